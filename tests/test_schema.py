import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.operators import schema as S


def ddl(df):
    return df.schema.simpleString()


def from_json_lines(spark, lines):
    return spark.read.json(spark.sparkContext.parallelize(lines))


def test_scrub_simple(spark):
    df = spark.createDataFrame([(1, 2)], "`field-1` int, `f-i-e-l-d\\\\2` int")
    assert S.scrub_schema(df).columns == ["field_1", "f_i_e_l_d__2"]


def test_scrub_array_and_struct(spark):
    lines = [
        '{"i-1": 1, "b-2-2-2": [{"c_1-\\\\45": 123, "abc": "ttt"}, {"c_1-\\\\45": 124, "abc": "sss"}]}',
    ]
    df = S.scrub_schema(from_json_lines(spark, lines))
    assert ddl(df) == "struct<b_2_2_2:array<struct<abc:string,c_1__45:bigint>>,i_1:bigint>"
    assert df.first()["b_2_2_2"][1]["c_1__45"] == 124
    df = S.scrub_schema(from_json_lines(spark, ['{"i-1": 1, "b-2-2-2": {"c_1-\\\\45": 123, "abc": "ttt"}}']))
    assert ddl(df) == "struct<b_2_2_2:struct<abc:string,c_1__45:bigint>,i_1:bigint>"


def test_scrub_with_exceptions(spark):
    L, X = T.LongType(), T.StringType()
    inner = T.StructType(
        [T.StructField(n, t) for n, t in [
            ("# mixed", L), ("%bad", L), ("dup 1", L), ("dup 1", L), ("dup2", L), ("dup2", X),
            ("good_col", L), ("j.k.l", L), ("other except", L)]]
    )
    parent = T.StructType(
        [T.StructField("dup 1", L), T.StructField("dup2", L), T.StructField("x.y.z", inner), T.StructField("z.y.x", L)]
    )
    df = spark.createDataFrame([((20, 21, (14, 15, 16, 17, 18, "19", 10, 12, 11), 22), "test")],
                               T.StructType([T.StructField("exception_parent", parent), T.StructField("parent w space", X)]))
    rules = [(r"\s", ""), (r"\.", ""), (r"[^a-zA-Z0-9]", "_")]
    out = S.scrub_schema(df, exceptions=[S.NameException("exception_parent", rules, True)])
    assert ddl(out) == (
        "struct<exception_parent:struct<dup1:bigint,dup2:bigint,xyz:struct<_mixed:bigint,_bad:bigint,"
        "dup1_UNIQUESUFFIX_95946320:bigint,dup1_UNIQUESUFFIX_95946320:bigint,"
        "dup2_UNIQUESUFFIX_3095059:bigint,dup2_UNIQUESUFFIX_3095059:string,"
        "good_col:bigint,jkl:bigint,otherexcept:bigint>,zyx:bigint>,parentwspace:string>"
    )


def test_scrub_drops_void(spark):
    df = spark.sql("select 1 as a, null as b, named_struct('x', null, 'y', 2) as s")
    assert ddl(S.scrub_schema(df, drop_null_types=True)) == "struct<a:int,s:struct<y:int>>"


@pytest.fixture(scope="module")
def nested(spark):
    return spark.sql(
        "select 1L as id, named_struct('c1', 2L, 'c2', 'x', 'c3', "
        "named_struct('c3_1', 3L, 'c3_2', 'y', 'c3_3', named_struct('c3_3_1', 'z', 'c3_3_2', 'w'))) as value"
    )


def test_flatten(nested):
    assert S.flatten(nested).columns == [
        "id", "value_c1", "value_c2", "value_c3_c3_1", "value_c3_c3_2", "value_c3_c3_3_c3_3_1", "value_c3_c3_3_c3_3_2",
    ]


def test_drop_struct_fields(nested):
    assert S.drop_struct_fields(nested, "value", ["c1", "C2"]).schema["value"].dataType.fieldNames() == ["c3"]
    for struct, fields in (("value", ["c3.c3_1"]), ("value.c3", ["c3_1"])):
        with pytest.raises(ValueError):
            S.drop_struct_fields(nested, struct, fields)


def test_modify_struct(nested):
    same = S.modify_struct(nested, {"value.nope": F.lit(1)})
    assert same.schema.simpleString() == nested.schema.simpleString()
    out = S.modify_struct(nested, {"id": F.lit("a"), "value.c3.c3_3.c3_3_1": F.lit(7)}).first()
    assert out["id"] == "a" and out["value"]["c3"]["c3_3"]["c3_3_1"] == 7
    assert out["value"]["c3"]["c3_3"]["c3_3_2"] == "w"


def test_append_to_struct(nested):
    out = S.append_to_struct(nested, "value", {"c1": F.lit(9), "n": F.lit(5)}).first()["value"]
    assert (out["c1"], out["n"]) == (2, 5)
    out = S.append_to_struct(nested, "value", {"c1": F.lit(9)}, override=True, new_name="v2").first()
    assert (out["v2"]["c1"], out["value"]["c1"]) == (9, 2)
    with pytest.raises(ValueError):
        S.append_to_struct(nested, "id", {"x": F.lit(1)})


def test_struct_from_json(spark):
    df = spark.createDataFrame([('{"a": 1}', "oops", "", 1), ('{"b": "x"}', "{bad", "", 2)], "j string, m string, e string, n int")
    out = df.select(S.struct_from_json(df, "j"))
    assert ddl(out) == "struct<j:struct<a:bigint,b:string>>"
    assert ddl(df.select(S.struct_from_json(df, "m"))) == "struct<m:struct<_corrupt_record:string>>"
    assert ddl(df.select(S.struct_from_json(df, "e"))) == "struct<e:void>"
    assert ddl(df.select(S.struct_from_json(df, "e", when_empty=S.STRING_MAP))) == "struct<e:map<string,string>>"
    with pytest.raises(ValueError):
        S.struct_from_json(df, "zzz")
    with pytest.raises(ValueError):
        S.struct_from_json(df, "n")
    arr = spark.createDataFrame([('[{"a":1},{"a":2}]',)], "j string")
    got = arr.select(S.struct_from_json(arr, "j", is_array=True)).first()["j"]
    assert [r["a"] for r in got] == [1, 2]


def test_json_schemas_are_those_of_the_reader(spark, tmp_path):
    texts = {
        "plain": ['{"a":1,"b":{"c":[1,2]}}', '{"b":{"c":[],"d":null}}', None, "  ", '\n{"z":true}\n'],
        "mixed": ['{"a b":1,"x:y":2,"q`":1.5,"o":{"OBJECT<":null,"e":{}},"arr":[],"n":12345678901234567890}',
                  '{"a b":"s","x:y":2.5,"l":[{"z":true},{"w":1}],"e":1e3}'],
        "arrays": ['[{"k":1},{"k":2.5}]', '{"j":[[1],["s"]]}', "[]", "null", '[{"m":[{}]}]'],
        "bad": ['{"a":1}', '{"a":', "5"],
        "only bad": ["{x", '"text"'],
        "conflict": ['{"a":{"b":1}}', '{"a":5}', '{"a":[1]}'],
        "empty": ["{}", "[]"],
        "wide": ['{"a":9223372036854775807,"b":false}', '{"a":1.25,"b":"x"}'],
    }
    longest = max(map(len, texts.values()))
    rows = list(zip(*[v + [None] * (longest - len(v)) for v in texts.values()]))
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in texts))
    found = S.json_schemas(df, list(texts))
    for c, values in texts.items():
        one_line = [(v.replace("\n", " "),) for v in values if v is not None and v.strip()]
        spark.createDataFrame(one_line, "t string").coalesce(1).write.text(f"{tmp_path}/{c}")
        assert found[c] == spark.read.json(f"{tmp_path}/{c}").schema, c
    assert S.json_schemas(df, []) == {}


def test_one_job_finds_all_schemas(spark):
    df = spark.createDataFrame([('{"a":1}', '[{"b":2}]')] * 5, "x string, y string")
    spark.sparkContext.setJobGroup("schemas", "")
    S.json_schemas(df, ["x", "y"])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("schemas")
    spark.sparkContext.setJobGroup("other", "")
    assert len(jobs) <= 2  # the aggregation; adaptive execution runs its shuffle stage as a job


def test_struct_to_map(spark):
    df = spark.sql("select named_struct('a', 1, 'b', cast(null as string)) as s, null as v, 5 as n")
    assert df.select(S.struct_to_map(df.schema, "s")).first()["s"] == {"a": "1"}
    assert df.select(S.struct_to_map(df.schema, "s", drop_empty=False)).first()["s"] == {"a": "1", "b": None}
    for c in ("v", "zzz"):
        out = df.select(S.struct_to_map(df.schema, c))
        assert ddl(out) == f"struct<{c}:map<string,string>>" and out.first()[0] is None
    with pytest.raises(ValueError):
        S.struct_to_map(df.schema, "n")


def test_clean_struct_array(spark):
    df = spark.sql(
        "select 1 as k, array(named_struct('task_key', 'a', 'new_cluster', named_struct('spark_conf', named_struct('x', 1), 'n', 2)), "
        "named_struct('task_key', 'b', 'new_cluster', null)) as tasks"
    )
    out = df.withColumn("tasks", S.clean_struct_array(df, "tasks", ["new_cluster.spark_conf"])).first()["tasks"]
    assert out[0]["new_cluster"]["spark_conf"] == {"x": "1"} and out[0]["new_cluster"]["n"] == 2
    assert out[1]["task_key"] == "b" and out[1]["new_cluster"] is None
    missing = df.select(S.clean_struct_array(df, "zzz", [], T.ArrayType(T.StringType())))
    assert ddl(missing) == "struct<zzz:array<string>>"


def test_drop_empty_columns(spark):
    df = spark.sql(
        "select * from values (1, 'a', map('k', 1), array(1), true, date'2020-01-01', cast(null as string), cast(null as map<string,int>)),"
        "(null, null, null, null, null, null, null, null) as t(i, s, m, a, b, d, x, y)"
    )
    assert set(S.drop_empty_columns(df).columns) == {"i", "s", "m", "a", "b", "d"}


def test_enforce_schema(spark):
    df = spark.sql("select '5' as a, 1 as free, 2 as gone, named_struct('p', '1') as s, array('1') as arr, map('k','v') as m")
    need = T.StructType.fromDDL("new string, a bigint, s struct<p:int, q:string>, arr array<int>, m map<string,string>")
    need = T.StructType([*need.fields, T.StructField("gone", T.NullType())])
    out = S.enforce_schema(df, need)
    assert ddl(out) == "struct<new:string,free:int,a:bigint,s:struct<q:string,p:int>,arr:array<int>,m:map<string,string>>"
    assert out.first()["a"] == 5 and out.first()["s"]["p"] == 1
    actions = {c.path: c.action for c in S.review_schema(df, need)}
    assert actions["new"] == "added" and actions["free"] == "kept" and actions["a"] == "cast" and actions["s.q"] == "added"
    for bad in ("a struct<x:int>", "s string", "m map<string,int>", "arr int"):
        with pytest.raises(S.SchemaMismatch):
            S.enforce_schema(df, T.StructType.fromDDL(bad))


def test_small_column_tools(spark):
    df = spark.createDataFrame([(1, None, None, None)], "a int, b string, c boolean, d double")
    assert S.columns_to_front(df, ["d", "b"]).columns == ["d", "b", "a", "c"]
    assert S.suffix_columns(df, "_x", ["a"]).columns == ["a_x", "b", "c", "d"]
    assert S.prefix_columns(df, "p_", ["a", "b"]).columns == ["p_a", "p_b", "c", "d"]
    assert tuple(S.fill_all_nulls(df).first()) == (1, "0", False, 0.0)
    other = spark.createDataFrame([(7, "z")], "a int, e string")
    assert [tuple(r) for r in S.union_with_nulls(df, other).select("a", "e").collect()] == [(1, None), (7, "z")]
    assert S.add_columns_of(df, other).schema["e"].dataType == T.StringType()
    assert S.apply_filters(spark.range(10), [F.col("id") > 3, F.col("id") < 6]).count() == 2


def test_project_properties(spark):
    df = spark.sql("select map('k1', 'a', 'k2', 'b') as p")
    out = df.select(S.project_properties(F.col("p"), {"One": "k1", "In": {"Two": "k2", "No": "zz"}}).alias("o")).first()["o"]
    assert (out["One"], out["In"]["Two"], out["In"]["No"]) == ("a", "b", None)


def test_case_variants(spark):
    from gaugeworks.sources.files import case_sensitive

    with case_sensitive(spark):
        df = spark.sql(
            "select * from values ('u', 'low', 'UP'), ('v', 'low', 'UP'), ('w', 'low', 'UP') as t(actionName, x, y)"
        ).select("actionName", F.struct(F.col("x").alias("itemId"), F.col("y").alias("ItemId")).alias("r"))
        out = S.merge_case_variants(df, "r", {"itemId": ("ItemId", [(["u"], "ItemId")], True)}, "actionName")
    assert {r["actionName"]: r["r"]["itemId"] for r in out.collect()} == {"u": "UP", "v": "low", "w": "low"}
    assert out.schema["r"].dataType.fieldNames() == ["itemId"]
