import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions import costs, text, timeutil
from gaugeworks.functions.predicates import cluster_id_of_audit, cluster_type, derive_sku, is_automated


def one(spark, col, **values):
    cols = [F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1).alias("x")]
    return spark.range(1).select(*cols).select(col.alias("out")).first()["out"]


def utc(*a):
    return dt.datetime(*a)


def test_to_ts(spark):
    fmt = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    assert one(spark, fmt(timeutil.to_ts(F.lit(123456789)))) == "1970-01-02T10:17:36"
    assert one(spark, fmt(timeutil.to_ts(F.lit(123456789), "sec"))) == "1973-11-29T21:33:09"
    assert one(spark, timeutil.to_ts(F.lit(123456789), "milli", T.DateType())) == dt.date(1970, 1, 2)
    assert one(spark, timeutil.to_ts(F.lit(123456789), "sec", T.DateType())) == dt.date(1973, 11, 29)
    with pytest.raises(ValueError):
        timeutil.to_ts(F.lit(1), "milli", T.LongType())


def test_text_times(spark):
    f = timeutil.string_ts_to_unix_millis
    assert one(spark, f(F.lit("2020-11-06T08:10:12.123Z"))) == 1604650212123
    assert one(spark, f(F.lit("2020-11-06T08:10:12Z"))) is None
    shown = F.date_format(timeutil.epoch_milli_to_ts(F.lit("1660109379388")), "yyyy-MM-dd HH:mm:ss.SSS")
    assert one(spark, shown) == "2022-08-10 05:29:39.388"
    assert one(spark, timeutil.epoch_milli_to_ts(F.lit("10/14/2016 09:28 PM"))) is None
    assert one(spark, timeutil.ts_to_epoch_milli(F.lit("2021-11-12 02:12:23.8870"))) == 1636683143887.0
    assert one(spark, timeutil.ts_to_epoch_milli(F.lit("1636663343887"))) is None


def test_run_time(spark):
    r = one(spark, timeutil.run_time(F.lit(123456789000), F.lit(223256289000)))
    assert r["runTimeMS"] == 99799500000
    assert r["runTimeS"] == 99799500.0
    assert r["runTimeM"] == 1663325.0
    assert abs(r["runTimeH"] - 27722.083333333332) < 1e-9


def test_ticks(spark):
    df = spark.sql(
        "select 2 as i, 2L as l, 2.0D as d, date'2020-10-30' as day, timestamp'2011-10-31 10:01:11.000' as ts"
    )
    kinds = {f.name: f.dataType for f in df.schema.fields}
    up = df.select(*[timeutil.add_ticks(F.col(c), 1, k).alias(c) for c, k in kinds.items()]).first()
    down = df.select(*[timeutil.subtract_ticks(F.col(c), 1, k).alias(c) for c, k in kinds.items()]).first()
    assert (up["i"], up["l"], up["d"], up["day"]) == (3, 3, 2.001, dt.date(2020, 10, 31))
    assert (down["i"], down["l"], down["d"], down["day"]) == (1, 1, 1.999, dt.date(2020, 10, 29))
    step = dt.timedelta(milliseconds=1)
    assert up["ts"] - df.first()["ts"] == step and df.first()["ts"] - down["ts"] == step
    with pytest.raises(ValueError):
        timeutil.add_ticks(F.lit("a"), 1, T.StringType())


def test_date_series(spark):
    days = one(spark, timeutil.date_series(F.lit(dt.date(2024, 1, 30)), F.lit(dt.date(2024, 2, 2))))
    assert days == [dt.date(2024, 1, 30), dt.date(2024, 1, 31), dt.date(2024, 2, 1)]
    assert one(spark, timeutil.date_series(F.lit(dt.date(2024, 1, 1)), F.lit(dt.date(2024, 1, 1)))) == []


def test_paths(spark):
    def c(p):
        return one(spark, text.cleanse_path(F.lit(p), "dfs"))

    assert c("dfs://12312//12332423") == "dfs:/12312/12332423"
    assert c("/12132/122132") == "dfs:/12132/122132"
    assert c("s3a://commoncrawl//path") == "s3a://commoncrawl/path"
    g = one(spark, text.group_filename(F.lit("a:/b/c/d/e/f/g")))
    assert (g["byCluster"], g["byDriverHost"], g["bySparkContext"]) == ("a:/b/c", "a:/b/c/d/e", "a:/b/c/d/e/f")


def test_text_pieces(spark):
    d = one(spark, text.stream_details(F.lit("name<br/>id = a1<br/>runId = r2<br/>batch = 7")))
    assert (d["stream_id"], d["stream_run_id"], d["stream_batch_id"]) == ("a1", "r2", "7")
    group = F.lit("1234_5678_job-12-run-3-action-9")
    assert one(spark, text.job_id_of_group(group)) == "12"
    assert one(spark, text.run_id_of_group(group)) == "3"
    assert one(spark, text.job_id_of_group(F.lit("plain"))) is None
    conf = F.lit('{"spark.some.key": "v"}')
    assert one(spark, text.dotted_json_value(conf, "spark.some.key")) == "v"


def test_predicates(spark):
    assert one(spark, is_automated(F.lit("job-1-run-2"))) is True
    assert one(spark, is_automated(F.lit("mine"))) is False
    cases = [
        (True, "apache_spark_2.4", "Standard", "jobsLight"),
        (True, "9.1", "Standard", "automated"),
        (False, "9.1", "SQL Analytics", "sqlCompute"),
        (False, "9.1", "High-Concurrency", "interactive"),
        (False, "9.1", "Standard", "interactive"),
    ]
    for auto, version, kind, want in cases:
        assert one(spark, derive_sku(F.lit(auto), F.lit(version), F.lit(kind))) == want
    def ct(conf, tags):
        return one(spark, cluster_type(F.lit(conf), F.lit(tags), "cluster.profile", "EndpointId"))

    assert ct('{"cluster.profile":"singleNode"}', "{}") == "Single Node"
    assert ct('{"cluster.profile":"serverless"}', "{}") == "High-Concurrency"
    assert ct("{}", '{"EndpointId":"1"}') == "SQL Analytics"
    assert ct("{}", "{}") == "Standard"
    audit = lambda s, a: one(
        spark, cluster_id_of_audit(F.lit(s), F.lit(a), F.lit("p"), F.lit("alt"), F.lit('{"cluster_id":"r"}'))
    )
    assert [audit("clusters", a) for a in ("createResult", "edit", "create")] == ["alt", "p", "r"]
    assert audit("jobs", "create") == "p"


def test_cost_formulas(spark):
    assert one(spark, costs.compute_cost(F.lit(True), F.lit(2.0), F.lit(3), F.lit(0.5))) == 3.0
    assert one(spark, costs.compute_cost(F.lit(False), F.lit(2.0), F.lit(3), F.lit(0.5))) == 0.0
    assert one(spark, costs.compute_cost(F.lit(True), F.lit(None).cast("double"), F.lit(3), F.lit(0.5))) == 0.0
    m = lambda e, s, a: one(spark, costs.engine_multiplier(F.lit(e), F.lit(s), F.lit(a)))
    assert [m("PHOTON", "automated", True), m("photon", "interactive", False)] == [2.9, 2.0]
    assert [m("PHOTON", "sqlCompute", False), m("STANDARD", "automated", True)] == [1.0, 1.0]
    df = spark.createDataFrame([("a", 1.0), ("a", 2.5), ("b", -4.0)], "k string, v double")
    got = {r["k"]: r["v"] for r in costs.summarize_costs(df, ["v"], ["k"], 2, F.lit(2)).collect()}
    assert got == {"a": 7.0, "b": 0.0}
    with pytest.raises(ValueError):
        costs.summarize_costs(df, ["nope"], ["k"], 2, F.lit(1))
