from collections import Counter

import duckdb
from gaugeworks.llm.common import table
from gaugeworks.llm.mixing import mix
from gaugeworks.llm.packing import pack
from gaugeworks.llm.queries import ORACLES
from gaugeworks.llm.quality_classifier import score_quality
from pyspark.sql import functions as F
from test_line_dedup import key
from test_simhash import brute, groups_of

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from check_oracle import TABLES, table_of

FOLDER = "/root/testdata/sf0.001"


def test_stages_act_on_all_that_is_left(spark, tmp_path):
    docs = table(spark, FOLDER, "documents")
    columns, seen = docs.columns, [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        seen.append(docs)
    for df in seen[1:-1]:
        assert df.columns == columns
    start, good, lines, single, mixed, packed = seen
    scored = score_quality(start, table(spark, FOLDER, "labels"))
    assert sorted(r.doc_id for r in good.collect()) == sorted(r.i for r in scored.filter("predicted = 1").selectExpr("row.doc_id i").collect())
    texts_are_deduplicated_by_lines(good, lines)
    one_of_each_group_is_kept(lines, single)
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(r.doc_id for r in mix(single).collect())
    tokens = {r.doc_id: r.doc_tokens for r in pack(single).collect()}
    assert sum(r.length for r in packed.collect()) == sum(tokens[r.doc_id] for r in mixed.collect())
    run = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(str, run.drop("sequence_id", "offset").collect())) == sorted(map(str, packed.drop("sequence_id", "offset").collect()))


def texts_are_deduplicated_by_lines(before, after):
    """Line dedup is that of a plain loop over all texts."""
    texts = {r.doc_id: (r.text or "").split("\n") for r in before.collect()}
    n = Counter(k for lines in texts.values() for k in {key(x) for x in lines})
    want = {i: "\n".join(x for x in lines if not key(x) or n[key(x)] < 10) for i, lines in texts.items()}
    assert {r.doc_id: r.text or "" for r in after.collect()} == want


def one_of_each_group_is_kept(before, after):
    """Of each group linked by at most four differing bits, over all pairs, the least id is left as it was."""
    rows = before.collect()
    left = after.collect()
    assert set(left) <= set(rows)
    fps = {r: brute(r.text) for r in rows}
    root = groups_of(list(fps.values()), 4)
    least = {}
    for r, fp in fps.items():
        least[root[fp]] = min(least.get(root[fp], r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in left) == sorted(least.values())
    assert len(left) < len(rows)


def test_near_copies_are_found_after_shared_lines_are_gone(spark):
    """Lines that ten documents share hide copies; both stages against plain loops."""
    shared = ["a line that all of them hold", "  And ANOTHER one\t", "\u00c9t\u00e9"]
    rows = []
    for i in range(36):
        words = [f"w{i // 3}x{j}" for j in range(400)]
        if i % 3 == 2:
            words[100] = "other"
        rows.append((i, "\n".join([" ".join(words[:90]), " ".join(words[90:]), *shared[: 1 + i % 3]]), "en", "s", 1))
    rows += [(100, None, "en", "s", 0), (101, "", "en", "s", 0), (102, shared[0], "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    lines = corpus_pipeline.dedup_lines(spark, docs, FOLDER).withColumn("n_chars", F.lit(1).cast("long"))
    texts_are_deduplicated_by_lines(docs, lines)
    single = corpus_pipeline.dedup_near_copies(spark, lines, FOLDER)
    one_of_each_group_is_kept(lines, single)
    kept = {r.doc_id for r in single.collect()}
    assert {3 * i for i in range(12)} | {100} <= kept and not kept & {3 * i + 1 for i in range(12)}


def test_queries_equal_their_sql(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    for name, sql in ORACLES.items():
        df = queries()[name](spark, FOLDER)
        cur = con.execute(sql)
        assert table_of(df.columns, df.collect()) == table_of([d[0] for d in cur.description], cur.fetchall()), name


def test_all_are_registered():
    names = set(queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
    assert set(ORACLES) <= set(oracle_sql())
