import random

import duckdb
import pytest
from fixtures import awkward, docs_of, nothing
from gaugeworks.llm.mixing import OP3_SQL, leaf_budgets, mix, mixed_documents
from pyspark.sql import functions as F


def water(budget, children):
    """Share a budget by weight, children (name, weight, cap), the slow way."""
    given = {n: 0 for n, _, _ in children}
    open_ = [(n, w, c) for n, w, c in children if w > 0]
    left = budget
    while open_:
        level = left / sum(w for _, w, _ in open_)
        full = [(n, w, c) for n, w, c in open_ if c <= level * w]
        if not full:
            for n, w, _ in open_:
                given[n] = int(level * w)
            break
        for n, _, c in full:
            given[n] = c
            left -= c
        open_ = [x for x in open_ if x not in full]
    return given


@pytest.mark.parametrize("seed", range(3))
def test_budgets_against_slow_filling(spark, seed):
    r = random.Random(seed)
    leaves = [(d, g, s, r.choice([0, 5, 40, 300, 2000])) for d in "ab" for g in ("x", "y", None) for s in ("p", "q", "r")]
    weights = {"domain": {"a": 3, "b": 1}, "lang": {"x": 2, "y": 5}, "source": {"p": 0, "q": 4}}
    budget, epochs = r.choice([100, 3000, 20_000]), 2
    df = spark.createDataFrame(leaves, "domain string, lang string, source string, supply long")
    got = {(x.domain, x.lang, x.source): x for x in leaf_budgets(df, F.lit(budget).cast("long"), epochs, weights).collect()}
    cap = lambda t: epochs * sum(x[3] for x in leaves if x[: len(t)] == t)
    for d, gd in water(budget, [(d, weights["domain"].get(d, 1), cap((d,))) for d in "ab"]).items():
        langs = [(g, weights["lang"].get(g, 1), cap((d, g))) for g in ("x", "y", None)]
        for g, gg in water(gd, langs).items():
            kids = [(s, weights["source"].get(s, 1), cap((d, g, s))) for s in ("p", "q", "r")]
            for s, gs in water(gg, kids).items():
                x = got[d, g, s]
                assert abs(x.given - gs) <= 1
                assert x.given == x.epochs * x.supply + x.rest and 0 <= x.rest < max(x.supply, 1)


def test_awkward_rows_match_sql(spark):
    docs = awkward(spark)
    pdf = docs.select("doc_id", "text", "lang", "source", "n_chars").toPandas()
    con = duckdb.connect()
    con.register("frame", pdf)
    con.execute("CREATE VIEW documents AS SELECT doc_id::BIGINT AS doc_id, text, lang, source FROM frame")
    want = con.execute(OP3_SQL)
    names = [d[0] for d in want.description]
    norm = lambda r: tuple(None if v != v else v for v in r)
    got = mix(docs).select(*names).collect()
    assert sorted(map(str, map(norm, want.fetchall()))) == sorted(str(tuple(r)) for r in got)


def test_tokens_follow_the_weights_and_stay_within_epochs(spark):
    rows = [(i, "w " * (1 + i % 7), "en", f"src{i % 20}") for i in range(600)]
    got = mix(docs_of(spark, rows), 0.5, 1, weights={"domain": {"web": 3}}).groupBy("domain").agg(F.sum("tokens").alias("n")).collect()
    n = {r.domain: r.n for r in got}
    total = sum(1 + i % 7 for i in range(600))
    assert n["web"] <= total / 4 + 7  # all of its supply at one epoch
    assert abs(sum(n.values()) - total / 2) <= 20 * 7 + 10
    assert max(n["books"], n["news"], n["talk"]) - min(n["books"], n["news"], n["talk"]) <= 5 * 7


def test_stage_repeats_documents_with_their_columns(spark):
    docs = docs_of(spark, [(i, "a b c", "en", "src0" if i else "src7") for i in range(10)])
    out = mixed_documents(docs, 1.0, 3)
    assert out.columns == docs.columns
    n = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert n[0] == 3 and sum(n.values()) == mix(docs, 1.0, 3).count()


def test_empty(spark):
    assert mix(nothing(spark)).count() == 0
    assert mixed_documents(nothing(spark)).count() == 0
