"""The sliced running values must equal a plain walk over each key."""

import random

from pyspark.sql import functions as F

from gaugeworks.operators.fill import near_value
from gaugeworks.operators.scan import Running, ordered_scan

KINDS = ["last", "last_x", "first", "first_x", "sum", "sum_x", "max", "lag", "lead"]


def make(n=400, seed=1):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        k = "hot" if rnd.random() < 0.5 else rnd.choice(["a", "b", None])
        out.append((k, rnd.randrange(0, 300), i, rnd.choice([None, None, rnd.randrange(100)])))
    return out


def walk(data):
    by_key = {}
    for k, t, i, v in data:
        by_key.setdefault(k, []).append((t, i, v))
    expected = {}
    for rows in by_key.values():
        rows.sort()
        vals = [v for _, _, v in rows]
        for p, (_, i, _) in enumerate(rows):
            def last(xs):
                known = [x for x in xs if x is not None]
                return known[-1] if known else None

            def total(xs):
                known = [x for x in xs if x is not None]
                return sum(known) if known else None

            seen = [x for x in vals[: p + 1] if x is not None]
            expected[i] = (
                last(vals[: p + 1]),
                last(vals[:p]),
                last(vals[p:][::-1]),
                last(vals[p + 1 :][::-1]),
                total(vals[: p + 1]),
                total(vals[:p]),
                max(seen) if seen else None,
                vals[p - 1] if p else None,
                vals[p + 1] if p + 1 < len(vals) else None,
            )
    return expected


def test_scan_equals_walk_for_any_slicing(spark):
    data = make()
    df = spark.createDataFrame(data, "k string, t int, id int, v int")
    running = [
        Running(k, k.removesuffix("_x"), F.col("v"), exclusive=k.endswith("_x")) for k in KINDS
    ]
    want = walk(data)
    for by in (None, F.floor(F.col("t") / 7), F.floor(F.col("t") / 50), F.col("t")):
        got = {
            r["id"]: tuple(r[k] for k in KINDS)
            for r in ordered_scan(df, ["k"], ["t", "id"], running, by).collect()
        }
        assert got == want


def test_scan_equals_walk_with_large_and_small_keys(spark):
    """Of the keys some are cut into slices and some are not, also where slices are null."""
    data = make()
    df = spark.createDataFrame(data, "k string, t int, id int, v int")
    running = [Running(k, k.removesuffix("_x"), F.col("v"), exclusive=k.endswith("_x")) for k in KINDS]
    want = walk(data)
    for rows in (0, 60, 100, 150, 1000):
        for by in (F.floor(F.col("t") / 7), F.when(F.col("t") >= 100, F.floor(F.col("t") / 50))):
            scanned = ordered_scan(df, ["k"], ["t", "id"], running, by, whole_key_rows=rows)
            assert {r["id"]: tuple(r[k] for k in KINDS) for r in scanned.collect()} == want
            assert scanned.columns == ["k", "t", "id", "v", *KINDS]


def test_small_keys_need_no_summaries_of_slices(spark):
    """Keys of a few rows a day must not cost two more rows for each slice."""
    df = spark.range(2000).select((F.col("id") % 500).alias("k"), F.col("id").alias("t"))
    scanned = ordered_scan(df, ["k"], ["t"], [Running("b", "last", F.col("t"), True), Running("n", "lead", F.col("t"))], F.col("t"))
    assert len(scanned.collect()) == 2000
    plan = scanned._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Final Plan" in plan and "Union" not in plan and "SortAggregate" not in plan


def test_scan_without_keys(spark):
    df = spark.range(100).withColumn("v", F.col("id") % 3)
    got = ordered_scan(df, [], ["id"], [Running("s", "sum", F.col("v"))], F.floor(F.col("id") / 9))
    total = 0
    for r in sorted(got.collect(), key=lambda r: r["id"]):
        total += r["id"] % 3
        assert r["s"] == total


def test_near_value_counts_rows(spark):
    data = make(300, 5)
    df = spark.createDataFrame(data, "k string, t int, id int, v int")
    by_key = {}
    for k, t, i, v in data:
        by_key.setdefault(k, []).append((t, i, v))
    for exclusive in (False, True):
        want = {}
        for rows in by_key.values():
            rows.sort()
            for p, (_, i, _) in enumerate(rows):
                gap = 1 if exclusive else 0
                ahead = [r[2] for r in rows[p + gap : p + 4] if r[2] is not None]
                back = [r[2] for r in rows[max(p - 3, 0) : p + 1 - gap] if r[2] is not None]
                want[i] = (ahead[0] if ahead else None, back[-1] if back else None)
        got = near_value(
            df, ["k"], ["t", "id"], {"a": ("v", "first"), "b": ("v", "last")},
            F.floor(F.col("t") / 20), 3, exclusive, 10,
        )
        assert {r["id"]: (r["a"], r["b"]) for r in got.collect()} == want
