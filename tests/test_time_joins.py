import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gaugeworks.operators import joins
from gaugeworks.operators.asof import UNBOUNDED, Lookup, TimeSeries, asof_join, asof_lookup, asof_lookups
from gaugeworks.session import materialize

# key 1: before all right rows, a tie (not seen), between two, after the last; key 2: one right row; key 3: none
LEFT = [(10, 1), (20, 1), (33, 1), (90, 1), (44, 2), (50, 3)]
RIGHT = [(15, 1, "p"), (20, 1, "q"), (40, 1, "r"), (41, 2, "s"), (60, 4, "t")]


def series(spark, rows, ddl):
    return TimeSeries(spark.createDataFrame(rows, ddl), "timestamp", ["jobId"])


@pytest.mark.parametrize("width", [0, 1, 2, 100])
def test_asof_golden_rows(spark, width):
    left = series(spark, LEFT, "timestamp int, jobId int")
    right = series(spark, RIGHT, "timestamp int, jobId int, jobName string")
    got = {(r["timestamp"], r["jobId"]): r["jobName"] for r in left.lookup(right, slice_width=width).df.collect()}
    assert got == {
        (10, 1): None, (20, 1): "p", (33, 1): "q", (90, 1): "r", (44, 2): "s", (50, 3): None,
    }


def test_asof_same_names_and_shuffled_input(spark):
    left = series(spark, [(5, 1, "own", None), (6, 1, None, None)], "timestamp int, jobId int, a string, b string")
    rows = [(1, 1, "r1", "b1"), (2, 1, "r2", None)]
    for order in (rows, rows[::-1]):
        right = series(spark, order, "timestamp int, jobId int, a string, b string")
        got = sorted(tuple(r[c] for c in ("timestamp", "a", "b")) for r in asof_lookup(left, right, slice_width=1).collect())
        assert got == [(5, "own", "b1"), (6, "r2", "b1")]


def brute_lookup(left, right, back, ahead):
    out = {}
    for lt, k, i in left:
        stream = sorted([(t, 0, i2, None) for t, k2, i2 in left if k2 == k] + [(t, 1, i2, v) for t, k2, i2, v in right if k2 == k])
        at = stream.index((lt, 0, i, None))
        before = stream[(0 if back == UNBOUNDED else max(at - back, 0)) : at + 1]
        after = stream[at : (len(stream) if ahead == UNBOUNDED else at + ahead + 1)]
        known = [v for *_, v in before if v is not None]
        later = [v for *_, v in after if v is not None]
        out[i] = known[-1] if known else (later[0] if later else None)
    return out


@pytest.mark.parametrize("back,ahead", [(UNBOUNDED, 0), (UNBOUNDED, 1), (UNBOUNDED, UNBOUNDED), (0, 1), (3, 2), (UNBOUNDED, 4), (2, UNBOUNDED)])
def test_asof_limits_equal_brute_force(spark, back, ahead):
    rnd = random.Random(back * 31 + ahead)
    times = rnd.sample(range(1000), 160)
    left = [(t, rnd.choice([1, 1, 1, 2]), i) for i, t in enumerate(times[:80])]
    right = [(t, rnd.choice([1, 1, 1, 2]), 1000 + i, rnd.choice([None, i])) for i, t in enumerate(times[80:])]
    l = TimeSeries(spark.createDataFrame(left, "timestamp long, jobId int, id int"), "timestamp", ["jobId"])
    r = TimeSeries(spark.createDataFrame(right, "timestamp long, jobId int, rid int, v int").drop("rid"), "timestamp", ["jobId"])
    got = asof_lookup(l, r, look_back=back, look_ahead=ahead, slice_width=37)
    assert {x["id"]: x["v"] for x in got.collect()} == brute_lookup(left, right, back, ahead)


def test_left_order_decides_ties(spark):
    left = TimeSeries(spark.createDataFrame([(5, 1, i) for i in (3, 1, 2)], "timestamp long, jobId int, id int"), "timestamp", ["jobId"])
    right = TimeSeries(spark.createDataFrame([(5, 1, "x")], "timestamp long, jobId int, v string"), "timestamp", ["jobId"])
    got = asof_lookup(left, right, look_back=0, look_ahead=1, left_order=["id"])
    assert {r["id"]: r["v"] for r in got.collect()} == {1: None, 2: None, 3: "x"}


def test_asof_join_keeps_both_sides(spark):
    left = series(spark, LEFT, "timestamp int, jobId int")
    right = series(spark, RIGHT, "timestamp int, jobId int, jobName string")
    got = asof_join(left, right, slice_width=2)
    assert got.count() == len(LEFT) + len(RIGHT)
    row = got.filter("timestamp = 90 and jobId = 1").first()
    assert (row["right_jobName"], row["right_timestamp"]) == ("r", 40)
    with pytest.raises(ValueError):
        asof_join(left, TimeSeries(right.df.withColumnRenamed("jobId", "other"), "timestamp", ["other"]))
    with pytest.raises(ValueError):
        TimeSeries(right.df, "jobName", ["jobId"])


COMMON = "site string, unit int, day date"
DAY = dt.date(2024, 3, 10)
ROWS_A = [("n", 1, DAY, "a1"), ("n", 2, DAY, "a2"), ("n", 3, DAY, "a3"), ("s", 1, DAY, "a4"), (None, 5, DAY, "a5")]
# at the limit, one day beyond it, far on the other side, an unknown key, a null key
ROWS_B = [
    ("n", 1, DAY + dt.timedelta(4), "b1"), ("n", 2, DAY + dt.timedelta(5), "b2"), ("n", 3, DAY - dt.timedelta(400), "b3"),
    ("w", 1, DAY, "b4"), (None, 5, DAY, "b5"),
]
KEYS = ["site", "unit"]


@pytest.mark.parametrize("lagging", ["left", "right"])
@pytest.mark.parametrize("how", ["left", "right", "inner"])
def test_lag_join_variants(spark, how, lagging):
    a = spark.createDataFrame(ROWS_A, COMMON + ", log1 string")
    b = spark.createDataFrame(ROWS_B, COMMON + ", log2 string")
    left, right = (a, b) if lagging == "left" else (b, a)
    out = joins.lag_join(left, right, KEYS, "day", lagging=lagging, lag_days=4, how=how)
    got = {(r["log1"], r["log2"]) for r in out.collect()}
    want = {("a1", "b1"), ("a3", "b3")}
    if how == ("left" if lagging == "left" else "right"):
        want |= {("a2", None), ("a4", None), ("a5", None)}
    elif how != "inner":
        want |= {(None, "b2"), (None, "b4"), (None, "b5")}
    assert got == want
    assert set(out.columns) == {*KEYS, "day", "log1", "log2"}


def test_lag_join_errors(spark):
    a = spark.createDataFrame(ROWS_A, COMMON + ", log1 string")
    with pytest.raises(ValueError):
        joins.lag_join(a.drop("day"), a, KEYS, "day")
    with pytest.raises(ValueError):
        joins.lag_join(a, a.withColumn("day", F.lit(1)), KEYS, "day")
    with pytest.raises(ValueError):
        joins.lag_join(a, a, KEYS, "day", how="outer")


@pytest.mark.parametrize("bucket", [None, 7, 1000])
def test_range_join_both_ends_count(spark, bucket):
    fact = spark.createDataFrame([("A ", 5), ("a", 10), ("b", 10), ("a", 25), ("c", 1)], "k string, at long")
    dim = spark.createDataFrame([(" a", 1, 10, "one"), ("A", 10, None, "two"), ("b", 20, None, "late")], "dk string, f long, u long, v string")
    out = joins.range_join(fact, dim, [("k", "dk")], "at", "f", "u", F.lit(30), bucket=bucket)
    got = sorted((r["k"].strip().lower(), r["at"], r["v"]) for r in out.collect() if r["v"])
    assert got == [("a", 5, "one"), ("a", 10, "one"), ("a", 10, "two"), ("a", 25, "two")]
    assert out.filter("v is null").count() == 2


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("bucket", [1, 10, 1 << 20])
def test_range_join_equals_brute_force(spark, how, bucket):
    rnd = random.Random(bucket)
    dims = [(rnd.choice("ab "), a, a + rnd.choice([-5, 0, 1, 7, 300, 5000]), i) for i, a in enumerate(rnd.randrange(-3000, 3000) for _ in range(60))]
    dims += [("a", None, 5, 90), ("b", 17, None, 91), (None, 0, 10, 92)]
    facts = [(rnd.choice(["A", " b", "c", None]), rnd.choice([None, rnd.randrange(-3200, 3200)]), i) for i in range(200)]
    facts += facts[:20]
    want = []
    for k, at, i in facts:
        key = None if k is None else k.strip().lower()
        found = [
            v for dk, lo, up, v in dims
            if key is not None and dk is not None and dk.strip() == key and at is not None and lo is not None and lo <= at <= (4000 if up is None else up)
        ]
        want += [(i, v) for v in found] or ([(i, None)] if how == "left" else [])
    fact = spark.createDataFrame(facts, "k string, at long, i long")
    dim = spark.createDataFrame(dims, "dk string, f long, u long, v long")
    out = joins.range_join(fact, dim, [("k", "dk")], "at", "f", "u", F.lit(4000), how=how, bucket=bucket)
    assert set(out.columns) == {"k", "at", "i", "dk", "f", "u", "v"}
    assert sorted(map(str, ((r.i, r.v) for r in out.collect()))) == sorted(map(str, want))


def test_dyadic_cells_make_up_the_range(spark):
    rnd = random.Random(4)
    ranges = [(a, a + n) for a in (-1000, -9, -1, 0, 1, 7, 8, 12345) for n in (0, 1, 2, 7, 8, 100)]
    ranges += [(a, a + rnd.randrange(3000)) for a in (rnd.randrange(-5000, 5000) for _ in range(40))]
    df = spark.createDataFrame(ranges, "a long, b long").withColumn("cells", joins.dyadic_cells(F.col("a"), F.col("b")))
    for r in df.collect():
        held = [x for c in r.cells for x in range(c.cell << c.width, (c.cell + 1) << c.width)]
        assert sorted(held) == list(range(r.a, r.b + 1))
        assert max(sum(c.width == w for c in r.cells) for w in range(20)) <= 2
    century = spark.sql("select 0L as a, 36524L as b").select(F.size(joins.dyadic_cells(F.col("a"), F.col("b"))).alias("n"))
    assert century.first().n < 30


def test_many_lookups_equal_the_chain(spark):
    rnd = random.Random(11)

    def side(n, ddl, *values):
        rows = [(rnd.randrange(300), rnd.choice([1, 1, 1, 2, 3]), *[v(i) for v in values]) for i in range(n)]
        return TimeSeries(spark.createDataFrame(rows, f"t long, k int, {ddl}"), "t", ["k"])

    some = lambda p: lambda i: rnd.choice([None, f"{p}{i}"])
    left = side(120, "id int, a string, z string", lambda i: i, some("l"), some("z"))
    sides = [side(60, "a string, b string", some("p"), some("q")), side(60, "a string, c string", some("r"), some("s")),
             side(40, "b string, c string", some("u"), some("v"))]
    limits = [(UNBOUNDED, 1), (UNBOUNDED, UNBOUNDED), (0, 1)]
    for width in (0, 17):
        chain = left
        for right, (back, ahead) in zip(sides, limits):
            options = {"look_back": back, "look_ahead": ahead, "slice_width": width, "left_order": ["id"]}
            chain = TimeSeries(materialize(asof_lookup(chain, right, **options)), "t", ["k"])
        lookups = [Lookup(r, None, *x) for r, x in zip(sides, limits)]
        got = asof_lookups(left, lookups, slice_width=width, left_order=["id"])
        columns = ["id", "t", "k", "a", "b", "c", "z"]
        assert set(got) == {"t"} and set(got["t"].columns) == set(columns)
        want = sorted(map(str, chain.df.select(columns).collect()))
        assert sorted(map(str, got["t"].select(columns).collect())) == want


def test_lookups_at_two_times_in_one_scan(spark):
    rnd = random.Random(12)
    rows = [(i, rnd.choice([1, 2]), (s := rnd.randrange(200)), s + rnd.randrange(60)) for i in range(80)]
    left = spark.createDataFrame(rows, "id int, k int, s long, e long")
    states = [(rnd.choice([1, 2]), t, t + rnd.randrange(30), f"x{t}") for t in rnd.sample(range(250), 60)]
    states = spark.createDataFrame(states, "k int, f long, u long, v string")
    begin = TimeSeries(states.select("k", "f", F.col("v").alias("v")), "f", ["k"])
    end = TimeSeries(states.select("k", "u", F.struct("v", "f").alias("w")), "u", ["k"])
    stores = []
    got = asof_lookups(
        TimeSeries(left, "s", ["k"]), [Lookup(begin, look_ahead=1), Lookup(end, "e", 0, UNBOUNDED, ("w.f",))],
        slice_width=13, left_order=["id"], store=lambda df: stores.append(1) or materialize(df),
    )
    first = asof_lookup(TimeSeries(left, "s", ["k"]), begin, look_ahead=1, slice_width=13, left_order=["id"])
    last = asof_lookup(TimeSeries(left, "e", ["k"]), end, look_back=0, look_ahead=UNBOUNDED, slice_width=13, left_order=["id"], tie_break=["w.f"])
    for at, want, cols in (("s", first, ["id", "s", "e", "v"]), ("e", last, ["id", "s", "e", "w"])):
        assert sorted(map(str, got[at].select(cols).collect())) == sorted(map(str, want.select(cols).collect()))
    assert stores == [1]
    with pytest.raises(ValueError):
        asof_lookups(TimeSeries(left, "s", ["k"]), [Lookup(begin, look_back=3)])


def test_contained_join_equals_brute_force(spark):
    rnd = random.Random(9)
    runs = [(rnd.choice("xy"), i, s, s + rnd.randrange(0, 60)) for i, s in enumerate(rnd.randrange(0, 300) for _ in range(60))]
    states = [(rnd.choice("xy"), i, s, s + rnd.choice([0, 3, 13, 14, 30, 58])) for i, s in enumerate(rnd.randrange(0, 300) for _ in range(60))]
    want = {(r[1], s[1]) for r in runs for s in states if r[0] == s[0] and s[2] > r[2] and s[3] < r[3]}
    a = spark.createDataFrame(runs, "k string, run int, rs long, re long")
    b = spark.createDataFrame(states, "k string, st int, ss long, se long")
    out = joins.contained_join(a, b, ["k"], ("rs", "re"), ("ss", "se"), 13).collect()
    assert len(out) == len(want) and {(r["run"], r["st"]) for r in out} == want


def test_prefix_and_salted_join(spark):
    paths = spark.createDataFrame([("/mnt/a/x",), ("/mnt/a/x",), ("/mnt/ab",), ("/other",), (None,)], "p string")
    mounts = spark.createDataFrame([("/mnt/a", 1), ("/mnt/ab", 2)], "m string, n int")
    got = sorted((str(r["p"]), r["n"] or 0) for r in joins.prefix_join(paths, "p", mounts, "m").collect())
    assert got == [("/mnt/a/x", 1), ("/mnt/a/x", 1), ("/mnt/ab", 1), ("/mnt/ab", 2), ("/other", 0), ("None", 0)]
    big = spark.range(1000).withColumn("k", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5))
    small = spark.createDataFrame([(i, i * 10) for i in range(8)], "k long, v int")
    out = joins.salted_join(big, small, ["k"], 4)
    assert out.count() == 1000 and out.filter("v <> k * 10 or v is null").count() == 0


@pytest.mark.parametrize("how", ["left", "inner"])
def test_only_hot_keys_are_salted(spark, how):
    rows = [(i, "hot" if i % 3 else f"k{i % 50}", {"m": i}) for i in range(600)] + [(600 + i, None, None) for i in range(50)]
    big = spark.createDataFrame(rows, "id int, k string, extra map<string,int>")
    unique = spark.createDataFrame([("hot", 1), *[(f"k{i}", i) for i in range(0, 40)]], "k string, v int")
    want = {r[0]: {"hot": 1}.get(r[1], int(r[1][1:]) if r[1] and r[1] != "hot" and int(r[1][1:]) < 40 else None) for r in rows}
    for size in (7, 100, 10_000):
        out = joins.salted_join(big, unique, ["k"], size, how)
        got = {r.id: r.v for r in out.collect()}
        assert got == {i: v for i, v in want.items() if how == "left" or v is not None}
        assert out.count() == len(got) and set(out.columns) == {"id", "k", "extra", "v"}
