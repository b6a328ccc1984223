import numpy as np
import pytest
from gaugeworks.llm import multi_index
from gaugeworks.llm.multi_index import nearest, op7_multi_index, visit
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("seed", range(40))
def test_cells_are_visited_in_order_until_enough(seed):
    r = np.random.default_rng(seed)
    k = int(r.integers(1, 9))
    a, b, counts = r.random(k).round(1), r.random(k).round(1), r.integers(0, 4, k * k)
    wanted = int(r.integers(0, counts.sum() + 3))
    got = visit(a, b, counts, wanted)
    total = (a[:, None] + b[None, :]).ravel()
    assert len(set(got)) == len(got) and (np.diff(total[got]) >= -1e-12).all()
    assert counts[got].sum() >= wanted or set(got) == set(np.flatnonzero(counts))
    if got:
        assert set(np.flatnonzero((total < total[got[-1]] - 1e-12) & (counts > 0))) <= set(got)


def brute(rows, near):
    """rows: id -> vector; every id's nearest others."""
    ids = sorted(rows)
    x = np.array([rows[i] for i in ids], dtype=float)
    norm = np.sqrt((x * x).sum(axis=1))
    out = {}
    for k, i in enumerate(ids):
        score = (x * x[k]).sum(axis=1) / (norm * norm[k])
        order = [j for j in np.lexsort((ids, -score)) if j != k][:near]
        out[i] = [(ids[j], score[j]) for j in order]
    return out


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    return df.withColumns({c: F.lit("x") for c in ("v", "cell", "entry", "ids", "k1", "bucket", "label")})


def compare(df, asked, want, near, spark):
    got = {}
    for r in nearest(df, spark.createDataFrame([(i,) for i in asked], "vec_id long"), near, target=1.0).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert set(got) == {i for i in asked if want.get(i)}
    for q, found in got.items():
        assert sorted(found) == list(range(1, len(found) + 1))
        assert [found[k][0] for k in sorted(found)] == [i for i, _ in want[q]]
        assert [found[k][1] for k in sorted(found)] == pytest.approx([s for _, s in want[q]], abs=1e-12)


def test_awkward_vectors(spark):
    rng = np.random.default_rng(2)
    good = {i: rng.normal(size=6).astype(np.float32).tolist() for i in range(60)}
    good |= {i: [1.0, 2.0, 3.0, 4.0, 5.0, 6.0] for i in range(100, 140)}  # one very common vector
    good |= {200: [2.0, 4.0, 6.0, 8.0, 10.0, 12.0], 201: [1e-20] * 6, 202: [1e18] * 6}
    bad = [(300, None), (301, []), (302, [0.0] * 6), (303, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (304, [float("nan")] * 6),
           (305, [float("inf")] + [1.0] * 5), (306, [1.0, 2.0]), (None, [1.0] * 6)]
    rows = list(good.items()) + bad + [(5, good[5]), (5, good[5])]
    asked = [0, 5, 50, 100, 120, 139, 201, 300, 302, 306, 999]
    compare(frame(spark, rows), asked, brute(good, 5), 5, spark)


def brute_rows(rows, near):
    """rows: distinct (id, vector); the answers of each row among all others of its dimension."""
    out = {}
    for i, v in rows:
        found = []
        for j, w in rows:
            if (i, v) != (j, w) and len(v) == len(w):
                x, y = np.array(v, dtype=np.float32).astype(float), np.array(w, dtype=np.float32).astype(float)
                found.append((-float(x @ y / np.sqrt((x @ x) * (y @ y))), j))
        out.setdefault(i, []).append([(j, round(-s, 9)) for s, j in sorted((round(s, 12), j) for s, j in found)[:near]])
    return out


def test_ids_with_several_vectors_and_dimensions(spark):
    rng = np.random.default_rng(8)
    rows = [(int(rng.integers(0, 25)), tuple(rng.integers(-3, 4, d).tolist())) for d in (4, 4, 4, 7) for _ in range(30)]
    # the case of the review: an id with a far vector and one close to the query's
    rows += [(50, (9.0, 9.0, 9.0, 9.5)), (1, (9.0, 9.0, 9.0, 9.0)), (1, (-9.0, 9.0, -9.0, 1.0)), (60, (1.0, 1.0))]
    rows = list(dict.fromkeys((i, tuple(map(float, v))) for i, v in rows if any(v)))
    df = frame(spark, [(i, list(v)) for i, v in rows * 2])
    asked = [0, 5, 10, 15, 20, 50, 60]
    got = {}
    for r in nearest(df, spark.createDataFrame([(i,) for i in asked], "vec_id long"), 5, target=1.0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, round(r.score, 9)))
    want = brute_rows(rows, 5)
    assert got[50][0][1] == 1 and 60 not in got
    for i in asked[:-1]:
        flat = [(k, j, s) for answer in want.get(i, []) for k, (j, s) in enumerate(answer, 1)]
        assert sorted(k for k, _, _ in got.get(i, [])) == sorted(k for k, _, _ in flat)
        assert sorted(s for _, _, s in got.get(i, [])) == pytest.approx(sorted(s for _, _, s in flat), abs=1e-8)
        if len(want.get(i, [])) == 1:
            scores = [s for _, _, s in flat]
            sure = {j for _, j, s in flat if scores.count(s) == 1}
            assert sure <= {j for _, j, _ in got[i]}


def test_index_goes_only_where_it_is_visited(spark, monkeypatch):
    """On clustered vectors a bucket of the index meets few of the query blocks."""
    monkeypatch.setattr(multi_index, "BUCKET_ROWS", 64)
    monkeypatch.setattr(multi_index, "QUERY_BLOCK", 40)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(16, 8)) * 10
    rows = {i: (centres[i % 16] + rng.normal(size=8) * 0.01).astype(np.float32).tolist() for i in range(1600)}
    seen = []
    real = multi_index.materialize
    monkeypatch.setattr(multi_index, "materialize", lambda df, name: seen.append((name, out := real(df, name))) or out)
    asked = list(range(0, 1600, 2))
    got = nearest(frame(spark, list(rows.items())), spark.createDataFrame([(i,) for i in asked], "vec_id long"), 5).collect()
    assert len(got) == 5 * len(asked) and all(i.vec_id % 16 == i.query_id % 16 for i in got)
    visits = dict(seen)["visits"]
    buckets = visits.select("bucket").distinct().count()
    blocks = visits.select("home").distinct().count()
    assert buckets > 12 and visits.select("bucket", "home").distinct().count() < buckets * blocks / 3


def test_slices_and_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "BUCKET_ROWS", 16)
    monkeypatch.setattr(multi_index, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(3)
    rows = {i: rng.normal(size=8).astype(np.float32).tolist() for i in range(120)}
    compare(frame(spark, list(rows.items())), list(range(0, 120, 3)), brute(rows, 4), 4, spark)


def test_few_and_no_rows(spark):
    two = {1: [1.0, 0.0], 2: [1.0, 1.0]}
    compare(frame(spark, list(two.items())), [1, 2], brute(two, 5), 5, spark)
    none = frame(spark, [(1, None)])
    assert nearest(none, spark.createDataFrame([(1,)], "vec_id long")).count() == 0
    assert nearest(none.filter("vec_id < 0"), spark.createDataFrame([], "vec_id long")).count() == 0


def test_recall_on_the_table(spark):
    rows = {r.vec_id: r.embedding for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()}
    want = brute(rows, 5)
    got = op7_multi_index(spark, FOLDER).collect()
    hits = sum(r.vec_id in {i for i, _ in want[r.query_id]} for r in got)
    assert {r.query_id for r in got} == {i for i in rows if i % 50 == 0}
    assert hits / len(got) >= 0.9
