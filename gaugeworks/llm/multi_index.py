"""Nearest neighbours by cosine through an inverted multi-index.

Vectors are normalised and their two halves quantised separately; a cell is a pair
of centroids. A query visits cells in the order of summed half distances, drawn
from a heap, until they hold a given share of all vectors, and the vectors of the
visited cells are reranked by their exact cosine. The share is calibrated on the
sample so that the wanted recall is met.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import query, small_batches, table
from gaugeworks.session import materialize

# Documented bounds: vectors that the codebooks are fitted on, and of these the
# ones whose neighbours calibrate the visited share.
SAMPLE_ROWS = 10_000
CALIBRATION_QUERIES = 200
TARGET_RECALL = 0.95
CELL_ROWS = 50
MAX_CENTROIDS = 512
# Rows of the index, and queries, that meet in one task at a time.
BUCKET_ROWS = 16_384
QUERY_BLOCK = 8_192
QUERIES_AT_ONCE = 256


@dataclass(frozen=True)
class Codebook:
    """Centroids of both halves; `share` of all vectors is what a query visits."""

    left: np.ndarray
    right: np.ndarray
    share: float

    @property
    def centroids(self) -> int:
        return len(self.left)

    def distances(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = unit.shape[1] // 2
        return _distances(unit[:, :half], self.left), _distances(unit[:, half:], self.right)

    def cells(self, unit: np.ndarray) -> np.ndarray:
        a, b = self.distances(unit)
        return a.argmin(axis=1) * self.centroids + b.argmin(axis=1)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of each row to each centre."""
    return (x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def k_means(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids from evenly spaced first ones; an empty cluster restarts at the worst-placed row."""
    centres = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        d = _distances(x, centres)
        own = d.argmin(axis=1)
        n = np.bincount(own, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
        empty = np.flatnonzero(n == 0)
        centres[empty] = x[np.argsort(-d.min(axis=1), kind="stable")[: len(empty)]]
    return centres


def visit(a: np.ndarray, b: np.ndarray, counts: np.ndarray, wanted: int) -> list[int]:
    """Cells in the order of a[i] + b[j], until their counts reach `wanted`.

    A pair of ranks enters the heap when both its lower neighbours have left it.
    """
    left, right, k = np.argsort(a, kind="stable"), np.argsort(b, kind="stable"), len(b)
    heap = [(a[left[0]] + b[right[0]], 0, 0)]
    row_done = [0] * len(a)  # of each left rank, how many right ranks have left the heap
    cells, got = [], 0
    while heap and got < wanted:
        _, i, j = heappop(heap)
        row_done[i] = j + 1
        cell = int(left[i]) * k + int(right[j])
        if counts[cell]:
            cells.append(cell)
            got += int(counts[cell])
        if i + 1 < len(a) and row_done[i + 1] == j:
            heappush(heap, (a[left[i + 1]] + b[right[j]], i + 1, j))
        if j + 1 < k and (i == 0 or row_done[i - 1] > j + 1):
            heappush(heap, (a[left[i]] + b[right[j + 1]], i, j + 1))
    return cells


def train(sample: np.ndarray, n_vectors: int, near: int, target: float = TARGET_RECALL) -> Codebook:
    """Fit the centroids, and find the share of the vectors to visit for the wanted recall.

    The number of centroids follows from the number of vectors. A share found on
    the sample is on the safe side for more vectors, whose neighbours are nearer.
    """
    unit = _unit(sample)
    half = unit.shape[1] // 2
    k = int(max(1, min(np.sqrt(n_vectors / CELL_ROWS), MAX_CENTROIDS, len(unit))))
    book = Codebook(k_means(unit[:, :half], k), k_means(unit[:, half:], k), 1.0)
    cells = book.cells(unit)
    counts = np.bincount(cells, minlength=k * k)
    asked = np.linspace(0, len(unit) - 1, min(len(unit), CALIBRATION_QUERIES)).astype(int)
    left, right = book.distances(unit[asked])
    shares = []
    for q, a, b in zip(asked, left, right):
        score = unit @ unit[q]
        score[q] = -np.inf
        best = np.argsort(-score, kind="stable")[: min(near, len(unit) - 1)]
        total = (a[:, None] + b[None, :]).ravel()
        order = np.argsort(total, kind="stable")
        reached = np.empty(k * k)
        reached[order] = np.cumsum(counts[order])
        shares.extend(reached[cells[best]] / len(unit))
    share = float(np.quantile(shares, target, method="higher")) if shares else 1.0
    return Codebook(book.left, book.right, share)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v array<double>) of the vectors that take part, each once.

    Left out: null ids, null or zero vectors, and vectors with a null or non-finite
    component. An id may have several vectors; equal rows are one.
    """
    bad = F.exists(
        F.col(vec_col), lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf"))
    )
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.when(~bad, F.col(vec_col).cast("array<double>")).alias("v"))
    return rows.filter(F.col("vec_id").isNotNull() & F.exists("v", lambda x: x != 0)).distinct()


def _row_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    for batch in batches:
        if len(batch):
            yield batch, np.stack(batch["v"].to_list())


def nearest(
    vectors: DataFrame,
    asked: DataFrame,
    near: int = 5,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    target: float = TARGET_RECALL,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """For each id in `asked` (column vec_id) its nearest rows: query_id, rank, vec_id, score.

    The score is the cosine of the original vectors in double precision, ties go to
    the smaller id, and a row is never its own neighbour. Every usable row (see
    `usable`) is indexed, also several vectors of one id: each is a candidate, and
    each vector of an id in `asked` has its own answer under that id. Vectors of different
    dimensions have no cosine; each dimension has an index of its own. Equal vectors are one
    entry with its near + 1 smallest ids,
    which is all that a result can hold of them, so a vector that very many rows
    have costs no more than another. With fewer candidates than `near` all are
    returned; no vectors or no queries give no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = materialize(usable(vectors, id_col, vec_col).withColumn("dim", F.size("v")), "vectors")
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for (dim,) in rows.select("dim").distinct().orderBy("dim").collect():
        out = out.unionByName(_nearest(rows.filter(F.col("dim") == dim).drop("dim"), asked, near, target, sample_rows))
    return out


def _nearest(rows: DataFrame, asked: DataFrame, near: int, target: float, sample_rows: int) -> DataFrame:
    """The answers among stored rows (vec_id, v) of one dimension."""
    spark = rows.sparkSession
    keys = [F.xxhash64("v").alias("k1"), F.xxhash64(F.lit("second"), "v").alias("k2")]
    keyed = rows.select("vec_id", "v", *keys)
    first = Window.partitionBy("k1", "k2").orderBy("vec_id")
    few = keyed.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= near + 1)
    entries = few.groupBy("k1", "k2").agg(
        F.min("vec_id").alias("low"), F.sort_array(F.collect_list("vec_id")).alias("ids"), F.min_by("v", "nth").alias("v")
    )
    # numbers of the entries, fixed by writing them
    entries = materialize(entries.withColumn("entry", F.monotonically_increasing_id()), "entries")
    total = entries.count()
    sample = entries.orderBy(F.xxhash64("v"), "low").limit(sample_rows).select("v").collect()
    book = train(np.array([r.v for r in sample], dtype=float), total, near + 1, target)
    k = book.centroids

    small_batches(spark, 2_000)

    def to_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, v in _row_blocks(batches):
            yield batch.assign(cell=book.cells(_unit(v)))

    indexed = entries.select("entry", "low", "ids", "v").mapInPandas(
        to_cells, "entry long, low long, ids array<long>, v array<double>, cell long"
    )
    indexed = materialize(indexed, "cells")
    counts = np.zeros(k * k, dtype=np.int64)
    for r in indexed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r.cell] = r.n
    # Cells are cut into slices of bounded size, and slices gathered to buckets.
    slices = np.maximum(1, -(-counts // BUCKET_ROWS))
    first_slice = np.concatenate(([0], np.cumsum(slices)))
    size = np.repeat(counts / slices, slices)
    bucket_of = ((np.cumsum(size) - size) // BUCKET_ROWS).astype(np.int64)
    wanted = max(int(np.ceil(book.share * total)), near + 1)

    queries = keyed.join(asked.select("vec_id").distinct(), "vec_id").select("vec_id", "k1", "k2")
    queries = materialize(queries.withColumnRenamed("vec_id", "query_id"), "queries")
    distinct = queries.select("k1", "k2").distinct().join(entries.select("k1", "k2", "entry", "v"), ["k1", "k2"])

    def to_buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, v in _row_blocks(batches):
            out = []
            left, right = book.distances(_unit(v))
            for entry, vector, a, b in zip(batch["entry"], batch["v"], left, right):
                parts = np.concatenate([np.arange(first_slice[c], first_slice[c + 1]) for c in visit(a, b, counts, wanted)])
                where = bucket_of[parts]
                order = np.argsort(where, kind="stable")
                cuts = np.flatnonzero(np.diff(where[order])) + 1
                for some in np.split(parts[order], cuts):
                    out.append((int(bucket_of[some[0]]), int(where[0]), entry, vector, some))
            yield pd.DataFrame(out, columns=["bucket", "home", "entry", "v", "parts"])

    def to_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cell, entry = batch["cell"].to_numpy(), batch["entry"].to_numpy()
            part = first_slice[cell] + entry % slices[cell]
            yield batch.assign(part=part, bucket=bucket_of[part])[["bucket", "part", "entry", "low", "v"]]

    def rerank(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({c: np.array([], int) for c in ("query", "entry", "low")} | {"score": np.array([], float)})
        if not len(asked) or not len(rows):
            return out
        rows = rows.sort_values(["part", "low", "entry"])
        x, q = np.stack(rows["v"].to_list()), np.stack(asked["v"].to_list())
        x_norm, q_norm = np.sqrt((x * x).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
        x_unit, q_unit = x / x_norm[:, None], q / q_norm[:, None]
        part, entry, low = (rows[c].to_numpy() for c in ("part", "entry", "low"))
        names, begins = np.unique(part, return_index=True)
        ends = np.append(begins[1:], len(part))
        found = []
        for start in range(0, len(q), QUERIES_AT_ONCE):
            some = range(start, min(start + QUERIES_AT_ONCE, len(q)))
            visited = np.zeros((len(some), len(names)), dtype=bool)
            for r, i in enumerate(some):
                parts = asked["parts"].iat[i]
                at = np.searchsorted(names, parts)
                ok = at < len(names)
                at = at[ok]
                visited[r, at[names[at] == np.asarray(parts)[ok]]] = True
            score = np.full((len(some), len(part)), -np.inf)
            for c in range(len(names)):
                who = np.flatnonzero(visited[:, c])
                if len(who):
                    score[who, begins[c] : ends[c]] = q_unit[start + who] @ x_unit[begins[c] : ends[c]].T
            keep = min(near + 1, len(part))
            limit = -np.partition(-score, keep - 1, axis=1)[:, keep - 1] - 1e-9
            for r, i in enumerate(some):
                hit = np.flatnonzero((score[r] >= limit[r]) & (score[r] > -np.inf))
                exact = (x[hit] * q[i]).sum(axis=1) / (x_norm[hit] * q_norm[i])
                best = np.lexsort((entry[hit], low[hit], -exact))[:keep]
                kept = {"entry": entry[hit][best], "low": low[hit][best], "score": exact[best]}
                found.append(pd.DataFrame({"query": asked["entry"].iat[i]} | kept))
        return pd.concat(found, ignore_index=True)

    sent = distinct.select("entry", "v").mapInPandas(
        to_buckets, "bucket long, home long, entry long, v array<double>, parts array<long>"
    )
    sent = materialize(sent, "visits")
    # queries whose nearest cells lie together are one block, so that a bucket of the index
    # goes only to the blocks that visit it; the counts are a number for each bucket
    homes = sent.filter("bucket = home").groupBy("home").agg(F.count(F.lit(1)).alias("n")).orderBy("home").toPandas()
    pieces = np.maximum(1, -(-homes["n"].to_numpy(np.int64) // QUERY_BLOCK))
    size = np.repeat(homes["n"].to_numpy(np.int64) / pieces, pieces)
    block_of = ((np.cumsum(size) - size) // QUERY_BLOCK).astype(np.int64)
    first_piece = dict(zip(homes["home"].tolist(), (np.cumsum(pieces) - pieces).tolist()))
    many = dict(zip(homes["home"].tolist(), pieces.tolist()))

    def to_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            piece = [first_piece[h] + e % many[h] for h, e in zip(batch["home"], batch["entry"])]
            yield batch.assign(block=block_of[np.array(piece, dtype=np.int64)]).drop(columns="home")

    sent = sent.mapInPandas(to_blocks, "bucket long, entry long, v array<double>, parts array<long>, block long")
    placed = indexed.select("entry", "low", "v", "cell").mapInPandas(
        to_parts, "bucket long, part long, entry long, low long, v array<double>"
    )
    visited = sent.groupBy(F.col("bucket").alias("to_bucket"), F.col("block").alias("to_block")).agg(F.lit(1).alias("one"))
    placed = placed.join(visited, F.col("bucket") == F.col("to_bucket")).select(
        "bucket", F.col("to_block").alias("block"), "part", "entry", "low", "v"
    )
    scored = (
        sent.groupBy("bucket", "block")
        .cogroup(placed.groupBy("bucket", "block"))
        .applyInPandas(rerank, "query long, entry long, low long, score double")
    )
    best = Window.partitionBy("query").orderBy(F.desc("score"), "low", "entry")
    top = scored.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= near + 1)
    with_ids = top.join(indexed.select("entry", "ids"), "entry").select(
        "query", "score", "entry", F.explode("ids").alias("vec_id")
    )
    pair = F.struct((-F.col("score")).alias("loss"), "vec_id", "entry")
    lists = with_ids.groupBy("query").agg(F.sort_array(F.collect_list(pair)).alias("found"))
    answers = queries.join(entries.select("k1", "k2", "entry"), ["k1", "k2"]).join(lists, F.col("entry") == F.col("query"))
    others = F.filter("found", lambda x: (x["vec_id"] != F.col("query_id")) | (x["entry"] != F.col("query")))
    listed = answers.select("query_id", F.posexplode(F.slice(others, 1, near)).alias("pos", "hit"))
    return listed.select(
        "query_id",
        (F.col("pos") + 1).cast("int").alias("rank"),
        F.col("hit.vec_id").alias("vec_id"),
        (-F.col("hit.loss")).alias("score"),
    )


@query("op7_multi_index")
def op7_multi_index(spark, folder):
    """The five nearest rows of every row whose id is divisible by 50."""
    vectors = table(spark, folder, "embeddings")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 50 == 0).select("vec_id"))
