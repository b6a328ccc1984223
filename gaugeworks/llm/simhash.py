"""Near duplicates by SimHash, found through anchor points of a covering code.

The 64 bits are cut into pieces. Of two fingerprints at most `threshold` bits
apart, some piece is at most threshold // pieces bits apart. Each piece has a
covering code: a Hamming code on its first 2**m - 1 bits, and all values of the
rest, so every value is at most one bit from an anchor. A fingerprint is at home
at its nearest anchor and visits every anchor within the covering radius plus the
piece's threshold. A close pair therefore meets at the home of either one, and
only homes are compared with visitors, per anchor.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm.common import query, small_batches, table, text_key
from gaugeworks.llm.components import component_roots
from gaugeworks.operators.dedup import row_hash
from gaugeworks.session import materialize

BITS = 64
THRESHOLD = 4
PIECES = 3
SHINGLE = 4
SEED = 42
RADIUS = 1
# Homes or visitors of one anchor in one comparison; more are cut into slices.
SLICE_ROWS = 4096
# Rows of one compared bucket of anchors, about.
BUCKET_ROWS = 150_000
# Pairs held at once inside a comparison.
PAIRS_AT_ONCE = 1 << 21


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles, as a signed 64-bit number; 0 without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > shingle:
        spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], SEED) for s, e in spans]
    else:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    h = np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8)
    ones = np.zeros(BITS, dtype=np.int64)
    for part in range(0, len(h), 1 << 14):
        ones += np.unpackbits(h[part : part + (1 << 14)], axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h)).view(">i8")[0])


@F.pandas_udf(T.LongType())
def _fingerprint(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def covering(pieces: int, threshold: int) -> list[tuple[int, int, int, list[np.ndarray]]]:
    """For each piece: its lowest bit, its width, its code length, and by syndrome the bit
    masks that lead from a value to all anchors within the radius plus the piece's threshold.

    The first mask of a syndrome leads to the nearest anchor, the home.
    """
    out, low = [], 0
    for p in range(pieces):
        width = (BITS - low) // (pieces - p)
        code = 2 ** ((width + 1).bit_length() - 1) - 1
        masks: dict[int, list[int]] = {s: [] for s in range(code + 1)}
        for weight in range(RADIUS + threshold // pieces + 1):
            # flips inside the code come first, so that the home is the first mask
            for flips in combinations(range(width), weight):
                syndrome = 0
                for i in flips:
                    syndrome ^= i + 1 if i < code else 0
                masks[syndrome].append(sum(1 << i for i in flips))
        out.append((low, width, code, [np.array(masks[s], dtype=np.uint64) for s in range(code + 1)]))
        low += width
    return out


def _syndromes(values: np.ndarray, code: int) -> np.ndarray:
    s = np.zeros(len(values), dtype=np.int64)
    for i in range(code):
        s ^= np.where((values >> np.uint64(i)) & np.uint64(1), i + 1, 0)
    return s


def _at_anchors(pieces: int, threshold: int):
    """Rows (cell, fp, home): a fingerprint as a guest of each of its anchors, the home too,
    and once more as the one that is at home. A cell is a piece and an anchor of it.
    """

    codes = covering(pieces, threshold)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = batch["fp"].to_numpy(np.int64).view(np.uint64)
            for p, (low, width, code, masks) in enumerate(codes):
                values = (fps >> np.uint64(low)) & np.uint64((1 << width) - 1)
                syndromes = _syndromes(values, code)
                for s in np.unique(syndromes):
                    mine = syndromes == s
                    anchors = (values[mine][:, None] ^ masks[s][None, :]) | np.uint64(p << 40)
                    visits, n = np.hstack([anchors, anchors[:, :1]]), anchors.shape[1] + 1
                    yield pd.DataFrame(
                        {
                            "cell": visits.ravel().view(np.int64),
                            "fp": np.repeat(fps[mine], n).view(np.int64),
                            "home": np.tile(np.arange(n) == n - 1, len(visits)),
                        }
                    )

    return place


def _find(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def _union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge the sets of a[i] and b[i]; the least member is the root."""
    while True:
        parent = _find(parent)
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            return parent
        a, b = ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def _compare(threshold: int):
    """Links of a bucket of anchors, cut down to one link from each member to its set's least."""

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        nodes, index = np.unique(rows["fp"].to_numpy(np.int64), return_inverse=True)
        bits = nodes.view(np.uint64)
        home = rows["home"].to_numpy(bool)
        cells = rows["part"].to_numpy(np.int64)
        order = np.argsort(cells[home], kind="stable")
        at_home, home_cell = index[home][order], cells[home][order]
        guest, guest_cell = index[~home], cells[~home]
        first = np.searchsorted(home_cell, guest_cell, "left")
        many = np.searchsorted(home_cell, guest_cell, "right") - first
        met = many > 0
        guest, first, many = guest[met], first[met], many[met]
        parent = np.arange(len(nodes))
        done = np.concatenate(([0], np.cumsum(many)))
        start = 0
        while start < len(guest):
            stop = max(start + 1, int(np.searchsorted(done, done[start] + PAIRS_AT_ONCE, "right")) - 1)
            n = many[start:stop]
            a = np.repeat(guest[start:stop], n)
            step = np.arange(n.sum()) - np.repeat(done[start:stop] - done[start], n)
            b = at_home[np.repeat(first[start:stop], n) + step]
            near = np.bitwise_count(bits[a] ^ bits[b]) <= threshold
            near &= a != b
            parent = _union(parent, a[near], b[near])
            start = stop
        linked = parent != np.arange(len(nodes))
        return pd.DataFrame({"a": nodes[linked], "b": nodes[parent[linked]]})

    return compare


def near_links(fps: DataFrame, threshold: int = THRESHOLD, pieces: int = PIECES) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints `fp` at most `threshold` bits apart.

    Per bucket the links found are cut down to a star around the least member of
    each connected set, so a large group of near copies gives one link a member
    and bucket and not all its pairs; no connection is lost. An anchor with many
    homes or visitors is cut into slices that are compared pair by pair of slices,
    so no task holds all of it.
    """
    spark = fps.sparkSession
    small_batches(spark, 4096)
    at = materialize(fps.mapInPandas(_at_anchors(pieces, threshold), "cell long, fp long, home boolean"), "anchors")
    crowd = at.groupBy("cell").agg(
        F.ceil(F.count_if("home") / SLICE_ROWS).cast("int").alias("home_slices"),
        F.ceil(F.count_if(~F.col("home")) / (8 * SLICE_ROWS)).cast("int").alias("guest_slices"),
    )
    hot = crowd.filter("home_slices > 1 or (home_slices = 1 and guest_slices > 1)")
    one = F.coalesce("home_slices", F.lit(1)), F.coalesce("guest_slices", F.lit(1))
    own = F.pmod(F.xxhash64("fp"), F.when(F.col("home"), one[0]).otherwise(one[1]))
    others = F.sequence(F.lit(0), F.when(F.col("home"), one[1]).otherwise(one[0]) - 1)
    sliced = (
        at.join(hot, "cell", "left")
        .select("cell", "fp", "home", own.alias("own"), F.explode(others).alias("other"))
        .withColumn(
            "part",
            F.when(F.col("home"), F.xxhash64("cell", "own", "other")).otherwise(
                F.xxhash64("cell", F.col("other").cast("long"), F.col("own").cast("int"))
            ),
        )
    )
    buckets = max(64, at.count() // BUCKET_ROWS)
    return (
        sliced.select(F.pmod("part", F.lit(buckets)).alias("bucket"), "part", "fp", "home")
        .groupBy("bucket")
        .applyInPandas(_compare(threshold), "a long, b long")
    )


def near_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: int = THRESHOLD,
    pieces: int = PIECES,
) -> DataFrame:
    """One row per document: doc_id, k1, k2 (hashes of the text), fp, root, component_id.

    The component is the smallest id reachable over links of at most `threshold`
    bits, the document itself included. `root` is the component's least fingerprint,
    which tells components apart even where ids repeat. Null and empty texts have no words and the
    fingerprint zero, and are linked like any other; equal texts have equal
    fingerprints; repeated rows stay. A null id counts for nothing in the minimum:
    a component of null ids only has a null component_id. An empty table gives no
    rows. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    k1, k2 = text_key(F.col(text_col))
    marked = docs.select(
        F.col(id_col).alias("doc_id"), k1.alias("k1"), k2.alias("k2"), _fingerprint(text_col).alias("fp")
    )
    marked = materialize(marked, "fingerprints")
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    roots = component_roots(near_links(marked.select("fp").distinct(), threshold, pieces))
    rooted = least.join(roots, F.col("fp") == F.col("node"), "left")
    rooted = rooted.select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    firsts = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = rooted.join(firsts, "root").select("fp", "root", "component_id")
    return marked.join(named, "fp").select("doc_id", "k1", "k2", "fp", "root", "component_id")


def keep_one_per_group(docs: DataFrame, threshold: int = THRESHOLD, pieces: int = PIECES) -> DataFrame:
    """The columns of `docs`, for one document of each group of near copies, see `keep_first`."""
    return keep_first(docs, materialize(near_groups(docs, threshold=threshold, pieces=pieces), "groups"))


def keep_first(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The columns of `docs`, for one document of each `root` of `groups` (doc_id, k1, k2, root).

    The one with the smallest id stays; of several with that id the one of the
    smallest text hash; of rows equal in both a single one. Ids that are null come
    after all others.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2")).alias("first")
    kept = groups.groupBy("root").agg(first).select("first.*")
    kept = kept.select(F.col("doc_id").alias("kept_id"), "k1", "k2")
    k1, k2 = text_key(F.col("text"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(whole, k1.alias("k1"), k2.alias("k2"), row_hash(docs).alias("tie"))
    same = (rows.k1 == kept.k1) & (rows.k2 == kept.k2) & rows["row.doc_id"].eqNullSafe(kept.kept_id)
    stay = rows.join(kept, same, "left_semi").withColumn("id", F.col("row.doc_id"))
    order = ["tie", *[F.col(f"row.`{f.name}`") for f in docs.schema.fields if f.name in ("lang", "source")]]
    alone = Window.partitionBy("k1", "k2", "id").orderBy(*order)
    return stay.withColumn("nth", F.row_number().over(alone)).filter("nth = 1").select("row.*")


@query("op8_simhash_groups")
def op8_simhash_groups(spark, folder):
    """Fingerprint and component of every document."""
    groups = near_groups(table(spark, folder, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
