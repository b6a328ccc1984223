"""Document quality from statistics of the whole text, scored by boosted trees."""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm.boosting import Forest, fit
from gaugeworks.llm.common import query, small_batches, table

# Bound of the labelled rows that the trees are fitted on (a documented parameter).
MAX_TRAIN_ROWS = 20_000
THRESHOLD = 0.7
# Bytes of a window; a text's worst window counts besides its average.
WINDOW = 256

_LOWER, _UPPER, _DIGIT, _BLANK, _LINE_END, _PUNCT, _CALL, _SYMBOL, _WIDE, _OTHER = range(10)
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
_CLASS[128:] = _WIDE
for _chars, _kind in (
    (b"abcdefghijklmnopqrstuvwxyz", _LOWER),
    (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", _UPPER),
    (b"0123456789", _DIGIT),
    (b" \t\r\x0b\x0c", _BLANK),
    (b"\n", _LINE_END),
    (b".,;:?'\"-()", _PUNCT),
    (b"!", _CALL),
    (b"#*$%&|<>{}[]\\/=+@^~_`", _SYMBOL),
):
    _CLASS[list(_chars)] = _kind

FEATURES = (
    "bytes words lines word_bytes distinct_words repeats lower upper digits blanks punct calls symbols wide other "
    "line_bytes distinct_lines shortest_line longest_word top_upper top_symbols top_calls top_digits low_letters"
).split()


def statistics(text: str | None) -> list[float]:
    """The FEATURES of a whole text; a null is like an empty text."""
    raw = (text or "").encode("utf-8", "replace")
    size = max(1, len(raw))
    kinds = _CLASS[np.frombuffer(raw, dtype=np.uint8)]
    share = np.bincount(kinds, minlength=10) / size
    words, lines = raw.split(), raw.split(b"\n")
    n = max(1, len(words))
    starts = np.arange(0, max(1, len(raw) - WINDOW // 2), WINDOW)
    spans = np.diff(np.append(starts, len(raw)))
    tops = [0.0] * 5
    if len(raw):
        by_kind = [np.add.reduceat(kinds == k, starts, dtype=np.int64) / spans for k in (_UPPER, _SYMBOL, _CALL, _DIGIT)]
        letters = np.add.reduceat((kinds == _LOWER) | (kinds == _WIDE), starts, dtype=np.int64) / spans
        tops = [*(float(v.max()) for v in by_kind), float(letters.min())]
    return [
        np.log1p(len(raw)),
        np.log1p(len(words)),
        np.log1p(len(lines)),
        sum(map(len, words)) / n,
        len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n,
        share[_LOWER],
        share[_UPPER],
        share[_DIGIT],
        share[_BLANK],
        share[_PUNCT],
        share[_CALL],
        share[_SYMBOL],
        share[_WIDE],
        share[_OTHER],
        np.log1p(len(raw) / len(lines)),
        len(set(lines)) / len(lines),
        np.log1p(min(map(len, lines))),
        np.log1p(max(map(len, words), default=0)),
        *tops,
    ]


def held_out(doc_id: Column) -> Column:
    """Documents that no label may be learned from: crc32 of the id's text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _statistics(texts: pd.Series) -> pd.Series:
    return pd.Series([statistics(t) for t in texts])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> Forest:
    """Fit the trees on at most `max_rows` labelled documents that are not held out.

    The rows are those of the smallest id hashes. Only their ids are sent out and
    only their statistics come back, so the driver's share has a fixed bound. Null
    labels do not count; of conflicting labels the larger, of documents with one
    id the one of the smallest text hash.
    """
    small_batches(docs.sparkSession)
    known = labels.filter(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    found = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows = found.select("doc_id", "quality", F.xxhash64("text").alias("h"), _statistics("text").alias("x"))
    rows = rows.groupBy("doc_id").agg(F.max("quality").alias("y"), F.min_by("x", "h").alias("x"))
    got = sorted(rows.collect(), key=lambda r: r.doc_id)
    x = np.array([r.x for r in got], dtype=float).reshape(len(got), len(FEATURES))
    return fit(x, np.array([r.y for r in got], dtype=float))


def scorer(forest: Forest):
    """A column function: the score of each whole text."""

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            x = np.array([statistics(t) for t in texts], dtype=float).reshape(len(texts), len(FEATURES))
            yield pd.Series(forest.score(x))

    return score


def score_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> DataFrame:
    """Every row of `docs` in the struct `row`, with `score` (0 to 1) and `predicted`.

    The trees see statistics of the whole text only, never labels, ids, languages
    or sources. A null text scores as an empty one; equal texts score alike;
    repeated rows stay. Without labels of both kinds the score is the smoothed
    base rate (0.9 with none), so nothing is rejected for lack of labels. An empty
    table gives no rows.
    """
    score = scorer(train(docs, labels, max_rows))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    scored = rows.select("row", score(F.col("row.text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with their columns."""
    return score_quality(docs, labels).filter("predicted = 1").select("row.*")


@query("op5_quality_classifier")
def op5_quality_classifier(spark, folder):
    """Score and prediction of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = score_quality(docs, table(spark, folder, "labels"))
    return scored.select(
        F.col("row.doc_id").alias("doc_id"), held_out(F.col("row.doc_id")).alias("held_out"), "score", "predicted"
    )
