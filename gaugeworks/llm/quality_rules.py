"""Quality rules: counts over whole texts, and content lines marked by a random field."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import query, small_batches, table
from gaugeworks.llm.crf import Chain, fit
from gaugeworks.llm.quality_classifier import held_out
from gaugeworks.llm.scan import BLANK, TextScan, byte_slices

MIN_WORDS = 20
WINDOW_WORDS = 8
MAX_REPEAT_PERCENT = 30
MIN_CONTENT_SHARE = 0.5
# Bound of the labelled documents that the field is fitted on (a documented parameter).
MAX_TRAIN_DOCS = 3_000
# Bound of the lines of such a document: of a longer one a run of so many from a place set by its id.
MAX_TRAIN_LINES = 100

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
_LOWER = np.zeros(256, dtype=bool)
_LOWER[list(b"abcdefghijklmnopqrstuvwxyz")] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[list(b"0123456789")] = True
_CONTINUED = np.zeros(256, dtype=bool)
_CONTINUED[128:192] = True

_MULTIPLIERS = np.random.default_rng(8).integers(1, 2**63, WINDOW_WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def repeated_words(scan: TextScan, window: int = WINDOW_WORDS) -> np.ndarray:
    """Words that lie in a window of words found twice or more in their text, by text."""
    ids, doc = scan.word_id, scan.word_doc
    n = len(ids) - window + 1
    covered = np.zeros(len(ids) + 1, dtype=np.int64)
    if n > 0:
        starts = np.flatnonzero(doc[:n] == doc[window - 1 :])
        key = doc[starts].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for j in range(window):
            mixed = (ids[starts + j].astype(np.uint64) + np.uint64(1)) * _MULTIPLIERS[j]
            key += mixed ^ (mixed >> np.uint64(29))
        order = np.argsort(key, kind="stable")
        ranked = starts[order]
        same = key[order][1:] == key[order][:-1]
        twice = np.flatnonzero(same)
        # equal keys are only a hint: the words and the text must be equal, too
        equal = doc[ranked[twice]] == doc[ranked[twice + 1]]
        for j in range(window):
            equal &= ids[ranked[twice] + j] == ids[ranked[twice + 1] + j]
        if equal.all():
            hit = np.unique(np.concatenate([ranked[twice], ranked[twice + 1]]))
        else:
            some = np.unique(np.concatenate([ranked[twice], ranked[twice + 1]]))
            rows = np.column_stack([doc[some], *(ids[some + j] for j in range(window))])
            _, inverse, many = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
            hit = some[many[inverse.ravel()] > 1]
        np.add.at(covered, hit, 1)
        np.add.at(covered, hit + window, -1)
    marked = np.cumsum(covered[:-1]) > 0
    return np.bincount(doc, weights=marked, minlength=scan.docs).astype(np.int64)


def duplicate_lines(scan: TextScan) -> np.ndarray:
    """Lines that equal an earlier line of their text."""
    pair = scan.line_doc * (scan.line_id.max(initial=0) + 1) + scan.line_id
    _, first = np.unique(pair, return_index=True)
    repeated = np.ones(len(pair), dtype=bool)
    repeated[first] = False
    return repeated


def base_counts(scan: TextScan) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    with_word = scan.line_word_end > scan.line_word
    return {
        "n_words": np.diff(scan.doc_word),
        "word_chars": scan.per_doc(~BLANK[scan.data] & ~_CONTINUED[scan.data]),
        "n_symbols": scan.per_doc(SYMBOLS[scan.data]),
        "n_dup_lines": np.bincount(scan.line_doc, weights=duplicate_lines(scan) & with_word, minlength=scan.docs).astype(np.int64),
        "n_repeat_words": repeated_words(scan),
    }


def line_features(scan: TextScan) -> np.ndarray:
    """Indicators of each line, for the random field."""
    data, start, end = scan.data, scan.line_start, scan.line_end
    size = np.maximum(end - start, 1)
    words = scan.line_word_end - scan.line_word

    def share(table: np.ndarray) -> np.ndarray:
        return scan.count(table[data], start, end) / size

    upper, lower, symbols, digits = share(_UPPER), share(_LOWER), share(SYMBOLS), share(_DIGIT)
    calls = scan.count(data == ord("!"), start, end) / size
    pipes = scan.count(data == ord("|"), start, end) / size
    again = np.zeros(len(scan.word_id), dtype=bool)
    again[1:] = scan.word_id[1:] == scan.word_id[:-1]
    sums = np.concatenate(([0], np.cumsum(again)))
    repeats = (sums[scan.line_word_end] - sums[scan.line_word]) / np.maximum(words, 1)
    tail = np.where(end > start, data[np.maximum(end - 1, 0)] if len(data) else 0, 0)
    closed = np.isin(tail, list(b".?!:;\"')"))
    columns = [
        np.ones(len(size)),
        words == 0,
        (words > 0) & (words <= 3),
        (words > 3) & (words <= 10),
        words > 40,
        upper > lower,
        upper > 0.2,
        symbols > 0.01,
        symbols > 0.06,
        calls > 0.02,
        pipes > 0.02,
        digits > 0.2,
        repeats > 0.1,
        repeats > 0.5,
        closed,
        duplicate_lines(scan),
    ]
    return np.column_stack([np.asarray(c, dtype=float) for c in columns])


def content_words(scan: TextScan, chain: Chain) -> np.ndarray:
    """Words in the lines that the field marks as content, by text."""
    labels = chain.viterbi(line_features(scan), scan.doc_line[1:])
    words = (scan.line_word_end - scan.line_word) * labels
    return np.bincount(scan.line_doc, weights=words, minlength=scan.docs).astype(np.int64)


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAIN_DOCS) -> Chain:
    """Fit the field on at most `max_docs` labelled documents, half of each quality where there are.

    Lines have no labels of their own: all lines of a document of quality 1 count as
    content, those of quality 0 as boilerplate. So that the field sees where one turns into
    the other, documents of both kinds are also put into each other (`spliced`). The documents
    are those of the smallest id hashes among the ones that are not held out; only they are
    fetched, as features of at most MAX_TRAIN_LINES consecutive lines.
    """
    known = labels.filter(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    halves = [known.filter(F.col("quality") == q).orderBy(*order).limit(max_docs // 2) for q in (0, 1)]
    found = docs.select("doc_id", "text").join(F.broadcast(halves[0].union(halves[1])), "doc_id")
    one = found.groupBy("doc_id", "quality").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in byte_slices(batch.column("text")):
                part = batch.slice(first, last - first)
                scan = TextScan(part.column("text"))
                x = line_features(scan).astype(np.uint8)
                cells = []
                for start, a, b in zip(part.column("start").to_pylist(), scan.doc_line, scan.doc_line[1:]):
                    a += start % max(b - a - MAX_TRAIN_LINES + 1, 1)
                    cells.append(x[a : min(b, a + MAX_TRAIN_LINES)].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("quality"), pa.array(cells, pa.binary())], ["doc_id", "quality", "x"]
                )

    one = one.withColumn("start", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)))
    rows = one.mapInArrow(features, f"doc_id {dict(docs.dtypes)['doc_id']}, quality int, x binary").collect()
    rows.sort(key=lambda r: r.doc_id)
    width = line_features(TextScan(pa.array([""]))).shape[1]
    x = [np.frombuffer(r.x, dtype=np.uint8).reshape(-1, width) for r in rows]
    if len({r.quality for r in rows}) < 2:
        return Chain(np.eye(1, width).ravel(), np.zeros((2, 2)))  # nothing to tell apart: all lines are content
    x, y = spliced(*([v for v, r in zip(x, rows) if r.quality == q] for q in (0, 1)))
    return fit(np.concatenate(x).astype(float), np.concatenate(y), np.cumsum([len(v) for v in x]))


def spliced(bad: list[np.ndarray], good: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Lines and labels of all documents, and of pairs in which a good document stands inside a bad one
    or the other way round, in turn; the place is drawn with a fixed seed.
    """
    draw = np.random.default_rng(6)
    x, y = [*bad, *good], [np.full(len(v), label) for label, docs in enumerate((bad, good)) for v in docs]
    for i, pair in enumerate(zip(bad, good)):
        inner = i % 2
        outer, put = pair[1 - inner], pair[inner]
        at = int(draw.integers(0, len(outer) + 1))
        x.append(np.concatenate([outer[:at], put, outer[at:]]))
        y.append(np.repeat([1 - inner, inner, 1 - inner], [at, len(put), len(outer) - at]))
    return x, y


RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "content_words long, base_failed boolean, kept boolean"
)


def apply_rules(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the counts, the words of content lines, base_failed and kept.

    A text fails the base with fewer than 20 words or with over 30 % of its words
    in repeated windows of eight. Otherwise it is kept if at least half of its words
    are in lines that the Viterbi path marks as content. Null and empty texts have
    no words and fail. Repeated rows and null ids give a row each; an empty table
    none. Other columns are not read.
    """
    small_batches(docs.sparkSession, 500)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first, last in byte_slices(batch.column("text")):
                part = batch.slice(first, last - first)
                scan = TextScan(part.column("text"))
                counts = base_counts(scan)
                counts["content_words"] = content_words(scan, chain)
                n = counts["n_words"]
                failed = (n < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * n)
                kept = ~failed & (counts["content_words"] >= MIN_CONTENT_SHARE * n)
                names = ["doc_id", *counts, "base_failed", "kept"]
                columns = [part.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts.values())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(failed), pa.array(kept)], names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(judge, RESULT)


@query("op6_quality_rules")
def op6_quality_rules(spark, folder):
    """Rule counts and verdict of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    chain = train(docs, table(spark, folder, "labels"))
    return apply_rules(docs, chain).drop("content_words")
