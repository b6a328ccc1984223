"""Score documents by masked pseudo-likelihood under a window network trained on the corpus."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm import window_model as model
from gaugeworks.llm.common import query, small_batches, table
from gaugeworks.llm.scan import byte_slices
from gaugeworks.session import materialize

# The part of all ids that stands for words beyond the most frequent ones, by hash.
RARE_PART = 16
# So many of the most frequent words beyond have their share of an id looked up while words are
# numbered; all further words are joined. The bound saves work and changes no result.
NAMED = 1 << 16
# Tokens that a partition learns from, for each id; smaller partitions are put together.
TOKENS_PER_ID = 256
# Passes over the corpus, and the share of all tokens that each masks and learns from:
# together the passes learn from every token.
ROUNDS = 2
MASKED_SHARE = 1 / ROUNDS
# Parameters of one part that is averaged, and partitions averaged at a time.
CHUNK = 8_192
FAN_IN = 256
COUNT_BYTES = 8 << 20
TOKENS_AT_ONCE = 1 << 19


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words (runs without ASCII blanks) of all texts, and the number of each text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = lists.flatten()
    real = pc.greater(pc.binary_length(flat), 0)
    owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    kept = real.to_numpy(zero_copy_only=False)
    return flat.filter(real), np.bincount(owner[kept], minlength=len(lists))


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) over all words of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for first, last in byte_slices(texts, COUNT_BYTES):
                found = pc.value_counts(split_words(texts.slice(first, last - first))[0])
                yield pa.RecordBatch.from_arrays([found.field("values"), found.field("counts")], ["word", "n"])

    parts = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame) -> tuple[dict[str, int], np.ndarray]:
    """Ids of the most frequent words of the whole corpus, and the count of each id.

    There are more ids the larger the corpus is (`window_model.Net.for_tokens`). The words beyond
    share the last ids by hash; the count of such an id is that of its words.
    """
    ids = model.Net.for_tokens(counts.agg(F.sum("n")).first()[0] or 0).vocabulary
    top = counts.orderBy(F.desc("n"), "word").limit(ids - ids // RARE_PART).collect()
    n = np.zeros(ids)
    n[: len(top)] = [r.n for r in top]
    known = {r.word: i for i, r in enumerate(top)}
    for r in rare_words(counts, known, n).groupBy("id").agg(F.sum("n").alias("n")).collect():
        n[ids - ids // RARE_PART + r.id] = r.n
    return known, n


def rare_words(counts: DataFrame, known: dict[str, int], n: np.ndarray) -> DataFrame:
    """(word, n, id) of the words beyond the known ones, which are those that come first by count and word."""
    rare = len(n) // RARE_PART
    marked = counts.withColumn("id", (F.crc32(F.col("word").cast("binary")) % rare).cast("int"))
    if len(known) < len(n) - rare:
        return marked.filter(F.lit(False))
    last, least = next(reversed(known)), int(n[len(known) - 1])
    return marked.filter((F.col("n") < least) | ((F.col("n") == least) & (F.col("word") > last)))


def word_shares(rare: DataFrame) -> tuple[DataFrame, dict[str, float]]:
    """(word, share) of rare words, the log of a word's part of all words of its id; and the shares
    of the NAMED most frequent ones by word.
    """
    of_id = rare.groupBy("id").agg(F.sum("n").alias("all"))
    # no more rows than ids, whatever the corpus
    shares = rare.join(F.broadcast(of_id), "id").select("word", "n", F.log(F.col("n") / F.col("all")).alias("share"))
    top = shares.orderBy(F.desc("n"), "word").limit(NAMED).collect()
    return shares.select("word", "share"), {r.word: r.share for r in top}


def _kind(ids: int) -> str:
    """How ids are stored."""
    return "<u2" if ids <= 1 << 16 else "<u4"


def encoded(
    docs: DataFrame,
    known: dict[str, int],
    id_col: str,
    text_col: str,
    ids_in_all: int = model.SMALL.vocabulary,
    named: dict[str, float] | None = None,
) -> DataFrame:
    """(doc_id, ids, row, within, words, times): the word ids of each whole text as numbers of 16 or 32
    bits, a number of the row, the sum of the `named` shares of its rare words, and its other rare
    words with their counts; written once.
    """
    named = named or {}
    rare_ids = ids_in_all // RARE_PART
    first_rare, kind = ids_in_all - rare_ids, _kind(ids_in_all)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = batch.column("text")
            for first, last in byte_slices(texts, COUNT_BYTES):
                words, lengths = split_words(texts.slice(first, last - first))
                coded = words.dictionary_encode()
                names, indices = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
                of = [known[w] if w in known else first_rare + zlib.crc32(w.encode()) % rare_ids for w in names]
                ids = np.array(of, dtype=kind)[indices]
                ends = np.cumsum(lengths)
                share = np.array([0.0 if i < first_rare else named.get(w, np.nan) for w, i in zip(names, of)])[indices]
                rare = np.isnan(share)
                owner = np.repeat(np.arange(len(lengths)), lengths)
                within = np.bincount(owner, np.where(rare, 0.0, share), len(lengths))
                own, times = np.unique(owner[rare] * max(len(names), 1) + indices[rare], return_counts=True)
                cuts = np.searchsorted(own // max(len(names), 1), np.arange(len(lengths) + 1)).astype(np.int32)
                found = coded.dictionary.take(pa.array(own % max(len(names), 1))).cast(pa.string())
                rows = pa.array(np.arange(row, row + len(lengths)))
                row += len(lengths)
                cells = [ids[e - n : e].tobytes() for e, n in zip(ends, lengths)]
                doc_ids = batch.column("doc_id").slice(first, last - first)
                lists = [pa.ListArray.from_arrays(cuts, found), pa.ListArray.from_arrays(cuts, pa.array(times.astype(np.int64)))]
                columns = [doc_ids, pa.array(cells, pa.binary()), rows, pa.array(within), *lists]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "row", "within", "words", "times"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, ids binary, row long, within double, words array<string>, times array<long>"
    return materialize(rows.mapInArrow(encode, schema), "word-ids")


def _texts(batch: pa.RecordBatch, net: model.Net) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows first to last of a batch at a time: their ids one after another, and their ends."""
    cells, kind = batch.column("ids"), np.dtype(_kind(net.vocabulary))
    for first, last in byte_slices(cells, kind.itemsize * TOKENS_AT_ONCE):
        part = cells.slice(first, last - first)
        ids = np.frombuffer(b"".join(v.as_buffer() for v in part), dtype=kind).astype(np.int64)
        yield first, last, ids, np.cumsum(pc.binary_length(part).to_numpy(zero_copy_only=False)) // kind.itemsize


def masked_tokens(ids: np.ndarray, ends: np.ndarray, turn: float, share: float) -> np.ndarray:
    """Which tokens are masked in a pass: a share of a circle, from `turn` on, by text and position.

    Turns that are a share apart mask disjoint tokens, and all of them once around,
    however the texts are dealt out.
    """
    starts = np.concatenate(([0], ends[:-1])).astype(np.int64)
    keys = np.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)], dtype=np.uint64)
    h = np.repeat(keys << np.uint64(32), ends - starts) + (np.arange(len(ids)) - np.repeat(starts, ends - starts)).astype(np.uint64)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    at = (h >> np.uint64(32)).astype(np.int64)
    return (at - int(turn * 2**32)) % 2**32 < np.ceil(share * 2**32)


def _learn(flat: np.ndarray, net: model.Net, seed: int, turn: float, masked_share: float):
    """One pass over a partition: its parameters in chunks, times the tokens it learned from."""

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner, learned = model.Learner(flat, net), 0
        for batch in batches:
            for first, _, ids, ends in _texts(batch, net):
                draw = np.random.default_rng([seed, learned, len(ids)])
                masked = draw.permutation(np.flatnonzero(masked_tokens(ids, ends, turn, masked_share)))
                own, near = ids[masked], model.contexts(ids, ends, net, masked)
                for start in range(0, len(masked), net.minibatch):
                    some = slice(start, start + net.minibatch)
                    learner.step(own[some], near[:, some])
                learned += len(masked)
        if learned:
            chunks = [learner.flat[i : i + CHUNK].astype("<f8") * learned for i in range(0, net.size, CHUNK)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(chunks))), pa.array([learned] * len(chunks)), pa.array([c.tobytes() for c in chunks])],
                ["chunk", "learned", "total"],
            )

    return learn


def _add(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("part")
    total = np.sum([np.frombuffer(t, dtype="<f8") for t in rows["total"]], axis=0)
    return pd.DataFrame(
        {
            "part": [rows["part"].iat[0] // FAN_IN],
            "chunk": [rows["chunk"].iat[0]],
            "learned": [rows["learned"].sum()],
            "total": [total.tobytes()],
        }
    )


def train(ids: DataFrame, counts: np.ndarray, rounds: int = ROUNDS, masked_share: float = MASKED_SHARE, seed: int = 11) -> np.ndarray:
    """Parameters after `rounds` passes over all documents.

    In a pass every partition starts from the common parameters and learns from its
    own documents; the results are averaged by the tokens learned from, a bounded
    number at a time, and the model alone reaches the driver. A partition learns from
    TOKENS_PER_ID tokens for each id of the vocabulary or more, so all partitions' models
    together grow no faster than the corpus.
    """
    flat, net = model.initial(counts), model.Net.of_ids(len(counts))
    learners = max(1, ceil(counts.sum() / (TOKENS_PER_ID * net.vocabulary)))
    for r in range(rounds):
        learn = _learn(flat, net, seed + r, r / rounds, masked_share)
        out = ids.coalesce(learners).mapInArrow(learn, "chunk long, learned long, total binary")
        sums = materialize(out.withColumn("part", F.spark_partition_id().cast("long")), "passes")
        for _ in range(2):
            group = [F.floor(F.col("part") / FAN_IN), F.col("chunk")]
            sums = sums.groupBy(*group).applyInPandas(_add, "part long, chunk long, learned long, total binary")
        rows = sorted(sums.collect(), key=lambda x: (x.chunk, x.part))
        if rows:
            total = sum_by_chunk(rows)
            flat = np.round(total, 6).astype(np.float32)
    return flat


def sum_by_chunk(rows) -> np.ndarray:
    """The averaged parameters from the last sums of each chunk."""
    chunks: dict[int, tuple[float, np.ndarray]] = {}
    for r in rows:
        n, total = chunks.get(r.chunk, (0, 0.0))
        chunks[r.chunk] = (n + r.learned, total + np.frombuffer(r.total, dtype="<f8"))
    return np.concatenate([chunks[c][1] / chunks[c][0] for c in sorted(chunks)])


def score_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, masked_share: float = MASKED_SHARE
) -> DataFrame:
    """One row per document: doc_id, n_tokens, log_likelihood, mean_log_likelihood.

    The log-likelihood is the sum, over all words of the whole text, of the word's
    log-probability given the two words on either side (with edge marks at the
    ends). That of a rare word is its id's plus the log of the word's share of all words
    of that id in the corpus. The vocabulary grows with the square root of the corpus's
    words, all of which are counted, and training passes over every document. Null and empty texts have no tokens, the sum 0 and a null mean;
    one word alone is scored from edge marks; repeated rows and null ids give a row
    each; an empty table gives none. Other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark, 500)
    counts = materialize(word_counts(docs, text_col), "word-counts")
    known, n = vocabulary(counts)
    net = model.Net.of_ids(len(n))
    shares, named = word_shares(rare_words(counts, known, n))
    ids = encoded(docs, known, id_col, text_col, len(n), named)
    flat = train(ids.select("ids"), n, rounds, masked_share)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, own, ends in _texts(batch, net):
                logs = model.log_probabilities(flat, own, model.contexts(own, ends, net), net)
                sums = np.concatenate(([0.0], np.cumsum(logs)))
                starts = np.concatenate(([0], ends[:-1]))
                lengths = ends - starts
                total = np.where(lengths > 0, sums[ends] - sums[starts], 0.0)
                row, doc_id, within = (batch.column(c).slice(first, last - first) for c in ("row", "doc_id", "within"))
                columns = [row, doc_id, pa.array(lengths), pa.array(total + within.to_numpy())]
                yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n_tokens", "by_id"])

    scored = ids.select("row", "doc_id", "ids", "within").mapInArrow(score, "row long, doc_id long, n_tokens long, by_id double")
    held = ids.select("row", F.explode(F.arrays_zip("words", "times")).alias("w"))
    held = held.select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    within = held.join(shares, "word").groupBy("row").agg(F.sum(F.col("times") * F.col("share")).alias("within"))
    total = F.col("by_id") + F.coalesce("within", F.lit(0.0))
    mean = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    out = scored.join(within, "row", "left").withColumn("log_likelihood", total)
    return out.select("doc_id", "n_tokens", "log_likelihood", mean.alias("mean_log_likelihood"))


@query("op4_lm_scoring")
def op4_lm_scoring(spark, folder):
    """Pseudo-likelihood of every document."""
    return score_documents(table(spark, folder, "documents"))
