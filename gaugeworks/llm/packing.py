"""Pack tokenised documents into sequences, shortest pack first over the length histogram."""

from __future__ import annotations

import codecs
import os
import re
import sys
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm.common import query, small_batches, table
from gaugeworks.llm.scan import byte_slices
from gaugeworks.session import materialize

SEQUENCE = 4096
END_ID = 2
# Bytes of text whose words are looked up together.
SLICE_BYTES = 1 << 20
# Words whose ids a Python worker remembers; it starts anew beyond that.
CACHE_WORDS = 100_000
# Rows of one rank block: what a single window task sorts.
BLOCK_BITS = 16
# Letters that no normal form changes: one word, nothing to split.
_PLAIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+").fullmatch


def public_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokens:
    """Token ids of texts for a tokenizer that never joins words across white space.

    Ids of a word do not depend on its neighbours, so a word is encoded once and
    remembered. Words are parted at ASCII blanks only; other blanks, and special
    tokens inside a word, are left to the tokenizer.
    """

    def __init__(self, path: str, end_id: int = END_ID, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.end_id, self.cache_words = Tokenizer.from_file(path), end_id, cache_words
        self.model = self.tokenizer.model
        # fixed values: how byte-level tokenizers write bytes as letters
        own = {*range(33, 127), *range(161, 173), *range(174, 256)}
        other = iter(range(256, 512))
        self.byte_letters = "".join(chr(b if b in own else next(other)) for b in range(256))
        self.known: dict[str, bytes] = {}

    def encode(self, word: str) -> bytes:
        """Ids of a word as 32-bit numbers; plain ones skip the steps that would not change them."""
        if _PLAIN(word):
            letters = codecs.charmap_decode(word.lower().encode("utf-8"), "strict", self.byte_letters)[0]
            return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()
        head = word.rstrip(".,;:!?|*#%$&")
        if head and len(head) < len(word) and head[-1].isalpha() and head[-1] < "\u0100":
            return self.of(head) + self.of(word[len(head) :])  # a new piece starts after the last letter
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def of(self, word: str) -> bytes:
        ids = self.known.get(word)
        if ids is None:
            ids = self.known[word] = self.encode(word)
        return ids

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """For each text its ids and the end id."""
        texts = pc.fill_null(texts, "")
        # a lower-cased word has the same ids, unless it could turn into a special token
        texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        words = pc.ascii_split_whitespace(texts)
        coded = words.flatten().dictionary_encode()
        if len(self.known) > self.cache_words:
            self.known = {}
        found = [self.of(w) for w in coded.dictionary.to_pylist()]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), dtype="<u4")
        at = coded.indices.to_numpy()
        many = sizes[at]
        ends = np.concatenate(([0], np.cumsum(many)))
        firsts = np.cumsum(sizes) - sizes
        ids = flat[np.repeat(firsts[at] - ends[:-1], many) + np.arange(ends[-1])]
        bounds = ends[words.offsets.to_numpy() - words.offsets[0].as_py()]
        end = np.array([self.end_id], dtype="<u4")
        return [np.concatenate((ids[a:b], end)) for a, b in zip(bounds, bounds[1:])]


def worker_tokens(path: str, end_id: int) -> WordTokens:
    """The tokenizer of this Python worker, kept for its next tasks with the words it knows."""
    kept = sys.modules.setdefault("gaugeworks_worker", ModuleType("gaugeworks_worker"))
    if getattr(kept, "tokens_of", None) != (path, end_id):
        kept.tokens, kept.tokens_of = WordTokens(path, end_id), (path, end_id)
    return kept.tokens


_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _cut(path: str, end_id: int, sequence: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = worker_tokens(path, end_id)
        for batch in batches:
            doc_ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for first, last in byte_slices(texts, SLICE_BYTES):
                out = []
                for doc_id, ids in zip(doc_ids[first:last], tokens(texts.slice(first, last - first))):
                    for start in range(0, len(ids), sequence):
                        piece = ids[start : start + sequence]
                        out.append((doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
                columns = [pa.array(c, pa.int64()) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return cut


def shortest_pack_first(histogram: dict[int, int], sequence: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths, with the number of packs that follow each.

    Lengths are placed longest first, each into the pack with the most room left, if
    it fits; packs that are alike are one pattern with a count, so the work depends
    on the number of lengths and not of documents.
    """
    by_room: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
    done: dict[tuple[int, ...], int] = {}

    def put(room: int, pattern: tuple[int, ...], count: int) -> None:
        target = by_room[room] if room else done
        target[pattern] = target.get(pattern, 0) + count

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r, packs in by_room.items() if packs), default=0)
            if room < length:
                put(sequence - length, (length,), left)
                break
            pattern, count = by_room[room].popitem()
            taken = min(count, left)
            put(room - length, (*pattern, length), taken)
            if count > taken:
                by_room[room][pattern] = count - taken
            left -= taken
        by_room = defaultdict(dict, {r: packs for r, packs in by_room.items() if packs})
    rest = [item for room in sorted(by_room) for item in by_room[room].items()]
    return sorted([*done.items(), *rest], reverse=True)


def placement(histogram: dict[int, int], sequence: int):
    """Arrays that place the k-th piece of a length: see `_placed`."""
    entries: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    first_id = 0
    for pattern, count in shortest_pack_first(histogram, sequence):
        offset = 0
        for length in pattern:
            entries[length].append((count, first_id, offset))
            offset += length
        first_id += count
    base = np.zeros(sequence + 1, dtype=np.int64)
    starts, ids, offsets, at = [], [], [], 0
    for length in sorted(entries):
        base[length] = at
        for count, sequence_id, offset in entries[length]:
            starts.append(at)
            ids.append(sequence_id)
            offsets.append(offset)
            at += count
    return base, np.array(starts, np.int64), np.array(ids, np.int64), np.array(offsets, np.int64)


def _placed(histogram: dict[int, int], sequence: int):
    base, starts, ids, offsets = placement(histogram, sequence)
    kind = T.StructType().add("sequence_id", T.LongType()).add("offset", T.LongType())

    @F.pandas_udf(kind)
    def placed(lengths: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        k = base[lengths.to_numpy()] + ranks.to_numpy()
        entry = np.searchsorted(starts, k, side="right") - 1
        return pd.DataFrame({"sequence_id": ids[entry] + k - starts[entry], "offset": offsets[entry]})

    return placed


def pack(
    docs: DataFrame,
    vocabulary: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    sequence: int = SEQUENCE,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and the end id, cut at multiples of the sequence length;
    full pieces are sequences of their own and the rests are packed shortest pack
    first. The driver sees the histogram of lengths only. Pieces get their rank
    among those of equal length from counts of row blocks, so a length that very
    many documents have is never in one task, and the pattern follows from the rank.

    A null or empty text is the end id alone. Repeated rows and null ids are packed
    like any others. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark, 500)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    cut = texts.mapInArrow(_cut(vocabulary or public_vocabulary(), end_id, sequence), _PIECE)
    pieces = materialize(cut.withColumn("pos", F.monotonically_increasing_id()), "pieces")
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}

    pieces = pieces.withColumn("block", F.shiftright("pos", BLOCK_BITS))
    earlier = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = pieces.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n"))
    blocks = blocks.select("length", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "block").orderBy("pos")
    ranked = pieces.withColumn("nth", F.row_number().over(inside) - 1).join(blocks, ["length", "block"])
    small_batches(spark, 10_000)
    place = _placed(histogram, sequence)
    return ranked.withColumn("at", place(F.col("length"), F.col("before") + F.col("nth"))).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "at.sequence_id", "at.offset"
    )


@query("op10_packing")
def op10_packing(spark, folder):
    """All documents packed into sequences of 4096 tokens."""
    return pack(table(spark, folder, "documents"))
