"""Spelling variants: words one edit apart, found by an index of variable-length grams.

Short grams of letters are in very many words, long ones are broken by an edit. So a
dictionary holds the longer grams that are frequent, and a word is cut, at each place,
into the longest gram of the dictionary that starts there (else the shortest length).
For each word a bound says how many of its grams one edit can touch; all
others stand in the changed word too. Of a word's grams, from rare to frequent, only
the first ones up to that bound and one more need their lists merged.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import query, small_batches, table
from gaugeworks.llm.scan import byte_slices
from gaugeworks.session import materialize

MIN_CHARS = 6
MIN_COUNT = 5
DELETE_ONE_IN = 199
# How many times as frequent a form must be as its variant.
FORM_RATIO = 5
SHORTEST, LONGEST = 2, 4
# A gram is frequent from this share of all places on, so there are at most as many of each length.
FREQUENT_SHARE = 1 / 20_000
# Bytes of text whose words are counted together.
SLICE_BYTES = 8 << 20
ROWS_OUT = 50_000
# Words whose byte length is at most this get their checksums from tables.
TABLE_BYTES = 64
START, END = "^", "$"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = True


def _crc_tables() -> np.ndarray:
    """[n, j, b]: what byte j of a checksum, being b, becomes after n more zero bytes."""
    # one zero byte more, by the definition of the checksum's polynomial
    step = np.empty(256, dtype=np.uint32)
    for b in range(256):
        x = b
        for _ in range(8):
            x = (x >> 1) ^ (0xEDB88320 if x & 1 else 0)
        step[b] = x
    tables = np.empty((TABLE_BYTES + 1, 4, 256), dtype=np.uint32)
    tables[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32)[:, None])
    for n in range(TABLE_BYTES):
        tables[n + 1] = (tables[n] >> np.uint32(8)) ^ step[tables[n] & np.uint32(255)]
    return tables


class RunScan:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF of at least `min_chars` code points, A-Z lower-cased.

    `run` numbers equal runs alike, `doc` is the text each is of, `chars` its code points.
    """

    def __init__(self, texts: pa.Array, min_chars: int):
        texts = pc.fill_null(texts, "")
        lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        doc_start = np.concatenate(([0], np.cumsum(lengths)))
        data = _LOWER[np.frombuffer(b"".join(v.as_buffer() for v in texts), dtype=np.uint8)]
        # in UTF-8 the letters from U+00C0 to U+00FF are 0xC3 and one more byte
        lead = data == 0xC3
        inside = _LETTER[data] | lead
        inside[1:] |= lead[:-1]
        first = doc_start[:-1][lengths > 0]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        begins[first] = inside[first]
        ends[:-1] &= ~inside[1:]
        last = doc_start[1:][lengths > 0] - 1
        ends[last] = inside[last]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        leads = np.concatenate(([0], np.cumsum(lead, dtype=np.int32)))
        chars = end - start - (leads[end] - leads[start])
        keep = chars >= min_chars
        start, end, self.chars = start[keep], end[keep], chars[keep]
        edge = np.zeros(len(data) + 1, dtype=np.int8)
        edge[start] += 1
        edge[end] -= 1
        letters = data[np.cumsum(edge[:-1], dtype=np.int8) > 0]
        offsets = np.concatenate(([0], np.cumsum(end - start))).astype(np.int32)
        runs = pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(letters)).dictionary_encode()
        self.runs, self.run = runs.dictionary, runs.indices.to_numpy().astype(np.int64)
        self.bytes = end - start
        self.doc = np.searchsorted(doc_start, start, side="right") - 1


def _checksums(doc_ids: list, scan: RunScan, tables: np.ndarray) -> np.ndarray:
    """The crc32 of `<doc_id>:<run>` for each run, from those of the id and of the run."""
    of_id = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in doc_ids], dtype=np.uint32)
    of_run = np.array([zlib.crc32(r.as_buffer()) for r in scan.runs], dtype=np.uint32)
    x, n = of_id[scan.doc], np.minimum(scan.bytes, TABLE_BYTES)
    moved = tables[n, 0, x & np.uint32(255)]
    for j in (1, 2, 3):
        moved = moved ^ tables[n, j, (x >> np.uint32(8 * j)) & np.uint32(255)]
    out = (moved ^ of_run[scan.run]).astype(np.int64)
    for i in np.flatnonzero(scan.bytes > TABLE_BYTES):
        doc_id = doc_ids[scan.doc[i]]
        out[i] = zlib.crc32(scan.runs[scan.run[i]].as_buffer(), zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()))
    return out


def _count(min_chars: int, one_in: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _crc_tables()
        for batch in batches:
            for first, last in byte_slices(batch.column("text"), SLICE_BYTES):
                part = batch.slice(first, last - first)
                scan = RunScan(part.column("text"), min_chars)
                if not len(scan.run):
                    continue
                h = _checksums(part.column("id").to_pylist(), scan, tables)
                hit = h % one_in == 0
                n = np.bincount(scan.run[~hit], minlength=len(scan.runs))
                cut: Counter[str] = Counter()
                for i in np.flatnonzero(hit):
                    if scan.chars[i] > min_chars:
                        word, at = scan.runs[scan.run[i]].as_py(), int(h[i] % scan.chars[i])
                        cut[word[:at] + word[at + 1 :]] += 1
                seen = np.flatnonzero(n)
                words = pa.concat_arrays([scan.runs.take(pa.array(seen)), pa.array(list(cut), pa.string())])
                counts = pa.concat_arrays([pa.array(n[seen].astype(np.int64)), pa.array(list(cut.values()), pa.int64())])
                for i in range(0, len(words), ROWS_OUT):
                    yield pa.RecordBatch.from_arrays([words[i : i + ROWS_OUT], counts[i : i + ROWS_OUT]], ["word", "n"])

    return count


def count_words(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
    min_count: int = MIN_COUNT, one_in: int = DELETE_ONE_IN,
) -> DataFrame:
    """The words of whole texts with their counts, one letter of some runs deleted by their checksum; stored.

    A null text has no words; a null id is an empty text in the checksum. All rows
    count, repeated ones too; other columns are not read.
    """
    small_batches(docs.sparkSession)
    narrow = docs.select(F.col(f"`{id_col}`").cast("string").alias("id"), F.col(f"`{text_col}`").alias("text"))
    counts = narrow.mapInArrow(_count(min_chars, one_in), "word string, n long")
    return materialize(counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count), "words")


class GramDictionary:
    """Frequent grams with their counts; the longer ones cut words.

    `starts` and `ends` hold the proper starts and ends of the longer ones, which say
    how far an edit can reach.
    """

    def __init__(self, counts: dict[str, int], shortest: int = SHORTEST, longest: int = LONGEST):
        self.counts, self.shortest, self.longest = counts, shortest, longest
        self.grams = {g for g in counts if len(g) > shortest}
        self.starts = {g[:i] for g in self.grams for i in range(1, len(g))}
        self.ends = {g[i:] for g in self.grams for i in range(1, len(g))}

    def cut(self, s: str) -> list[tuple[int, int]]:
        """Start and end of the grams of a padded word; a gram within an earlier one is left out."""
        out, reach = [], 0
        for p in range(len(s) - self.shortest + 1):
            end = p + self.shortest
            for n in range(min(self.longest, len(s) - p), self.shortest, -1):
                if s[p : p + n] in self.grams:
                    end = p + n
                    break
            if end > reach:
                out.append((p, end))
                reach = end
        return out

    def touched(self, s: str, grams: list[tuple[int, int]]) -> int:
        """How many grams one edit can touch at most, wherever it is.

        Grams around the edit break. Left of it, a gram may be cut longer, or vanish in a
        longer one, only from where the letters before the edit start a gram of the dictionary;
        right of it, a gram may vanish in a new one only as far as the letters after the
        edit end a gram of the dictionary.
        """
        most = 0
        for i in range(1, len(s)):
            low = i
            for p in range(max(0, i - self.longest + 1), i):
                if s[p:i] in self.starts:
                    low = p
                    break
            # an insertion before letter i, and a change or deletion of it (the end mark stays)
            for right in (i, i + 1) if i < len(s) - 1 else (i,):
                high = right
                for e in range(min(len(s), right + self.longest - 1), right, -1):
                    if s[right:e] in self.ends:
                        high = e
                        break
                n = 0
                for p, e in grams:
                    if p < right and e > i or e <= i and p >= low or p >= right and e <= high:
                        n += 1
                most = max(most, n)
        return most

    def signature(self, s: str) -> tuple[list[tuple[int, int]], int]:
        """The grams whose lists are merged, and how many grams any word one edit away shares at least."""
        grams = self.cut(s)
        bound = self.touched(s, grams)
        ranked = sorted(grams, key=lambda g: (self.counts.get(s[g[0] : g[1]], 0), s[g[0] : g[1]], g[0]))
        return ranked[: bound + 1], len(grams) - bound


def gram_counts(words: DataFrame, shortest: int, longest: int) -> DataFrame:
    """How many places of the words each gram of these lengths has: (gram, n)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n: Counter[str] = Counter()
            for word in batch.column("word").to_pylist():
                s = START + word + END
                for q in range(shortest, longest + 1):
                    n.update([s[i : i + q] for i in range(len(s) - q + 1)])
            yield pa.RecordBatch.from_arrays([pa.array(list(n)), pa.array(list(n.values()), pa.int64())], ["gram", "n"])

    return words.select("word").mapInArrow(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def gram_dictionary(
    words: DataFrame, shortest: int = SHORTEST, longest: int = LONGEST, share: float = FREQUENT_SHARE
) -> GramDictionary:
    """The grams with at least `share` of all places of the words: at most 1 / share for each length."""
    places = words.agg(F.sum(F.char_length("word") + 1)).first()[0] or 0
    frequent = gram_counts(words, shortest, longest).filter(F.col("n") >= max(1, places * share))
    return GramDictionary({r.gram: r.n for r in frequent.toLocalIterator()}, shortest, longest)


def _keys(dictionary):
    """List entries of words: (key, word, n). A word whose bound leaves no sure gram is also listed by plain grams.

    For plain grams of two letters the bound is two, and a padded word has more, so
    two such words meet there.
    """
    plain = GramDictionary({}, SHORTEST, SHORTEST)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: GramDictionary = dictionary.value
        for batch in batches:
            keys: list[str] = []
            many: list[int] = []
            for word in batch.column("word").to_pylist():
                s, before = START + word + END, len(keys)
                signature, sure = grams.signature(s)
                found = [("", signature)] + ([("2", plain.signature(s)[0])] if sure < 1 else [])
                for mark, listed in found:
                    # an untouched gram left of the edit has the same letters before it, one to the right the same after it
                    keys.extend(mark + "<" + s[:e] for _, e in listed if e < len(s))
                    keys.extend(mark + ">" + s[p:] for p, _ in listed if p)
                many.append(len(keys) - before)
            rows = pa.array(np.repeat(np.arange(batch.num_rows), many))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), batch.column("word").take(rows), batch.column("n").take(rows)],
                ["key", "word", "n"],
            )

    return index


def near_words(words: DataFrame, longest: int = LONGEST, share: float = FREQUENT_SHARE) -> DataFrame:
    """All pairs (word, n, other, other_n) that differ by one inserted, deleted or replaced code point, both ways.

    `words` is a stored table of distinct words of at least two letters, with n. Words meet in the
    merged lists of their rarest grams, aligned at the start or the end of the word,
    and each pair that meets is verified. No pair is missed: of one word's grams an
    edit touches at most `GramDictionary.touched`, so the rarest of those that it leaves is
    in the signatures of both.
    """
    spark = words.sparkSession
    grams = gram_dictionary(words, longest=longest, share=share)
    listed = words.select("word", "n").mapInArrow(_keys(spark.sparkContext.broadcast(grams)), "key string, word string, n long")
    listed = listed.select(F.xxhash64("key").alias("key"), "word", "n")
    other = listed.select("key", F.col("word").alias("other"), F.col("n").alias("other_n"))
    close = (F.col("word") < F.col("other")) & (F.abs(F.char_length("word") - F.char_length("other")) <= 1)
    met = listed.join(other, "key").filter(close).filter(F.levenshtein("word", "other", 1) == 1)
    pairs = materialize(met.select("word", "n", "other", "other_n").distinct(), "near-words")
    turned = pairs.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    return pairs.unionByName(turned)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for rows (word, form): the last word along the forms. A form has a larger count, so there is no ring."""
    found = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        # every round doubles the steps taken; counts grow by a factor with each step, so few rounds do
        further = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = found.join(further, "root", "left")
        found = materialize(
            joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots"
        )
        if found.filter("moved").isEmpty():
            return found.select("word", "root")
        found = found.select("word", "root")


def spelling_variants(words: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """For each word of a stored table (word, n): form, root, n_near, form_n.

    The form is the near word of largest count (of equal ones the first in code-point
    order) if that count is at least `ratio` times the word's own; the root is the last
    word along the forms, the word itself without one. Words without near words
    have n_near 0 and no form.
    """
    near = near_words(words).groupBy("word", "n").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other"))).alias("best")
    )
    many = -F.col("best.minus")
    chosen = (many.cast("decimal(20,0)") >= F.col("n").cast("decimal(20,0)") * ratio)
    near = materialize(
        near.select("word", "n_near", F.when(chosen, F.col("best.other")).alias("form"), F.when(chosen, many).alias("form_n")),
        "forms",
    )
    found = near.join(roots(near.filter("form is not null")), "word", "left")
    return words.join(found, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        "form_n",
    )


@query("op11_spelling_variants")
def op11_spelling_variants(spark, folder):
    """Every word of the documents with its usual form, the root of its forms and its near words."""
    return spelling_variants(count_words(table(spark, folder, "documents")))
