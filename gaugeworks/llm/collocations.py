"""Phrases that stick together, from count streams in prefix and in suffix order.

Phrases are counted length by length, and a longer one only where its shorter parts
are frequent. The counts are then two sorted streams. In prefix order a phrase comes
right after its first words and right before its longer forms, so one pass that
remembers the last phrase of each length knows the counts of all left parts and
the most frequent extension to the right; in suffix order (the words reversed) the
same pass gives right parts and extensions to the left. No table of counts is held.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import query, small_batches, table
from gaugeworks.llm.scan import byte_slices
from gaugeworks.session import materialize

LONGEST = 4
MIN_COUNT = 30
# A phrase goes if a longer one has at least this share of its count, in percent.
COVERED = 80
SCALE = 2_000_000
TOP = 2000
NO_LANG = "und"
# Bytes of text that are counted together in a task.
SLICE_BYTES = 8 << 20
# Phrases of one range of a stream, and the sampled phrases a range's border is taken from.
RANGE_ROWS = 50_000
SAMPLES = 30
# Bits of the filter of frequent parts: it only spares work, so it may fill up beyond that.
MAX_BITS = 1 << 26
ROWS_OUT = 50_000

# What a byte is: of a word, blank between words, or the end of a piece.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[9, 32]] = 1
_KIND[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class PieceScan:
    """The words of whole texts, and which of them stand next to each other in a piece.

    `word` numbers equal words of the slice alike, `joined[i]` says whether word i + 1
    follows word i in the same piece, `doc` is the text a word is of.
    """

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts, "")
        lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        doc_start = np.concatenate(([0], np.cumsum(lengths)))
        data = _LOWER[np.frombuffer(b"".join(v.as_buffer() for v in texts), dtype=np.uint8)]
        kind = _KIND[data]
        inside = kind == 0
        first = doc_start[:-1][lengths > 0]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        begins[first] = inside[first]
        start = np.flatnonzero(begins)
        breaks = kind == 2
        breaks[first] = True
        piece = np.cumsum(breaks, dtype=np.int32)[start]
        # the bytes of all words without what is between them
        letters = data[inside]
        place = np.cumsum(inside, dtype=np.int32)[start] - 1
        offsets = np.concatenate((place, [len(letters)])).astype(np.int32)
        words = pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(letters)).dictionary_encode()
        self.words = words.dictionary
        self.word = words.indices.to_numpy().astype(np.int64)
        self.doc = np.searchsorted(doc_start, start, side="right") - 1
        self.joined = piece[1:] == piece[:-1]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _hashes(words: pa.Array) -> np.ndarray:
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _mixed(first * np.uint64(0xC2B2AE3D27D4EB4F) + second)


def _bits(h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(size - 1)
    return (h & mask).astype(np.int64), ((h >> np.uint64(32)) & mask).astype(np.int64)


def _has(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether the filter may hold the keys; `bits` are 64-bit words."""
    out = np.ones(len(h), dtype=bool)
    for at in _bits(h, len(bits) * 64):
        out &= (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) > 0
    return out


def _phrase_hashes(langs: pa.Array, phrases: pa.Array) -> np.ndarray:
    """Hashes of phrases of one or two words, as a scan computes them."""
    parts = pc.split_pattern(phrases, " ")
    flat, counts = _hashes(parts.flatten()), np.diff(parts.offsets.to_numpy())
    own = np.repeat(_hashes(langs), counts)
    flat = _mixed(flat ^ own)
    at = np.cumsum(counts) - counts
    return np.where(counts == 1, flat[at], _pair(flat[at], flat[at + counts - 1]))


def frequent_filter(phrases: DataFrame) -> np.ndarray:
    """A Bloom filter of at most `MAX_BITS` bits of the given phrases of one or two words."""
    size = 1 << 10
    wanted = phrases.count() * 16
    while size < min(wanted, MAX_BITS):
        size *= 2

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate(_bits(_phrase_hashes(batch.column("lang"), batch.column("phrase")), size))
            bit = (np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(bit)], ["place", "bit"])

    marked = phrases.select("lang", "phrase").mapInArrow(mark, "place long, bit long")
    found = marked.groupBy("place").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(size // 64, dtype=np.uint64)
    bits[found["place"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return bits


def _counted(codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each distinct code a place where it stands, and how often it does."""
    _, first, n = np.unique(codes, return_index=True, return_counts=True)
    return at[first], n


def _count(lengths: tuple[int, ...], filtered, text_col: str, lang_col: str):
    """Counts of phrases in slices of texts: (lang, phrase, n).

    Length 1 counts all words, and the sum for each language (phrase null). Length 2 needs
    the filter of frequent words, lengths 3 and 4 that of frequent pairs.
    """

    def slice_counts(langs: pa.Array, scan: PieceScan):
        coded = langs.dictionary_encode()
        lang = coded.indices.to_numpy().astype(np.int64)[scan.doc]
        word, joined, kinds = scan.word, scan.joined, len(scan.words)
        if lengths == (1,):
            n = np.bincount(lang, minlength=len(coded.dictionary))
            yield coded.dictionary, pa.nulls(len(n), pa.string()), n
            at, n = _counted(lang * kinds + word, np.arange(len(word)))
            yield coded.dictionary.take(pa.array(lang[at])), scan.words.take(pa.array(word[at])), n
            return
        bits = filtered.value
        of_word, of_lang = _hashes(scan.words), _hashes(coded.dictionary)
        h = _mixed(of_word[word] ^ of_lang[lang])
        if lengths == (2,):
            known = _has(bits, h)
            at = np.flatnonzero(joined & known[:-1] & known[1:])
            grams = [(2, *_counted((lang[at] * kinds + word[at]) * kinds + word[at + 1], at))]
        else:
            pair = joined.copy()
            near = np.flatnonzero(joined)
            pair[near] = _has(bits, _pair(h[near], h[near + 1]))
            at = np.flatnonzero(pair)
            code = np.full(len(word) + LONGEST, -1, dtype=np.int64)
            _, code[at] = np.unique((lang[at] * kinds + word[at]) * kinds + word[at + 1], return_inverse=True)
            size, grams = len(at) + 1, []
            tail = code.copy()
            for length in lengths:
                # a phrase is its first words (so far `tail`) and the pair at its end
                at = at[code[at + length - 2] >= 0]
                codes = tail[at] * size + code[at + length - 2]
                grams.append((length, *_counted(codes, at)))
                tail = np.full(len(code), -1, dtype=np.int64)
                _, tail[at] = np.unique(codes, return_inverse=True)
        for length, at, n in grams:
            parts = [scan.words.take(pa.array(word[at + i])) for i in range(length)]
            yield coded.dictionary.take(pa.array(lang[at])), pc.binary_join_element_wise(*parts, " "), n

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, texts in _slices(batches, text_col, lang_col):
            scan = PieceScan(texts)
            if len(scan.word) < max(lengths[0], 1):
                continue
            for lang, phrase, n in slice_counts(langs, scan):
                for i in range(0, len(n), ROWS_OUT):
                    part = slice(i, i + ROWS_OUT)
                    yield pa.RecordBatch.from_arrays(
                        [lang[part], phrase[part], pa.array(n[part].astype(np.int64))], ["lang", "phrase", "n"]
                    )

    return count


def _slices(batches: Iterator[pa.RecordBatch], text_col: str, lang_col: str) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Languages and texts of about `SLICE_BYTES` together, whatever the batches are."""
    langs, texts, held = [], [], 0
    for batch in batches:
        for first, last in byte_slices(batch.column(text_col), SLICE_BYTES):
            part = batch.slice(first, last - first)
            langs.append(pc.fill_null(part.column(lang_col), NO_LANG))
            texts.append(pc.fill_null(part.column(text_col), ""))
            held += pc.sum(pc.binary_length(texts[-1])).as_py()
            if held >= SLICE_BYTES:
                yield pa.concat_arrays(langs), pa.concat_arrays(texts)
                langs, texts, held = [], [], 0
    if texts:
        yield pa.concat_arrays(langs), pa.concat_arrays(texts)


def count_phrases(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT
) -> tuple[DataFrame, DataFrame]:
    """Counts of all phrases of 1 to 4 words with at least `min_count` occurrences, and of all words by language.

    Returns stored tables (lang, phrase, n) and (lang, n). A filter of frequent parts
    (of bounded size, with no false negatives) keeps most rare phrases from being shuffled.
    """
    spark = docs.sparkSession
    small_batches(spark)
    narrow = docs.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))

    def counted(lengths: tuple[int, ...], known) -> DataFrame:
        sent = None if known is None else spark.sparkContext.broadcast(frequent_filter(known))
        counts = narrow.mapInArrow(_count(lengths, sent, "text", "lang"), "lang string, phrase string, n long")
        counts = counts.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
        return materialize(counts.filter((F.col("n") >= min_count) | F.col("phrase").isNull()), "phrases")

    ones = counted((1,), None)
    words = ones.filter("phrase is not null")
    pairs = counted((2,), words)
    longer = counted((3, 4), pairs)
    return words.unionByName(pairs).unionByName(longer), ones.filter("phrase is null").select("lang", "n")


def _borders(stream: DataFrame, ranges: int, total: int) -> list[tuple]:
    """Keys that cut the stream into about equal ranges, from a sample of `SAMPLES` phrases for each."""
    if ranges < 2:
        return []
    every = max(1, total // (ranges * SAMPLES))
    sample = stream.filter(F.pmod(F.xxhash64("lang", "words"), F.lit(every)) == 0).select("lang", "words")
    keys = sorted((lang, *words) for lang, words in zip(*sample.toArrow().to_pydict().values()))
    return sorted({keys[i * len(keys) // ranges] for i in range(1, ranges)}) if keys else []


def _places(key: tuple, borders: list[tuple]) -> list[int]:
    """The range of a key, and the later ones that its extensions reach into."""
    home = last = bisect_right(borders, key)
    while last < len(borders) and borders[last][: len(key)] == key:
        last += 1
    return list(range(home, last + 1))


def _dealt(borders: list[tuple]):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column("lang").to_pylist(), batch.column("words").to_pylist())
            places = [_places((lang, *words), borders) for lang, words in keys]
            rows = [i for i, p in enumerate(places) for _ in p]
            out = batch.take(pa.array(rows, pa.int64()))
            part = pa.array([x for p in places for x in p], pa.int32())
            home = pa.array([x == p[0] for p in places for x in p])
            yield pa.RecordBatch.from_arrays([*out.columns, part, home], [*batch.schema.names, "part", "home"])

    return deal


PHRASE = "lang string, words array<string>, n long, other_parts array<long>, other_extended long"
PHRASE_COLUMNS = [c.split()[0] for c in PHRASE.split(", ")]
STREAM = "lang string, words array<string>, n long, home boolean, parts array<long>, extended long, other_parts array<long>, other_extended long"
_COLUMNS = [c.split()[0] for c in STREAM.split(", ")]
_ARROW = pa.schema(
    zip(_COLUMNS, [pa.string(), pa.list_(pa.string()), pa.int64(), pa.bool_(), pa.list_(pa.int64()), pa.int64(),
                   pa.list_(pa.int64()), pa.int64()])
)


def _lockstep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One pass over a sorted stream: the counts of each phrase's first words, and its largest extension by a word.

    `opened` holds the phrases that may still be extended, each the start of the next.
    """
    opened: list[tuple[tuple, dict]] = []
    done: list[dict] = []
    part = None
    for batch in batches:
        for row in batch.to_pylist():
            key = (row["lang"], *row["words"])
            if row["part"] != part:
                part = row["part"]
                done += [above for _, above in opened]
                opened = []
            while opened and opened[-1][0] != key[: len(opened[-1][0])]:
                done.append(opened.pop()[1])
            row["parts"] = [above["n"] for _, above in opened]
            row["extended"] = 0
            if opened and len(opened[-1][0]) == len(key) - 1:
                above = opened[-1][1]
                above["extended"] = max(above["extended"], row["n"])
            opened.append((key, row))
        if len(done) >= ROWS_OUT:
            yield pa.RecordBatch.from_pylist(done, _ARROW)
            done = []
    done += [row for _, row in opened]
    if done:
        yield pa.RecordBatch.from_pylist(done, _ARROW)


def merge_stream(stream: DataFrame, total: int, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Add to phrases (lang, words, n, ...) the counts of their first words and their largest extension.

    The stream is cut into ranges of its order, of about `range_rows` phrases each, so a
    first word of very many phrases is no hot spot. A phrase whose extensions
    reach into later ranges is copied there (at most three for each border), and what the
    copies find comes back to it. `words` is in the order of the stream.
    """
    borders = _borders(stream, -(-total // range_rows), total)
    dealt = stream.select(*PHRASE_COLUMNS).mapInArrow(_dealt(borders), f"{PHRASE}, part int, home boolean")
    ordered = dealt.repartition(len(borders) + 1, "part").sortWithinPartitions("part", "lang", "words")
    merged = materialize(ordered.mapInArrow(_lockstep, STREAM), "stream")
    if not borders:
        return merged
    # at most three phrases for each border
    found = merged.filter("not home").groupBy("lang", "words").agg(F.max("extended").alias("there"))
    whole = merged.filter("home").join(F.broadcast(found), ["lang", "words"], "left")
    return whole.withColumn("extended", F.greatest("extended", F.coalesce("there", F.lit(0)))).drop("there")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = MIN_COUNT,
    covered: int = COVERED,
    scale: int = SCALE,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Phrases of 2 to 4 words that occur at least `min_count` times, scored by their weakest cut.

    Texts are lower-cased (A-Z only) and split at `.,;:!?` and line ends into pieces, those
    at blanks and tabs into words; a null or empty text has none. All is counted for
    each language on its own (null: "und"), over all rows, repeated rows and ids too, and
    overlapping occurrences count each. A cut after the first words gives
    floor(scale * a / (l + r)) with the counts l and r of both parts; the lowest
    cut counts, the first of equal ones. `within` says that a longer phrase holds this one
    and has at least `covered` percent of its count; it is enough to look at
    phrases longer by one word, which are at least as frequent as those that hold them.
    Result: lang, phrase, a, l, r, n (all words of the language), score, within. Other
    columns are not read; an empty table gives no rows. Products go through decimals of
    38 digits.
    """
    counts, totals = count_phrases(docs, text_col, lang_col, min_count)
    return score_phrases(counts, totals, covered, scale, range_rows)


def score_phrases(
    counts: DataFrame, totals: DataFrame, covered: int = COVERED, scale: int = SCALE, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """The scores of counted phrases (see `count_phrases`): every part of a phrase has its count too."""
    total = counts.count()
    start = counts.select(
        "lang", F.reverse(F.split("phrase", " ")).alias("words"), "n",
        F.lit(None).cast("array<bigint>").alias("other_parts"), F.lit(0).cast("long").alias("other_extended"),
    )
    by_suffix = merge_stream(start, total, range_rows)
    turned = by_suffix.select(
        "lang", F.reverse("words").alias("words"), "n", F.col("parts").alias("other_parts"),
        F.col("extended").alias("other_extended"),
    )
    both = merge_stream(turned, total, range_rows).filter(F.size("words") > 1)

    def wide(c: str) -> str:
        return f"cast({c} as decimal(20,0))"

    # parts: counts of the first 1, 2, .. words; other_parts: of the last 1, 2, .. words
    cuts = f"""transform(sequence(1, size(words) - 1), k -> struct(
        {wide('n')} * {scale}bd div ({wide('parts[k - 1]')} + {wide('other_parts[size(words) - k - 1]')}) as score,
        k as k, parts[k - 1] as l, other_parts[size(words) - k - 1] as r))"""
    longer = F.greatest("extended", "other_extended")
    within = (longer.cast("decimal(20,0)") * 100 >= F.col("n").cast("decimal(20,0)") * covered) & (longer > 0)
    scored = both.select("lang", "words", F.col("n").alias("a"), F.array_min(F.expr(cuts)).alias("cut"), within.alias("within"))
    return scored.join(totals, "lang").select(
        "lang", F.array_join("words", " ").alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score", "within"
    )


def best_phrases(scored: DataFrame, top: int = TOP) -> DataFrame:
    """The first phrases of each language that are not within a longer one, with their rank.

    By score and count, largest first, then by the bytes of the phrase.
    """
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = scored.filter(~F.col("within")).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


OP12_SQL = r"""
WITH pieces AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k)),
f AS (SELECT lang, k, phrase, count(*) AS n FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(n) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= 30),
cuts AS (
  SELECT c.lang, c.phrase, a, j, x.n AS l, y.n AS r,
         CAST(CAST(a AS HUGEINT) * 2000000 // (x.n + y.n) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:j], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[j + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_parts AS (
  SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, a, w, m, unnest(range(1, k - m + 2)) AS i
        FROM (SELECT *, unnest(range(2, k)) AS m FROM c))),
gone AS (SELECT DISTINCT b.lang, b.phrase FROM best b JOIN inner_parts p
         ON p.lang = b.lang AND p.phrase = b.phrase AND 100 * p.a >= 80 * b.a)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank,
       b.phrase, a, l, r, CAST(t.n AS BIGINT) AS n, score
FROM best b JOIN totals t USING (lang) ANTI JOIN gone g ON g.lang = b.lang AND g.phrase = b.phrase
QUALIFY rank <= 2000
"""


@query("op12_collocations", OP12_SQL)
def op12_collocations(spark, folder):
    """The 2000 phrases of each language that stick together most."""
    return best_phrases(collocations(table(spark, folder, "documents")))
