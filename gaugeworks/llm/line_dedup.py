"""Drop lines that many documents share."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.llm.common import BLANKS, ascii_lower, query, small_batches, table, text_key

MIN_CHARS = 1
MIN_DOCS = 10


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z lower-cased."""
    return F.btrim(ascii_lower(line), F.lit(BLANKS))


_LINES = T.StructType().add("kept", T.StringType()).add("n_lines", T.LongType()).add("n_dropped", T.LongType())


@F.pandas_udf(_LINES)
def _without(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, positions in batches:
        out = []
        for text, gone in zip(texts, positions):
            lines = ("" if text is None else text).split("\n")
            if gone is None or len(gone) == 0:
                out.append((text, len(lines), 0))
                continue
            drop = set(gone)
            kept = [x for i, x in enumerate(lines) if i not in drop]
            out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
        yield pd.DataFrame(out, columns=["kept", "n_lines", "n_dropped"])


def shared_lines(
    docs: DataFrame, text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """Positions of the lines to drop, by text: (k1, k2, dropped array<int>).

    Lines are exploded, normalised and hashed to 128 bits; within a document each
    hash counts once, so documents per hash are a plain count that is summed
    before the shuffle, and a line of very many documents is one row a task.
    """
    k1, k2 = text_key(F.col(text_col))
    lines = (
        docs.select(k1.alias("k1"), k2.alias("k2"), F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("pos", "line"))
        .withColumn("line", line_key(F.col("line")))
        .filter(F.char_length("line") >= min_chars)
        .select("k1", "k2", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("line"), "line").alias("h2"))
    )
    keys = F.transform(F.split(ascii_lower(F.col(text_col)), "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)))
    keyed = (
        docs.select(F.explode(F.array_distinct(keys)).alias("line"))
        .filter(F.char_length("line") >= min_chars)
        .select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("line"), "line").alias("h2"))
    )
    shared = keyed.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs")).filter(F.col("n_docs") >= min_docs)
    hits = lines.join(shared.select("h1", "h2"), ["h1", "h2"])
    return hits.groupBy("k1", "k2").agg(F.collect_set("pos").alias("dropped"))


def drop_shared_lines(
    docs: DataFrame, text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS
) -> DataFrame:
    """All rows of `docs` with `kept`, `n_lines` and `n_dropped` in a struct `lines`.

    A line's key has no blanks at its ends and A-Z lower-cased. Keys of at least
    `min_chars` code points in at least `min_docs` documents lose all their lines
    in every document; the others stay as they are, in order. Each row counts as
    one document, also when ids or whole rows repeat. A null text stays null and
    counts as one empty line; an empty text is one empty line; a text that loses
    all lines becomes empty. No column of `docs` but the text is looked at, and
    all columns come back in the struct `row`. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    gone = shared_lines(docs, text_col, min_chars, min_docs)
    k1, k2 = text_key(F.col(text_col))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), k1.alias("k1"), k2.alias("k2"))
    joined = rows.join(gone, ["k1", "k2"], "left")
    return joined.select("row", _without(F.col(f"row.`{text_col}`"), F.col("dropped")).alias("lines"))


def deduplicate_lines(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The columns of `docs`, with the text (and its length) after the dropping."""
    done = drop_shared_lines(docs, text_col)
    out = []
    for f in docs.schema.fields:
        if f.name == text_col:
            c = F.col("lines.kept")
        elif f.name == chars_col and isinstance(f.dataType, T.IntegralType):
            c = F.when(F.col("lines.n_dropped") > 0, F.char_length("lines.kept").cast(f.dataType)).otherwise(
                F.col(f"row.`{f.name}`")
            )
        else:
            c = F.col(f"row.`{f.name}`")
        out.append(c.alias(f.name))
    return done.select(*out)


OP9_SQL = r"""
WITH lines AS (
  SELECT row_no, doc_id, n_lines, u.pos AS pos, u.line AS line,
         translate(trim(u.line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT row_no, doc_id, len(a) AS n_lines,
               unnest([{'pos': i, 'line': a[i]} FOR i IN range(1, len(a) + 1)]) AS u
        FROM (SELECT row_number() OVER () AS row_no, doc_id,
                     string_split(coalesce(text, ''), chr(10)) AS a FROM documents))),
shared AS (
  SELECT k FROM lines WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT row_no) >= 10)
SELECT any_value(doc_id) AS doc_id,
       any_value(n_lines) AS n_lines,
       count(*) FILTER (k IN (SELECT k FROM shared)) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos)
                       FILTER (k NOT IN (SELECT k FROM shared)), '')) AS kept_sha256
FROM lines GROUP BY row_no
"""


@query("op9_line_dedup", OP9_SQL)
def op9_line_dedup(spark, folder):
    """Every document without the lines that ten documents or more share, as a digest."""
    done = drop_shared_lines(table(spark, folder, "documents"))
    return done.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("lines.n_lines").alias("n_lines"),
        F.col("lines.n_dropped").alias("n_dropped"),
        F.sha2(F.coalesce(F.col("lines.kept"), F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )
