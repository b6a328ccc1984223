"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeats, clashing columns."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
# Names that the operators use inside.
CLASHING = "row k1 k2 fp id key pos block line lines shard size score epoch tokens domain bucket times kept".split()

PROSE = "the quick brown fox jumps over the lazy dog while seven wizards box with jugs of liquid near an old mill "


def docs_of(spark, rows):
    """Rows of (doc_id, text[, lang, source]) with the extra columns."""
    full = []
    for r in rows:
        doc_id, text, lang, source = (*r, "en", "src1")[: max(len(r), 2)] + ("en", "src1")[max(len(r), 2) - 2 :]
        full.append((doc_id, text, lang, source, None if text is None else len(text)))
    df = spark.createDataFrame(full, DOCS).repartition(3)
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHING})


def awkward(spark):
    long = " ".join(f"word{i % 977} and{i % 31}" for i in range(30_000))
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, PROSE * 2), (5, PROSE * 2), (6, (PROSE * 2).upper()),
        (7, long), (8, "one"), (8, "one"), (9, "é ü ß\nÉ Ü\x1cx <|endoftext|> it's"), (None, PROSE), (None, None),
        (10, PROSE * 2, None, None), (11, "\n".join(f"line {i}" for i in range(50)) + "\nShared Line "),
    ]
    rows += [(100 + i, f"  SHARED line\t\nown text of {i} " + PROSE) for i in range(12)]
    return docs_of(spark, rows)


def nothing(spark):
    return docs_of(spark, [(1, "x")]).filter("doc_id < 0")
