"""From raw documents to packed training sequences.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which is written and read again as the docs of the next stage. All but
the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gaugeworks.llm.common import table
from gaugeworks.llm.line_dedup import deduplicate_lines
from gaugeworks.llm.mixing import mixed_documents
from gaugeworks.llm.packing import pack
from gaugeworks.llm.quality_classifier import keep_good
from gaugeworks.llm.simhash import keep_one_per_group
from gaugeworks.session import materialize


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; null and empty texts are scored too."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten or more of them share; a null text stays null."""
    return deduplicate_lines(docs)


def dedup_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints are linked: 4-word shingles, at most 4 differing bits.

    Null, empty and blank texts are one group, texts of fewer words one shingle. The document of the
    smallest id stays, a null id comes last; all columns stay as they are. An empty table gives no rows.
    """
    return keep_one_per_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources ask for; none of an empty table."""
    return mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 4096 tokens; a null text is an empty one."""
    return pack(docs)


STAGES = [
    ("quality_classifier", classify),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Scores of trained trees and tokenizer ids have no SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
