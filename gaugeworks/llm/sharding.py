"""Contiguous shards of nearly equal bytes from global prefix sums.

The rows are brought into id order by one range shuffle of three narrow columns
and written with their position. Totals of position blocks, their prefix sums,
and a running sum within each block give every row its global start; the byte
range of the corpus is cut at equal targets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import query, table, unsigned_crc32
from gaugeworks.session import materialize

# 2 ** BLOCK_BITS rows are one block: what a single window task sorts.
BLOCK_BITS = 16


def _positions(narrow: DataFrame, order: list[str]) -> DataFrame:
    """Rows in order with `pos`: partition number and row number in it, written once.

    Equal rows are dealt over partitions by the partition they come from.
    """
    salted = narrow.withColumn("from_part", F.spark_partition_id())
    ranged = salted.repartitionByRange(*order, "from_part").sortWithinPartitions(*order)
    return materialize(ranged.withColumn("pos", F.monotonically_increasing_id()), "shard-order")


def prefix_sums(rows: DataFrame, value: str) -> DataFrame:
    """Add `before` (sum of `value` over earlier rows), `rank` and `total` by `pos`.

    `total` is the sum over all rows. The summary has one row for each block.
    """
    block = F.shiftright("pos", BLOCK_BITS)
    blocks = rows.groupBy(block.alias("block")).agg(
        F.sum(value).alias("block_sum"), F.count(F.lit(1)).alias("block_rows")
    )
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("block_sum").over(earlier), F.lit(0)).alias("sum_before"),
        F.coalesce(F.sum("block_rows").over(earlier), F.lit(0)).alias("rows_before"),
        F.sum("block_sum").over(Window.partitionBy()).alias("total"),
    )
    inside = Window.partitionBy("block").orderBy("pos")
    running = rows.withColumn("block", block).select(
        "*",
        (F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col(value)).alias("in_block"),
        (F.row_number().over(inside) - 1).alias("row_in_block"),
    )
    return running.join(blocks, "block").select(
        *rows.columns,
        (F.col("sum_before") + F.col("in_block")).alias("before"),
        (F.col("rows_before") + F.col("row_in_block")).alias("rank"),
        "total",
    )


def cut(before: Column, size: Column, total: Column, shards: int) -> Column:
    """The target range in which the middle of a row's bytes lies."""
    middle = (before.cast("decimal(24,0)") * 2 + size) * F.lit(shards)
    return F.least(F.floor(middle / (total.cast("decimal(24,0)") * 2)).cast("int"), F.lit(shards - 1))


def byte_shards(
    docs: DataFrame,
    shards: int = 40,
    id_col: str = "doc_id",
    text_col: str = "text",
    row_bytes: int = 16,
) -> DataFrame:
    """Deal all rows, in id order, into contiguous shards of nearly equal bytes.

    Result: doc_id, size (UTF-8 bytes of the text plus `row_bytes`), text_crc32,
    law ("bytes"), shard, slot (place in its shard, gapless from 0), grown_shard
    (null: this law makes no promise about growth).

    A null text has no bytes and the checksum of an empty text. Null ids come
    first. Rows with the same id are ordered by checksum and size; rows equal in
    all three are interchangeable, and each gets its own slot. A row is in the
    shard that holds the middle of its bytes, so a shard misses its target by at
    most one row at either end; with a row larger than the target some shards
    stay empty. An empty table gives no rows. Other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text).cast("long") + row_bytes).alias("size"),
            unsigned_crc32(text).alias("text_crc32"),
        ),
        "shard-sizes",
    )
    placed = prefix_sums(_positions(narrow, ["doc_id", "text_crc32", "size"]), "size").withColumn(
        "shard", cut(F.col("before"), F.col("size"), F.col("total"), shards)
    )
    firsts = placed.groupBy("shard").agg(F.min("rank").alias("first_rank"))
    return placed.join(firsts, "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("rank") - F.col("first_rank")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op2_byte_shards")
def op2_byte_shards(spark, folder):
    """All documents in 40 contiguous shards of nearly equal bytes."""
    return byte_shards(table(spark, folder, "documents"))
