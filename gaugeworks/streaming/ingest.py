"""Structured Streaming: rate-limited ingest, drain and stop, recovery, upserts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from gaugeworks.operators.dedup import keep_first, row_hash
from gaugeworks.sources.tables import INSERT_ONLY, TENANT, TableSpec, exists, read_table, upsert, write_table

BATCH = "__batch"


def message_stream(
    spark: SparkSession, path: str, schema: T.StructType | str, tenant: str, run_id: str, *,
    max_files: int | None = None, fmt: str = "json", after: dt.datetime | int | None = None, event_time: str | None = None,
    late_ms: int = 0,
) -> DataFrame:
    """Messages landed as files, with body as text, tenant and run id.

    ``after`` (a time, or epoch milliseconds) goes on from an instant when a checkpoint was lost. Messages of that
    very instant are read again, since some may not have been read before; drop the
    copies by key (see ``resume_rows``). ``late_ms`` reads that much earlier.
    """
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    df = reader.load(path)
    if after is not None and event_time:
        low = after - (late_ms if isinstance(after, int) else dt.timedelta(milliseconds=late_ms))
        df = df.filter(F.col(event_time) >= F.lit(low))
    if "body" in df.columns:
        df = df.withColumn("deserializedBody", F.col("body").cast("string"))
    return df.withColumns({TENANT: F.lit(tenant), "run_id": F.lit(run_id)})


def append_stream(
    df: DataFrame, path: str, checkpoint: str, name: str, partition_by: list[str] | None = None
) -> StreamingQuery:
    """Append everything that is there now, then stop."""
    writer = df.writeStream.format("parquet").outputMode("append").queryName(name)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return (
        writer.option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True).start()
    )


class StopWhenQuiet(StreamingQueryListener):
    """Remembers when a batch had no more than a number of rows."""

    def __init__(self, query_name: str, min_rows: int):
        self.query_name, self.min_rows, self.quiet, self.run_id = query_name, min_rows, False, None

    def onQueryStarted(self, event):
        if event.name == self.query_name:
            self.run_id = event.runId

    def onQueryProgress(self, event):
        p = event.progress
        if p.name == self.query_name and p.numInputRows <= self.min_rows:
            self.quiet = True

    def onQueryIdle(self, event):
        if self.run_id is not None and event.runId == self.run_id:
            self.quiet = True

    def onQueryTerminated(self, event):
        pass


def run_until_quiet(
    df: DataFrame, path: str, checkpoint: str, name: str, min_rows: int, timeout_s: int | None,
    interval: str = "1 second",
) -> StreamingQuery:
    """Run a continuous query and stop it at the first quiet batch.

    After ``timeout_s`` seconds (None: never) it stops waiting for one, reads what
    is there and stops.
    """
    spark = df.sparkSession
    listener = StopWhenQuiet(name, min_rows)
    spark.streams.addListener(listener)
    query = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .queryName(name)
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(processingTime=interval)
        .start()
    )
    try:
        waited = 0
        while query.isActive and not listener.quiet and (timeout_s is None or waited < timeout_s):
            query.awaitTermination(1)
            waited += 1
        query.processAllAvailable()
    finally:
        query.stop()
        spark.streams.removeListener(listener)
    return query


def resume_rows(again: DataFrame, landed: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of a restarted read that had not landed before, each key once."""
    new = again.join(landed.select(*keys), reduce(and_, [again[k].eqNullSafe(landed[k]) for k in keys]), "left_anti")
    return keep_first(new, keys, [])


def resume_point(landed: DataFrame, event_time: str):
    """Newest event time already landed; where to go on without a checkpoint."""
    return landed.agg(F.max(event_time).alias("at")).first()["at"]


def _merge_batches(batches: DataFrame, spec: TableSpec, order: list) -> None:
    """Merge waiting batches as if one came after the other."""
    # a table that only takes new keys keeps the row of the first batch
    batch = F.col(BATCH).asc() if spec.scope == INSERT_ONLY else F.col(BATCH).desc()
    one = keep_first(batches, spec.match_keys, [batch, *order, row_hash(batches.drop(BATCH))]).drop(BATCH)
    if exists(batches.sparkSession, spec):
        upsert(one, spec)
    else:
        write_table(one, spec)


def upsert_stream(
    df: DataFrame, spec: TableSpec, checkpoint: str, order: list, prepare: Callable[[DataFrame], DataFrame] | None = None
) -> StreamingQuery:
    """Merge all batches that are there into a keyed table, then stop; a repeated batch changes nothing.

    A merge rewrites what it touches of the table, so one for every batch would cost the
    square of the rows. Batches wait in the checkpoint folder until they have as
    many rows as the table, and the last are merged before this returns. The folder also
    says up to which batch the table is merged, so what a lost run left is merged by the next.
    """
    spark = df.sparkSession
    waiting, merged = f"{checkpoint}/waiting", f"{checkpoint}/merged"

    def read(path: str) -> DataFrame | None:
        try:
            return spark.read.option("mergeSchema", "true").parquet(path)
        except AnalysisException:
            return None

    def table_rows() -> int:
        return read_table(spark, spec).count() if exists(spark, spec) else 0

    log = read(merged)
    until = -1 if log is None else log.agg(F.max("batch")).first()[0]
    left = read(waiting)
    facts = None if left is None else left.filter(F.col(BATCH) > until).agg(F.max(BATCH), F.count(F.lit(1))).first()
    last, rows = (until, 0) if facts is None or facts[0] is None else facts
    state = {"until": until, "last": last, "rows": rows, "table": table_rows()}

    def merge() -> None:
        if state["last"] == state["until"]:
            return
        batches = read(waiting).filter((F.col(BATCH) > state["until"]) & (F.col(BATCH) <= state["last"]))
        _merge_batches(batches, spec, order)
        spark.range(1).select(F.lit(state["last"]).cast("bigint").alias("batch")).write.mode("append").parquet(merged)
        state.update(until=state["last"], rows=0, table=table_rows())

    def take(batch: DataFrame, epoch: int) -> None:
        if epoch <= state["until"]:
            return
        path = f"{waiting}/{BATCH}={epoch}"
        again = epoch <= state["last"]
        (prepare(batch) if prepare else batch).write.mode("overwrite").parquet(path)
        state["last"] = epoch
        if not again:
            state["rows"] += spark.read.parquet(path).count()
        if state["rows"] >= state["table"]:
            merge()

    query = (
        df.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    finally:
        query.stop()
        merge()
    return query
