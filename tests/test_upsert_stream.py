"""Streams that are merged into a keyed table."""

import pytest
from conftest import rows
from gaugeworks.session import scratch_path
from gaugeworks.sources.tables import FULL, INSERT_ONLY, UPDATE_ONLY, TableSpec, read_table, write_table
from gaugeworks.streaming import ingest
from pyspark.sql import functions as F

SCHEMA = "id int, part string, at int, v int"


def land(spark, path, batches):
    for found in batches:
        spark.createDataFrame(found, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def run(spark, path, spec, checkpoint, prepare=None):
    s = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    return ingest.upsert_stream(s, spec, checkpoint, [F.col("at")], prepare)


def table(spark, scope=FULL):
    return TableSpec("kept", scratch_path(spark, "kept"), ("id",), partition_by=("part",), mode="merge", scope=scope)


def test_merges_do_not_grow_with_the_batches(spark, monkeypatch):
    written = []
    for name in ("upsert", "write_table"):
        made = getattr(ingest, name)
        monkeypatch.setattr(ingest, name, lambda df, spec, made=made: (written.append(df.count()), made(df, spec)))
    spec, path = table(spark), scratch_path(spark, "in")
    land(spark, path, [[(i, "a", 1, i)] for i in range(8)] + [[(i, "a", 1, i)] for i in range(8)])
    run(spark, path, spec, scratch_path(spark, "check")).awaitTermination()
    assert rows(read_table(spark, spec).select("id", "v")) == [(i, i) for i in range(8)]
    assert len(written) <= 6  # was one for each of the 16 batches


@pytest.mark.parametrize(("scope", "v"), [(FULL, 5), (INSERT_ONLY, 1), (UPDATE_ONLY, 5)])
def test_batches_count_in_their_order(spark, scope, v):
    """Within a batch the first by time counts, between batches the last, or where only new keys are taken the first."""
    spec, path, check = table(spark, scope), scratch_path(spark, "in"), scratch_path(spark, "check")
    write_table(spark.createDataFrame([(i, "a", 0, 0) for i in range(10, 20)] + [(1, "a", 0, 0)] * (scope == UPDATE_ONLY), SCHEMA), spec)
    for found in [[(1, "a", 3, 1), (1, "a", 4, 2), (None, "a", 1, 7)], [(1, "a", 9, 3)], [(1, "a", 2, 5), (1, "a", 3, 6)]]:
        land(spark, path, [found])
        run(spark, path, spec, check).awaitTermination()  # a run for each batch; files of one instant have no order
    got = {r.id: r.v for r in read_table(spark, spec).filter("id is null or id < 10").collect()}
    assert got == ({1: v} if scope == UPDATE_ONLY else {1: v, None: 7})


def test_waiting_batches_are_merged_in_order(spark):
    spec = table(spark)
    waiting = spark.createDataFrame([(0, 1, "a", 1, 1), (2, 1, "a", 9, 3), (1, 1, "a", 0, 2), (2, 1, "a", 8, 4)], f"{ingest.BATCH} int, {SCHEMA}")
    ingest._merge_batches(waiting, spec, [F.col("at")])
    assert rows(read_table(spark, spec).select("id", "v")) == [(1, 4)]


def test_a_failed_run_keeps_what_came_before(spark):
    spec, path, check = table(spark), scratch_path(spark, "in"), scratch_path(spark, "check")
    write_table(spark.createDataFrame([(i, "a", 0, 0) for i in range(10, 20)], SCHEMA), spec)
    land(spark, path, [[(1, "a", 1, 1)], [(2, "a", 1, 2)], [(3, "a", 1, 3)]])
    taken = []

    def fails_third(batch):
        taken.append(batch)
        if len(taken) == 3:
            raise ValueError("broken batch")
        return batch

    with pytest.raises(Exception, match="broken batch"):
        run(spark, path, spec, check, fails_third).awaitTermination()
    assert read_table(spark, spec).filter("id < 10").count() == 2
    run(spark, path, spec, check).awaitTermination()
    assert rows(read_table(spark, spec).filter("id < 10").select("id", "v")) == [(1, 1), (2, 2), (3, 3)]
