"""Stored tables: nothing is lost whatever the partition value, and upserts prune."""

import pytest
from pyspark.sql import functions as F

from gaugeworks.session import scratch_path
from gaugeworks.sources import tables
from gaugeworks.sources.tables import EMPTIED, TableSpec

VALUES = [None, "x", "a:b", "100%", "two words", "p=q/r"]


def stored(spark, rows, **more):
    spec = TableSpec("t", scratch_path(spark, "t"), ("id",), partition_by=("part",), **more)
    tables.write_table(frame(spark, rows), spec)
    return spec


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, part string, v string")


def content(spark, spec):
    return sorted(((r.id, r.part, r.v) for r in tables.read_table(spark, spec).collect()), key=str)


@pytest.mark.parametrize("part", VALUES)
def test_upsert_keeps_the_other_rows_of_a_partition(spark, part):
    spec = stored(spark, [(1, part, "a"), (2, part, "b"), (3, "other", "c")], mode="merge")
    for _ in range(2):
        tables.write_table(frame(spark, [(9, part, "new"), (2, part, "B")]), spec)
    assert content(spark, spec) == sorted([(1, part, "a"), (2, part, "B"), (9, part, "new"), (3, "other", "c")], key=str)


@pytest.mark.parametrize("part", VALUES)
def test_delete_empties_a_partition(spark, part):
    spec = stored(spark, [(1, part, "a"), (2, part, "b"), (3, "other", "c")], mode="merge")
    assert tables.delete_where(spark, spec, F.col("id") < 3) == 2
    assert content(spark, spec) == [(3, "other", "c")]
    assert EMPTIED not in tables.read_table(spark, spec).columns
    tables.write_table(frame(spark, [(7, part, "again")]), spec)
    assert content(spark, spec) == sorted([(3, "other", "c"), (7, part, "again")], key=str)
    tables.compact(spark, spec, ["id"])
    assert EMPTIED not in spark.read.parquet(spec.path).columns


def test_a_second_snapshot_is_a_copy(spark):
    spec = stored(spark, [(i, p, "v") for i, p in enumerate(VALUES)])
    root = scratch_path(spark, "copies")
    tables.snapshot_tables(spark, [spec], root)
    tables.delete_where(spark, spec, F.col("id") != 1)
    tables.snapshot_tables(spark, [spec], root)
    assert [(r.id, r.part) for r in spark.read.parquet(f"{root}/t").collect()] == [(1, "x")]


def test_partition_columns_are_not_changed_in_place(spark):
    spec = stored(spark, [(1, "x", "a")])
    with pytest.raises(ValueError):
        tables.update_where(spark, spec, F.col("id") == 1, {"part": F.lit("y")})
    tables.update_where(spark, spec, F.col("id") == 1, {"v": F.lit("b")})
    assert content(spark, spec) == [(1, "x", "b")]


def test_duplicates_go_and_whole_partitions_stay(spark):
    spec = stored(spark, [(1, None, "b"), (1, None, "a"), (2, "x", "c")], dedup=False)
    before = {r.f for r in spark.read.parquet(spec.path).filter("part = 'x'").select(F.input_file_name().alias("f")).collect()}
    report = tables.delete_duplicates(spark, spec, ["v"]).first()
    assert report.rows_dropped == 1 and content(spark, spec) == [(1, None, "a"), (2, "x", "c")]
    after = {r.f for r in spark.read.parquet(spec.path).filter("part = 'x'").select(F.input_file_name().alias("f")).collect()}
    assert before == after


@pytest.mark.parametrize("named", [1000, 0])
def test_an_upsert_reads_the_touched_partitions_only(spark, monkeypatch, named):
    monkeypatch.setattr(tables, "MAX_NAMED_VALUES", named)
    spec = stored(spark, [(i, f"p{i:02d}", "v") for i in range(30)])
    touched = frame(spark, [(3, "p03", "n"), (4, "p04", "n")]).select("part").distinct()
    part = tables.touched_part(spark, spec, touched)
    assert sorted(r.id for r in part.collect()) == [3, 4]
    plan = part._jdf.queryExecution().executedPlan().toString()
    line = next(x for x in plan.splitlines() if "PartitionFilters" in x)
    filters = line.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "p03" in filters and "p04" in filters
    assert len(part.inputFiles()) <= 30 and "p29" not in filters


def test_parts_of_a_shuffle_stay_small_however_large_the_table(spark, tmp_path):
    """A task must not sort tens of megabytes of packed rows."""
    from gaugeworks.session import configure

    configure(spark)
    rows = spark.range(0, 4_000_000, 1, 16).select("id", F.xxhash64("id").alias("v"), F.lit("one").alias("part"))
    rows.hint("rebalance", "part").write.parquet(f"{tmp_path}/r")
    assert len(list((tmp_path / "r").glob("*.parquet"))) > 2
