import pytest
from pyspark.sql import functions as F

from gaugeworks.sources import runstate, tables
from gaugeworks.sources.tables import TENANT, TableSpec

DAY = 86_400_000
RUN = f"{TENANT} string, module_id int, from_ts long, until_ts long, status string, run_id string"


def state(spark, rows):
    full = [(t, m, f * DAY, u * DAY, s, f"r{i}") for i, (t, m, f, u, s) in enumerate(rows)]
    return spark.createDataFrame(full, RUN).withColumns(
        {"workspace_name": F.lit("w"), "module_name": F.lit("m"), "metrics": F.lit(None).cast("map<string,string>"),
         "snapshot_ts": F.timestamp_millis("until_ts")}
    )


def windows(spark, rows, modules, needs, max_days=10, snapshot=100, primordial=50):
    m = spark.createDataFrame(modules, f"{TENANT} string, module_id int, history_days int")
    n = spark.createDataFrame(needs, "module_id int, needs int")
    out = runstate.run_windows(state(spark, rows), m, n, primordial * DAY, snapshot * DAY, max_days)
    return {(r[TENANT], r.module_id): (r.first_run, r.from_ts / DAY, r.until_ts / DAY, r.held_by) for r in out.collect()}


def test_first_runs_and_slowest_module(spark):
    rows = [("a", 1, 0, 60, "SUCCESS"), ("a", 1, 60, 70, "FAILED"), ("a", 2, 0, 95, "EMPTY"), ("a", 5, 0, 63, "SUCCESS")]
    modules = [("a", 1, None), ("a", 2, None), ("a", 3, None), ("a", 4, 7), ("b", 1, None), ("b", 3, None)]
    needs = [(3, 2), (2, 1), (4, 5), (4, 1)]
    got = windows(spark, rows, modules, needs)
    assert got == {
        ("a", 1): (False, 60, 70, None),
        # stands ahead of what it needs: an empty window
        ("a", 2): (False, 95, 95, 1),
        # never ran; module 1 holds it back over module 2, but its own limit is nearer
        ("a", 3): (True, 50, 60, None),
        # its source goes back seven days; module 5 does not run and ends before
        ("a", 4): (True, 93, 93, 5),
        ("b", 1): (True, 50, 60, None),
        # module 2 never ran for this tenant and will not
        ("b", 3): (True, 50, 50, 2),
    }


def test_snapshot_limits_and_long_chains(spark):
    rows = [("a", i, 0, 90 + i, "SUCCESS") for i in range(9)]
    got = windows(spark, rows, [("a", i, None) for i in range(10)], [(i + 1, i) for i in range(9)])
    assert got[("a", 8)] == (False, 98, 100, None) and got[("a", 9)] == (True, 50, 60, None)
    got = windows(spark, rows, [("a", i, None) for i in range(10)], [(i + 1, i) for i in range(9)], max_days=3)
    assert got[("a", 8)] == (False, 98, 98, 0) and got[("a", 3)] == (False, 93, 93, 0)


def test_ring_and_nothing(spark):
    with pytest.raises(ValueError):
        windows(spark, [], [("a", 1, None)], [(1, 2), (2, 3), (3, 1)])
    assert windows(spark, [], [("a", 1, None)], []) == {("a", 1): (True, 50, 60, None)}


def test_rollback_joins_its_plan(spark, tmp_path):
    spec = runstate.run_state_table(f"{tmp_path}/state")
    rows = [(f"t{i}", m, 10 * n, 10 * n + 10, "SUCCESS") for i in range(40) for m in (1, 2) for n in range(3)]
    runstate.record_run(state(spark, rows), spec)
    data = {}
    for m in (1, 2):
        data[m] = TableSpec(f"d{m}", f"{tmp_path}/d{m}", ("id",), ("at",), (TENANT,))
        df = spark.range(1200).select("id", F.concat(F.lit("t"), F.col("id") % 40).alias(TENANT), (F.col("id") % 30 * DAY).alias("at"))
        tables.write_layout(df.unionByName(spark.createDataFrame([(5000, None, 0)], f"id long, {TENANT} string, at long")), data[m]).write.partitionBy(TENANT).parquet(data[m].path)
    args = (spark, spec, data, 15 * DAY, [f"t{i}" for i in range(39)])
    plan = runstate.rollback_to(*args)
    assert plan.count() == 78 and {r.rollback_ts for r in plan.collect()} == {10 * DAY}
    assert tables.read_table(spark, data[1]).count() == 1201
    runstate.rollback_to(*args, dry_run=False)
    for m in (1, 2):
        left = tables.read_table(spark, data[m]).collect()
        assert sorted(r.id for r in left) == sorted([i for i in range(1200) if i % 40 == 39 or i % 30 < 10] + [5000])
    marks = tables.read_table(spark, spec).groupBy("status").count().collect()
    assert {r.status: r["count"] for r in marks} == {"SUCCESS": 39 * 2 + 6, "ROLLED BACK - SUCCESS": 39 * 4}


def test_folders_of_the_run_state_do_not_grow_with_tenants(spark, tmp_path):
    spec = runstate.run_state_table(f"{tmp_path}/many")
    rows = [(f"t{i}", 1, 0, 10, "SUCCESS") for i in range(300)] + [(None, 1, 0, 10, "SUCCESS")]
    runstate.record_run(state(spark, rows), spec)
    assert len(list((tmp_path / "many").glob("*=*"))) <= runstate.TENANT_BUCKETS
    stored = tables.read_table(spark, spec)
    assert stored.count() == 301 and runstate.latest_runs(stored).count() == 301
