"""What a chain of steps leaves on disk, and the narrow lookups of runs."""

import os

import pytest
from pyspark.sql import functions as F

from gaugeworks import session
from gaugeworks.operators.asof import TimeSeries, asof_lookup
from gaugeworks.plans import jobs
from gaugeworks.session import materialize, settled
from gaugeworks.sources.tables import TENANT
from tests.test_states import STATE, H, runs, state


def folder(df):
    return os.path.dirname(df.inputFiles()[0].removeprefix("file://"))


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.size()))


def test_steps_go_when_the_result_is_written(spark):
    kept, seen = materialize(spark.range(3), "outside"), []

    def inner():
        seen.append(materialize(spark.range(5), "step"))
        return seen[0].join(kept, "id")

    def outer():
        seen.append(settled(inner, "inner"))
        seen.append(folder(seen[1]))
        return seen[1].withColumn("x", F.lit(1))

    out = settled(outer, "outer")
    assert out.count() == 3 and kept.count() == 3
    assert os.path.isdir(folder(kept)) and os.path.isdir(folder(out)) and not os.path.exists(seen[2])
    step = seen[0].inputFiles()[0].removeprefix("file://")
    assert not os.path.exists(step)


def test_steps_stay_when_the_write_fails(spark):
    seen = []

    def make():
        seen.append(materialize(spark.range(5), "step"))
        return seen[0].select(F.raise_error(F.lit("no")).cast("string").alias("x"))

    with pytest.raises(Exception, match="no"):
        settled(make)
    assert seen[0].count() == 5 and not session._open.steps


def test_shuffles_go_with_the_write(spark):
    before = shuffle_files(spark)
    out = materialize(spark.range(1000).repartition(3).groupBy(F.col("id") % 7).count(), "grouped")
    assert out.count() == 7
    before_read = spark.conf.get(session.CLEAN_SHUFFLES)
    assert shuffle_files(spark) <= before + 1 and before_read == "false"


def recorded(monkeypatch):
    frames = {}

    def record(df, name="stage"):
        frames.setdefault(name, []).append(df.columns)
        return materialize(df, name)

    monkeypatch.setattr(jobs, "materialize", record)
    return frames


def test_runs_find_last_known_and_next_values(spark, monkeypatch):
    frames = recorded(monkeypatch)

    def some(start, end, tags, rate, potential):
        row = list(state(start * H, end * H - 1, "RUNNING", 1.0))
        row[2], row[14], row[15] = tags, rate, potential
        return tuple(row)

    rows = [some(1, 2, None, None, 4.0), some(2, 3, "a", None, None), some(3, 4, None, None, 5.0), some(4, 6, None, 2.0, None)]
    states = spark.createDataFrame(rows, STATE)
    # 2.5 h: the next row is a run; 2.7 h: it is the state from 3 h on; 0.5 h: no state before; 9 h: none after
    at = {1: 0.5, 2: 1.5, 3: 2.5, 4: 2.7, 5: 3.5, 6: 4.5, 7: 9.0}
    df = runs(spark, [(i, "existing", int(s * H), int(s * H) + 60_000) for i, s in at.items()])
    got = {
        r.run_id: (r.unixTimeMS_state_start, r.cluster_tags, r.unit_rate, r.state_potential_core_H)
        for r in jobs.run_states(df, states, 10 * H).filter("lifecycleState = 'init'").collect()
    }
    keys = [TENANT, "cluster_id"]
    wide = states.select(
        *keys, "unixTimeMS_state_start", F.col("unixTimeMS_state_start").alias("t"), F.col("custom_tags").alias("tags"), "unit_rate",
        F.col("worker_potential_core_H").alias("p"),
    )
    left = TimeSeries(df.select("run_id", *keys, F.col("s").alias("t")), "t", keys)
    plain = asof_lookup(left, TimeSeries(wide, "t", keys), look_ahead=1, left_order=["run_id"])
    assert got == {r.run_id: (r.unixTimeMS_state_start, r.tags, r.unit_rate, r.p) for r in plain.collect()}
    assert got[3] == (2 * H, "a", None, 4.0) and got[5] == (3 * H, "a", 2.0, 5.0) and got[7] == (4 * H, "a", 2.0, 5.0)
    # the scan of runs and states and what follows it carry numbers of states, not their values
    assert not {c for name in ("cost-lookups", "cost-runs") for f in frames[name] for c in f} & set(jobs.STATE_VALUES)


def test_equal_runs_are_one_row_of_costs(spark):
    # twice the same run, and one whose other cluster type counts as the same
    df = runs(spark, [(1, "existing", H, 3 * H), (1, "existing", H, 3 * H), (1, None, H, 3 * H), (2, "new", H, 3 * H)])
    df = df.withColumn("job_name", F.when(F.col("run_id") == 2, "j"))
    states = spark.createDataFrame([state(0, 2 * H - 1, "RUNNING", 10.0), state(2 * H, 5 * H - 1, "RUNNING", 30.0)], STATE)
    got = {r.run_id: r for r in jobs.run_cost_fact(df, states, 6 * H).collect()}
    assert len(got) == 2 and got[1].run_cluster_states == 6 and got[2].run_cluster_states == 2
    assert got[1].cluster_type == "interactive" and got[2].cluster_type == "automated" and got[2].job_name == "j"
    assert [len(got[i].running_days) for i in (1, 2)] == [1, 1]


def test_run_lookups_carry_no_columns_of_the_runs(spark, monkeypatch):
    from tests.test_jobs import audit, start

    frames = recorded(monkeypatch)
    log = audit(spark, [(1, "runTriggered", None, {"runId": "1", "jobId": "5"}), start(20_000, 1)])
    spec = spark.createDataFrame([("t0", 10_000, "spec name", "c1")], f"{TENANT} string, timestamp long, cluster_name string, cluster_id string")
    snap = spark.sql(f"SELECT 't0' AS {TENANT}, timestamp_millis(5000) AS snapshot_ts, 'snap name' AS cluster_name, 'c1' AS cluster_id")
    status = spark.createDataFrame([("t0", 30_000, 5, "late", 1)], f"{TENANT} string, timestamp long, jobId long, jobName string, max_retries long")
    known = spark.sql(f"SELECT 't0' AS {TENANT}, timestamp_millis(5000) AS snapshot_ts, 5L AS job_id, named_struct('name', 'job') AS settings")
    out = jobs.job_runs(log, spec, snap, status, known).collect()
    assert [(r.cluster_name, r.jobName, r.max_retries) for r in out] == [("spec name", "job", None)]
    assert sorted(map(sorted, frames["run-lookup"])) == [["__row", "cluster_name"], ["__row", "jobName", "max_retries"]]
