"""State sessions and marts on small hand-made telemetry."""

import datetime as dt

from pyspark.sql import functions as F

from gaugeworks.operators.sessions import reset_sessions
from gaugeworks.plans.clusters import cluster_state_detail
from gaugeworks.plans.jobs import new_and_open_runs, run_cost_fact
from gaugeworks.functions.timeutil import run_time

H = 3_600_000
EVENT = (
    "organization_id string, cluster_id string, timestamp long, type string, details struct<cluster_size: "
    "struct<autoscale: struct<max_workers: bigint, min_workers: bigint>, num_workers: bigint>, "
    "current_num_workers: bigint, target_num_workers: bigint>"
)


def event(t, kind, size=None, current=None, target=None, cluster="c"):
    return ("o", cluster, t, kind, ((((None, None), size)), current, target))


def states(spark, events, until):
    df = cluster_state_detail(spark.createDataFrame(events, EVENT), until)
    return sorted((r.asDict() for r in df.collect()), key=lambda r: (r["cluster_id"], r["unixTimeMS_state_start"]))


def test_states_of_one_life(spark):
    got = states(
        spark,
        [
            event(0, "CREATING", size=2),
            event(1 * H, "RUNNING", current=2),
            event(2 * H, "RESIZING", current=2, target=5),
            event(3 * H, "TERMINATING", current=0),
        ],
        4 * H,
    )
    assert [s["state"] for s in got] == ["CREATING", "RUNNING", "RESIZING", "TERMINATING"]
    assert [s["isRunning"] for s in got] == [True, True, True, False]
    assert [s["current_num_workers"] for s in got] == [2, 2, 2, 0]
    assert [s["target_num_workers"] for s in got] == [2, 2, 5, 0]
    assert [s["platform_billable"] for s in got] == [False, True, True, False]
    assert [s["unixTimeMS_state_end"] for s in got] == [H - 1, 2 * H - 1, 3 * H - 1, 4 * H]
    assert [s["uptime_since_restart_S"] for s in got][:3] == [(H - 1) / 1000, (2 * H - 2) / 1000, (3 * H - 3) / 1000]
    assert got[3]["uptime_since_restart_S"] == 0


def test_lost_termination_is_imputed(spark):
    got = states(spark, [event(0, "CREATING", size=1), event(H, "RUNNING", current=1), event(5 * H, "STARTING")], 6 * H)
    assert [(s["state"], s["unixTimeMS_state_start"]) for s in got] == [
        ("CREATING", 0), ("RUNNING", H), ("TERMINATING", H + 1), ("STARTING", 5 * H),
    ]
    assert [s["isRunning"] for s in got] == [True, True, False, True]
    assert got[3]["uptime_since_restart_S"] == 0  # the row after a termination resets the counter


def test_reset_sessions(spark):
    df = spark.createDataFrame([("a", i, i in (3, 6), i) for i in range(9)], "k string, t int, r boolean, v long")
    for by in (None, F.floor(F.col("t") / 2)):
        got = reset_sessions(df, ["k"], ["t"], F.col("r"), F.col("v"), by).orderBy("t").collect()
        assert [x["session_no"] for x in got] == [0, 0, 0, 1, 1, 1, 2, 2, 2]
        assert [x["session_total"] for x in got] == [0, 1, 3, 3, 7, 12, 6, 13, 21]


STATE = (
    "organization_id string, cluster_id string, custom_tags string, unixTimeMS_state_start long, "
    "unixTimeMS_state_end long, state string, cloud_billable boolean, platform_billable boolean, "
    "uptime_in_state_H double, current_num_workers long, target_num_workers long, "
    "driverSpecs struct<API_Name: string>, workerSpecs struct<API_Name: string>, isAutomated boolean, "
    "unit_rate double, worker_potential_core_H double, driver_compute_cost double, worker_compute_cost double, "
    "driver_unit_cost double, worker_unit_cost double, total_units double"
)


def state(start, end, name, cost, cluster="c"):
    hours = (end - start) / H
    return ("o", cluster, None, start, end, name, True, True, hours, 1, 1, ("d",), ("w",), False, 1.0,
            hours * 4, cost, cost, cost, cost, cost)


def runs(spark, rows):
    df = spark.createDataFrame(rows, "run_id long, cluster_type string, s long, e long")
    none = {c: F.lit(None).cast("string") for c in (
        "workspace_name", "job_name", "task_key", "run_name", "cluster_name", "terminal_state", "job_trigger_type",
        "task_type", "created_by", "last_edited_by")}
    ids = {c: F.lit(None).cast("long") for c in ("job_id", "job_run_id", "task_run_id", "repair_id",
                                                "multitask_parent_run_id", "parent_run_id")}
    r = run_time(F.col("s"), F.col("e"))
    return df.withColumns({**none, **ids, "organization_id": F.lit("o"), "cluster_id": F.lit("c"),
                           "startEpochMS": F.col("s"), "task_runtime": r, "task_execution_runtime": r})


def costs(spark, run_rows, state_rows, until):
    out = run_cost_fact(runs(spark, run_rows), spark.createDataFrame(state_rows, STATE), until)
    return {r["run_id"]: r.asDict() for r in out.collect()}


def test_run_over_three_states_on_its_own_cluster(spark):
    got = costs(
        spark,
        [(1, "new", H, 6 * H)],
        [state(0, 2 * H - 1, "CREATING", 10.0), state(2 * H, 4 * H - 1, "RUNNING", 20.0), state(4 * H, 8 * H - 1, "RUNNING", 40.0)],
        9 * H,
    )[1]
    assert got["run_cluster_states"] == 3 and got["avg_cluster_share"] == 1.0
    # whole first and second state, half of the third
    assert abs(got["driver_compute_cost"] - (10 + 20 + 20)) < 0.01
    assert abs(got["total_cost"] - 4 * got["driver_compute_cost"]) < 0.001


def test_two_runs_share_an_interactive_cluster(spark):
    got = costs(
        spark,
        [(1, "existing", H, 3 * H), (2, "existing", 2 * H, 4 * H)],
        [state(0, 10 * H, "RUNNING", 100.0)],
        11 * H,
    )
    # run 1: own two hours and run 2 that starts during and ends after
    cum1 = 2 * H + (10 * H - H)
    cum2 = 2 * H + (3 * H - 0)
    for run, cum in ((1, cum1), (2, cum2)):
        assert got[run]["max_overlapping_runs"] == 1.0
        share = round(2 * H / cum, 4)
        assert abs(got[run]["avg_cluster_share"] - share) < 1e-9
        assert abs(got[run]["driver_compute_cost"] - 100 * 0.2 * 2 * H / cum) < 1e-5


def test_open_run_is_costed_until_now_and_again_later(spark):
    st = [state(0, 4 * H, "RUNNING", 40.0)]
    first = costs(spark, [(1, "existing", H, None)], st, 3 * H)[1]
    assert first["openRun"] and abs(first["driver_compute_cost"] - 20.0) < 1e-6
    all_runs = runs(spark, [(1, "existing", H, 4 * H), (2, "existing", 5 * H, 6 * H), (3, "existing", 0, H)])
    earlier = spark.createDataFrame([("o", 1, True), ("o", 3, False)], "organization_id string, run_id long, openRun boolean")
    todo = new_and_open_runs(all_runs, earlier, 5 * H)
    assert sorted(r["run_id"] for r in todo.collect()) == [1, 2]


def test_costs_of_single_runs_stay_within_the_state(spark):
    st = [state(i * H, (i + 1) * H - 1, "RUNNING", 10.0) for i in range(6)]
    got = costs(spark, [(1, "new", int(1.5 * H), int(4.2 * H))], st, 7 * H)[1]
    assert got["driver_compute_cost"] <= 60.0


def test_missing_days(spark):
    from gaugeworks.operators.quality import missing_days

    df = spark.createDataFrame([(dt.date(2024, 1, 2),)], "d date")
    got = [r["day"] for r in missing_days(df, F.col("d"), dt.date(2024, 1, 1), dt.date(2024, 1, 4)).orderBy("day").collect()]
    assert got == [dt.date(2024, 1, 1), dt.date(2024, 1, 3)]
