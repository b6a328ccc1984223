from pyspark.sql import functions as F

from gaugeworks.plans import jobs
from gaugeworks.sources.tables import TENANT

PARAMS = ["runId", "run_id", "jobId", "job_id", "multitaskParentRunId", "taskKey", "repairId", "jobTerminalState",
          "jobTriggerType", "clusterId", "run_name", "tasks", "notebook_params", "jar_params", "rerun_tasks"]


def audit(spark, rows):
    """Rows of (time, action, result, parameters)."""
    full = [
        ("t0", at, "jobs", action, f"r{i}", "s", "ip", "agent", ("me@x",), (result, 200), tuple(p.get(n) for n in PARAMS))
        for i, (at, action, result, p) in enumerate(rows)
    ]
    schema = (
        f"{TENANT} string, timestamp long, serviceName string, actionName string, requestId string, sessionId string, "
        "sourceIPAddress string, userAgent string, userIdentity struct<email:string>, "
        "response struct<result:string,statusCode:long>, requestParams struct<" + ",".join(f"{n}:string" for n in PARAMS) + ">"
    )
    return spark.createDataFrame(full, schema).repartition(3)


def start(at, run, **more):
    return (at, "runStart", None, {"runId": str(run), "jobId": "5", "clusterId": "c1", **more})


def by_run(spark, rows):
    return {r.runId: r for r in jobs.runs_base(audit(spark, rows)).collect()}


def test_first_record_of_each_kind_counts(spark):
    rows = [
        (10, "runNow", '{"run_id":1}', {"job_id": "5", "notebook_params": '{"a":"b"}', "jar_params": '["x"]', "run_name": "not of this action"}),
        (9, "cancel", None, {"run_id": "1"}),
        (30, "cancel", None, {"run_id": "1"}),
        start(12, 1),
        start(11, 1, clusterId="c0"),
        (20, "runFailed", None, {"runId": "1", "jobTerminalState": "Failed"}),
        (19, "runSucceeded", None, {"runId": "1", "jobTerminalState": "Succeeded"}),
        (8, "runStart", None, {"runId": None}),
        (8, "runNow", "not JSON", {}),
    ]
    got = by_run(spark, rows)
    assert set(got) == {1}
    r = got[1]
    assert (r.clusterId, r.timestamp, r.terminalState, r.jobTriggerType, r.run_name) == ("c0", 11, "Cancelled", "manual", None)
    assert r.timeDetails.completionTime == 19 and r.timeDetails.cancellationTime == 9 and r.TaskRunTime.endEpochMS == 19
    assert r.manual_override_params.jar_params == ["x"] and r.manual_override_params.notebook_params == '{"a":"b"}'
    assert r.requestDetails.submissionRequest.submitSessionId == "s"


def test_tasks_repairs_and_unstarted_runs(spark):
    rows = [
        (1, "submitRun", '{"run_id":1}', {"run_name": "mine", "tasks": "[]"}),
        start(2, 11, multitaskParentRunId="1", taskKey="a", repairId="7"),
        start(2, 12, multitaskParentRunId="1", taskKey="b", repairId="8"),
        (3, "runSucceeded", None, {"runId": "11", "multitaskParentRunId": "1", "jobTerminalState": "Succeeded"}),
        (3, "runSucceeded", None, {"runId": "12", "multitaskParentRunId": "2", "jobTerminalState": "of another run"}),
        (4, "repairRun", '{"repair_id":7}', {"run_id": "11", "rerun_tasks": '["a"]'}),
        (4, "repairRun", '{"repair_id":9}', {"run_id": "12"}),
        (5, "cancel", None, {"run_id": "1"}),
        (6, "runTriggered", None, {"runId": "3", "jobId": "6", "jobTriggerType": "cron"}),
        (7, "cancel", None, {"run_id": "3"}),
        start(8, 99),
    ]
    got = by_run(spark, rows)
    assert set(got) == {11, 12, 3}
    assert {(r.jobRunId, r.taskRunId, r.taskKey, r.run_name) for r in got.values()} == {(1, 11, "a", "mine"), (1, 12, "b", "mine"), (3, None, None, None)}
    assert [got[i].terminalState for i in (11, 12, 3)] == ["Succeeded", None, "Cancelled"]
    assert got[11].repair_details[0].rerun_tasks == '["a"]' and got[12].repair_details is None and got[12].repairId == 8
    assert (got[3].jobId, got[3].jobTriggerType, got[3].startEpochMS) == (6, "cron", None)
    assert got[3].requestDetails.submissionRequest.submitSessionId is None


def test_audit_log_is_read_once(spark):
    plan = jobs.run_records(audit(spark, [start(1, 1)]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1 and "Join" not in plan and "Window" not in plan


def test_nested_runs(spark):
    rows = [(1, None, None, 10), (2, 1, None, 11), (3, 1, None, 12), (4, None, '{"root_run_id":1}', 13), (5, None, None, 14)]
    runs = spark.createDataFrame(rows, "runId long, parentRunId long, workflow_context string, startEpochMS long")
    runs = runs.withColumns({TENANT: F.lit("t0"), "taskRunId": F.col("runId")})
    got = {r.runId: r for r in jobs.nest_runs(runs).collect()}
    assert set(got) == {1, 5} and [c.runId for c in got[1].children] == [2, 3]
    assert [c.runId for c in got[1].workflow_children] == [4] and got[5].children is None
