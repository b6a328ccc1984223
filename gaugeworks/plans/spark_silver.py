"""Silver tables of Spark events: starts paired with their ends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.timeutil import run_time
from gaugeworks.operators.dedup import keep_first
from gaugeworks.operators.joins import lag_join
from gaugeworks.operators.schema import project_properties
from gaugeworks.sources.tables import TENANT

CONTEXT = [TENANT, "clusterId", "SparkContextID"]
DAY = "fileCreateDate"
SQL_START = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart"
SQL_END = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionEnd"


def job_properties(vendor: str) -> dict:
    """Field names and the property keys they come from.

    Keys of the platform carry its name after ``spark``; it is a parameter.
    """
    v = f"spark{vendor}"
    tags = f"{v}clusterUsageTags"
    return {
        "AppName": "sparkappname",
        "WorkspaceURL": f"{v}apiurl",
        "JobGroupID": "sparkjobGroupid",
        "CloudProvider": f"{v}cloudProvider",
        "principalIdpObjectId": "principalIdpObjectId",
        "ClusterDetails": {
            "ClusterSource": f"{v}clusterSource",
            "AutoTerminationMinutes": f"{tags}autoTerminationMinutes",
            "ClusterTags": f"{tags}clusterAllTags",
            "ClusterAvailability": f"{tags}clusterAvailability",
            "ClusterID": f"{tags}clusterId",
            "InstancePoolID": f"{tags}clusterInstancePoolId",
            "MaxWorkers": f"{tags}clusterMaxWorkers",
            "MinWorkers": f"{tags}clusterMinWorkers",
            "Name": f"{tags}clusterName",
            "OwnerUserID": f"{tags}clusterOwnerUserId",
            "ScalingType": f"{tags}clusterScalingType",
            "SpotBidPricePercent": f"{tags}clusterSpotBidPricePercent",
            "TargetWorkers": f"{tags}clusterTargetWorkers",
            "ActualWorkers": f"{tags}clusterWorkers",
            "ZoneID": f"{tags}containerZoneId",
            "Region": f"{tags}dataPlaneRegion",
            "DriverNodeType": f"{tags}driverNodeType",
            "WorkerNodeType": f"{v}workerNodeTypeId",
            "SparkVersion": f"{tags}sparkVersion",
        },
        "NotebookID": f"{v}notebookid",
        "NotebookPath": f"{v}notebookpath",
        "SparkContextID": f"{v}sparkContextId",
        "DriverHostIP": "sparkdriverhost",
        "DriverMaxResults": "sparkdrivermaxResultSize",
        "ExecutorID": "sparkexecutorid",
        "ExecutorMemory": "sparkexecutormemory",
        "ExecutionID": "sparksqlexecutionid",
        "ExecutionParent": "sparksqlexecutionparent",
        "SparkDBIsolationID": f"{v}isolationID",
        "AzureOAuth2ClientID": "sparkhadoopfsazureaccountoauth2clientid",
        "RDDScope": "sparkrddscope",
        "SparkDBREPLID": f"{v}replId",
        "SparkDBJobID": f"{v}jobid",
        "SparkDBRunID": f"{v}jobrunId",
        "sparkDBJobType": f"{v}jobtype",
        "ShufflePartitions": "sparksqlshufflepartitions",
        "UserEmail": "user",
        "UserID": "userID",
    }


def pair(
    starts: DataFrame,
    ends: DataFrame,
    keys: list[str],
    start_ts: str,
    end_ts: str,
    from_ms: int,
    lag_days: int = 1,
) -> DataFrame:
    """Each start with its end, if it came within the lag; only new or newly closed ones.

    Events arrive at least once. Both sides are cut to one row per key before
    the join, so copies never multiply. The end with the earliest file date is
    the one most likely to be within the lag.
    """
    first = keep_first(starts, keys, [start_ts, DAY])
    last = keep_first(ends, keys, [DAY, end_ts])
    joined = lag_join(first, last, keys, DAY, lag_days=lag_days, how="left")
    return joined.filter(F.coalesce(F.col(end_ts), F.col(start_ts), F.lit(0)) >= from_ms)


def _timed(df: DataFrame, name: str, start: str, end: str, with_date: bool = True) -> DataFrame:
    df = df.withColumn(name, run_time(F.col(start), F.col(end))).drop(start, end, DAY)
    df = df.withColumn("startTimestamp", F.col(f"{name}.startEpochMS"))
    return df.withColumn("startDate", F.col(f"{name}.startTS").cast("date")) if with_date else df


def _events(df: DataFrame, event: str, *columns: Column | str) -> DataFrame:
    return df.filter(F.col("Event") == event).select(TENANT, DAY, "clusterId", "SparkContextID", *columns)


def _file(name: str) -> Column:
    return F.col("filenameGroup").alias(name)


def executors(lagged: DataFrame, new: DataFrame, from_ms: int) -> DataFrame:
    """Executors with the time they were alive; ends are looked for over 30 days."""
    added = _events(
        lagged, "SparkListenerExecutorAdded", "ExecutorID", "executorInfo",
        F.col("Timestamp").alias("addedTS"), _file("startFilenameGroup"),
    )
    removed = _events(
        new, "SparkListenerExecutorRemoved", "ExecutorID", "RemovedReason",
        F.col("Timestamp").alias("removedTS"), _file("endFilenameGroup"),
    )
    out = pair(added, removed, [*CONTEXT, "ExecutorID"], "addedTS", "removedTS", from_ms, 30)
    r = run_time(F.col("addedTS"), F.col("removedTS"))
    names = {
        "startEpochMS": "AddedEpochMS", "startTS": "AddedTS", "endEpochMS": "RemovedEpochMS", "endTS": "RemovedTS",
        "runTimeMS": "uptimeMS", "runTimeS": "uptimeS", "runTimeM": "uptimeM", "runTimeH": "uptimeH",
    }
    alive = F.struct(*[r.getField(a).alias(b) for a, b in names.items()])
    return out.withColumns({"ExecutorAliveTime": alive, "addedTimestamp": F.col("addedTS")}).drop("addedTS", "removedTS", DAY)


def sql_executions(lagged: DataFrame, new: DataFrame, from_ms: int) -> DataFrame:
    started = _events(
        lagged, SQL_START, "description", "details", F.col("executionId").alias("ExecutionID"),
        F.col("time").alias("startTime"), _file("startFilenameGroup"),
    )
    ended = _events(
        new, SQL_END, F.col("executionId").alias("ExecutionID"), F.col("time").alias("endTime"), _file("endFilenameGroup"),
    )
    out = pair(started, ended, [*CONTEXT, "ExecutionID"], "startTime", "endTime", from_ms)
    return _timed(out, "SqlExecutionRunTime", "startTime", "endTime", False)


def spark_jobs(lagged: DataFrame, new: DataFrame, from_ms: int, vendor: str) -> DataFrame:
    start = lagged.withColumn("PowerProperties", project_properties(F.col("Properties"), job_properties(vendor)))
    started = _events(
        start, "SparkListenerJobStart", "PowerProperties.JobGroupID", "PowerProperties.ExecutionID", "JobID",
        "StageIDs", "SubmissionTime", "PowerProperties", _file("startFilenameGroup"),
    )
    ended = _events(
        new, "SparkListenerJobEnd", "JobID", "JobResult", "CompletionTime", _file("endFilenameGroup")
    )
    out = pair(started, ended, [*CONTEXT, "JobID"], "SubmissionTime", "CompletionTime", from_ms)
    return _timed(out, "JobRunTime", "SubmissionTime", "CompletionTime")


def spark_stages(lagged: DataFrame, new: DataFrame, from_ms: int) -> DataFrame:
    started = _events(
        lagged, "SparkListenerStageSubmitted", "StageInfo.StageID", "StageInfo.StageAttemptID",
        "StageInfo.SubmissionTime", F.col("StageInfo").alias("s"), _file("startFilenameGroup"),
    )
    ended = _events(
        new, "SparkListenerStageCompleted", "StageInfo.StageID", "StageInfo.StageAttemptID",
        "StageInfo.CompletionTime", F.col("StageInfo").alias("e"), _file("endFilenameGroup"),
    )
    out = pair(started, ended, [*CONTEXT, "StageID", "StageAttemptID"], "SubmissionTime", "CompletionTime", from_ms)
    info = F.struct(
        "e.Accumulables", "e.CompletionTime", "s.Details", "s.FailureReason", "e.NumberofTasks", "s.ParentIDs",
        "s.SubmissionTime",
    )
    return _timed(out.withColumn("StageInfo", info).drop("s", "e"), "StageRunTime", "SubmissionTime", "CompletionTime")


TASK_KEYS = [*CONTEXT, "StageID", "StageAttemptID", "TaskID", "TaskAttempt", "ExecutorID", "Host"]


def spark_tasks(lagged: DataFrame, new: DataFrame, from_ms: int) -> DataFrame:
    ids = ["StageID", "StageAttemptID", "TaskInfo.TaskID", "TaskInfo.ExecutorID",
           F.col("TaskInfo.Attempt").alias("TaskAttempt"), "TaskInfo.Host"]
    started = _events(
        lagged, "SparkListenerTaskStart", *ids, "TaskInfo.LaunchTime", F.col("TaskInfo").alias("s"),
        _file("startFilenameGroup"),
    )
    ended = _events(
        new, "SparkListenerTaskEnd", *ids, "TaskInfo.FinishTime", F.col("TaskInfo").alias("e"), "TaskEndReason",
        "TaskMetrics", "TaskType", "TaskExecutorMetrics", _file("endFilenameGroup"),
    )
    out = pair(started, ended, TASK_KEYS, "LaunchTime", "FinishTime", from_ms)
    info = F.struct(
        "e.Accumulables", "e.Failed", "e.FinishTime", "e.GettingResultTime", "e.Host", "e.Index", "e.Killed",
        "s.LaunchTime", "e.Locality", "e.Speculative",
    )
    return _timed(out.withColumn("TaskInfo", info).drop("s", "e"), "TaskRunTime", "LaunchTime", "FinishTime")
