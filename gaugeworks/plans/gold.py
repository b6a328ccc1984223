"""Gold tables: renamed projections of silver, user attribution, streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.text import job_id_of_group, run_id_of_group, stream_details
from gaugeworks.functions.timeutil import day_of_ms, to_ts, ts_to_epoch_milli
from gaugeworks.operators import schema as S
from gaugeworks.operators.aggregates import ordered_list
from gaugeworks.operators.dedup import keep_first
from gaugeworks.operators.fill import fill_forward, fill_from_groups
from gaugeworks.plans.accounts import logins_with_user
from gaugeworks.session import materialize
from gaugeworks.sources.tables import TENANT

STREAM_EVENTS = "org.apache.spark.sql.streaming.StreamingQueryListener"


def _renamed(df: DataFrame, columns: dict[str, str], extra: list[Column] | None = None) -> DataFrame:
    """Columns by new name; those the frame lacks are left out."""
    have = set(df.columns)
    return df.select(*[F.col(src).alias(new) for new, src in columns.items() if src in have], *(extra or []))


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def _times(ms: str) -> list[Column]:
    at = to_ts(F.col(ms))
    return [F.col(ms).alias("unixTimeMS"), at.alias("timestamp"), at.cast("date").alias("date")]


def cluster(spec: DataFrame) -> DataFrame:
    return _renamed(
        spec,
        {
            **_same(TENANT, "cluster_id", "cluster_name", "num_workers", "autoscale", "enable_elastic_disk"),
            "action": "actionName",
            "driver_node_type": "driver_node_type_id",
            "node_type": "node_type_id",
            "auto_termination_minutes": "autotermination_minutes",
            **_same(
                "is_automated", "cluster_type", "security_profile", "cluster_log_conf", "init_scripts", "custom_tags",
                "cluster_source", "aws_attributes", "azure_attributes", "spark_env_vars", "spark_conf",
                "acl_path_prefix", "driver_instance_pool_id", "instance_pool_id", "driver_instance_pool_name",
                "instance_pool_name", "spark_version", "runtime_engine", "idempotency_token", "deleted_by",
            ),
            "created_by": "createdBy",
            "last_edited_by": "lastEditedBy",
        },
        _times("timestamp"),
    )


def job(status: DataFrame) -> DataFrame:
    dlt = F.coalesce(F.col("is_from_dlt").try_cast("boolean"), F.lit(False)) if "is_from_dlt" in status.columns else F.lit(False)
    return _renamed(
        status,
        {
            **_same(TENANT, "workspace_name"),
            "job_id": "jobId", "action": "actionName", "job_name": "jobName",
            **_same("tags", "job_type"),
            "job_format": "format",
            **_same(
                "existing_cluster_id", "new_cluster", "tasks", "job_clusters", "libraries", "git_source",
                "timeout_seconds", "max_concurrent_runs", "max_retries", "retry_on_timeout",
                "min_retry_interval_millis", "schedule", "task_detail_legacy", "aclPermissionSet", "targetUserId",
            ),
            "session_id": "sessionId", "request_id": "requestId", "user_agent": "userAgent", "response": "response",
            "source_ip_address": "sourceIPAddress",
            **_same("created_by", "created_ts", "deleted_by", "deleted_ts", "last_edited_by", "last_edited_ts"),
        },
        [*_times("timestamp"), dlt.alias("is_from_dlt")],
    )


def job_run(runs: DataFrame) -> DataFrame:
    return _renamed(
        runs,
        {
            **_same(TENANT, "workspace_name"),
            "job_id": "jobId", "job_name": "jobName", "tags": "tags", "run_id": "runId", "job_run_id": "jobRunId",
            "task_run_id": "taskRunId", "task_key": "taskKey", "cluster_id": "clusterId",
            "cluster_name": "cluster_name", "multitask_parent_run_id": "multitaskParentRunId",
            "parent_run_id": "parentRunId", "task_detail": "task_detail", "task_dependencies": "taskDependencies",
            "task_runtime": "TaskRunTime", "task_execution_runtime": "TaskExecutionRunTime",
            "job_cluster_key": "job_cluster_key", "cluster_type": "clusterType", "job_cluster": "job_cluster",
            "new_cluster": "new_cluster", "task_type": "taskType", "terminal_state": "terminalState",
            "job_trigger_type": "jobTriggerType",
            **_same("schedule", "libraries", "manual_override_params"),
            "repair_id": "repairId",
            **_same(
                "repair_details", "run_name", "timeout_seconds", "retry_on_timeout", "max_retries",
                "min_retry_interval_millis", "max_concurrent_runs", "run_as_user_name", "workflow_context",
                "task_detail_legacy", "submitRun_details", "created_by", "last_edited_by",
            ),
            "request_detail": "requestDetails", "time_detail": "timeDetails", "startEpochMS": "startEpochMS",
        },
    )


def notebook(silver: DataFrame) -> DataFrame:
    return _renamed(
        silver,
        {
            TENANT: TENANT, "notebook_id": "notebookId", "notebook_name": "notebookName", "notebook_path": "path",
            "cluster_id": "clusterId", "action": "actionName", "old_name": "oldName", "old_path": "oldPath",
            "new_name": "newName", "new_path": "newPath", "parent_path": "parentPath", "user_email": "userEmail",
            "request_id": "requestId", "response": "response",
        },
        _times("timestamp"),
    )


def account_change(silver: DataFrame) -> DataFrame:
    return _renamed(
        silver,
        {
            TENANT: TENANT, "mod_unixTimeMS": "timestamp", "mod_date": "date", "action": "actionName",
            **_same("endpoint", "modified_by", "user_name", "user_id", "group_name", "group_id"),
            "from_ip_address": "sourceIPAddress", "user_agent": "userAgent", "request_id": "requestId",
            "response": "response",
        },
    )


def login(silver: DataFrame, changes: DataFrame) -> DataFrame:
    return _renamed(
        logins_with_user(silver, changes),
        {
            TENANT: TENANT, "login_unixTimeMS": "timestamp",
            **_same("login_date", "login_type", "login_user", "user_email", "user_id", "ssh_login_details"),
            "from_ip_address": "sourceIPAddress", "user_agent": "userAgent", "request_id": "requestId",
            "response": "response",
        },
    )


def instance_pool(silver: DataFrame) -> DataFrame:
    return silver.select(
        "serviceName", "actionName", TENANT, "timestamp", "date", "instance_pool_id", "instance_pool_name",
        "node_type_id", "idle_instance_autotermination_minutes", "min_idle_instances", "max_capacity",
        "preloaded_spark_versions", "aws_attributes", "azure_attributes", "custom_tags", "create_details",
        "delete_details", "request_details",
    )


SPARK_FILES = {"event_log_start": "startFilenameGroup", "event_log_end": "endFilenameGroup"}
SPARK_IDS = {TENANT: TENANT, "spark_context_id": "SparkContextID", "cluster_id": "clusterId"}


def spark_job(silver: DataFrame, by_principal: bool = False) -> DataFrame:
    """Spark jobs with the user behind them.

    The user of a job without one comes from jobs of the same principal (where
    the platform has one), isolation id, job group or execution, in this
    order, else from the last earlier job of the same interpreter. The jobs are
    written once; only the columns these steps need go through their shuffles,
    with a row id by which the users come back to the jobs.
    """
    p = "PowerProperties."
    helpers = {
        "__group": F.col(p + "JobGroupID"),
        "__exec": F.col(p + "ExecutionID"),
        "__principal": F.col(p + "principalIdpObjectId"),
        "__isolation": F.col(p + "SparkDBIsolationID"),
        "__repl": F.col(p + "SparkDBREPLID"),
    }
    platform_job = F.coalesce(F.col("JobGroupID").like("%job-%-run-%"), F.lit(False))
    job_id, run_id = F.col(p + "SparkDBJobID"), F.col(p + "SparkDBRunID")
    df = _renamed(
        silver.withColumns({"user_email": F.col(p + "UserEmail"), **helpers}),
        {
            **SPARK_IDS, "job_id": "JobID", "job_group_id": "JobGroupID", "execution_id": "ExecutionID",
            "stage_ids": "StageIDs", "job_runtime": "JobRunTime", "job_result": "JobResult", **SPARK_FILES,
            **_same("user_email", *helpers),
        },
        [
            F.col(p + "NotebookID").alias("notebook_id"),
            F.col(p + "NotebookPath").alias("notebook_path"),
            F.when(platform_job & job_id.isNull(), job_id_of_group(F.col("JobGroupID"))).otherwise(job_id).alias("db_job_id"),
            F.when(platform_job & run_id.isNull(), run_id_of_group(F.col("JobGroupID"))).otherwise(run_id).alias("db_id_in_job"),
            run_id.alias("db_run_id"),
            F.col(p + "sparkDBJobType").alias("db_job_type"),
            *_times("startTimestamp"),
        ],
    )
    names = [c for c in df.columns if c not in helpers]
    df = materialize(df.withColumn("__row", F.monotonically_increasing_id()), "spark-jobs")

    context = [TENANT, "spark_context_id"]
    groups = [[*context, "__isolation"], [*context, "__group"], [*context, "__exec"]]
    if by_principal:
        groups.insert(0, [TENANT, "__principal"])
    order = ["unixTimeMS", "job_id"]
    users = df.select("__row", *context, *helpers, *order, "user_email")
    users = materialize(fill_from_groups(users, "user_email", groups), "user")
    users = fill_forward(users, [*context, "__repl"], order, {"user_email": []}, day_of_ms(F.col("unixTimeMS")))
    df = fill_from_groups(df.drop("user_email"), "cluster_id", [context])
    return df.join(users.select("__row", "user_email"), "__row").select(*names)


def spark_stage(silver: DataFrame) -> DataFrame:
    return _renamed(
        silver,
        {**SPARK_IDS, "stage_id": "StageID", "stage_attempt_id": "StageAttemptID", "stage_runtime": "StageRunTime",
         "stage_info": "StageInfo", **SPARK_FILES},
        _times("startTimestamp"),
    )


def spark_task(silver: DataFrame) -> DataFrame:
    return _renamed(
        silver,
        {**SPARK_IDS, "task_id": "TaskID", "task_attempt_id": "TaskAttempt", "stage_id": "StageID",
         "stage_attempt_id": "StageAttemptID", "executor_id": "ExecutorID", "host": "Host",
         "task_runtime": "TaskRunTime", "task_metrics": "TaskMetrics", "task_executor_metrics": "TaskExecutorMetrics",
         "task_info": "TaskInfo", "task_type": "TaskType", "task_end_reason": "TaskEndReason", **SPARK_FILES},
        _times("startTimestamp"),
    )


def spark_execution(silver: DataFrame) -> DataFrame:
    return _renamed(
        silver,
        {**SPARK_IDS, "execution_id": "ExecutionID", **_same("description", "details"),
         "sql_execution_runtime": "SqlExecutionRunTime", **SPARK_FILES},
        _times("startTimestamp"),
    )


def spark_executor(silver: DataFrame) -> DataFrame:
    return _renamed(
        silver,
        {**SPARK_IDS, "executor_id": "ExecutorID", "executor_info": "executorInfo", "removed_reason": "RemovedReason",
         "executor_alivetime": "ExecutorAliveTime", **SPARK_FILES},
        _times("addedTimestamp"),
    )


STREAM_SCHEMA = (
    "cluster_id string, organization_id string, spark_context_id string, stream_id string, stream_run_id string,"
    " stream_batch_id bigint, stream_timestamp double, date date, streamSegment string, stream_name string,"
    " streaming_metrics struct<batchDuration: bigint, batchId: bigint, durationMs: string,"
    " eventTime: struct<avg: string, max: string, min: string, watermark: string>, id: string, name: string,"
    " runId: string, sink: string, sources: string, stateOperators: string, timestamp: string>,"
    " execution_ids array<bigint>"
)
STREAM_KEYS = [TENANT, "spark_context_id", "cluster_id", "stream_id", "stream_run_id", "stream_batch_id", "stream_timestamp"]
STREAM_TEXTS = ["durationMs", "sink", "sources", "metrics", "observedMetrics"]


def spark_stream(
    events: DataFrame, executions: DataFrame, progress_schema: T.DataType | None = None, chunk: int = 10_000
) -> DataFrame:
    """Started and progressed events of streams with their SQL executions.

    The executions of a batch come in chunks, so no list outgrows a task: beyond the
    first ``chunk`` a batch has further rows, told apart by ``execution_chunk``, which
    belongs to the key of a stored table.
    """
    event = F.col("Event")
    raw = events.filter(event.startswith(STREAM_EVENTS) & ~event.endswith("TerminatedEvent"))
    df = raw.withColumn("streaming_metrics", S.struct_from_json(raw, "progress", schema=progress_schema))
    m = "streaming_metrics."
    at = F.coalesce(ts_to_epoch_milli(F.col(m + "timestamp")), F.col("Timestamp").cast("double"))
    df = df.select(
        TENANT,
        F.col("SparkContextID").alias("spark_context_id"),
        F.col("clusterId").alias("cluster_id"),
        at.alias("stream_timestamp"),
        F.timestamp_millis(at.cast("bigint")).cast("date").alias("date"),
        F.when(event.endswith("StartedEvent"), "Started").when(event.endswith("ProgressEvent"), "Progressed").alias("streamSegment"),
        F.coalesce(F.col(m + "id"), F.col("id")).alias("stream_id"),
        F.col("name").alias("stream_name"),
        F.coalesce(F.col(m + "runId"), F.col("runId")).alias("stream_run_id"),
        F.coalesce(F.col(m + "batchId"), F.lit(-1).cast("bigint")).alias("stream_batch_id"),
        "streaming_metrics",
        "fileCreateEpochMS",
    )
    run = [TENANT, "spark_context_id", "cluster_id", "stream_id", "stream_run_id"]
    # copies of an event say the same, so dropping them first does not change the filled name
    df = keep_first(df, STREAM_KEYS, [F.col("fileCreateEpochMS").desc()]).drop("fileCreateEpochMS")
    order = ["stream_timestamp", "stream_batch_id"]
    df = fill_forward(materialize(df, "stream"), run, order, {"stream_name": []}, day_of_ms(F.col("stream_timestamp")))

    operators = F.to_json(m + "stateOperators") if S.find_type(df.schema, m + "stateOperators") else F.lit(None)
    changes = {m + "stateOperators": F.nullif(operators, F.lit("[]"))}
    for name in STREAM_TEXTS:
        kind = S.find_type(df.schema, m + name)
        if kind is not None:
            text = F.col(m + name) if isinstance(kind, T.StringType) else F.to_json(m + name)
            changes[m + name] = text
    changes = {p: c for p, c in changes.items() if S.find_type(df.schema, p) is not None}
    df = S.modify_struct(df, changes)

    described = executions.filter(F.col("description").like("%id =%runId =%batch =%"))
    linked = described.select(
        TENANT,
        F.col("SparkContextID").alias("spark_context_id"),
        F.col("clusterId").alias("cluster_id"),
        F.col("ExecutionID").cast("bigint").alias("execution_id"),
        stream_details(F.col("description")).alias("d"),
    ).select(
        TENANT, "spark_context_id", "cluster_id", "execution_id", "d.stream_id", "d.stream_run_id",
        F.col("d.stream_batch_id").try_cast("bigint").alias("stream_batch_id"),
    ).filter(F.col("stream_id").isNotNull())
    keys = [*run, "stream_batch_id"]
    by = F.floor(F.col("execution_id") / 100_000)
    lists = ordered_list(linked, keys, "execution_id", ["execution_id"], "execution_ids", by, chunk)
    rows = df.join(lists, keys, "left").withColumn("execution_chunk", F.coalesce("chunk_no", F.lit(0))).drop("chunk_no")
    return S.enforce_schema(rows, T.StructType.fromDDL(STREAM_SCHEMA))
