"""Queries of the marts made of Spark events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.plans import bronze, gold, jobs, spark_silver
from gaugeworks.queries import samples
from gaugeworks.queries.registry import Tables, ms, query
from gaugeworks.session import materialize, scratch_path
from gaugeworks.sources.tables import TENANT

VENDOR = "vendor"
FROM_MS = samples.JAN_1 + 2 * samples.DAY
STAGE_INFO = (
    "StageID bigint, StageAttemptID bigint, SubmissionTime bigint, CompletionTime bigint, Accumulables array<string>,"
    " Details string, FailureReason string, NumberofTasks bigint, ParentIDs array<bigint>"
)
TASK_INFO = (
    "TaskID bigint, ExecutorID string, Attempt bigint, Host string, LaunchTime bigint, FinishTime bigint,"
    " Accumulables array<string>, Failed boolean, GettingResultTime bigint, Index bigint, Killed boolean,"
    " Locality string, Speculative boolean"
)


def _struct(fields: str, **values: Column) -> Column:
    """A struct with the given fields, some of them set."""
    kinds = T.StructType.fromDDL(fields).fields
    return F.struct(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in kinds])


def spark_events(t: Tables) -> DataFrame:
    """Each event gives a job, a stage, a task, an execution and an executor.

    One in nine never ends; one in five is delivered twice.
    """
    start = ms("ts")
    end = start + F.floor(F.col("value") * 1000) + 1
    e = t.events.select("*", start.alias("s"), end.alias("e"), samples.number().alias("k"))
    eid = F.col("event_id")
    properties = F.create_map(
        F.lit("sparkjobGroupid"),
        F.when(
            F.col("event_type") == "view",
            F.concat(F.lit("1_2_job-"), F.col("user_id"), F.lit("-run-"), eid, F.lit("-action-1")),
        ).otherwise(F.concat(F.lit("g"), F.col("k") % 10)),
        F.lit("sparksqlexecutionid"),
        (eid % 97).cast("string"),
        F.lit(f"spark{VENDOR}isolationID"),
        F.concat(F.lit("i"), F.col("k") % 3),
        F.lit(f"spark{VENDOR}replId"),
        F.lit("repl"),
        F.lit(f"spark{VENDOR}notebookid"),
        F.concat(F.lit("n"), F.col("k")),
        F.lit("user"),
        F.when(F.col("event_type") == "click", F.concat(F.lit("u"), F.col("user_id"))),
    )
    at = {"SubmissionTime": F.col("s"), "LaunchTime": F.col("s"), "StageID": eid, "StageAttemptID": F.lit(0)}
    closing = F.col("kind") >= 5
    when = F.when(closing, F.col("e")).otherwise(F.col("s"))
    ended = F.when(closing, F.col("e"))
    done = {"CompletionTime": ended, "FinishTime": ended}
    task = {"TaskID": eid, "ExecutorID": F.concat(F.lit("x"), eid), "Attempt": F.lit(0), "Host": F.lit("h1")}

    pairs = [
        ("SparkListenerJobStart", "SparkListenerJobEnd"),
        ("SparkListenerStageSubmitted", "SparkListenerStageCompleted"),
        ("SparkListenerTaskStart", "SparkListenerTaskEnd"),
        (spark_silver.SQL_START, spark_silver.SQL_END),
        ("SparkListenerExecutorAdded", "SparkListenerExecutorRemoved"),
    ]
    names = F.array(*[F.lit(a) for a, _ in pairs], *[F.lit(b) for _, b in pairs])
    # only numbers are multiplied, so a reader of one event does not make the others
    both = F.when(eid % 9 != 0, F.sequence(F.lit(0), F.lit(9))).otherwise(F.sequence(F.lit(0), F.lit(4)))
    copies = F.when(eid % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = e.select("*", F.explode(both).alias("kind"))
    return rows.select("*", F.explode(copies).alias("copy")).select(
        samples.tenant("user_id"),
        F.concat(F.lit("c"), F.col("user_id")).alias("clusterId"),
        F.concat(F.lit("ctx"), F.col("user_id")).alias("SparkContextID"),
        F.get(names, F.col("kind")).alias("Event"),
        F.timestamp_millis(when).cast("date").alias("fileCreateDate"),
        when.alias("Timestamp"),
        when.alias("time"),
        F.when(~closing, F.col("s")).alias("SubmissionTime"),
        ended.alias("CompletionTime"),
        _struct(STAGE_INFO, NumberofTasks=F.lit(1), Details=F.lit("d"), **{**at, **done}).alias("StageInfo"),
        _struct(TASK_INFO, Failed=F.lit(False), **{**at, **task, **done}).alias("TaskInfo"),
        properties.alias("Properties"),
        eid.alias("JobID"),
        F.array(eid).alias("StageIDs"),
        F.struct(F.lit("JobSucceeded").alias("Result")).alias("JobResult"),
        eid.alias("StageID"),
        F.lit(0).cast("bigint").alias("StageAttemptID"),
        eid.alias("executionId"),
        F.when(
            F.col("event_type") == "purchase",
            F.concat(
                F.lit("q<br/>id = s"), F.col("user_id"), F.lit("<br/>runId = r"), F.col("user_id"),
                F.lit("<br/>batch = "), F.floor(eid / 100),
            ),
        ).otherwise("plain").alias("description"),
        F.lit("d").alias("details"),
        F.concat(F.lit("x"), eid).alias("ExecutorID"),
        F.struct(F.lit("h1").alias("Host")).alias("executorInfo"),
        F.lit("gone").alias("RemovedReason"),
        F.struct(F.lit("Success").alias("Reason")).alias("TaskEndReason"),
        F.struct((F.col("e") - F.col("s")).alias("ExecutorRunTime")).alias("TaskMetrics"),
        F.lit("ResultTask").alias("TaskType"),
        F.struct(F.lit(0).alias("JVMHeapMemory")).alias("TaskExecutorMetrics"),
        F.struct(F.lit("f").alias("filename")).alias("filenameGroup"),
        F.col("s").alias("fileCreateEpochMS"),
    )


def _sql(lag: int) -> str:
    """Starts with their ends where the end came within the lag, new or newly closed."""
    return f"""WITH e AS (SELECT *, epoch_us(ts) // 1000 AS s, CASE WHEN event_id % 9 <> 0 THEN epoch_us(ts) // 1000 + CAST(floor(value * 1000) AS BIGINT) + 1 END AS e0 FROM events),
x AS (SELECT *, CASE WHEN CAST(make_timestamp(s * 1000) AS DATE) >= CAST(make_timestamp(e0 * 1000) AS DATE) - {lag} THEN e0 END AS en FROM e)
SELECT 't' || user_id % 2 AS organization_id, 'c' || user_id AS cluster_id, event_id AS id, s AS start_ms, en AS end_ms, en - s AS run_ms
FROM x WHERE coalesce(en, s) >= {FROM_MS}"""


def _checked(df: DataFrame, id_col: str, run: str, names=("startEpochMS", "endEpochMS", "runTimeMS")) -> DataFrame:
    key = F.regexp_replace(F.col(id_col).cast("string"), "^x", "").cast("bigint")
    return df.select(
        TENANT, F.col("clusterId").alias("cluster_id"), key.alias("id"),
        F.col(f"{run}.{names[0]}").alias("start_ms"),
        F.col(f"{run}.{names[1]}").alias("end_ms"),
        F.col(f"{run}.{names[2]}").alias("run_ms"),
    )


@query("s_2003_executors", _sql(30))
def executors(t: Tables):
    e = spark_events(t)
    names = ("AddedEpochMS", "RemovedEpochMS", "uptimeMS")
    return _checked(spark_silver.executors(e, e, FROM_MS), "ExecutorID", "ExecutorAliveTime", names)


@query("s_2005_sql_executions", _sql(1))
def executions(t: Tables):
    e = spark_events(t)
    return _checked(spark_silver.sql_executions(e, e, FROM_MS), "ExecutionID", "SqlExecutionRunTime")


@query("s_2006_spark_jobs", _sql(1))
def spark_jobs(t: Tables):
    e = spark_events(t)
    return _checked(spark_silver.spark_jobs(e, e, FROM_MS, VENDOR), "JobID", "JobRunTime")


@query("s_2007_spark_stages", _sql(1))
def stages(t: Tables):
    e = spark_events(t)
    return _checked(spark_silver.spark_stages(e, e, FROM_MS), "StageID", "StageRunTime")


@query("s_2008_spark_tasks", _sql(1))
def tasks(t: Tables):
    e = spark_events(t)
    return _checked(spark_silver.spark_tasks(e, e, FROM_MS), "TaskID", "TaskRunTime")


_USER_SQL = f"""WITH e AS (SELECT *, 't' || user_id % 2 AS org, CAST(json_extract(props, '$.k') AS BIGINT) AS k, epoch_us(ts) // 1000 AS s,
  CASE WHEN event_id % 9 <> 0 THEN epoch_us(ts) // 1000 + CAST(floor(value * 1000) AS BIGINT) + 1 END AS e0 FROM events),
x AS (SELECT *, CASE WHEN event_type = 'view' THEN '1_2_job-' || user_id || '-run-' || event_id || '-action-1' ELSE 'g' || k % 10 END AS grp,
  CASE WHEN event_type = 'click' THEN 'u' || user_id END AS u0, (event_id % 97)::VARCHAR AS ex,
  CASE WHEN CAST(make_timestamp(s * 1000) AS DATE) >= CAST(make_timestamp(e0 * 1000) AS DATE) - 1 THEN e0 END AS en FROM e),
f AS (SELECT * FROM x WHERE coalesce(en, s) >= {FROM_MS}),
a AS (SELECT *, coalesce(u0, min(u0) OVER (PARTITION BY org, user_id, k % 3)) AS u1 FROM f),
b AS (SELECT *, coalesce(u1, min(u1) OVER (PARTITION BY org, user_id, grp)) AS u2 FROM a),
c AS (SELECT *, coalesce(u2, min(u2) OVER (PARTITION BY org, user_id, ex)) AS u3 FROM b),
d AS (SELECT *, coalesce(u3, last_value(u3 IGNORE NULLS) OVER (PARTITION BY org, user_id ORDER BY s, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS u4 FROM c)
SELECT org AS organization_id, event_id AS job_id, grp AS job_group_id, u4 AS user_email, CASE WHEN event_type = 'view' THEN user_id::VARCHAR END AS db_job_id,
  CASE WHEN event_type = 'view' THEN event_id::VARCHAR END AS db_id_in_job, 'n' || k AS notebook_id, s AS start_ms FROM d"""


def gold_jobs(t: Tables) -> DataFrame:
    e = spark_events(t)
    return gold.spark_job(spark_silver.spark_jobs(e, e, FROM_MS, VENDOR))


@query("g_3010_spark_job", _USER_SQL)
def spark_job(t: Tables):
    return gold_jobs(t).select(
        TENANT, "job_id", "job_group_id", "user_email", "db_job_id", "db_id_in_job", "notebook_id",
        F.col("unixTimeMS").alias("start_ms"),
    )


def _gold_sql(lag: int, name: str) -> str:
    return f"""SELECT organization_id, cluster_id, 'ctx' || cluster_id[2:] AS spark_context_id, id AS {name}, start_ms AS "unixTimeMS",
  strftime(make_timestamp(start_ms * 1000), '%Y-%m-%d') AS date, run_ms FROM ({_sql(lag)})"""


def _gold_checked(df: DataFrame, id_col: str, run: str, field: str = "runTimeMS") -> DataFrame:
    key = F.regexp_replace(F.col(id_col).cast("string"), "^x", "").cast("bigint").alias(id_col)
    return df.select(
        TENANT, "cluster_id", "spark_context_id", key, "unixTimeMS", F.col("date").cast("string").alias("date"),
        F.col(f"{run}.{field}").alias("run_ms"),
    )


@query("g_3011_spark_stage", _gold_sql(1, "stage_id"))
def gold_stage(t: Tables):
    e = spark_events(t)
    return _gold_checked(gold.spark_stage(spark_silver.spark_stages(e, e, FROM_MS)), "stage_id", "stage_runtime")


@query("g_3012_spark_task", _gold_sql(1, "task_id"))
def gold_task(t: Tables):
    e = spark_events(t)
    return _gold_checked(gold.spark_task(spark_silver.spark_tasks(e, e, FROM_MS)), "task_id", "task_runtime")


@query("g_3013_spark_execution", _gold_sql(1, "execution_id"))
def gold_execution(t: Tables):
    e = spark_events(t)
    out = gold.spark_execution(spark_silver.sql_executions(e, e, FROM_MS))
    return _gold_checked(out, "execution_id", "sql_execution_runtime")


@query("g_3014_spark_executor", _gold_sql(30, "executor_id"))
def gold_executor(t: Tables):
    e = spark_events(t)
    out = gold.spark_executor(spark_silver.executors(e, e, FROM_MS))
    return _gold_checked(out, "executor_id", "executor_alivetime", "uptimeMS")


def stream_events(t: Tables) -> DataFrame:
    """Progress of a stream per user, a batch per hundred events; each event comes twice."""
    b = F.floor(F.col("event_id") / 100)
    e = t.events.groupBy("user_id", b.alias("b")).agg(F.min("ts").alias("ts"))
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    progress = F.to_json(
        F.struct(
            F.concat(F.lit("s"), F.col("user_id")).alias("id"),
            F.concat(F.lit("r"), F.col("user_id")).alias("runId"),
            F.col("b").alias("batchId"),
            iso.alias("timestamp"),
            F.struct(F.lit(5).alias("addBatch")).alias("durationMs"),
            F.array(F.struct(F.lit(1).alias("rows"))).alias("stateOperators"),
        )
    )
    rows = e.select(
        samples.tenant("user_id"),
        F.concat(F.lit("ctx"), F.col("user_id")).alias("SparkContextID"),
        F.concat(F.lit("c"), F.col("user_id")).alias("clusterId"),
        F.lit("org.apache.spark.sql.streaming.StreamingQueryListener$QueryProgressEvent").alias("Event"),
        progress.alias("progress"),
        F.lit(None).cast("string").alias("id"),
        F.lit(None).cast("string").alias("runId"),
        F.when(F.col("b") % 2 == 0, F.concat(F.lit("q"), F.col("user_id"))).alias("name"),
        F.lit(None).cast("bigint").alias("Timestamp"),
        ms("ts").alias("fileCreateEpochMS"),
    )
    return rows.unionByName(rows.withColumn("fileCreateEpochMS", F.col("fileCreateEpochMS") + 1))


@query(
    "g_3016_spark_stream",
    """WITH p AS (SELECT user_id, event_id // 100 AS b, min(epoch_us(ts)) // 1000 AS s, string_agg(event_id::VARCHAR, ',' ORDER BY event_id) FILTER (event_type = 'purchase') AS ids
  FROM events GROUP BY 1, 2)
SELECT 't' || user_id % 2 AS organization_id, 's' || user_id AS stream_id, b AS stream_batch_id, s AS at_ms, 'Progressed' AS segment,
  last_value(CASE WHEN b % 2 = 0 THEN 'q' || user_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY s, b ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stream_name,
  '[{"rows":1}]' AS operators, '{"addBatch":5}' AS duration, ids AS execution_ids FROM p""",
)
def stream(t: Tables):
    """All executions of a batch, for purchases have one; the silver executions start with the first day here."""
    e = spark_events(t)
    runs = spark_silver.sql_executions(e, e, 0)
    s = gold.spark_stream(stream_events(t), runs)
    return s.select(
        TENANT, "stream_id", "stream_batch_id",
        F.round("stream_timestamp").cast("bigint").alias("at_ms"),
        F.col("streamSegment").alias("segment"),
        "stream_name",
        F.col("streaming_metrics.stateOperators").alias("operators"),
        F.col("streaming_metrics.durationMs").alias("duration"),
        F.array_join(F.col("execution_ids").cast("array<string>"), ",").alias("execution_ids"),
    )


st_05 = query(
    "st_05_streaming_mart",
    "SELECT CAST(count(DISTINCT (user_id, event_id // 100)) AS BIGINT) AS batches, CAST(count(*) FILTER (event_type = 'purchase') AS BIGINT) AS executions, 0 AS doubles FROM events",
)


@st_05
def stream_totals(t: Tables):
    e = spark_events(t)
    s = gold.spark_stream(stream_events(t), spark_silver.sql_executions(e, e, 0), chunk=2)
    return s.agg(
        F.count_distinct("stream_id", "stream_batch_id").alias("batches"),
        (F.count(F.lit(1)) - F.count_distinct("stream_id", "stream_batch_id", "execution_chunk")).alias("doubles"),
        F.sum(F.size("execution_ids")).cast("bigint").alias("executions"),
    )


@query(
    "agg_02_job_run_utilisation",
    f"""WITH x AS (SELECT * FROM ({_sql(1)}) JOIN events ON id = event_id WHERE event_type = 'view')
SELECT organization_id, user_id::VARCHAR AS db_job_id, id::VARCHAR AS db_id_in_job, run_ms AS runtime_ms, round(run_ms / 3600000, 4) AS hours FROM x""",
)
def utilisation(t: Tables):
    e = spark_events(t)
    done = materialize(gold_jobs(t), "gold-jobs")
    gold_tasks = gold.spark_task(spark_silver.spark_tasks(e, e, FROM_MS))
    out = jobs.spark_utilisation(done, gold_tasks)
    return out.select(
        TENANT, "db_job_id", "db_id_in_job", F.col("spark_task_runtimeMS").alias("runtime_ms"),
        F.col("spark_task_runtime_H").alias("hours"),
    )


# --- event logs as files ----------------------------------------------------


def event_log_files(t: Tables) -> str:
    """JSON event logs in folders cluster / eventlog / host / context, with some broken lines."""
    root = scratch_path(t.spark, "eventlogs")
    line = F.to_json(
        F.struct(
            F.when(F.col("event_type") == "click", "SparkListenerJobStart")
            .when(F.col("event_type") == "view", "org.apache.spark.scheduler.SparkListenerSpeculativeTaskSubmitted")
            .otherwise("SparkListenerTaskStart")
            .alias("Event"),
            F.col("event_id").alias("Job ID"),
            ms("ts").alias("Timestamp"),
            F.when(F.col("event_type") != "view", F.col("event_id")).alias("Stage ID"),
            F.when(F.col("event_type") == "view", F.col("event_id")).alias("stageId"),
            F.when(
                F.col("event_type") == "click",
                F.struct(
                    F.col("event_type").alias("spark.app.name"),
                    F.col("props").alias("spark.job.props"),
                    F.lit("x").alias("spark.executor.extraClassPath"),
                ),
            ).alias("Properties"),
            F.lit("big").alias("sparkPlanInfo"),
        )
    )
    text = F.when(F.col("event_id") % 250 == 0, F.concat(F.lit("{broken "), F.col("event_id"))).otherwise(line)
    df = t.events.select(
        text.alias("value"),
        F.concat(F.lit("c"), F.col("user_id") % 8).alias("cluster"),
        F.lit("eventlog").alias("kind"),
        F.lit("host 1%2+3").alias("host"),
        F.concat(F.lit("ctx"), F.col("user_id") % 8).alias("context"),
    )
    df.repartition("cluster").write.partitionBy("cluster", "kind", "host", "context").text(root)
    return root


_LOG_SQL = """SELECT 'c' || user_id % 8 AS cluster_id, 'ctx' || user_id % 8 AS context_id, event_id AS job_id, event_id AS stage_id, epoch_us(ts) // 1000 AS at_ms,
  CASE WHEN event_type = 'click' THEN 'click' END AS app_name, CASE WHEN event_type = 'click' THEN 2 END AS n_properties FROM events WHERE event_id % 250 <> 0"""


def _log_rows(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("clusterId").alias("cluster_id"),
        F.col("SparkContextID").alias("context_id"),
        F.col("JobID").alias("job_id"),
        F.col("StageID").alias("stage_id"),
        F.col("Timestamp").alias("at_ms"),
        F.try_element_at("Properties", F.lit("sparkappname")).alias("app_name"),
        F.when(F.col("Properties").isNotNull(), F.size("Properties")).alias("n_properties"),
    )


@query("src_04_event_log_scan", _LOG_SQL)
def event_logs(t: Tables):
    events, _, _ = bronze.spark_events(t.spark, [event_log_files(t)], "part-*", "t1", 0, samples.FEB_1 * 10)
    return _log_rows(events)


@query("b_1006_spark_events", "SELECT CAST(count(*) FILTER (event_id % 250 <> 0) AS BIGINT) AS good, CAST(count(*) FILTER (event_id % 250 = 0) AS BIGINT) AS bad, CAST(0 AS BIGINT) AS again FROM events")
def bronze_events(t: Tables):
    """A second run over the same folders finds nothing new."""
    roots = [event_log_files(t)]
    until = samples.FEB_1 * 10
    events, bad, tracker = bronze.spark_events(t.spark, roots, "part-*", "t1", 0, until)
    tracker = materialize(tracker, "tracker")
    again, _, _ = bronze.spark_events(t.spark, roots, "part-*", "t1", 0, until, tracker)

    def n(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(name))

    return n(events, "good").select("good", n(bad, "bad").scalar().alias("bad"), n(again, "again").scalar().alias("again"))
