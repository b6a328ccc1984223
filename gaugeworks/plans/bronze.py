"""Bronze tables: landed data with clean names and stable types."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.predicates import cluster_id_of_audit
from gaugeworks.operators import schema as S
from gaugeworks.operators.aggregates import batch_by_size
from gaugeworks.operators.dedup import keep_first, latest_snapshot
from gaugeworks.sources import files
from gaugeworks.sources.tables import TENANT

TASK_MAPS = [
    "notebook_task.base_parameters",
    "python_wheel_task.named_parameters",
    "sql_task.parameters",
    *[f"new_cluster.{f}" for f in S.CLUSTER_MAPS],
]
JOB_CLUSTER_MAPS = [f"new_cluster.{f}" for f in S.CLUSTER_MAPS]
SNAPSHOT_MAPS = ["default_tags", "custom_tags", "spark_conf", "spark_env_vars", "aws_attributes", "azure_attributes"]
POOL_MAPS = ["custom_tags", "default_tags", "aws_attributes", "azure_attributes"]
EVENT_ATTRIBUTES = ["custom_tags", "spark_conf", "azure_attributes", "aws_attributes", "spark_env_vars"]

EMPTY_TASKS = "array<struct<task_key:string>>"
EMPTY_JOB_CLUSTERS = "array<struct<job_cluster_key:string>>"

CLUSTER_EVENT_SCHEMA = (
    "organization_id string, cluster_id string, timestamp bigint, type string,"
    " details struct<cluster_size: struct<autoscale: struct<max_workers: bigint, min_workers: bigint>,"
    " num_workers: bigint>, current_num_workers: bigint, target_num_workers: bigint, user: string,"
    " disk_size: bigint, free_space: bigint, instance_id: string, previous_disk_size: bigint,"
    " driver_state_message: string>"
)


def _present(df: DataFrame, changes: dict[str, Column]) -> dict[str, Column]:
    return {p: c for p, c in changes.items() if S.find_type(df.schema, p) is not None}


def clean_jobs_snapshot(raw: DataFrame, run_id: str) -> DataFrame:
    """Job snapshot: tags and parameters as maps, tasks and job clusters cleaned in place."""
    df = S.scrub_schema(raw).withColumn("run_id", F.lit(run_id))
    changes = {
        "settings.tasks": S.clean_struct_array(df, "settings.tasks", TASK_MAPS, EMPTY_TASKS),
        "settings.job_clusters": S.clean_struct_array(df, "settings.job_clusters", JOB_CLUSTER_MAPS, EMPTY_JOB_CLUSTERS),
        "settings.tags": S.struct_to_map(df.schema, "settings.tags"),
        "settings.notebook_task.base_parameters": S.struct_to_map(df.schema, "settings.notebook_task.base_parameters"),
        **S.cluster_map_changes(df.schema, "settings.new_cluster"),
    }
    return S.drop_void_fields(S.modify_struct(df, _present(df, changes)))


def clean_job_runs_snapshot(raw: DataFrame, run_id: str) -> DataFrame:
    df = S.scrub_schema(raw).withColumn("run_id_of_load", F.lit(run_id))
    changes = {
        "tasks": S.clean_struct_array(df, "tasks", TASK_MAPS, EMPTY_TASKS),
        "job_clusters": S.clean_struct_array(df, "job_clusters", JOB_CLUSTER_MAPS, EMPTY_JOB_CLUSTERS),
        **S.cluster_map_changes(df.schema, "cluster_spec.new_cluster"),
    }
    return S.drop_void_fields(S.modify_struct(df, _present(df, changes)))


def _with_maps(raw: DataFrame, columns: list[str]) -> DataFrame:
    df = S.scrub_schema(raw)
    return df.withColumns({c: S.struct_to_map(df.schema, c) for c in columns})


def clean_clusters_snapshot(raw: DataFrame) -> DataFrame:
    return _with_maps(raw, SNAPSHOT_MAPS)


def clean_pools_snapshot(raw: DataFrame) -> DataFrame:
    return _with_maps(raw, POOL_MAPS)


def plain_snapshot(raw: DataFrame, run_id: str, snapshot_ts: dt.datetime) -> DataFrame:
    """Libraries, policies, instance profiles, tokens, init scripts: names cleaned, run stamped."""
    return S.scrub_schema(raw).withColumns({"run_id": F.lit(run_id), "snapshot_ts": F.lit(snapshot_ts)})


def audit_log(
    spark: SparkSession, root: str, fmt: str, start: dt.date, until: dt.date, tenant: str,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Audit records of a date range with their hash, one row per key."""
    df = files.read_audit_folders(spark, root, fmt, start, until, tenant, schema)
    keys = [TENANT, "timestamp", "serviceName", "actionName", "requestId", "hashKey"]
    return keep_first(df, keys, ["filename"])


def clusters_with_new_events(audit: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Clusters named in the audit log, or running in the newest snapshot."""
    named = audit.select(
        TENANT,
        cluster_id_of_audit(
            F.col("serviceName"),
            F.col("actionName"),
            F.col("requestParams.cluster_id"),
            F.col("requestParams.clusterId"),
            F.col("response.result"),
        ).alias("cluster_id"),
    ).filter(F.col("cluster_id").isNotNull())
    running = latest_snapshot(snapshot, [TENANT], "snapshot_ts").filter("state = 'RUNNING'")
    return named.unionByName(running.select(TENANT, "cluster_id")).distinct()


def fetch_batches(event_counts: DataFrame, batch_size: int) -> DataFrame:
    """Batches of clusters by their number of events, in order of the cluster id."""
    return batch_by_size(event_counts, "cluster_id", "events", batch_size, F.substring("cluster_id", 1, 4))


def cluster_events(pages: DataFrame, tenant: str) -> DataFrame:
    """Cluster events out of landed pages: attributes as maps, minimum schema enforced."""
    df = S.scrub_schema(files.explode_pages(pages))
    changes = {
        f"details.{owner}.{a}": S.struct_to_map(df.schema, f"details.{owner}.{a}")
        for owner in ("attributes", "previous_attributes")
        for a in EVENT_ATTRIBUTES
    }
    df = S.modify_struct(df, _present(df, changes)).withColumn(TENANT, F.lit(tenant))
    return keep_first(S.enforce_schema(df, T.StructType.fromDDL(CLUSTER_EVENT_SCHEMA)), [TENANT, "cluster_id", "type", "timestamp"], ["timestamp"])


def spark_events(
    spark: SparkSession, roots: list[str], glob: str, tenant: str, from_ms: int, until_ms: int,
    processed: DataFrame | None = None, schema: T.StructType | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Event rows of new log files in range, broken lines, and the tracker rows to append."""
    found = files.discover_files(spark, roots, glob, from_ms, until_ms)
    fresh = files.new_files(found, processed).withColumn(TENANT, F.lit(tenant))
    readable = fresh.filter(~F.col("failed") & F.col("withinSpecifiedTimeRange"))
    good, _ = files.readable_roots(spark, roots, glob)
    events, bad = files.read_event_logs(spark, good, readable, tenant, glob, schema, from_ms, until_ms)
    return events, bad, fresh
