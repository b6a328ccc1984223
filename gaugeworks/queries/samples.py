"""Telemetry frames made of the given tables, for the mart queries.

Every event is also a cluster event, a run or a Spark event of some cluster;
customers describe clusters, nations machine types and regions price classes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.timeutil import run_time
from gaugeworks.queries.registry import Tables, ms
from gaugeworks.queries.windows import STATE_OF_TYPE
from gaugeworks.sources.tables import TENANT

DAY = 86_400_000
JAN_1 = 1_704_067_200_000  # 2024-01-01
FEB_1 = JAN_1 + 31 * DAY


def tenant(key: str) -> Column:
    return F.concat(F.lit("t"), F.col(key) % 2).alias(TENANT)


def cluster(key: str) -> Column:
    return F.concat(F.lit("c"), F.col(key)).alias("cluster_id")


def number(column: str = "props") -> Column:
    return F.get_json_object(column, "$.k").cast("bigint")


def cluster_events(t: Tables) -> DataFrame:
    kind = F.create_map(*[F.lit(x) for kv in STATE_OF_TYPE.items() for x in kv])[F.col("event_type")]
    k = number()
    none = F.lit(None).cast("bigint")
    details = F.struct(
        F.struct(
            F.struct(none.alias("max_workers"), none.alias("min_workers")).alias("autoscale"),
            F.when(F.col("event_type") == "signup", k % 5 + 1).alias("num_workers"),
        ).alias("cluster_size"),
        F.when((F.col("event_type") == "view") & (k % 8 != 7), k % 8).alias("current_num_workers"),
        F.when(F.col("event_type") == "click", k % 6).alias("target_num_workers"),
    )
    return t.events.select(
        tenant("user_id"), cluster("user_id"), ms("ts").alias("timestamp"), kind.alias("type"), details.alias("details")
    )


def cluster_spec(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    return t.customer.filter(k % 7 != 0).select(
        tenant("c_custkey"),
        cluster("c_custkey"),
        F.when(k % 4 == 0, F.concat(F.lit("job-"), k, F.lit("-run-1"))).otherwise(F.col("c_name")).alias("cluster_name"),
        F.when(k % 5 == 0, '{"ResourceClass":"SingleNode"}').alias("custom_tags"),
        (F.lit(JAN_1) + (k % 40) * (DAY // 2)).alias("timestamp"),
        F.concat(F.lit(" n"), F.col("c_nationkey"), F.lit(" ")).alias("driver_node_type_id"),
        F.concat(F.lit("n"), (F.col("c_nationkey") + 1) % 25).alias("node_type_id"),
        F.when(k % 8 == 0, "apache_spark_2.4").otherwise("9.1.x").alias("spark_version"),
        F.when(k % 9 == 1, "SQL Analytics").otherwise("Standard").alias("cluster_type"),
        F.when(k % 3 == 0, "PHOTON").otherwise("STANDARD").alias("runtime_engine"),
    )


SPEC_SQL = f"""
spec AS (SELECT 't' || c_custkey % 2 AS org, 'c' || c_custkey AS cluster_id,
  CASE WHEN c_custkey % 4 = 0 THEN 'job-' || c_custkey || '-run-1' ELSE c_name END AS cluster_name,
  CASE WHEN c_custkey % 5 = 0 THEN '{{"ResourceClass":"SingleNode"}}' END AS custom_tags,
  {JAN_1} + (c_custkey % 40) * {DAY // 2} AS t, ' n' || c_nationkey || ' ' AS driver, 'n' || (c_nationkey + 1) % 25 AS node,
  CASE WHEN c_custkey % 8 = 0 THEN 'apache_spark_2.4' ELSE '9.1.x' END AS version,
  CASE WHEN c_custkey % 9 = 1 THEN 'SQL Analytics' ELSE 'Standard' END AS kind,
  CASE WHEN c_custkey % 3 = 0 THEN 'PHOTON' ELSE 'STANDARD' END AS engine FROM customer WHERE c_custkey % 7 <> 0),
snap AS (SELECT 't' || c_custkey % 2 AS org, 'c' || c_custkey AS cluster_id, c_name AS cluster_name,
  '{{"seg":"' || c_mktsegment || '"}}' AS custom_tags, {JAN_1} + 5 * {DAY} AS t, 'n' || c_nationkey AS driver,
  'n' || c_nationkey AS node, '10.0.x' AS version, NULL::VARCHAR AS kind, 'STANDARD' AS engine FROM customer)"""


def cluster_snapshot(t: Tables) -> DataFrame:
    return t.customer.select(
        tenant("c_custkey"),
        cluster("c_custkey"),
        F.col("c_name").alias("cluster_name"),
        F.create_map(F.lit("seg"), F.col("c_mktsegment")).alias("custom_tags"),
        F.create_map(F.lit("Creator"), F.concat(F.lit("u"), F.col("c_custkey"))).alias("default_tags"),
        F.lit(None).cast("bigint").alias("terminated_time"),
        F.lit(JAN_1 + 5 * DAY).cast("bigint").alias("start_time"),
        F.concat(F.lit("n"), F.col("c_nationkey")).alias("driver_node_type_id"),
        F.concat(F.lit("n"), F.col("c_nationkey")).alias("node_type_id"),
        F.lit("10.0.x").alias("spark_version"),
        F.lit("STANDARD").alias("runtime_engine"),
        F.lit("RUNNING").alias("state"),
        F.timestamp_millis(F.lit(JAN_1 + 5 * DAY)).alias("snapshot_ts"),
    )


def _versions(first: str, second: str) -> Column:
    """Two validity versions: until and from the second date."""
    return F.explode(
        F.array(
            F.struct(
                F.lit(0).alias("v"), F.lit(first).cast("date").alias("activeFrom"),
                F.lit(second).cast("date").alias("activeUntil"), F.lit(False).alias("isActive"),
            ),
            F.struct(
                F.lit(1).alias("v"), F.lit(second).cast("date").alias("activeFrom"),
                F.lit(None).cast("date").alias("activeUntil"), F.lit(True).alias("isActive"),
            ),
        )
    )


def machine_prices(t: Tables) -> DataFrame:
    n = F.col("n_nationkey")
    both = F.explode(F.array(F.lit("t0"), F.lit("t1")))
    return (
        t.nation.select("n_nationkey", both.alias(TENANT))
        .select("*", _versions("2020-01-01", "2024-01-15").alias("w"))
        .select(
            TENANT,
            F.concat(F.lit("N"), n).alias("API_Name"),
            (n % 8 + 1).alias("vCPUs"),
            ((n + 1) * 0.125 + F.col("w.v") * 0.5).alias("Compute_Contract_Price"),
            ((n + 1) * 0.0625).alias("Hourly_Units"),
            "w.activeFrom", "w.activeUntil", "w.isActive",
        )
    )


def unit_prices(t: Tables) -> DataFrame:
    skus = F.array(*[F.lit(s) for s in ("interactive", "automated", "sqlCompute", "jobsLight", "unknown")])
    both = F.explode(F.array(F.lit("t0"), F.lit("t1")))
    return (
        t.region.select("r_regionkey", both.alias(TENANT))
        .select("*", _versions("2020-01-01", "2024-01-10").alias("w"))
        .select(
            TENANT,
            F.get(skus, F.col("r_regionkey").cast("int")).alias("sku"),
            ((F.col("r_regionkey") + 1) * 0.25 + F.col("w.v") * 0.125).alias("contract_price"),
            "w.activeFrom", "w.activeUntil", "w.isActive",
        )
    )


PRICE_SQL = """
machines AS (SELECT o.org, 'n' || n_nationkey AS api, n_nationkey % 8 + 1 AS cpus, (n_nationkey + 1) * 0.125::DOUBLE + v.i * 0.5::DOUBLE AS price,
  (n_nationkey + 1) * 0.0625::DOUBLE AS units,
  CASE v.i WHEN 0 THEN 1577836800000 ELSE 1705276800000 END AS f, CASE v.i WHEN 0 THEN 1705276800000 ELSE 1706745600000 END AS u
  FROM nation, (VALUES ('t0'), ('t1')) o(org), (VALUES (0), (1)) v(i)),
rates AS (SELECT o.org, ['interactive', 'automated', 'sqlCompute', 'jobsLight', 'unknown'][r_regionkey + 1] AS sku,
  (r_regionkey + 1) * 0.25::DOUBLE + v.i * 0.125::DOUBLE AS rate, CASE v.i WHEN 0 THEN 1577836800000 ELSE 1704844800000 END AS t
  FROM region, (VALUES ('t0'), ('t1')) o(org), (VALUES (0), (1)) v(i))"""


def gold_runs(t: Tables) -> DataFrame:
    """Runs that start with an event and last by its value; some are still open."""
    start = ms("ts")
    end = F.when(F.col("event_id") % 50 != 0, start + F.floor(F.col("value") * 600_000))
    none = F.lit(None).cast("string")
    kind = F.col("event_type")
    return t.events.select(
        tenant("user_id"),
        F.lit("north").alias("workspace_name"),
        F.col("user_id").alias("job_id"),
        F.concat(F.lit("job"), F.col("user_id")).alias("job_name"),
        F.col("event_id").alias("run_id"),
        F.col("event_id").alias("job_run_id"),
        F.col("event_id").alias("task_run_id"),
        none.alias("task_key"),
        F.lit(None).cast("bigint").alias("repair_id"),
        none.alias("run_name"),
        start.alias("startEpochMS"),
        cluster("user_id"),
        none.alias("cluster_name"),
        F.when(kind == "purchase", "existing").otherwise("new").alias("cluster_type"),
        F.lit(None).cast("bigint").alias("multitask_parent_run_id"),
        F.lit(None).cast("bigint").alias("parent_run_id"),
        run_time(start, end).alias("task_runtime"),
        run_time(start, end).alias("task_execution_runtime"),
        F.when(end.isNotNull(), "Succeeded").alias("terminal_state"),
        F.lit("manual").alias("job_trigger_type"),
        F.lit("notebook").alias("task_type"),
        none.alias("created_by"),
        none.alias("last_edited_by"),
    )


RUN_SQL = """
runs AS (SELECT 't' || user_id % 2 AS org, 'c' || user_id AS cluster_id, user_id AS job_id, event_id AS run_id,
  CASE event_type WHEN 'purchase' THEN 'existing' ELSE 'new' END AS ctype, epoch_us(ts) // 1000 AS s,
  CASE WHEN event_id % 50 <> 0 THEN epoch_us(ts) // 1000 + CAST(floor(value * 600000) AS BIGINT) END AS e0
  FROM events)"""
