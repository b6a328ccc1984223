"""State of module runs: where each module stands and how to roll back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.operators.dedup import keep_first
from gaugeworks.session import materialize
from gaugeworks.sources.tables import TENANT, TableSpec, at_or_after, delete_where, read_table, update_where, write_layout

# Status texts of a finished run.
SUCCESS, EMPTY, FAILED = "SUCCESS", "EMPTY", "FAILED"
DONE = [SUCCESS, EMPTY]
ROLLED_BACK = "ROLLED BACK"

SCHEMA = (
    "organization_id string, workspace_name string, module_id int, module_name string,"
    " from_ts bigint, until_ts bigint, status string, metrics map<string,string>,"
    " run_id string, snapshot_ts timestamp"
)


# A folder per tenant would make a tiny file for each; tenants share a fixed number of folders.
TENANT_BUCKET = "tenant_bucket"
TENANT_BUCKETS = 64


def run_state_table(path: str) -> TableSpec:
    return TableSpec(
        "run_state", path, (TENANT, "module_id", "run_id"), ("snapshot_ts",), (TENANT_BUCKET,),
        required=T.StructType.fromDDL(SCHEMA),
    )


def record_run(state: DataFrame, spec: TableSpec) -> None:
    """Append state rows, gathered by the bucket of their tenant."""
    bucket = F.pmod(F.xxhash64(TENANT), F.lit(TENANT_BUCKETS)).cast("int")
    rows = write_layout(state.withColumn(TENANT_BUCKET, bucket), spec)
    rows.write.mode("append").partitionBy(*spec.partition_by).parquet(spec.path)


def latest_runs(state: DataFrame) -> DataFrame:
    """The newest finished run of each tenant and module."""
    done = state.filter(F.col("status").isin(DONE))
    newest_first = [F.col("snapshot_ts").desc(), F.col("until_ts").desc(), F.col("run_id").desc()]
    return keep_first(done, [TENANT, "module_id"], newest_first)


def next_window(state: DataFrame, primordial_ms: int, snapshot_ms: int, max_days: int) -> DataFrame:
    """From and until of the next run per tenant and module."""
    last = latest_runs(state)
    start = F.coalesce(F.col("until_ts"), F.lit(primordial_ms))
    return last.select(
        TENANT,
        "module_id",
        start.alias("from_ts"),
        F.least(start + F.lit(max_days * 86_400_000), F.lit(snapshot_ms)).alias("until_ts"),
    )


def with_ancestors(dependencies: DataFrame) -> DataFrame:
    """All modules that each module needs, directly or not, from rows (module_id, needs); a ring is an error."""
    known = materialize(dependencies.select("module_id", "needs").distinct(), "needs")
    n = known.count()
    while True:
        # each round doubles the steps that are joined
        further = known.select(F.col("module_id").alias("needs"), F.col("needs").alias("next"))
        joined = known.join(further, "needs").select("module_id", F.col("next").alias("needs"))
        known = materialize(known.unionByName(joined).distinct(), "needs")
        if not known.filter("module_id = needs").isEmpty():
            raise ValueError("modules need each other")
        if (more := known.count()) == n:
            return known
        n = more


def run_windows(
    state: DataFrame,
    modules: DataFrame,
    dependencies: DataFrame,
    primordial_ms: int,
    snapshot_ms: int,
    max_days: int,
) -> DataFrame:
    """From and until of the next run of each module of a tenant, held back by what it needs.

    ``modules`` lists what will run: tenant, module_id, history_days (the most its
    source goes back, or null). ``dependencies`` has rows (module_id, needs).

    A module goes on where its last finished run ended; one that never ran starts at the
    primordial date, or at the end of its source's history. Its own limit is so many days on or
    the snapshot time, not before the source's history. No module passes the least limit of all it
    needs, directly or not: of one that runs too its planned limit, of another the end
    of its last run. Where one of these has never run and will not, or stands before
    the module's start, the window is empty (until = from). Result: tenant, module_id,
    first_run, from_ts, until_ts, held_by (the slowest of the modules needed, the smallest
    number of equally slow ones; null if the module's own limit counts).
    """
    day = 86_400_000
    last = latest_runs(state).select(TENANT, "module_id", F.col("until_ts").alias("done_until"))
    planned = modules.select(TENANT, "module_id", "history_days", F.lit(True).alias("runs"))
    both = planned.join(last, [TENANT, "module_id"], "full_outer")
    oldest = F.lit(snapshot_ms) - F.col("history_days").cast("bigint") * day
    start = F.coalesce("done_until", F.greatest(F.lit(primordial_ms).cast("bigint"), oldest))
    limit = F.greatest(F.least(start + max_days * day, F.lit(snapshot_ms)), oldest)
    reach = both.select(
        TENANT, "module_id", F.coalesce("runs", F.lit(False)).alias("runs"), F.col("done_until").isNull().alias("first_run"),
        start.alias("from_ts"), F.when(F.col("runs"), limit).otherwise(F.col("done_until")).alias("limit_ts"),
    )
    reach = materialize(reach, "reach")
    needed = reach.filter("runs").select(TENANT, "module_id").join(with_ancestors(dependencies), "module_id")
    theirs = reach.select(TENANT, F.col("module_id").alias("needs"), "limit_ts")
    needed = needed.join(theirs, [TENANT, "needs"], "left")
    # a module needed that has no limit never ran and will not; it comes before all others
    slowest = needed.groupBy(TENANT, "module_id").agg(
        F.min(F.struct(F.col("limit_ts").isNotNull().alias("known"), "limit_ts", "needs")).alias("slowest")
    )
    held = F.col("slowest").isNotNull() & (~F.col("slowest.known") | (F.col("slowest.limit_ts") < F.col("limit_ts")))
    until = F.when(held, F.greatest(F.col("from_ts"), F.coalesce("slowest.limit_ts", "from_ts"))).otherwise(F.col("limit_ts"))
    return reach.filter("runs").join(slowest, [TENANT, "module_id"], "left").select(
        TENANT, "module_id", "first_run", "from_ts", until.alias("until_ts"), F.when(held, F.col("slowest.needs")).alias("held_by")
    )


def rollback_points(state: DataFrame, instant_ms: int, modules: list[int], tenants: list[str] | None) -> DataFrame:
    """Start of the first run of each tenant and module that reaches past the instant."""
    reach = state.filter(F.col("module_id").isin(modules) & (F.col("until_ts") >= instant_ms))
    if tenants:
        reach = reach.filter(F.col(TENANT).isin(tenants))
    return reach.groupBy(TENANT, "module_id").agg(F.min("from_ts").alias("rollback_ts"))


def rollback_to(
    spark: SparkSession,
    state_spec: TableSpec,
    targets: dict[int, TableSpec],
    instant_ms: int,
    tenants: list[str] | None = None,
    dry_run: bool = True,
) -> DataFrame:
    """Undo the runs of some modules from an instant on.

    Each table loses the rows at or after its module's cut, and the state rows
    are marked. The plan has one row per tenant and module and is returned; it is
    joined to the tables and never collected. A dry run changes nothing.
    """
    points = rollback_points(read_table(spark, state_spec), instant_ms, list(targets), tenants)
    plan = materialize(points, "rollback-plan")
    if not dry_run:
        cut = F.col("rollback_ts")
        for module, spec in targets.items():
            late = at_or_after(read_table(spark, spec).schema, list(spec.incremental), cut)
            delete_where(spark, spec, late, plan.filter(F.col("module_id") == module).drop("module_id"), [TENANT])
        status = F.concat(F.lit(f"{ROLLED_BACK} - "), F.col("status"))
        update_where(spark, state_spec, F.col("from_ts") >= cut, {"status": status}, plan, [TENANT, "module_id"])
    return plan
