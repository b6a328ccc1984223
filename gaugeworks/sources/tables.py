"""Keyed tables on parquet: description, reads, writes, upserts, deletes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.timeutil import epoch_ms
from gaugeworks.operators.dedup import drop_duplicate_keys, keep_first
from gaugeworks.operators.schema import apply_filters, columns_to_front, enforce_schema
from gaugeworks.session import materialize

TENANT = "organization_id"
NOISE = "part_noise"
NOISE_BUCKETS = 32
FULL, INSERT_ONLY, UPDATE_ONLY = "full", "insertOnly", "updateOnly"
# Marks the one row that stands for a partition without rows; readers leave it out.
EMPTIED = "partition_is_empty"
_HIT = "__hit"
# Touched partition values that are named one by one in a filter; beyond, their range.
MAX_NAMED_VALUES = 1_000


@dataclass(frozen=True)
class TableSpec:
    """A table: its folder, keys, time columns, partitions and write rules."""

    name: str
    path: str
    keys: tuple[str, ...]
    incremental: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = (TENANT,)
    mode: str = "append"  # append, overwrite, merge
    scope: str = FULL
    index_columns: tuple[str, ...] = ()
    required: T.StructType | None = None
    dedup: bool = True
    tie_break: tuple[str, ...] = field(default=())

    @property
    def match_keys(self) -> list[str]:
        """Business keys, time columns and partitions, without the noise column."""
        names = [*self.keys, *self.incremental, *self.partition_by]
        return [c for c in dict.fromkeys(names) if c != NOISE]


def read_table(spark: SparkSession, spec: TableSpec, filters: list[Column] | None = None) -> DataFrame:
    """The table with filters and minimum schema; a missing one reads as empty."""
    try:
        df = spark.read.option("mergeSchema", "true").parquet(spec.path)
    except AnalysisException:
        if spec.required is None:
            raise
        return spark.createDataFrame([], spec.required)
    if EMPTIED in df.columns:
        df = df.filter(F.col(EMPTIED).isNull()).drop(EMPTIED)
    return enforce_schema(apply_filters(df, filters or []), spec.required)


def exists(spark: SparkSession, spec: TableSpec) -> bool:
    try:
        spark.read.parquet(spec.path)
        return True
    except AnalysisException:
        return False


def incremental_filters(
    schema: T.StructType,
    columns: list[str],
    partition_by: list[str],
    start: dt.datetime,
    until: dt.datetime,
    lag_days: int = 0,
) -> list[Column]:
    """Bounds of a run for each time column of a table.

    Dates include both ends and must be partition columns; timestamps and epoch
    milliseconds include the start only. Lag days move the start back.
    """
    names = {c.lower() for c in columns}
    parts = {c.lower() for c in partition_by}
    low = start - dt.timedelta(days=lag_days)
    out = []
    for f in schema.fields:
        if f.name.lower() not in names:
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            if f.name.lower() not in parts:
                raise ValueError(f"date column {f.name} must be a partition column")
            out.append((c >= F.lit(low.date())) & (c <= F.lit(until.date())))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            out.append((c >= F.lit(low)) & (c < F.lit(until)))
        elif isinstance(f.dataType, T.LongType):
            out.append((c >= F.lit(epoch_ms(low))) & (c < F.lit(epoch_ms(until))))
        else:
            raise ValueError(f"type {f.dataType.simpleString()} of {f.name} cannot bound a run")
    return out


def read_incremental(
    spark: SparkSession,
    spec: TableSpec,
    start: dt.datetime,
    until: dt.datetime,
    columns: list[str] | None = None,
    lag_days: int = 0,
    filters: list[Column] | None = None,
) -> DataFrame:
    """The rows of one run. The filters reach the partitions and the files."""
    df = read_table(spark, spec, filters)
    bounds = incremental_filters(
        df.schema, list(columns or spec.incremental), list(spec.partition_by), start, until, lag_days
    )
    return apply_filters(df, bounds)


def prepare_write(
    df: DataFrame, spec: TableSpec, snapshot_ts: dt.datetime, run_id: str, tenant_name: str | None = None
) -> DataFrame:
    """Add snapshot time, run id and tenant name, and keep one row per key."""
    stamped = {"snapshot_ts": F.lit(snapshot_ts), "run_id": F.lit(run_id)}
    if tenant_name is not None:
        stamped["workspace_name"] = F.lit(tenant_name)
    df = df.withColumns(stamped)
    if not spec.dedup:
        return df
    keys = [c for c in spec.match_keys if c in df.columns]
    return keep_first(df, keys, list(spec.tie_break))


def write_layout(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Index columns first, and rows gathered by partition before the write.

    The rebalance hint lets Spark split a partition that would become too
    large and join small ones. Where a table has a noise column it is a hash
    of the keys, so a repeated write gives the same files.
    """
    front = [c for c in spec.index_columns if c in df.columns]
    if front:
        df = columns_to_front(df, front)
    if NOISE in spec.partition_by:
        hashed = F.xxhash64(*[c for c in spec.keys if c in df.columns])
        df = df.withColumn(NOISE, F.pmod(hashed, F.lit(NOISE_BUCKETS)).cast("int"))
    return df.hint("rebalance", *[F.col(c) for c in spec.partition_by]) if spec.partition_by else df


def write_table(df: DataFrame, spec: TableSpec) -> None:
    """Write by the table's mode."""
    spark = df.sparkSession
    if spec.mode == "merge" and exists(spark, spec):
        upsert(df, spec)
        return
    writer = write_layout(df, spec).write.mode("overwrite" if spec.mode == "overwrite" else "append")
    # an overwrite of a whole table must also drop the partitions that got no rows
    writer.option("partitionOverwriteMode", "static").partitionBy(*spec.partition_by).parquet(spec.path)


def same_values(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Equality of columns in which nulls are equal too."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def _semi(left: DataFrame, right: DataFrame, columns: list[str], how: str = "left_semi") -> DataFrame:
    return left.join(right, same_values(left, right, columns), how)


def touched_filter(rows: DataFrame, columns: list[str]) -> Column:
    """A filter of literals for the partition values that occur in `rows`.

    Literals let Spark prune the partitions before it lists and reads files. The
    values of a column are named one by one up to a bound, else by their range; it
    may let other partitions pass, so a join on the exact values follows.
    """
    kinds = {c: F.col(c) for c in columns}
    asked = []
    for c, v in kinds.items():
        asked += [F.count_distinct(v).alias(f"n_{c}"), F.min(v).alias(f"min_{c}"), F.max(v).alias(f"max_{c}")]
        asked.append(F.count_if(v.isNull()).alias(f"null_{c}"))
    facts = rows.agg(*asked).first()
    out = F.lit(True)
    for c, v in kinds.items():
        if facts[f"n_{c}"] <= MAX_NAMED_VALUES:
            named = [r[0] for r in rows.select(c).filter(v.isNotNull()).distinct().collect()]
            hit = v.isin(*named) if named else F.lit(False)
        else:
            hit = v.between(F.lit(facts[f"min_{c}"]), F.lit(facts[f"max_{c}"]))
        out = out & ((hit | v.isNull()) if facts[f"null_{c}"] else hit)
    return out


def touched_part(spark: SparkSession, spec: TableSpec, touched: DataFrame) -> DataFrame:
    """The rows of the stored table in the partitions of `touched`."""
    parts = list(spec.partition_by)
    return _semi(read_table(spark, spec, [touched_filter(touched, parts)]), touched, parts)


def upsert(updates: DataFrame, spec: TableSpec) -> None:
    """Merge rows into a table by its keys; null keys and partition values match each other.

    Only the partitions the updates touch are read and rewritten. The merged
    rows are first written to the shared folder, since a folder cannot be read
    and overwritten in one job. One writer per table at a time.
    """
    spark = updates.sparkSession
    updates = materialize(write_layout(updates, spec), f"upsert-{spec.name}")
    keys, parts = spec.match_keys, list(spec.partition_by)
    if parts:
        target = touched_part(spark, spec, materialize(updates.select(*parts).distinct(), f"touched-{spec.name}"))
    else:
        target = read_table(spark, spec)
    fresh, old = updates.select(*keys), target.select(*keys)
    if spec.scope == INSERT_ONLY:
        merged = target.unionByName(_semi(updates, old, keys, "left_anti"), allowMissingColumns=True)
    elif spec.scope == UPDATE_ONLY:
        changed = _semi(updates, old, keys)
        merged = _semi(target, fresh, keys, "left_anti").unionByName(changed, allowMissingColumns=True)
    else:
        merged = _semi(target, fresh, keys, "left_anti").unionByName(updates, allowMissingColumns=True)
    _replace_partitions(materialize(merged, f"merge-{spec.name}"), spec)


def _replace_partitions(df: DataFrame, spec: TableSpec) -> None:
    layout = df.hint("rebalance", *[F.col(c) for c in spec.partition_by]) if spec.partition_by else df
    mode = "dynamic" if spec.partition_by else "static"
    layout.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(
        *spec.partition_by
    ).parquet(spec.path)


def rewrite_where(
    spark: SparkSession,
    spec: TableSpec,
    condition: Column,
    change: Callable[[DataFrame], DataFrame] | None,
    facts: DataFrame | None = None,
    on: list[str] | None = None,
) -> int:
    """Delete (``change`` None) or change the rows that meet a condition; their number.

    The condition may also use the columns of ``facts``, a stored frame with one row for
    each value of the columns ``on``, which is joined to the table (nulls match
    each other); rows without facts are not met. Reads and rewrites the partitions with such rows only. A partition left without
    rows is overwritten by one row that marks it as empty (see EMPTIED), in the same
    write, so no folder is named or removed by hand. A change must leave the
    partition columns as they are.
    """
    table = read_table(spark, spec)

    def marked(df: DataFrame) -> DataFrame:
        if facts is None:
            return df.withColumn(_HIT, F.coalesce(condition, F.lit(False)))
        known = facts.withColumnsRenamed({c: f"__on_{c}" for c in on})
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__on_{c}")) for c in on])
        return df.join(known, same, "left").select(*df.columns, F.coalesce(condition, F.lit(False)).alias(_HIT))

    parts = list(spec.partition_by)
    hits = marked(table).filter(_HIT)
    if parts:
        counted = hits.groupBy(*parts).agg(F.count(F.lit(1)).alias(_HIT))
        touched = materialize(counted, f"touched-{spec.name}")
        n = touched.agg(F.sum(_HIT)).first()[0] or 0
    else:
        n = hits.count()
    if n == 0:
        return 0
    touched = touched.drop(_HIT) if parts else None
    scope = marked(touched_part(spark, spec, touched) if parts else table)
    rest = scope.filter(~F.col(_HIT)).drop(_HIT)
    if change is not None:
        rest = rest.unionByName(change(scope.filter(_HIT).drop(_HIT)), allowMissingColumns=True)
    staged = materialize(rest, f"rewrite-{spec.name}")
    if touched is not None:
        gone = _semi(touched, staged.select(*parts).distinct(), parts, "left_anti")
        if gone.take(1):
            staged = staged.unionByName(gone.withColumn(EMPTIED, F.lit(True)), allowMissingColumns=True)
    _replace_partitions(staged, spec)
    return n


def delete_where(
    spark: SparkSession, spec: TableSpec, condition: Column, facts: DataFrame | None = None, on: list[str] | None = None
) -> int:
    return rewrite_where(spark, spec, condition, None, facts, on)


def update_where(
    spark: SparkSession,
    spec: TableSpec,
    condition: Column,
    values: dict[str, Column],
    facts: DataFrame | None = None,
    on: list[str] | None = None,
) -> int:
    moved = set(values) & set(spec.partition_by)
    if moved:
        raise ValueError(f"partition columns cannot be changed in place: {sorted(moved)}")
    return rewrite_where(spark, spec, condition, lambda df: df.withColumns(values), facts, on)


def rollback_run(spark: SparkSession, specs: list[TableSpec], run_id: str, tracker: TableSpec | None = None) -> DataFrame:
    """Delete what a run wrote from tables that belong together.

    Rows of the file tracker stay and are marked as failed.
    """
    report = [(s.name, delete_where(spark, s, F.col("run_id") == run_id)) for s in specs]
    if tracker is not None:
        failed = {"failed": F.lit(True)}
        report.append((tracker.name, update_where(spark, tracker, F.col("run_id") == run_id, failed)))
    return spark.createDataFrame(report, "table_name string, rows_changed bigint")


def at_or_after(schema: T.StructType, columns: list[str], instant_ms: int | Column) -> Column:
    """All of the time columns at or after an instant, which may differ from row to row."""
    instant = instant_ms if isinstance(instant_ms, Column) else F.lit(instant_ms)
    moment = F.timestamp_millis(instant)
    conditions = []
    for name in columns:
        kind, c = schema[name].dataType, F.col(name)
        if isinstance(kind, T.DateType):
            conditions.append(c >= F.to_date(F.date_trunc("day", moment)))
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            conditions.append(c >= moment)
        else:
            conditions.append(c.cast("bigint") >= instant)
    return reduce(lambda a, b: a & b, conditions)


def delete_duplicates(spark: SparkSession, spec: TableSpec, order: list[Column | str]) -> DataFrame:
    """Keep one row per key in the stored table; the report of dropped rows.

    Only partitions that hold repeated keys are rewritten.
    """
    keys, parts = spec.match_keys, list(spec.partition_by)
    table = read_table(spark, spec)
    _, report = drop_duplicate_keys(table, keys, order)
    report = materialize(report, f"dups-{spec.name}")
    if report.first().rows_dropped == 0:
        return report
    scope = table
    if parts:
        repeated = table.groupBy(*keys).count().filter("count > 1")
        scope = touched_part(spark, spec, materialize(repeated.select(*parts).distinct(), f"repeated-{spec.name}"))
    _replace_partitions(materialize(keep_first(scope, keys, order), f"dedup-{spec.name}"), spec)
    return report


def compact(spark: SparkSession, spec: TableSpec, cluster_by: list[str], rows_per_file: int = 5_000_000) -> None:
    """Rewrite a table into larger files, clustered for skipping by min and max."""
    df = read_table(spark, spec)
    by = [*spec.partition_by, *cluster_by]
    clustered = materialize(df.repartitionByRange(*by).sortWithinPartitions(*by), f"compact-{spec.name}")
    clustered.write.mode("overwrite").option("partitionOverwriteMode", "static").option(
        "maxRecordsPerFile", rows_per_file
    ).partitionBy(*spec.partition_by).parquet(spec.path)


def snapshot_tables(
    spark: SparkSession, specs: list[TableSpec], target_root: str, exclude: list[str] | None = None
) -> DataFrame:
    """Copy tables to another root; one report row per table."""
    skip = {e.lower() for e in exclude or []}
    report = []
    for spec in specs:
        if spec.name.lower() in skip:
            continue
        to = f"{target_root}/{spec.name}"
        try:
            # a copy must not keep partitions of an earlier one
            writer = read_table(spark, spec).write.mode("overwrite").option("partitionOverwriteMode", "static")
            writer.partitionBy(*spec.partition_by).parquet(to)
            report.append((spec.name, spec.path, to, "SUCCESS"))
        except AnalysisException as e:
            report.append((spec.name, spec.path, to, f"FAILED: {e.getCondition()}"))
    return spark.createDataFrame(report, "table_name string, source string, target string, status string")


def publish_view(
    df: DataFrame,
    name: str,
    columns: list[str] | str = "*",
    tenants: list[str] | None = None,
    sort_by: list[str] | None = None,
    reverse: bool = False,
) -> DataFrame:
    """A temporary view with chosen columns, tenants and order."""
    out = df.filter(F.col(TENANT).isin(tenants)) if tenants else df
    wanted = df.columns if columns == "*" else [c for c in columns if c in df.columns]
    out = out.select(*wanted)
    if sort_by:
        out = out.orderBy(*[F.col(c).desc() if reverse else F.col(c).asc() for c in sort_by])
    out.createOrReplaceTempView(name)
    return out


def persist_errors(errors: DataFrame, spec: TableSpec, tenant: str) -> DataFrame:
    """Append failed fetch ranges with their bounds as timestamps."""
    from gaugeworks.functions.timeutil import to_ts

    out = errors.withColumns(
        {
            "from_ts": to_ts(F.col("from_epoch")),
            "until_ts": to_ts(F.col("until_epoch")),
            TENANT: F.lit(tenant),
        }
    )
    out.write.mode("append").partitionBy(*spec.partition_by).parquet(spec.path)
    return read_table(errors.sparkSession, spec)


def migrate(
    spark: SparkSession, spec: TableSpec, steps: list[tuple[str, Callable[[DataFrame], DataFrame]]],
    partition_by: tuple[str, ...] | None = None,
) -> DataFrame:
    """Apply named schema changes to a stored table and rewrite it once.

    The report has a row per step; the table is only rewritten when all steps
    could be planned.
    """
    df = read_table(spark, spec)
    report, ok = [], True
    for name, step in steps:
        try:
            df = step(df)
            report.append((spec.name, name, "SUCCESS"))
        except (AnalysisException, ValueError) as e:
            report.append((spec.name, name, f"FAILED: {type(e).__name__}"))
            ok = False
            break
    if ok:
        parts = partition_by if partition_by is not None else spec.partition_by
        materialize(df, f"migrate-{spec.name}").write.mode("overwrite").option(
            "partitionOverwriteMode", "static"
        ).partitionBy(*parts).parquet(spec.path)
    return spark.createDataFrame(report, "table_name string, step string, status string")
