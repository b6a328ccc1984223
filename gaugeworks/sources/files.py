"""File sources: dated folders, landed pages, event logs, discovery of new files."""

from __future__ import annotations

import datetime as dt
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.text import group_filename, path_part_from_end, row_hash
from gaugeworks.functions.timeutil import days_between, string_ts_to_unix_millis
from gaugeworks.operators.joins import prefix_join
from gaugeworks.operators.schema import (
    NAME_RULES,
    NameException,
    json_schema,
    scrub_schema,
    struct_from_json,
    struct_to_map,
)
from gaugeworks.sources.tables import TENANT

# Field and event names of the input.
BULKY_EVENT_FIELDS = [
    "Classpath Entries",
    "System Properties",
    "sparkPlanInfo",
    "Spark Properties",
    "HadoopProperties",
    "Hadoop Properties",
    "SparkContext Id",
    "Stage Infos",
]
SPECULATIVE_EVENT = "org.apache.spark.scheduler.SparkListenerSpeculativeTaskSubmitted"
STREAM_STARTED_EVENT = "org.apache.spark.sql.streaming.StreamingQueryListener$QueryStartedEvent"
DROPPED_PROPERTY = "sparkexecutorextraClassPath"
PROPERTY_RULES = [(r"\s", ""), (r"\.", ""), (r"[^a-zA-Z0-9]", "_")]
PAGE_WRAPPERS = ["clusters", "jobs", "runs", "res", "events", "policies", "instance_pools"]


@contextmanager
def case_sensitive(spark: SparkSession):
    """Column names that differ only in case stay apart inside the block."""
    before = spark.conf.get("spark.sql.caseSensitive")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.caseSensitive", before)


def read_dated_folders(
    spark: SparkSession, root: str, fmt: str, start: dt.date, until: dt.date, schema: T.StructType | None = None
) -> DataFrame:
    """Rows of the ``date=`` folders in [start, until]; days without folder are skipped.

    One glob names all the days, so only their folders are listed and the
    date comes from the folder name.
    """
    days = days_between(start, until + dt.timedelta(days=1))
    glob = ",".join(d.isoformat() for d in days)
    reader = spark.read.format(fmt).option("basePath", root)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(f"{root}/date={{{glob}}}")
    return df.withColumn("date", F.col("date").cast("date"))


def with_audit_hash(df: DataFrame, tenant: str | None = None) -> DataFrame:
    """Tenant and hash key of audit records."""
    if tenant is not None:
        df = df.withColumn(TENANT, F.lit(tenant))
    keys = [F.col(c) for c in (TENANT, "timestamp", "serviceName", "actionName", "requestId")]
    return df.withColumn("hashKey", row_hash(*keys, payload=F.col("requestParams")))


def read_audit_folders(
    spark: SparkSession, root: str, fmt: str, start: dt.date, until: dt.date, tenant: str,
    schema: T.StructType | None = None,
) -> DataFrame:
    with case_sensitive(spark):
        df = read_dated_folders(spark, root, fmt, start, until, schema)
        df = df.withColumn("filename", F.col("_metadata.file_path"))
        return with_audit_hash(df, tenant)


def decode_envelopes(
    landed: DataFrame, body: str = "body", schema: T.StructType | None = None,
    params_schema: T.StructType | None = None, response_schema: T.StructType | None = None,
    identity_schema: T.StructType | None = None,
) -> DataFrame:
    """Audit rows out of messages ``{"records": [...]}``.

    ``properties`` of a record become columns; request parameters, response
    and identity are JSON texts within and are parsed too. Known schemas spare
    a pass each.
    """
    text = landed.withColumn("__body", F.col(body).cast("string"))
    parsed = text.withColumn("__parsed", struct_from_json(text, "__body", schema=schema))
    records = parsed.select(F.explode("__parsed.records").alias("r"), *([TENANT] if TENANT in landed.columns else []))
    flat = records.select("r.*", *([TENANT] if TENANT in landed.columns else []))
    at = F.to_timestamp("time")
    rows = flat.select(
        "category",
        F.col("operationVersion").alias("version"),
        (F.unix_seconds(at) * 1000).alias("timestamp"),
        at.cast("date").alias("date"),
        F.col("identity").alias("userIdentity"),
        *([TENANT] if TENANT in landed.columns else []),
        "properties.*",
    )
    return rows.withColumns(
        {
            "userIdentity": struct_from_json(rows, "userIdentity", schema=identity_schema),
            "requestParams": struct_from_json(rows, "requestParams", schema=params_schema),
            "response": struct_from_json(rows, "response", schema=response_schema),
        }
    ).drop("logId")


def read_landed_pages(spark: SparkSession, path: str, tenant: str, schema: T.StructType | None = None) -> DataFrame:
    """Entities out of landed API pages: the wrapper array is exploded."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    pages = reader.json(path)
    return explode_pages(pages).withColumn(TENANT, F.lit(tenant))


def explode_pages(pages: DataFrame) -> DataFrame:
    for name in PAGE_WRAPPERS:
        if name in pages.columns and isinstance(pages.schema[name].dataType, T.ArrayType):
            return pages.select(F.explode(name).alias("e")).select("e.*")
    return pages


def read_validity_csv(spark: SparkSession, path: str, tenant: str, active_from: dt.date, doubles: list[str] | None = None) -> DataFrame:
    """A CSV dimension, valid from a date on."""
    df = spark.read.option("header", True).option("inferSchema", True).csv(path)
    df = df.withColumns({c: F.col(c).cast("double") for c in doubles or [] if c in df.columns})
    return df.withColumns(
        {
            TENANT: F.lit(tenant),
            "activeFrom": F.lit(active_from),
            "activeUntil": F.lit(None).cast("date"),
            "isActive": F.lit(True),
        }
    )


# --- discovery --------------------------------------------------------------


def file_name() -> Column:
    """The plain path of a row's file; the hidden column has it with blanks and % escaped."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def _listed(spark: SparkSession, roots: list[str], glob: str) -> DataFrame:
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
    return reader.load(roots).select(file_name().alias("filename"), "length", "modificationTime")


def readable_roots(spark: SparkSession, roots: list[str], glob: str) -> tuple[list[str], list[tuple[str, str]]]:
    """The roots that can be listed, and the others with the reason; asked one by one only if one fails."""
    try:
        _listed(spark, roots, glob)
        return list(roots), []
    except (AnalysisException, Py4JJavaError):
        pass
    good, failed = [], []
    for root in roots:
        try:
            _listed(spark, [root], glob)
            good.append(root)
        except AnalysisException as e:
            failed.append((root, e.getCondition() or str(e)[:200]))
        except Py4JJavaError as e:
            failed.append((root, str(e.java_exception)[:200]))
    return good, failed


def discover_files(
    spark: SparkSession, roots: list[str], glob: str, from_ms: int, until_ms: int
) -> DataFrame:
    """All files under the roots with size, time, and whether the time is in range.

    Spark lists the folders in parallel; no content is read. A root that is missing
    or cannot be listed gives a row of its own with ``failed`` and the reason.
    """
    good, failed = readable_roots(spark, roots, glob)
    empty = "filename string, length bigint, modificationTime timestamp"
    found = _listed(spark, good, glob) if good else spark.createDataFrame([], empty)
    found = found.withColumn("failMsg", F.lit(None).cast("string"))
    if failed:
        rows = spark.createDataFrame(failed, "filename string, failMsg string")
        found = found.unionByName(rows, allowMissingColumns=True)
    ms = F.unix_millis("modificationTime")
    return found.select(
        "filename",
        F.col("length").alias("fileSize"),
        ms.alias("fileCreateEpochMS"),
        F.col("modificationTime").alias("fileCreateTS"),
        F.col("modificationTime").cast("date").alias("fileCreateDate"),
        F.coalesce(ms.between(from_ms, until_ms - 1), F.lit(False)).alias("withinSpecifiedTimeRange"),
        F.col("failMsg").isNotNull().alias("failed"),
        "failMsg",
    )


def new_files(found: DataFrame, processed: DataFrame | None, bad: DataFrame | None = None) -> DataFrame:
    """Found files that were neither processed in range nor found to be bad."""
    out = found
    if processed is not None:
        done = processed.filter(~F.col("failed") & F.col("withinSpecifiedTimeRange"))
        out = out.join(done.select("filename"), "filename", "left_anti")
    if bad is not None:
        out = out.join(bad.select("filename"), "filename", "left_anti")
    return out


def rewrite_prefixes(df: DataFrame, mounts: DataFrame, scheme: str = "file:") -> DataFrame:
    """Event-log roots with mount points replaced by their storage path.

    ``df`` has cluster_id and cluster_log_conf, ``mounts`` mount_point and
    source. Sub-folders below a mount are kept.
    """
    def trimmed(c: str) -> Column:
        return F.regexp_replace(F.col(c), "/$", "")

    m = mounts.select(trimmed("mount_point").alias("mount_point"), trimmed("source").alias("source"))
    m = m.filter(F.col("mount_point") != "")
    paths = df.withColumn("__p", F.regexp_replace(trimmed("cluster_log_conf"), f"^{scheme}", ""))
    joined = prefix_join(paths, "__p", m, "mount_point")
    parts, mount = F.split("__p", "/"), F.split("mount_point", "/")
    below = F.concat_ws("/", F.col("source"), F.array_join(F.array_except(parts, mount), "/"))
    derived = F.when(F.col("source").isNull(), F.col("__p")).otherwise(
        F.when(F.size(parts) > F.size(mount), below).otherwise(F.col("source"))
    )
    return joined.select(
        F.concat_ws("/", derived, F.col("cluster_id"), F.lit("eventlog")).alias("wildPrefix"), "cluster_id"
    )


# --- event logs -------------------------------------------------------------


def _second(ms: int) -> str:
    """A time for the reader's options, in whole seconds and UTC."""
    return dt.datetime.fromtimestamp(max(ms, 0) // 1000, dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S")


def _folder_value(part: Column) -> Column:
    return F.regexp_replace(part, "^[A-Za-z]+=", "")


def read_event_logs(
    spark: SparkSession,
    roots: list[str],
    files: DataFrame,
    tenant: str,
    glob: str = "*",
    schema: T.StructType | None = None,
    from_ms: int | None = None,
    until_ms: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Event rows of the new files, and the lines that are no valid JSON.

    The files are read from their folders and joined on their names to the
    discovered ones, so the list never passes through the driver. Files changed
    before ``from_ms`` or after ``until_ms`` are not opened.
    """
    with case_sensitive(spark):
        reader = (
            spark.read.option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", glob)
            .option("timeZone", "UTC")
        )
        if from_ms is not None:
            reader = reader.option("modifiedAfter", _second(from_ms - 1000))
        if until_ms is not None:
            reader = reader.option("modifiedBefore", _second(until_ms + 1000))
        if schema is None:
            schema = reader.json(roots).schema
        if "_corrupt_record" not in schema.fieldNames():
            schema = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
        raw = reader.schema(schema).json(roots).withColumn("filename", file_name())
        slim = raw.drop(*[c for c in BULKY_EVENT_FIELDS if c in raw.columns])
        # a line is an event when it is valid JSON and says which; both lists together hold every line
        is_event = F.col("_corrupt_record").isNull() & F.col("Event").isNotNull()
        bad = slim.filter(~is_event).select("filename", F.col("_corrupt_record").alias("record"))
        good = slim.filter(is_event).drop("_corrupt_record")
        events = _unified_events(good)
        name = F.col("filename")
        placed = events.withColumns(
            {
                "SparkContextID": _folder_value(path_part_from_end(name, 2)),
                "clusterId": _folder_value(path_part_from_end(name, 5)),
                "filenameGroup": group_filename(name),
            }
        )
        exceptions = [NameException("Properties", PROPERTY_RULES, True)] if "Properties" in placed.columns else []
        clean = scrub_schema(placed, NAME_RULES, exceptions)
        maps = {
            c: struct_to_map(clean.schema, c)
            for c in ("Properties", "modifiedConfigs", "extraTags")
            if c in clean.columns
        }
        if "Properties" in maps:
            maps["Properties"] = F.map_filter(maps["Properties"], lambda k, _: k != DROPPED_PROPERTY)
        meta = files.select("filename", "fileSize", "fileCreateEpochMS", "fileCreateDate")
        out = clean.withColumns(maps).join(meta, "filename").withColumn(TENANT, F.lit(tenant))
        if "TaskMetrics" in out.columns and isinstance(out.schema["TaskMetrics"].dataType, T.StructType):
            if "UpdatedBlocks" in out.schema["TaskMetrics"].dataType.fieldNames():
                out = out.withColumn("TaskMetrics", F.col("TaskMetrics").dropFields("UpdatedBlocks"))
        return out, bad


def _unified_events(df: DataFrame) -> DataFrame:
    """One name for fields that events spell in several ways (case-sensitive names)."""
    have = set(df.columns)
    out = {}
    if "timestamp" in have:
        text = string_ts_to_unix_millis(F.col("timestamp"))
        if "Timestamp" in have:
            started = F.col("Timestamp").isNull() & (F.col("Event") == STREAM_STARTED_EVENT)
            out["Timestamp"] = F.when(started, text).otherwise(F.col("Timestamp"))
        else:
            out["Timestamp"] = text
    if "progress" in have:
        out["progress"] = (
            F.col("progress") if isinstance(df.schema["progress"].dataType, T.StringType) else F.to_json("progress")
        )
    if "Executor ID" in have and "executorId" in have:
        out["Executor ID"] = F.coalesce(F.col("Executor ID"), F.col("executorId"))
    for wide, narrow in (("Stage ID", "stageId"), ("Stage Attempt ID", "stageAttemptId")):
        if narrow in have and wide in have:
            speculative = F.col("Event") == SPECULATIVE_EVENT
            out[wide] = F.when(speculative, F.col(narrow)).otherwise(F.col(wide))
    gone = [c for c in ("timestamp", "executorId", "stageId", "stageAttemptId") if c in have]
    return df.withColumns(out).drop(*gone) if out or gone else df


def infer_page_schema(df: DataFrame, column: str) -> T.DataType:
    return json_schema(df, column)
