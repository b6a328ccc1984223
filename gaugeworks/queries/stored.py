"""Queries of sources, stored tables and streams.

Each one writes its input, derived from the given tables, to a new folder
under the shared scratch root and reads the outcome back.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions.timeutil import epoch_ms
from gaugeworks.operators import quality as Q
from gaugeworks.operators import schema as S
from gaugeworks.queries.registry import Tables, ms, query
from gaugeworks.session import scratch_path
from gaugeworks.sources import files, runstate, tables
from gaugeworks.sources.tables import TENANT, TableSpec
from gaugeworks.streaming import ingest

UTC = dt.timezone.utc


def moment(*a: int) -> dt.datetime:
    return dt.datetime(*a, tzinfo=UTC)


# --- sources ----------------------------------------------------------------


def audit_rows(t: Tables) -> DataFrame:
    """Audit records made of events."""
    return t.events.select(
        ms("ts").alias("timestamp"),
        F.lit("clusters").alias("serviceName"),
        F.col("event_type").alias("actionName"),
        F.concat(F.lit("r"), F.col("event_id")).alias("requestId"),
        F.struct(F.col("props").alias("props"), F.col("user_id").alias("cluster_id")).alias("requestParams"),
        F.struct(F.when(F.col("event_type") == "error", 400).otherwise(200).alias("statusCode")).alias("response"),
        F.to_date("ts").alias("date"),
    )


@query(
    "src_01_dated_folders",
    """SELECT strftime(ts, '%Y-%m-%d') AS date, 'r' || event_id AS request_id, user_id AS cluster_id, true AS hashed
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-14'""",
)
def dated(t: Tables):
    root = scratch_path(t.spark, "audit")
    audit_rows(t).write.partitionBy("date").json(root)
    out = files.read_audit_folders(t.spark, root, "json", dt.date(2024, 1, 10), dt.date(2024, 1, 14), "t1")
    return out.select(
        F.col("date").cast("string").alias("date"),
        F.col("requestId").alias("request_id"),
        F.col("requestParams.cluster_id").alias("cluster_id"),
        F.col("hashKey").isNotNull().alias("hashed"),
    )


def envelopes(t: Tables) -> DataFrame:
    """Messages of up to fifty audit records each, as JSON text."""
    record = F.struct(
        F.lit("clusters").alias("category"),
        F.lit("1.0").alias("operationVersion"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"),
        F.to_json(F.struct(F.concat(F.lit("u"), F.col("user_id")).alias("email"))).alias("identity"),
        F.struct(
            F.lit("clusters").alias("serviceName"),
            F.col("event_type").alias("actionName"),
            F.concat(F.lit("r"), F.col("event_id")).alias("requestId"),
            F.lit("x").alias("logId"),
            F.to_json(F.struct("user_id", "value")).alias("requestParams"),
            F.to_json(F.struct(F.lit(200).alias("statusCode"))).alias("response"),
        ).alias("properties"),
    )
    packed = t.events.groupBy(F.floor(F.col("event_id") / 50).alias("m")).agg(F.collect_list(record).alias("records"))
    return packed.select(F.to_json(F.struct("records")).cast("binary").alias("body"), F.lit("t1").alias(TENANT))


_ENVELOPE_SQL = """SELECT 'r' || event_id AS request_id, event_type AS action, 'u' || user_id AS email, user_id,
  (epoch_us(ts) // 1000000) * 1000 AS timestamp_ms, CAST(200 AS BIGINT) AS status FROM events"""


@query("src_02_envelopes", _ENVELOPE_SQL)
def decode(t: Tables):
    return _decoded(files.decode_envelopes(envelopes(t)))


def _decoded(out: DataFrame) -> DataFrame:
    return out.select(
        F.col("requestId").alias("request_id"),
        F.col("actionName").alias("action"),
        F.col("userIdentity.email").alias("email"),
        F.col("requestParams.user_id").alias("user_id"),
        F.col("timestamp").alias("timestamp_ms"),
        F.col("response.statusCode").alias("status"),
    )


@query("src_03_message_stream", _ENVELOPE_SQL)
def stream_source(t: Tables):
    """Landed messages read as a stream, stored, then decoded."""
    landed, stored, check = (scratch_path(t.spark, n) for n in ("landed", "stored", "check"))
    envelopes(t).withColumn("body", F.col("body").cast("string")).drop(TENANT).write.json(landed)
    s = ingest.message_stream(t.spark, landed, "body string", "t1", "run1", max_files=2)
    ingest.append_stream(s, stored, check, f"src03_{check[-8:]}").awaitTermination()
    return _decoded(files.decode_envelopes(t.spark.read.parquet(stored), "deserializedBody"))


@query(
    "src_05_file_discovery",
    """SELECT strftime(ts, '%Y-%m-%d') AS day, true AS sized, true AS in_range, false AS failed, NULL AS reason FROM events GROUP BY 1
UNION ALL SELECT 'absent', NULL, false, true, 'PATH_NOT_FOUND'""",
)
def discovery(t: Tables):
    root = scratch_path(t.spark, "found")
    audit_rows(t).write.partitionBy("date").json(root)
    found = files.discover_files(t.spark, [root, root + "/absent"], "part-*", 0, epoch_ms(moment(2100, 1, 1)))
    day = F.regexp_extract("filename", "date=([^/]+)", 1)
    return found.groupBy(F.when(day != "", day).otherwise("absent").alias("day")).agg(
        F.bool_and(F.col("fileSize") > 0).alias("sized"),
        F.bool_and("withinSpecifiedTimeRange").alias("in_range"),
        F.bool_or("failed").alias("failed"),
        F.max("failMsg").alias("reason"),
    )


@query(
    "src_06_new_files",
    """SELECT page_id, url AS filename FROM pages WHERE page_id % 3 <> 0 AND page_id % 7 <> 0""",
)
def fresh_files(t: Tables):
    found = t.pages.select("page_id", F.col("url").alias("filename"))
    found = found.withColumn("filename", F.concat("filename", F.lit("#"), F.col("page_id")))
    flags = [F.lit(False).alias("failed"), F.lit(True).alias("withinSpecifiedTimeRange")]
    done = found.filter(F.col("page_id") % 3 == 0).select("filename", *flags)
    # files that failed, or lay outside the range, are to be read again
    failed = found.filter(F.col("page_id") % 3 == 1).select("filename", F.lit(True).alias("failed"), flags[1])
    bad = found.filter(F.col("page_id") % 7 == 0)
    out = files.new_files(found, done.unionByName(failed), bad)
    return out.select("page_id", F.regexp_replace("filename", "#\\d+$", "").alias("filename"))


@query(
    "src_07_landed_pages",
    "SELECT c_custkey AS id, c_name AS cluster_name, 't1' AS organization_id FROM customer",
)
def landed_pages(t: Tables):
    path = scratch_path(t.spark, "pages")
    entity = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("cluster_name"))
    page = t.customer.groupBy(F.floor(F.col("c_custkey") / 20).alias("page")).agg(F.collect_list(entity).alias("clusters"))
    page.write.json(path)
    return files.read_landed_pages(t.spark, path, "t1").select("id", "cluster_name", TENANT)


@query(
    "src_08_validity_csv",
    """SELECT 'n' || p_partkey AS api_name, p_retailprice AS hourly, CAST(p_size AS DOUBLE) AS memory_gb, 't1' AS organization_id,
  '2024-01-01' AS active_from, true AS is_active, true AS open FROM part""",
)
def dimension(t: Tables):
    path = scratch_path(t.spark, "prices")
    t.part.select(
        F.concat(F.lit("n"), F.col("p_partkey")).alias("API_Name"),
        F.col("p_retailprice").alias("hourly"),
        F.col("p_size").alias("Memory_GB"),
    ).write.option("header", True).csv(path)
    out = files.read_validity_csv(t.spark, path, "t1", dt.date(2024, 1, 1), ["Memory_GB", "hourly"])
    return out.select(
        F.col("API_Name").alias("api_name"),
        "hourly",
        F.col("Memory_GB").alias("memory_gb"),
        TENANT,
        F.col("activeFrom").cast("string").alias("active_from"),
        F.col("isActive").alias("is_active"),
        F.col("activeUntil").isNull().alias("open"),
    )


@query(
    "src_13_prefix_rewrite",
    """WITH m AS (SELECT DISTINCT '/mnt/' || string_split(url, '/')[3] AS mount, 'store://' || upper(string_split(url, '/')[3]) AS source FROM pages
  WHERE url LIKE 'https%'),
p AS (SELECT page_id, '/mnt/' || string_split(url, '/')[3] || '/' || string_split(url, '/')[4] || 'x' || page_id AS path FROM pages)
SELECT CAST(page_id AS VARCHAR) AS cluster_id, coalesce(source || '/' || string_split(path, '/')[4], path) || '/' || page_id || '/eventlog' AS prefix
FROM p LEFT JOIN m ON starts_with(path, mount)""",
)
def prefixes(t: Tables):
    part = F.split("url", "/")
    conf = t.pages.select(
        F.col("page_id").cast("string").alias("cluster_id"),
        F.concat(F.lit("file:/mnt/"), part[2], F.lit("/"), part[3], F.lit("x"), F.col("page_id"), F.lit("/")).alias(
            "cluster_log_conf"
        ),
    )
    mounts = (
        t.pages.filter("url like 'https%'")
        .select(
            F.concat(F.lit("/mnt/"), part[2]).alias("mount_point"),
            F.concat(F.lit("store://"), F.upper(part[2]), F.lit("/")).alias("source"),
        )
        .distinct()
    )
    return files.rewrite_prefixes(conf, mounts).select("cluster_id", F.col("wildPrefix").alias("prefix"))


# --- stored tables ----------------------------------------------------------


def order_table(t: Tables, name: str, **more) -> TableSpec:
    """Orders of a table partitioned by priority, as a description with a new folder."""
    return TableSpec(name, scratch_path(t.spark, name), ("o_orderkey",), partition_by=("o_orderpriority",), **more)


def store(df: DataFrame, spec: TableSpec) -> TableSpec:
    tables.write_table(df, spec)
    return spec


_ORDER = "o_orderkey, o_custkey, o_totalprice, o_orderpriority"


def some_orders(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


# Partition values that are null or hold characters which folder names escape.
_ODD = "CASE o_orderpriority WHEN '2-HIGH' THEN NULL WHEN '3-MEDIUM' THEN '3: 100%/x' ELSE o_orderpriority END"
_ODD_ORDER = f"o_orderkey, o_custkey, o_totalprice, {_ODD} AS o_orderpriority"


def odd_partitions(df: DataFrame) -> DataFrame:
    return df.withColumn("o_orderpriority", F.expr(_ODD))


@query(
    "src_10_read_table",
    f"SELECT {_ORDER}, NULL::VARCHAR AS note FROM orders WHERE o_orderpriority = '1-URGENT'",
)
def read(t: Tables):
    required = T.StructType.fromDDL("note string, o_orderkey bigint")
    spec = store(some_orders(t), order_table(t, "orders10", required=required))
    out = tables.read_table(t.spark, spec, [F.col("o_orderpriority") == "1-URGENT"])
    gone = TableSpec("none", scratch_path(t.spark, "none"), ("o_orderkey",), required=out.schema)
    return out.unionByName(tables.read_table(t.spark, gone))


@query(
    "src_11_read_incremental",
    """SELECT event_id, epoch_us(ts) // 1000 AS timestamp_ms FROM events WHERE ts >= TIMESTAMP '2024-01-08 00:00:00'
  AND epoch_us(ts) // 1000 < epoch_us(TIMESTAMP '2024-01-12 06:00:00') // 1000""",
)
def incremental(t: Tables):
    """Three days of lag move the start back; the date prunes partitions, the time cuts rows."""
    spec = TableSpec(
        "events11", scratch_path(t.spark, "events11"), ("event_id",), ("date", "timestamp_ms"), ("date",)
    )
    store(t.events.select("event_id", ms("ts").alias("timestamp_ms"), F.to_date("ts").alias("date")), spec)
    out = tables.read_incremental(t.spark, spec, moment(2024, 1, 11), moment(2024, 1, 12, 6), lag_days=3)
    return out.select("event_id", "timestamp_ms")


@query("snk_01_write_append", f"SELECT {_ORDER}, CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS o_orderstatus FROM orders")
def append(t: Tables):
    """Two appends; the second brings a new column."""
    spec = order_table(t, "orders01")
    store(some_orders(t).filter(F.col("o_orderkey") % 2 == 0), spec)
    odd = t.orders.filter(F.col("o_orderkey") % 2 == 1)
    store(odd.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus"), spec)
    return tables.read_table(t.spark, spec)


def _upserted(t: Tables, scope: str) -> DataFrame:
    spec = order_table(t, f"orders02{scope}", mode="merge", scope=scope)
    store(odd_partitions(some_orders(t)).filter(F.col("o_orderkey") % 3 != 0), spec)
    new = some_orders(t).filter((F.col("o_orderkey") % 2 == 0) & (F.col("o_orderpriority") != "5-LOW"))
    changed = odd_partitions(new).withColumn("o_totalprice", -F.col("o_orderkey").cast("double"))
    tables.write_table(changed, spec)
    tables.write_table(changed, spec)  # once more changes nothing
    return tables.read_table(t.spark, spec)


_UPD = "o_orderkey % 2 = 0 AND o_orderpriority <> '5-LOW'"


@query(
    "snk_02_upsert",
    f"""SELECT o_orderkey, o_custkey, CASE WHEN {_UPD} THEN -CAST(o_orderkey AS DOUBLE) ELSE o_totalprice END AS o_totalprice, {_ODD} AS o_orderpriority
FROM orders WHERE o_orderkey % 3 <> 0 OR ({_UPD})""",
)
def upsert(t: Tables):
    return _upserted(t, tables.FULL)


@query(
    "snk_02_upsert_insert_only",
    f"""SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN -CAST(o_orderkey AS DOUBLE) ELSE o_totalprice END AS o_totalprice, {_ODD} AS o_orderpriority
FROM orders WHERE o_orderkey % 3 <> 0 OR ({_UPD})""",
)
def insert_only(t: Tables):
    return _upserted(t, tables.INSERT_ONLY)


@query(
    "snk_02_upsert_update_only",
    f"""SELECT o_orderkey, o_custkey, CASE WHEN {_UPD} THEN -CAST(o_orderkey AS DOUBLE) ELSE o_totalprice END AS o_totalprice, {_ODD} AS o_orderpriority
FROM orders WHERE o_orderkey % 3 <> 0""",
)
def update_only(t: Tables):
    return _upserted(t, tables.UPDATE_ONLY)


@query(
    "snk_04_prepare_write",
    f"SELECT {_ORDER}, 'run7' AS run_id, 'north' AS workspace_name, '2024-02-01 00:00:00' AS snapshot FROM orders",
)
def prepare(t: Tables):
    spec = order_table(t, "orders04")
    twice = some_orders(t).unionByName(some_orders(t))
    out = tables.prepare_write(twice, spec, moment(2024, 2, 1), "run7", "north")
    return out.withColumn("snapshot", F.date_format("snapshot_ts", "yyyy-MM-dd HH:mm:ss")).drop("snapshot_ts")


@query(
    "snk_05_write_layout",
    "SELECT CAST(count(*) AS BIGINT) AS n, 'o_totalprice' AS first_column, true AS same_again, CAST(32 AS BIGINT) AS parts FROM orders",
)
def layout(t: Tables):
    """Index columns first; the noise column is the same in a repeated write."""
    spec = TableSpec(
        "orders05", "", ("o_orderkey",), partition_by=("o_orderpriority", tables.NOISE), index_columns=("o_totalprice",)
    )
    one, two = tables.write_layout(some_orders(t), spec), tables.write_layout(some_orders(t), spec)
    both = one.join(two.select("o_orderkey", F.col(tables.NOISE).alias("again")), "o_orderkey")
    return both.agg(
        F.count(F.lit(1)).alias("n"),
        F.lit(one.columns[0]).alias("first_column"),
        F.bool_and(F.col(tables.NOISE) == F.col("again")).alias("same_again"),
        F.count_distinct(tables.NOISE).alias("parts"),
    )


@query(
    "snk_07_published_view",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'P') ORDER BY o_orderkey DESC",
)
def view(t: Tables):
    df = t.orders.withColumnRenamed("o_orderstatus", TENANT)
    tables.publish_view(df, "orders_view", ["o_orderkey", "o_totalprice", "absent"], ["F", "P"], ["o_orderkey"], True)
    return t.spark.table("orders_view")


@query(
    "snk_08_rollback_run",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'run1' ELSE 'run2' END AS run_id, 'a' AS part FROM orders WHERE o_orderkey % 4 IN (0, 1) UNION ALL "
    "SELECT o_custkey, 'run3', 'failed' FROM orders",
)
def rollback(t: Tables):
    """Rows of run3 go, with the partitions they fill alone; the tracker marks them."""
    k = F.col("o_orderkey") % 4
    run = F.when(k == 0, "run1").when(k == 1, "run2").otherwise("run3")
    alone = F.when(F.col("o_custkey") % 2 == 0, "on:ly%3")  # or null
    df = t.orders.select("o_orderkey", run.alias("run_id"), F.when(k == 3, alone).otherwise("mixed").alias("part"))
    spec = TableSpec("orders08", scratch_path(t.spark, "orders08"), ("o_orderkey",), partition_by=("part",))
    store(df, spec)
    track = TableSpec("tracker08", scratch_path(t.spark, "tracker08"), ("o_orderkey",), partition_by=("part",))
    seen = t.orders.select(
        F.col("o_custkey").alias("o_orderkey"), F.lit("run3").alias("run_id"), F.lit("x").alias("part"), F.lit(False).alias("failed")
    )
    store(seen, track)
    tables.rollback_run(t.spark, [spec], "run3", track)
    left = tables.read_table(t.spark, spec).withColumn("part", F.lit("a"))
    tracked = tables.read_table(t.spark, track).withColumn("part", F.when(F.col("failed"), "failed").otherwise("ok"))
    return left.unionByName(tracked.drop("failed"))


def _state_rows(t: Tables, tenant_no: Column) -> DataFrame:
    """A run per tenant, module and ten days of January."""
    day = 86_400_000
    start = F.lit(epoch_ms(moment(2024, 1, 1))) + F.col("n") * 10 * day
    tenants = t.events.select(tenant_no.alias("k")).distinct()
    return (
        tenants.select(
            F.concat(F.lit("t"), F.col("k")).alias(TENANT),
            F.explode(F.array(F.lit(1001), F.lit(2001))).alias("module_id"),
            "k",
        )
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("n"))
        .select(
            TENANT,
            F.col(TENANT).alias("workspace_name"),
            "module_id",
            F.concat(F.lit("m"), F.col("module_id")).alias("module_name"),
            start.alias("from_ts"),
            (start + 10 * day).alias("until_ts"),
            F.when((F.col("n") == 2) & (F.col("k") % 4 == 1), "FAILED").otherwise("SUCCESS").alias("status"),
            F.lit(None).cast("map<string,string>").alias("metrics"),
            F.concat(F.lit("run"), F.col("n")).alias("run_id"),
            F.timestamp_millis(start + 10 * day).alias("snapshot_ts"),
        )
    )


@query(
    "snk_09_rollback_to_time",
    """SELECT event_id, 'kept' AS status FROM events WHERE ts < TIMESTAMP '2024-01-11 00:00:00' OR user_id % 4 = 3
UNION ALL SELECT CAST(NULL AS BIGINT), s FROM (SELECT CASE WHEN n >= 1 AND k <> 3 THEN 'ROLLED BACK - ' ELSE '' END ||
  CASE WHEN n = 2 AND k = 1 THEN 'FAILED' ELSE 'SUCCESS' END AS s FROM range(4) a(k), range(3) b(n)) WHERE s <> ''""",
)
def rollback_time(t: Tables):
    state = runstate.run_state_table(scratch_path(t.spark, "state09"))
    rows = _state_rows(t, F.col("user_id") % 4).filter("module_id = 2001")
    runstate.record_run(rows, state)
    spec = TableSpec("events09", scratch_path(t.spark, "events09"), ("event_id",), ("date", "at_ms"), (TENANT, "date"))
    e = t.events.select(
        "event_id",
        ms("ts").alias("at_ms"),
        F.concat(F.lit("t"), F.col("user_id") % 4).alias(TENANT),
        F.to_date("ts").alias("date"),
    )
    store(e, spec)
    args = (t.spark, state, {2001: spec}, epoch_ms(moment(2024, 1, 15)), ["t0", "t1", "t2"])
    runstate.rollback_to(*args)  # a dry run changes nothing
    runstate.rollback_to(*args, dry_run=False)
    kept = tables.read_table(t.spark, spec).select("event_id", F.lit("kept").alias("status"))
    marks = tables.read_table(t.spark, state).select(F.lit(None).cast("bigint").alias("event_id"), "status")
    return kept.unionByName(marks)


@query(
    "snk_10_delete_duplicates",
    """SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, CAST((SELECT count(*) FROM lineitem) -
  (SELECT count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem) AS BIGINT) AS dropped FROM lineitem GROUP BY 1, 2""",
)
def deduped(t: Tables):
    spec = TableSpec("lines10", scratch_path(t.spark, "lines10"), ("l_orderkey", "l_linenumber"), partition_by=("l_linenumber",))
    store(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), spec)
    report = tables.delete_duplicates(t.spark, spec, ["l_partkey"])
    dropped = report.select("rows_dropped").scalar()
    return tables.read_table(t.spark, spec).withColumn("dropped", dropped)


@query("snk_11_compaction", f"SELECT {_ORDER} FROM orders")
def compacted(t: Tables):
    spec = order_table(t, "orders11")
    store(some_orders(t).repartition(16), spec)
    tables.compact(t.spark, spec, ["o_totalprice"], 100_000)
    return tables.read_table(t.spark, spec)


@query(
    "snk_12_snapshot",
    f"SELECT {_ODD_ORDER}, 'SUCCESS' AS status FROM orders WHERE o_orderpriority NOT IN ('5-LOW', '2-HIGH')",
)
def snapshot(t: Tables):
    """A second copy, after partitions have been emptied, has the rows of the table again."""
    spec, skipped = order_table(t, "orders12"), order_table(t, "skipped12")
    store(odd_partitions(some_orders(t)), spec)
    target = scratch_path(t.spark, "snap12")
    tables.snapshot_tables(t.spark, [spec, skipped], target, ["skipped12"])
    tables.delete_where(t.spark, spec, F.col("o_orderpriority").isNull() | (F.col("o_orderpriority") == "5-LOW"))
    report = tables.snapshot_tables(t.spark, [spec, skipped], target, ["skipped12"])
    copy = t.spark.read.parquet(f"{target}/orders12")
    return copy.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", report.select("status").scalar().alias("status"))


@query(
    "snk_13_error_table",
    """SELECT 'c' || user_id AS cluster_id, epoch_us(ts) // 1000 AS from_epoch, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS from_ts, 't1' AS organization_id
FROM events WHERE event_type = 'error'""",
)
def errors(t: Tables):
    spec = TableSpec("errors13", scratch_path(t.spark, "errors13"), ("cluster_id", "from_epoch", "until_epoch"))
    bad = t.events.filter("event_type = 'error'").select(
        F.concat(F.lit("c"), F.col("user_id")).alias("cluster_id"),
        ms("ts").alias("from_epoch"),
        (ms("ts") + 60_000).alias("until_epoch"),
        F.lit("no answer").alias("error"),
    )
    out = tables.persist_errors(bad, spec, "t1")
    return out.select("cluster_id", "from_epoch", F.date_format("from_ts", "yyyy-MM-dd HH:mm:ss").alias("from_ts"), TENANT)


@query(
    "snk_15_run_state",
    """SELECT 't' || k AS organization_id, m AS module_id, CASE WHEN k % 4 = 1 THEN 'run1' ELSE 'run2' END AS run_id,
  epoch_us(TIMESTAMP '2024-01-21') // 1000 + CASE WHEN k % 4 = 1 THEN 0 ELSE 864000000 END AS from_ts
FROM (SELECT DISTINCT user_id AS k FROM events) a, (VALUES (1001), (2001)) b(m)""",
)
def run_state(t: Tables):
    spec = runstate.run_state_table(scratch_path(t.spark, "state15"))
    runstate.record_run(_state_rows(t, F.col("user_id")), spec)
    state = tables.read_table(t.spark, spec)
    last = runstate.latest_runs(state).select(TENANT, "module_id", "run_id")
    window = runstate.next_window(state, 0, epoch_ms(moment(2024, 3, 1)), 60).select(TENANT, "module_id", "from_ts")
    return last.join(window, [TENANT, "module_id"])


_MARCH = epoch_ms(moment(2024, 3, 1))
_PRIMORDIAL = epoch_ms(moment(2023, 11, 1))


@query(
    "snk_15_run_windows",
    f"""WITH RECURSIVE d(module_id, needs) AS (SELECT * FROM (VALUES (2001, 1001), (3001, 2001), (3002, 3001), (3002, 1005), (3003, 7777)) x(a, b)),
c AS (SELECT * FROM d UNION SELECT c.module_id, d.needs FROM c JOIN d ON c.needs = d.module_id),
t AS (SELECT DISTINCT user_id AS k FROM events),
s AS (SELECT k, m AS module_id, {epoch_ms(moment(2024, 1, 11))} + CASE WHEN k % 4 = 1 THEN 1 ELSE 2 END * 864000000 AS done FROM t, (VALUES (1001), (2001)) x(m)
  WHERE NOT (m = 2001 AND k % 5 = 0)),
p AS (SELECT k, m AS module_id, h FROM t, (VALUES (1001, NULL), (1005, 30), (2001, NULL), (3001, NULL), (3002, 20), (3003, NULL)) x(m, h)
  WHERE NOT (m = 2001 AND k % 3 = 0)),
r AS (SELECT coalesce(p.k, s.k) AS k, coalesce(p.module_id, s.module_id) AS module_id, p.k IS NOT NULL AS runs, done IS NULL AS first_run,
  {_MARCH} - h::BIGINT * 86400000 AS oldest, coalesce(done, greatest({_PRIMORDIAL}, {_MARCH} - h::BIGINT * 86400000)) AS f, done
  FROM p FULL JOIN s ON p.k = s.k AND p.module_id = s.module_id),
l AS (SELECT *, CASE WHEN runs THEN greatest(least(f + 50 * 86400000::BIGINT, {_MARCH}), oldest) ELSE done END AS lim FROM r),
n AS (SELECT l.k, l.module_id, bool_or(o.lim IS NULL) AS missing, min(o.lim) AS least, min(CASE WHEN o.lim IS NULL THEN c.needs END) AS lost, arg_min(c.needs, (o.lim, c.needs)) AS slow
  FROM l JOIN c ON c.module_id = l.module_id LEFT JOIN l o ON o.k = l.k AND o.module_id = c.needs WHERE l.runs GROUP BY 1, 2)
SELECT 't' || l.k AS organization_id, l.module_id, first_run, f AS from_ts,
  CASE WHEN missing THEN f WHEN least < lim THEN greatest(f, least) ELSE lim END AS until_ts, CASE WHEN missing THEN lost WHEN least < lim THEN slow END AS held_by
FROM l LEFT JOIN n ON l.k = n.k AND l.module_id = n.module_id WHERE runs""",
)
def run_windows(t: Tables):
    """Windows of modules that have run, never ran, or need what does not run for the tenant."""
    spec = runstate.run_state_table(scratch_path(t.spark, "windows15"))
    k = F.regexp_extract(TENANT, "[0-9]+", 0).cast("int")
    done = _state_rows(t, F.col("user_id")).filter((F.col("module_id") != 2001) | (k % 5 != 0))
    runstate.record_run(done, spec)
    planned = [(1001, None), (1005, 30), (2001, None), (3001, None), (3002, 20), (3003, None)]
    modules = t.spark.createDataFrame(planned, "module_id int, history_days int")
    tenants = t.events.select(F.concat(F.lit("t"), F.col("user_id")).alias(TENANT), "user_id").distinct()
    # one in three tenants does not run module 2001
    runs = F.array_compact(F.transform(F.array(*[F.lit(m) for m, _ in planned]), lambda m: F.when((m != 2001) | (F.col("user_id") % 3 != 0), m)))
    modules = tenants.select(TENANT, F.explode(runs).alias("module_id")).join(modules, "module_id")
    needs = t.spark.createDataFrame([(2001, 1001), (3001, 2001), (3002, 3001), (3002, 1005), (3003, 7777)], "module_id int, needs int")
    return runstate.run_windows(tables.read_table(t.spark, spec), modules, needs, _PRIMORDIAL, _MARCH, 50)


@query(
    "snk_16_migration",
    """SELECT o_orderkey, 'C' || o_custkey AS tag_cust, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' ELSE 'other' END AS state,
  o_orderpriority FROM orders""",
)
def migrated(t: Tables):
    """A struct becomes a map, a column is added and filled, the partitions change."""
    spec = TableSpec("orders16", scratch_path(t.spark, "orders16"), ("o_orderkey",), partition_by=("o_orderpriority",))
    tags = F.struct(F.concat(F.lit("C"), F.col("o_custkey")).alias("cust"), F.lit(None).cast("string").alias("none"))
    store(t.orders.select("o_orderkey", "o_orderstatus", tags.alias("tags"), "o_orderpriority"), spec)
    status = F.col("o_orderstatus")
    steps = [
        ("tags to map", lambda df: df.withColumn("tags", S.struct_to_map(df.schema, "tags"))),
        ("add state", lambda df: df.withColumn("state", F.when(status == "F", "done").when(status == "O", "open").otherwise("other"))),
    ]
    tables.migrate(t.spark, spec, steps, ("state",))
    out = t.spark.read.parquet(spec.path)
    return out.select("o_orderkey", F.try_element_at("tags", F.lit("cust")).alias("tag_cust"), "state", "o_orderpriority")


@query(
    "dq_11_rebuild_and_compare",
    """SELECT 'rebuilt' AS table_name, CAST(count(DISTINCT o_custkey) AS BIGINT) AS source_count,
  CAST(count(DISTINCT o_custkey) AS BIGINT) AS target_count, CAST(0 AS BIGINT) AS discrepancies, CAST(0 AS DOUBLE) AS discrepancy_ratio, 'PASS' AS status FROM orders""",
)
def rebuilt(t: Tables):
    """A stored job result against the same job on a snapshot of its input."""

    def job(df: DataFrame) -> DataFrame:
        return df.groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))

    source, result = order_table(t, "orders_in"), scratch_path(t.spark, "result11")
    store(some_orders(t), source)
    job(tables.read_table(t.spark, source)).write.parquet(result)
    target = scratch_path(t.spark, "snap11")
    tables.snapshot_tables(t.spark, [source], target)
    again = job(t.spark.read.parquet(f"{target}/orders_in"))
    return Q.equality_report(t.spark.read.parquet(result), again, ["o_custkey", "total"], 0.0, "rebuilt")


# --- streams ----------------------------------------------------------------

EVENT_SCHEMA = "event_id bigint, user_id bigint, event_type string, value double, at_ms bigint"


def landed_events(t: Tables, rows_per_file: int = 20_000) -> str:
    """Events as landed files of bounded size, so their number grows with the rows."""
    path = scratch_path(t.spark, "stream-in")
    rows = t.events.select("event_id", "user_id", "event_type", "value", ms("ts").alias("at_ms"))
    rows.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return path


_STREAMED = "SELECT event_id, value, 't1' AS organization_id FROM events"


@query("st_01_rate_limited_ingest", _STREAMED)
def rate_limited(t: Tables):
    stored, check = scratch_path(t.spark, "st01"), scratch_path(t.spark, "st01-check")
    s = ingest.message_stream(t.spark, landed_events(t), EVENT_SCHEMA, "t1", "r", max_files=2, fmt="parquet")
    ingest.append_stream(s, stored, check, f"st01_{check[-8:]}").awaitTermination()
    return t.spark.read.parquet(stored).select("event_id", "value", TENANT)


@query("st_02_drain_then_stop", _STREAMED)
def drained(t: Tables):
    """The query stops itself at the first batch without rows."""
    stored, check = scratch_path(t.spark, "st02"), scratch_path(t.spark, "st02-check")
    s = ingest.message_stream(t.spark, landed_events(t), EVENT_SCHEMA, "t1", "r", fmt="parquet")
    ingest.run_until_quiet(s, stored, check, f"st02_{check[-8:]}", 10, 60, "500 milliseconds")
    return t.spark.read.parquet(stored).select("event_id", "value", TENANT)


@query("st_03_append_sink", "SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1")
def sink(t: Tables):
    """Two runs on one checkpoint read every row once."""
    stored, check = scratch_path(t.spark, "st03"), scratch_path(t.spark, "st03-check")
    path = landed_events(t)
    for i in range(2):
        s = ingest.message_stream(t.spark, path, EVENT_SCHEMA, "t1", "r", fmt="parquet")
        ingest.append_stream(s, stored, check, f"st03_{i}_{check[-8:]}", ["event_type"]).awaitTermination()
    return t.spark.read.parquet(stored).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("st_04_recovery", _STREAMED)
def recovered(t: Tables):
    """The checkpoint is lost half-way, with late rows and rows of the newest instant unread."""
    stored = scratch_path(t.spark, "st04")
    path = landed_events(t)
    all_events = t.spark.read.schema(EVENT_SCHEMA).parquet(path)
    cut = all_events.agg(F.max("at_ms") - F.lit(10 * 86_400_000)).scalar()
    at, n = F.col("at_ms"), F.col("event_id")
    read = ((at < cut) & (n % 7 != 0)) | ((at == cut) & (n % 2 == 0))
    all_events.filter(read).withColumns({TENANT: F.lit("t1"), "run_id": F.lit("r")}).write.parquet(stored)
    landed = t.spark.read.parquet(stored)
    newest = ingest.resume_point(landed, "at_ms")
    late_ms = newest - all_events.agg(F.min("at_ms")).first()[0]
    s = ingest.message_stream(
        t.spark, path, EVENT_SCHEMA, "t1", "r", fmt="parquet", after=newest, event_time="at_ms", late_ms=late_ms
    )
    ingest.append_stream(s, stored + "-on", scratch_path(t.spark, "st04-check"), f"st04_{stored[-8:]}").awaitTermination()
    again = t.spark.read.parquet(stored + "-on")
    return landed.unionByName(ingest.resume_rows(again, landed, ["event_id"])).select("event_id", "value", TENANT)


@query("st_06_late_upserts", "SELECT user_id, event_type, event_id FROM events")
def late(t: Tables):
    """Every event is delivered twice, the copy in a later file; merged by key each is there once."""
    spec = TableSpec("last06", scratch_path(t.spark, "last06"), ("event_id",), partition_by=("event_type",), mode="merge")
    path = scratch_path(t.spark, "st06-in")
    e = t.events.select("event_id", "user_id", "event_type", "value", ms("ts").alias("at_ms"))
    e.write.parquet(path)
    e.repartition("event_id").write.mode("append").parquet(path)
    s = ingest.message_stream(t.spark, path, EVENT_SCHEMA, "t1", "r", max_files=1, fmt="parquet")
    ingest.upsert_stream(s, spec, scratch_path(t.spark, "st06-check"), [F.col("at_ms")]).awaitTermination()
    return tables.read_table(t.spark, spec).select("user_id", "event_type", "event_id")
