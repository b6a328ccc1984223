"""Queries of aggregations, sorts, sets and scalar functions."""

from __future__ import annotations



from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions import costs, text, timeutil
from gaugeworks.functions.predicates import cluster_id_of_audit, cluster_type, derive_sku, is_automated
from gaugeworks.operators import aggregates, joins, schema
from gaugeworks.queries.registry import Tables, ms, query


@query(
    "agg_01_metrics_by_many_keys",
    """SELECT l_suppkey, l_returnflag, l_linestatus, p_brand, p_type, min(p_size) AS min_size,
  round(avg(l_discount), 4) AS avg_discount, max(l_quantity) AS max_quantity, CAST(count(*) AS BIGINT) AS lines,
  greatest(round(sum(l_extendedprice * (1 - l_discount)), 6), 0) AS revenue
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3, 4, 5""",
)
def many_keys(t: Tables):
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.groupBy("l_suppkey", "l_returnflag", "l_linestatus", "p_brand", "p_type").agg(
        F.min("p_size").alias("min_size"),
        F.round(F.avg("l_discount"), 4).alias("avg_discount"),
        F.max("l_quantity").alias("max_quantity"),
        F.count(F.lit(1)).alias("lines"),
        costs.floor_zero(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 6).alias("revenue"),
    )


@query(
    "agg_02_exploded_lag_sums",
    """WITH o AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS d, unnest([1, 2, 3]) AS stage FROM orders),
l AS (SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS d, l_quantity FROM lineitem)
SELECT o_custkey, CAST(count(*) AS BIGINT) AS tasks, round(sum(l_quantity), 4) AS quantity FROM o JOIN l
  ON o_orderkey = l_orderkey AND stage = l_linenumber AND o.d >= l.d - 400 GROUP BY 1""",
)
def exploded(t: Tables):
    orders = t.orders.select(
        "o_custkey",
        F.col("o_orderkey").alias("key"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("stage"),
    )
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("key"),
        F.col("l_linenumber").alias("stage"),
        F.col("l_shipdate").cast("date").alias("day"),
        "l_quantity",
    )
    joined = joins.lag_join(orders, lines, ["key", "stage"], "day", lag_days=400)
    return joined.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("tasks"), F.round(F.sum("l_quantity"), 4).alias("quantity")
    )


@query(
    "agg_03_nest_children",
    """SELECT conv_id, CAST(turn // 4 AS BIGINT) AS chunk_no, CAST(count(*) AS BIGINT) AS n,
  string_agg(role || ':' || length(text), '|' ORDER BY turn) AS turns
FROM (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS turn FROM conversations) GROUP BY 1, 2""",
)
def nest(t: Tables):
    """Turns packed per conversation, four to an array."""
    out = aggregates.nest_children(
        t.conversations, ["conv_id"], ["turn"], "children", F.floor(F.col("turn") / 1000), chunk=4
    )
    turns = F.transform(
        "children", lambda c: F.concat(c["role"], F.lit(":"), F.char_length(c["text"]).cast("string"))
    )
    return out.select("conv_id", "chunk_no", F.size("children").cast("bigint").alias("n"), F.array_join(turns, "|").alias("turns"))


@query(
    "agg_04_ordered_lists",
    """SELECT user_id, event_type, string_agg(event_id::VARCHAR, ',' ORDER BY event_id) AS ids
FROM events GROUP BY 1, 2""",
)
def lists(t: Tables):
    keys = ["user_id", "event_type"]
    out = aggregates.ordered_list(t.events, keys, "event_id", ["event_id"], "ids", F.floor(F.col("event_id") / 100_000))
    return out.select(*keys, F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))


@query(
    "agg_05_cost_summary",
    """SELECT l_returnflag, l_linestatus, greatest(round(sum(l_quantity * (1 - l_discount)), 3), 0) AS l_quantity,
  greatest(round(sum(l_extendedprice * (1 - l_discount)), 3), 0) AS l_extendedprice FROM lineitem GROUP BY 1, 2""",
)
def summary(t: Tables):
    return costs.summarize_costs(
        t.lineitem, ["l_quantity", "l_extendedprice"], ["l_returnflag", "l_linestatus"], 3, 1 - F.col("l_discount")
    )


@query(
    "agg_06_duplicate_counts",
    """SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) AS distinct_keys,
  CAST(count(DISTINCT l_partkey) AS BIGINT) AS parts FROM lineitem""",
)
def duplicate_counts(t: Tables):
    return t.lineitem.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_distinct("l_orderkey", "l_linenumber").alias("distinct_keys"),
        F.count_distinct("l_partkey").alias("parts"),
    )


@query("agg_07_distinct_keys", "SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem")
def distinct_keys(t: Tables):
    return t.lineitem.select("l_orderkey", "l_returnflag").distinct()


@query(
    "agg_08_batches",
    """WITH c AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1)
SELECT user_id, CAST(n AS BIGINT) AS n, CAST(ceil(sum(n) OVER (ORDER BY user_id) / 500) AS INTEGER) AS batch_id FROM c""",
)
def batches(t: Tables):
    counts = t.events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return aggregates.batch_by_size(counts, "user_id", "n", 500, F.floor(F.col("user_id") / 4096))


@query(
    "agg_09_cost_formulas",
    """WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_linestatus = 'O' AS billable, l_quantity AS hours,
  l_extendedprice / 1000 AS price, l_linenumber AS nodes, CASE WHEN l_returnflag = 'R' THEN 'photon' ELSE 'standard' END AS engine,
  CASE l_linenumber % 3 WHEN 0 THEN 'sqlCompute' WHEN 1 THEN 'automated' ELSE 'interactive' END AS sku, l_linenumber % 3 = 1 AS auto
  FROM lineitem),
y AS (SELECT *, CASE WHEN engine = 'photon' AND sku <> 'sqlCompute' AND auto THEN 2.9::DOUBLE
  WHEN engine = 'photon' AND sku <> 'sqlCompute' THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS m FROM x)
SELECT l_orderkey, l_linenumber, l_partkey, round(CASE WHEN billable THEN price * hours * nodes ELSE 0 END, 7) AS compute_cost,
  round(hours * m * 0.15::DOUBLE, 8) AS unit_cost FROM y""",
)
def formulas(t: Tables):
    n = F.col("l_linenumber")
    sku = F.when(n % 3 == 0, "sqlCompute").when(n % 3 == 1, "automated").otherwise("interactive")
    engine = F.when(F.col("l_returnflag") == "R", "photon").otherwise("standard")
    hours = F.col("l_quantity")
    units = hours * costs.engine_multiplier(engine, sku, n % 3 == 1)
    compute = costs.compute_cost(F.col("l_linestatus") == "O", F.col("l_extendedprice") / 1000, n, hours)
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.round(compute, 7).alias("compute_cost"),
        F.round(costs.unit_cost(units, F.lit(0.15)), 8).alias("unit_cost"),
    )


@query(
    "agg_10_scalar_aggregates",
    """SELECT max(epoch_us(ts)) AS max_ts_us, CAST((SELECT max(n) FROM (SELECT count(*) AS n FROM events WHERE event_type = 'click' GROUP BY user_id)) AS BIGINT) AS max_active FROM events""",
)
def scalars(t: Tables):
    active = t.events.filter("event_type = 'click'").groupBy("user_id").count().agg(F.max("count")).scalar()
    return t.events.agg(F.max(F.unix_micros("ts")).alias("max_ts_us")).withColumn("max_active", active)


@query("srt_01_global_sort", "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id")
def sort(t: Tables):
    return t.documents.select("doc_id", "n_chars").orderBy(F.col("n_chars").desc(), "doc_id")


@query(
    "srt_02_top_groups",
    """SELECT l_partkey, l_suppkey, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1, 2 ORDER BY n DESC, l_partkey, l_suppkey LIMIT 40""",
)
def top_groups(t: Tables):
    return joins.hot_keys(t.lineitem, ["l_partkey", "l_suppkey"], 40)


@query(
    "set_01_union_by_name",
    """SELECT event_id AS id, value, props, NULL::VARCHAR AS note FROM events
UNION ALL SELECT o_orderkey, o_totalprice, NULL, o_orderpriority FROM orders""",
)
def union(t: Tables):
    a = t.events.select(F.col("event_id").alias("id"), "value", "props")
    b = t.orders.select(
        F.col("o_orderpriority").alias("note"), F.col("o_totalprice").alias("value"), F.col("o_orderkey").alias("id")
    )
    return a.unionByName(b, allowMissingColumns=True)


@query(
    "set_02_union_missing_as_null",
    """SELECT c_custkey AS k, c_name AS name, NULL::VARCHAR AS s_only, c_mktsegment AS c_only FROM customer
UNION ALL SELECT s_suppkey, s_name, 's' || s_nationkey, NULL FROM supplier""",
)
def union_nulls(t: Tables):
    a = t.customer.select(
        F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("c_only")
    )
    b = t.supplier.select(
        F.col("s_suppkey").alias("k"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("s"), F.col("s_nationkey")).alias("s_only"),
    )
    return schema.union_with_nulls(a, b)


@query(
    "set_03_except",
    "SELECT o_custkey AS k FROM orders EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal < 0",
)
def minus(t: Tables):
    return t.orders.select(F.col("o_custkey").alias("k")).subtract(
        t.customer.filter("c_acctbal < 0").select("c_custkey")
    )


@query(
    "set_04_union_of_reports",
    """SELECT 'orders' AS report, CAST(count(*) AS BIGINT) AS n FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'events', count(*) FROM events""",
)
def reports(t: Tables):
    def counted(name: str):
        return getattr(t, name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("report"), "n")

    return counted("orders").union(counted("lineitem")).union(counted("events"))


@query(
    "scl_01_epoch_to_ts",
    """SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS at, strftime(ts, '%Y-%m-%d') AS day FROM events""",
)
def to_ts(t: Tables):
    at = ms("ts")
    return t.events.select(
        "event_id",
        F.date_format(timeutil.to_ts(at), "yyyy-MM-dd HH:mm:ss").alias("at"),
        timeutil.to_ts(at, "milli", T.DateType()).cast("string").alias("day"),
    )


@query(
    "scl_02_epoch_milli_to_ts",
    """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE epoch_us(ts) // 1000 END AS back FROM events""",
)
def epoch_milli(t: Tables):
    raw = F.when(F.col("event_id") % 5 == 0, "no number").otherwise(ms("ts").cast("string"))
    return t.events.select("event_id", F.unix_millis(timeutil.epoch_milli_to_ts(raw)).alias("back"))


@query(
    "scl_03_ts_to_epoch_milli",
    "SELECT event_id, CAST(epoch_us(ts) // 1000 AS DOUBLE) AS at FROM events",
)
def ts_epoch(t: Tables):
    shown = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"), F.lit("0"))
    return t.events.select("event_id", F.round(timeutil.ts_to_epoch_milli(shown)).alias("at"))


@query(
    "scl_04_iso_text_to_millis",
    "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE epoch_us(ts) // 1000 END AS at FROM events",
)
def iso_text(t: Tables):
    full = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    short = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    raw = F.when(F.col("event_id") % 4 == 0, short).otherwise(full)
    return t.events.select("event_id", timeutil.string_ts_to_unix_millis(raw).alias("at"))


@query(
    "scl_05_run_time",
    """WITH r AS (SELECT event_id, epoch_us(ts) // 1000 AS s, epoch_us(ts) // 1000 + CAST(floor(value * 1000) AS BIGINT) AS e FROM events)
SELECT event_id, s AS start_ms, e AS end_ms, e - s AS run_ms, round((e - s) / 1000, 6) AS run_s, round((e - s) / 3600000, 8) AS run_h FROM r""",
)
def run_time(t: Tables):
    r = timeutil.run_time(ms("ts"), ms("ts") + F.floor(F.col("value") * 1000))
    return t.events.select("event_id", r.alias("r")).select(
        "event_id",
        F.col("r.startEpochMS").alias("start_ms"),
        F.col("r.endEpochMS").alias("end_ms"),
        F.col("r.runTimeMS").alias("run_ms"),
        F.round("r.runTimeS", 6).alias("run_s"),
        F.round("r.runTimeH", 8).alias("run_h"),
    )


@query(
    "scl_06_ticks",
    """SELECT event_id, epoch_us(ts) + 1000 AS ts_up, CAST(CAST(ts AS DATE) - 1 AS VARCHAR)[:10] AS day_down,
  round(value + 0.001, 6) AS value_up, event_id - 1 AS id_down FROM events""",
)
def ticks(t: Tables):
    return t.events.select(
        "event_id",
        F.unix_micros(timeutil.add_ticks(F.col("ts"), 1, T.TimestampType())).alias("ts_up"),
        timeutil.subtract_ticks(F.col("ts").cast("date"), 1, T.DateType()).cast("string").alias("day_down"),
        F.round(timeutil.add_ticks(F.col("value"), 1, T.DoubleType()), 6).alias("value_up"),
        timeutil.subtract_ticks(F.col("event_id"), 1, T.LongType()).alias("id_down"),
    )


@query(
    "scl_07_date_series",
    """SELECT o_orderkey, strftime(unnest(range(o_orderdate::TIMESTAMP, (CAST(o_orderdate AS DATE) + CAST(o_orderkey % 4 AS INTEGER))::TIMESTAMP, INTERVAL 1 DAY)), '%Y-%m-%d') AS day FROM orders""",
)
def series(t: Tables):
    day = F.col("o_orderdate").cast("date")
    until = F.date_add(day, (F.col("o_orderkey") % 4).cast("int"))
    return t.orders.select("o_orderkey", F.explode(timeutil.date_series(day, until).cast("array<string>")).alias("day"))


@query(
    "scl_08_cleanse_path",
    """SELECT page_id, CASE WHEN page_id % 2 = 0 THEN url ELSE 'file:/' || replace(substr(url, strpos(url, '//') + 2), '//', '/') END AS path FROM pages""",
)
def paths(t: Tables):
    bare = F.concat(F.lit("//"), F.regexp_replace("url", "^https?://", ""))
    raw = F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise(bare)
    return t.pages.select("page_id", text.cleanse_path(raw).alias("path"))


@query(
    "scl_09_group_filename",
    """SELECT page_id, array_to_string(string_split(url, '/')[1:3], '/') AS by_cluster,
  array_to_string(string_split(url, '/')[1:5], '/') AS by_host, array_to_string(string_split(url, '/')[1:6], '/') AS by_context FROM pages""",
)
def filenames(t: Tables):
    return t.pages.select("page_id", text.group_filename(F.col("url")).alias("g")).select(
        "page_id",
        F.col("g.byCluster").alias("by_cluster"),
        F.col("g.byDriverHost").alias("by_host"),
        F.col("g.bySparkContext").alias("by_context"),
    )


@query(
    "scl_10_stream_details",
    """SELECT event_id, 's' || user_id AS stream_id, 'r' || event_id AS stream_run_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE (event_id % 11)::VARCHAR END AS stream_batch_id FROM events""",
)
def stream_details(t: Tables):
    parts = [F.lit("job<br/>id = s"), F.col("user_id"), F.lit("\nrunId = r"), F.col("event_id")]
    batch = F.when(F.col("event_id") % 3 == 0, "").otherwise(F.concat(F.lit("<br/>batch = "), F.col("event_id") % 11))
    df = t.events.select("event_id", text.stream_details(F.concat(*parts, batch)).alias("d"))
    return df.select("event_id", "d.*")


@query(
    "scl_11_ids_of_group",
    "SELECT event_id, CASE WHEN event_id % 4 > 0 THEN user_id::VARCHAR END AS job_id, CASE WHEN event_id % 4 > 0 THEN event_id::VARCHAR END AS run_id FROM events",
)
def group_ids(t: Tables):
    group = F.concat(F.lit("12_34_job-"), F.col("user_id"), F.lit("-run-"), F.col("event_id"), F.lit("-action-5"))
    group = F.when(F.col("event_id") % 4 > 0, group).otherwise("interactive")
    return t.events.select(
        "event_id", text.job_id_of_group(group).alias("job_id"), text.run_id_of_group(group).alias("run_id")
    )


@query(
    "scl_12_json",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, CAST(json_extract(props, '$.k') AS INTEGER) AS parsed,
  'v' || user_id AS dotted FROM events""",
)
def json_functions(t: Tables):
    conf = F.concat(F.lit('{"spark.some.key":"v'), F.col("user_id"), F.lit('"}'))
    parsed = F.from_json("props", "k int")
    return t.events.select(
        "event_id",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.from_json(F.to_json(parsed), "k int")["k"].alias("parsed"),
        text.dotted_json_value(conf, "spark.some.key").alias("dotted"),
    )


@query(
    "scl_13_collections",
    """SELECT o_orderkey, greatest(o_orderkey, o_custkey) AS high, least(o_orderkey, o_custkey) AS low,
  CAST(o_orderkey % 3 + 1 AS BIGINT) AS days, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 2 END AS kept, o_orderstatus IN ('O', 'F') AS listed FROM orders""",
)
def collections(t: Tables):
    pair = F.array("o_orderkey", "o_custkey")
    days = F.sequence(
        F.col("o_orderdate").cast("date"), F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 3).cast("int"))
    )
    m = F.create_map(F.lit("status"), F.col("o_orderstatus"), F.lit("priority"), F.col("o_orderpriority"))
    kept = F.map_filter(m, lambda k, v: v != "P")
    return t.orders.select(
        "o_orderkey",
        F.array_max(pair).alias("high"),
        F.array_min(pair).alias("low"),
        F.size(F.array_except(days, F.array())).cast("bigint").alias("days"),
        F.size(kept).alias("kept"),
        F.array_contains(F.array(F.lit("O"), F.lit("F")), F.col("o_orderstatus")).alias("listed"),
    )


@query("scl_14_row_hash", "SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(*) AS BIGINT) AS hashes FROM events")
def hashes(t: Tables):
    """No two events share a hash, and equal rows have equal hashes."""
    h = text.row_hash(F.col("event_id"), F.col("user_id"), payload=F.struct("event_type", "value", "props"))
    both = t.events.select("event_id", h.alias("h")).unionByName(t.events.select("event_id", h.alias("h")))
    return both.agg((F.count(F.lit(1)) / 2).cast("bigint").alias("n"), F.count_distinct("h").alias("hashes"))


@query(
    "scl_15_math",
    """SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * l_discount, 6) AS r, greatest(l_quantity, 25) AS g,
  least(l_quantity, 25) AS l, abs(l_discount - 0.05) AS a, CAST(ceil(l_quantity / 7) AS BIGINT) AS c FROM lineitem""",
)
def math_functions(t: Tables):
    q = F.col("l_quantity")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.round(F.col("l_extendedprice") * F.col("l_discount"), 6).alias("r"),
        F.greatest(q, F.lit(25.0)).alias("g"),
        F.least(q, F.lit(25.0)).alias("l"),
        F.abs(F.col("l_discount") - 0.05).alias("a"),
        F.ceil(q / 7).alias("c"),
    )


@query(
    "prj_22_case_predicates",
    """WITH x AS (SELECT event_id, user_id % 4 AS m, event_id % 3 AS n FROM events)
SELECT event_id, m = 0 AS automated, CASE n WHEN 0 THEN 'Single Node' WHEN 1 THEN 'SQL Analytics' ELSE 'Standard' END AS cluster_type,
  CASE WHEN m = 0 AND n = 2 THEN 'jobsLight' WHEN m = 0 THEN 'automated' WHEN n = 1 THEN 'sqlCompute' ELSE 'interactive' END AS sku,
  CASE n WHEN 0 THEN 'r' || event_id WHEN 1 THEN 'p' ELSE 'alt' END AS cluster_id FROM x""",
)
def predicates(t: Tables):
    m, n = F.col("user_id") % 4, F.col("event_id") % 3
    name = F.when(m == 0, F.concat(F.lit("job-"), F.col("user_id"), F.lit("-run-1"))).otherwise("mine")
    conf = F.when(n == 0, '{"cluster.profile":"singleNode"}').otherwise("{}")
    tags = F.when(n == 1, '{"EndpointId":"7"}').otherwise("{}")
    version = F.when(n == 2, "apache_spark_2.4").otherwise("9.1.x")
    kind = cluster_type(conf, tags, "cluster.profile", "EndpointId")
    action = F.when(n == 0, "create").when(n == 1, "edit").otherwise("startResult")
    result = F.concat(F.lit('{"cluster_id":"r'), F.col("event_id"), F.lit('"}'))
    return t.events.select(
        "event_id",
        is_automated(name).alias("automated"),
        kind.alias("cluster_type"),
        derive_sku(is_automated(name), version, kind).alias("sku"),
        cluster_id_of_audit(F.lit("clusters"), action, F.lit("p"), F.lit("alt"), result).alias("cluster_id"),
    )




