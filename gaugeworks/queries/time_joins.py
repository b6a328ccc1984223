"""Queries of the as-of, lag, range and interval joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaugeworks.operators import joins
from gaugeworks.operators.asof import UNBOUNDED, TimeSeries, asof_join, asof_lookup
from gaugeworks.operators.overlap import cumulative_overlap, true_overlap
from gaugeworks.operators.scan import Running, ordered_scan
from gaugeworks.session import materialize
from gaugeworks.queries.registry import Tables, day_slice, ms, query


def _views_and_purchases(t: Tables):
    e = t.events
    views = e.filter("event_type = 'view'").select("user_id", "ts", "event_id")
    buys = e.filter("event_type = 'purchase'").select(
        "user_id", "ts", F.when(F.col("value") >= 20, F.col("value")).alias("amount"), "props"
    )
    return TimeSeries(views, "ts", ["user_id"]), TimeSeries(buys, "ts", ["user_id"])


_MERGED = """
WITH s AS (
  SELECT user_id, ts, 0 AS side, event_id, NULL::DOUBLE AS amount, NULL::VARCHAR AS props
  FROM events WHERE event_type = 'view'
  UNION ALL
  SELECT user_id, ts, 1, NULL, CASE WHEN value >= 20 THEN value END, props
  FROM events WHERE event_type = 'purchase')
"""


@query(
    "jn_03_asof_lookup",
    _MERGED
    + """, f AS (SELECT *,
  last_value(amount IGNORE NULLS) OVER w AS last_amount, last_value(props IGNORE NULLS) OVER w AS last_props
  FROM s WINDOW w AS (PARTITION BY user_id ORDER BY ts, side ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT event_id, user_id, last_amount AS amount, last_props AS props FROM f WHERE side = 0""",
)
def asof(t: Tables):
    left, right = _views_and_purchases(t)
    return asof_lookup(left, right).select("event_id", "user_id", "amount", "props")


@query(
    "jn_03_asof_lookup_limits",
    _MERGED
    + """, f AS (SELECT *,
  last_value(amount IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, side
    ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS b,
  first_value(amount IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, side
    ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS a
  FROM s)
SELECT event_id, user_id, coalesce(b, a) AS amount FROM f WHERE side = 0""",
)
def asof_limits(t: Tables):
    left, right = _views_and_purchases(t)
    out = asof_lookup(left, right, look_back=4, look_ahead=3)
    return out.select("event_id", "user_id", "amount")


@query(
    "jn_03_asof_lookup_ahead",
    _MERGED
    + """, f AS (SELECT *,
  last_value(amount IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, side
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS b,
  first_value(amount IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, side
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS a,
  lead(amount) OVER (PARTITION BY user_id ORDER BY ts, side) AS n
  FROM s)
SELECT event_id, user_id, coalesce(b, a) AS amount, n AS next_amount FROM f WHERE side = 0""",
)
def asof_ahead(t: Tables):
    left, right = _views_and_purchases(t)
    filled = TimeSeries(asof_lookup(left, right, look_ahead=UNBOUNDED).drop("props"), "ts", ["user_id"])
    buys = TimeSeries(right.df.select("user_id", "ts", F.col("amount").alias("next_amount")), "ts", ["user_id"])
    out = asof_lookup(filled, buys, look_back=0, look_ahead=1)
    return out.select("event_id", "user_id", "amount", "next_amount")


@query(
    "jn_04_asof_join",
    _MERGED
    + """SELECT user_id, epoch_us(ts) AS ts_us, event_id,
  last_value(amount IGNORE NULLS) OVER w AS right_amount,
  last_value(CASE WHEN side = 1 THEN epoch_us(ts) END IGNORE NULLS) OVER w AS right_ts_us
  FROM s WINDOW w AS (PARTITION BY user_id ORDER BY ts, side ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def asof_both(t: Tables):
    left, right = _views_and_purchases(t)
    out = asof_join(left, TimeSeries(right.df.drop("props"), "ts", ["user_id"]))
    return out.select(
        "user_id",
        F.unix_micros("ts").alias("ts_us"),
        "event_id",
        "right_amount",
        F.unix_micros("right_ts").alias("right_ts_us"),
    )


@query(
    "jn_05_asof_time_slices",
    """WITH e AS (SELECT *, CASE WHEN user_id % 3 = 0 THEN -1 ELSE user_id END AS k FROM events),
s AS (SELECT k, ts, 0 AS side, event_id, NULL::DOUBLE AS amount FROM e WHERE event_type = 'view'
  UNION ALL SELECT k, ts, 1, NULL, value FROM e WHERE event_type = 'purchase'),
f AS (SELECT *, last_value(amount IGNORE NULLS) OVER
  (PARTITION BY k ORDER BY ts, side ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v FROM s)
SELECT event_id, k, v AS amount FROM f WHERE side = 0""",
)
def asof_hot_key(t: Tables):
    """A third of the rows share one key; six-hour slices spread it."""
    e = t.events.withColumn("k", F.when(F.col("user_id") % 3 == 0, -1).otherwise(F.col("user_id")))
    left = e.filter("event_type = 'view'").select("k", "ts", "event_id")
    right = e.filter("event_type = 'purchase'").select("k", "ts", F.col("value").alias("amount"))
    out = asof_lookup(TimeSeries(left, "ts", ["k"]), TimeSeries(right, "ts", ["k"]), slice_width=6 * 3600)
    return out.select("event_id", "k", "amount")


def _orders_and_lines(t: Tables):
    orders = t.orders.select(
        F.col("o_orderkey").alias("order_key"), F.col("o_orderdate").cast("date").alias("day"), "o_totalprice"
    )
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_shipdate").cast("date").alias("day"),
        "l_linenumber",
        "l_quantity",
    )
    return orders, lines


@query(
    "jn_01_lag_join",
    """SELECT o.o_orderkey AS order_key, CAST(o.o_orderdate AS DATE)::VARCHAR AS day, o_totalprice, l_linenumber, l_quantity
FROM orders o LEFT JOIN lineitem l ON o_orderkey = l_orderkey
  AND CAST(o_orderdate AS DATE) >= CAST(l_shipdate AS DATE) - 30""",
)
def lag_left(t: Tables):
    orders, lines = _orders_and_lines(t)
    out = joins.lag_join(orders, lines, ["order_key"], "day", lag_days=30, how="left")
    return out.withColumn("day", F.col("day").cast("string"))


@query(
    "jn_01_lag_join_right",
    """SELECT l.l_orderkey AS order_key, CAST(l.l_shipdate AS DATE)::VARCHAR AS day, o_totalprice, l_linenumber, l_quantity
FROM orders o RIGHT JOIN lineitem l ON o_orderkey = l_orderkey
  AND CAST(l_shipdate AS DATE) >= CAST(o_orderdate AS DATE) - 5""",
)
def lag_right(t: Tables):
    orders, lines = _orders_and_lines(t)
    out = joins.lag_join(orders, lines, ["order_key"], "day", lagging="right", lag_days=5, how="right")
    return out.withColumn("day", F.col("day").cast("string"))


@query(
    "jn_02_same_or_previous_day",
    """SELECT o_orderkey AS order_key, CAST(l_shipdate AS DATE)::VARCHAR AS day, o_totalprice, l_linenumber, l_quantity
FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey
  AND CAST(l_shipdate AS DATE) IN (CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) - 1)""",
)
def previous_day(t: Tables):
    orders, lines = _orders_and_lines(t)
    out = joins.same_or_previous_day_join(lines, orders, ["order_key"], "day")
    return out.withColumn("day", F.col("day").cast("string"))


def order_prices(t: Tables):
    """Price versions per customer: valid from one order to the next."""
    o = t.orders.select(
        F.col("o_custkey").alias("cust"), "o_orderkey", ms("o_orderdate").alias("valid_from"), "o_totalprice"
    )
    month = 30 * 86_400_000
    return ordered_scan(
        o,
        ["cust"],
        ["valid_from", "o_orderkey"],
        [Running("valid_until", "lead", F.col("valid_from"))],
        F.floor(F.col("valid_from") / month),
    )


@query(
    "jn_06_validity_join",
    """WITH d AS (SELECT ' CUST' || o_custkey || ' ' AS cust, o_orderkey AS version, epoch_ms(o_orderdate) AS f,
  coalesce(lead(epoch_ms(o_orderdate)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), 1041292800000) AS u,
  o_totalprice AS price FROM orders),
x AS (SELECT 'cust' || o_custkey AS cust, l_orderkey, l_linenumber, l_partkey, epoch_ms(l_shipdate) AS at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT x.cust AS cust, l_orderkey, l_linenumber, l_partkey, x.at AS "at", version, price
FROM x LEFT JOIN d ON trim(lower(x.cust)) = trim(lower(d.cust)) AND x.at BETWEEN d.f AND d.u""",
)
def validity(t: Tables):
    dim = order_prices(t).select(
        F.concat(F.lit(" CUST"), F.col("cust"), F.lit(" ")).alias("dim_cust"),
        F.col("o_orderkey").alias("version"),
        "valid_from",
        "valid_until",
        F.col("o_totalprice").alias("price"),
    )
    dim = materialize(dim, "versions")  # read twice: which widths there are, and the cells
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", ms("l_shipdate").alias("at"))
    owner = t.orders.select(
        F.col("o_orderkey").alias("l_orderkey"), F.concat(F.lit("cust"), F.col("o_custkey")).alias("cust")
    )
    out = joins.range_join(
        lines.join(owner, "l_orderkey"),
        dim,
        [("cust", "dim_cust")],
        "at",
        "valid_from",
        "valid_until",
        F.lit(1041292800000),
        bucket=90 * 86_400_000,
    )
    return out.select("cust", "l_orderkey", "l_linenumber", "l_partkey", "at", "version", "price")


@query(
    "jn_07_contained_intervals",
    """WITH r AS (SELECT user_id, event_id AS run_id, (epoch_us(ts) // 1000) AS rs,
  lead((epoch_us(ts) // 1000)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS re FROM events WHERE event_type = 'signup'),
s AS (SELECT user_id, event_id AS state_id, (epoch_us(ts) // 1000) AS ss, (epoch_us(ts) // 1000) + CAST(floor(value * 60000) AS BIGINT) AS se
  FROM events WHERE event_type = 'view')
SELECT r.user_id AS user_id, run_id, state_id, ss - rs AS after_ms FROM r JOIN s
  ON r.user_id = s.user_id AND ss > rs AND se < re""",
)
def contained(t: Tables):
    e = t.events.select("user_id", "event_id", "event_type", "ts", ms("ts").alias("at"), "value")
    runs = ordered_scan(
        e.filter("event_type = 'signup'").drop("value", "event_type"),
        ["user_id"],
        ["ts", "event_id"],
        [Running("re", "lead", F.col("at"))],
        day_slice(),
    ).select("user_id", F.col("event_id").alias("run_id"), F.col("at").alias("rs"), "re")
    states = e.filter("event_type = 'view'").select(
        "user_id",
        F.col("event_id").alias("state_id"),
        F.col("at").alias("ss"),
        (F.col("at") + F.floor(F.col("value") * 60000)).alias("se"),
    )
    out = joins.contained_join(runs, states, ["user_id"], ("rs", "re"), ("ss", "se"), 86_400_000)
    return out.select("user_id", "run_id", "state_id", (F.col("ss") - F.col("rs")).alias("after_ms"))


_RUNS = """
WITH r AS (SELECT user_id, event_id AS run_id, (epoch_us(ts) // 1000) AS s,
  epoch_ms(date_trunc('day', ts)) AS ss, epoch_ms(date_trunc('day', ts)) + 86399999 AS se,
  least((epoch_us(ts) // 1000) + CAST(floor(value * 600000) AS BIGINT), epoch_ms(date_trunc('day', ts)) + 86399999) AS e
  FROM events)
"""


def day_runs(t: Tables):
    """Runs that start with an event, last by its value and end with the day at the latest."""
    day = F.unix_millis(F.date_trunc("day", "ts"))
    return t.events.select(
        "user_id",
        F.col("event_id").alias("run_id"),
        ms("ts").alias("s"),
        F.least(ms("ts") + F.floor(F.col("value") * 600000), day + 86_399_999).alias("e"),
        day.alias("ss"),
        (day + 86_399_999).alias("se"),
    )


@query(
    "jn_08_interval_overlap",
    _RUNS
    + """, p AS (SELECT o.user_id, o.run_id, o.ss, CASE
    WHEN l.s < o.s AND l.e > o.s AND l.e < o.e THEN l.e - o.ss
    WHEN l.s > o.s AND l.s < o.e AND l.e > o.e THEN o.se - o.s
    WHEN l.s BETWEEN o.s AND o.e AND l.e BETWEEN o.s AND o.e THEN l.e - o.s END AS rel
  FROM r o JOIN r l ON o.user_id = l.user_id AND o.ss = l.ss)
SELECT user_id, run_id, ss AS state_start, CAST(sum(rel) AS BIGINT) AS cum_runtime_in_cluster_state,
  CAST(count(rel) - 1 AS BIGINT) AS overlapping_run_states FROM p WHERE rel IS NOT NULL GROUP BY ALL""",
)
def overlap(t: Tables):
    out = cumulative_overlap(day_runs(t), ["user_id", "ss", "se"], ["run_id"], "s", "e", "ss", "se")
    return out.select(
        "user_id",
        "run_id",
        F.col("ss").alias("state_start"),
        "cum_runtime_in_cluster_state",
        "overlapping_run_states",
    )


@query(
    "jn_08_interval_overlap_exact",
    _RUNS
    + """SELECT o.user_id, o.run_id, o.ss AS state_start,
  CAST(sum(greatest(0, least(o.e, l.e) - greatest(o.s, l.s))) - (o.e - o.s) AS BIGINT) AS shared_ms
FROM r o JOIN r l ON o.user_id = l.user_id AND o.ss = l.ss
WHERE o.e > o.s AND l.e > l.s GROUP BY o.user_id, o.run_id, o.ss, o.s, o.e""",
)
def overlap_exact(t: Tables):
    out = true_overlap(day_runs(t), ["user_id", "ss"], ["run_id"], "s", "e")
    return out.select("user_id", "run_id", F.col("ss").alias("state_start"), "shared_ms")


@query(
    "jn_09_anti_join",
    "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)",
)
def without_orders(t: Tables):
    big = t.orders.filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.missing_from(t.customer, big, ["c_custkey"]).select("c_custkey", "c_name")


@query(
    "jn_10_prefix_join",
    """WITH p AS (SELECT DISTINCT regexp_extract(url, '^https?://[^/]*/[a-z]') AS prefix FROM pages)
SELECT page_id, prefix FROM pages LEFT JOIN p ON starts_with(url, prefix) AND prefix LIKE 'https%'""",
)
def prefix(t: Tables):
    prefixes = (
        t.pages.select(F.regexp_extract("url", "^https?://[^/]*/[a-z]", 0).alias("prefix"))
        .filter("prefix like 'https%'")
        .distinct()
    )
    return joins.prefix_join(t.pages.select("page_id", "url"), "url", prefixes, "prefix").select("page_id", "prefix")


@query(
    "jn_11_left_assembly",
    """SELECT o_orderkey, c_name, n_name, n_lines FROM orders
LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) ON o_orderkey = l_orderkey
LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def assembly(t: Tables):
    lines = (
        t.lineitem.filter("l_returnflag = 'R'")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )
    cust = t.customer.withColumnRenamed("c_custkey", "o_custkey").withColumnRenamed("c_nationkey", "n_nationkey")
    return (
        t.orders.join(lines, "o_orderkey", "left")
        .join(cust, "o_custkey", "left")
        .join(t.nation, "n_nationkey", "left")
        .select("o_orderkey", "c_name", "n_name", "n_lines")
    )


@query(
    "jn_12_full_outer_counts",
    """WITH a AS (SELECT user_id, ts::DATE AS day, count(*) AS a FROM events WHERE event_type = 'click' GROUP BY 1, 2),
b AS (SELECT user_id, ts::DATE AS day, count(*) AS b FROM events WHERE event_type = 'error' GROUP BY 1, 2)
SELECT user_id, day::VARCHAR AS day, coalesce(a, 0) AS clicks, coalesce(b, 0) AS errors FROM a FULL OUTER JOIN b USING (user_id, day)""",
)
def full_outer(t: Tables):
    def counted(kind: str, name: str):
        e = t.events.filter(F.col("event_type") == kind)
        return e.groupBy("user_id", F.to_date("ts").cast("string").alias("day")).agg(F.count(F.lit(1)).alias(name))

    return (
        counted("click", "clicks")
        .join(counted("error", "errors"), ["user_id", "day"], "full_outer")
        .select("user_id", "day", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("clicks", "errors")])
    )


@query(
    "jn_13_salted_join",
    """SELECT l_orderkey, l_linenumber, l_quantity, p_brand FROM lineitem LEFT JOIN part
  ON (CASE WHEN l_partkey % 3 = 0 THEN 0 ELSE l_partkey END) = p_partkey""",
)
def salted(t: Tables):
    """A third of the lines refer to one part: it alone is cut into parts."""
    lines = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        F.when(F.col("l_partkey") % 3 == 0, 0).otherwise(F.col("l_partkey")).alias("p_partkey"),
    )
    parts = t.part.select("p_partkey", "p_brand")
    return joins.salted_join(lines, parts, ["p_partkey"], 5_000).drop("p_partkey")


@query(
    "jn_14_semi_join",
    "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')",
)
def with_orders(t: Tables):
    open_orders = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return joins.present_in(t.customer, open_orders, ["c_custkey"]).select("c_custkey", "c_name")
