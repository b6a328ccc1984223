"""Queries of the data-quality reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from gaugeworks.operators import quality as Q
from gaugeworks.queries.registry import Tables, query
from gaugeworks.queries.time_joins import order_prices


@query(
    "dq_01_key_report",
    """SELECT 'lineitem' AS table_name, CAST(count(*) AS BIGINT) AS row_count,
  CAST(count(DISTINCT (l_orderkey, l_linenumber)) AS BIGINT) AS key_count, CAST(0 AS BIGINT) AS null_l_orderkey,
  CAST(0 AS BIGINT) AS null_l_linenumber, 'FAIL' AS status FROM lineitem
UNION ALL SELECT 'events', count(*), count(DISTINCT event_id), 0, 0, 'PASS' FROM events""",
)
def keys(t: Tables):
    a = Q.key_report(t.lineitem, ["l_orderkey", "l_linenumber"], "lineitem")
    b = Q.key_report(
        t.events.select(F.col("event_id").alias("l_orderkey"), F.lit(1).alias("l_linenumber")),
        ["l_orderkey", "l_linenumber"],
        "events",
    )
    return a.unionByName(b)


@query(
    "dq_02_duplicate_report",
    """WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)
SELECT 'lineitem' AS table_name, CAST(sum(n - 1) AS BIGINT) AS dup_count, CAST(count(*) FILTER (n > 1) AS BIGINT) AS keys_with_dups,
  CAST(sum(n) AS BIGINT) AS total_records,
  round(count(*) FILTER (n > 1) / count(*), 8) AS pct_keys_with_dups, round(sum(n - 1) / sum(n), 8) AS pct_duplicate_records, 'FAIL' AS status FROM k""",
)
def dup_report(t: Tables):
    out = Q.duplicate_report(t.lineitem, ["l_orderkey", "l_linenumber"], "lineitem")
    pct = ["pct_keys_with_dups", "pct_duplicate_records"]
    return out.withColumns({c: F.round(c, 8) for c in pct})


@query(
    "dq_02_duplicate_rows",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(rn AS BIGINT) AS rn FROM (SELECT *, row_number() OVER
  (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity) AS rn FROM lineitem) WHERE rn > 1""",
)
def dup_rows(t: Tables):
    order = ["l_partkey", "l_suppkey", "l_quantity"]
    out = Q.duplicate_rows(t.lineitem, ["l_orderkey", "l_linenumber"], order, F.floor(F.col("l_partkey") / 100_000))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "rn")


@query(
    "dq_03_table_equality",
    """WITH e AS (SELECT user_id, event_type, count(*) AS e FROM events GROUP BY 1, 2),
a AS (SELECT user_id, event_type, count(*) AS a FROM events WHERE event_id % 50 <> 0 GROUP BY 1, 2),
j AS (SELECT coalesce(e, 0) AS e, coalesce(a, 0) AS a FROM e FULL OUTER JOIN a USING (user_id, event_type))
SELECT 'events' AS table_name, CAST(sum(e) AS BIGINT) AS source_count, CAST(sum(a) AS BIGINT) AS target_count,
  CAST(sum(abs(e - a)) AS BIGINT) AS discrepancies, round(sum(abs(e - a)) / sum(e), 8) AS discrepancy_ratio, 'PASS' AS status FROM j""",
)
def equality(t: Tables):
    fewer = t.events.filter(F.col("event_id") % 50 != 0)
    out = Q.equality_report(t.events, fewer, ["user_id", "event_type"], 0.05, "events")
    return out.withColumn("discrepancy_ratio", F.round("discrepancy_ratio", 8))


def price_dimension(t: Tables, broken: bool):
    """Price versions per customer as a validity dimension of days."""
    prices = order_prices(t)
    days = prices.select(
        F.concat(F.lit("C"), F.col("cust")).alias("sku"),
        "o_orderkey",
        F.timestamp_millis("valid_from").cast("date").alias("activeFrom"),
        F.timestamp_millis("valid_until").cast("date").alias("activeUntil"),
        F.col("valid_until").isNull().alias("isActive"),
        F.col("o_totalprice").alias("contract_price"),
    ).filter(F.col("activeUntil").isNull() | (F.col("activeUntil") > F.col("activeFrom")))
    if not broken:
        return days
    # customers 0, 10, 20, ... lose the version before the open one's end; 5, 15, ... keep two open ones
    cust = F.col("o_orderkey")
    gap = F.col("isActive") & (cust % 10 == 0)
    double = ~F.col("isActive") & (cust % 10 == 5)
    return days.withColumns(
        {
            "activeFrom": F.when(gap, F.date_add("activeFrom", 1)).otherwise(F.col("activeFrom")),
            "isActive": F.col("isActive") | double,
        }
    )


_DIM = """
WITH o AS (SELECT 'C' || o_custkey AS sku, o_orderkey, CAST(o_orderdate AS DATE) AS f,
  CAST(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS DATE) AS u, o_totalprice AS p FROM orders),
d AS (SELECT *, u IS NULL AS act FROM o WHERE u IS NULL OR u > f),
b AS (SELECT lower(sku) AS sku, CASE WHEN act AND o_orderkey % 10 = 0 THEN f + 1 ELSE f END AS f, coalesce(u, DATE '2002-01-01') AS u,
  act OR o_orderkey % 10 = 5 AS act FROM d)
"""


@query(
    "dq_04_validity_rules",
    _DIM
    + """, s AS (SELECT *, lag(u) OVER w AS pu, row_number() OVER w AS rn,
  max(act::INTEGER) OVER (PARTITION BY sku ORDER BY f, u ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ab,
  count(*) FILTER (act) OVER (PARTITION BY sku) AS n FROM b WINDOW w AS (PARTITION BY sku ORDER BY f, u))
SELECT sku, CAST(f AS VARCHAR)[:10] AS active_from, CAST(pu AS VARCHAR)[:10] AS previous_until, CAST(n AS BIGINT) AS active_rows,
  CAST(f - pu AS INTEGER) AS gap_days FROM s WHERE act AND (n > 1 OR NOT (rn = 1 OR (f = pu AND coalesce(ab, 0) = 0)))""",
)
def validity(t: Tables):
    month = F.floor(F.unix_date("activeFrom") / 30)
    out = Q.type2_violations(
        price_dimension(t, True), ["sku"], "activeFrom", "activeUntil", "isActive", F.lit(dt.date(2002, 1, 1)), month
    )
    return out.select(
        "sku",
        F.col("activeFrom").cast("string").alias("active_from"),
        F.col("previous_until").cast("string").alias("previous_until"),
        "active_rows",
        "gap_days",
    )


@query(
    "dq_06_rules",
    """SELECT 'quantity_in_bounds' AS rule, CAST(count(*) FILTER (l_quantity BETWEEN 1 AND 45) AS BIGINT) AS passed,
  CAST(count(*) FILTER (NOT l_quantity BETWEEN 1 AND 45) AS BIGINT) AS failed, 'FAIL' AS status FROM lineitem
UNION ALL SELECT 'known_flag', count(*) FILTER (lower(l_returnflag) IN ('a', 'n', 'r')), count(*) FILTER (lower(l_returnflag) NOT IN ('a', 'n', 'r')), 'PASS' FROM lineitem
UNION ALL SELECT 'one_status_per_order', count(*) FILTER (n = 1), count(*) FILTER (n <> 1), 'FAIL' FROM (SELECT count(DISTINCT l_linestatus) AS n FROM lineitem GROUP BY l_orderkey)""",
)
def rules(t: Tables):
    return Q.run_rules(
        t.lineitem,
        [
            Q.Rule("quantity_in_bounds", Q.in_bounds(F.col("l_quantity"), 1, 45)),
            Q.Rule("known_flag", Q.allowed(F.col("l_returnflag"), ["a", "N", "r"])),
            Q.Rule("one_status_per_order", F.count_distinct("l_linestatus") == 1, ("l_orderkey",)),
        ],
    )


@query(
    "dq_10_missing_days",
    """WITH d AS (SELECT unnest(range(DATE '2023-12-20', DATE '2024-02-10', INTERVAL 1 DAY)) AS day)
SELECT strftime(day, '%Y-%m-%d') AS day FROM d WHERE CAST(day AS DATE) NOT IN
  (SELECT CAST(ts AS DATE) FROM events WHERE extract(day FROM ts) % 6 <> 0)""",
)
def days(t: Tables):
    e = t.events.filter(F.dayofmonth("ts") % 6 != 0)
    out = Q.missing_days(e, F.col("ts"), dt.date(2023, 12, 20), dt.date(2024, 2, 10))
    return out.select(F.col("day").cast("string").alias("day"))


@query(
    "dq_12_price_update",
    _DIM
    + """, n AS (SELECT sku, max(p) + 1 AS np FROM d WHERE o_orderkey % 3 = 0 GROUP BY 1),
j AS (SELECT d.*, np, act AND np IS NOT NULL AND p <> np AS changed FROM d LEFT JOIN n USING (sku))
SELECT sku, o_orderkey, CAST(f AS VARCHAR)[:10] AS active_from, CASE WHEN changed THEN '2002-01-01' ELSE CAST(u AS VARCHAR)[:10] END AS active_until,
  act AND NOT changed AS is_active, p AS contract_price FROM j
UNION ALL SELECT sku, o_orderkey, '2002-01-01', NULL, true, np FROM j WHERE changed""",
)
def price_update(t: Tables):
    dim = price_dimension(t, False)
    changed = dim.filter(F.col("o_orderkey") % 3 == 0).groupBy("sku").agg((F.max("contract_price") + 1).alias("contract_price"))
    out = Q.update_type2(dim, changed, ["sku"], "contract_price", F.lit(dt.date(2002, 1, 1)))
    return out.select(
        "sku",
        "o_orderkey",
        F.col("activeFrom").cast("string").alias("active_from"),
        F.col("activeUntil").cast("string").alias("active_until"),
        F.col("isActive").alias("is_active"),
        "contract_price",
    )


