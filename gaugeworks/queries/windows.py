"""Queries of the keep-one, fill, interval and session operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.operators import aggregates, dedup, fill, sessions
from gaugeworks.operators.asof import TimeSeries
from gaugeworks.operators.scan import Running, ordered_scan
from gaugeworks.queries.registry import Tables, day_slice, ms, query


@query(
    "win_01_keep_one_per_key",
    """SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""",
)
def keep_one(t: Tables):
    """Events arrive twice; the first of each user and type stays."""
    twice = t.events.unionByName(t.events)
    out = dedup.keep_first(twice, ["user_id", "event_type"], ["ts", "event_id"])
    return out.select("user_id", "event_type", "event_id", "value")


@query(
    "win_02_latest_per_key",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def latest(t: Tables):
    out = dedup.latest_per_key(t.orders, ["o_custkey"], "o_orderdate", ["o_orderkey"])
    return out.select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "win_02_latest_snapshot",
    """SELECT o_orderpriority, o_orderkey FROM orders
QUALIFY rank() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC) = 1""",
)
def snapshot(t: Tables):
    """All orders of the newest day of each priority."""
    return dedup.latest_snapshot(t.orders, ["o_orderpriority"], "o_orderdate").select("o_orderpriority", "o_orderkey")


_GAPS = """WITH e AS (SELECT *, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS v,
  CASE WHEN event_type = 'click' THEN props END AS p FROM events) """


def _gaps(t: Tables):
    return t.events.withColumns(
        {
            "v": F.when(F.col("event_type") != "error", F.col("value")),
            "p": F.when(F.col("event_type") == "click", F.col("props")),
        }
    )


@query(
    "win_03_fill_forward",
    _GAPS
    + """SELECT event_id, last_value(v IGNORE NULLS) OVER w AS v,
  coalesce(last_value(p IGNORE NULLS) OVER w, last_value(event_type IGNORE NULLS) OVER w) AS p
FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def forward(t: Tables):
    out = fill.fill_forward(
        _gaps(t), ["user_id"], ["ts", "event_id"], {"v": [], "p": [F.col("event_type")]}, day_slice()
    )
    return out.select("event_id", "v", "p")


@query(
    "win_03_fill_forward_lookups_only",
    _GAPS
    + """SELECT event_id, last_value(v IGNORE NULLS) OVER w AS p
FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def forward_lookups(t: Tables):
    df = _gaps(t).withColumn("p", F.col("value"))
    out = fill.fill_forward(df, ["user_id"], ["ts", "event_id"], {"p": [F.col("v")]}, day_slice(), own_first=False)
    return out.select("event_id", "p")


@query(
    "win_04_fill_both_ways",
    _GAPS
    + """SELECT event_id, coalesce(v, last_value(v IGNORE NULLS) OVER w, first_value(v IGNORE NULLS) OVER n) AS v,
  coalesce(p, last_value(v IGNORE NULLS) OVER w::VARCHAR, first_value(v IGNORE NULLS) OVER n::VARCHAR) IS NOT NULL AS has_p
FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
 n AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
)
def both(t: Tables):
    out = fill.fill_both_ways(
        _gaps(t), ["user_id"], ["ts", "event_id"], {"v": [], "p": [F.col("v").cast("string")]}, day_slice()
    )
    return out.select("event_id", "v", F.col("p").isNotNull().alias("has_p"))


@query(
    "win_05_fill_meta",
    _GAPS
    + """SELECT event_id, coalesce(v, last_value(v IGNORE NULLS) OVER w, first_value(v IGNORE NULLS) OVER n) AS v,
  coalesce(p, last_value(p IGNORE NULLS) OVER w, first_value(p IGNORE NULLS) OVER n) AS p
FROM e WINDOW w AS (PARTITION BY user_id % 2 ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
 n AS (PARTITION BY user_id % 2 ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
)
def meta(t: Tables):
    """Two keys hold all the rows."""
    df = _gaps(t).withColumn("k", F.col("user_id") % 2)
    return fill.fill_meta(df, ["v", "p"], ["k"], ["ts", "event_id"], day_slice()).select("event_id", "v", "p")


@query(
    "win_06_next_value",
    _GAPS
    + """SELECT event_id,
  first_value(p IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING) AS near,
  first_value(p IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ever
FROM e""",
)
def next_value(t: Tables):
    by = day_slice()
    order = ["ts", "event_id"]
    df = fill.near_value(_gaps(t), ["user_id"], order, {"near": ("p", "first")}, by, within=3)
    df = fill.near_value(df, ["user_id"], order, {"ever": ("p", "first")}, by, within=None)
    return df.select("event_id", "near", "ever")


@query(
    "win_07_state_intervals",
    """SELECT event_id, (epoch_us(ts) // 1000) AS state_start,
  coalesce(lead((epoch_us(ts) // 1000)) OVER (PARTITION BY user_id ORDER BY (epoch_us(ts) // 1000), event_id) - 1, 1706745600000) AS state_end
FROM events""",
)
def intervals(t: Tables):
    e = t.events.select("user_id", "event_id", ms("ts").alias("at"))
    out = sessions.state_intervals(
        e, ["user_id"], "at", ["event_id"], F.lit(1706745600000), F.floor(F.col("at") / 86_400_000)
    )
    return out.select("event_id", "state_start", "state_end")


@query(
    "win_08_reset_sessions",
    """WITH s AS (SELECT *, CAST(floor(value * 100) AS BIGINT) AS amount,
  sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)
SELECT event_id, CAST(n AS BIGINT) AS session_no,
  CAST(sum(amount) OVER (PARTITION BY user_id, n ORDER BY ts, event_id) AS BIGINT) AS session_total FROM s""",
)
def resets(t: Tables):
    out = sessions.reset_sessions(
        t.events,
        ["user_id"],
        ["ts", "event_id"],
        F.col("event_type") == "signup",
        F.floor(F.col("value") * 100),
        day_slice(),
    )
    return out.select("event_id", "session_no", "session_total")


# Event types read as cluster states.
STATE_OF_TYPE = {
    "signup": "CREATING",
    "view": "RUNNING",
    "click": "RESIZING",
    "purchase": "EXPANDED_DISK",
    "error": "TERMINATING",
}
STATE_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATE_OF_TYPE.items()) + " END"


def states(t: Tables):
    kind = F.create_map(*[F.lit(x) for kv in STATE_OF_TYPE.items() for x in kv])
    return t.events.select("user_id", "event_id", ms("ts").alias("at_ms"), kind[F.col("event_type")].alias("state"))


_IMPUTED = f"""
WITH e AS (SELECT user_id, event_id, epoch_us(ts) // 1000 AS at_ms, {STATE_SQL} AS state FROM events),
s AS (SELECT *, CASE WHEN state = 'TERMINATING' THEN false WHEN state = 'CREATING' THEN true END AS sw FROM e),
c AS (SELECT *, lead(sw) OVER (PARTITION BY user_id ORDER BY at_ms, event_id) AS nxt,
  last_value(sw IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY at_ms, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cur FROM s),
i AS (SELECT user_id, event_id, at_ms, state, sw, false AS imputed FROM c
  UNION ALL SELECT user_id, event_id, at_ms + 1, 'TERMINATING', sw, true FROM c WHERE nxt = cur)
"""


@query(
    "win_09_imputed_terminations",
    _IMPUTED + "SELECT user_id, event_id, at_ms, state, imputed FROM i",
)
def imputed(t: Tables):
    out = sessions.impute_terminations(
        states(t), ["user_id"], "at_ms", ["event_id"], "state", F.floor(F.col("at_ms") / 86_400_000)
    )
    return out.select("user_id", "event_id", "at_ms", "state", "imputed")


def _running_sql(before: str, after: str) -> str:
    w = "PARTITION BY user_id ORDER BY at_ms, event_id, imputed ROWS BETWEEN"
    back, ahead = f"{w} {before} PRECEDING AND 1 PRECEDING", f"{w} 1 FOLLOWING AND {after} FOLLOWING"
    return (
        _IMPUTED
        + f""", p AS (SELECT *, last_value(sw IGNORE NULLS) OVER ({back}) AS prv, first_value(sw IGNORE NULLS) OVER ({ahead}) AS nx
  FROM i),
o AS (SELECT *, coalesce(CASE WHEN imputed THEN false END, sw, prv, NOT nx) AS on1 FROM p),
a AS (SELECT *, CASE WHEN on1 IS NULL AND state IN ('RUNNING', 'CREATING', 'RESIZING') THEN true ELSE on1 END AS on2 FROM o),
f AS (SELECT *, coalesce(on2, last_value(on2 IGNORE NULLS) OVER ({back}), NOT first_value(on2 IGNORE NULLS) OVER ({ahead}),
  false) AS on3 FROM a),
g AS (SELECT *, lag(on3) OVER (PARTITION BY user_id ORDER BY at_ms, event_id, imputed) AS was FROM f)
SELECT event_id, at_ms, imputed, state,
  CASE WHEN was = false AND state = 'EXPANDED_DISK' THEN false ELSE on3 END AS is_running FROM g"""
    )


def _inferred(t: Tables, within: int | None) -> DataFrame:
    by = F.floor(F.col("at_ms") / 86_400_000)
    out = sessions.infer_running(states(t), ["user_id"], "at_ms", ["event_id"], "state", by, within=within)
    return out.select("event_id", "at_ms", "imputed", "state", "is_running")


@query("win_09_running_inference", _running_sql("UNBOUNDED", "UNBOUNDED"))
def running(t: Tables):
    return _inferred(t, None)


@query("win_09_running_inference_limit", _running_sql("2", "2"))
def running_near(t: Tables):
    """Only values at most two rows away count."""
    return _inferred(t, 2)


@query(
    "win_10_prior_rows",
    """SELECT o_orderkey, max(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS max_before,
  lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS before FROM orders""",
)
def prior(t: Tables):
    price = F.col("o_totalprice")
    out = ordered_scan(
        t.orders,
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
        [Running("max_before", "max", price, True), Running("before", "lag", price)],
        F.floor(F.unix_seconds("o_orderdate") / (30 * 86_400)),
    )
    return out.select("o_orderkey", "max_before", "before")


_PROPS = "CAST(json_extract(props, '$.k') AS INTEGER)"


@query(
    "win_11_group_fills",
    f"""WITH e AS (SELECT *, {_PROPS} AS k, CASE WHEN event_id % 7 = 0 THEN 'u' || user_id END AS who FROM events),
a AS (SELECT *, coalesce(who, min(who) OVER (PARTITION BY user_id, k)) AS w1 FROM e),
b AS (SELECT *, coalesce(w1, min(w1) OVER (PARTITION BY user_id, event_type)) AS w2 FROM a)
SELECT event_id, w2 AS who FROM b""",
)
def group_fills(t: Tables):
    e = t.events.withColumns(
        {
            "k": F.get_json_object("props", "$.k").cast("int"),
            "who": F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("u"), F.col("user_id"))),
        }
    )
    out = fill.fill_from_groups(e, "who", [["user_id", "k"], ["user_id", "event_type"]])
    return out.select("event_id", "who")


@query(
    "win_12_ratio_to_total",
    """SELECT l_orderkey, l_linenumber, l_partkey, round(l_quantity / sum(l_quantity) OVER (PARTITION BY l_orderkey), 8) AS share FROM lineitem""",
)
def ratio(t: Tables):
    out = aggregates.ratio_to_total(t.lineitem, ["l_orderkey"], "l_quantity", "share")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.round("share", 8).alias("share"))


@query(
    "win_13_bounded_frames",
    """SELECT event_id,
  CAST(sum(event_id) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS BIGINT) AS sum_rows,
  CAST(count(*) OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000 RANGE BETWEEN 86400000 PRECEDING AND CURRENT ROW) AS BIGINT) AS day_count
FROM events""",
)
def frames(t: Tables):
    e = t.events.select("user_id", "event_id", ms("ts").alias("at"))
    by_rows = TimeSeries(e, "at", ["user_id"]).rows_frame(2, 1, {"sum_rows": F.sum("event_id")}, ["event_id"])
    out = TimeSeries(by_rows, "at", ["user_id"]).range_frame(86_400_000, 0, {"day_count": F.count(F.lit(1))})
    return out.select("event_id", "sum_rows", "day_count")


@query(
    "win_14_first_occurrence",
    """WITH f AS (SELECT user_id, event_type, min_by(event_id, (ts, event_id)) AS first_id FROM events GROUP BY ALL)
SELECT user_id, max(first_id) FILTER (event_type = 'signup') AS start_id, max(first_id) FILTER (event_type = 'error') AS end_id,
  max(first_id) FILTER (event_type = 'click') AS cancel_id FROM f GROUP BY 1""",
)
def first_occurrence(t: Tables):
    first = dedup.keep_first(t.events, ["user_id", "event_type"], ["ts", "event_id"])

    def of(kind: str, name: str):
        return F.max(F.when(F.col("event_type") == kind, F.col("event_id"))).alias(name)

    return first.groupBy("user_id").agg(of("signup", "start_id"), of("error", "end_id"), of("click", "cancel_id"))


@query(
    "win_15_settings_merge",
    f"""WITH e AS (SELECT *, CASE event_type WHEN 'click' THEN 'update' WHEN 'signup' THEN 'reset' ELSE 'create' END AS action,
  CASE WHEN event_type IN ('click', 'signup') AND {_PROPS} % 3 = 0 THEN {_PROPS} END AS fresh,
  CASE WHEN event_type = 'view' THEN {_PROPS} END AS own,
  event_type = 'click' AND {_PROPS} % 2 = 0 AS listed,
  CASE WHEN event_type = 'error' THEN 1000 + {_PROPS} END AS snap FROM events)
SELECT event_id, CASE WHEN action = 'update' AND listed THEN fresh ELSE coalesce(
  last_value(coalesce(fresh, own) IGNORE NULLS) OVER w, last_value(snap IGNORE NULLS) OVER w) END AS size
FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def settings(t: Tables):
    k = F.get_json_object("props", "$.k").cast("int")
    kind = F.col("event_type")
    e = t.events.select(
        "user_id",
        "ts",
        "event_id",
        F.when(kind == "click", "update").when(kind == "signup", "reset").otherwise("create").alias("actionName"),
        F.when(
            kind.isin("click", "signup") & (k % 3 == 0), F.to_json(F.struct(k.alias("max_size")))
        ).alias("new_settings"),
        F.when(kind == "view", k).alias("size"),
        F.when(kind == "click", F.when(k % 2 == 0, '["max_size"]').otherwise('["other"]')).alias("fields_to_remove"),
        F.when(kind == "error", F.to_json(F.struct((k + 1000).alias("max_size")))).alias("lookup_settings"),
    )
    out = fill.merge_settings(e, {"size": "max_size"}, ["user_id"], ["ts", "event_id"], day_slice())
    return out.select("event_id", "size")
