"""Queries of the schema operators."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.operators import schema as S
from gaugeworks.queries.registry import Tables, query
from gaugeworks.sources.files import case_sensitive


def nested_orders(t: Tables):
    """Orders with a nested customer."""
    c = t.customer.select(
        "c_custkey",
        F.struct(
            F.col("c_name").alias("name"),
            F.col("c_acctbal").alias("balance"),
            F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")).alias("place"),
        ).alias("cust"),
    )
    return t.orders.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "o_totalprice", "cust"
    )


_ORDERS = "FROM orders JOIN customer ON o_custkey = c_custkey"


@query(
    "prj_01_flatten",
    f"""SELECT o_orderkey, o_totalprice, c_name AS cust_name, c_acctbal AS cust_balance, c_mktsegment AS cust_place_segment,
  c_nationkey AS cust_place_nation {_ORDERS}""",
)
def flatten(t: Tables):
    return S.flatten(nested_orders(t))


@query("prj_05_drop_struct_fields", f"SELECT o_orderkey, o_totalprice, c_name AS cust_name {_ORDERS}")
def drop_fields(t: Tables):
    return S.flatten(S.drop_struct_fields(nested_orders(t), "cust", ["BALANCE", "place"]))


@query(
    "prj_06_modify_struct",
    f"""SELECT o_orderkey, round(o_totalprice / 1000, 8) AS o_totalprice, c_name AS cust_name, c_acctbal AS cust_balance,
  lower(c_mktsegment) AS cust_place_segment, c_nationkey AS cust_place_nation {_ORDERS}""",
)
def modify(t: Tables):
    changes = {
        "o_totalprice": F.round(F.col("o_totalprice") / 1000, 8),
        "cust.place.segment": F.lower("cust.place.segment"),
        "cust.not_there": F.lit(1),
    }
    return S.flatten(S.modify_struct(nested_orders(t), changes))


@query(
    "prj_07_append_to_struct",
    f"""SELECT o_orderkey, o_totalprice, c_name AS cust_name, c_acctbal AS cust_balance, c_mktsegment AS cust_place_segment,
  c_nationkey AS cust_place_nation, o_orderkey % 7 AS cust_bucket {_ORDERS}""",
)
def append(t: Tables):
    new = {"bucket": F.col("o_orderkey") % 7, "name": F.lit("not taken")}
    return S.flatten(S.append_to_struct(nested_orders(t), "cust", new))


@query(
    "prj_08_struct_from_json",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
)
def from_json(t: Tables):
    """The schema comes from one pass over all the texts."""
    e = t.events
    return e.select("event_id", S.struct_from_json(e, "props").alias("p")).select("event_id", "p.k")


@query(
    "prj_09_struct_to_map",
    f"SELECT o_orderkey, CAST(2 + (o_orderkey % 2) AS INTEGER) AS n, c_name AS name, CASE WHEN o_orderkey % 2 = 1 THEN c_mktsegment END AS segment {_ORDERS}",
)
def to_map(t: Tables):
    df = nested_orders(t).select(
        "o_orderkey",
        F.struct(
            F.col("cust.name").alias("name"),
            F.when(F.col("o_orderkey") % 2 == 1, F.col("cust.place.segment")).alias("segment"),
            F.col("cust.balance").alias("balance"),
        ).alias("tags"),
    )
    out = df.withColumn("tags", S.struct_to_map(df.schema, "tags"))
    return out.select(
        "o_orderkey",
        F.size("tags").alias("n"),
        F.try_element_at("tags", F.lit("name")).alias("name"),
        F.try_element_at("tags", F.lit("segment")).alias("segment"),
    )


@query("prj_10_drop_empty_columns", "SELECT event_id, event_type, value FROM events")
def drop_empty(t: Tables):
    """The columns without any value go: one pass counts them all."""
    e = t.events.select(
        "event_id",
        "event_type",
        F.when(F.col("value") < 0, F.col("props")).alias("never"),
        F.lit(None).cast("map<string,string>").alias("void_map"),
        "value",
    )
    return S.drop_empty_columns(e)


@query(
    "prj_11_enforce_schema",
    f"""SELECT NULL::VARCHAR AS note, o_totalprice AS o_totalprice, CAST(o_orderkey AS VARCHAR) AS o_orderkey,
  NULL::INTEGER AS cust_level, c_acctbal AS cust_balance, c_name AS cust_name {_ORDERS}""",
)
def enforce(t: Tables):
    required = T.StructType.fromDDL("note string, o_orderkey string, cust struct<level:int, name:string>")
    cust = required["cust"].dataType
    banned = T.StructType([*cust.fields, T.StructField("place", T.NullType())])
    required = T.StructType([*required.fields[:2], T.StructField("cust", banned)])
    return S.flatten(S.enforce_schema(nested_orders(t), required))


@query(
    "prj_13_scrub_schema",
    """SELECT o_orderkey AS order_key, o_totalprice AS "p_x_UNIQUESUFFIX_108837", o_custkey AS info_cust_id,
  o_orderstatus AS info_thestatus, o_orderpriority AS "p_x_UNIQUESUFFIX_108899" FROM orders""",
)
def scrub(t: Tables):
    messy = t.orders.select(
        F.col("o_orderkey").alias("order-key"),
        F.struct(F.col("o_custkey").alias("cust.id"), F.col("o_orderstatus").alias("the status")).alias("in fo"),
        F.col("o_totalprice").alias("p#x"),
        F.col("o_orderpriority").alias("p%x"),
    )
    return S.flatten(S.scrub_schema(messy))


@query(
    "prj_14_column_tools",
    "SELECT o_totalprice AS b_price, o_orderkey AS k_x, o_orderstatus AS status FROM orders",
)
def column_tools(t: Tables):
    df = t.orders.select(
        F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price")
    )
    df = S.prefix_columns(S.suffix_columns(df, "_x", ["k"]), "b_", ["price"])
    front = S.columns_to_front(df, ["b_price"])
    other = front.select("k_x", F.col("status").alias("again"))
    joined = front.alias("l").join(other.alias("r"), "k_x")
    return S.drop_by_alias(joined, "r", ["again"])


@query(
    "prj_15_add_columns_of_other",
    "SELECT s_suppkey, s_name, NULL::BIGINT AS c_custkey, NULL::VARCHAR AS c_mktsegment FROM supplier",
)
def add_columns(t: Tables):
    return S.add_columns_of(t.supplier.select("s_suppkey", "s_name"), t.customer.select("c_custkey", "c_mktsegment"))


@query(
    "prj_16_fill_all_nulls",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_totalprice END AS price,
  CASE WHEN o_orderstatus = 'F' THEN '0' ELSE o_orderpriority END AS priority, o_orderstatus = 'O' AS open FROM orders""",
)
def fill_nulls(t: Tables):
    status = F.col("o_orderstatus")
    df = t.orders.select(
        "o_orderkey",
        F.when(status != "P", F.col("o_totalprice")).alias("price"),
        F.when(status != "F", F.col("o_orderpriority")).alias("priority"),
        F.when(status == "O", True).alias("open"),
    )
    return S.fill_all_nulls(df)


@query(
    "prj_17_filters",
    "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_quantity > 40 AND l_returnflag = 'R' AND l_discount < 0.03",
)
def filters(t: Tables):
    wanted = [F.col("l_quantity") > 40, F.col("l_returnflag") == "R", F.col("l_discount") < 0.03]
    return S.apply_filters(t.lineitem, wanted).select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "prj_18_clean_struct_array",
    """SELECT o_orderkey, 'a' || o_orderkey AS first_task, o_orderstatus AS status_tag, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 2 END AS n_tags FROM orders""",
)
def clean_array(t: Tables):
    def task(prefix: str):
        return F.struct(
            F.concat(F.lit(prefix), F.col("o_orderkey")).alias("task_key"),
            F.struct(
                F.struct(
                    F.col("o_orderstatus").alias("status"),
                    F.when(F.col("o_orderkey") % 2 == 1, F.col("o_orderpriority")).alias("priority"),
                ).alias("custom_tags"),
                F.lit(2).alias("num_workers"),
            ).alias("new_cluster"),
        )

    df = t.orders.select("o_orderkey", F.array(task("a"), task("b")).alias("tasks"))
    clean = df.withColumn("tasks", S.clean_struct_array(df, "tasks", ["new_cluster.custom_tags"]))
    tags = F.col("tasks")[0]["new_cluster"]["custom_tags"]
    return clean.select(
        "o_orderkey",
        F.col("tasks")[0]["task_key"].alias("first_task"),
        F.try_element_at(tags, F.lit("status")).alias("status_tag"),
        F.size(tags).alias("n_tags"),
    )


@query(
    "prj_19_case_variants",
    """SELECT event_id, CASE WHEN event_type = 'click' THEN 'B' || event_id ELSE 'a' || event_id END AS item_id,
  CASE event_type WHEN 'click' THEN 'C' || user_id WHEN 'view' THEN 'c' || user_id END AS source_id FROM events""",
)
def case_variants(t: Tables):
    with case_sensitive(t.spark):
        params = F.struct(
            F.concat(F.lit("a"), F.col("event_id")).alias("itemId"),
            F.concat(F.lit("B"), F.col("event_id")).alias("ItemId"),
            F.concat(F.lit("c"), F.col("user_id")).alias("sourceId"),
            F.concat(F.lit("C"), F.col("user_id")).alias("SourceId"),
        )
        df = t.events.select("event_id", F.col("event_type").alias("actionName"), params.alias("requestParams"))
        rules = {
            "itemId": ("ItemId", [(["click"], "ItemId")], True),
            "sourceId": ("SourceId", [(["click"], "SourceId"), (["view"], "sourceId")], False),
        }
        out = S.merge_case_variants(df, "requestParams", rules, "actionName")
        return out.select(
            "event_id",
            F.col("requestParams.itemId").alias("item_id"),
            F.col("requestParams.sourceId").alias("source_id"),
        )


@query(
    "prj_21_project_properties",
    """SELECT event_id, event_type AS kind, 'c' || user_id AS cluster_id, NULL::VARCHAR AS region, props AS payload FROM events""",
)
def properties(t: Tables):
    m = F.create_map(
        F.lit("sparkappname"),
        F.col("event_type"),
        F.lit("clusterid"),
        F.concat(F.lit("c"), F.col("user_id")),
        F.lit("payload"),
        F.col("props"),
    )
    spec = {
        "kind": "sparkappname",
        "payload": "payload",
        "details": {"cluster_id": "clusterid", "region": "region"},
    }
    return (
        t.events.select("event_id", m.alias("m"))
        .select("event_id", S.project_properties(F.col("m"), spec).alias("p"))
        .select("event_id", "p.kind", "p.details.*", "p.payload")
    )
