"""Cluster marts: pools, cluster specifications, state detail, the state fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.functions import costs
from gaugeworks.functions.predicates import cluster_type, derive_sku, is_automated
from gaugeworks.functions.text import dotted_json_value
from gaugeworks.functions.timeutil import day_of_ms, to_ts
from gaugeworks.operators.asof import UNBOUNDED, Lookup, TimeSeries, asof_lookup, asof_lookups
from gaugeworks.operators.dedup import keep_first, latest_per_key
from gaugeworks.operators.fill import fill_forward, fill_meta, near_value
from gaugeworks.operators.joins import missing_from, range_join
from gaugeworks.operators.scan import Running, ordered_scan
from gaugeworks.operators.schema import union_with_nulls
from gaugeworks.operators.sessions import NOT_BILLABLE, RESET_AFTER, infer_running
from gaugeworks.session import materialize
from gaugeworks.sources.tables import TENANT

# Fields of the input.
POOL_SETTINGS = [
    "instance_pool_name",
    "node_type_id",
    "idle_instance_autotermination_minutes",
    "min_idle_instances",
    "max_capacity",
    "preloaded_spark_versions",
    "aws_attributes",
    "azure_attributes",
]
ENDPOINT_TAG = "SqlEndpointId"
IMPUTED = "snapImpute"


def conf_keys(vendor: str) -> dict[str, str]:
    """Names of the cluster settings that carry the platform's name."""
    v = f"spark.{vendor}"
    return {
        "profile": f"{v}.cluster.profile",
        "table_acls": f"{v}.acl.dfAclsEnabled",
        "passthrough": f"{v}.passthrough.enabled",
        "isolation": f"{v}.pyspark.enableProcessIsolation",
        "languages": f"{v}.repl.allowedLanguages",
    }


def snapshot_ms(column: str = "snapshot_ts") -> Column:
    return F.unix_seconds(column) * 1000


def json_map(df: DataFrame, column: str) -> Column:
    """Map of text out of JSON text with free keys."""
    if isinstance(df.schema[column].dataType, T.MapType):
        return F.col(column)
    return F.from_json(F.col(column), "map<string,string>")


# --- pools ------------------------------------------------------------------


def pool_spec(audit: DataFrame, pool_snapshot: DataFrame, first_run: bool, from_ms: int) -> DataFrame:
    """Settings of each pool after each audit record, with create and delete details."""
    keys = [TENANT, "instance_pool_id"]
    ok = F.col("response.statusCode") == 200
    action = F.col("actionName")
    raw = audit.filter((F.col("serviceName") == "instancePools") & action.isin("create", "edit", "delete")).select(
        TENANT, "serviceName", "actionName", "date", "timestamp", "requestId", "response", "sessionId",
        "sourceIPAddress", "userAgent", "userIdentity", "requestParams.instance_pool_id", "requestParams.custom_tags",
        *[f"requestParams.{c}" for c in POOL_SETTINGS],
    )
    created_id = F.get_json_object("response.result", "$.instance_pool_id")
    raw = raw.withColumns(
        {
            "instance_pool_id": F.when(action == "create", created_id).otherwise(F.col("instance_pool_id")),
            "aws_attributes": json_map(raw, "aws_attributes"),
            "azure_attributes": json_map(raw, "azure_attributes"),
            "custom_tags": json_map(raw, "custom_tags"),
        }
    )
    once = keep_first(raw, [*keys, "timestamp"], ["actionName", "requestId"])

    snap = pool_snapshot.withColumn("preloaded_spark_versions", F.to_json("preloaded_spark_versions"))
    lookup = snap.select(
        *keys, snapshot_ms().alias("timestamp"), F.struct(*POOL_SETTINGS).alias("poolSnapDetails")
    )
    base = asof_lookup(
        TimeSeries(once, "timestamp", keys), TimeSeries(lookup, "timestamp", keys), look_ahead=UNBOUNDED
    )
    if first_run:
        newest = latest_per_key(missing_from(snap, once, keys), keys, "snapshot_ts")
        imputed = newest.select(
            F.lit("instancePools").alias("serviceName"),
            F.lit(IMPUTED).alias("actionName"),
            *keys,
            F.lit(from_ms).cast("bigint").alias("timestamp"),
            F.col("snapshot_ts").cast("date").alias("date"),
            *[F.col(c).cast(base.schema[c].dataType).alias(c) for c in POOL_SETTINGS],
            F.col("custom_tags"),
        )
        base = union_with_nulls(base, imputed)

    def made(prefix: str, when: str) -> Column:
        return F.when(
            (action == when) & ok,
            F.struct(
                F.col("userIdentity.email").alias(f"{prefix}_by"),
                F.col("timestamp").alias(f"{prefix}_at_epochMillis"),
                to_ts(F.col("timestamp")).alias(f"{prefix}_at"),
            ),
        )

    base = base.withColumns({"create_details": made("created", "create"), "delete_details": made("deleted", "delete")})
    fills: dict[str, list[Column]] = {
        c: [F.col(f"poolSnapDetails.{c}").cast(base.schema[c].dataType)] for c in POOL_SETTINGS
    }
    fills["create_details"] = []
    base = base.withColumn("__tie", F.coalesce("requestId", F.lit("")))
    filled = fill_forward(base, keys, ["timestamp", "__tie"], fills, day_of_ms(F.col("timestamp")))
    request = F.struct("requestId", "response", "sessionId", "sourceIPAddress", "userAgent")
    return filled.select(
        "serviceName", "actionName", TENANT, "timestamp", "date", "instance_pool_id", *POOL_SETTINGS, "custom_tags",
        "create_details", "delete_details", F.when(action != IMPUTED, request).alias("request_details"),
    )


# --- cluster specification --------------------------------------------------

# Fields of the input.
CLUSTER_FIELDS = [
    "driver_node_type_id", "node_type_id", "num_workers", "autoscale", "autotermination_minutes",
    "enable_elastic_disk", "start_cluster", "cluster_log_conf", "init_scripts", "custom_tags", "cluster_source",
    "aws_attributes", "azure_attributes", "spark_env_vars", "spark_conf", "acl_path_prefix",
    "driver_instance_pool_id", "instance_pool_id", "runtime_engine", "idempotency_token", "single_user_name",
]


def cluster_base(audit: DataFrame) -> DataFrame:
    """Successful cluster records of the audit log with id and name completed."""
    p = audit.schema["requestParams"].dataType.fieldNames()

    def param(name: str) -> Column:
        return F.col(f"requestParams.{name}") if name in p else F.lit(None).cast("string")

    action = F.col("actionName")
    own_id = (
        F.when(action == "create", F.get_json_object("response.result", "$.cluster_id"))
        .when((action != "create") & param("cluster_id").isNull(), param("clusterId"))
        .otherwise(param("cluster_id"))
    )
    raw = (
        audit.filter(
            (F.col("serviceName") == "clusters")
            & (action != "changeClusterAcl")
            & (F.col("response.statusCode") == 200)
            & F.get_json_object(param("custom_tags"), f"$.{ENDPOINT_TAG}").isNull()
        )
        .select(
            "timestamp", "date", TENANT, "serviceName", "actionName",
            F.col("userIdentity.email").alias("userEmail"), "requestId", "response",
            own_id.alias("cluster_id"),
            F.coalesce(param("cluster_name"), param("clusterName")).alias("cluster_name"),
            param("clusterState").alias("cluster_state"),
            *[param(c).alias(c) for c in CLUSTER_FIELDS],
            F.coalesce(param("effective_spark_version"), param("spark_version")).alias("spark_version"),
        )
    )
    order, by = ["timestamp", "requestId"], day_of_ms(F.col("timestamp"))
    # names find their id, then ids their name, in later records
    raw = materialize(raw, "cluster-audit")
    raw = near_value(raw, [TENANT, "cluster_name"], order, {"__id": ("cluster_id", "first")}, by)
    raw = materialize(raw.withColumn("cluster_id", F.col("__id")).drop("__id"), "cluster-ids")
    raw = near_value(raw, [TENANT, "cluster_id"], order, {"__name": ("cluster_name", "first")}, by)
    raw = raw.withColumn("cluster_name", F.col("__name")).drop("__name")
    return raw.withColumns({c: json_map(raw, c) for c in ("aws_attributes", "azure_attributes")})


def _imputed_clusters(base: DataFrame, snapshot: DataFrame) -> DataFrame:
    newest = latest_per_key(snapshot, [TENANT, "cluster_id"], "snapshot_ts")
    gone = missing_from(newest, base, [TENANT, "cluster_id"])
    have = set(gone.columns)

    def text(c: str) -> Column:
        if c not in have:
            return F.lit(None).cast("string")
        kind = gone.schema[c].dataType
        complex_type = isinstance(kind, (T.StructType, T.ArrayType, T.MapType))
        return F.to_json(c) if complex_type else F.col(c).cast("string")

    def as_map(c: str) -> Column:
        return F.col(c) if c in have else F.lit(None).cast("map<string,string>")

    maps = ("aws_attributes", "azure_attributes")
    return gone.select(
        TENANT, "cluster_id", F.lit("clusters").alias("serviceName"), F.lit(IMPUTED).alias("actionName"),
        "cluster_name",
        F.col("state").alias("cluster_state"),
        snapshot_ms().alias("timestamp"),
        F.col("snapshot_ts").cast("date").alias("date"),
        F.lit("-1").alias("requestId"),
        F.coalesce(text("effective_spark_version"), text("spark_version")).alias("spark_version"),
        *[(as_map(c) if c in maps else text(c)).alias(c) for c in CLUSTER_FIELDS],
    )


def cluster_spec(
    audit: DataFrame, cluster_snapshot: DataFrame, pool_snapshot: DataFrame | None, first_run: bool, vendor: str
) -> DataFrame:
    """Specification of each cluster after each create and edit."""
    conf = conf_keys(vendor)
    base = materialize(cluster_base(audit), "cluster-base")
    spec = base.filter(F.col("actionName").isin("create", "edit"))
    if first_run:
        spec = union_with_nulls(spec, _imputed_clusters(spec, cluster_snapshot))

    pools = audit.filter((F.col("serviceName") == "instancePools") & F.col("actionName").isin("create", "edit"))
    pool_id = F.when(
        F.col("actionName") == "create", F.get_json_object("response.result", "$.instance_pool_id")
    ).otherwise(F.col("requestParams.instance_pool_id"))
    from_audit = pools.select(
        "timestamp", TENANT, pool_id.alias("pool"), F.col("requestParams.instance_pool_name").alias("name"),
        F.col("requestParams.node_type_id").alias("node"),
    )
    sources = [(from_audit, "pool_name", "pool_node")]
    if pool_snapshot is not None:
        snaps = pool_snapshot.select(
            snapshot_ms().alias("timestamp"), TENANT, F.col("instance_pool_id").alias("pool"),
            F.col("instance_pool_name").alias("name"), F.col("node_type_id").alias("node"),
        )
        # the first snapshot of a pool also counts for all time before it
        oldest = keep_first(snaps, [TENANT, "pool"], ["timestamp"]).withColumn("timestamp", F.lit(0).cast("bigint"))
        sources.append((snaps.unionByName(oldest), "snap_name", "snap_node"))
    else:
        nothing = F.lit(None).cast("string")
        spec = spec.withColumns({f"{w}_{c}": nothing for w in ("worker", "driver") for c in ("snap_name", "snap_node")})
    spec = materialize(_look_up_pools(spec, sources, "worker", "instance_pool_id"), "pool-worker")
    spec = _look_up_pools(spec, sources, "driver", "driver_instance_pool_id")

    spec = keep_first(spec, [TENANT, "cluster_id", "actionName", "timestamp"], ["requestId"])
    keys, order, by = [TENANT, "cluster_id"], ["timestamp", "requestId"], day_of_ms(F.col("timestamp"))
    automated = is_automated(F.col("cluster_name"))
    spec = spec.withColumns(
        {
            "__creator": F.when(
                F.col("actionName") == "create",
                F.when(automated, F.lit("JobsService")).when(~automated, F.col("userEmail")),
            ),
            "__editor": F.when(~automated & (F.col("actionName") == "edit"), F.col("userEmail")),
        }
    )
    spec = near_value(
        materialize(spec, "cluster-spec"),
        keys,
        order,
        {
            "__driver_before": ("driver_node_type_id", "last"),
            "__version": ("spark_version", "last"),
            "__creator_before": ("__creator", "last"),
            "__editor_before": ("__editor", "last"),
        },
        by,
    )
    single = dotted_json_value(F.col("spark_conf"), conf["profile"]) == "singleNode"
    single = F.coalesce(single, F.lit(False))
    kind = cluster_type(F.col("spark_conf"), F.col("custom_tags"), conf["profile"], ENDPOINT_TAG)
    pooled, driver_pooled = F.col("instance_pool_id").isNotNull(), F.col("driver_instance_pool_id").isNotNull()
    driver = (
        F.when(driver_pooled, F.coalesce("driver_pool_node", "driver_snap_node", "driver_node_type_id"))
        .when(pooled, F.coalesce("worker_pool_node", "worker_snap_node", "node_type_id"))
        .when(automated, F.coalesce("driver_node_type_id", "node_type_id"))
        .when(single, F.col("node_type_id"))
        .otherwise(F.coalesce("driver_node_type_id", "__driver_before", "node_type_id"))
    )
    worker = (
        F.when(single, F.lit(None).cast("string"))
        .when(pooled, F.coalesce("worker_pool_node", "worker_snap_node", "node_type_id"))
        .otherwise(F.col("node_type_id"))
    )

    def flag(key: str) -> Column:
        return F.coalesce(dotted_json_value(F.col("spark_conf"), conf[key]).try_cast("boolean"), F.lit(False))

    security = F.struct(
        flag("table_acls").alias("table_acls_enabled"),
        flag("passthrough").alias("credential_passthrough"),
        flag("isolation").alias("process_isolation"),
        F.coalesce(
            F.split(dotted_json_value(F.col("spark_conf"), conf["languages"]), ","), F.array(F.lit("All"))
        ).alias("languages_allowed"),
        F.struct(F.col("single_user_name").isNotNull().alias("is_single_user"), "single_user_name").alias(
            "single_user_profile"
        ),
        F.try_element_at("aws_attributes", F.lit("instance_profile_arn")).alias("instance_profile_arn"),
    )
    removed = keep_first(
        base.filter("actionName = 'permanentDelete'").select(*keys, F.col("userEmail").alias("deleted_by"), "timestamp"),
        keys,
        ["timestamp"],
    ).drop("timestamp")
    creators = latest_per_key(cluster_snapshot, keys, "snapshot_ts").select(
        *keys, F.try_element_at("default_tags", F.lit("Creator")).alias("__tagged_creator")
    )
    version = F.col("__version")
    fast = version.like("%_photon_%")
    return (
        spec.join(creators, keys, "left")
        .join(removed, keys, "left")
        .select(
            "serviceName", "actionName", TENANT, "cluster_id",
            F.when(kind == "SQL Analytics", F.lit("SQLAnalytics")).otherwise(F.col("cluster_name")).alias("cluster_name"),
            driver.alias("driver_node_type_id"),
            worker.alias("node_type_id"),
            F.when(single, F.lit(0)).otherwise(F.col("num_workers").try_cast("int")).alias("num_workers"),
            "autoscale",
            F.col("autotermination_minutes").try_cast("int").alias("autotermination_minutes"),
            (F.coalesce(F.col("enable_elastic_disk"), F.lit("")) != "false").alias("enable_elastic_disk"),
            automated.alias("is_automated"),
            kind.alias("cluster_type"),
            (F.coalesce(F.col("start_cluster"), F.lit("")) != "false").alias("start_cluster"),
            "cluster_log_conf", "init_scripts", "custom_tags", "cluster_source", "aws_attributes", "azure_attributes",
            "spark_env_vars", "spark_conf", "acl_path_prefix", "driver_instance_pool_id", "instance_pool_id",
            F.when(pooled, F.coalesce("worker_pool_name", "worker_snap_name")).alias("instance_pool_name"),
            F.when(driver_pooled, F.coalesce("driver_pool_name", "driver_snap_name")).alias("driver_instance_pool_name"),
            version.alias("spark_version"),
            "idempotency_token", "timestamp",
            F.coalesce(
                F.when(~automated, F.coalesce("__creator", "__creator_before")).otherwise(F.col("__creator")),
                F.col("__tagged_creator"),
            ).alias("createdBy"),
            F.coalesce("__editor", "__editor_before").alias("lastEditedBy"),
            "deleted_by",
            F.when(F.col("runtime_engine").isNotNull(), F.col("runtime_engine"))
            .when(fast, "PHOTON")
            .when(~fast, "STANDARD")
            .otherwise("UNKNOWN")
            .alias("runtime_engine"),
            security.alias("security_profile"),
        )
    )


def _look_up_pools(spec: DataFrame, sources: list[tuple[DataFrame, str, str]], who: str, key: str) -> DataFrame:
    """Name and node type of a pool at each record, from all sources in one scan."""
    keys = [TENANT, key]
    lookups = []
    for pools, name, node in sources:
        side = pools.select(
            "timestamp", TENANT, F.col("pool").alias(key), F.col("name").alias(f"{who}_{name}"),
            F.col("node").alias(f"{who}_{node}"),
        ).filter(F.col(key).isNotNull())
        lookups.append(Lookup(TimeSeries(side, "timestamp", keys)))
    return asof_lookups(TimeSeries(spec, "timestamp", keys), lookups)["timestamp"]


# --- states -----------------------------------------------------------------


def cluster_state_detail(events: DataFrame, until_ms: int, within: int | None = None) -> DataFrame:
    """States of each cluster with their times, workers, uptime and what is billed.

    ``within`` limits how many rows away a switch or worker count may be found (None: no limit).
    """
    keys = [TENANT, "cluster_id"]
    by = day_of_ms(F.col("timestamp"))
    flat = events.select(
        *keys, "timestamp", F.col("type").alias("state"), F.col("type").alias("event_type"),
        F.col("details.current_num_workers").alias("current_num_workers"),
        F.col("details.target_num_workers").alias("target_num_workers"),
        F.col("details.cluster_size.num_workers").alias("__size"),
        F.col("details.cluster_size.autoscale.min_workers").alias("__min"),
    )
    sized = F.coalesce("current_num_workers", "__size", "__min")
    rows = infer_running(flat, keys, "timestamp", ["event_type"], "state", by, sized, within)

    running = F.col("is_running")
    current = F.coalesce(F.when(running, F.coalesce(sized, F.col("workers_before"))), F.lit(0))
    target = F.coalesce(
        F.when(
            running,
            F.when(F.col("state") == "CREATING", F.coalesce("__size", "__min")).otherwise(
                F.coalesce(F.col("target_num_workers"), current)
            ),
        ),
        F.lit(0),
    )
    reset = F.coalesce(F.col("previous_state").isin(RESET_AFTER), F.lit(False)) | ~running
    end = F.coalesce(F.col("next_ts") - 1, F.lit(until_ms))
    rows = rows.select(
        *keys, "state", "timestamp", "event_type", "imputed", "row_no",
        running.alias("isRunning"),
        current.alias("current_num_workers"),
        target.alias("target_num_workers"),
        reset.alias("__reset"),
        F.col("timestamp").alias("unixTimeMS_state_start"),
        end.alias("unixTimeMS_state_end"),
    )
    rows = materialize(rows, "states")
    # ends and starts meet, so uptime since a reset needs only where the reset was
    opened = F.when(
        F.col("__reset") | (F.col("row_no") == 1), F.struct(F.col("timestamp").alias("ts"), F.col("row_no").alias("n"))
    )
    rows = ordered_scan(
        rows, keys, ["timestamp", "event_type", "imputed"], [Running("__open", "last", opened)], by
    )
    start, stop = F.col("unixTimeMS_state_start"), F.col("unixTimeMS_state_end")
    since = (stop - F.col("__open.ts")) - (F.col("row_no") - F.col("__open.n"))
    in_state = (stop - start) / 1000
    days = F.sequence(to_ts(start, result=T.DateType()), to_ts(stop, result=T.DateType()))
    return rows.select(
        *keys, "isRunning", "state", "current_num_workers", "target_num_workers",
        start, stop,
        to_ts(start).alias("timestamp_state_start"),
        to_ts(stop).alias("timestamp_state_end"),
        to_ts(start, result=T.DateType()).alias("state_start_date"),
        in_state.alias("uptime_in_state_S"),
        F.when(F.col("__reset"), F.lit(0.0)).otherwise(since / 1000).alias("uptime_since_restart_S"),
        F.col("isRunning").alias("cloud_billable"),
        (F.col("isRunning") & ~F.col("state").isin(NOT_BILLABLE)).alias("platform_billable"),
        (in_state / 3600).alias("uptime_in_state_H"),
        days.alias("state_dates"),
        F.size(days).alias("days_in_state"),
    )


# Fields that describe a state.
STATE_META = [
    "cluster_name", "custom_tags", "driver_node_type_id", "runtime_engine", "node_type_id", "spark_version", "sku",
    "unit_rate", "driverSpecs", "workerSpecs",
]


def cluster_state_fact(
    states: DataFrame,
    spec: DataFrame,
    snapshot: DataFrame,
    machine_prices: DataFrame,
    unit_prices: DataFrame,
    snapshot_time_ms: int,
) -> DataFrame:
    """Cost of each cluster state.

    Specifications get the unit price of their class as of their time; states
    get the specification as of their start, else the snapshot, and the
    machine prices valid at their start.
    """
    keys = [TENANT, "cluster_id"]
    rates = unit_prices.select(
        TENANT,
        (F.unix_seconds(F.col("activeFrom").cast("timestamp")) * 1000).alias("timestamp"),
        "sku",
        F.col("contract_price").alias("unit_rate"),
    )
    rates = TimeSeries(rates, "timestamp", [TENANT, "sku"])
    sku = derive_sku(is_automated(F.col("cluster_name")), F.col("spark_version"), F.col("cluster_type"))
    fields = [
        *keys, "cluster_name", "custom_tags", "timestamp", "driver_node_type_id", "node_type_id", "spark_version",
        "cluster_type", "runtime_engine",
    ]

    snaps = snapshot.select(
        *keys, "cluster_name", F.to_json("custom_tags").alias("custom_tags"),
        F.coalesce("terminated_time", "start_time").alias("timestamp"), "driver_node_type_id", "node_type_id",
        "spark_version", F.lit(None).cast("string").alias("cluster_type"), "runtime_engine",
    )
    # specifications and snapshots get their prices together
    described = spec.select(*fields, F.lit(True).alias("is_spec")).unionByName(
        snaps.select(*fields, F.lit(False).alias("is_spec"))
    )
    with_sku = TimeSeries(described.withColumn("sku", sku), "timestamp", [TENANT, "sku"])
    month = 30 * 86_400_000
    priced = materialize(asof_lookup(with_sku, rates, slice_width=month), "priced")
    sides = [TimeSeries(priced.filter(c).drop("is_spec"), "timestamp", keys) for c in ("is_spec", "not is_spec")]
    states = TimeSeries(states, "unixTimeMS_state_start", keys)
    df = asof_lookups(states, [Lookup(x, look_ahead=1) for x in sides], left_order=["state"])[states.ts].drop("cluster_type")

    # both node types of a state look up their prices together
    start = "unixTimeMS_state_start"
    machines = machine_prices.select(
        F.col(TENANT).alias("__tenant"),
        F.trim(F.lower("API_Name")).alias("__node"),
        F.struct(*machine_prices.columns).alias("__specs"),
        (F.unix_seconds(F.col("activeFrom").cast("timestamp")) * 1000).alias("__valid_from"),
        (F.unix_seconds(F.col("activeUntil").cast("timestamp")) * 1000).alias("__valid_until"),
    )
    nodes = {who: F.trim(F.lower(c)) for who, c in (("driver", "driver_node_type_id"), ("worker", "node_type_id"))}
    df = materialize(df, "state-lookup")
    used = df.select(TENANT, F.col(start), F.explode(F.array(*nodes.values())).alias("node")).distinct()
    on = [(TENANT, "__tenant"), ("node", "__node")]
    prices = range_join(
        used, machines, on, start, "__valid_from", "__valid_until", F.lit(snapshot_time_ms), how="inner",
        bucket=86_400_000, text_keys=False,
    )
    prices = materialize(prices.select(TENANT, start, "node", "__specs"), "machine-prices")
    for who, node in nodes.items():
        own = prices.select(TENANT, start, F.col("node").alias("__node"), F.col("__specs").alias(f"{who}Specs"))
        df = df.withColumn("__node", node).join(own, [TENANT, start, "__node"], "left").drop("__node")

    order = ["unixTimeMS_state_start", "state"]
    df = fill_meta(materialize(df, "state-prices"), STATE_META, keys, order, day_of_ms(F.col(order[0])))
    return df.select(*state_fact_columns())


def state_fact_columns() -> list[Column]:
    """The columns of the state fact with all its cost formulas."""
    single = F.coalesce(F.get_json_object("custom_tags", "$.ResourceClass") == "SingleNode", F.lit(False))
    billed, automated = F.col("platform_billable"), is_automated(F.col("cluster_name"))
    seconds, hours = F.col("uptime_in_state_S"), F.col("uptime_in_state_H")
    current, target = F.col("current_num_workers"), F.col("target_num_workers")
    multiplier = costs.engine_multiplier(F.col("runtime_engine"), F.col("sku"), automated)

    potential = (
        F.when(billed & single, F.col("driverSpecs.vCPUs") * seconds)
        .when(billed, F.col("workerSpecs.vCPUs") * current * seconds)
        .otherwise(F.lit(0.0))
    )
    driver_units = F.when(billed, F.col("driverSpecs.Hourly_Units") * hours * multiplier).otherwise(F.lit(0.0))
    worker_units = F.when(billed & ~single, F.col("workerSpecs.Hourly_Units") * current * hours * multiplier).otherwise(
        F.lit(0.0)
    )
    workers = costs.applicable_workers(F.col("state"), current, target)
    driver_core_h = F.round(costs.node_seconds(F.col("state"), F.col("driverSpecs.vCPUs"), seconds) / 3600, 2)
    worker_core_h = F.round(costs.node_seconds(F.col("state"), F.col("workerSpecs.vCPUs"), seconds, workers) / 3600, 2)
    core_h = (
        F.when(F.col("isRunning") & single, driver_core_h)
        .when(F.col("isRunning"), worker_core_h)
        .otherwise(F.lit(0.0))
    )
    cloud = F.col("cloud_billable")
    driver_compute = costs.compute_cost(cloud, F.col("driverSpecs.Compute_Contract_Price"), F.lit(1), hours)
    worker_compute = costs.compute_cost(cloud, F.col("workerSpecs.Compute_Contract_Price"), target, hours)
    driver_unit = costs.unit_cost(driver_units, F.col("unit_rate"))
    worker_unit = costs.unit_cost(worker_units, F.col("unit_rate"))
    plain = [
        TENANT, "cluster_id", "cluster_name", "custom_tags", "state_start_date", "unixTimeMS_state_start",
        "unixTimeMS_state_end", "timestamp_state_start", "timestamp_state_end", "state", "driver_node_type_id",
        "node_type_id", "current_num_workers", "target_num_workers", "uptime_since_restart_S", "uptime_in_state_S",
        "uptime_in_state_H", "cloud_billable", "platform_billable", "sku", "runtime_engine", "unit_rate",
        "state_dates", "days_in_state", "driverSpecs", "workerSpecs",
    ]
    return [
        *[F.col(c) for c in plain],
        automated.alias("isAutomated"),
        (potential / 3600).alias("worker_potential_core_H"),
        core_h.alias("core_hours"),
        driver_units.alias("driver_units"),
        worker_units.alias("worker_units"),
        (driver_units + worker_units).alias("total_units"),
        driver_compute.alias("driver_compute_cost"),
        worker_compute.alias("worker_compute_cost"),
        driver_unit.alias("driver_unit_cost"),
        worker_unit.alias("worker_unit_cost"),
        (driver_compute + worker_compute).alias("total_compute_cost"),
        (driver_unit + worker_unit).alias("total_unit_cost"),
        (driver_unit + driver_compute).alias("total_driver_cost"),
        (worker_unit + worker_compute).alias("total_worker_cost"),
        (driver_compute + driver_unit + worker_compute + worker_unit).alias("total_cost"),
    ]

