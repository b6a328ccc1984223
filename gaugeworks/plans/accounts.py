"""Marts of the audit log without history: logins, account changes, notebooks, SQL history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.timeutil import day_of_ms
from gaugeworks.operators.dedup import latest_per_key
from gaugeworks.operators.fill import near_value
from gaugeworks.sources.tables import TENANT

ACCOUNT_ACTIONS = ["add", "addPrincipalToGroup", "removePrincipalFromGroup", "setAdmin", "updateUser", "delete"]
SERVICE_USER = "dbadmin"


def _param(df: DataFrame, name: str) -> Column:
    have = df.schema["requestParams"].dataType.fieldNames()
    return F.col(f"requestParams.{name}") if name in have else F.lit(None).cast("string")


def account_logins(audit: DataFrame) -> DataFrame:
    """Logins to the endpoints and by shell; the latter with their details.

    The details come from the login record itself, so no join is needed.
    """
    endpoint = (
        (F.col("serviceName") == "accounts")
        & F.lower("actionName").like("%login%")
        & (F.col("userIdentity.email") != SERVICE_USER)
    )
    shell = (F.col("serviceName") == "ssh") & (F.col("actionName") == "login")
    details = F.struct(
        _param(audit, "instanceId").alias("instance_id"),
        _param(audit, "port").alias("login_port"),
        F.col("sessionId").alias("session_id"),
        _param(audit, "publicKey").alias("login_public_key"),
        _param(audit, "containerId").alias("container_id"),
        _param(audit, "userName").alias("container_user_name"),
    )
    return audit.filter(endpoint | shell).select(
        "timestamp", TENANT, F.col("date").alias("login_date"), "serviceName",
        F.when(shell, F.lit("ssh")).otherwise(F.col("actionName")).alias("login_type"),
        _param(audit, "user").alias("login_user"),
        F.col("userIdentity.email").alias("user_email"),
        "sourceIPAddress", "userAgent", "requestId", "response",
        F.when(shell, details).alias("ssh_login_details"),
    )


def account_changes(audit: DataFrame) -> DataFrame:
    """Changes of users and groups; a missing user id comes from the user's next record."""
    raw = audit.filter((F.col("serviceName") == "accounts") & F.col("actionName").isin(ACCOUNT_ACTIONS)).select(
        "date", "timestamp", TENANT, "serviceName", "actionName",
        _param(audit, "endpoint").alias("endpoint"), "requestId",
        F.col("userIdentity.email").alias("modified_by"),
        _param(audit, "targetUserName").alias("user_name"),
        _param(audit, "targetUserId").alias("user_id"),
        _param(audit, "targetGroupName").alias("group_name"),
        _param(audit, "targetGroupId").alias("group_id"),
        "sourceIPAddress", "userAgent", "response",
    )
    by = day_of_ms(F.col("timestamp"))
    found = near_value(
        raw, [TENANT, "user_name"], ["timestamp", "requestId"], {"__id": ("user_id", "first")}, by, within=None
    )
    return found.withColumn("user_id", F.coalesce("user_id", "__id")).drop("__id")


def notebooks(audit: DataFrame) -> DataFrame:
    df = audit.filter("serviceName = 'notebook'")
    name = F.coalesce(_param(df, "notebookName"), F.try_element_at(F.split(_param(df, "path"), "/"), F.lit(-1)))
    return df.select(
        "timestamp", "date", TENANT, "serviceName", "actionName", F.col("userIdentity.email").alias("userEmail"),
        "requestId", "response", _param(df, "notebookId").alias("notebookId"), name.alias("notebookName"),
        *[_param(df, c).alias(c) for c in ("path", "oldName", "oldPath", "newName", "newPath", "parentPath", "clusterId")],
    )


def sql_query_history(history: DataFrame) -> DataFrame:
    """The metrics of a query as columns."""
    return history.select("*", "metrics.*").drop("metrics")


def logins_with_user(logins: DataFrame, changes: DataFrame) -> DataFrame:
    """Logins with the user id of the newest account change of that name; no login is doubled."""
    users = changes.filter(F.col("user_name").isNotNull() & F.col("user_id").isNotNull())
    newest = latest_per_key(users, [TENANT, "user_name"], "timestamp", ["requestId"])
    lookup = newest.select(TENANT, F.col("user_name").alias("login_user"), "user_id")
    return logins.join(lookup, [TENANT, "login_user"], "left")
