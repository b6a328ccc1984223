"""Column expressions for paths, names, JSON text and hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cleanse_path(path: Column, default_scheme: str = "file") -> Column:
    """One slash between segments; a missing scheme gets the default one."""
    scheme = F.lower(F.regexp_extract(path, r"^([A-Za-z][-.+A-Za-z0-9]*):/", 1))
    all_single = F.regexp_replace(path, "/{2,}", "/")
    keep_authority = F.regexp_replace(path, "(?<=[^/:])/{2,}", "/")
    return (
        F.when(scheme == "", F.concat(F.lit(default_scheme + ":"), all_single))
        .when(scheme == default_scheme.lower(), all_single)
        .otherwise(keep_authority)
    )


def group_filename(filename: Column) -> Column:
    """Path prefixes down to the cluster, the host and the context folder."""
    parts = F.split(filename, "/")

    def prefix(n: int) -> Column:
        return F.array_join(F.slice(parts, 1, n), "/")

    return F.struct(
        filename.alias("filename"),
        prefix(3).alias("byCluster"),
        prefix(5).alias("byDriverHost"),
        prefix(6).alias("bySparkContext"),
    )


def path_part_from_end(filename: Column, n: int) -> Column:
    """The n-th path segment from the end; the file name itself is 1."""
    return F.try_element_at(F.split(filename, "/"), F.lit(-n))


def cleanse_description(text: Column) -> Column:
    """One line of text out of an HTML-broken description."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, "<br/>", " "), "\\n", " "))


def stream_details(text: Column) -> Column:
    """Stream id, run id and batch id of the words ``id = x runId = y batch = z``."""
    words = F.split(cleanse_description(text), " ")

    def after(*tokens: str) -> Column:
        found = F.coalesce(*[F.nullif(F.array_position(words, t), F.lit(0)) for t in tokens])
        # two words further on: the token is followed by an equals sign
        return F.get(words, (found + 1).cast("int"))

    return F.struct(
        after("id").alias("stream_id"),
        after("runId").alias("stream_run_id"),
        after("batchId", "batch").alias("stream_batch_id"),
    )


def job_id_of_group(group: Column) -> Column:
    """Job number in a job group text such as ``a_b_job-12-run-3``."""
    return F.nullif(F.regexp_extract(F.get(F.split(group, "_"), 2), r"job-(\d+)", 1), F.lit(""))


def run_id_of_group(group: Column) -> Column:
    """Run number in a job group text such as ``a_b_job-12-run-3``."""
    return F.nullif(F.regexp_extract(F.get(F.split(group, "_"), 2), r"-run-(\d+)", 1), F.lit(""))


def dotted_json_value(json: Column, key: str) -> Column:
    """Value of a JSON key that has dots in its name."""
    flat = F.regexp_replace(json, "\\.", "_")
    return F.get_json_object(flat, "$." + key.replace(".", "_"))


def row_hash(*columns: Column, payload: Column | None = None) -> Column:
    """64-bit hash of the key columns and, as JSON text, of a payload struct."""
    tail = [] if payload is None else [F.to_json(payload)]
    return F.xxhash64(*columns, *tail)
