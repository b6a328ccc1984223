"""Session helpers: recommended settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the library is designed for. Adaptive execution sizes the shuffles
# and splits skewed join partitions, so no partition count is set by hand. Parts of
# files and shuffles are bounded lower than Spark does, since rows grow wide when they are
# sorted: a task's memory then stays as it is when tables grow.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.files.maxPartitionBytes": "16m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session."""
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, a session
    on one machine takes a folder of its own and remembers it; any other session
    gets an error, since its executors would not see each other's files.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="gaugeworks-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the scratch root; never reused between calls."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


# Removes the shuffle files of an execution at its end; else they stay until the driver collects its garbage.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_open = threading.local()


@contextmanager
def _clean_shuffles(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(CLEAN_SHUFFLES, "false")
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_SHUFFLES, before)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage, and survives the loss of executors because the files are
    in shared storage. The shuffle files of the write go with its end, as nothing
    reads them again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with _clean_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    for steps in getattr(_open, "steps", []):
        steps.append(path)
    return spark.read.schema(df.schema).parquet(path)


def settled(make: Callable[[], DataFrame], name: str = "stage") -> DataFrame:
    """Write the frame that ``make`` gives, and delete the steps written while it was made.

    No other frame that ``make`` builds on them may be used afterwards. Steps of other
    calls and threads stay, and all of them if the write fails.
    """
    steps: list[str] = []
    _open.steps = [*getattr(_open, "steps", []), steps]
    try:
        out = make()
        done = list(steps)
        result = materialize(out, name)
    finally:
        _open.steps = _open.steps[:-1]
    for path in done:
        _delete(result.sparkSession, path)
    return result


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
