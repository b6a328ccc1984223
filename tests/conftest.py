import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from gaugeworks.session import configure

    session = (
        SparkSession.builder.master("local[8]")
        .appName("gaugeworks-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return configure(session)


def rows(df, *order):
    """Collected rows as tuples, sorted."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((v is not None, str(type(v)), v) if not isinstance(v, (list, dict)) else (True, "", str(v)) for v in r))
