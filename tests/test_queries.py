"""Every registered query against its SQL twin on the smallest tables.

The marts take longest; they run with GAUGEWORKS_ALL=1 or by check_oracle.py.
"""

import os

import pytest

from __spark_entry__ import entry, queries
from check_oracle import TABLES, table_of
from gaugeworks.queries import load_all
from gaugeworks.queries.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
MARTS = ("s_", "g_", "b_", "v_", "dq_07", "dq_08", "dq_09", "st_05", "agg_02_job")
load_all()
NAMES = [n for n in QUERIES if os.environ.get("GAUGEWORKS_ALL") or not n.startswith(MARTS)]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not there")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    got = table_of(df.columns, df.collect())
    cur = duck.execute(ORACLES[name])
    assert got == table_of([d[0] for d in cur.description], cur.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0
