"""Every registered query with oracle SQL equals DuckDB on the smoke data
(the driver runs the same comparison at sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from smoke_data import SMOKE

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SMOKE)
    srows, scols = sdf.collect(), sdf.columns
    cur = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(scols) == sorted(ocols)
    si = sorted(range(len(scols)), key=lambda i: scols[i])
    oi = sorted(range(len(ocols)), key=lambda i: ocols[i])
    assert sorted(tuple(_norm(r[i]) for i in si) for r in srows) == \
        sorted(tuple(_norm(r[i]) for i in oi) for r in orows)
