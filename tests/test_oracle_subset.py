"""The oracle gate inside pytest: a representative subset of the catalogue
must equal its independent DuckDB statement at sf0.001 (order-insensitive,
columns by name). The full comparison is tools/check_oracle.py."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF

SUBSET = ["ticks_to_daily_bars", "resample_weekly_bars", "merge_append_bars", "session_calendar",
          "daily_gaps_sessions", "split_adjusted_bars", "universe_with_fallback", "continuous_volume",
          "validation_report", "run_outcome"]
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SUBSET)
def test_query_equals_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(srows, df.columns) == _rows(drows, dcols)
