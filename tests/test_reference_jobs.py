from datetime import datetime

import pytest

from barlake.plans import backfill
from barlake.plans import reference as R
from tests.test_store import _land, _universe

CELL_SCHEMA = "page string, table_no int, row_no int, col_name string, is_flat boolean, value string"


def _cells(spark, col="Symbol", n=60):
    return spark.createDataFrame([("P", 0, i, col, True, f"t{i}") for i in range(n)], CELL_SCHEMA)


def _frozen(spark):
    return spark.createDataFrame([("OLD1", "frozen", datetime(2024, 1, 2)), ("OLD2", "frozen", datetime(2024, 1, 2))],
                                 "ticker string, source string, generated_at timestamp")


def test_success_then_cache_then_force(spark, scratch):
    r1 = R.update_universe(spark, scratch, _cells(spark), "Symbol", _frozen(spark), now="2024-02-01 00:00:00")
    assert (r1.source, r1.tickers, r1.cached, r1.used_fallback) == ("scrape", 60, False, False)
    r2 = R.update_universe(spark, scratch, _cells(spark, n=70), "Symbol", _frozen(spark), now="2024-02-03 00:00:00")
    assert r2.cached and r2.tickers == 60
    r3 = R.update_universe(spark, scratch, _cells(spark, n=70), "Symbol", _frozen(spark), now="2024-02-03 00:00:00",
                           force=True)
    assert not r3.cached and r3.tickers == 70
    assert R.read_universe(spark, scratch).count() == 70


def test_fallback_keeps_vintage_and_reads_stale(spark, scratch):
    r = R.update_universe(spark, scratch, _cells(spark, col="Ticker"), "Symbol", _frozen(spark),
                          now="2024-02-01 00:00:00")
    assert r.used_fallback and r.source == "frozen" and r.generated_at == datetime(2024, 1, 2)
    # The stored vintage is 30 days old: the next refresh is not short-circuited.
    r2 = R.update_universe(spark, scratch, _cells(spark, col="Ticker"), "Symbol", _frozen(spark),
                           now="2024-02-01 00:00:00")
    assert not r2.cached


def test_no_frozen_list_raises(spark, scratch):
    with pytest.raises(R.UniverseUnavailable):
        R.update_universe(spark, scratch, _cells(spark, col="Ticker"), "Symbol", None, now="2024-02-01 00:00:00")


def test_explicit_symbols(spark):
    u = R.universe_from_symbols(spark, " aapl, msft,,AAPL ,brk.b", "stocks")
    assert [r["symbol"] for r in u.collect()] == ["AAPL", "MSFT", "BRK.B"]


def test_auth_error_aborts_before_any_write(spark, scratch):
    import json
    import os
    root, landing = f"{scratch}/lake", f"{scratch}/landing"
    _land(landing, "A", datetime(2020, 1, 2), 3, 86400)
    os.makedirs(f"{landing}/symbol=B")
    with open(f"{landing}/symbol=B/e.json", "w") as f:
        f.write(json.dumps({"error": "auth: invalid key"}) + "\n")
    with pytest.raises(backfill.FatalFetchError):
        backfill.run(spark, root, _universe(spark, "A", "B", asset="stocks"), landing, asset_class="stocks",
                     timeframe="daily", default_start="2020-01-02", target_end="2020-01-06", run_id="r",
                     now="2020-01-07 00:00:00")
    assert not os.path.exists(f"{root}/bars")


def test_dry_run_returns_plan(spark, scratch):
    plan = backfill.run(spark, scratch, _universe(spark, "A", asset="stocks"), f"{scratch}/none",
                        asset_class="stocks", timeframe="daily", default_start="2020-01-02",
                        target_end="2020-01-06", run_id="r", now="2020-01-07 00:00:00", dry_run=True)
    assert [(r["symbol"], str(r["from_date"])) for r in plan.collect()] == [("A", "2020-01-02")]


def test_nothing_landed_is_zero_bar(spark, scratch):
    out = backfill.run(spark, f"{scratch}/lake", _universe(spark, "A", "B", asset="stocks"), f"{scratch}/none",
                       asset_class="stocks", timeframe="daily", default_start="2020-01-02",
                       target_end="2020-01-06", run_id="r", now="2020-01-07 00:00:00")
    assert (out.attempted, out.zero_bar, out.exit_code, out.touched_partitions) == (2, 2, 0, 0)
