"""The contract job, isolation of asset classes, and drift told by file footers."""

from datetime import date, datetime

import pytest

from barlake import session
from barlake.plans import actions, backfill, store
from barlake.schemas import FUTURES_CONTRACTS
from tests.test_ingest_rules import bar, land
from tests.test_intervals_rolls import bars
from tests.test_store import _run


def test_contract_windows_are_the_plan(spark, scratch):
    root, landing = f"{scratch}/lake", f"{scratch}/landing"
    kw = dict(timeframe="daily", start="2024-01-01", run_id="f", now="2024-02-01 00:00:00")
    with pytest.raises(backfill.MissingUniverseError):
        backfill.run_contracts(spark, root, landing, today="2024-01-10", **kw)
    rows = [(t, "F", t, "m", a, b, "X", 0.25, None) for t, a, b in (
        ("F1", date(2023, 12, 1), date(2024, 1, 4)), ("F2", date(2024, 1, 3), date(2024, 3, 1)), ("OLD", date(2023, 1, 1), date(2023, 12, 31)))]
    actions.refresh(spark, root, "futures_contracts", spark.createDataFrame(rows, FUTURES_CONTRACTS), now="2024-01-01 00:00:00")
    for symbol in ("F1", "F2", "OLD"):
        land(landing, symbol, "a", [bar(datetime(2023, 12, 29), 0.0), *[bar(datetime(2024, 1, d, 6), float(d)) for d in range(1, 9)]])
    plan = backfill.run_contracts(spark, root, landing, today="2024-01-06", dry_run=True, **kw)
    assert {(r["symbol"], str(r["from_date"]), str(r["to_date"])) for r in plan.collect()} == {
        ("F1", "2024-01-01", "2024-01-04"), ("F2", "2024-01-03", "2024-01-05")}
    for today, stored in (("2024-01-06", 4 + 3), ("2024-01-08", 4 + 5), ("2024-01-08", 9)):
        backfill.run_contracts(spark, root, landing, today=today, **kw)
        assert store.read_bars(spark, root).count() == stored  # F2's later bars waited


def test_a_failing_asset_class_does_not_stop_the_others(spark, scratch):
    root = f"{scratch}/lake"
    land(f"{scratch}/crypto", "A", "a", [{"error": "x", "error_kind": "auth"}])
    land(f"{scratch}/stocks", "A", "a", [bar(datetime(2024, 1, 2, 5), 1.0)])
    run = lambda asset: lambda: _run(spark, root, f"{scratch}/{asset}", ["A"], timeframe="daily", start="2024-01-02", end="2024-01-02",
                                     run_id=asset, asset=asset)
    with pytest.raises(backfill.BackfillError) as caught:
        backfill.run_isolated({"crypto": run("crypto"), "stocks": run("stocks")})
    assert list(caught.value.failed) == ["crypto"] and caught.value.done["stocks"].bars_written == 1
    log = {r["run_id"]: r["status"] for r in spark.read.parquet(store.table_path(root, "run_log")).collect()}
    assert log == {"crypto": "aborted", "stocks": "success"}


def test_odd_files_are_found_by_their_footers(spark, scratch):
    root = f"{scratch}/lake"
    df = bars(spark, [("A", datetime(2024, 1, 2), 1.0), ("A", datetime(2024, 1, 3), 2.0)])
    store.write_bars(store.with_layout(df, "stocks", "daily"), root, num_files=1)
    assert store.schema_drift(spark, root).collect() == []
    folder = f"{store.bars_path(root)}/asset_class=stocks/timeframe=daily/year=2023"
    odd = df.drop("otc").withColumnRenamed("vwap", "VWAP").withColumn("volume", df["volume"].cast("string")).coalesce(1)
    odd.write.parquet(folder)
    with open(f"{folder}/torn.parquet", "wb") as f:
        f.write(b"PAR1 and no more")
    got = {(r["year"], r["column"], r["found"], r["issue"].split(":")[0], r["rows"]) for r in store.schema_drift(spark, root).collect()}
    assert got == {(2023, "otc", None, "missing", 2), (2023, "vwap", None, "missing", 2), (2023, "VWAP", "double", "extra", 2),
                   (2023, "volume", "string", "type", 2), (2023, None, None, "unreadable", None)}
    assert store.schema_drift(spark, f"{scratch}/none").collect() == []


def test_files_of_a_year_are_written_without_a_sort(spark, scratch, monkeypatch):
    """One file per year as before, but no task sorts (and so holds) the rows of its years."""
    from pyspark.sql import functions as F

    from barlake.plans import catalog
    rows = spark.range(1000).select(F.timestamp_seconds(F.col("id") * 400_000).alias("timestamp"), F.lit("S").alias("symbol"),
                                    *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "close", "volume", "vwap")],
                                    F.lit(1).alias("transactions"), F.lit(None).cast("boolean").alias("otc"))
    monkeypatch.setattr(catalog, "stock_daily", lambda spark, d: rows)
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, name: f"{scratch}/{name}")
    plans = []
    monkeypatch.setattr(catalog, "open_files", lambda spark, n: plans.append(n) or session.open_files(spark, n))
    got = {(r["year"], r["column"]): r["rows"] for r in catalog.schema_drift(spark, None).collect()}
    years = {r["y"]: r["n"] for r in rows.groupBy(F.year("timestamp").alias("y")).agg(F.count("*").alias("n")).collect()}
    assert got == {(y, c): n for y, n in years.items() if y % 2 == 0 for c in ("volume", "vwap")}
    assert plans and max(plans) >= 1 and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
