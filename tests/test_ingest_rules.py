"""Rules of the ingest core on data that is not whole days or minutes."""

import gzip
import json
import os
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from barlake.functions.time import from_epoch_ns
from barlake.operators import calendar as C
from barlake.operators import universe as U
from barlake.operators import validation as V
from barlake.plans import backfill, reference, report, store
from barlake.schemas import BARS, CELLS
from barlake.sources.landing import read_flat_files
from barlake.streaming import update
from tests.test_store import _run, _universe


def land(path, symbol, name, records):
    folder = os.path.join(path, f"symbol={symbol}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"{name}.json"), "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in records)


def bar(at, volume):
    return {"o": 1.0, "h": 2.0, "l": 0.5, "c": 1.5, "v": volume, "vw": 1.2, "n": 5,
            "t": int(at.replace(tzinfo=timezone.utc).timestamp() * 1000)}


def test_update_never_stores_a_day_that_is_not_complete(spark, scratch):
    root, landing, ckpt = f"{scratch}/lake", f"{scratch}/landing", f"{scratch}/ckpt"
    kw = dict(asset_class="crypto", timeframe="daily")
    land(landing, "X:BTCUSD", "a", [bar(datetime(2024, 1, 1), 1.0), bar(datetime(2024, 1, 2), 10.0)])
    update.run_update(spark, landing, root, ckpt, now="2024-01-02 15:00:00", **kw)
    assert [r["volume"] for r in store.read_bars(spark, root).collect()] == [1.0]
    assert str(store.read_manifest(spark, root).first()["last_complete_date"]) == "2024-01-01"
    land(landing, "X:BTCUSD", "b", [bar(datetime(2024, 1, 2), 99.0)])
    update.run_update(spark, landing, root, ckpt, now="2024-01-03 01:00:00", **kw)
    assert [r["volume"] for r in store.read_bars(spark, root).orderBy("timestamp").collect()] == [1.0, 99.0]
    assert update.run_update(spark, landing, root, ckpt, now="2024-01-03 02:00:00", **kw) == 0
    log = spark.read.parquet(store.table_path(root, "run_log")).orderBy("started_at").collect()
    assert [(r["command"], r["bars_written"]) for r in log] == [("update", 1), ("update", 1)]
    assert update.update_all(spark, f"{scratch}/none", root, ckpt, now="2024-01-03 02:00:00") == {}


def test_evening_bar_of_a_stock_counts_for_its_exchange_day(spark, scratch):
    root, landing = f"{scratch}/lake", f"{scratch}/landing"
    # 15:00 and 19:30 in New York on 5 January; 04:00 on the 6th.
    land(landing, "AAPL", "a", [bar(datetime(2024, 1, 5, 20, 0), 1.0), bar(datetime(2024, 1, 6, 0, 30), 2.0),
                                bar(datetime(2024, 1, 6, 9, 0), 3.0)])
    out = _run(spark, root, landing, ["AAPL"], timeframe="minute", start="2024-01-05", end="2024-01-05", run_id="r",
               asset="stocks")
    assert out.bars_written == 2
    assert sorted(r["volume"] for r in store.read_bars(spark, root).collect()) == [1.0, 2.0]
    state = store.read_manifest(spark, root).first()
    assert (str(state["earliest_date"]), str(state["last_complete_date"]), state["bar_count"]) == ("2024-01-05", "2024-01-05", 2)


def test_state_reads_touched_years_only(spark, scratch):
    root, landing = f"{scratch}/lake", f"{scratch}/landing"
    land(landing, "X:B", "a", [bar(datetime(y, 6, 1), float(y)) for y in (2021, 2022, 2023)])
    _run(spark, root, landing, ["X:B"], timeframe="daily", start="2021-01-01", end="2023-12-31", run_id="a")
    # History that vanished is not read again: its years keep their state.
    assert store.drop_partition(spark, root, "crypto", "daily", 2021)
    land(landing, "X:B", "b", [bar(datetime(2024, 6, 1), 1.0)])
    _run(spark, root, landing, ["X:B"], timeframe="daily", start="2021-01-01", end="2024-12-31", run_id="b")
    state = store.read_manifest(spark, root).first()
    assert (str(state["earliest_date"]), str(state["last_complete_date"]), state["bar_count"]) == ("2021-06-01", "2024-06-01", 4)
    store.record_state(spark, root, _universe(spark, "X:B"), "crypto", "daily", "2025-01-01 00:00:00", years=[2021])
    assert store.read_manifest(spark, root).first()["bar_count"] == 3


@pytest.mark.parametrize("error,aborts", [
    ({"error": "Authentication failed: invalid API key"}, True),
    ({"error": "HTTP 401"}, True),
    ({"error": "no data", "error_kind": "auth"}, True),
    ({"error": "ticker delisted, see issuing authority"}, False),
    ({"error": "unauthorised use of auth is discussed", "error_kind": "other"}, False),
])
def test_authentication_errors_abort(spark, scratch, error, aborts):
    root, landing = f"{scratch}/lake", f"{scratch}/landing"
    land(landing, "A", "a", [bar(datetime(2020, 1, 2), 1.0)])
    land(landing, "B", "b", [error])

    def run():
        return _run(spark, root, landing, ["A", "B"], timeframe="daily", start="2020-01-02", end="2020-01-06", run_id="r",
                    asset="stocks")

    if aborts:
        with pytest.raises(backfill.FatalFetchError):
            run()
    else:
        assert run().exit_code == 1
    row = spark.read.parquet(store.table_path(root, "run_log")).first()
    assert (row["status"], row["bars_written"]) == (("aborted", 0) if aborts else ("partial", 1))
    assert row["finished_at"] > row["started_at"] and bool(row["error_message"])
    assert store.read_bars(spark, root).count() == (0 if aborts else 1)


def test_record_without_time_is_an_error(spark, scratch):
    land(f"{scratch}/landing", "A", "a", [{"o": 1.0, "c": 1.0}])
    out = _run(spark, f"{scratch}/lake", f"{scratch}/landing", ["A"], timeframe="daily", start="2020-01-02",
               end="2020-01-06", run_id="r")
    assert (out.errors, out.zero_bar) == (1, 0)


def test_ohlc_policy_and_head_extension(spark, scratch):
    root, landing = f"{scratch}/lake", f"{scratch}/landing"
    bad = {**bar(datetime(2020, 1, 3), 5.0), "l": None}
    land(landing, "X:A", "a", [bar(datetime(2020, 1, 2), 1.0), bad])
    kw = dict(asset_class="crypto", timeframe="daily", target_end="2020-01-03", now="2020-01-04 00:00:00")
    got = backfill.run(spark, root, _universe(spark, "X:A"), landing, default_start="2020-01-02", run_id="a", ohlc="drop", **kw)
    assert got.bars_written == 1
    land(landing, "X:A", "b", [bar(datetime(2020, 1, 1), 2.0)])
    got = backfill.run(spark, root, _universe(spark, "X:A"), landing, default_start="2020-01-01", run_id="b", extend_head=True,
                       ohlc="drop", **kw)
    assert got.bars_written == 1 and str(store.read_manifest(spark, root).first()["earliest_date"]) == "2020-01-01"


def test_empty_lake(spark, scratch):
    assert [r["series"] for r in report.status(spark, f"{scratch}/none").collect() if "series" in r] in ([], [0])
    assert store.storage_usage(spark, f"{scratch}/none").collect() == []


def test_flat_files_of_two_column_orders(spark, scratch):
    folder = f"{scratch}/flat"
    os.makedirs(folder)
    with gzip.open(f"{folder}/a.csv.gz", "wt") as f:
        f.write("ticker,volume,open,close,high,low,window_start,transactions\nA,10,1,2,3,0.5,1704067200123456789,7\n")
    with gzip.open(f"{folder}/b.csv.gz", "wt") as f:
        f.write('window_start,ticker,low,high,open,close,volume\n1704153600000000000,"B",5,9,6,8,20\n')
    got = {r["ticker"]: r.asDict() for r in read_flat_files(spark, folder).collect()}
    assert (got["A"]["open"], got["A"]["high"], got["A"]["low"], got["A"]["transactions"]) == (1.0, 3.0, 0.5, 7)
    assert (got["B"]["open"], got["B"]["high"], got["B"]["low"], got["B"]["transactions"]) == (6.0, 9.0, 5.0, None)


def test_ns_epoch_is_exact(spark):
    base = 1704067200_000
    df = spark.range(5000).select((F.lit(base) + F.col("id")).alias("ms"))
    off = df.where(F.unix_micros(from_epoch_ns(F.col("ms") * 1000000 + 999)) != F.col("ms") * 1000)
    assert off.count() == 0
    assert spark.range(1).select(F.unix_micros(from_epoch_ns(F.lit(-1))).alias("x")).first()["x"] == -1


def bars(spark, rows):
    return spark.createDataFrame([(t, s, o, h, lo, c, 1.0, None, 1, None) for t, s, o, h, lo, c in rows], BARS)


def test_null_prices_are_reported_and_dropped(spark):
    t = datetime(2024, 1, 1)
    df = bars(spark, [(t, "A", 1.0, 2.0, 0.5, 1.5), (t, "B", None, 2.0, 0.5, 1.5), (t, "C", 3.0, 2.0, 0.5, 1.5)])
    assert {r["symbol"]: r["rule"] for r in V.ohlc_violations(df).collect()} == {"B": "null price", "C": "open>high"}
    assert [r["symbol"] for r in V.apply_ohlc_policy(df, "drop").collect()] == ["A"]


def test_missing_minutes_of_absent_days_and_sessions(spark):
    rows = [(datetime(2024, 1, 1, 23, 58), "A", 1.0, 2.0, 0.5, 1.5), (datetime(2024, 1, 3, 0, 1), "A", 1.0, 2.0, 0.5, 1.5)]
    got = [r["missing_minute"] for r in V.missing_minutes(bars(spark, rows)).collect()]
    assert len(got) == 1 + 1440 + 1 and datetime(2024, 1, 2, 12, 0) in got and len(set(got)) == len(got)
    # Regular sessions, the second one closing early.
    sessions = spark.createDataFrame([(date(2024, 1, 1), datetime(2024, 1, 1, 23, 57), datetime(2024, 1, 1, 23, 59)),
                                      (date(2024, 1, 2), datetime(2024, 1, 2, 14, 30), datetime(2024, 1, 2, 14, 32))],
                                     "day date, first_minute timestamp, last_minute timestamp")
    got = sorted(r["missing_minute"] for r in V.missing_minutes(bars(spark, rows), sessions).collect())
    assert got == [datetime(2024, 1, 1, 23, 59), *[datetime(2024, 1, 2, 14, m) for m in (30, 31, 32)]]


def test_futures_calendar_leaves_out_us_holidays(spark):
    days = C.day_range(spark, "2024-01-01", "2024-01-16")
    got = {str(r["session_date"]) for r in C.sessions(days, calendar=C.US_WEEKDAYS).collect()}
    assert "2024-01-01" not in got and "2024-01-15" not in got and "2024-01-02" in got and len(got) == 10
    assert C.last_complete_day(spark, "2024-01-16", C.US_WEEKDAYS) == "2024-01-12"
    assert update.horizon(spark, "stocks", "2024-01-13 02:00:00") == "2024-01-11"  # still the 12th in New York
    assert update.horizon(spark, "crypto", "2024-01-13 02:00:00") == "2024-01-12"


def cells(spark, page, values, col="Symbol"):
    rows = [(page, 0, i, col, True, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, CELLS)


def test_universe_pages_must_all_give_tickers(spark, scratch):
    good = cells(spark, "p1", [f"A{i}" for i in range(60)])
    blank = cells(spark, "p2", ["nan"] * 60)
    frozen = spark.createDataFrame([("F", "frozen", datetime(2023, 1, 1))], "ticker string, source string, generated_at timestamp")
    kw = dict(now="2024-01-01 00:00:00", force=True, expected_pages=["p1", "p2"])
    for got in (good, good.unionByName(blank)):  # a page without cells, a page without tickers
        out = reference.update_universe(spark, f"{scratch}/lake", got, "Symbol", frozen, **kw)
        assert out.used_fallback and out.tickers == 1
    both = good.unionByName(cells(spark, "p2", [f"B{i}" for i in range(60)]))
    out = reference.update_universe(spark, f"{scratch}/lake", both, "Symbol", frozen, **kw)
    assert not out.used_fallback and out.tickers == 120
    assert reference.read_frozen(spark, f"{scratch}/lake").count() == 120
    # The list written on success is the fallback of a later run.
    out = reference.update_universe(spark, f"{scratch}/lake", good, "Symbol", None, **{**kw, "now": "2024-02-01 00:00:00"})
    assert out.tickers == 120 and str(out.generated_at).startswith("2024-01-01")


def test_freeze_chunks_follow_the_universe(spark):
    snap = spark.range(95).select(F.concat(F.lit("T"), "id").alias("ticker"), F.lit("s").alias("source"),
                                  F.lit("2024-01-01").cast("timestamp").alias("generated_at"))
    docs = U.freeze(snap, ["X"], chunk_size=10)
    assert docs.count() <= 10 and U.thaw(docs).count() == 95
