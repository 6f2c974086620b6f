import json
import os
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from barlake.plans import backfill, store
from barlake.operators import validation as V


def _land(path, symbol, start, n, step_s):
    """Write wire records (o=1 h=2 l=0.5 c=1.5 vw=1.2 n=5, volume 10+i) as landed JSON lines."""
    d = os.path.join(path, f"symbol={symbol}")
    os.makedirs(d, exist_ok=True)
    t0 = int(start.replace(tzinfo=timezone.utc).timestamp() * 1000)
    with open(os.path.join(d, f"part-{t0}-{n}.json"), "w") as f:
        for i in range(n):
            f.write(json.dumps({"o": 1.0, "h": 2.0, "l": 0.5, "c": 1.5, "v": 10.0 + i, "vw": 1.2,
                                "t": t0 + i * step_s * 1000, "n": 5}) + "\n")


def _universe(spark, *symbols, asset="crypto"):
    return spark.createDataFrame([(asset, s) for s in symbols], "asset_class string, symbol string")


def _run(spark, root, landing, symbols, *, timeframe, start, end, run_id, asset="crypto"):
    return backfill.run(spark, root, _universe(spark, *symbols, asset=asset), landing, asset_class=asset,
                        timeframe=timeframe, default_start=start, target_end=end, run_id=run_id,
                        now="2025-01-02 00:00:00")


def test_year_boundary_split_and_state(spark, scratch):
    root, landing = f"{scratch}/lake", f"{scratch}/landing"
    _land(landing, "X:BTCUSD", datetime(2024, 12, 31, 23, 55), 10, 60)
    out = _run(spark, root, landing, ["X:BTCUSD"], timeframe="minute", start="2024-12-31", end="2025-01-01",
               run_id="r1")
    assert out.exit_code == 0 and out.succeeded == 1 and out.touched_partitions == 2
    years = {r["year"]: r["n"] for r in store.read_bars(spark, root, with_partitions=True)
             .groupBy("year").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert years == {2024: 5, 2025: 5}
    m = store.read_manifest(spark, root).first()
    assert (str(m["earliest_date"]), str(m["last_complete_date"]), m["bar_count"]) == \
        ("2024-12-31", "2025-01-01", 10)
    # Helper columns never leak into the stored rows.
    assert store.read_bars(spark, root).columns[:2] == ["timestamp", "symbol"]


def test_crash_between_write_and_record_heals_on_rerun(spark, scratch, monkeypatch):
    root, landing = f"{scratch}/lake", f"{scratch}/landing"
    _land(landing, "X:BTCUSD", datetime(2024, 3, 1), 100, 60)

    def boom(*a, **k):
        raise RuntimeError("crash after data commit")

    monkeypatch.setattr(store, "record_state", boom)
    try:
        _run(spark, root, landing, ["X:BTCUSD"], timeframe="minute", start="2024-03-01", end="2024-03-01",
             run_id="r1")
        raise AssertionError("expected the injected crash")
    except RuntimeError:
        pass
    monkeypatch.undo()
    assert store.read_manifest(spark, root).count() == 0
    _land(landing, "X:BTCUSD", datetime(2024, 3, 1), 180, 60)
    out = _run(spark, root, landing, ["X:BTCUSD"], timeframe="minute", start="2024-03-01", end="2024-03-01",
               run_id="r2")
    assert out.exit_code == 0
    bars = store.read_bars(spark, root)
    assert bars.count() == 180 and bars.select("timestamp").distinct().count() == 180
    steps = V.bar_steps(bars).where(F.col("prev_ts").isNotNull())
    assert {r["step_seconds"] for r in steps.select("step_seconds").distinct().collect()} == {60}
    assert store.read_manifest(spark, root).first()["bar_count"] == 180


def test_rerun_same_day_is_noop_and_daily_resume(spark, scratch):
    root, landing = f"{scratch}/lake", f"{scratch}/landing"
    _land(landing, "AAPL", datetime(2020, 1, 2), 5, 86400)
    o1 = _run(spark, root, landing, ["AAPL"], timeframe="daily", start="2020-01-02", end="2020-01-06",
              run_id="r1", asset="stocks")
    assert o1.succeeded == 1
    o2 = _run(spark, root, landing, ["AAPL"], timeframe="daily", start="2020-01-02", end="2020-01-06",
              run_id="r2", asset="stocks")
    assert o2.attempted == 0 and o2.up_to_date == 1 and o2.touched_partitions == 0
    # 5 stored + 4 re-sent overlapping days -> 8 days, stored rows untouched.
    _land(landing, "AAPL", datetime(2020, 1, 6), 4, 86400)
    o3 = _run(spark, root, landing, ["AAPL"], timeframe="daily", start="2020-01-02", end="2020-01-09",
              run_id="r3", asset="stocks")
    assert o3.succeeded == 1
    assert store.read_bars(spark, root).count() == 8
    assert store.read_manifest(spark, root).first()["last_complete_date"].isoformat() == "2020-01-09"
    assert spark.read.parquet(store.table_path(root, "run_log")).count() == 3


def test_errors_and_zero_bars(spark, scratch):
    root, landing = f"{scratch}/lake", f"{scratch}/landing"
    _land(landing, "A", datetime(2020, 1, 2), 3, 86400)
    os.makedirs(f"{landing}/symbol=B", exist_ok=True)
    with open(f"{landing}/symbol=B/err.json", "w") as f:
        f.write(json.dumps({"error": "bad request"}) + "\n")
    os.makedirs(f"{landing}/symbol=C", exist_ok=True)
    with open(f"{landing}/symbol=C/bad.json", "w") as f:
        f.write("{not json\n")
    out = _run(spark, root, landing, ["A", "B", "C", "D"], timeframe="daily", start="2020-01-02",
               end="2020-01-06", run_id="r1", asset="stocks")
    assert (out.succeeded, out.errors, out.zero_bar, out.exit_code) == (1, 2, 1, 1)
    assert store.read_manifest(spark, root).count() == 1


def test_empty_universe_raises(spark, scratch):
    try:
        backfill.plan(spark, scratch, _universe(spark), timeframe="daily", default_start="2020-01-01",
                      target_end="2020-01-02")
        raise AssertionError("expected MissingUniverseError")
    except backfill.MissingUniverseError:
        pass


def test_storage_usage(spark, scratch):
    root, landing = f"{scratch}/lake", f"{scratch}/landing"
    _land(landing, "X:BTCUSD", datetime(2024, 12, 31, 23, 55), 10, 60)
    _run(spark, root, landing, ["X:BTCUSD"], timeframe="minute", start="2024-12-31", end="2025-01-01",
         run_id="r1")
    u = store.storage_usage(spark, root).collect()
    assert len(u) == 2 and all(r["files"] >= 1 and r["bytes"] > 0 for r in u)




def test_landing_json_array_fixture(spark, scratch):
    """Five one-minute bars as one JSON array (multiLine), mixed int/float numbers,
    `otc` omitted; read via the landing source and normalised."""
    from barlake.operators import normalize as N
    from barlake.sources.landing import landed_bars, read_landing
    d = f"{scratch}/landing/symbol=AAPL"
    os.makedirs(d)
    t0 = 1779436800000
    recs = [{"o": 305.61 + i, "h": 306.2 + i, "l": 305 + i, "c": 305.69 + i, "v": 25370.68 if i else 25370,
             "vw": 305.79, "t": t0 + 60000 * i, "n": 2649} for i in range(5)]
    with open(f"{d}/bars.json", "w") as f:
        json.dump(recs, f)
    raw = read_landing(spark, f"{scratch}/landing", multi_line=True)
    bars = N.normalize_raw(landed_bars(raw)).orderBy("timestamp").collect()
    assert len(bars) == 5 and bars[0]["symbol"] == "AAPL" and bars[0]["volume"] == 25370.0
    assert bars[0]["otc"] is None and bars[1]["low"] == 306.0


def test_write_is_zstd_and_sorted(spark, scratch):
    from barlake.schemas import BARS
    rows = [(datetime(2024, 1, 1) + timedelta(minutes=m), s, 1.0, 2.0, 0.5, 1.5, 1.0, 1.2, 5, None)
            for m in range(30) for s in ("B", "A")]
    df = store.with_layout(spark.createDataFrame(rows[::-1], BARS), "crypto", "minute")
    store.write_bars(df, f"{scratch}/lake", num_files=1)
    files = [os.path.join(dp, f) for dp, _, fs in os.walk(f"{scratch}/lake") for f in fs if f.endswith(".parquet")]
    assert files and all(".zstd." in f for f in files)
    back = spark.read.parquet(files[0]).select("symbol", "timestamp").collect()
    assert back == sorted(back)


def test_flat_files_read_by_name(spark, scratch):
    """A gzip csv whose columns are in O,C,H,L order (and one extra column) is
    read by header name, not by position."""
    import gzip
    from barlake.operators import normalize as N
    from barlake.sources.landing import read_flat_files
    os.makedirs(f"{scratch}/flat")
    with gzip.open(f"{scratch}/flat/2024-01-02.csv.gz", "wt") as f:
        f.write("ticker,volume,open,close,high,low,window_start,transactions,extra\n")
        f.write("AAPL,100.5,10.0,11.0,12.0,9.0,1704153600000000000,7,x\n")
    bar = N.normalize_flat_file(read_flat_files(spark, f"{scratch}/flat")).first()
    assert (bar["open"], bar["high"], bar["low"], bar["close"]) == (10.0, 12.0, 9.0, 11.0)
    assert bar["timestamp"] == datetime(2024, 1, 2) and bar["transactions"] == 7 and bar["volume"] == 100.5


def test_window_read_point_lookup_and_drop(spark, scratch):
    root, landing = f"{scratch}/lake", f"{scratch}/landing"
    _land(landing, "X:BTCUSD", datetime(2024, 12, 31, 23, 55), 10, 60)
    _run(spark, root, landing, ["X:BTCUSD"], timeframe="minute", start="2024-12-31", end="2025-01-01",
         run_id="r1")
    assert store.read_window(spark, root, "crypto", "minute", "2025-01-01", "2025-01-01").count() == 5
    assert store.get_state(spark, root, "crypto", "X:BTCUSD", "minute")["bar_count"] == 10
    assert store.get_state(spark, root, "stocks", "X:BTCUSD", "minute") is None
    assert store.drop_partition(spark, root, "crypto", "minute", 2024)
    assert store.read_bars(spark, root).count() == 5


def test_stock_minute_state_uses_exchange_date(spark, scratch):
    # 2024-01-05 20:30 New York time is 2024-01-06 01:30 UTC: it belongs to the 5th.
    root, landing = f"{scratch}/lake", f"{scratch}/landing"
    _land(landing, "AAPL", datetime(2024, 1, 6, 1, 30), 2, 60)
    _run(spark, root, landing, ["AAPL"], timeframe="minute", start="2024-01-05", end="2024-01-06",
         run_id="r1", asset="stocks")
    m = store.get_state(spark, root, "stocks", "AAPL", "minute")
    assert str(m["last_complete_date"]) == "2024-01-05"


def test_import_per_symbol_ns_files(spark, scratch):
    """Per-symbol files with ns UTC timestamps and a dictionary symbol, in the
    daily-file and minute/year layouts, are imported and merged into the lake."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from barlake.sources.landing import read_per_symbol_files

    def table(sym, start, n, step_ns):
        ts = pa.array([start + i * step_ns for i in range(n)], pa.timestamp("ns", tz="UTC"))
        return pa.table({"timestamp": ts, "symbol": pa.array([sym] * n).dictionary_encode(),
                         "open": [1.0] * n, "high": [2.0] * n, "low": [0.5] * n, "close": [1.5] * n,
                         "volume": [10.0 + i for i in range(n)], "vwap": [1.2] * n,
                         "transactions": pa.array([5] * n, pa.int32()), "otc": pa.array([None] * n, pa.bool_())})

    base = f"{scratch}/ohlcv"
    os.makedirs(f"{base}/stocks/daily")
    os.makedirs(f"{base}/crypto/minute/BTC")
    day0 = 1577923200 * 10**9  # 2020-01-02
    pq.write_table(table("AAPL", day0, 3, 86400 * 10**9), f"{base}/stocks/daily/AAPL.parquet")
    pq.write_table(table("X:BTCUSD", 1735689300 * 10**9, 4, 60 * 10**9), f"{base}/crypto/minute/BTC/2024.parquet")
    bars = read_per_symbol_files(spark, base)
    got = {(r["asset_class"], r["timeframe"]): r["n"] for r in
           bars.groupBy("asset_class", "timeframe").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {("stocks", "daily"): 3, ("crypto", "minute"): 4}
    first = bars.where(F.col("symbol") == "AAPL").orderBy("timestamp").first()
    assert first["timestamp"] == datetime(2020, 1, 2)
    store.merge_into_lake(store.with_layout(bars), f"{scratch}/lake")
    assert store.read_bars(spark, f"{scratch}/lake").count() == 7


def test_increments_append_and_compact(spark, scratch):
    root, landing = f"{scratch}/lake", f"{scratch}/landing"
    _land(landing, "X:BTCUSD", datetime(2024, 3, 1), 50, 60)
    _run(spark, root, landing, ["X:BTCUSD"], timeframe="minute", start="2024-03-01", end="2024-03-01", run_id="r1")
    _land(landing, "X:BTCUSD", datetime(2024, 3, 2), 40, 60)           # the next day: appended files
    _run(spark, root, landing, ["X:BTCUSD"], timeframe="minute", start="2024-03-01", end="2024-03-02", run_id="r2")
    files = lambda: sorted(f for dp, _, fs in os.walk(f"{root}/bars") for f in fs if f.endswith(".parquet"))
    before = store.read_bars(spark, root).collect()
    assert len(before) == 90 and len(files()) >= 2
    store.compact(spark, root, "crypto", "minute")
    after = store.read_bars(spark, root).collect()
    assert sorted(after) == sorted(before)
    assert store.read_manifest(spark, root).first()["bar_count"] == 90


def test_prune_versions_keeps_newest(spark, scratch):
    from pyspark.sql import functions as F
    df = spark.range(3).select(F.col("id").alias("x"))
    for _ in range(4):
        store.write_version(df, scratch, "t")
    assert store.prune_versions(spark, scratch, "t", keep=2) == 2
    versions = sorted(int(r["version"]) for r in spark.read.parquet(f"{scratch}/t").select("version").distinct().collect())
    assert versions == [3, 4]
    assert store.write_version(df, scratch, "t") == 5


def test_versions_past_nine_order_numerically(spark, scratch):
    from pyspark.sql import functions as F
    df = spark.range(1).select(F.col("id").alias("x"))
    for i in range(11):
        assert store.write_version(df.withColumn("x", F.lit(i)), scratch, "t") == i + 1
    assert store.read_latest(spark, scratch, "t", df.schema).first()["x"] == 10


def test_empty_newest_version_and_crashed_write(spark, scratch):
    from pyspark.sql import functions as F
    df = spark.range(2).select(F.col("id").alias("x"))
    store.write_version(df, scratch, "f")
    store.write_version(df.limit(0), scratch, "f")          # a run with no findings
    assert store.read_latest(spark, scratch, "f", df.schema).count() == 0
    os.makedirs(f"{scratch}/f/version=3/_temporary")         # a crashed write: no _SUCCESS
    assert store.read_latest(spark, scratch, "f", df.schema).count() == 0
    assert store.write_version(df, scratch, "f") == 4
    assert store.read_latest(spark, scratch, "f", df.schema).count() == 2
