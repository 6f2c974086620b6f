import json
import os
from datetime import datetime

from barlake.plans import report
from tests.test_store import _land, _run


def test_status_and_validate_over_a_lake(spark, scratch):
    root, landing = f"{scratch}/lake", f"{scratch}/landing"
    # AAPL: sessions 2020-01-02, 03, 06, 07 but not the 6th -> one gap; one bad OHLC bar.
    d = f"{landing}/symbol=AAPL"
    os.makedirs(d)
    with open(f"{d}/a.json", "w") as f:
        for day, lo in ((2, 0.5), (3, 0.5), (7, 3.0)):
            t = int(datetime(2020, 1, day).timestamp() * 1000)
            f.write(json.dumps({"o": 1.0, "h": 2.0, "l": lo, "c": 1.5, "v": 10.0, "t": t, "n": 5}) + "\n")
    _land(landing, "MSFT", datetime(2020, 1, 2), 4, 86400)
    out = _run(spark, root, landing, ["AAPL", "MSFT"], timeframe="daily", start="2020-01-02", end="2020-01-07",
               run_id="r1", asset="stocks")
    assert out.succeeded == 2
    st = {(r["asset_class"], r["timeframe"]): r for r in report.status(spark, root).collect()}
    assert st[("stocks", "daily")]["symbols"] == 2 and st[("stocks", "daily")]["bars"] == 7
    assert st[(None, None)]["disk_bytes"] > 0
    f = {(r["symbol"], r["check"]) for r in report.findings(spark, root, as_of="2020-01-08").collect()}
    assert ("AAPL", "gap") in f and ("AAPL", "ohlc") in f
    # MSFT's last bar is Sunday 2020-01-05: three sessions behind 2020-01-08.
    assert ("MSFT", "coverage") in f and ("AAPL", "coverage") not in f
    v = report.validate(spark, root, as_of="2020-01-08", write=True).collect()[0]
    assert (v["symbols"], v["warnings"], v["gap"], v["ohlc"], v["coverage"]) == (2, 2, 1, 1, 1)


def test_reference_freshness_over_stored_tables(spark, scratch):
    from barlake.plans import store
    uni = spark.createDataFrame([("AAPL", "scrape", datetime(2024, 1, 30))],
                                "ticker string, source string, generated_at timestamp")
    store.write_version(uni, scratch, "universe")
    spl = spark.createDataFrame([("AAPL", datetime(2024, 1, 20))], "symbol string, refreshed_at timestamp")
    store.write_version(spl, scratch, "splits")
    got = {r["dataset"]: r["flag"] for r in report.reference_freshness(spark, scratch, as_of="2024-02-01 00:00:00")
           .collect()}
    assert got == {"stocks_universe": "OK", "splits": "STALE", "dividends": "MISSING",
                   "futures_contracts": "MISSING", "market_calendar": "MISSING"}
