from datetime import datetime

from barlake.plans import store
from barlake.streaming import update as U
from tests.test_store import _land


def test_available_now_update_twice_is_noop(spark, scratch):
    root, landing, ckpt = f"{scratch}/lake", f"{scratch}/landing", f"{scratch}/ckpt"
    _land(landing, "X:BTCUSD", datetime(2018, 1, 1), 3, 86400)
    n1 = U.run_update(spark, landing, root, ckpt, asset_class="crypto", timeframe="daily",
                      now="2018-01-04 00:00:00")
    assert n1 >= 1
    first = sorted(store.read_bars(spark, root).collect())
    m = store.read_manifest(spark, root).first()
    assert (m["symbol"], str(m["earliest_date"]), str(m["last_complete_date"]), m["bar_count"]) == \
        ("X:BTCUSD", "2018-01-01", "2018-01-03", 3)
    n2 = U.run_update(spark, landing, root, ckpt, asset_class="crypto", timeframe="daily",
                      now="2018-01-04 01:00:00")
    assert n2 == 0
    assert sorted(store.read_bars(spark, root).collect()) == first
    # Overlap of 2 re-sent days + 3 new ones -> 3 new bars, stored rows unchanged.
    _land(landing, "X:BTCUSD", datetime(2018, 1, 2), 5, 86400)
    U.run_update(spark, landing, root, ckpt, asset_class="crypto", timeframe="daily",
                 now="2018-01-07 00:00:00")
    assert store.read_bars(spark, root).count() == 6
    assert store.read_manifest(spark, root).first()["bar_count"] == 6


def test_tumbling_bars_append_closed_windows(spark, scratch):
    schema = "symbol string, ts timestamp, seq long, price decimal(18,2), size long"
    from decimal import Decimal
    rows = [("A", datetime(2024, 1, 1, 0, 0, s), s, Decimal(10 + s), 1) for s in range(0, 50, 10)]
    rows += [("A", datetime(2024, 1, 1, 0, 0, 20), 20, Decimal(12), 1)]   # re-sent trade (same seq)
    rows += [("A", datetime(2024, 1, 1, 0, 30, 0), 99, Decimal(1), 1)]    # moves the watermark on
    spark.createDataFrame(rows, schema).write.parquet(f"{scratch}/ticks")
    U.run_tumbling_bars(spark, f"{scratch}/ticks", schema, f"{scratch}/bars", f"{scratch}/ck")
    U.run_tumbling_bars(spark, f"{scratch}/ticks", schema, f"{scratch}/bars", f"{scratch}/ck")
    out = spark.read.parquet(f"{scratch}/bars").orderBy("timestamp").collect()
    assert len(out) >= 1
    b = out[0]
    assert (b["open"], b["close"], b["high"], b["low"], b["transactions"]) == (10.0, 50.0, 50.0, 10.0, 5)
