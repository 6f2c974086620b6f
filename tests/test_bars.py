from datetime import datetime

from pyspark.sql import functions as F

from barlake.operators import bars as B
from barlake.operators import normalize as N
from barlake.schemas import BARS, BAR_COLUMNS


def test_normalize_schema_order_and_types(spark):
    raw = spark.createDataFrame(
        [(305.61, 306.20, 305.43, 305.69, 25370.68, 305.79, 1779436800000, 2649, None)],
        "o double, h double, l double, c double, v double, vw double, t bigint, n int, otc boolean")
    out = N.normalize_raw(raw, "AAPL")
    assert out.columns == BAR_COLUMNS
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in BARS.fields]
    row = out.first()
    assert row["symbol"] == "AAPL" and row["open"] == 305.61 and row["transactions"] == 2649
    assert out.select(F.unix_millis("timestamp")).first()[0] == 1779436800000


def test_normalize_mixed_int_float_and_nulls(spark):
    # A round volume arrives as a JSON int, the next as a float; nulls stay null.
    rows = [{"t": 1514764800000, "o": 1, "h": 2, "l": 1, "c": 2, "v": 70295, "vw": None, "n": None},
            {"t": 1514851200000, "o": 1.5, "h": 2.5, "l": 1.0, "c": 2.0, "v": 70295.78, "vw": 1.2, "n": 5}]
    raw = spark.read.json(spark.sparkContext.parallelize([__import__("json").dumps(r) for r in rows]))
    out = N.normalize_raw(raw, "X:BTCUSD").orderBy("timestamp").collect()
    assert [r["volume"] for r in out] == [70295.0, 70295.78]
    assert out[0]["vwap"] is None and out[0]["transactions"] is None
    assert out[0]["otc"] is None


def test_normalize_empty_keeps_schema(spark):
    raw = spark.createDataFrame([], "o double, h double, l double, c double, v double, vw double, "
                                    "t bigint, n int, otc boolean")
    out = N.normalize_raw(raw, "AAPL")
    assert out.count() == 0 and out.columns == BAR_COLUMNS


def test_ticks_to_bars_open_close_by_total_order(spark):
    t = datetime(2024, 1, 1, 0, 0, 0)
    ticks = spark.createDataFrame(
        [("A", t, 2, 10.0, 1), ("A", t, 1, 11.0, 2), ("A", datetime(2024, 1, 1, 5), 3, 9.0, 3)],
        "symbol string, ts timestamp, seq long, price double, size long") \
        .withColumn("price", F.col("price").cast("decimal(18,2)"))
    bar = B.ticks_to_bars(ticks, 1, "day", order_cols=["seq"]).first()
    assert (bar["open"], bar["close"], bar["high"], bar["low"]) == (11.0, 9.0, 11.0, 9.0)
    assert bar["volume"] == 6.0 and bar["transactions"] == 3
    assert abs(bar["vwap"] - (10 + 22 + 27) / 6) < 1e-12


def test_resample_keeps_ohlc_and_weights_vwap(spark):
    rows = [(datetime(2024, 1, 1, 0, m), "A", 1.0 + m, 2.0 + m, 0.5, 1.5 + m, 10.0 + m, 1.2, 5, None)
            for m in range(4)]
    bars = spark.createDataFrame(rows, BARS)
    out = B.resample_bars(bars, 1, "hour").first()
    assert out["open"] == 1.0 and out["close"] == 4.5 and out["high"] == 5.0 and out["low"] == 0.5
    assert out["volume"] == 46.0 and out["transactions"] == 20
    assert abs(out["vwap"] - 1.2) < 1e-9


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_num = st.one_of(st.none(), st.integers(-10**6, 10**6), st.floats(-1e6, 1e6, allow_nan=False))


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(_num, _num, _num, _num, _num, st.integers(0, 2**40)), min_size=1, max_size=8))
def test_normalize_is_null_preserving(spark, rows):
    """Ints and floats become the same doubles; nulls stay nulls, never zero."""
    import json
    recs = [json.dumps({"o": o, "h": h, "l": lo, "c": c, "v": v, "t": t}) for o, h, lo, c, v, t in rows]
    raw = spark.read.schema("o double, h double, l double, c double, v double, t bigint") \
        .json(spark.sparkContext.parallelize(recs))
    out = N.normalize_raw(raw, "X").orderBy("timestamp").collect()
    got = [(r["open"], r["high"], r["low"], r["close"], r["volume"]) for r in out]
    want = [tuple(None if x is None else float(x) for x in r[:5]) for r in rows]
    key = lambda t: tuple((x is None, x or 0.0) for x in t)
    assert sorted(got, key=key) == sorted(want, key=key)


def _ticks(spark, rows):
    return spark.createDataFrame(rows, "symbol string, ts timestamp, a long, b long, price double, size long") \
        .withColumn("price", F.col("price").cast("decimal(18,2)"))


def test_order_key_takes_any_tie_breaker(spark):
    """Negative, wide and intraday keys: the order is that of (time, a, b)."""
    t = datetime(2024, 1, 1, 12, 30)
    rows = [("A", t, 7, 2, 10.0, 1), ("A", t, 7, -1, 11.0, 1), ("A", t, -3, 9, 12.0, 1), ("A", t, 2**62, 0, 13.0, 1)]
    bar = B.ticks_to_bars(_ticks(spark, rows), 1, "day", order_cols=["a", "b"]).first()
    assert (bar["open"], bar["close"]) == (12.0, 13.0)


def test_bar_steps_carry_across_empty_days(spark):
    from barlake.operators import validation as V
    ts = [datetime(2024, 1, 1, 23, 58), datetime(2024, 1, 1, 23, 59), datetime(2024, 1, 3, 0, 1),
          datetime(2024, 1, 3, 0, 2)]
    rows = [(t, "A", 1.0, 1.0, 1.0, 1.0, 1.0, None, 1, None) for t in ts]
    steps = {r["timestamp"]: r["step_seconds"] for r in V.bar_steps(spark.createDataFrame(rows, BARS)).collect()}
    assert steps[ts[0]] is None and steps[ts[1]] == 60
    assert steps[ts[2]] == 86400 + 120 and steps[ts[3]] == 60
