"""Stored reference tables, adjusted reads, calendar bars, ISO stamps."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from barlake.functions.time import bar_start, format_iso, parse_iso
from barlake.operators import calendar as C
from barlake.plans import actions, report, store
from barlake.schemas import BARS


def lake(spark, root, rows, timeframe="daily"):
    df = spark.createDataFrame([(t, s, p, p, p, p, v, p, 1, None) for t, s, p, v in rows], BARS)
    store.merge_into_lake(store.with_layout(df, "stocks", timeframe), root)


def test_split_through_the_stored_path(spark, scratch):
    root = f"{scratch}/lake"
    lake(spark, root, [(datetime(2020, 8, 28), "AAPL", 500.0, 10.0), (datetime(2020, 8, 31), "AAPL", 125.0, 40.0)])
    new = spark.createDataFrame([("AAPL", date(2020, 8, 31), 1.0, 4.0, 4.0)],
                                "symbol string, execution_date date, split_from double, split_to double, ratio double")
    actions.refresh(spark, root, "splits", new, now="2024-01-10 00:00:00")
    actions.refresh(spark, root, "splits", new, now="2024-01-11 00:00:00")
    assert actions.read(spark, root, "splits").count() == 1
    got = actions.read_adjusted(spark, root, "stocks", "daily", "2020-08-01", "2020-09-30").orderBy("timestamp").collect()
    assert [(r["close"], r["volume"], r["split_factor"]) for r in got] == [(125.0, 40.0, 0.25), (125.0, 40.0, 1.0)]
    cash = spark.createDataFrame([("AAPL", date(2020, 8, 31), 5.0, "USD", "CD", 4, None, None, None)],
                                 "symbol string, ex_dividend_date date, cash_amount double, currency string, dividend_type string, "
                                 "frequency int, pay_date date, record_date date, declaration_date date")
    actions.refresh(spark, root, "dividends", cash, now="2024-01-11 00:00:00")
    got = actions.read_adjusted(spark, root, "stocks", "daily", "2020-08-28", "2020-08-28", dividends=True).first()
    assert got["close"] == pytest.approx(125.0 * 0.99) and got["dividend_factor"] == pytest.approx(0.99)


def test_minute_bars_adjust_by_the_exchange_date(spark, scratch):
    root = f"{scratch}/lake"
    # 19:30 in New York on 28 August is after midnight UTC; the split is on the 29th.
    lake(spark, root, [(datetime(2020, 8, 29, 0, 30), "X", 100.0, 1.0), (datetime(2020, 8, 29, 14, 0), "X", 50.0, 2.0)], "minute")
    new = spark.createDataFrame([("X", date(2020, 8, 29), 1.0, 2.0, 2.0)],
                                "symbol string, execution_date date, split_from double, split_to double, ratio double")
    actions.refresh(spark, root, "splits", new, now="2024-01-10 00:00:00")
    got = actions.read_adjusted(spark, root, "stocks", "minute", "2020-08-28", "2020-08-30").orderBy("timestamp").collect()
    assert [r["close"] for r in got] == [50.0, 50.0]


def test_freshness_of_all_stored_tables(spark, scratch):
    root, now = f"{scratch}/lake", "2024-01-10 00:00:00"
    flags = {r["dataset"]: r["flag"] for r in report.reference_freshness(spark, root, as_of=now).collect()}
    assert set(flags.values()) == {"MISSING"} and len(flags) == 5
    actions.refresh_calendar(spark, root, "2024-01-01", "2024-01-31", now=now)
    actions.refresh(spark, root, "splits", spark.createDataFrame(
        [("A", date(2020, 1, 1), 1.0, 2.0, 2.0)], "symbol string, execution_date date, split_from double, split_to double, ratio double"), now=now)
    actions.refresh(spark, root, "futures_contracts", spark.createDataFrame(
        [("ESH4", "ES", "E", "2024-03", date(2023, 1, 1), date(2024, 3, 15), "XCME", 0.25)],
        "ticker string, product_code string, name string, month string, first_trade_date date, last_trade_date date, "
        "exchange_mic string, tick_size double"), now=now)
    actions.refresh(spark, root, "membership", spark.createDataFrame(
        [("I", "A", date(2020, 1, 1), None)], "index string, ticker string, added_date date, removed_date date"), now=now)
    flags = {r["dataset"]: r["flag"] for r in report.reference_freshness(spark, root, as_of=now).collect()}
    assert [flags[k] for k in ("market_calendar", "splits", "futures_contracts")] == ["OK"] * 3
    assert actions.read(spark, root, "membership").count() == 1


def test_validate_reports_minute_gaps_and_stale_series(spark, scratch):
    root = f"{scratch}/lake"
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, m), "X:B", 1.0, 1.0, 1.0, 1.0, 1.0, None, 1, None) for m in (0, 1, 4)], BARS)
    store.merge_into_lake(store.with_layout(df, "crypto", "minute"), root)
    store.record_state(spark, root, df.select("symbol"), "crypto", "minute", "2024-01-02 00:00:00")
    found = {r["check"]: r["detail"] for r in report.findings(spark, root, as_of="2024-01-05").collect()}
    assert found == {"gap": "2 missing minutes", "coverage": "4 sessions behind"}


def test_validate_checks_minutes_of_sessions(spark, scratch):
    root = f"{scratch}/lake"
    # New York 2024-01-02 (Tuesday) 09:30 to 09:34 without 09:32, and one bar on the 4th.
    times = [datetime(2024, 1, 2, 14, 30 + m) for m in (0, 1, 3, 4)] + [datetime(2024, 1, 4, 14, 30)]
    df = spark.createDataFrame([(t, "AAPL", 1.0, 1.0, 1.0, 1.0, 1.0, None, 1, None) for t in times], BARS)
    store.merge_into_lake(store.with_layout(df, "stocks", "minute"), root)
    store.record_state(spark, root, df.select("symbol"), "stocks", "minute", "2024-01-05 00:00:00")
    rows = lambda **k: sorted((r["check"], str(r["day"]), r["detail"]) for r in
                              report.findings(spark, root, as_of="2024-01-04", **k).collect())
    assert rows() == [("gap not checked", "2024-01-02", "3 sessions without session minutes")]
    v = report.validate(spark, root, as_of="2024-01-04").first()
    assert (v["symbols"], v["healthy"], v["warnings"], v["gap"]) == (1, 0, 1, 0)
    sessions = C.build_calendar(C.day_range(spark, "2024-01-02", "2024-01-03"))[0]
    early = spark.createDataFrame([(date(2024, 1, 3), 13 * 60)], "day date, close_minute int")
    minutes = C.regular_minutes(sessions, early).withColumn("calendar", F.lit(C.NYSE))
    want = [("gap", "2024-01-02", "386 missing minutes"), ("gap", "2024-01-03", "210 missing minutes"),
            ("gap not checked", "2024-01-04", "1 sessions without session minutes")]
    assert rows(session_minutes=minutes) == want
    actions.refresh(spark, root, "session_minutes", minutes, now="2024-01-05 00:00:00")
    assert rows() == want


@pytest.mark.parametrize("multiplier,span,want", [
    (3, "month", "2024-04-01"), (2, "quarter", "2024-01-01"), (5, "year", "2020-01-01"), (1, "month", "2024-05-01"),
    (1, "week", "2024-05-13"), (2, "week", "2024-05-13"), (4, "week", "2024-04-29"),
])
def test_calendar_multipliers(spark, multiplier, span, want):
    at = spark.createDataFrame([(datetime(2024, 5, 15, 13, 1),)], "t timestamp")
    got = at.select(bar_start("t", multiplier, span).alias("b")).first()["b"]
    if span == "week" and multiplier > 1:  # weeks count from one fixed Monday
        assert got.weekday() == 0 and 0 <= (datetime(2024, 5, 15) - got).days < 7 * multiplier
    else:
        assert str(got.date()) == want


def test_iso_stamps_with_offsets(spark):
    rows = [("2024-01-01T10:00:00Z",), ("2024-01-01T10:00:00+02:00",), ("2024-01-01T10:00:00",), ("2024-01-01T10:00:00.250Z",), ("x",)]
    df = spark.createDataFrame(rows, "s string").select(format_iso(parse_iso(F.col("s"))).alias("t"))
    assert [r["t"] for r in df.collect()] == ["2024-01-01T10:00:00Z", "2024-01-01T08:00:00Z", "2024-01-01T10:00:00Z",
                                              "2024-01-01T10:00:00Z", None]
