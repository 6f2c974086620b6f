"""Gap ranges, stored order, the change log, crossover rolls, dividends beyond the close."""

import random
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from barlake.operators import adjust as A
from barlake.operators import futures as FU
from barlake.operators import universe as U
from barlake.operators import validation as V
from barlake.plans import actions, store
from barlake.schemas import BARS

T0 = datetime(2024, 1, 1)
MEMBERS = "index string, ticker string"
LOG = "index string, ticker string, date date, change string"


def bars(spark, rows):
    """Bars of (symbol, time, close)."""
    return spark.createDataFrame([(t, s, c, c, c, c, 10.0, c, 1, None) for s, t, c in rows], BARS)


def collapsed(minutes):
    """Missing minutes as ranges of neighbours."""
    out = []
    for m in sorted(minutes):
        if out and m - out[-1][1] == timedelta(minutes=1):
            out[-1][1] = m
        else:
            out.append([m, m])
    return [(a, b, int((b - a).total_seconds()) // 60 + 1) for a, b in out]


def test_ranges_are_the_expanded_minutes(spark):
    rnd = random.Random(4)
    rows = [(s, T0 + timedelta(minutes=m, seconds=rnd.choice([0, 30])), 1.0)
            for s in "AB" for m in sorted(rnd.sample(range(4_000), 900)) if not 1_000 < m < 2_600]
    rows += rows[:50]  # re-sent bars
    sessions = spark.createDataFrame(
        [(date(2024, 1, d), datetime(2024, 1, d, 9, 30), datetime(2024, 1, d, 12 if d == 2 else 16, 0)) for d in (1, 2, 3)]
        + [(date(2024, 1, 4), datetime(2024, 1, 3, 18, 0), datetime(2024, 1, 4, 1, 0))],  # begins on the eve
        "day date, first_minute timestamp, last_minute timestamp")
    df = bars(spark, rows)
    for expected in (None, sessions):
        want = {}
        for r in V.missing_minutes(df, expected).collect():
            want.setdefault(r["symbol"], []).append(r["missing_minute"])
        got = V.missing_minute_ranges(df, expected)
        assert sorted(map(tuple, got.collect())) == sorted((s, *x) for s, m in want.items() for x in collapsed(m))
        per_day = {}
        for s, m in want.items():
            for x in m:
                per_day[s, x.date()] = per_day.get((s, x.date()), 0) + 1
        assert {(r["symbol"], r["day"]): r["minutes"] for r in V.missing_minutes_by_day(got).collect()} == per_day
    plan = V.missing_minute_ranges(df, sessions)._jdf.queryExecution().optimizedPlan().toString()
    assert "INTERVAL '01' MINUTE)" not in plan.split("Generate")[0] and "sequence(_lo" not in plan


def test_reversed_rows_of_a_file_are_found(spark, scratch):
    rows = [("A", T0 + timedelta(days=i), 1.0) for i in range(5)] + [("B", T0 + timedelta(days=i), 1.0) for i in (2, 1, 0, 3, 3)]
    bars(spark, rows).coalesce(1).write.parquet(f"{scratch}/f1")
    got = {r["symbol"]: (r["rows"], r["violations"]) for r in V.stored_order_check(spark.read.parquet(f"{scratch}/f1")).collect()}
    assert got == {"A": (5, 0), "B": (5, 3)}
    root = f"{scratch}/lake"
    store.write_bars(store.with_layout(bars(spark, rows[:8]), "stocks", "daily"), root)  # the lake's own files are in order
    scan = spark.read.schema(BARS).parquet(store.bars_path(root))
    assert {r["violations"] for r in V.stored_order_check(scan).collect()} == {0}


def test_change_log_is_replayed_backwards(spark):
    log = spark.createDataFrame([
        ("I", "JOIN", date(2010, 1, 1), "added"), ("I", "LEFT", date(2011, 1, 1), "removed"),
        ("I", "BACK", date(2005, 1, 1), "added"), ("I", "BACK", date(2008, 1, 1), "removed"), ("I", "BACK", date(2012, 1, 1), "added"),
        ("I", "SWAP", date(2013, 1, 1), "removed"), ("I", "SWAP", date(2013, 1, 1), "added"),
        ("I", "GONE", date(2014, 1, 1), "added"), ("I", "HERE", date(2015, 1, 1), "removed"),
        ("I", "TWICE", date(2001, 1, 1), "added"), ("I", "TWICE", date(2003, 1, 1), "added"),
        ("J", "JOIN", date(2016, 1, 1), "added"), ("I", "JOIN", date(2010, 1, 1), "added")], LOG)
    now = spark.createDataFrame([("I", t) for t in ("JOIN", "BACK", "SWAP", "HERE", "TWICE", "ALWAYS")] + [("J", "JOIN")], MEMBERS)
    start = date(1900, 1, 1)
    got = {tuple(r) for r in U.membership_from_changes(now, log).collect()}
    assert got == {
        ("I", "JOIN", date(2010, 1, 1), None), ("J", "JOIN", date(2016, 1, 1), None), ("I", "LEFT", start, date(2011, 1, 1)),
        ("I", "BACK", date(2005, 1, 1), date(2008, 1, 1)), ("I", "BACK", date(2012, 1, 1), None),
        ("I", "SWAP", start, date(2013, 1, 1)), ("I", "SWAP", date(2013, 1, 1), None), ("I", "HERE", start, date(2015, 1, 1)),
        ("I", "HERE", date(2015, 1, 1), None), ("I", "TWICE", date(2003, 1, 1), None), ("I", "ALWAYS", start, None)}
    bad = {(r["ticker"], str(r["date"]), r["reason"]) for r in U.change_contradictions(now, log).collect()}
    assert bad == {("GONE", "2014-01-01", "added, but no member today"), ("HERE", "2015-01-01", "removed, but a member today"),
                   ("TWICE", "2001-01-01", "added, but no member from 2003-01-01")}
    assert U.membership_from_changes(now.limit(0), log.limit(0)).collect() == []


def test_stored_membership_and_exchange_dates(spark, scratch):
    root = f"{scratch}/lake"
    log = spark.createDataFrame([("I", "A", date(2024, 1, 6), "removed")], LOG)
    assert actions.refresh_membership(spark, root, spark.createDataFrame([("I", "B")], MEMBERS), log, now="2024-02-01 00:00:00").count() == 0
    assert [r["ticker"] for r in actions.get_universe_at(spark, root, "I", "2024-01-05").orderBy("ticker").collect()] == ["A", "B"]
    assert [r["ticker"] for r in actions.get_universe_at(spark, root, "I", "2024-01-06").collect()] == ["B"]
    assert actions.get_universe_at(spark, root, "J", "2024-01-05").count() == 0
    evening = [("A", datetime(2024, 1, 6, 0, 30), 1.0), ("A", datetime(2024, 1, 6, 6, 0), 2.0)]  # 19:30 on the 5th in New York; 01:00 on the 6th
    store.write_bars(store.with_layout(bars(spark, evening), "stocks", "minute"), root)
    got = actions.read_member_bars(spark, root, "I", "stocks", "minute", "2024-01-01", "2024-01-31").collect()
    assert [r["close"] for r in got] == [1.0]


CONTRACTS = "ticker string, product_code string, last_trade_date date"


def test_sticky_roll_stays_on_ties(spark):
    contracts = spark.createDataFrame([("F1", "F", date(2024, 1, 6)), ("F2", "F", date(2024, 2, 6)), ("F3", "F", date(2024, 3, 6)),
                                       ("G1", "G", date(2024, 2, 1))], CONTRACTS)
    interest = {"F1": [9, 5, 5, 5, 5, 5, None, None, None], "F2": [1, 5, 5, 6, 2, 2, 2, 2, None], "F3": [1, 1, 5, 6, 2, 2, 2, 2, 1],
                "G1": [1] * 9}
    rows = [(s, T0 + timedelta(days=i), float(v)) for s, vs in interest.items() for i, v in enumerate(vs) if v is not None]
    values = bars(spark, rows).withColumn("oi", F.col("close"))
    got = {(r["root"], r["contract"], r["valid_from"].day, r["valid_to"] and r["valid_to"].day)
           for r in FU.sticky_rolls(values, contracts, "oi").collect()}
    # F2 overtakes on the 4th (F3 as much, but later); F3 only ties on the 5th to 8th, and wins when F2 is not quoted.
    assert got == {("F", "F1", 1, 4), ("F", "F2", 4, 9), ("F", "F3", 9, None), ("G", "G1", 1, None)}
    series = {(r["root"], r["day"].day): r["contract"] for r in FU.continuous_sticky(values, contracts, "oi").collect()}
    assert [series["F", i] for i in range(1, 10)] == ["F1"] * 3 + ["F2"] * 5 + ["F3"]


def test_expired_contract_gives_way_to_less_interest(spark):
    contracts = spark.createDataFrame([("F1", "F", date(2024, 1, 2)), ("F2", "F", date(2024, 2, 6))], CONTRACTS)
    rows = [("F1", T0, 9.0), ("F1", T0 + timedelta(1), 9.0), ("F1", T0 + timedelta(2), 9.0), ("F2", T0 + timedelta(2), 1.0)]
    got = [(r["contract"], r["valid_from"].day) for r in FU.sticky_rolls(bars(spark, rows), contracts, "close").orderBy("valid_from").collect()]
    assert got == [("F1", 1), ("F2", 3)]


def test_dividend_above_the_close_is_skipped_and_reported(spark):
    df = bars(spark, [("A", T0, 5.0), ("A", T0 + timedelta(1), 4.0), ("B", T0 + timedelta(1), 4.0), ("C", T0, 10.0), ("C", T0 + timedelta(1), 9.0)])
    div = spark.createDataFrame([("A", date(2024, 1, 2), 6.0), ("B", date(2024, 1, 2), 1.0), ("C", date(2024, 1, 2), 1.0)],
                                "symbol string, ex_dividend_date date, cash_amount double")
    got = {(r["symbol"], r["timestamp"].day): r["close"] for r in A.dividend_adjust(df, div).collect()}
    assert got == {("A", 1): 5.0, ("A", 2): 4.0, ("B", 2): 4.0, ("C", 1): 9.0, ("C", 2): 9.0}
    assert {(r["symbol"], r["reason"]) for r in A.skipped_dividends(df, div).collect()} == {
        ("A", "cash is not below the close before the ex-date"), ("B", "no bar before the ex-date")}


def test_the_close_before_the_exchange_day_of_minute_bars(spark, scratch):
    root = f"{scratch}/lake"
    # 15:00 and 19:30 New York on the 5th (close 10, then 20); the 6th is the ex-date.
    rows = [("A", datetime(2024, 1, 5, 20, 0), 10.0), ("A", datetime(2024, 1, 6, 0, 30), 20.0), ("A", datetime(2024, 1, 6, 15, 0), 18.0)]
    store.write_bars(store.with_layout(bars(spark, rows), "stocks", "minute"), root)
    div = spark.createDataFrame([("A", date(2024, 1, 6), 2.0, "USD", "CD", 1, None, None, None)],
                                "symbol string, ex_dividend_date date, cash_amount double, currency string, dividend_type string, "
                                "frequency int, pay_date date, record_date date, declaration_date date")
    actions.refresh(spark, root, "dividends", div, now="2024-02-01 00:00:00")
    got = actions.read_adjusted(spark, root, "stocks", "minute", "2024-01-05", "2024-01-07", dividends=True).orderBy("timestamp").collect()
    assert [r["dividend_factor"] for r in got] == [0.9, 0.9, 1.0]
