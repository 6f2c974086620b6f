from datetime import date, datetime

from pyspark.sql import functions as F

from barlake.operators import adjust as A
from barlake.operators import universe as U
from barlake.schemas import BARS, SPLITS


def _cells(spark, values, col="Symbol", flat=True, table_no=0, page="P"):
    return spark.createDataFrame([(page, table_no, i, col, flat, v) for i, v in enumerate(values)],
                                 "page string, table_no int, row_no int, col_name string, is_flat boolean, "
                                 "value string")


def test_extraction_case(spark):
    cells = _cells(spark, ["AAPL", "brk-b", None, "NaN", "  msft "])
    sel = U.select_constituents(cells, "Symbol", min_rows=1)
    got = [r["ticker"] for r in U.extract_tickers(cells, sel, "Symbol").orderBy("row_no").collect()]
    assert got == ["AAPL", "BRK.B", "MSFT"]


def test_selection_by_signature(spark):
    nav = _cells(spark, ["x"] * 60, col="0", flat=False, table_no=0)
    small = _cells(spark, ["S1"] * 10, table_no=1)
    log = _cells(spark, ["S2"] * 100, flat=False, table_no=2)
    good = _cells(spark, [f"T{i}" for i in range(61)], table_no=3)
    later = _cells(spark, [f"U{i}" for i in range(70)], table_no=4)
    cells = nav.unionByName(small).unionByName(log).unionByName(good).unionByName(later)
    r = U.select_constituents(cells, "Symbol").first()
    assert (r["table_no"], r["n_rows"]) == (3, 61)
    assert U.select_constituents(cells, "Ticker").count() == 0


def test_union_of_two_indexes(spark):
    sp = [f"S{i}" for i in range(60)] + ["BRK.B"]
    nd = ["BF-B"] + [f"S{i}" for i in range(50, 60)] + [f"N{i}" for i in range(50)]
    a = U.extract_tickers(_cells(spark, sp), U.select_constituents(_cells(spark, sp), "Symbol"), "Symbol")
    b_cells = _cells(spark, nd, col="Ticker")
    b = U.extract_tickers(b_cells, U.select_constituents(b_cells, "Ticker"), "Ticker")
    union = a.select("ticker").union(b.select("ticker")).distinct()
    tickers = {r["ticker"] for r in union.collect()}
    assert len(tickers) == 112 and {"BRK.B", "BF.B"} <= tickers


def test_fallback_keeps_vintage_and_reads_stale(spark):
    frozen = spark.createDataFrame([("AAPL", "frozen", datetime(2024, 1, 2)), ("MSFT", "frozen", datetime(2024, 1, 2))],
                                   "ticker string, source string, generated_at timestamp")
    primary = frozen.limit(0).withColumn("source", F.lit("scrape"))
    failures = spark.createDataFrame([("P",)], "page string")
    chosen = U.with_fallback(primary, failures, frozen)
    rows = chosen.collect()
    assert {r["source"] for r in rows} == {"frozen"} and {r["generated_at"] for r in rows} == {datetime(2024, 1, 2)}
    fresh = U.universe_freshness(chosen, "2024-02-01 00:00:00", 7).first()
    assert fresh["age_days"] == 30 and fresh["flag"] == "STALE"
    ok = U.universe_freshness(chosen, "2024-01-05 00:00:00", 7).first()
    assert ok["flag"] == "OK"
    future = U.universe_freshness(chosen, "2023-12-01 00:00:00", 7).first()
    assert future["flag"] == "WARN"


def test_freeze_thaw_roundtrip(spark):
    snap = spark.createDataFrame([(f"T{i}", "scrape", datetime(2024, 1, 1)) for i in range(50)],
                                 "ticker string, source string, generated_at timestamp")
    doc = U.freeze(snap, ["SP500", "NDX"], 20)
    assert doc.count() <= 3
    assert sorted(U.thaw(doc).collect()) == sorted(snap.collect())


def test_four_to_one_split(spark):
    bars = spark.createDataFrame(
        [(datetime(2020, 8, 28), "AAPL", 500.0, 510.0, 490.0, 499.0, 100.0, 500.0, 1, None),
         (datetime(2020, 8, 31), "AAPL", 127.0, 130.0, 126.0, 129.0, 400.0, 128.0, 1, None)], BARS)
    splits = spark.createDataFrame([("AAPL", date(2020, 8, 31), 1.0, 4.0, 4.0)], SPLITS)
    out = {r["timestamp"].date().isoformat(): r for r in A.split_adjust(bars, splits).collect()}
    assert out["2020-08-28"]["close"] == 499.0 / 4 and out["2020-08-28"]["volume"] == 400.0
    assert out["2020-08-31"]["close"] == 129.0 and out["2020-08-31"]["split_factor"] == 1.0


def test_cumulative_factor_of_two_splits(spark):
    splits = spark.createDataFrame([("X", date(2020, 1, 10), 1.0, 2.0, 2.0), ("X", date(2020, 2, 10), 1.0, 4.0, 4.0)],
                                   SPLITS)
    iv = sorted((r["valid_to"].isoformat(), r["factor"]) for r in A.split_intervals(splits).collect())
    assert iv == [("2020-01-10", 0.125), ("2020-02-10", 0.25)]


def test_membership_half_open(spark):
    m = spark.createDataFrame([("I", "A", date(2020, 1, 1), date(2020, 6, 1)), ("I", "B", date(2020, 1, 1), None)],
                              "index string, ticker string, added_date date, removed_date date")
    assert {r["ticker"] for r in U.universe_at(m, "2020-06-01").collect()} == {"B"}
    assert {r["ticker"] for r in U.universe_at(m, "2020-05-31").collect()} == {"A", "B"}


def test_asof_last_near_and_far(spark):
    from barlake.operators.joins import asof_last
    vals = spark.createDataFrame([("A", datetime(2020, 1, 1), 1.0), ("A", datetime(2020, 3, 1), 2.0),
                                  ("A", datetime(2020, 3, 10), 3.0), ("B", datetime(2019, 6, 1), 9.0)],
                                 "k string, t timestamp, v double")
    marks = spark.createDataFrame([("A", datetime(2020, 3, 10)), ("A", datetime(2020, 2, 1)),
                                   ("B", datetime(2021, 1, 1)), ("C", datetime(2020, 1, 1))],
                                  "k string, t timestamp")
    got = {(r["k"], r["t"].date().isoformat()): r["prev"]
           for r in asof_last(marks, vals, "k", "t", "v", "prev").collect()}
    assert got == {("A", "2020-03-10"): 2.0, ("A", "2020-02-01"): 1.0, ("B", "2021-01-01"): 9.0,
                   ("C", "2020-01-01"): None}


def test_continuous_rolls_forward_only(spark):
    from barlake.operators import futures as FU
    contracts = spark.createDataFrame(
        [("ESH0", "ES", date(2020, 1, 1), date(2020, 1, 10)), ("ESM0", "ES", date(2020, 1, 1), date(2020, 1, 20))],
        "ticker string, product_code string, first_trade_date date, last_trade_date date")
    vol = {("ESH0", 2): 10.0, ("ESM0", 2): 5.0, ("ESH0", 3): 1.0, ("ESM0", 3): 50.0, ("ESH0", 4): 99.0,
           ("ESM0", 4): 1.0, ("ESM0", 12): 7.0}
    bars = spark.createDataFrame([(datetime(2020, 1, d), s, 1.0, 1.0, 1.0, 1.0, v, None, 1, None)
                                  for (s, d), v in vol.items()], BARS)
    cal = {(r["day"].day): r["contract"] for r in FU.continuous(bars, contracts, FU.CALENDAR).collect()}
    assert cal == {2: "ESH0", 3: "ESH0", 4: "ESH0", 12: "ESM0"}
    by_vol = {(r["day"].day): r["contract"] for r in FU.continuous(bars, contracts, FU.VOLUME).collect()}
    # Day 3 rolls to ESM0 on volume; day 4 stays on ESM0 although ESH0 leads again.
    assert by_vol == {2: "ESH0", 3: "ESM0", 4: "ESM0", 12: "ESM0"}


def test_interval_join_shuffle_path_matches_broadcast(spark):
    from barlake.operators.joins import interval_join
    bars = spark.createDataFrame([(datetime(2020, 1, d), "A", 1.0, 1.0, 1.0, 1.0, 1.0, None, 1, None)
                                  for d in range(1, 20)], BARS)
    iv = spark.createDataFrame([("A", None, date(2020, 1, 5), 0.25), ("A", date(2020, 1, 5), date(2020, 1, 10), 0.5)],
                               "symbol string, valid_from date, valid_to date, factor double")
    at = F.to_date("timestamp")
    small = sorted((r["timestamp"], r["factor"]) for r in interval_join(bars, iv, ["symbol"], at).collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = sorted((r["timestamp"], r["factor"]) for r in interval_join(bars, iv, ["symbol"], at).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert small == shuffled and len(small) == 19
    assert dict((t.day, f) for t, f in small)[4] == 0.25 and dict((t.day, f) for t, f in small)[12] is None
