from pyspark.sql import functions as F

from barlake.operators import planning as P

MANIFEST = ("asset_class string, symbol string, timeframe string, earliest_date date, "
            "last_complete_date date, last_updated_at timestamp, bar_count long")


def _disp(spark, rows):
    return spark.createDataFrame(rows, "symbol string, disposition string")


def test_exit_codes(spark):
    # 2 succeeded + 3 errors -> 1; all errors -> 2; only a zero-bar -> 0.
    d1 = _disp(spark, [("A", "succeeded"), ("B", "succeeded"), ("C", "error"), ("D", "error"), ("E", "error")])
    d2 = _disp(spark, [("C", "error"), ("D", "error"), ("E", "error")])
    d3 = _disp(spark, [("Z", "zero_bar")])
    assert P.run_outcome(d1).first()["exit_code"] == 1
    assert P.run_outcome(d2).first()["exit_code"] == 2
    assert P.run_outcome(d3).first()["exit_code"] == 0


def test_one_failure_plus_up_to_date_is_total_failure(spark):
    d = _disp(spark, [("C", "error")])
    up = spark.createDataFrame([("U1",), ("U2",)], "symbol string")
    row = P.run_outcome(d, up).first()
    assert row["exit_code"] == 2 and row["up_to_date"] == 2 and row["attempted"] == 1


def test_fetch_plan_branches(spark):
    uni = spark.createDataFrame([("crypto", "X:BTCUSD"), ("crypto", "X:ETHUSD"), ("stocks", "X:BTCUSD"),
                                 ("crypto", "X:SOLUSD")], "asset_class string, symbol string")
    man = spark.createDataFrame([], MANIFEST).unionByName(spark.sql(
        "SELECT 'crypto' asset_class, 'X:BTCUSD' symbol, 'daily' timeframe, DATE'2018-01-01' earliest_date, "
        "DATE'2018-01-03' last_complete_date, TIMESTAMP'2018-01-04 00:00:00' last_updated_at, 3L bar_count "
        "UNION ALL SELECT 'crypto', 'X:ETHUSD', 'daily', DATE'2018-01-01', DATE'2018-01-10', "
        "TIMESTAMP'2018-01-11 00:00:00', 10L"))
    plan = P.fetch_plan(uni, man, timeframe="daily", default_start="2018-01-01", target_end="2018-01-10")
    got = {(r["asset_class"], r["symbol"]): (r["action"], str(r["from_date"])) for r in plan.collect()}
    assert got[("crypto", "X:BTCUSD")] == ("fetch", "2018-01-04")
    assert got[("crypto", "X:ETHUSD")][0] == "up_to_date"
    # Same symbol in another asset class has no state: full window.
    assert got[("stocks", "X:BTCUSD")] == ("fetch", "2018-01-01")
    assert got[("crypto", "X:SOLUSD")] == ("fetch", "2018-01-01")


def test_inverted_window_is_dropped(spark):
    uni = spark.createDataFrame([("crypto", "X:BTCUSD")], "asset_class string, symbol string")
    man = spark.createDataFrame([], MANIFEST)
    plan = P.fetch_plan(uni, man, timeframe="daily", default_start="2020-01-05", target_end="2020-01-01")
    assert plan.count() == 0


def test_dispositions(spark):
    plan = spark.createDataFrame([("A", "fetch"), ("B", "fetch"), ("C", "fetch"), ("D", "up_to_date")],
                                 "symbol string, action string")
    landed = spark.createDataFrame([("A", None), ("A", None), ("B", "bad request")],
                                   "symbol string, _error string")
    got = {r["symbol"]: r["disposition"] for r in P.dispositions(plan, landed, error_col="_error").collect()}
    assert got == {"A": "succeeded", "B": "error", "C": "zero_bar"}
    assert [r["symbol"] for r in P.zero_bar_symbols(
        plan.withColumn("from_date", F.lit(None)).withColumn("to_date", F.lit(None)), landed).collect()] == ["C"]


def test_duplicate_universe_entries_planned_once(spark):
    uni = spark.createDataFrame([("stocks", "AAPL"), ("stocks", "AAPL")], "asset_class string, symbol string")
    man = spark.createDataFrame([], MANIFEST)
    plan = P.fetch_plan(uni, man, timeframe="daily", default_start="2020-01-01", target_end="2020-01-10")
    assert plan.count() == 1
