from pyspark.sql import functions as F

from barlake.operators import calendar as C


def _cal(spark, start="2019-12-01", end="2025-01-31"):
    days = C.day_range(spark, start, end)
    sess = C.sessions(days)
    return days, sess, C.dense_calendar(days, sess)


def _count(sess, a, b):
    return sess.where(F.col("session_date").between(F.lit(a).cast("date"), F.lit(b).cast("date"))).count()


def test_session_counts(spark):
    _, sess, _ = _cal(spark)
    assert _count(sess, "2020-01-01", "2020-12-31") == 253
    assert _count(sess, "2024-01-02", "2024-01-05") == 4
    assert _count(sess, "2024-07-15", "2024-07-15") == 1
    assert _count(sess, "2024-01-06", "2024-01-07") == 0


def test_target_end_and_first_session(spark):
    days, sess, dense = _cal(spark)
    todays = spark.createDataFrame([(d,) for d in ["2024-01-08", "2024-01-10", "2024-01-09", "2024-01-16",
                                                   "2025-01-01"]], "today string") \
        .select(F.col("today").cast("date").alias("today"))
    got = {r["today"].isoformat(): r["target_end"].isoformat()
           for r in C.target_end(todays, "today", dense).collect()}
    assert got == {"2024-01-08": "2024-01-05", "2024-01-10": "2024-01-09", "2024-01-09": "2024-01-08",
                   "2024-01-16": "2024-01-12", "2025-01-01": "2024-12-31"}
    after = {r["day"].isoformat(): r["session_on_or_after"].isoformat() for r in dense.where(
        F.col("day").isin(F.lit("2020-01-01").cast("date"), F.lit("2021-01-01").cast("date"))).collect()}
    assert after == {"2020-01-01": "2020-01-02", "2021-01-01": "2021-01-04"}


def test_session_count_operator_matches_filter(spark):
    days, sess, dense = _cal(spark)
    ranges = spark.createDataFrame([("2020-01-01", "2020-12-31"), ("2024-01-06", "2024-01-07")],
                                   "a string, b string").select(F.col("a").cast("date").alias("a"),
                                                                F.col("b").cast("date").alias("b"))
    got = sorted(r["sessions"] for r in C.session_count(ranges, dense, sess, "a", "b").collect())
    assert got == [0, 253]


def test_good_friday_and_special_closure(spark):
    days = C.day_range(spark, "2001-09-01", "2001-09-30")
    hol = {r["holiday_date"].isoformat() for r in C.holidays(days).collect()}
    assert {"2001-09-03", "2001-09-11", "2001-09-14"} <= hol
    days = C.day_range(spark, "2024-03-01", "2024-03-31")
    assert "2024-03-29" in {r["holiday_date"].isoformat() for r in C.holidays(days).collect()}


def test_calendar_of_a_long_span(spark):
    far = spark.createDataFrame([("1700-01-01",), ("2100-01-01",)], "d string").select(F.col("d").cast("date").alias("d"))
    assert C.days_spanning(far, "d").count() == 146098
