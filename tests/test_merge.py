from datetime import datetime, timedelta

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barlake.operators import dedupe as D
from barlake.operators import state as S

DAY0 = datetime(2020, 1, 2)
SCHEMA = "timestamp timestamp, symbol string, volume double"


def _df(spark, rows):
    return spark.createDataFrame([(DAY0 + timedelta(days=d), "AAPL", v) for d, v in rows], SCHEMA)


def test_keep_first_stored_rows_win(spark):
    stored = _df(spark, [(0, 1.0), (1, 2.0)])
    new = _df(spark, [(2, 3.0), (1, 99.0)])
    try:
        for limit in ("10m", "-1"):   # the planner broadcasts, or shuffles
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            out = S.merge_append(stored, new).orderBy("timestamp")
            assert [r["volume"] for r in out.collect()] == [1.0, 2.0, 3.0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_keep_last_and_fail_policies(spark):
    df = _df(spark, [(0, 1.0), (0, 5.0), (1, 2.0)]).withColumn("arrival", F.monotonically_increasing_id())
    first = D.keep_one(df, ["symbol", "timestamp"], ["volume"], D.KEEP_FIRST).orderBy("timestamp").collect()
    last = D.keep_one(df, ["symbol", "timestamp"], ["volume"], D.KEEP_LAST).orderBy("timestamp").collect()
    assert [r["volume"] for r in first] == [1.0, 2.0]
    assert [r["volume"] for r in last] == [5.0, 2.0]
    try:
        D.keep_one(df, ["symbol", "timestamp"], ["volume"], D.FAIL)
        raise AssertionError("expected DuplicateKeyError")
    except D.DuplicateKeyError:
        pass


def test_five_plus_four_overlapping_days_is_eight(spark):
    stored = _df(spark, [(d, 10.0 + d) for d in range(5)])
    new = _df(spark, [(d, 10.0 + d) for d in range(4, 8)])
    assert S.merge_append(stored, new).count() == 8


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.floats(0, 100, allow_nan=False)), max_size=15),
       st.lists(st.tuples(st.integers(0, 20), st.floats(0, 100, allow_nan=False)), max_size=15))
def test_merge_is_idempotent_and_keeps_stored(spark, a, b):
    stored = D.keep_one(_df(spark, a), ["symbol", "timestamp"], ["volume"])
    new = _df(spark, b)
    once = S.merge_append(stored, new)
    twice = S.merge_append(once, new)
    key = lambda r: (r["timestamp"], r["volume"])
    assert sorted(once.collect(), key=key) == sorted(twice.collect(), key=key)
    stored_rows = {r["timestamp"]: r["volume"] for r in stored.collect()}
    for r in once.collect():
        if r["timestamp"] in stored_rows:
            assert r["volume"] == stored_rows[r["timestamp"]]


@settings(max_examples=5, deadline=None)
@given(st.sets(st.integers(0, 30), max_size=10), st.sets(st.integers(31, 60), max_size=10))
def test_disjoint_batches_commute(spark, a, b):
    empty = _df(spark, [])
    x = _df(spark, [(d, float(d)) for d in a])
    y = _df(spark, [(d, float(d)) for d in b])
    ab = S.merge_append(S.merge_append(empty, x), y).collect()
    ba = S.merge_append(S.merge_append(empty, y), x).collect()
    assert sorted(ab) == sorted(ba)
