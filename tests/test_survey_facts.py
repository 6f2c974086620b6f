"""Facts about the supplied tables at sf0.01 that the design survey measured
independently; the derivations here must reproduce them."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from barlake.sources import tables as T

SF01 = "/root/testdata/sf0.01"


def test_daily_crypto_bars_150(spark):
    assert E.queries()["ticks_to_daily_bars"](spark, SF01).count() == 150


def test_per_user_series_have_460_missing_days(spark):
    assert E.queries()["daily_gaps_24x7"](spark, SF01).count() == 460


def test_lineitem_has_11785_duplicated_line_keys(spark):
    assert E.queries()["duplicate_report"](spark, SF01).count() == 11785


def test_about_2_6_contracts_per_root_and_day(spark):
    t = T.futures_ticks(spark, SF01)
    per = t.groupBy("root", F.to_date("ts")).agg(F.countDistinct("symbol").alias("n"))
    avg = per.agg(F.avg("n")).first()[0]
    assert 2.4 < avg < 2.8
