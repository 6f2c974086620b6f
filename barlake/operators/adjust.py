"""Corporate actions: split and dividend adjustment at read time (JN-9, JN-10,
WN-5, CA-1..3).

Prices are stored raw. Adjustment turns the small corporate-action table into
per-symbol factor intervals ([valid_from, valid_to) with the cumulative factor
of all later actions) and joins bars to them on symbol with a range residual.
The planner broadcasts the interval table while it is small in bytes, so bars are
not shuffled; beyond that AQE splits a symbol that holds a third of all bars.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.operators.dedupe import KEEP_FIRST, keep_one
from barlake.operators.joins import asof_last, interval_join
from barlake.schemas import BAR_COLUMNS, DIVIDENDS_KEY, SPLITS_KEY

PRICE_COLUMNS = ["open", "high", "low", "close", "vwap"]


def factor_intervals(actions: DataFrame, date_col: str, factor_col: str) -> DataFrame:
    """Per symbol: [previous action date, this action date) -> product of the
    factors of this and all later actions (WN-5)."""
    per_day = actions.groupBy("symbol", F.col(date_col).alias("_d")).agg(F.product(factor_col).alias("_f"))
    later = Window.partitionBy("symbol").orderBy(F.col("_d").desc()) \
        .rowsBetween(Window.unboundedPreceding, 0)
    prev = Window.partitionBy("symbol").orderBy("_d")
    return per_day.select(
        "symbol",
        F.lag("_d").over(prev).alias("valid_from"),
        F.col("_d").alias("valid_to"),
        F.product("_f").over(later).alias("factor"),
    )


def split_intervals(splits: DataFrame) -> DataFrame:
    """Price factor split_from / split_to for bars dated before execution_date."""
    f = splits.select("symbol", "execution_date",
                      (F.col("split_from") / F.col("split_to")).alias("_pf"))
    return factor_intervals(f, "execution_date", "_pf")


def _apply(bars: DataFrame, intervals: DataFrame, name: str, volume_inverse: bool, day: Column | None = None) -> DataFrame:
    day = F.to_date("timestamp") if day is None else day
    j = interval_join(bars, intervals.withColumnRenamed("factor", name), ["symbol"], day)
    f = F.coalesce(F.col(name), F.lit(1.0))
    cols = {c: F.col(c) * f for c in PRICE_COLUMNS}
    if volume_inverse:
        cols["volume"] = F.col("volume") / f
    return j.withColumns(cols).withColumn(name, f).drop("valid_from", "valid_to")


def split_adjust(bars: DataFrame, splits: DataFrame, day: Column | None = None) -> DataFrame:
    """JN-9: prices x factor, volume / factor, for bars before each split. ``day``
    is the date a bar counts for (by default its UTC date; minute bars of an
    exchange pass the exchange's date)."""
    return _apply(bars, split_intervals(splits), "split_factor", True, day) \
        .select(*BAR_COLUMNS, "split_factor")


def dividend_factors(bars: DataFrame, dividends: DataFrame, ex_time: Column | None = None) -> DataFrame:
    """(symbol, ex_dividend_date, cash_amount, prev_close, factor): backward factor
    1 - cash / close of the last bar before the ex-date, null where there is no such
    close, or where the cash is not below it (no factor could keep prices positive).
    ``ex_time`` is the instant at which ``ex_dividend_date`` begins: UTC midnight by
    default; minute bars of an exchange pass the exchange's midnight."""
    start = F.col("ex_dividend_date").cast("timestamp") if ex_time is None else ex_time
    div = dividends.select("symbol", start.alias("_ex"), "ex_dividend_date", "cash_amount")
    closes = bars.select("symbol", "timestamp", "close")
    with_close = asof_last(div, closes.withColumnRenamed("timestamp", "_ex"), "symbol", "_ex", "close", "prev_close")
    factor = F.when((F.col("prev_close") > 0) & (F.col("cash_amount") < F.col("prev_close")),
                    1 - F.col("cash_amount") / F.col("prev_close"))
    return with_close.select("symbol", "ex_dividend_date", "cash_amount", "prev_close", factor.alias("factor"))


def dividend_intervals(bars: DataFrame, dividends: DataFrame, ex_time: Column | None = None) -> DataFrame:
    """Factor intervals of the dividends that have a factor (``dividend_factors``)."""
    f = dividend_factors(bars, dividends, ex_time).where(F.col("factor").isNotNull())
    return factor_intervals(f.select("symbol", "ex_dividend_date", F.col("factor").alias("_df")), "ex_dividend_date", "_df")


def skipped_dividends(bars: DataFrame, dividends: DataFrame, ex_time: Column | None = None) -> DataFrame:
    """Dividends that no adjusted read applies, with the reason."""
    f = dividend_factors(bars, dividends, ex_time)
    reason = F.when(F.col("prev_close").isNull(), F.lit("no bar before the ex-date")) \
        .when(F.col("prev_close") <= 0, F.lit("close before the ex-date is not positive")) \
        .when(F.col("cash_amount").isNull(), F.lit("no cash amount")).otherwise(F.lit("cash is not below the close before the ex-date"))
    return f.where(F.col("factor").isNull()).select("symbol", "ex_dividend_date", "cash_amount", "prev_close", reason.alias("reason"))


def dividend_adjust(bars: DataFrame, dividends: DataFrame, splits: DataFrame | None = None,
                    day: Column | None = None) -> DataFrame:
    """JN-10: dividend factors (from raw closes) on top of split adjustment."""
    intervals = dividend_intervals(bars, dividends)
    base = split_adjust(bars, splits, day) if splits is not None else bars.withColumn("split_factor", F.lit(1.0))
    return apply_dividends(base, intervals, day)


def apply_dividends(bars: DataFrame, intervals: DataFrame, day: Column | None = None) -> DataFrame:
    """Prices x dividend factor, for bars that carry their split factor."""
    out = _apply(bars, intervals, "dividend_factor", False, day)
    return out.select(*BAR_COLUMNS, "split_factor", "dividend_factor")


def merge_splits(stored: DataFrame, new: DataFrame) -> DataFrame:
    """CA-1: append, de-duplicated on (symbol, execution_date); stored wins."""
    both = stored.withColumn("_gen", F.lit(0)).unionByName(new.withColumn("_gen", F.lit(1)))
    rest = [c for c in stored.columns if c not in SPLITS_KEY]
    return keep_one(both, SPLITS_KEY, ["_gen", *rest], KEEP_FIRST).drop("_gen")


def merge_dividends(stored: DataFrame, new: DataFrame) -> DataFrame:
    """CA-2: append, de-duplicated on (symbol, ex-date, type, cash); stored wins."""
    both = stored.withColumn("_gen", F.lit(0)).unionByName(new.withColumn("_gen", F.lit(1)))
    rest = [c for c in stored.columns if c not in DIVIDENDS_KEY]
    return keep_one(both, DIVIDENDS_KEY, ["_gen", *rest], KEEP_FIRST).drop("_gen")
