"""Bar construction (AG-8) and re-sampling (AG-9).

Both are one hash aggregation keyed by (symbol, bar start). Every aggregate is
declarative (``min_by``/``max_by``/``sum``/``min``/``max``/``count``), so Spark
combines map-side before the shuffle: a symbol holding a third of all ticks
still ships one partial row per (map task, bar), and the final stage spreads a
hot symbol over its many bars.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.functions.time import bar_start
from barlake.schemas import BAR_COLUMNS

TURNOVER_DECIMAL = "decimal(38,4)"


def order_key(ts: str, order_cols: Sequence[str]) -> Column:
    """Total order of trades: time, then the tie-breakers, of any type and width."""
    return F.struct(F.col(ts), *[F.col(c) for c in order_cols])


def ticks_to_bars(ticks: DataFrame, multiplier: int = 1, timespan: str = "day", *,
                  ts: str = "ts", price: str = "price", size: str = "size",
                  order_cols: Sequence[str] = (), symbol: str = "symbol") -> DataFrame:
    """OHLCV bars from trades.

    open/close are the prices of the first/last trade by (ts, *order_cols), which
    must be a total order within a bar for a repeatable pick. ``price``/``size``
    should be exact (decimal or integer): turnover and volume are summed exactly
    and converted once, so the result does not depend on summation order.
    vwap = turnover / volume; transactions = trade count. otc is unknown (null).
    """
    # The ordering key is computed once, in a projection before the aggregate.
    t = ticks.withColumn("_ord", order_key(ts, order_cols))
    key = F.col("_ord")
    p = F.col(price)
    s = F.col(size)
    bars = (
        t.groupBy(F.col(symbol).alias("symbol"),
                  bar_start(F.col(ts), multiplier, timespan).alias("timestamp"))
        .agg(
            F.min_by(p, key).alias("_open"),
            F.max(p).alias("_high"),
            F.min(p).alias("_low"),
            F.max_by(p, key).alias("_close"),
            F.sum(s).alias("_volume"),
            F.sum(p * s).alias("_turnover"),
            F.count(F.lit(1)).alias("_n"),
        )
    )
    return bars.select(
        F.col("timestamp"),
        F.col("symbol"),
        F.col("_open").cast("double").alias("open"),
        F.col("_high").cast("double").alias("high"),
        F.col("_low").cast("double").alias("low"),
        F.col("_close").cast("double").alias("close"),
        F.col("_volume").cast("double").alias("volume"),
        F.when(F.col("_volume") != 0,
               F.col("_turnover").cast("double") / F.col("_volume").cast("double")).alias("vwap"),
        F.col("_n").cast("int").alias("transactions"),
        F.lit(None).cast("boolean").alias("otc"),
    )


def resample_bars(bars: DataFrame, multiplier: int = 1, timespan: str = "hour") -> DataFrame:
    """Coarser bars from finer canonical bars.

    open = first bar's open, close = last bar's close (by timestamp; bars are
    unique per (symbol, timestamp)), high/low = extremes, volume and
    transactions are sums, vwap is volume-weighted over the bars that have one.
    Per-bar turnover (vwap x volume) is summed as a decimal at 1e-4 currency
    units, so the result does not depend on the order partial sums combine.
    """
    has_vwap = F.col("vwap").isNotNull()
    out = (
        bars.groupBy(F.col("symbol"), bar_start(F.col("timestamp"), multiplier, timespan).alias("_start"))
        .agg(
            F.min_by("open", "timestamp").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "timestamp").alias("close"),
            F.sum("volume").alias("volume"),
            F.sum(F.when(has_vwap, (F.col("vwap") * F.col("volume")).cast(TURNOVER_DECIMAL))).alias("_pv"),
            F.sum(F.when(has_vwap, F.col("volume"))).alias("_v"),
            F.sum("transactions").alias("_n"),
            F.bool_or("otc").alias("otc"),
        )
    )
    return out.select(
        F.col("_start").alias("timestamp"),
        "symbol", "open", "high", "low", "close", "volume",
        F.when(F.col("_v") != 0, F.col("_pv").cast("double") / F.col("_v")).alias("vwap"),
        F.col("_n").cast("int").alias("transactions"),
        "otc",
    ).select(*BAR_COLUMNS)
