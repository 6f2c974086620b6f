"""Raw bars to the canonical schema (PRJ-1..5, PRJ-3, SRC-12).

A normalisation is a single projection of casts; an empty input projects to an
empty frame with the exact canonical schema. Time order is a sink property
(``sortWithinPartitions`` at write), not a global sort here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.functions.time import from_epoch_ms, from_epoch_ns


def normalize_raw(raw: DataFrame, ticker: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Wire bars (o,h,l,c,v,vw,t[ms],n,otc) -> canonical ten columns.

    Numbers keep nulls as nulls; ints and floats both become doubles. When the
    records hold no symbol, ``ticker`` is injected as a constant column. The columns
    ``keep`` are passed on after the ten.
    """
    cols = set(raw.columns)
    symbol = F.col("symbol") if "symbol" in cols else F.lit(ticker)
    if "symbol" not in cols and ticker is None:
        raise ValueError("raw bars carry no symbol and no ticker was given")

    def num(name: str, dtype: str):
        return F.col(name).cast(dtype) if name in cols else F.lit(None).cast(dtype)

    return raw.select(
        from_epoch_ms(F.col("t").cast("bigint")).alias("timestamp"),
        symbol.cast("string").alias("symbol"),
        num("o", "double").alias("open"),
        num("h", "double").alias("high"),
        num("l", "double").alias("low"),
        num("c", "double").alias("close"),
        num("v", "double").alias("volume"),
        num("vw", "double").alias("vwap"),
        num("n", "int").alias("transactions"),
        num("otc", "boolean").alias("otc"),
        *keep,
    )


def normalize_flat_file(flat: DataFrame) -> DataFrame:
    """Flat-file rows (ticker, volume, open, close, high, low, window_start[ns],
    transactions) -> canonical columns, matched by name, never by position."""
    return flat.select(
        from_epoch_ns(F.col("window_start").cast("bigint")).alias("timestamp"),
        F.col("ticker").cast("string").alias("symbol"),
        F.col("open").cast("double").alias("open"),
        F.col("high").cast("double").alias("high"),
        F.col("low").cast("double").alias("low"),
        F.col("close").cast("double").alias("close"),
        F.col("volume").cast("double").alias("volume"),
        F.lit(None).cast("double").alias("vwap"),
        F.col("transactions").cast("int").alias("transactions"),
        F.lit(None).cast("boolean").alias("otc"),
    )


def to_raw(bars: DataFrame) -> DataFrame:
    """Canonical bars re-expressed as wire records (inverse of ``normalize_raw``)."""
    return bars.select(
        "symbol",
        F.col("open").alias("o"), F.col("high").alias("h"), F.col("low").alias("l"),
        F.col("close").alias("c"), F.col("volume").alias("v"), F.col("vwap").alias("vw"),
        F.unix_millis(F.col("timestamp")).alias("t"),
        F.col("transactions").alias("n"),
        F.col("otc").alias("otc"),
    )


def to_flat_file(bars: DataFrame) -> DataFrame:
    """Canonical bars in the flat-file column order (O, C, H, L; ns start)."""
    return bars.select(
        F.col("symbol").alias("ticker"), "volume", "open", "close", "high", "low",
        (F.unix_micros(F.col("timestamp")) * F.lit(1000)).alias("window_start"),
        "transactions",
    )
