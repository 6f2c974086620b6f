"""Fixed schemas of the bar lake and its side tables.

Column order is part of the contract for bars: the canonical table has exactly
these ten columns in this order and nothing else is persisted beside them except
the layout's partition columns.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Canonical bar (ten columns, this order).
BARS = T.StructType([
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("symbol", T.StringType(), True),
    T.StructField("open", T.DoubleType(), True),
    T.StructField("high", T.DoubleType(), True),
    T.StructField("low", T.DoubleType(), True),
    T.StructField("close", T.DoubleType(), True),
    T.StructField("volume", T.DoubleType(), True),
    T.StructField("vwap", T.DoubleType(), True),
    T.StructField("transactions", T.IntegerType(), True),
    T.StructField("otc", T.BooleanType(), True),
])
BAR_COLUMNS = [f.name for f in BARS.fields]
BAR_KEY = ["symbol", "timestamp"]

# Partition columns of the lake table (never part of a bar row).
LAKE_PARTITIONS = ["asset_class", "timeframe", "year"]

# Raw bar as it arrives on the wire: prices may be JSON ints or floats, `t` is
# epoch milliseconds, `otc` is omitted when false. The ticker is not in the
# record; landing rows carry it as `symbol`.
RAW_BAR = T.StructType([
    T.StructField("symbol", T.StringType(), True),
    T.StructField("o", T.DoubleType(), True),
    T.StructField("h", T.DoubleType(), True),
    T.StructField("l", T.DoubleType(), True),
    T.StructField("c", T.DoubleType(), True),
    T.StructField("v", T.DoubleType(), True),
    T.StructField("vw", T.DoubleType(), True),
    T.StructField("t", T.LongType(), True),
    T.StructField("n", T.IntegerType(), True),
    T.StructField("otc", T.BooleanType(), True),
])

# Daily flat file: note the O, C, H, L column order and ns epoch start.
FLAT_FILE_BAR = T.StructType([
    T.StructField("ticker", T.StringType(), True),
    T.StructField("volume", T.DoubleType(), True),
    T.StructField("open", T.DoubleType(), True),
    T.StructField("close", T.DoubleType(), True),
    T.StructField("high", T.DoubleType(), True),
    T.StructField("low", T.DoubleType(), True),
    T.StructField("window_start", T.LongType(), True),
    T.StructField("transactions", T.IntegerType(), True),
])

# Ingestion state, one row per (asset_class, symbol, timeframe).
MANIFEST = T.StructType([
    T.StructField("asset_class", T.StringType(), False),
    T.StructField("symbol", T.StringType(), False),
    T.StructField("timeframe", T.StringType(), False),
    T.StructField("earliest_date", T.DateType(), True),
    T.StructField("last_complete_date", T.DateType(), True),
    T.StructField("last_updated_at", T.TimestampType(), True),
    T.StructField("bar_count", T.LongType(), True),
])
# State of each series and year; the manifest is its roll-up.
SERIES_YEARS = T.StructType([
    T.StructField("asset_class", T.StringType(), False),
    T.StructField("symbol", T.StringType(), False),
    T.StructField("timeframe", T.StringType(), False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("earliest_date", T.DateType(), True),
    T.StructField("last_complete_date", T.DateType(), True),
    T.StructField("bar_count", T.LongType(), True),
])
MANIFEST_KEY = ["asset_class", "symbol", "timeframe"]

RUN_LOG = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("started_at", T.TimestampType(), True),
    T.StructField("finished_at", T.TimestampType(), True),
    T.StructField("command", T.StringType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("error_message", T.StringType(), True),
    T.StructField("symbols_attempted", T.IntegerType(), True),
    T.StructField("symbols_succeeded", T.IntegerType(), True),
    T.StructField("bars_written", T.LongType(), True),
])

# Bars that landed and wait for their day to complete, as they came.
PENDING = T.StructType(RAW_BAR.fields + [
    T.StructField("_file", T.StringType(), True),
    T.StructField("_landed", T.TimestampType(), True),
])

# Landed lines that are no bars.
QUARANTINE = T.StructType([
    T.StructField("asset_class", T.StringType(), False),
    T.StructField("timeframe", T.StringType(), False),
    T.StructField("symbol", T.StringType(), True),
    T.StructField("reason", T.StringType(), True),
    T.StructField("record", T.StringType(), True),
    T.StructField("file", T.StringType(), True),
    T.StructField("landed_at", T.TimestampType(), True),
])

#: What inline validation found in the batch of a run.
INGEST_FINDINGS = T.StructType([
    T.StructField("asset_class", T.StringType(), False),
    T.StructField("timeframe", T.StringType(), False),
    T.StructField("symbol", T.StringType(), True),
    T.StructField("check", T.StringType(), False),
    T.StructField("day", T.DateType(), True),
    T.StructField("detail", T.StringType(), True),
    T.StructField("run_id", T.StringType(), False),
    T.StructField("found_at", T.TimestampType(), True),
])

# Landed files that a run has taken, and the start of the window it took them for.
LANDING_FILES = T.StructType([
    T.StructField("asset_class", T.StringType(), False),
    T.StructField("timeframe", T.StringType(), False),
    T.StructField("symbol", T.StringType(), True),
    T.StructField("file", T.StringType(), False),
    T.StructField("modified", T.TimestampType(), True),
    T.StructField("length", T.LongType(), True),
    T.StructField("from_date", T.DateType(), True),
    T.StructField("run_id", T.StringType(), True),
])

# Flat files taken: state by asset class and day, beside that by symbol.
FLAT_DAYS = T.StructType([
    T.StructField("asset_class", T.StringType(), False),
    T.StructField("timeframe", T.StringType(), False),
    T.StructField("day", T.DateType(), True),
    T.StructField("path", T.StringType(), False),
    T.StructField("modified", T.TimestampType(), True),
    T.StructField("length", T.LongType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("tickers", T.LongType(), True),
    T.StructField("rows", T.LongType(), True),
    T.StructField("bad", T.LongType(), True),
    T.StructField("run_id", T.StringType(), True),
])

UNIVERSE = T.StructType([
    T.StructField("ticker", T.StringType(), False),
    T.StructField("source", T.StringType(), True),
    T.StructField("generated_at", T.TimestampType(), True),
])

# Frozen document form of a universe (one row per chunk of tickers).
FROZEN = T.StructType([
    T.StructField("generated_at", T.TimestampType(), True),
    T.StructField("source", T.StringType(), True),
    T.StructField("indexes_included", T.ArrayType(T.StringType()), True),
    T.StructField("chunk", T.IntegerType(), True),
    T.StructField("tickers", T.ArrayType(T.StringType()), True),
])

SPLITS = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("execution_date", T.DateType(), False),
    T.StructField("split_from", T.DoubleType(), True),
    T.StructField("split_to", T.DoubleType(), True),
    T.StructField("ratio", T.DoubleType(), True),
])
SPLITS_KEY = ["symbol", "execution_date"]

DIVIDENDS = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("ex_dividend_date", T.DateType(), False),
    T.StructField("cash_amount", T.DoubleType(), True),
    T.StructField("currency", T.StringType(), True),
    T.StructField("dividend_type", T.StringType(), True),
    T.StructField("frequency", T.IntegerType(), True),
    T.StructField("pay_date", T.DateType(), True),
    T.StructField("record_date", T.DateType(), True),
    T.StructField("declaration_date", T.DateType(), True),
])
DIVIDENDS_KEY = ["symbol", "ex_dividend_date", "dividend_type", "cash_amount"]

FUTURES_CONTRACTS = T.StructType([
    T.StructField("ticker", T.StringType(), False),
    T.StructField("product_code", T.StringType(), True),
    T.StructField("name", T.StringType(), True),
    T.StructField("month", T.StringType(), True),
    T.StructField("first_trade_date", T.DateType(), True),
    T.StructField("last_trade_date", T.DateType(), True),
    T.StructField("exchange_mic", T.StringType(), True),
    T.StructField("tick_size", T.DoubleType(), True),
    T.StructField("discovered_at", T.TimestampType(), True),
])

MEMBERSHIP = T.StructType([
    T.StructField("index", T.StringType(), False),
    T.StructField("ticker", T.StringType(), False),
    T.StructField("added_date", T.DateType(), True),
    T.StructField("removed_date", T.DateType(), True),
])

# Expected minutes of each session day (UTC, both inclusive), by calendar; rows of
# one calendar do not overlap.
SESSION_MINUTES = T.StructType([
    T.StructField("calendar", T.StringType(), False),
    T.StructField("day", T.DateType(), False),
    T.StructField("first_minute", T.TimestampType(), True),
    T.StructField("last_minute", T.TimestampType(), True),
])

# Long cell table of scraped HTML tables.
CELLS = T.StructType([
    T.StructField("page", T.StringType(), False),
    T.StructField("table_no", T.IntegerType(), False),
    T.StructField("row_no", T.LongType(), False),
    T.StructField("col_name", T.StringType(), True),
    T.StructField("is_flat", T.BooleanType(), True),
    T.StructField("value", T.StringType(), True),
])


def assert_same_columns(left, right, what: str = "frames") -> None:
    """Strict-schema check before a vertical concat (names, order and types)."""
    ls = [(f.name, f.dataType.simpleString()) for f in left.schema.fields]
    rs = [(f.name, f.dataType.simpleString()) for f in right.schema.fields]
    if ls != rs:
        raise ValueError(f"schema drift between {what}: {ls} != {rs}")
