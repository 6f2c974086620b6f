"""Reference tables of the lake beside the universe: splits, dividends, futures
contracts, index membership, session minutes and the session calendar, and
adjusted reads.

Each table is a versioned snapshot whose rows carry the stamp of the refresh
that brought them; a refresh merges by the table's key, stored rows win.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlake.functions.profiles import PROFILES
from barlake.functions.time import exchange_midnight
from barlake.operators import adjust as A
from barlake.operators import calendar as C
from barlake.operators import universe as U
from barlake.operators.dedupe import KEEP_FIRST, keep_one
from barlake.plans import store
from barlake.schemas import BAR_COLUMNS, DIVIDENDS, DIVIDENDS_KEY, FUTURES_CONTRACTS, MEMBERSHIP, SESSION_MINUTES, SPLITS, SPLITS_KEY

STAMP = "refreshed_at"
# Tables, their schemas, keys and stamp columns.
TABLES = {
    "splits": (SPLITS, SPLITS_KEY, STAMP),
    "dividends": (DIVIDENDS, DIVIDENDS_KEY, STAMP),
    "futures_contracts": (FUTURES_CONTRACTS, ["ticker"], "discovered_at"),
    "membership": (MEMBERSHIP, ["index", "ticker", "added_date"], STAMP),
    "session_minutes": (SESSION_MINUTES, ["calendar", "day", "first_minute"], STAMP),
}


def _schema(name: str) -> T.StructType:
    schema, _, stamp = TABLES[name]
    own = [T.StructField(f.name, f.dataType, True) for f in schema.fields]
    return T.StructType(own if stamp in schema.fieldNames() else [*own, T.StructField(stamp, T.TimestampType(), True)])


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The newest version of one reference table (empty if it was never written)."""
    return store.read_latest(spark, root, name, _schema(name))


def refresh(spark: SparkSession, root: str, name: str, new: DataFrame, *, now: str) -> int:
    """Merge ``new`` rows into the table and write its next version. The newest
    stamp is that of this refresh, also where no row is new."""
    schema, key, stamp = TABLES[name]
    columns = [f.name for f in _schema(name).fields if f.name != stamp]
    stamped = new.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in columns],
                         F.lit(now).cast("timestamp").alias(stamp), F.lit(1).alias("_gen"))
    both = read(spark, root, name).withColumn("_gen", F.lit(0)).unionByName(stamped)
    rest = [c for c in columns if c not in key]
    merged = keep_one(both, key, ["_gen", *rest], KEEP_FIRST).drop("_gen")
    if stamp == STAMP:
        merged = merged.withColumn(stamp, F.lit(now).cast("timestamp"))
    return store.write_version(merged, root, name)


def refresh_calendar(spark: SparkSession, root: str, first: str, last: str, *, now: str, calendar: str = C.NYSE) -> int:
    """Write the sessions of [first, last] as the next version of ``calendar``."""
    sessions = C.sessions(C.day_range(spark, first, last), calendar=calendar)
    return store.write_version(sessions.select(F.lit(calendar).alias("calendar"), "session_date", "ordinal",
                                               F.lit(now).cast("timestamp").alias(STAMP)), root, "calendar")


def read_adjusted(spark: SparkSession, root: str, asset_class: str, timeframe: str, from_date: str, to_date: str, *,
                  dividends: bool = False) -> DataFrame:
    """CA-3: stored bars of a window, adjusted by the stored splits (and dividends).

    Factors apply by the date a bar counts for: the exchange's for minute bars of
    exchange-traded assets. Dividend factors need the close before each ex-date,
    so they are taken from all stored bars of the table, not of the window only."""
    profile = PROFILES.get(asset_class)
    day = profile.bar_date(F.col("timestamp"), timeframe) if profile else F.to_date("timestamp")
    bars = store.read_window(spark, root, asset_class, timeframe, from_date, to_date)
    out = A.split_adjust(bars, read(spark, root, "splits"), day)
    if dividends:
        history = store.read_bars(spark, root, asset_class=asset_class, timeframe=timeframe)
        local = profile is not None and profile.exchange_dates and timeframe == "minute"
        factors = A.dividend_intervals(history, read(spark, root, "dividends"),
                                       exchange_midnight("ex_dividend_date") if local else None)
        return A.apply_dividends(out, factors, day)
    return out.select(*BAR_COLUMNS, "split_factor")


def refresh_membership(spark: SparkSession, root: str, current: DataFrame, changes: DataFrame, *, now: str) -> DataFrame:
    """JN-11: replay today's members and the change log into intervals, the next version
    of ``membership`` (a full replacement: a later log may deny earlier knowledge).
    Returns the contradictions of the log."""
    intervals = U.membership_from_changes(current, changes)
    store.write_version(intervals.withColumn(STAMP, F.lit(now).cast("timestamp")), root, "membership")
    return U.change_contradictions(current, changes)


def get_universe_at(spark: SparkSession, root: str, index: str, as_of: str) -> DataFrame:
    """The stored members (ticker) of an index on a date."""
    return U.universe_at(read(spark, root, "membership").where(F.col("index") == index), as_of).select("ticker")


def read_member_bars(spark: SparkSession, root: str, index: str, asset_class: str, timeframe: str, from_date: str,
                     to_date: str) -> DataFrame:
    """Stored bars of a window on the dates their symbol was a member, by the date a bar counts for."""
    profile = PROFILES.get(asset_class)
    day = profile.bar_date(F.col("timestamp"), timeframe) if profile else F.to_date("timestamp")
    members = read(spark, root, "membership").where(F.col("index") == index)
    return U.bars_in_membership(store.read_window(spark, root, asset_class, timeframe, from_date, to_date), members, day) \
        .select(*BAR_COLUMNS)
