"""Jobs over a stored lake: ``status`` (AG-10 with disk usage) and
``validate`` (V-2..V-8 over every table, with each asset class's calendar).

Both return DataFrames; ``validate`` can also append its findings as a new
version of the ``findings`` table. Nothing is collected except the list of
(asset_class, timeframe) tables, which is a handful of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.profiles import PROFILES
from barlake.operators import calendar as C
from barlake.operators import dedupe as D
from barlake.operators import state as S
from barlake.operators import validation as V
from barlake.plans import actions, store
from barlake.session import pin

FINDING_COLUMNS = ["asset_class", "timeframe", "symbol", "check", "day", "detail"]


def status(spark: SparkSession, root: str) -> DataFrame:
    """Per asset class and timeframe: series, oldest and newest date, bars,
    last update and bytes on disk, with rollup totals."""
    usage = store.storage_usage(spark, root).groupBy("asset_class", "timeframe") \
        .agg(F.sum("bytes").alias("disk_bytes"))
    return S.status_summary(store.read_manifest(spark, root), usage.select(
        "asset_class", "timeframe", "disk_bytes"))


# Freshness thresholds per reference dataset (OK up to, WARN up to), in days.
REFERENCE_THRESHOLDS = [
    ("stocks_universe", 7, 14),
    ("futures_contracts", 14, 30),
    ("market_calendar", 30, 90),
    ("splits", 2, 7),
    ("dividends", 2, 7),
]
# Stamp column of each stored reference table.
_STAMPS = {"stocks_universe": ("universe", "generated_at"), "futures_contracts": ("futures_contracts", "discovered_at"),
           "market_calendar": ("calendar", "refreshed_at"), "splits": ("splits", "refreshed_at"),
           "dividends": ("dividends", "refreshed_at")}


def reference_freshness(spark: SparkSession, root: str, *, as_of: str) -> DataFrame:
    """AG-6: one row per reference dataset stored in the lake (newest version
    of each table): rows, newest stamp, whole-day age and flag; a dataset that
    is absent reads MISSING."""
    from pyspark.sql import types as T
    from barlake.operators import universe as U
    parts = []
    for dataset, (table, stamp) in _STAMPS.items():
        schema = T.StructType([T.StructField(stamp, T.TimestampType(), True)])
        df = store.read_latest(spark, root, table, schema)
        parts.append(df.agg(F.lit(dataset).alias("dataset"), F.count(F.lit(1)).alias("rows"),
                            F.max(stamp).alias("last_refreshed")))
    datasets = parts[0]
    for p in parts[1:]:
        datasets = datasets.unionByName(p)
    thresholds = spark.createDataFrame(REFERENCE_THRESHOLDS, "dataset string, ok_days int, stale_days int")
    return U.freshness_report(datasets, thresholds, as_of)


def row_findings(bars: DataFrame, asset_class: str, timeframe: str) -> DataFrame:
    """What rows tell by themselves: OHLC order, repeated keys and required values that are
    null, as rows (asset_class, timeframe, symbol, check, day, detail)."""
    def found(rows: DataFrame, check: str, detail) -> DataFrame:
        return rows.select(F.lit(asset_class).alias("asset_class"), F.lit(timeframe).alias("timeframe"), "symbol",
                           F.lit(check).alias("check"), F.to_date("timestamp").alias("day"), detail.alias("detail"))

    missing = F.greatest(*[F.col(c).isNull().cast("int") for c in V.REQUIRED]) == 1
    return found(V.ohlc_violations(bars), "ohlc", F.col("rule")) \
        .unionByName(found(D.duplicate_report(bars, ["symbol", "timestamp"]), "duplicate", F.col("n_rows").cast("string"))) \
        .unionByName(found(bars.where(missing), "null", F.lit("required column is null")))


CHECKS = ["gap", "ohlc", "duplicate", "null", "coverage"]
NOT_CHECKED = "gap not checked"


def findings(spark: SparkSession, root: str, *, as_of: str, coverage_sessions: int = 1,
             session_minutes: DataFrame | None = None) -> DataFrame:
    """All findings of all tables as rows (asset_class, timeframe, symbol, check, day, detail).

    Gaps of minute bars with sessions need the expected minutes of each session:
    ``session_minutes`` (calendar, day, first_minute, last_minute), by default the
    lake's own table of that name. A series with sessions that it does not list
    gets a ``gap not checked`` finding; the listed ones are checked all the same."""
    out = None
    if session_minutes is None:
        session_minutes = actions.read(spark, root, "session_minutes")
    manifest = store.read_manifest(spark, root)
    as_of_day = F.lit(as_of).cast("date")
    for asset_class, timeframe in store.list_tables(spark, root):
        bars = store.read_bars(spark, root, asset_class=asset_class, timeframe=timeframe)
        profile = PROFILES.get(asset_class)
        cal = profile.calendar if profile else C.CONTINUOUS
        lit = [F.lit(asset_class).alias("asset_class"), F.lit(timeframe).alias("timeframe")]
        parts = [row_findings(bars, asset_class, timeframe)]
        # Calendar over the table's span up to the as-of day (bounded by the span).
        own = manifest.where((F.col("asset_class") == asset_class) & (F.col("timeframe") == timeframe))
        span = bars.select(F.to_date("timestamp").alias("d")).unionByName(
            spark.range(1).select(as_of_day.alias("d"))).unionByName(own.select(F.col("last_complete_date").alias("d")))
        sess, dense = C.build_calendar(C.days_spanning(span, "d"), cal)
        if timeframe == "daily":
            bar_days = bars.select("symbol", F.to_date("timestamp").alias("day")).distinct()
            parts.append(V.missing_sessions(bar_days, sess, dense).select(
                *lit, "symbol", F.lit("gap").alias("check"), F.col("missing_date").alias("day"),
                F.lit("missing session").alias("detail")))
        elif timeframe == "minute":
            expected = None
            if cal != C.CONTINUOUS:
                expected = session_minutes.where(F.col("calendar") == cal)
                bar_day = profile.bar_date(F.col("timestamp"), timeframe)
                parts.append(V.unlisted_sessions(bars, bar_day, sess, expected).select(
                    *lit, "symbol", F.lit(NOT_CHECKED).alias("check"), F.col("first_day").alias("day"),
                    F.concat(F.col("sessions").cast("string"), F.lit(" sessions without session minutes")).alias("detail")))
            per_day = V.missing_minutes_by_day(V.missing_minute_ranges(bars, expected))
            parts.append(per_day.select(*lit, "symbol", F.lit("gap").alias("check"), "day",
                                        F.concat(F.col("minutes").cast("string"), F.lit(" missing minutes")).alias("detail")))
        le = dense.select(F.col("day").alias("_d"), F.col("sessions_le").alias("_le"))
        # Sessions up to the as-of day: one number, used as a parameter.
        now = dense.where(F.col("day") == as_of_day).select("sessions_le").first()
        now_le = now["sessions_le"] if now is not None else None
        m = own.join(le, F.col("last_complete_date") == F.col("_d"), "left") \
            .withColumn("_behind", F.lit(now_le).cast("long") - F.col("_le"))
        parts.append(m.where(F.col("_behind") > coverage_sessions).select(
            *lit, "symbol", F.lit("coverage").alias("check"), F.col("last_complete_date").alias("day"),
            F.concat(F.col("_behind").cast("string"), F.lit(" sessions behind")).alias("detail")))
        for p in parts:
            out = p if out is None else out.unionByName(p)
    if out is None:
        return spark.createDataFrame([], "asset_class string, timeframe string, symbol string, check string, "
                                         "day date, detail string")
    return out


def validate(spark: SparkSession, root: str, *, as_of: str, write: bool = False,
             session_minutes: DataFrame | None = None) -> DataFrame:
    """V-8: per table, series checked, healthy, with warnings, and findings per check.
    A series whose gaps could not be checked (see ``findings``) is one with warnings.
    With ``write`` the findings are pinned and appended as a new version of
    the ``findings`` table first."""
    found = findings(spark, root, as_of=as_of, session_minutes=session_minutes)
    if write:
        found = pin(found)
        store.write_version(found, root, "findings")
    series = store.read_manifest(spark, root).select("asset_class", "timeframe", "symbol")
    per_symbol = found.groupBy("asset_class", "timeframe", "symbol").agg(F.count(F.lit(1)).alias("_n"))
    j = series.join(per_symbol, ["asset_class", "timeframe", "symbol"], "left")
    summary = j.groupBy("asset_class", "timeframe").agg(
        F.count(F.lit(1)).alias("symbols"), F.count_if(F.col("_n").isNull()).alias("healthy"),
        F.count_if(F.col("_n").isNotNull()).alias("warnings"))
    checks = found.groupBy("asset_class", "timeframe").agg(
        *[F.count_if(F.col("check") == c).alias(c) for c in CHECKS])
    return summary.join(checks, ["asset_class", "timeframe"], "left").na.fill(0)
