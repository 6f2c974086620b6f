"""Exchange session calendar (CAL-1, CAL-2, JN-6..8, AG-7, PRJ-14, AG-13).

The calendar is a table built by rules over a day range: weekends and the
exchange's holiday rules (fixed days with weekend observance, n-th weekdays,
Good Friday from the Gregorian computus) plus an input list of one-off
closures. Its size is bounded by the date span (at most 366 rows per year),
never by the bar data, so joining it to bars may broadcast it.

Global windows over the calendar (ordinal, previous/next session) run in one
task; that task holds the date span only.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.functions.time import EXCHANGE_TZ, REGULAR_CLOSE_MIN, REGULAR_OPEN_MIN, exchange_date, session_class
from barlake.session import pin as pin_df

# One-off full-day closures of the New York Stock Exchange
# (public record), which no rule derives.
SPECIAL_CLOSURES = [
    ("1994-04-27", "National Day of Mourning"),
    ("2001-09-11", "September 11"),
    ("2001-09-12", "September 11"),
    ("2001-09-13", "September 11"),
    ("2001-09-14", "September 11"),
    ("2004-06-11", "National Day of Mourning"),
    ("2007-01-02", "National Day of Mourning"),
    ("2012-10-29", "Hurricane Sandy"),
    ("2012-10-30", "Hurricane Sandy"),
    ("2018-12-05", "National Day of Mourning"),
    ("2025-01-09", "National Day of Mourning"),
]

# First year each rule-based holiday applies.
MLK_FIRST_YEAR = 1998
JUNETEENTH_FIRST_YEAR = 2022

NYSE = "NYSE"
WEEKDAYS = "WEEKDAYS"
US_WEEKDAYS = "US_WEEKDAYS"
CONTINUOUS = "24x7"


def _d(v) -> Column:
    return F.lit(v).cast("date") if isinstance(v, str) else v


def day_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """All days in [start, end] as ``day``, generated by a distributed range."""
    n = (date.fromisoformat(str(end)) - date.fromisoformat(str(start))).days
    return spark.range(0, max(n + 1, 0)).select(
        F.date_add(_d(str(start)), F.col("id").cast("int")).alias("day"))


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter Sunday of ``year`` (anonymous Gregorian computus)."""
    y = year
    a = y % 19
    b = F.floor(y / 100)
    c = y % 100
    d = F.floor(b / 4)
    e = b % 4
    f = F.floor((b + 8) / 25)
    g = F.floor((b - f + 1) / 3)
    h = (a * 19 + b - d - g + 15) % 30
    i = F.floor(c / 4)
    k = c % 4
    ll = (e * 2 + i * 2 - h - k + 32) % 7
    m = F.floor((a + h * 11 + ll * 22) / 451)
    month = F.floor((h + ll - m * 7 + 114) / 31)
    day = (h + ll - m * 7 + 114) % 31 + 1
    return F.make_date(y.cast("int"), month.cast("int"), day.cast("int"))


def holiday_name(day: Column) -> Column:
    """Name of the exchange holiday observed on ``day``, else null."""
    y, m, dom, dow = F.year(day), F.month(day), F.dayofmonth(day), F.dayofweek(day)
    weekday = (dow >= 2) & (dow <= 6)
    mon, thu, fri = dow == 2, dow == 5, dow == 6

    def fixed(mm: int, dd: int, saturday_to_friday: bool = True) -> Column:
        on_day = (m == mm) & (dom == dd) & weekday
        sunday_moved = (m == mm) & (dom == dd + 1) & mon
        cond = on_day | sunday_moved
        if saturday_to_friday:
            cond = cond | ((m == mm) & (dom == dd - 1) & fri)
        return cond

    def nth(mm: int, weekday_cond: Column, n: int) -> Column:
        return (m == mm) & weekday_cond & (dom >= 7 * (n - 1) + 1) & (dom <= 7 * n)

    return (F.when(fixed(1, 1, saturday_to_friday=False), F.lit("New Year's Day"))
            .when((y >= MLK_FIRST_YEAR) & nth(1, mon, 3), F.lit("Martin Luther King Jr. Day"))
            .when(nth(2, mon, 3), F.lit("Washington's Birthday"))
            .when(day == F.date_sub(easter_sunday(y), 2), F.lit("Good Friday"))
            .when((m == 5) & mon & (dom >= 25), F.lit("Memorial Day"))
            .when((y >= JUNETEENTH_FIRST_YEAR) & fixed(6, 19), F.lit("Juneteenth"))
            .when(fixed(7, 4), F.lit("Independence Day"))
            .when(nth(9, mon, 1), F.lit("Labor Day"))
            .when(nth(11, thu, 4), F.lit("Thanksgiving Day"))
            .when(fixed(12, 25), F.lit("Christmas Day")))


def special_closures(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SPECIAL_CLOSURES, "holiday_date string, name string") \
        .select(F.col("holiday_date").cast("date").alias("holiday_date"), "name")


def days_spanning(df: DataFrame, col: str, pad_before: int = 0) -> DataFrame:
    """All days from the first to the last date of ``col`` in ``df``.

    One aggregate row is expanded with ``sequence``: the result holds the date
    span only, however large ``df`` is."""
    bounds = df.agg(F.date_sub(F.min(F.to_date(col)), pad_before).alias("_s"),
                    F.max(F.to_date(col)).alias("_e"))
    return bounds.where(F.col("_s").isNotNull()).select(F.explode(F.sequence("_s", "_e")).alias("day"))


def holidays(days: DataFrame, closures: DataFrame | None = None) -> DataFrame:
    """Weekday holidays among ``days``: rule-based ones plus one-off closures."""
    ruled = days.select(F.col("day").alias("holiday_date"), holiday_name(F.col("day")).alias("name")) \
        .where(F.col("name").isNotNull())
    extra = closures if closures is not None else special_closures(days.sparkSession)
    extra = extra.join(F.broadcast(days.select(F.col("day").alias("holiday_date"))), "holiday_date", "left_semi")
    return ruled.unionByName(extra.join(ruled.select("holiday_date"), "holiday_date", "left_anti")
                             .select("holiday_date", "name"))


def sessions(days: DataFrame, *, calendar: str = NYSE, holiday_table: DataFrame | None = None) -> DataFrame:
    """Session days among ``days`` with ordinal and neighbouring sessions.

    ``calendar``: NYSE (weekdays minus exchange holidays and one-off closures),
    US_WEEKDAYS (weekdays minus the holidays that follow rules), WEEKDAYS
    (weekdays only) or 24x7 (every day)."""
    if calendar == CONTINUOUS:
        sess = days
    else:
        dow = F.dayofweek("day")
        sess = days.where((dow >= 2) & (dow <= 6))
        if calendar == NYSE:
            hol = holiday_table if holiday_table is not None else holidays(days)
            sess = sess.join(F.broadcast(hol.select(F.col("holiday_date").alias("day"))), "day", "left_anti")
        elif calendar == US_WEEKDAYS:
            sess = sess.where(holiday_name(F.col("day")).isNull())
        elif calendar != WEEKDAYS:
            raise ValueError(f"unknown calendar {calendar!r}")
    w = Window.orderBy("day")
    return sess.select(
        F.col("day").alias("session_date"),
        F.row_number().over(w).cast("int").alias("ordinal"),
        F.lag("day").over(w).alias("prev_session"),
        F.lead("day").over(w).alias("next_session"),
    )


def dense_calendar(days: DataFrame, session_table: DataFrame) -> DataFrame:
    """Every day with the last session on or before it and the first session on
    or after it (an as-of lookup without a range join)."""
    s = session_table.select(F.col("session_date").alias("day"), F.lit(True).alias("is_session"))
    j = days.join(F.broadcast(s), "day", "left")
    sess = F.when(F.col("is_session"), F.col("day"))
    back = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    fwd = Window.orderBy("day").rowsBetween(0, Window.unboundedFollowing)
    # Sessions increase with the day, so the last one so far is a running max.
    return j.select(
        "day",
        F.coalesce(F.col("is_session"), F.lit(False)).alias("is_session"),
        F.max(sess).over(back).alias("session_on_or_before"),
        F.min(sess).over(fwd).alias("session_on_or_after"),
        F.count(sess).over(back).alias("sessions_le"),
    )


def build_calendar(days: DataFrame, calendar: str = NYSE, pin: bool = True) -> tuple[DataFrame, DataFrame]:
    """(sessions, dense) for ``days``, each computed once.

    With ``pin`` both small tables are written to the shared checkpoint folder,
    so the many joins that use them neither rebuild the calendar nor re-scan
    the table the day span came from."""
    sess = sessions(days, calendar=calendar)
    if pin:
        sess = pin_df(sess)
    dense = dense_calendar(days, sess)
    if pin:
        dense = pin_df(dense)
    return sess, dense


def regular_minutes(session_table: DataFrame, early_closes: DataFrame | None = None) -> DataFrame:
    """(day, first_minute, last_minute) of each session in UTC, both inclusive:
    regular New York hours; ``early_closes`` (day, close_minute: minutes after
    midnight in New York) end the days they name."""
    days = session_table.select(F.col("session_date").alias("day"))
    close = F.lit(REGULAR_CLOSE_MIN)
    if early_closes is not None:
        days = days.join(early_closes.select("day", "close_minute"), "day", "left")
        close = F.coalesce("close_minute", close)

    def utc(minute: Column) -> Column:
        local = F.col("day").cast("timestamp_ntz") + F.make_dt_interval(mins=minute)
        return F.convert_timezone(F.lit(EXCHANGE_TZ), F.lit("UTC"), local).cast("timestamp")

    return days.select("day", utc(F.lit(REGULAR_OPEN_MIN)).alias("first_minute"), utc(close - 1).alias("last_minute"))


def target_end(days: DataFrame, day_col: str, dense: DataFrame) -> DataFrame:
    """Last complete session for each ``today``: last session on or before the
    day before; never today itself. Equi-join on the dense calendar."""
    look = dense.select(F.col("day").alias("_d"), F.col("session_on_or_before").alias("target_end"))
    return days.join(F.broadcast(look), F.date_sub(F.col(day_col), 1) == F.col("_d"), "left").drop("_d")


def last_complete_day(spark: SparkSession, today: str, calendar: str = NYSE) -> str | None:
    """The last session before ``today`` (ISO date), looked up in the month before."""
    end = date.fromisoformat(today) - timedelta(days=1)
    days = day_range(spark, (end - timedelta(days=31)).isoformat(), end.isoformat())
    row = sessions(days, calendar=calendar).agg(F.max("session_date").alias("d")).first()
    return row["d"].isoformat() if row["d"] is not None else None


def session_count(ranges: DataFrame, dense: DataFrame, session_table: DataFrame | None = None,
                  start_col: str = "start_date", end_col: str = "end_date") -> DataFrame:
    """Number of sessions in [start, end] for each row of ``ranges``: the
    running session count at the end minus the one before the start (two
    equi-joins on the broadcast calendar, no range join)."""
    lo = dense.select(F.col("day").alias("_lo_day"),
                      (F.col("sessions_le") - F.col("is_session").cast("long")).alias("_lo"))
    hi = dense.select(F.col("day").alias("_hi_day"), F.col("sessions_le").alias("_hi"))
    out = (ranges.join(F.broadcast(lo), F.col(start_col) == F.col("_lo_day"), "left")
           .join(F.broadcast(hi), F.col(end_col) == F.col("_hi_day"), "left"))
    return out.withColumn("sessions", F.greatest(F.col("_hi") - F.col("_lo"), F.lit(0)).cast("bigint")) \
        .drop("_lo_day", "_lo", "_hi_day", "_hi")


def classify_sessions(bars: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Add the exchange-local session class and date of each bar."""
    return bars.withColumn("session", session_class(F.col(ts))) \
        .withColumn("session_date", exchange_date(F.col(ts)))
