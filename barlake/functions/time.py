"""Time expressions: epoch units, bar starts, exchange-local time and sessions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXCHANGE_TZ = "America/New_York"

# Exchange session boundaries in New York local time, as minutes
# after midnight (pre 04:00-09:30, regular 09:30-16:00, after 16:00-20:00).
PRE_OPEN_MIN = 4 * 60
REGULAR_OPEN_MIN = 9 * 60 + 30
REGULAR_CLOSE_MIN = 16 * 60
AFTER_CLOSE_MIN = 20 * 60

# Seconds per fixed-length timespan unit.
_FIXED_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
# Months per calendar timespan unit; a week is seven days from Monday.
_CALENDAR_MONTHS = {"month": 1, "quarter": 3, "year": 12}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def from_epoch_ms(c) -> Column:
    return F.timestamp_millis(_col(c))


def from_epoch_ns(c) -> Column:
    """ns epoch -> timestamp (µs precision; sub-µs digits are floored)."""
    ns = _col(c).cast("bigint")  # integer arithmetic: a double holds no ns of this century
    return F.timestamp_micros(F.call_function("div", ns - F.pmod(ns, F.lit(1000)), F.lit(1000)))


def to_utc_instant(c) -> Column:
    """Naive wall-clock values of the supplied tables are UTC instants."""
    return _col(c).cast("timestamp")


def bar_start(ts, multiplier: int = 1, timespan: str = "day") -> Column:
    """Start of the ``multiplier x timespan`` bar containing ``ts`` (UTC)."""
    ts = _col(ts)
    if timespan in _FIXED_SECONDS:
        if multiplier == 1:
            return F.date_trunc(timespan, ts)
        width = _FIXED_SECONDS[timespan] * multiplier
        secs = F.unix_seconds(ts)
        return F.timestamp_seconds(secs - F.pmod(secs, F.lit(width)))
    if timespan in _CALENDAR_MONTHS:
        if multiplier == 1:
            return F.date_trunc(timespan, ts)
        months = F.year(ts) * 12 + F.month(ts) - 1
        first = months - F.pmod(months, F.lit(multiplier * _CALENDAR_MONTHS[timespan]))
        return F.make_date(F.floor(first / 12).cast("int"), F.pmod(first, F.lit(12)) + 1, F.lit(1)).cast("timestamp")
    if timespan == "week":
        if multiplier == 1:
            return F.date_trunc(timespan, ts)
        monday = F.unix_date(F.to_date(F.date_trunc("week", ts))) + 3  # days from Monday, 29 December 1969
        return F.date_from_unix_date(monday - F.pmod(monday, F.lit(7 * multiplier)) - 3).cast("timestamp")
    raise ValueError(f"unknown timespan {timespan!r}")


def parse_iso(c) -> Column:
    """ISO 8601 text -> instant: ``Z`` or an offset counts, a naive time is UTC (the
    session's zone); text that is no time is null."""
    return F.try_to_timestamp(_col(c))


def format_iso(c) -> Column:
    """Instant -> ISO 8601 text in UTC, whole seconds, with ``Z``."""
    return F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def exchange_local(ts) -> Column:
    """Exchange (New York) wall clock of a UTC instant, as timestamp_ntz."""
    return F.convert_timezone(F.lit("UTC"), F.lit(EXCHANGE_TZ), _col(ts).cast("timestamp_ntz"))


def exchange_date(ts) -> Column:
    return F.to_date(exchange_local(ts))


def exchange_midnight(date) -> Column:
    """The instant at which a date begins in New York."""
    local = _col(date).cast("timestamp_ntz")
    return F.convert_timezone(F.lit(EXCHANGE_TZ), F.lit("UTC"), local).cast("timestamp")


def session_class(ts) -> Column:
    """'pre', 'regular', 'after' or 'closed' by New York local time of day."""
    local = exchange_local(ts)
    minute = F.hour(local) * 60 + F.minute(local)
    return (F.when((minute >= PRE_OPEN_MIN) & (minute < REGULAR_OPEN_MIN), F.lit("pre"))
            .when((minute >= REGULAR_OPEN_MIN) & (minute < REGULAR_CLOSE_MIN), F.lit("regular"))
            .when((minute >= REGULAR_CLOSE_MIN) & (minute < AFTER_CLOSE_MIN), F.lit("after"))
            .otherwise(F.lit("closed")))


def whole_days_between(earlier, later) -> Column:
    """Elapsed whole days (floor of seconds / 86400), not calendar-day difference."""
    micros = F.unix_micros(_col(later)) - F.unix_micros(_col(earlier))
    return F.floor(micros / F.lit(86_400_000_000)).cast("bigint")
