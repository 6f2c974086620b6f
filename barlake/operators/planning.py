"""Fetch planning, per-symbol dispositions and run outcome (JN-1..3, SRC-2, AG-3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUCCEEDED = "succeeded"
ERROR = "error"
ZERO_BAR = "zero_bar"
UP_TO_DATE = "up_to_date"
FETCH = "fetch"


def _date(v) -> Column:
    return F.lit(v).cast("date") if isinstance(v, str) else v


def fetch_plan(universe: DataFrame, manifest: DataFrame, *, timeframe: str,
               default_start, target_end, extend_head: bool = False) -> DataFrame:
    """One row per universe symbol: what to fetch for ``timeframe``.

    No state -> [default_start, target_end]; ``last_complete_date >= target_end``
    -> up to date, nothing fetched; else [last_complete_date + 1, target_end].
    Windows that would be empty are dropped (from > to). With ``extend_head``
    a series whose history starts after ``default_start`` also gets the head
    window [default_start, earliest_date - 1].

    ``universe`` has (asset_class, symbol); the manifest join is an equi-join
    on the full series key, so one symbol in two asset classes never collides.
    """
    start, end = _date(default_start), _date(target_end)
    state = manifest.where(F.col("timeframe") == timeframe).select(
        "asset_class", "symbol", "earliest_date", "last_complete_date")
    # A symbol listed twice in the universe is planned once.
    joined = universe.select("asset_class", "symbol").distinct().join(state, ["asset_class", "symbol"], "left")
    lcd = F.col("last_complete_date")
    action = F.when(lcd.isNotNull() & (lcd >= end), F.lit(UP_TO_DATE)).otherwise(F.lit(FETCH))
    tail = joined.select(
        "asset_class", "symbol", F.lit(timeframe).alias("timeframe"),
        F.when(lcd.isNull(), start).otherwise(F.date_add(lcd, 1)).alias("from_date"),
        end.alias("to_date"),
        action.alias("action"),
    )
    plan = tail.where((F.col("action") == UP_TO_DATE) | (F.col("from_date") <= F.col("to_date")))
    if extend_head:
        head = joined.where(F.col("earliest_date") > start).select(
            "asset_class", "symbol", F.lit(timeframe).alias("timeframe"),
            start.alias("from_date"), F.date_sub(F.col("earliest_date"), 1).alias("to_date"),
            F.lit(FETCH).alias("action"))
        plan = plan.unionByName(head)
    return plan


def landed_summary(landed: DataFrame, *, error_col: str | None = None) -> DataFrame:
    """Per symbol: landed row count and whether any record was an error.

    Pre-aggregated (map-side combine) before it meets the plan."""
    err = F.col(error_col).isNotNull() & (F.col(error_col).cast("string") != "false") \
        if error_col else F.lit(False)
    return landed.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"),
                                        F.bool_or(err).alias("has_error"))


def dispositions(plan: DataFrame, landed: DataFrame, *, error_col: str | None = None) -> DataFrame:
    """Planned symbols x landed rows -> succeeded / error / zero_bar.

    A failure of one symbol never hides the others; a symbol with no rows is a
    zero-bar success (no write, no manifest row)."""
    fetch = plan.where(F.col("action") == FETCH).select("symbol").distinct()
    summary = landed_summary(landed, error_col=error_col)
    j = fetch.join(summary, "symbol", "left")
    disp = (F.when(F.coalesce(F.col("has_error"), F.lit(False)), F.lit(ERROR))
            .when(F.coalesce(F.col("rows"), F.lit(0)) == 0, F.lit(ZERO_BAR))
            .otherwise(F.lit(SUCCEEDED)))
    return j.select("symbol", disp.alias("disposition"),
                    F.coalesce(F.col("rows"), F.lit(0)).cast("bigint").alias("rows"))


def attempts(landed: DataFrame) -> DataFrame:
    """One row per attempt (symbol, file), with its time: whether it failed, how (``auth``
    where any error is one), and its good and bad records. ``landed`` is a landing scan; a
    line that does not parse belongs to the attempt that the file's other records name."""
    good = F.col("_error").isNull() & F.col("_bad").isNull()
    named = F.max(F.when(F.col("attempt").isNotNull(), F.col("_landed")))
    return landed.groupBy("symbol", "_file").agg(
        F.coalesce(named, F.max("_landed")).alias("_landed"),
        F.bool_or(F.col("_error").isNotNull()).alias("failed"),
        F.bool_or(F.coalesce(F.col("error_kind") == "auth", F.lit(False))).alias("auth"), F.max("_error").alias("message"),
        F.count_if(good).alias("good"), F.count_if(F.col("_bad").isNotNull()).alias("bad"))


def attempt_dispositions(plan: DataFrame, tried: DataFrame, taken: DataFrame) -> DataFrame:
    """AG-3 over attempts: per planned symbol its latest attempt decides.

    ``tried`` are ``attempts``, ``taken`` the (symbol, rows) of bars stored or re-sent for
    the planned windows. A failed attempt counts only if no good one came after it; an attempt
    of bad records alone is a failed one. A symbol that neither failed nor has rows is a
    zero-bar success."""
    fetch = plan.where(F.col("action") == FETCH).select("symbol").distinct()
    at = F.struct(F.col("_landed"), F.col("_file"))
    failed = F.col("failed") | ((F.col("good") == 0) & (F.col("bad") > 0))
    last = tried.groupBy("symbol").agg(F.max(F.when(failed, at)).alias("_bad_at"), F.max(F.when(~failed & (F.col("good") > 0), at)).alias("_good_at"))
    j = fetch.join(last, "symbol", "left").join(taken.select("symbol", "rows"), "symbol", "left")
    rows = F.coalesce("rows", F.lit(0))
    error = F.col("_bad_at").isNotNull() & (F.col("_good_at").isNull() | (F.col("_good_at") < F.col("_bad_at")))
    return j.select("symbol", F.when(error, F.lit(ERROR)).when(rows == 0, F.lit(ZERO_BAR)).otherwise(F.lit(SUCCEEDED)).alias("disposition"),
                    rows.cast("bigint").alias("rows"))


def fatal_attempt(tried: DataFrame) -> DataFrame:
    """One row (message): of the latest failed authentication, null where there is none
    or a later attempt of any symbol succeeded."""
    at = F.struct(F.col("_landed"), F.col("_file"))
    last = tried.agg(F.max(F.when(F.col("auth"), F.struct(at.alias("at"), F.col("message")))).alias("_auth"),
                     F.max(F.when(~F.col("failed") & (F.col("good") > 0), at)).alias("_good"))
    return last.select(F.when(F.col("_auth").isNotNull() & (F.col("_good").isNull() | (F.col("_good") < F.col("_auth.at"))),
                              F.col("_auth.message")).alias("message"))


def zero_bar_symbols(plan: DataFrame, landed: DataFrame) -> DataFrame:
    """Planned symbols with no landed rows (anti join)."""
    fetch = plan.where(F.col("action") == FETCH).select("symbol", "from_date", "to_date")
    return fetch.join(landed.select("symbol").distinct(), "symbol", "left_anti")


def run_outcome(disp: DataFrame, up_to_date: DataFrame | None = None) -> DataFrame:
    """Counts by disposition and the exit code: 0 no error, 2 all attempted
    failed, 1 otherwise. Up-to-date symbols are counted but not attempted."""
    rows = disp.select("disposition")
    if up_to_date is not None:
        rows = rows.unionByName(up_to_date.select(F.lit(UP_TO_DATE).alias("disposition")))
    d = F.col("disposition")
    agg = rows.agg(
        F.count_if(d == SUCCEEDED).alias("succeeded"),
        F.count_if(d == ERROR).alias("errors"),
        F.count_if(d == ZERO_BAR).alias("zero_bar"),
        F.count_if(d == UP_TO_DATE).alias("up_to_date"),
    )
    attempted = F.col("succeeded") + F.col("errors") + F.col("zero_bar")
    return agg.select(
        attempted.alias("attempted"), "succeeded", "errors", "zero_bar", "up_to_date",
        F.when(F.col("errors") == 0, F.lit(0))
         .when(F.col("errors") == attempted, F.lit(2))
         .otherwise(F.lit(1)).alias("exit_code"),
    )


def gap_refetch_plan(ranges: DataFrame, *, asset_class: str, timeframe: str) -> DataFrame:
    """Interior gaps as fetch windows (the resume plan only ever extends the
    tail; this feeds the gap ranges of validation back into fetching)."""
    return ranges.select(F.lit(asset_class).alias("asset_class"), "symbol", F.lit(timeframe).alias("timeframe"),
                         F.col("first_missing").alias("from_date"), F.col("last_missing").alias("to_date"),
                         F.lit(FETCH).alias("action"))
