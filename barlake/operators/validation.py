"""Validation of stored bars (V-1..V-8, JN-5, WN-3, WN-4, WN-6).

Sequence checks need each bar's predecessor. A window partitioned by symbol
alone would put a whole symbol in one task, so the window is partitioned by
(symbol, bucket) -- a day for minute bars, a year for daily bars -- and the
first bar of each bucket takes its predecessor from a small per-bucket
aggregate (last timestamp of each earlier bucket), looked up by equi-join.

Gaps are expanded only where they are: for each bar and the next one, the
calendar slots strictly between them. Present bars are never expanded, and no
symbol x calendar product is formed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.schemas import BAR_COLUMNS


def _bucket(ts: Column, bucket: str) -> Column:
    if bucket == "day":
        return F.to_date(ts)
    if bucket == "year":
        return F.year(ts)
    if bucket == "month":
        return F.trunc(F.to_date(ts), "month")
    raise ValueError(f"unknown bucket {bucket!r}")


def with_previous(df: DataFrame, key: Sequence[str] = ("symbol",), ts: str = "timestamp",
                  bucket: str = "year", prev: str = "prev_ts") -> DataFrame:
    """Add the previous row's ``ts`` within ``key`` (null for the first row)."""
    key = list(key)
    b = df.withColumn("_bk", _bucket(F.col(ts), bucket))
    w = Window.partitionBy(*key, "_bk").orderBy(F.col(ts))
    local = b.withColumn(prev, F.lag(ts).over(w))
    # Last timestamp of every (key, bucket); the previous bucket's value carries over.
    last = b.groupBy(*key, "_bk").agg(F.max(ts).alias("_last"))
    carry = last.withColumn(
        "_carry", F.max("_last").over(Window.partitionBy(*key).orderBy("_bk")
                                      .rowsBetween(Window.unboundedPreceding, -1))
    ).select(*key, "_bk", "_carry")
    out = local.join(carry, [*key, "_bk"], "left")
    return out.withColumn(prev, F.coalesce(F.col(prev), F.col("_carry"))).drop("_bk", "_carry")


def bar_steps(bars: DataFrame, bucket: str = "day") -> DataFrame:
    """WN-3: time since the previous bar of the same symbol, in seconds."""
    p = with_previous(bars.select("symbol", "timestamp"), bucket=bucket)
    return p.select("symbol", "timestamp", F.col("prev_ts"),
                    (F.unix_seconds("timestamp") - F.unix_seconds("prev_ts")).alias("step_seconds"))


def monotonic_check(df: DataFrame, ts: str = "ts") -> DataFrame:
    """WN-6: per symbol, rows whose time does not strictly exceed the previous
    one in time order. In sorted order that is exactly the number of rows
    minus the number of distinct times, so it is two partial aggregations:
    no window, and a symbol with a third of all rows is no hot partition."""
    per_ts = df.groupBy("symbol", ts).agg(F.count(F.lit(1)).alias("_n"))
    return per_ts.groupBy("symbol").agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("_distinct")) \
        .select("symbol", "rows", (F.col("rows") - F.col("_distinct")).alias("violations")) \
        .withColumn("strictly_increasing", F.col("violations") == 0)


def stored_order_check(scan: DataFrame, ts: str = "timestamp") -> DataFrame:
    """WN-6 on stored files: per symbol, rows whose time does not exceed that of the row
    stored before them in the same file (``scan`` reads files: its ``_metadata`` gives
    each row's place). A window holds one symbol's rows of one file."""
    rows = scan.select("symbol", F.col(ts).alias("_t"), F.col("_metadata.file_path").alias("_file"),
                       F.col("_metadata.row_index").alias("_at"))
    before = F.lag("_t").over(Window.partitionBy("_file", "symbol").orderBy("_at"))
    return rows.select("symbol", "_file", (F.col("_t") <= before).alias("_bad")).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("_file").alias("files"), F.count_if("_bad").alias("violations"))


def missing_sessions(bar_days: DataFrame, sessions: DataFrame, dense: DataFrame,
                     key: str = "symbol", with_ordinal: bool = False) -> DataFrame:
    """JN-5: sessions strictly between consecutive bar days of a series.

    ``bar_days`` has (key, day), one row per series and day with a bar.
    Each (day, next_day) pair expands to the session ordinals between them
    (ordinal arithmetic on the broadcast calendar), then back to dates."""
    ords = sessions.select(F.col("session_date").alias("_sd"), F.col("ordinal").alias("_ord"))
    le = dense.select(F.col("day").alias("_day"), F.col("sessions_le").cast("int").alias("_le"))
    # One row per series and day: a series' window is bounded by the calendar's days.
    nxt = bar_days.select(key, "day", F.lead("day").over(Window.partitionBy(key).orderBy("day")).alias("next_day"))
    pairs = nxt.where(F.col("next_day").isNotNull())
    pairs = pairs.join(F.broadcast(le.select(F.col("_day").alias("day"), F.col("_le").alias("lo"))), "day") \
        .join(F.broadcast(le.select(F.col("_day").alias("_nd"), F.col("_le").alias("hi"))),
              F.date_sub("next_day", 1) == F.col("_nd")) \
        .where(F.col("hi") > F.col("lo"))
    exploded = pairs.select(key, F.explode(F.sequence(F.col("lo") + 1, F.col("hi"))).alias("_ord"))
    out = exploded.join(F.broadcast(ords), "_ord")
    extra = [F.col("_ord").alias("ordinal")] if with_ordinal else []
    return out.select(key, F.col("_sd").alias("missing_date"), *extra)


def missing_minutes(bars: DataFrame, session_minutes: DataFrame | None = None) -> DataFrame:
    """JN-5 at minute scale: minutes without a bar between the first and the last
    bar of each symbol, days without any bar included.

    By default every minute is expected (24x7). ``session_minutes`` (day,
    first_minute, last_minute; UTC timestamps, both inclusive) gives the expected
    minutes of each session day instead; early closes are rows like any other.
    Without sessions only the days that lack bars are expanded, to one day's
    minutes each; with sessions every session day is, to its own minutes."""
    have = bars.select("symbol", F.to_date("timestamp").alias("day"),
                       F.date_trunc("minute", "timestamp").alias("timestamp")).distinct()
    span = bars.groupBy("symbol").agg(F.min("timestamp").alias("_lo"), F.max("timestamp").alias("_hi"))
    reach = 0 if session_minutes is None else 1  # a session may begin on the eve of its day, or end after it
    first, last = F.date_sub(F.to_date("_lo"), reach), F.date_add(F.to_date("_hi"), reach)
    days = span.select("symbol", "_lo", "_hi", F.explode(F.sequence(first, last)).alias("day"))
    if session_minutes is None:
        start = F.col("day").cast("timestamp")
        windows = days.withColumns({"_a": start, "_b": start + F.expr("INTERVAL 1439 MINUTES")})
    else:
        windows = days.join(session_minutes.select("day", F.col("first_minute").alias("_a"),
                                                   F.col("last_minute").alias("_b")), "day")
    short = windows.select("symbol", "day", F.greatest("_a", F.date_trunc("minute", "_lo")).alias("_a"),
                           F.least("_b", "_hi").alias("_b")).where(F.col("_a") <= F.col("_b"))
    if session_minutes is None:
        per_day = have.groupBy("symbol", "day").agg(F.count(F.lit(1)).alias("_n"))
        expected = F.floor((F.unix_seconds("_b") - F.unix_seconds("_a")) / 60) + 1
        short = short.join(per_day, ["symbol", "day"], "left").where(F.coalesce("_n", F.lit(0)) < expected)
    minutes = short.select("symbol", F.explode(F.sequence("_a", "_b", F.expr("INTERVAL 1 MINUTE"))).alias("timestamp"))
    return minutes.join(have.select("symbol", "timestamp"), ["symbol", "timestamp"], "left_anti") \
        .select("symbol", F.col("timestamp").alias("missing_minute"))


def missing_minute_ranges(bars: DataFrame, session_minutes: DataFrame | None = None) -> DataFrame:
    """JN-5 at minute scale as intervals: (symbol, first_missing, last_missing, minutes),
    the stretches between the first and the last bar of each symbol that hold no bar.

    What lies between a bar and the next is one interval, however long; no minute is
    ever expanded. With ``session_minutes`` (see ``missing_minutes``) it is cut to the
    sessions it meets, one piece each, found by its days: a gap costs a row per day that
    it spans, not per minute."""
    minutes = bars.select("symbol", F.date_trunc("minute", "timestamp").alias("timestamp")).distinct()
    step = F.expr("INTERVAL 1 MINUTE")
    gaps = with_previous(minutes, bucket="day").where(F.col("timestamp") > F.col("prev_ts") + step).select(
        "symbol", (F.col("prev_ts") + step).alias("_lo"), (F.col("timestamp") - step).alias("_hi"))
    first, last = F.col("_lo"), F.col("_hi")
    if session_minutes is not None:
        # A session may begin on the eve of its day, or end after it.
        days = F.sequence(F.date_sub(F.to_date("_lo"), 1), F.date_add(F.to_date("_hi"), 1))
        gaps = gaps.select("*", F.explode(days).alias("day")).join(session_minutes.select("day", "first_minute", "last_minute"), "day")
        first, last = F.greatest("_lo", "first_minute"), F.least("_hi", "last_minute")
    count = F.floor((F.unix_seconds("last_missing") - F.unix_seconds("first_missing")) / 60) + 1
    return gaps.select("symbol", first.alias("first_missing"), last.alias("last_missing")) \
        .where(F.col("first_missing") <= F.col("last_missing")).withColumn("minutes", count.cast("bigint"))


def missing_minutes_by_day(ranges: DataFrame) -> DataFrame:
    """(symbol, day, minutes) of ``missing_minute_ranges``, a range that spans days cut at midnight."""
    days = ranges.select("*", F.explode(F.sequence(F.to_date("first_missing"), F.to_date("last_missing"))).alias("day"))
    first = F.greatest("first_missing", F.col("day").cast("timestamp"))
    last = F.least("last_missing", F.date_add("day", 1).cast("timestamp") - F.expr("INTERVAL 1 MINUTE"))
    return days.groupBy("symbol", "day").agg(F.sum(F.floor((F.unix_seconds(last) - F.unix_seconds(first)) / 60) + 1).alias("minutes"))


def unlisted_sessions(bars: DataFrame, bar_day: Column, sessions: DataFrame, session_minutes: DataFrame) -> DataFrame:
    """(symbol, sessions, first_day): per symbol, sessions between its first and
    its last bar day for which ``session_minutes`` has no row, so that their
    minutes cannot be checked."""
    unlisted = sessions.select(F.col("session_date").alias("day")).join(
        session_minutes.select("day").distinct(), "day", "left_anti")
    span = bars.groupBy("symbol").agg(F.min(bar_day).alias("_lo"), F.max(bar_day).alias("_hi"))
    days = span.where("_lo IS NOT NULL").select("symbol", F.explode(F.sequence("_lo", "_hi")).alias("day"))
    return days.join(unlisted, "day").groupBy("symbol").agg(F.count(F.lit(1)).alias("sessions"), F.min("day").alias("first_day"))


def gap_ranges(missing: DataFrame, sessions: DataFrame, key: str = "symbol") -> DataFrame:
    """WN-4: consecutive missing sessions compressed into [first, last] ranges.

    Islands by ordinal: ordinal minus its rank is constant within a run.
    ``missing`` may carry the session ``ordinal`` already (``missing_sessions(...,
    with_ordinal=True)``); otherwise it is looked up on the calendar."""
    if "ordinal" in missing.columns:
        m = missing
    else:
        ords = sessions.select(F.col("session_date").alias("missing_date"), "ordinal")
        m = missing.join(F.broadcast(ords), "missing_date")
    # One row per series and missing day, so the window is bounded by the calendar's days.
    g = m.withColumn("_grp", F.col("ordinal") - F.row_number().over(Window.partitionBy(key).orderBy("ordinal")))
    return g.groupBy(key, "_grp").agg(
        F.min("missing_date").alias("first_missing"), F.max("missing_date").alias("last_missing"),
        F.count(F.lit(1)).alias("sessions")).drop("_grp")


# ------------------------------------------------------------ row checks --

def ohlc_ok(prefix: str = "") -> Column:
    """True, or false where a price is null or breaks low <= open, close <= high."""
    o, h, lo, c = (F.col(prefix + n) for n in ("open", "high", "low", "close"))
    return F.coalesce((lo <= o) & (o <= h) & (lo <= c) & (c <= h) & (lo <= h), F.lit(False))


def ohlc_violations(bars: DataFrame) -> DataFrame:
    """V-2: bars breaking low <= open, close <= high, with the failed rule; a
    null price is one too (the drop policy removes exactly these rows)."""
    o, h, lo, c = (F.col(n) for n in ("open", "high", "low", "close"))
    some_null = o.isNull() | h.isNull() | lo.isNull() | c.isNull()
    rule = (F.when(some_null, F.lit("null price"))
            .when(lo > h, F.lit("low>high")).when(o > h, F.lit("open>high"))
            .when(o < lo, F.lit("open<low")).when(c > h, F.lit("close>high"))
            .when(c < lo, F.lit("close<low")))
    return bars.where(~ohlc_ok()).withColumn("rule", rule)


def apply_ohlc_policy(bars: DataFrame, policy: str = "warn") -> DataFrame:
    """drop: filter violating bars; warn: keep them; fail: raise if any exists."""
    if policy == "drop":
        return bars.where(ohlc_ok())
    if policy == "fail":
        n = bars.agg(F.count_if(~ohlc_ok())).first()[0]
        if n:
            raise ValueError(f"{n} bars violate OHLC sanity")
    elif policy != "warn":
        raise ValueError(f"unknown OHLC policy {policy!r}")
    return bars


def null_report(bars: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """V-7: null count per canonical column (one pass, partial aggregate)."""
    aggs = [F.count(F.lit(1)).alias("rows")] + [
        F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in BAR_COLUMNS]
    return bars.groupBy(*group).agg(*aggs)


REQUIRED = ["timestamp", "open", "high", "low", "close", "volume"]


def type_audit(raw: DataFrame, expected: dict[str, str], group: Sequence[str] = ()) -> DataFrame:
    """V-1: per column, non-null raw text that does not parse as its type."""
    rows = []
    for name, dtype in expected.items():
        bad = F.col(name).isNotNull() & F.expr(f"try_cast(`{name}` AS {dtype})").isNull()
        rows.append(F.struct(F.lit(name).alias("column"), F.lit(dtype).alias("expected_type"),
                             bad.alias("bad"), F.col(name).isNull().alias("missing")))
    x = raw.select(*group, F.explode(F.array(*rows)).alias("_c"))
    return x.groupBy(*group, "_c.column", "_c.expected_type").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("_c.bad").alias("violations"),
        F.count_if("_c.missing").alias("nulls"))


def column_presence(raw: DataFrame, columns: list[str], group: list[str]) -> DataFrame:
    """V-1 (schema drift): per group (e.g. landed file or symbol) and column,
    rows, nulls and whether the column is absent altogether (null in every
    row, as when a field is never sent). One partial aggregation."""
    rows = [F.struct(F.lit(c).alias("column"), F.col(c).isNull().alias("is_null")) for c in columns]
    x = raw.select(*group, F.explode(F.array(*rows)).alias("_c"))
    out = x.groupBy(*group, "_c.column").agg(F.count(F.lit(1)).alias("rows"),
                                             F.count_if("_c.is_null").alias("nulls"))
    return out.withColumn("missing", F.col("rows") == F.col("nulls"))


# ---------------------------------------------------------------- footers --

DRIFT = "file string, column string, found string, expected string, issue string, rows long"
# Parquet column types that hold each canonical type without loss.
FOOTER_TYPES = {"timestamp": {"timestamp"}, "string": {"string"}, "double": {"double"}, "int": {"int32"}, "boolean": {"bool"}}


def _footer_type(kind, physical: str | None) -> str:
    import pyarrow.types as pt
    if physical == "INT96":  # Spark's own form of a timestamp
        return "timestamp"
    if pt.is_dictionary(kind):
        kind = kind.value_type
    if pt.is_timestamp(kind):
        return "timestamp" if kind.unit != "ns" else "timestamp[ns]"
    return "string" if pt.is_large_string(kind) else str(kind)


def footer_drift(files: DataFrame, expected: dict[str, str]) -> DataFrame:
    """V-1 on stored files: (file, column, found, expected, issue, rows) for every column
    that a Parquet file lacks, has in excess or with another type, and for a file whose
    footer cannot be read.

    ``files`` (path) is dealt over tasks; a task opens its files' footers only, no row
    group is read. ``expected`` maps columns to Spark types."""
    def read(batches):
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs
        names = [f.split(" ")[0] for f in DRIFT.split(", ")]
        for batch in batches:
            out = []
            for path in batch.column(0).to_pylist():
                try:
                    where, name = fs.FileSystem.from_uri(path.replace(" ", "%20"))
                    with where.open_input_file(name) as f:
                        footer = pq.ParquetFile(f)
                        columns = [footer.metadata.schema.column(i) for i in range(footer.metadata.num_columns)]
                        stored = {c.path: c.physical_type for c in columns}
                        found = {c.name: _footer_type(c.type, stored.get(c.name)) for c in footer.schema_arrow}
                        rows = footer.metadata.num_rows
                except Exception as error:  # noqa: BLE001  an unreadable file is a finding
                    out.append((path, None, None, None, f"unreadable: {type(error).__name__}", None))
                    continue
                for c, kind in expected.items():
                    if c not in found:
                        out.append((path, c, None, kind, "missing", rows))
                    elif found[c] not in FOOTER_TYPES[kind]:
                        out.append((path, c, found[c], kind, "type", rows))
                out += [(path, c, found[c], None, "extra", rows) for c in found if c not in expected]
            kinds = {"rows": pa.int64()}
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kinds.get(n, pa.string())) for i, n in enumerate(names)], names)

    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("path").repartition(n).mapInArrow(read, DRIFT)
