"""Query catalogue: every operator of the lake run on inputs derived from the
supplied tables. Each entry is ``(spark, sf_dir) -> DataFrame`` and has a
matching DuckDB statement in ``barlake.plans.oracle`` unless noted.

Parameters that the reference takes from the clock (today, yesterday) are
literals here, so results are repeatable.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.operators import bars as B
from barlake.operators import dedupe as D
from barlake.operators import normalize as N
from barlake.operators import state as S
from barlake.sources import tables as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# ---------------------------------------------------------------- inputs --

def crypto_daily(spark, d):
    return B.ticks_to_bars(T.crypto_ticks(spark, d), 1, "day", order_cols=T.CRYPTO_ORDER)


def crypto_minute(spark, d):
    return B.ticks_to_bars(T.crypto_ticks(spark, d), 1, "minute", order_cols=T.CRYPTO_ORDER)


def stock_daily(spark, d):
    return B.ticks_to_bars(T.stock_ticks(spark, d), 1, "day", order_cols=T.STOCK_ORDER)


def user_daily(spark, d):
    return B.ticks_to_bars(T.user_ticks(spark, d), 1, "day", order_cols=T.CRYPTO_ORDER)


# ------------------------------------------------------------ bars (AG-8) --

@query
def ticks_to_daily_bars(spark, d):
    return crypto_daily(spark, d)


@query
def ticks_to_minute_bars(spark, d):
    return crypto_minute(spark, d)


@query
def stock_ticks_to_daily_bars(spark, d):
    return stock_daily(spark, d)


@query
def resample_bars(spark, d):
    """AG-9: crypto minute bars -> 4-hour bars."""
    return B.resample_bars(crypto_minute(spark, d), 4, "hour")


@query
def resample_weekly_bars(spark, d):
    """AG-9: stock daily bars -> calendar-week bars."""
    return B.resample_bars(stock_daily(spark, d), 1, "week")


# --------------------------------------------------------- normalise (PRJ) --

@query
def normalize_bars(spark, d):
    """PRJ-1/2/4/5: wire records (ms epoch) -> canonical ten columns."""
    return N.normalize_raw(N.to_raw(crypto_daily(spark, d)))


@query
def flatfile_normalize(spark, d):
    """SRC-12/PRJ-3: flat files (gzip csv with a header; O,C,H,L column order,
    ns epoch), read back by column NAME and normalised to the canonical schema.
    The provider ships one file per day; here a few files per month hold the
    same rows, so the check does not time thousands of tiny files."""
    from barlake.sources.landing import read_flat_files
    path = scratch_path(spark, "flat")
    flat = N.to_flat_file(stock_daily(spark, d)).withColumn(
        "month", F.date_format(F.timestamp_micros(F.expr("window_start div 1000")), "yyyy-MM"))
    # A few files per month, dealt by symbol as well: no task holds a whole month.
    flat.repartition("month", F.pmod(F.xxhash64("ticker"), F.lit(4))).write.partitionBy("month").option("header", "true") \
        .option("compression", "gzip").csv(path)
    return N.normalize_flat_file(read_flat_files(spark, path))


# ------------------------------------------------------ dedupe (WN-1/2) --

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey"]


def _lines(spark, d):
    return T.read(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity",
        "l_extendedprice")


@query
def dedupe_keep_first(spark, d):
    return D.keep_one(_lines(spark, d), LINE_KEY, LINE_ORDER, D.KEEP_FIRST)


@query
def dedupe_keep_last(spark, d):
    return D.keep_one(_lines(spark, d), LINE_KEY, LINE_ORDER, D.KEEP_LAST)


@query
def duplicate_report(spark, d):
    return D.duplicate_report(_lines(spark, d), LINE_KEY)


# ----------------------------------------------------------- state (AG-1) --

def lake_bars(spark, d):
    """The lake: crypto minute bars and stock daily bars with their series key."""
    crypto = crypto_minute(spark, d).withColumns({"asset_class": F.lit("crypto"), "timeframe": F.lit("minute")})
    stocks = stock_daily(spark, d).withColumns({"asset_class": F.lit("stocks"), "timeframe": F.lit("daily")})
    return crypto.unionByName(stocks)


@query
def series_state(spark, d):
    return S.series_state(lake_bars(spark, d))


# -------------------------------------------------------- calendar (CAL) --

from barlake.operators import calendar as C  # noqa: E402

BAR_COUNT_TOLERANCE = 1


def stock_days(spark, d):
    return C.days_spanning(T.read(spark, d, "lineitem"), "l_shipdate")


def stock_calendar(spark, d):
    """(sessions, dense calendar) over the stock bars' span, built once."""
    return C.build_calendar(stock_days(spark, d))


def stock_sessions(spark, d):
    return stock_calendar(spark, d)[0]


@query
def holiday_calendar(spark, d):
    """CAL-1: exchange holidays over the span of the stock bars."""
    return C.holidays(stock_days(spark, d))


@query
def session_calendar(spark, d):
    """CAL-1: sessions with ordinal, previous and next session."""
    return stock_sessions(spark, d)


@query
def session_snap(spark, d):
    """JN-6/JN-7: each stock bar's day snapped to the sessions around it."""
    dense = stock_calendar(spark, d)[1].select("day", "is_session", "session_on_or_before",
                                               "session_on_or_after")
    bars = stock_daily(spark, d).select("symbol", F.to_date("timestamp").alias("day"))
    return bars.join(F.broadcast(dense), "day", "left")


@query
def target_end(spark, d):
    """JN-8: for every order date taken as 'today', the last complete session."""
    orders = T.read(spark, d, "orders").select(F.to_date("o_orderdate").alias("today")).distinct()
    days = C.days_spanning(orders, "today", pad_before=10)
    dense = C.build_calendar(days)[1]
    return C.target_end(orders, "today", dense)


def stock_state(spark, d):
    return S.series_state(stock_daily(spark, d), asset_class="stocks", timeframe="daily")


@query
def session_count(spark, d):
    """AG-7: sessions between each stock series' first and last bar."""
    sess, dense = stock_calendar(spark, d)
    ranges = stock_state(spark, d).select("symbol", "earliest_date", "last_complete_date")
    return C.session_count(ranges, dense, sess, "earliest_date", "last_complete_date")


@query
def bar_count_check(spark, d):
    """AG-12: bar count vs expected sessions (within one bar); the first bar must
    be that of the first session on or after the requested start (the first day of
    the table), which shows a start that the source clamped."""
    sess, dense = stock_calendar(spark, d)
    state = stock_state(spark, d).select("symbol", "earliest_date", "last_complete_date", "bar_count")
    counted = C.session_count(state, dense, sess, "earliest_date", "last_complete_date")
    first = dense.select(F.col("day").alias("earliest_date"), "session_on_or_after")
    out = counted.join(F.broadcast(first), "earliest_date", "left")
    requested = sess.agg(F.min("session_date").alias("d")).first()["d"]  # one date
    diff = F.col("bar_count") - F.col("sessions")
    return out.select(
        "symbol", "bar_count", "sessions", diff.alias("diff"),
        (F.abs(diff) <= BAR_COUNT_TOLERANCE).alias("within_tolerance"),
        (F.col("earliest_date") == F.col("session_on_or_after")).alias("starts_on_session"),
        (F.col("earliest_date") == F.lit(requested)).alias("starts_as_requested"))


@query
def session_filter(spark, d):
    """PRJ-14: minute bars classified by New York session; closed hours dropped."""
    bars = C.classify_sessions(crypto_minute(spark, d))
    return bars.where(F.col("session") != "closed")


SESSION_CLASSES = ["pre", "regular", "after", "closed"]


@query
def session_counts(spark, d):
    """AG-13: bars per symbol and New York date by session class (conditional
    counts: one partial aggregation instead of a two-stage pivot)."""
    bars = C.classify_sessions(crypto_minute(spark, d))
    s = F.col("session")
    counts = [F.count_if(s == c).alias(c) for c in SESSION_CLASSES]
    return bars.groupBy("symbol", "session_date").agg(*counts, F.count(F.lit(1)).alias("total"))


# ------------------------------------------- manifest, plan, outcome (JN/AG) --

from barlake.operators import planning as P  # noqa: E402
from barlake.session import pin  # noqa: E402

# Fixed parameters of the planning scenario.
MANIFEST_CUT_BASE = "1999-07-01"    # a supplier's state reaches up to this date ...
MANIFEST_CUT_STEP_DAYS = 15         # ... plus this many days per nation key
MANIFEST_MAX_NATION = 22            # suppliers of nations from here on were never fetched
STOCKS_DEFAULT_START = "1995-01-01"
STOCKS_TARGET_END = "2000-01-31"
MANIFEST_STAMP = "1999-12-31 23:00:00"
UPSERT_STAMP = "2000-02-01 06:00:00"


def stock_universe(spark, d):
    return T.stock_symbols(spark, d).select(F.lit("stocks").alias("asset_class"), "symbol")


def manifest(spark, d):
    """State recorded by earlier runs: each supplier's bars up to a nation-dependent cut."""
    sup = T.stock_symbols(spark, d).where(F.col("s_nationkey") < MANIFEST_MAX_NATION).select(
        "symbol", F.date_add(F.lit(MANIFEST_CUT_BASE).cast("date"),
                             F.col("s_nationkey") * MANIFEST_CUT_STEP_DAYS).alias("_cut"))
    bars = stock_daily(spark, d).join(sup, "symbol") \
        .where(F.to_date("timestamp") < F.col("_cut")).drop("_cut")
    st = S.series_state(bars, asset_class="stocks", timeframe="daily")
    return st.select("asset_class", "symbol", "timeframe", "earliest_date", "last_complete_date",
                     F.lit(MANIFEST_STAMP).cast("timestamp").alias("last_updated_at"), "bar_count")


def stock_plan(spark, d):
    return P.fetch_plan(stock_universe(spark, d), manifest(spark, d), timeframe="daily",
                        default_start=STOCKS_DEFAULT_START, target_end=STOCKS_TARGET_END)


def landed(spark, d, plan=None):
    """What the fetch returned: ticks inside each planned window; suppliers with a
    negative balance answer with an error instead."""
    plan = plan if plan is not None else stock_plan(spark, d)
    win = plan.where(F.col("action") == P.FETCH).select("symbol", "from_date", "to_date")
    ticks = T.stock_ticks(spark, d)
    got = ticks.join(win, "symbol") \
        .where(F.to_date("ts").between(F.col("from_date"), F.col("to_date")))
    bad = T.stock_symbols(spark, d).select("symbol", (F.col("s_acctbal") < 0).alias("_bad"))
    return got.join(bad, "symbol", "left").withColumn(
        "_error", F.when(F.col("_bad"), F.lit("bad request"))).drop("_bad")


def scenario(spark, d):
    """The planning scenario: plan (pinned: it feeds several branches), landed rows and
    dispositions (lazy)."""
    plan = pin(stock_plan(spark, d))
    lnd = landed(spark, d, plan)
    return {"plan": plan, "landed": lnd, "disp": P.dispositions(plan, lnd, error_col="_error")}


@query
def fetch_plan(spark, d):
    """JN-1: universe x manifest -> per-symbol window or up to date."""
    return stock_plan(spark, d)


@query
def source_dispositions(spark, d):
    """SRC-2/JN-2: per planned symbol succeeded / error / zero_bar."""
    return scenario(spark, d)["disp"]


@query
def zero_bar_symbols(spark, d):
    """JN-2: planned symbols that returned no bars."""
    sc = scenario(spark, d)
    return P.zero_bar_symbols(sc["plan"], sc["landed"])


@query
def run_outcome(spark, d):
    """AG-3: counts by disposition and the exit code."""
    sc = scenario(spark, d)
    return P.run_outcome(sc["disp"], sc["plan"].where(F.col("action") == P.UP_TO_DATE))


def upserted_manifest(spark, d, sc=None):
    sc = sc or scenario(spark, d)
    ok = sc["disp"].where(F.col("disposition") == P.SUCCEEDED).select("symbol")
    bars = stock_daily(spark, d).where(F.to_date("timestamp") <= F.lit(STOCKS_TARGET_END).cast("date"))
    new_state = S.series_state(bars.join(ok, "symbol", "left_semi"), asset_class="stocks", timeframe="daily")
    return S.manifest_upsert(manifest(spark, d), new_state, UPSERT_STAMP)


@query
def manifest_upsert(spark, d):
    """AG-2: state of the succeeded symbols replaces their rows; others stay."""
    return upserted_manifest(spark, d)


@query
def tracked_series(spark, d):
    """AG-4: number of tracked series and emptiness."""
    return S.tracked_series(upserted_manifest(spark, d))


# --------------------------------------------------- merge and layout (SRC) --

MERGE_STORED_BEFORE = "2000-01-01"
MERGE_NEW_FROM = "1999-10-01"


def refetched_stock_daily(spark, d):
    """A later fetch of the same series: prices net of discount, so re-sent bars
    differ from the stored ones."""
    li = T.read(spark, d, "lineitem")
    ticks = li.select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        "l_orderkey", "l_linenumber", "l_partkey",
        (F.col("l_extendedprice").cast(T.PRICE_DECIMAL) * (1 - F.col("l_discount").cast(T.PRICE_DECIMAL)))
        .alias("price"),
        F.col("l_quantity").cast("bigint").alias("size"))
    return B.ticks_to_bars(ticks, 1, "day", order_cols=T.STOCK_ORDER)


def merged_bars(spark, d):
    stored = stock_daily(spark, d).where(F.col("timestamp") < F.lit(MERGE_STORED_BEFORE).cast("timestamp"))
    new = refetched_stock_daily(spark, d).where(F.col("timestamp") >= F.lit(MERGE_NEW_FROM).cast("timestamp"))
    return S.merge_append(stored, new)


@query
def merge_append_bars(spark, d):
    """SRC-6: stored bars plus a re-fetch that overlaps them; stored rows win."""
    return merged_bars(spark, d)


@query
def year_partition_counts(spark, d):
    """SRC-7/AG-14: rows, symbols and time range per year partition of the merge."""
    m = merged_bars(spark, d).withColumn("year", F.year("timestamp"))
    return m.groupBy("year").agg(F.count(F.lit(1)).alias("bars"),
                                 F.countDistinct("symbol").alias("symbols"),
                                 F.min("timestamp").alias("first_ts"),
                                 F.max("timestamp").alias("last_ts"))


WINDOW_FROM, WINDOW_TO = "1997-03-01", "1997-05-31"


@query
def bars_date_window(spark, d):
    """PRJ-12/SO-2: bars with date in [from, to] (inclusive), newest first."""
    # The window stands on the stored column, below the aggregate: it reaches the scan.
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in (WINDOW_FROM, WINDOW_TO))
    ticks = T.stock_ticks(spark, d, (F.col("l_shipdate") >= lo) & (F.col("l_shipdate") < hi + F.expr("INTERVAL 1 DAY")))
    return B.ticks_to_bars(ticks, 1, "day", order_cols=T.STOCK_ORDER).orderBy(F.col("timestamp").desc(), "symbol")


RAW_FROM, RAW_TO = "2024-01-05", "2024-01-20"


@query
def raw_bar_scan(spark, d):
    """SRC-1: wire records of all symbols whose bar date is in [from, to], read
    back from landed JSON files (one folder per symbol) in one scan."""
    from barlake.schemas import RAW_BAR
    from barlake.sources.landing import read_landing, write_landing
    landing = scratch_path(spark, "landing")
    write_landing(N.to_raw(crypto_daily(spark, d)), landing)
    raw = read_landing(spark, landing).select(*RAW_BAR.fieldNames())
    lo = F.unix_millis(F.lit(RAW_FROM).cast("timestamp"))
    hi = F.unix_millis(F.date_add(F.lit(RAW_TO).cast("date"), 1).cast("timestamp"))
    return raw.where((F.col("t") >= lo) & (F.col("t") < hi))


HYBRID_FLAT_BEFORE = "2000-01-01"
HYBRID_REST_FROM = "1999-07-01"


@query
def hybrid_source_merge(spark, d):
    """SRC-14: flat-file history and REST increments in one canonical table;
    where both have a bar the flat file (rank 0) wins."""
    flat = N.normalize_flat_file(N.to_flat_file(
        stock_daily(spark, d).where(F.col("timestamp") < F.lit(HYBRID_FLAT_BEFORE).cast("timestamp"))))
    rest = N.normalize_raw(N.to_raw(
        refetched_stock_daily(spark, d).where(F.col("timestamp") >= F.lit(HYBRID_REST_FROM).cast("timestamp"))))
    both = flat.withColumn("source", F.lit("flat")).withColumn("_rank", F.lit(0)) \
        .unionByName(rest.withColumn("source", F.lit("rest")).withColumn("_rank", F.lit(1)))
    return D.keep_one(both, ["symbol", "timestamp"], ["_rank"]).drop("_rank")


@query
def symbol_recluster(spark, d):
    """SRC-13: date-clustered rows re-laid out by (symbol, timestamp) ranges."""
    b = stock_daily(spark, d)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return b.repartitionByRange(n, "symbol", "timestamp").sortWithinPartitions("symbol", "timestamp")


# ------------------------------------------------------------ validation --

from barlake.operators import validation as V  # noqa: E402

COVERAGE_MAX_SESSIONS = 1   # V-5: last_complete_date at most this many sessions behind


@query
def bar_steps(spark, d):
    """WN-3: seconds since the previous minute bar of the same symbol."""
    return V.bar_steps(crypto_minute(spark, d), bucket="day")


@query
def monotonic_check(spark, d):
    """WN-6: stock trades per symbol whose time does not strictly increase."""
    return V.monotonic_check(T.stock_ticks(spark, d), ts="ts")


def user_bar_days(spark, d):
    return user_daily(spark, d).select("symbol", F.to_date("timestamp").alias("day"))


def user_calendar(spark, d):
    days = C.days_spanning(T.read(spark, d, "events"), "ts")
    return C.build_calendar(days, C.CONTINUOUS)


@query
def daily_gaps_24x7(spark, d):
    """JN-5: days without a bar inside each 24x7 series (per-user series)."""
    sess, dense = user_calendar(spark, d)
    return V.missing_sessions(user_bar_days(spark, d), sess, dense)


def stock_missing(spark, d, with_ordinal=False):
    sess, dense = stock_calendar(spark, d)
    bar_days = stock_daily(spark, d).select("symbol", F.to_date("timestamp").alias("day"))
    return V.missing_sessions(bar_days, sess, dense, with_ordinal=with_ordinal), sess


@query
def daily_gaps_sessions(spark, d):
    """JN-5: exchange sessions without a bar inside each stock series."""
    return stock_missing(spark, d)[0]


@query
def gap_ranges(spark, d):
    """WN-4: missing sessions of each stock series as contiguous ranges."""
    missing, sess = stock_missing(spark, d, with_ordinal=True)
    return V.gap_ranges(missing, sess)


def misread_flat_file(spark, d):
    """Flat-file rows read by position (O,H,L,C) instead of by name (O,C,H,L)."""
    flat = N.to_flat_file(stock_daily(spark, d))
    return flat.select(
        F.col("window_start"), F.col("ticker").alias("symbol"), F.col("open"),
        F.col("close").alias("high"), F.col("high").alias("low"), F.col("low").alias("close"),
        "volume", "transactions")


@query
def ohlc_violations(spark, d):
    """V-2: bars of a positional flat-file read that break OHLC sanity."""
    return V.ohlc_violations(misread_flat_file(spark, d))


@query
def ohlc_dropped(spark, d):
    """V-2 drop policy: the bars of that read that pass."""
    return V.apply_ohlc_policy(misread_flat_file(spark, d), "drop")


@query
def null_report(spark, d):
    """V-7: nulls per canonical column by source of the hybrid table."""
    return V.null_report(QUERIES["hybrid_source_merge"](spark, d), ["source"])


def raw_landing_text(spark, d):
    """Landed records as text; error events land with a non-numeric price."""
    ev = T.read(spark, d, "events")
    return ev.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
        F.col("ts").cast("string").alias("ts"),
        F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("price"),
        F.get_json_object("props", "$.k").alias("size"))


@query
def type_violations(spark, d):
    """V-1: per column, raw values that do not parse as the expected type."""
    return V.type_audit(raw_landing_text(spark, d),
                        {"ts": "timestamp", "price": "decimal(18,2)", "size": "bigint"})


@query
def coverage_check(spark, d):
    """V-5: series whose last complete date is more than N sessions behind."""
    m = upserted_manifest(spark, d)
    sess, dense = stock_calendar(spark, d)
    le = dense.select(F.col("day").alias("_day"), F.col("sessions_le").cast("int").alias("_le"))
    # Sessions up to the as-of day: one number, used as a parameter.
    now_le = le.where(F.col("_day") == F.lit(STOCKS_TARGET_END).cast("date")).first()["_le"]
    j = m.join(F.broadcast(le), F.col("last_complete_date") == F.col("_day"), "left")
    behind = (F.lit(now_le) - F.col("_le")).cast("bigint")
    return j.select("asset_class", "symbol", "timeframe", "last_complete_date",
                    behind.alias("sessions_behind"),
                    (behind <= COVERAGE_MAX_SESSIONS).alias("covered"))


@query
def zero_bar_open_market(spark, d):
    """V-6: zero-bar symbols whose window held at least one open session."""
    sc = scenario(spark, d)
    zero = P.zero_bar_symbols(sc["plan"], sc["landed"])
    sess, dense = stock_calendar(spark, d)
    counted = C.session_count(zero, dense, sess, "from_date", "to_date")
    return counted.where(F.col("sessions") > 0).withColumn("severity", F.lit("warn"))


# ---------------------------------------------------- corporate actions --

from barlake.operators import adjust as A  # noqa: E402

SPLITS_STORED_BEFORE = "1997-01-01"
DIVIDENDS_STORED_DATE = "1997-03-14"


@query
def split_adjusted_bars(spark, d):
    """JN-9/WN-5/CA-3: stock bars adjusted for all later splits."""
    return A.split_adjust(stock_daily(spark, d), T.splits(spark, d))


@query
def dividend_adjusted_bars(spark, d):
    """JN-10: split- and dividend-adjusted bars (prices rounded to 6 dp)."""
    out = A.dividend_adjust(stock_daily(spark, d), T.dividends(spark, d), T.splits(spark, d))
    return out.withColumns({c: F.round(c, 6) for c in A.PRICE_COLUMNS + ["dividend_factor"]})


@query
def splits_merge(spark, d):
    """CA-1: stored splits plus a re-fetch that omits the ratio; stored rows win."""
    sp = T.splits(spark, d)
    stored = sp.where(F.col("execution_date") < F.lit(SPLITS_STORED_BEFORE).cast("date"))
    new = sp.withColumn("ratio", F.lit(None).cast("double"))
    return A.merge_splits(stored, new)


@query
def dividends_merge(spark, d):
    """CA-2: stored dividends plus a re-fetch with later pay dates; stored rows win."""
    dv = T.dividends(spark, d)
    stored = dv.where(F.col("ex_dividend_date") == F.lit(DIVIDENDS_STORED_DATE).cast("date"))
    new = dv.withColumn("pay_date", F.date_add("pay_date", 1))
    return A.merge_dividends(stored, new)


# ------------------------------------------------------------- universe --

from barlake.functions.tickers import crypto_ticker as _crypto_ticker  # noqa: E402
from barlake.operators import universe as U  # noqa: E402

TICKER_COL = "Symbol"
PRIMARY_STAMP = "2024-02-01 00:00:00"
VINTAGE_1 = "2024-01-01 00:00:00"
VINTAGE_2 = "2024-01-08 12:00:00"
FRESHNESS_AS_OF = "2024-02-01 00:00:00"
MEMBERSHIP_AS_OF = "1997-06-30"
FREEZE_CHUNK = 50


@query
def crypto_tickers(spark, d):
    """PRJ-7: X:{BASE}{QUOTE} for every traded base."""
    ev = T.read(spark, d, "events").select(F.upper("event_type").alias("base")).distinct()
    return ev.select("base", _crypto_ticker(F.col("base")).alias("ticker"))


@query
def normalize_tickers(spark, d):
    """PRJ-8: every raw constituent cell -> canonical ticker (strip, upper, dash to dot)."""
    cells = T.constituent_cells(spark, d)
    return cells.select("page", "table_no", "row_no", "col_name", F.col("value").alias("raw"),
                        U.normalize_ticker(F.col("value")).alias("ticker"),
                        (~U.is_blank_ticker(F.col("value"))).alias("is_ticker"))


@query
def select_constituents(spark, d):
    """PRJ-10: constituents table per page by column signature."""
    return U.select_constituents(T.constituent_cells(spark, d), TICKER_COL)


def _scraped(spark, d, ticker_col, cells=None):
    cells = cells if cells is not None else T.constituent_cells(spark, d)
    sel = U.select_constituents(cells, ticker_col)
    return U.extract_tickers(cells, sel, ticker_col), U.scrape_outcome(cells, sel)


@query
def extract_tickers(spark, d):
    """PRJ-9: tickers of the selected tables (blank/nan dropped, duplicates kept)."""
    return _scraped(spark, d, TICKER_COL)[0]


def index_a(spark, d):
    return T.index_lists(spark, d).where(F.col("index") == "IDXA").select("ticker")


def index_b(spark, d):
    return T.index_lists(spark, d).where(F.col("index") == "IDXB").select("ticker")


@query
def universe_union(spark, d):
    """SE-2/SO-3: distinct union of the index lists, sorted."""
    return index_a(spark, d).union(index_b(spark, d)).distinct().orderBy("ticker")


@query
def universe_overlap(spark, d):
    """SE-3: tickers in both lists."""
    return index_a(spark, d).intersect(index_b(spark, d))


@query
def universe_adds(spark, d):
    """SE-3: tickers the second list adds to the first."""
    return index_b(spark, d).subtract(index_a(spark, d))


@query
def universe_diff(spark, d):
    """SE-4: change log between two snapshots (first list -> second list)."""
    return U.universe_diff(index_a(spark, d), index_b(spark, d))


def snapshots(spark, d):
    v1 = U.build_snapshot(index_a(spark, d), "scrape", VINTAGE_1)
    v2 = U.build_snapshot(index_a(spark, d).union(index_b(spark, d)), "scrape", VINTAGE_2)
    return v1.unionByName(v2)


@query
def universe_snapshot(spark, d):
    """RF-1/SRC-5/WN-8: the newest of the stored snapshot vintages."""
    return U.latest_snapshot(snapshots(spark, d))


def frozen(spark, d):
    return U.build_snapshot(index_a(spark, d).union(index_b(spark, d)), "frozen", VINTAGE_2)


def fallback(spark, d, ticker_col, cells=None):
    tickers, failures = _scraped(spark, d, ticker_col, cells)
    primary = U.build_snapshot(tickers, "scrape", PRIMARY_STAMP)
    return U.with_fallback(primary, failures, frozen(spark, d))


@query
def universe_with_fallback(spark, d):
    """RF-2: the scrape succeeds on every page, so its snapshot is used."""
    return fallback(spark, d, TICKER_COL)


@query
def universe_fallback_vintage(spark, d):
    """RF-2: pages restructured (no 'Ticker' column anywhere) -> frozen list, old stamp kept."""
    return fallback(spark, d, "Ticker")


@query
def universe_freshness(spark, d):
    """AG-5: age and flag of the scraped and the frozen snapshot."""
    cells = pin(T.constituent_cells(spark, d))
    both = fallback(spark, d, TICKER_COL, cells).unionByName(fallback(spark, d, "Ticker", cells))
    return U.universe_freshness(both, FRESHNESS_AS_OF, 7, ["source"])


from barlake.plans.report import REFERENCE_THRESHOLDS as FRESHNESS_THRESHOLDS  # noqa: E402
REPORT_AS_OF = "2001-12-01 00:00:00"


@query
def freshness_report(spark, d):
    """AG-6/RF-4: one row per reference dataset with its own thresholds."""
    uni = fallback(spark, d, TICKER_COL).agg(F.lit("stocks_universe").alias("dataset"),
                                             F.count(F.lit(1)).alias("rows"),
                                             F.max("generated_at").alias("last_refreshed"))
    fut = T.futures_contracts(spark, d).agg(F.lit("futures_contracts").alias("dataset"),
                                            F.count(F.lit(1)).alias("rows"),
                                            F.max("discovered_at").alias("last_refreshed"))
    cal = stock_sessions(spark, d).agg(F.lit("market_calendar").alias("dataset"),
                                       F.count(F.lit(1)).alias("rows"),
                                       F.max("session_date").cast("timestamp").alias("last_refreshed"))
    spl = T.splits(spark, d).agg(F.lit("splits").alias("dataset"), F.count(F.lit(1)).alias("rows"),
                                 F.max("execution_date").cast("timestamp").alias("last_refreshed"))
    div = T.dividends(spark, d).agg(F.lit("dividends").alias("dataset"), F.count(F.lit(1)).alias("rows"),
                                    F.max("declaration_date").cast("timestamp").alias("last_refreshed"))
    datasets = uni.unionByName(fut).unionByName(cal).unionByName(spl).unionByName(div)
    thresholds = spark.createDataFrame(FRESHNESS_THRESHOLDS, "dataset string, ok_days int, stale_days int")
    return U.freshness_report(datasets, thresholds, REPORT_AS_OF)


@query
def universe_at(spark, d):
    """JN-11: point-in-time members of the index on a date."""
    return U.universe_at(T.membership(spark, d), MEMBERSHIP_AS_OF)


@query
def bars_in_membership(spark, d):
    """JN-11: stock bars restricted to the dates their symbol was a member."""
    return U.bars_in_membership(stock_daily(spark, d), T.membership(spark, d))


@query
def universe_coverage(spark, d):
    """JN-12: members without bars and bar symbols outside the universe."""
    uni = index_a(spark, d).union(index_b(spark, d))
    return U.universe_coverage(uni, stock_daily(spark, d))


@query
def universe_freeze_roundtrip(spark, d):
    """SRC-11: snapshot -> frozen documents (hash-chunked arrays) -> rows."""
    doc = U.freeze(frozen(spark, d), ["IDXA", "IDXB"], FREEZE_CHUNK)
    return U.thaw(doc)


@query
def parse_symbol_list(spark, d):
    """PRJ-11: per order, a watch list string of its suppliers (messy forms,
    empties, repeats) parsed back to ordered unique symbols."""
    li = T.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    sym = F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))
    item = F.when(F.col("l_linenumber") % 2 == 1, F.concat(F.lit(" "), sym, F.lit(" "))) \
        .otherwise(F.concat(F.upper(sym), F.lit(",")))
    lists = li.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", item.alias("item")))).alias("_items"))
    lists = lists.select("l_orderkey", F.concat_ws(",", F.transform("_items", lambda x: x["item"])).alias("list"))
    return U.parse_lists(lists, ["l_orderkey"])


# -------------------------------------------------------------- futures --

from barlake.operators import futures as FU  # noqa: E402

FUTURES_START = "1996-01-01"
FUTURES_TODAY = "2001-07-01"
FUTURES_STATE_BEFORE = "1999-01-01"


def futures_daily(spark, d):
    return B.ticks_to_bars(T.futures_ticks(spark, d), 1, "day", order_cols=T.STOCK_ORDER)


@query
def futures_contracts(spark, d):
    """FU-1: the contract table derived from the contracts' trades."""
    return T.futures_contracts(spark, d)


@query
def futures_fetch_plan(spark, d):
    """PRJ-16/17/FU-2: eligible contracts, clipped windows, resumed from state."""
    state = S.series_state(
        futures_daily(spark, d).where(F.col("timestamp") < F.lit(FUTURES_STATE_BEFORE).cast("timestamp")),
        asset_class="futures", timeframe="daily")
    return FU.contract_plan(T.futures_contracts(spark, d), state, start=FUTURES_START, today=FUTURES_TODAY)


@query
def continuous_calendar(spark, d):
    """WN-7: continuous series rolled on expiry (nearest traded contract)."""
    return FU.continuous(futures_daily(spark, d), T.futures_contracts(spark, d), FU.CALENDAR)


@query
def continuous_volume(spark, d):
    """WN-7: continuous series rolled on volume leadership, forward only."""
    return FU.continuous(futures_daily(spark, d), T.futures_contracts(spark, d), FU.VOLUME)


# ------------------------------------------------------ status and runs --

STATUS_STAMPS = {"crypto": "2024-01-31 01:00:00", "stocks": "2001-11-05 01:00:00"}
RECENT_RUNS = 5


def lake_manifest(spark, d):
    st = S.series_state(lake_bars(spark, d))
    stamp = F.when(F.col("asset_class") == "crypto", F.lit(STATUS_STAMPS["crypto"])) \
        .otherwise(F.lit(STATUS_STAMPS["stocks"])).cast("timestamp")
    return st.withColumn("last_updated_at", stamp)


@query
def status_summary(spark, d):
    """AG-10: per asset class and timeframe, with rollup totals."""
    return S.status_summary(lake_manifest(spark, d)).drop("disk_bytes")


def run_log(spark, d):
    """Run log: one update run per event day; users with an error event failed."""
    ev = T.read(spark, d, "events").select(F.to_date("ts").alias("day"), F.col("ts").cast("timestamp").alias("ts"),
                                           "user_id", "event_type")
    err = F.col("event_type") == "error"
    g = ev.groupBy("day").agg(
        F.min("ts").alias("started_at"), F.max("ts").alias("finished_at"),
        F.countDistinct("user_id").alias("_att"),
        F.countDistinct(F.when(err, F.col("user_id"))).alias("_bad"),
        F.count_if(~err).alias("_bars"))
    ok = F.col("_att") - F.col("_bad")
    status = F.when(ok == F.col("_att"), F.lit("success")).when(ok == 0, F.lit("failed")) \
        .otherwise(F.lit("partial"))
    return g.select(
        F.concat(F.lit("run-"), F.date_format("day", "yyyyMMdd")).alias("run_id"),
        "started_at", "finished_at", F.lit("update").alias("command"), status.alias("status"),
        F.when(F.col("_bad") > 0, F.concat(F.col("_bad").cast("string"), F.lit(" symbols failed")))
        .alias("error_message"),
        F.col("_att").cast("int").alias("symbols_attempted"), ok.cast("int").alias("symbols_succeeded"),
        F.col("_bars").cast("bigint").alias("bars_written"))


@query
def run_log_summary(spark, d):
    """AG-11: per run attempted, succeeded, bars written and duration."""
    r = run_log(spark, d)
    return r.select("run_id", "status", "symbols_attempted", "symbols_succeeded", "bars_written",
                    F.floor((F.unix_micros("finished_at") - F.unix_micros("started_at")) / 1_000_000)
                    .cast("bigint").alias("duration_seconds"))


@query
def recent_runs(spark, d):
    """SO-4: the newest runs first (top-k by start time)."""
    return run_log(spark, d).orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(RECENT_RUNS)


# ----------------------------------------------------- validation report --

def findings(spark, d):
    """Missing sessions of stock series and missing days of crypto daily series."""
    stock_missing_days = stock_missing(spark, d)[0].select(
        F.lit("stocks").alias("asset_class"), F.lit("daily").alias("timeframe"), "symbol", "missing_date")
    days = C.days_spanning(T.read(spark, d, "events"), "ts")
    sess, dense = C.build_calendar(days, C.CONTINUOUS)
    cd = crypto_daily(spark, d).select("symbol", F.to_date("timestamp").alias("day"))
    crypto_missing = V.missing_sessions(cd, sess, dense).select(
        F.lit("crypto").alias("asset_class"), F.lit("daily").alias("timeframe"), "symbol", "missing_date")
    return stock_missing_days.unionByName(crypto_missing)


def checked_series(spark, d):
    s = S.series_state(stock_daily(spark, d), asset_class="stocks", timeframe="daily")
    c = S.series_state(crypto_daily(spark, d), asset_class="crypto", timeframe="daily")
    return s.unionByName(c).select("asset_class", "timeframe", "symbol")


@query
def validation_report(spark, d):
    """V-8: per asset class and timeframe: symbols, healthy, warnings, missing sessions."""
    f = findings(spark, d).groupBy("asset_class", "timeframe", "symbol").agg(
        F.count(F.lit(1)).alias("missing"))
    j = checked_series(spark, d).join(f, ["asset_class", "timeframe", "symbol"], "left")
    return j.groupBy("asset_class", "timeframe").agg(
        F.count(F.lit(1)).alias("symbols"),
        F.count_if(F.col("missing").isNull()).alias("healthy"),
        F.count_if(F.col("missing").isNotNull()).alias("warnings"),
        F.coalesce(F.sum("missing"), F.lit(0)).cast("bigint").alias("missing_sessions"))


@query
def validation_findings(spark, d):
    """V-8 detail: per series and year, the missing dates (a bounded list)."""
    f = findings(spark, d)
    return f.groupBy("asset_class", "timeframe", "symbol", F.year("missing_date").alias("year")).agg(
        F.count(F.lit(1)).alias("missing"),
        F.concat_ws(",", F.array_sort(F.collect_list(F.date_format("missing_date", "yyyy-MM-dd"))))
        .alias("missing_dates"))


# ------------------------------------------------ lake on disk (SRC-3/4/9) --

from barlake.plans import store as ST  # noqa: E402
from barlake.session import open_files, scratch_path, small_files  # noqa: E402

SCAN_YEAR = 1998


def written_lake(spark, d):
    """Write the stock daily bars and the crypto minute bars as a lake in the
    shared folder (a new folder per call) and return its root."""
    root = scratch_path(spark, "lake")
    ST.write_bars(ST.with_layout(stock_daily(spark, d), "stocks", "daily"), root)
    ST.merge_into_lake(ST.with_layout(crypto_minute(spark, d), "crypto", "minute"), root)
    return root


@query
def bars_scan(spark, d):
    """SRC-3/SRC-4: read back one year of stock bars from the written lake
    (partition pruning on asset_class/timeframe/year)."""
    root = written_lake(spark, d)
    return ST.read_bars(spark, root, asset_class="stocks", timeframe="daily", years=[SCAN_YEAR])


@query
def bars_scan_all(spark, d):
    """SRC-3/SRC-4: read back all stock bars of the written lake."""
    return ST.read_bars(spark, written_lake(spark, d), asset_class="stocks", timeframe="daily")


@query
def storage_usage(spark, d):
    """SRC-9: files and bytes per lake partition (no SQL oracle: sizes are the
    writer's)."""
    return ST.storage_usage(spark, written_lake(spark, d))


# --------------------------------------------- profiles, coverage, stamps --

from barlake.functions.profiles import PROFILES  # noqa: E402

MINUTES_PER_DAY = 1440


@query
def profile_calendars(spark, d):
    """CAL-2/UD-1: sessions per asset class, each by its own calendar, over
    the span of the event stream."""
    days = C.days_spanning(T.read(spark, d, "events"), "ts")
    out = None
    for name, prof in sorted(PROFILES.items()):
        sess = C.sessions(days, calendar=prof.calendar)
        part = sess.agg(F.lit(name).alias("asset_class"), F.lit(prof.calendar).alias("calendar"),
                        F.count(F.lit(1)).alias("sessions"), F.min("session_date").alias("first_session"),
                        F.max("session_date").alias("last_session"))
        out = part if out is None else out.unionByName(part)
    return out


@query
def minute_coverage(spark, d):
    """JN-5 at minute scale: bars per symbol and day against the 1440 minutes
    of a 24x7 day. Counting first means no day is ever expanded to minutes."""
    b = crypto_minute(spark, d).groupBy("symbol", F.to_date("timestamp").alias("day")) \
        .agg(F.count(F.lit(1)).alias("bars"))
    return b.withColumn("missing_minutes", F.lit(MINUTES_PER_DAY) - F.col("bars"))


@query
def futures_gaps_weekdays(spark, d):
    """JN-5/CAL-2: weekdays, US holidays excluded, without a bar inside each
    futures contract's life."""
    days = C.days_spanning(T.read(spark, d, "lineitem"), "l_shipdate")
    sess, dense = C.build_calendar(days, C.US_WEEKDAYS)
    bar_days = futures_daily(spark, d).select("symbol", F.to_date("timestamp").alias("day"))
    return V.missing_sessions(bar_days, sess, dense)


from barlake.functions.time import format_iso, parse_iso  # noqa: E402


@query
def iso_stamps(spark, d):
    """PRJ-15: run stamps formatted as ISO-8601 UTC without sub-seconds, sent as text in
    four forms (``Z``, an offset, naive, no time at all) and parsed back."""
    r = run_log(spark, d).select("run_id", "started_at")
    at, form = F.col("started_at"), F.dayofmonth("started_at") % 4
    local = "yyyy-MM-dd'T'HH:mm:ss"
    sent = F.when(form == 0, format_iso(at)).when(form == 1, F.concat(F.date_format(at + F.expr("INTERVAL 330 MINUTES"), local), F.lit("+05:30"))) \
        .when(form == 2, F.date_format(at, local)).otherwise(F.concat(F.lit("at "), F.date_format(at, "HH:mm")))
    r = r.select("run_id", "started_at", sent.alias("sent"))
    back = parse_iso("sent")
    return r.select("run_id", format_iso(at).alias("started_iso"), "sent", format_iso(back).alias("parsed_iso"),
                    (back == F.date_trunc("second", "started_at")).alias("roundtrip_ok"))


# ------------------------------------------------------- streaming (ST) --

from barlake.sources.landing import write_landing as _write_landing  # noqa: E402
from barlake.streaming import update as SU  # noqa: E402

STREAM_WATERMARK = "10 minutes"


@query
def stream_update_state(spark, d):
    """ST-1/ST-5: crypto daily bars landed as wire records, ingested by the
    availableNow update stream (run twice: the second run is a no-op) into a
    new lake; the result is the recorded state."""
    landing, root, ckpt = (scratch_path(spark, n) for n in ("landing", "lake", "stream-ckpt"))
    _write_landing(N.to_raw(crypto_daily(spark, d)), landing)
    for now in ("2024-02-01 00:00:00", "2024-02-01 01:00:00"):
        SU.run_update(spark, landing, root, ckpt, asset_class="crypto", timeframe="daily", now=now)
    return ST.read_manifest(spark, root).drop("last_updated_at")


@query
def stream_minute_bars(spark, d):
    """ST-2/ST-3/ST-4: crypto trades as a file stream -> one-minute bars in
    append mode; only windows closed by the watermark (latest trade minus
    10 minutes) are emitted."""
    ticks_path, out, ckpt = (scratch_path(spark, n) for n in ("ticks", "stream-bars", "stream-ckpt"))
    ticks = T.crypto_ticks(spark, d)
    ticks.write.parquet(ticks_path)
    SU.run_tumbling_bars(spark, ticks_path, ticks.schema, out, ckpt, watermark=STREAM_WATERMARK)
    return spark.read.parquet(out)


@query
def minute_gaps_24x7(spark, d):
    """JN-5: missing minutes of the crypto minute series between its first and
    its last bar, days without any bar included."""
    return V.missing_minutes(crypto_minute(spark, d))


@query
def minute_gaps_sessions(spark, d):
    """JN-5: missing minutes of the same series within the regular New York hours
    of each NYSE session."""
    sess = C.build_calendar(C.days_spanning(T.read(spark, d, "events"), "ts"))[0]
    return V.missing_minutes(crypto_minute(spark, d), C.regular_minutes(sess))


@query
def gap_refetch_plan(spark, d):
    """JN-1 + WN-4: interior gaps of the stock series as fetch windows."""
    missing, sess = stock_missing(spark, d, with_ordinal=True)
    return P.gap_refetch_plan(V.gap_ranges(missing, sess), asset_class="stocks", timeframe="daily")


LAKE_AS_OF = "2001-11-30"


@query
def lake_validation_report(spark, d):
    """V-8 end to end: the stock bars written as a lake, state recorded, then
    the validate job (gaps by the exchange calendar, OHLC, duplicates, nulls,
    coverage against the as-of day)."""
    from barlake.plans import report as RP
    root = scratch_path(spark, "lake")
    bars = ST.with_layout(stock_daily(spark, d), "stocks", "daily")
    ST.write_bars(bars, root)
    ST.record_state(spark, root, ST.read_bars(spark, root).select("symbol").distinct(), "stocks", "daily",
                    MANIFEST_STAMP)
    return RP.validate(spark, root, as_of=LAKE_AS_OF)


@query
def landing_column_audit(spark, d):
    """V-1: landed wire records (written per symbol, read back in one scan):
    per symbol and field, rows, nulls and whether the field never arrived
    (``otc`` is omitted when false, so it is missing for crypto)."""
    from barlake.schemas import RAW_BAR
    from barlake.sources.landing import read_landing, write_landing
    landing = scratch_path(spark, "landing")
    write_landing(N.to_raw(crypto_daily(spark, d)), landing)
    fields = [c for c in RAW_BAR.fieldNames() if c != "symbol"]
    return V.column_presence(read_landing(spark, landing), fields, ["symbol"])


# ------------------------------------------- landing: attempts, ledger, pending --

from barlake.functions.time import from_epoch_ns  # noqa: E402
from barlake.plans import backfill as BF  # noqa: E402
from barlake.sources import landing as L  # noqa: E402

NOON, NEXT_DAY = "2024-01-15 12:00:00", "2024-01-16 01:00:00"


@query
def stream_pending_bars(spark, d):
    """ST-1/ST-2: minute bars up to noon of a running day land, and nothing more;
    the update at noon keeps the running day's bars waiting, the update of the next day
    admits them. The result is the lake: bars and volume of each series and day."""
    landing, root, ckpt = (scratch_path(spark, n) for n in ("landing", "lake", "stream-ckpt"))
    _write_landing(N.to_raw(crypto_minute(spark, d).where(F.col("timestamp") < F.lit(NOON).cast("timestamp"))), landing)
    for now in (NOON, NEXT_DAY, NEXT_DAY):
        SU.run_update(spark, landing, root, ckpt, asset_class="crypto", timeframe="minute", now=now)
    return ST.read_bars(spark, root).groupBy("symbol", F.to_date("timestamp").alias("day")).agg(
        F.count(F.lit(1)).alias("bars"), F.sum(F.col("volume").cast("bigint")).alias("volume"))


ATTEMPT_1, ATTEMPT_2 = 1706745600000, 1706749200000   # 2024-02-01 00:00 and 01:00 UTC
ATTEMPTS_TARGET, ATTEMPTS_NOW = "2024-01-31", "2024-02-01 06:00:00"


def _attempt_cases(spark, d):
    """Per-user daily bars as landed JSON lines of two attempts; the user decides what
    each attempt brings (see ``attempt_dispositions``)."""
    raw = N.to_raw(user_daily(spark, d)).withColumn("case", F.substr("symbol", F.lit(2)).cast("bigint") % 6)
    lines = lambda at: F.to_json(F.struct(*[F.col(c) for c in raw.columns if c not in ("symbol", "case")], F.lit(at).alias("attempt")))
    error = lambda at: F.to_json(F.struct(F.lit("bad request").alias("error"), F.lit(at).alias("attempt")))
    users = raw.select("symbol", "case").distinct()
    case = F.col("case")
    first = raw.where(case.isin(1, 2)).select("symbol", lines(ATTEMPT_1).alias("value")) \
        .unionByName(users.where(case.isin(0, 4)).select("symbol", error(ATTEMPT_1).alias("value"))) \
        .unionByName(users.where(case.isin(2, 3)).select("symbol", F.lit('{"o": 1.0, "t": broken').alias("value")))
    second = raw.where(case == 0).select("symbol", lines(ATTEMPT_2).alias("value")) \
        .unionByName(users.where(case == 1).select("symbol", error(ATTEMPT_2).alias("value")))
    return users, [first, second]


@query
def attempt_dispositions(spark, d):
    """SRC-2/AG-3: per planned symbol the disposition, bars stored and lines quarantined
    of a run over two attempts: error then bars (0), bars then error (1), bars beside a
    line that does not parse (2), such a line alone (3), an error alone (4), nothing (5)."""
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "lake")
    users, waves = _attempt_cases(spark, d)
    for wave in waves:
        L.write_lines(wave.repartition("symbol"), landing)
    universe = pin(users.select(F.lit("crypto").alias("asset_class"), "symbol"))
    plan = pin(P.fetch_plan(universe, ST.read_manifest(spark, root), timeframe="daily", default_start="2024-01-01",
                            target_end=ATTEMPTS_TARGET))
    with small_files(spark):
        tried = pin(P.attempts(L.read_landing(spark, landing)))
    BF.run(spark, root, universe, landing, asset_class="crypto", timeframe="daily", default_start="2024-01-01",
           target_end=ATTEMPTS_TARGET, run_id="attempts", now=ATTEMPTS_NOW)
    stored = ST.read_bars(spark, root).groupBy("symbol").agg(F.count(F.lit(1)).alias("rows"))
    bad = BF.read_quarantine(spark, root).groupBy("symbol").agg(F.count(F.lit(1)).alias("quarantined"))
    return P.attempt_dispositions(plan, tried, stored).join(bad, "symbol", "left").select(
        "symbol", "disposition", F.col("rows").alias("bars"), F.coalesce("quarantined", F.lit(0)).cast("bigint").alias("quarantined"))


LEDGER_CUTS = ("2024-01-10", "2024-01-20", "2024-01-31")


@query
def landing_new_files(spark, d):
    """SRC-1: three waves of landed files, one file per symbol each; a run after each
    wave, and one more. Per run the files it opened (new ones only) and the bars it stored."""
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "lake")
    bars = pin(N.to_raw(user_daily(spark, d)).withColumn("_day", F.to_date(F.timestamp_millis("t"))))
    universe = pin(bars.select(F.lit("crypto").alias("asset_class"), "symbol").distinct())
    after, runs = "0001-01-01", []
    for run_id, end in [*enumerate(LEDGER_CUTS), (len(LEDGER_CUTS), "2024-02-15")]:
        wave = bars.where((F.col("_day") > F.lit(after).cast("date")) & (F.col("_day") <= F.lit(end).cast("date"))).drop("_day")
        if run_id < len(LEDGER_CUTS):
            _write_landing(wave.repartition("symbol"), landing)
        out = BF.run(spark, root, universe, landing, asset_class="crypto", timeframe="daily", default_start="2024-01-01",
                     target_end=end, run_id=f"run-{run_id}", now="2024-03-01 00:00:00")
        runs.append((run_id, out.files_opened, out.bars_written))
        after = end
    return spark.createDataFrame(runs, "run int, files_opened bigint, bars_written bigint")


# ------------------------------------ intervals, stored order, change log, crossover --

@query
def minute_gap_ranges(spark, d):
    """JN-5/V-4: missing minutes of the crypto series within regular New York hours, as
    ranges (gap intervals cut to the sessions; no minute is expanded)."""
    sess = C.build_calendar(C.days_spanning(T.read(spark, d, "events"), "ts"))[0]
    return V.missing_minute_ranges(crypto_minute(spark, d), C.regular_minutes(sess))


@query
def minute_gap_ranges_24x7(spark, d):
    """JN-5/V-4: missing minutes of the same series around the clock, as ranges."""
    return V.missing_minute_ranges(crypto_minute(spark, d))


@query
def stored_order_check(spark, d):
    """WN-6: per-user daily bars written to lake files, every third user's in reverse
    order; rows that do not follow their predecessor in the file."""
    path = scratch_path(spark, "stored-order")
    at = F.unix_micros("timestamp")
    back = F.substr("symbol", F.lit(2)).cast("bigint") % 3 == 0
    user_daily(spark, d).repartition("symbol").sortWithinPartitions("symbol", F.when(back, -at).otherwise(at)).write.parquet(path)
    return V.stored_order_check(spark.read.parquet(path)).drop("files")


def _member_changes(spark, d):
    """Today's members and the change log of the index: every addition and removal, but
    additions of every fifth supplier and removals of every second are not logged;
    every third that left came back (2000) and every sixth left again (2001)."""
    m = T.membership(spark, d).withColumn("_k", F.substr("ticker", F.lit(2)).cast("bigint"))
    k, left = F.col("_k"), F.col("removed_date").isNotNull()
    change = lambda rows, date, what: rows.select("index", "ticker", date.cast("date").alias("date"), F.lit(what).alias("change"))
    back = m.where(left & (k % 3 == 0))
    changes = change(m.where(k % 5 != 0), F.col("added_date"), "added") \
        .unionByName(change(m.where(left & (k % 2 != 0)), F.col("removed_date"), "removed")) \
        .unionByName(change(back, F.lit("2000-06-01"), "added")) \
        .unionByName(change(back.where(k % 6 == 0), F.lit("2001-02-01"), "removed"))
    current = m.where(~left | (k % 6 == 3)).select("index", "ticker")
    return current, changes


@query
def membership_from_changes(spark, d):
    """JN-11/SE-4: membership intervals replayed from today's members and the change log."""
    return U.membership_from_changes(*_member_changes(spark, d))


@query
def change_contradictions(spark, d):
    """JN-11/SE-4: logged changes that later knowledge denies."""
    return U.change_contradictions(*_member_changes(spark, d))


@query
def universe_at_stored(spark, d):
    """JN-11: members of the index on a date, from the stored table that the replay wrote."""
    from barlake.plans import actions
    root = scratch_path(spark, "lake")
    current, changes = _member_changes(spark, d)
    actions.refresh_membership(spark, root, current, changes, now=PRIMARY_STAMP)
    return actions.get_universe_at(spark, root, "IDXM", "2000-12-31")


@query
def continuous_open_interest(spark, d):
    """WN-7/FU-3: continuous series rolled by open-interest crossover; the current contract
    stays on ties (open interest here is the volume in steps of 100, so ties abound)."""
    bars = futures_daily(spark, d).withColumn("open_interest", F.floor(F.col("volume") / 100))
    return FU.continuous_sticky(bars, T.futures_contracts(spark, d), "open_interest")


@query
def skipped_dividends(spark, d):
    """JN-10: dividends without an adjustment factor (100 times the derived cash, so that
    some exceed the close), with the reason."""
    paid = T.dividends(spark, d).withColumn("cash_amount", F.round(F.col("cash_amount") * 100_000, 2))
    return A.skipped_dividends(stock_daily(spark, d), paid)


OPEN_FILES = 16  # of a task at once


@query
def flatfile_ingest_state(spark, d):
    """SRC-12: the stock bars as gzip flat files, one per month here (every second month
    in another column order with quoted fields), ingested by the flat-file job, run twice:
    the second run opens no file. The state by day, with the lake's bars of each file."""
    from barlake.schemas import FLAT_DAYS
    root, path = scratch_path(spark, "lake"), scratch_path(spark, "flat")
    flat = N.to_flat_file(stock_daily(spark, d)).withColumn("day", F.trunc(F.to_date(from_epoch_ns("window_start")), "month"))
    odd = F.month("day") % 2 == 1
    with open_files(spark, OPEN_FILES):
        for rows, columns, quoted in ((flat.where(odd), None, False), (flat.where(~odd), ["window_start", "ticker", "high", "low", "open", "close",
                                                                                         "transactions", "volume"], True)):
            names = columns or [c for c in rows.columns if c != "day"]
            rows.select(*names, "day").repartition("day").write.mode("append").partitionBy("day") \
                .option("header", "true").option("quoteAll", str(quoted).lower()).option("compression", "gzip").csv(path)
    opened = [BF.run_flat_files(spark, root, path, asset_class="stocks", timeframe="daily", target_end="2001-12-31", run_id=f"flat-{i}",
                                now="2002-01-02 00:00:00").files_opened for i in range(2)]
    lake = ST.read_bars(spark, root).groupBy(F.trunc(F.to_date("timestamp"), "month").alias("day")).agg(F.count(F.lit(1)).alias("lake_bars"))
    return ST.read_appended(spark, root, "flat_days", FLAT_DAYS).join(lake, "day").select(
        "day", "status", "tickers", "rows", "bad", "lake_bars", F.lit(opened[1]).cast("bigint").alias("opened_again"))


@query
def futures_contract_job(spark, d):
    """FU-2: contracts stored, their daily bars landed, then the contract job run up to
    1998 and again to the end; the state of each contract."""
    from barlake.plans import actions
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "lake")
    actions.refresh(spark, root, "futures_contracts", T.futures_contracts(spark, d), now=PRIMARY_STAMP)
    _write_landing(N.to_raw(futures_daily(spark, d)), landing)
    for today in ("1999-01-01", FUTURES_TODAY):
        BF.run_contracts(spark, root, landing, timeframe="daily", start=FUTURES_START, today=today, run_id=f"futures-{today}",
                         now="2002-01-01 00:00:00")
    return ST.read_manifest(spark, root).drop("last_updated_at")


@query
def schema_drift(spark, d):
    """V-1: the stock bars as lake files, one per year, those of even years with volume as
    an integer and without vwap; what the files' footers tell (no row group is read)."""
    root = scratch_path(spark, "lake")
    bars = ST.with_layout(stock_daily(spark, d), "stocks", "daily").drop("asset_class", "timeframe")
    even = F.col("year") % 2 == 0
    path = f"{ST.bars_path(root)}/asset_class=stocks/timeframe=daily"
    with open_files(spark, OPEN_FILES):
        for part in (bars.where(~even), bars.where(even).withColumn("volume", F.col("volume").cast("long")).drop("vwap")):
            part.repartition("year").write.mode("append").partitionBy("year").parquet(path)
    return ST.schema_drift(spark, root).select("asset_class", "timeframe", "year", "column", "found", "expected", "issue", "rows")
