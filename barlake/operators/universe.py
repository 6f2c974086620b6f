"""Instrument universes and reference-data freshness (PRJ-7..11, SE-1..4,
RF-1..4, JN-11, JN-12, AG-5, AG-6, SRC-11).

A universe is a table (ticker, source, generated_at). A universe taken from
today's index membership carries survivorship bias; point-in-time membership
(``universe_at``) is the cure when the membership history is available.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlake.functions.tickers import is_blank_ticker, normalize_ticker, parse_symbol_list
from barlake.functions.time import whole_days_between
from barlake.operators.joins import interval_join

MIN_CONSTITUENT_ROWS = 50
OK, WARN, STALE, MISSING = "OK", "WARN", "STALE", "MISSING"


def select_constituents(cells: DataFrame, ticker_col: str, min_rows: int = MIN_CONSTITUENT_ROWS) -> DataFrame:
    """PRJ-10: per page, the first table (by table_no) whose headers are all
    flat, that has the exact ``ticker_col`` column and at least ``min_rows`` rows."""
    t = cells.groupBy("page", "table_no").agg(
        F.count_distinct("row_no").alias("n_rows"),
        F.bool_or(F.col("col_name") == ticker_col).alias("_has"),
        F.bool_and(F.col("is_flat")).alias("_flat"))
    ok = t.where(F.col("_has") & F.col("_flat") & (F.col("n_rows") >= min_rows))
    return ok.groupBy("page").agg(F.min_by(F.struct("table_no", "n_rows"), "table_no").alias("_t")) \
        .select("page", "_t.table_no", "_t.n_rows")


def extract_tickers(cells: DataFrame, selected: DataFrame, ticker_col: str) -> DataFrame:
    """PRJ-9: normalised tickers of the selected tables; blank, null and 'nan'
    cells dropped; duplicates kept."""
    c = cells.where(F.col("col_name") == ticker_col) \
        .join(selected.select("page", "table_no"), ["page", "table_no"], "left_semi")
    return c.where(~is_blank_ticker(F.col("value"))).select(
        "page", "row_no", normalize_ticker(F.col("value")).alias("ticker"))


def scrape_outcome(cells: DataFrame, selected: DataFrame, tickers: DataFrame | None = None,
                   expected: DataFrame | None = None) -> DataFrame:
    """Pages that failed: without a matching table (the page was restructured),
    and, with ``tickers``, without any ticker extracted. ``expected`` (page) are the
    pages that were asked for: one that returned no cells at all fails too."""
    pages = cells.select("page").distinct()
    if expected is not None:
        pages = pages.unionByName(expected.select("page")).distinct()
    good = selected.select("page")
    if tickers is not None:
        good = good.join(tickers.select("page").distinct(), "page", "left_semi")
    return pages.join(good, "page", "left_anti")


def build_snapshot(tickers: DataFrame, source: str | Column, generated_at: str | Column) -> DataFrame:
    """RF-1: distinct tickers with one source and one stamp on every row."""
    src = F.lit(source) if isinstance(source, str) else source
    gen = F.lit(generated_at).cast("timestamp") if isinstance(generated_at, str) else generated_at
    return tickers.select("ticker").distinct().select("ticker", src.alias("source"), gen.alias("generated_at"))


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """WN-8: rows of the newest vintage (max generated_at)."""
    newest = snapshots.agg(F.max("generated_at").alias("generated_at"))
    return snapshots.join(F.broadcast(newest), "generated_at").select("ticker", "source", "generated_at")


def with_fallback(primary: DataFrame, primary_failures: DataFrame, frozen: DataFrame) -> DataFrame:
    """RF-2: the primary snapshot if it has rows and no failures, else the
    frozen one with its own vintage (never re-stamped). Both empty -> empty.

    Candidates and failure markers are tagged with their rank and reduced in
    one small aggregate; the winner is picked by an equi-join on the rank.
    Nothing is collected."""
    cand = primary.withColumn("_rank", F.lit(0)).unionByName(frozen.withColumn("_rank", F.lit(1)))
    tags = cand.select("_rank", F.lit(0).alias("_fail")).unionByName(
        primary_failures.select(F.lit(0).alias("_rank"), F.lit(1).alias("_fail")))
    stats = tags.groupBy("_rank").agg(F.count_if(F.col("_fail") == 0).alias("_n"),
                                      F.count_if(F.col("_fail") == 1).alias("_f"))
    winner = stats.where((F.col("_n") > 0) & (F.col("_f") == 0)).agg(F.min("_rank").alias("_rank"))
    return cand.join(F.broadcast(winner), "_rank").drop("_rank")


def freshness_flag(age_days: Column, ok_days: Column | int, stale_days: Column | int) -> Column:
    """OK <= ok_days < WARN <= stale_days < STALE; no stamp -> STALE; a stamp
    in the future -> WARN."""
    okc = F.lit(ok_days) if isinstance(ok_days, int) else ok_days
    stc = F.lit(stale_days) if isinstance(stale_days, int) else stale_days
    return (F.when(age_days.isNull(), F.lit(STALE)).when(age_days < 0, F.lit(WARN))
            .when(age_days <= okc, F.lit(OK)).when(age_days <= stc, F.lit(WARN))
            .otherwise(F.lit(STALE)))


def universe_freshness(snapshot: DataFrame, as_of: str, refresh_days: int = 7,
                       group: list[str] | None = None) -> DataFrame:
    """AG-5: newest stamp, row count, whole-day age and flag (2x for STALE)."""
    group = group or []
    agg = snapshot.groupBy(*group).agg(F.max("generated_at").alias("generated_at"),
                                       F.count(F.lit(1)).alias("tickers"))
    age = whole_days_between(F.col("generated_at"), F.lit(as_of).cast("timestamp"))
    return agg.select(*group, "generated_at", "tickers", age.alias("age_days"),
                      F.when(F.col("tickers") == 0, F.lit(MISSING))
                      .otherwise(freshness_flag(age, refresh_days, 2 * refresh_days)).alias("flag"))


def freshness_report(datasets: DataFrame, thresholds: DataFrame, as_of: str) -> DataFrame:
    """AG-6/RF-4: datasets (dataset, rows, last_refreshed) x thresholds
    (dataset, ok_days, stale_days) -> flag and whether to refresh."""
    j = datasets.join(thresholds, "dataset", "left")
    age = whole_days_between(F.col("last_refreshed"), F.lit(as_of).cast("timestamp"))
    flag = F.when(F.coalesce(F.col("rows"), F.lit(0)) == 0, F.lit(MISSING)) \
        .otherwise(freshness_flag(age, F.col("ok_days"), F.col("stale_days")))
    return j.select("dataset", "rows", "last_refreshed", age.alias("age_days"), "ok_days", "stale_days",
                    flag.alias("flag"), (flag != OK).alias("refresh"))


def universe_at(membership: DataFrame, as_of: str) -> DataFrame:
    """JN-11: members on ``as_of`` of half-open intervals [added, removed)."""
    d = F.lit(as_of).cast("date")
    return membership.where((F.col("added_date") <= d) &
                            (F.col("removed_date").isNull() | (d < F.col("removed_date")))) \
        .select("index", "ticker")


def _replayed(current: DataFrame, changes: DataFrame) -> DataFrame:
    """Each change with the state after it as later knowledge has it, newest first: the
    newest change meets today's membership, every other one the change that follows it.
    Today's members without any change have one row of null change."""
    key = ["index", "ticker"]
    now = current.select(*key).distinct().withColumn("_now", F.lit(True))
    log = changes.select(*key, "date", "change").distinct()
    rows = log.join(now, key, "full")
    # On one day a removal comes before an addition (a member that left and came back).
    newer = Window.partitionBy(*key).orderBy("date", F.col("change") == "added")
    following = F.lead("change").over(newer)
    return rows.select(
        *key, "date", "change", F.lead("date").over(newer).alias("_next"), F.lag("change").over(newer).isNull().alias("_oldest"),
        F.when(following.isNotNull(), following == "removed").otherwise(F.coalesce("_now", F.lit(False))).alias("_member_after"))


def membership_from_changes(current: DataFrame, changes: DataFrame, since: str = "1900-01-01") -> DataFrame:
    """JN-11/SE-4: (index, ticker, added_date, removed_date) from today's members and a log
    of dated changes (index, ticker, date, change: added or removed), replayed backwards.

    Before an addition a ticker was no member, before a removal it was one: so every
    stretch between two changes is decided by the newer of them, the last one by today's
    members. A stretch that began before the log starts at ``since``. Where the log
    contradicts itself the newer knowledge stands (see ``change_contradictions``). The
    window holds one ticker's changes."""
    r = _replayed(current, changes)
    after = r.where("_member_after").select(
        "index", "ticker", F.coalesce("date", F.lit(since).cast("date")).alias("added_date"), F.col("_next").alias("removed_date"))
    before = r.where("_oldest AND change = 'removed'").select(
        "index", "ticker", F.lit(since).cast("date").alias("added_date"), F.col("date").alias("removed_date"))
    return after.unionByName(before).where(F.col("removed_date").isNull() | (F.col("added_date") < F.col("removed_date")))


def change_contradictions(current: DataFrame, changes: DataFrame) -> DataFrame:
    """(index, ticker, date, change, reason): changes that what follows them denies."""
    r = _replayed(current, changes).where(F.col("change").isNotNull() & (F.col("_member_after") != (F.col("change") == "added")))
    follows = F.when(F.col("_next").isNull(), F.lit("today")).otherwise(F.concat(F.lit("from "), F.col("_next").cast("string")))
    return r.select("index", "ticker", "date", "change", F.concat(
        F.when(F.col("change") == "added", F.lit("added, but no member ")).otherwise(F.lit("removed, but a member ")), follows).alias("reason"))


def bars_in_membership(bars: DataFrame, membership: DataFrame, day: Column | None = None) -> DataFrame:
    """JN-11: bars on dates their symbol belonged to an index. ``day`` is the date a bar
    counts for (by default its UTC date; minute bars of an exchange pass the exchange's date)."""
    m = membership.select(F.col("ticker").alias("symbol"), "index",
                          F.col("added_date").alias("valid_from"), F.col("removed_date").alias("valid_to"))
    j = interval_join(bars, m, ["symbol"], F.to_date("timestamp") if day is None else day, how="inner")
    return j.drop("valid_from", "valid_to")


def universe_coverage(universe: DataFrame, bars: DataFrame) -> DataFrame:
    """JN-12: members without bars and bar symbols outside the universe."""
    u = universe.select("ticker").distinct()
    b = bars.select(F.col("symbol").alias("ticker")).distinct()
    return u.join(b, "ticker", "left_anti").withColumn("issue", F.lit("no_bars")) \
        .unionByName(b.join(u, "ticker", "left_anti").withColumn("issue", F.lit("not_in_universe")))


def universe_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """SE-4: tickers added and removed between two snapshots."""
    o = old.select(F.col("ticker").alias("_o")).distinct()
    n = new.select(F.col("ticker").alias("_n")).distinct()
    j = o.join(n, F.col("_o") == F.col("_n"), "full")
    return j.where(F.col("_o").isNull() | F.col("_n").isNull()).select(
        F.coalesce("_n", "_o").alias("ticker"),
        F.when(F.col("_o").isNull(), F.lit("added")).otherwise(F.lit("removed")).alias("change"))


def freeze(snapshot: DataFrame, indexes: list[str], chunk_size: int = 10_000) -> DataFrame:
    """SRC-11: the frozen document form (generated_at, source,
    indexes_included, tickers[]). The number of documents follows the number of
    tickers of a vintage (about ``chunk_size`` each, dealt by hash), so no
    document holds an unbounded universe."""
    vintage = ["generated_at", "source"]
    counts = snapshot.groupBy(*vintage).agg(F.count(F.lit(1)).alias("_n"))
    chunks = F.ceil(F.col("_n") / chunk_size)
    dealt = snapshot.join(counts, vintage).withColumn("chunk", F.pmod(F.xxhash64("ticker"), chunks).cast("int"))
    return dealt.groupBy(*vintage, "chunk").agg(
        F.array_sort(F.collect_list("ticker")).alias("tickers")
    ).select("generated_at", "source", F.array(*[F.lit(i) for i in indexes]).alias("indexes_included"),
             "chunk", "tickers")


def thaw(doc: DataFrame) -> DataFrame:
    """Frozen documents back to snapshot rows."""
    return doc.select(F.explode("tickers").alias("ticker"), "source", "generated_at")


def parse_lists(lists: DataFrame, id_cols: list[str], col: str = "list") -> DataFrame:
    """PRJ-11: one row per parsed symbol with its first-seen position."""
    return lists.select(*id_cols, F.posexplode(parse_symbol_list(F.col(col))).alias("pos", "symbol"))


