"""The ingest jobs: one core for the batch backfill and the streaming update.

Plan from universe and manifest, scan what landed, decide each symbol's
disposition, merge the good bars into touched partitions, then record state and
the run. A bar counts as fetched only on a date inside its symbol's planned
window (the exchange's date for minute bars of exchange-traded assets), so a day
that is not complete yet is never stored.

Nothing that landed is lost by that. Good bars after the window wait in the
``pending`` table and are admitted by the first run whose window reaches them, whether
or not anything else lands. So do provisional bars, fetched before their own interval
was over; the latest attempt of a bar replaces the one that waits. Lines that are no
bars go to the ``quarantine`` table. Per symbol the latest attempt decides: an error
counts until a good attempt follows it, and bars of a failed attempt are not taken.

Order matters for crash safety: data is committed before the pending table, that before
state, and the ledger of files comes last. State is recomputed from the stored bars,
so a run killed anywhere between is healed by simply running again (the merge is
idempotent).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barlake.functions.profiles import PROFILES
from barlake.functions.time import exchange_date
from barlake.operators import dedupe as D
from barlake.operators import futures as FU
from barlake.operators import normalize as N
from barlake.operators import planning as P
from barlake.operators import validation as V
from barlake.operators.dedupe import KEEP_FIRST
from barlake.plans import report, store
from barlake.schemas import BAR_COLUMNS, BAR_KEY, FLAT_DAYS, FUTURES_CONTRACTS, INGEST_FINDINGS, LANDING_FILES, PENDING, QUARANTINE, RUN_LOG
from barlake.session import pin, small_files
from barlake.sources import landing as L


class MissingUniverseError(RuntimeError):
    """The universe is absent or empty: never ingest nothing silently."""


class FatalFetchError(RuntimeError):
    """An error that affects every symbol (e.g. authentication): abort the run."""


@dataclass
class Outcome:
    attempted: int
    succeeded: int
    errors: int
    zero_bar: int
    up_to_date: int
    exit_code: int
    touched_partitions: int = 0
    bars_written: int = 0
    files_opened: int | None = None
    findings: int | None = None


def plan(spark: SparkSession, root: str, universe: DataFrame, *, timeframe: str, default_start: str,
         target_end: str, extend_head: bool = False) -> DataFrame:
    if universe.isEmpty():
        raise MissingUniverseError("the universe is missing or empty")
    return P.fetch_plan(universe, store.read_manifest(spark, root), timeframe=timeframe,
                        default_start=default_start, target_end=target_end, extend_head=extend_head)


def bar_date(asset_class: str, timeframe: str, ts: Column) -> Column:
    """Date that a bar counts for: the asset class's own rule, else the UTC date."""
    profile = PROFILES.get(asset_class)
    return profile.bar_date(ts, timeframe) if profile else F.to_date(ts)


def pending_table(asset_class: str, timeframe: str) -> str:
    return f"pending/{asset_class}-{timeframe}"


def read_pending(spark: SparkSession, root: str, asset_class: str, timeframe: str) -> DataFrame:
    """Good bars that landed and were not admitted yet."""
    return store.read_latest(spark, root, pending_table(asset_class, timeframe), PENDING)


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """Landed lines that are no bars, once each (a replayed run reports a line again)."""
    return store.read_appended(spark, root, "quarantine", QUARANTINE).distinct()


def provisional(asset_class: str, timeframe: str, t: Column, landed: Column) -> Column:
    """Whether a bar (epoch ms ``t``) was fetched before its own interval was over: on
    its own date for daily bars, within its minute for minute bars."""
    if timeframe == "daily":
        profile = PROFILES.get(asset_class)
        today = exchange_date(landed) if profile and profile.exchange_dates else F.to_date(landed)
        early = today <= bar_date(asset_class, timeframe, F.timestamp_millis(t))
    else:
        early = F.unix_millis(landed) < t + 60_000
    return F.coalesce(early, F.lit(False))


def ingest(spark: SparkSession, root: str, the_plan: DataFrame, landing: DataFrame, *, asset_class: str, timeframe: str,
           run_id: str, now: str, command: str, duplicates: str = KEEP_FIRST, ohlc: str = "warn",
           hold_on_abort: bool = False, pinned: bool = False, validate: bool = False) -> Outcome:
    """Store what landed of a plan (symbol, from_date, to_date, action); a null
    from_date is an open start. ``landing`` is a scan of ``sources.landing``; bars that
    wait in the pending table are considered with it.

    ``duplicates`` (keep_first, keep_last, fail) and ``ohlc`` (drop, warn, fail) are
    the validation policies; ``validate`` also records what the admitted rows show before
    the policies act on them (``read_findings``). Every run leaves a row in the run log, an aborted one
    too. A run that failed authentication aborts stores nothing; with ``hold_on_abort``
    (a source that is not read again) its good bars wait in the pending table. ``pinned``
    says that ``landing`` is pinned already and holds planned symbols only."""
    started = time.monotonic()

    def finish(status: str, o: Outcome, error: str | None) -> None:
        record_run(spark, root, run_id, now, time.monotonic() - started, command, status, o, error)

    try:
        # Pin the plan and the landed batch before anything is written: both are
        # derived from tables this run rewrites, and a recomputation after that
        # (lost executor, partially materialised cache) would see the new state.
        # A reliable checkpoint in the shared folder survives both. The landed batch is
        # scanned once (many small files per symbol).
        the_plan = pin(the_plan)
        fetch = the_plan.where(F.col("action") == P.FETCH)
        windows = fetch.groupBy("symbol").agg(F.collect_list(F.struct("from_date", "to_date")).alias("_windows"),
                                              F.max("to_date").alias("_last"))
        batch = landing if pinned else pin(landing.join(windows.select("symbol"), "symbol", "left_semi"))
        tried = pin(P.attempts(batch))
        fatal = P.fatal_attempt(tried).first()["message"]
        raw = PENDING.fieldNames()
        failed = tried.where("failed").select("symbol", L.FILE)
        good = L.landed_bars(batch).join(failed, ["symbol", L.FILE], "left_anti").select(*raw)
        before = read_pending(spark, root, asset_class, timeframe)
        if fatal:
            if hold_on_abort:
                hold(spark, root, before.unionByName(good), asset_class, timeframe)
            raise FatalFetchError(f"fatal fetch error: {fatal}")
        quarantine(batch, root, asset_class, timeframe)
        day = bar_date(asset_class, timeframe, F.timestamp_millis("t"))
        early = provisional(asset_class, timeframe, F.col("t"), F.col(L.LANDED))
        held_and_good = before.unionByName(good).withColumns({"_day": day, "_early": early})
        day, early = F.col("_day"), F.col("_early")  # once per row, not once per window
        inside = F.exists("_windows", lambda w: (w["from_date"].isNull() | (day >= w["from_date"])) & (day <= w["to_date"]))
        waits = (day > F.col("_last")) | (early & inside)
        marked = held_and_good.join(windows, "symbol", "left").select(
            *raw, F.coalesce(inside & ~early, F.lit(False)).alias("_admit"),
            F.coalesce(waits, F.lit(True)).alias("_wait"))  # a symbol without a plan keeps what it has
        marked = pin(marked.where("_admit OR _wait"))
        admitted = marked.where("_admit").withColumn("_rank", F.unix_micros(L.LANDED) * (1 if duplicates == D.KEEP_LAST else -1))
        bars = N.normalize_raw(admitted, keep=["_rank"])
        found = record_findings(bars, root, asset_class, timeframe, run_id, now) if validate else None
        bars = V.apply_ohlc_policy(bars, ohlc)
        # Of bars that were fetched twice the later attempt comes first, then the values decide.
        order = ["_rank", *[c for c in BAR_COLUMNS if c not in BAR_KEY]]
        merged = store.merge_into_lake(store.with_layout(bars, asset_class, timeframe, keep=["_rank"]), root, new_order=order,
                                       policy=duplicates)
        taken = pin(admitted.groupBy("symbol").agg(F.count(F.lit(1)).alias("rows")))
        waiting = marked.where("_wait")
        if not waiting.isEmpty():
            latest = marked.groupBy("symbol", "t").agg(F.max(F.struct(L.LANDED, L.FILE, F.col("_wait"))).alias("_last_try"))
            waiting = waiting.join(latest.where("_last_try._wait").select("symbol", "t"), ["symbol", "t"], "left_semi")
        hold(spark, root, waiting.select(*raw), asset_class, timeframe)
        if merged.partitions:
            store.record_state(spark, root, taken.select("symbol"), asset_class, timeframe, now, years=merged.years)
        disp = P.attempt_dispositions(the_plan, tried, taken)
        out = P.run_outcome(disp, the_plan.where(F.col("action") == P.UP_TO_DATE)).first()
    except Exception as aborted:
        finish("aborted", Outcome(0, 0, 0, 0, 0, 2), str(aborted).splitlines()[0][:1000])
        raise
    outcome = Outcome(out["attempted"], out["succeeded"], out["errors"], out["zero_bar"], out["up_to_date"],
                      out["exit_code"], len(merged.partitions), merged.bars, findings=found)
    status = "success" if outcome.exit_code == 0 else ("failed" if outcome.exit_code == 2 else "partial")
    finish(status, outcome, f"{outcome.errors} symbols failed" if outcome.errors else None)
    return outcome


def hold(spark: SparkSession, root: str, waiting: DataFrame, asset_class: str, timeframe: str) -> None:
    """Write the next version of the pending table: of each bar its latest attempt.
    A table that was empty and stays empty gets no new version."""
    name = pending_table(asset_class, timeframe)
    latest = pin(D.keep_one(waiting, ["symbol", "t"], [L.LANDED, L.FILE, *[c for c in PENDING.fieldNames() if c not in ("symbol", "t", L.LANDED, L.FILE)]],
                            D.KEEP_LAST))
    if not latest.isEmpty() or not read_pending(spark, root, asset_class, timeframe).isEmpty():
        store.write_version(latest.select(*PENDING.fieldNames()), root, name)


def quarantine(batch: DataFrame, root: str, asset_class: str, timeframe: str) -> None:
    """Append the bad lines of a landed batch to the quarantine table, as they came."""
    fields = [f for f in L.LANDING.fieldNames() if f not in (L.CORRUPT, "symbol")]
    bad = batch.where(F.col(L.BAD).isNotNull()).select(
        F.lit(asset_class).alias("asset_class"), F.lit(timeframe).alias("timeframe"), "symbol", F.col(L.BAD).alias("reason"),
        F.coalesce(F.col(L.CORRUPT), F.to_json(F.struct(*fields))).alias("record"), F.col(L.FILE).alias("file"),
        F.col(L.LANDED).alias("landed_at"))
    if not bad.isEmpty():
        bad.write.mode("append").parquet(store.table_path(root, "quarantine"))


def record_findings(bars: DataFrame, root: str, asset_class: str, timeframe: str, run_id: str, now: str) -> int:
    """Inline validation: append the row findings of a batch to the ``ingest_findings``
    table; their number is counted while they are written."""
    counted = Observation()
    found = report.row_findings(bars, asset_class, timeframe) \
        .select("*", F.lit(run_id).alias("run_id"), F.lit(now).cast("timestamp").alias("found_at")) \
        .select(*INGEST_FINDINGS.fieldNames()).observe(counted, F.count(F.lit(1)).alias("n"))
    found.write.mode("append").parquet(store.table_path(root, "ingest_findings"))
    return counted.get.get("n") or 0  # no metric where the plan turned out to be empty


def read_findings(spark: SparkSession, root: str) -> DataFrame:
    """Findings of inline validation, once each (a replayed run reports its batch again)."""
    return store.read_appended(spark, root, "ingest_findings", INGEST_FINDINGS).distinct()


def run(spark: SparkSession, root: str, universe: DataFrame, landing_path: str, *, asset_class: str,
        timeframe: str, default_start: str, target_end: str, run_id: str, now: str, extend_head: bool = False,
        refetch: DataFrame | None = None, duplicates: str = KEEP_FIRST, ohlc: str = "warn",
        dry_run: bool = False, validate: bool = False) -> Outcome | DataFrame:
    """One backfill run. ``extend_head`` also fetches history before the stored
    start; ``refetch`` adds windows of interior gaps (``planning.gap_refetch_plan``).
    ``dry_run`` returns the plan only.

    Only landed files of planned symbols are opened that no run has taken yet, or that
    were taken for a window that began later (``landing_files`` is the ledger)."""
    the_plan = plan(spark, root, universe, timeframe=timeframe, default_start=default_start,
                    target_end=target_end, extend_head=extend_head)
    if refetch is not None:
        the_plan = the_plan.unionByName(refetch.select(*the_plan.columns))
    if dry_run:
        return the_plan
    return _run_plan(spark, root, the_plan, landing_path, asset_class=asset_class, timeframe=timeframe, run_id=run_id, now=now,
                     command="backfill", duplicates=duplicates, ohlc=ohlc, validate=validate)


def run_contracts(spark: SparkSession, root: str, landing_path: str, *, timeframe: str, start: str, today: str, run_id: str,
                  now: str, duplicates: str = KEEP_FIRST, ohlc: str = "warn", dry_run: bool = False) -> Outcome | DataFrame:
    """FU-2: one backfill run over the stored futures contracts that still trade on or
    after ``start``: per contract from its first trade (or where its state ends) to its last
    trade, or the day before ``today``. Landing, ledger, pending and state are those of ``run``."""
    contracts = store.read_latest(spark, root, "futures_contracts", FUTURES_CONTRACTS)
    if contracts.isEmpty():
        raise MissingUniverseError("the table of futures contracts is missing or empty")
    windows = FU.contract_plan(contracts, store.read_manifest(spark, root), start=start, today=today, timeframe=timeframe)
    the_plan = windows.select(F.lit("futures").alias("asset_class"), F.col("ticker").alias("symbol"), F.lit(timeframe).alias("timeframe"),
                              "from_date", "to_date", "action")
    if dry_run:
        return the_plan
    return _run_plan(spark, root, the_plan, landing_path, asset_class="futures", timeframe=timeframe, run_id=run_id, now=now,
                     command="backfill", duplicates=duplicates, ohlc=ohlc)


class BackfillError(RuntimeError):
    """Some jobs failed; ``done`` has the outcomes of the others."""

    def __init__(self, failed: dict[str, Exception], done: dict[str, Outcome]):
        super().__init__("; ".join(f"{name}: {str(e).splitlines()[0]}" for name, e in failed.items()))
        self.failed, self.done = failed, done


def run_isolated(jobs: dict[str, Callable[[], Outcome]]) -> dict[str, Outcome]:
    """Run each named job (a handful, one per asset class); one that fails does not stop
    the others. ``BackfillError`` names the failed ones when all have run."""
    done: dict[str, Outcome] = {}
    failed: dict[str, Exception] = {}
    for name, job in jobs.items():
        try:
            done[name] = job()
        except Exception as error:  # noqa: BLE001
            failed[name] = error
    if failed:
        raise BackfillError(failed, done)
    return done


def _run_plan(spark: SparkSession, root: str, the_plan: DataFrame, landing_path: str, **kw) -> Outcome:
    """Open the landed files that a plan needs, ingest them and enter them in the ledger."""
    asset_class, timeframe, run_id = kw["asset_class"], kw["timeframe"], kw["run_id"]
    if not store.path_exists(spark, landing_path):  # nothing landed at all: every planned symbol is a zero-bar success
        return ingest(spark, root, the_plan, L.no_landing(spark), **kw)
    the_plan = pin(the_plan)
    own = (F.col("asset_class") == asset_class) & (F.col("timeframe") == timeframe)
    ledger = store.read_appended(spark, root, "landing_files", LANDING_FILES).where(own)
    fetch = the_plan.where(F.col("action") == P.FETCH).select("symbol", "from_date")
    with small_files(spark):
        listing = L.list_in_tasks(spark, landing_path)
        if listing is None and ledger.isEmpty():  # the first run opens all files of planned symbols: one listing, that of the scan
            landing = pin(L.read_landing(spark, landing_path).join(fetch.select("symbol").distinct(), "symbol", "left_semi"))
        else:
            listing = L.list_by_index(spark, landing_path) if listing is None else listing
            landing = L.read_chosen(spark, landing_path, pin(L.files_to_open(listing, ledger, fetch)))
    outcome = ingest(spark, root, the_plan, landing, pinned=True, **kw)
    opened = pin(L.opened_files(landing, fetch))
    outcome.files_opened = opened.count()
    if outcome.files_opened:  # last of all: a run that dies before opens the same files again
        opened.select(F.lit(asset_class).alias("asset_class"), F.lit(timeframe).alias("timeframe"), "symbol", "file", "modified",
                      "length", "from_date", F.lit(run_id).alias("run_id")) \
            .write.mode("append").parquet(store.table_path(root, "landing_files"))
    return outcome


def run_flat_files(spark: SparkSession, root: str, path: str, *, asset_class: str, timeframe: str, target_end: str, run_id: str,
                   now: str, duplicates: str = KEEP_FIRST, ohlc: str = "warn") -> Outcome:
    """SRC-12: ingest the daily flat files of a folder, each with all tickers of its day.

    State is kept by asset class and day (``flat_days``): a file is opened once, again
    only where it was rewritten, and not before its day is complete (``target_end``). The
    rows of all new files go through ``ingest`` in one pass, every ticker with an open
    window, so series state, run log, quarantine and pending bars are those of any
    other source. A file without a usable header or date is recorded with that status,
    and counts as failed in the exit code."""
    days = store.read_appended(spark, root, "flat_days", FLAT_DAYS).where(
        (F.col("asset_class") == asset_class) & (F.col("timeframe") == timeframe))
    listing = L.list_flat_files(spark, path).where(F.col("day").isNull() | (F.col("day") <= F.lit(target_end).cast("date")))
    new = pin(listing.join(days.select("path", "modified", "length"), ["path", "modified", "length"], "left_anti"))
    rows, headless = L.scan_flat_files(spark, new.where("day IS NOT NULL"))
    landing = pin(L.flat_as_landing(rows))
    the_plan = landing.select("symbol").where("symbol IS NOT NULL").distinct().select(
        "symbol", F.lit(None).cast("date").alias("from_date"), F.lit(target_end).cast("date").alias("to_date"), F.lit(P.FETCH).alias("action"))
    outcome = ingest(spark, root, the_plan, landing, asset_class=asset_class, timeframe=timeframe, run_id=run_id, now=now,
                     command="flat files", duplicates=duplicates, ohlc=ohlc, pinned=True)
    counts = landing.groupBy(F.col(L.FILE).alias("file")).agg(
        F.count_distinct("symbol").alias("tickers"), F.count(F.lit(1)).alias("rows"), F.count_if(F.col(L.BAD).isNotNull()).alias("bad"))
    status = F.when(F.col("day").isNull(), F.lit("no date in its name")) \
        .when(F.col("file").isin(headless), F.lit("no header")).otherwise(F.lit("taken"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    state = pin(new.join(counts, "file", "left").select(
        F.lit(asset_class).alias("asset_class"), F.lit(timeframe).alias("timeframe"), "day", "path", "modified", "length",
        status.alias("status"), zero("tickers"), zero("rows"), zero("bad"), F.lit(run_id).alias("run_id")))
    seen = {r["status"]: r["n"] for r in state.groupBy("status").agg(F.count(F.lit(1)).alias("n")).collect()}
    outcome.files_opened = sum(seen.values())
    if outcome.files_opened:
        state.write.mode("append").parquet(store.table_path(root, "flat_days"))
        if set(seen) != {"taken"}:
            outcome.exit_code = max(outcome.exit_code, 1 if "taken" in seen else 2)
    return outcome


def record_run(spark: SparkSession, root: str, run_id: str, now: str, seconds: float, command: str, status: str,
               o: Outcome, error: str | None) -> None:
    """Append one row to the run log; it started ``now`` and took ``seconds``."""
    row = [(run_id, None, None, command, status, error, o.attempted, o.succeeded, o.bars_written)]
    started = F.lit(now).cast("timestamp")
    df = spark.createDataFrame(row, RUN_LOG).withColumn("started_at", started) \
        .withColumn("finished_at", F.timestamp_micros(F.unix_micros(started) + F.lit(int(seconds * 1e6))))
    df.write.mode("append").parquet(store.table_path(root, "run_log"))
