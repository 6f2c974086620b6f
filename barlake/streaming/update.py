"""The incremental update as Structured Streaming jobs (ST-1..ST-5).

``run_update``: the landing folder is a file stream; ``trigger(availableNow)``
processes whatever landed since the last run and stops. Each micro-batch goes
through the same core as the batch backfill (``plans.backfill.ingest``): bars up
to the last complete day only, dispositions, merge, state and run log. A batch
replayed after a crash (same ``batch_id``, same files) changes nothing, and a
second run on the same day finds no new files: a no-op. The stream reads a file
once, so what a batch cannot store yet waits in the pending table, and a later update
admits it when its day is complete, even if nothing more has landed.

``update_all``: ``run_update`` for every table that the manifest knows, then the newly
fetched corporate actions; a table that fails does not stop the others.

``tumbling_bars``: ticks to closed bars in append mode. The watermark on trade
time is the completeness horizon: a bar is emitted only once no more trades
for it can arrive; re-sent trades are dropped within the watermark, and the
keep-first merge guards the lake beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.profiles import PROFILES
from barlake.functions.time import exchange_date
from barlake.operators import calendar as C
from barlake.operators import planning as P
from barlake.operators.bars import order_key
from barlake.operators.dedupe import KEEP_FIRST
from barlake.plans import actions, backfill, store
from barlake.sources.landing import LANDED, LANDING, no_landing, with_attempts


def horizon(spark: SparkSession, asset_class: str, now: str) -> str:
    """Last complete day of an asset class at ``now`` (UTC): the last session
    before today, by the exchange's date where the asset class trades on one."""
    profile = PROFILES.get(asset_class)
    stamp = F.lit(now).cast("timestamp")
    today = exchange_date(stamp) if profile and profile.exchange_dates else F.to_date(stamp)
    day = spark.range(1).select(today.alias("d")).first()["d"].isoformat()
    return C.last_complete_day(spark, day, profile.calendar if profile else C.CONTINUOUS)


def run_update(spark: SparkSession, landing_path: str, root: str, checkpoint: str, *,
               asset_class: str, timeframe: str, now: str, max_files_per_batch: int | None = None,
               duplicates: str = KEEP_FIRST, ohlc: str = "warn", validate: bool = True) -> int:
    """Process all newly landed files once; returns the number of micro-batches
    that had rows (pending bars admitted without any count as one). All new files are
    one batch unless ``max_files_per_batch`` is set; the policies are those of ``ingest``,
    and inline validation is on.

    A failed authentication stores nothing of its batch and is raised when the stream
    has stopped: the batch is done with, its good bars wait for the next update."""
    target_end = horizon(spark, asset_class, now)
    batches: list[int] = []
    fatal: list[backfill.FatalFetchError] = []

    def admit(landing: DataFrame, name: object) -> None:
        own = landing.sparkSession
        waiting = backfill.read_pending(own, root, asset_class, timeframe).select("symbol")
        plan = landing.select("symbol").unionByName(waiting).distinct().select(
            "symbol", F.lit(None).cast("date").alias("from_date"), F.lit(target_end).cast("date").alias("to_date"),
            F.lit(P.FETCH).alias("action"))
        try:
            backfill.ingest(own, root, plan, landing, asset_class=asset_class, timeframe=timeframe,
                            run_id=f"update-{asset_class}-{timeframe}-{now}-{name}", now=now, command="update",
                            duplicates=duplicates, ohlc=ohlc, hold_on_abort=True, validate=validate)
        except backfill.FatalFetchError as error:
            fatal.append(error)

    def each(batch: DataFrame, batch_id: int) -> None:
        landing = batch.persist()
        try:
            if not landing.isEmpty():
                admit(landing, batch_id)
                batches.append(batch_id)
        finally:
            landing.unpersist()

    stream = (spark.readStream.schema(LANDING)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt"))
    if max_files_per_batch is not None:
        stream = stream.option("maxFilesPerTrigger", max_files_per_batch)
    q = (with_attempts(stream.json(landing_path)).writeStream.trigger(availableNow=True)
         .option("checkpointLocation", checkpoint).foreachBatch(each).start())
    q.awaitTermination()
    if not batches:
        day = backfill.bar_date(asset_class, timeframe, F.timestamp_millis("t"))
        due = backfill.read_pending(spark, root, asset_class, timeframe).where(
            (day <= F.lit(target_end).cast("date")) & ~backfill.provisional(asset_class, timeframe, F.col("t"), F.col(LANDED)))
        if not due.isEmpty():
            admit(no_landing(spark), "pending")
            batches.append(-1)
    if fatal:
        raise fatal[0]
    return len(batches)


class UpdateError(RuntimeError):
    """Some tables failed; ``done`` has the others."""

    def __init__(self, failed: dict[tuple[str, str], Exception], done: dict[tuple[str, str], int]):
        super().__init__("; ".join(f"{a}/{t}: {str(e).splitlines()[0]}" for (a, t), e in failed.items()))
        self.failed, self.done = failed, done


def update_all(spark: SparkSession, landing_root: str, root: str, checkpoint_root: str, *, now: str,
               corporate_actions: dict[str, DataFrame] | None = None, **policies) -> dict[tuple[str, str], int]:
    """Update every (asset class, timeframe) of the manifest from its landing
    folder ``{landing_root}/{asset_class}/{timeframe}``; tables without one are
    skipped. Returns the batches of each (a handful of tables). A table that fails
    leaves its row in the run log; the others are updated first, then ``UpdateError``
    names it. ``corporate_actions`` are newly fetched rows by table (splits, dividends),
    merged into the stored tables after the bars (``actions.refresh``); such a table is
    ("actions", its name) in the result, with its new version."""
    tables = store.read_manifest(spark, root).select("asset_class", "timeframe").distinct().collect()
    done: dict[tuple[str, str], int] = {}
    failed: dict[tuple[str, str], Exception] = {}
    for asset_class, timeframe in sorted((r["asset_class"], r["timeframe"]) for r in tables):
        landing = f"{landing_root.rstrip('/')}/{asset_class}/{timeframe}"
        if not store.path_exists(spark, landing):
            continue
        try:
            done[asset_class, timeframe] = run_update(
                spark, landing, root, f"{checkpoint_root.rstrip('/')}/{asset_class}-{timeframe}",
                asset_class=asset_class, timeframe=timeframe, now=now, **policies)
        except Exception as error:  # noqa: BLE001  one asset class never stops the others
            failed[asset_class, timeframe] = error
    for name, rows in (corporate_actions or {}).items():
        try:
            done["actions", name] = actions.refresh(spark, root, name, rows, now=now)
        except Exception as error:  # noqa: BLE001
            failed["actions", name] = error
    if failed:
        raise UpdateError(failed, done)
    return done


def tumbling_bars(ticks: DataFrame, *, width: str = "1 minute", watermark: str = "10 minutes",
                  order_col: str = "seq") -> DataFrame:
    """Streaming ticks (symbol, ts, seq, price, size) -> one bar per closed window.

    ``min_by``/``max_by`` on (ts, seq) give open and close (the same
    ordering key as the batch bars); sums are exact when price/size are decimals."""
    key = order_key("ts", [order_col])
    dedup = ticks.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(["symbol", order_col])
    agg = dedup.groupBy(F.window("ts", width).alias("w"), "symbol").agg(
        F.min_by("price", key).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
        F.max_by("price", key).alias("close"), F.sum("size").alias("_v"),
        F.sum(F.col("price") * F.col("size")).alias("_pv"), F.count(F.lit(1)).alias("_n"))
    return agg.select(
        F.col("w.start").alias("timestamp"), "symbol",
        F.col("open").cast("double").alias("open"), F.col("high").cast("double").alias("high"),
        F.col("low").cast("double").alias("low"), F.col("close").cast("double").alias("close"),
        F.col("_v").cast("double").alias("volume"),
        F.when(F.col("_v") != 0, F.col("_pv").cast("double") / F.col("_v").cast("double")).alias("vwap"),
        F.col("_n").cast("int").alias("transactions"), F.lit(None).cast("boolean").alias("otc"))


def run_tumbling_bars(spark: SparkSession, ticks_path: str, schema, out_path: str, checkpoint: str, *,
                      state_partitions: int | None = None, **kw) -> None:
    """Parquet tick files -> appended closed bars (availableNow).

    ``state_partitions`` fixes the number of state-store partitions of a new
    checkpoint (it cannot change afterwards); by default the session's
    parallelism, not the batch shuffle setting."""
    n = state_partitions or spark.sparkContext.defaultParallelism
    previous = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        ticks = spark.readStream.schema(schema).parquet(ticks_path)
        q = (tumbling_bars(ticks, **kw).writeStream.outputMode("append").format("parquet")
             .option("path", out_path).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", previous)
    q.awaitTermination()
