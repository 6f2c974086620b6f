"""Merge-append, series state, manifest upsert and status (SRC-6, AG-1, AG-2, AG-4, AG-10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.operators.dedupe import KEEP_FIRST, keep_one
from barlake.schemas import BAR_KEY, MANIFEST_KEY, assert_same_columns

def fresh_rows(stored: DataFrame, new: DataFrame, key: Sequence[str] = BAR_KEY,
               new_order: Sequence[str | Column] = (), *, policy: str = KEEP_FIRST) -> DataFrame:
    """The rows of ``new`` whose key is not stored yet (de-duplicated by
    ``policy`` over ``new_order`` first, whose columns that are not stored are then
    left out). Stored rows are never replaced.

    The stored keys that collide are found first by a semi join with the new
    keys: where these are small in bytes the planner broadcasts them and the
    key-only scan of ``stored`` is not shuffled; where they are not, both sides
    are shuffled on the key and AQE splits a hot one. The anti join then meets
    only the collisions."""
    extra = [c for c in new_order if isinstance(c, str) and c not in stored.columns]
    assert_same_columns(stored, new.drop(*extra), "stored and new rows")
    key = list(key)
    order = list(new_order) or [c for c in new.columns if c not in key]
    new_unique = keep_one(new, key, order, policy).drop(*extra)
    collisions = stored.select(*key).join(new.select(*key), key, "left_semi")  # has the keys of new_unique, without its sort
    return new_unique.join(collisions, key, "left_anti")


def merge_append(stored: DataFrame, new: DataFrame, key: Sequence[str] = BAR_KEY,
                 new_order: Sequence[str | Column] = (), *, policy: str = KEEP_FIRST) -> DataFrame:
    """Stored rows and new rows, one row per key; stored rows are never replaced
    (``stored`` is unique per key: it is the output of earlier merges)."""
    return stored.unionByName(fresh_rows(stored, new, key, new_order, policy=policy))


def series_state(bars: DataFrame, *, asset_class: str | Column | None = None,
                 timeframe: str | Column | None = None, date_expr: Column | None = None) -> DataFrame:
    """Per series: first and last bar date and the bar count (partial aggregate).

    ``date_expr`` defaults to the UTC date of ``timestamp``; stock minute bars
    should pass the exchange date instead.
    """
    d = date_expr if date_expr is not None else F.to_date(F.col("timestamp"))
    df = bars
    if "asset_class" not in df.columns:
        df = df.withColumn("asset_class", F.lit(asset_class) if isinstance(asset_class, str) else asset_class)
    if "timeframe" not in df.columns:
        df = df.withColumn("timeframe", F.lit(timeframe) if isinstance(timeframe, str) else timeframe)
    return (df.groupBy(*MANIFEST_KEY)
            .agg(F.min(d).alias("earliest_date"), F.max(d).alias("last_complete_date"),
                 F.count(F.lit(1)).alias("bar_count")))


def manifest_upsert(manifest: DataFrame, new_state: DataFrame, updated_at: Column | str) -> DataFrame:
    """Replace the manifest rows of the given keys, keep all other rows.

    Plain Parquet has no MERGE: untouched rows (anti join) are unioned with the
    new rows and the table is rewritten. Run only after the data commit.
    """
    stamp = F.lit(updated_at).cast("timestamp") if isinstance(updated_at, str) else updated_at
    fresh = new_state.select(*MANIFEST_KEY, "earliest_date", "last_complete_date",
                             stamp.alias("last_updated_at"), F.col("bar_count").cast("bigint"))
    cols = fresh.columns
    untouched = manifest.join(fresh.select(*MANIFEST_KEY), MANIFEST_KEY, "left_anti").select(*cols)
    return untouched.unionByName(fresh)


def tracked_series(manifest: DataFrame) -> DataFrame:
    return manifest.agg(F.count(F.lit(1)).alias("tracked_series"),
                        (F.count(F.lit(1)) == 0).alias("is_empty"))


def status_summary(manifest: DataFrame, usage: DataFrame | None = None) -> DataFrame:
    """Per asset class and timeframe, with subtotals and a grand total (rollup).
    ``usage`` (asset_class, timeframe, disk_bytes) is rolled up the same way and
    attached with a null-safe join on the rollup keys."""
    agg = (manifest.rollup("asset_class", "timeframe")
           .agg(F.count(F.lit(1)).alias("symbols"),
                F.min("earliest_date").alias("oldest_date"),
                F.max("last_complete_date").alias("newest_date"),
                F.sum("bar_count").alias("bars"),
                F.max("last_updated_at").alias("last_updated_at")))
    if usage is None:
        return agg
    u = usage.rollup("asset_class", "timeframe").agg(F.sum("disk_bytes").alias("disk_bytes")) \
        .select(F.col("asset_class").alias("_a"), F.col("timeframe").alias("_t"), "disk_bytes")
    cond = F.col("asset_class").eqNullSafe(F.col("_a")) & F.col("timeframe").eqNullSafe(F.col("_t"))
    return agg.join(u, cond, "left").drop("_a", "_t")
