"""Reference-data jobs: the universe refresh (RF-1, RF-2, AG-5, SRC-5) and
explicit symbol lists (PRJ-11).

``update_universe``: if the stored snapshot is fresh (OK) and not forced,
nothing happens. Otherwise the scraped cell table is turned into a snapshot;
if any page has no matching table (or nothing is extracted), the frozen list
is used with its own vintage. The chosen snapshot is appended as the next
version of the ``universe`` table. Only one-row status values reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.tickers import parse_symbol_list
from barlake.operators import universe as U
from barlake.plans import store
from barlake.schemas import FROZEN, UNIVERSE


class UniverseUnavailable(RuntimeError):
    """The scrape failed and no frozen list exists."""


@dataclass
class UniverseUpdate:
    source: str
    tickers: int
    generated_at: object
    cached: bool = False
    used_fallback: bool = False


def read_universe(spark: SparkSession, root: str) -> DataFrame:
    return store.read_latest(spark, root, "universe", UNIVERSE)


def read_frozen(spark: SparkSession, root: str) -> DataFrame:
    """The stored frozen list as a snapshot (empty if none was written)."""
    docs = store.read_latest(spark, root, "universe_frozen", FROZEN)
    return U.thaw(docs).select(*UNIVERSE.fieldNames())


def update_universe(spark: SparkSession, root: str, cells: DataFrame, ticker_col: str,
                    frozen: DataFrame | None, *, now: str, refresh_days: int = 7,
                    force: bool = False, expected_pages: list[str] | None = None,
                    indexes: list[str] | None = None) -> UniverseUpdate:
    """Refresh the stored universe. ``expected_pages`` are the pages that were
    asked for: each must give a table and at least one ticker, else the whole
    scrape failed. A successful scrape also writes the frozen list, the fallback
    of later runs; ``frozen`` (else the stored frozen list) is used on failure."""
    if not force:
        fresh = U.universe_freshness(read_universe(spark, root), now, refresh_days).first()
        if fresh is not None and fresh["tickers"] > 0 and fresh["flag"] == U.OK:
            return UniverseUpdate("cache", fresh["tickers"], fresh["generated_at"], cached=True)
    selected = U.select_constituents(cells, ticker_col)
    tickers = U.extract_tickers(cells, selected, ticker_col)
    expected = spark.createDataFrame([(p,) for p in expected_pages], "page string") if expected_pages else None
    failures = U.scrape_outcome(cells, selected, tickers, expected)
    primary = U.build_snapshot(tickers, "scrape", now)
    if frozen is None:
        frozen = read_frozen(spark, root)
    chosen = U.with_fallback(primary, failures, frozen)
    summary = chosen.agg(F.count(F.lit(1)).alias("n"), F.max("generated_at").alias("g"),
                         F.max("source").alias("s")).first()
    if not summary["n"]:
        raise UniverseUnavailable("scrape failed and no frozen list exists")
    store.write_version(chosen.select(*UNIVERSE.fieldNames()), root, "universe")
    if summary["s"] == "scrape":
        store.write_version(U.freeze(read_universe(spark, root), indexes or expected_pages or []), root, "universe_frozen")
    return UniverseUpdate(summary["s"], summary["n"], summary["g"], used_fallback=summary["s"] != "scrape")


def universe_from_symbols(spark: SparkSession, symbols: str, asset_class: str) -> DataFrame:
    """Explicit ``--symbols`` text -> universe rows (bypasses the stored universe)."""
    one = spark.createDataFrame([(symbols,)], "list string")
    return one.select(F.lit(asset_class).alias("asset_class"),
                      F.explode(parse_symbol_list(F.col("list"))).alias("symbol"))
