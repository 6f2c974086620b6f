"""Futures contracts: fetch planning and continuous series (FU-1..3, PRJ-16,
PRJ-17, WN-7).

Continuous series pick one contract per (root, day) by a roll rule and only
ever roll forward: the active contract is the running maximum, by expiry, of
each day's pick. The per-day pick is a partial aggregate over contract bars;
the running maximum is a window per root over days, so each task holds one
root's date span, never its bars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlake.operators.joins import interval_join
from barlake.operators.planning import FETCH, UP_TO_DATE

CALENDAR = "calendar"
VOLUME = "volume"


def eligible_contracts(contracts: DataFrame, min_first_trade_date: str) -> DataFrame:
    """PRJ-16: contracts still trading on or after the configured start."""
    return contracts.where(F.col("last_trade_date") >= F.lit(min_first_trade_date).cast("date"))


def contract_plan(contracts: DataFrame, manifest: DataFrame | None, *, start: str, today: str,
                  timeframe: str = "daily") -> DataFrame:
    """PRJ-17/FU-2: per contract [max(first trade, start or resume), min(last
    trade, today - 1)]; up to date when the state already reaches the end."""
    c = eligible_contracts(contracts, start)
    end = F.least(F.col("last_trade_date"), F.date_sub(F.lit(today).cast("date"), 1))
    begin = F.greatest(F.col("first_trade_date"), F.lit(start).cast("date"))
    if manifest is not None:
        st = manifest.where((F.col("asset_class") == "futures") & (F.col("timeframe") == timeframe)) \
            .select(F.col("symbol").alias("ticker"), "last_complete_date")
        c = c.join(st, "ticker", "left")
        begin = F.greatest(begin, F.coalesce(F.date_add("last_complete_date", 1), begin))
        lcd = F.col("last_complete_date")
    else:
        lcd = F.lit(None).cast("date")
    out = c.select("ticker", "product_code", begin.alias("from_date"), end.alias("to_date"),
                   F.when(lcd.isNotNull() & (lcd >= end), F.lit(UP_TO_DATE)).otherwise(F.lit(FETCH))
                   .alias("action"))
    return out.where((F.col("action") == UP_TO_DATE) | (F.col("from_date") <= F.col("to_date")))


def continuous(contract_bars: DataFrame, contracts: DataFrame, method: str = CALENDAR) -> DataFrame:
    """WN-7: one bar per (root, day) from the active contract.

    calendar: each day's pick is the listed contract nearest to expiry (the
    front month, whether it traded that day or not);
    volume (or any other numeric bar column, e.g. open interest when the bars
    carry it): the contract leading on that column that day (ties: nearer
    expiry, then ticker). Either way the active contract never moves back."""
    c = contracts.select(F.col("ticker").alias("symbol"), F.col("product_code").alias("root"),
                         "last_trade_date")
    b = contract_bars.withColumn("day", F.to_date("timestamp")).join(c, "symbol")
    ident = F.struct("last_trade_date", "symbol")
    if method == CALENDAR:
        # Nearest expiry among the contracts listed that day (first trade <= day
        # <= last trade), traded or not: each contract's own lifetime expands to
        # its days (bounded by contracts x lifetime, no root x day product).
        listed = contracts.select(
            F.col("product_code").alias("root"), F.col("ticker").alias("symbol"), "last_trade_date",
            F.explode(F.sequence("first_trade_date", "last_trade_date")).alias("day"))
        daily = listed.groupBy("root", "day").agg(F.min(ident).alias("_pick"))
    elif method in contract_bars.columns:
        pick = F.min_by(ident, F.struct((-F.col(method)).alias("v"), "last_trade_date", "symbol"))
        daily = b.groupBy("root", "day").agg(pick.alias("_pick"))
    else:
        raise ValueError(f"unknown roll method {method!r}: neither 'calendar' nor a bar column")
    run = Window.partitionBy("root").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    active = daily.select("root", "day", F.max("_pick").over(run)["symbol"].alias("symbol"))
    out = active.join(b.drop("root", "last_trade_date"), ["symbol", "day"])
    return out.select("root", "day", F.col("symbol").alias("contract"), "open", "high", "low", "close",
                      "volume")


def sticky_rolls(contract_values: DataFrame, contracts: DataFrame, value: str) -> DataFrame:
    """Roll by crossover: (root, contract, valid_from, valid_to), the contract that is
    active on each day.

    The current contract stays until a later-expiring one *overtakes* it on ``value``
    (``contract_values`` has symbol, timestamp and it; a contract without a row that day
    counts 0); on a tie it stays. It gives way without a contest once it has expired.
    Among several that overtake, the greatest value wins, then the nearer expiry, then
    the ticker. What is current depends on every earlier day, so each root's days are
    folded in order: one row per root holds its days with the contracts quoted on each
    (bounded by the listing calendar, not by trades); the fold keeps rolls only."""
    c = contracts.select(F.col("ticker").alias("symbol"), F.col("product_code").alias("root"), F.col("last_trade_date").alias("expiry"))
    quoted = contract_values.select("symbol", F.to_date("timestamp").alias("day"), F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("v")) \
        .groupBy("symbol", "day").agg(F.max("v").alias("v")).join(c, "symbol")
    # Better contracts sort first: greater value, nearer expiry, ticker.
    days = quoted.groupBy("root", "day").agg(F.array_sort(F.collect_list(F.struct((-F.col("v")).alias("v"), "expiry", "symbol"))).alias("quotes"))
    per_root = days.groupBy("root").agg(F.array_sort(F.collect_list(F.struct("day", "quotes"))).alias("days"))
    none = F.lit(None).cast("struct<expiry:date,symbol:string>")
    rolls = F.array().cast("array<struct<day:date,symbol:string>>")

    def step(acc, d):
        now = acc["now"]
        own = F.coalesce(F.get(F.filter(d["quotes"], lambda q: q["symbol"] == now["symbol"]), F.lit(0))["v"], F.lit(0.0))
        later = F.get(F.filter(d["quotes"], lambda q: now.isNull() | (F.struct(q["expiry"], q["symbol"]) > now)), F.lit(0))
        over = later.isNotNull() & (now.isNull() | (now["expiry"] < d["day"]) | (later["v"] < own))
        to = F.struct(later["expiry"].alias("expiry"), later["symbol"].alias("symbol"))
        return F.struct(F.when(over, to).otherwise(now).alias("now"),
                        F.when(over, F.concat(acc["rolls"], F.array(F.struct(d["day"].alias("day"), later["symbol"].alias("symbol")))))
                        .otherwise(acc["rolls"]).alias("rolls"))

    folded = per_root.select("root", F.explode(F.aggregate("days", F.struct(none.alias("now"), rolls.alias("rolls")), step)["rolls"]).alias("r"))
    nxt = F.lead("r.day").over(Window.partitionBy("root").orderBy("r.day"))
    return folded.select("root", F.col("r.symbol").alias("contract"), F.col("r.day").alias("valid_from"), nxt.alias("valid_to"))


def continuous_sticky(contract_bars: DataFrame, contracts: DataFrame, value: str, values: DataFrame | None = None) -> DataFrame:
    """WN-7/FU-3 by crossover: one bar per (root, day) from the active contract of
    ``sticky_rolls`` on ``value``, a column of the bars or of ``values`` (symbol, timestamp,
    and it), such as open interest."""
    rolls = sticky_rolls(values if values is not None else contract_bars, contracts, value)
    root = contracts.select(F.col("ticker").alias("symbol"), F.col("product_code").alias("root"))
    b = contract_bars.withColumn("day", F.to_date("timestamp")).join(root, "symbol")
    active = interval_join(b, rolls, ["root"], F.col("day"), how="inner").where(F.col("contract") == F.col("symbol"))
    return active.select("root", "day", "contract", "open", "high", "low", "close", "volume")
