"""Deterministic market inputs derived from the supplied tables.

The supplied tables are TPC-H-like plus an event stream; these functions turn
them into ticks, bars, corporate actions, universes and contracts with plain
projections, so every job built on them scales with the tables. Only the
columns a derivation needs are read (the scan's ReadSchema shows the pruning).

| input            | derived from | rule |
| ---------------- | ------------ | ---- |
| crypto ticks     | events       | symbol X:{EVENT_TYPE}USD, price = value (2 dp), size = props.k |
| user ticks       | events       | symbol U{user_id}: many 24x7 series with real gaps |
| stock ticks      | lineitem     | symbol S{suppkey}, day = shipdate, price = extendedprice, size = quantity |
| splits           | supplier     | every supplier 1 -> 2 on a date set by its nation; some twice |
| dividends        | supplier     | cash = acctbal / 10000 (2 dp) on two fixed dates |
| universe, indexes| supplier     | S{suppkey}; IDXA = balance >= 0, IDXB = nation < 13 |
| futures          | lineitem     | root = returnflag, contract quarter of shipdate + 30 * linenumber days |
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.functions.tickers import crypto_ticker
from barlake.functions.time import to_utc_instant

# Fixed values of the derivations (shared with the SQL oracle).
PRICE_DECIMAL = "decimal(18,2)"
SPLIT_BASE_DATE = "1995-06-01"     # first split of nation 0; later nations step by:
SPLIT_NATION_STEP_DAYS = 60
SECOND_SPLIT_MIN_NATION = 20       # these nations split a second time ...
SECOND_SPLIT_LAG_DAYS = 700        # ... this many days after the first
DIVIDEND_DATES = ("1997-03-14", "1999-09-15")
INDEX_B_MAX_NATION = 13            # index "IDXB": nations below this; "IDXA": balance >= 0


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crypto_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24/7 trades of five crypto pairs: symbol, ts, seq, price, size."""
    ev = read(spark, sf_dir, "events")
    return ev.select(
        crypto_ticker(F.col("event_type")).alias("symbol"),
        to_utc_instant(F.col("ts")).alias("ts"),
        F.col("event_id").alias("seq"),
        F.col("value").cast(PRICE_DECIMAL).alias("price"),
        F.get_json_object(F.col("props"), "$.k").cast("bigint").alias("size"),
    )


def user_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many 24/7 series (one per user) with real missing days."""
    ev = read(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("symbol"),
        to_utc_instant(F.col("ts")).alias("ts"),
        F.col("event_id").alias("seq"),
        F.col("value").cast(PRICE_DECIMAL).alias("price"),
        F.get_json_object(F.col("props"), "$.k").cast("bigint").alias("size"),
        F.col("event_type"),
    )


def stock_ticks(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    """Daily stock trades: one per lineitem (that passes ``where``), tie-broken by
    (orderkey, linenumber, partkey)."""
    li = read(spark, sf_dir, "lineitem")
    li = li if where is None else li.where(where)
    return li.select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"),
        to_utc_instant(F.col("l_shipdate")).alias("ts"),
        F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"),
        F.col("l_extendedprice").cast(PRICE_DECIMAL).alias("price"),
        F.col("l_quantity").cast("bigint").alias("size"),
    )


STOCK_ORDER = ["l_orderkey", "l_linenumber", "l_partkey"]
CRYPTO_ORDER = ["seq"]


def stock_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    sup = read(spark, sf_dir, "supplier")
    return sup.select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("symbol"),
                      F.col("s_suppkey"), F.col("s_acctbal"), F.col("s_nationkey"))


def splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1 -> 2 splits: every supplier splits once, dated by its nation; suppliers of
    the last nations split a second time later."""
    s = stock_symbols(spark, sf_dir)
    first = s.select("symbol", F.date_add(F.lit(SPLIT_BASE_DATE).cast("date"),
                                          F.col("s_nationkey") * SPLIT_NATION_STEP_DAYS).alias("execution_date"))
    second = s.where(F.col("s_nationkey") >= SECOND_SPLIT_MIN_NATION).select(
        "symbol", F.date_add(F.lit(SPLIT_BASE_DATE).cast("date"),
                             F.col("s_nationkey") * SPLIT_NATION_STEP_DAYS + SECOND_SPLIT_LAG_DAYS)
        .alias("execution_date"))
    return first.unionByName(second).select(
        "symbol", "execution_date", F.lit(1.0).alias("split_from"), F.lit(2.0).alias("split_to"),
        F.lit(2.0).alias("ratio"))


def dividends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two cash dividends per supplier with a positive balance."""
    s = stock_symbols(spark, sf_dir).where(F.col("s_acctbal") > 0)
    dates = F.array(*[F.lit(d).cast("date") for d in DIVIDEND_DATES])
    return s.select(
        "symbol", F.explode(dates).alias("ex_dividend_date"),
        F.round(F.col("s_acctbal") / 10000, 2).alias("cash_amount"),
        F.lit("USD").alias("currency"), F.lit("CD").alias("dividend_type"),
        F.lit(4).alias("frequency"),
    ).select("symbol", "ex_dividend_date", "cash_amount", "currency", "dividend_type", "frequency",
             F.date_add("ex_dividend_date", 14).alias("pay_date"),
             F.date_add("ex_dividend_date", 1).alias("record_date"),
             F.date_sub("ex_dividend_date", 30).alias("declaration_date"))


def index_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(index, ticker): two overlapping index lists over the suppliers."""
    s = stock_symbols(spark, sf_dir)
    a = s.where(F.col("s_acctbal") >= 0).select(F.lit("IDXA").alias("index"), F.col("symbol").alias("ticker"))
    b = s.where(F.col("s_nationkey") < INDEX_B_MAX_NATION).select(F.lit("IDXB").alias("index"),
                                                                  F.col("symbol").alias("ticker"))
    return a.unionByName(b)


def constituent_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scraped index pages as a long cell table, one page per region.

    table 0: nation names under a numeric header (not flat);
    table 1: a small flat table with a Symbol column (nation codes);
    table 2: the constituents: one row per order of the region's customers,
             Symbol = customer ticker C{nation}-{custkey} in a form set by the
             order priority (padded lower case, dot form, dash form with a
             trailing tab, the text nan, blank), plus a Security column;
    table 3: a change log with two-level headers (not flat) and a Symbol column.
    """
    region = read(spark, sf_dir, "region").select("r_regionkey", F.col("r_name").alias("page"))
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    nat = nation.join(region, nation.n_regionkey == region.r_regionkey).select("page", "n_nationkey", "n_name")
    t0 = nat.select("page", F.lit(0).alias("table_no"), F.col("n_nationkey").cast("int").alias("row_no"),
                    F.lit("0").alias("col_name"), F.lit(False).alias("is_flat"), F.col("n_name").alias("value"))
    t1 = nat.select("page", F.lit(1).alias("table_no"), F.col("n_nationkey").cast("int").alias("row_no"),
                    F.lit("Symbol").alias("col_name"), F.lit(True).alias("is_flat"),
                    F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("value"))
    cust = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    oc = orders.join(cust, orders.o_custkey == cust.c_custkey) \
        .join(nat, cust.c_nationkey == nat.n_nationkey)
    base = F.concat(F.lit("C"), F.col("c_nationkey").cast("string"), F.lit("-"), F.col("c_custkey").cast("string"))
    pr = F.col("o_orderpriority")
    raw = (F.when(pr == "1-URGENT", F.concat(F.lit("  "), F.lower(base), F.lit(" ")))
           .when(pr == "2-HIGH", F.replace(base, F.lit("-"), F.lit(".")))
           .when(pr == "3-MEDIUM", F.concat(F.lower(base), F.lit("\t")))
           .when(pr == "4-NOT SPECIFIED", F.lit("nan"))
           .otherwise(F.lit("")))
    rows = oc.select("page", F.lit(2).alias("table_no"), F.col("o_orderkey").alias("row_no"),
                     raw.alias("_sym"), F.col("c_custkey"), F.col("o_orderkey"))
    t2 = rows.select("page", "table_no", "row_no", F.lit("Symbol").alias("col_name"),
                     F.lit(True).alias("is_flat"), F.col("_sym").alias("value")) \
        .unionByName(rows.select("page", "table_no", "row_no", F.lit("Security").alias("col_name"),
                                 F.lit(True).alias("is_flat"),
                                 F.concat(F.lit("Customer "), F.col("c_custkey").cast("string")).alias("value")))
    t3 = rows.select("page", F.lit(3).alias("table_no"), "row_no", F.lit("Symbol").alias("col_name"),
                     F.lit(False).alias("is_flat"),
                     F.concat(F.lit("X"), F.col("o_orderkey").cast("string")).alias("value"))
    return t0.unionByName(t1).unionByName(t2).unionByName(t3)


MEMBERSHIP_BASE = "1995-01-01"
MEMBERSHIP_STEP_DAYS = 40
MEMBERSHIP_REMOVED = "1999-01-01"


def membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index membership intervals: joined by nation, negative-balance suppliers left."""
    s = stock_symbols(spark, sf_dir)
    return s.select(
        F.lit("IDXM").alias("index"), F.col("symbol").alias("ticker"),
        F.date_add(F.lit(MEMBERSHIP_BASE).cast("date"), F.col("s_nationkey") * MEMBERSHIP_STEP_DAYS)
        .alias("added_date"),
        F.when(F.col("s_acctbal") < 0, F.lit(MEMBERSHIP_REMOVED).cast("date")).alias("removed_date"))


def futures_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Futures trades: root = returnflag, contract = delivery quarter of
    shipdate + 30 * linenumber days, traded on the ship date."""
    li = read(spark, sf_dir, "lineitem")
    deliv = F.date_add(F.to_date("l_shipdate"), F.col("l_linenumber") * 30)
    return li.select(
        F.col("l_returnflag").alias("root"),
        F.concat(F.col("l_returnflag"), F.year(deliv).cast("string"), F.lit("Q"),
                 F.quarter(deliv).cast("string")).alias("symbol"),
        to_utc_instant(F.col("l_shipdate")).alias("ts"),
        F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"),
        F.col("l_extendedprice").cast(PRICE_DECIMAL).alias("price"),
        F.col("l_quantity").cast("bigint").alias("size"))


def futures_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract table: first/last trade dates from the contract's trades."""
    t = futures_ticks(spark, sf_dir)
    g = t.groupBy("symbol", "root").agg(F.min(F.to_date("ts")).alias("first_trade_date"),
                                        F.max(F.to_date("ts")).alias("last_trade_date"))
    return g.select(
        F.col("symbol").alias("ticker"), F.col("root").alias("product_code"),
        F.concat(F.lit("Root "), F.col("root"), F.lit(" "), F.substring("symbol", 2, 6)).alias("name"),
        F.substring("symbol", 2, 6).alias("month"), "first_trade_date", "last_trade_date",
        F.lit("XTST").alias("exchange_mic"), F.lit(0.25).alias("tick_size"),
        F.date_add("last_trade_date", 1).cast("timestamp").alias("discovered_at"))
