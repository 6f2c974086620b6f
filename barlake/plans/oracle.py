"""DuckDB statements that independently compute each catalogue query.

They read the supplied tables (pre-registered views) and restate every
derivation in SQL; nothing here calls into Spark or the library.
"""

from __future__ import annotations

# Derived inputs as CTE bodies (fixed values mirror barlake.sources.tables).
CTE = {
    "crypto_ticks": """
  SELECT 'X:' || upper(event_type) || 'USD' AS symbol, ts, event_id AS seq,
         CAST(value AS DECIMAL(18,2)) AS price,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS size
  FROM events""",
    "user_ticks": """
  SELECT 'U' || CAST(user_id AS VARCHAR) AS symbol, ts, event_id AS seq,
         CAST(value AS DECIMAL(18,2)) AS price,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS size, event_type
  FROM events""",
    "stock_ticks": """
  SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol, l_shipdate AS ts,
         l_orderkey, l_linenumber, l_partkey,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(l_quantity AS BIGINT) AS size
  FROM lineitem""",
}


def bars_cte(ticks: str, bucket: str, order: str) -> str:
    return f"""
  SELECT {bucket} AS timestamp, symbol,
         CAST(arg_min(price, ({order})) AS DOUBLE) AS open,
         CAST(max(price) AS DOUBLE) AS high,
         CAST(min(price) AS DOUBLE) AS low,
         CAST(arg_max(price, ({order})) AS DOUBLE) AS close,
         CAST(sum(size) AS DOUBLE) AS volume,
         CASE WHEN sum(size) = 0 THEN NULL
              ELSE CAST(sum(price * size) AS DOUBLE) / CAST(sum(size) AS DOUBLE) END AS vwap,
         CAST(count(*) AS INTEGER) AS transactions,
         CAST(NULL AS BOOLEAN) AS otc
  FROM {ticks} GROUP BY 1, 2"""


CTE["crypto_daily"] = bars_cte("crypto_ticks", "date_trunc('day', ts)", "ts, seq")
CTE["crypto_minute"] = bars_cte("crypto_ticks", "date_trunc('minute', ts)", "ts, seq")
CTE["user_daily"] = bars_cte("user_ticks", "date_trunc('day', ts)", "ts, seq")
CTE["stock_daily"] = bars_cte("stock_ticks", "date_trunc('day', ts)",
                              "ts, l_orderkey, l_linenumber, l_partkey")
CTE["lake_bars"] = """
  SELECT *, 'crypto' AS asset_class, 'minute' AS timeframe FROM crypto_minute
  UNION ALL
  SELECT *, 'stocks' AS asset_class, 'daily' AS timeframe FROM stock_daily"""

# Dependencies between CTEs, so a statement names only what it reads.
DEPS = {
    "crypto_daily": ["crypto_ticks"], "crypto_minute": ["crypto_ticks"],
    "user_daily": ["user_ticks"], "stock_daily": ["stock_ticks"],
    "lake_bars": ["crypto_minute", "stock_daily"],
}


def with_(*names: str) -> str:
    """WITH clause holding ``names`` and everything they depend on, in order."""
    seen: list[str] = []

    def visit(n: str) -> None:
        for dep in DEPS.get(n, []):
            visit(dep)
        if n not in seen:
            seen.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n]}\n)" for n in seen) + "\n"


def resample_sql(src: str, bucket: str) -> str:
    return f"""
SELECT {bucket} AS timestamp, symbol,
       arg_min(open, timestamp) AS open, max(high) AS high, min(low) AS low,
       arg_max(close, timestamp) AS close, sum(volume) AS volume,
       CASE WHEN sum(CASE WHEN vwap IS NOT NULL THEN volume END) = 0 THEN NULL
            ELSE CAST(sum(CASE WHEN vwap IS NOT NULL THEN CAST(vwap * volume AS DECIMAL(38,4)) END) AS DOUBLE)
                 / sum(CASE WHEN vwap IS NOT NULL THEN volume END) END AS vwap,
       CAST(sum(transactions) AS INTEGER) AS transactions,
       bool_or(otc) AS otc
FROM {src} GROUP BY 1, 2"""


ORACLE: dict[str, str] = {}

ORACLE["ticks_to_daily_bars"] = with_("crypto_daily") + "SELECT * FROM crypto_daily"
ORACLE["ticks_to_minute_bars"] = with_("crypto_minute") + "SELECT * FROM crypto_minute"
ORACLE["stock_ticks_to_daily_bars"] = with_("stock_daily") + "SELECT * FROM stock_daily"
ORACLE["resample_bars"] = with_("crypto_minute") + resample_sql(
    "crypto_minute", "make_timestamp(epoch_us(timestamp) - epoch_us(timestamp) % CAST(14400000000 AS BIGINT))")
ORACLE["resample_weekly_bars"] = with_("stock_daily") + resample_sql(
    "stock_daily", "date_trunc('week', timestamp)")

ORACLE["normalize_bars"] = with_("crypto_daily") + """
SELECT make_timestamp(epoch_ms(timestamp) * 1000) AS timestamp, symbol, open, high, low, close,
       volume, vwap, transactions, otc
FROM crypto_daily"""
ORACLE["flatfile_normalize"] = with_("stock_daily") + """
SELECT make_timestamp((epoch_us(timestamp) * 1000) // 1000) AS timestamp, symbol, open, high, low,
       close, volume, CAST(NULL AS DOUBLE) AS vwap, transactions, CAST(NULL AS BOOLEAN) AS otc
FROM stock_daily"""

_LINES = """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity,
       l_extendedprice FROM lineitem"""
ORACLE["dedupe_keep_first"] = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate, l_partkey, l_suppkey) AS rn
  FROM ({_LINES})) WHERE rn = 1"""
ORACLE["dedupe_keep_last"] = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn
  FROM ({_LINES})) WHERE rn = 1"""
ORACLE["duplicate_report"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1"""

ORACLE["series_state"] = with_("lake_bars") + """
SELECT asset_class, symbol, timeframe, min(CAST(timestamp AS DATE)) AS earliest_date,
       max(CAST(timestamp AS DATE)) AS last_complete_date, count(*) AS bar_count
FROM lake_bars GROUP BY 1, 2, 3"""


# ------------------------------------------------------------- calendar --

CLOSURES_SQL = """VALUES
    (DATE '1994-04-27', 'National Day of Mourning'), (DATE '2001-09-11', 'September 11'),
    (DATE '2001-09-12', 'September 11'), (DATE '2001-09-13', 'September 11'),
    (DATE '2001-09-14', 'September 11'), (DATE '2004-06-11', 'National Day of Mourning'),
    (DATE '2007-01-02', 'National Day of Mourning'), (DATE '2012-10-29', 'Hurricane Sandy'),
    (DATE '2012-10-30', 'Hurricane Sandy'), (DATE '2018-12-05', 'National Day of Mourning'),
    (DATE '2025-01-09', 'National Day of Mourning')"""


def _fixed(mm: int, dd: int, sat_to_fri: bool = True) -> str:
    cond = (f"(m = {mm} AND dom = {dd} AND dw <= 5) OR (m = {mm} AND dom = {dd + 1} AND dw = 1)")
    if sat_to_fri:
        cond += f" OR (m = {mm} AND dom = {dd - 1} AND dw = 5)"
    return f"({cond})"


def _nth(mm: int, dw: int, n: int) -> str:
    return f"(m = {mm} AND dw = {dw} AND dom BETWEEN {7 * (n - 1) + 1} AND {7 * n})"


HOLIDAY_CASE = f"""CASE
    WHEN {_fixed(1, 1, False)} THEN 'New Year''s Day'
    WHEN y >= 1998 AND {_nth(1, 1, 3)} THEN 'Martin Luther King Jr. Day'
    WHEN {_nth(2, 1, 3)} THEN 'Washington''s Birthday'
    WHEN day = good_friday THEN 'Good Friday'
    WHEN m = 5 AND dw = 1 AND dom >= 25 THEN 'Memorial Day'
    WHEN y >= 2022 AND {_fixed(6, 19)} THEN 'Juneteenth'
    WHEN {_fixed(7, 4)} THEN 'Independence Day'
    WHEN {_nth(9, 1, 1)} THEN 'Labor Day'
    WHEN {_nth(11, 4, 4)} THEN 'Thanksgiving Day'
    WHEN {_fixed(12, 25)} THEN 'Christmas Day' END"""


def register_calendar(prefix: str, bounds_sql: str, bounds_deps: list[str] | None = None) -> None:
    """CTEs {prefix}_days, _holidays, _sessions, _dense over the span of ``bounds_sql``
    (a SELECT returning one row with DATE columns s, e)."""
    CTE[f"{prefix}_bounds"] = bounds_sql
    DEPS[f"{prefix}_bounds"] = bounds_deps or []
    CTE[f"{prefix}_days"] = f"""
  SELECT CAST(unnest(generate_series(s, e, INTERVAL 1 DAY)) AS DATE) AS day
  FROM {prefix}_bounds WHERE s IS NOT NULL"""
    DEPS[f"{prefix}_days"] = [f"{prefix}_bounds"]
    CTE[f"{prefix}_easter"] = f"""
  SELECT y, make_date(y, CAST((h + l - 7 * mm + 114) // 31 AS INTEGER),
                      CAST((h + l - 7 * mm + 114) % 31 + 1 AS INTEGER)) - INTERVAL 2 DAY AS good_friday
  FROM (SELECT *, (a + 11 * h + 22 * l) // 451 AS mm
        FROM (SELECT *, (32 + 2 * e + 2 * i - h - k) % 7 AS l
              FROM (SELECT *, (19 * a + b - d - g + 15) % 30 AS h, c // 4 AS i, c % 4 AS k
                    FROM (SELECT *, (b - f + 1) // 3 AS g
                          FROM (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c, (y // 100) // 4 AS d,
                                       (y // 100) % 4 AS e, ((y // 100) + 8) // 25 AS f
                                FROM (SELECT DISTINCT CAST(year(day) AS BIGINT) AS y FROM {prefix}_days))))))"""
    DEPS[f"{prefix}_easter"] = [f"{prefix}_days"]
    CTE[f"{prefix}_holidays"] = f"""
  SELECT holiday_date, name FROM (
    SELECT day AS holiday_date, {HOLIDAY_CASE} AS name
    FROM (SELECT day, year(day) AS y, month(day) AS m, day(day) AS dom, isodow(day) AS dw,
                 CAST(good_friday AS DATE) AS good_friday
          FROM {prefix}_days JOIN {prefix}_easter ON year(day) = y))
  WHERE name IS NOT NULL
  UNION ALL
  SELECT holiday_date, name FROM ({CLOSURES_SQL}) c(holiday_date, name)
  WHERE holiday_date IN (SELECT day FROM {prefix}_days)
    AND holiday_date NOT IN (SELECT day FROM (
      SELECT day, {HOLIDAY_CASE} AS name
      FROM (SELECT day, year(day) AS y, month(day) AS m, day(day) AS dom, isodow(day) AS dw,
                   CAST(good_friday AS DATE) AS good_friday
            FROM {prefix}_days JOIN {prefix}_easter ON year(day) = y)) WHERE name IS NOT NULL)"""
    DEPS[f"{prefix}_holidays"] = [f"{prefix}_days", f"{prefix}_easter"]
    CTE[f"{prefix}_sessions"] = f"""
  SELECT day AS session_date, CAST(row_number() OVER (ORDER BY day) AS INTEGER) AS ordinal,
         lag(day) OVER (ORDER BY day) AS prev_session, lead(day) OVER (ORDER BY day) AS next_session
  FROM {prefix}_days
  WHERE isodow(day) <= 5 AND day NOT IN (SELECT holiday_date FROM {prefix}_holidays)"""
    DEPS[f"{prefix}_sessions"] = [f"{prefix}_days", f"{prefix}_holidays"]
    CTE[f"{prefix}_dense"] = f"""
  SELECT day, session_date IS NOT NULL AS is_session,
         max(session_date) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
           AS session_on_or_before,
         min(session_date) OVER (ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
           AS session_on_or_after
  FROM {prefix}_days LEFT JOIN {prefix}_sessions ON day = session_date"""
    DEPS[f"{prefix}_dense"] = [f"{prefix}_days", f"{prefix}_sessions"]


register_calendar("scal", "SELECT CAST(min(l_shipdate) AS DATE) AS s, CAST(max(l_shipdate) AS DATE) AS e FROM lineitem")
register_calendar("ocal", "SELECT CAST(min(o_orderdate) AS DATE) - INTERVAL 10 DAY AS s, "
                          "CAST(max(o_orderdate) AS DATE) AS e FROM orders")
CTE["ocal_bounds"] = ("SELECT CAST(CAST(min(o_orderdate) AS DATE) - INTERVAL 10 DAY AS DATE) AS s, "
                      "CAST(max(o_orderdate) AS DATE) AS e FROM orders")

CTE["stock_state"] = """
  SELECT 'stocks' AS asset_class, symbol, 'daily' AS timeframe,
         min(CAST(timestamp AS DATE)) AS earliest_date, max(CAST(timestamp AS DATE)) AS last_complete_date,
         count(*) AS bar_count
  FROM stock_daily GROUP BY symbol"""
DEPS["stock_state"] = ["stock_daily"]
CTE["stock_session_count"] = """
  SELECT st.*, CAST(greatest(coalesce(hi.ord, 0) - (coalesce(lo.ord, 0) - CAST(lo.is_session AS INTEGER)), 0)
                    AS BIGINT) AS sessions
  FROM stock_state st
  LEFT JOIN (SELECT d.day, d.is_session, s.ordinal AS ord FROM scal_dense d
             LEFT JOIN scal_sessions s ON d.session_on_or_before = s.session_date) lo ON st.earliest_date = lo.day
  LEFT JOIN (SELECT d.day, s.ordinal AS ord FROM scal_dense d
             LEFT JOIN scal_sessions s ON d.session_on_or_before = s.session_date) hi
         ON st.last_complete_date = hi.day"""
DEPS["stock_session_count"] = ["stock_state", "scal_dense", "scal_sessions"]

ET = "timezone('America/New_York', timestamp AT TIME ZONE 'UTC')"
SESSION_CASE = f"""CASE
    WHEN hour({ET}) * 60 + minute({ET}) >= 240 AND hour({ET}) * 60 + minute({ET}) < 570 THEN 'pre'
    WHEN hour({ET}) * 60 + minute({ET}) >= 570 AND hour({ET}) * 60 + minute({ET}) < 960 THEN 'regular'
    WHEN hour({ET}) * 60 + minute({ET}) >= 960 AND hour({ET}) * 60 + minute({ET}) < 1200 THEN 'after'
    ELSE 'closed' END"""
CTE["crypto_minute_sessions"] = f"""
  SELECT *, {SESSION_CASE} AS session, CAST({ET} AS DATE) AS session_date FROM crypto_minute"""
DEPS["crypto_minute_sessions"] = ["crypto_minute"]

ORACLE["holiday_calendar"] = with_("scal_holidays") + "SELECT * FROM scal_holidays"
ORACLE["session_calendar"] = with_("scal_sessions") + "SELECT * FROM scal_sessions"
ORACLE["session_snap"] = with_("stock_daily", "scal_dense") + """
SELECT b.day, b.symbol, d.is_session, d.session_on_or_before, d.session_on_or_after
FROM (SELECT symbol, CAST(timestamp AS DATE) AS day FROM stock_daily) b
LEFT JOIN scal_dense d ON b.day = d.day"""
ORACLE["target_end"] = with_("ocal_dense") + """
SELECT t.today, d.session_on_or_before AS target_end
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS today FROM orders) t
LEFT JOIN ocal_dense d ON CAST(t.today - INTERVAL 1 DAY AS DATE) = d.day"""
ORACLE["session_count"] = with_("stock_session_count") + """
SELECT symbol, earliest_date, last_complete_date, sessions FROM stock_session_count"""
ORACLE["bar_count_check"] = with_("stock_session_count") + f"""
SELECT c.symbol, c.bar_count, c.sessions, c.bar_count - c.sessions AS diff,
       abs(c.bar_count - c.sessions) <= 1 AS within_tolerance,
       c.earliest_date = d.session_on_or_after AS starts_on_session,
       c.earliest_date = (SELECT min(session_on_or_after) FROM scal_dense) AS starts_as_requested
FROM stock_session_count c LEFT JOIN scal_dense d ON c.earliest_date = d.day"""
ORACLE["session_filter"] = with_("crypto_minute_sessions") + """
SELECT * FROM crypto_minute_sessions WHERE session <> 'closed'"""
ORACLE["session_counts"] = with_("crypto_minute_sessions") + """
SELECT symbol, session_date,
       count(*) FILTER (WHERE session = 'pre') AS pre,
       count(*) FILTER (WHERE session = 'regular') AS regular,
       count(*) FILTER (WHERE session = 'after') AS after,
       count(*) FILTER (WHERE session = 'closed') AS closed,
       count(*) AS total
FROM crypto_minute_sessions GROUP BY 1, 2"""


# --------------------------------------------- manifest, plan and outcome --

CTE["manifest"] = """
  SELECT 'stocks' AS asset_class, b.symbol, 'daily' AS timeframe,
         min(CAST(b.timestamp AS DATE)) AS earliest_date, max(CAST(b.timestamp AS DATE)) AS last_complete_date,
         TIMESTAMP '1999-12-31 23:00:00' AS last_updated_at, count(*) AS bar_count
  FROM stock_daily b
  JOIN (SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS symbol,
               CAST(DATE '1999-07-01' + CAST(s_nationkey * 15 AS INTEGER) AS DATE) AS cut
        FROM supplier WHERE s_nationkey < 22) s ON b.symbol = s.symbol
  WHERE CAST(b.timestamp AS DATE) < s.cut
  GROUP BY b.symbol"""
DEPS["manifest"] = ["stock_daily"]
CTE["plan"] = """
  SELECT * FROM (
    SELECT 'stocks' AS asset_class, u.symbol, 'daily' AS timeframe,
           CASE WHEN m.last_complete_date IS NULL THEN DATE '1995-01-01'
                ELSE CAST(m.last_complete_date + INTERVAL 1 DAY AS DATE) END AS from_date,
           DATE '2000-01-31' AS to_date,
           CASE WHEN m.last_complete_date >= DATE '2000-01-31' THEN 'up_to_date' ELSE 'fetch' END AS action
    FROM (SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS symbol FROM supplier) u
    LEFT JOIN manifest m ON u.symbol = m.symbol)
  WHERE action = 'up_to_date' OR from_date <= to_date"""
DEPS["plan"] = ["manifest"]
CTE["landed"] = """
  SELECT t.*, p.from_date, p.to_date, CASE WHEN s.s_acctbal < 0 THEN 'bad request' END AS _error
  FROM stock_ticks t
  JOIN plan p ON t.symbol = p.symbol AND p.action = 'fetch'
  LEFT JOIN supplier s ON t.symbol = 'S' || CAST(s.s_suppkey AS VARCHAR)
  WHERE CAST(t.ts AS DATE) BETWEEN p.from_date AND p.to_date"""
DEPS["landed"] = ["stock_ticks", "plan"]
CTE["dispositions"] = """
  SELECT f.symbol,
         CASE WHEN coalesce(l.has_error, false) THEN 'error'
              WHEN coalesce(l.n, 0) = 0 THEN 'zero_bar' ELSE 'succeeded' END AS disposition,
         CAST(coalesce(l.n, 0) AS BIGINT) AS rows
  FROM (SELECT DISTINCT symbol FROM plan WHERE action = 'fetch') f
  LEFT JOIN (SELECT symbol, count(*) AS n, bool_or(_error IS NOT NULL) AS has_error
             FROM landed GROUP BY symbol) l ON f.symbol = l.symbol"""
DEPS["dispositions"] = ["plan", "landed"]
CTE["upserted_manifest"] = """
  SELECT * FROM manifest WHERE symbol NOT IN (
      SELECT symbol FROM dispositions WHERE disposition = 'succeeded')
  UNION ALL
  SELECT 'stocks' AS asset_class, symbol, 'daily' AS timeframe,
         min(CAST(timestamp AS DATE)) AS earliest_date, max(CAST(timestamp AS DATE)) AS last_complete_date,
         TIMESTAMP '2000-02-01 06:00:00' AS last_updated_at, count(*) AS bar_count
  FROM stock_daily
  WHERE CAST(timestamp AS DATE) <= DATE '2000-01-31'
    AND symbol IN (SELECT symbol FROM dispositions WHERE disposition = 'succeeded')
  GROUP BY symbol"""
DEPS["upserted_manifest"] = ["manifest", "dispositions", "stock_daily"]

ORACLE["fetch_plan"] = with_("plan") + "SELECT * FROM plan"
ORACLE["source_dispositions"] = with_("dispositions") + "SELECT * FROM dispositions"
ORACLE["zero_bar_symbols"] = with_("plan", "landed") + """
SELECT symbol, from_date, to_date FROM plan
WHERE action = 'fetch' AND symbol NOT IN (SELECT symbol FROM landed)"""
ORACLE["run_outcome"] = with_("dispositions", "plan") + """
SELECT CAST(s + e + z AS BIGINT) AS attempted, s AS succeeded, e AS errors, z AS zero_bar, u AS up_to_date,
       CASE WHEN e = 0 THEN 0 WHEN e = s + e + z THEN 2 ELSE 1 END AS exit_code
FROM (SELECT count(*) FILTER (WHERE disposition = 'succeeded') AS s,
             count(*) FILTER (WHERE disposition = 'error') AS e,
             count(*) FILTER (WHERE disposition = 'zero_bar') AS z,
             (SELECT count(*) FROM plan WHERE action = 'up_to_date') AS u
      FROM dispositions)"""
ORACLE["manifest_upsert"] = with_("upserted_manifest") + "SELECT * FROM upserted_manifest"
ORACLE["tracked_series"] = with_("upserted_manifest") + """
SELECT count(*) AS tracked_series, count(*) = 0 AS is_empty FROM upserted_manifest"""

# ------------------------------------------------------- merge and layout --

CTE["refetched_ticks"] = """
  SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS symbol, l_shipdate AS ts, l_orderkey, l_linenumber, l_partkey,
         CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))) AS price,
         CAST(l_quantity AS BIGINT) AS size
  FROM lineitem"""
CTE["refetched_daily"] = bars_cte("refetched_ticks", "date_trunc('day', ts)",
                                  "ts, l_orderkey, l_linenumber, l_partkey")
DEPS["refetched_daily"] = ["refetched_ticks"]
CTE["merged"] = """
  SELECT * EXCLUDE (gen, rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY symbol, timestamp ORDER BY gen) AS rn FROM (
      SELECT *, 0 AS gen FROM stock_daily WHERE timestamp < TIMESTAMP '2000-01-01'
      UNION ALL
      SELECT *, 1 AS gen FROM refetched_daily WHERE timestamp >= TIMESTAMP '1999-10-01'))
  WHERE rn = 1"""
DEPS["merged"] = ["stock_daily", "refetched_daily"]

ORACLE["merge_append_bars"] = with_("merged") + "SELECT * FROM merged"
ORACLE["year_partition_counts"] = with_("merged") + """
SELECT CAST(year(timestamp) AS INTEGER) AS year, count(*) AS bars, count(DISTINCT symbol) AS symbols,
       min(timestamp) AS first_ts, max(timestamp) AS last_ts
FROM merged GROUP BY 1"""
ORACLE["bars_date_window"] = with_("stock_daily") + """
SELECT * FROM stock_daily
WHERE CAST(timestamp AS DATE) BETWEEN DATE '1997-03-01' AND DATE '1997-05-31'
ORDER BY timestamp DESC, symbol"""
ORACLE["raw_bar_scan"] = with_("crypto_daily") + """
SELECT symbol, open AS o, high AS h, low AS l, close AS c, volume AS v, vwap AS vw,
       epoch_ms(timestamp) AS t, transactions AS n, otc
FROM crypto_daily
WHERE epoch_ms(timestamp) >= epoch_ms(TIMESTAMP '2024-01-05')
  AND epoch_ms(timestamp) < epoch_ms(TIMESTAMP '2024-01-21')"""
ORACLE["hybrid_source_merge"] = with_("stock_daily", "refetched_daily") + """
SELECT * EXCLUDE (rk, rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, timestamp ORDER BY rk) AS rn FROM (
    SELECT timestamp, symbol, open, high, low, close, volume, CAST(NULL AS DOUBLE) AS vwap, transactions,
           CAST(NULL AS BOOLEAN) AS otc, 'flat' AS source, 0 AS rk
    FROM stock_daily WHERE timestamp < TIMESTAMP '2000-01-01'
    UNION ALL
    SELECT *, 'rest' AS source, 1 AS rk FROM refetched_daily WHERE timestamp >= TIMESTAMP '1999-07-01'))
WHERE rn = 1"""
ORACLE["symbol_recluster"] = with_("stock_daily") + "SELECT * FROM stock_daily"


# ----------------------------------------------------------- validation --

CTE["ucal_bounds"] = "SELECT CAST(min(ts) AS DATE) AS s, CAST(max(ts) AS DATE) AS e FROM events"
CTE["scal_le"] = """
  SELECT d.day, coalesce(s.ordinal, 0) AS le FROM scal_dense d
  LEFT JOIN scal_sessions s ON d.session_on_or_before = s.session_date"""
DEPS["scal_le"] = ["scal_dense", "scal_sessions"]
CTE["stock_missing"] = """
  SELECT r.symbol, s.session_date AS missing_date
  FROM (SELECT symbol, min(CAST(timestamp AS DATE)) AS lo, max(CAST(timestamp AS DATE)) AS hi
        FROM stock_daily GROUP BY symbol) r
  JOIN scal_sessions s ON s.session_date BETWEEN r.lo AND r.hi
  WHERE NOT EXISTS (SELECT 1 FROM stock_daily b
                    WHERE b.symbol = r.symbol AND CAST(b.timestamp AS DATE) = s.session_date)"""
DEPS["stock_missing"] = ["stock_daily", "scal_sessions"]
CTE["misread"] = """
  SELECT epoch_us(timestamp) * 1000 AS window_start, symbol, open, close AS high, high AS low,
         low AS close, volume, transactions
  FROM stock_daily"""
DEPS["misread"] = ["stock_daily"]

ORACLE["bar_steps"] = with_("crypto_minute") + """
SELECT symbol, timestamp, prev_ts, CAST(epoch(timestamp) - epoch(prev_ts) AS BIGINT) AS step_seconds
FROM (SELECT symbol, timestamp, lag(timestamp) OVER (PARTITION BY symbol ORDER BY timestamp) AS prev_ts
      FROM crypto_minute)"""
ORACLE["monotonic_check"] = with_("stock_ticks") + """
SELECT symbol, count(*) AS rows, count(*) - count(DISTINCT ts) AS violations,
       count(*) = count(DISTINCT ts) AS strictly_increasing
FROM stock_ticks GROUP BY symbol"""
ORACLE["daily_gaps_24x7"] = with_("user_daily") + """
SELECT symbol, missing_date FROM (
  SELECT symbol, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS missing_date
  FROM (SELECT symbol, min(CAST(timestamp AS DATE)) AS lo, max(CAST(timestamp AS DATE)) AS hi
        FROM user_daily GROUP BY symbol))
EXCEPT ALL
SELECT symbol, CAST(timestamp AS DATE) FROM user_daily"""
ORACLE["daily_gaps_sessions"] = with_("stock_missing") + "SELECT * FROM stock_missing"
ORACLE["gap_ranges"] = with_("stock_missing", "scal_sessions") + """
SELECT symbol, min(missing_date) AS first_missing, max(missing_date) AS last_missing,
       CAST(count(*) AS BIGINT) AS sessions
FROM (SELECT m.symbol, m.missing_date,
             s.ordinal - row_number() OVER (PARTITION BY m.symbol ORDER BY s.ordinal) AS grp
      FROM stock_missing m JOIN scal_sessions s ON m.missing_date = s.session_date)
GROUP BY symbol, grp"""
ORACLE["ohlc_violations"] = with_("misread") + """
SELECT *, CASE WHEN open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL THEN 'null price'
               WHEN low > high THEN 'low>high' WHEN open > high THEN 'open>high'
               WHEN open < low THEN 'open<low' WHEN close > high THEN 'close>high'
               WHEN close < low THEN 'close<low' END AS rule
FROM misread
WHERE NOT coalesce(low <= open AND open <= high AND low <= close AND close <= high AND low <= high, false)"""
ORACLE["ohlc_dropped"] = with_("misread") + """
SELECT * FROM misread
WHERE low <= open AND open <= high AND low <= close AND close <= high AND low <= high"""
_NULLS = ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in
                   ["timestamp", "symbol", "open", "high", "low", "close", "volume", "vwap",
                    "transactions", "otc"])
ORACLE["null_report"] = ORACLE["hybrid_source_merge"].replace(
    "SELECT * EXCLUDE (rk, rn) FROM (", f"SELECT source, count(*) AS rows, {_NULLS} FROM (SELECT * EXCLUDE (rk, rn) FROM (", 1
) + ") GROUP BY source"
ORACLE["type_violations"] = """
WITH raw AS (
  SELECT CAST(ts AS VARCHAR) AS ts,
         CASE WHEN event_type = 'error' THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS price,
         json_extract_string(props, '$.k') AS size
  FROM events)
SELECT 'ts' AS "column", 'timestamp' AS expected_type, count(*) AS rows,
       count(*) FILTER (WHERE ts IS NOT NULL AND TRY_CAST(ts AS TIMESTAMP) IS NULL) AS violations,
       count(*) FILTER (WHERE ts IS NULL) AS nulls FROM raw
UNION ALL
SELECT 'price', 'decimal(18,2)', count(*),
       count(*) FILTER (WHERE price IS NOT NULL AND TRY_CAST(price AS DECIMAL(18,2)) IS NULL),
       count(*) FILTER (WHERE price IS NULL) FROM raw
UNION ALL
SELECT 'size', 'bigint', count(*),
       count(*) FILTER (WHERE size IS NOT NULL AND TRY_CAST(size AS BIGINT) IS NULL),
       count(*) FILTER (WHERE size IS NULL) FROM raw"""
ORACLE["coverage_check"] = with_("upserted_manifest", "scal_le") + """
SELECT m.asset_class, m.symbol, m.timeframe, m.last_complete_date,
       CAST(n.le - l.le AS BIGINT) AS sessions_behind, n.le - l.le <= 1 AS covered
FROM upserted_manifest m
LEFT JOIN scal_le l ON m.last_complete_date = l.day
LEFT JOIN scal_le n ON n.day = DATE '2000-01-31'"""
ORACLE["zero_bar_open_market"] = with_("plan", "landed", "scal_sessions") + """
SELECT p.symbol, p.from_date, p.to_date, count(*) AS sessions, 'warn' AS severity
FROM plan p JOIN scal_sessions s ON s.session_date BETWEEN p.from_date AND p.to_date
WHERE p.action = 'fetch' AND p.symbol NOT IN (SELECT symbol FROM landed)
GROUP BY p.symbol, p.from_date, p.to_date"""


# ----------------------------------------------------- corporate actions --

CTE["splits"] = """
  SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS symbol,
         CAST(DATE '1995-06-01' + CAST(s_nationkey * 60 AS INTEGER) AS DATE) AS execution_date,
         CAST(1.0 AS DOUBLE) AS split_from, CAST(2.0 AS DOUBLE) AS split_to, CAST(2.0 AS DOUBLE) AS ratio
  FROM supplier
  UNION ALL
  SELECT 'S' || CAST(s_suppkey AS VARCHAR),
         CAST(DATE '1995-06-01' + CAST(s_nationkey * 60 + 700 AS INTEGER) AS DATE), 1.0, 2.0, 2.0
  FROM supplier WHERE s_nationkey >= 20"""
CTE["dividends"] = """
  SELECT symbol, ex_dividend_date, cash_amount, 'USD' AS currency, 'CD' AS dividend_type, 4 AS frequency,
         CAST(ex_dividend_date + INTERVAL 14 DAY AS DATE) AS pay_date,
         CAST(ex_dividend_date + INTERVAL 1 DAY AS DATE) AS record_date,
         CAST(ex_dividend_date - INTERVAL 30 DAY AS DATE) AS declaration_date
  FROM (SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS symbol, round(s_acctbal / 10000, 2) AS cash_amount
        FROM supplier WHERE s_acctbal > 0) s,
       (VALUES (DATE '1997-03-14'), (DATE '1999-09-15')) d(ex_dividend_date)"""
# Split factor of a bar: product of split_from / split_to of all later splits.
CTE["split_adjusted"] = """
  SELECT b.timestamp, b.symbol, b.open * f AS open, b.high * f AS high, b.low * f AS low,
         b.close * f AS close, b.volume / f AS volume, b.vwap * f AS vwap, b.transactions, b.otc,
         f AS split_factor
  FROM (SELECT b.*, coalesce((SELECT product(s.split_from / s.split_to) FROM splits s
                              WHERE s.symbol = b.symbol AND s.execution_date > CAST(b.timestamp AS DATE)), 1.0) AS f
        FROM stock_daily b) b"""
DEPS["split_adjusted"] = ["stock_daily", "splits"]
CTE["div_factors"] = """
  SELECT d.symbol, d.ex_dividend_date,
         1 - d.cash_amount / (SELECT arg_max(b.close, b.timestamp) FROM stock_daily b
                              WHERE b.symbol = d.symbol AND b.timestamp < CAST(d.ex_dividend_date AS TIMESTAMP)) AS f
  FROM dividends d"""
DEPS["div_factors"] = ["dividends", "stock_daily"]

ORACLE["split_adjusted_bars"] = with_("split_adjusted") + "SELECT * FROM split_adjusted"
ORACLE["dividend_adjusted_bars"] = with_("split_adjusted", "div_factors") + """
SELECT timestamp, symbol, round(open * g, 6) AS open, round(high * g, 6) AS high, round(low * g, 6) AS low,
       round(close * g, 6) AS close, volume, round(vwap * g, 6) AS vwap, transactions, otc, split_factor,
       round(g, 6) AS dividend_factor
FROM (SELECT a.*, coalesce((SELECT product(f) FROM div_factors x
                            WHERE x.symbol = a.symbol AND x.f IS NOT NULL AND x.f > -1e300
                              AND x.ex_dividend_date > CAST(a.timestamp AS DATE)), 1.0) AS g
      FROM split_adjusted a)"""
ORACLE["splits_merge"] = with_("splits") + """
SELECT symbol, execution_date, split_from, split_to,
       CASE WHEN execution_date < DATE '1997-01-01' THEN ratio END AS ratio
FROM splits"""
ORACLE["dividends_merge"] = with_("dividends") + """
SELECT symbol, ex_dividend_date, cash_amount, currency, dividend_type, frequency,
       CASE WHEN ex_dividend_date = DATE '1997-03-14' THEN pay_date
            ELSE CAST(pay_date + INTERVAL 1 DAY AS DATE) END AS pay_date,
       record_date, declaration_date
FROM dividends"""


# -------------------------------------------------------------- universe --

_BASE = "('C' || CAST(c_nationkey AS VARCHAR) || '-' || CAST(c_custkey AS VARCHAR))"
CTE["cells"] = f"""
  WITH nat AS (SELECT r_name AS page, n_nationkey, n_name FROM nation JOIN region ON n_regionkey = r_regionkey),
  oc AS (SELECT nat.page, o_orderkey, c_custkey,
                CASE o_orderpriority WHEN '1-URGENT' THEN '  ' || lower({_BASE}) || ' '
                                     WHEN '2-HIGH' THEN replace({_BASE}, '-', '.')
                                     WHEN '3-MEDIUM' THEN lower({_BASE}) || chr(9)
                                     WHEN '4-NOT SPECIFIED' THEN 'nan' ELSE '' END AS sym
         FROM orders JOIN customer ON o_custkey = c_custkey JOIN nat ON c_nationkey = n_nationkey)
  SELECT page, 0 AS table_no, CAST(n_nationkey AS BIGINT) AS row_no, '0' AS col_name, false AS is_flat,
         n_name AS value FROM nat
  UNION ALL SELECT page, 1, CAST(n_nationkey AS BIGINT), 'Symbol', true, 'N' || CAST(n_nationkey AS VARCHAR) FROM nat
  UNION ALL SELECT page, 2, CAST(o_orderkey AS BIGINT), 'Symbol', true, sym FROM oc
  UNION ALL SELECT page, 2, CAST(o_orderkey AS BIGINT), 'Security', true, 'Customer ' || CAST(c_custkey AS VARCHAR) FROM oc
  UNION ALL SELECT page, 3, CAST(o_orderkey AS BIGINT), 'Symbol', false, 'X' || CAST(o_orderkey AS VARCHAR) FROM oc"""
_STRIP = "regexp_replace(value, '^\\s+|\\s+$', '', 'g')"
_NORM = f"replace(upper({_STRIP}), '-', '.')"
_BLANK = f"(value IS NULL OR {_STRIP} = '' OR lower({_STRIP}) = 'nan')"


def _selected(ticker_col: str) -> str:
    return f"""
  SELECT page, min(table_no) AS table_no FROM (
    SELECT page, table_no FROM cells GROUP BY page, table_no
    HAVING bool_or(col_name = '{ticker_col}') AND bool_and(is_flat) AND count(DISTINCT row_no) >= 50)
  GROUP BY page"""


for _col, _name in (("Symbol", "sym"), ("Ticker", "tick")):
    CTE[f"selected_{_name}"] = _selected(_col)
    DEPS[f"selected_{_name}"] = ["cells"]
    CTE[f"extracted_{_name}"] = f"""
  SELECT c.page, c.row_no, {_NORM} AS ticker FROM cells c
  JOIN selected_{_name} s ON c.page = s.page AND c.table_no = s.table_no
  WHERE c.col_name = '{_col}' AND NOT {_BLANK}"""
    DEPS[f"extracted_{_name}"] = ["cells", f"selected_{_name}"]
    CTE[f"fallback_{_name}"] = f"""
  SELECT * FROM (SELECT DISTINCT ticker, 'scrape' AS source, TIMESTAMP '2024-02-01 00:00:00' AS generated_at
                 FROM extracted_{_name})
  WHERE (SELECT count(DISTINCT page) FROM cells) = (SELECT count(*) FROM selected_{_name})
    AND (SELECT count(*) FROM extracted_{_name}) > 0
  UNION ALL
  SELECT * FROM frozen
  WHERE NOT ((SELECT count(DISTINCT page) FROM cells) = (SELECT count(*) FROM selected_{_name})
             AND (SELECT count(*) FROM extracted_{_name}) > 0)"""
    DEPS[f"fallback_{_name}"] = [f"extracted_{_name}", "frozen"]

CTE["idx_a"] = "SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS ticker FROM supplier WHERE s_acctbal >= 0"
CTE["idx_b"] = "SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS ticker FROM supplier WHERE s_nationkey < 13"
CTE["frozen"] = """
  SELECT DISTINCT ticker, 'frozen' AS source, TIMESTAMP '2024-01-08 12:00:00' AS generated_at
  FROM (SELECT ticker FROM idx_a UNION ALL SELECT ticker FROM idx_b)"""
DEPS["frozen"] = ["idx_a", "idx_b"]
CTE["membership"] = """
  SELECT 'IDXM' AS "index", 'S' || CAST(s_suppkey AS VARCHAR) AS ticker,
         CAST(DATE '1995-01-01' + CAST(s_nationkey * 40 AS INTEGER) AS DATE) AS added_date,
         CASE WHEN s_acctbal < 0 THEN DATE '1999-01-01' END AS removed_date
  FROM supplier"""

ORACLE["crypto_tickers"] = """
SELECT DISTINCT upper(event_type) AS base, 'X:' || upper(event_type) || 'USD' AS ticker FROM events"""
ORACLE["normalize_tickers"] = with_("cells") + f"""
SELECT page, CAST(table_no AS INTEGER) AS table_no, row_no, col_name, value AS raw, {_NORM} AS ticker,
       NOT {_BLANK} AS is_ticker
FROM cells"""
ORACLE["select_constituents"] = with_("cells") + """
SELECT page, table_no, n_rows FROM (
  SELECT page, table_no, count(DISTINCT row_no) AS n_rows,
         row_number() OVER (PARTITION BY page ORDER BY table_no) AS rn
  FROM cells GROUP BY page, table_no
  HAVING bool_or(col_name = 'Symbol') AND bool_and(is_flat) AND count(DISTINCT row_no) >= 50)
WHERE rn = 1"""
ORACLE["extract_tickers"] = with_("extracted_sym") + "SELECT * FROM extracted_sym"
ORACLE["universe_union"] = with_("idx_a", "idx_b") + """
SELECT DISTINCT ticker FROM (SELECT ticker FROM idx_a UNION ALL SELECT ticker FROM idx_b) ORDER BY ticker"""
ORACLE["universe_overlap"] = with_("idx_a", "idx_b") + "SELECT ticker FROM idx_a INTERSECT SELECT ticker FROM idx_b"
ORACLE["universe_adds"] = with_("idx_a", "idx_b") + "SELECT ticker FROM idx_b EXCEPT SELECT ticker FROM idx_a"
ORACLE["universe_diff"] = with_("idx_a", "idx_b") + """
SELECT ticker, 'added' AS change FROM (SELECT ticker FROM idx_b EXCEPT SELECT ticker FROM idx_a)
UNION ALL
SELECT ticker, 'removed' FROM (SELECT ticker FROM idx_a EXCEPT SELECT ticker FROM idx_b)"""
ORACLE["universe_snapshot"] = with_("idx_a", "idx_b") + """
SELECT DISTINCT ticker, 'scrape' AS source, TIMESTAMP '2024-01-08 12:00:00' AS generated_at
FROM (SELECT ticker FROM idx_a UNION ALL SELECT ticker FROM idx_b)"""
ORACLE["universe_with_fallback"] = with_("fallback_sym") + "SELECT * FROM fallback_sym"
ORACLE["universe_fallback_vintage"] = with_("fallback_tick") + "SELECT * FROM fallback_tick"
ORACLE["universe_freshness"] = with_("fallback_sym", "fallback_tick") + """
SELECT source, max(generated_at) AS generated_at, count(*) AS tickers,
       CAST(floor((epoch(TIMESTAMP '2024-02-01 00:00:00') - epoch(max(generated_at))) / 86400) AS BIGINT) AS age_days,
       CASE WHEN count(*) = 0 THEN 'MISSING'
            WHEN max(generated_at) IS NULL THEN 'STALE'
            WHEN epoch(TIMESTAMP '2024-02-01 00:00:00') < epoch(max(generated_at)) THEN 'WARN'
            WHEN floor((epoch(TIMESTAMP '2024-02-01 00:00:00') - epoch(max(generated_at))) / 86400) <= 7 THEN 'OK'
            WHEN floor((epoch(TIMESTAMP '2024-02-01 00:00:00') - epoch(max(generated_at))) / 86400) <= 14 THEN 'WARN'
            ELSE 'STALE' END AS flag
FROM (SELECT * FROM fallback_sym UNION ALL SELECT * FROM fallback_tick) GROUP BY source"""
ORACLE["freshness_report"] = with_("fallback_sym", "scal_sessions", "splits", "dividends") + """
, datasets AS (
  SELECT 'stocks_universe' AS dataset, count(*) AS rows, max(generated_at) AS last_refreshed FROM fallback_sym
  UNION ALL
  SELECT 'futures_contracts', count(*), CAST(max(last) + INTERVAL 1 DAY AS TIMESTAMP) FROM (
    SELECT max(CAST(l_shipdate AS DATE)) AS last FROM lineitem
    GROUP BY l_returnflag || CAST(year(CAST(l_shipdate AS DATE) + CAST(l_linenumber * 30 AS INTEGER)) AS VARCHAR)
             || 'Q' || CAST(quarter(CAST(l_shipdate AS DATE) + CAST(l_linenumber * 30 AS INTEGER)) AS VARCHAR))
  UNION ALL
  SELECT 'market_calendar', count(*), CAST(max(session_date) AS TIMESTAMP) FROM scal_sessions
  UNION ALL
  SELECT 'splits', count(*), CAST(max(execution_date) AS TIMESTAMP) FROM splits
  UNION ALL
  SELECT 'dividends', count(*), CAST(max(declaration_date) AS TIMESTAMP) FROM dividends),
thresholds AS (SELECT * FROM (VALUES ('stocks_universe', 7, 14), ('futures_contracts', 14, 30),
                                     ('market_calendar', 30, 90), ('splits', 2, 7), ('dividends', 2, 7))
               t(dataset, ok_days, stale_days)),
aged AS (
  SELECT d.*, CAST(floor((epoch(TIMESTAMP '2001-12-01 00:00:00') - epoch(last_refreshed)) / 86400) AS BIGINT) AS age_days,
         t.ok_days, t.stale_days
  FROM datasets d LEFT JOIN thresholds t ON d.dataset = t.dataset)
SELECT dataset, rows, last_refreshed, age_days, ok_days, stale_days, flag, flag <> 'OK' AS refresh
FROM (SELECT *, CASE WHEN coalesce(rows, 0) = 0 THEN 'MISSING' WHEN age_days IS NULL THEN 'STALE'
                     WHEN age_days < 0 THEN 'WARN' WHEN age_days <= ok_days THEN 'OK'
                     WHEN age_days <= stale_days THEN 'WARN' ELSE 'STALE' END AS flag FROM aged)"""
ORACLE["universe_at"] = with_("membership") + """
SELECT "index", ticker FROM membership
WHERE added_date <= DATE '1997-06-30' AND (removed_date IS NULL OR DATE '1997-06-30' < removed_date)"""
ORACLE["bars_in_membership"] = with_("stock_daily", "membership") + """
SELECT b.*, m."index" FROM stock_daily b JOIN membership m
  ON b.symbol = m.ticker AND CAST(b.timestamp AS DATE) >= m.added_date
 AND (m.removed_date IS NULL OR CAST(b.timestamp AS DATE) < m.removed_date)"""
ORACLE["universe_coverage"] = with_("idx_a", "idx_b", "stock_daily") + """
SELECT ticker, 'no_bars' AS issue FROM (
  SELECT ticker FROM idx_a UNION SELECT ticker FROM idx_b EXCEPT SELECT symbol FROM stock_daily)
UNION ALL
SELECT ticker, 'not_in_universe' FROM (
  SELECT symbol AS ticker FROM stock_daily EXCEPT (SELECT ticker FROM idx_a UNION SELECT ticker FROM idx_b))"""
ORACLE["universe_freeze_roundtrip"] = with_("frozen") + "SELECT * FROM frozen"
ORACLE["parse_symbol_list"] = """
WITH items AS (
  SELECT l_orderkey, l_linenumber, l_partkey,
         CASE WHEN l_linenumber % 2 = 1 THEN ' s' || CAST(l_suppkey AS VARCHAR) || ' '
              ELSE upper('s' || CAST(l_suppkey AS VARCHAR)) || ',' END AS item
  FROM lineitem),
lists AS (SELECT l_orderkey, string_agg(item, ',' ORDER BY l_linenumber, l_partkey, item) AS list
          FROM items GROUP BY l_orderkey),
parts AS (SELECT l_orderkey, unnest(string_split(list, ',')) AS p,
                 unnest(range(1, len(string_split(list, ',')) + 1)) AS i FROM lists),
firsts AS (SELECT l_orderkey, upper(regexp_replace(p, '^\\s+|\\s+$', '', 'g')) AS symbol, min(i) AS i
           FROM parts WHERE upper(regexp_replace(p, '^\\s+|\\s+$', '', 'g')) <> ''
           GROUP BY 1, 2)
SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY i) - 1 AS INTEGER) AS pos, symbol
FROM firsts"""


# --------------------------------------------------------------- futures --

_DELIV = "(CAST(l_shipdate AS DATE) + CAST(l_linenumber * 30 AS INTEGER))"
CTE["futures_ticks"] = f"""
  SELECT l_returnflag AS root,
         l_returnflag || CAST(year({_DELIV}) AS VARCHAR) || 'Q' || CAST(quarter({_DELIV}) AS VARCHAR) AS symbol,
         l_shipdate AS ts, l_orderkey, l_linenumber, l_partkey,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(l_quantity AS BIGINT) AS size
  FROM lineitem"""
CTE["futures_daily"] = bars_cte("futures_ticks", "date_trunc('day', ts)", "ts, l_orderkey, l_linenumber, l_partkey")
DEPS["futures_daily"] = ["futures_ticks"]
CTE["contracts"] = """
  SELECT symbol AS ticker, root AS product_code, 'Root ' || root || ' ' || substring(symbol, 2, 6) AS name,
         substring(symbol, 2, 6) AS month, min(CAST(ts AS DATE)) AS first_trade_date,
         max(CAST(ts AS DATE)) AS last_trade_date, 'XTST' AS exchange_mic, CAST(0.25 AS DOUBLE) AS tick_size,
         CAST(max(CAST(ts AS DATE)) + INTERVAL 1 DAY AS TIMESTAMP) AS discovered_at
  FROM futures_ticks GROUP BY symbol, root"""
DEPS["contracts"] = ["futures_ticks"]
CTE["fut_bars"] = """
  SELECT b.*, CAST(b.timestamp AS DATE) AS day, c.product_code AS root, c.last_trade_date,
         strftime(c.last_trade_date, '%Y-%m-%d') || '|' || b.symbol AS ident
  FROM futures_daily b JOIN contracts c ON b.symbol = c.ticker"""
DEPS["fut_bars"] = ["futures_daily", "contracts"]


def _continuous(pick: str) -> str:
    return f"""
SELECT a.root, a.day, b.symbol AS contract, b.open, b.high, b.low, b.close, b.volume
FROM (SELECT root, day, split_part(max(p) OVER (PARTITION BY root ORDER BY day
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '|', 2) AS symbol
      FROM (SELECT root, day, {pick} AS p FROM fut_bars GROUP BY root, day)) a
JOIN fut_bars b ON a.symbol = b.symbol AND a.day = b.day"""


ORACLE["futures_contracts"] = with_("contracts") + "SELECT * FROM contracts"
ORACLE["futures_fetch_plan"] = with_("contracts", "futures_daily") + """
SELECT * FROM (
  SELECT c.ticker, c.product_code,
         greatest(greatest(c.first_trade_date, DATE '1996-01-01'),
                  coalesce(CAST(s.lcd + INTERVAL 1 DAY AS DATE), greatest(c.first_trade_date, DATE '1996-01-01')))
           AS from_date,
         least(c.last_trade_date, DATE '2001-06-30') AS to_date,
         CASE WHEN s.lcd >= least(c.last_trade_date, DATE '2001-06-30') THEN 'up_to_date' ELSE 'fetch' END AS action
  FROM contracts c
  LEFT JOIN (SELECT symbol, max(CAST(timestamp AS DATE)) AS lcd FROM futures_daily
             WHERE timestamp < TIMESTAMP '1999-01-01' GROUP BY symbol) s ON c.ticker = s.symbol
  WHERE c.last_trade_date >= DATE '1996-01-01')
WHERE action = 'up_to_date' OR from_date <= to_date"""
ORACLE["continuous_calendar"] = with_("fut_bars", "contracts") + """
SELECT a.root, a.day, b.symbol AS contract, b.open, b.high, b.low, b.close, b.volume
FROM (SELECT root, day, split_part(max(p) OVER (PARTITION BY root ORDER BY day
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '|', 2) AS symbol
      FROM (SELECT product_code AS root, day,
                   min(strftime(last_trade_date, '%Y-%m-%d') || '|' || ticker) AS p
            FROM (SELECT product_code, ticker, last_trade_date,
                         CAST(unnest(generate_series(first_trade_date, last_trade_date, INTERVAL 1 DAY)) AS DATE) AS day
                  FROM contracts)
            GROUP BY 1, 2)) a
JOIN fut_bars b ON a.symbol = b.symbol AND a.day = b.day"""
ORACLE["continuous_volume"] = with_("fut_bars") + _continuous("arg_min(ident, (-volume, last_trade_date, symbol))")

# ------------------------------------------------------- status and runs --

ORACLE["status_summary"] = with_("lake_bars") + """
SELECT asset_class, timeframe, count(*) AS symbols, min(earliest_date) AS oldest_date,
       max(last_complete_date) AS newest_date, sum(bar_count) AS bars, max(last_updated_at) AS last_updated_at
FROM (SELECT asset_class, symbol, timeframe, min(CAST(timestamp AS DATE)) AS earliest_date,
             max(CAST(timestamp AS DATE)) AS last_complete_date, count(*) AS bar_count,
             CASE WHEN asset_class = 'crypto' THEN TIMESTAMP '2024-01-31 01:00:00'
                  ELSE TIMESTAMP '2001-11-05 01:00:00' END AS last_updated_at
      FROM lake_bars GROUP BY 1, 2, 3)
GROUP BY ROLLUP (asset_class, timeframe)"""
ORACLE["status_summary"] = ORACLE["status_summary"].replace(
    "sum(bar_count) AS bars", "CAST(sum(bar_count) AS BIGINT) AS bars")
CTE["run_log"] = """
  SELECT 'run-' || strftime(day, '%Y%m%d') AS run_id, started_at, finished_at, 'update' AS command,
         CASE WHEN att - bad = att THEN 'success' WHEN att - bad = 0 THEN 'failed' ELSE 'partial' END AS status,
         CASE WHEN bad > 0 THEN CAST(bad AS VARCHAR) || ' symbols failed' END AS error_message,
         CAST(att AS INTEGER) AS symbols_attempted, CAST(att - bad AS INTEGER) AS symbols_succeeded,
         CAST(bars AS BIGINT) AS bars_written
  FROM (SELECT CAST(ts AS DATE) AS day, min(ts) AS started_at, max(ts) AS finished_at,
               count(DISTINCT user_id) AS att,
               count(DISTINCT CASE WHEN event_type = 'error' THEN user_id END) AS bad,
               count(*) FILTER (WHERE event_type <> 'error') AS bars
        FROM events GROUP BY 1)"""
ORACLE["run_log_summary"] = with_("run_log") + """
SELECT run_id, status, symbols_attempted, symbols_succeeded, bars_written,
       CAST(floor((epoch_us(finished_at) - epoch_us(started_at)) / 1000000) AS BIGINT) AS duration_seconds
FROM run_log"""
ORACLE["recent_runs"] = with_("run_log") + "SELECT * FROM run_log ORDER BY started_at DESC, run_id DESC LIMIT 5"

# ------------------------------------------------------ validation report --

CTE["findings"] = """
  SELECT 'stocks' AS asset_class, 'daily' AS timeframe, symbol, missing_date FROM stock_missing
  UNION ALL
  SELECT 'crypto', 'daily', symbol, missing_date FROM (
    SELECT symbol, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS missing_date
    FROM (SELECT symbol, min(CAST(timestamp AS DATE)) AS lo, max(CAST(timestamp AS DATE)) AS hi
          FROM crypto_daily GROUP BY symbol)
    EXCEPT ALL SELECT symbol, CAST(timestamp AS DATE) FROM crypto_daily)"""
DEPS["findings"] = ["stock_missing", "crypto_daily"]
ORACLE["validation_report"] = with_("findings", "stock_daily", "crypto_daily") + """
SELECT s.asset_class, s.timeframe, count(*) AS symbols, count(*) FILTER (WHERE f.missing IS NULL) AS healthy,
       count(*) FILTER (WHERE f.missing IS NOT NULL) AS warnings,
       CAST(coalesce(sum(f.missing), 0) AS BIGINT) AS missing_sessions
FROM (SELECT DISTINCT 'stocks' AS asset_class, 'daily' AS timeframe, symbol FROM stock_daily
      UNION ALL SELECT DISTINCT 'crypto', 'daily', symbol FROM crypto_daily) s
LEFT JOIN (SELECT asset_class, timeframe, symbol, count(*) AS missing FROM findings GROUP BY 1, 2, 3) f
  ON s.asset_class = f.asset_class AND s.timeframe = f.timeframe AND s.symbol = f.symbol
GROUP BY 1, 2"""
ORACLE["validation_findings"] = with_("findings") + """
SELECT asset_class, timeframe, symbol, CAST(year(missing_date) AS INTEGER) AS year, count(*) AS missing,
       string_agg(strftime(missing_date, '%Y-%m-%d'), ',' ORDER BY missing_date) AS missing_dates
FROM findings GROUP BY 1, 2, 3, 4"""

ORACLE["bars_scan_all"] = with_("stock_daily") + "SELECT * FROM stock_daily"
ORACLE["bars_scan"] = with_("stock_daily") + "SELECT * FROM stock_daily WHERE year(timestamp) = 1998"

# ------------------------------------------------ profiles, coverage, stamps --

register_calendar("ecal", "SELECT CAST(min(ts) AS DATE) AS s, CAST(max(ts) AS DATE) AS e FROM events")
ORACLE["profile_calendars"] = with_("ecal_sessions", "ecal_days", "ecal_holidays") + """
SELECT 'crypto' AS asset_class, '24x7' AS calendar, count(*) AS sessions, min(day) AS first_session,
       max(day) AS last_session FROM ecal_days
UNION ALL
SELECT 'futures', 'US_WEEKDAYS', count(*), min(day), max(day) FROM ecal_days WHERE isodow(day) <= 5
  AND day NOT IN (SELECT holiday_date FROM ecal_holidays)
UNION ALL
SELECT 'stocks', 'NYSE', count(*), min(session_date), max(session_date) FROM ecal_sessions"""
ORACLE["minute_coverage"] = with_("crypto_minute") + """
SELECT symbol, CAST(timestamp AS DATE) AS day, count(*) AS bars, 1440 - count(*) AS missing_minutes
FROM crypto_minute GROUP BY 1, 2"""
register_calendar("fcal", "SELECT CAST(min(l_shipdate) AS DATE) AS s, CAST(max(l_shipdate) AS DATE) AS e FROM lineitem")
ORACLE["futures_gaps_weekdays"] = with_("futures_daily", "fcal_holidays") + f"""
SELECT symbol, missing_date FROM (
  SELECT symbol, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS missing_date
  FROM (SELECT symbol, min(CAST(timestamp AS DATE)) AS lo, max(CAST(timestamp AS DATE)) AS hi
        FROM futures_daily GROUP BY symbol))
WHERE isodow(missing_date) <= 5 AND missing_date NOT IN (
  SELECT holiday_date FROM fcal_holidays
  WHERE holiday_date NOT IN (SELECT holiday_date FROM ({CLOSURES_SQL}) c(holiday_date, name)))
EXCEPT ALL
SELECT symbol, CAST(timestamp AS DATE) FROM futures_daily"""
ORACLE["iso_stamps"] = with_("run_log") + """
, f AS (SELECT run_id, strftime(started_at, '%Y-%m-%dT%H:%M:%SZ') AS iso, day(started_at) % 4 AS form, started_at FROM run_log)
SELECT run_id, iso AS started_iso,
       CASE form WHEN 0 THEN iso WHEN 1 THEN strftime(started_at + INTERVAL 330 MINUTE, '%Y-%m-%dT%H:%M:%S') || '+05:30'
                 WHEN 2 THEN strftime(started_at, '%Y-%m-%dT%H:%M:%S') ELSE 'at ' || strftime(started_at, '%H:%M') END AS sent,
       CASE WHEN form <> 3 THEN iso END AS parsed_iso, CASE WHEN form <> 3 THEN true END AS roundtrip_ok
FROM f"""

# -------------------------------------------------------------- streaming --

ORACLE["stream_update_state"] = with_("crypto_daily") + """
SELECT 'crypto' AS asset_class, symbol, 'daily' AS timeframe, min(CAST(timestamp AS DATE)) AS earliest_date,
       max(CAST(timestamp AS DATE)) AS last_complete_date, count(*) AS bar_count
FROM crypto_daily GROUP BY symbol"""
ORACLE["stream_minute_bars"] = with_("crypto_minute") + """
SELECT * FROM crypto_minute
WHERE timestamp + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"""
ORACLE["minute_gaps_24x7"] = with_("crypto_minute") + """
SELECT symbol, unnest(generate_series(lo, hi, INTERVAL 1 MINUTE)) AS missing_minute
FROM (SELECT symbol, min(timestamp) AS lo, max(timestamp) AS hi FROM crypto_minute GROUP BY 1)
EXCEPT ALL
SELECT symbol, timestamp FROM crypto_minute"""

ORACLE["minute_gaps_sessions"] = with_("crypto_minute", "ecal_sessions") + """
, spans AS (SELECT symbol, min(timestamp) AS lo, max(timestamp) AS hi FROM crypto_minute GROUP BY 1),
hours AS (
  SELECT timezone('UTC', timezone('America/New_York', CAST(session_date AS TIMESTAMP) + INTERVAL 570 MINUTE)) AS o,
         timezone('UTC', timezone('America/New_York', CAST(session_date AS TIMESTAMP) + INTERVAL 959 MINUTE)) AS c
  FROM ecal_sessions)
SELECT symbol, unnest(generate_series(greatest(lo, o), least(hi, c), INTERVAL 1 MINUTE)) AS missing_minute
FROM spans JOIN hours ON o <= hi AND c >= lo
EXCEPT ALL
SELECT symbol, timestamp FROM crypto_minute"""

ORACLE["gap_refetch_plan"] = with_("stock_missing", "scal_sessions") + """
SELECT 'stocks' AS asset_class, symbol, 'daily' AS timeframe, min(missing_date) AS from_date,
       max(missing_date) AS to_date, 'fetch' AS action
FROM (SELECT m.symbol, m.missing_date,
             s.ordinal - row_number() OVER (PARTITION BY m.symbol ORDER BY s.ordinal) AS grp
      FROM stock_missing m JOIN scal_sessions s ON m.missing_date = s.session_date)
GROUP BY symbol, grp"""


# --------------------------------------------------------- lake validation --

register_calendar("vcal", "SELECT CAST(min(l_shipdate) AS DATE) AS s, DATE '2001-11-30' AS e FROM lineitem")
CTE["vcal_le"] = """
  SELECT d.day, coalesce(s.ordinal, 0) AS le FROM vcal_dense d
  LEFT JOIN vcal_sessions s ON d.session_on_or_before = s.session_date"""
DEPS["vcal_le"] = ["vcal_dense", "vcal_sessions"]
ORACLE["lake_validation_report"] = with_("stock_missing", "vcal_le") + """
, lcd AS (SELECT symbol, max(CAST(timestamp AS DATE)) AS lcd FROM stock_daily GROUP BY symbol),
cov AS (SELECT l.symbol FROM lcd l JOIN vcal_le d ON l.lcd = d.day
        JOIN vcal_le n ON n.day = DATE '2001-11-30' WHERE n.le - d.le > 1),
gaps AS (SELECT symbol, count(*) AS n FROM stock_missing GROUP BY symbol)
SELECT 'stocks' AS asset_class, 'daily' AS timeframe, count(*) AS symbols,
       count(*) FILTER (WHERE g.n IS NULL AND c.symbol IS NULL) AS healthy,
       count(*) FILTER (WHERE g.n IS NOT NULL OR c.symbol IS NOT NULL) AS warnings,
       (SELECT count(*) FROM stock_missing) AS gap, CAST(0 AS BIGINT) AS ohlc, CAST(0 AS BIGINT) AS duplicate,
       CAST(0 AS BIGINT) AS "null", (SELECT count(*) FROM cov) AS coverage
FROM lcd s LEFT JOIN gaps g ON s.symbol = g.symbol LEFT JOIN cov c ON s.symbol = c.symbol"""

ORACLE["landing_column_audit"] = with_("crypto_daily") + """
SELECT symbol, 'o' AS "column", count(*) AS rows, count(*) FILTER (WHERE open IS NULL) AS nulls,
       count(*) = count(*) FILTER (WHERE open IS NULL) AS missing
FROM crypto_daily GROUP BY symbol
UNION ALL
SELECT symbol, 'h' AS "column", count(*) AS rows, count(*) FILTER (WHERE high IS NULL) AS nulls,
       count(*) = count(*) FILTER (WHERE high IS NULL) AS missing
FROM crypto_daily GROUP BY symbol
UNION ALL
SELECT symbol, 'l' AS "column", count(*) AS rows, count(*) FILTER (WHERE low IS NULL) AS nulls,
       count(*) = count(*) FILTER (WHERE low IS NULL) AS missing
FROM crypto_daily GROUP BY symbol
UNION ALL
SELECT symbol, 'c' AS "column", count(*) AS rows, count(*) FILTER (WHERE close IS NULL) AS nulls,
       count(*) = count(*) FILTER (WHERE close IS NULL) AS missing
FROM crypto_daily GROUP BY symbol
UNION ALL
SELECT symbol, 'v' AS "column", count(*) AS rows, count(*) FILTER (WHERE volume IS NULL) AS nulls,
       count(*) = count(*) FILTER (WHERE volume IS NULL) AS missing
FROM crypto_daily GROUP BY symbol
UNION ALL
SELECT symbol, 'vw' AS "column", count(*) AS rows, count(*) FILTER (WHERE vwap IS NULL) AS nulls,
       count(*) = count(*) FILTER (WHERE vwap IS NULL) AS missing
FROM crypto_daily GROUP BY symbol
UNION ALL
SELECT symbol, 't' AS "column", count(*) AS rows, count(*) FILTER (WHERE timestamp IS NULL) AS nulls,
       count(*) = count(*) FILTER (WHERE timestamp IS NULL) AS missing
FROM crypto_daily GROUP BY symbol
UNION ALL
SELECT symbol, 'n' AS "column", count(*) AS rows, count(*) FILTER (WHERE transactions IS NULL) AS nulls,
       count(*) = count(*) FILTER (WHERE transactions IS NULL) AS missing
FROM crypto_daily GROUP BY symbol
UNION ALL
SELECT symbol, 'otc' AS "column", count(*) AS rows, count(*) FILTER (WHERE otc IS NULL) AS nulls,
       count(*) = count(*) FILTER (WHERE otc IS NULL) AS missing
FROM crypto_daily GROUP BY symbol"""


# ------------------------------------------- landing: attempts, ledger, pending --

ORACLE["stream_pending_bars"] = with_("crypto_minute") + """
SELECT symbol, CAST(timestamp AS DATE) AS day, count(*) AS bars, CAST(sum(CAST(volume AS BIGINT)) AS BIGINT) AS volume
FROM crypto_minute WHERE timestamp < TIMESTAMP '2024-01-15 12:00:00' GROUP BY 1, 2"""
ORACLE["attempt_dispositions"] = with_("user_daily") + """
, u AS (SELECT symbol, CAST(substr(symbol, 2) AS BIGINT) % 6 AS k, count(*) AS n FROM user_daily
        WHERE timestamp < TIMESTAMP '2024-02-01' GROUP BY 1, 2)
SELECT symbol, CASE WHEN k IN (1, 3, 4) THEN 'error' WHEN k = 5 THEN 'zero_bar' ELSE 'succeeded' END AS disposition,
       CASE WHEN k IN (0, 1, 2) THEN n ELSE 0 END AS bars, CAST(CASE WHEN k IN (2, 3) THEN 1 ELSE 0 END AS BIGINT) AS quarantined
FROM u"""
ORACLE["landing_new_files"] = with_("user_daily") + """
, w AS (SELECT symbol, CASE WHEN timestamp < TIMESTAMP '2024-01-11' THEN 0 WHEN timestamp < TIMESTAMP '2024-01-21' THEN 1 ELSE 2 END AS run
        FROM user_daily WHERE timestamp < TIMESTAMP '2024-02-01'),
r AS (SELECT unnest([0, 1, 2, 3]) AS run)
SELECT CAST(r.run AS INTEGER) AS run, count(DISTINCT w.symbol) AS files_opened, count(w.symbol) AS bars_written
FROM r LEFT JOIN w USING (run) GROUP BY 1"""


# ------------------------------------ intervals, stored order, change log, crossover --

_RANGES = """
SELECT symbol, min(missing_minute) AS first_missing, max(missing_minute) AS last_missing, count(*) AS minutes
FROM (SELECT *, epoch(missing_minute) / 60 - row_number() OVER (PARTITION BY symbol{0} ORDER BY missing_minute) AS grp FROM missing)
GROUP BY symbol, grp{0}"""
for _name, _old, _by in (("minute_gap_ranges", "minute_gaps_sessions", ", CAST(missing_minute AS DATE)"),
                         ("minute_gap_ranges_24x7", "minute_gaps_24x7", "")):
    ORACLE[_name] = f"WITH missing AS ({ORACLE[_old]})" + _RANGES.format(_by)
ORACLE["stored_order_check"] = with_("user_daily") + """
, placed AS (SELECT symbol, timestamp, row_number() OVER (PARTITION BY symbol ORDER BY
               CASE WHEN CAST(substr(symbol, 2) AS BIGINT) % 3 = 0 THEN -epoch_us(timestamp) ELSE epoch_us(timestamp) END) AS place
             FROM user_daily),
stepped AS (SELECT symbol, timestamp <= lag(timestamp) OVER (PARTITION BY symbol ORDER BY place) AS bad FROM placed)
SELECT symbol, count(*) AS rows, count(*) FILTER (bad) AS violations FROM stepped GROUP BY symbol"""
CTE["member_log"] = """
  SELECT "index", ticker, added_date AS date, 'added' AS change, k FROM mk WHERE k % 5 <> 0
  UNION ALL SELECT "index", ticker, removed_date, 'removed', k FROM mk WHERE removed_date IS NOT NULL AND k % 2 <> 0
  UNION ALL SELECT "index", ticker, DATE '2000-06-01', 'added', k FROM mk WHERE removed_date IS NOT NULL AND k % 3 = 0
  UNION ALL SELECT "index", ticker, DATE '2001-02-01', 'removed', k FROM mk WHERE removed_date IS NOT NULL AND k % 6 = 0"""
CTE["mk"] = "SELECT *, CAST(substr(ticker, 2) AS BIGINT) AS k FROM membership"
# Membership of every ticker in every stretch between its changes, asked of what follows the stretch.
CTE["stretches"] = """
  SELECT e."index", e.ticker, e.date AS lo, e.change, f.date AS hi,
         CASE WHEN f.change IS NOT NULL THEN f.change = 'removed' ELSE m.removed_date IS NULL OR m.k % 6 = 3 END AS member
  FROM (SELECT * FROM member_log UNION ALL SELECT "index", ticker, DATE '1900-01-01', 'start', k FROM mk) e
  JOIN mk m ON e.ticker = m.ticker
  LEFT JOIN member_log f ON f.ticker = e.ticker
   AND f.date = (SELECT min(g.date) FROM member_log g WHERE g.ticker = e.ticker AND g.date > e.date)"""
DEPS |= {"mk": ["membership"], "member_log": ["mk"], "stretches": ["mk", "member_log"]}
_INTERVALS = """SELECT "index", ticker, lo AS added_date, hi AS removed_date FROM stretches WHERE member"""
ORACLE["membership_from_changes"] = with_("stretches") + _INTERVALS
ORACLE["change_contradictions"] = with_("stretches") + """
SELECT "index", ticker, lo AS date, change,
       CASE WHEN change = 'added' THEN 'added, but no member ' ELSE 'removed, but a member ' END
       || CASE WHEN hi IS NULL THEN 'today' ELSE 'from ' || CAST(hi AS VARCHAR) END AS reason
FROM stretches WHERE change <> 'start' AND member <> (change = 'added')"""
ORACLE["universe_at_stored"] = with_("stretches") + f"""
SELECT ticker FROM ({_INTERVALS}) WHERE added_date <= DATE '2000-12-31' AND (removed_date IS NULL OR DATE '2000-12-31' < removed_date)"""
ORACLE["continuous_open_interest"] = with_("fut_bars").replace("WITH ", "WITH RECURSIVE ", 1) + """
, q AS (SELECT root, day, symbol, last_trade_date AS expiry, floor(volume / 100) AS v FROM fut_bars),
days AS (SELECT root, day, row_number() OVER (PARTITION BY root ORDER BY day) AS n FROM (SELECT DISTINCT root, day FROM q)),
fold AS (
  SELECT d.root, d.n, d.day, arg_min(q.symbol, (-q.v, q.expiry, q.symbol)) AS symbol,
         arg_min(q.expiry, (-q.v, q.expiry, q.symbol)) AS expiry
  FROM days d JOIN q ON q.root = d.root AND q.day = d.day WHERE d.n = 1 GROUP BY ALL
  UNION ALL
  SELECT root, n, day, CASE WHEN roll THEN to_symbol ELSE symbol END, CASE WHEN roll THEN to_expiry ELSE expiry END
  FROM (SELECT d.root, d.n, d.day, f.symbol, f.expiry, b.symbol AS to_symbol, b.expiry AS to_expiry,
               b.symbol IS NOT NULL AND (f.expiry < d.day OR b.v > coalesce(o.v, 0)) AS roll
        FROM fold f JOIN days d ON d.root = f.root AND d.n = f.n + 1
        LEFT JOIN q o ON o.root = d.root AND o.day = d.day AND o.symbol = f.symbol
        LEFT JOIN q b ON b.root = d.root AND b.day = d.day AND (b.expiry, b.symbol) > (f.expiry, f.symbol)
        QUALIFY row_number() OVER (PARTITION BY d.root ORDER BY b.v DESC NULLS LAST, b.expiry, b.symbol) = 1))
SELECT f.root, f.day, f.symbol AS contract, b.open, b.high, b.low, b.close, b.volume
FROM fold f JOIN fut_bars b ON b.symbol = f.symbol AND b.day = f.day"""
ORACLE["skipped_dividends"] = with_("stock_daily") + """
, d AS (SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS symbol, e AS ex_dividend_date,
               round(round(s_acctbal / 10000, 2) * 100000, 2) AS cash_amount
        FROM supplier, unnest([DATE '1997-03-14', DATE '1999-09-15']) AS t(e) WHERE s_acctbal > 0),
c AS (SELECT d.*, (SELECT arg_max(b.close, b.timestamp) FROM stock_daily b
                   WHERE b.symbol = d.symbol AND b.timestamp < d.ex_dividend_date) AS prev_close FROM d)
SELECT symbol, ex_dividend_date, cash_amount, prev_close,
       CASE WHEN prev_close IS NULL THEN 'no bar before the ex-date' ELSE 'cash is not below the close before the ex-date' END AS reason
FROM c WHERE prev_close IS NULL OR cash_amount >= prev_close"""
ORACLE["flatfile_ingest_state"] = with_("stock_daily") + """
SELECT CAST(date_trunc('month', timestamp) AS DATE) AS day, 'taken' AS status, count(DISTINCT symbol) AS tickers, count(*) AS rows,
       CAST(0 AS BIGINT) AS bad, count(*) AS lake_bars, CAST(0 AS BIGINT) AS opened_again
FROM stock_daily GROUP BY 1"""
ORACLE["futures_contract_job"] = with_("contracts", "futures_daily") + """
SELECT 'futures' AS asset_class, b.symbol, 'daily' AS timeframe, min(CAST(timestamp AS DATE)) AS earliest_date,
       max(CAST(timestamp AS DATE)) AS last_complete_date, count(*) AS bar_count
FROM futures_daily b JOIN contracts c ON b.symbol = c.ticker
WHERE c.last_trade_date >= DATE '1996-01-01' AND CAST(timestamp AS DATE) BETWEEN DATE '1996-01-01' AND DATE '2001-06-30'
GROUP BY b.symbol"""
ORACLE["schema_drift"] = with_("stock_daily") + """
, y AS (SELECT CAST(year(timestamp) AS INTEGER) AS year, count(*) AS rows FROM stock_daily GROUP BY 1)
SELECT 'stocks' AS asset_class, 'daily' AS timeframe, year, 'volume' AS "column", 'int64' AS found, 'double' AS expected, 'type' AS issue, rows
FROM y WHERE year % 2 = 0
UNION ALL SELECT 'stocks', 'daily', year, 'vwap', NULL, 'double', 'missing', rows FROM y WHERE year % 2 = 0"""
