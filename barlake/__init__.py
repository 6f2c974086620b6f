"""barlake: a market-bar lake (OHLCV) built from Spark DataFrame jobs.

Subpackages:
  sources    -- scans of landing data, flat files, the lake and the supplied test tables
  functions  -- column expressions (tickers, epoch units, exchange time)
  operators  -- DataFrame -> DataFrame operators (bars, merge, state, calendar, ...)
  plans      -- multi-step jobs (backfill, lake writes) and the query catalogue
  streaming  -- the incremental update as a Structured Streaming job
"""

__version__ = "0.1.0"
