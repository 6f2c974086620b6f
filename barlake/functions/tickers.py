"""Column expressions for tickers and symbol lists (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_all(c) -> Column:
    """Remove leading/trailing whitespace of any kind (``trim`` strips spaces only)."""
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


def normalize_ticker(c) -> Column:
    """Canonical dot form: strip, upper-case, dash to dot. Idempotent."""
    return F.replace(F.upper(strip_all(c)), F.lit("-"), F.lit("."))


def is_blank_ticker(c) -> Column:
    """True for null, blank and ``nan`` (any case) cells, which are not tickers."""
    s = strip_all(c)
    return _col(c).isNull() | (s == "") | (F.lower(s) == "nan")


def crypto_ticker(base, quote="USD") -> Column:
    """``X:{BASE}{QUOTE}``; base and quote are upper-cased."""
    q = F.lit(quote) if isinstance(quote, str) and quote.isalpha() and quote.isupper() else _col(quote)
    return F.concat(F.lit("X:"), F.upper(_col(base)), F.upper(q))


def base_symbol(c) -> Column:
    """Storage name of an instrument: ``X:BTCUSD`` -> ``BTC``; stocks unchanged."""
    s = _col(c)
    return F.when(s.startswith("X:"), F.regexp_extract(s, r"^X:(.+?)(USD)?$", 1)).otherwise(s)


def parse_symbol_list(c) -> Column:
    """Comma list -> array: split, strip, drop empty, upper, first-seen dedupe."""
    parts = F.transform(F.split(_col(c), ","), lambda x: F.upper(strip_all(x)))
    return F.array_distinct(F.filter(parts, lambda x: x != ""))
