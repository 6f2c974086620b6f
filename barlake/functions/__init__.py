"""Column-expression helpers (built-in Spark functions only, no UDFs)."""

from barlake.functions.tickers import (  # noqa: F401
    base_symbol, crypto_ticker, is_blank_ticker, normalize_ticker, parse_symbol_list, strip_all,
)
from barlake.functions.time import (  # noqa: F401
    bar_start, exchange_date, exchange_local, from_epoch_ms, from_epoch_ns, session_class,
    to_utc_instant, whole_days_between,
)
