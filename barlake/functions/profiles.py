"""Per-asset-class profiles (UD-1): the few things that differ between asset
classes, as Column expressions and names, never Python UDFs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from barlake.functions.time import exchange_date


@dataclass(frozen=True)
class AssetProfile:
    asset_class: str
    calendar: str            # NYSE, US_WEEKDAYS, WEEKDAYS or 24x7 (see operators.calendar)
    exchange_dates: bool     # state and gaps by exchange (New York) date, not UTC date

    def bar_date(self, ts: Column, timeframe: str) -> Column:
        """Date a bar belongs to: minute stock bars after 19:00 New York time
        fall on the next UTC date, so they use the exchange date."""
        if self.exchange_dates and timeframe == "minute":
            return exchange_date(ts)
        return F.to_date(ts)


# The profiles of the supported asset classes.
STOCKS = AssetProfile("stocks", "NYSE", True)
FUTURES = AssetProfile("futures", "US_WEEKDAYS", True)
CRYPTO = AssetProfile("crypto", "24x7", False)
PROFILES = {p.asset_class: p for p in (STOCKS, FUTURES, CRYPTO)}
