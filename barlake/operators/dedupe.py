"""Keep-first / keep-last de-duplication and the duplicate policy (WN-1, WN-2, V-3).

The pick is an aggregation, not a window: ``min_by(struct(row), struct(order))``
per key is a declarative aggregate, so duplicates of a key are already reduced
map-side before the shuffle. A key that holds a third of all rows therefore
costs one partial row per map task instead of one giant window partition.
``dropDuplicates`` is not used: it keeps an arbitrary row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP_FIRST = "keep_first"
KEEP_LAST = "keep_last"
FAIL = "fail"


class DuplicateKeyError(ValueError):
    """Raised by the ``fail`` policy when a key occurs more than once."""


def _order(order_cols: Sequence[str | Column]) -> Column:
    return F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_cols])


def keep_one(df: DataFrame, key: Sequence[str], order_cols: Sequence[str | Column],
             policy: str = KEEP_FIRST) -> DataFrame:
    """One row per ``key``: the first (or last) by ``order_cols``.

    ``order_cols`` should make the order total within a key (end with the value
    columns if needed); columns of the result keep the input order.
    """
    if policy == FAIL:
        assert_unique(df, key)
        return df
    if policy not in (KEEP_FIRST, KEEP_LAST):
        raise ValueError(f"unknown duplicate policy {policy!r}")
    payload = [c for c in df.columns if c not in key]
    pick = F.min_by if policy == KEEP_FIRST else F.max_by
    row = F.struct(*[F.col(c) for c in payload]) if payload else F.lit(None)
    picked = df.groupBy(*key).agg(pick(row, _order(order_cols)).alias("_row"))
    return picked.select(*[F.col(k) for k in key], *[F.col(f"_row.{c}").alias(c) for c in payload]) \
        .select(*df.columns)


def duplicate_report(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their multiplicity (partial-aggregated)."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def assert_unique(df: DataFrame, key: Sequence[str]) -> None:
    dup = duplicate_report(df, key)
    first = dup.limit(1).collect()
    if first:
        raise DuplicateKeyError(f"duplicate key {dict((k, first[0][k]) for k in key)} "
                                f"occurs {first[0]['n_rows']} times")
