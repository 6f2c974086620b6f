"""Join helpers: interval and as-of joins. Whether a side is broadcast is left to
the planner, which goes by its size in bytes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def interval_join(left: DataFrame, intervals: DataFrame, key: Sequence[str], at: Column,
                  start: str = "valid_from", end: str = "valid_to", how: str = "left") -> DataFrame:
    """Rows of ``left`` with the interval of the same key containing ``at``:
    ``start <= at < end`` (null start/end are open). An equi-join on ``key``
    with a residual range predicate, never a pure theta join."""
    key = list(key)
    r = intervals
    for k in key:
        r = r.withColumnRenamed(k, f"_r_{k}")
    cond = [F.col(k) == F.col(f"_r_{k}") for k in key]
    cond.append(F.col(start).isNull() | (at >= F.col(start)))
    cond.append(F.col(end).isNull() | (at < F.col(end)))
    j = left.join(r, cond, how)
    return j.drop(*[f"_r_{k}" for k in key])


def asof_last(markers: DataFrame, values: DataFrame, key: str, time: str, value: str,
              out: str, bucket=F.year) -> DataFrame:
    """For each marker row, the ``value`` of the latest ``values`` row of the
    same key strictly before the marker's ``time``.

    Distinct (key, time) markers and the values are unioned and a running
    last-non-null is taken in a window partitioned by (key, bucket); markers
    whose bucket holds no earlier value take the last value of earlier buckets
    from a per-bucket aggregate. A hot key is therefore split by its buckets.
    The answer is joined back to the markers on (key, time)."""
    vtype = values.schema[value].dataType
    m = markers.select(F.col(key).alias("_k"), F.col(time).alias("_t")).distinct() \
        .select("_k", "_t", F.lit(1).alias("_is_m"), F.lit(None).cast(vtype).alias("_v"))
    v = values.select(F.col(key).alias("_k"), F.col(time).alias("_t"), F.lit(0).alias("_is_m"),
                      F.col(value).alias("_v"))
    u = m.unionByName(v).withColumn("_b", bucket(F.col("_t")))
    # Values at the same time as a marker are not "before" it: markers sort first.
    w = Window.partitionBy("_k", "_b").orderBy("_t", F.col("_is_m").desc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    local = u.withColumn("_prev", F.last("_v", ignorenulls=True).over(w)).where(F.col("_is_m") == 1)
    per_bucket = v.withColumn("_b", bucket(F.col("_t"))).groupBy("_k", "_b") \
        .agg(F.max_by("_v", "_t").alias("_bv"))
    # Carry the last value of earlier buckets into every bucket that holds a
    # marker, including buckets without any value row of their own.
    mb = local.select("_k", "_b").distinct()
    allb = mb.join(per_bucket.select("_k", "_b"), ["_k", "_b"], "full")
    allb = allb.join(per_bucket, ["_k", "_b"], "left").withColumn(
        "_carry", F.last("_bv", ignorenulls=True).over(
            Window.partitionBy("_k").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)))
    res = local.join(allb.select("_k", "_b", "_carry"), ["_k", "_b"], "left") \
        .select(F.col("_k"), F.col("_t"), F.coalesce("_prev", "_carry").alias(out))
    return markers.join(res, (F.col(key) == F.col("_k")) & (F.col(time) == F.col("_t")), "left") \
        .drop("_k", "_t")
