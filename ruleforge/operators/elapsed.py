"""Time span per group: first and last event, total amount, minutes between.

Backs threshold reports such as "all deposits of one customer on one day
within 30 minutes": aggregate per group, then apply a rule on ``time_diff``.
All aggregates are algebraic (min, max, sum, count), so Spark combines them
map-side before the shuffle; a group holding a third of the rows costs one
partial row per task, never a collected list.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def elapsed_minutes(min_time: Column | str, max_time: Column | str) -> Column:
    """Minutes from ``min_time`` to ``max_time``; each side is floored to whole
    seconds first (as ``bigint(timestamp)`` does). TIMESTAMP_NTZ values are
    read as wall-clock time, independent of the session time zone."""
    return (F.unix_timestamp(max_time) - F.unix_timestamp(min_time)) / F.lit(60)


def time_span(df: DataFrame, keys: Sequence[Column | str], ts_col: str,
              amount_col: str | None = None, *, amount_alias: str = "total_amount",
              round_to: int | None = 2, decimals: int = 6) -> DataFrame:
    """Per group: ``n_events, min_time, max_time, <amount_alias>, time_diff``.

    Amounts are added as decimals with ``decimals`` places, so the total (a
    double) does not depend on the order in which partitions are combined."""
    aggs = [F.count(F.lit(1)).alias("n_events"),
            F.min(ts_col).alias("min_time"),
            F.max(ts_col).alias("max_time")]
    if amount_col:
        total = F.sum(F.col(amount_col).cast(f"decimal(28,{decimals})"))
        total = F.round(total, round_to) if round_to is not None else total
        aggs.append(total.cast("double").alias(amount_alias))
    return (df.groupBy(*keys).agg(*aggs)
            .withColumn("time_diff", elapsed_minutes("min_time", "max_time")))
