"""Join helpers: broadcast only a side whose size has been checked.

Two checks: Catalyst's size estimate of the optimized plan
(:func:`maybe_broadcast`; file sizes for scans, propagated through filters
and projections), and an actual row count (:func:`few_rows`) for small
tables derived by joins and aggregations, whose estimate Catalyst inflates.
A side over its bound is joined by shuffle; AQE may still turn that into a
broadcast at runtime from the real shuffle sizes, and splits skewed
partitions of the big side when it does not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Upper bound for an explicit broadcast hint. Parquet bytes: in memory a
# table takes several times as much.
DEFAULT_BROADCAST_BYTES = 16 * 1024 * 1024
# Upper bound for a counted broadcast.
DEFAULT_BROADCAST_ROWS = 10_000
# Stored (Parquet) bytes that one task groups or sorts, and up to how many
# such tasks the number is left to Spark.
TASK_BYTES = 4 * 1024 * 1024
FEW_TASKS = 16


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate for ``df``."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_bound(df: DataFrame) -> int:
    conf = df.sparkSession.conf.get("tarn.broadcast.maxBytes", None)
    return int(conf) if conf else DEFAULT_BROADCAST_BYTES


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    return estimated_bytes(df) <= (max_bytes if max_bytes is not None else broadcast_bound(df))


def maybe_broadcast(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``broadcast(df)`` when its estimated size is within the bound."""
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df


def few_rows(df: DataFrame, most: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` when it is counted to have at most ``most`` rows.
    The count is a job of its own: use it for small tables only."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def spread(df: DataFrame, size: int, *keys) -> DataFrame:
    """``df`` dealt by ``keys`` into as many tasks as its ``size`` in stored
    bytes asks for, so that what one task sorts does not grow with the
    table; a small one is left to Spark's own number of tasks. Groupings,
    windows and joins by these keys need no other shuffle."""
    tasks = -(-size // TASK_BYTES)
    return df.repartition(tasks, *keys) if tasks > FEW_TASKS else df


def dim_join(fact: DataFrame, dim: DataFrame, on, how: str = "left",
             max_bytes: int | None = None) -> DataFrame:
    """Join a fact-sized frame to a dimension-sized one.

    The dimension is the build side (right); it is broadcast only when its
    estimated size is within the bound, otherwise both sides shuffle on
    the keys.
    """
    return fact.join(maybe_broadcast(dim, max_bytes), on, how)
