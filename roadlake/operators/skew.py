"""Splitting one key's time series across tasks.

A per-link window (lags, as-of frames) partitioned by ``link_id`` alone puts a
hot link -- possibly a third of all rows -- into a single task.  Every window
in this library only looks a bounded time distance back and ahead, so the
series is cut into time buckets and each bucket also receives copies of the
rows within that distance of its edges (a *halo*).  Windows then run over
``(keys, _bucket)`` and only the bucket's own rows (``_home``) are kept.

Bucket width is at least four halo widths, so each row is copied into at most
one or two extra buckets and the copied share stays small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefn import epoch_micros

BUCKET = "_bucket"
HOME = "_home"
MICROS = "_us"


def bucket_width_us(before_us: int, after_us: int, bucket_hours: float) -> int:
    base = int(bucket_hours * 3600 * 1_000_000)
    return max(base, 4 * (before_us + after_us), 1)


def with_halo(df: DataFrame, ts_col: str, before_us: int, after_us: int,
              bucket_hours: float = 24.0) -> DataFrame:
    """Copy each row into every bucket whose window needs it.

    A window evaluated for a home row at time ``t`` of bucket ``b`` sees all rows of
    the same key in ``[t - before_us, t + after_us]`` (and more), contiguously in time.
    Adds ``_us`` (epoch micros), ``_bucket`` and ``_home``.
    """
    width = bucket_width_us(before_us, after_us, bucket_hours)
    us = epoch_micros(F.col(ts_col))
    lo = F.floor((us - F.lit(after_us)) / F.lit(width)).cast("long")
    hi = F.floor((us + F.lit(before_us)) / F.lit(width)).cast("long")
    home = F.floor(us / F.lit(width)).cast("long")
    return (
        df.withColumn(MICROS, us)
        .withColumn(BUCKET, F.explode(F.sequence(lo, hi)))
        .withColumn(HOME, F.col(BUCKET) == home)
    )


def dealt(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt by key and bucket over the session's whole number of shuffle partitions.

    Left to itself Spark joins partitions until they hold 64 MB as compressed; these rows repeat keys and
    times and are some twenty times that when a task sorts them.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key, BUCKET)


def home_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(HOME)).drop(BUCKET, HOME, MICROS)
