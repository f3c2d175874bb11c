"""Projections, filters and set shaping."""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import settings as S
from ..functions.timefn import plus_minutes


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def cast_speed(df: DataFrame, col: str = "speed") -> DataFrame:
    """Text speed -> double; junk -> null (never fails the job)."""
    return df.withColumn(col, F.col(col).try_cast("double"))


def valid_speed(col="speed", lo: float = S.SPEED_MIN_EXCLUSIVE,
                hi: float = S.SPEED_MAX_EXCLUSIVE) -> Column:
    c = _c(col)
    return (c > lo) & (c < hi)


def filter_valid_speed(df: DataFrame, col: str = "speed", lo: float = S.SPEED_MIN_EXCLUSIVE,
                       hi: float = S.SPEED_MAX_EXCLUSIVE) -> DataFrame:
    """Keep lo < speed < hi; null speeds are dropped."""
    return df.filter(valid_speed(col, lo, hi))


def filter_active_links(df: DataFrame, active: DataFrame, key: str = "link_id") -> DataFrame:
    """Left-semi join against the active-link list.

    The list is a stored artifact with one row per road link; Spark broadcasts it if its
    bytes allow, else the join shuffles.
    """
    ids = active.select(F.col(active.columns[0]).cast("string").alias(key)).distinct()
    return df.join(ids, on=key, how="left_semi")


def filter_not_null(df: DataFrame, *cols: str) -> DataFrame:
    """P4."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))


def filter_link_sample(df: DataFrame, links, key: str = "link_id") -> DataFrame:
    """P5: one link, a literal list of links, or a frame whose first column lists them (semi join)."""
    if isinstance(links, str):
        return df.filter(F.col(key) == links)
    if isinstance(links, DataFrame):
        ids = links.select(F.col(links.columns[0]).cast("string").alias(key))
        return df.join(ids, on=key, how="left_semi")
    return df.filter(F.col(key).isin(list(links)))


def filter_partition(df: DataFrame, year: int, month: int | None = None) -> DataFrame:
    """year/month predicate; pruned to the partition directories on a partitioned table."""
    cond = F.col("year") == year
    if month is not None:
        cond = cond & (F.col("month") == month)
    return df.filter(cond)


def active_links(df: DataFrame, now, window_hours: float = S.ACTIVE_WINDOW_HOURS,
                 key: str = "link_id", ts: str = "data_as_of", ordered: bool = True) -> DataFrame:
    """Distinct (sorted, for the artifact) links that reported at or after
    ``now - window``.  Rows whose time failed to parse (null) are skipped."""
    cutoff = plus_minutes(_lit_ts(now), -window_hours * 60)
    out = df.filter(F.col(ts).isNotNull() & (F.col(ts) >= cutoff)).select(key).distinct()
    return out.orderBy(key) if ordered else out


def _lit_ts(now) -> Column:
    if isinstance(now, Column):
        return now
    return F.lit(str(now)).cast("timestamp_ntz")


def filter_dead_links(df: DataFrame, now, dead_minutes: float = S.DEAD_LINK_MINUTES,
                      ts: str = "data_as_of") -> DataFrame:
    """Drop rows older than ``now - dead_minutes``."""
    return df.filter(F.col(ts) >= plus_minutes(_lit_ts(now), -dead_minutes))


def split_column(bounds: Mapping[str, object]) -> Column:
    """First matching split name, in the given order; null if none."""
    expr = None
    for name, cond in bounds.items():
        c = F.expr(cond) if isinstance(cond, str) else cond
        expr = F.when(c, F.lit(name)) if expr is None else expr.when(c, F.lit(name))
    return expr.otherwise(F.lit(None).cast("string"))


def time_split(df: DataFrame, bounds: Mapping[str, object] = S.SPLIT_BOUNDS,
               name: str | None = None) -> DataFrame:
    """Add a ``split`` column, or keep one split only when ``name`` is given."""
    out = df.withColumn("split", split_column(bounds))
    return out if name is None else out.filter(F.col("split") == name)


def within_gap(present: Column, minutes: Column, lo: float, hi: float) -> Column:
    """P10 with P11's rule for lags: the neighbour is there and ``lo <= minutes <= hi``.

    A row whose neighbour is missing would be dropped for its null lag afterwards anyway,
    so one predicate per neighbour does both.
    """
    return present & minutes.between(lo, hi)


def all_of(conds: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def dropna_required(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows with null or NaN in any required column."""
    return df.dropna(how="any", subset=cols)


def project_schema(df: DataFrame, cols: list, rename: Mapping[str, str] | None = None) -> DataFrame:
    """Fixed projection with optional renames."""
    rename = rename or {}
    return df.select(*[F.col(c).alias(rename.get(c, c)) if isinstance(c, str) else c for c in cols])


def bulk_cast(df: DataFrame, to_string: list[str] = (), to_double: list[str] = ()) -> DataFrame:
    """One projection with all casts (keeps the analysed plan small)."""
    ss, dd = set(to_string), set(to_double)
    return df.select(*[
        F.col(c).cast("string").alias(c) if c in ss else
        F.col(c).cast("double").alias(c) if c in dd else F.col(c)
        for c in df.columns
    ])


def stratified_sample(df: DataFrame, keys: list[str], label: str = S.LABEL_COL, fraction: float = S.SAMPLE_FRACTION,
                      classes=S.CLASSES, seed: int = S.SAMPLE_SEED) -> DataFrame:
    """Per-class Bernoulli sample (no shuffle).

    A row is drawn by a digest of its ``keys`` and the seed, so the same rows come back
    whatever the partitioning, also when a lost task runs again.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys))
    drawn = F.substring(F.md5(text.cast("binary")), 1, 8) < F.lit(sample_limit(fraction))
    return df.filter(F.col(label).cast("double").isin([float(c) for c in classes]) & drawn)


def sample_limit(fraction: float) -> str:
    """Digests whose first eight hex digits sort before this are drawn."""
    return "g" if fraction >= 1 else f"{int(fraction * (1 << 32)):08x}"


def union_all(dfs: list[DataFrame]) -> DataFrame:
    """Union by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def months_between(df: DataFrame, first: tuple[int, int], last: tuple[int, int], ts: str = "data_as_of") -> DataFrame:
    """P15 over one table: all months from ``first`` to ``last`` (year, month), as one pushed half-open range."""
    start = F.make_timestamp_ntz(F.lit(first[0]), F.lit(first[1]), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    end = F.timestamp_add("MONTH", F.lit(1), F.make_timestamp_ntz(F.lit(last[0]), F.lit(last[1]), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
    return df.filter((F.col(ts) >= start) & (F.col(ts) < end))


def dedupe_by_key(df: DataFrame, key: str = "link_id", order: list[str] | None = None) -> DataFrame:
    """One row per key, deterministically the smallest ``order`` row.

    ``min(struct(order..., rest...))`` is a partial aggregate, so a hot key is reduced
    map-side before the shuffle.
    """
    order = order or [c for c in df.columns if c != key]
    rest = [c for c in df.columns if c != key and c not in order]
    packed = F.min(F.struct(*[F.col(c) for c in order + rest])).alias("_r")
    return df.groupBy(key).agg(packed).select(key, *[F.col("_r." + c).alias(c) for c in order + rest]) \
        .select(*df.columns)


def distinct_keys(df: DataFrame, *cols: str, ordered: bool = True) -> DataFrame:
    """P17."""
    out = df.select(*cols).distinct()
    return out.orderBy(*cols) if ordered else out


def missing_links(active: DataFrame, present: DataFrame, key: str = "link_id") -> DataFrame:
    """Active links with no row in ``present`` (EXCEPT DISTINCT)."""
    a = active.select(F.col(active.columns[0]).cast("string").alias(key)).distinct()
    p = present.select(key).distinct()
    return a.join(p, on=key, how="left_anti")


def limit_rows(df: DataFrame, n: int, order: list | None = None) -> DataFrame:
    """First n rows (in a total order when one is given)."""
    return (df.orderBy(*order) if order else df).limit(n)


def top_k(df: DataFrame, k: int, order: list) -> DataFrame:
    """P20: TakeOrdered -- each task keeps its own top k, the driver merges k x tasks rows."""
    return df.orderBy(*order).limit(k)


def month_calendar(spark, start: str, end: str) -> DataFrame:
    """One row per (year, month) from ``start`` to ``end`` (dates, inclusive)."""
    return spark.range(1).select(F.explode(F.sequence(
        F.trunc(F.lit(start).cast("date"), "month"),
        F.trunc(F.lit(end).cast("date"), "month"),
        F.expr("INTERVAL 1 MONTH"))).alias("m")) \
        .select(F.year("m").cast("int").alias("year"), F.month("m").cast("int").alias("month"))


def month_calendar_of(df: DataFrame, ts: str) -> DataFrame:
    """P21 over data: every (year, month) from the first to the last month present."""
    bounds = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"))  # one row
    months = bounds.select(F.explode(F.sequence(
        F.trunc(F.col("lo").cast("date"), "month"), F.trunc(F.col("hi").cast("date"), "month"),
        F.expr("INTERVAL 1 MONTH"))).alias("m"))
    return months.select(F.year("m").cast("int").alias("year"), F.month("m").cast("int").alias("month"))


def month_range_filter(df: DataFrame, year: int, month: int, ts: str = "data_as_of") -> DataFrame:
    """Half-open ``[first of month, first of next month)``; December rolls the year."""
    start = F.make_timestamp_ntz(F.lit(year), F.lit(month), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    end = F.timestamp_add("MONTH", F.lit(1), start)
    return df.filter((F.col(ts) >= start) & (F.col(ts) < end))
