"""Aggregations.

All of them are single ``groupBy().agg()`` passes; Spark runs them as partial
(map-side) plus final aggregates, so a hot key is combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import settings as S
from ..functions.congestion import class_label


#: Slices of a bracket that are ranked side by side.
SLICES = 256


def ranked_values(x: DataFrame, keys: list[str], value: str, ranks: dict[str, tuple[float, Column]],
                  accuracy: int = 10_000) -> DataFrame:
    """Exact order statistics per key, bounded in memory whatever the number of values.

    ``ranks`` maps a name to ``(share, rank)``: the place that is wanted, as a share of the
    rows and as a 0-based rank in terms of ``_n``, the key's row count.  One pass brackets
    each rank by two sketch quantiles (their rank error is at most ``n / accuracy``, the
    margin is twice that); a second counts the rows below each bracket as one group and the
    rows inside, about ``4 n / accuracy`` per rank, by value; those counts are ranked in slices of the
    bracket's values, so no task holds a whole bracket.
    Null and NaN values take no part.  Returns ``keys``, ``_n`` and one column per name.
    """
    x = x.select(*keys, F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    if not keys:
        x = x.withColumn("_all", F.lit(0))
    by = keys or ["_all"]
    margin = 2.0 / accuracy
    names = list(ranks)
    probs = [min(1.0, max(0.0, p)) for n in names for p in (ranks[n][0] - margin, ranks[n][0] + margin)]
    sketch = x.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_x", probs, accuracy).alias("_b"))
    # a rank is rounded to a whole row, which can lie one row outside its share: the ends stay open there
    small = F.col("_n") <= 4 * accuracy
    bracket = [F.struct(F.lit(k).alias("k"), ranks[n][1].cast("long").alias("rank"),
                        F.when(small, F.lit(float("-inf"))).otherwise(F.col("_b")[2 * k]).alias("lo"),
                        F.when(small, F.lit(float("inf"))).otherwise(F.col("_b")[2 * k + 1]).alias("hi")) for k, n in enumerate(names)]
    sketch = sketch.select(*by, "_n", F.array(*bracket).alias("_k"))
    met = x.join(sketch, by).select(*by, "_n", "_x", F.explode(F.filter("_k", lambda b: F.col("_x") <= b["hi"])).alias("b"))
    # all rows below a bracket are one group, its null value sorts first
    counted = (met.groupBy(*by, "_n", F.col("b.k").alias("_of"), F.col("b.rank").alias("_rank"),
                           F.when(F.col("_x") >= F.col("b.lo"), F.col("_x")).alias("_x")).agg(F.count(F.lit(1)).alias("_m")))
    # ranked in slices of the bracket by value: a table of one row per slice says what lies before it
    ends = counted.groupBy(*by, "_of").agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    span = F.col("_hi") - F.col("_lo")
    place = F.when((span > 0) & (span < F.lit(float("inf"))), F.least(F.lit(SLICES - 1), F.floor((F.col("_x") - F.col("_lo")) / span * F.lit(SLICES))))
    sliced = counted.join(ends, [*by, "_of"]).withColumn("_slice", F.when(F.col("_x").isNull(), F.lit(-1)).otherwise(F.coalesce(place, F.lit(0))).cast("long"))
    before = Window.partitionBy(*by, "_of").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)  # at most SLICES + 1 rows
    bases = sliced.groupBy(*by, "_of", "_slice").agg(F.sum("_m").alias("_s")).select(*by, "_of", "_slice", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_base"))
    run = Window.partitionBy(*by, "_of", "_slice").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    upto = sliced.withColumn("_in", F.sum("_m").over(run)).join(bases, [*by, "_of", "_slice"]).withColumn("_upto", F.col("_base") + F.col("_in"))
    pick = [F.min(F.when((F.col("_of") == k) & (F.col("_upto") > F.col("_rank")), F.col("_x"))).alias(n) for k, n in enumerate(names)]
    return upto.groupBy(*by).agg(F.first("_n").alias("_n"), *pick).select(*keys, "_n", *names)


def free_flow_lookup(df: DataFrame, key: str = "link_id", speed: str = "speed",
                     order: str = "data_as_of", q: float = S.FREE_FLOW_PERCENTILE,
                     method: str = "exact", accuracy: int = 10_000) -> DataFrame:
    """G1 + G2 + J2: one row per link -> (link_id, free_flow_speed, borough, link_name).

    ``free_flow_speed`` is the discrete ``q`` percentile of speed (the smallest value
    whose cumulative share reaches ``q``); ``borough``/``link_name`` come from the
    link's earliest row.

    ``method="exact"``: ``ranked_values``, exact with bounded state per link.
    ``method="approx"``: ``percentile_approx`` sketches with the given ``accuracy``.
    """
    src = df.filter(F.col(speed).isNotNull())
    meta = F.min(F.struct(F.col(order).alias("t"), F.col("borough").alias("borough"),
                          F.col("link_name").alias("link_name"))).alias("_m")
    if method == "approx":
        out = src.groupBy(key).agg(F.percentile_approx(speed, q, accuracy).cast("double").alias("free_flow_speed"), meta)
    else:
        rank = F.greatest(F.ceil(F.lit(q) * F.col("_n")) - 1, F.lit(0))
        speeds = ranked_values(src, [key], speed, {"free_flow_speed": (q, rank)}, accuracy)
        out = src.groupBy(key).agg(meta).join(speeds, key, "left")
    return out.select(key, "free_flow_speed", F.col("_m.borough").alias("borough"),
                      F.col("_m.link_name").alias("link_name"))


def count_by_key(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    """Rows per key, ordered by key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).orderBy(*keys)


def count_by_year_month(df: DataFrame, ts: str = "data_as_of") -> DataFrame:
    """Group by expressions year(ts), month(ts)."""
    return (df.groupBy(F.year(ts).cast("int").alias("year"), F.month(ts).cast("int").alias("month"))
            .agg(F.count(F.lit(1)).alias("count")).orderBy("year", "month"))


def link_quality(df: DataFrame, key: str = "link_id", speed_text: str = "speed",
                 ts: str = "data_as_of") -> DataFrame:
    """Per link total rows, rows with a valid numeric speed, latest time."""
    sp = F.col(speed_text).try_cast("double")
    return (df.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.sum(F.when((sp > S.SPEED_MIN_EXCLUSIVE) & (sp < S.SPEED_MAX_EXCLUSIVE), 1).otherwise(0))
        .cast("long").alias("valid_rows"),
        F.max(ts).alias("latest_data_as_of"))
        .orderBy(key))


def count_link_speed(df: DataFrame, key: str = "link_id", speed: str = "speed") -> DataFrame:
    """Two-key count, ordered."""
    return df.groupBy(key, speed).agg(F.count(F.lit(1)).alias("count")).orderBy(key, speed)


def row_counts(df: DataFrame, conditions: dict) -> DataFrame:
    """Total rows plus one conditional count per named condition, one pass."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    aggs += [F.count_if(F.expr(c) if isinstance(c, str) else c).alias(n) for n, c in conditions.items()]
    return df.agg(*aggs)


def distinct_links(df: DataFrame, key: str = "link_id", approx: bool = False) -> DataFrame:
    """G8."""
    if approx:
        return df.agg(F.approx_count_distinct(key).alias("distinct_links"))
    return df.agg(F.count_distinct(key).alias("distinct_links"))


#: Sketch size of distinct counts: a relative standard error of about 1.04 / sqrt(2**LG_K), 1.6 % here.
LG_K = 12


def link_sketches(df: DataFrame, by: list[Column], key: str = "link_id", lg_k: int = LG_K) -> DataFrame:
    """G8, G22, G23 mergeable: per group (an hour, a month) a HyperLogLog sketch of the links and the rows.

    A few kB a group whatever its rows; a new hour adds its own row and reads no other.
    """
    return df.groupBy(*by).agg(F.hll_sketch_agg(key, lg_k).alias("links"), F.count(F.lit(1)).alias("rows"))


def sketched_links(sketches: DataFrame, by: list[str] = (), min_links: int = S.WARMUP_MIN_LINKS) -> DataFrame:
    """Distinct links (estimated), rows and the readiness flag (G23) of unions of stored sketches; no reading is read."""
    both = sketches.groupBy(*by).agg(F.hll_union_agg("links").alias("_s"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
    n = F.coalesce(F.hll_sketch_estimate("_s"), F.lit(0)).cast("long")
    return both.select(*by, n.alias("distinct_links"), "rows", (n >= F.lit(min_links)).alias("ready"))


def speed_sketches(df: DataFrame, by: list[Column], key: str = "link_id", speed: str = "speed", width: float = 0.25) -> DataFrame:
    """G1 mergeable: per link and group (a month) how many speeds lie in each cell of ``width``, from 0 on.

    Speeds are bounded (0 to 100 after cleaning), so a group has at most 100 / width cells whatever its
    rows.  Counts add up over any choice of groups.
    """
    cell = F.floor(F.col(speed) / F.lit(width)).cast("long").alias("cell")
    return df.where(F.col(speed).isNotNull()).groupBy(key, *by, cell).agg(F.count(F.lit(1)).alias("n"))


def sketched_speed(sketches: DataFrame, key: str = "link_id", q: float = S.FREE_FLOW_PERCENTILE, width: float = 0.25) -> DataFrame:
    """``(key, n, low, high)``: the exact ``q`` percentile (the smallest value whose share reaches ``q``) lies in ``[low, high)``.

    From stored cell counts only: months can be added or left out without reading any reading again.
    """
    cells = sketches.groupBy(key, "cell").agg(F.sum("n").alias("n"))
    steps = Window.partitionBy(key).orderBy("cell")  # the cells of one link
    upto = cells.select(key, "cell", F.sum("n").over(steps).alias("_upto"), F.sum("n").over(Window.partitionBy(key)).alias("_all"))
    hit = upto.where(F.col("_upto") >= F.ceil(F.lit(q) * F.col("_all"))).groupBy(key).agg(F.min("cell").alias("cell"), F.first("_all").alias("n"))
    return hit.select(key, "n", (F.col("cell") * F.lit(width)).alias("low"), ((F.col("cell") + 1) * F.lit(width)).alias("high"))


def refined_speed(readings: DataFrame, bracket: DataFrame, key: str = "link_id", speed: str = "speed", q: float = S.FREE_FLOW_PERCENTILE) -> DataFrame:
    """The exact percentile from a bracket: of the readings only those inside are ranked, those below are counted."""
    met = readings.select(key, F.col(speed).cast("double").alias("_x")).join(bracket, key).where(F.col("_x") < F.col("high"))
    counted = met.groupBy(key, "n", F.when(F.col("_x") >= F.col("low"), F.col("_x")).alias("_x")).agg(F.count(F.lit(1)).alias("_m"))
    run = Window.partitionBy(key).orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)  # values of one cell; null: all below
    upto = counted.select(key, "n", "_x", F.sum("_m").over(run).alias("_upto"))
    return (upto.where(F.col("_x").isNotNull() & (F.col("_upto") >= F.ceil(F.lit(q) * F.col("n"))))
            .groupBy(key).agg(F.min("_x").alias("free_flow_speed")))


def value_ranges(df: DataFrame, ts: str = "data_as_of", speed: str = "speed") -> DataFrame:
    """min/max of time and of numeric-cast speed."""
    sp = F.col(speed).try_cast("double")
    return df.agg(F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"),
                  F.min(sp).alias("min_speed"), F.max(sp).alias("max_speed"))


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Null count of every column, one pass."""
    cols = cols or df.columns
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def describe_column(df: DataFrame, col: str, digits: int = 4, accuracy: int = 10_000) -> DataFrame:
    """Count, mean, std, min, quartiles (interpolated, exact), max -- rounded.

    NaN counts as missing.  The quartiles interpolate between the two ranked values around
    them, as pandas and ``quantile_cont`` do; nothing but the one result row is gathered.
    """
    x = df.select(F.col(col).cast("double").alias("x"))
    x = x.withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    places = {}
    for name, share in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        at = F.lit(share) * (F.col("_n") - 1)
        places[f"{name}_lo"], places[f"{name}_hi"] = (share, F.floor(at)), (share, F.ceil(at))
    ranked = ranked_values(x, [], "x", places, accuracy)
    moments = x.agg(F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
                    F.min("x").alias("min"), F.max("x").alias("max"))
    quartiles = []
    for name, share in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        at = F.lit(share) * (F.col("_n") - 1)
        lo, hi = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        quartiles.append(F.round(lo + (hi - lo) * (at - F.floor(at)), digits).alias(name))
    # one row each
    both = moments.join(F.broadcast(ranked), F.lit(True), "left")
    return both.select("count", *(F.round(c, digits).alias(c) for c in ("mean", "std", "min")), *quartiles,
                       F.round("max", digits).alias("max"))


def class_histogram(df: DataFrame, col: str = "predicted_congestion") -> DataFrame:
    """G12 + F20: class counts with text label."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .withColumn("label", class_label(col)).orderBy(col))


def split_class_distribution(df: DataFrame, label: str = S.LABEL_COL, split: str = "split") -> DataFrame:
    """G19."""
    return (df.groupBy(split, label).agg(F.count(F.lit(1)).alias("count")).orderBy(split, label))


def coverage(df: DataFrame, key: str = "link_id", ts: str = "data_as_of") -> DataFrame:
    """Distinct links, rows, distinct (year, month) present; the rows shrink to one per link and month first."""
    ym = (F.year(ts) * 100 + F.month(ts)).alias("ym")
    small = df.groupBy(key, ym).agg(F.count(F.lit(1)).alias("n"), F.min(ts).alias("lo"), F.max(ts).alias("hi"))
    return small.agg(F.count_distinct(key).alias("links"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                     F.count_distinct("ym").alias("months"), F.min("lo").alias("first_ts"), F.max("hi").alias("last_ts"))


def snapshot_readiness(df: DataFrame, key: str = "link_id",
                       min_links: int = S.WARMUP_MIN_LINKS) -> DataFrame:
    """Distinct links in the window and whether that is enough to skip warm-up."""
    return (df.agg(F.count_distinct(key).alias("distinct_links"))
            .withColumn("ready", F.col("distinct_links") >= F.lit(min_links)))
