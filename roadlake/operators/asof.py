"""As-of lag search for serving.

For a reference time ``ref`` and lag ``m`` minutes with tolerance ``(lo, hi)``:

* J6 nearest: among snapshots in ``[ref-hi, ref-lo]`` the one nearest to
  ``ref-m``; at equal distance the earlier one wins.
* J7 carry-forward: if there is no candidate, the last snapshot at or before
  ``ref-m`` when it is at most ``locf`` minutes older, else missing.

Both are RANGE window frames over epoch micros -- ``max(struct)`` for the latest
at or before the target, ``min(struct)`` for the earliest after it -- so there
is no self join.  The frames only look back a bounded time, so the series is
split into time buckets with a halo and a hot link is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import settings as S
from ..functions.congestion import congestion_trend, speed_ratio_trend
from ..functions.timefn import calendar_features, epoch_micros, utc_to_local
from .joins import join_holiday, lookup_inner
from .skew import BUCKET, HOME, MICROS, dealt, with_halo


def _pick_nearest(bk: Column, fw: Column, target_us: Column) -> Column:
    d_bk = target_us - bk["u"]
    d_fw = fw["u"] - target_us
    return (F.when(bk.isNotNull() & fw.isNotNull(), F.when(d_bk <= d_fw, bk).otherwise(fw))
            .when(bk.isNotNull(), bk).otherwise(fw))


def asof_lags(df: DataFrame, values: list[str], key: str = "link_id", ts: str = "data_as_of",
              tie: str | None = None, params: S.ServingParams = S.ServingParams(),
              mode: str = "both") -> DataFrame:
    """Add one struct column ``lag_{m}`` per lag with fields ``u`` (epoch micros) and ``values``.

    ``mode``: ``"nearest"`` (J6 only), ``"locf"`` (J7 only) or ``"both"`` (J6 then J7).
    Equal times are resolved by the smallest ``tie`` (arrival order).
    """
    sc = params.scale
    reach = max(max(hi, m + params.locf_max_minutes) for m, (lo, hi) in params.lag_tolerance.items())
    split = dealt(with_halo(df, ts, sc.micros(reach), 0, params.bucket_hours), key)
    w = Window.partitionBy(key, BUCKET).orderBy(F.col(MICROS))
    t = F.col(tie) if tie else F.lit(0)
    # max() favours the smallest tie through -tie, min() through +tie
    late = F.struct(F.col(MICROS).alias("u"), (-t).alias("_k"), *[F.col(v) for v in values])
    early = F.struct(F.col(MICROS).alias("u"), t.alias("_k"), *[F.col(v) for v in values])
    cols = []
    for m, (lo, hi) in params.lag_tolerance.items():
        m_us, lo_us, hi_us = sc.micros(m), sc.micros(lo), sc.micros(hi)
        target = F.col(MICROS) - F.lit(m_us)
        bk = F.max(late).over(w.rangeBetween(-hi_us, -m_us))
        fw = F.min(early).over(w.rangeBetween(-m_us, -lo_us))
        lc = F.max(late).over(w.rangeBetween(-(m_us + sc.micros(params.locf_max_minutes)), -m_us))
        near = _pick_nearest(bk, fw, target)
        pick = {"nearest": near, "locf": lc, "both": F.coalesce(near, lc)}[mode]
        cols.append(pick.dropFields("_k").alias(f"lag_{m}"))
    return split.select("*", *cols).filter(F.col(HOME)).drop(BUCKET, HOME, MICROS)


def asof_join(left: DataFrame, right: DataFrame, values: list[str], key: str = "link_id", ts: str = "data_as_of", direction: str = "backward",
              within_minutes: float | None = None, tie: str | None = None, bucket_hours: float = 24.0, out: str = "match") -> DataFrame:
    """J6 + J7 between two tables: each row of ``left`` with the row of ``right`` of its key that is nearest in time.

    ``direction``: ``"backward"`` (the last at or before it), ``"forward"`` (the first at or after it) or
    ``"nearest"`` (the earlier one of two equally near).  ``out`` is a struct of ``u`` (epoch micros) and
    ``values`` of that row, null if there is none, or none ``within_minutes``; equal times take the
    smallest ``tie``.  All rows and columns of ``left`` stay, also those without a key or time.

    Both sides are put in one frame, cut into time buckets, and one sorted pass per (key, bucket)
    carries the last and the next row of ``right`` along; there is no pair of rows, and a hot key is
    spread over its buckets.  What a bucket cannot see itself comes from a table of one row per key and
    bucket: the last (first) row of ``right`` in the buckets before (after) it.
    """
    if direction not in ("backward", "forward", "nearest"):
        raise ValueError("direction is backward, forward or nearest")
    width = F.lit(max(1, int(bucket_hours * 3_600_000_000)))
    us = epoch_micros(F.col(ts))
    order = F.col(tie) if tie else F.lit(0)
    found = (right.where(F.col(key).isNotNull() & F.col(ts).isNotNull())
             .select(F.col(key).alias("_key"), us.alias("_us"), order.alias("_tie"), F.struct(us.alias("u"), *values).alias("_row")))
    # of equal times the smallest tie
    found = found.groupBy("_key", "_us").agg(F.min_by("_row", "_tie").alias("_row")).withColumn("_bucket", F.floor(F.col("_us") / width))
    asked = left.select(F.struct(*(F.col(f"`{c}`") for c in left.columns)).alias("_left"), F.col(key).alias("_key"), us.alias("_us"))
    asked = asked.withColumn("_bucket", F.floor(F.col("_us") / width))
    both = asked.withColumn("_row", F.lit(None).cast(found.schema["_row"].dataType)).unionByName(
        found.withColumn("_left", F.lit(None).cast(asked.schema["_left"].dataType)))
    steps = Window.partitionBy("_key", "_bucket").orderBy("_us")
    ends = found.groupBy("_key", "_bucket").agg(F.min_by("_row", "_us").alias("_first"), F.max_by("_row", "_us").alias("_last"))
    # every bucket of either side, one row each, with what lies before and after it
    places = both.select("_key", "_bucket").distinct().join(ends, ["_key", "_bucket"], "left")
    series = Window.partitionBy("_key").orderBy("_bucket")
    places = places.select("_key", "_bucket",
                           F.last("_last", True).over(series.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
                           F.first("_first", True).over(series.rowsBetween(1, Window.unboundedFollowing)).alias("_after"))
    same = steps.rangeBetween(Window.unboundedPreceding, 0), steps.rangeBetween(0, Window.unboundedFollowing)
    seen = both.select("*", F.last("_row", True).over(same[0]).alias("_back"), F.first("_row", True).over(same[1]).alias("_next")).where("_left is not null")
    met = seen.join(places, seen["_key"].eqNullSafe(places["_key"]) & seen["_bucket"].eqNullSafe(places["_bucket"]), "left")
    known = seen["_key"].isNotNull() & seen["_us"].isNotNull()
    back = F.when(known, F.coalesce(seen["_back"], places["_before"]))
    forth = F.when(known, F.coalesce(seen["_next"], places["_after"]))
    if within_minutes is not None:
        reach = F.lit(int(round(within_minutes * 60_000_000)))
        back, forth = F.when(seen["_us"] - back["u"] <= reach, back), F.when(forth["u"] - seen["_us"] <= reach, forth)
    pick = {"backward": back, "forward": forth, "nearest": _pick_nearest(back, forth, seen["_us"])}[direction]
    return met.select("_left.*", pick.alias(out))


def newest_with_lags(snapshots: DataFrame, values: list[str], key: str = "link_id", ts: str = "data_as_of",
                     tie: str | None = None, params: S.ServingParams = S.ServingParams()) -> DataFrame:
    """W5 + J6 + J7 for the newest snapshot of each link only: two partial aggregates, no window.

    The first finds each link's newest time; it is joined back on the link (one row per
    link), and the second takes the newest row and, per lag, the latest row at or before
    the target and the earliest after it, each from its own time range.
    """
    sc = params.scale
    us = epoch_micros(F.col(ts))
    t = F.col(tie) if tie else F.lit(0)
    ref = snapshots.groupBy(key).agg(F.max(us).alias("_ref"))
    x = snapshots.select("*", us.alias("_at")).join(ref, on=key)
    back = F.col("_ref") - F.col("_at")
    # max() favours the smallest tie through -tie, min() through +tie
    late = F.struct(F.col("_at").alias("u"), (-t).alias("_k"), *[F.col(v) for v in values])
    early = F.struct(F.col("_at").alias("u"), t.alias("_k"), *[F.col(v) for v in values])
    rest = [c for c in snapshots.columns if c != key]
    aggs = [F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(F.col("_at"), -t)).alias("_r"), F.first("_ref").alias("_ref")]
    for m, (lo, hi) in params.lag_tolerance.items():
        at, near, far = sc.micros(m), sc.micros(lo), sc.micros(hi)
        carried = at + sc.micros(params.locf_max_minutes)
        aggs += [F.max(F.when(back.between(at, far), late)).alias(f"_b{m}"),
                 F.min(F.when(back.between(near, at), early)).alias(f"_f{m}"),
                 F.max(F.when(back.between(at, carried), late)).alias(f"_c{m}")]
    found = x.groupBy(key).agg(*aggs)
    lags = [F.coalesce(_pick_nearest(F.col(f"_b{m}"), F.col(f"_f{m}"), F.col("_ref") - F.lit(sc.micros(m))), F.col(f"_c{m}"))
            .dropFields("_k").alias(f"lag_{m}") for m in params.lag_tolerance]
    return found.select(key, *[F.col("_r." + c).alias(c) for c in rest], *lags)


def serving_features(snapshots: DataFrame, lookup: DataFrame, holidays: DataFrame | None = None,
                     key: str = "link_id", tie: str | None = None,
                     params: S.ServingParams = S.ServingParams(), zone: str = S.LOCAL_ZONE) -> DataFrame:
    """J8 (+J5, W5, F4, F5, F9, F14, F19): one feature row per link for its newest snapshot.

    ``snapshots``: link_id, data_as_of (UTC instant), current_congestion, speed_ratio,
    link_name.  Links missing from the lookup or missing any lag are dropped.
    """
    newest = newest_with_lags(snapshots, ["current_congestion", "speed_ratio"], key=key, tie=tie, params=params)
    return lag_features(newest, lookup, holidays, key=key, params=params, zone=zone)


def lag_features(newest: DataFrame, lookup: DataFrame, holidays: DataFrame | None = None, key: str = "link_id",
                 params: S.ServingParams = S.ServingParams(), zone: str = S.LOCAL_ZONE) -> DataFrame:
    """J8's second half: feature rows from snapshots that have their lags (in batch or from ``lookback_stream``)."""
    newest = newest.dropna(subset=[f"lag_{m}" for m in params.lag_tolerance])
    feat = lookup_inner(newest, lookup, key=key, with_ratio=False)
    local = utc_to_local("data_as_of", zone)
    feat = feat.withColumn("_local", local)
    if holidays is not None:
        feat = join_holiday(feat, holidays, local_ts="_local")
    else:
        feat = feat.withColumn("is_holiday", F.lit(0))
    lag_cols = []
    for m in params.lag_tolerance:
        lag_cols += [F.col(f"lag_{m}.current_congestion").cast("int").alias(f"past_congestion_{m}min"),
                     F.col(f"lag_{m}.speed_ratio").cast("double").alias(f"past_speed_ratio_{m}min")]
    out = feat.select(
        key, "borough", "link_name",
        F.col("speed_ratio").cast("double").alias("speed_ratio"),
        F.col("current_congestion").cast("int").alias("current_congestion"),
        *calendar_features("_local"),
        F.col("is_holiday").cast("int").alias("is_holiday"),
        *lag_cols,
        F.col("data_as_of"),
    )
    return (out.withColumn("congestion_trend", congestion_trend())
            .withColumn("speed_ratio_trend", speed_ratio_trend()))
