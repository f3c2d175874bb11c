"""Per-link window operators.

The training features look a bounded *number of rows* back, but every kept row
must pass a gap check that bounds the *time* distance to those rows.  So the
series can be split into time buckets with a halo (see ``skew``), which keeps a
hot link spread over many tasks; the result equals the single-window form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import settings as S
from ..functions.congestion import congestion_trend, speed_ratio_trend
from ..functions.timefn import epoch_micros
from .filters import all_of, dropna_required, within_gap
from .skew import BUCKET, HOME, MICROS, bucket_width_us, dealt, with_halo


def _gap_minutes(later_sec: Column, earlier_sec: Column) -> Column:
    """Whole-second difference in minutes."""
    return (later_sec - earlier_sec) / F.lit(60.0)


def gold_features(df: DataFrame, params: S.GoldParams = S.GoldParams(), key: str = "link_id",
                  ts: str = "data_as_of_utc", tie: tuple = ("speed",), keep_gaps: bool = False) -> DataFrame:
    """W1-W4 + P10 + P11 + F9: lags, lead label, gap rule, dropna, trends.

    Input needs ``key``, ``ts`` (instant), ``speed_ratio``, ``current_congestion`` and the
    calendar columns.  Lags are taken over all rows first, then filtered (as specified).
    All lag/lead expressions share one window spec in one ``select``, so the plan has a
    single exchange, a single sort and a single Window node.
    """
    sc = params.scale
    max_hi = max(hi for _, hi in params.lag_tolerance.values())
    before = sc.micros(max_hi) + 1_000_000
    after = sc.micros(params.lead_tolerance[1]) + 1_000_000
    split = dealt(with_halo(df, ts, before, after, params.bucket_hours), key)
    w = Window.partitionBy(key, BUCKET).orderBy(F.col(MICROS), *[F.col(c) for c in tie])
    sec = F.floor(F.col(MICROS) / F.lit(1_000_000))
    row = F.struct(F.col("current_congestion").alias("c"), F.col("speed_ratio").alias("r"),
                   sec.alias("s"))
    lag_cols = [F.lag(row, k).over(w).alias(f"_p{m}") for m, k in params.lag_rows.items()]
    lead_col = F.lead(row, params.lead_rows).over(w).alias("_f")
    out = split.select("*", sec.alias("_sec"), *lag_cols, lead_col)

    conds = [within_gap(F.col("_f").isNotNull(), _gap_minutes(F.col("_f.s"), F.col("_sec")),
                        sc.minutes(params.lead_tolerance[0]), sc.minutes(params.lead_tolerance[1]))]
    for m, (lo, hi) in params.lag_tolerance.items():
        conds.append(within_gap(F.col(f"_p{m}").isNotNull(), _gap_minutes(F.col("_sec"), F.col(f"_p{m}.s")),
                                sc.minutes(lo), sc.minutes(hi)))
    out = out.filter(F.col(HOME) & all_of(conds))

    proj = [F.col(c) for c in df.columns]
    for m in params.lag_rows:
        proj.append(F.col(f"_p{m}.c").cast("int").alias(f"past_congestion_{m}min"))
        proj.append(F.col(f"_p{m}.r").cast("double").alias(f"past_speed_ratio_{m}min"))
    proj.append(F.col("_f.c").cast("int").alias(S.LABEL_COL))
    if keep_gaps:  # W3 values of the kept rows, in (unscaled-name) minutes
        proj += [_gap_minutes(F.col("_sec"), F.col(f"_p{m}.s")).alias(f"gap_{m}min") for m in params.lag_rows]
        proj.append(_gap_minutes(F.col("_f.s"), F.col("_sec")).alias("gap_future_15min"))
    out = out.select(*proj)
    # What the model reads must be there: all columns added here, and the current state
    added = [c for c in out.columns if c not in df.columns]
    out = dropna_required(out, [*added, "speed_ratio", "current_congestion"])
    return (out.withColumn("congestion_trend", congestion_trend())
            .withColumn("speed_ratio_trend", speed_ratio_trend()))


def latest_per_link(df: DataFrame, key: str = "link_id", ts: str = "data_as_of",
                    tie: str | None = None) -> DataFrame:
    """Newest row per link; equal times -> smallest ``tie``.

    ``max_by`` is a partial aggregate: a hot link is reduced map-side.
    """
    cols = [c for c in df.columns if c != key]
    order = F.struct(F.col(ts), -F.col(tie)) if tie else F.struct(F.col(ts))
    return (df.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in cols]), order).alias("_r"))
            .select(key, *[F.col("_r." + c).alias(c) for c in cols]))


def change_detect(df: DataFrame, key: str = "link_id", value: str = "data_as_of",
                  order: tuple = ("ingest_ts", "row_no"), bucket_hours: float = 24.0) -> DataFrame:
    """Keep a row only if ``value`` differs from the previous row of its link (null equals null).

    Emit-if-changed compares with the last *emitted* value, which always equals the
    previous row's value, so A, B, A emits three times.  No task holds a whole link: inside a
    time bucket of ``order[0]`` the previous row comes by ``lag``; the first row of a bucket
    takes the last value of the nearest earlier bucket, from a table of one row per bucket
    that is joined on the buckets' own partitioning.
    """
    width = bucket_width_us(0, 0, bucket_hours)
    x = df.withColumn(BUCKET, F.floor(epoch_micros(F.col(order[0])) / F.lit(width)).cast("long"))
    place = F.struct(*[F.col(c) for c in order])
    # the value goes inside a struct, so that a null value differs from "no row"
    last = x.groupBy(key, BUCKET).agg(F.max_by(F.struct(F.col(value).alias("v")), place).alias("_end"))
    before = last.select(key, BUCKET, F.lag("_end").over(Window.partitionBy(key).orderBy(BUCKET)).alias("_before"))
    w = Window.partitionBy(key, BUCKET).orderBy(*[F.col(c) for c in order])
    x = x.select("*", F.lag(F.struct(F.col(value).alias("v"))).over(w).alias("_inside"))
    x = x.join(before, on=[key, BUCKET], how="left")
    previous = F.coalesce("_inside", "_before")
    return (x.filter(previous.isNull() | ~F.col(value).eqNullSafe(previous["v"]))
            .drop(BUCKET, "_inside", "_before"))


def order_within_link(df: DataFrame, key: str = "link_id", ts: str = "data_as_of") -> DataFrame:
    """Ascending time per link.  A range-partitioned sort on (key, ts) splits a hot
    link over several tasks while keeping the order."""
    return df.orderBy(key, ts)


def order_output(df: DataFrame, *cols) -> DataFrame:
    """W8."""
    return df.orderBy(*cols)
