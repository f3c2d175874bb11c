"""Dimension joins.

A dimension (active list, free-flow lookup) is a stored table: callers pass it in, and
Spark broadcasts it if its stored bytes are below the session's threshold.  Nothing
here counts, stores or hints at a table that grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import settings as S
from ..functions.congestion import congestion_class, holiday_flag, speed_ratio
from ..functions.text import name_fallback
from ..functions.timefn import local_date_str


def join_holiday(df: DataFrame, holidays: DataFrame, local_ts: str = "data_as_of",
                 out: str = "is_holiday") -> DataFrame:
    """J1 + F19: flag rows whose local date is a holiday (broadcast left join).

    After ``distinct`` the holiday table has at most one row per calendar date
    (366 per covered year), a bound that holds by construction, so it is broadcast.
    """
    h = holidays.select(F.col(holidays.columns[0]).cast("string").alias("_holiday_date")).distinct()
    return (df.withColumn("_date_str", local_date_str(local_ts))
            .join(F.broadcast(h), F.col("_date_str") == F.col("_holiday_date"), "left")
            .withColumn(out, holiday_flag("_holiday_date"))
            .drop("_date_str", "_holiday_date"))


def enrich_free_flow(df: DataFrame, lookup: DataFrame, key: str = "link_id") -> DataFrame:
    """J3 + F7 + F8: attach free-flow speed (left join), ratio and class."""
    return (df.join(lookup.select(key, "free_flow_speed"), on=key, how="left")
            .withColumn("speed_ratio", speed_ratio("speed", "free_flow_speed"))
            .withColumn("current_congestion", congestion_class("speed_ratio")))


def join_class_weight(df: DataFrame, weights: DataFrame, label: str = S.LABEL_COL) -> DataFrame:
    """Left join of each row's label to its class weight.

    The weight table has one row per class (three rows), a fixed bound.
    """
    by_class = F.broadcast(weights.select(F.col(label).cast("double").alias("_class"), F.col("class_weight").cast("double")))
    return df.join(by_class, F.col(label).cast("double") == F.col("_class"), "left").drop("_class")


def lookup_inner(df: DataFrame, lookup: DataFrame, key: str = "link_id",
                 with_ratio: bool = True, fallback: bool = True) -> DataFrame:
    """J5 (+F7/F8/F14): keep links in the lookup with free-flow > 0; attach borough,
    fall back to the lookup's link name, and optionally compute ratio and class.
    """
    lk = (lookup.filter(F.col("free_flow_speed") > 0)
          .select(key, "free_flow_speed",
                  F.col("borough").alias("_lk_borough"), F.col("link_name").alias("_lk_name")))
    out = df.join(lk, on=key, how="inner")
    out = out.withColumn("borough", F.col("_lk_borough"))
    if "link_name" in df.columns:
        if fallback:
            out = out.withColumn("link_name", name_fallback("link_name", "_lk_name"))
    else:
        out = out.withColumn("link_name", F.col("_lk_name"))
    out = out.drop("_lk_borough", "_lk_name")
    if with_ratio:
        out = (out.withColumn("speed_ratio", speed_ratio("speed", "free_flow_speed"))
               .withColumn("current_congestion", congestion_class("speed_ratio")))
    return out
