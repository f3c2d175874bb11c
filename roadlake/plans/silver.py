"""Bronze -> silver cleaning (Q4) and the coordinate dimension (Q3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import settings as S
from ..functions.text import parse_first_point
from ..functions.timefn import calendar_features, parse_utc_ts, utc_to_local
from ..operators.filters import cast_speed, filter_active_links, filter_valid_speed

SILVER_OUT = S.SILVER_COLUMNS + ["data_as_of_utc", "year"]


def silver_clean(bronze: DataFrame, active: DataFrame, holidays: DataFrame,
                 zone: str = S.LOCAL_ZONE) -> DataFrame:
    """Q4: cast + range-filter speed, keep active links, parse the UTC text time, derive
    local wall time and calendar features, flag holidays, project the silver schema.

    ``data_as_of`` is local wall time (display, calendar, partitions); ``data_as_of_utc``
    is the instant used for ordering and gaps.  Rows whose time does not parse are
    dropped.  One narrow projection chain over two stored dimensions.
    """
    from ..operators.joins import join_holiday

    df = filter_valid_speed(cast_speed(bronze.select("link_id", "borough", "link_name",
                                                     "speed", "data_as_of")))
    df = filter_active_links(df, active)
    df = (df.withColumn("data_as_of_utc", parse_utc_ts("data_as_of"))
          .filter(F.col("data_as_of_utc").isNotNull())
          .withColumn("data_as_of", utc_to_local("data_as_of_utc", zone)))
    df = df.select("*", *calendar_features("data_as_of"))
    df = join_holiday(df, holidays, local_ts="data_as_of")
    return df.select(*S.SILVER_COLUMNS, "data_as_of_utc",
                     F.year("data_as_of").cast("int").alias("year"))


def link_coordinates(bronze: DataFrame, active: DataFrame, order: str = "data_as_of") -> DataFrame:
    """Q3: earliest non-null point list per active link -> first (lat, lon); bad -> dropped.

    ``min(struct(time, points))`` per link is a partial aggregate (skew-safe).
    """
    pts = bronze.select("link_id", F.col(order).alias("_t"), "link_points") \
        .filter(F.col("link_points").isNotNull())
    pts = filter_active_links(pts, active)
    first = pts.groupBy("link_id").agg(F.min(F.struct("_t", "link_points")).alias("_r"))
    coords = first.select("link_id", parse_first_point(F.col("_r.link_points")).alias("coords"))
    return (coords.select("link_id", F.col("coords.lat").alias("lat"), F.col("coords.lon").alias("lon"))
            .filter(F.col("lat").isNotNull()))
