"""Query catalog: every SURVEY section-2 operator as a query over the test tables.

``QUERIES[name] = (spark_fn(spark, sf_dir) -> DataFrame, duckdb_sql or None)``.
Column names are identical on both sides; doubles that come out of
different summation orders are rounded on both sides.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadlake import settings as S
from roadlake.functions.timefn import epoch_micros
from roadlake.functions import (calendar_features, class_label, clean_quotes, confidence, epoch_seconds,
                         json_decode_snapshot, json_encode_snapshot, local_date_str, local_hour_str,
                         minutes_between, parse_first_point, parse_local_ts, parse_utc_ts,
                         plus_minutes, utc_to_local)
from roadlake.operators import aggregates as G
from roadlake.operators import filters as P
from roadlake.operators import joins as J
from roadlake.operators import metrics as M
from roadlake.operators import windows as W
from roadlake.operators.asof import asof_join, asof_lags, serving_features
from roadlake.session import checkpoint_dir
from roadlake.sources import readers as R
from . import oracle as O
from roadlake.plans.silver import link_coordinates

from . import tables as T

Q: dict = {}


def query(name: str, sql: str | None):
    def deco(fn):
        Q[name] = (fn, sql)
        return fn
    return deco


def _w(*ctes):
    return O.with_(*ctes)


LOOKBACK_MIN = S.LOOKBACK_MINUTES * T.SCALE.factor      # 13,500 minutes
DEAD_MIN = S.DEAD_LINK_MINUTES * T.SCALE.factor         # 18,000 minutes


def _enriched(spark, sf) -> DataFrame:
    """Stored silver joined to the stored lookup: ratio + class."""
    return J.enrich_free_flow(T.silver(spark, sf), T.lookup(spark, sf))


def _gold_split(spark, sf):
    return P.time_split(T.gold(spark, sf), T.SPLITS)


def _persistence(spark, sf) -> DataFrame:
    g = T.gold(spark, sf)
    return g.select(F.col(S.LABEL_COL).cast("double").alias(S.LABEL_COL),
                    F.col("current_congestion").cast("double").alias("prediction"))


# ---------------------------------------------------------------- 2.1 scans
@query("scan_parquet", "SELECT l_suppkey, l_quantity, l_shipdate FROM lineitem WHERE l_quantity >= 25")
def q_scan_parquet(spark, sf):
    return R.scan_parquet(spark, f"{sf}/lineitem.parquet").filter(F.col("l_quantity") >= 25) \
        .select("l_suppkey", "l_quantity", "l_shipdate")


@query("scan_table", "SELECT event_id, user_id, ts FROM events WHERE event_type = 'click'")
def q_scan_table(spark, sf):
    return R.scan_table(spark, f"{sf}/events.parquet", fmt="parquet") \
        .filter(F.col("event_type") == "click").select("event_id", "user_id", "ts")


@query("scan_json_list", """
SELECT event_id, unnest([CAST(user_id AS VARCHAR), event_type]) AS link_id FROM events""")
def q_scan_json_list(spark, sf):
    e = T.table(spark, sf, "events")
    text = F.to_json(F.array(F.col("user_id").cast("string"), F.col("event_type")))
    return R.explode_json_ids(e.select("event_id", text.alias("j")), "j", out="link_id") \
        .select("event_id", "link_id")


@query("land_history_month", """
SELECT CAST(l_suppkey AS VARCHAR) AS link_id, CAST(l_quantity AS VARCHAR) AS speed,
       strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%g') AS data_as_of
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-12-01' AND l_shipdate < TIMESTAMP '1997-01-01'""")
def q_land_history_month(spark, sf):
    li = T.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("link_id"),
        F.col("l_quantity").cast("string").alias("speed"), F.col("l_shipdate").alias("ts"))
    m = R.land_history_month(li, 1996, 12, ts="ts")
    return m.select("link_id", "speed", F.date_format("ts", S.BRONZE_TS_FORMAT).alias("data_as_of"))


@query("scan_recent_hours", _w(O.READINGS) + f"""
SELECT link_id, data_as_of, speed FROM readings
WHERE data_as_of >= TIMESTAMP '{T.NOW}' - INTERVAL {int(LOOKBACK_MIN)} MINUTE
  AND speed > 0 AND speed < 100""")
def q_scan_recent_hours(spark, sf):
    r = P.filter_valid_speed(T.readings(spark, sf))
    r = r.withColumn("_l", utc_to_local("data_as_of"))
    r = r.withColumn("date", local_date_str("_l")).withColumn("hour", local_hour_str("_l"))
    out = R.recent_hours(r, T.NOW, LOOKBACK_MIN)
    return out.select("link_id", "data_as_of", "speed")


# ---------------------------------------------------------------- 2.3 projections / filters
@query("cast_speed", _w(O.BRONZE) + "SELECT link_id, data_as_of, TRY_CAST(speed AS DOUBLE) AS speed FROM bronze")
def q_cast_speed(spark, sf):
    return P.cast_speed(T.bronze(spark, sf)).select("link_id", "data_as_of", "speed")


@query("filter_valid_speed", _w(O.READINGS) +
       "SELECT event_id, link_id, speed FROM readings WHERE speed > 0 AND speed < 100")
def q_filter_valid_speed(spark, sf):
    return P.filter_valid_speed(T.readings(spark, sf)).select("event_id", "link_id", "speed")


@query("filter_active_links", _w(O.READINGS, O.ACTIVE) +
       "SELECT event_id, link_id FROM readings WHERE link_id IN (SELECT link_id FROM active)")
def q_filter_active_links(spark, sf):
    return P.filter_active_links(T.readings(spark, sf), T.active(spark, sf)).select("event_id", "link_id")


@query("filter_not_null", _w(O.BRONZE) +
       "SELECT link_id, data_as_of, link_points FROM bronze WHERE link_points IS NOT NULL")
def q_filter_not_null(spark, sf):
    return P.filter_not_null(T.bronze(spark, sf), "link_points").select("link_id", "data_as_of", "link_points")


@query("filter_link_sample", _w(*O.BASE_GOLD) + """
SELECT link_id, data_as_of, speed FROM bronze
WHERE link_id IN (SELECT link_id FROM active EXCEPT SELECT link_id FROM gold)""")
def q_filter_link_sample(spark, sf):
    # the investigation step: raw rows of the active links that produced no gold row
    ids = P.missing_links(T.active(spark, sf), T.gold(spark, sf))
    return P.filter_link_sample(T.bronze(spark, sf), ids).select("link_id", "data_as_of", "speed")


@query("filter_partition", _w(*O.BASE_SILVER) +
       "SELECT link_id, data_as_of, speed FROM silver WHERE year = 2024 AND month = 1")
def q_filter_partition(spark, sf):
    return P.filter_partition(T.silver(spark, sf), 2024, 1).select("link_id", "data_as_of", "speed")


@query("active_links", _w(O.FEED) + f"""
SELECT DISTINCT trim(trim("linkId"), '"') AS link_id FROM feed
WHERE (strptime(trim(trim("DataAsOf"), '"'), '%m/%d/%Y %H:%M:%S') AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC'
      >= TIMESTAMP '{T.NOW}' - INTERVAL 48 HOUR""")
def q_active_links(spark, sf):
    f = T.feed_rows(T.table(spark, sf, "events"))
    parsed = R.parse_feed(f)
    return P.active_links(parsed, T.NOW)


@query("filter_dead_links", _w(*O.BASE_SNAP) + f"""
SELECT link_id, data_as_of, event_id FROM snapshots
WHERE data_as_of >= TIMESTAMP '{T.NOW}' - INTERVAL {int(DEAD_MIN)} MINUTE""")
def q_filter_dead_links(spark, sf):
    return P.filter_dead_links(T.snapshots(spark, sf), T.NOW, DEAD_MIN).select("link_id", "data_as_of", "event_id")


@query("time_split", _w(*O.BASE_SILVER) + """
SELECT link_id, data_as_of_utc, CASE WHEN data_as_of < TIMESTAMP '2024-01-21' THEN 'train'
  WHEN data_as_of < TIMESTAMP '2024-01-26' THEN 'val' ELSE 'test' END AS split FROM silver""")
def q_time_split(spark, sf):
    return P.time_split(T.silver(spark, sf), T.SPLITS).select("link_id", "data_as_of_utc", "split")


@query("dropna_required", _w(O.BRONZE) + """
SELECT link_id, data_as_of, link_points FROM bronze
WHERE link_points IS NOT NULL AND TRY_CAST(speed AS DOUBLE) IS NOT NULL""")
def q_dropna_required(spark, sf):
    b = P.cast_speed(T.bronze(spark, sf))
    return P.dropna_required(b, ["link_points", "speed"]).select("link_id", "data_as_of", "link_points")


@query("project_schema", _w(*O.BASE_SILVER) + """
SELECT link_id, borough, link_name, data_as_of, speed, hour, day_of_week, month, is_weekend, is_holiday FROM silver""")
def q_project_schema(spark, sf):
    return P.project_schema(T.silver(spark, sf), S.SILVER_COLUMNS)


@query("bulk_cast", _w(*O.BASE_GOLD) + """
SELECT CAST(link_id AS VARCHAR) AS link_id, CAST(borough AS VARCHAR) AS borough,
  CAST(hour AS DOUBLE) AS hour, CAST(day_of_week AS DOUBLE) AS day_of_week, CAST(month AS DOUBLE) AS month,
  CAST(is_weekend AS DOUBLE) AS is_weekend, CAST(is_holiday AS DOUBLE) AS is_holiday,
  CAST(speed_ratio AS DOUBLE) AS speed_ratio, CAST(current_congestion AS DOUBLE) AS current_congestion,
  CAST(past_congestion_15min AS DOUBLE) AS past_congestion_15min, past_speed_ratio_15min,
  CAST(past_congestion_30min AS DOUBLE) AS past_congestion_30min, past_speed_ratio_30min,
  CAST(past_congestion_45min AS DOUBLE) AS past_congestion_45min, past_speed_ratio_45min,
  CAST(past_congestion_60min AS DOUBLE) AS past_congestion_60min, past_speed_ratio_60min,
  CAST(congestion_trend AS DOUBLE) AS congestion_trend, speed_ratio_trend,
  CAST(future_congestion_15min AS DOUBLE) AS future_congestion_15min, data_as_of,
  CAST(year AS DOUBLE) AS year FROM gold""")
def q_bulk_cast(spark, sf):
    from roadlake.plans.training import training_frame
    return training_frame(T.gold(spark, sf))


@query("stratified_sample", _w(*O.DENSE_GOLD) + f"""
SELECT link_id, data_as_of, future_congestion_15min FROM dense_gold
WHERE substr(md5('{S.SAMPLE_SEED}|' || link_id || '|' || CAST(data_as_of AS VARCHAR)), 1, 8) < '{P.sample_limit(S.SAMPLE_FRACTION)}'""")
def q_stratified_sample(spark, sf):
    return P.stratified_sample(T.dense_gold(spark, sf), ["link_id", "data_as_of"]).select("link_id", "data_as_of", S.LABEL_COL)


@query("union_months", """
SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE l_shipdate IS NOT NULL""")
def q_union_months(spark, sf):
    """All months from the first to the last one present, as one pushed range over one scan."""
    li = T.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    ends = li.agg(F.min("l_shipdate"), F.max("l_shipdate")).first()  # from the file footers
    if ends[0] is None:
        return li.limit(0)
    return P.months_between(li, *((t.year, t.month) for t in ends), ts="l_shipdate")


@query("dedupe_by_key", _w(O.BRONZE) + """
SELECT link_id, min(data_as_of) AS data_as_of, arg_min_null(link_points, data_as_of) AS link_points
FROM bronze GROUP BY link_id""")
def q_dedupe_by_key(spark, sf):
    b = T.bronze(spark, sf).select("link_id", "data_as_of", "link_points")
    return P.dedupe_by_key(b, "link_id", order=["data_as_of", "link_points"])


@query("distinct_keys", """
SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month FROM lineitem""")
def q_distinct_keys(spark, sf):
    li = T.table(spark, sf, "lineitem").select(F.year("l_shipdate").cast("int").alias("year"),
                                                F.month("l_shipdate").cast("int").alias("month"))
    return P.distinct_keys(li, "year", "month")


@query("missing_links", _w(*O.BASE_GOLD) + """
SELECT link_id FROM active EXCEPT SELECT link_id FROM gold""")
def q_missing_links(spark, sf):
    return P.missing_links(T.active(spark, sf), T.gold(spark, sf))


@query("limit_rows", _w(O.READINGS) +
       "SELECT event_id, link_id, data_as_of FROM readings ORDER BY data_as_of, event_id LIMIT 20")
def q_limit_rows(spark, sf):
    return P.limit_rows(T.readings(spark, sf).select("event_id", "link_id", "data_as_of"), 20,
                        order=["data_as_of", "event_id"])


@query("top_k_latest", _w(*O.BASE_SNAP) +
       "SELECT link_id, data_as_of, current_congestion FROM snapshots ORDER BY data_as_of DESC, event_id LIMIT 10")
def q_top_k_latest(spark, sf):
    s = T.snapshots(spark, sf)
    return P.top_k(s, 10, [F.col("data_as_of").desc(), F.col("event_id")]) \
        .select("link_id", "data_as_of", "current_congestion")


@query("month_calendar", """
SELECT CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month
FROM (SELECT unnest(generate_series(date_trunc('month', min(l_shipdate)), date_trunc('month', max(l_shipdate)),
      INTERVAL 1 MONTH)) AS m FROM lineitem)""")
def q_month_calendar(spark, sf):
    li = T.table(spark, sf, "lineitem")
    return P.month_calendar_of(li, "l_shipdate")


@query("month_range_filter", """
SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1996-12-01' AND l_shipdate < TIMESTAMP '1997-01-01'""")
def q_month_range_filter(spark, sf):
    li = T.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return P.month_range_filter(li, 1996, 12, ts="l_shipdate")


# ---------------------------------------------------------------- 2.4 joins
@query("join_holiday", _w(O.READINGS) + """
SELECT event_id, CAST(CASE WHEN strftime((data_as_of AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York', '%Y-%m-%d')
  IN ('2024-01-01', '2024-01-15') THEN 1 ELSE 0 END AS INTEGER) AS is_holiday FROM readings""")
def q_join_holiday(spark, sf):
    r = T.readings(spark, sf).withColumn("_local", utc_to_local("data_as_of"))
    return J.join_holiday(r, T.holidays(spark), local_ts="_local").select("event_id", "is_holiday")


@query("free_flow_lookup", _w(*O.BASE_LOOKUP) + "SELECT link_id, free_flow_speed, borough, link_name FROM lookup")
def q_free_flow_lookup(spark, sf):
    return T.build_lookup(spark, sf)


@query("free_flow_lookup_approx", """
WITH x AS (SELECT l_suppkey % 20 AS link, l_extendedprice AS v FROM lineitem),
r AS (SELECT link, v, cume_dist() OVER (PARTITION BY link ORDER BY v) AS share, count(*) OVER (PARTITION BY link) AS n FROM x)
SELECT CAST(link AS VARCHAR) AS link_id, max(n) AS rows, TRUE AS within FROM r GROUP BY link""")
def q_free_flow_lookup_approx(spark, sf):
    """The sketch at its default accuracy over continuous values: its rank is within n / accuracy (and one row)."""
    x = T.table(spark, sf, "lineitem").select((F.col("l_suppkey") % 20).cast("string").alias("link_id"),
                                              F.col("l_extendedprice").alias("speed"), F.col("l_shipdate").alias("data_as_of"),
                                              F.lit("x").alias("borough"), F.lit("y").alias("link_name"))
    lk = G.free_flow_lookup(x, method="approx")
    ranked = x.join(lk.select("link_id", "free_flow_speed"), "link_id").groupBy("link_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("speed") < F.col("free_flow_speed")).alias("below"),
        F.count_if(F.col("speed") <= F.col("free_flow_speed")).alias("upto"))
    wanted, slack = F.col("rows") * S.FREE_FLOW_PERCENTILE, F.col("rows") / 10_000 + 1
    return ranked.select("link_id", "rows", ((F.col("below") - slack <= wanted) & (F.col("upto") + slack >= wanted)).alias("within"))


@query("enrich_free_flow", _w(*O.BASE_LOOKUP, O.ENRICHED) + """
SELECT link_id, data_as_of_utc, free_flow_speed, speed_ratio, current_congestion FROM enriched""")
def q_enrich_free_flow(spark, sf):
    return _enriched(spark, sf) \
        .select("link_id", "data_as_of_utc", "free_flow_speed", "speed_ratio", "current_congestion")


@query("join_class_weight", _w(*O.BASE_GOLD, O.GOLD_SPLIT) + """,
cw AS (SELECT CAST(future_congestion_15min AS DOUBLE) AS lbl,
              (SELECT count(*) FROM gold_split WHERE split = 'train') / (3.0 * count(*)) AS class_weight
       FROM gold_split WHERE split = 'train' GROUP BY 1)
SELECT g.link_id, g.data_as_of, g.future_congestion_15min, round(cw.class_weight, 9) AS class_weight
FROM gold_split g LEFT JOIN cw ON CAST(g.future_congestion_15min AS DOUBLE) = cw.lbl WHERE g.split = 'train'""")
def q_join_class_weight(spark, sf):
    g = _gold_split(spark, sf)
    train = g.filter(F.col("split") == "train")
    w = M.class_weight(train)
    out = J.join_class_weight(train, w)
    return out.select("link_id", "data_as_of", S.LABEL_COL, F.round("class_weight", 9).alias("class_weight"))


@query("lookup_inner", _w(*O.BASE_SNAP) + """
SELECT link_id, event_id, borough, link_name, speed_ratio, current_congestion FROM snapshots""")
def q_lookup_inner(spark, sf):
    return T.snapshots(spark, sf).select("link_id", "event_id", "borough", "link_name",
                                         "speed_ratio", "current_congestion")


def _asof_sql(kind: str) -> str:
    lags = {15: (10, 20), 30: (25, 35), 45: (40, 50), 60: (55, 65)}
    us = 150 * 60_000_000
    ctes = [O.READINGS] + list(O.BASE_LOOKUP[:]) + [O.SNAPSHOTS,
            "s AS (SELECT link_id, event_id, epoch_us(data_as_of) AS u FROM snapshots)"]
    sel = ["r.link_id", "r.event_id"]
    for m, (lo, hi) in lags.items():
        if kind == "nearest":
            ctes.append(f"""n{m} AS (SELECT r.event_id, c.event_id AS pick,
  row_number() OVER (PARTITION BY r.event_id ORDER BY abs(c.u - (r.u - {m * us})), c.u, c.event_id) AS rn
  FROM s r JOIN s c ON c.link_id = r.link_id AND c.u BETWEEN r.u - {hi * us} AND r.u - {lo * us})""")
        else:
            ctes.append(f"""n{m} AS (SELECT r.event_id, c.event_id AS pick,
  row_number() OVER (PARTITION BY r.event_id ORDER BY c.u DESC, c.event_id) AS rn
  FROM s r JOIN s c ON c.link_id = r.link_id AND c.u BETWEEN r.u - {(m + 15) * us} AND r.u - {m * us})""")
        sel.append(f"(SELECT pick FROM n{m} WHERE n{m}.event_id = r.event_id AND rn = 1) AS lag_{m}")
    return O.with_(*ctes) + f"SELECT {', '.join(sel)} FROM s r"


def _asof_query(spark, sf, mode):
    s = T.snapshots(spark, sf).select("link_id", "data_as_of", "event_id")
    out = asof_lags(s, ["event_id"], tie="event_id", params=T.SERVING_PARAMS, mode=mode)
    return out.select("link_id", "event_id",
                      *[F.col(f"lag_{m}.event_id").alias(f"lag_{m}") for m in S.LAG_TOLERANCE])


@query("asof_nearest", _asof_sql("nearest"))
def q_asof_nearest(spark, sf):
    return _asof_query(spark, sf, "nearest")


@query("asof_locf", _asof_sql("locf"))
def q_asof_locf(spark, sf):
    return _asof_query(spark, sf, "locf")


def _serving_sql() -> str:
    lags = {15: (10, 20), 30: (25, 35), 45: (40, 50), 60: (55, 65)}
    us = 150 * 60_000_000
    ctes = [O.READINGS] + list(O.BASE_LOOKUP) + [O.SNAPSHOTS, f"""s AS (
  SELECT link_id, event_id, epoch_us(data_as_of) AS u, data_as_of, current_congestion, speed_ratio,
         CASE WHEN event_id % 7 = 0 THEN '' ELSE link_name END AS link_name
  FROM snapshots WHERE data_as_of >= TIMESTAMP '{T.NOW}' - INTERVAL {int(LOOKBACK_MIN)} MINUTE)""",
            """latest AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY link_id ORDER BY u DESC, event_id) = 1)"""]
    cols = []
    for m, (lo, hi) in lags.items():
        ctes.append(f"""c{m} AS (
  SELECT r.link_id, c.current_congestion AS cc, c.speed_ratio AS sr,
         row_number() OVER (PARTITION BY r.link_id ORDER BY abs(c.u - (r.u - {m * us})), c.u, c.event_id) AS rn
  FROM latest r JOIN s c ON c.link_id = r.link_id AND c.u BETWEEN r.u - {hi * us} AND r.u - {lo * us})""")
        ctes.append(f"""l{m} AS (
  SELECT r.link_id, c.current_congestion AS cc, c.speed_ratio AS sr,
         row_number() OVER (PARTITION BY r.link_id ORDER BY c.u DESC, c.event_id) AS rn
  FROM latest r JOIN s c ON c.link_id = r.link_id AND c.u BETWEEN r.u - {(m + 15) * us} AND r.u - {m * us})""")
        ctes.append(f"""p{m} AS (
  SELECT r.link_id, coalesce(n.cc, l.cc) AS cc, CASE WHEN n.link_id IS NOT NULL THEN n.sr ELSE l.sr END AS sr,
         (n.link_id IS NOT NULL OR l.link_id IS NOT NULL) AS found
  FROM latest r LEFT JOIN (SELECT * FROM c{m} WHERE rn = 1) n ON n.link_id = r.link_id
                LEFT JOIN (SELECT * FROM l{m} WHERE rn = 1) l ON l.link_id = r.link_id)""")
        cols.append((m,))
    loc = "((r.data_as_of AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')"
    sel = f"""SELECT r.link_id, k.borough, coalesce(nullif(r.link_name, ''), k.link_name) AS link_name,
  r.speed_ratio, r.current_congestion,
  CAST(hour({loc}) AS INTEGER) AS hour, CAST(dayofweek({loc}) + 1 AS INTEGER) AS day_of_week,
  CAST(month({loc}) AS INTEGER) AS month,
  CAST(CASE WHEN dayofweek({loc}) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
  CAST(CASE WHEN strftime({loc}, '%Y-%m-%d') IN ('2024-01-01', '2024-01-15') THEN 1 ELSE 0 END AS INTEGER) AS is_holiday,
  p15.cc AS past_congestion_15min, p15.sr AS past_speed_ratio_15min,
  p30.cc AS past_congestion_30min, p30.sr AS past_speed_ratio_30min,
  p45.cc AS past_congestion_45min, p45.sr AS past_speed_ratio_45min,
  p60.cc AS past_congestion_60min, p60.sr AS past_speed_ratio_60min,
  r.data_as_of, CAST(r.current_congestion - p15.cc AS INTEGER) AS congestion_trend,
  r.speed_ratio - p15.sr AS speed_ratio_trend
FROM latest r JOIN lookup k ON k.link_id = r.link_id AND k.free_flow_speed > 0
  JOIN p15 ON p15.link_id = r.link_id JOIN p30 ON p30.link_id = r.link_id
  JOIN p45 ON p45.link_id = r.link_id JOIN p60 ON p60.link_id = r.link_id
WHERE p15.found AND p30.found AND p45.found AND p60.found"""
    return O.with_(*ctes) + sel


def _window(spark, sf) -> DataFrame:
    """Snapshots of the lookback; every seventh has no name, as in the feed, so the lookup's stands in."""
    w = R.lookback_window(T.snapshots(spark, sf), T.NOW, LOOKBACK_MIN)
    return w.withColumn("link_name", F.when(F.col("event_id") % 7 == 0, F.lit("")).otherwise(F.col("link_name")))


@query("serving_features", _serving_sql())
def q_serving_features(spark, sf):
    return serving_features(_window(spark, sf), T.lookup(spark, sf), T.holidays(spark), tie="event_id", params=T.SERVING_PARAMS)


# ---------------------------------------------------------------- 2.5 aggregations
@query("free_flow_speed", """
SELECT CAST(l_suppkey AS VARCHAR) AS link_id, CAST(quantile_disc(l_quantity, 0.85) AS DOUBLE) AS free_flow_speed
FROM lineitem GROUP BY l_suppkey""")
def q_free_flow_speed(spark, sf):
    li = T.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("link_id"), F.col("l_quantity").alias("speed"),
        F.col("l_shipdate").alias("data_as_of"), F.lit("x").alias("borough"), F.lit("y").alias("link_name"))
    return G.free_flow_lookup(li).select("link_id", "free_flow_speed")


@query("link_meta", _w(*O.BASE_LOOKUP) + "SELECT link_id, borough, link_name FROM lookup")
def q_link_meta(spark, sf):
    return T.lookup(spark, sf).select("link_id", "borough", "link_name")


@query("count_by_key", _w(*O.BASE_LOOKUP, O.ENRICHED) + """
SELECT current_congestion, count(*) AS count FROM enriched GROUP BY current_congestion""")
def q_count_by_key(spark, sf):
    return G.count_by_key(_enriched(spark, sf), "current_congestion")


@query("count_by_year_month", """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month, count(*) AS count
FROM lineitem GROUP BY 1, 2""")
def q_count_by_year_month(spark, sf):
    return G.count_by_year_month(T.table(spark, sf, "lineitem"), ts="l_shipdate")


@query("count_by_hour", _w(*O.BASE_SILVER) + "SELECT hour, count(*) AS count FROM silver GROUP BY hour")
def q_count_by_hour(spark, sf):
    return G.count_by_key(T.silver(spark, sf), "hour")


@query("link_quality", _w(O.BRONZE) + """
SELECT link_id, count(*) AS total_rows,
  CAST(sum(CASE WHEN TRY_CAST(speed AS DOUBLE) > 0 AND TRY_CAST(speed AS DOUBLE) < 100 THEN 1 ELSE 0 END) AS BIGINT) AS valid_rows,
  max(data_as_of) AS latest_data_as_of FROM bronze GROUP BY link_id""")
def q_link_quality(spark, sf):
    return G.link_quality(T.bronze(spark, sf))


@query("count_link_speed", _w(O.BRONZE) + "SELECT link_id, speed, count(*) AS count FROM bronze GROUP BY 1, 2")
def q_count_link_speed(spark, sf):
    return G.count_link_speed(T.bronze(spark, sf))


@query("row_counts", _w(*O.BASE_LOOKUP, O.ENRICHED) + """
SELECT count(*) AS rows, count(*) FILTER (WHERE free_flow_speed IS NULL) AS missing_free_flow,
       count(*) FILTER (WHERE current_congestion = 2) AS heavy FROM enriched""")
def q_row_counts(spark, sf):
    e = _enriched(spark, sf)
    return G.row_counts(e, {"missing_free_flow": "free_flow_speed IS NULL", "heavy": "current_congestion = 2"})


@query("distinct_links", _w(*O.BASE_SILVER) + "SELECT count(DISTINCT link_id) AS distinct_links FROM silver")
def q_distinct_links(spark, sf):
    return G.distinct_links(T.silver(spark, sf))


@query("value_ranges", _w(O.BRONZE) + """
SELECT min(data_as_of) AS min_ts, max(data_as_of) AS max_ts,
       min(TRY_CAST(speed AS DOUBLE)) AS min_speed, max(TRY_CAST(speed AS DOUBLE)) AS max_speed FROM bronze""")
def q_value_ranges(spark, sf):
    return G.value_ranges(T.bronze(spark, sf))


@query("null_counts", _w(O.BRONZE) + """
SELECT count(*) FILTER (WHERE link_id IS NULL) AS link_id, count(*) FILTER (WHERE borough IS NULL) AS borough,
  count(*) FILTER (WHERE link_name IS NULL) AS link_name, count(*) FILTER (WHERE speed IS NULL) AS speed,
  count(*) FILTER (WHERE data_as_of IS NULL) AS data_as_of,
  count(*) FILTER (WHERE link_points IS NULL) AS link_points FROM bronze""")
def q_null_counts(spark, sf):
    return G.null_counts(T.bronze(spark, sf))


@query("describe_confidence", _w(*O.BASE_SNAP) + """
SELECT count(speed_ratio) AS count, round(avg(speed_ratio), 4) AS mean, round(stddev_samp(speed_ratio), 4) AS std,
  round(min(speed_ratio), 4) AS min, round(quantile_cont(speed_ratio, 0.25), 4) AS p25,
  round(quantile_cont(speed_ratio, 0.5), 4) AS p50, round(quantile_cont(speed_ratio, 0.75), 4) AS p75,
  round(max(speed_ratio), 4) AS max FROM snapshots""")
def q_describe_confidence(spark, sf):
    return G.describe_column(T.snapshots(spark, sf), "speed_ratio")


@query("class_histogram", _w(*O.BASE_SNAP) + """
SELECT current_congestion, count(*) AS count,
  CASE current_congestion WHEN 0 THEN '0-free flow' WHEN 1 THEN '1-congested' WHEN 2 THEN '2-severe' END AS label
FROM snapshots GROUP BY current_congestion""")
def q_class_histogram(spark, sf):
    return G.class_histogram(T.snapshots(spark, sf), "current_congestion")


@query("class_weight", _w(*O.BASE_GOLD, O.GOLD_SPLIT) + """
SELECT CAST(future_congestion_15min AS DOUBLE) AS future_congestion_15min, count(*) AS count,
  round((SELECT count(*) FROM gold_split WHERE split = 'train') / (3.0 * count(*)), 9) AS class_weight
FROM gold_split WHERE split = 'train' GROUP BY 1""")
def q_class_weight(spark, sf):
    train = _gold_split(spark, sf).filter(F.col("split") == "train")
    return M.class_weight(train).withColumn("class_weight", F.round("class_weight", 9))


@query("confusion_matrix", _w(*O.BASE_GOLD, O.PERSIST) + """
SELECT c AS actual,
  count(p.actual) FILTER (WHERE p.predicted = 0.0) AS pred_0,
  count(p.actual) FILTER (WHERE p.predicted = 1.0) AS pred_1,
  count(p.actual) FILTER (WHERE p.predicted = 2.0) AS pred_2
FROM (VALUES (0.0::DOUBLE), (1.0::DOUBLE), (2.0::DOUBLE)) t(c) LEFT JOIN pairs p ON p.actual = t.c GROUP BY c""")
def q_confusion_matrix(spark, sf):
    return M.confusion_matrix(_persistence(spark, sf))


@query("confusion_normalized", _w(*O.BASE_GOLD, O.PERSIST) + """,
cm AS (SELECT c AS actual,
  count(p.actual) FILTER (WHERE p.predicted = 0.0) AS p0, count(p.actual) FILTER (WHERE p.predicted = 1.0) AS p1,
  count(p.actual) FILTER (WHERE p.predicted = 2.0) AS p2
  FROM (VALUES (0.0::DOUBLE), (1.0::DOUBLE), (2.0::DOUBLE)) t(c) LEFT JOIN pairs p ON p.actual = t.c GROUP BY c)
SELECT actual, round(p0 / nullif(p0 + p1 + p2, 0), 6) AS pred_0, round(p1 / nullif(p0 + p1 + p2, 0), 6) AS pred_1,
  round(p2 / nullif(p0 + p1 + p2, 0), 6) AS pred_2 FROM cm""")
def q_confusion_normalized(spark, sf):
    return M.confusion_normalized(M.confusion_matrix(_persistence(spark, sf)))


@query("class_metrics", _w(*O.BASE_GOLD, O.PERSIST, O.METRICS) +
       "SELECT class, tp, fp, fn, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1 FROM metrics")
def q_class_metrics(spark, sf):
    m = M.class_metrics(_persistence(spark, sf))
    return m.select("class", "tp", "fp", "fn", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


@query("macro_f1", _w(*O.BASE_GOLD, O.PERSIST, O.METRICS) +
       "SELECT round(sum(f1) / 3, 9) AS macro_f1, CAST(sum(tp) + sum(fn) AS BIGINT) AS rows FROM metrics")
def q_macro_f1(spark, sf):
    return M.macro_f1(M.class_metrics(_persistence(spark, sf))).withColumn("macro_f1", F.round("macro_f1", 9))


@query("distribution_pct", _w(*O.BASE_GOLD, O.GOLD_SPLIT) + """
SELECT split, hour, count(*) AS count,
  round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY split), 3) AS pct FROM gold_split GROUP BY split, hour""")
def q_distribution_pct(spark, sf):
    return M.distribution_pct(_gold_split(spark, sf), "hour")


@query("distribution_pct_month", _w(*O.BASE_GOLD, O.GOLD_SPLIT) + """
SELECT split, month, count(*) AS count,
  round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY split), 3) AS pct FROM gold_split GROUP BY split, month""")
def q_distribution_pct_month(spark, sf):
    return M.distribution_pct(_gold_split(spark, sf), "month")


@query("split_class_distribution", _w(*O.BASE_GOLD, O.GOLD_SPLIT) + """
SELECT split, future_congestion_15min, count(*) AS count FROM gold_split GROUP BY 1, 2""")
def q_split_class_distribution(spark, sf):
    return G.split_class_distribution(_gold_split(spark, sf))


CORR_COLS = S.NUMERIC_FEATURES + [S.LABEL_COL]


def _corr_sql() -> str:
    parts = []
    for a in CORR_COLS:
        for b in CORR_COLS:
            if a == b:
                expr = f"CASE WHEN var_pop({a}) > 0 THEN 1.0 END"
            else:
                expr = f"CASE WHEN var_pop({a}) > 0 AND var_pop({b}) > 0 THEN round(corr({a}, {b}), 6) + 0.0 END"
            parts.append(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {expr} AS corr FROM gold")
    return O.with_(*O.BASE_GOLD) + "\nUNION ALL\n".join(parts)


@query("correlation_matrix", _corr_sql())
def q_correlation_matrix(spark, sf):
    return M.correlation_matrix(T.gold(spark, sf), CORR_COLS)


def _label_corr_sql() -> str:
    parts = [f"SELECT '{c}' AS feature, CASE WHEN var_pop({c}) > 0 AND var_pop({S.LABEL_COL}) > 0 "
             f"THEN round(corr({c}, {S.LABEL_COL}), 6) + 0.0 END AS corr FROM gold" for c in S.NUMERIC_FEATURES]
    return (O.with_(*O.BASE_GOLD) + ", c AS (" + " UNION ALL ".join(parts) + ")\n"
            "SELECT feature, corr, CAST(row_number() OVER (ORDER BY abs(corr) DESC NULLS LAST, feature) AS INTEGER) AS rank FROM c")


@query("label_correlation_rank", _label_corr_sql())
def q_label_correlation_rank(spark, sf):
    return M.label_correlation_rank(T.gold(spark, sf), S.NUMERIC_FEATURES)


@query("silver_coverage", _w(*O.BASE_SILVER) + """
SELECT count(DISTINCT link_id) AS links, count(*) AS rows,
  count(DISTINCT year(data_as_of) * 100 + month(data_as_of)) AS months,
  min(data_as_of) AS first_ts, max(data_as_of) AS last_ts FROM silver""")
def q_silver_coverage(spark, sf):
    return G.coverage(T.silver(spark, sf))


@query("snapshot_readiness", _w(*O.BASE_SNAP) + f"""
SELECT count(DISTINCT link_id) AS distinct_links, count(DISTINCT link_id) >= 20 AS ready FROM snapshots
WHERE data_as_of >= TIMESTAMP '{T.NOW}' - INTERVAL {int(LOOKBACK_MIN)} MINUTE""")
def q_snapshot_readiness(spark, sf):
    w = R.lookback_window(T.snapshots(spark, sf), T.NOW, LOOKBACK_MIN)
    return G.snapshot_readiness(w)


# ---------------------------------------------------------------- 2.6 windows
@query("gold_features", _w(*O.BASE_GOLD) + f"SELECT {', '.join(S.GOLD_COLUMNS)} FROM gold")
def q_gold_features(spark, sf):
    return T.gold(spark, sf)


@query("gap_minutes", _w(*O.BASE_GOLD) + """
SELECT link_id, data_as_of, gap_15min, gap_30min, gap_45min, gap_60min, gap_future_15min FROM gold""")
def q_gap_minutes(spark, sf):
    """W3 + P10: whole-second gaps of every kept row, each inside its (scaled) tolerance."""
    from roadlake.operators.joins import enrich_free_flow
    from roadlake.operators.windows import gold_features
    e = enrich_free_flow(T.silver(spark, sf), T.lookup(spark, sf))
    g = gold_features(e, T.GOLD_PARAMS, ts="data_as_of_utc", tie=("speed",), keep_gaps=True)
    return g.select("link_id", "data_as_of", "gap_15min", "gap_30min", "gap_45min", "gap_60min", "gap_future_15min")


@query("latest_per_link", _w(*O.BASE_SNAP) + """
SELECT link_id, data_as_of, current_congestion, speed_ratio, event_id FROM snapshots
QUALIFY row_number() OVER (PARTITION BY link_id ORDER BY data_as_of DESC, event_id) = 1""")
def q_latest_per_link(spark, sf):
    s = T.snapshots(spark, sf).select("link_id", "data_as_of", "current_congestion", "speed_ratio", "event_id")
    return W.latest_per_link(s, tie="event_id")


@query("change_detect", _w(O.READINGS) + """
SELECT event_id, link_id, day FROM (
  SELECT event_id, link_id, day, lag(day) OVER (PARTITION BY link_id ORDER BY data_as_of, event_id) AS prev
  FROM (SELECT *, date_trunc('day', data_as_of) AS day FROM readings WHERE speed > 0 AND speed < 100) r) x
WHERE prev IS DISTINCT FROM day""")
def q_change_detect(spark, sf):
    r = P.filter_valid_speed(T.readings(spark, sf))
    # to_date -> NTZ midnight stays zone free (date_trunc would yield a zoned timestamp)
    r = r.select("event_id", "link_id", F.to_date("data_as_of").cast("timestamp_ntz").alias("day"),
                 F.col("data_as_of").alias("ingest_ts"), F.col("event_id").alias("row_no"))
    return W.change_detect(r, value="day").select("event_id", "link_id", "day")


@query("order_within_link", _w(*O.BASE_SNAP) + "SELECT link_id, data_as_of, speed_ratio FROM snapshots")
def q_order_within_link(spark, sf):
    return W.order_within_link(T.snapshots(spark, sf)).select("link_id", "data_as_of", "speed_ratio")


# ---------------------------------------------------------------- 2.7 scalar functions
@query("parse_utc_ts", _w(O.BRONZE) + r"""
SELECT link_id, data_as_of AS raw, CASE WHEN regexp_matches(data_as_of, '^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}$')
  THEN TRY_CAST(data_as_of AS TIMESTAMP) END AS data_as_of FROM bronze""")
def q_parse_utc_ts(spark, sf):
    b = T.bronze(spark, sf)
    return b.select("link_id", F.col("data_as_of").alias("raw"), parse_utc_ts("data_as_of").alias("data_as_of"))


@query("utc_to_local", _w(O.READINGS) + """
SELECT event_id, (data_as_of AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS local_ts FROM readings""")
def q_utc_to_local(spark, sf):
    return T.readings(spark, sf).select("event_id", utc_to_local("data_as_of").alias("local_ts"))


@query("parse_local_ts", _w(O.FEED) + """
SELECT event_id, (strptime(trim(trim("DataAsOf"), '"'), '%m/%d/%Y %H:%M:%S') AT TIME ZONE 'America/New_York')
  AT TIME ZONE 'UTC' AS data_as_of FROM feed""")
def q_parse_local_ts(spark, sf):
    f = T.feed_rows(T.table(spark, sf, "events"))
    return f.select("event_id", parse_local_ts(clean_quotes("raw_time")).alias("data_as_of"))


@query("calendar_features", _w(*O.BASE_SILVER) + """
SELECT link_id, data_as_of_utc, hour, day_of_week, month, is_weekend, year FROM silver""")
def q_calendar_features(spark, sf):
    s = T.silver(spark, sf)
    return s.select("link_id", "data_as_of_utc", *calendar_features("data_as_of"),
                    F.year("data_as_of").cast("int").alias("year"))


@query("partition_keys", _w(O.READINGS) + """
SELECT event_id, strftime((data_as_of AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York', '%Y-%m-%d') AS date,
  strftime((data_as_of AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York', '%H') AS hour FROM readings""")
def q_partition_keys(spark, sf):
    r = T.readings(spark, sf).withColumn("_l", utc_to_local("data_as_of"))
    return r.select("event_id", local_date_str("_l").alias("date"), local_hour_str("_l").alias("hour"))


@query("epoch_arith", _w(O.READINGS) + f"""
SELECT event_id, epoch_us(data_as_of) // 1000000 AS epoch_seconds,
  (epoch_us(TIMESTAMP '{T.NOW}') // 1000000 - epoch_us(data_as_of) // 1000000) / 60.0 AS minutes_to_now FROM readings""")
def q_epoch_arith(spark, sf):
    r = T.readings(spark, sf)
    now = F.lit(T.NOW).cast("timestamp_ntz")
    return r.select("event_id", epoch_seconds("data_as_of").alias("epoch_seconds"),
                    minutes_between(now, F.col("data_as_of")).alias("minutes_to_now"))


@query("clean_quotes", _w(O.FEED) + """
SELECT event_id, trim(trim("linkId"), '"') AS link_id, trim(trim("Speed"), '"') AS speed,
  trim(trim("linkName"), '"') AS link_name FROM feed""")
def q_clean_quotes(spark, sf):
    f = T.feed_rows(T.table(spark, sf, "events"))
    return f.select("event_id", clean_quotes("raw_link").alias("link_id"), clean_quotes("raw_speed").alias("speed"),
                    clean_quotes("raw_name").alias("link_name"))


@query("parse_first_point", _w(O.BRONZE) + r"""
SELECT link_id, data_as_of, CASE WHEN ok THEN TRY_CAST(a AS DOUBLE) END AS lat, CASE WHEN ok THEN TRY_CAST(b AS DOUBLE) END AS lon
FROM (SELECT link_id, data_as_of, parts[1] AS a, parts[2] AS b,
        len(parts) = 2 AND regexp_matches(trim(parts[1]), '^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$')
                       AND regexp_matches(trim(parts[2]), '^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$') AS ok
      FROM (SELECT link_id, data_as_of, string_split(string_split(trim(link_points), ' ')[1], ',') AS parts FROM bronze) x) y""")
def q_parse_first_point(spark, sf):
    b = T.bronze(spark, sf)
    p = parse_first_point("link_points")
    return b.select("link_id", "data_as_of", p.getField("lat").alias("lat"), p.getField("lon").alias("lon"))


@query("json_roundtrip", _w(*O.BASE_SNAP) + """
SELECT event_id, data_as_of, current_congestion, speed_ratio, link_name FROM snapshots""")
def q_json_roundtrip(spark, sf):
    s = T.snapshots(spark, sf)
    enc = s.select("event_id", json_encode_snapshot().alias("value"))
    dec = enc.select("event_id", json_decode_snapshot("value").alias("v"))
    return dec.select("event_id", "v.data_as_of", "v.current_congestion", "v.speed_ratio", "v.link_name")


@query("json_decode", "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def q_json_decode(spark, sf):
    e = T.table(spark, sf, "events")
    return e.select("event_id", F.from_json("props", "k INT").getField("k").alias("k"))


@query("target_time", _w(*O.BASE_SNAP) + """
SELECT event_id, data_as_of + INTERVAL 15 MINUTE AS target_time FROM snapshots""")
def q_target_time(spark, sf):
    return T.snapshots(spark, sf).select("event_id", plus_minutes("data_as_of", S.TARGET_MINUTES).alias("target_time"))


@query("confidence", "SELECT vec_id, CAST(list_max(embedding) AS DOUBLE) AS confidence FROM embeddings")
def q_confidence(spark, sf):
    e = T.table(spark, sf, "embeddings")
    return e.select("vec_id", confidence("embedding").alias("confidence"))


@query("class_label", _w(*O.BASE_LOOKUP, O.ENRICHED) + """
SELECT link_id, data_as_of_utc,
  CASE current_congestion WHEN 0 THEN '0-free flow' WHEN 1 THEN '1-congested' WHEN 2 THEN '2-severe' END AS label
FROM enriched""")
def q_class_label(spark, sf):
    e = _enriched(spark, sf)
    return e.select("link_id", "data_as_of_utc", class_label("current_congestion").alias("label"))


# ---------------------------------------------------------------- 2.8 streaming rules (batch-equal forms)
@query("case_cascade", _w(O.READINGS, O.ACTIVE) + f"""
SELECT event_id, link_id, CASE
  WHEN link_id NOT IN (SELECT link_id FROM active) THEN 'inactive'
  WHEN data_as_of < TIMESTAMP '{T.NOW}' - INTERVAL {int(DEAD_MIN)} MINUTE THEN 'dead'
  WHEN speed IS NULL OR speed <= 0 OR speed >= 100 THEN 'faulty_sensor'
  ELSE 'valid' END AS verdict FROM readings""")
def q_case_cascade(spark, sf):
    from roadlake.streaming.collector import case_cascade
    return case_cascade(T.readings(spark, sf), T.active(spark, sf), T.NOW, DEAD_MIN) \
        .select("event_id", "link_id", "verdict")


@query("lookback_window", _w(*O.BASE_SNAP) + f"""
SELECT link_id, event_id, data_as_of FROM snapshots
WHERE data_as_of >= TIMESTAMP '{T.NOW}' - INTERVAL {int(LOOKBACK_MIN)} MINUTE""")
def q_lookback_window(spark, sf):
    return R.lookback_window(T.snapshots(spark, sf), T.NOW, LOOKBACK_MIN).select("link_id", "event_id", "data_as_of")


# ---------------------------------------------------------------- 2.10 quality
@query("link_coordinates", _w(O.BRONZE, O.ACTIVE) + r""",
firsts AS (SELECT link_id, arg_min(link_points, data_as_of) AS lp FROM bronze
           WHERE link_points IS NOT NULL AND link_id IN (SELECT link_id FROM active) GROUP BY link_id),
p AS (SELECT link_id, string_split(string_split(trim(lp), ' ')[1], ',') AS parts FROM firsts)
SELECT link_id, TRY_CAST(parts[1] AS DOUBLE) AS lat, TRY_CAST(parts[2] AS DOUBLE) AS lon FROM p
WHERE len(parts) = 2 AND regexp_matches(trim(parts[1]), '^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$')
  AND regexp_matches(trim(parts[2]), '^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$')""")
def q_link_coordinates(spark, sf):
    return link_coordinates(T.bronze(spark, sf), T.active(spark, sf))


@query("expected_count", _w(O.BRONZE, O.ACTIVE) + r""",
firsts AS (SELECT link_id, arg_min(link_points, data_as_of) AS lp FROM bronze
           WHERE link_points IS NOT NULL AND link_id IN (SELECT link_id FROM active) GROUP BY link_id),
p AS (SELECT link_id, string_split(string_split(trim(lp), ' ')[1], ',') AS parts FROM firsts)
SELECT count(*) AS rows, 125 AS expected, count(*) = 125 AS ok FROM p
WHERE len(parts) = 2 AND regexp_matches(trim(parts[1]), '^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$')
  AND regexp_matches(trim(parts[2]), '^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$')""")
def q_expected_count(spark, sf):
    from roadlake.operators.quality import expected_count
    return expected_count(link_coordinates(T.bronze(spark, sf), T.active(spark, sf)), S.EXPECTED_COORDINATE_ROWS)


@query("silver_clean", _w(*O.BASE_SILVER) + "SELECT * FROM silver")
def q_silver_clean(spark, sf):
    return T.clean(spark, sf)


@query("profile_snapshots", _w(*O.BASE_SNAP) + """
SELECT count(*) AS rows, count(DISTINCT link_id) AS links, min(data_as_of) AS min_ts, max(data_as_of) AS max_ts,
  count(*) FILTER (WHERE link_name IS NULL) AS null_names FROM snapshots""")
def q_profile_snapshots(spark, sf):
    from roadlake.operators.quality import profile
    return profile(T.snapshots(spark, sf))


# ---------------------------------------------------------------- 2.9 ML (index only is SQL-checkable)
@query("index_categories", _w(*O.BASE_GOLD, O.GOLD_SPLIT) + """
SELECT link_id, CAST(row_number() OVER (ORDER BY count(*) DESC, link_id) - 1 AS DOUBLE) AS link_id_idx
FROM gold_split WHERE split = 'train' GROUP BY link_id""")
def q_index_categories(spark, sf):
    from roadlake.operators.ml import index_labels
    train = _gold_split(spark, sf).filter(F.col("split") == "train")
    return index_labels(train, "link_id")


def _forest(spark, sf):
    """The frame with its splits and the forest fitted on the sampled train split of the dense series."""
    from roadlake.plans.training import fit_forest, prepare
    frame = prepare(T.dense_gold(spark, sf), T.DENSE_SPLITS, checkpoint_path=f"{checkpoint_dir(spark)}/frame-{uuid.uuid4().hex}")
    return frame, fit_forest(frame)


def _predictions(spark, sf) -> DataFrame:
    from roadlake.operators.ml import score_batch
    _, model = _forest(spark, sf)
    feats = serving_features(_window(spark, sf), T.lookup(spark, sf), T.holidays(spark), tie="event_id", params=T.SERVING_PARAMS)
    return score_batch(model, feats)


@query("score_batch", O.with_(f"served AS ({_serving_sql()})") + """
SELECT link_id, data_as_of AS timestamp, data_as_of + INTERVAL 15 MINUTE AS target_time, TRUE AS class_ok, TRUE AS confidence_ok
FROM served""")
def q_score_batch(spark, sf):
    """M7: one prediction per served link; which class is the forest's own business, that it is one is not."""
    p = _predictions(spark, sf)
    return p.select("link_id", "timestamp", "target_time", F.col("predicted_congestion").isin(*S.CLASSES).alias("class_ok"),
                    F.col("confidence").between(0.333, 1.0).alias("confidence_ok"))


@query("prediction_profile", O.with_(f"served AS ({_serving_sql()})") + """
SELECT count(*) AS rows, count(DISTINCT link_id) AS links, min(data_as_of) AS min_ts, max(data_as_of) AS max_ts,
  count(*) FILTER (WHERE link_name IS NULL) AS null_names FROM served""")
def q_prediction_profile(spark, sf):
    """K8 -> S7 -> Q5: predictions are written, scanned again and profiled."""
    from roadlake.operators.quality import profile
    from roadlake.sources.writers import write_predictions
    root = f"{checkpoint_dir(spark)}/predictions-{uuid.uuid4().hex}"
    write_predictions(_predictions(spark, sf), root, T.NOW, run_id="profile", batch_id=0)
    return profile(R.scan_predictions(spark, root), ts="timestamp")


@query("prediction_report", _w(*O.BASE_SNAP, """preds AS (
  SELECT link_id, data_as_of AS timestamp, CAST(current_congestion AS INTEGER) AS predicted_congestion, speed_ratio AS confidence FROM snapshots)""",
  """newest AS (SELECT CAST(row_number() OVER (ORDER BY timestamp DESC, link_id, predicted_congestion) AS INTEGER) AS place, * FROM preds)""") + """
SELECT 'summary' AS section, 1 AS place, 'rows' AS item, CAST(count(*) AS DOUBLE) AS number, CAST(NULL AS TIMESTAMP) AS at FROM preds
UNION ALL SELECT 'summary', 2, 'links', count(DISTINCT link_id), NULL FROM preds
UNION ALL SELECT 'summary', 3, 'first', NULL, min(timestamp) FROM preds
UNION ALL SELECT 'summary', 4, 'last', NULL, max(timestamp) FROM preds
UNION ALL SELECT 'class', c + 1, label, (SELECT count(*) FROM preds WHERE predicted_congestion = c), NULL
  FROM (VALUES (0, '0-free flow'), (1, '1-congested'), (2, '2-severe')) t(c, label)
UNION ALL SELECT 'class', 4, 'other', count(*) FILTER (WHERE predicted_congestion IS NULL OR predicted_congestion NOT IN (0, 1, 2)), NULL FROM preds
UNION ALL SELECT 'nulls', 1, 'confidence', count(*) FILTER (WHERE confidence IS NULL), NULL FROM preds
UNION ALL SELECT 'nulls', 2, 'link_id', count(*) FILTER (WHERE link_id IS NULL), NULL FROM preds
UNION ALL SELECT 'nulls', 3, 'predicted_congestion', count(*) FILTER (WHERE predicted_congestion IS NULL), NULL FROM preds
UNION ALL SELECT 'nulls', 4, 'timestamp', count(*) FILTER (WHERE timestamp IS NULL), NULL FROM preds
UNION ALL SELECT 'confidence', 1, 'count', count(confidence), NULL FROM preds
UNION ALL SELECT 'confidence', 2, 'mean', round(avg(confidence), 4), NULL FROM preds
UNION ALL SELECT 'confidence', 3, 'std', round(stddev_samp(confidence), 4), NULL FROM preds
UNION ALL SELECT 'confidence', 4, 'min', round(min(confidence), 4), NULL FROM preds
UNION ALL SELECT 'confidence', 5, 'p25', round(quantile_cont(confidence, 0.25), 4), NULL FROM preds
UNION ALL SELECT 'confidence', 6, 'p50', round(quantile_cont(confidence, 0.5), 4), NULL FROM preds
UNION ALL SELECT 'confidence', 7, 'p75', round(quantile_cont(confidence, 0.75), 4), NULL FROM preds
UNION ALL SELECT 'confidence', 8, 'max', round(max(confidence), 4), NULL FROM preds
UNION ALL SELECT 'newest', place, CAST(link_id AS VARCHAR), predicted_congestion, timestamp FROM newest WHERE place <= 10""")
def q_prediction_report(spark, sf):
    """Q5 whole: the report of persistence predictions (the present class holds, the ratio stands for the confidence)."""
    from roadlake.operators.quality import prediction_report
    s = T.snapshots(spark, sf)
    return prediction_report(s.select("link_id", F.col("data_as_of").alias("timestamp"), F.col("current_congestion").cast("int").alias("predicted_congestion"),
                                      F.col("speed_ratio").alias("confidence")))


@query("forest_evidence", _w(*O.DENSE_GOLD, """held AS (
  SELECT split, CAST(future_congestion_15min AS DOUBLE) AS a, CAST(current_congestion AS DOUBLE) AS p FROM dense_split WHERE split <> 'train')""",
  """f AS (SELECT split, c, 2.0 * count(*) FILTER (WHERE a = c AND p = c)
            / nullif(count(*) FILTER (WHERE a = c) + count(*) FILTER (WHERE p = c), 0) AS f1
          FROM held CROSS JOIN (VALUES (0.0), (1.0), (2.0)) t(c) GROUP BY split, c)""") + """
SELECT split, (SELECT count(*) FROM held h WHERE h.split = f.split) AS rows,
  CAST(round(sum(coalesce(f1, 0)) / 3, 6) AS DOUBLE) AS persistence_f1,
  TRUE AS rows_ok, 1.0::DOUBLE AS importance_total, 19 AS features FROM f GROUP BY split""")
def q_forest_evidence(spark, sf):
    """M3-M6: next to the persistence forecast of each split, what must hold of any forest: it scores every row, its importances add up to 1."""
    from roadlake.operators.ml import feature_importance
    from roadlake.plans.training import evaluate
    frame, model = _forest(spark, sf)
    shares = feature_importance(model).agg(F.round(F.sum("importance"), 6).alias("importance_total"), F.count("feature").cast("int").alias("features"))
    parts = []
    for split in ("val", "test"):
        held = frame.filter(F.col("split") == split)
        last = held.select(F.col(S.LABEL_COL), F.col("current_congestion").cast("double").alias("prediction"))
        plain = M.macro_f1(M.class_metrics(last)).select("rows", F.round("macro_f1", 6).alias("persistence_f1"))
        own = evaluate(model, held)["macro_f1"].select(F.col("rows").alias("scored"))
        parts.append(plain.crossJoin(own).crossJoin(shares)  # one row each
                     .where(F.col("rows") > 0)
                     .select(F.lit(split).alias("split"), "rows", "persistence_f1", (F.col("rows") == F.col("scored")).alias("rows_ok"),
                             "importance_total", "features"))
    return P.union_all(parts)


@query("evaluate_split", _w(*O.DENSE_GOLD) + """
SELECT split, count(*) AS rows, TRUE AS f1_ok FROM dense_split WHERE split <> 'train' GROUP BY split""")
def q_evaluate_split(spark, sf):
    """M5: the confusion counts of the fitted model add up to all rows of the split."""
    from roadlake.plans.training import evaluate
    frame, model = _forest(spark, sf)
    parts = []
    for split in ("val", "test"):
        e = evaluate(model, frame.filter(F.col("split") == split))
        n = e["confusion"].agg(F.sum(F.col("pred_0") + F.col("pred_1") + F.col("pred_2")).cast("long").alias("rows"))
        parts.append(n.crossJoin(e["macro_f1"].select(F.col("macro_f1").between(0.0, 1.0).alias("f1_ok")))  # one row each
                     .where(F.col("rows") > 0).select(F.lit(split).alias("split"), "rows", "f1_ok"))
    return P.union_all(parts)


@query("feature_importance", None)
def q_feature_importance(spark, sf):
    from roadlake.operators.ml import feature_importance
    return feature_importance(_forest(spark, sf)[1])


# ---------------------------------------------------------------- dense series, order and written forms
@query("gold_features_dense", _w(*O.DENSE_GOLD) + f"SELECT {', '.join(S.GOLD_COLUMNS)} FROM dense_gold")
def q_gold_features_dense(spark, sf):
    return T.dense_gold(spark, sf)


@query("change_detect_arrival", _w(O.READINGS) + """
SELECT event_id, link_id, hour FROM (
  SELECT event_id, link_id, hour, row_number() OVER w AS rn, lag(hour) OVER w AS prev
  FROM (SELECT *, CASE WHEN event_id % 11 = 0 THEN NULL ELSE date_trunc('day', data_as_of) END AS hour,
               (event_id * 7919) % 1000003 AS arrival FROM readings) r
  WINDOW w AS (PARTITION BY link_id ORDER BY arrival, event_id)) x
WHERE rn = 1 OR prev IS DISTINCT FROM hour""")
def q_change_detect_arrival(spark, sf):
    """W6 with rows that arrive out of time order (A, B, A happens) and null values."""
    r = T.readings(spark, sf)
    arrival = (F.col("event_id") * 7919) % 1000003
    day = F.when(F.col("event_id") % 11 != 0, F.to_date("data_as_of").cast("timestamp_ntz"))
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    r = r.select("event_id", "link_id", day.alias("hour"), F.timestamp_add("SECOND", arrival, start).alias("ingest_ts"),
                 F.col("event_id").alias("row_no"))
    return W.change_detect(r, value="hour").select("event_id", "link_id", "hour")


@query("order_within_link_rank", _w(*O.BASE_SNAP) + """
SELECT link_id, data_as_of, CAST(row_number() OVER (ORDER BY link_id, data_as_of, event_id) - 1 AS BIGINT) AS place FROM snapshots""")
def q_order_within_link_rank(spark, sf):
    """W7 + W8: the place of every row in the written, ordered output."""
    s = W.order_output(T.snapshots(spark, sf).select("link_id", "data_as_of", "event_id"), "link_id", "data_as_of", "event_id")
    return T.numbered(s).select("link_id", "data_as_of", "place")


# ---------------------------------------------------------------- stored and merged state
@query("asof_join", _w(O.READINGS) + """,
l AS (SELECT * FROM readings WHERE borough = 'click'),
r AS (SELECT link_id, data_as_of, min(event_id) AS event_id FROM readings WHERE borough <> 'click' GROUP BY ALL)
SELECT l.event_id, r.event_id AS matched, (epoch_us(l.data_as_of) - epoch_us(r.data_as_of)) / 60000000.0 AS minutes
FROM l ASOF LEFT JOIN r ON l.link_id = r.link_id AND l.data_as_of >= r.data_as_of""")
def q_asof_join(spark, sf):
    """Each click with the last other reading of its link: an as-of join of two tables."""
    r = T.readings(spark, sf)
    met = asof_join(r.where("borough = 'click'"), r.where("borough <> 'click'"), ["event_id"], tie="event_id")
    gap = (epoch_micros(F.col("data_as_of")) - F.col("match.u")) / F.lit(60_000_000.0)
    return met.select("event_id", F.col("match.event_id").alias("matched"), gap.alias("minutes"))


@query("free_flow_speed_months", """
SELECT CAST(l_suppkey AS VARCHAR) AS link_id, CAST(quantile_disc(l_quantity, 0.85) AS DOUBLE) AS free_flow_speed
FROM lineitem WHERE l_quantity IS NOT NULL GROUP BY l_suppkey""")
def q_free_flow_speed_months(spark, sf):
    """P85 from stored month cells, refined inside the one cell that holds it."""
    li = T.table(spark, sf, "lineitem").select(F.col("l_suppkey").cast("string").alias("link_id"), F.col("l_quantity").cast("double").alias("speed"),
                                               F.trunc("l_shipdate", "month").alias("month"))
    cells = T.kept(spark, sf, "speed-cells", lambda: G.speed_sketches(li, [F.col("month")], width=5.0))
    return G.refined_speed(li, G.sketched_speed(cells, width=5.0))


@query("correlation_months", _corr_sql())
def q_correlation_months(spark, sf):
    """The matrix of all rows from the co-moments of each month."""
    gold = T.gold(spark, sf).withColumn("month_of", F.trunc("data_as_of", "month"))
    months = T.kept(spark, sf, "co-moments", lambda: M.co_moments(gold, CORR_COLS, ["month_of"]))
    return M.correlations(M.merge_co_moments(months), CORR_COLS)


@query("coverage_sketched", _w(*O.BASE_SILVER) + """
SELECT count(*) AS rows, true AS within_bound, count(DISTINCT link_id) >= 20 AS ready FROM silver""")
def q_coverage_sketched(spark, sf):
    """Distinct links and readiness from stored hour sketches; the estimate is checked against its error bound."""
    silver = T.silver(spark, sf)
    hours = T.kept(spark, sf, "link-sketches", lambda: G.link_sketches(silver, [F.date_trunc("hour", "data_as_of").alias("hour")]))
    exact = G.distinct_links(silver).withColumnRenamed("distinct_links", "exact")
    bound = F.greatest(F.lit(1.0), F.lit(4 * 1.04 / 2 ** (G.LG_K / 2)) * F.col("exact"))
    # one row each
    return (G.sketched_links(hours).crossJoin(F.broadcast(exact))
            .select("rows", (F.abs(F.col("distinct_links") - F.col("exact")) <= bound).alias("within_bound"), "ready"))


from . import stored  # noqa: E402,F401  (registers the queries of sinks and streams)


def queries() -> dict:
    return {k: v[0] for k, v in Q.items()}


def oracle_sql() -> dict:
    return {k: v[1] for k, v in Q.items() if v[1] is not None}
