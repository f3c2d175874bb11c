"""Reference SQL (DuckDB dialect) for the query catalog.

Each statement recomputes its query from the raw test tables with plain SQL --
single windows, joins and aggregates, no halo splitting -- so it checks the
Spark plans, not a copy of them.  Minute constants carry the test scale (150).
"""

from __future__ import annotations

# ---- shared derived tables -------------------------------------------------

READINGS = """readings AS (
  SELECT CAST(user_id AS VARCHAR) AS link_id, event_type AS borough,
         'link-' || CAST(user_id AS VARCHAR) AS link_name, ts AS data_as_of, value AS speed, event_id
  FROM events)"""

BRONZE = r"""bronze AS (
  SELECT CAST(user_id AS VARCHAR) AS link_id, event_type AS borough,
         'link-' || CAST(user_id AS VARCHAR) AS link_name,
         CASE WHEN bad = 1 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS speed,
         CASE WHEN bad = 2 THEN 'not a time' ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') END AS data_as_of,
         CASE TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 10
           WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'no points' WHEN 3 THEN '40.5'
           WHEN 4 THEN '40.5,-73.9,7 40.6,-73.8'
           ELSE '40.' || lpad(CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR), 2, '0')
                || ',-73.' || lpad(CAST(user_id % 100 AS VARCHAR), 2, '0') || ' 40.80,-73.90' END AS link_points
  FROM (SELECT *, 0 AS bad FROM events UNION ALL SELECT *, 1 FROM events WHERE event_id % 89 = 0
        UNION ALL SELECT *, 2 FROM events WHERE event_id % 97 = 0) e)"""

ACTIVE = """active AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS link_id FROM events
                     WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 48 HOUR)"""

SILVER = r"""silver AS (
  SELECT link_id, borough, link_name, loc AS data_as_of, spd AS speed,
         CAST(hour(loc) AS INTEGER) AS hour, CAST(dayofweek(loc) + 1 AS INTEGER) AS day_of_week,
         CAST(month(loc) AS INTEGER) AS month,
         CAST(CASE WHEN dayofweek(loc) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend,
         CAST(CASE WHEN strftime(loc, '%Y-%m-%d') IN ('2024-01-01', '2024-01-15') THEN 1 ELSE 0 END AS INTEGER) AS is_holiday,
         utc AS data_as_of_utc, CAST(year(loc) AS INTEGER) AS year
  FROM (SELECT *, ((utc AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') AS loc FROM (
          SELECT b.link_id, b.borough, b.link_name, TRY_CAST(b.speed AS DOUBLE) AS spd,
                 CASE WHEN regexp_matches(b.data_as_of, '^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}$')
                      THEN TRY_CAST(b.data_as_of AS TIMESTAMP) END AS utc
          FROM bronze b) x
        WHERE spd > 0 AND spd < 100 AND utc IS NOT NULL AND link_id IN (SELECT link_id FROM active)) y)"""

LOOKUP = """lookup AS (
  SELECT link_id, CAST(quantile_disc(speed, 0.85) AS DOUBLE) AS free_flow_speed,
         arg_min(borough, data_as_of_utc) AS borough, arg_min(link_name, data_as_of_utc) AS link_name
  FROM silver WHERE data_as_of < TIMESTAMP '2024-01-21 00:00:00' GROUP BY link_id)"""

ENRICHED = """enriched AS (
  SELECT *, CAST(CASE WHEN speed_ratio IS NULL THEN NULL WHEN speed_ratio >= 0.67 THEN 0
                      WHEN speed_ratio >= 0.40 THEN 1 ELSE 2 END AS INTEGER) AS current_congestion
  FROM (SELECT s.*, l.free_flow_speed,
               CASE WHEN l.free_flow_speed > 0 THEN s.speed / l.free_flow_speed END AS speed_ratio
        FROM silver s LEFT JOIN lookup l ON s.link_id = l.link_id) e)"""

# lag rows / tolerance windows scaled by 150: 15 -> (1500, 3000) ...
GOLD = """gold AS (
  SELECT link_id, borough, hour, day_of_week, month, is_weekend, is_holiday,
         speed_ratio, current_congestion,
         pc15 AS past_congestion_15min, pr15 AS past_speed_ratio_15min,
         pc30 AS past_congestion_30min, pr30 AS past_speed_ratio_30min,
         pc45 AS past_congestion_45min, pr45 AS past_speed_ratio_45min,
         pc60 AS past_congestion_60min, pr60 AS past_speed_ratio_60min,
         CAST(current_congestion - pc15 AS INTEGER) AS congestion_trend,
         speed_ratio - pr15 AS speed_ratio_trend,
         fc AS future_congestion_15min, data_as_of, year,
         (sec - ps15) / 60.0 AS gap_15min, (sec - ps30) / 60.0 AS gap_30min,
         (sec - ps45) / 60.0 AS gap_45min, (sec - ps60) / 60.0 AS gap_60min,
         (fs - sec) / 60.0 AS gap_future_15min
  FROM (
    SELECT *,
      lag(current_congestion, 3) OVER w AS pc15, lag(speed_ratio, 3) OVER w AS pr15, lag(sec, 3) OVER w AS ps15,
      lag(current_congestion, 6) OVER w AS pc30, lag(speed_ratio, 6) OVER w AS pr30, lag(sec, 6) OVER w AS ps30,
      lag(current_congestion, 9) OVER w AS pc45, lag(speed_ratio, 9) OVER w AS pr45, lag(sec, 9) OVER w AS ps45,
      lag(current_congestion, 12) OVER w AS pc60, lag(speed_ratio, 12) OVER w AS pr60, lag(sec, 12) OVER w AS ps60,
      lead(current_congestion, 3) OVER w AS fc, lead(sec, 3) OVER w AS fs
    FROM (SELECT *, epoch_us(data_as_of_utc) // 1000000 AS sec FROM enriched) z
    WINDOW w AS (PARTITION BY link_id ORDER BY data_as_of_utc, speed)) q
  WHERE (fs IS NULL OR (fs - sec) / 60.0 BETWEEN 1500 AND 3000)
    AND (ps15 IS NULL OR (sec - ps15) / 60.0 BETWEEN 1500 AND 3000)
    AND (ps30 IS NULL OR (sec - ps30) / 60.0 BETWEEN 3750 AND 5250)
    AND (ps45 IS NULL OR (sec - ps45) / 60.0 BETWEEN 6000 AND 7500)
    AND (ps60 IS NULL OR (sec - ps60) / 60.0 BETWEEN 8250 AND 9750)
    AND pc15 IS NOT NULL AND pc30 IS NOT NULL AND pc45 IS NOT NULL AND pc60 IS NOT NULL
    AND pr15 IS NOT NULL AND pr30 IS NOT NULL AND pr45 IS NOT NULL AND pr60 IS NOT NULL
    AND fc IS NOT NULL AND speed_ratio IS NOT NULL AND current_congestion IS NOT NULL)"""

GOLD_SPLIT = """gold_split AS (
  SELECT *, CASE WHEN data_as_of < TIMESTAMP '2024-01-21 00:00:00' THEN 'train'
                 WHEN data_as_of < TIMESTAMP '2024-01-26 00:00:00' THEN 'val'
                 ELSE 'test' END AS split
  FROM gold)"""

SNAPSHOTS = """snapshots AS (
  SELECT r.link_id, r.data_as_of,
         CAST(CASE WHEN r.speed / l.free_flow_speed >= 0.67 THEN 0
                   WHEN r.speed / l.free_flow_speed >= 0.40 THEN 1 ELSE 2 END AS INTEGER) AS current_congestion,
         r.speed / l.free_flow_speed AS speed_ratio, r.link_name, l.borough, r.speed, r.event_id
  FROM readings r JOIN lookup l ON r.link_id = l.link_id
  WHERE r.speed > 0 AND r.speed < 100 AND l.free_flow_speed > 0)"""

FEED = """feed AS (
  SELECT '"' || CAST(user_id AS VARCHAR) || '"' AS "linkId",
         '"' || CAST(value AS VARCHAR) || '"' AS "Speed",
         '"' || strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York', '%m/%d/%Y %H:%M:%S') || '"' AS "DataAsOf",
         '"link-' || CAST(user_id AS VARCHAR) || '"' AS "linkName", event_id, ts
  FROM events)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE_SILVER = (BRONZE, ACTIVE, SILVER)
BASE_LOOKUP = BASE_SILVER + (LOOKUP,)
BASE_GOLD = BASE_LOOKUP + (ENRICHED, GOLD)
BASE_SNAP = (READINGS,) + BASE_LOOKUP + (SNAPSHOTS,)

# the dense series: every constant unscaled
DENSE_SILVER = """dense_silver AS (
  SELECT link_id, 'b' AS borough, 'link-' || link_id AS link_name, loc AS data_as_of, speed,
         CAST(hour(loc) AS INTEGER) AS hour, CAST(dayofweek(loc) + 1 AS INTEGER) AS day_of_week,
         CAST(month(loc) AS INTEGER) AS month,
         CAST(CASE WHEN dayofweek(loc) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER) AS is_weekend, 0 AS is_holiday,
         utc AS data_as_of_utc, CAST(year(loc) AS INTEGER) AS year
  FROM (SELECT *, ((utc AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') AS loc FROM (
    SELECT CAST(l_suppkey % 20 AS VARCHAR) AS link_id, l_quantity AS speed, l_orderkey,
           TIMESTAMP '2024-03-01 05:00:00' + INTERVAL 5 MINUTE *
             (row_number() OVER (PARTITION BY l_suppkey % 20 ORDER BY l_orderkey, l_linenumber, l_extendedprice) - 1)
             + CASE WHEN l_orderkey % 97 = 0 THEN INTERVAL 3650 DAY ELSE INTERVAL 0 DAY END AS utc
    FROM lineitem) x) y)"""

DENSE_LOOKUP = """dense_lookup AS (
  SELECT link_id, CAST(quantile_disc(speed, 0.85) AS DOUBLE) AS free_flow_speed
  FROM dense_silver WHERE data_as_of < TIMESTAMP '2024-03-02 00:00:00' GROUP BY link_id)"""


def _unscaled(sql: str) -> str:
    """The gold statement at scale 1: tolerances in minutes."""
    for wide, narrow in (("1500 AND 3000", "10 AND 20"), ("3750 AND 5250", "25 AND 35"),
                         ("6000 AND 7500", "40 AND 50"), ("8250 AND 9750", "55 AND 65")):
        sql = sql.replace(wide, narrow)
    return sql


DENSE_GOLD = (DENSE_SILVER, DENSE_LOOKUP,
              ENRICHED.replace("enriched AS", "dense_enriched AS").replace("FROM silver s", "FROM dense_silver s").replace("JOIN lookup l", "JOIN dense_lookup l"),
              _unscaled(GOLD).replace("gold AS", "dense_gold AS").replace("FROM enriched)", "FROM dense_enriched)"),
              """dense_split AS (
  SELECT *, CASE WHEN data_as_of < TIMESTAMP '2024-03-02 00:00:00' THEN 'train'
                 WHEN data_as_of < TIMESTAMP '2024-03-04 00:00:00' THEN 'val' ELSE 'test' END AS split FROM dense_gold)""")

# persistence predictions on gold: predicted = current class, actual = label
PERSIST = """pairs AS (SELECT CAST(future_congestion_15min AS DOUBLE) AS actual,
                       CAST(current_congestion AS DOUBLE) AS predicted FROM gold)"""

CM = """classes AS (SELECT * FROM (VALUES (0.0::DOUBLE), (1.0::DOUBLE), (2.0::DOUBLE)) t(c)),
cm AS (SELECT a.c AS actual, p.c AS predicted,
              (SELECT count(*) FROM pairs x WHERE x.actual = a.c AND x.predicted = p.c) AS n
       FROM classes a CROSS JOIN classes p)"""

METRICS = """per_class AS (
  SELECT c AS class,
         CAST(sum(CASE WHEN actual = c AND predicted = c THEN 1 ELSE 0 END) AS BIGINT) AS tp,
         CAST(sum(CASE WHEN actual <> c AND predicted = c THEN 1 ELSE 0 END) AS BIGINT) AS fp,
         CAST(sum(CASE WHEN actual = c AND predicted <> c THEN 1 ELSE 0 END) AS BIGINT) AS fn
  FROM (SELECT * FROM (VALUES (0.0::DOUBLE), (1.0::DOUBLE), (2.0::DOUBLE)) t(c)) k LEFT JOIN pairs ON TRUE GROUP BY c),
prf AS (
  SELECT class, tp, fp, fn,
         CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
         CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall
  FROM per_class),
metrics AS (
  SELECT class, tp, fp, fn, precision, recall,
         CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
  FROM prf)"""
