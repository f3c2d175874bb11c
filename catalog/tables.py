"""Mapping of the driver's test tables onto the road-speed domain.

``events`` stands for speed readings: link = user, borough = event type,
speed = value, reading time = ts (UTC wall time), arrival order = event_id.
Events of one user lie hours apart, so every minute constant is multiplied by
``SCALE`` (150) when run on these tables; the operators themselves are unscaled.

``bronze`` re-creates the raw text form (speed and time as text, a point list)
plus deliberately malformed copies of some rows, so the cleaning rules have work and
no event is lost.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadlake import settings as S
from roadlake.functions.timefn import calendar_features, utc_to_local
from roadlake.operators.filters import active_links, filter_valid_speed
from roadlake.operators.joins import lookup_inner
from roadlake.plans import gold as G
from roadlake.plans import silver as SV
from roadlake.session import checkpoint_dir

SCALE = S.TimeScale(150.0)
NOW = "2024-01-31 00:00:00"
HOLIDAYS = ("2024-01-01", "2024-01-15")
SPLITS = {
    "train": "data_as_of < TIMESTAMP_NTZ'2024-01-21 00:00:00'",
    "val": "data_as_of < TIMESTAMP_NTZ'2024-01-26 00:00:00'",
    "test": "data_as_of >= TIMESTAMP_NTZ'2024-01-26 00:00:00'",
}
GOLD_PARAMS = S.GoldParams(scale=SCALE)
SERVING_PARAMS = S.ServingParams(scale=SCALE)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed readings: link_id, borough, link_name, data_as_of (UTC), speed, event_id."""
    e = table(spark, sf_dir, "events")
    uid = F.col("user_id").cast("string")
    return e.select(uid.alias("link_id"), F.col("event_type").alias("borough"),
                    F.concat(F.lit("link-"), uid).alias("link_name"),
                    F.col("ts").alias("data_as_of"), F.col("value").alias("speed"), "event_id")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text rows like the landed history (speed/time as text, point list).

    Every event is a well-formed row; one in 89 comes a second time with a bad speed, one in
    97 with a bad time.
    """
    bad = F.array(F.lit(0), F.when(F.col("event_id") % 89 == 0, F.lit(1)), F.when(F.col("event_id") % 97 == 0, F.lit(2)))
    e = table(spark, sf_dir, "events").withColumn("bad", F.explode(F.array_compact(bad)))
    uid = F.col("user_id").cast("string")
    k = F.get_json_object("props", "$.k").try_cast("int")
    pts = (F.when(k % 10 == 0, F.lit(None).cast("string"))
           .when(k % 10 == 1, F.lit(""))
           .when(k % 10 == 2, F.lit("no points"))
           .when(k % 10 == 3, F.lit("40.5"))
           .when(k % 10 == 4, F.lit("40.5,-73.9,7 40.6,-73.8"))
           .otherwise(F.concat(F.lit("40."), F.lpad(k.cast("string"), 2, "0"), F.lit(",-73."),
                               F.lpad((F.col("user_id") % 100).cast("string"), 2, "0"),
                               F.lit(" 40.80,-73.90"))))
    speed = F.when(F.col("bad") == 1, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    ts = (F.when(F.col("bad") == 2, F.lit("not a time"))
          .otherwise(F.date_format("ts", S.BRONZE_TS_FORMAT)))
    return e.select(uid.alias("link_id"), F.col("event_type").alias("borough"),
                    F.concat(F.lit("link-"), uid).alias("link_name"),
                    speed.alias("speed"), ts.alias("data_as_of"), pts.alias("link_points"))


def _listing(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the tables' files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    tables = list(fs.listStatus(path))
    files = [s for t in tables if t.isDirectory() for s in fs.listStatus(t.getPath())] + [t for t in tables if not t.isDirectory()]
    return tuple(sorted((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in files))


def kept(spark: SparkSession, sf_dir: str, name: str, make) -> DataFrame:
    """A dimension or stage that production keeps as a table: written once per session and
    table folder, below the shared checkpoint folder, and read from there afterwards."""
    tables = spark.__dict__.setdefault("_roadlake_kept", {})
    key = (sf_dir, _listing(spark, sf_dir), name)  # another input, or other files in the folder, make it anew
    if key not in tables:
        path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
        made = make()
        made.write.parquet(path)
        tables[key] = (path, made.schema)
    path, schema = tables[key]
    return spark.read.schema(schema).parquet(path)


def active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active-link list by the P7 rule: links with a reading in the 48 hours before ``NOW``."""
    return kept(spark, sf_dir, "active", lambda: active_links(readings(spark, sf_dir), NOW, ordered=False))


def holidays(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{d}')" for d in HOLIDAYS)
    return spark.sql(f"SELECT holiday_date FROM VALUES {rows} AS t(holiday_date)")


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver transform itself."""
    return SV.silver_clean(bronze(spark, sf_dir), active(spark, sf_dir), holidays(spark))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored silver table."""
    return kept(spark, sf_dir, "silver", lambda: clean(spark, sf_dir))


def build_lookup(spark: SparkSession, sf_dir: str, method: str = "exact", accuracy: int = 10_000) -> DataFrame:
    """The free-flow lookup of the training split, from stored silver."""
    return G.build_lookup(silver(spark, sf_dir), SPLITS, method=method, accuracy=accuracy)


def lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored lookup."""
    return kept(spark, sf_dir, "lookup", lambda: build_lookup(spark, sf_dir))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.build_gold(silver(spark, sf_dir), lookup(spark, sf_dir), GOLD_PARAMS)


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the collector would publish: valid readings of links in the lookup,
    with ratio and class (data_as_of = UTC instant, event_id = arrival order)."""
    snap = lookup_inner(filter_valid_speed(readings(spark, sf_dir)), lookup(spark, sf_dir), fallback=False)
    return snap.select("link_id", "data_as_of", "current_congestion", "speed_ratio",
                       "link_name", "borough", "speed", "event_id")


def feed_rows(events: DataFrame, zone: str = S.LOCAL_ZONE) -> DataFrame:
    """Feed rows as ``scan_feed_tsv`` gives them (quoted text, local ``MM/dd/yyyy HH:mm:ss``
    times), so that the feed parser can run over the whole test table."""
    uid = F.col("user_id").cast("string")
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    local = F.date_format(utc_to_local("ts", zone), S.FEED_TS_FORMAT)
    return events.select(q(uid).alias("raw_link"), q(F.col("value").cast("string")).alias("raw_speed"),
                         q(local).alias("raw_time"), q(F.concat(F.lit("link-"), uid)).alias("raw_name"),
                         "event_id", "ts")


# --- a dense series: lineitem as five-minute readings, at the operators' own minute scale ---

DENSE_STEP_S = 300
#: Readings that are late by this many days leave gaps where they would have been.
DENSE_LATE_DAYS = 3650
DENSE_SPLITS = {
    "train": "data_as_of < TIMESTAMP_NTZ'2024-03-02 00:00:00'",
    "val": "data_as_of < TIMESTAMP_NTZ'2024-03-04 00:00:00'",
    "test": "data_as_of >= TIMESTAMP_NTZ'2024-03-04 00:00:00'",
}


def numbered(ordered: DataFrame) -> DataFrame:
    """Rows of an ordered frame with their place: the parts' counts, then the place inside the part."""
    marked = ordered.select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_id"))
    path = f"{checkpoint_dir(ordered.sparkSession)}/ordered-{uuid.uuid4().hex}"
    marked.write.parquet(path)  # the order is fixed once
    rows = ordered.sparkSession.read.parquet(path)
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per part
    counts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(F.broadcast(counts), "_part").withColumn("place", F.col("_before") + inside)


def dense_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rows from ``lineitem``: link = supplier modulo 20, the n-th line of a link is its
    reading of the n-th five minutes from 2024-03-01 05:00 UTC; every 97th reading
    (by order key) comes ten years late, which leaves gaps; speed = quantity."""
    order = ["l_orderkey", "l_linenumber", "l_extendedprice"]
    li = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 20).alias("link"), *order, F.col("l_quantity").alias("speed"))
    placed = numbered(li.repartitionByRange("link", *order).sortWithinPartitions("link", *order).select("link", "l_orderkey", "speed"))
    first = placed.groupBy("link").agg(F.min("place").alias("first"))  # one row per link
    rows = placed.join(F.broadcast(first), "link").select(F.col("link").cast("string").alias("link_id"), (F.col("place") - F.col("first")).alias("nth"), "l_orderkey", "speed")
    late = F.when(F.col("l_orderkey") % 97 == 0, F.lit(DENSE_LATE_DAYS * 86_400)).otherwise(F.lit(0))
    utc = F.timestamp_add("SECOND", F.col("nth") * DENSE_STEP_S + late, F.lit("2024-03-01 05:00:00").cast("timestamp_ntz"))
    rows = rows.withColumn("data_as_of_utc", utc).withColumn("data_as_of", utc_to_local("data_as_of_utc"))
    rows = rows.select("*", *calendar_features("data_as_of"))
    return rows.select("link_id", F.lit("b").alias("borough"), F.concat(F.lit("link-"), "link_id").alias("link_name"),
                       "data_as_of", "speed", "hour", "day_of_week", "month", "is_weekend",
                       F.lit(0).alias("is_holiday"), "data_as_of_utc", F.year("data_as_of").cast("int").alias("year"))


def dense_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold table of the dense series, every constant unscaled."""
    s = kept(spark, sf_dir, "dense-silver", lambda: dense_silver(spark, sf_dir))
    lk = kept(spark, sf_dir, "dense-lookup", lambda: G.build_lookup(s, DENSE_SPLITS))
    return kept(spark, sf_dir, "dense-gold", lambda: G.build_gold(s, lk))
