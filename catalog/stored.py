"""Queries of sinks and streams: the test tables go through a writer or a stream and are read back.

Every step that production repeats is repeated here (a month done again, a batch retried, a message
published twice), so a row that is lost or doubled shows.  Files lie below the shared checkpoint folder
under names of their own.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlake import settings as S
from roadlake.functions import clean_quotes, parse_utc_ts
from roadlake.operators import filters as P
from roadlake.operators.asof import lag_features
from roadlake.operators.forest import with_predictions
from roadlake.operators.ml import assembler, indexers, save_model
from roadlake.operators.quality import artifact_check
from roadlake.plans.months import clean_months, land_months
from roadlake.plans.training import materialize, training_frame
from roadlake.session import checkpoint_dir
from roadlake.sources import readers as R
from roadlake.sources import writers as K
from roadlake.streaming import state as ST
from roadlake.streaming.collector import maybe_warmup, start_collector

from . import oracle as O
from . import tables as T
from .queries import DEAD_MIN, LOOKBACK_MIN, _forest, _serving_sql, _w, _window, query

#: Readings of one landed feed file; even, so that the two copies of a reading share a file.
FEED_FILE_ROWS = 10_000
#: Files of one micro-batch for each core that there is: a task's share of a batch stays the same on any cluster.
BATCH_FILES = 16
MESSAGES = "key string, value string, timestamp timestamp_ntz"
NOW_MS = int(dt.datetime.fromisoformat(T.NOW).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)

LOCAL = "((data_as_of AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York')"


def _place(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _batch_files(spark: SparkSession) -> int:
    return BATCH_FILES * spark.sparkContext.defaultParallelism


def _months(df: DataFrame, ts: str) -> list[tuple[int, int]]:
    return [(r["year"], r["month"]) for r in P.month_calendar_of(df, ts).collect()]  # one row per month


def _end(stream) -> None:
    """Wait for a bounded run; its error is the query's error."""
    stream.awaitTermination()
    if stream.exception() is not None:
        raise stream.exception()


# ---------------------------------------------------------------- sinks
@query("write_bronze_month", _w(O.READINGS) + """
SELECT event_id, link_id, CAST(speed AS VARCHAR) AS speed, data_as_of,
       CAST(year(data_as_of) AS INTEGER) AS year, CAST(month(data_as_of) AS INTEGER) AS month FROM readings""")
def q_write_bronze_month(spark, sf):
    """S5 + K1: every month is landed, the first one again; a second run finds the ledger full."""
    r = T.readings(spark, sf).select("event_id", "link_id", F.col("speed").cast("string").alias("speed"), "data_as_of")
    root, ledger, months = _place(spark, "bronze"), _place(spark, "ledger"), _months(r, "data_as_of")
    land_months(r, months, root, ledger)
    land_months(r, months, root, ledger, redo=months[:1])
    return R.scan_table(spark, root).select("event_id", "link_id", "speed", "data_as_of", "year", "month")


@query("write_silver", _w(*O.BASE_SILVER) + "SELECT * FROM silver")
def q_write_silver(spark, sf):
    """K1 -> Q4 -> K3: bronze month by month, silver by source month, the first month again; equal to silver at once."""
    raw = T.bronze(spark, sf).withColumn("_utc", parse_utc_ts("data_as_of"))
    bronze, silver = _place(spark, "bronze"), _place(spark, "silver")
    months = _months(raw, "_utc")
    # rows whose time does not parse belong to no month; silver has none of them
    land_months(raw, months, bronze, f"{bronze}-ledger", ts="_utc")
    for redo in ((), months[:1]):
        clean_months(spark, bronze, months, T.active(spark, sf), T.holidays(spark), silver, f"{silver}-ledger", redo=redo)
    return R.scan_table(spark, silver).drop("source_month")


@query("write_bronze_realtime", _w(O.READINGS) + f"""
SELECT event_id, link_id, speed, CAST({LOCAL} AS DATE) AS date, CAST(hour({LOCAL}) AS INTEGER) AS hour, event_id % 2 AS batch_id FROM readings""")
def q_write_bronze_realtime(spark, sf):
    """K2: two batches; the first was cut off half-way and is retried, the second is retried after it had ended."""
    rows = T.readings(spark, sf).select("event_id", "link_id", "speed", "data_as_of", F.col("data_as_of").alias("ingest_ts"))
    rows = rows.repartitionByRange("ingest_ts")  # a task writes hours of its own
    root = _place(spark, "bronze-rt")
    first, second = rows.where("event_id % 2 = 0"), rows.where("event_id % 2 = 1")
    for batch, number in ((first.where("event_id % 4 = 0"), 0), (first, 0), (second, 1), (second, 1)):
        K.write_bronze_realtime(batch, root, "run", number, keys=("event_id",))
    return R.scan_table(spark, root).select("event_id", "link_id", "speed", "date", "hour", "batch_id")


@query("write_gold", _w(*O.DENSE_GOLD) + f"SELECT {', '.join(S.GOLD_COLUMNS)} FROM dense_gold")
def q_write_gold(spark, sf):
    """K4: the table twice as a whole, then its newest month again on its own."""
    gold, root = T.dense_gold(spark, sf), _place(spark, "gold")
    for _ in range(2):
        K.write_gold(gold, root)
    year, month = gold.agg(F.max(F.struct("year", "month")).alias("m")).select("m.*").first()
    K.replace_gold_months(P.filter_partition(gold, year, month), root)
    return R.scan_table(spark, root).select(*S.GOLD_COLUMNS)


@query("write_lookup", _w(*O.BASE_LOOKUP) + "SELECT link_id, free_flow_speed, borough, link_name, 1 AS files FROM lookup")
def q_write_lookup(spark, sf):
    """K5 + K6: the dimension is overwritten, then several files of it are made one."""
    lookup, place, parts = T.lookup(spark, sf), _place(spark, "lookup"), _place(spark, "lookup-parts")
    K.write_lookup(lookup.limit(0), place)
    K.write_lookup(lookup, place)
    R.scan_parquet(spark, place).repartition(4, "link_id").write.parquet(parts)
    compacted = _place(spark, "lookup-one")
    if not K.compact_artifact(spark, parts, compacted) or K.compact_artifact(spark, _empty(spark, lookup), compacted):
        raise AssertionError("an empty artifact replaces nothing, another one is compacted")
    rows = R.scan_parquet(spark, compacted)
    files = rows.select(F.col("_metadata.file_path").alias("f")).agg(F.count_distinct("f").cast("int").alias("files"))
    return rows.select("link_id", "free_flow_speed", "borough", "link_name").crossJoin(F.broadcast(files))  # one row


def _empty(spark, df: DataFrame) -> str:
    place = _place(spark, "empty")
    df.limit(0).write.parquet(place)
    return place


@query("write_snapshots", _w(*O.BASE_SNAP) + f"""
SELECT link_id, data_as_of, current_congestion, speed_ratio, link_name FROM snapshots
WHERE data_as_of >= TIMESTAMP '{T.NOW}' - INTERVAL {int(LOOKBACK_MIN)} MINUTE""")
def q_write_snapshots(spark, sf):
    """K7 -> S6: every batch of the topic is published twice and read once, from the lookback on."""
    return _topic_rows(spark, _publish(spark, T.snapshots(spark, sf)))


def _publish(spark, snapshots: DataFrame) -> str:
    topic = _place(spark, "topic")
    for batch in (0, 1, 1, 0):
        K.write_snapshots(snapshots.where(F.col("event_id") % 2 == batch), fmt="parquet", path=topic, timestamp_col="data_as_of", run_id="run", batch_id=batch)
    return topic


def _topic_rows(spark, topic: str) -> DataFrame:
    rows = R.scan_snapshots_bounded(spark, NOW_MS, LOOKBACK_MIN, fmt="parquet", path=topic)
    return rows.select("link_id", "data_as_of", "current_congestion", "speed_ratio", "link_name")


@query("materialize", _w(*O.DENSE_GOLD) + """
SELECT link_id, data_as_of, CAST(hour AS DOUBLE) AS hour, speed_ratio, CAST(future_congestion_15min AS DOUBLE) AS label FROM dense_gold""")
def q_materialize(spark, sf):
    """K9: the training frame cut off twice, as a written table and as a checkpoint of that."""
    frame = materialize(materialize(training_frame(T.dense_gold(spark, sf)), _place(spark, "frame")))
    return frame.select("link_id", "data_as_of", "hour", "speed_ratio", F.col(S.LABEL_COL).alias("label"))


@query("partition_exists", _w(*O.DENSE_GOLD) + """
SELECT m.month, EXISTS (SELECT 1 FROM dense_gold g WHERE g.month = m.month) AS there FROM range(0, 13) m(month)""")
def q_partition_exists(spark, sf):
    """S9 for each month of the year in the written gold table; month 0 stands for a table that is not there."""
    root = _place(spark, "gold")
    K.write_gold(T.dense_gold(spark, sf), root)
    found = [(0, R.partition_exists(spark, f"{root}-missing"))]
    found += [(m, R.partition_exists(spark, root, month=m)) for m in range(1, 13)]
    return spark.createDataFrame(found, "month long, there boolean")


@query("artifact_check", _w(*O.BASE_LOOKUP) + """
SELECT 'lookup' AS artifact, TRUE AS exists, (SELECT count(*) FROM lookup) AS rows, CAST(125 AS BIGINT) AS expected_rows, '' AS missing_columns,
       (SELECT count(*) FROM lookup) = 125 AS ok
UNION ALL SELECT 'silver', TRUE, (SELECT count(*) FROM silver), NULL, 'lat,lon', FALSE
UNION ALL SELECT 'silver plain', TRUE, (SELECT count(*) FROM silver), NULL, '', TRUE
UNION ALL SELECT 'absent', FALSE, NULL, NULL, 'link_id', FALSE""")
def q_artifact_check(spark, sf):
    """Q1 over written artifacts: an expected count, missing columns, nothing to complain of, no table at all."""
    lookup, silver = _place(spark, "lookup"), _place(spark, "silver")
    K.write_lookup(T.lookup(spark, sf), lookup)
    T.silver(spark, sf).write.parquet(silver)
    report = artifact_check(spark, [
        {"name": "lookup", "path": lookup, "expected_rows": S.EXPECTED_COORDINATE_ROWS, "columns": ["link_id", "free_flow_speed"]},
        {"name": "silver", "path": silver, "columns": ["link_id", "lat", "lon"]},
        {"name": "silver plain", "path": silver, "columns": ["link_id", "speed"]},
        {"name": "absent", "path": f"{silver}-absent", "columns": ["link_id"]}])
    return report.withColumn("missing_columns", F.array_join("missing_columns", ","))


# ---------------------------------------------------------------- model frames
@query("assemble_features", _w(*O.DENSE_GOLD, """idx AS (
  SELECT link_id, CAST(row_number() OVER (ORDER BY count(*) DESC, link_id) - 1 AS DOUBLE) AS i FROM dense_split WHERE split = 'train' GROUP BY link_id)""",
  "unseen AS (SELECT CAST(count(*) AS DOUBLE) AS i FROM idx)") + """
SELECT g.link_id, g.data_as_of, 19 AS size, coalesce(idx.i, (SELECT i FROM unseen)) AS link_idx,
       g.speed_ratio AS ratio, g.speed_ratio_trend AS trend, CAST(g.hour AS DOUBLE) AS hour
FROM dense_gold g LEFT JOIN idx ON idx.link_id = g.link_id""")
def q_assemble_features(spark, sf):
    """M1 + M2: indexers fitted on the train split, every row's feature vector read back by place."""
    frame = P.time_split(training_frame(T.dense_gold(spark, sf)), T.DENSE_SPLITS)
    model = Pipeline(stages=[*indexers(), assembler()]).fit(frame.filter(F.col("split") == "train"))
    v = vector_to_array("features")
    at = lambda c: F.element_at("v", len(S.CATEGORICAL_FEATURES) + S.NUMERIC_FEATURES.index(c) + 1)
    rows = model.transform(frame).select("link_id", "data_as_of", v.alias("v"))
    return rows.select("link_id", "data_as_of", F.size("v").alias("size"), F.element_at("v", 1).alias("link_idx"),
                       at("speed_ratio").alias("ratio"), at("speed_ratio_trend").alias("trend"), at("hour").alias("hour"))


@query("save_model", _w(*O.DENSE_GOLD) + """
SELECT split, count(*) AS rows, CAST(0 AS BIGINT) AS different FROM dense_split GROUP BY split""")
def q_save_model(spark, sf):
    """M3 M4 M8: the fitted model and the one read back from its folder predict alike, with the same probabilities."""
    frame, model = _forest(spark, sf)
    again = save_model(model, _place(spark, "model"))
    both = with_predictions(frame, first=model, second=again)
    return both.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("first") != F.col("second")).alias("different"))


# ---------------------------------------------------------------- feed and streams
def _land_feed(spark, sf) -> str:
    """Feed files of all readings: a header line and quoted values; every reading comes twice, one after the other.

    Files are in order of time from file to file, not by the times at which their tasks end.
    """
    second = F.date_trunc("second", "ts")
    rows = T.table(spark, sf, "events").withColumn("_s", second).withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1))))
    ordered = rows.repartitionByRange("_s").sortWithinPartitions("_s", "user_id", "event_id", "_copy")
    feed = T.feed_rows(ordered)
    cols = [clean_quotes(c).alias(n) for n, c in R.FEED_COLUMNS.items()]
    folder = _place(spark, "feed")
    (feed.select(F.lit("1").alias("Id"), *cols).write.option("sep", "\t").option("header", True).option("quoteAll", True)
     .option("maxRecordsPerFile", FEED_FILE_ROWS).csv(folder))
    return folder


FEED_ROWS = """fed AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS link_id, 'link-' || CAST(user_id AS VARCHAR) AS link_name, value AS speed,
         date_trunc('second', ts) AS data_as_of FROM events)"""


@query("scan_feed_tsv", _w(FEED_ROWS) + """
SELECT link_id, link_name, speed, data_as_of, count(*) * 2 AS copies FROM fed GROUP BY ALL""")
def q_scan_feed_tsv(spark, sf):
    """S3: landed feed files, columns picked by each file's header; a reading's copies are counted."""
    feed = R.parse_feed(R.scan_feed_tsv(spark, _land_feed(spark, sf)))
    return feed.groupBy("link_id", "link_name", "speed", "data_as_of").agg(F.count(F.lit(1)).alias("copies"))


@query("collect_stream", _w(FEED_ROWS, *O.BASE_LOOKUP, f"""valid AS (
  SELECT f.link_id, f.data_as_of, arg_min(f.speed, f.event_id) AS speed, min(l.free_flow_speed) AS ff FROM fed f JOIN lookup l ON l.link_id = f.link_id
  WHERE f.speed > 0 AND f.speed < 100 AND l.free_flow_speed > 0 AND f.link_id IN (SELECT link_id FROM active)
    AND f.data_as_of >= TIMESTAMP '{T.NOW}' - INTERVAL {int(DEAD_MIN)} MINUTE GROUP BY ALL)""") + """
SELECT 'bronze' AS sink, link_id, data_as_of, speed AS value FROM valid
UNION ALL SELECT 'topic', link_id, data_as_of, speed / ff FROM valid""")
def q_collect_stream(spark, sf):
    """Feed files -> rules -> changed readings -> topic and bronze; a second run of the same stream adds nothing."""
    feed, bronze, topic, ck = _land_feed(spark, sf), _place(spark, "bronze-rt"), _place(spark, "topic"), _place(spark, "stream")
    for _ in range(2):
        stream = R.scan_feed_tsv(spark, feed, streaming=True, max_files=_batch_files(spark))
        _end(start_collector(stream, T.active(spark, sf), T.lookup(spark, sf), bronze, ck, topic_fmt="parquet", topic_path=topic,
                             trigger={"availableNow": True}, now=T.NOW, dead_minutes=DEAD_MIN, late_minutes=DEAD_MIN, ttl_minutes=DEAD_MIN))
    told = R.published_once(R.decode_snapshot_messages(spark.read.schema(MESSAGES).parquet(topic)))
    kept = R.scan_table(spark, bronze)
    return (kept.select(F.lit("bronze").alias("sink"), "link_id", "data_as_of", F.col("speed").alias("value"))
            .unionByName(told.select(F.lit("topic").alias("sink"), "link_id", "data_as_of", F.col("speed_ratio").alias("value"))))


@query("late_data", _w(*O.BASE_SNAP) + f"""
SELECT DISTINCT link_id, data_as_of FROM snapshots
WHERE data_as_of > (SELECT date_trunc('milliseconds', max(data_as_of)) FROM snapshots) - INTERVAL {int(DEAD_MIN)} MINUTE""")
def q_late_data(spark, sf):
    """T3 + T9: the last 48 hours come first, then the whole table; what the watermark has passed is dropped."""
    snap = T.snapshots(spark, sf)
    rows = snap.withColumns({"free_flow_speed": F.col("speed") / F.col("speed_ratio"), "ingest_ts": F.col("data_as_of"),
                             "feed_file": F.lit("f"), "feed_row": F.col("event_id")}).select(*ST.OUT_COLS)
    folder, out, ck = _place(spark, "valid"), _place(spark, "changed"), _place(spark, "stream")
    for part in (P.filter_dead_links(rows, T.NOW, 48 * 60), rows):
        part.write.mode("append").option("maxRecordsPerFile", FEED_FILE_ROWS).parquet(folder)
        valid = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", _batch_files(spark)).parquet(folder)
        changed = ST.change_stream(valid, ttl_minutes=DEAD_MIN, late_minutes=DEAD_MIN)
        with ST.with_state_store(spark):
            _end(changed.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start())
    return spark.read.parquet(out).select("link_id", "data_as_of").distinct()


@query("warmup_replay", _w(*O.BASE_SNAP) + f"""
SELECT link_id, data_as_of, current_congestion, speed_ratio, link_name FROM snapshots
WHERE data_as_of >= TIMESTAMP '{T.NOW}' - INTERVAL {int(LOOKBACK_MIN)} MINUTE""")
def q_warmup_replay(spark, sf):
    """K2 -> S8 -> T6 -> K7 -> S6: the topic is empty, so the stored readings of the lookback are scored again and published."""
    valid = P.filter_valid_speed(T.readings(spark, sf)).repartitionByRange("data_as_of")
    bronze, topic = _place(spark, "bronze-rt"), _place(spark, "topic")
    K.write_bronze_realtime(valid.withColumn("ingest_ts", F.col("data_as_of")), bronze, "run", 0, keys=("event_id",))
    maybe_warmup(spark, T.snapshots(spark, sf).limit(0), bronze, T.lookup(spark, sf), T.NOW, topic_fmt="parquet", topic_path=topic,
                 lookback_minutes=LOOKBACK_MIN)
    return _topic_rows(spark, topic)


@query("lookback_stream", _serving_sql())
def q_lookback_stream(spark, sf):
    """T7 + T8 in the stream: from the topic, published twice, to each link's lags in its ring; the last of them are the serving features."""
    topic, out, ck = _publish(spark, _window(spark, sf)), _place(spark, "lags"), _place(spark, "stream")
    msgs = spark.readStream.schema(MESSAGES).option("maxFilesPerTrigger", _batch_files(spark)).parquet(topic)
    ring = ST.lookback_stream(R.snapshot_stream(msgs, LOOKBACK_MIN), T.SERVING_PARAMS)

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")  # a retried batch replaces itself

    with ST.with_state_store(spark):
        _end(ring.writeStream.foreachBatch(keep).option("checkpointLocation", ck).trigger(availableNow=True).start())
    rows = spark.read.parquet(out)
    last = rows.groupBy("link_id").agg(F.max_by(F.struct(*(c for c in rows.columns if c not in ("link_id", "batch"))), "batch").alias("r")).select("link_id", "r.*")
    return lag_features(last, T.lookup(spark, sf), T.holidays(spark), params=T.SERVING_PARAMS)
