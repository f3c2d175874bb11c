"""The collector (T1-T6, T9, K2, K7): feed -> rules -> change detection -> topic + bronze.

Batch and streaming share the same rule expressions; the streaming job adds
keyed state for change detection (``state.py``) and a dual sink per micro-batch.
"""

from __future__ import annotations

import json
import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import settings as S
from ..functions.timefn import plus_minutes
from ..operators.filters import _lit_ts
from .state import change_stream, with_state_store

LOG = logging.getLogger(__name__)


def verdict(active_match: Column, ts: Column, speed: Column, now,
            dead_minutes: float = S.DEAD_LINK_MINUTES) -> Column:
    """Ordered row rules -> rule name.

    0 inactive link, 1 dead link (older than ``now - dead``), 2 faulty sensor
    (speed missing or outside (0, 100)), 3 valid.
    """
    cutoff = plus_minutes(_lit_ts(now), -dead_minutes)
    return (F.when(active_match.isNull(), F.lit("inactive"))
            .when(ts.isNull() | (ts < cutoff), F.lit("dead"))
            .when(speed.isNull() | (speed <= S.SPEED_MIN_EXCLUSIVE) | (speed >= S.SPEED_MAX_EXCLUSIVE),
                  F.lit("faulty_sensor"))
            .otherwise(F.lit("valid")))


def case_cascade(rows: DataFrame, active: DataFrame, now, dead_minutes: float = S.DEAD_LINK_MINUTES,
                 key: str = "link_id", ts: str = "data_as_of", speed: str = "speed") -> DataFrame:
    """T2 + T9: add a ``verdict`` column (left join against the active list)."""
    a = active.select(F.col(active.columns[0]).cast("string").alias(key)).distinct() \
        .withColumn("_active", F.lit(True))
    out = rows.join(a, on=key, how="left")  # Spark broadcasts the stored list if its bytes allow
    return out.withColumn("verdict", verdict(F.col("_active"), F.col(ts), F.col(speed), now, dead_minutes)) \
        .drop("_active")


# --------------------------------------------------------------------------- streaming job

def now_utc() -> Column:
    """Processing time as a UTC wall-clock NTZ value (zone free)."""
    from ..functions.timefn import epoch_ntz
    return F.timestamp_add("MICROSECOND", F.unix_micros(F.current_timestamp()), epoch_ntz())


VERDICTS = ("inactive", "dead", "faulty_sensor", "valid")
OBSERVED = "collector"


def judged_feed(feed: DataFrame, active: DataFrame, lookup: DataFrame, now=None,
                dead_minutes: float = S.DEAD_LINK_MINUTES) -> DataFrame:
    """T1 row path before state: parse -> verdict (T2) -> valid only (T9: dead rows
    dropped) -> lookup inner join (J5, stream-static) -> ratio and class.

    ``now`` defaults to processing time.  Rows carry their arrival order: the feed file's
    time, the file and the line.  How many rows got which verdict, and how many of the
    valid ones the lookup knows, is observed as ``collector`` and ``collector_matched``.
    """
    from ..operators.joins import lookup_inner
    from ..sources.readers import parse_feed
    rows = parse_feed(feed).withColumn("ingest_ts", F.col("feed_ts"))
    now_c = now if now is not None else now_utc()
    judged = case_cascade(rows, active, now_c, dead_minutes)
    judged = judged.observe(OBSERVED, *(F.count_if(F.col("verdict") == v).alias(v) for v in VERDICTS))
    valid = judged.filter(F.col("verdict") == "valid")
    return lookup_inner(valid, lookup, fallback=False).observe(f"{OBSERVED}_matched", F.count(F.lit(1)).alias("matched"))


def run_id_of(spark, checkpoint: str) -> str:
    """The id that Spark gives a stream with its checkpoint: the same after a restart, new with a new checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def dual_sink(bronze_root: str, checkpoint: str, topic_fmt: str = "kafka", topic_options: dict | None = None,
              topic_path: str | None = None, on_bronze_error=None, dead_letters: str | None = None):
    """T5: one micro-batch -> topic (K7), then bronze (K2).  The batch is persisted so
    both writes read it once.  A batch that is retried is published again with the same
    message ids, so readers take it once.  A failing bronze write is tried once more; if that fails
    too the rows go to ``dead_letters`` (default: beside bronze) under run and batch, the
    failure is logged and handed to ``on_bronze_error(batch_id, error)``, and the topic
    keeps flowing.  Bronze rows are written once per run and batch."""
    from ..sources.writers import write_bronze_realtime, write_snapshots
    dead = dead_letters or f"{bronze_root.rstrip('/')}-dead-letters"

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        run = run_id_of(batch.sparkSession, checkpoint)
        try:
            if batch.isEmpty():  # nothing has changed, or the watermark alone has moved
                return
            write_snapshots(batch, fmt=topic_fmt, options=topic_options, path=topic_path,
                            timestamp_col=None if topic_fmt == "kafka" else "ingest_ts", run_id=run, batch_id=batch_id)
            rows = batch.select("link_id", "speed", "data_as_of", "borough", "link_name", "ingest_ts")
            for attempt in (1, 2):
                try:
                    write_bronze_realtime(rows, bronze_root, run, batch_id)
                    break
                except Exception as e:  # noqa: BLE001 - the topic must not stop on a bronze failure
                    LOG.warning("bronze write of batch %s failed, attempt %s: %s", batch_id, attempt, e)
                    if attempt == 2:
                        try:
                            rows.write.mode("overwrite").parquet(f"{dead}/run_id={run}/batch_id={batch_id}")
                        except Exception as again:  # noqa: BLE001
                            LOG.error("rows of batch %s are neither in bronze nor in %s: %s", batch_id, dead, again)
                        if on_bronze_error:
                            on_bronze_error(batch_id, e)
        finally:
            batch.unpersist()

    return sink


def recover_dead_letters(spark, dead: str, bronze_root: str) -> int:
    """Write the batches of a dead-letter folder to bronze, each once per run and batch; returns how many had rows to add."""
    from ..sources.writers import write_bronze_realtime
    letters = spark.read.parquet(dead)
    added = 0
    for r in letters.select("run_id", "batch_id").distinct().collect():  # one row per failed batch
        own = letters.where((F.col("run_id") == r["run_id"]) & (F.col("batch_id") == r["batch_id"])).drop("run_id", "batch_id")
        added += write_bronze_realtime(own, bronze_root, r["run_id"], r["batch_id"])
    return added


def start_collector(feed_stream: DataFrame, active: DataFrame, lookup: DataFrame, bronze_root: str,
                    checkpoint: str, topic_fmt: str = "kafka", topic_options: dict | None = None,
                    topic_path: str | None = None, trigger: dict | None = None, on_bronze_error=None,
                    initial: DataFrame | None = None, late_minutes: float = S.DEAD_LINK_MINUTES,
                    ttl_minutes: float = S.DEAD_LINK_MINUTES, dead_letters: str | None = None,
                    now=None, dead_minutes: float = S.DEAD_LINK_MINUTES):
    """The whole collector as one streaming query (default trigger: every minute).

    ``feed_stream`` comes from ``scan_feed_tsv``; its ``max_files`` bounds what one
    micro-batch, and so one link's rows in it, can hold.  ``initial`` (``link_id``, ``data_as_of``) is the
    warm-up replay: a first start emits none of its newest readings again.  Readings
    ``late_minutes`` older than the newest one seen are dropped by the watermark, besides those that
    the ``dead`` verdict drops by the clock; a link that is silent for ``ttl_minutes`` is forgotten.
    ``now`` pins that clock (replays, tests).
    """
    valid = judged_feed(feed_stream, active, lookup, now, dead_minutes)
    changed = change_stream(valid, ttl_minutes, late_minutes, initial)
    sink = dual_sink(bronze_root, checkpoint, topic_fmt, topic_options, topic_path, on_bronze_error, dead_letters)
    w = changed.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).outputMode("append")
    with with_state_store(feed_stream.sparkSession):
        return w.trigger(**(trigger or {"processingTime": "1 minute"})).start()


# --------------------------------------------------------------------------- warm-up

def needs_warmup(recent_snapshots: DataFrame, min_links: int = S.WARMUP_MIN_LINKS) -> bool:
    """G23 gate: fewer than ``min_links`` distinct links in the lookback."""
    from ..operators.aggregates import snapshot_readiness
    return not snapshot_readiness(recent_snapshots, min_links=min_links).head()["ready"]


def warmup_snapshots(bronze_rt: DataFrame, lookup: DataFrame, now,
                     lookback_minutes: float = S.LOOKBACK_MINUTES) -> DataFrame:
    """Re-score the realtime bronze rows of every partition overlapping the lookback
    (S8 + J5 + F7/F8); the caller publishes them with ``write_snapshots``."""
    from ..operators.joins import lookup_inner
    from ..sources.readers import recent_hours
    recent = recent_hours(bronze_rt, now, lookback_minutes)
    return lookup_inner(recent, lookup, fallback=False).select(
        "link_id", "data_as_of", "current_congestion", "speed_ratio", "link_name")


def maybe_warmup(spark, recent_snapshots: DataFrame, bronze_root: str, lookup: DataFrame, now,
                 topic_fmt: str = "kafka", topic_options: dict | None = None, topic_path: str | None = None,
                 min_links: int = S.WARMUP_MIN_LINKS, lookback_minutes: float = S.LOOKBACK_MINUTES) -> int:
    """T6, run once before the collector starts: when the topic's lookback holds fewer
    than ``min_links`` links and realtime bronze has data, re-score the recent bronze
    rows and publish them.  Returns the number of published snapshots (0 if skipped)."""
    from ..sources.readers import partition_exists
    from ..sources.writers import write_snapshots
    if not needs_warmup(recent_snapshots, min_links) or not partition_exists(spark, bronze_root):
        return 0
    replay = warmup_snapshots(spark.read.parquet(bronze_root), lookup, now, lookback_minutes)
    replay = replay.persist()
    try:
        n = replay.count()
        if n:
            write_snapshots(replay, fmt=topic_fmt, options=topic_options, path=topic_path,
                            timestamp_col=None if topic_fmt == "kafka" else "data_as_of")
        return n
    finally:
        replay.unpersist()
