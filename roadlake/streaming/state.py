"""Keyed streaming state (T3, T4, T6, T8, T9): change detection and the lookback ring.

Both are ``transformWithState`` processors in event time (``data_as_of``, UTC): rows older than the
watermark never reach them, and timers on the readings' own time end a link's state.  Both
take their state at the first start from a batch frame, such as the warm-up replay.
The session needs the RocksDB state store (``with_state_store``).  A micro-batch brings few rows per
link, so rows come as ``Row`` (a frame per link and batch costs more than its rows), and a processor asks the
store as seldom as it can: each call of it is a round trip.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from .. import settings as S

OUT_SCHEMA = ("link_id string, data_as_of timestamp_ntz, speed double, link_name string, "
              "borough string, free_flow_speed double, speed_ratio double, current_congestion int, "
              "ingest_ts timestamp_ntz, feed_file string, feed_row long")
OUT_COLS = [c.strip().split(" ")[0] for c in OUT_SCHEMA.split(",")]
EVENT_TIME = "event_ts"

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


PARTITIONS = "spark.sql.shuffle.partitions"
#: Changes alone are stored with a micro-batch, not a copy of the store.
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


class with_state_store:
    """While a query of this module starts, the session's state store is RocksDB; its own settings come back after.

    Every micro-batch opens, commits and gives a Python worker to each state partition, however few rows it
    holds: ``partitions`` is at most two for each core there is, if the session's number is not below that.  A
    checkpoint keeps the number it began with.
    """

    def __init__(self, spark: SparkSession, partitions: int | None = None):
        self.spark = spark
        most = 2 * spark.sparkContext.defaultParallelism
        self.own = {PROVIDER: ROCKSDB, CHANGELOG: "true", PARTITIONS: str(partitions or min(most, int(spark.conf.get(PARTITIONS))))}

    def __enter__(self) -> None:
        self.old = {k: self.spark.conf.get(k, None) for k in self.own}
        for k, v in self.own.items():
            self.spark.conf.set(k, v)

    def __exit__(self, *_: Any) -> None:
        for k, v in self.old.items():
            self.spark.conf.unset(k) if v is None else self.spark.conf.set(k, v)


def with_event_time(rows: DataFrame, late_minutes: float, ts: str = "data_as_of") -> DataFrame:
    """``event_ts`` with a watermark ``late_minutes`` behind the newest reading seen.

    ``data_as_of`` is UTC wall time; the event time is that instant whatever the session's zone.
    Rows that have it already keep it.
    """
    if EVENT_TIME in rows.columns:
        return rows
    instant = F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts)))
    return rows.withColumn(EVENT_TIME, instant).withWatermark(EVENT_TIME, f"{int(late_minutes * 60)} seconds")


EPOCH = dt.datetime(1970, 1, 1)
MICRO = dt.timedelta(microseconds=1)
#: Stands for the time of a row that has none; before all times.
NO_TIME = -(1 << 63)


def micros(time: dt.datetime | None) -> int:
    return NO_TIME if time is None else (time - EPOCH) // MICRO


class ChangeProcessor(StatefulProcessor):
    """Emits a link's reading when its time differs from the one emitted last; T4: forgets silent links.

    Rows of a micro-batch are taken in the order in which the feed brought them.  A timer
    stands at most ``ttl_minutes`` after the newest remembered reading and moves on when it is reached; once the
    watermark passes that time the state goes (nothing older can arrive any more, so output does not change).
    """

    def __init__(self, ttl_minutes: float):
        self.ttl_us = int(ttl_minutes * 60_000_000)

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "last_us long, newest_us long")

    def _remember(self, last: int, newest: int, old: tuple | None) -> None:
        if old is None:
            self.handle.registerTimer((newest + self.ttl_us) // 1000)
        if old is None or (old[0], old[1]) != (last, newest):
            self.last.update((last, newest))

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        # as the replay has published them: the newest reading is the last one emitted
        us = micros(initialState["data_as_of"])
        self._remember(us, us, self.last.get())

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        order = lambda r: tuple((r[c] is None, r[c] or blank) for c, blank in (("ingest_ts", EPOCH), ("feed_file", ""), ("feed_row", 0)))
        held = self.last.get()
        out, newest, last = [], held[1] if held else None, held[0] if held else None
        for row in sorted(rows, key=order):
            us = micros(row["data_as_of"])
            if last is None or us != last:
                out.append(Row(**{c: row[c] for c in OUT_COLS}))
            last, newest = us, us if newest is None else max(us, newest)
        if last is not None:
            self._remember(last, newest, held)
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        due = (self.last.get()[1] + self.ttl_us) // 1000
        if due > max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()):
            self.handle.registerTimer(due)
        else:
            self.last.clear()
        return iter([])

    def close(self) -> None:
        pass


def change_stream(valid: DataFrame, ttl_minutes: float = S.DEAD_LINK_MINUTES, late_minutes: float = S.DEAD_LINK_MINUTES,
                  initial: DataFrame | None = None) -> DataFrame:
    """T3 + T4 + T9: keyed emit-if-changed over micro-batches, in event time.

    ``initial`` (``link_id``, ``data_as_of``) is what has been emitted before the first start,
    for example the warm-up replay: its newest reading of each link is not emitted again.
    """
    rows = with_event_time(valid.select(*OUT_COLS), late_minutes)
    if initial is not None:
        initial = initial.select("link_id", "data_as_of").groupBy("link_id").agg(F.max("data_as_of").alias("data_as_of")).groupBy("link_id")
    return rows.groupBy("link_id").transformWithState(ChangeProcessor(ttl_minutes), OUT_SCHEMA, "append", "EventTime", initialState=initial)


# --------------------------------------------------------------------------- the lookback ring

SNAPSHOT = "link_id string, data_as_of timestamp_ntz, current_congestion int, speed_ratio double, link_name string"


def lag_schema(lags) -> str:
    return SNAPSHOT + "".join(f", lag_{m} struct<u: long, current_congestion: int, speed_ratio: double>" for m in lags)


class LookbackProcessor(StatefulProcessor):
    """T7 + J6 + J7 in the stream: each link's snapshots of the lookback, and the lags of its newest one.

    The ring is a map from the snapshot's time to its values (equal times: the first to arrive).  A
    micro-batch that adds a snapshot emits the newest one with its lags; a timer at the newest time plus the
    lookback clears links that have gone silent.  Memory per link is the lookback, whatever the
    length of the stream.  The timer moves on when it is reached, not with every snapshot.
    """

    def __init__(self, params: S.ServingParams):
        sc = params.scale
        self.back_us = sc.micros(params.lookback_minutes)
        self.lags = {m: (sc.micros(m), sc.micros(lo), sc.micros(hi), sc.micros(m + params.locf_max_minutes))
                     for m, (lo, hi) in params.lag_tolerance.items()}

    def init(self, handle) -> None:
        self.handle = handle
        self.ring = handle.getMapState("ring", "us long", "current_congestion int, speed_ratio double, link_name string")
        self.newest = handle.getValueState("newest", "us long")

    def _take(self, rows: Iterator[Row]) -> tuple[int, dict] | None:
        """Adds snapshots, drops what has left the lookback; the newest time and the ring, or None if nothing was added."""
        old = self.newest.get()
        held = {} if old is None else {k[0]: v for k, v in self.ring.iterator()}
        newest, new = None if old is None else old[0], {}
        for row in rows:
            us = micros(row["data_as_of"])
            newest = us if newest is None else max(newest, us)
            if us not in held and us not in new:
                new[us] = (int(row["current_congestion"]), float(row["speed_ratio"]), row["link_name"])
        if newest is None:
            return None
        new = {t: v for t, v in new.items() if t >= newest - self.back_us}
        for t, values in new.items():
            self.ring.updateValue((t,), values)
        for t in [t for t in held if t < newest - self.back_us]:
            self.ring.removeKey((t,))
            del held[t]
        if old is None:
            self.handle.registerTimer((newest + self.back_us) // 1000)
        if old is None or newest != old[0]:
            self.newest.update((newest,))
        return (newest, held | new) if new else None

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self._take(iter([initialState]))

    def _lag(self, times: list[int], at: int, near: int, far: int, carried: int) -> int | None:
        """The time nearest to ``at`` within the tolerance, the earlier one of two; else J7: the last one before, if not too old."""
        within = [t for t in times if far <= t <= near]
        if within:
            return min(within, key=lambda t: (abs(t - at), t))
        return max((t for t in times if carried <= t <= at), default=None)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        taken = self._take(rows)
        if taken is None:
            return iter([])
        newest, held = taken
        times = sorted(held)
        now = held[newest]
        row = {"link_id": key[0], "data_as_of": EPOCH + newest * MICRO, "current_congestion": now[0], "speed_ratio": now[1], "link_name": now[2]}
        for m, (at, lo, hi, carried) in self.lags.items():
            t = self._lag(times, newest - at, newest - lo, newest - hi, newest - carried)
            row[f"lag_{m}"] = None if t is None else Row(u=t, current_congestion=held[t][0], speed_ratio=held[t][1])
        return iter([Row(**row)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        due = (self.newest.get()[0] + self.back_us) // 1000
        if due > max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()):
            self.handle.registerTimer(due)
        else:
            self.ring.clear()
            self.newest.clear()
        return iter([])

    def close(self) -> None:
        pass


def lookback_stream(snapshots: DataFrame, params: S.ServingParams = S.ServingParams(), late_minutes: float = S.LOOKBACK_MINUTES,
                    initial: DataFrame | None = None) -> DataFrame:
    """T7 + T8: each link's newest snapshot with its lags, whenever a micro-batch adds a snapshot of the lookback.

    Columns are those of ``newest_with_lags`` on the link's lookback.  ``initial`` holds snapshots from
    before the first start (the topic's lookback or the warm-up replay).
    """
    cols = [c.strip().split(" ")[0] for c in SNAPSHOT.split(",")]
    kept = [EVENT_TIME] if EVENT_TIME in snapshots.columns else []
    rows = with_event_time(snapshots.select(*cols, *kept), late_minutes * params.scale.factor)
    state = None if initial is None else initial.select(*cols).groupBy("link_id")
    return rows.groupBy("link_id").transformWithState(LookbackProcessor(params), lag_schema(params.lag_tolerance), "append", "EventTime", initialState=state)
