"""Event-time state of the streams: watermark, eviction, warm start, lookback ring, messages published twice."""

import datetime as dt
import os

from pyspark.sql import functions as F

from roadlake import settings as S
from roadlake.operators.asof import newest_with_lags
from roadlake.sources import readers as R
from roadlake.sources import writers as K
from roadlake.streaming import state as ST

T0 = dt.datetime(2024, 3, 1, 12)
ROW = ("link_id string, data_as_of timestamp_ntz, speed double, link_name string, borough string, free_flow_speed double, "
       "speed_ratio double, current_congestion int, ingest_ts timestamp_ntz, feed_file string, feed_row long")


def minutes(m):
    return T0 + dt.timedelta(minutes=m)


class Stream:
    """A query over a folder to which micro-batches are added one by one."""

    def __init__(self, spark, scratch, schema, make):
        self.spark, self.schema, self.make = spark, schema, make
        self.folder, self.out, self.ckpt = (os.path.join(scratch, d) for d in ("in", "out", "ck"))
        os.makedirs(self.folder)

    def run(self, rows):
        """One micro-batch (and what its watermark sets off); the rows it gave."""
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.folder)
        got = []
        sink = lambda batch, n: got.extend(batch.collect())
        with ST.with_state_store(self.spark):
            q = (self.make(self.spark.readStream.schema(self.schema).parquet(self.folder)).writeStream.foreachBatch(sink)
                 .option("checkpointLocation", self.ckpt).trigger(availableNow=True).start())
        q.processAllAvailable()
        q.awaitTermination()
        assert q.exception() is None
        self.progress = [p for p in q.recentProgress if p.stateOperators]
        return got


def reading(link, at, order=0):
    return (link, minutes(at), 30.0, "n", "B", 50.0, 0.6, 1, T0 + dt.timedelta(seconds=order), "f", order)


def changes(rows):
    return sorted((r.link_id, int((r.data_as_of - T0).total_seconds() // 60)) for r in rows)


def test_late_rows_and_eviction_follow_event_time(spark, scratch):
    """Rows inside the bound count, rows outside are dropped, and silent links leave the state; output equals the batch rule."""
    s = Stream(spark, scratch, ROW, lambda x: ST.change_stream(x, ttl_minutes=120, late_minutes=120))
    assert changes(s.run([reading("a", 0), reading("b", 10), reading("b", 10, 1)])) == [("a", 0), ("b", 10)]
    assert changes(s.run([reading("b", 100), reading("c", -50)])) == [("b", 100), ("c", -50)]  # 60 minutes late: inside
    rows = lambda: sum(o.numRowsTotal for o in s.progress[-1].stateOperators)
    assert rows() >= 3
    assert changes(s.run([reading("b", 300)])) == [("b", 300)]  # the watermark passes a, c and b's old time
    # a (0) and c (-50) are older than 300 - 120 = 180 and gone; a row older than the watermark never arrives
    assert changes(s.run([reading("a", 100), reading("a", 179), reading("b", 299)])) == [("b", 299)]
    assert rows() < 3
    assert changes(s.run([reading("a", 310)])) == [("a", 310)]  # a silent link that comes back is new
    from roadlake.operators.filters import filter_dead_links
    frame = spark.createDataFrame([reading("a", 100), reading("a", 179), reading("b", 299), reading("b", 180)], ROW)
    kept = filter_dead_links(frame, minutes(300).strftime("%Y-%m-%d %H:%M:%S"))
    assert changes(kept.collect()) == [("b", 180), ("b", 299)]  # P8 in batch, with the newest reading as now


def test_warm_start_emits_nothing_twice(spark, scratch):
    replay = spark.createDataFrame([("a", minutes(-30)), ("a", minutes(-5)), ("b", minutes(-5))], "link_id string, data_as_of timestamp_ntz")
    s = Stream(spark, scratch, ROW, lambda x: ST.change_stream(x, initial=replay))
    first = s.run([reading("a", -5), reading("b", 2), reading("c", -5)])
    assert changes(first) == [("b", 2), ("c", -5)]  # a's newest reading was in the replay
    assert changes(s.run([reading("a", -5), reading("a", 3), reading("a", -5, 1), reading("a", 3, 2)])) == [("a", -5), ("a", 3), ("a", 3)]


def test_a_b_a_in_and_over_batches(spark, scratch):
    s = Stream(spark, scratch, ROW, ST.change_stream)
    assert changes(s.run([reading("a", 1, 0), reading("a", 2, 1), reading("a", 1, 2), reading("a", 1, 3)])) == [("a", 1), ("a", 1), ("a", 2)]
    assert changes(s.run([reading("a", 1, 4), reading("a", 2, 5)])) == [("a", 2)]


def snapshot(link, at, k):
    return (link, minutes(at), k % 3, 0.3 + (k % 60) / 100, f"n{k}")


def plain(rows, params):
    """``newest_with_lags`` over a link's lookback, as comparable tuples."""
    return sorted((r.link_id, r.data_as_of, r.current_congestion, r.speed_ratio, r.link_name,
                   *((None if r[f"lag_{m}"] is None else (r[f"lag_{m}"].u, r[f"lag_{m}"].current_congestion, r[f"lag_{m}"].speed_ratio))
                     for m in params.lag_tolerance)) for r in rows)


def test_lookback_ring_equals_the_batch_form_at_every_tick(spark, scratch):
    import random
    rng, params = random.Random(5), S.ServingParams()
    s = Stream(spark, scratch, ST.SNAPSHOT, lambda x: ST.lookback_stream(x, params, late_minutes=30))
    seen, k, low = [], 0, -10_000
    for tick in range(7):
        fresh = []
        for link in "abcd":
            if link == "d" and tick > 2:
                continue  # goes silent
            for _ in range(rng.randint(2, 6)):
                at = tick * 25 + rng.randint(0, 24) + rng.randint(0, 59) / 60
                if rng.random() < 0.2:
                    at -= rng.choice([3, 12, 20])  # late, inside the bound
                fresh.append(snapshot(link, at, k))
                k += 1
        if tick == 3:
            fresh.append((*snapshot("a", 0, k)[:1], seen[0][1], 2, 0.9, "again"))  # older than the watermark: dropped
        got = plain(s.run(fresh), params)
        late = [r for r in fresh if r[1] < minutes(low)]
        seen += [r for r in fresh if r not in late]
        low = max(low, max((r[1] - T0).total_seconds() / 60 for r in fresh) - 30)
        frame = spark.createDataFrame([(*r, n) for n, r in enumerate(seen)], ST.SNAPSHOT + ", n long")
        newest = frame.groupBy("link_id").agg(F.max("data_as_of").alias("m"))
        window = frame.join(newest, "link_id").where("data_as_of >= m - INTERVAL 90 MINUTES").drop("m")
        expected = plain(newest_with_lags(window, ["current_congestion", "speed_ratio"], tie="n").drop("n").collect(), params)
        links = {r[0] for r in fresh if r not in late}
        assert got == [e for e in expected if e[0] in links], tick
    total = sum(o.numRowsTotal for o in s.progress[-1].stateOperators)
    assert total < len(seen)  # the ring holds the lookback, not the stream


def test_lookback_warm_start(spark, scratch):
    params = S.ServingParams()
    before = [snapshot("a", m, m) for m in range(-80, 0, 5)]
    s = Stream(spark, scratch, ST.SNAPSHOT, lambda x: ST.lookback_stream(x, params, initial=spark.createDataFrame(before, ST.SNAPSHOT)))
    after = [snapshot("a", 1, 500)]
    got = plain(s.run(after), params)
    frame = spark.createDataFrame(before + after, ST.SNAPSHOT)
    assert got == plain(newest_with_lags(frame, ["current_congestion", "speed_ratio"]).collect(), params) and None not in got[0][5:]


def test_a_batch_published_twice_is_read_once(spark, scratch):
    topic = os.path.join(scratch, "topic")
    rows = [(*snapshot("a", m, m), minutes(m)) for m in range(0, 20, 5)] + [(*snapshot("b", 3, 3), minutes(3))]
    batch = spark.createDataFrame(rows, ST.SNAPSHOT + ", ingest_ts timestamp_ntz")
    publish = lambda df, n: K.write_snapshots(df, fmt="parquet", path=topic, timestamp_col="ingest_ts", run_id="r", batch_id=n)
    publish(batch, 0)
    publish(batch.repartition(3), 0)  # the retry of a batch that had been published
    publish(batch.limit(1), 1)  # the same reading in another batch is another message
    K.write_snapshots(batch.limit(1), fmt="parquet", path=topic, timestamp_col="ingest_ts")  # without ids all stay
    K.write_snapshots(batch.limit(1), fmt="parquet", path=topic, timestamp_col="ingest_ts")
    now_ms = int(minutes(30).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    got = R.scan_snapshots_bounded(spark, now_ms, 90, fmt="parquet", path=topic)
    assert got.count() == 5 + 1 + 2 and "message_id" not in got.columns
    seen = []
    with ST.with_state_store(spark):
        q = (R.snapshot_stream(spark.readStream.schema("key string, value string, timestamp timestamp_ntz").parquet(topic))
             .writeStream.foreachBatch(lambda b, n: seen.extend(b.collect())).option("checkpointLocation", os.path.join(scratch, "ck"))
             .trigger(availableNow=True).start())
    q.processAllAvailable()
    q.awaitTermination()
    assert len(seen) == 8


def test_lookback_predictor_writes_predictions(spark, scratch):
    """From the topic, published twice, to predictions: equal to scoring the whole lookback at once."""
    from catalog import tables as T
    from roadlake.operators.ml import build_pipeline
    from roadlake.plans.training import prepare, weighted_train
    from roadlake.streaming.predictor import predict_once, start_lookback_predictor
    model = build_pipeline(numTrees=3, maxDepth=3, maxBins=256).fit(weighted_train(prepare(T.dense_gold(spark, "/root/testdata/sf0.001"), T.DENSE_SPLITS), fraction=1.0))
    lookup = spark.createDataFrame([("a", 50.0, "B", "N"), ("b", 50.0, "B", "N")], "link_id string, free_flow_speed double, borough string, link_name string")
    holidays = spark.createDataFrame([("2024-01-01",)], "holiday_date string")
    rows = [(*snapshot(link, m, m), minutes(m)) for link in "ab" for m in range(0, 80, 5)]
    batch = spark.createDataFrame(rows, ST.SNAPSHOT + ", ingest_ts timestamp_ntz")
    topic, out = os.path.join(scratch, "topic"), os.path.join(scratch, "pred")
    for _ in range(2):
        K.write_snapshots(batch, fmt="parquet", path=topic, timestamp_col="ingest_ts", run_id="r", batch_id=0)
    msgs = spark.readStream.schema("key string, value string, timestamp timestamp_ntz").parquet(topic)
    q = start_lookback_predictor(R.snapshot_stream(msgs), lookup, holidays, model, out, os.path.join(scratch, "ck"), trigger={"availableNow": True})
    q.processAllAvailable()
    q.awaitTermination()
    assert q.exception() is None
    got = sorted((r.link_id, r.timestamp, r.predicted_congestion, round(r.confidence, 9)) for r in R.scan_predictions(spark, out).collect())
    at_once = predict_once(batch.drop("ingest_ts"), lookup, holidays, model, minutes(76).strftime("%Y-%m-%d %H:%M:%S"))
    assert len(got) == 2 and got == sorted((r.link_id, r.timestamp, r.predicted_congestion, round(r.confidence, 9)) for r in at_once.collect())
