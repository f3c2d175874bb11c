import datetime as dt
import os
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F

from roadlake import settings as S
from catalog import tables as T
from roadlake.plans.training import evaluate, prepare, run_training, weighted_train
from roadlake.sources import readers as R
from roadlake.streaming import collector as C
from roadlake.streaming.predictor import run_predictor

NY = ZoneInfo("America/New_York")
SF = "/root/testdata/sf0.01"


def _feed_file(folder, name, rows):
    with open(os.path.join(folder, name), "w") as fh:
        fh.write('"linkId"\t"Speed"\t"DataAsOf"\t"linkName"\n')
        for link, speed, t in rows:
            fh.write(f'"{link}"\t"{speed}"\t"{t.strftime("%m/%d/%Y %H:%M:%S")}"\t"L{link}"\n')


def test_collector_stream_change_detection(spark, scratch):
    feed, topic, bronze, ckpt = (os.path.join(scratch, d) for d in ("feed", "topic", "bronze", "ckpt"))
    os.makedirs(feed)
    now = dt.datetime.now(NY).replace(microsecond=0, tzinfo=None)
    ta, tb = now - dt.timedelta(minutes=30), now - dt.timedelta(minutes=20)
    old = now - dt.timedelta(minutes=200)
    active = spark.createDataFrame([("1",), ("2",), ("3",)], "link_id string")
    lookup = spark.createDataFrame([("1", 50.0, "B1", "N1"), ("2", 40.0, "B2", "N2")],
                                   "link_id string, free_flow_speed double, borough string, link_name string")
    batches = [
        [("1", 30, ta), ("2", 20, ta), ("3", 20, ta), ("9", 20, ta), ("2", 0, tb)],  # 3 no lookup, 9 inactive, speed 0
        [("1", 31, ta), ("2", 25, tb)],    # 1 unchanged -> skip; 2 changed -> emit
        [("1", 32, tb), ("2", 26, old)],   # 1 B -> emit; 2 dead -> dropped
        [("1", 33, ta)],                   # 1 back to A -> emit (A, B, A)
    ]
    for i, rows in enumerate(batches):
        _feed_file(feed, f"f{i}.txt", rows)
        stream = R.scan_feed_tsv(spark, feed, streaming=True)
        q = C.start_collector(stream, active, lookup, bronze, ckpt, topic_fmt="parquet", topic_path=topic,
                              trigger={"availableNow": True})
        q.processAllAvailable()
        assert q.exception() is None
        q.stop()
    msgs = R.decode_snapshot_messages(spark.read.parquet(topic))
    got = sorted((r.link_id, r.data_as_of) for r in msgs.collect())
    utc = lambda t: t.replace(tzinfo=NY).astimezone(dt.timezone.utc).replace(tzinfo=None)
    assert got == sorted([("1", utc(ta)), ("1", utc(tb)), ("1", utc(ta)), ("2", utc(ta)), ("2", utc(tb))])
    assert {r.current_congestion for r in msgs.filter("link_id = '1'").collect()} == {1}
    b = spark.read.parquet(bronze)
    assert b.count() == 5 and set(b.columns) >= {"link_id", "speed", "data_as_of", "borough", "date", "hour", "run_id", "batch_id"}


def test_case_cascade_order(spark):
    now = "2024-01-31 00:00:00"
    rows = spark.createDataFrame([("a", dt.datetime(2024, 1, 30, 23), 50.0), ("a", dt.datetime(2024, 1, 30, 21), 50.0),
                                  ("a", dt.datetime(2024, 1, 30, 23), 0.0), ("z", dt.datetime(2024, 1, 30, 23), 50.0),
                                  ("a", None, 50.0)],
                                 "link_id string, data_as_of timestamp_ntz, speed double")
    active = spark.createDataFrame([("a",)], "link_id string")
    got = [r.verdict for r in C.case_cascade(rows, active, now).collect()]
    assert sorted(got) == sorted(["valid", "dead", "faulty_sensor", "inactive", "dead"])


def test_training_scoring_and_reload(spark, scratch):
    gold = T.gold(spark, SF)
    frame = prepare(gold, T.SPLITS)
    from roadlake.operators.ml import build_pipeline, feature_importance, save_model
    model = build_pipeline(numTrees=5, maxDepth=4, maxBins=256).fit(weighted_train(frame, fraction=1.0))
    ev = evaluate(model, frame.filter(F.col("split") != "train"))
    cm = ev["confusion"].collect()
    assert len(cm) == 3 and all(len(r) == 4 for r in cm)
    f1 = ev["macro_f1"].head()
    assert 0.0 <= f1.macro_f1 <= 1.0 and f1.rows == frame.filter(F.col("split") != "train").count()
    imp = feature_importance(model).collect()
    assert len(imp) == 19 and abs(sum(r.importance for r in imp) - 1.0) < 1e-6
    reloaded = save_model(model, os.path.join(scratch, "model"))
    quick = frame.limit(20)
    a = [r.prediction for r in model.transform(quick).orderBy("link_id", "data_as_of").collect()]
    b = [r.prediction for r in reloaded.transform(quick).orderBy("link_id", "data_as_of").collect()]
    assert a == b

    # scorer: serving features -> predictions folder (unseen links are kept by the indexers)
    lk = T.lookup(spark, SF)
    snaps = T.snapshots(spark, SF)
    out = os.path.join(scratch, "pred")
    assert run_predictor(snaps, lk, T.holidays(spark), model, out, "run", 0, now=T.NOW, params=T.SERVING_PARAMS)
    assert not run_predictor(snaps, lk, T.holidays(spark), model, out, "run", 0, now=T.NOW, params=T.SERVING_PARAMS)  # a retry
    preds = R.scan_predictions(spark, out)
    cols = set(preds.columns)
    assert set(S.PREDICTION_COLUMNS) <= cols and preds.count() > 0
    assert preds.filter("confidence < 0.3 OR confidence > 1.0").count() == 0

    # streaming form: the snapshot topic paces the runs, each run re-reads the lookback
    from roadlake.sources.writers import write_snapshots
    from roadlake.streaming.predictor import start_predictor
    topic = os.path.join(scratch, "topic")
    write_snapshots(snaps.limit(50), fmt="parquet", path=topic, timestamp_col="data_as_of")
    tick = spark.readStream.schema("key string, value string, timestamp timestamp_ntz").parquet(topic)
    out2 = os.path.join(scratch, "pred2")
    q = start_predictor(tick, lambda: snaps, lk, T.holidays(spark), model, out2, os.path.join(scratch, "ck"),
                        trigger={"availableNow": True}, params=T.SERVING_PARAMS, now=T.NOW)
    q.processAllAvailable()
    q.stop()
    assert R.scan_predictions(spark, out2).count() == preds.count()


def test_warmup_replay_and_artifact_check(spark, scratch):
    from roadlake.operators.quality import artifact_check
    from roadlake.sources.writers import write_bronze_realtime, write_lookup, write_snapshots
    now = "2024-01-31 00:00:00"
    rt = spark.createDataFrame(
        [("1", 30.0, dt.datetime(2024, 1, 30, 23, 0), "B", "n"), ("1", 30.0, dt.datetime(2024, 1, 30, 21, 0), "B", "n"),
         ("2", 10.0, dt.datetime(2024, 1, 30, 23, 30), "B", "m"), ("7", 10.0, dt.datetime(2024, 1, 30, 23, 30), "B", "m")],
        "link_id string, speed double, data_as_of timestamp_ntz, borough string, link_name string")
    root = os.path.join(scratch, "rt")
    write_bronze_realtime(rt.withColumn("ingest_ts", F.col("data_as_of")), root, "run", 0)
    lookup = spark.createDataFrame([("1", 60.0, "B1", "N1"), ("2", 50.0, "B2", "N2")],
                                   "link_id string, free_flow_speed double, borough string, link_name string")
    lk_path = os.path.join(scratch, "lookup")
    write_lookup(lookup, lk_path)
    assert C.needs_warmup(spark.createDataFrame([("1",)], "link_id string"))
    replay = C.warmup_snapshots(spark.read.parquet(root), R.scan_table(spark, lk_path), now)
    got = sorted((r.link_id, r.current_congestion) for r in replay.collect())
    assert got == [("1", 1), ("2", 2)]       # 21:00 is outside the 90-minute lookback; 7 has no lookup
    topic = os.path.join(scratch, "topic")
    empty_topic = spark.createDataFrame([], "link_id string")
    assert C.maybe_warmup(spark, empty_topic, os.path.join(scratch, "none"), lookup, now,
                          topic_fmt="parquet", topic_path=topic) == 0       # no bronze yet
    assert C.maybe_warmup(spark, empty_topic, root, R.scan_table(spark, lk_path), now,
                          topic_fmt="parquet", topic_path=topic) == 2
    full = spark.range(25).selectExpr("CAST(id AS STRING) AS link_id")
    assert C.maybe_warmup(spark, full, root, lookup, now, topic_fmt="parquet", topic_path=topic) == 0
    report = {r.artifact: r for r in artifact_check(spark, [
        {"name": "lookup", "path": lk_path, "expected_rows": 2, "columns": S.LOOKUP_COLUMNS},
        {"name": "coords", "path": os.path.join(scratch, "missing")},
        {"name": "topic", "path": topic, "expected_rows": 5, "columns": ["key", "value"]},
    ]).collect()}
    assert report["lookup"].ok and report["lookup"].rows == 2
    assert not report["coords"].exists and not report["coords"].ok
    assert report["topic"].exists and not report["topic"].ok


def test_change_detect_batch_equals_stream(spark, scratch):
    """W6 batch form = T3 streaming state on the same rows split over micro-batches."""
    from roadlake.operators.windows import change_detect
    now = dt.datetime.now(NY).replace(microsecond=0, tzinfo=None)
    times = [now - dt.timedelta(minutes=m) for m in (50, 40, 30)]
    seq = [("1", times[i]) for i in (0, 0, 1, 1, 0, 2, 2, 1)] + [("2", times[i]) for i in (0, 1, 1, 2)]
    feed, ckpt, topic, bronze = (os.path.join(scratch, d) for d in ("feed", "ckpt", "topic", "bronze"))
    os.makedirs(feed)
    active = spark.createDataFrame([("1",), ("2",)], "link_id string")
    lookup = spark.createDataFrame([("1", 50.0, "B", "N"), ("2", 50.0, "B", "N")],
                                   "link_id string, free_flow_speed double, borough string, link_name string")
    # one fetch (file) per reading, three fetches per micro-batch, arrival = file time
    base = 1_700_000_000
    for i, (link, t) in enumerate(seq):
        path = os.path.join(scratch, f"f{i:02d}.txt")
        _feed_file(scratch, f"f{i:02d}.txt", [(link, 20, t)])
        os.utime(path, (base + i, base + i))
    for b in range(0, len(seq), 3):
        for i in range(b, min(b + 3, len(seq))):
            os.rename(os.path.join(scratch, f"f{i:02d}.txt"), os.path.join(feed, f"f{i:02d}.txt"))
        q = C.start_collector(R.scan_feed_tsv(spark, feed, streaming=True), active, lookup, bronze, ckpt,
                              topic_fmt="parquet", topic_path=topic, trigger={"availableNow": True})
        q.processAllAvailable()
        q.stop()
    streamed = sorted((r.link_id, r.data_as_of) for r in
                      R.decode_snapshot_messages(spark.read.parquet(topic)).collect())
    utc = lambda t: t.replace(tzinfo=NY).astimezone(dt.timezone.utc).replace(tzinfo=None)
    rows = [(link, utc(t), dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i), i) for i, (link, t) in enumerate(seq)]
    batch = change_detect(spark.createDataFrame(rows, "link_id string, data_as_of timestamp_ntz, "
                                                      "ingest_ts timestamp_ntz, row_no long"))
    assert streamed == sorted((r.link_id, r.data_as_of) for r in batch.collect())


LOOKUP = "link_id string, free_flow_speed double, borough string, link_name string"


def _collect(spark, scratch, files, max_files=None, ttl=None, **options):
    feed, topic, bronze, ckpt = (os.path.join(scratch, d) for d in ("feed", "topic", "bronze", "ckpt"))
    os.makedirs(feed, exist_ok=True)
    for name, rows in files.items():
        _feed_file(feed, name, rows)
    active = spark.createDataFrame([("1",), ("2",)], "link_id string")
    lookup = spark.createDataFrame([("1", 50.0, "B1", "N1")], LOOKUP)
    q = C.start_collector(R.scan_feed_tsv(spark, feed, streaming=True, max_files=max_files), active, lookup, bronze, ckpt,
                          topic_fmt="parquet", topic_path=topic, trigger={"availableNow": True}, **options)
    q.processAllAvailable()
    assert q.exception() is None
    progress = q.recentProgress
    q.stop()
    return topic, bronze, progress


def test_order_inside_one_micro_batch(spark, scratch):
    """A, B, A in one file and one batch is three changes; rejected and unmatched rows are counted."""
    now = dt.datetime.now(NY).replace(microsecond=0, tzinfo=None)
    a, b = now - dt.timedelta(minutes=20), now - dt.timedelta(minutes=30)
    rows = [("1", 30, a), ("1", 30, a), ("1", 30, b), ("1", 30, a), ("2", 30, a), ("9", 30, a), ("1", 0, a), ("1", 30, now - dt.timedelta(hours=9))]
    topic, bronze, progress = _collect(spark, scratch, {"f.txt": rows})
    assert spark.read.parquet(topic).count() == 3 and spark.read.parquet(bronze).count() == 3
    seen = [p.observedMetrics for p in progress if p.observedMetrics.get("collector")]
    assert sum(m["collector"].valid for m in seen) == 5 and sum(m["collector"].inactive for m in seen) == 1
    assert sum(m["collector"].dead for m in seen) == 1 and sum(m["collector"].faulty_sensor for m in seen) == 1
    assert sum(m["collector_matched"].matched for m in seen) == 4  # link 2 is not in the lookup


def test_bronze_failure_is_retried_then_reported(spark, scratch, monkeypatch):
    from roadlake.sources import writers
    now = dt.datetime.now(NY).replace(microsecond=0, tzinfo=None)
    real, calls, told = writers.write_bronze_realtime, [], []

    def flaky(*args, **options):
        calls.append(1)
        if len(calls) in (1, 3, 4):
            raise OSError("no space")
        return real(*args, **options)

    monkeypatch.setattr(writers, "write_bronze_realtime", flaky)
    report = lambda batch, e: told.append((batch, str(e)))
    topic, bronze, _ = _collect(spark, scratch, {"f1.txt": [("1", 30, now - dt.timedelta(minutes=30))]}, on_bronze_error=report)
    assert spark.read.parquet(bronze).count() == 1 and not told  # the second attempt worked
    _collect(spark, scratch, {"f2.txt": [("1", 30, now - dt.timedelta(minutes=20))]}, on_bronze_error=report)
    assert [m for _, m in told] == ["no space"] and spark.read.parquet(topic).count() == 2  # reported; the topic flows
    dead = bronze + "-dead-letters"
    assert spark.read.parquet(dead).count() == 1 and spark.read.parquet(bronze).count() == 1  # kept beside bronze
    monkeypatch.setattr(writers, "write_bronze_realtime", real)
    assert C.recover_dead_letters(spark, dead, bronze) == 1 and C.recover_dead_letters(spark, dead, bronze) == 0
    assert spark.read.parquet(bronze).count() == 2


def test_run_training_evaluates_every_row(spark):
    gold = T.dense_gold(spark, "/root/testdata/sf0.001")
    out = run_training(spark, gold, T.DENSE_SPLITS, forest_params={"numTrees": 3, "maxDepth": 3}, fraction=0.35)
    frame = prepare(gold, T.DENSE_SPLITS)
    for split in ("val", "test"):
        assert out[split]["macro_f1"].first().rows == frame.filter(F.col("split") == split).count()
    assert [type(s).__name__ for s in out["model"].stages] == ["StringIndexerModel", "StringIndexerModel", "VectorAssembler", "RandomForestClassificationModel"]


def test_sample_is_redrawn_in_plain_python(spark):
    import hashlib
    gold = T.dense_gold(spark, "/root/testdata/sf0.001")
    from roadlake.operators.filters import sample_limit, stratified_sample
    key = lambda r: f"{S.SAMPLE_SEED}|{r.link_id}|{r.data_as_of}"
    expected = {key(r) for r in gold.collect() if hashlib.md5(key(r).encode()).hexdigest()[:8] < sample_limit(S.SAMPLE_FRACTION)}
    for parts in (1, 5):
        assert {key(r) for r in stratified_sample(gold.repartition(parts), ["link_id", "data_as_of"]).collect()} == expected
    assert 0.25 < len(expected) / gold.count() < 0.45
