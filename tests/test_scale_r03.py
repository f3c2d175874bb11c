"""What must not grow faster than the rows: state partitions and store calls, passes of a model, listings, rows in a task."""

import datetime as dt
import os

from pyspark.sql import Row
from pyspark.sql import functions as F

from roadlake import settings as S
from roadlake.operators.asof import asof_lags
from roadlake.plans import training
from roadlake.sources import readers as R
from roadlake.sources import versions as V
from roadlake.sources import writers as K
from roadlake.streaming import state as ST

T0 = dt.datetime(2024, 3, 1, 12)


class Conf:
    """A session setting for the time of a test."""

    def __init__(self, spark, key, value):
        self.spark, self.key, self.value = spark, key, value

    def __enter__(self):
        self.old = self.spark.conf.get(self.key)
        self.spark.conf.set(self.key, self.value)

    def __exit__(self, *_):
        self.spark.conf.set(self.key, self.old)


def test_state_partitions_follow_the_cores(spark):
    most = 2 * spark.sparkContext.defaultParallelism
    for there, own in (("500", most), ("3", 3)):
        with Conf(spark, ST.PARTITIONS, there):
            with ST.with_state_store(spark):
                assert spark.conf.get(ST.PARTITIONS) == str(own) and spark.conf.get(ST.PROVIDER) == ST.ROCKSDB
            assert spark.conf.get(ST.PARTITIONS) == there
            with ST.with_state_store(spark, partitions=7):
                assert spark.conf.get(ST.PARTITIONS) == "7"


class Store:
    """Stands for handle and value state; counts the calls."""

    def __init__(self):
        self.value, self.timers, self.calls = None, [], 0

    def getValueState(self, *_):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, ms):
        self.calls += 1
        self.timers.append(ms)

    def getCurrentWatermarkInMs(self):
        return 0

    def getExpiryTimeInMs(self):
        return self.timers[-1]


def feed_row(minute, order, **others):
    at = None if minute is None else T0 + dt.timedelta(minutes=minute)
    return Row(**(dict.fromkeys(ST.OUT_COLS) | {"link_id": "a", "data_as_of": at, "ingest_ts": T0, "feed_file": "f", "feed_row": order} | others))


def test_a_batch_of_a_link_asks_the_store_twice(spark):
    p, store = ST.ChangeProcessor(ttl_minutes=10), Store()
    p.init(store)
    given = lambda *rows: [r["feed_row"] for r in p.handleInputRows(("a",), iter(rows), None)]
    # arrival order, not the order given; what has no arrival time comes last
    assert given(feed_row(5, 2), feed_row(0, 1), feed_row(0, 0), feed_row(9, 3, ingest_ts=None), feed_row(5, 9)) == [0, 2, 3]
    first = list(store.timers)
    for k in range(3):
        store.calls = 0
        assert given(feed_row(10 + k, k), feed_row(None, k + 1)) == [k, k + 1]
        assert store.calls == 2 and store.timers == first
    assert list(p.handleExpiredTimer(("a",), store, store)) == [] and store.value is not None  # newer rows have come: the timer moves on
    assert store.timers[-1] - first[-1] == 3 * 60_000
    p.handleExpiredTimer(("a",), store, store)
    assert store.value is None


def test_evaluate_scores_each_row_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def score(v):
        seen.add(1)
        return float(v % 3)

    class Model:
        def transform(self, df):
            return df.withColumn("prediction", F.udf(score, "double")("v"))

    rows = [(float(k % 2), k) for k in range(30)] + [(None, 1)]
    e = training.evaluate(Model(), spark.createDataFrame(rows, f"{S.LABEL_COL} double, v long").repartition(2))
    confusion = {r["actual"]: (r["pred_0"], r["pred_1"], r["pred_2"]) for r in e["confusion"].collect()}
    assert confusion == {0.0: (5, 5, 5), 1.0: (5, 5, 5), 2.0: (0, 0, 0)}
    assert {r["class"]: (r["tp"], r["fp"], r["fn"]) for r in e["metrics"].collect()} == {0.0: (5, 5, 10), 1.0: (5, 5, 10), 2.0: (0, 10, 0)}
    assert e["macro_f1"].first()["rows"] == 30
    assert seen.value == len(rows)


def test_forest_is_fitted_on_stored_rows(spark, monkeypatch):
    """The train rows are written once; indexers and trees read these, not what they were taken from."""
    from roadlake.operators import ml
    fitted = []

    class Pipeline:
        def fit(self, train):
            fitted.append(train)

    monkeypatch.setattr(ml, "build_pipeline", lambda **_: Pipeline())
    gold = spark.range(200).select(F.lit("train").alias("split"), (F.col("id") % 3).cast("double").alias(S.LABEL_COL), F.col("id").cast("string").alias("link_id"),
                                   F.lit("b").alias("borough"), F.timestamp_seconds("id").alias("data_as_of"))
    training.fit_forest(gold, fraction=1.0)
    assert fitted[0].count() == 200 and all(os.path.basename(os.path.dirname(f)).startswith("train-") for f in fitted[0].inputFiles())


def test_partition_exists_lists_its_own_partitions(spark, scratch):
    root = os.path.join(scratch, "gold")
    K.write_gold(spark.range(60).select(F.col("id").cast("string").alias("link_id"), F.timestamp_seconds(F.col("id") * 3600).alias("data_as_of"),
                                        F.lit(2024).alias("year"), (F.col("id") % 3 + 1).cast("int").alias("month")), root, partitions=2)
    files = V.read_table(spark, root, equals={"month": 2}).inputFiles()
    assert files and all("month=2" in f for f in files)
    assert len(V.read_table(spark, root, equals={"link_id": "1", "month": "2"}).inputFiles()) == len(V.read_table(spark, root).inputFiles())
    assert R.partition_exists(spark, root, month=2, year=2024) and not R.partition_exists(spark, root, month=4)
    assert not R.partition_exists(spark, root, month=2, year=2023) and not R.partition_exists(spark, root, month=2, link_id="none")


def test_rows_of_windows_stay_dealt(spark):
    """Partitions that look small when compressed are not joined to one task."""
    from roadlake.operators.windows import gold_features
    rows = [(str(k % 40), T0 + dt.timedelta(minutes=5 * (k // 40)), 0.5, 1, k) for k in range(2000)]
    df = spark.createDataFrame(rows, "link_id string, data_as_of timestamp_ntz, speed_ratio double, current_congestion int, speed long")
    with Conf(spark, ST.PARTITIONS, "24"):
        lags = asof_lags(df, ["speed"], tie="speed")
        assert lags.count() == 2000
        assert lags.rdd.getNumPartitions() == 24
        assert gold_features(df, ts="data_as_of").rdd.getNumPartitions() == 24


def test_dense_series_joins_places_without_moving_rows(spark):
    from catalog import tables as T
    with Conf(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        plan = T.dense_silver(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in plan


def test_a_message_is_parsed_once(spark):
    """predicates and fields of the decoded snapshot do not write the parse out again; what is dropped stays the same."""
    ok = '"current_congestion": 1, "speed_ratio": 0.5, "link_name": "n"'
    rows = [("a", '{"data_as_of": "2024-03-01T07:00:00-05:00", %s, "message_id": "m"}' % ok),
            ("b", '{"data_as_of": "2024-03-01T12:00:00.250Z", "current_congestion": 0, "speed_ratio": 1}'),
            ("c", '{"data_as_of": "2024-03-01 07:00:00", %s}' % ok), ("d", '{"data_as_of": "2024-03-01", %s}' % ok),
            ("e", '{"data_as_of": null, %s}' % ok), ("f", "{%s}" % ok), ("g", "{not json"), ("h", None), ("i", ""),
            (None, '{"data_as_of": "2024-03-01T12:00:00Z", %s}' % ok),
            ("j", '{"data_as_of": "2024-03-01T12:00:00Z", "current_congestion": "x", "speed_ratio": 0.5}'),
            ("k", '{"data_as_of": "2024-03-01T12:00:00Z", "current_congestion": 1}')]
    got = R.decode_snapshot_messages(spark.createDataFrame(rows, "key string, value string"))
    assert got.columns == ["link_id", "message_id", "data_as_of", "current_congestion", "speed_ratio", "link_name"]
    assert sorted(map(tuple, got.collect())) == [
        ("a", "m", T0, 1, 0.5, "n"), ("b", None, T0.replace(microsecond=250_000), 0, 1.0, None), ("c", None, T0, 1, 0.5, "n")]
    plan = R.published_once(got)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and plan.count("regexp_extract(") == 2 and "RLIKE" not in plan
