import datetime as dt
import json
import os

from pyspark.sql import functions as F

from roadlake.sources import readers as R
from roadlake.sources import writers as K
from roadlake.plans.training import materialize


def test_feed_tsv_parse(spark, scratch):
    path = os.path.join(scratch, "feed.txt")
    lines = ['"linkId"\t"Speed"\t"DataAsOf"\t"linkName"',
             '"4616297"\t"42.25"\t"01/15/2024 08:03:12"\t"A to B"',
             '"4616298"\t""\t"01/15/2024 08:03:12"\t"C"',
             '"4616299"\t"7"\t"bad time"\t""']
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    rows = R.parse_feed(R.scan_feed_tsv(spark, path)).orderBy("link_id").collect()
    assert [(r.link_id, r.speed, r.link_name) for r in rows] == [
        ("4616297", 42.25, "A to B"), ("4616298", None, "C"), ("4616299", 7.0, "")]
    assert rows[0].data_as_of == dt.datetime(2024, 1, 15, 13, 3, 12) and rows[2].data_as_of is None


def test_json_list(spark, scratch):
    path = os.path.join(scratch, "active.json")
    with open(path, "w") as fh:
        json.dump(["1", "2", "3"], fh)
    assert sorted(r.link_id for r in R.scan_json_list(spark, path).collect()) == ["1", "2", "3"]


def test_bronze_month_is_replaced_not_appended(spark, scratch):
    root = os.path.join(scratch, "bronze")
    a = spark.createDataFrame([("1", "5.0")], "link_id string, speed string")
    K.write_bronze_month(a, root, 2024, 1)
    K.write_bronze_month(a.union(a), root, 2024, 2)
    K.write_bronze_month(a, root, 2024, 2)  # re-run of February
    df = R.scan_table(spark, root)
    assert sorted((r.year, r.month) for r in df.collect()) == [(2024, 1), (2024, 2)]
    assert R.partition_exists(spark, root, year=2024, month=2)
    assert not R.partition_exists(spark, root, year=2024, month=3)
    assert not R.partition_exists(spark, os.path.join(scratch, "nothing"))
    assert R.land_history_month(spark.createDataFrame(
        [(dt.datetime(2024, 12, 31, 23),), (dt.datetime(2025, 1, 1),)], "data_as_of timestamp_ntz"),
        2024, 12).count() == 1


def test_feed_columns_by_name(spark, scratch):
    """Other column orders, more columns and a missing linkName, batch and stream."""
    folder = os.path.join(scratch, "feed")
    os.makedirs(folder)
    files = {
        "a.txt": ['"Id"\t"Speed"\t"TravelTime"\t"DataAsOf"\t"linkId"\t"linkName"', '"7"\t"30"\t"99"\t"01/15/2024 08:03:12"\t"111"\t"N1"'],
        "b.txt": ['"DataAsOf"\t"linkId"\t"Speed"', '"01/15/2024 08:03:12"\t"222"\t"40"', "", '"01/15/2024 08:04:12"\t"223"'],
        "c.txt": ['"linkId"\t"Speed"\t"DataAsOf"\t"linkName"'],
    }
    for name, lines in files.items():
        with open(os.path.join(folder, name), "w") as fh:
            fh.write("\r\n".join(lines))
    t = dt.datetime(2024, 1, 15, 13, 3, 12)
    expected = [("111", 30.0, t, "N1"), ("222", 40.0, t, ""), ("223", None, t + dt.timedelta(minutes=1), "")]
    pick = lambda df: sorted((r.link_id, r.speed, r.data_as_of, r.link_name) for r in df.collect())
    assert pick(R.parse_feed(R.scan_feed_tsv(spark, folder))) == expected
    out = os.path.join(scratch, "out")
    q = (R.parse_feed(R.scan_feed_tsv(spark, folder, streaming=True, max_files=1)).writeStream.format("parquet")
         .option("checkpointLocation", os.path.join(scratch, "ck")).trigger(availableNow=True).start(out))
    q.awaitTermination()
    assert pick(spark.read.parquet(out)) == expected


SILVER = "link_id string, data_as_of timestamp_ntz, speed double"


def test_silver_months_do_not_destroy_each_other(spark, scratch):
    """A source month's first five hours belong to the local month before."""
    root = os.path.join(scratch, "silver")
    jan = spark.createDataFrame([("a", dt.datetime(2024, 1, 5, 3), 1.0), ("a", dt.datetime(2024, 1, 31, 18), 1.0), ("b", dt.datetime(2023, 12, 31, 20), 2.0)], SILVER)
    feb = spark.createDataFrame([("a", dt.datetime(2024, 1, 31, 21), 3.0), ("b", dt.datetime(2024, 2, 1, 1), 4.0)], SILVER)
    for df, name, total in ((jan, "2024-01", 3), (feb, "2024-02", 5), (jan, "2024-01", 5), (feb.limit(1), "2024-02", 4), (feb, "2024-02", 5)):
        K.write_silver(df, root, name)
        assert R.scan_table(spark, root).count() == total
    back = R.scan_table(spark, root)
    assert back.filter("year = 2024 AND month = 1").count() == 3 and back.filter("month = 12").count() == 1


def test_gold_full_and_partial_writes(spark, scratch):
    root = os.path.join(scratch, "gold")
    gold = spark.createDataFrame([("a", dt.datetime(2024, 1, 31, 23), 1.0), ("b", dt.datetime(2024, 2, 1, 1), 2.0)], SILVER) \
        .withColumn("year", F.lit(2024)).withColumn("month", F.month("data_as_of"))
    K.write_gold(gold, root, partitions=4, files_per_month=2, max_records=1)
    assert R.scan_table(spark, root).count() == 2
    K.replace_gold_months(gold.filter("month = 2").union(gold.filter("month = 2")), root, partitions=2)
    assert sorted(r.month for r in R.scan_table(spark, root).collect()) == [1, 2, 2]
    K.write_gold(gold.filter("month = 2"), root, partitions=2)  # a rebuild with fewer months leaves none behind
    assert [r.month for r in R.scan_table(spark, root).collect()] == [2]


RT = "link_id string, speed double, data_as_of timestamp_ntz, borough string, link_name string, ingest_ts timestamp_ntz"


def _rt(spark, *rows):
    return spark.createDataFrame([(link, 30.0, at, "B", "n", at) for link, at in rows], RT)


def test_bronze_realtime_is_written_once(spark, scratch):
    root = os.path.join(scratch, "rt")
    h = dt.datetime(2024, 1, 30, 10, 59)  # 05:59 local
    one = _rt(spark, ("1", h), ("2", h + dt.timedelta(minutes=2)))  # a batch over an hour change
    count = lambda: spark.read.parquet(root).count()
    K.write_bronze_realtime(one, root, "run-a", 0)
    K.write_bronze_realtime(one, root, "run-a", 0)  # the batch again, after the hour has changed
    assert count() == 2
    K.write_bronze_realtime(_rt(spark, ("3", h)), root, "run-b", 0)  # a new checkpoint numbers from 0 again
    K.write_bronze_realtime(_rt(spark, ("3", h)), root, "run-a", 1)
    assert count() == 4
    half = _rt(spark, ("5", h))
    K.write_bronze_realtime(half, root, "run-a", 2)  # as if an attempt had been cut off
    K.write_bronze_realtime(half.union(_rt(spark, ("6", h))), root, "run-a", 2)
    assert count() == 6 and spark.read.parquet(root).select("link_id", "run_id", "batch_id").distinct().count() == 6
    assert K.write_bronze_realtime(one.limit(0), root, "run-a", 3) == 0
    assert sorted(os.listdir(os.path.join(root, "date=2024-01-30"))) == ["hour=05", "hour=06"]  # no folder per batch


def test_recent_hours_of_a_written_table(spark, scratch):
    """Hours 00-09 local and a lookback across midnight, with the partitions pruned."""
    root = os.path.join(scratch, "rt")
    times = [dt.datetime(2024, 1, 30, 4, 0) + dt.timedelta(minutes=20 * k) for k in range(40)]  # from 23:00 local of the 29th
    K.write_bronze_realtime(_rt(spark, *((str(k), t) for k, t in enumerate(times))), root, "r", 0)
    table = spark.read.parquet(root)
    for now in ("2024-01-30 05:30:00", "2024-01-30 06:10:00", "2024-01-30 11:00:00", "2024-01-30 15:30:00"):
        at = dt.datetime.fromisoformat(now)
        got = R.recent_hours(table, now, 90)
        # the last hour's partition is read whole: rows later than now, as a replay has, stay
        expected = {t for t in times if t >= at - dt.timedelta(minutes=90) and t < at.replace(minute=0) + dt.timedelta(hours=1)}
        assert {r.data_as_of for r in got.collect()} == expected
        scan = got._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [(concat(cast(date" in scan


def test_month_runner(spark, scratch):
    from roadlake.plans.months import clean_months, finished, land_months
    from roadlake.plans.silver import silver_clean
    active = spark.createDataFrame([("a",), ("b",)], "link_id string")
    holidays = spark.createDataFrame([("2024-01-01",)], "holiday_date string")
    times = [dt.datetime(2023, 12, 31, 20) + dt.timedelta(hours=9 * k) for k in range(200)]
    raw = spark.createDataFrame([("ab"[k % 2], "B", "n", "40.5" if k % 7 else "x", t) for k, t in enumerate(times)],
                                "link_id string, borough string, link_name string, speed string, ts timestamp_ntz") \
        .withColumn("data_as_of", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
    bronze, silver, led, led2 = (os.path.join(scratch, x) for x in ("bronze", "silver", "ledger-b", "ledger-s"))
    months = [(2023, 12), (2024, 1), (2024, 2), (2024, 3), (2024, 4)]
    landed = land_months(raw, months, bronze, led, ts="ts")
    assert list(landed) == ["2023-12", "2024-01", "2024-02", "2024-03"] and sum(landed.values()) == 200
    assert land_months(raw, months, bronze, led, ts="ts") == {}
    clean = lambda **k: clean_months(spark, bronze, months, active, holidays, silver, led2, **k)
    first = clean()
    whole = silver_clean(raw.drop("ts"), active, holidays)
    cols = whole.columns
    rows = lambda df: sorted(map(tuple, df.select(*cols).collect()))
    assert rows(R.scan_table(spark, silver)) == rows(whole) and finished(spark, led2) == set(first)
    assert clean() == {} and set(clean(redo=[(2024, 2)])) == {"2024-02"}
    assert rows(R.scan_table(spark, silver)) == rows(whole)


def test_compact_artifact_refuses_empty(spark, scratch):
    src, dst = os.path.join(scratch, "lk"), os.path.join(scratch, "lk1")
    spark.createDataFrame([], "link_id string").write.parquet(src)
    assert K.compact_artifact(spark, src, dst) is False and not os.path.exists(dst)
    src2 = os.path.join(scratch, "lk2")
    spark.createDataFrame([(str(i),) for i in range(5)], "link_id string").repartition(3).write.parquet(src2)
    assert K.compact_artifact(spark, src2, dst)
    assert R.scan_parquet(spark, dst).count() == 5 and len(R.scan_parquet(spark, dst).inputFiles()) == 1
    assert K.compact_artifact(spark, dst, dst) and R.scan_parquet(spark, dst).count() == 5  # in place


def test_predictions_roundtrip_ignores_other_files(spark, scratch):
    root = os.path.join(scratch, "pred")
    preds = spark.createDataFrame([("1", "B", None, dt.datetime(2024, 1, 1), 2, 0.9)],
                                  "link_id string, borough string, link_name string, timestamp timestamp_ntz, "
                                  "predicted_congestion int, confidence double")
    assert K.write_predictions(preds.limit(0), root, "2024-01-01 12:00:00", "run", 0) is False
    assert K.write_predictions(preds, root, "2024-01-01 12:00:00", "run", 1)
    assert K.write_predictions(preds, root, "2024-01-01 12:00:00", "run", 1) is False  # the tick again
    part = os.path.join(root, "date=2024-01-01", "hour=07")
    assert os.path.isdir(part)
    with open(os.path.join(part, "notes.txt"), "w") as fh:
        fh.write("not parquet")
    back = R.scan_predictions(spark, root)
    assert back.count() == 1 and set(["date", "hour"]) <= set(back.columns)


def test_snapshot_topic_file_roundtrip(spark, scratch):
    path = os.path.join(scratch, "topic")
    snaps = spark.createDataFrame(
        [("1", dt.datetime(2024, 1, 1, 12), 1, 0.5, "n", dt.datetime(2024, 1, 1, 12, 0, 5)),
         ("2", dt.datetime(2024, 1, 1, 9), 0, 0.9, "", dt.datetime(2024, 1, 1, 9, 0, 5))],
        "link_id string, data_as_of timestamp_ntz, current_congestion int, speed_ratio double, link_name string, "
        "ingest_ts timestamp_ntz")
    K.write_snapshots(snaps, fmt="parquet", path=path, timestamp_col="ingest_ts")
    junk = spark.createDataFrame([(None, "{}", dt.datetime(2024, 1, 1, 12)), ("3", "{bad", dt.datetime(2024, 1, 1, 12))],
                                 "key string, value string, timestamp timestamp_ntz")
    junk.write.mode("append").parquet(path)
    now_ms = int(dt.datetime(2024, 1, 1, 13, tzinfo=dt.timezone.utc).timestamp() * 1000)
    got = R.scan_snapshots_bounded(spark, now_ms, 90, fmt="parquet", path=path).collect()
    assert [(r.link_id, r.data_as_of, r.current_congestion) for r in got] == [("1", dt.datetime(2024, 1, 1, 12), 1)]


def test_materialize_checkpoint(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    m = materialize(df)
    assert m.count() == 10 and m.agg(F.sum("x")).head()[0] == 90


def test_json_list_roundtrip(spark, scratch):
    path = os.path.join(scratch, "active")
    ids = spark.createDataFrame([("3",), ("1",), ("2",), ("1",)], "link_id string")
    K.write_json_list(ids, path)
    assert sorted(r.link_id for r in R.scan_json_list(spark, path).collect()) == ["1", "2", "3"]
