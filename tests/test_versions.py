"""Tables that are replaced at once: failed, killed and concurrent writes."""

import datetime as dt
import os
import threading

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from roadlake.plans import months as M
from roadlake.sources import readers as R
from roadlake.sources import versions as V
from roadlake.sources import writers as K

SILVER = "link_id string, data_as_of timestamp_ntz, speed double"


def silver(spark, n, value, fail=False):
    """``n`` rows of January; with ``fail`` the last task of the write raises after the others have written."""
    rows = spark.range(0, n, 1, 4).select(F.concat(F.lit("l"), F.col("id") % 7).alias("link_id"),
                                          F.timestamp_add("MINUTE", F.col("id") * 5, F.lit("2024-01-03").cast("timestamp_ntz")).alias("data_as_of"),
                                          F.lit(float(value)).alias("speed"))
    if fail:
        rows = rows.withColumn("speed", F.when(F.spark_partition_id() == 3, F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("speed")))
    return rows


def month_columns(df):
    return df.withColumn("year", F.year("data_as_of")).withColumn("month", F.month("data_as_of"))


WRITES = {
    "K1": (lambda df, root: K.write_bronze_month(df, root, 2024, 1)),
    "K3": (lambda df, root: K.write_silver(df, root, "2024-01")),
    "K4": (lambda df, root: K.write_gold(month_columns(df), root, partitions=4)),
    "K4 months": (lambda df, root: K.replace_gold_months(month_columns(df), root, partitions=4)),
    "K5": (lambda df, root: K.write_lookup(df, root)),
}


def state(spark, root):
    t = R.scan_table(spark, root)
    return t.count(), {r.speed for r in t.select("speed").distinct().collect()}


@pytest.mark.parametrize("name", WRITES)
def test_a_write_that_fails_or_is_killed_leaves_the_old_rows(spark, scratch, monkeypatch, name):
    root, write = os.path.join(scratch, "t"), WRITES[name]
    write(silver(spark, 100, 1), root)
    assert state(spark, root) == (100, {1.0})
    with pytest.raises(Exception, match="lost"):
        write(silver(spark, 200, 2, fail=True), root)
    assert state(spark, root) == (100, {1.0})
    held = R.scan_table(spark, root)

    def killed(*a):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:  # all data is written, the pointer is not
        m.setattr(V, "switch", killed)
        with pytest.raises(KeyboardInterrupt):
            write(silver(spark, 300, 3), root)
    assert state(spark, root) == (100, {1.0})
    write(silver(spark, 40, 4), root)
    assert state(spark, root) == (40, {4.0})
    assert held.count() == 100  # a reader that had begun still has its files
    assert V.vacuum(spark, root) == 0 and V.vacuum(spark, root, keep_hours=-1) in (2, 3)  # a build can fail before it writes
    assert state(spark, root) == (40, {4.0})


def test_units_stand_side_by_side(spark, scratch):
    root = os.path.join(scratch, "t")
    for m, n in ((1, 10), (2, 20), (1, 30)):
        K.write_silver(silver(spark, n, m), root, f"2024-0{m}")
    t = R.scan_table(spark, root)
    assert t.count() == 50 and set(t.columns) == {"link_id", "data_as_of", "speed", "source_month", "year", "month"}
    plan = t.where("year = 2024 and month = 1").select("link_id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert K.write_silver(silver(spark, 0, 1), root, "2024-01") is None  # nothing valid any more
    assert R.scan_table(spark, root).count() == 20
    assert K.write_silver(silver(spark, 0, 1), root, "2024-02") is None
    with pytest.raises(AnalysisException):
        R.scan_table(spark, root)
    assert not R.partition_exists(spark, root)


def test_writers_at_once_lose_nothing(spark, scratch):
    root, failed = os.path.join(scratch, "t"), []

    def write(k):
        try:
            K.write_bronze_month(silver(spark, 10 + k, k), root, 2024, k)
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(1, 9)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and R.scan_table(spark, root).count() == sum(10 + k for k in range(1, 9))
    assert V.pointer(spark, root)[0] == 8


def test_plain_folders_are_not_hidden(spark, scratch):
    root = os.path.join(scratch, "t")
    month_columns(silver(spark, 10, 1)).write.partitionBy("year", "month").parquet(root)
    assert R.scan_table(spark, root).count() == 10
    with pytest.raises(ValueError, match="no pointer names"):
        K.replace_gold_months(month_columns(silver(spark, 5, 2)), root)
    assert R.scan_table(spark, root).count() == 10
    K.write_gold(month_columns(silver(spark, 5, 2)), root)  # as a whole
    assert state(spark, root) == (5, {2.0})


def test_pointers_are_few(spark, scratch):
    for k in range(30):
        V.switch(spark, scratch, lambda units, k=k: {"n": {"k": k}})
    assert V.pointer(spark, scratch) == (30, {"n": {"k": 29}}) and len(V._numbers(spark, scratch)) == V.KEPT_POINTERS


def test_a_failed_redo_is_due_again(spark, scratch, monkeypatch):
    """The old rows stay readable, the ledger has no hole, and the next run does the month."""
    active = spark.createDataFrame([("a",), ("b",)], "link_id string")
    holidays = spark.createDataFrame([("2024-01-01",)], "holiday_date string")
    times = [dt.datetime(2024, 1, 1, 6) + dt.timedelta(hours=9 * k) for k in range(150)]
    raw = spark.createDataFrame([("ab"[k % 2], "B", "n", "40.5", t) for k, t in enumerate(times)],
                                "link_id string, borough string, link_name string, speed string, ts timestamp_ntz") \
        .withColumn("data_as_of", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
    bronze, tidy, led, led2 = (os.path.join(scratch, x) for x in ("bronze", "silver", "ledger-b", "ledger-s"))
    months = [(2024, 1), (2024, 2)]
    assert list(M.land_months(raw, months, bronze, led, ts="ts")) == ["2024-01", "2024-02"]
    clean = lambda **k: M.clean_months(spark, bronze, months, active, holidays, tidy, led2, **k)
    first = clean()
    before = R.scan_table(spark, tidy).count()
    real = M.silver_clean
    broken = lambda *a: real(*a).withColumn("speed", F.raise_error(F.lit("lost")).cast("double"))
    with monkeypatch.context() as m:
        m.setattr(M, "silver_clean", broken)
        with pytest.raises(Exception, match="lost"):
            clean(redo=[(2024, 1)])
    assert R.scan_table(spark, tidy).count() == before and M.finished(spark, led2) == {"2024-02"}
    assert clean() == {"2024-01": first["2024-01"]} and clean() == {}
    assert R.scan_table(spark, tidy).count() == before
