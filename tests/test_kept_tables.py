"""Stage tables of the catalog follow their input folder."""

import os
import shutil

from catalog import tables as T

SF = "/root/testdata/sf0.001"


def test_changed_input_makes_stage_tables_anew(spark, scratch):
    shutil.copyfile(f"{SF}/events.parquet", os.path.join(scratch, "events.parquet"))  # the table is read-only, its copy is not
    first = T.silver(spark, scratch).count()
    assert first == T.silver(spark, scratch).count() == T.silver(spark, SF).count()
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.where("event_id % 2 = 0").coalesce(1).write.parquet(os.path.join(scratch, "half"))
    half = next(n for n in os.listdir(os.path.join(scratch, "half")) if n.endswith(".parquet"))
    shutil.copyfile(os.path.join(scratch, "half", half), os.path.join(scratch, "events.parquet"))
    assert 0 < T.silver(spark, scratch).count() < first


def test_no_event_is_lost_to_malformed_copies(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    rows = T.bronze(spark, SF)
    assert rows.where("speed <> 'n/a' and data_as_of <> 'not a time'").count() == events.count() < rows.count()


def test_dense_series_keeps_every_line(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    dense = T.dense_silver(spark, SF)
    assert dense.count() == lines and dense.select("link_id", "data_as_of_utc").distinct().count() == lines
