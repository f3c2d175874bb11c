import datetime as dt

from pyspark.sql import functions as F

from roadlake import functions as RF


def one(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("x")).collect()]


def test_parse_utc_ts_strict(spark):
    got = one(spark, RF.parse_utc_ts("s"),
              [("2024-01-15T08:03:12.500",), ("2024-01-15 08:03:12.500",), ("bad",), (None,),
               ("2024-13-01T00:00:00.000",)], "s string")
    assert got == [dt.datetime(2024, 1, 15, 8, 3, 12, 500000), None, None, None, None]


def test_utc_to_local_dst_edges(spark):
    rows = [(dt.datetime(2024, 3, 10, 6, 59),), (dt.datetime(2024, 3, 10, 7, 0),),
            (dt.datetime(2024, 11, 3, 5, 30),), (dt.datetime(2024, 11, 3, 6, 30),),
            (dt.datetime(2024, 1, 1, 3, 0),)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    got = [r[0] for r in df.select(RF.utc_to_local("t")).collect()]
    assert got == [dt.datetime(2024, 3, 10, 1, 59), dt.datetime(2024, 3, 10, 3, 0),
                   dt.datetime(2024, 11, 3, 1, 30), dt.datetime(2024, 11, 3, 1, 30),
                   dt.datetime(2023, 12, 31, 22, 0)]


def test_parse_local_ts(spark):
    got = one(spark, RF.parse_local_ts("s"),
              [("01/15/2024 08:03:12",), ("07/04/2024 12:00:00",), ("2024-01-15",), ("",)], "s string")
    assert got == [dt.datetime(2024, 1, 15, 13, 3, 12), dt.datetime(2024, 7, 4, 16, 0), None, None]


def test_iso_instant_offsets(spark):
    got = one(spark, RF.parse_iso_instant("s"),
              [("2024-01-15T08:03:12-05:00",), ("2024-01-15T08:03:12",), ("2024-01-15T13:03:12Z",),
               ("2024-01-15T08:03:12.250000-05:00",), ("junk",)], "s string")
    assert got[:3] == [dt.datetime(2024, 1, 15, 13, 3, 12)] * 3
    assert got[3] == dt.datetime(2024, 1, 15, 13, 3, 12, 250000)
    assert got[4] is None


def test_json_roundtrip_keeps_instant(spark):
    df = spark.createDataFrame([("7", dt.datetime(2024, 7, 1, 12, 0, 0, 5), 1, 0.5, None)],
                               "link_id string, data_as_of timestamp_ntz, current_congestion int, "
                               "speed_ratio double, link_name string")
    enc = df.select(RF.json_encode_snapshot().alias("v"))
    text = enc.head()[0]
    assert '"data_as_of":"2024-07-01T08:00:00.000005-04:00"' in text
    back = enc.select(RF.json_decode_snapshot("v").alias("s")).select("s.*").head()
    assert back.data_as_of == dt.datetime(2024, 7, 1, 12, 0, 0, 5)
    assert back.current_congestion == 1 and back.speed_ratio == 0.5 and back.link_name is None
    bad = spark.createDataFrame([("{not json",)], "v string").select(RF.json_decode_snapshot("v")).head()[0]
    assert bad is None or all(v is None for v in bad)


def test_calendar_features_sunday_is_one(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7, 23, 30),), (dt.datetime(2024, 1, 13, 0, 0),),
                                (dt.datetime(2024, 1, 10, 9, 0),)], "t timestamp_ntz")
    got = [tuple(r) for r in df.select(*RF.calendar_features("t")).collect()]
    assert got == [(23, 1, 1, 1), (0, 7, 1, 1), (9, 4, 1, 0)]


def test_speed_ratio_and_class(spark):
    rows = [(67.0, 100.0), (66.9, 100.0), (40.0, 100.0), (39.99, 100.0), (50.0, None), (50.0, 0.0), (50.0, -3.0)]
    df = spark.createDataFrame(rows, "speed double, free_flow_speed double")
    out = df.select(RF.speed_ratio().alias("r")).select("r", RF.congestion_class("r").alias("c")).collect()
    assert [r.c for r in out] == [0, 1, 1, 2, None, None, None]
    assert out[0].r == 0.67


def test_clean_quotes_and_fallback(spark):
    df = spark.createDataFrame([('  "4616297" ', "", "lk"), ('"x"', "name", "lk"), (None, None, "lk")],
                               "a string, n string, f string")
    got = df.select(RF.clean_quotes("a"), RF.name_fallback("n", "f")).collect()
    assert [tuple(r) for r in got] == [("4616297", "lk"), ("x", "name"), (None, "lk")]


def test_parse_first_point(spark):
    rows = [("40.7,-73.9 40.8,-73.8",), (" 40.7,-73.9",), ("40.7",), ("40.7,-73.9,5",), ("a,b",), ("",), (None,),
            ("1e1,2",)]
    df = spark.createDataFrame(rows, "p string").select(RF.parse_first_point("p").alias("c"))
    got = [(r.c.lat, r.c.lon) for r in df.collect()]
    assert got == [(40.7, -73.9), (40.7, -73.9), (None, None), (None, None), (None, None), (None, None),
                   (None, None), (10.0, 2.0)]


def test_epoch_and_minutes(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 15, 0, 999999), dt.datetime(2024, 1, 1, 0, 0, 0, 1))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(RF.minutes_between("a", "b").alias("m"), RF.epoch_seconds("b").alias("s")).head()
    assert r.m == 15.0 and r.s == 1704067200


def test_confidence_and_label(spark):
    df = spark.createDataFrame([([0.1, 0.7, 0.2], 2)], "p array<double>, c int")
    r = df.select(RF.confidence("p"), RF.class_label("c")).head()
    assert r[0] == 0.7 and r[1] == "2-severe"
    assert df.select(F.lit(1)).count() == 1
