"""Operators on literal frames, and the split-series windows against brute force."""

import datetime as dt
import math
import random

from pyspark.sql import functions as F

from roadlake import settings as S
from roadlake.operators import aggregates as G
from roadlake.operators import filters as P
from roadlake.operators import windows as W
from roadlake.operators.asof import asof_lags
from roadlake.operators.joins import enrich_free_flow, join_holiday, lookup_inner

T0 = dt.datetime(2024, 1, 1)


def test_valid_speed_active_and_missing(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 100.0), ("a", 50.0), ("b", -1.0), ("c", None), ("d", 99.9)],
                               "link_id string, speed double")
    active = spark.createDataFrame([("a",), ("d",), ("z",)], "id string")
    kept = P.filter_active_links(P.filter_valid_speed(df), active)
    assert sorted(tuple(r) for r in kept.collect()) == [("a", 50.0), ("d", 99.9)]
    miss = P.missing_links(active, kept)
    assert [r.link_id for r in miss.collect()] == ["z"]


def test_time_split_and_dedupe(spark):
    df = spark.createDataFrame([("a", 2024, 3), ("a", 2025, 9), ("b", 2025, 11), ("b", 2026, 1), ("c", 2023, 12)],
                               "link_id string, year int, month int")
    got = {(r.link_id, r.year): r.split for r in P.time_split(df).collect()}
    assert got == {("a", 2024): "train", ("a", 2025): "train", ("b", 2025): "val", ("b", 2026): "test",
                   ("c", 2023): None}
    d = P.dedupe_by_key(df, "link_id", order=["year", "month"])
    assert sorted(tuple(r) for r in d.collect()) == [("a", 2024, 3), ("b", 2025, 11), ("c", 2023, 12)]


def test_month_range_filter_december(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 11, 30, 23, 59),), (dt.datetime(2024, 12, 1),),
                                (dt.datetime(2024, 12, 31, 23, 59, 59),), (dt.datetime(2025, 1, 1),)],
                               "data_as_of timestamp_ntz")
    assert P.month_range_filter(df, 2024, 12).count() == 2
    cal = P.month_calendar(spark, "2024-11-15", "2025-02-01").collect()
    assert [(r.year, r.month) for r in cal] == [(2024, 11), (2024, 12), (2025, 1), (2025, 2)]


def brute_p85(values):
    v = sorted(values)
    return v[max(1, math.ceil(0.85 * len(v))) - 1]


def test_free_flow_exact_matches_brute_force(spark):
    rng = random.Random(7)
    rows = []
    for link in range(12):
        n = rng.randint(1, 60)
        for i in range(n):
            rows.append((str(link), float(rng.randint(1, 40)), T0 + dt.timedelta(minutes=i), f"b{link}", f"n{link}"))
    rows.append(("0", None, T0, "x", "y"))
    df = spark.createDataFrame(rows, "link_id string, speed double, data_as_of timestamp_ntz, borough string, link_name string")
    got = {r.link_id: r.free_flow_speed for r in G.free_flow_lookup(df).collect()}
    approx = {r.link_id: r.free_flow_speed for r in G.free_flow_lookup(df, method="approx", accuracy=100000).collect()}
    coarse = {r.link_id: r.free_flow_speed for r in G.free_flow_lookup(df, accuracy=4).collect()}
    assert coarse == got
    for link in range(12):
        vals = [r[1] for r in rows if r[0] == str(link) and r[1] is not None]
        assert got[str(link)] == brute_p85(vals)
        assert approx[str(link)] == brute_p85(vals)


def test_enrich_and_lookup_inner(spark):
    silver = spark.createDataFrame([("a", 50.0, "x"), ("b", 10.0, ""), ("c", 10.0, None)],
                                   "link_id string, speed double, link_name string")
    lookup = spark.createDataFrame([("a", 100.0, "B1", "A"), ("b", 0.0, "B2", "BB"), ("c", 20.0, "B3", "CC")],
                                   "link_id string, free_flow_speed double, borough string, link_name string")
    e = {r.link_id: (r.speed_ratio, r.current_congestion) for r in enrich_free_flow(silver, lookup).collect()}
    assert e == {"a": (0.5, 1), "b": (None, None), "c": (0.5, 1)}
    inner = {r.link_id: (r.borough, r.link_name) for r in lookup_inner(silver, lookup).collect()}
    assert inner == {"a": ("B1", "x"), "c": ("B3", "CC")}


def test_join_holiday(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 7, 4, 23),), (dt.datetime(2024, 7, 5, 0),)], "data_as_of timestamp_ntz")
    h = spark.createDataFrame([("2024-07-04",), ("2024-07-04",)], "holiday_date string")
    assert [r.is_holiday for r in join_holiday(df, h).orderBy("data_as_of").collect()] == [1, 0]


def _series(rng, links=4, n=120, hot=None):
    rows = []
    for link in range(links):
        t = T0
        for i in range(n * (5 if link == hot else 1)):
            step = rng.choice([5] * 30 + [4, 6, 20, 60])
            t = t + dt.timedelta(minutes=step, seconds=rng.randint(-15, 15))
            ratio = rng.choice([0.3, 0.5, 0.9, 1.1])
            rows.append((str(link), t, 50.0 * ratio, ratio))
    return rows


def _brute_gold(rows, params=S.GoldParams()):
    out = set()
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    cls = lambda x: 0 if x >= 0.67 else (1 if x >= 0.4 else 2)
    for link, seq in by.items():
        seq.sort(key=lambda r: (r[1], r[2]))
        secs = [int(r[1].timestamp()) for r in seq]  # naive -> local tz, differences only
        for i, r in enumerate(seq):
            ok = True
            if i + params.lead_rows >= len(seq):
                continue
            g = (secs[i + params.lead_rows] - secs[i]) / 60
            lo, hi = params.lead_tolerance
            ok &= lo <= g <= hi
            for m, k in params.lag_rows.items():
                if i - k < 0:
                    ok = False
                    break
                g = (secs[i] - secs[i - k]) / 60
                lo, hi = params.lag_tolerance[m]
                ok &= lo <= g <= hi
            if ok:
                out.add((link, r[1], cls(seq[i + params.lead_rows][3]), cls(seq[i - 12][3])))
    return out


def test_gold_features_split_series_equals_single_window(spark):
    rng = random.Random(3)
    rows = _series(rng, hot=0)
    df = spark.createDataFrame(rows, "link_id string, data_as_of_utc timestamp_ntz, speed double, speed_ratio double")
    df = df.withColumn("current_congestion", F.expr(
        "CAST(CASE WHEN speed_ratio >= 0.67 THEN 0 WHEN speed_ratio >= 0.40 THEN 1 ELSE 2 END AS INT)"))
    expected = _brute_gold(rows)
    assert len(expected) > 10
    for bucket_hours in (24.0, 0.5):  # tiny buckets force many halo copies
        params = S.GoldParams(bucket_hours=bucket_hours)
        got = W.gold_features(df, params, ts="data_as_of_utc", tie=("speed",))
        got = {(r.link_id, r.data_as_of_utc, r[S.LABEL_COL], r.past_congestion_60min) for r in got.collect()}
        assert got == expected


def _brute_asof(rows, ref, m, lo, hi, locf=15):
    target = ref - dt.timedelta(minutes=m)
    cands = [r for r in rows if ref - dt.timedelta(minutes=hi) <= r[1] <= ref - dt.timedelta(minutes=lo)]
    if cands:
        return min(cands, key=lambda r: (abs((r[1] - target).total_seconds()), r[1], r[4]))[4]
    before = [r for r in rows if r[1] <= target]
    if not before:
        return None
    best = max(before, key=lambda r: (r[1], -r[4]))
    return best[4] if (target - best[1]).total_seconds() / 60 <= 15 else None


def test_asof_lags_match_brute_force(spark):
    rng = random.Random(11)
    rows = [(r[0], r[1], r[2], r[3], i) for i, r in enumerate(_series(rng, links=3, n=80, hot=1))]
    # exact-target and equal-distance cases
    rows.append(("9", T0 + dt.timedelta(minutes=100), 1.0, 0.5, 10_001))
    rows.append(("9", T0 + dt.timedelta(minutes=85), 1.0, 0.5, 10_002))
    rows.append(("9", T0 + dt.timedelta(minutes=80), 1.0, 0.5, 10_003))
    rows.append(("9", T0 + dt.timedelta(minutes=90), 1.0, 0.5, 10_004))
    df = spark.createDataFrame(rows, "link_id string, data_as_of timestamp_ntz, speed double, speed_ratio double, eid long")
    for bucket_hours in (24.0, 1.0):
        got = asof_lags(df, ["eid"], tie="eid", params=S.ServingParams(bucket_hours=bucket_hours))
        res = {r.eid: tuple(r[f"lag_{m}"].eid if r[f"lag_{m}"] else None for m in S.LAG_TOLERANCE)
               for r in got.collect()}
        for r in rows:
            link_rows = [x for x in rows if x[0] == r[0]]
            exp = tuple(_brute_asof(link_rows, r[1], m, lo, hi) for m, (lo, hi) in S.LAG_TOLERANCE.items())
            assert res[r[4]] == exp, (r, res[r[4]], exp)


def test_change_detect_aba_and_buckets(spark):
    base = dt.datetime(2024, 1, 1)
    vals = ["A", "A", "B", "A", "A", "C", "C"]
    rows = [("x", base + dt.timedelta(hours=5 * i), i, v) for i, v in enumerate(vals)]
    rows += [("y", base + dt.timedelta(hours=i), i, "Q") for i in range(3)]
    df = spark.createDataFrame(rows, "link_id string, ingest_ts timestamp_ntz, row_no long, v string")
    for bucket_hours in (24.0, 1.0):
        got = W.change_detect(df, value="v", bucket_hours=bucket_hours)
        seq = [r.v for r in got.filter("link_id = 'x'").orderBy("row_no").collect()]
        assert seq == ["A", "B", "A", "C"]
        assert got.filter("link_id = 'y'").count() == 1


def test_latest_per_link_tie(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", t, 2, 0.1), ("a", t, 1, 0.2), ("a", t - dt.timedelta(1), 0, 0.3)],
                               "link_id string, data_as_of timestamp_ntz, eid long, v double")
    r = W.latest_per_link(df, tie="eid").head()
    assert (r.eid, r.v) == (1, 0.2)


def test_aggregates_small(spark):
    df = spark.createDataFrame([("a", "10", "2024-01-01T00:00:00.000"), ("a", "x", "2024-01-02T00:00:00.000"),
                                ("b", None, None)], "link_id string, speed string, data_as_of string")
    q = {r.link_id: (r.total_rows, r.valid_rows) for r in G.link_quality(df).collect()}
    assert q == {"a": (2, 1), "b": (1, 0)}
    n = G.null_counts(df).head()
    assert (n.speed, n.data_as_of, n.link_id) == (1, 1, 0)
    d = G.describe_column(spark.createDataFrame([(float(i),) for i in range(1, 5)], "c double"), "c").head()
    assert (d["count"], d.mean, d.p25, d.p50, d["max"]) == (4, 2.5, 1.75, 2.5, 4.0)


def test_exact_quartiles_bracketing(spark):
    import numpy as np
    rng = random.Random(5)
    vals = [float(rng.randint(0, 300)) / 7 for _ in range(3000)] + [5.0] * 400
    df = spark.createDataFrame([(v,) for v in vals] + [(None,), (float("nan"),)], "c double")
    for acc in (20, 100_000):   # a coarse sketch leaves wide brackets
        d = G.describe_column(df, "c", digits=9, accuracy=acc).head()
        assert d["count"] == len(vals) and abs(d.mean - np.mean(vals)) < 1e-8 and abs(d.std - np.std(vals, ddof=1)) < 1e-8
        for name, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
            assert abs(d[name] - float(np.quantile(np.array(vals), q))) < 1e-8
    empty = G.describe_column(df.limit(0), "c").head()
    assert empty["count"] == 0 and empty.p50 is None


def test_hot_link_with_continuous_speeds(spark):
    """One link holds most rows, each with a speed of its own: exact, and few rows are ranked."""
    n = 40_000
    df = spark.range(n).select(F.when(F.col("id") % 10 < 8, F.lit("hot")).otherwise((F.col("id") % 7).cast("string")).alias("link_id"),
                               (F.pmod(F.xxhash64("id"), F.lit(1 << 40)) / 7.0).alias("speed"),
                               F.timestamp_add("SECOND", F.col("id").cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("data_as_of"),
                               F.lit("b").alias("borough"), F.lit("n").alias("link_name"))
    by_link = {}
    for r in df.select("link_id", "speed").collect():
        by_link.setdefault(r.link_id, []).append(r.speed)
    for accuracy in (500, 10_000):
        got = {r.link_id: r.free_flow_speed for r in G.free_flow_lookup(df, accuracy=accuracy).collect()}
        assert got == {k: brute_p85(v) for k, v in by_link.items()}
    x = df.select("link_id", "speed")
    ranked = G.ranked_values(x, ["link_id"], "speed", {"p": (0.85, F.ceil(0.85 * F.col("_n")) - 1)}, 500)
    assert {r.link_id: r["_n"] for r in ranked.collect()} == {k: len(v) for k, v in by_link.items()}


def test_hot_link_is_spread_over_tasks(spark):
    """A link holding a third of all rows must not land in one window task."""
    from roadlake.operators.skew import BUCKET, with_halo
    base = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("link_id"),
        F.timestamp_add("MINUTE", (F.col("id") / 3).cast("int") * 5, F.lit("2024-01-01").cast("timestamp_ntz"))
        .alias("data_as_of_utc"))
    hot_rows = base.filter("link_id = 'hot'").count()
    split = with_halo(base, "data_as_of_utc", 66 * 60_000_000, 21 * 60_000_000, bucket_hours=24.0)
    per_task = (split.repartition(16, "link_id", BUCKET).filter("link_id = 'hot'")
                .groupBy(F.spark_partition_id().alias("p")).count().collect())
    assert len(per_task) >= 8                         # the hot link spans most tasks
    assert max(r["count"] for r in per_task) < 0.4 * hot_rows


def test_prediction_report_odd_rows(spark):
    """Nulls, ties, an unknown class, an extra column and an empty table."""
    from roadlake.operators.quality import prediction_report
    schema = "link_id string, timestamp timestamp_ntz, predicted_congestion int, confidence double, `odd name.x` int"
    t = [dt.datetime(2024, 1, 1, h) for h in range(4)]
    rows = [("a", t[0], 0, 0.5, 1), ("b", t[3], 2, 0.75, None), ("a", t[3], 7, None, None), (None, None, None, 1.0, None), ("c", t[3], 0, 0.5, 2)]
    got = {(r.section, r.place): r for r in prediction_report(spark.createDataFrame(rows, schema), newest=3).collect()}
    assert {r.item: r.number for (s, _), r in got.items() if s == "class"} == {"0-free flow": 2, "1-congested": 0, "2-severe": 1, "other": 2}
    assert {r.item: r.number for (s, _), r in got.items() if s == "nulls"} == {
        "link_id": 1, "timestamp": 1, "predicted_congestion": 1, "confidence": 1, "odd name.x": 3}
    assert [(got["newest", k].item, got["newest", k].number) for k in (1, 2, 3)] == [("a", 7), ("b", 2), ("c", 0)] and ("newest", 4) not in got
    assert (got["summary", 1].number, got["summary", 2].number, got["summary", 3].at, got["summary", 4].at) == (5, 3, t[0], t[3])
    none = {(r.section, r.item): r for r in prediction_report(spark.createDataFrame([], schema)).collect()}
    assert none["summary", "rows"].number == 0 and none["summary", "last"].at is None and not any(s == "newest" for s, _ in none)
    assert none["confidence", "count"].number == 0 and none["confidence", "p50"].number is None
