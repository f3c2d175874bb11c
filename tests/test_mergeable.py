"""As-of joins of two tables, co-moments, sketches and sliced ranking against brute force and SQL."""

import datetime as dt
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from roadlake.operators import aggregates as G
from roadlake.operators import metrics as M
from roadlake.operators import ml
from roadlake.operators.asof import asof_join

T0 = dt.datetime(2024, 3, 1)


def two_tables(spark, seed, n=300, hot=0.0):
    rng = random.Random(seed)
    link = lambda: "hot" if rng.random() < hot else rng.choice(["a", "b", "c", "only-left"])
    at = lambda: T0 + dt.timedelta(minutes=rng.randint(0, 4000))
    left = [(link(), at(), k) for k in range(n)] + [(None, at(), n), ("a", None, n + 1)]
    right = [(rng.choice(["a", "b", "c", "hot", "only-right"]), at(), k, k * 1.5) for k in range(n)] + [(None, at(), n, 0.0), ("b", None, n + 1, 0.0)]
    return (left, right, spark.createDataFrame(left, "link_id string, data_as_of timestamp_ntz, lid long"),
            spark.createDataFrame(right, "link_id string, data_as_of timestamp_ntz, rid long, v double"))


def plain_asof(left, right, direction, within):
    out = []
    for link, t, lid in left:
        fits = [(rt, rid) for rl, rt, rid, _ in right if link is not None and t is not None and rl == link and rt is not None]
        gap = lambda x: abs((x[0] - t).total_seconds())
        back = max((x for x in fits if x[0] <= t), key=lambda x: (x[0], -x[1]), default=None)
        forth = min((x for x in fits if x[0] >= t), default=None)
        back, forth = (x if x is not None and (within is None or gap(x) <= within * 60) else None for x in (back, forth))
        both = [x for x in (back, forth) if x is not None]
        pick = {"backward": back, "forward": forth, "nearest": min(both, key=lambda x: (gap(x), x[0], x[1]), default=None)}[direction]
        out.append((lid, None if pick is None else pick[1]))
    return sorted(out)


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("hours,within,hot", [(24.0, None, 0.0), (1.0, 45, 0.5), (0.05, None, 0.3)])
def test_asof_join(spark, direction, hours, within, hot):
    left, right, lf, rf = two_tables(spark, 3, hot=hot)
    got = asof_join(lf, rf, ["rid", "v"], direction=direction, within_minutes=within, tie="rid", bucket_hours=hours)
    assert got.columns == ["link_id", "data_as_of", "lid", "match"]
    assert sorted((r.lid, None if r.match is None else r.match.rid) for r in got.collect()) == plain_asof(left, right, direction, within)


def test_asof_join_equals_duckdb_asof(spark):
    left, right, lf, rf = two_tables(spark, 9)
    once = rf.groupBy("link_id", "data_as_of").agg(F.min("rid").alias("rid"))
    con = duckdb.connect()
    con.register("l", lf.toPandas())
    con.register("r", once.toPandas())
    expected = con.execute("SELECT l.lid, r.rid FROM l ASOF LEFT JOIN r ON l.link_id = r.link_id AND l.data_as_of >= r.data_as_of").fetchall()
    got = asof_join(lf, rf, ["rid"], tie="rid").select("lid", "match.rid")
    assert sorted(map(tuple, got.collect())) == sorted((int(a), None if b is None or (isinstance(b, float) and math.isnan(b)) else int(b)) for a, b in expected)


def test_asof_join_spreads_a_hot_link(spark):
    rows = spark.range(40_000).select(F.lit("hot").alias("link_id"), F.timestamp_add("MINUTE", F.col("id"), F.lit(T0)).alias("data_as_of"), F.col("id").alias("rid"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = asof_join(rows.withColumnRenamed("rid", "lid"), rows, ["rid"], bucket_hours=6)
        assert got.where("match.rid = lid").count() == 40_000
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert max(sizes) < 30_000
    assert asof_join(rows.limit(0), rows, ["rid"]).count() == 0
    assert asof_join(rows.limit(5).withColumnRenamed("rid", "lid"), rows.limit(0), ["rid"]).where("match is null").count() == 5


def frame(spark, n=4000, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)) * [1, 1e-2, 50, 1] + [0, 1e4, -3, 7]
    x[:, 2] += 40 * x[:, 0]
    x[:, 3] = 7.0
    rows = [(*map(float, r), int(k) % 3) for k, r in enumerate(x)]
    rows += [(None, 1.0, 2.0, 7.0, 0), (float("nan"), 1.0, 2.0, 7.0, 1)]
    return x, spark.createDataFrame(rows, "a double, b double, c double, d double, g int").repartition(7)


def test_co_moments_are_lazy_exact_and_mergeable(spark):
    x, df = frame(spark)
    sc = spark.sparkContext
    sc.setJobGroup("moments", "must stay empty")
    try:
        out = M.correlation_matrix(df, ["a", "b", "c", "d"], 9)
        out._jdf.queryExecution().optimizedPlan()
        M.label_correlation_rank(df, ["a", "b", "d"], "c")._jdf.queryExecution().optimizedPlan()
        assert list(sc.statusTracker().getJobIdsForGroup("moments")) == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    expected = np.corrcoef(x[:, :3].T)
    got = {(r.feature_a, r.feature_b): r.corr for r in out.collect()}
    for i, a in enumerate("abc"):
        for j, b in enumerate("abc"):
            assert abs(got[a, b] - expected[i, j]) < 1e-8
    assert all(got["d", b] is None and got[b, "d"] is None for b in "abcd") and len(got) == 16
    assert [(r.feature, r["rank"]) for r in M.label_correlation_rank(df, ["a", "b", "d"], "c").orderBy("rank").collect()][0] == ("a", 1)
    # months stored apart and merged: any choice of them, without their rows
    parts = M.co_moments(df, ["a", "b", "c"], ["g"]).cache()
    assert parts.count() == 3
    some = M.merge_co_moments(parts.where("g < 2")).first()
    rows = x[np.arange(len(x)) % 3 < 2][:, :3]
    assert some.n == len(rows) and np.allclose(some.mean, rows.mean(axis=0)) and np.allclose(np.array(some.c).reshape(3, 3), np.cov(rows.T, bias=True) * len(rows), rtol=1e-8)
    assert M.correlation_matrix(df.limit(0), ["a", "b"]).count() == 0


def test_sketched_links(spark):
    df = spark.range(200_000).select((F.col("id") % 30_000).cast("string").alias("link_id"), (F.col("id") % 7).alias("hour"))
    stored = G.link_sketches(df, [F.col("hour")]).cache()
    assert stored.count() == 7
    for hours in ([0], [0, 3], list(range(7))):
        exact = df.where(F.col("hour").isin(hours)).agg(F.count_distinct("link_id")).first()[0]
        r = G.sketched_links(stored.where(F.col("hour").isin(hours))).first()
        assert abs(r.distinct_links / exact - 1) < 4 * 1.04 / math.sqrt(2**G.LG_K) and r.ready
        assert r.rows == df.where(F.col("hour").isin(hours)).count()
    none = G.sketched_links(stored.limit(0)).first()
    assert (none.distinct_links, none.rows, none.ready) == (0, 0, False)


def test_incremental_speeds(spark):
    """The percentile of any months from stored cells, refined to the exact value."""
    rng = np.random.default_rng(5)
    rows = [(f"l{k % 4}", int(k) % 5, float(v)) for k, v in enumerate(rng.gamma(4, 10, 5000).clip(0, 99.9))] + [("l0", 0, None), ("one", 2, 33.0)]
    df = spark.createDataFrame(rows, "link_id string, month int, speed double").cache()
    stored = G.speed_sketches(df, [F.col("month")]).cache()
    assert stored.groupBy("link_id", "month").count().agg(F.max("count")).first()[0] <= 400
    for months in ([0], [1, 2], [0, 1, 2, 3, 4]):
        own, cells = df.where(F.col("month").isin(months)), stored.where(F.col("month").isin(months))
        bracket = G.sketched_speed(cells)
        exact = {}
        for link in {r[0] for r in rows}:
            v = sorted(r[2] for r in rows if r[0] == link and r[1] in months and r[2] is not None)
            if v:
                exact[link] = v[max(0, math.ceil(0.85 * len(v)) - 1)]
        got = {r.link_id: (r.low, r.high, r.n) for r in bracket.collect()}
        assert set(got) == set(exact) and all(got[k][0] <= exact[k] < got[k][1] for k in exact)
        assert {r.link_id: r.free_flow_speed for r in G.refined_speed(own, bracket).collect()} == exact


@pytest.mark.parametrize("accuracy", [10, 100])
def test_ranks_of_one_hot_key_are_spread(spark, accuracy):
    """A low accuracy and one key: the bracket holds a large share of the rows, no task holds the bracket."""
    n = 60_000
    df = spark.range(n).select(F.lit("hot").alias("link_id"), F.pmod(F.xxhash64("id"), F.lit(1 << 40)).cast("double").alias("speed")).cache()
    values = sorted(r.speed for r in df.collect())
    ranks = {"p": (0.85, F.ceil(F.lit(0.85) * F.col("_n")) - 1), "m": (0.5, F.floor(F.lit(0.5) * (F.col("_n") - 1)))}
    got = G.ranked_values(df, ["link_id"], "speed", ranks, accuracy).first()
    assert (got.p, got.m) == (values[math.ceil(0.85 * n) - 1], values[(n - 1) // 2])
    same = spark.createDataFrame([("k", 5.0)] * 50 + [("k", float("inf")), ("k", None), ("z", 1.0)], "link_id string, speed double")
    got = {r.link_id: r.p for r in G.ranked_values(same, ["link_id"], "speed", {"p": (0.85, F.ceil(F.lit(0.85) * F.col("_n")) - 1)}, 2).collect()}
    assert got == {"k": 5.0, "z": 1.0}


def test_forest_with_many_links(spark):
    """100,000 links: a target statistic per link, the forest at its usual number of bins, and better than chance."""
    from roadlake import settings as S
    n = 100_000
    base = spark.range(n * 2).select((F.col("id") % n).cast("string").alias("link_id"), F.concat(F.lit("b"), F.col("id") % 5).alias("borough"),
                                     (F.col("id") % n % 3).cast("double").alias(S.LABEL_COL), F.lit(1.0).alias("class_weight"),
                                     *[(F.pmod(F.xxhash64("id", F.lit(c)), F.lit(100)) / 100).alias(c) for c in S.NUMERIC_FEATURES])
    stats = ml.target_statistics(base, weight=1.0)
    assert stats.where("feature = 'link_id'").count() == n + 1
    train = ml.with_target_statistics(base, stats)
    model = ml.many_links_pipeline(numTrees=5, maxDepth=4).fit(train)
    hit = model.transform(train.sample(0.05, 1)).agg(F.avg((F.col("prediction") == F.col(S.LABEL_COL)).cast("int"))).first()[0]
    assert hit > 0.7  # one of three by chance
    new = ml.with_target_statistics(spark.createDataFrame([("never met", None)], "link_id string, borough string"), stats).first()
    assert abs(new.link_id_stat - 1.0) < 0.01 and abs(new.borough_stat - 1.0) < 0.01


def test_forest_beats_the_persistence_forecast(spark):
    """A series whose class follows the hour: the forest learns it, the last class does not; importances add up to 1."""
    from roadlake import settings as S
    from roadlake.operators.ml import build_pipeline, feature_importance
    from roadlake.plans.training import evaluate
    rng = np.random.default_rng(3)
    rows = []
    for k in range(3000):
        hour = int(rng.integers(0, 24))
        label = float(0 if hour < 8 else 1 if hour < 16 else 2)
        now = int((label + (rng.random() < 0.4)) % 3)  # the present class is often another
        values = {c: float(rng.random()) for c in S.NUMERIC_FEATURES} | {"hour": float(hour), "current_congestion": float(now)}
        rows.append((f"l{k % 9}", f"b{k % 3}", *(values[c] for c in S.NUMERIC_FEATURES), label, 1.0))
    schema = "link_id string, borough string, " + ", ".join(f"{c} double" for c in S.NUMERIC_FEATURES) + f", {S.LABEL_COL} double, class_weight double"
    frame_ = spark.createDataFrame(rows, schema).withColumn("n", F.monotonically_increasing_id())
    train, held = frame_.where("n % 3 > 0"), frame_.where("n % 3 = 0")
    model = build_pipeline(numTrees=10, maxDepth=6, maxBins=64).fit(train)
    f1 = evaluate(model, held)["macro_f1"].first().macro_f1
    pairs = held.select(F.col(S.LABEL_COL).alias("actual"), F.col("current_congestion").alias("predicted")).collect()
    scores = []
    for c in (0.0, 1.0, 2.0):
        tp = sum(r.actual == c == r.predicted for r in pairs)
        wrong = sum((r.actual == c) != (r.predicted == c) for r in pairs)
        scores.append(2 * tp / (2 * tp + wrong))
    assert f1 > 0.9 > sum(scores) / 3
    imp = feature_importance(model).collect()
    assert abs(sum(r.importance for r in imp) - 1) < 1e-9 and [r.feature for r in imp if r["rank"] == 1] == ["hour"]
