"""Forests that score blocks of rows: the same numbers as MLlib's own transform, for every row and every model."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catalog import stored
from roadlake import settings as S
from roadlake.operators.forest import with_predictions
from roadlake.operators.ml import build_pipeline, save_model


def frame_of(spark, rows=900, seed=1):
    """Rows whose label follows link, hour and ratio; the last column of a kind is constant."""
    def digit(k, n):
        return F.pmod(F.xxhash64("id", F.lit(seed * 100 + k)), F.lit(n))

    wide = {"link_id": digit(0, 9).cast("string"), "borough": F.when(digit(1, 3) == 0, "x").otherwise("y"),
            "hour": digit(2, 24).cast("double"), "split": F.when(digit(3, 3) == 0, "train").otherwise("test")}
    for k, c in enumerate(c for c in S.NUMERIC_FEATURES if c not in wide):
        wide[c] = (digit(4 + k, 50) / 40).cast("double") if "ratio" in c else digit(4 + k, 3).cast("double")
    label = F.pmod(F.col("link_id").cast("long") + F.floor(F.col("hour") / 5) + F.floor(F.col("speed_ratio") * 4) + F.floor(F.col("past_speed_ratio_15min") * 3), F.lit(3))
    return spark.range(rows).withColumns(wide).withColumn(S.LABEL_COL, label.cast("double")).drop("id")


@pytest.fixture(scope="module")
def fitted(spark):
    frame = frame_of(spark).cache()
    train = frame.withColumn("class_weight", F.when(F.col(S.LABEL_COL) == 1, 1.7).otherwise(0.9))
    return frame, train, build_pipeline(numTrees=12, maxDepth=7, maxBins=40).fit(train)


def odd_rows(spark, frame, model):
    """All rows, and these with values that the model has not met, null, NaN, beyond all thresholds or exactly on one."""
    text = "".join(t.toDebugString for t in model.stages[-1].trees)
    edge = float(text.split("(feature 7 <= ")[1].split(")")[0])  # speed_ratio
    odd = frame.limit(60)
    parts = [frame, odd.withColumn("link_id", F.lit("new")), odd.withColumn("link_id", F.lit(None).cast("string")), odd.withColumn("borough", F.lit("")),
             odd.withColumns({c: F.lit(None).cast("double") for c in ("speed_ratio", "hour")}), odd.withColumn("past_speed_ratio_15min", F.lit(float("nan"))),
             odd.withColumn("speed_ratio", F.lit(float("-inf"))), odd.withColumn("speed_ratio", F.lit(float("inf"))), odd.withColumn("speed_ratio", F.lit(edge)),
             odd.withColumn("speed_ratio", F.lit(edge) + F.lit(1e-15)), odd.withColumn("hour", F.lit(-0.0))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.repartition(3)


def unlike(scored, model, name):
    """Rows, and those whose numbers differ from the model's own."""
    said = F.struct(F.col("prediction"), vector_to_array("probability").alias("probability"))
    own = model.transform(scored).select(F.col(name).alias("block"), said.alias("own"))
    return tuple(own.agg(F.count(F.lit(1)), F.count_if(~F.col("block").eqNullSafe(F.col("own")))).first())


def test_blocks_predict_what_the_model_predicts(spark, fitted, scratch):
    frame, train, model = fitted
    rows, again = odd_rows(spark, frame, model), save_model(model, f"{scratch}/model")
    other = build_pipeline(numTrees=9, maxDepth=3, maxBins=32, seed=7).fit(train)
    scored = with_predictions(rows, first=model, second=again, third=other)
    assert scored.columns == [*frame.columns, "first", "second", "third"]
    assert with_predictions(rows.limit(0), first=model).count() == 0
    for m, name in ((model, "first"), (again, "second"), (other, "third")):
        assert unlike(scored, m, name) == (1500, 0)
    assert scored.where(F.col("first") != F.col("second")).count() == 0
    assert scored.where(F.col("first") != F.col("third")).count() > 700
    assert scored.select("first.prediction").distinct().count() == 3


def test_numbers_of_other_types_and_several_columns_in_an_indexer(spark, fitted):
    from pyspark.ml.feature import StringIndexer
    from roadlake.operators.ml import assembler, forest
    frame, train, _ = fitted
    kinds = {"hour": "int", "is_weekend": "boolean", "month": "decimal(6,2)", "link_id": "long"}
    cast = {c: F.col(c).cast(t) for c, t in kinds.items()}
    both = StringIndexer(inputCols=list(S.CATEGORICAL_FEATURES), outputCols=[f"{c}_idx" for c in S.CATEGORICAL_FEATURES], handleInvalid="keep")
    model = Pipeline(stages=[both, assembler(), forest(numTrees=5, maxDepth=5, maxBins=40)]).fit(train.withColumns(cast))
    scored = with_predictions(frame.withColumns(cast), said=model)
    assert "ArrowEvalPython" in scored._jdf.queryExecution().executedPlan().toString()
    assert unlike(scored, model, "said") == (900, 0)


def test_a_model_of_another_make_scores_by_itself(spark, fitted):
    frame, _, model = fitted
    moved = model.stages[-1].copy()
    moved.setThresholds([0.2, 0.9, 0.4])
    moved = PipelineModel([*model.stages[:-1], moved])
    scored = with_predictions(frame, first=model, second=moved)
    assert scored.columns == [*frame.columns, "first", "second"]
    assert unlike(scored, model, "first") == unlike(scored, moved, "second") == (900, 0)
    assert scored.where(F.col("first.prediction") != F.col("second.prediction")).count() > 0
    assert scored.where(F.col("first.probability") != F.col("second.probability")).count() == 0


def test_save_model_scores_every_row_with_both_models(spark, fitted, monkeypatch):
    """no tree is walked row by row, neither model is left out, and another model read back shows."""
    frame, train, model = fitted
    rows = {r["split"]: r["count"] for r in frame.groupBy("split").count().collect()}
    monkeypatch.setattr(stored, "_forest", lambda *_: (frame, model))
    same = stored.q_save_model(spark, "none")
    assert {r["split"]: (r["rows"], r["different"]) for r in same.collect()} == {k: (n, 0) for k, n in rows.items()}
    plan = same._jdf.queryExecution().optimizedPlan().toString()
    assert "UDF(" not in plan and plan.count("score_first(") == 1 and plan.count("score_second(") == 1
    other = build_pipeline(numTrees=12, maxDepth=7, maxBins=40, seed=5).fit(train)
    monkeypatch.setattr(stored, "save_model", lambda *_: other)
    unequal = {r["split"]: r for r in stored.q_save_model(spark, "none").collect()}
    assert {k: r["rows"] for k, r in unequal.items()} == rows and all(r["different"] > r["rows"] // 2 for r in unequal.values())
