"""MLlib dataflow (M1-M8): indexers, assembler, weighted random forest, scoring."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import settings as S
from ..functions.text import confidence
from ..functions.timefn import plus_minutes


def index_labels(df: DataFrame, col: str) -> DataFrame:
    """M1 (as data): label -> index by frequency (desc), ties by value -- the order a
    frequency-ordered ``StringIndexer`` assigns.

    Labels of equal frequency are ranked among themselves; in front of them stand all labels
    of higher frequencies, summed up over the distinct frequencies (far fewer than labels:
    k of them need k * k / 2 rows).
    """
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    sizes = counts.groupBy("_n").agg(F.count(F.lit(1)).alias("_labels"))
    ahead = Window.orderBy(F.col("_n").desc()).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_n", F.coalesce(F.sum("_labels").over(ahead), F.lit(0)).alias("_ahead"))
    own = F.row_number().over(Window.partitionBy("_n").orderBy(col)) - 1
    return (counts.join(sizes, "_n").select(col, (F.col("_ahead") + own).cast("double").alias(f"{col}_idx")))


def indexers(cols=S.CATEGORICAL_FEATURES) -> list:
    """M1: unseen values keep an extra index instead of failing."""
    return [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep",
                          stringOrderType="frequencyDesc") for c in cols]


def assembler(numeric=S.NUMERIC_FEATURES, cats=S.CATEGORICAL_FEATURES) -> VectorAssembler:
    """M2."""
    return VectorAssembler(inputCols=[f"{c}_idx" for c in cats] + list(numeric),
                           outputCol="features", handleInvalid="keep")


def target_statistics(train: DataFrame, cats=S.CATEGORICAL_FEATURES, label: str = S.LABEL_COL, weight: float = 20.0) -> DataFrame:
    """M1 for many links: per category value the mean label, drawn towards the mean of all by ``weight`` rows.

    ``(feature, value, stat)``, one row per value and a row with a null value for values not
    met in training.  A plain aggregate: it grows with the values, not with the forest.
    """
    rows = train.select(F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in cats))).alias("f"),
                        F.col(label).cast("double").alias("y"))
    sums = rows.groupBy("f.feature", "f.value").agg(F.sum("y").alias("s"), F.count("y").alias("n"))
    whole = sums.groupBy("feature").agg((F.sum("s") / F.sum("n")).alias("mean"))  # one row per feature
    known = (sums.where("value is not null").join(whole, "feature")
             .select("feature", "value", ((F.col("s") + F.lit(weight) * F.col("mean")) / (F.col("n") + F.lit(weight))).alias("stat")))
    return known.unionByName(whole.select("feature", F.lit(None).cast("string").alias("value"), F.col("mean").alias("stat")))


def with_target_statistics(df: DataFrame, stats: DataFrame, cats=S.CATEGORICAL_FEATURES) -> DataFrame:
    """Adds ``<feature>_stat`` columns; values without one, and nulls, get the feature's mean.  Joins on the value, no category limit."""
    for c in cats:
        own = stats.where((F.col("feature") == c) & F.col("value").isNotNull()).select(F.col("value").alias(c), F.col("stat").alias(f"{c}_stat"))
        rest = stats.where((F.col("feature") == c) & F.col("value").isNull()).select(F.col("stat").alias("_rest"))
        df = (df.join(own, c, "left").crossJoin(F.broadcast(rest))  # one row
              .withColumn(f"{c}_stat", F.coalesce(f"{c}_stat", "_rest")).drop("_rest"))
    return df


def many_links_pipeline(weight_col: str | None = "class_weight", **forest_overrides) -> Pipeline:
    """M4 for any number of links: the forest on ``with_target_statistics`` columns, all continuous, at the usual ``maxBins``."""
    columns = VectorAssembler(inputCols=[f"{c}_stat" for c in S.CATEGORICAL_FEATURES] + list(S.NUMERIC_FEATURES), outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[columns, forest(weight_col, **forest_overrides)])


def forest(weight_col: str | None = "class_weight", **overrides) -> RandomForestClassifier:
    """M3: the weighted forest; every parameter can be overridden (e.g. ``maxBins`` must
    be at least the number of distinct links + 1)."""
    params = dict(S.FOREST_PARAMS)
    params.update(overrides)
    kw = dict(featuresCol="features", labelCol=S.LABEL_COL, predictionCol="prediction",
              probabilityCol="probability", rawPredictionCol="rawPrediction", **params)
    if weight_col:
        kw["weightCol"] = weight_col
    return RandomForestClassifier(**kw)


def build_pipeline(weight_col: str | None = "class_weight", **forest_overrides) -> Pipeline:
    """M4: indexers -> assembler -> forest, the same at every data size.

    ``maxBins`` must exceed the number of links by two (the unseen bucket and one), and
    MLlib also needs at least that many training rows; ``bins_for`` sizes it.
    """
    return Pipeline(stages=indexers() + [assembler(), forest(weight_col, **forest_overrides)])


def bins_for(train: DataFrame, cats=S.CATEGORICAL_FEATURES) -> int:
    """``maxBins`` that holds every category of ``train`` and the unseen bucket."""
    counts = train.agg(*(F.count_distinct(c).alias(c) for c in cats)).first()
    return max(S.FOREST_PARAMS["maxBins"], max(counts) + 2)


def feature_importance(model: PipelineModel, top: int = 5) -> DataFrame:
    """M6: (feature, importance, rank, top_quartile) for the fitted forest.

    The importance vector has one entry per feature (19), so it is turned into a small
    DataFrame; the quartile flag uses ``percentile`` over it.
    """
    spark = SparkSession.getActiveSession()
    names = [f"{c}_idx" for c in S.CATEGORICAL_FEATURES] + S.NUMERIC_FEATURES
    imp = [float(x) for x in model.stages[-1].featureImportances.toArray()]
    df = spark.createDataFrame(list(zip(names, imp)), "feature string, importance double")
    q75 = df.agg(F.percentile("importance", 0.75).alias("q75"))
    w = Window.orderBy(F.col("importance").desc(), F.col("feature"))  # 19 rows
    return (df.crossJoin(q75)  # q75 is a single row
            .select("feature", "importance", F.row_number().over(w).alias("rank"),
                    (F.col("importance") >= F.col("q75")).alias("top_quartile"))
            .withColumn("top", F.col("rank") <= top))


def score_batch(model: PipelineModel, features: DataFrame, minutes: float = S.TARGET_MINUTES) -> DataFrame:
    """M7 + F17 + F18: predictions table rows, without a driver round trip."""
    pred = model.transform(features)
    return pred.select(
        "link_id", "borough", "link_name",
        F.col("data_as_of").alias("timestamp"),
        plus_minutes("data_as_of", minutes).alias("target_time"),
        F.col("prediction").cast("int").alias("predicted_congestion"),
        confidence(vector_to_array("probability")).alias("confidence"),
    )


def save_model(model: PipelineModel, path: str) -> PipelineModel:
    """M8: overwrite, then reload to prove the saved model is usable."""
    model.write().overwrite().save(path)
    return PipelineModel.load(path)
