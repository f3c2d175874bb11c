"""Training dataflow: gold -> typed frame -> sample -> splits -> weights -> forest -> metrics."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import settings as S
from ..operators.filters import bulk_cast, dropna_required, stratified_sample, time_split
from ..operators.joins import join_class_weight
from ..operators.metrics import class_metrics, class_weight, confusion_matrix, macro_f1
from ..session import checkpoint_dir

COUNT = "_rows"
NUMERIC_CAST = S.NUMERIC_FEATURES + [S.LABEL_COL, "year"]


def training_frame(gold: DataFrame) -> DataFrame:
    """P13 + P11: required columns, ids as text, everything else double, no nulls."""
    typed = bulk_cast(gold.select(*S.GOLD_COLUMNS), to_string=S.CATEGORICAL_FEATURES, to_double=NUMERIC_CAST)
    return dropna_required(typed, S.FEATURE_COLUMNS + [S.LABEL_COL, "year", "month"])


def materialize(df: DataFrame, path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """K9: cut the lineage of an expensive intermediate.

    With a ``path`` (shared storage) the frame is written and read back; otherwise it
    is ``checkpoint()``-ed into ``spark.checkpoint.dir``.  Both survive executor loss.
    """
    spark = df.sparkSession
    if path:
        df.write.mode("overwrite").format(fmt).save(path)
        return spark.read.format(fmt).load(path)
    checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def prepare(gold: DataFrame, bounds=S.SPLIT_BOUNDS, checkpoint_path: str | None = None) -> DataFrame:
    """Typed, materialized frame with a ``split`` column; every row of every split."""
    return time_split(materialize(training_frame(gold), checkpoint_path), bounds)


def weighted_train(frame: DataFrame, fraction: float = S.SAMPLE_FRACTION, seed: int = S.SAMPLE_SEED) -> DataFrame:
    """P14 + G13 + J4 on the train split: the sample bounds only the rows the forest is fitted on."""
    train = frame.filter(F.col("split") == "train")
    train = stratified_sample(train, ["link_id", "data_as_of"], fraction=fraction, seed=seed)
    return join_class_weight(train, class_weight(train))


def evaluate(model, df: DataFrame) -> dict:
    """M5: predictions -> confusion matrix, per-class metrics and macro F1 (all DataFrames).

    Rows are scored once: their counts by label and prediction, a few rows, are kept, and all else comes from these.
    """
    counts = materialize(model.transform(df).groupBy(S.LABEL_COL, "prediction").agg(F.count(F.lit(1)).alias(COUNT)))
    metrics = class_metrics(counts, count=COUNT)
    return {"confusion": confusion_matrix(counts, count=COUNT), "metrics": metrics, "macro_f1": macro_f1(metrics)}


def fit_forest(frame: DataFrame, fraction: float = S.SAMPLE_FRACTION, forest_params: dict | None = None):
    """M2-M4 on the sampled, weighted train split."""
    from ..operators.ml import bins_for, build_pipeline
    # indexers, bins and trees each go over these rows: what they are taken from is read once
    train = materialize(weighted_train(frame, fraction), f"{checkpoint_dir(frame.sparkSession)}/train-{uuid.uuid4().hex}")
    params = {"maxBins": bins_for(train)} | (forest_params or {})
    return build_pipeline(**params).fit(train)


def run_training(spark: SparkSession, gold: DataFrame, bounds=S.SPLIT_BOUNDS, forest_params: dict | None = None,
                 checkpoint_path: str | None = None, fraction: float = S.SAMPLE_FRACTION) -> dict:
    """Whole training step; the fitted model and its evaluation on all val and test rows."""
    frame = prepare(gold, bounds, checkpoint_path=checkpoint_path)
    model = fit_forest(frame, fraction, forest_params)
    return {"model": model,
            "val": evaluate(model, frame.filter(F.col("split") == "val")),
            "test": evaluate(model, frame.filter(F.col("split") == "test"))}
