"""Scoring with fitted forests in blocks of rows (M7 for whole tables).

MLlib walks the nodes of every tree row by row, as objects; on many rows that walk is most of
the work of a query.  Here the nodes of the fitted model become arrays once, on the driver, and
a block of rows goes down a tree together.  Predictions and probabilities are those of
``PipelineModel.transform``, bit for bit: the same comparisons, the same sums in the same order.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREDICTED = "prediction double, probability array<double>"
#: Bits of a node's number that hold its feature and the place of its answers; the node of its left child stands above them.
FEATURE_BITS, ANSWER_BITS, NODE_BITS = 10, 26, 27


def with_predictions(df: DataFrame, **models: PipelineModel) -> DataFrame:
    """M7: ``df`` with a struct ``(prediction, probability)`` per model, named as the model is given.

    Every model scores every row.  One that is not made of ``build_pipeline``'s stages, or too large
    for the arrays, scores by its own ``transform``.
    """
    blocks = {name: _block_scorer(df, name, model) for name, model in models.items()}
    out = df.select("*", *(F.arrow_udf(score, PREDICTED)(*inputs).alias(name) for name, (score, inputs) in ((k, b) for k, b in blocks.items() if b)))
    for name in (k for k, b in blocks.items() if not b):
        said = F.struct(F.col("prediction"), vector_to_array("probability").alias("probability"))
        out = models[name].transform(out).select(*out.columns, said.alias(name))
    return out.select(*df.columns, *models)


def _block_scorer(df: DataFrame, name: str, model: PipelineModel) -> tuple | None:
    """The function that scores a block, and its input columns; None for a model that it could not follow exactly."""
    *before, forest = model.stages
    indexers, assemblers = before[:-1], before[-1:]
    if not (isinstance(forest, RandomForestClassificationModel) and not forest.isDefined("thresholds")
            and all(isinstance(a, VectorAssembler) and a.getHandleInvalid() == "keep" and a.getOutputCol() == forest.getFeaturesCol() for a in assemblers)
            and assemblers and all(isinstance(i, StringIndexerModel) and i.getHandleInvalid() == "keep" for i in indexers)):
        return None
    labels = {}
    for i in indexers:
        several = i.isSet("inputCols")
        names = zip(i.getInputCols(), i.getOutputCols()) if several else [(i.getInputCol(), i.getOutputCol())]
        labels |= {out: (col, values) for (col, out), values in zip(names, i.labelsArray)}
    if labels.keys() & {col for col, _ in labels.values()}:
        return None
    inputs, values = [], []
    for c in assemblers[0].getInputCols():
        if c not in labels and not isinstance(df.schema[c].dataType, (T.NumericType, T.BooleanType)):
            return None
        inputs.append(F.col(labels[c][0]).cast("string") if c in labels else F.col(c).cast("double"))
        values.append(list(labels[c][1]) if c in labels else None)
    score = _score(df.sparkSession, forest, values)
    if score is None:
        return None
    score.__name__ = f"score_{name}"  # else Spark takes two models that are equal for one call, and only one is run
    return score, inputs


def _trees(spark: SparkSession, forest: RandomForestClassificationModel) -> list:
    """The nodes of each tree of the fitted model itself, by their numbers; a parent comes before its children."""
    jvm = spark._jvm
    build = getattr(getattr(jvm.org.apache.spark.ml.tree, "DecisionTreeModelReadWrite$NodeData$"), "MODULE$").build
    mapper, seen = jvm.com.fasterxml.jackson.databind.ObjectMapper(), getattr(jvm.com.fasterxml.jackson.annotation, "JsonAutoDetect$Visibility")
    part = jvm.com.fasterxml.jackson.annotation.PropertyAccessor
    mapper.setVisibility(part.ALL, getattr(seen, "NONE"))
    mapper.setVisibility(part.FIELD, getattr(seen, "ANY"))
    as_list = jvm.scala.jdk.javaapi.CollectionConverters.asJava
    trees = [json.loads(mapper.writeValueAsString(as_list(build(t._java_obj.rootNode(), 0)._1()))) for t in forest.trees]
    return [sorted(t, key=lambda n: n["id"]) for t in trees]


def _score(spark: SparkSession, forest: RandomForestClassificationModel, labels: list) -> Callable | None:
    """A function from a block's columns to its predictions; ``labels`` has the values of an indexed column, None for a number."""
    def in_turn(x: np.ndarray) -> np.ndarray:
        return np.cumsum(x, axis=-1)[..., -1]  # one after the other, as MLlib adds; sum() is compensated, np.sum() pairwise

    trees, classes, features = _trees(spark, forest), forest.numClasses, len(labels)
    cuts, sizes = {}, {}
    for s in (n["split"] for t in trees for n in t if n["leftChild"] >= 0):
        if s["numCategories"] < 0:
            cuts.setdefault(s["featureIndex"], set()).add(float(s["leftCategoriesOrThreshold"][0]))
        else:
            sizes[s["featureIndex"]] = s["numCategories"]
    cuts = {f: np.array(sorted(c)) for f, c in cuts.items()}
    place_of = {f: {x: k for k, x in enumerate(c)} for f, c in cuts.items()}
    # a feature's bin is the number of its thresholds below the value, or the category; the last bin is any other value
    width = max([1, *(len(c) + 1 for c in cuts.values()), *(n + 1 for n in sizes.values())])
    # what a node answers for a bin, 1 for right: all thresholds share one step, each set of categories has its own
    answers, own, end = [np.repeat(np.array([0, 1], np.uint8), width)], {}, 2 * width

    nodes, roots, depths, shares = [], [], [], []
    for t in trees:
        root, free = len(nodes), len(nodes) + 1
        place, depth = {0: root}, {0: 0}
        nodes += [0] * len(t)
        share = np.zeros((len(t), classes))
        for n in t:
            at = place[n["id"]]
            if n["leftChild"] < 0:
                counts = np.array(n["impurityStats"], float)
                if (total := in_turn(counts)) != 0:
                    share[at - root] = counts / total
                nodes[at] = (at, 0, 0)  # stays where it is: the first bins of the step answer 0
                continue
            for k, child in enumerate((n["leftChild"], n["rightChild"])):
                place[child], depth[child] = free + k, depth[n["id"]] + 1
            f, given = n["split"]["featureIndex"], n["split"]["leftCategoriesOrThreshold"]
            if f in sizes:
                key = (f, *given)
                if key not in own:
                    right = np.ones(sizes[f] + 1, np.uint8)
                    right[np.array(given, int)] = 0
                    right[-1] = len(given) <= sizes[f] // 2  # MLlib keeps the smaller side of the set; what it does not know is on the other
                    own[key], end = end, end + len(right)
                    answers.append(right)
                base = own[key]
            else:
                base = width - 1 - place_of[f][float(given[0])]
            nodes[at] = (free, base, f)
            free += 2
        roots.append(root)
        depths.append(max(depth.values()))
        shares.append(share)
    if features >= 1 << FEATURE_BITS or end + width >= 1 << ANSWER_BITS or len(nodes) >= 1 << NODE_BITS:
        return None
    nodes = np.array([left << FEATURE_BITS + ANSWER_BITS | base << FEATURE_BITS | f for left, base, f in nodes], np.int64)
    answers, kind = np.concatenate([*answers, np.zeros(width, np.uint8)]), np.min_scalar_type(width)
    is_feature, is_answer, to_answer, to_left = (1 << FEATURE_BITS) - 1, (1 << ANSWER_BITS) - 1, FEATURE_BITS, FEATURE_BITS + ANSWER_BITS

    # nested, so that executors get the function itself and need no module of this package
    def score(*columns: pa.Array) -> pa.Array:
        rows = len(columns[0])
        bins = np.zeros((rows, features), kind)
        for f, column in enumerate(columns):
            if f not in cuts and f not in sizes:
                continue
            if labels[f] is not None:
                column = pc.index_in(column, value_set=pa.array(labels[f], column.type)).fill_null(len(labels[f])).cast("double")
            x = column.to_numpy(zero_copy_only=False)  # null becomes NaN, which is above every threshold
            if f in cuts:
                bins[:, f] = np.searchsorted(cuts[f], x, side="left")
            else:
                bins[:, f] = np.where((x >= 0) & (x < sizes[f]) & (np.floor(x) == x), x, sizes[f])
        bins, first = bins.ravel(), np.arange(rows) * features
        votes = np.zeros((rows, classes))
        for root, depth, share in zip(roots, depths, shares):
            at = np.full(rows, root)
            for _ in range(depth):
                node = nodes.take(at)
                feature = node & is_feature
                feature += first
                at = node >> to_left
                node >>= to_answer
                node &= is_answer
                node += bins.take(feature)
                at += answers.take(node)
            at -= root
            votes += share.take(at, axis=0)
        total = in_turn(votes)
        if not (total > 0).all():
            raise ValueError("no tree has a vote")  # as MLlib
        lists = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * classes), pa.array((votes / total[:, None]).ravel()))
        return pa.StructArray.from_arrays([pa.array(votes.argmax(axis=1).astype(float)), lists], ["prediction", "probability"])

    return score
