"""Training-set statistics and classifier metrics.

Metrics stay distributed: confusion counts are one aggregate over the
predictions; only the 3 x 3 result is small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import settings as S


def _classes(spark, classes=S.CLASSES) -> DataFrame:
    rows = ", ".join(f"({float(c)}D)" for c in classes)  # double literals, not DECIMAL
    return spark.sql(f"SELECT c FROM VALUES {rows} AS t(c)")


def class_weight(train: DataFrame, label: str = S.LABEL_COL,
                 num_classes: int = S.NUM_CLASSES) -> DataFrame:
    """``total / (num_classes * count)`` per class present in ``train``."""
    counts = train.groupBy(F.col(label).cast("double").alias(label)).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())  # three rows: one tiny partition
    return counts.select(label, "count",
                         (total / (F.lit(num_classes) * F.col("count"))).cast("double").alias("class_weight"))


def _times(condition: Column, count: str | None) -> Column:
    """How often a condition holds, each row counted once or ``count`` times."""
    return F.count_if(condition) if count is None else F.coalesce(F.sum(F.when(condition, F.col(count))), F.lit(0))


def confusion_matrix(pred: DataFrame, actual: str = S.LABEL_COL, predicted: str = "prediction",
                     classes=S.CLASSES, count: str | None = None) -> DataFrame:
    """Actual x predicted counts, every class row and column present, zeros filled.

    A row of ``pred`` is one prediction, or ``count`` of them.
    """
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    aggs = [_times(p == float(c), count).alias(f"pred_{c}") for c in classes]
    counts = pred.groupBy(a.alias("actual")).agg(*aggs)
    spine = _classes(pred.sparkSession, classes).withColumnRenamed("c", "actual")
    out = spine.join(counts, on="actual", how="left")
    return out.select("actual", *[F.coalesce(F.col(f"pred_{c}"), F.lit(0)).cast("long").alias(f"pred_{c}")
                                  for c in classes])


def confusion_normalized(cm: DataFrame, classes=S.CLASSES, digits: int = 6) -> DataFrame:
    """Each row divided by its total (null for an empty row)."""
    tot = sum(F.col(f"pred_{c}") for c in classes)
    return cm.select("actual", *[F.round(F.try_divide(F.col(f"pred_{c}").cast("double"), tot), digits)
                                 .alias(f"pred_{c}") for c in classes])


def class_metrics(pred: DataFrame, actual: str = S.LABEL_COL, predicted: str = "prediction",
                  classes=S.CLASSES, count: str | None = None) -> DataFrame:
    """Tp, fp, fn, precision, recall, f1 per class; 0.0 when a denominator is 0.

    A row of ``pred`` is one prediction, or ``count`` of them.
    """
    a, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    aggs = []
    for c in classes:
        c = float(c)
        aggs += [_times((a == c) & (p == c), count).alias(f"tp{int(c)}"),
                 _times((a != c) & (p == c), count).alias(f"fp{int(c)}"),
                 _times((a == c) & (p != c), count).alias(f"fn{int(c)}")]
    wide = pred.agg(*aggs)
    stack = ", ".join(f"{float(c)}D, tp{c}, fp{c}, fn{c}" for c in classes)
    long = wide.selectExpr(f"stack({len(classes)}, {stack}) AS (class, tp, fp, fn)")
    prec = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(F.lit(0.0))
    rec = F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(F.lit(0.0))
    long = long.select("class", F.col("tp").cast("long").alias("tp"), F.col("fp").cast("long").alias("fp"),
                       F.col("fn").cast("long").alias("fn"), prec.alias("precision"), rec.alias("recall"))
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(F.lit(0.0))
    return long.withColumn("f1", f1)


def macro_f1(metrics: DataFrame, num_classes: int = S.NUM_CLASSES) -> DataFrame:
    """Mean f1 over exactly ``num_classes`` classes, plus the number of scored rows."""
    return metrics.agg((F.sum("f1") / F.lit(num_classes)).alias("macro_f1"),
                       (F.sum("tp") + F.sum("fn")).cast("long").alias("rows"))


def distribution_pct(df: DataFrame, by: str, split: str = "split", digits: int = 3) -> DataFrame:
    """Count and percentage of rows per ``by`` value within each split."""
    counts = df.groupBy(split, by).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy(split))
    return counts.withColumn("pct", F.round(F.col("count") * F.lit(100.0) / total, digits))


class Moments:
    """Rows counted so far: ``n``, and of k columns the means, smallest and largest values and summed products of deviations."""

    def __init__(self, n: int, mean: np.ndarray, low: np.ndarray, high: np.ndarray, c: np.ndarray):
        self.n, self.mean, self.low, self.high, self.c = n, mean, low, high, c

    @classmethod
    def of(cls, x: np.ndarray) -> Moments:
        mean = x.mean(axis=0)
        away = x - mean
        return cls(len(x), mean, x.min(axis=0), x.max(axis=0), away.T @ away)

    def add(self, other: Moments) -> Moments:
        """Of both sets of rows: about the common mean the products grow by the distance of the two means."""
        n = self.n + other.n
        gap = other.mean - self.mean
        return Moments(n, self.mean + gap * (other.n / n), np.minimum(self.low, other.low), np.maximum(self.high, other.high),
                       self.c + other.c + np.outer(gap, gap) * (self.n * other.n / n))


MOMENTS = "n long, mean array<double>, low array<double>, high array<double>, c array<double>"


def _moment_rows(held: list[tuple[tuple, Moments]], names: list[str], types: list) -> pa.Table:
    """A row per key: the key's columns and its moments (``c`` row by row)."""
    keys = [pa.array([k[i] for k, _ in held], t) for i, t in enumerate(types)]
    lists = [pa.array([getattr(m, c).ravel().tolist() for _, m in held], pa.list_(pa.float64())) for c in ("mean", "low", "high", "c")]
    return pa.Table.from_arrays([*keys, pa.array([m.n for _, m in held], pa.int64()), *lists], names=[*names, "n", "mean", "low", "high", "c"])


def co_moments(df: DataFrame, cols: list[str], by: list[str] = ()) -> DataFrame:
    """What Pearson correlations need, per group: ``n``, ``mean``, ``low``, ``high`` of each column and ``c``, all pairs' products.

    Rows with a null or NaN in any of ``cols`` are left out.  Each task sums up its rows (numpy, a
    batch at a time) and hands on one row per group; those are merged (``merge_co_moments``).  Groups'
    moments can be stored, such as those of a month, and merged later without their rows.
    """
    by = list(by)
    typed = df.select(*by, *[F.col(c).cast("double").alias(f"_{k}") for k, c in enumerate(cols)])
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in typed.select(*by).schema), MOMENTS]) if by else MOMENTS

    def sums(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Moments] = {}
        types: list = []
        for batch in parts:
            types = [batch.schema.field(c).type for c in by]
            x = np.column_stack([batch.column(f"_{k}").to_numpy(zero_copy_only=False).astype(np.float64) for k in range(len(cols))])
            full = ~np.isnan(x).any(axis=1)
            if by:
                keys = list(zip(*(batch.column(c).to_pylist() for c in by)))
                order: dict[tuple, list[int]] = {}
                for r in np.flatnonzero(full).tolist():
                    order.setdefault(keys[r], []).append(r)
                found = [(k, Moments.of(x[rows])) for k, rows in order.items()]
            else:
                found = [((), Moments.of(x[full]))] if full.any() else []
            for k, m in found:
                held[k] = held[k].add(m) if k in held else m
        if held:
            yield from _moment_rows(list(held.items()), by, types).to_batches()

    return merge_co_moments(typed.mapInArrow(sums, schema), by)


def merge_co_moments(parts: DataFrame, by: list[str] = (), slots: int = 64) -> DataFrame:
    """Co-moments of unions of groups.  Two steps, so no task gets the parts of a whole table at once."""
    by = list(by)
    fields = [f for f in parts.schema if f.name in by]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), MOMENTS])

    def merged(key: tuple, rows: pa.Table) -> pa.Table:
        whole = None
        for n, *arrays in zip(*(rows.column(c).to_pylist() for c in ("n", "mean", "low", "high", "c"))):
            mean, low, high, c = (np.array(a) for a in arrays)
            m = Moments(n, mean, low, high, c.reshape(len(mean), len(mean)))
            whole = m if whole is None else whole.add(m)
        return _moment_rows([(tuple(rows.column(c)[0].as_py() for c in by), whole)], by, [rows.schema.field(c).type for c in by])

    columns = [*by, "n", "mean", "low", "high", "c"]
    dealt = parts.select(*columns, F.pmod(F.xxhash64("n", "mean", "c"), F.lit(slots)).alias("_slot"))
    once = dealt.groupBy(*by, "_slot").applyInArrow(merged, schema)
    return once.withColumn("_all", F.lit(0)).groupBy(*by, "_all").applyInArrow(merged, schema)


def correlations(moments: DataFrame, cols: list[str], digits: int = 6, by: list[str] = ()) -> DataFrame:
    """``(by, feature_a, feature_b, corr)`` for every ordered pair, from one row of co-moments per group.

    A constant column (its smallest value is its largest) has no correlation: null.
    """
    k = len(cols)
    cells = F.array(*(F.struct(F.lit(i + 1).alias("i"), F.lit(j + 1).alias("j"), F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"))
                      for i, a in enumerate(cols) for j, b in enumerate(cols)))
    # as many rows as the matrix has entries
    rows = moments.select(*by, "low", "high", "c", F.inline(cells))
    c = lambda i, j: F.element_at("c", (F.col(i) - 1) * F.lit(k) + F.col(j))
    varies = lambda i: F.element_at("low", F.col(i)) < F.element_at("high", F.col(i))
    value = F.try_divide(c("i", "j"), F.sqrt(c("i", "i")) * F.sqrt(c("j", "j")))
    return rows.select(*by, "feature_a", "feature_b", F.when(varies("i") & varies("j"), F.round(value, digits) + F.lit(0.0)).alias("corr"))


def correlation_matrix(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Pearson correlation of every pair (both orders; diagonal 1.0, or null for a
    constant column) over all rows that have every column -- no row cap, and no job before an action."""
    return correlations(co_moments(df, cols), cols, digits)


def label_correlation_rank(df: DataFrame, cols: list[str], label: str = S.LABEL_COL,
                           digits: int = 6) -> DataFrame:
    """Features ranked by absolute correlation with the label."""
    matrix = correlations(co_moments(df, [*cols, label]), [*cols, label], digits)
    own = matrix.where((F.col("feature_b") == label) & (F.col("feature_a") != label))
    order = Window.orderBy(F.abs("corr").desc_nulls_last(), F.col("feature_a"))  # one row per feature
    return own.select(F.col("feature_a").alias("feature"), "corr", F.row_number().over(order).alias("rank"))
