"""Data-quality checks (Q1, Q2, Q5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import settings as S
from ..functions.congestion import class_label
from ..sources.readers import partition_exists, scan_table
from .aggregates import describe_column
from .filters import top_k


def expected_count(df: DataFrame, expected: int) -> DataFrame:
    """Q2: row count against an expected value, as one row (rows, expected, ok)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(expected).alias("expected"), (F.col("rows") == F.lit(expected)).alias("ok"))


def profile(df: DataFrame, key: str = "link_id", ts: str = "data_as_of", name: str = "link_name") -> DataFrame:
    """Q5 summary row: rows, links, time range, null names -- one aggregate pass."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("links"),
                  F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"),
                  F.count_if(F.col(name).isNull()).alias("null_names"))


def prediction_report(df: DataFrame, newest: int = 10, key: str = "link_id", ts: str = "timestamp",
                      cls: str = "predicted_congestion", conf: str = "confidence") -> DataFrame:
    """Q5 in one call: ``(section, place, item, number, at)``, a bounded table whatever the predictions.

    Sections: ``summary`` (rows, links; first and last time), ``class`` (rows per class, classes
    without a row included, others and nulls as ``other``), ``confidence`` (count, mean, std, min,
    quartiles, max, rounded to four digits), ``nulls`` (per column, by name) and ``newest``
    (the latest rows, ties by key: ``item`` the key, ``number`` the class).  Summary, classes and nulls are one
    partial aggregate; nothing runs before an action.  Without a row: counts of 0, the
    other numbers null and no newest row.
    """
    columns = sorted(df.columns)
    known = F.coalesce(F.col(cls).isin(*S.CLASSES), F.lit(False))
    # (section, place, item, number, at) of everything that one pass over the rows gives
    cells = [("summary", F.lit("rows"), F.count(F.lit(1)), None), ("summary", F.lit("links"), F.count_distinct(key), None),
             ("summary", F.lit("first"), None, F.min(ts)), ("summary", F.lit("last"), None, F.max(ts))]
    cells += [("class", class_label(F.lit(c)), F.count_if(F.coalesce(F.col(cls) == c, F.lit(False))), None) for c in S.CLASSES]
    cells += [("class", F.lit("other"), F.count_if(~known), None)]
    cells += [("nulls", F.lit(c), F.count_if(F.col(f"`{c}`").isNull()), None) for c in columns]
    once = df.agg(*[(at if number is None else number).alias(f"c{k}") for k, (_, _, number, at) in enumerate(cells)])

    def row(section: str, place: int, item, number, at):
        nothing = F.lit(None)
        return F.struct(F.lit(section).alias("section"), F.lit(place).alias("place"), item.alias("item"),
                        (nothing if number is None else number).cast("double").alias("number"),
                        (nothing if at is None else at).cast(df.schema[ts].dataType).alias("at"))

    seen: dict[str, int] = {}
    rows = []
    for k, (section, item, number, at) in enumerate(cells):
        seen[section] = seen.get(section, 0) + 1
        rows.append(row(section, seen[section], item, None if number is None else F.col(f"c{k}"), None if at is None else F.col(f"c{k}")))
    report = once.select(F.inline(F.array(*rows)))
    spread = describe_column(df, conf)
    report = report.unionByName(spread.select(F.inline(F.array(*(
        row("confidence", k, F.lit(c), F.col(c), None) for k, c in enumerate(spread.columns, 1))))))
    latest = top_k(df.select(key, ts, cls), newest, [F.col(ts).desc_nulls_last(), F.col(key).asc_nulls_last(), F.col(cls).asc_nulls_last()])
    place = F.row_number().over(Window.orderBy(F.col(ts).desc_nulls_last(), F.col(key).asc_nulls_last(), F.col(cls).asc_nulls_last()))  # ``newest`` rows
    return report.unionByName(latest.select(F.lit("newest").alias("section"), place.alias("place"), F.col(key).cast("string").alias("item"),
                                            F.col(cls).cast("double").alias("number"), F.col(ts).alias("at")))


REPORT_SCHEMA = T.StructType([
    T.StructField("artifact", T.StringType()), T.StructField("exists", T.BooleanType()),
    T.StructField("rows", T.LongType()), T.StructField("expected_rows", T.LongType()),
    T.StructField("missing_columns", T.ArrayType(T.StringType())), T.StructField("ok", T.BooleanType()),
])


def artifact_check(spark: SparkSession, artifacts: list[dict]) -> DataFrame:
    """Q1: one report row per artifact.

    ``artifacts``: dicts with ``name``, ``path``, optional ``fmt``, ``expected_rows``
    and ``columns``.  Each table is counted by Spark; only the per-artifact summary
    (a handful of rows) is assembled on the driver.
    """
    rows = []
    for a in artifacts:
        fmt = a.get("fmt", "parquet")
        exists = partition_exists(spark, a["path"], fmt)
        n, missing = None, list(a.get("columns", []))
        if exists:
            df = scan_table(spark, a["path"], fmt)
            n = df.count()
            missing = [c for c in a.get("columns", []) if c not in df.columns]
        exp = a.get("expected_rows")
        ok = bool(exists and not missing and (exp is None or n == exp))
        rows.append((a["name"], exists, n, exp, missing, ok))
    return spark.createDataFrame(rows, REPORT_SCHEMA)
