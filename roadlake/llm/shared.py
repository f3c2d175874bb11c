"""Helpers the operators of this package share: scratch tables, blocks, shipping the package.

Scratch tables live in a fresh folder below ``spark.checkpoint.dir`` and are written by
Spark's own Parquet writer, so a lost executor costs a task retry and nothing else.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import roadlake
from roadlake.session import checkpoint_dir

#: Text bytes that one block of documents holds on average.  A block is the unit that
#: is read by one task together with the statistics of its own words or chunks.
BLOCK_BYTES = 16 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_roadlake_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(roadlake.__file__))
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="roadlake-py-")), "roadlake_py.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("roadlake", os.path.relpath(full, root)))
    sc.addPyFile(target)
    sc._roadlake_shipped = True


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that the session names."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table: cuts the lineage and survives executor loss."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def drop(*tables: DataFrame) -> None:
    """Delete scratch tables that no later step reads."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t._scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores before it until no column is called so."""
    while name.lower() in {c.lower() for c in taken}:
        name = f"_{name}"
    return name


#: Partners that one unit of work of a block join meets, and the most tasks that its units are dealt to.
RUN_PARTNERS, MOST_TASKS = 32, 20_000


def pair_runs(pairs: DataFrame, left: DataFrame, left_key: list[str], right: DataFrame, right_key: list[str], keep: list[str] = ()) -> DataFrame:
    """Blocks that meet, so that each task reads a left block once for a run of its partners.

    ``pairs(left_key, right_key, keep)`` names the pairs.  Rows of the result are ``is_right`` (false: a
    left block, which holds for the rows up to the next one) with the other columns of ``left``, ``right`` and
    ``keep``.  A run has about ``RUN_PARTNERS`` partners, so it moves half the bytes of single pairs; the
    number of tasks follows the runs up to ``MOST_TASKS``, beyond which a task takes several.
    """
    n = pairs.count()
    most = pairs.groupBy(*left_key).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    run = F.pmod(F.xxhash64(*right_key), F.lit(max(1, math.ceil(most / RUN_PARTNERS)))).alias("run")
    dealt = pairs.select(*left_key, *right_key, *keep, run)
    heads = dealt.select(*left_key, "run").distinct().join(left, left_key)
    partners = dealt.join(right, right_key)
    extra = [c for c in right.columns if c not in right_key]
    types = dict(left.dtypes) | dict(pairs.dtypes) | dict(right.dtypes)
    nulls = lambda names: [F.lit(None).cast(types[c]).alias(c) for c in names]
    own = [c for c in left.columns if c not in left_key]
    both = (heads.select(*left_key, "run", F.lit(False).alias("is_right"), *own, *nulls([*keep, *extra]))
            .unionByName(partners.select(*left_key, "run", F.lit(True).alias("is_right"), *nulls(own), *keep, *extra)))
    tasks = min(MOST_TASKS, max(1, math.ceil(n / max(1, min(most, RUN_PARTNERS) // 4))))
    return both.repartition(tasks, *left_key, "run").sortWithinPartitions(*left_key, "run", "is_right")


#: A key is hot if it holds more than one in so many rows; so there are fewer hot keys than this.
HOT_KEYS = 1000


def join_hot(rows: DataFrame, table: DataFrame, key: str, weight: str) -> DataFrame:
    """``rows`` joined with ``table`` (written, one row per key; ``weight``: how many ``rows`` have the key, not returned).

    Hot keys, fewer than ``HOT_KEYS`` rows of the table, are broadcast; only the others are shuffled,
    so no task gets more than a small share of the rows for one key.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    is_hot = F.col(weight) * F.lit(HOT_KEYS) > F.lit(total)
    hot, cold = F.broadcast(table.where(is_hot).drop(weight)), table.where(~is_hot).drop(weight)
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(cold, key))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def id_crc(id_col: str) -> Column:
    """crc32 of the id as text (null: of the empty string)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))


def text_bytes(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary"))


def count_blocks(total_bytes: int | None, block_bytes: int) -> int:
    return max(1, math.ceil((total_bytes or 0) / block_bytes))


def block_of(n: int, *cols: str) -> Column:
    """Block number by a hash of the given columns; equal rows meet, nothing else is needed."""
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")
