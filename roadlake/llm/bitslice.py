"""Exact top-k inner products over a bit-sliced index.

Every component is quantised to an integer.  A block of rows keeps, for each component and
each bit, a bitmap over its rows.  For a query, the bitmaps of ``component * query
component`` are added column by column with carry-save adders, which leaves the score as a
stack of bitmaps.  Rows are then taken from the most significant bitmap downward: rows that
must be in, rows still tied, and at the end the tied rows with the smallest ids.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import pair_runs, ship, stored

SCALE = 256
TOP = 5
BLOCK_ROWS = 16_384
QUERY_SHARD = 256
#: Quantised components must fit in so many bits, the sign included.
COMPONENT_BITS = 62


def usable(vector: str) -> Column:
    """Whether a vector is not null and has no null or non-finite component."""
    c = F.col(vector)
    bad = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return c.isNotNull() & ~bad


def quantise(values: np.ndarray, scale: int) -> np.ndarray:
    q = np.floor(values.astype(np.float64) * scale)
    if len(q) and np.abs(q).max() >= 2.0 ** (COMPONENT_BITS - 1):
        raise ValueError(f"a quantised component needs more than {COMPONENT_BITS} bits")
    return q.astype(np.int64)


def slices_of(q: np.ndarray) -> np.ndarray:
    """Two's complement bitmaps ``[component, bit, word]`` of ``q`` (rows, components); row r is bit r % 64 of word r // 64."""
    n, dim = q.shape
    bits = int(max(np.abs(q).max(initial=0), 1)).bit_length() + 1
    words = -(-n // 64)
    out = np.zeros((dim, bits, words), dtype=np.uint64)
    padded = np.zeros((words * 64, dim), dtype=np.int64)
    padded[:n] = q
    for b in range(bits):
        plane = ((padded >> b) & 1).astype(np.uint8).T
        out[:, b] = np.ascontiguousarray(np.packbits(plane, axis=1, bitorder="little")).view(np.uint64)
    return out


def add_columns(columns: list[np.ndarray]) -> list[np.ndarray]:
    """The sum of bitmaps by weight: ``columns[t]`` (m, words) count ``2**t`` each -> one bitmap per weight."""
    out: list[np.ndarray] = []
    carried: list[np.ndarray] = []
    t = 0
    while t < len(columns) or carried:
        parts = carried + ([columns[t]] if t < len(columns) else [])
        x = np.concatenate(parts) if parts else np.zeros((0, out[0].shape[-1] if out else 0), dtype=np.uint64)
        carried = []
        while len(x) >= 3:
            m = len(x) // 3
            a, b, c = x[:m], x[m : 2 * m], x[2 * m : 3 * m]
            half = a ^ b
            carried.append((a & b) | (half & c))
            x = np.concatenate([half ^ c, x[3 * m :]])
        if len(x) == 2:
            carried.append((x[0] & x[1])[None])
            x = (x[0] ^ x[1])[None]
        out.append(x[0] if len(x) else None)
        t += 1
    words = next((x.shape[-1] for x in out if x is not None), 0)
    return [np.zeros(words, dtype=np.uint64) if x is None else x for x in out]


class Index:
    """One block's rows: ids ascending, bitmaps and their complements."""

    def __init__(self, ids: np.ndarray, slices: np.ndarray):
        self.ids, (self.dim, self.bits, self.words) = ids, slices.shape
        self.planes = np.stack([slices, ~slices])
        tail = np.zeros(self.words * 64, dtype=np.uint8)
        tail[: len(ids)] = 1
        self.all = np.packbits(tail, bitorder="little").view(np.uint64)

    def score_slices(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Bitmaps of ``score + offset`` by weight, and the offset that makes it at least 0.

        A product with a minus sign, ``-w * bit``, is added as ``w * (not bit)`` and w in the offset.
        """
        magnitude = np.abs(query)
        width = int(magnitude.max(initial=0)).bit_length()
        d, k = np.nonzero((magnitude[:, None] >> np.arange(max(width, 1))) & 1)
        dd, jj = np.repeat(d, self.bits), np.tile(np.arange(self.bits), len(d))
        weight = np.repeat(k, self.bits) + jj
        minus = (query[dd] < 0) ^ (jj == self.bits - 1)
        columns = []
        for t in range(int(weight.max(initial=-1)) + 1):
            at = weight == t
            columns.append(self.planes[minus[at].astype(np.int8), dd[at], jj[at]])
        offset = sum(1 << int(w) for w in weight[minus])
        return add_columns(columns), offset

    def top(self, query: np.ndarray, own_id: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows but those of ``own_id``; ties to the smaller id."""
        slices, offset = self.score_slices(query)
        tied = self.all.copy()
        lo, hi = np.searchsorted(self.ids, [own_id, own_id + 1])
        for r in range(lo, hi):
            tied[r >> 6] &= ~np.uint64(1 << (r & 63))
        sure = np.zeros_like(tied)
        for s in reversed(slices):
            more = sure | (tied & s)
            n = int(np.bitwise_count(more).sum())
            if n > k:
                tied = tied & s
            else:
                sure, tied = more, tied & ~s
                if n == k:
                    tied[:] = 0
                    break
        rows = _rows(sure)
        if len(rows) < k:
            rows = np.concatenate([rows, _rows(tied)[: k - len(rows)]])
        # of k rows at most, in integers of any size
        scores = [sum((int(s[r >> 6]) >> (r & 63) & 1) << t for t, s in enumerate(slices)) - offset for r in rows.tolist()]
        if any(not -(1 << 63) <= x < 1 << 63 for x in scores):
            raise OverflowError("a score among the best does not fit in a long")
        return self.ids[rows], np.array(scores, dtype=np.int64)


def _rows(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def build_index(rows: DataFrame, scale: int = SCALE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``rows(id, dim, v)`` -> written table ``(dim, block, ids, bits, slices)``, one row per block of rows."""
    n = rows.count()
    blocks = max(1, math.ceil(n / block_rows))

    def build(key: tuple, table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        dim = key[0].as_py()
        flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        slices = slices_of(quantise(flat, scale).reshape(len(ids), dim)[order])
        return pa.table({"dim": pa.array([dim], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()),
                         "ids": pa.array([ids[order].astype("<i8").tobytes()], pa.binary()),
                         "bits": pa.array([slices.shape[1]], pa.int32()),
                         "slices": pa.array([slices.tobytes()], pa.binary())})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    return stored(dealt.groupBy("dim", "block").applyInArrow(build, "dim int, block int, ids binary, bits int, slices binary"), "bit-slices")


def top_k(vectors: DataFrame, queries: Column, *, k: int = TOP, scale: int = SCALE, block_rows: int = BLOCK_ROWS,
          query_shard: int = QUERY_SHARD, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows with the highest integer inner product.

    ``queries`` picks the query rows of ``vectors``; candidates are all rows with another id
    and as many components.  Ties go to the smaller id.  Vectors that are null or hold null
    or non-finite components, and rows without an id, take no part; empty vectors score 0
    with each other.  A candidate id that stands twice can be returned twice; a
    query that stands twice with the same vector is answered once.  No rows give no rows.

    Components may be as large as 2**61 when quantised, beyond that they are an error, and so is a
    score among the best that does not fit in a long.

    A unit of work is a block of candidates and a run of shards of queries, so neither side has
    to fit in one task, and only ``k`` rows per query and block are shuffled.
    """
    ship(vectors.sparkSession)
    rows = (vectors.where(F.col(id_col).isNotNull() & usable(vector_col))
            .select(F.col(id_col).cast("long").alias("id"), F.size(vector_col).alias("dim"), F.col(vector_col).alias("v"),
                    queries.alias("asks")))
    index = build_index(rows.select("id", "dim", "v"), scale, block_rows)
    asked = rows.where("asks").select("id", "dim", "v").distinct()
    shards = max(1, math.ceil(asked.count() / query_shard))

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        q = quantise(flat, scale).reshape(table.num_rows, dim)
        return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int32()),
                         "query_ids": pa.array([table.column("id").to_numpy().astype("<i8").tobytes()], pa.binary()),
                         "q": pa.array([q.astype("<i8").tobytes()], pa.binary())})

    asked = asked.withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int"))
    asked = stored(asked.groupBy("dim", "shard").applyInArrow(gather, "dim int, shard int, query_ids binary, q binary"), "queries")
    # each shard of queries visits each block of its dimension: shards x blocks units
    blocks = index.withColumnRenamed("dim", "block_dim")
    shards_ = asked.withColumnRenamed("dim", "shard_dim")
    units = stored(blocks.select("block_dim", "block").join(shards_.select("shard_dim", "shard"), F.expr("block_dim = shard_dim")), "units")
    met = (pair_runs(units, blocks, ["block_dim", "block"], shards_, ["shard_dim", "shard"])
           .select("is_right", "block_dim", "bits", "ids", "slices", "query_ids", "q"))

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for r in range(batch.num_rows):
                right, dim, bits, ids, slices, query_ids, q = (batch.column(c)[r].as_py() for c in range(7))
                if not right:  # a block and, after it, the queries that it is asked
                    ids = np.frombuffer(ids, "<i8")
                    index_ = Index(ids, np.frombuffer(slices, np.uint64).reshape(dim, bits, -(-len(ids) // 64)))
                    continue
                query_ids = np.frombuffer(query_ids, "<i8")
                asked_ = np.frombuffer(q, "<i8").reshape(len(query_ids), dim)
                answers = [index_.top(vector, own, k) for own, vector in zip(query_ids.tolist(), asked_)]
                n = [len(found) for found, _ in answers]
                copies = np.array([zlib.crc32(vector.tobytes()) for vector in asked_], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(query_ids, n)), pa.array(np.repeat(copies, n)),
                     pa.array(np.concatenate([f for f, _ in answers])), pa.array(np.concatenate([x for _, x in answers]))],
                    names=["query_id", "copy", "vec_id", "score"])

    best = met.mapInArrow(search, "query_id long, copy long, vec_id long, score long")
    # copy: tells apart two query rows of one id with different vectors
    order = Window.partitionBy("query_id", "copy").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))

