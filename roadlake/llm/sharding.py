"""Sharding: a minimax contiguous partition of atomic groups of equal texts.

Groups are ordered by the SHA-256 of their text.  The driver never sees the groups: it holds
byte totals of digest prefixes (65,536 at first) and opens only those prefixes that a cut
can fall into, 256 ways at a time, until every cut lies between two groups.  All rows of a
group share a digest and the shard is an expression of the digest, so a group of any size is
never gathered, shuffled or split.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import drop, ship, stored, text_bytes

SHARDS = 24
ROW_BYTES = 8
#: First prefix of hex digits, digits that opening a prefix adds, length of a digest.
FIRST, STEP, FULL = 4, 2, 64
#: Prefixes that together hold no more rows than this are opened down to their groups.
LIST_ROWS = 200_000
#: Beyond every hex digit.
END = "g"


@dataclass
class Segment:
    """All groups whose digest starts with ``prefix``; ``atomic`` if they are one group."""

    prefix: str
    size: int
    rows: int
    atomic: bool


class Line:
    """Segments side by side, in order: where they can be cut."""

    def __init__(self, segments: list[Segment]):
        self.segments = segments
        self.ends = [0, *accumulate(s.size for s in segments)]
        self.total = self.ends[-1]

    def floor(self, x: int) -> int:
        """The last place at or before ``x`` between two segments."""
        return self.ends[bisect_right(self.ends, x) - 1]

    def inside(self, x: int) -> int:
        """``floor``, but any place within a segment that is not one group."""
        k = bisect_right(self.ends, x) - 1
        if k == len(self.segments):
            return self.total
        return self.ends[k] if self.segments[k].atomic else x

    def greedy(self, capacity: int, shards: int, cut: Callable[[int], int]) -> list[int]:
        """Where each shard ends if each takes as much as it can."""
        ends, at = [], 0
        for _ in range(shards):
            at = cut(at + capacity)
            ends.append(at)
        return ends

    def capacity(self, shards: int, cut: Callable[[int], int]) -> int:
        """The smallest capacity with which the greedy check reaches the end: a binary search."""
        low, high = -(-self.total // shards), self.total
        while low < high:
            mid = (low + high) // 2
            if self.greedy(mid, shards, cut)[-1] >= self.total:
                high = mid
            else:
                low = mid + 1
        return high

    def reach(self, shards: int) -> list[tuple[int, int]]:
        """For each cut, the span in which the greedy check can place it, whatever lies inside the segments."""
        low, high = self.capacity(shards, self.inside), self.capacity(shards, self.floor)
        return list(zip(self.greedy(low, shards, self.floor), self.greedy(high, shards, self.inside)))


def heavy_groups(segments: list[Segment], shards: int) -> tuple[list[Segment], list[Segment]]:
    """Groups larger than the mean of what is left for the shards left, largest first, and the segments that may hold more of them.

    They are fewer than the shards: each is larger than a shard's share of the rest.
    """
    rest, left, heavy = sum(s.size for s in segments), shards, []
    for s in sorted((s for s in segments if s.atomic), key=lambda s: (-s.size, s.prefix)):
        if s.size * left <= rest:
            break
        heavy.append(s)
        rest, left = rest - s.size, left - 1
    return heavy, [s for s in segments if not s.atomic and s.size * left > rest]


def unsettled(line: Line, shards: int) -> list[Segment]:
    """Segments that hold several groups and may hold a cut: of the check from the left, from the right, or nearest an equal share."""
    if not line.total:
        return []
    spans = line.reach(shards)
    back = Line(line.segments[::-1])
    spans += [(line.total - b, line.total - a) for a, b in back.reach(shards)]
    spans += [(x, x + 1) for x in (k * line.total // shards for k in range(1, shards))]
    found = set()
    for a, b in spans:
        found.update(range(max(0, bisect_right(line.ends, a) - 1), min(len(line.segments), bisect_left(line.ends, b))))
    return [line.segments[k] for k in sorted(found) if not line.segments[k].atomic]


def cuts(line: Line, shards: int) -> tuple[int, list[str]]:
    """The smallest feasible capacity, and the prefixes that the second to the last shard start with.

    Of the places that keep every shard within the capacity, each cut takes the one nearest
    to an equal share.
    """
    if not line.total:
        return 0, [END] * (shards - 1)
    capacity = line.capacity(shards, line.floor)
    back = Line(line.segments[::-1])
    least = [line.total - x for x in back.greedy(capacity, shards, back.floor)][-2::-1]
    at, places = 0, []
    for k in range(1, shards):
        share = k * line.total // shards
        low, high = max(least[k - 1], at), line.floor(at + capacity)
        below = line.floor(share)
        above = line.ends[min(len(line.segments), bisect_left(line.ends, share))]
        at = min(max(below if share - below <= above - share else above, low), high)
        places.append(at)
    index = (bisect_left(line.ends, x) for x in places)
    return capacity, [line.segments[k].prefix if k < len(line.segments) else END for k in index]


def opened(rows: DataFrame, segments: list[Segment], list_rows: int) -> list[Segment]:
    """What the given segments hold, by longer prefixes: one aggregate per prefix length."""
    out = []
    deep = sum(s.rows for s in segments) <= list_rows
    for length in sorted({len(s.prefix) for s in segments}):
        wanted = [s.prefix for s in segments if len(s.prefix) == length]
        to = FULL if deep else min(FULL, length + (STEP if length else FIRST))
        held = rows.where(F.substring("digest", 1, length).isin(wanted)) if length else rows
        got = (held.groupBy(F.substring("digest", 1, to).alias("prefix"))
               .agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"), (F.min("digest") == F.max("digest")).alias("atomic"))
               .toArrow())
        out += map(Segment, *(got.column(c).to_pylist() for c in ("prefix", "size", "rows", "atomic")))
    return out


def plan(rows: DataFrame, shards: int, list_rows: int = LIST_ROWS) -> tuple[list[str], list[str], int]:
    """Digests of the groups that fill a shard each, the prefixes that the other shards but the first start with, and the capacity.

    ``rows(digest, size)`` are read once per level of prefixes; their number is the
    logarithm of the number of groups to the base 256.
    """
    segments = opened(rows, [Segment("", 0, 1 << 62, False)], list_rows)
    while True:
        heavy, more = heavy_groups(segments, shards)
        if not more:
            names = {s.prefix for s in heavy}
            line = Line(sorted((s for s in segments if s.prefix not in names), key=lambda s: s.prefix))
            more = unsettled(line, shards - len(heavy))
        if not more:
            break
        names = {s.prefix for s in more}
        segments = [s for s in segments if s.prefix not in names] + opened(rows, more, list_rows)
    capacity, starts = cuts(line, shards - len(heavy))
    # a segment of one group has the name of its prefix; its digest is the only one that starts with it
    return [s.prefix for s in heavy], starts, max([capacity, *(s.size for s in heavy)])


def shard_of(heavy: list[str], starts: list[str]) -> Column:
    digest = F.col("digest")
    shard = F.lit(len(heavy))
    for s in starts:
        shard = shard + (digest >= F.lit(s)).cast("int")
    for k, prefix in reversed(list(enumerate(heavy))):
        shard = F.when(digest.startswith(prefix), F.lit(k)).otherwise(shard)
    return shard.cast("int")


def numbered(rows: DataFrame, shards: int) -> DataFrame:
    """``rows`` with ``part`` (the task that read it) and ``place`` (how many rows of its shard the task has read before)."""
    schema = rows.select("*", F.lit(0).alias("part"), F.lit(0).cast("long").alias("place")).schema
    names = schema.fieldNames()

    def number(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        seen = np.zeros(shards, dtype=np.int64)
        for batch in parts:
            shard = batch.column("shard").to_numpy()
            order = np.argsort(shard, kind="stable")
            counts = np.bincount(shard, minlength=shards)
            place = np.empty(len(shard), dtype=np.int64)
            place[order] = np.arange(len(shard)) - np.repeat(np.cumsum(counts) - counts - seen, counts)
            seen += counts
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(shard), part, dtype=np.int32)), pa.array(place)], names=names)

    return rows.mapInArrow(number, schema)


def shard(docs: DataFrame, *, shards: int = SHARDS, row_bytes: int = ROW_BYTES, list_rows: int = LIST_ROWS,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its shard from 0 to ``shards - 1`` and its place there, by the law ``bytes``.

    ``size`` is the text's UTF-8 bytes plus ``row_bytes``.  Rows of equal text stay together.
    A group larger than an equal share of what the others leave has a shard of its own (the
    first ones, largest group first); the rest, ordered by digest, is cut contiguously so that
    its largest shard is as small as any contiguous cut allows (``capacity`` is that bound, or the
    largest group), and within it each cut is as near to an equal share as it can be.
    ``slot`` counts a shard's rows from 0 in the order in which they are read.
    ``grown_shard`` is null: sizes decide, so one more shard would move the cuts.

    Null texts are empty ones and form one group with them.  Null, equal and repeated ids each give a row.
    With fewer groups than shards some shards are empty; no rows give no rows.  Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    text = text_bytes(text_col)
    rows = stored(docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + F.lit(row_bytes)).cast("long").alias("size"),
                              F.crc32(text).alias("text_crc32"), F.sha2(text, 256).alias("digest")), "shard-rows")
    heavy, starts, capacity = plan(rows.select("digest", "size"), shards, list_rows)
    dealt = rows.select("doc_id", "size", "text_crc32", shard_of(heavy, starts).alias("shard"))
    placed = stored(numbered(dealt, shards), "shard-places")
    drop(rows)
    counts = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    bases = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return (placed.join(bases, ["shard", "part"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("base") + F.col("place")).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), F.lit(capacity).cast("long").alias("capacity")))
