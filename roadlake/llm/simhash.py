"""SimHash near-duplicates by exact comparison of tiles of fingerprints.

Distinct fingerprints are dealt into tiles of one population count each.  Two
fingerprints within ``radius`` bits have population counts at most ``radius`` apart, so
only tiles that close meet.  A tile pair is one row and one unit of work: numpy takes the
exclusive or of stretches of the two tiles and counts the bits.  Inside, stretches are
sorted by the population counts of the four 16-bit quarters, whose differences sum up to at
most the distance, so stretches further apart are skipped too.
"""

from __future__ import annotations

from collections.abc import Iterator

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components, forest
from .shared import fresh, join_hot, pair_runs, ship, stored, text_bytes

SHINGLE = 3
RADIUS = 3
SEED = 42
STRETCH = 256
#: Bytes of a long text that are hashed at once.
TEXT_STRETCH = 1 << 20
_SPACE = re.compile(rb"[\t-\r ]")


def fingerprint(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Majority bits of consecutive groups of 64-bit hashes; an empty group gives 0."""
    out = np.zeros(len(ends), dtype=np.uint64)
    starts = np.r_[0, ends[:-1]]
    full = np.flatnonzero(ends > starts)
    if not len(full):
        return out
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    votes = np.empty((len(full), 64), dtype=np.int64)
    for k, g in enumerate(full):
        votes[k] = bits[starts[g] : ends[g]].sum(axis=0, dtype=np.uint32)
    major = votes * 2 > (ends - starts)[full, None]
    out[full] = np.packbits(major, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def shingle_hashes(text: bytes, width: int, seed: int) -> list[int]:
    words = text.lower().split()  # bytes: A-Z only, and the six ASCII white-space bytes
    digest = xxhash.xxh64_intdigest
    if len(words) < width:
        return [digest(b" ".join(words), seed)] if words else []
    return [digest(b" ".join(s), seed) for s in zip(*(words[k:] for k in range(width)))]


def long_fingerprint(text: bytes, width: int, seed: int) -> int:
    """The fingerprint of a text of any length; memory follows one stretch of it, not the text."""
    votes, n, carried, at = np.zeros(64, dtype=np.int64), 0, [], 0
    while at < len(text):
        gap = _SPACE.search(text, at + TEXT_STRETCH)
        to = gap.start() if gap else len(text)
        words = carried + text[at:to].lower().split()
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(s), seed) for s in zip(*(words[k:] for k in range(width)))], dtype=np.uint64)
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n, at = n + len(hashes), to
        carried = words[len(words) - min(len(words), width - 1) :]
    if not n:
        return xxhash.xxh64_intdigest(b" ".join(carried), seed) if carried else 0
    return int(np.packbits(votes * 2 > n, bitorder="little").view(np.uint64)[0])


def with_fingerprint(rows: DataFrame, name: str, text_name: str, *, width: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """Replaces the binary column ``text_name`` of ``rows`` by the fingerprint ``name`` (long)."""
    keep = [c for c in rows.columns if c != text_name]
    schema = rows.select(*keep, F.lit(0).cast("long").alias(name)).schema

    def compute(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            prints = []
            held, ends = [], []

            def flush() -> None:
                prints.append(fingerprint(np.array(held, dtype=np.uint64), np.array(ends, dtype=np.int64)))
                held.clear()
                ends.clear()

            for text in batch.column(text_name):
                text = text.as_py()
                if len(text) > 2 * TEXT_STRETCH:
                    flush()
                    prints.append(np.array([long_fingerprint(text, width, seed)], dtype=np.uint64))
                    continue
                held.extend(shingle_hashes(text, width, seed))
                ends.append(len(held))
                if len(held) > 200_000:
                    flush()
            flush()
            found = np.concatenate(prints).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(found)], names=[*keep, name])

    return rows.mapInArrow(compute, schema)


def linked_pairs(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Indices into the concatenation of ``a`` and ``b`` that link, as a spanning forest."""
    n = len(a)
    both = np.concatenate([a, b])
    low = np.arange(len(both))
    spans = []
    for rows in (np.arange(n), np.arange(n, len(both))):
        quarters = np.bitwise_count(both[rows, None].view(np.uint16)).astype(np.int16)
        rows = rows[np.lexsort(quarters.T[::-1])]
        quarters = np.bitwise_count(both[rows, None].view(np.uint16)).astype(np.int16)
        cuts = range(0, len(rows), STRETCH)
        spans.append(([rows[c : c + STRETCH] for c in cuts],
                      np.array([quarters[c : c + STRETCH].min(axis=0) for c in cuts]).reshape(-1, 4),
                      np.array([quarters[c : c + STRETCH].max(axis=0) for c in cuts]).reshape(-1, 4)))
    (left, left_min, left_max), (right, right_min, right_max) = spans
    held: list[np.ndarray] = []
    size = 0
    for k, rows in enumerate(left):
        gap = np.maximum(0, np.maximum(right_min - left_max[k], left_min[k] - right_max)).sum(axis=1)
        for m in np.flatnonzero(gap <= radius):
            if same and m < k:
                continue
            apart = np.bitwise_count(both[rows][:, None] ^ both[right[m]][None, :])
            i, j = np.nonzero(apart <= radius)
            i, j = rows[i], right[m][j]
            if same:  # b repeats a
                j = j - n
                i, j = i[i != j], j[i != j]
            if len(i):
                held.append(np.stack([i, j]))
                size += len(i)
        if size > 1_000_000 or (held and k == len(left) - 1):
            found = np.concatenate([*held, np.stack([np.arange(len(both)), low])], axis=1)
            low = forest(found[0], found[1], len(both))
            held, size = [], 0
    child = np.flatnonzero(low != np.arange(len(both)))
    return child, low[child]


def fingerprint_links(prints: DataFrame, radius: int = RADIUS, tile_rows: int | None = None) -> DataFrame:
    """Links ``(a, b)`` that connect the distinct ``fp`` values within ``radius`` bits of each other.

    Of each tile pair only a spanning forest of its links is returned: as few rows as
    fingerprints, and the same components.  Without ``tile_rows`` a tile holds about 16 times
    the root of their number (4096 at least), which keeps both the tile pairs and
    the bytes that they move well below the comparisons.
    """
    if tile_rows is None:
        tile_rows = max(4096, int(16 * prints.count() ** 0.5))
    counted = prints.select("fp", F.bit_count("fp").alias("ones"))
    sizes = counted.groupBy("ones").agg(F.ceil(F.count("*") / F.lit(tile_rows)).cast("int").alias("tiles"))  # 65 rows at most
    dealt = (counted.join(F.broadcast(sizes), "ones")
             .select("ones", F.pmod(F.xxhash64("fp"), "tiles").cast("int").alias("tile"), "fp"))

    def gather_tile(key: tuple, rows: pa.Table) -> pa.Table:
        raw = np.sort(rows.column("fp").to_numpy()).tobytes()
        return pa.table({"ones": pa.array([key[0].as_py()], pa.int32()), "tile": pa.array([key[1].as_py()], pa.int32()),
                         "fps": pa.array([raw], pa.binary())})

    tiles = stored(dealt.groupBy("ones", "tile").applyInArrow(gather_tile, "ones int, tile int, fps binary"), "tiles")
    names = tiles.select("ones", "tile")
    right = names.select(F.col("ones").alias("ones_b"), F.col("tile").alias("tile_b"))
    pairs = (names.withColumn("ones_b", F.explode(F.sequence(F.col("ones"), F.col("ones") + radius)))
             .join(right, "ones_b").where("ones < ones_b or tile <= tile_b"))
    pairs = stored(pairs.withColumn("same", F.expr("ones = ones_b and tile = tile_b")), "tile-pairs")
    other = tiles.select(F.col("ones").alias("ones_b"), F.col("tile").alias("tile_b"), F.col("fps").alias("fps_b"))
    met = pair_runs(pairs, tiles, ["ones", "tile"], other, ["ones_b", "tile_b"], ["same"]).select("is_right", "same", "fps", "fps_b")

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = None
        for batch in parts:
            for right, same, a, b in zip(*batch.columns):
                if not right.as_py():
                    x = np.frombuffer(a.as_py(), dtype=np.uint64)
                    continue
                y = np.frombuffer(b.as_py(), dtype=np.uint64)
                both = np.concatenate([x, y]).view(np.int64)
                i, j = linked_pairs(x, y, radius, same.as_py())
                yield pa.RecordBatch.from_arrays([pa.array(both[i]), pa.array(both[j])], names=["a", "b"])

    return met.mapInArrow(compare, "a long, b long")


def _classes(rows: DataFrame, radius: int, tile_rows: int | None) -> DataFrame:
    """``rows(doc_id, fp, ...)`` (a written table) -> ``(fp, first_id, n_rows, class_fp)`` per distinct fingerprint, written."""
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n_rows")), "prints")
    found = components(fingerprint_links(prints.select("fp"), radius, tile_rows))
    return stored(prints.join(found.select(F.col("node").alias("fp"), "component"), "fp", "left")
                  .select("fp", "first_id", "n_rows", F.coalesce("component", "fp").alias("class_fp")), "classes")


def near_duplicates(docs: DataFrame, *, width: int = SHINGLE, radius: int = RADIUS, seed: int = SEED,
                    tile_rows: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``.

    Null and empty texts have fingerprint zero and link like any other.  Texts of fewer
    than ``width`` words are one shingle.  Repeated rows and equal ids each give a row.
    ``component_id`` is the smallest id of the component that is not null, or null if there is
    none.  No rows give no rows; columns besides the two named ones are not read.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_bytes(text_col).alias("text"))
    rows = stored(with_fingerprint(rows, "fp", "text", width=width, seed=seed), "fingerprints")
    classed = _classes(rows, radius, tile_rows)
    heads = stored(classed.groupBy("class_fp").agg(F.min("first_id").alias("component_id"), F.count(F.lit(1)).alias("n_prints")), "heads")
    groups = stored(join_hot(classed.select("fp", "n_rows", "class_fp"), heads, "class_fp", "n_prints"), "groups")
    return (join_hot(rows, groups, "fp", "n_rows")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns; those that hold maps, which cannot be hashed, go as JSON."""
    return F.xxhash64(*(F.to_json(F.struct(f"`{c}`")) if "map<" in t or t == "variant" else F.col(f"`{c}`") for c, t in docs.dtypes))


def keep_one(docs: DataFrame, *, width: int = SHINGLE, radius: int = RADIUS, seed: int = SEED,
             tile_rows: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: one row of each component stays, whole.

    It is the one with the smallest id (nulls last), then the smallest hash of its
    columns; of rows equal in every column one stays.
    """
    ship(docs.sparkSession)
    columns = docs.columns
    rows = docs.select(F.col(id_col).alias("doc_id"), row_hash(docs).alias("row"), text_bytes(text_col).alias("text"))
    rows = stored(with_fingerprint(rows, "fp", "text", width=width, seed=seed), "fingerprints")
    classed = _classes(rows, radius, tile_rows)
    kept_id, kept_row, own_row = (fresh(c, columns) for c in ("kept_id", "kept_row", "own_row"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    of_print = rows.groupBy("fp").agg(F.min(order).alias("k"))  # before the join, so a print of many rows is one row
    kept = (of_print.join(classed.select("fp", "class_fp"), "fp").groupBy("class_fp").agg(F.min("k").alias("k"))
            .select(F.col("k.doc_id").alias(kept_id), F.col("k.row").alias(kept_row)))
    hashed = docs.withColumn(own_row, row_hash(docs))
    met = hashed.join(kept, F.col(f"`{id_col}`").eqNullSafe(F.col(kept_id)) & (F.col(own_row) == F.col(kept_row)), "left_semi")
    return met.dropDuplicates([id_col, own_row]).select(*(f"`{c}`" for c in columns))
