"""Embedding near-duplicates: cosine at or above a threshold, found by cover trees.

Unit vectors within cosine c of each other lie within ``sqrt(2 - 2c)``, so the join is a
distance join.  Equal vectors of a group are one point.  The upper levels of a group's tree are
nested nets with halving radii over a sample of it; each point goes to its nearest centre, so a cell holds points
close to each other, and pairs of cells too far apart are dropped before any point is read.  A cell's
points form blocks of bounded size; a block's tree (nested levels of centres, the covering
radius halves from level to level) is built once and stored.  Pairs of blocks are compared by a
dual traversal that drops a pair of nodes once the distance of their centres exceeds both covering
radii and the threshold.
"""

from __future__ import annotations

import logging
import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bitslice import usable
from .components import components, forest
from .shared import pair_runs, ship, stored

LOG = logging.getLogger(__name__)

COSINE = 0.93
BLOCK_ROWS = 2048
#: Cells of one group at most, points sampled per cell, and numbers in all centres together (every task holds them).
CELLS, SAMPLED, CENTRE_NUMBERS = 256, 32, 4 << 20
LEAF = 32
#: Guards the bounds against rounding; links themselves are decided by the cosine.
SLACK = 1e-7


@dataclass
class Node:
    rows: np.ndarray  # all points below
    centre: int
    radius: float  # largest distance from the centre to a point below
    level: int  # that radius is at most the root's divided by 2 ** level
    children: list["Node"] = field(default_factory=list)
    centres: np.ndarray | None = None  # of the children, with their radii
    radii: np.ndarray | None = None


def distances(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, ((points - centre) ** 2).sum(axis=1)))


def build(points: np.ndarray, leaf: int = LEAF) -> Node:
    """The cover tree of ``points``: the root covers all, each level's radius is half the one above.

    A node's children are centred on a net of its points: its own centre first (levels are
    nested), then each point that no chosen centre covers; points go to the first centre
    within the level's radius.
    """
    apart = np.sqrt(np.maximum(0.0, 2 - 2 * points @ points.T))  # of one block: a bounded table
    root = Node(np.arange(len(points)), 0, float(apart[0].max()), 0)
    open_ = [(root, 1)]
    while open_:
        node, level = open_.pop()
        radius = root.radius / 2**level
        if len(node.rows) <= leaf or node.radius <= SLACK:
            continue
        rest, centre = node.rows, node.centre
        while len(rest):
            away = apart[centre, rest]
            near = away <= radius
            near[rest == centre] = True
            child = Node(rest[near], int(centre), float(away[near].max()), level)
            node.children.append(child)
            rest = rest[~near]
            centre = rest[0] if len(rest) else None
        if len(node.children) == 1:  # nothing to part at this radius: go on with the next level
            node.children = []
            open_.append((node, level + 1))
            continue
        node.centres = np.array([c.centre for c in node.children])
        node.radii = np.array([c.radius for c in node.children])
        open_.extend((c, level + 1) for c in node.children)
    return root


def links(points_a: np.ndarray, points_b: np.ndarray, tree_a: Node, tree_b: Node, cosine: float,
          same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index arrays ``(i, j)`` of every pair with cosine >= ``cosine``; with ``same`` each pair once, i < j."""
    reach = np.sqrt(max(0.0, 2 - 2 * cosine))
    stack = [(tree_a, tree_b)]
    while stack:
        a, b = stack.pop()
        parts_a = a.children or [a]
        parts_b = b.children or [b]
        if a.children or b.children:
            at_a = a.centres if a.children else np.array([a.centre])
            at_b = b.centres if b.children else np.array([b.centre])
            radius_a = a.radii if a.children else np.array([a.radius])
            radius_b = b.radii if b.children else np.array([b.radius])
            apart = np.sqrt(np.maximum(0.0, 2 - 2 * points_a[at_a] @ points_b[at_b].T))
            close = apart <= radius_a[:, None] + radius_b[None, :] + reach + SLACK
            if same and a is b:
                close = np.triu(close)
            i, j = np.nonzero(close)
            if not len(i):
                continue
            ones = np.array([len(p.rows) == 1 for p in parts_a])[i] & np.array([len(p.rows) == 1 for p in parts_b])[j]
            if ones.any():  # single points: decided here, all at once
                rows_i = np.array([p.rows[0] for p in parts_a])[i[ones]]
                rows_j = np.array([p.rows[0] for p in parts_b])[j[ones]]
                yield from _decided(points_a, points_b, rows_i, rows_j, cosine, same)
            stack.extend((parts_a[x], parts_b[y]) for x, y in zip(i[~ones], j[~ones]))
            continue
        rows_i = np.repeat(a.rows, len(b.rows))
        rows_j = np.tile(b.rows, len(a.rows))
        if same and a is b:
            later = rows_i < rows_j
            rows_i, rows_j = rows_i[later], rows_j[later]
        yield from _decided(points_a, points_b, rows_i, rows_j, cosine, same)


def _decided(points_a, points_b, i, j, cosine, same):
    if same:
        i, j = i[i != j], j[i != j]
    if not len(i):
        return
    keep = np.einsum("ij,ij->i", points_a[i], points_b[j]) >= cosine
    if keep.any():
        i, j = i[keep], j[keep]
        yield (np.minimum(i, j), np.maximum(i, j)) if same else (i, j)


def unit(flat: np.ndarray, dim: int) -> np.ndarray:
    x = flat.astype(np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares of tiny or huge values stay finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def net(points: np.ndarray, cells: int) -> np.ndarray:
    """Rows of up to ``cells`` centres: nested nets of halving radii, each point that a level leaves uncovered is a centre, the furthest first."""
    chosen, away = [0], distances(points, points[0])
    radius = away.max()
    while len(chosen) < min(cells, len(points)) and radius > SLACK:
        radius /= 2
        while len(chosen) < cells and away.max() > radius:
            chosen.append(int(away.argmax()))
            away = np.minimum(away, distances(points, points[chosen[-1]]))
    return np.array(chosen)


def centres_of(points: DataFrame, block_rows: int) -> dict[tuple, np.ndarray]:
    """The centres of every group with more points than a block holds: ``(g, dim)`` -> rows of unit vectors.

    Largest groups first, within ``CENTRE_NUMBERS``; the nets are made in tasks, from a sample of
    about ``SAMPLED`` points a cell.  Groups beyond that bound stay one cell.
    """
    sizes = (points.groupBy("g", F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block_rows)
             .orderBy(F.desc("n")).limit(CENTRE_NUMBERS // 64).collect())
    room, wanted = CENTRE_NUMBERS, []
    for r in sizes:
        cells = min(CELLS, 2 * math.ceil(r["n"] / block_rows), room // r["dim"])
        if cells < 2:
            break
        room -= cells * r["dim"]
        wanted.append((r["g"], r["dim"], cells, int(min(1.0, cells * SAMPLED / r["n"]) * (1 << 30))))
    if not wanted:
        return {}
    g_type = points.schema["g"].dataType.simpleString()
    asked = points.sparkSession.createDataFrame(wanted, f"g {g_type}, dim int, cells int, share long")
    # as many rows as groups have centres
    sample = (points.select("g", F.size("v").alias("dim"), "point", "v").join(F.broadcast(asked), ["g", "dim"])
              .where(F.pmod(F.xxhash64("point"), F.lit(1 << 30)) < F.col("share")))

    def make(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("point")
        x = unit(table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False), key[1].as_py())
        c = x[net(x, table.column("cells")[0].as_py())]
        return pa.table({"g": pa.array([key[0].as_py()], key[0].type), "dim": pa.array([key[1].as_py()], pa.int32()), "centres": pa.array([c.tobytes()], pa.binary())})

    found = sample.groupBy("g", "dim").applyInArrow(make, f"g {g_type}, dim int, centres binary").toArrow()
    return {(g, dim): np.frombuffer(c, np.float64).reshape(-1, dim) for g, dim, c in zip(*(found.column(c).to_pylist() for c in ("g", "dim", "centres")))}


def near_duplicates(vectors: DataFrame, *, cosine: float = COSINE, block_rows: int = BLOCK_ROWS, leaf: int = LEAF,
                    group: Column | str = "label", id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Vectors link when their groups are equal and not null and their cosine in double
    precision is at least ``cosine``.  ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest id reachable by links and ``kept`` says whether the row
    has it.  Null or zero vectors, vectors with null or non-finite components and rows
    without a group link with nothing (0 links, own id, kept).  Vectors of different
    lengths do not link.  Rows with equal ids each have a row; a null id counts as linked
    but is never a component's smallest, and its ``kept`` is null.  No rows give no rows.
    """
    ship(vectors.sparkSession)
    group = F.col(group) if isinstance(group, str) else group
    fits = usable(vector_col) & F.exists(vector_col, lambda x: x != 0) & group.isNotNull()
    every = vectors.select(F.col(id_col).alias("vec_id"), F.when(fits, group).alias("g"), F.when(fits, F.col(vector_col)).alias("v"))
    # equal vectors of a group are one point; its copies are only counted, its number is given once
    points = stored(every.where("v is not null").groupBy("g", "v").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
                    .withColumn("point", F.monotonically_increasing_id()), "points")
    g_type, g_arrow = points.schema["g"].dataType.simpleString(), points.select("g").limit(0).toArrow().schema.field("g").type
    shared = vectors.sparkSession.sparkContext.broadcast(centres_of(points, block_rows))  # at most CENTRE_NUMBERS numbers

    def deal(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value
        for batch in parts:
            v = batch.column("v")
            dims, cells = pc.list_value_length(v).to_numpy(), np.zeros(len(v), dtype=np.int32)
            rows: dict[tuple, list[int]] = {}
            for r, key in enumerate(zip(batch.column("g").to_pylist(), dims.tolist())):
                if key in centres:
                    rows.setdefault(key, []).append(r)
            for key, at in rows.items():
                x = unit(v.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False), key[1])
                cells[at] = (x @ centres[key].T).argmax(axis=1)  # the nearest centre
            yield pa.RecordBatch.from_arrays([batch.column("g"), pa.array(dims.astype(np.int32)), pa.array(cells), batch.column("point"), batch.column("copies"), v],
                                             names=["g", "dim", "cell", "point", "copies", "v"])

    v_type = points.schema["v"].dataType.simpleString()
    dealt = stored(points.select("g", "point", "copies", "v").mapInArrow(deal, f"g {g_type}, dim int, cell int, point long, copies long, v {v_type}"), "dealt")
    cell = ["g", "dim", "cell"]
    sizes = dealt.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("int").alias("blocks"))
    dealt = dealt.join(sizes, cell).withColumn("block", F.pmod(F.xxhash64("point"), "blocks").cast("int"))

    def plant(key: tuple, table: pa.Table) -> pa.Table:
        g, dim, c, block = (k.as_py() for k in key)
        x = unit(table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False), dim)
        centre = shared.value[g, dim][c] if (g, dim) in shared.value else x.mean(axis=0)
        return pa.table({"g": pa.array([g], g_arrow), "dim": pa.array([dim], pa.int32()), "cell": pa.array([c], pa.int32()), "block": pa.array([block], pa.int32()),
                         "points": pa.array([table.column("point").to_numpy().astype("<i8").tobytes()], pa.binary()),
                         "copies": pa.array([table.column("copies").to_numpy().astype("<i8").tobytes()], pa.binary()),
                         "units": pa.array([x.tobytes()], pa.binary()), "tree": pa.array([pickle.dumps(build(x, leaf))], pa.binary()),
                         "centre": pa.array([centre.tolist()], pa.list_(pa.float64())), "radius": pa.array([float(distances(x, centre).max())], pa.float64())})

    blocks = stored(dealt.groupBy(*cell, "block").applyInArrow(
        plant, f"g {g_type}, dim int, cell int, block int, points binary, copies binary, units binary, tree binary, centre array<double>, radius double"), "blocks")
    reach = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + SLACK
    balls = blocks.select(*cell, "block", "centre", "radius")
    other = balls.select("g", "dim", *(F.col(c).alias(f"{c}_b") for c in ("cell", "block", "centre", "radius")))
    apart = F.sqrt(F.aggregate(F.zip_with("centre", "centre_b", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    later = (F.col("cell") < F.col("cell_b")) | ((F.col("cell") == F.col("cell_b")) & (F.col("block") <= F.col("block_b")))
    pairs = (balls.join(other, ["g", "dim"]).where(later).where(apart <= F.col("radius") + F.col("radius_b") + F.lit(reach))
             .select(*cell, "block", F.col("g").alias("g_b"), F.col("dim").alias("dim_b"), "cell_b", "block_b",
                     ((F.col("cell") == F.col("cell_b")) & (F.col("block") == F.col("block_b"))).alias("same")))
    pairs = stored(pairs, "block-pairs")
    held = blocks.groupBy("g", "dim").agg(F.count(F.lit(1)).alias("n")).agg(F.sum(F.expr("n * (n + 1) / 2"))).first()[0] or 0
    LOG.info("%d of %d pairs of blocks are close enough to be compared", pairs.count(), held)
    payload = ["points", "copies", "units", "tree"]
    left = blocks.select(*cell, "block", *payload)
    right = blocks.select(*(F.col(c).alias(f"{c}_b") for c in [*cell, "block", *payload]))
    met = pair_runs(pairs, left, [*cell, "block"], right, ["g_b", "dim_b", "cell_b", "block_b"], ["same"])
    met = met.select("is_right", "same", "dim", *payload, *(f"{c}_b" for c in payload))

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for row in zip(*batch.columns):
                is_right, same, dim, *raw = (x.as_py() for x in row)
                ids, copies, units, tree = raw[4:] if is_right else raw[:4]
                block = (np.frombuffer(ids, "<i8"), np.frombuffer(copies, "<i8"), np.frombuffer(units, np.float64).reshape(-1, dim), pickle.loads(tree))
                if not is_right:
                    (ids_a, copies_a, a, tree_a) = block
                    continue
                ids_b, copies_b, b, tree_b = block
                if same:
                    tree_b = tree_a
                yield _summary(links(a, b, tree_a, tree_b, cosine, same), ids_a, copies_a, ids_b, copies_b, same)

    found = stored(met.mapInArrow(compare, "point long, links long, parent long"), "links")
    counts = found.groupBy("point").agg(F.sum("links").alias("n"))
    edges = found.where("parent is not null").select(F.col("point").alias("a"), F.col("parent").alias("b"))
    classes = components(edges)
    classed = (points.select("point", "first_id", "copies").join(counts, "point", "left")
               .join(classes.select(F.col("node").alias("point"), "component"), "point", "left")
               .select("point", "first_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                       F.coalesce("component", "point").alias("class")))
    heads = classed.groupBy("class").agg(F.min("first_id").alias("component_id"))
    classed = classed.join(heads, "class").select("point", "n_links", "component_id")
    # back to the rows by the vectors themselves
    numbers = points.select("g", "v", "point").join(classed, "point").select("g", "v", "n_links", "component_id")
    linked = every.where("v is not null").join(numbers, ["g", "v"]).select("vec_id", "n_links", "component_id")
    alone = every.where("v is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _summary(found, ids_a, copies_a, ids_b, copies_b, same) -> pa.RecordBatch:
    """Per point of a block pair: its links there (copies counted) and a parent in a spanning forest of them."""
    n = len(ids_a)
    size = n if same else n + len(ids_b)
    ids = ids_a if same else np.concatenate([ids_a, ids_b])
    copies = copies_a if same else np.concatenate([copies_a, copies_b])
    counts = np.zeros(size)
    low = np.arange(size)
    held, rows = [], 0

    def settle() -> np.ndarray:
        pairs = np.concatenate([*held, np.stack([np.arange(size), low])], axis=1)
        return forest(pairs[0], pairs[1], size)

    for i, j in found:
        j = j if same else j + n
        counts += np.bincount(i, copies[j], size) + np.bincount(j, copies[i], size)
        held.append(np.stack([i, j]))
        rows += len(i)
        if rows > 1_000_000:
            low, held, rows = settle(), [], 0
    if held:
        low = settle()
    used = np.flatnonzero(counts)
    parent = [None if low[u] == u else int(ids[low[u]]) for u in used]
    return pa.RecordBatch.from_arrays([pa.array(ids[used]), pa.array(counts[used].astype(np.int64)), pa.array(parent, pa.int64())],
                                      names=["point", "links", "parent"])
