"""Bit-sliced top-k and the cover-tree join against brute force."""

import numpy as np
import pytest
from llm_cases import SF_SMALL
from pyspark.sql import functions as F

from roadlake.llm import bitslice, cover_tree

SCHEMA = "vec_id long, embedding array<float>, label int, block int, dim int, score string, point string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, g, 1, 2, "x", "y") for i, v, g in rows], SCHEMA)


def odd_rows(n=180, dim=6, seed=1):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim)).astype(np.float32)
    base[40:60] = base[0] + rng.normal(size=(20, dim)).astype(np.float32) * 0.05
    base[60:70] = base[1]
    rows = [(int(i), base[i].tolist(), int(i) % 3 if i % 7 else None) for i in range(n)]
    rows += [(500, None, 1), (550, [0.0] * dim, 1), (600, [float("nan")] * dim, 1), (650, [None] * dim, 1), (700, [float("inf")] + [0.0] * (dim - 1), 1),
             (750, [1.0, 2.0], 1), (800, [1.0, 2.1], 1), (None, base[1].tolist(), 1), (850, [], 1), (900, [-0.5] * dim, 1),
             (950, base[1].tolist(), 1), (950, base[1].tolist(), 1)]
    return rows


def good(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def plain_top(rows, k=5):
    usable = [(i, np.floor(256 * np.array(v, dtype=np.float64)).astype(np.int64)) for i, v, _ in rows if i is not None and good(v)]
    out, seen = [], set()
    for i, q in usable:
        if i % 50 or (i, q.tobytes()) in seen:
            continue
        seen.add((i, q.tobytes()))
        scores = sorted((-int(q @ v), j) for j, v in usable if j != i and len(v) == len(q))[:k]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("block_rows,shard", [(16_384, 256), (20, 2)])
def test_top_k_odd(spark, block_rows, shard):
    rows = odd_rows()
    got = bitslice.top_k(table(spark, rows), F.col("vec_id") % 50 == 0, block_rows=block_rows, query_shard=shard)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == plain_top(rows)


def test_top_k_large_components(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=4) * 10.0 ** rng.integers(0, 7)], 0) for i in range(300)]
    rows += [(1000, [1e6, 40000.0, -1e6, 32768.0], 0), (1050, [-3e5] * 4, 0)]
    assert sorted(map(tuple, bitslice.top_k(table(spark, rows), F.col("vec_id") % 50 == 0, block_rows=64).collect())) == plain_top(rows)
    far = bitslice.top_k(table(spark, [(50, [3e9, 3e9], 0), (1, [3e9, 3e9], 0)]), F.col("vec_id") % 50 == 0)
    with pytest.raises(Exception, match="does not fit in a long"):
        far.collect()


def test_top_k_table_and_empty(spark):
    vectors = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in vectors.collect()]
    assert sorted(map(tuple, bitslice.top_k(vectors, F.col("vec_id") % 50 == 0).collect())) == plain_top(rows)
    assert bitslice.top_k(vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_ties(spark):
    rows = [(i, [0.5, 0.25], 0) for i in range(200)]
    got = bitslice.top_k(table(spark, rows), F.col("vec_id") % 50 == 0, block_rows=30)
    assert sorted(map(tuple, got.collect())) == plain_top(rows)


def test_score_slices():
    rng = np.random.default_rng(2)
    q = rng.integers(-300, 300, (130, 9))
    index = bitslice.Index(np.arange(130), bitslice.slices_of(q))
    for query in (q[3], np.zeros(9, dtype=np.int64), -q[5]):
        slices, offset = index.score_slices(query)
        bits = sum(np.unpackbits(s.view(np.uint8), bitorder="little")[:130].astype(np.int64) << t for t, s in enumerate(slices))
        assert (bits - offset == q @ query).all()


def plain_links(rows, cosine=0.93):
    fit = [good(v) and any(v) and g is not None for _, v, g in rows]
    unit = [np.array(v, dtype=np.float64) / np.linalg.norm(np.array(v, dtype=np.float64)) if f else None for (_, v, _), f in zip(rows, fit)]
    near = [[b for b in range(len(rows)) if b != a and fit[a] and fit[b] and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b])
             and float(unit[a] @ unit[b]) >= cosine] for a in range(len(rows))]
    out = []
    for a in range(len(rows)):
        seen, open_ = {a}, [a]
        while open_:
            for b in near[open_.pop()]:
                if b not in seen:
                    seen.add(b)
                    open_.append(b)
        ids = [rows[b][0] for b in seen if rows[b][0] is not None]
        first = min(ids) if ids else None
        i = rows[a][0]
        out.append((i, len(near[a]), first, None if i is None else i == first))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_rows,leaf", [(2048, 32), (16, 2)])
def test_links_odd(spark, block_rows, leaf):
    rows = odd_rows()
    got = cover_tree.near_duplicates(table(spark, rows), block_rows=block_rows, leaf=leaf)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_links(rows)


def test_links_table_and_empty(spark):
    vectors = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding, r.label) for r in vectors.collect()]
    assert sorted(map(tuple, cover_tree.near_duplicates(vectors).collect()), key=str) == plain_links(rows)
    assert cover_tree.near_duplicates(vectors.limit(0)).count() == 0


def test_tree_covers_and_links():
    rng = np.random.default_rng(8)
    x = cover_tree.unit(np.concatenate([rng.normal(size=(200, 5)), np.ones((40, 5)) + rng.normal(size=(40, 5)) * 0.1]).ravel(), 5)
    tree = cover_tree.build(x, leaf=4)
    open_, leaves = [tree], []
    while open_:
        node = open_.pop()
        assert cover_tree.distances(x[node.rows], x[node.centre]).max() <= node.radius + cover_tree.SLACK
        if node.children:
            assert node.children[0].centre == node.centre  # nested
            assert sorted(r for c in node.children for r in c.rows) == sorted(node.rows)
            assert all(c.level > node.level and c.radius <= tree.radius / 2**c.level + cover_tree.SLACK for c in node.children)
            centres = x[node.centres]
            apart = np.sqrt(((centres[:, None] - centres[None, :]) ** 2).sum(axis=2))[np.triu_indices(len(centres), 1)]
            assert apart.min() > tree.radius / 2 ** node.children[0].level - cover_tree.SLACK  # a net
        else:
            leaves.extend(node.rows)
        open_.extend(node.children)
    assert sorted(leaves) == list(range(240))
    for cosine in (0.93, 0.5):
        got = sorted((i, j) for a, b in cover_tree.links(x, x, tree, tree, cosine, True) for i, j in zip(a.tolist(), b.tolist()))
        assert got == [(i, j) for i in range(240) for j in range(i + 1, 240) if x[i] @ x[j] >= cosine]


def clustered(n, dim=16, clusters=40, seed=4):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(clusters, dim))
    return (middle[rng.integers(0, clusters, n)] + rng.normal(size=(n, dim)) * 0.05).astype(np.float32)


def test_nets_are_nested_and_spread():
    x = cover_tree.unit(clustered(600).ravel(), 16)
    few, many = cover_tree.net(x, 20), cover_tree.net(x, 60)
    assert many[:20].tolist() == few.tolist() and len(set(many.tolist())) == 60
    away = np.min([cover_tree.distances(x, x[c]) for c in cover_tree.net(x, 40)], axis=0)
    assert away.max() < 0.6  # forty centres cover forty clusters
    assert cover_tree.net(x[:1], 5).tolist() == [0] and len(cover_tree.net(np.repeat(x[:1], 9, axis=0), 5)) == 1


def test_cells_drop_block_pairs(spark, caplog):
    """Clustered vectors of one label: the same links as by all products, from a small share of the block pairs."""
    x = clustered(4000)
    rows = [(i, v.tolist(), 1 if i % 10 else 2) for i, v in enumerate(x)]
    with caplog.at_level("INFO", logger="roadlake.llm.cover_tree"):
        got = cover_tree.near_duplicates(table(spark, rows), block_rows=100, leaf=8).collect()
    compared, of = caplog.records[-1].args
    assert compared < of / 4
    unit = cover_tree.unit(x.ravel(), 16)
    group = np.array([1 if i % 10 else 2 for i in range(len(x))])
    near = (unit @ unit.T >= 0.93) & (group[:, None] == group[None, :])
    assert {r.vec_id: r.n_links for r in got} == {i: int(near[i].sum()) - 1 for i in range(len(x))}
    a, b = np.nonzero(near)
    from roadlake.llm.components import forest
    low = forest(a, b, len(x))
    assert {r.vec_id: r.component_id for r in got} == {i: int(low[i]) for i in range(len(x))}
