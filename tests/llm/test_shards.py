"""Minimax shards against plain Python over the whole list of groups."""

import hashlib
import random
import zlib
from collections import Counter

from llm_cases import ODD, SF_SMALL, documents

import __spark_entry__ as entry
from roadlake.llm import sharding
from roadlake.llm.sharding import Line, Segment


def digest(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def least_capacity(sizes, shards):
    """By dynamic programming: the smallest largest sum of ``shards`` contiguous parts."""
    inf = float("inf")
    best = [0] + [inf] * len(sizes)
    for _ in range(shards):
        best = [min(max(best[a], sum(sizes[a:b])) for a in range(b + 1)) for b in range(len(sizes) + 1)]
    return best[-1]


def check(rows, docs, shards, small=False):
    text = Counter((i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 8) for i, t in docs)
    assert Counter((r.doc_id, r.text_crc32, r.size) for r in rows) == text
    assert {r.law for r in rows} <= {"bytes"} and {r.grown_shard for r in rows} <= {None}
    slots = {}
    for r in rows:
        assert 0 <= r.shard < shards
        slots.setdefault(r.shard, []).append(r.slot)
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    of = {}
    for r in rows:
        assert of.setdefault(r.text_crc32, r.shard) == r.shard  # no two texts here share a crc32
    groups = Counter()
    for _, t in docs:
        groups[digest(t)] += len((t or "").encode()) + 8
    rest, left, heavy = sum(groups.values()), shards, []
    for d, size in sorted(groups.items(), key=lambda g: (-g[1], g[0])):
        if size * left <= rest:
            break
        heavy.append(d)
        rest, left = rest - size, left - 1
    light = [groups[d] for d in sorted(groups) if d not in heavy]
    total = Counter()
    for r in rows:
        total[r.shard] += r.size
    for k, d in enumerate(heavy):
        assert total[k] == groups[d]
    largest = max([total[k] for k in range(len(heavy), shards)], default=0)
    if small and light:
        assert largest == least_capacity(light, left)
    bound = max([*(groups[d] for d in heavy), 0])
    assert {r.capacity for r in rows} <= {max(largest, bound)} if small else True
    if light:
        assert largest <= rest / left + max(light)
    return total


def test_search_equals_dynamic_programming():
    rng = random.Random(7)
    for _ in range(400):
        sizes = [rng.choice([1, 2, 3, 9, 30]) for _ in range(rng.randint(1, 14))]
        shards = rng.randint(1, 6)
        line = Line([Segment(f"{k:064x}", s, 1, True) for k, s in enumerate(sizes)])
        best = least_capacity(sizes, shards)
        assert line.capacity(shards, line.floor) == best
        capacity, starts = sharding.cuts(line, shards)
        at = [0, *(int(s, 16) if s != sharding.END else len(sizes) for s in starts), len(sizes)]
        assert capacity == best and at == sorted(at)
        assert max(sum(sizes[a:b]) for a, b in zip(at, at[1:])) <= best


def test_opening_prefixes_finds_the_same_cuts(spark, monkeypatch):
    """Driven down digit by digit, the search ends where the whole list of groups ends."""
    monkeypatch.setattr(sharding, "FIRST", 1)
    monkeypatch.setattr(sharding, "STEP", 1)
    rng = random.Random(11)
    groups = {digest(str(k)): rng.choice([9, 40, 41, 300, 5000]) for k in range(400)}
    rows = spark.createDataFrame([(d, s) for d, s in groups.items()] + [(digest("0"), 7)] * 900, "digest string, size long").cache()
    groups[digest("0")] += 6300
    heavy, starts, capacity = sharding.plan(rows, 9, list_rows=0)
    whole, more = sharding.heavy_groups([Segment(d, s, 1, True) for d, s in groups.items()], 9)
    assert not more and [d[: len(p)] for d, p in zip((s.prefix for s in whole), heavy)] == heavy
    line = Line([Segment(d, groups[d], 1, True) for d in sorted(groups) if d not in {s.prefix for s in whole}])
    best, exact = sharding.cuts(line, 9 - len(whole))
    names = [s.prefix for s in line.segments] + [sharding.END]
    assert [next(n for n in names if n >= s) for s in starts] == exact
    assert capacity == max([best, *(s.size for s in whole)])


def test_odd_rows_and_empty(spark, odd, none):
    total = check(sharding.shard(odd).collect(), ODD, 24)
    assert len(total) <= 24
    check(sharding.shard(odd, shards=3).collect(), ODD, 3, small=True)
    assert sharding.shard(none).count() == 0
    assert sharding.shard(odd, shards=1).agg({"shard": "max"}).first()[0] == 0


def test_hot_group_fills_one_shard(spark):
    docs = [(k, "the same text for a third of all rows") for k in range(3000)] + [(k, f"text number {k} " * (k % 7)) for k in range(3000, 9000)]
    rows = sharding.shard(documents(spark, docs).repartition(7), shards=8).collect()
    total = check(rows, docs, 8)
    light = sorted(total.values())[:-1] if max(total.values()) > 2 * sum(total.values()) / 8 else list(total.values())
    assert max(light) < 1.2 * min(light)


def test_query_on_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    out = entry.queries()["op11_minimax_shards"](spark, SF_SMALL)
    assert dict(out.dtypes) | {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint",
                               "grown_shard": "int"} == dict(out.dtypes)
    check(out.collect(), docs, 24)
