"""SimHash, chunk dedup and components against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from llm_cases import EXTRA, ODD, SF_SMALL, documents
from pyspark.sql import functions as F

from roadlake.llm import chunk_dedup, simhash
from roadlake.llm.components import components, forest


def reach(nodes, links):
    low = {n: n for n in nodes}

    def root(n):
        while low[n] != n:
            n = low[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        low[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = random.Random(5)
    links = [(k, k + 1) for k in range(0, 60)] + [(rng.randrange(100, 300), rng.randrange(100, 300)) for _ in range(110)]
    links += [(500, k) for k in range(501, 560)] + [(7, 7), (8, 7), (7, 8)]
    edges = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    nodes = {n for a, b in links for n in (a, b) if a != b}
    expected = reach(nodes, links)
    assert {r.node: r.component for r in components(edges).collect()} == expected
    assert components(edges.limit(0)).count() == 0
    a, b = np.array(links).T
    low = forest(a, b, 600)
    assert all(low[n] == c for n, c in expected.items())


def plain_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, seed=42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


def plain_groups(rows):
    prints = [plain_print(t) for _, t in rows]
    distinct = sorted(set(prints))
    links = [(a, b) for k, a in enumerate(distinct) for b in distinct[k + 1 :] if (a ^ b).bit_count() <= 3]
    low = reach(distinct, links)
    first = defaultdict(lambda: None)
    for (i, _), p in zip(rows, prints):
        if i is not None:
            first[low[p]] = i if first[low[p]] is None else min(i, first[low[p]])
    key = lambda r: tuple((x is None, x) for x in r)
    return sorted(((i, f"{p:016x}", first[low[p]]) for (i, _), p in zip(rows, prints)), key=key)


def by_key(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, x) for x in r))


@pytest.mark.parametrize("tile_rows", [None, 40])
def test_simhash_table(spark, tile_rows):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = by_key(simhash.near_duplicates(docs, tile_rows=tile_rows).collect())
    assert got == plain_groups([(r.doc_id, r.text) for r in docs.collect()])


def test_simhash_long_text_in_stretches(spark, monkeypatch):
    """A text of any length, cut anywhere, has the fingerprint of the whole."""
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 3, 4, 900):
        text = b" \n".join(bytes(f"W{x}", "ascii") for x in rng.integers(0, 50, n))
        for width in (1, 3, 5):
            hashes = np.array(simhash.shingle_hashes(text, width, 42), dtype=np.uint64)
            for stretch in (1, 7, 100, 10_000):
                monkeypatch.setattr(simhash, "TEXT_STRETCH", stretch)
                assert simhash.long_fingerprint(text, width, 42) == int(simhash.fingerprint(hashes, np.array([len(hashes)]))[0])
    monkeypatch.undo()
    text = " ".join(f"w{k}" for k in range(800_000))  # 5 MB and more
    rows = simhash.near_duplicates(documents(spark, [(2, text), (1, text + " end"), (3, "x")])).collect()
    assert {r.doc_id: r.component_id for r in rows} == {1: 1, 2: 1, 3: 3}


def test_keep_one_with_maps_and_clashing_names(spark):
    rows = [(1, "a b c d", {"k": 1}, 5, 6), (1, "a b c d", {"k": 1}, 5, 6), (2, "a b c d", {"k": 2}, 7, 8), (3, None, None, 0, 0), (4, "", {}, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra map<string, int>, kept_id int, OWN_ROW int")
    kept = simhash.keep_one(docs)
    assert kept.schema == docs.schema and sorted(r.doc_id for r in kept.collect()) == [1, 3]


@pytest.mark.parametrize("hot_keys", [1, 3, 1000])
def test_hot_fingerprints(spark, monkeypatch, hot_keys):
    """A fingerprint and a class of a third of all rows: whichever keys count as hot, the rows are the same."""
    from roadlake.llm import shared

    monkeypatch.setattr(shared, "HOT_KEYS", hot_keys)
    rng = random.Random(3)
    rows = [(k, "" if k % 3 else "one text that many documents share") for k in range(60)]
    rows += [(100 + k, words(rng, 20)) for k in range(20)] + [(None, None), (5, "one text that many documents share")]
    docs = documents(spark, rows)
    assert by_key(simhash.near_duplicates(docs).collect()) == plain_groups(rows)
    kept = [r.doc_id for r in simhash.keep_one(docs).collect()]
    assert sorted(kept) == sorted({c for _, _, c in plain_groups(rows)})


def test_many_pairs_in_few_tasks(spark):
    """Blocks that meet: every pair once, its left block first, and a bounded number of tasks."""
    from roadlake.llm import shared

    left = spark.range(60).select(F.col("id").alias("a"), F.concat(F.lit("left"), "id").alias("x"))
    right = spark.range(90).select(F.col("id").alias("b"), F.concat(F.lit("right"), "id").alias("y"))
    pairs = left.select("a").join(right.select("b"), F.expr("(a + b) % 3 > 0")).withColumn("mark", F.expr("a = b"))
    met = shared.pair_runs(pairs, left, ["a"], right, ["b"], ["mark"])
    assert met.rdd.getNumPartitions() <= shared.MOST_TASKS
    seen = []
    for part in met.select("is_right", "x", "y", "mark").rdd.glom().collect():
        held = None
        for r in part:
            if not r.is_right:
                held = r.x
            else:
                seen.append((int(held[4:]), int(r.y[5:]), r.mark))
    assert sorted(seen) == sorted((a, b, a == b) for a in range(60) for b in range(90) if (a + b) % 3)


def test_simhash_odd(odd, none):
    assert by_key(simhash.near_duplicates(odd).collect()) == plain_groups(ODD)
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.keep_one(odd)
    groups = plain_groups(ODD)
    assert kept.columns == odd.columns and kept.count() == len({p for _, p, _ in groups}) - _linked(groups)
    ids = [r.doc_id for r in kept.collect()]
    assert set(ids) >= {c for _, _, c in groups if c is not None} and len(ids) == len(set(ids))
    assert simhash.keep_one(none).count() == 0


def _linked(groups):
    prints = sorted({int(p, 16) for _, p, _ in groups})
    low = reach(prints, [(a, b) for k, a in enumerate(prints) for b in prints[k + 1 :] if (a ^ b).bit_count() <= 3])
    return sum(low[p] != p for p in prints)


def test_simhash_spark_hash(spark):
    got = spark.sql("select xxhash64('the quick brown') as h").first().h & (1 << 64) - 1
    assert simhash.shingle_hashes(b"The quick  brown", 3, 42) == [got]


def test_linked_pairs_planted():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    near = base[:150] ^ (np.uint64(1) << rng.integers(0, 64, 150).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 150).astype(np.uint64))
    far = base[150:200] ^ np.uint64(0b1111)
    a, b = base, np.concatenate([near, far])
    expected = reach(range(500), [(i, 300 + j) for i in range(300) for j in range(200) if int(a[i] ^ b[j]).bit_count() <= 3])
    child, parent = simhash.linked_pairs(a, b, 3, False)
    got = reach(range(500), list(zip(child.tolist(), parent.tolist())))
    assert got == expected
    both = np.concatenate([a, b])
    expected = reach(range(500), [(i, j) for i in range(500) for j in range(i) if int(both[i] ^ both[j]).bit_count() <= 3])
    child, parent = simhash.linked_pairs(both, both, 3, True)
    assert reach(range(500), list(zip(child.tolist(), parent.tolist()))) == expected


# --- chunks --------------------------------------------------------------


def plain_gear(data):
    h, out = 0, []
    for b in data:
        h = ((h << 1) + int(chunk_dedup.GEAR[b])) & 0xFFFFFFFF
        out.append(h)
    return out


def plain_ends(text, w=chunk_dedup.REACH):
    pad = b"\0" * 64
    data = pad + text + pad
    h = plain_gear(data)
    for p in range(len(data) - 1):
        if data[p + 1] & 0xC0 == 0x80:
            h[p] = 0
    ends = []
    for p in range(64, 64 + len(text) - 1):
        if h[p] > max(h[p - w : p]) and h[p] >= max(h[p + 1 : p + 1 + w]):
            ends.append(p - 63)
    return ends + [len(text)] if text else []


def test_chunk_ends():
    texts = ["".join(random.Random(k).choices("abcdef ghé日\n", k=900)).encode() for k in range(4)] + [b"", b"a", b"z" * 300]
    assert chunk_dedup.chunk_ends(texts) == [plain_ends(t) for t in texts]
    long = [("é" * 9000).encode()]
    for t, ends in zip(long, chunk_dedup.chunk_ends(long)):
        sizes = np.diff([0, *ends])
        assert sizes.max() <= chunk_dedup.MAX_CHUNK and all(t[a:b].decode() for a, b in zip([0, *ends], ends))


@pytest.mark.parametrize("n_words", [60, 300])
def test_periodic_passages(n_words):
    """A phrase of 1 to 16 bytes over and over is cut alike whatever stands around it."""
    phrases = ["no money down, x"[16 - k :] for k in range(2, 17)] + ["Retionly ", "ha ", "buy now ", "no money down, ", "日本 ", "é "]
    phrases = [p if " " in p else p[:-1] + " " for p in phrases] + ["z" * 4, "-" * 5]
    rng = random.Random(n_words)
    for phrase in phrases:
        passage = (phrase * (n_words // len(phrase.split()) + 1)).encode().strip()
        if len(passage) < chunk_dedup.MIN_RUN + 2 * len(phrase):
            continue
        for _ in range(5):
            sides = [words(rng, 50).encode() for _ in range(4)]
            texts = [b" ".join([sides[2 * k], passage, sides[2 * k + 1]]) for k in range(2)]
            first, second = chunk_dedup.chunk_ends(texts)
            assert b"".join(texts[1][a:b] for a, b in zip([0, *second], second)) == texts[1] and second == sorted(set(second))
            known = set(chunk_dedup.digests(texts[0], first))
            owners = [(1,) if d in known else None for d in chunk_dedup.digests(texts[1], second)]
            spans = chunk_dedup.repeated_spans(texts[1], second, owners, chunk_dedup.MIN_RUN)
            assert len(spans) == 1, phrase
            start = len(sides[2]) + 1
            assert start - 2 <= spans[0][0] <= start + 33 and start + len(passage) - 33 <= spans[0][1] <= start + len(passage) + 2, phrase


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(n))


def test_insertion_moves_few_chunks():
    rng = random.Random(9)
    a = words(rng, 600).encode()
    b = a[:1500] + b"inserted here " + a[1500:]
    one, two = (set(chunk_dedup.digests(t, e)) for t, e in zip((a, b), chunk_dedup.chunk_ends([a, b])))
    assert len(one - two) <= 3


@pytest.mark.parametrize("block_bytes", [1 << 24, 3000])
def test_passages(spark, block_bytes):
    rng = random.Random(4)
    passages = [words(rng, 52 + k) for k in range(6)]
    rows, holds = [], {}
    for i in range(60):
        mine = passages[i % 6] if i >= 30 and i % 2 == 0 else None
        body = [words(rng, 40), words(rng, 30)]
        rows.append((i, f"{body[0]} {mine} {body[1]}" if mine else " ".join(body)))
        if mine:
            holds.setdefault(i % 6, []).append(i)
    docs = documents(spark, rows)
    found = chunk_dedup.repeated_passages(docs, block_bytes=block_bytes).collect()
    caught = {r.doc_id for r in found}
    assert caught == {i for ids in holds.values() for i in ids[1:]}
    for r in found:
        assert r.owner_id == next(ids[0] for ids in holds.values() if r.doc_id in ids)
        cut = rows[r.doc_id][1][r.start : r.end]
        assert cut in rows[r.owner_id][1] and len(cut.split()) >= 14 and len(cut) == r.n_chars
    kept = {r.doc_id: r.text for r in chunk_dedup.cut_repeats(docs, block_bytes=block_bytes).collect()}
    assert len(kept) == 60
    for i, text in rows:
        spans = sorted((r.start, r.end) for r in found if r.doc_id == i)
        at, out = 0, ""
        for a, b in spans:
            out, at = out + text[at:a], b
        assert kept[i] == out + text[at:]
        assert set(kept[i].split()) <= set(text.split())  # no word is torn


def test_chunks_odd(spark, odd, none):
    got = chunk_dedup.cut_repeats(odd, min_run=20)
    rows = {(r.doc_id, r.text) for r in got.collect()}
    assert got.columns == odd.columns and got.schema == odd.schema
    # of the three equal texts one stays, the others lose all they have
    assert len(rows) == got.count() == len(ODD) - 2
    assert {r for r in rows if r[1] and "MIT" in r[1]} == {(6, ODD[7][1])}
    assert chunk_dedup.cut_repeats(none).count() == 0 and chunk_dedup.repeated_passages(none).count() == 0
    # within one document, and with the first copy under a null id
    text = words(random.Random(2), 80)
    docs = documents(spark, [(None, text), (5, f"{text} {words(random.Random(3), 30)} {text}")])
    spans = chunk_dedup.repeated_passages(docs).collect()
    assert {(r.doc_id, r.owner_id) for r in spans} == {(5, 5), (None, 5)}


def test_length_follows(spark):
    text = words(random.Random(2), 90)
    docs = documents(spark, [(1, text), (2, "start here " + text + " then the end of it")]).withColumn("n_chars", F.length("text"))
    rows = {r.doc_id: r for r in chunk_dedup.cut_repeats(docs, length_col="n_chars").collect()}
    assert rows[1].text == text and all(r.n_chars == len(r.text) for r in rows.values()) and len(rows[2].text) < 150
    assert set(EXTRA) <= set(docs.columns)
