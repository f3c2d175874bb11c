"""Periodic runs against a plain search over every lag."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
from llm_cases import ODD, SF_SMALL, documents

import __spark_entry__ as entry
from roadlake.llm import periodic, queries


def plain_runs(w):
    """Every maximal stretch of every lag whose smallest period is that lag."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if size >= max(6, 4 * q):
                s = w[i : i + size]
                if not any(s[p:] == s[:-p] for p in range(1, q)):
                    out.append((i, size, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def plain_kept(w, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return b" ".join(x for k, x in enumerate(w) if k not in gone)


def made_periodic(doc_id, w):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 0
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def test_runs_equal_plain_search():
    rng = random.Random(5)
    for _ in range(1500):
        docs = []
        for _ in range(rng.randint(0, 4)):
            n, letters = rng.choice([0, 1, 5, 6, 8, 20, 60, 130]), rng.choice([1, 2, 3, 5, 30])
            w = [rng.randrange(letters) for _ in range(n)]
            for _ in range(rng.randint(0, 3)):  # stretches with planted periods, also next to and inside each other
                if n:
                    a = rng.randrange(n)
                    p, b = 1 + rng.randrange(max(1, (n - a) // 3)), rng.randint(a, n)
                    w = [w[a + (i - a) % p] if a <= i < b else w[i] for i in range(n)]
            docs.append(w)
        got = periodic.find_runs(np.array([x for d in docs for x in d], dtype=np.int64), np.array([len(d) for d in docs], dtype=np.int64))
        assert [tuple(map(int, r)) for r in got] == [(d, *r) for d, w in enumerate(docs) for r in plain_runs(w)]


def test_runs_within_runs():
    inner = ["a", "b"] * 4 + ["c"]
    for w in (inner * 5, ["x", *(inner * 4), "y"], ["a"] * 6, ["a"] * 5, ["a", "b", "c"] * 4, (["a", "b", "c"] * 4)[:-1]):
        sizes, runs, kept = periodic.collapse([" ".join(w).encode()])
        assert sizes == [len(w)] and [tuple(map(int, r)) for r in runs[0]] == plain_runs(w)
        assert kept[0] == plain_kept([x.encode() for x in w], plain_runs(w))


def check(rows, docs):
    expected = sorted((i is None, i or 0, len(plain_words(t)), plain_runs(plain_words(t)), plain_kept(plain_words(t), plain_runs(plain_words(t))))
                      for i, t in docs)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed.encode()) for r in rows) == expected


def test_odd_rows_and_empty(spark, odd, none):
    check([r for r in periodic.periodic_runs(odd).collect() if r.n_words < 2000], [(i, t) for i, t in ODD if len(plain_words(t)) < 2000])
    assert periodic.periodic_runs(odd).count() == len(ODD) and periodic.periodic_runs(none).count() == 0


def test_long_texts(spark):
    docs = [(1, "ha " * 1_200_000), (2, " ".join(f"w{i % 1000}" for i in range(300_000))), (3, " ".join(f"u{i}" for i in range(300_000)))]
    began = time.time()
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic.periodic_runs(documents(spark, docs)).collect()}
    assert got == {1: [(0, 1_200_000, 1)], 2: [(0, 300_000, 1000)], 3: []}
    assert time.time() - began < 60


def test_query_on_table_and_odd_rows(spark, odd):
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    made = {r.doc_id: r.text for r in queries.made_periodic(table.select("doc_id", "text")).collect()}
    rows = {r.doc_id: r for r in entry.queries()["op12_periodic_runs"](spark, SF_SMALL).collect()}
    hit = 0
    for r in table.select("doc_id", "text").collect():
        w = made_periodic(r.doc_id, plain_words(r.text))
        assert plain_words(made[r.doc_id]) == w
        if len(w) > 3000:
            continue
        runs = plain_runs(w)
        got, best = rows[r.doc_id], min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        hit += bool(runs)
        assert (got.n_runs, got.start, got.length, got.period) == (len(runs), *best)
        assert got.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert got.runs_sha256 == hashlib.sha256("".join("%d,%d,%d\n" % x for x in runs).encode()).hexdigest()
        assert got.collapsed_sha256 == hashlib.sha256(plain_kept(w, runs)).hexdigest()
    assert hit > 5 and len(rows) == table.count()
    for r in queries.made_periodic(odd.select("doc_id", "text")).collect():
        assert any(plain_words(r.text) == made_periodic(i, plain_words(t)) for i, t in ODD if i == r.doc_id)
