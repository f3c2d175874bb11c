"""License scan and quality classifier."""

import random
import re
import zlib

import numpy as np
import pytest
from llm_cases import ODD, SF_SMALL, documents
from pyspark.sql import functions as F

from roadlake.llm import license_scan, quality

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_scan(i, text):
    words = WORD.findall((text or "").translate(LOWER))
    places = []
    for phrase, label in license_scan.PHRASES.items():
        p = phrase.split()
        places += [(k, label) for k in range(len(words)) if words[k : k + len(p)] == p]
    starts = [k for k, _ in places]
    return (i, len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))


def key(r):
    return tuple((x is None, x) for x in r)


MIT = license_scan.TEMPLATES[1][1]
CASES = {
    "Released under the MIT License.": {"mit"},
    "released UNDER the terms of the mit-license!": {"mit"},
    "Released under some terms of the MIT License": {"mit"},  # the phrase alone
    "x This work is licensed under the GNU General Public License, version 3. y": {"gpl"},
    "Licensed under the Apache License, Version 2.0.": {"apache", "apache-2.0"},
    "Licensed under the Apache License, Version 1.1": {"apache"},
    "Licensed under CC BY-NC 4.0. All rights reserved": {"cc-by-nc-4.0"},
    "Licensed under CC BY-SA 4.0": set(),
    "mit license mit license": {"mit"},
    "smit license": set(),
    "limit licenses": set(),
}


def test_scan_cases(spark, odd):
    rows = [*enumerate(CASES, start=100), *ODD]
    got = license_scan.scan(documents(spark, rows)).collect()
    assert sorted((tuple(r[:6]) for r in got), key=key) == sorted((plain_scan(i, t) for i, t in rows), key=key)
    for r in got:
        labels = set(filter(None, r.labels.split(",")))
        if r.doc_id is not None and r.doc_id >= 100:
            assert labels == list(CASES.values())[r.doc_id - 100]
        assert set(filter(None, r.base_labels.split(","))) <= labels and ",".join(sorted(labels)) == r.labels
        assert r.score == (1.0 if r.text_labels else 0.8 if r.spans else 0.5 if r.n_base else 0.0)


def test_scan_table_and_empty(spark, none):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = license_scan.scan(docs).collect()
    assert sorted((tuple(r[:6]) for r in got), key=key) == sorted((plain_scan(r.doc_id, r.text) for r in docs.collect()), key=key)
    assert any(r.spans for r in got) and license_scan.scan(none).count() == 0


def filled(markup, optional, var):
    out = re.sub(r"<<beginOptional>>(.*?)<<endOptional>>", r"\1" if optional else "", markup)
    return re.sub(r"<<var;[^>]*original=([^;>]*)[^>]*>>", r"\1" if var is None else var, out)


@pytest.mark.parametrize("label,markup", license_scan.TEMPLATES)
@pytest.mark.parametrize("optional", [False, True])
def test_templates_accept_their_own_wording(label, markup, optional):
    automaton = license_scan.compile_template(label, markup)
    scanner = license_scan.Scanner([(label, markup)], {})
    text = filled(markup, optional, None)
    n = len(license_scan.words_of(text.encode()))
    assert automaton.accept(license_scan.words_of(text.encode()), 0) == n
    *_, spans = scanner.scan(f"before it {text} and after".encode())
    assert [(s[0], s[2]) for s in spans] == [(label, n + 2)] and 0 <= spans[0][1] <= 2
    words = license_scan.words_of(text.encode())
    mandatory = license_scan.words_of(re.sub(r"<<beginOptional>>.*?<<endOptional>>|<<var;[^>]*>>", " ", markup).encode())
    for w in {mandatory[0], mandatory[len(mandatory) // 2], mandatory[-1]}:  # a mandatory word changed
        at = len(words) - 1 - words[::-1].index(w)
        if words.count(w) == mandatory.count(w):
            changed = b" ".join(words[:at] + [b"zzz"] + words[at + 1 :])
            assert scanner.scan(changed)[-1] == []


WHOLE = [(label, filled(markup, optional, None)) for label, markup in license_scan.TEMPLATES for optional in (False, True)
         if len(markup.split()) > 40]


@pytest.mark.parametrize("label,text", WHOLE)
def test_later_wording_counts(label, text):
    """The opening alone, any changed or missing later sentence and an added condition are no license text."""
    scanner = license_scan.Scanner()
    spans_of = lambda t: [s for s in scanner.scan(t.encode())[-1] if s[2] - s[1] > 20]
    names = scanner.scan(text.encode())[-2]
    assert label in names.split(",") and spans_of(text)
    words = text.split()
    for share in (0.5, 0.7, 0.95):
        assert not spans_of(" ".join(words[: int(len(words) * share)]))
        assert not spans_of(" ".join(words[: int(len(words) * share)] + "but never on a Sunday in May or on any other day of rest whatsoever".split()
                                     + words[int(len(words) * share) :]))


def test_json_license_is_not_mit():
    text = filled(license_scan.TEMPLATES[1][1], True, None)
    added = text.replace("portions of the Software.", "portions of the Software. The Software shall be used for Good, not Evil.")
    assert license_scan.Scanner().scan(added.encode())[5:7] == ("", 0.0)


def test_bsd_clauses():
    texts = [filled(m, True, None) for label, m in license_scan.TEMPLATES if label == "bsd"]
    assert [license_scan.Scanner().scan(t.encode())[5:7] for t in texts] == [("bsd", 1.0)] * 3
    for t in texts:
        for old, new in (("must reproduce", "need not reproduce"), ("without specific prior", "with or without"), ("display", "sing"), ("EVEN IF ADVISED", "UNLESS ADVISED")):
            if old in t:
                assert license_scan.Scanner().scan(t.replace(old, new).encode())[5:7] == ("", 0.0)


def test_notices_are_told_from_texts():
    scanner = license_scan.Scanner()
    for label, markup in license_scan.NOTICES:
        found = scanner.scan(filled(markup, True, None).encode())
        assert label in found[5].split(",") and found[7] == ""


def test_related_texts_are_told_apart():
    """MIT without its notice condition is another license, and so is ISC without one."""
    texts = {label: filled(m, True, None) for label, m in license_scan.TEXTS}
    for label in ("mit", "mit-0", "isc", "0bsd", "zlib", "bsl-1.0", "unlicense"):
        found = license_scan.Scanner().scan(f"Copyright (c) 2020 A. B. {texts[label]} int main".encode())
        assert (found[5], found[6], found[7]) == (label, 1.0, label)


def random_template(rng, depth=0):
    """``(markup, fillings)``: every filling is a tuple of words, None for any word."""
    markup, fillings = "", {()}
    for k in range(rng.randint(1, 4 - depth)):
        kind = rng.choice(("word", "word", "optional", "choice", "any")) if depth or k else "word"  # the first is mandatory
        if kind == "word":
            w = rng.choice("abc")
            part, ways = f"{w} ", {(w,)}
        elif kind == "optional" and depth < 2:
            inner, ways = random_template(rng, depth + 1)
            part, ways = f"<<beginOptional>>{inner}<<endOptional>>", ways | {()}
        elif kind == "choice":
            choices = [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 2))) for _ in range(2)]
            part, ways = f"<<var;name=x;original={choices[0]};match={'|'.join(choices)}>>", {tuple(c.split()) for c in choices}
        else:
            fewest = rng.randint(0, 2)
            most = max(1, fewest + rng.randint(0, 1))
            part, ways = f"<<var;name=x;original=a;match=.{{{fewest},{most}}}>>", {(None,) * n for n in range(fewest, most + 1)}
        markup, fillings = markup + part, {f + w for f in fillings for w in ways}
    return markup, fillings


@pytest.mark.parametrize("seed", range(5))
def test_automata_equal_all_fillings(seed):
    """Random templates against the set of all their fillings: longest stretch from every word, then the spans from left to right."""
    rng = random.Random(seed)
    accepted = 0
    for _ in range(80):
        markup, fillings = random_template(rng)
        automaton = license_scan.compile_template("x", markup)
        scanner = license_scan.Scanner([("x", markup)], {})
        for _ in range(5):
            words = [rng.choice("abc") for _ in range(rng.randint(0, 14))]
            ends = []
            for start in range(len(words) + 1):
                fits = [len(f) for f in fillings if len(f) <= len(words) - start and all(w in (None, x) for w, x in zip(f, words[start:]))]
                ends.append(start + max(fits) if fits else -1)
            coded = [w.encode() for w in words]
            assert [automaton.accept(coded, k) for k in range(len(words) + 1)] == ends, markup
            spans, at = [], 0
            while at < len(words):
                if ends[at] > at:
                    spans.append(("x", at, ends[at]))
                    at = ends[at]
                else:
                    at += 1
            assert scanner.scan(b" ".join(coded))[-1] == spans, (markup, words)
            accepted += len(spans)
    assert accepted > 100


def test_markup_errors():
    for bad in ("<<beginOptional>>a", "a<<endOptional>>", "<<beginOptional>>a<<endOptional>>"):
        with pytest.raises(ValueError):
            license_scan.compile_template("x", bad)


# --- quality -------------------------------------------------------------


def plain_score(model, text):
    """Margin feature by feature."""
    p, words = model.params, (text or "").encode().split()
    shift, total, n, last = 32 - (p.buckets.bit_length() - 1), 0.0, 0, None
    odd = 0x9E3779B1
    for w in words:
        marked, buckets = b"<" + w + b">", [(zlib.crc32(w) * odd & 0xFFFFFFFF) >> shift]
        for size in p.ngrams:
            for k in range(len(marked) - size + 1):
                h = marked[k]
                for b in marked[k + 1 : k + size]:
                    h = (h * 16777619 & 0xFFFFFFFF) ^ b
                buckets.append(((h + size) * odd & 0xFFFFFFFF) >> shift)
        total += sum(model.margin[b] for b in buckets)
        n += len(buckets)
        if w == last:
            total += len(buckets) * model.margin[quality.same_bucket(p)]
            n += len(buckets)
        last = w
    return 1 / (1 + np.exp(-((total / n if n else 0.0) + model.bias)))


@pytest.fixture(scope="module")
def model(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    return quality.train(docs, labels, rows=~quality.held_out())


def test_scores(spark, odd, none, model):
    rows = quality.score(odd, model).collect()
    key = lambda r: (r[0] is None, r[0] or 0, round(r[1], 9))
    expected = sorted(((i, plain_score(model, t)) for i, t in ODD), key=key)
    for r, (i, s) in zip(sorted(((r.doc_id, r.score) for r in rows), key=key), expected, strict=True):
        assert r[0] == i and r[1] == pytest.approx(s, abs=1e-9)
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)
    assert quality.score(none, model).count() == 0
    kept = quality.keep_accepted(odd, model)
    assert kept.schema == odd.schema and kept.count() == sum(r.predicted for r in rows)


def test_held_out_accuracy(spark, model):
    d = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    held = docs.where(quality.held_out())
    rows = quality.score(held, model).join(labels, "doc_id").select("predicted", "quality").collect()
    right = sum(r.predicted == r.quality for r in rows)
    clean = [r for r in rows if r.quality == 1]
    assert right / len(rows) > 0.95 and sum(r.predicted for r in clean) / len(clean) > 0.98


def test_training_reads_only_its_rows(spark):
    """Labels of held-out rows, and every column but the text, change nothing."""
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    p = quality.QualityParams(epochs=1, max_rows=60)
    one = quality.train(docs, labels, rows=~quality.held_out(), params=p)
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    two = quality.train(docs.withColumn("lang", F.lit("x")).withColumn("source", F.lit("y")), flipped, rows=~quality.held_out(), params=p)
    assert (one.margin == two.margin).all() and one.bias == two.bias


def test_training_edges(spark, odd, none):
    labels = spark.createDataFrame([(None, 1), (4, None), (5, 7), (6, 0), (6, 1), (12, 1), (99, 0)], "doc_id long, quality int")
    p = quality.QualityParams(epochs=1, max_rows=10)
    _, places, marks = quality.training_sample(odd, labels, "quality", F.lit(True), p, "doc_id", "text")
    assert len(places) == 3
    assert sorted(marks.tolist()) == [0, 0, 1]
    for l in (labels, labels.limit(0)):
        m = quality.train(none, l, params=p)
        assert quality.score(odd, m).where("score > 0 and score < 1").count() == len(ODD)


def in_order(spark, ids):
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    return [r.doc_id for r in rows.orderBy(F.xxhash64("doc_id")).collect()]


def sample_of(spark, texts, labels, **bounds):
    docs, marks = documents(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int")
    p = quality.QualityParams(**bounds)
    rows, places, held = quality.training_sample(docs, marks, "quality", F.lit(True), p, "doc_id", "text")
    texts = {r.place: bytes(r.text) for r in rows.collect()}
    return [texts[k] for k in places], held.tolist()


def test_sample_leaves_out_what_does_not_fit(spark):
    ids = in_order(spark, range(20))
    size = {ids[0]: 5000, ids[3]: 990}
    texts = [(i, "x" * size.get(i, 50)) for i in ids]
    got, marks = sample_of(spark, texts, [(i, k % 2) for k, i in enumerate(ids)], max_bytes=1000, max_rows=20)
    assert [len(t) for t in got] == [50] * 18 and marks == [k % 2 for k in range(20) if k not in (0, 3)]


def test_sample_holds_both_labels(spark):
    ids = in_order(spark, range(20))
    texts = [(i, f"text {i:4d}") for i in ids]
    late = [(i, int(k == 19)) for k, i in enumerate(ids)]
    got, marks = sample_of(spark, texts, late, max_rows=6)
    assert marks == [0, 0, 0, 1] and len(got) == 4
    got, marks = sample_of(spark, texts, late, max_bytes=40)
    assert marks == [0, 0, 1]
    with pytest.raises(ValueError):
        sample_of(spark, [(i, t * (500 if i == ids[19] else 1)) for i, t in texts], late, max_bytes=40)


def test_sample_of_a_repeated_id(spark):
    """Only rows that both bounds counted are in the sample, however often an id stands."""
    ids = in_order(spark, range(10))
    texts = [(i, f"text {i:4d}") for i in ids] + [(ids[4], f"text {ids[4]:4d}")] * 300 + [(ids[4], f"more {k:4d}") for k in range(300)]
    labels = [(i, k % 2) for k, i in enumerate(ids)]
    got, marks = sample_of(spark, texts, labels, max_rows=40)
    assert len(got) == len(marks) == 40 and marks == [0, 1, 0, 1] + [0] * 36
    assert sample_of(spark, texts, labels, max_rows=40) == (got, marks)
    got, marks = sample_of(spark, texts, labels, max_bytes=180)
    assert len(got) == 20 and sum(map(len, got)) == 180
