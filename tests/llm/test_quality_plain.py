"""The classifier against plain Python: features one by one, gradients by finite differences, scores as means."""

import math
import zlib

import numpy as np
from llm_cases import SF_SMALL

from roadlake.llm import quality

ODD_FACTOR, PRIME = 0x9E3779B1, 16777619
TEXTS = [b"good plain text here", b"bad bad bad words", b"plain good words", b"", b"bad text text", b"a b a", b"words words here here", b"good text"]
LABELS = [1, 0, 1, 1, 0, 1, 0, 1]


def bucket(h, p):
    return (h * ODD_FACTOR & 0xFFFFFFFF) >> 32 - (p.buckets.bit_length() - 1)


def word_buckets(word, p):
    out, marked = [bucket(zlib.crc32(word), p)], b"<" + word + b">"
    for n in p.ngrams:
        for k in range(len(marked) - n + 1):
            h = marked[k]
            for c in marked[k + 1 : k + n]:
                h = (h * PRIME & 0xFFFFFFFF) ^ c
            out.append(bucket(h + n & 0xFFFFFFFF, p))
    return out


def plain_features(text, p):
    out, before = [], None
    for word in text.split():
        own = word_buckets(word, p)
        out += own + [bucket(zlib.crc32(b"\0same"), p)] * (len(own) if word == before else 0)
        before = word
    return out


def loss(vectors, out, bias, docs):
    total = 0.0
    for features, label in docs:
        hidden = vectors[features].mean(axis=0) if features else np.zeros(len(out))
        margin = hidden @ out + bias
        total += math.log(np.exp(margin - margin[label]).sum())
    return total


def slopes(value, place, step=1e-5):
    """The derivative of ``value()`` by each number of the view ``place``."""
    found = np.zeros(place.shape)
    for k in np.ndindex(*place.shape):
        old = place[k]
        place[k] = old + step
        above = value()
        place[k] = old - step
        found[k] = (above - value()) / (2 * step)
        place[k] = old
    return found


def plain_fit(texts, labels, p):
    rng = np.random.default_rng(p.seed)
    share = (sum(labels) + 1) / (len(labels) + 2)
    vectors = ((rng.random((p.buckets, p.dim), dtype=np.float32) - 0.5) / p.dim).astype(np.float64)
    out, bias = np.zeros((p.dim, 2)), np.array([0.0, math.log(share / (1 - share))])
    seen, out_seen, bias_seen = np.full(p.buckets, 1e-6), np.full(out.shape, 1e-6), np.full(2, 1e-6)
    docs = [(plain_features(t, p), y) for t, y in zip(texts, labels)]
    first = True
    for epoch in range(p.epochs):
        rate, order = p.rate * (1 - epoch / p.epochs), rng.permutation(len(docs))
        for b in range(0, len(order), p.batch):
            batch = [docs[d] for d in order[b : b + p.batch]]
            now = lambda: loss(vectors, out, bias, batch)  # noqa: B023, E731
            touched = sorted({f for features, _ in batch for f in features})
            by_out, by_bias = slopes(now, out), slopes(now, bias)
            by_vector = {f: slopes(now, vectors[f]) for f in touched}
            out_seen += by_out**2
            bias_seen += by_bias**2
            out -= rate * by_out / np.sqrt(out_seen)
            bias -= rate * by_bias / np.sqrt(bias_seen)
            if not first:  # the output layer was still zero
                for f, g in by_vector.items():
                    seen[f] += (g**2).mean()
                    vectors[f] -= rate * g / math.sqrt(seen[f])
            first = False
    return vectors @ (out[:, 1] - out[:, 0]), bias[1] - bias[0]


def test_training_follows_finite_differences():
    p = quality.QualityParams(buckets=1 << 14, dim=2, epochs=3, batch=3)
    same = bucket(zlib.crc32(b"\0same"), p)
    assert same not in {f for t in TEXTS for w in t.split() for f in word_buckets(w, p)}
    model = quality.fit(TEXTS, np.array(LABELS), p)
    margin, bias = plain_fit(TEXTS, LABELS, p)
    assert np.allclose(model.margin, margin, rtol=2e-3, atol=2e-4) and abs(model.bias - bias) < 1e-3


def test_repetition_bucket_shared_with_other_features():
    """In a small table the repetition feature meets n-grams in its bucket; both gradients count."""
    p = quality.QualityParams(buckets=1 << 4, dim=2, epochs=2, batch=3)
    same = bucket(zlib.crc32(b"\0same"), p)
    assert same in {f for t in TEXTS for w in t.split() for f in word_buckets(w, p)}
    margin, bias = plain_fit(TEXTS, LABELS, p)
    model = quality.fit(TEXTS, np.array(LABELS), p)
    assert np.allclose(model.margin, margin, rtol=2e-3, atol=2e-4) and abs(model.bias - bias) < 1e-3


def test_scores_are_means_of_features(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rng = np.random.default_rng(2)
    p = quality.QualityParams()
    model = quality.QualityModel(rng.normal(size=p.buckets), 0.3, p)
    got = {r.doc_id: (r.score, r.predicted) for r in quality.score(docs, model).collect()}
    for r in docs.collect():
        features = plain_features((r.text or "").encode(), p)
        expected = 1 / (1 + math.exp(-(model.margin[features].mean() if features else 0.0) - 0.3))
        assert abs(got[r.doc_id][0] - expected) < 1e-9 and got[r.doc_id][1] == (got[r.doc_id][0] >= 0.7)
    good = {r.doc_id for r in quality.keep_accepted(docs, model).collect()}
    assert good == {i for i, (s, _) in got.items() if s >= 0.7}
