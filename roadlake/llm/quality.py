"""Quality classifier: averaged vectors of hashed words and character n-grams, softmax output.

A document's features are its white-space words (case kept), the byte n-grams of each word
between word marks, and, for a word that repeats the word before it, a repetition feature as
many times as the word has features.  All are hashed into one table of learned vectors; the document is the mean of its features' vectors
and a softmax layer turns it into the probability of label 1.  Training is stochastic
gradient descent in numpy on a bounded sample of labelled rows; scoring reads every row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import fresh, id_crc, ship, text_bytes
from .token_ids import pieces_of
from .words import Growing, WordNumbers, spans


@dataclass(frozen=True)
class QualityParams:
    buckets: int = 1 << 18
    dim: int = 8
    ngrams: tuple[int, ...] = (3, 4, 5)
    epochs: int = 4
    batch: int = 32
    rate: float = 0.15
    seed: int = 7
    #: The model is fitted on at most this many labelled rows and bytes of text, the first by
    #: a hash of the id; texts are taken whole, those that do not fit are left out.  Scoring has no bound.
    max_rows: int = 3000
    max_bytes: int = 16 << 20
    threshold: float = 0.7
    #: Words whose features one Python worker keeps while scoring.
    cache_words: int = 2_000_000


@dataclass(frozen=True)
class QualityModel:
    """What scoring needs: each bucket's share of the margin of label 1 over label 0."""

    margin: np.ndarray
    bias: float
    params: QualityParams


SAME = zlib.crc32(b"\x00same")
_ODD = np.uint32(0x9E3779B1)


def word_features(words: list[bytes], p: QualityParams) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of ``words``, word by word, and how many each word has."""
    if not words:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    data = np.frombuffer(b"<" + b"><".join(words) + b">", dtype=np.uint8).astype(np.uint32)
    size = np.array([len(w) + 2 for w in words], dtype=np.int64)
    owner = np.repeat(np.arange(len(words)), size)
    left = np.repeat(np.cumsum(size), size) - np.arange(len(data))  # bytes from here to the word's end
    shift = np.uint32(32 - (p.buckets.bit_length() - 1))
    found = [np.array([zlib.crc32(w) for w in words], dtype=np.uint32) * _ODD >> shift]
    owners = [np.arange(len(words))]
    h = data.copy()
    for n in range(2, max(p.ngrams) + 1):
        if len(h) < 2:
            break
        h = h[:-1] * np.uint32(16777619) ^ data[n - 1 :]
        if n in p.ngrams:
            at = np.flatnonzero(left[: len(h)] >= n)
            found.append((h[at] + np.uint32(n)) * _ODD >> shift)
            owners.append(owner[at])
    owner, bucket = np.concatenate(owners), np.concatenate(found).astype(np.int64)
    return bucket[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(words))


def same_bucket(p: QualityParams) -> int:
    return int((np.array([SAME], dtype=np.uint32) * _ODD >> np.uint32(32 - (p.buckets.bit_length() - 1)))[0])


def fit(texts: list[bytes], labels: np.ndarray, p: QualityParams = QualityParams()) -> QualityModel:
    """Train on whole texts (``labels`` 0 or 1).  With fewer than two classes every score is the label's share."""
    labels = np.asarray(labels, dtype=np.int64)
    share = (labels.sum() + 1.0) / (len(labels) + 2.0)
    prior = float(np.log(share / (1 - share)))
    if len(set(labels.tolist())) < 2:
        return QualityModel(np.zeros(p.buckets), prior, p)
    rng = np.random.default_rng(p.seed)
    table, new, all_rows = WordNumbers(), [], []  # none of them is held while training
    for part in pieces_of(pa.array(texts, pa.binary())):
        data, starts, ends, n_words = spans(part)
        numbers, met = table.numbers(data, starts, ends)
        new += met
        all_rows += np.split(numbers.astype(np.int32), np.cumsum(n_words)[:-1])
    parts = [word_features(new[k : k + 20_000], p) for k in range(0, len(new), 20_000)]  # bounds what is held at once
    buckets = np.concatenate([b.astype(np.int32) for b, _ in parts] or [np.zeros(0, dtype=np.int32)])
    sizes = np.concatenate([n for _, n in parts] or [np.zeros(0, dtype=np.int64)])
    ends = np.cumsum(sizes)
    begins = ends - sizes
    docs = []
    for rows in all_rows:
        unique, n = np.unique(rows, return_counts=True)
        docs.append((unique, n.astype(np.int32), sizes[rows[1:][rows[1:] == rows[:-1]]].sum()))
    del table, new, all_rows, parts
    vectors = (rng.random((p.buckets, p.dim), dtype=np.float32) - 0.5) / p.dim
    seen = np.full(p.buckets, 1e-6, dtype=np.float32)  # squared gradients so far, for each bucket's step
    out = np.zeros((p.dim, 2))
    bias = np.array([0.0, prior])
    out_seen, bias_seen = np.full_like(out, 1e-6), np.full_like(bias, 1e-6)
    same = same_bucket(p)
    for epoch in range(p.epochs):
        rate = p.rate * (1 - epoch / p.epochs)
        order = rng.permutation(len(docs))
        for b in range(0, len(order), p.batch):
            batch = order[b : b + p.batch]
            unique, inverse = np.unique(np.concatenate([docs[d][0] for d in batch]), return_inverse=True)
            times = np.concatenate([docs[d][1] for d in batch]).astype(np.float64)
            doc = np.repeat(np.arange(len(batch)), [len(docs[d][0]) for d in batch])
            size = sizes[unique]
            at = np.repeat(begins[unique] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            used = buckets[at]
            word = np.repeat(np.arange(len(unique)), size)
            sums = np.add.reduceat(vectors[used], np.cumsum(size) - size, axis=0) if len(used) else np.zeros((0, p.dim))
            repeats = np.array([docs[d][2] for d in batch], dtype=np.float64)
            total = np.bincount(doc, times * size[inverse], len(batch)) + repeats
            total[total == 0] = 1
            hidden = np.stack([np.bincount(doc, times * sums[inverse, k], len(batch)) for k in range(p.dim)], axis=1)
            hidden = (hidden + repeats[:, None] * vectors[same]) / total[:, None]
            margin = hidden @ out + bias
            prob = np.exp(margin - margin.max(axis=1, keepdims=True))
            prob /= prob.sum(axis=1, keepdims=True)
            prob[np.arange(len(batch)), labels[batch]] -= 1  # now the gradient of the margins
            back = prob @ out.T / total[:, None]
            grad_out, grad_bias = hidden.T @ prob, prob.sum(axis=0)
            out_seen += grad_out**2
            bias_seen += grad_bias**2
            out -= rate * grad_out / np.sqrt(out_seen)
            bias -= rate * grad_bias / np.sqrt(bias_seen)
            per_word = np.stack([np.bincount(inverse, times * back[doc, k], len(unique)) for k in range(p.dim)], axis=1)
            if epoch == 0 and b == 0:
                continue  # the output layer is still zero
            # the repetition feature may share its bucket with a word or n-gram
            step, place = np.unique(np.append(used, same), return_inverse=True)
            of_repeats = (repeats[:, None] * back).sum(axis=0)
            grad = np.stack([np.bincount(place, np.append(per_word[word, k], of_repeats[k]), len(step)) for k in range(p.dim)], axis=1)
            seen[step] += (grad**2).mean(axis=1)
            vectors[step] -= (rate * grad / np.sqrt(seen[step])[:, None]).astype(np.float32)
    return QualityModel(vectors.astype(np.float64) @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0]), p)


class Scorer:
    """Scores texts; keeps the feature sums of the words it has met."""

    def __init__(self, model: QualityModel):
        self.model, self.same = model, model.margin[same_bucket(model.params)]
        self._clear()

    def _clear(self) -> None:
        self.known, self.sums, self.sizes = WordNumbers(), Growing(np.float64), Growing(np.float64)

    def scores(self, texts: list[bytes]) -> list[float]:
        if self.known.count > self.model.params.cache_words:
            self._clear()
        data, starts, ends, n_words = spans(texts)
        numbers, new = self.known.numbers(data, starts, ends)
        if new:
            buckets, sizes = word_features(new, self.model.params)
            self.sums.extend(np.bincount(np.repeat(np.arange(len(new)), sizes), self.model.margin[buckets], len(new)))
            self.sizes.extend(sizes)
        size = self.sizes.values[numbers]
        again = np.r_[False, numbers[1:] == numbers[:-1]] if len(numbers) else np.zeros(0, dtype=bool)
        first = np.cumsum(n_words) - n_words
        again[first[n_words > 0]] = False  # a text's first word has none before it
        repeated = np.where(again, size, 0.0)
        doc = np.repeat(np.arange(len(texts)), n_words)
        total = np.bincount(doc, size + repeated, len(texts))
        margin = np.bincount(doc, self.sums.values[numbers] + repeated * self.same, len(texts))
        margin = np.divide(margin, total, out=np.zeros(len(texts)), where=total > 0) + self.model.bias
        return (1 / (1 + np.exp(-margin))).tolist()


def training_sample(docs: DataFrame, labels: DataFrame, label_col: str, train: Column, p: QualityParams,
                    id_col: str, text_col: str) -> tuple[DataFrame, list[int], np.ndarray]:
    """At most ``max_rows`` labelled rows and ``max_bytes`` of text, the first by a hash of the id.

    Returns ``(place, text)`` of the distinct texts, the place of each sample row's text, and its label;
    the texts stay where they are.

    A row that does not fit the bytes that are left is left out.  If that leaves a label out
    that labelled rows have, each label gets half of both bounds; if still none of its rows
    fits, or no row at all, it is an error.
    """
    marks = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("label")))
    rows = docs.where(train & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.xxhash64(id_col).alias("order"), text_bytes(text_col).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text")).withColumn("size", F.octet_length("text"))
    key = ["order", "id", "hash", "size"]
    sizes = rows.select(key).join(marks, "id").select(*key, "label")

    def first(of: DataFrame, max_rows: int, max_bytes: int) -> list:
        picked, held = [], 0
        for r in of.orderBy(key).limit(max_rows).collect():
            if held + r["size"] <= max_bytes:
                held += r["size"]
                picked.append(r)
        return picked

    picked = first(sizes, p.max_rows, p.max_bytes)
    if len({r["label"] for r in picked}) < 2:
        present = [r["label"] for r in sizes.select("label").distinct().collect()]
        if len(present) == 2:
            picked = [r for v in (0, 1) for r in first(sizes.where(F.col("label") == v), max(1, p.max_rows // 2), p.max_bytes // 2)]
        missing = sorted(set(present) - {r["label"] for r in picked})
        if missing:
            raise ValueError(f"no row of label {missing[0]} fits the training sample of {p.max_bytes} bytes")
    picked.sort(key=lambda r: tuple(r[c] for c in key))
    # equal rows are one text, however many there are
    places = {k: n for n, k in enumerate(dict.fromkeys(tuple(r[c] for c in key) for r in picked))}
    wanted = docs.sparkSession.createDataFrame([(*k, n) for k, n in places.items()], rows.select(*key, F.lit(0).alias("place")).schema)
    found = rows.join(F.broadcast(wanted), key).groupBy("place").agg(F.first("text").alias("text"))
    return found, [places[tuple(r[c] for c in key)] for r in picked], np.array([r["label"] for r in picked], dtype=np.int64)


def train(docs: DataFrame, labels: DataFrame, *, rows: Column | None = None, label_col: str = "quality",
          params: QualityParams = QualityParams(), id_col: str = "doc_id", text_col: str = "text") -> QualityModel:
    """Fit on the labelled rows of ``docs`` for which ``rows`` holds.

    Rows without a label, without an id or with a label besides 0 and 1 are left out; an
    id labelled more than once takes the smallest label.  Only the text is an input.
    One task trains on the bounded sample; a lost executor costs it a retry with the same result.
    """
    ship(docs.sparkSession)
    sample, places, marks = training_sample(docs, labels, label_col, F.lit(True) if rows is None else rows, params, id_col, text_col)

    if not places:
        return fit([], marks, params)

    def fitted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts: dict[int, bytes] = {}
        for batch in parts:
            texts.update(zip(batch.column("place").to_pylist(), batch.column("text").to_pylist()))
        model = fit([texts[k] for k in places], marks, params)
        yield pa.RecordBatch.from_arrays([pa.array([model.margin.tobytes()], pa.binary()), pa.array([model.bias])], names=["margin", "bias"])

    model = sample.repartition(1).mapInArrow(fitted, "margin binary, bias double").first()
    return QualityModel(np.frombuffer(bytes(model["margin"])), model["bias"], params)


def with_score(rows: DataFrame, model: QualityModel, name: str, text_name: str) -> DataFrame:
    """Replaces the binary column ``text_name`` of ``rows`` by the score ``name`` (double)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # fixed size: one number per bucket
    keep = [c for c in rows.columns if c != text_name]
    schema = rows.select(*(f"`{c}`" for c in keep), F.lit(0.0).alias(name)).schema

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in parts:
            found: list[float] = []
            for texts in pieces_of(batch.column(text_name)):
                found.extend(scorer.scores(texts))
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(found, pa.float64())], names=[*keep, name])

    return rows.mapInArrow(score, schema)


def score(docs: DataFrame, model: QualityModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score, predicted)`` for every row of ``docs``.

    Null and empty texts have no features: their score is the softmax of the bias.
    Repeated rows and null ids each give a row; other columns are not read.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_bytes(text_col).alias("text"))
    return with_score(rows, model, "score", "text").withColumn(
        "predicted", (F.col("score") >= model.params.threshold).cast("int"))


def keep_accepted(docs: DataFrame, model: QualityModel, *, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text reaches the threshold, unchanged."""
    ship(docs.sparkSession)
    text, score_ = fresh("quality_text", docs.columns), fresh("quality_score", docs.columns)
    scored = with_score(docs.select("*", text_bytes(text_col).alias(text)), model, score_, text)
    return scored.where(F.col(score_) >= model.params.threshold).select(*(f"`{c}`" for c in docs.columns))


def held_out(id_col: str = "doc_id") -> Column:
    return id_crc(id_col) % 4 == 2
