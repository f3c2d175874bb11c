"""Periodic runs of words: maximal stretches that repeat with a smallest period, by seeds on diagonals.

A run of period ``q`` and length ``max(6, 4 q)`` or more matches itself, shifted by ``q``, over
at least ``max(5, 3 q)`` words.  So the k-gram index needs one size per octave of lags: grams
of ``k`` words serve the lags of ``(k / 2, k]``, since 3 q > k there (``k = 4``: the lags 1 to 4).
As such a gram covers a whole period, its next occurrence inside the run is exactly one period
later; only neighbouring occurrences of a document's grams are paired, never all.

Along one lag the seeds of a run follow each other without a gap, so the furthest place that a
lag has covered grows seed by seed: a seed inside it extends nothing anew, the first one
outside it opens the next stretch.  A stretch is maximal and the lag its smallest period (a
smaller one would show as a nearer occurrence), hence every run is found once.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ship, text_bytes

SEED = 4
MIN_LENGTH = 6
MIN_PERIODS = 4
#: Text bytes that are indexed together.
CHUNK_BYTES = 2 << 20


def _named(keys: np.ndarray, at: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Equal keys of one document numbered alike.

    Returns the places sorted by key and place, their names, and for each whether the
    one before and the one after is the same gram of the same document.
    """
    order = np.argsort(keys, kind="stable")  # ``at`` ascends
    keys, at = keys[order], at[order]
    fresh = np.r_[True, (keys[1:] != keys[:-1]) | (doc[at[1:]] != doc[at[:-1]])] if len(at) else np.zeros(0, dtype=bool)
    before = ~fresh
    return at, np.cumsum(fresh), before, np.r_[before[1:], False] if len(at) else before


def find_runs(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All runs of documents laid end to end: rows (document, start, length, period), in that order.

    ``words`` are word numbers below 2**31, ``sizes`` the documents' numbers of words.
    """
    n = len(words)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    begin = np.repeat(np.cumsum(sizes) - sizes, sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(n)  # words from here to the document's end
    name = np.where(left >= 1, words, -1).astype(np.int64)
    at, k = np.arange(n), 1
    found = []
    while len(at):
        # grams of 2 k words: two grams of k words that both occur twice in the document
        held, at = at, at[left[at] >= 2 * k]
        second = name[at + k]
        at, second = at[second >= 0], second[second >= 0]
        places, names, before, after = _named(name[at] << 32 | second, at, doc)
        k *= 2
        if k >= SEED:
            lag = places[1:] - places[:-1]
            seed = before[1:] & (lag <= k) & (lag > (k // 2 if k > SEED else 0))
            first, lag = places[:-1][seed], lag[seed]
            order = np.lexsort((first, lag))
            first, lag = first[order], lag[order]
            # the furthest place that the lag has covered: a seed next to the last one extends its stretch
            opens = np.r_[True, (lag[1:] != lag[:-1]) | (first[1:] != first[:-1] + 1) | (doc[first[1:]] != doc[first[:-1]])] if len(first) else []
            heads = np.flatnonzero(opens)
            tails = np.r_[heads[1:], len(first)] - 1 if len(heads) else heads
            start, period = first[heads], lag[heads]
            length = first[tails] - start + k + period
            long = length >= np.maximum(MIN_LENGTH, MIN_PERIODS * period)
            found.append(np.stack([doc[start], start - begin[start], length, period], axis=1)[long])
        again = before | after
        name[held] = -1
        name[places[again]] = names[again]
        at = np.sort(places[again])
        if k > SEED:  # grams of the next size serve periods over k, so runs of more than 4 k words
            at = at[(left + (np.arange(n) - begin))[at] > MIN_PERIODS * k]
    runs = np.concatenate(found) if found else np.zeros((0, 4), dtype=np.int64)
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def dropped(runs: np.ndarray, begins: np.ndarray, n: int) -> np.ndarray:
    """Which of ``n`` words lie in a run after its first period."""
    cover = np.zeros(n + 1, dtype=np.int64)
    start = begins[runs[:, 0]] + runs[:, 1]
    np.add.at(cover, start + runs[:, 3], 1)
    np.add.at(cover, start + runs[:, 2], -1)
    return np.cumsum(cover[:-1]) > 0


def collapse(texts: list[bytes]) -> tuple[list[int], list[np.ndarray], list[bytes]]:
    """Of each text: its number of words, its runs (start, length, period), and the text without the repeated periods."""
    numbers: defaultdict = defaultdict(count().__next__)
    split = [t.split() for t in texts]
    sizes = np.array([len(w) for w in split], dtype=np.int64)
    words = np.fromiter((numbers[w] for ws in split for w in ws), dtype=np.int64, count=int(sizes.sum()))
    runs = find_runs(words, sizes)
    begins = np.cumsum(sizes) - sizes
    gone = dropped(runs, begins, len(words))
    cut = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1))
    per, kept = [], []
    for d, ws in enumerate(split):
        own = runs[cut[d] : cut[d + 1], 1:]
        if len(own):
            stay = np.flatnonzero(~gone[begins[d] : begins[d] + len(ws)])
            ws = [ws[k] for k in stay.tolist()]
        per.append(own)
        kept.append(b" ".join(ws))
    return sizes.tolist(), per, kept


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``runs`` and ``collapsed``.

    Words are separated by the six ASCII white-space bytes.  ``runs`` lists (start, length, period) in
    words from 0, by start, then period: every stretch of at least 6 words and 4 periods
    that repeats with that smallest period and that no neighbouring word extends.  ``collapsed``
    are the words that no run holds after its first period, joined by single spaces.

    Null and empty texts have no words, no runs and an empty ``collapsed``.  Null, equal and repeated ids
    each give a row.  No rows give no rows; other columns are not read.  A text is one unit of work:
    memory follows the longest text.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_bytes(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"

    def find(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            ids, texts = batch.column("doc_id"), batch.column("text")
            ends = np.cumsum(pc.binary_length(texts).to_numpy())
            at = 0
            while at < len(texts):
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK_BYTES, side="right")))
                sizes, runs, kept = collapse(texts.slice(at, to - at).to_pylist())
                flat = np.concatenate([*runs, np.zeros((0, 3), dtype=np.int64)])
                offsets = np.cumsum([0, *map(len, runs)])
                values = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], fields=list(RUN))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(at, to - at), pa.array(sizes, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values), pa.array(kept, pa.binary())],
                    names=["doc_id", "n_words", "runs", "collapsed"])
                at = to

    return rows.mapInArrow(find, schema).withColumn("collapsed", F.col("collapsed").cast("string"))
