"""Spelling variants: vocabulary words one edit apart, found with Bloom filters of the vocabulary.

Each word's deletions and replacements are hashed, never written out, and probed against
blocked Bloom filters, one per word length, that all tasks hold.  Only edits that a filter
knows become strings and are joined with the vocabulary, which drops the filter's errors.
A pair is generated once: from the longer word, or from the one with the smaller letter.

Filters are broadcast within a fixed bound of bytes.  A vocabulary whose filters are larger
is probed in several passes, each with the filters of some lengths (or of a part of one
length's hashes), so the bound holds and no edit goes unprobed.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import drop, ship, stored, text_bytes

MIN_LENGTH = 5
MIN_COUNT = 3
RATIO = 2
#: One of so many (document, word) pairs loses a letter.
SPOILED = 97
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
WORD = re.compile("[a-zÀ-ÿ]+")
#: Words that a counting task holds before it hands them on; characters of a text that are split at once.
HELD_WORDS, STRETCH = 200_000, 1 << 20
#: Filter bits per word, of words up to POOL letters and of the longer ones, which share a filter.
BITS, POOL_BITS, POOL = 16, 64, 64
#: Bytes of filters that one pass broadcasts; blocks of 64 bits that one task fills.
FILTER_BYTES, SLICE = 64 << 20, 1 << 13
#: Letters whose replacements are hashed at once; words that one task probes.
PROBES, TASK_WORDS = 4096, 50_000
_ALPHABET = np.frombuffer(LETTERS.encode("latin-1"), dtype=np.uint8)


def words_of(text: bytes) -> Counter:
    """The words of a text and how often they stand in it; a long text is taken in stretches that end between words."""
    lower = text.lower().decode("utf-8", "replace")  # of bytes: A-Z only
    found: Counter = Counter()
    at = 0
    while at < len(lower):
        to = at + STRETCH
        while to < len(lower) and WORD.match(lower, to):
            to = WORD.match(lower, to).end()
        found.update(WORD.findall(lower, at, to))
        at = to
    return found


def spoil(words: Counter, doc_id: str, one_in: int) -> Counter:
    """Deletes one letter of the words whose crc32 with the document's id is a multiple of ``one_in``."""
    prefix = zlib.crc32(f"{doc_id}:".encode())
    out: Counter = Counter()
    for w, n in words.items():
        h = zlib.crc32(w.encode(), prefix)
        if h % one_in == 0:
            k = h % len(w)
            w = w[:k] + w[k + 1 :]
        out[w] += n
    return out


def vocabulary(docs: DataFrame, *, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, spoiled: int | None = None,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, n)`` of all words with so many letters and occurrences; tasks count before anything is shuffled."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), text_bytes(text_col).alias("text"))

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            long = [(w, n) for w, n in held.items() if len(w) >= min_length]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in long], pa.string()), pa.array([n for _, n in long], pa.int64())],
                                              names=["word", "n"])

        for batch in parts:
            for i, text in zip(batch.column("id"), batch.column("text")):
                words = words_of(text.as_py())
                held.update(spoil(words, i.as_py(), spoiled) if spoiled else words)
                if len(held) > HELD_WORDS:
                    yield out()
        yield out()

    return rows.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def place_hash(place: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """A random 64-bit value for a letter at a place; the sum over its places is a word's hash."""
    x = (place.astype(np.uint64) << np.uint64(8) | letter.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def letter_table(words: list[bytes]) -> np.ndarray:
    """Latin-1 words of one length as rows of letters."""
    return np.frombuffer(b"".join(words), dtype=np.uint8).reshape(len(words), -1)


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The words' indices and letters, one length at a time."""
    raw = [w.encode("latin-1") for w in words]
    sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
    for n in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == n)
        yield at, letter_table([raw[k] for k in at.tolist()])


def hashes(letters: np.ndarray) -> np.ndarray:
    return place_hash(np.arange(letters.shape[1])[None, :], letters).sum(axis=1, dtype=np.uint64)


def mask(h: np.ndarray) -> np.ndarray:
    """The five bits of a word in its block."""
    one, out = np.uint64(1), np.zeros(len(h), dtype=np.uint64)
    for k in range(5):
        out |= one << (h >> np.uint64(6 * k) & np.uint64(63))
    return out


def block(h: np.ndarray, blocks: int) -> np.ndarray:
    return (h >> np.uint64(32)).astype(np.int64) & (blocks - 1)


def part_of(h: np.ndarray, parts: int) -> np.ndarray:
    """Which part of a length that is too large for one pass (a power of two of parts); uses bits that ``block`` does not."""
    return (h >> np.uint64(54)).astype(np.int64) & (parts - 1)


class Filters:
    """Blocked Bloom filters by word length (lengths beyond ``POOL`` share one)."""

    def __init__(self, tables: dict[int, np.ndarray], part: int, parts: int):
        self.tables, self.part, self.parts = tables, part, parts

    def knows(self, length: int, h: np.ndarray) -> np.ndarray:
        """Indices of the hashes that may be those of vocabulary words of this length."""
        table = self.tables.get(min(length, POOL + 1))
        if table is None:
            return np.zeros(0, dtype=np.int64)
        at = np.arange(len(h)) if self.parts == 1 else np.flatnonzero(part_of(h, self.parts) == self.part)
        for shift in (0, 6, 12, 18, 24):  # most fail at the first bits
            bits = table[block(h[at], len(table))] >> (h[at] >> np.uint64(shift) & np.uint64(63))
            at = at[bits & np.uint64(1) > 0]
        return at


def edits(letters: np.ndarray, filters: Filters, min_length: int) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Rows of ``letters`` (words of one length) and an edit of each that the filters know."""
    m, n = letters.shape
    flat = letters.ravel()
    if min(n, POOL + 1) in filters.tables:  # replacements by a larger letter
        whole = hashes(letters)
        for a in range(0, m * n, PROBES):
            row, place = np.divmod(np.arange(a, min(a + PROBES, m * n)), n)
            old = flat[a : a + len(row)]
            other, of = np.nonzero(old[:, None] < _ALPHABET[None, :])
            rest = whole[row] - place_hash(place, old)
            first, upto = int(place.min()), int(place.max()) + 1
            new = place_hash(np.arange(first, upto)[:, None], _ALPHABET[None, :])
            hit = filters.knows(n, rest[other] + new[place[other] - first, of])
            if len(hit):
                other, of = other[hit], of[hit]
                for b in range(0, len(hit), max(1, (1 << 22) // n)):
                    some = slice(b, b + max(1, (1 << 22) // n))
                    made = letters[row[other[some]]]
                    made[np.arange(len(made)), place[other[some]]] = _ALPHABET[of[some]]
                    yield row[other[some]], [w.tobytes().decode("latin-1") for w in made]
    if n > min_length and min(n - 1, POOL + 1) in filters.tables:  # deletions, the first of equal neighbours
        step = max(1, (1 << 20) // n)
        for a in range(0, m, step):
            some = letters[a : a + step]
            at = np.arange(n)[None, :]
            before = np.cumsum(place_hash(at, some), axis=1, dtype=np.uint64)
            before = np.concatenate([np.zeros((len(some), 1), dtype=np.uint64), before[:, :-1]], axis=1)
            moved = place_hash(at[:, :-1], some[:, 1:])  # the letters after the gap stand one place earlier
            after = np.cumsum(moved[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
            after = np.concatenate([after, np.zeros((len(some), 1), dtype=np.uint64)], axis=1)
            fresh = np.concatenate([np.ones((len(some), 1), dtype=bool), some[:, 1:] != some[:, :-1]], axis=1)
            row, place = np.nonzero(fresh)
            hit = filters.knows(n - 1, (before + after)[row, place])
            row, place = row[hit], place[hit]
            for b in range(0, len(row), max(1, (1 << 22) // n)):
                r, p = row[b : b + max(1, (1 << 22) // n)], place[b : b + max(1, (1 << 22) // n)]
                whole_words = some[r]
                stay = np.arange(n)[None, :] != p[:, None]
                yield a + r, [w.tobytes().decode("latin-1") for w in whole_words[stay].reshape(len(r), n - 1)]


def filter_blocks(count: int, length: int) -> int:
    bits = (POOL_BITS if length > POOL else BITS) * count
    return 1 << max(4, math.ceil(math.log2(max(1, bits / 64))))


def passes(counts: dict[int, int], filter_bytes: int) -> list[tuple[dict[int, int], int, int]]:
    """Lengths with the blocks of their filters, a part and the number of parts, so that a pass stays within ``filter_bytes``."""
    out, room = [], 0
    for length in sorted(counts):
        parts = 1
        while filter_blocks(-(-counts[length] // parts), length) * 8 > filter_bytes and parts < 256:
            parts *= 2
        blocks = filter_blocks(-(-counts[length] // parts), length)
        while blocks * 8 > max(filter_bytes, 128):  # more than 256 passes for one length: a filter with more errors instead
            blocks //= 2
        if parts > 1:
            out += [({length: blocks}, k, parts) for k in range(parts)]
            room = 0
        elif out and room >= blocks * 8 and out[-1][2] == 1:
            out[-1][0][length] = blocks
            room -= blocks * 8
        else:
            out.append(({length: blocks}, 0, 1))
            room = filter_bytes - blocks * 8
    return out


def build_filters(words: DataFrame, blocks: dict[int, int], part: int, parts: int) -> Filters:
    """The filters of one pass: each task fills slices of them, the driver puts the slices side by side."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, letters in by_length(batch.column("word").to_pylist()):
                length = min(letters.shape[1], POOL + 1)
                h = hashes(letters)
                if parts > 1:
                    h = h[part_of(h, parts) == part]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(h), length, dtype=np.int32)), pa.array((block(h, blocks[length]) // SLICE).astype(np.int32)),
                     pa.array(h.view(np.int64))], names=["length", "slice", "h"])

    def fill(key: tuple, rows: pa.Table) -> pa.Table:
        length, k = (x.as_py() for x in key)
        h = rows.column("h").to_numpy().view(np.uint64)
        table = np.zeros(min(SLICE, blocks[length]), dtype=np.uint64)
        np.bitwise_or.at(table, block(h, blocks[length]) - k * SLICE, mask(h))
        return pa.table({"length": pa.array([length], pa.int32()), "slice": pa.array([k], pa.int32()), "bits": pa.array([table.tobytes()], pa.binary())})

    held = words.where(F.least(F.length("word"), F.lit(POOL + 1)).isin(list(blocks))).select("word")
    slices = held.mapInArrow(place, "length int, slice int, h long").groupBy("length", "slice").applyInArrow(fill, "length int, slice int, bits binary")
    tables = {n: np.zeros(b, dtype=np.uint64) for n, b in blocks.items()}
    for r in slices.toLocalIterator():
        got = np.frombuffer(r["bits"], dtype=np.uint64)
        tables[r["length"]][r["slice"] * SLICE : r["slice"] * SLICE + len(got)] = got
    return Filters(tables, part, parts)


def near_pairs(words: DataFrame, *, min_length: int = MIN_LENGTH, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``(a, n_a, b, n_b)``: every pair of ``words(word, n)`` (a written table) that differ by one edit, once."""
    spark = words.sparkSession
    counts = {r["length"]: r["n"] for r in
              words.groupBy(F.least(F.length("word"), F.lit(POOL + 1)).alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()}
    found = []
    for blocks, part, parts in passes(counts, filter_bytes):
        shared = spark.sparkContext.broadcast(build_filters(words, blocks, part, parts))

        def probe(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            filters = shared.value
            for batch in batches:
                for at, letters in by_length(batch.column("word").to_pylist()):
                    for rows, made in edits(letters, filters, min_length):
                        mine = batch.take(pa.array(at[rows]))
                        yield pa.RecordBatch.from_arrays([*mine.columns, pa.array(made, pa.string())], names=["a", "n_a", "b"])

        lengths = sorted({x for n in blocks for x in (n, n + 1)})
        asked = words.where(F.least(F.length("word"), F.lit(POOL + 1)).isin(lengths))
        n_words = sum(counts.get(x, 0) for x in lengths)
        edited = (asked.select("word", "n").repartition(max(1, math.ceil(n_words / TASK_WORDS)) * 2, "word")
                  .mapInArrow(probe, "a string, n_a long, b string"))
        found.append(stored(edited.join(words.select(F.col("word").alias("b"), F.col("n").alias("n_b")), "b").select("a", "n_a", "b", "n_b"),
                            "near-words"))
        shared.destroy()
    if not found:
        return words.select(F.col("word").alias("a"), F.col("n").alias("n_a"), F.col("word").alias("b"), F.col("n").alias("n_b")).limit(0)
    out = reduce(DataFrame.unionByName, found)
    out._scratch = found
    return out


def roots(links: DataFrame, most: int, ratio: int) -> DataFrame:
    """``(word, up)`` -> each word's last form, by doubling the distance that a link spans.

    A form has at least ``ratio`` times the occurrences, so chains are no longer than the
    logarithm of ``most`` and the rounds than the logarithm of that.
    """
    reached, rounds = links, math.ceil(math.log2(max(1.0, math.log(max(2, most), ratio)))) + 1
    for k in range(rounds):
        further = (reached.join(reached.select(F.col("word").alias("up"), F.col("up").alias("further")), "up", "left")
                   .select("word", F.coalesce("further", "up").alias("up"), F.col("further").isNotNull().alias("moved")))
        following = stored(further, "roots")
        if k:
            drop(reached)
        reached = following
        if reached.where("moved").isEmpty():
            break
    return reached


def variants(docs: DataFrame, *, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO, spoiled: int | None = None,
             filter_bytes: int = FILTER_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per vocabulary word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Words are runs of a-z (A-Z lower-cased) and U+00C0 to U+00FF with at least ``min_length`` letters and
    ``min_count`` occurrences over all texts.  Two are near if one insertion, deletion or replacement
    of a letter makes them equal.  ``form`` is the near word with most occurrences (ties: the
    smallest in code-point order) if it has ``ratio`` times the word's own, else null; ``root`` is where
    the forms end, the word itself without a form.  ``spoiled`` deletes a letter of one in so many
    (document, word) pairs first.

    Null and empty texts have no words; equal rows count each; a null id is an empty one.  No words
    give no rows; other columns are not read.
    """
    if ratio < 2:
        raise ValueError("ratio is 2 or more: forms must have more occurrences")
    ship(docs.sparkSession)
    words = stored(vocabulary(docs, min_length=min_length, min_count=min_count, spoiled=spoiled, id_col=id_col, text_col=text_col), "vocabulary")
    pairs = near_pairs(words, min_length=min_length, filter_bytes=filter_bytes)
    both = pairs.select("a", "b", "n_b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("n_a").alias("n_b")))
    near = (both.groupBy(F.col("a").alias("word"))
            .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("b"))).alias("best")))
    strong = -F.col("best.less") >= F.lit(ratio) * F.col("n")
    forms = stored(words.join(near, "word", "left")
                   .select("word", F.when(strong, F.col("best.b")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                           F.when(strong, -F.col("best.less")).alias("form_n")), "forms")
    drop(words, *getattr(pairs, "_scratch", []))
    most = forms.agg(F.max("n")).first()[0] or 1
    ends = roots(forms.where("form is not null").select("word", F.col("form").alias("up")), most, ratio).select("word", F.col("up").alias("end"))
    return forms.join(ends, "word", "left").select("word", "form", F.coalesce("end", "word").alias("root"), "n", "n_near", "form_n")
