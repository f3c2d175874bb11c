"""Subword lattice likelihood.

A word's lattice has one arc for every vocabulary piece that matches somewhere in it.  Each
segmentation of the word is a path, its probability the product of its pieces' weights, and
the word's probability the sum over all paths, by a forward recursion in log space.  Pieces
never cross the start of a word, so a text's probability is the product of its words' and
of the end's.

The vocabulary is an existing one and is not changed; its scores are the prior of the
weights.  The weights are fitted to the distinct words of the training texts by expectation
maximisation (forward and backward recursion), with the prior as pseudo counts.  A word
that the training texts hold has one more segmentation, itself as a whole: an arc from its
start to its end whose weight is its discounted share of the training tokens.  What the
discount leaves over is the weight of the segmentations into pieces, for all words, known
or not; so the probabilities of all words and of the end still sum to one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import BLOCK_BYTES, block_of, count_blocks, ship, stored, text_bytes
from .sp_model import BYTE, CONTROL, UNIGRAM, UNKNOWN, read_model
from .token_ids import pieces_of
from .words import WordNumbers, spans

MARK = "▁"
ROUNDS = 2
#: Pseudo counts that the vocabulary's own scores are worth in training.
PRIOR = 1000.0
#: What is taken off each token's count for the segmentations into pieces.
DISCOUNT = 0.5
_MUL = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_SLOTS = 18


@dataclass(frozen=True)
class Lattice:
    """Pieces that may be arcs, found by a hash of their characters."""

    pieces: list[str]
    byte_index: list[int]  # index of each byte's piece, or -1
    longest: int
    hashes: np.ndarray
    table: np.ndarray  # (slots, width) indices of pieces by hash, -1: none

    @property
    def end(self) -> int:
        return len(self.pieces)


def _hash(chars: np.ndarray) -> np.ndarray:
    return (chars.astype(np.uint64) + np.uint64(1)) * _MUL


def lattice(pieces: list[str], byte_index: list[int]) -> Lattice:
    hashes = np.zeros(len(pieces), dtype=np.uint64)
    for k, piece in enumerate(pieces):
        h = np.zeros(1, dtype=np.uint64)
        for c in _hash(np.frombuffer(piece.encode("utf-32-le"), "<u4")):
            h = h * _STEP + c
        hashes[k] = h[0]
    byte_set = {b for b in byte_index if b >= 0}
    arcs = np.array([k for k in range(len(pieces)) if k not in byte_set and pieces[k]], dtype=np.int64)
    slot = (hashes[arcs] >> np.uint64(64 - _SLOTS)).astype(np.int64)
    order = np.argsort(slot, kind="stable")
    slot, arcs = slot[order], arcs[order]
    place = np.arange(len(slot)) - np.searchsorted(slot, slot)
    table = np.full((1 << _SLOTS, int(place.max(initial=0)) + 1), -1, dtype=np.int32)
    table[slot, place] = arcs
    return Lattice(pieces, byte_index, max((len(pieces[a]) for a in arcs), default=1), hashes, table)


def find(lat: Lattice, h: np.ndarray) -> np.ndarray:
    """Piece index of each hash, or the number of pieces + 1 (no arc)."""
    slot = (h >> np.uint64(64 - _SLOTS)).astype(np.int64)
    out = np.full(h.shape, len(lat.pieces) + 1, dtype=np.int32)
    for w in range(lat.table.shape[1]):
        got = lat.table[slot, w]
        at = np.nonzero(got >= 0)
        right = lat.hashes[got[at]] == h[at]
        hit = tuple(x[right] for x in at)
        out[hit] = got[hit]
        if not len(at[0]):
            break
    return out


def arcs_of(lat: Lattice, words: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Words of one length: characters (words, n), and for each piece length l the arcs (words, n - l + 1)."""
    n = len(words[0])
    chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), n)
    x = _hash(chars)
    found, h = [], x
    for l in range(1, min(lat.longest, n) + 1):
        if l > 1:
            h = h[:, :-1] * _STEP + x[:, l - 1 :]
        found.append(find(lat, h))
    return chars, found


def _spell(lat: Lattice, char: int) -> list[int]:
    raw = chr(char).encode("utf-8", "replace")
    return [lat.byte_index[b] for b in raw if lat.byte_index[b] >= 0]


def log_weights(weights: np.ndarray) -> np.ndarray:
    """Natural logarithms of the pieces' and the end's weights, and minus infinity for no arc."""
    with np.errstate(divide="ignore"):
        return np.append(np.log(weights), -np.inf)


#: A character that neither a piece nor byte pieces can spell.
_LOST = -60.0


def _single(lat: Lattice, chars: np.ndarray, found: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Log weight of each character alone: its piece, or else its bytes one after the other."""
    out = logs[found]
    bare = found == len(lat.pieces) + 1
    if bare.any():
        for c in np.unique(chars[bare]):
            spelt = _spell(lat, int(c))
            out[bare & (chars == c)] = float(sum(logs[b] for b in spelt)) if spelt else _LOST
    return out


#: Longer words are summed up in stretches side by side.
LONG = 2048


def _log_sum(terms: np.ndarray) -> np.ndarray:
    """Logarithm of the sum over the first axis."""
    top = terms.max(axis=0)
    top[top == -np.inf] = 0.0
    with np.errstate(divide="ignore"):
        return top + np.log(np.exp(terms - top).sum(axis=0))


def _sums(ends: list[np.ndarray]) -> np.ndarray:
    """``out[:, j]``: log sum over all chains of arcs from 0 to j; ``ends[l - 1][:, j]`` is the arc of length l that ends at j."""
    count, n = ends[0].shape[0], ends[0].shape[1] - 1
    if n > LONG:
        return np.stack([_long_sums([e[r] for e in ends]) for r in range(count)])
    out = np.full((count, n + 1), -np.inf)
    out[:, 0] = 0.0
    for j in range(1, n + 1):
        out[:, j] = _log_sum(np.stack([out[:, j - l] + ends[l - 1][:, j] for l in range(1, min(j, len(ends)) + 1)]))
    return out


def _long_sums(ends: list[np.ndarray]) -> np.ndarray:
    """``_sums`` of one long word: its stretches go side by side, as many steps as the root of its length.

    What a stretch does depends on the sums at the ``len(ends)`` places before it.  The first pass
    takes each of these places alone as a start, which gives the stretch's matrix; the matrices, one
    after the other, give the sums before each stretch; the second pass fills the stretches in.
    """
    n, reach = len(ends[0]) - 1, len(ends)
    width = max(reach, int(n**0.5))
    rows = -(-n // width)
    arcs = np.full((reach, rows * width), -np.inf)
    arcs[:, :n] = [e[1:] for e in ends]
    arcs = arcs.reshape(reach, rows, width)
    last = [np.full((rows, reach), -np.inf) for _ in range(reach)]  # the sums at the latest places, newest first
    for k in range(reach):
        last[k][:, k] = 0.0
    for t in range(width):
        last = [_log_sum(np.stack([last[l] + arcs[l, :, t, None] for l in range(reach)])), *last[:-1]]
    matrix = np.stack(last, axis=2)  # (stretch, place before it, place at its end)
    before = np.full((rows, reach), -np.inf)
    before[0, 0] = 0.0
    for r in range(1, rows):
        before[r] = _log_sum(before[r - 1][:, None] + matrix[r - 1])
    last = [before[:, k] for k in range(reach)]
    out = np.empty((rows, width))
    for t in range(width):
        out[:, t] = _log_sum(np.stack([last[l] + arcs[l, :, t] for l in range(reach)]))
        last = [out[:, t], *last[:-1]]
    return np.append(0.0, out.ravel()[:n])


def _ending(weight: list[np.ndarray]) -> list[np.ndarray]:
    """Arcs by where they end instead of where they start."""
    count, n = weight[0].shape
    out = [np.full((count, n + 1), -np.inf) for _ in weight]
    for l, w in enumerate(weight, start=1):
        out[l - 1][:, l:] = w
    return out


def forward(lat: Lattice, chars: np.ndarray, found: list[np.ndarray], logs: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """``alpha[:, j]``: log probability of all segmentations of the first j characters; and the arcs' weights."""
    weight = [_single(lat, chars, found[0], logs), *(logs[f] for f in found[1:])]
    return _sums(_ending(weight)), weight


def expected(lat: Lattice, chars, found, logs, times: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over all segmentations, each word ``times`` times."""
    alpha, weight = forward(lat, chars, found, logs)
    count, n = chars.shape
    beta = _sums(_ending([w[:, ::-1] for w in weight]))[:, ::-1]  # the same from the end
    out = np.zeros(len(lat.pieces) + 2)
    whole = alpha[:, n][:, None]
    for l, (w, f) in enumerate(zip(weight, found), start=1):
        share = times[:, None] * np.exp(alpha[:, : n - l + 1] + w + beta[:, l:] - whole)
        out += np.bincount(f.ravel(), share.ravel(), len(out))
        if l == 1 and (bare := f == len(lat.pieces) + 1).any():
            for c in np.unique(chars[bare]):
                for b in _spell(lat, int(c)):
                    out[b] += share[bare & (chars == c)].sum()
    return out[: len(lat.pieces)]


def by_length(words: list[bytes], budget: int = 1 << 20) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Indices and marked texts of words of equal length, in groups of bounded size."""
    texts = [MARK + w.decode("utf-8", "replace") for w in words]
    lengths = np.array([len(t) for t in texts])
    order = np.argsort(lengths, kind="stable")
    for same in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(order) else []:
        size = max(1, budget // (int(lengths[same[0]]) * 16))
        for k in range(0, len(same), size):
            part = same[k : k + size]
            yield part, [texts[i] for i in part]


def word_logs(lat: Lattice, words: list[bytes], logs: np.ndarray) -> np.ndarray:
    """log10 of each word's probability."""
    out = np.zeros(len(words))
    for at, texts in by_length(words):
        chars, found = arcs_of(lat, texts)
        out[at] = forward(lat, chars, found, logs)[0][:, -1] / np.log(10)
    return out


@dataclass(frozen=True)
class Shares:
    """How whole words and segmentations into pieces share the probability."""

    n_tokens: int  # of the training texts, ends included
    n_types: int
    n_train: int
    into_pieces: float  # of any token: the weight of all segmentations into pieces
    word_start: float  # log10: from the lattice's weight of a word to its probability as a word
    end: float  # log10 of the end's probability

    def words(self, counts: np.ndarray, lattice_logs: np.ndarray) -> np.ndarray:
        """log10 of each word's probability from its training count and its lattice weight."""
        pieces = lattice_logs + self.word_start + np.log10(self.into_pieces)
        whole = np.maximum(counts - DISCOUNT, 0.0) / max(self.n_tokens, 1)
        with np.errstate(divide="ignore"):
            return np.where(whole > 0, np.logaddexp(np.log(whole), pieces * np.log(10)) / np.log(10), pieces)


def shares(lat: Lattice, weights: np.ndarray, n_tokens: int, n_types: int, n_train: int) -> Shares:
    """A word made of pieces is one that starts a word, others, and then a new word or the end."""
    first = float(sum(w for p, w in zip(lat.pieces, weights) if p.startswith(MARK)))
    stop = first + float(weights[lat.end])
    if n_train:
        into, end = DISCOUNT * n_types / n_tokens, (n_train - DISCOUNT) / n_tokens
    else:  # nothing to learn from: the vocabulary's scores alone
        into, end = first / stop, float(weights[lat.end]) / stop
    return Shares(n_tokens, n_types, n_train, into, float(np.log10(stop / first)), float(np.log10(end)))


def vocabulary(model_path: str) -> tuple[Lattice, np.ndarray]:
    """Arcs and prior weights (with the end's as last) from a SentencePiece model file.

    A unigram model's scores are log probabilities.  A merge model's scores are minus the
    place of the piece in the merge list; place r gets the weight ``1 / (r + 3)`` (Zipf).
    """
    model = read_model(model_path)
    pieces, weights, byte_index = [], [], [-1] * 256
    for piece, score, kind in model.pieces:
        inner = MARK in piece.lstrip(MARK) or piece.startswith(MARK * 2)
        if kind in (CONTROL, UNKNOWN) or (inner and kind != BYTE) or not piece:
            continue
        if kind == BYTE:
            byte_index[int(piece[3:5], 16)] = len(pieces)
            weights.append(None)
        else:
            weights.append(np.exp(score) if model.model_type == UNIGRAM else 1.0 / (3.0 - min(0.0, float(score))))
        pieces.append(piece)
    least = min(w for w in weights if w is not None)
    weights = np.array([least if w is None else w for w in weights] + [least])
    return lattice(pieces, byte_index), weights / weights.sum()


def word_spans(texts: list[bytes]):
    """``words.spans`` of the texts in lower case (A-Z only): words are parted by the six ASCII white-space bytes."""
    return spans([t.lower() for t in texts])


class BlockCounts:
    """The distinct words of one block and how often each stands in its training texts."""

    def __init__(self) -> None:
        self.known, self.words, self.counts = WordNumbers(), [], np.zeros(1024, dtype=np.int64)

    def add(self, texts: list[bytes], training: np.ndarray) -> None:
        data, starts, ends, n_words = word_spans(texts)
        numbers, new = self.known.numbers(data, starts, ends)
        self.words += new
        if len(self.words) > len(self.counts):
            self.counts = np.concatenate([self.counts, np.zeros(max(len(self.words), 2 * len(self.counts)) - len(self.counts), dtype=np.int64)])
        got = np.bincount(numbers[np.repeat(training, n_words)])
        self.counts[: len(got)] += got


class BlockValues:
    """A block's words with a row of values each, and their sums over texts."""

    def __init__(self) -> None:
        self.known, self.parts = WordNumbers(), []

    def load(self, words: list[bytes], values: np.ndarray) -> None:
        data, starts, ends, _ = spans(words)
        numbers, _ = self.known.numbers(data, starts, ends)
        placed = np.empty_like(values)
        placed[:, numbers - (self.known.count - len(words))] = values  # the words are new and distinct
        self.parts.append(placed)

    def sums(self, texts: list[bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Each text's number of words, and for each value its sum over the text's words."""
        data, starts, ends, n_words = word_spans(texts)
        self.parts = [np.concatenate(self.parts, axis=1)] if self.parts else [np.zeros((3, 0))]
        numbers, new = self.known.numbers(data, starts, ends)
        if new:
            raise ValueError("a text has a word that its block has not sent")
        doc = np.repeat(np.arange(len(texts)), n_words)
        return n_words, [np.bincount(doc, v[numbers], len(texts)) for v in self.parts[0]]


def runs(blocks: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``(block, from, to)`` of each run of equal values."""
    cuts = np.flatnonzero(np.diff(blocks)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(blocks)]):
        if b > a:
            yield int(blocks[a]), a, b


def score(docs: DataFrame, train: Column, model_path: str, *, rounds: int = ROUNDS, prior: float = PRIOR,
          block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    ``train`` picks the training rows; ``held_out`` is its opposite.  Tokens are the text's
    words and one end.  ``base_score`` is the sum of log10((c + 0.1) / (N + 0.1 (V + 1)))
    over a text's tokens, from the counts c of tokens in all training texts; ``score`` is the
    log10 probability of the text, all segmentations of all its words summed up.  Null text counts as empty: one
    end.  Equal rows and null ids each give a row; no rows give no rows, no training rows
    leave the vocabulary's own weights and counts of 0.  Other columns are not read.

    A block of documents sends each of its distinct words once, and gets that word's count
    and probability back; no task holds more words than its block has.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(train, F.lit(False)).alias("train"), text_bytes(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text")).alias("b"), F.count_if("train").alias("n")).first()
    n_blocks, n_train = count_blocks(total["b"], block_bytes), total["n"] or 0
    blocked = rows.select(block_of(n_blocks, "id", "text").alias("block"), "id", "train", "text")
    lat, weights = vocabulary(model_path)
    held_lattice = spark.sparkContext.broadcast(lat)  # as large as the vocabulary

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, BlockCounts] = {}
        for batch in parts:
            training = batch.column("train").to_numpy(zero_copy_only=False)
            for block, a, b in runs(batch.column("block").to_numpy()):
                of_block = held.setdefault(block, BlockCounts())
                for texts in pieces_of(batch.column("text").slice(a, b - a)):
                    of_block.add(texts, training[a : a + len(texts)])
                    a += len(texts)
        for block, found in held.items():
            for k in range(0, len(found.words), 50_000):
                part = found.words[k : k + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), block, dtype=np.int32)), pa.array(part, pa.binary()),
                                                  pa.array(found.counts[k : k + len(part)])], names=["block", "word", "n"])

    once = (blocked.select("block", "train", "text").repartitionById(n_blocks, "block")
            .mapInArrow(count, "block int, word binary, n long"))
    order = Window.partitionBy("word").orderBy("block")
    everywhere = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counted = stored(once.select("block", "word", F.sum("n").over(everywhere).alias("c"),
                                 (F.row_number().over(order) == 1).alias("first")), "word-counts")
    distinct = counted.where("first and c > 0").select("word", "c")
    sums = distinct.agg(F.sum("c"), F.count("*")).first()
    n_tokens, n_words = (sums[0] or 0) + n_train, sums[1] + (n_train > 0)

    for _ in range(rounds if n_train else 0):
        logs = spark.sparkContext.broadcast(log_weights(weights))

        def expect(parts: Iterator[pa.RecordBatch], logs=logs) -> Iterator[pa.RecordBatch]:
            lat_ = held_lattice.value
            uses = np.zeros(len(lat_.pieces))
            for batch in parts:
                words = batch.column("word").to_pylist()  # each once: rare words tell what unknown ones look like
                for at, texts in by_length(words):
                    uses += expected(lat_, *arcs_of(lat_, texts), logs.value, np.ones(len(at)))
            used = np.flatnonzero(uses)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(uses[used])], names=["piece", "uses"])

        # one row per piece of the vocabulary at most
        got = distinct.mapInArrow(expect, "piece long, uses double").groupBy("piece").agg(F.sum("uses").alias("uses")).toArrow()
        uses = prior * weights
        uses[got.column("piece").to_numpy()] += got.column("uses").to_numpy()
        uses[lat.end] += 1
        weights = uses / uses.sum()

    logs = spark.sparkContext.broadcast(log_weights(weights))
    parted = shares(lat, weights, n_tokens, n_words, n_train)
    base_of = lambda c: np.log10((c + 0.1) / (n_tokens + 0.1 * (n_words + 1)))

    def weigh(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lat_ = held_lattice.value
        for batch in parts:
            words = batch.column("word").to_pylist()
            once_each = list(dict.fromkeys(words))  # the rows of one word lie together
            log = dict(zip(once_each, word_logs(lat_, once_each, logs.value).tolist()))
            model = parted.words(batch.column("c").to_numpy(), np.array([log[w] for w in words], dtype=np.float64))
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("word"), batch.column("c"), pa.array(model)],
                                             names=["block", "word", "c", "log"])

    def nothing(kind):
        return F.lit(None).cast(kind)

    id_type = rows.schema["id"].dataType
    weighed = counted.select("block", "word", "c").mapInArrow(weigh, "block int, word binary, c long, log double")
    met = (weighed.select("block", F.lit(0).alias("kind"), "word", "c", "log", nothing(id_type).alias("id"), nothing("boolean").alias("train"))
           .unionByName(blocked.select("block", F.lit(1).alias("kind"), F.col("text").alias("word"), nothing("long").alias("c"),
                                       nothing("double").alias("log"), "id", "train"))
           .repartitionById(n_blocks, "block").sortWithinPartitions("kind"))
    end_base = float(base_of(np.float64(n_train)))

    def total_up(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, BlockValues] = {}
        for batch in parts:
            kinds = batch.column("kind").to_numpy()
            firsts = int((kinds == 0).sum())  # sorted: words come before texts
            head, rest = batch.slice(0, firsts), batch.slice(firsts)
            for block, a, b in runs(head.column("block").to_numpy()):
                c = head.column("c").to_numpy()[a:b]
                values = np.stack([(c > 0).astype(np.float64), base_of(c), head.column("log").to_numpy()[a:b]])
                held.setdefault(block, BlockValues()).load(head.column("word").slice(a, b - a).to_pylist(), values)
            for block, a, b in runs(rest.column("block").to_numpy()):
                for texts in pieces_of(rest.column("word").slice(a, b - a)):
                    n_words, (known, base, model) = held.setdefault(block, BlockValues()).sums(texts)
                    n = len(texts)
                    yield pa.RecordBatch.from_arrays(
                        [rest.column("id").slice(a, n), pc.invert(rest.column("train").slice(a, n)), pa.array(n_words + 1),
                         pa.array(known.astype(np.int64) + (n_train > 0)), pa.array(np.full(n, n_tokens, dtype=np.int64)),
                         pa.array(base + end_base), pa.array(model + parted.end)],
                        names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
                    a += n

    return met.mapInArrow(total_up, f"doc_id {id_type.simpleString()}, held_out boolean, n_tokens long, n_known long, "
                                    "train_tokens long, base_score double, score double")
