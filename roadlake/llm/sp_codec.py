"""SentencePiece encoding and decoding on the ``tokenizers`` library.

The model file's parts are rebuilt as a ``tokenizers`` pipeline: the normaliser (its
character map, extra white space, the leading marker), the marker for spaces, the unigram
scores or the merge order, and byte fallback.  Batches are encoded by the library's
threads.  No piece has a marker behind another character, so a text's ids are those of its
stretches "spaces, then what follows"; each worker keeps the ids of stretches it has met and
gives the library's model only those it has not.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ship, text_bytes
from .sp_model import BPE, BYTE, CONTROL, NORMAL, UNIGRAM, UNKNOWN, UNUSED, USER_DEFINED, Model, parse_model, read_model
from .token_ids import ID, pieces_of
from .words import IdPool

MARK = "▁"
THREADS = 2
#: Stretches whose ids one Python worker keeps (about 60 bytes each); beyond it starts anew.
CACHE = 1_000_000

#: ``encode`` compares the libraries' ids for one text in so many, by a hash of it, where texts go by their stretches; ``digests`` for all.
PARITY_SHARE = 16


def _merges(model: Model) -> list[tuple[str, str]]:
    """The merge list of a merge model: every way to split a piece in two, best piece first."""
    place = {p: -s for p, s, kind in model.pieces if kind in (NORMAL, UNUSED)}
    found = []
    for piece, at in place.items():
        for k in range(1, len(piece)):
            left, right = piece[:k], piece[k:]
            if left in place and right in place:
                found.append((at, place[left], place[right], left, right))
    return [(left, right) for *_, left, right in sorted(found)]


def core_of(model: Model, **options):
    """The library's model alone: ids of a text that is normalised and not to be cut; ``options`` are those of its merge model."""
    from tokenizers import models

    unk = model.pieces[model.unk_id][0]
    if model.model_type == UNIGRAM:
        # pieces that never match text keep their place under a name that no text has
        names = [(f"﷐{p}" if kind in (CONTROL, UNKNOWN) else p, s) for p, s, kind in model.pieces]
        return models.Unigram(names, unk_id=model.unk_id, byte_fallback=model.byte_fallback)
    if model.model_type == BPE:
        ids = {p: k for k, (p, _, _) in enumerate(model.pieces)}
        return models.BPE(ids, _merges(model), unk_token=unk, fuse_unk=True, byte_fallback=model.byte_fallback, **options)
    raise ValueError("only unigram and merge models are supported")


def build(model: Model, prefix: bool | None = None):
    """The pipeline of ``model``; ``prefix`` overrides whether a marker is put in front."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, normalizers, pre_tokenizers

    core = core_of(model)
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.remove_extra_whitespaces:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.add_dummy_prefix if prefix is None else prefix:
        steps.append(normalizers.Prepend(" "))
    if model.escape_whitespaces:
        steps.append(normalizers.Replace(" ", MARK))
    tok = Tokenizer(core)
    if steps:
        tok.normalizer = normalizers.Sequence(steps)
    # the library then keeps the ids of stretches it has met; nothing merges across their ends
    tok.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*"), "isolated")
    # the marker in front goes again; a model that removes extra white space removes all in front
    lead = (1 << 16 if model.remove_extra_whitespaces else 1) if model.add_dummy_prefix and prefix is None else 0
    spaces = decoders.Metaspace(MARK, prepend_scheme="never")  # a look at each character; Replace runs a pattern over every id's piece
    tok.decoder = decoders.Sequence([spaces, decoders.ByteFallback(), decoders.Fuse(), decoders.Strip(" ", lead, 0)])
    own = [p for p, _, kind in model.pieces if kind == USER_DEFINED]
    if own:
        tok.add_tokens([AddedToken(p, normalized=True, special=False) for p in own])
    return tok


def stretches_of(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The texts joined, each after one space; starts and ends of their stretches; stretches per text.

    A stretch begins with a run of spaces or markers, with a run of line feeds, or behind
    one.  Empty texts have none.
    """
    sizes = np.array([len(t) + 1 if t else 0 for t in texts], dtype=np.int64)
    joined = b"".join(b" " + t for t in texts if t) + b" " * 16
    d = np.frombuffer(joined, dtype=np.uint8)
    kind = (d == 0x20).astype(np.int8) + 2 * (d == 0x0A)
    mark = np.flatnonzero((d[:-2] == 0xE2) & (d[1:-1] == 0x96) & (d[2:] == 0x81))
    kind[mark], kind[mark + 1], kind[mark + 2] = 1, 1, 1
    begins = np.zeros(len(d), dtype=bool)
    begins[1:] = (kind[1:] != kind[:-1]) & ((kind[1:] > 0) | (kind[:-1] == 2))
    upto = np.cumsum(sizes)
    begins[(upto - sizes)[sizes > 0]] = True
    starts = np.flatnonzero(begins[: len(d) - 16])
    ends = np.append(starts[1:], len(d) - 16) if len(starts) else starts
    return joined, starts, ends, np.diff(np.searchsorted(starts, upto), prepend=0)


class Codec:
    """Encodes and decodes texts with the ids of a SentencePiece model."""

    def __init__(self, raw: bytes, threads: int = THREADS, cache: int = CACHE, check: bool = False, share: int = PARITY_SHARE):
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        self.share = share
        self.model = parse_model(raw)
        self.whole = build(self.model)
        m = self.model
        texts = [p for p, _, kind in m.pieces if kind in (NORMAL, USER_DEFINED, UNUSED)]
        self.plain = not m.charsmap and not m.remove_extra_whitespaces and m.escape_whitespaces
        # with byte fallback nothing is unknown, and only unknown characters run together across a stretch's end
        spelt = m.byte_fallback and sum(kind == BYTE for _, _, kind in m.pieces) == 256
        self.parted = self.plain and spelt and m.add_dummy_prefix and not any(MARK in p.lstrip(MARK) or "\n" in p or " " in p for p in texts)
        # a stretch is met once and is one word of the pipeline: the model gives its ids, unless whole pieces are looked for before it
        self.inner = build(m, prefix=False) if any(kind == USER_DEFINED for _, _, kind in m.pieces) else None
        self.core = core_of(m, cache_capacity=0) if self.parted and not self.inner else None
        self.pool = IdPool(self._learn, cache)
        self.judge = None
        if check:
            import sentencepiece

            self.judge = sentencepiece.SentencePieceProcessor(model_proto=raw, num_threads=threads)

    def _learn(self, stretches: list[bytes]) -> list[bytes]:
        texts = [s.decode("utf-8", "replace") for s in stretches]
        if self.core:
            ids_of = self.core.tokenize
            return [array("I", [t.id for t in ids_of(x.replace(" ", MARK))]).tobytes() for x in texts]
        found = [e.ids for e in self.inner.encode_batch_fast(texts, add_special_tokens=False)]
        return [np.array(ids, ID).tobytes() for ids in found]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return self.checked(texts)[0]

    def checked(self, texts: list[bytes]) -> tuple[list[bytes], list[bool], list[bool | None]]:
        """Ids of each text; whether they decode to it; whether the sentencepiece library gives the same (None: not asked).

        Every text's own ids are decoded.  The library is asked about whole texts: all of them, or
        where ids come from stretches one in ``share``, by a hash of the text.
        """
        if not self.parted:
            plain = [t.decode("utf-8", "replace") for t in texts]
            found = [e.ids for e in self.whole.encode_batch_fast(plain, add_special_tokens=False)]
            ids = [np.array(x, ID).tobytes() for x in found]
            if not self.judge:
                return ids, [], []
            back = self.whole.decode_batch(found, skip_special_tokens=False)
            return ids, [a == b for a, b in zip(back, plain)], [a == b for a, b in zip(self.judge.encode(plain), found)]
        if self.pool.known.count > self.pool.cap:
            self.pool.clear()
        data, starts, ends, n = stretches_of(texts)
        numbers = self.pool.numbers(data, starts, ends)
        ids = self.pool.joined(numbers, n)
        if not self.judge:
            return ids, [], []
        plain = [t.decode("utf-8", "replace") for t in texts]
        found = [np.frombuffer(x, ID).tolist() for x in ids]
        back = [a == b for a, b in zip(self.whole.decode_batch(found, skip_special_tokens=False), plain)]
        same: list[bool | None] = [None] * len(texts)
        asked = [k for k, t in enumerate(texts) if self.share == 1 or zlib.crc32(t) % self.share == 0]
        for k, theirs in zip(asked, self.judge.encode([plain[k] for k in asked])):
            same[k] = theirs == found[k]
        return ids, back, same

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        """Text of each array of ids, by the pipeline's decoder."""
        return self.whole.decode_batch([i.tolist() for i in ids], skip_special_tokens=False)


_MADE: dict[tuple, Codec] = {}


def codec_of(raw: bytes, threads: int, check: bool, share: int = PARITY_SHARE) -> Codec:
    """One codec per Python worker and model: the stretches it has met serve the worker's next tasks."""
    key = (hash(raw), threads, check, share)
    if key not in _MADE:
        _MADE.clear()
        _MADE[key] = Codec(raw, threads, check=check, share=share)
    return _MADE[key]


def encode(docs: DataFrame, model_path: str, *, threads: int = THREADS, check: bool = False, share: int = PARITY_SHARE,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row (ids as little-endian unsigned 32-bit integers).

    ``check`` adds ``round_trip``, whether decoding the row's ids gives its text back,
    and ``parity``, whether the ``sentencepiece`` library gives the same ids for the whole text; it is
    null for texts on which that was not measured: all but one in ``share``.  Null and empty
    texts have no ids.  Equal rows and null ids each give a row; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), text_bytes(text_col).alias("text"))
    read_model(model_path)  # checks size and format here, not in a task
    with open(model_path, "rb") as f:
        shared = rows.sparkSession.sparkContext.broadcast(f.read())
    ship(docs.sparkSession)
    names = ["doc_id", "n_tokens", "ids", *(["round_trip", "parity"] if check else [])]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared.value, threads, check, share)
        for batch in parts:
            at = 0
            for raw in pieces_of(batch.column("text")):
                ids, back, same = codec.checked(raw)
                out = [batch.column("doc_id").slice(at, len(ids)), pa.array([len(x) // ID.itemsize for x in ids], pa.int64()),
                       pa.array(ids, pa.binary())]
                if check:
                    out += [pa.array(back, pa.bool_()), pa.array(same, pa.bool_())]
                yield pa.RecordBatch.from_arrays(out, names=names)
                at += len(ids)

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids binary"
                           + (", round_trip boolean, parity boolean" if check else ""))


def decode(rows: DataFrame, model_path: str, *, id_col: str = "doc_id", ids_col: str = "ids", threads: int = THREADS) -> DataFrame:
    """``doc_id, text`` from rows of ids; null ids give null text."""
    ship(rows.sparkSession)
    read_model(model_path)
    with open(model_path, "rb") as f:
        shared = rows.sparkSession.sparkContext.broadcast(f.read())
    rows = rows.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value, threads)
        for batch in parts:
            held = batch.column("ids").to_pylist()
            texts = iter(codec.decode([np.frombuffer(x, ID) for x in held if x is not None]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([None if x is None else next(texts) for x in held], pa.string())],
                                             names=["doc_id", "text"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")


def digests(docs: DataFrame, model_path: str, **options) -> DataFrame:
    """Per row: ``doc_id, n_tokens, ids_crc32, round_trip, parity, parity_measured`` (null text counts as empty), see ``encode``.

    Parity is measured on every text, unless ``share`` says otherwise.
    """
    found = encode(docs, model_path, check=True, **({"share": 1} | options))
    return found.select("doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"), "round_trip", "parity",
                        F.col("parity").isNotNull().alias("parity_measured"))
