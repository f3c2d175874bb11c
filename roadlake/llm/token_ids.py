"""Token ids of whole texts by a ``tokenizers`` vocabulary file, with a running position.

The vocabulary splits at white space and drops it, so a text's ids are the ids of its
white-space words one after the other.  Each Python worker keeps the ids of the words it
has met (bounded, see ``CACHE_WORDS``) and gives the library only words it has not met.
``tests/llm`` compares the result with the library's ids of whole texts.
"""

from __future__ import annotations

import functools
import json
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored, text_bytes
from .words import IdPool, spans

END_ID = 1
#: Words whose ids one Python worker keeps (about 60 bytes each); beyond it starts anew.
CACHE_WORDS = 1_000_000
#: Runs of words whose ids it keeps (about 250 bytes each): words that differ in case or marks share theirs.
CACHE_RUNS = 1 << 16
ID = np.dtype("<u4")

TOKEN_SCHEMA = "part int, before long, doc_id {id_type}, n_tokens long, ids binary"
COUNTED = ", used binary"


#: ASCII marks but the apostrophe, with which the pattern's own endings begin.
_MARKS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum() and b != 0x27)


def byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write bytes that are no visible Latin-1 character: as the next letters from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(0x100 + k) for k, b in enumerate(hidden)}


class WordIds:
    """Ids of texts, as little-endian unsigned 32-bit integers, from the ids of their words.

    A vocabulary of the known shape (canonical composition, white space folded, lower case; a
    pattern's matches, byte by byte) cuts a word into runs, and the library's model gives
    each run's ids directly.  Other vocabularies, and words with characters from U+0300
    on, go through the library's whole pipeline.
    """

    def __init__(self, vocabulary: str, cache_words: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(vocabulary)
        self.pattern = _run_pattern(json.loads(vocabulary))
        self.special = os.path.commonprefix([t.content for t in self.tok.get_added_tokens_decoder().values()])
        self.letters = byte_letters()
        self.pool = IdPool(self._learn, cache_words)
        self.run = functools.lru_cache(CACHE_RUNS)(self._run)

    def _run(self, run: bytes) -> bytes:
        text = run.decode() if run.isalpha() else run.decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.tok.model.tokenize(text)]).tobytes()

    def _learn(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word."""
        if self.pattern is None:
            return self._whole(words)
        run = self.run
        out: list[bytes | None] = []
        for w in words:
            core = w.rstrip(_MARKS)  # most words are letters, then perhaps a run of marks
            if not core or core.isalpha():
                ids = run(core.lower()) if core else b""
            else:
                s = core.decode("utf-8", "replace")
                if max(s) >= "\u0300" or "İ" in s or (self.special in s if self.special else False):
                    out.append(None)
                    continue
                s = s.lower()
                ids = run(s.encode()) if s.isalpha() else b"".join([run(r.encode()) for r in self.pattern.findall(s)])
                if not s.isalpha() and core != w and not s[-1].isalnum():
                    out.append(None)  # the marks go on from the core's own
                    continue
            out.append(ids + run(w[len(core) :]) if len(core) < len(w) else ids)
        rest = [k for k, x in enumerate(out) if x is None]
        for k, ids in zip(rest, self._whole([words[k] for k in rest])):
            out[k] = ids
        return out

    def _whole(self, words: list[bytes]) -> list[bytes]:
        found = self.tok.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)
        return [np.array(e.ids, ID).tobytes() for e in found]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """All ids of each text."""
        if self.pool.known.count > self.pool.cap:
            self.pool.clear()
        data, starts, ends, n_words = spans(texts)
        return self.pool.joined(self.pool.numbers(data, starts, ends), n_words)


def _run_pattern(made: dict):
    """The compiled pattern of a vocabulary of the known shape, else None."""
    steps = [n.get("type") for n in (made.get("normalizer") or {}).get("normalizers", [])]
    cuts = (made.get("pre_tokenizer") or {}).get("pretokenizers", [])
    if steps != ["NFC", "Replace", "Lowercase"] or [c.get("type") for c in cuts] != ["Split", "ByteLevel"]:
        return None
    split, level = cuts
    if (split["behavior"], split["invert"], level["add_prefix_space"], level["use_regex"]) != ("Removed", True, False, False):
        return None
    return regex.compile(split["pattern"]["Regex"])


_MADE: dict[int, WordIds] = {}


def word_ids(vocabulary: str) -> WordIds:
    """One encoder per Python worker and vocabulary."""
    key = hash(vocabulary)
    if key not in _MADE:
        _MADE.clear()
        _MADE[key] = WordIds(vocabulary)
    return _MADE[key]


def read_vocabulary(path: str) -> str:
    """The vocabulary file's text; a file of this kind is a few MB, checked before it is sent out."""
    if os.path.getsize(path) > 64 << 20:
        raise ValueError(f"{path} is too large to send to every task")
    with open(path, encoding="utf-8") as f:
        return f.read()


def pieces_of(column: pa.Array, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The column's values in lists of about ``size`` bytes, so that memory follows one list."""
    upto = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(column):
        before = upto[at - 1] if at else 0
        end = int(np.searchsorted(upto, before + size)) + 1
        yield column.slice(at, end - at).to_pylist()
        at = end


def tokenised(docs: DataFrame, vocabulary_path: str, *, id_col: str = "doc_id", text_col: str = "text",
              end_id: int = END_ID, ordered: int = 0, counted: bool = False) -> DataFrame:
    """Written table ``(part, before, doc_id, n_tokens, ids)`` of every row of ``docs``.

    ``ids`` holds the document's ids and then ``end_id``; null text counts as empty.
    ``part`` is the task that made the row and ``before`` the number of ids in that task's
    rows before it, so a global position needs only the totals of the parts.  With
    ``ordered`` > 0 the rows lie in ascending ``doc_id`` order over that many parts (null
    ids first, equal ids by a hash of their text); else they keep the input's order.

    With ``counted`` there is one more column ``used`` and one more row a task, the only one in which it is
    not null: the ids that occur in the task's rows and, after them, how often (64-bit integers).
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), text_bytes(text_col).alias("text"))
    if ordered:
        # ``row`` deals rows that are equal in both over several parts; their order does not matter
        keyed = rows.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
        rows = (keyed.repartitionByRange(ordered, "doc_id", "tie", "row")
                .sortWithinPartitions("doc_id", "tie", "row").select("doc_id", "text"))
    shared = spark.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    end = np.array([end_id], ID).tobytes()

    def encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(shared.value)
        part, before, seen = TaskContext.get().partitionId(), 0, np.zeros(0, dtype=np.int64)
        for batch in parts:
            at = 0
            for texts in pieces_of(batch.column("text")):
                ids = [x + end for x in encoder.encode(texts)]
                n = np.array([len(x) // ID.itemsize for x in ids], dtype=np.int64)
                starts = before + np.cumsum(n) - n
                before += int(n.sum())
                if counted:
                    got = np.bincount(np.frombuffer(b"".join(ids), ID), minlength=len(seen))
                    got[: len(seen)] += seen
                    seen = got
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), part, dtype=np.int32)), pa.array(starts),
                     batch.column("doc_id").slice(at, len(n)), pa.array(n), pa.array(ids, pa.binary()),
                     *([pa.nulls(len(n), pa.binary())] if counted else [])], names=names)
                at += len(n)
        if before and counted:
            there = np.flatnonzero(seen)
            last = (part, before, None, 0, b"", np.concatenate([there, seen[there]]).astype("<i8").tobytes())
            types = (pa.int32(), pa.int64(), batch.schema.field("doc_id").type, pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(last, types)], names=names)

    spec = TOKEN_SCHEMA.format(id_type=id_type) + (COUNTED if counted else "")
    names = [x.split()[0] for x in spec.split(", ")]
    return stored(rows.mapInArrow(encode, spec), "tokens")


def with_start(tokens: DataFrame) -> DataFrame:
    """Adds ``start``: the ids of all rows before this one.

    First pass: one total per part.  Their prefix sums (as many as there were tasks) come
    from the driver and go back as a small table; second pass: part base plus ``before``.
    """
    spark = tokens.sparkSession
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()
    bases, total = [], 0
    for part, n in sorted((r["part"], r["n"]) for r in totals):
        bases.append((part, total))
        total += n
    base = spark.createDataFrame(bases, "part int, base long")
    return (tokens.join(F.broadcast(base), "part")
            .withColumn("start", F.col("base") + F.col("before")).drop("base"))
