"""Substring deduplication by content-defined chunks.

A gear hash rolls over a text's bytes (the last 32 bytes decide its value).  A chunk ends
where that value is the largest within ``REACH`` bytes to either side and the next byte
starts a character.  Cuts depend only on the bytes around them, so a passage is cut alike
wherever it stands, and an insertion moves the cuts near it only.  Text that repeats with a
period of at most ``REACH`` bytes has no largest value: a stretch of it ends a chunk once a
period, from its first byte to its last, at the place in the period with the largest value; a
stretch of one byte is parted from the text around it.  Chunks are compared by a 96-bit
digest, those of one byte whatever their length; the first of equal ones stays.

Documents are dealt into blocks.  A block sends each of its digests once, so a chunk that
millions of documents share reaches the digest's task once per block.  Repeated digests
come back to the blocks that hold them, next to the block's texts, and are cut there.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import BLOCK_BYTES, block_of, count_blocks, ship, stored, text_bytes
from .token_ids import pieces_of

REACH = 16
MAX_CHUNK = 4096
#: A run of repeated chunks is cut when it spans so many bytes (about 16 words).
MIN_RUN = 100
DIGEST_BYTES = 12
_PAD = 64
_ROLL = 32  # bytes that decide a hash value

SPANS = "array<struct<start:int,end:int,owner_id:{id_type}>>"


def gear_table(seed: int = 1) -> np.ndarray:
    """256 fixed pseudo-random 32-bit numbers."""
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 32, 256, dtype=np.uint32)


GEAR = gear_table()


def gear_hash(data: np.ndarray) -> np.ndarray:
    """``h[i] = sum(GEAR[data[i - k]] << k for k < 32)``, the rolling ``h = (h << 1) + GEAR[byte]``."""
    h = GEAR[data]
    width = 1
    while width < 32:
        h = h.copy()
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    return h


def _forward_max(h: np.ndarray, width: int) -> np.ndarray:
    """Largest of ``h[i : i + width]`` for each i (to the end at least 0)."""
    m, have = h, 1
    while have < width:
        step = min(have, width - have)
        m = np.maximum(m, np.append(m[step:], np.zeros(step, dtype=m.dtype)))
        have += step
    return m


def chunk_ends(texts: list[bytes], reach: int = REACH, max_chunk: int = MAX_CHUNK) -> list[list[int]]:
    """For each text the ends of its chunks, in order; the last one is its length."""
    gap = b"\0" * _PAD
    data = np.frombuffer(gap + gap.join(texts) + gap, dtype=np.uint8)
    h = gear_hash(data)
    h[:-1][(data[1:] & 0xC0) == 0x80] = 0  # no end inside a character
    ahead = _forward_max(h, reach)
    here, before = h[reach:-1], ahead[: len(h) - reach - 1]
    peak = here >= ahead[reach + 1 :]
    ends = np.flatnonzero(peak & (here > before)) + reach + 1
    tied = np.flatnonzero(peak & (here == before) & (here > 0)) + reach
    out, at = [], _PAD
    for text in texts:
        n = len(text)
        lo, hi = np.searchsorted(ends, [at + 1, at + n])
        found = [*(ends[lo:hi] - at).tolist(), n] if n else []
        lo, hi = np.searchsorted(tied, [at, at + n])
        if lo < hi:
            found = _each_period(found, data[at : at + n], h[at : at + n], tied[lo:hi] - at, reach)
        if n > max_chunk:
            found = _shortened(text, found, max_chunk)
        out.append(found)
        at += n + _PAD
    return out


def _stretch(data: np.ndarray, p: int, period: int, step: int = 256) -> tuple[int, int]:
    """The longest ``data[start:end]`` around ``data[p]`` that repeats with ``period``."""
    start, end, n = p - period + 1, p + 1, len(data)
    width = step
    while end < n:
        stop = min(end + width, n)
        other = np.flatnonzero(data[end:stop] != data[end - period : stop - period])
        if len(other):
            end += int(other[0])
            break
        end, width = stop, 2 * width
    width = step
    while start > 0:
        stop = max(start - width, 0)
        other = np.flatnonzero(data[stop:start] != data[stop + period : start + period])
        if len(other):
            start = stop + int(other[-1]) + 1
            break
        start, width = stop, 2 * width
    return start, end


def _each_period(ends: list[int], data: np.ndarray, h: np.ndarray, tied: np.ndarray, reach: int) -> list[int]:
    """``ends`` of one text with those of its periodic stretches, which hold the ``tied`` peaks.

    A stretch of ``_ROLL + 3 * reach`` bytes holds a tied peak whatever stands around it; shorter
    ones keep their ends.
    """
    had, n = np.array(ends), len(data)
    stays, more, k = np.ones(len(had), dtype=bool), [], 0
    while k < len(tied):
        p, past = int(tied[k]), int(tied[k]) + 1
        for period in range(1, min(reach, p) + 1):
            if h[p - period] != h[p]:
                continue
            start, end = _stretch(data, p, period)
            past = max(past, end)
            if end - start < _ROLL + 3 * reach:
                continue
            if period == 1:
                more += [start, end]
                break
            first = start + _ROLL - 1  # from here on the hash repeats too
            top = int(np.argmax(h[first : first + period])) + first + 1
            more += range(top - (top - start - 1) // period * period, end + 1, period)
            stays[np.searchsorted(had, start, "right") : np.searchsorted(had, end)] = False
            break
        k = int(np.searchsorted(tied, past))
    more = [x for x in more if 0 < x < n and data[x] & 0xC0 != 0x80]
    return np.union1d(had[stays], np.array(more, dtype=had.dtype)).tolist()


def _shortened(text: bytes, ends: list[int], max_chunk: int) -> list[int]:
    out, at = [], 0
    for end in ends:
        while end - at > max_chunk:
            at += max_chunk
            while text[at] & 0xC0 == 0x80:
                at -= 1
            out.append(at)
        out.append(end)
        at = end
    return out


def digests(text: bytes, ends: list[int]) -> list[bytes]:
    digest = xxhash.xxh3_128_digest
    chunks = (text[a:b] for a, b in zip([0, *ends], ends))
    return [digest(c[:1] if c[0] == c[-1] and c.count(c[:1]) == len(c) else c)[:DIGEST_BYTES] for c in chunks]


def whole_words(text: bytes, start: int, end: int) -> tuple[int, int]:
    """The stretch from the first word that begins to the last that ends in ``text[start:end]``."""
    if start and not text[start - 1 : start].isspace():
        while start < end and not text[start : start + 1].isspace():
            start += 1
        while start < end and text[start : start + 1].isspace():
            start += 1
    if end < len(text) and not text[end : end + 1].isspace():
        while end > start and not text[end - 1 : end].isspace():
            end -= 1
    return start, end


def characters(text: bytes, ends: list[int]) -> list[int]:
    """How many characters stand before each byte position (ends of words, so no character is cut)."""
    if not ends or text.isascii():
        return ends
    begins = np.cumsum(np.frombuffer(text, dtype=np.uint8) & 0xC0 != 0x80)
    return [int(begins[e - 1]) if e else 0 for e in ends]


def repeated_spans(text: bytes, ends: list[int], owners: list, min_run: int) -> list[tuple[int, int, object]]:
    """Byte spans of runs of repeated chunks; ``owners[k]`` is ``None`` for a chunk that stays, else ``(id,)``."""
    spans, k, n = [], 0, len(ends)
    while k < n:
        if owners[k] is None:
            k += 1
            continue
        first = k
        while k < n and owners[k] is not None:
            k += 1
        start, end = (ends[first - 1] if first else 0), ends[k - 1]
        if end - start >= min_run:
            a, b = whole_words(text, start, end)
            if b > a:
                spans.append((a, b, Counter(o[0] for o in owners[first:k]).most_common(1)[0][0]))
    return spans


def _once_each(block: int, ids: list, counts: list[int], raw: list[bytes], id_type: pa.DataType,
               rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Each digest of a block once, with the smallest id that has it and whether it stands there more than once."""
    rank = np.empty(len(ids), dtype=np.int64)
    order = sorted(range(len(ids)), key=lambda k: (ids[k] is None, ids[k]))
    rank[order] = np.arange(len(ids))
    of_rank = pa.array([ids[k] for k in order], id_type)
    whole = np.frombuffer(b"".join(raw), dtype=np.dtype([("a", "<u8"), ("b", "<u4")]))
    raw.clear()
    place = np.repeat(rank, counts)
    by = np.lexsort((place, whole["b"], whole["a"]))
    whole, place = whole[by], place[by]
    fresh = np.r_[True, whole[1:] != whole[:-1]] if len(whole) else np.zeros(0, dtype=bool)
    first = np.flatnonzero(fresh)
    twice = np.diff(np.r_[first, len(whole)]) > 1
    for k in range(0, len(first), rows):
        at = first[k : k + rows]
        owner = of_rank.take(pa.array(place[at]))
        digest = pa.Array.from_buffers(pa.binary(DIGEST_BYTES), len(at), [None, pa.py_buffer(whole[at].tobytes())]).cast(pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(at), block, dtype=np.int32)), digest, owner.is_null(), owner, pa.array(twice[k : k + rows])],
            names=["block", "digest", "none", "id", "twice"])


def repeats(docs: DataFrame, *, min_run: int = MIN_RUN, reach: int = REACH, max_chunk: int = MAX_CHUNK,
            block_bytes: int = BLOCK_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` as ``(row, n_chunks, n_repeated, spans, kept)``.

    ``row`` holds the row's own columns.  ``n_repeated`` counts chunks that stand earlier: in
    a document with a smaller id (nulls last, then by block), or earlier in the same one.
    ``spans`` are the character spans ``[start, end)`` of runs of such chunks of at least
    ``min_run`` bytes, shrunk to whole words, each with the id of the document that
    holds the first copy of most of its chunks.  ``kept`` is the text without the spans.

    Null text has no chunk and stays null; empty text stays empty.  Of equal rows one
    keeps the text.  Equal ids and extra columns of any name are allowed; no rows give no rows.
    """
    ship(docs.sparkSession)
    columns = docs.columns
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"),
                       F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))
    n_blocks = count_blocks(rows.agg(F.sum(F.octet_length("text"))).first()[0], block_bytes)
    id_field = rows.schema["id"].dataType
    id_type = id_field.simpleString()
    id_arrow = rows.select("id").limit(0).toArrow().schema.field("id").type
    block = block_of(n_blocks, "id", "text").alias("block")

    def chunked(column: pa.Array) -> Iterator[tuple[bytes, list[int]]]:
        for texts in pieces_of(column):
            yield from zip(texts, chunk_ends(texts, reach, max_chunk))

    def send(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        copies: Counter = Counter()
        for batch in parts:
            blocks, ids = batch.column("block").to_pylist(), batch.column("id").to_pylist()
            for block, i, (text, ends) in zip(blocks, ids, chunked(batch.column("text"))):
                # two copies of a row say what any number of them does
                copies[block, i, row := xxhash.xxh128_digest(text)] += 1
                if copies[block, i, row] > 2:
                    continue
                of_block = held.setdefault(block, [[], [], []])
                of_block[0].append(i)
                of_block[1].append(len(ends))
                of_block[2].append(b"".join(digests(text, ends)))
        for block in list(held):
            yield from _once_each(block, *held.pop(block), id_arrow)

    once = (rows.select(block, "id", "text").repartitionById(n_blocks, "block")
            .mapInArrow(send, f"block int, digest binary, none boolean, id {id_type}, twice boolean"))
    same = Window.partitionBy("digest")
    owner = F.min(F.struct("none", "id", "block")).over(same)
    shared = (once.select("block", "digest", owner.alias("owner"),
                          (F.max("twice").over(same) | (F.count("*").over(same) > 1)).alias("shared"))
              .where("shared").select("block", "digest", F.col("owner.id").alias("owner_id"), F.col("owner.block").alias("owner_block")))
    shared = stored(shared, "repeated-chunks")
    nothing = lambda kind: F.lit(None).cast(kind)
    met = (shared.select("block", F.lit(0).alias("kind"), "digest", "owner_id", "owner_block",
                         nothing(rows.schema["row"].dataType).alias("row"))
           .unionByName(rows.select(block, F.lit(1).alias("kind"), nothing("binary").alias("digest"),
                                    nothing(id_field).alias("owner_id"), nothing("int").alias("owner_block"), "row"))
           .repartitionById(n_blocks, "block")
           .sortWithinPartitions("kind", F.col("row").getField(id_col).asc_nulls_last(), F.xxhash64(F.col("row").getField(text_col))))
    spec = T.StructType([T.StructField("row", rows.schema["row"].dataType)]
                        + list(T._parse_datatype_string(f"n_chunks int, n_repeated int, spans {SPANS.format(id_type=id_type)}, kept binary")))
    span_arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("owner_id", id_arrow)]))

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[int, bytes], tuple] = {}
        met_first: set[tuple[int, bytes]] = set()
        for batch in parts:
            kinds = batch.column("kind").to_numpy(zero_copy_only=False)
            firsts = int((kinds == 0).sum())  # sorted: digests come before texts
            if firsts:
                head = batch.slice(0, firsts)
                known.update(zip(zip(head.column("block").to_pylist(), head.column("digest").to_pylist()),
                                 zip(head.column("owner_id").to_pylist(), head.column("owner_block").to_pylist())))
            if firsts == batch.num_rows:
                continue
            rest = batch.slice(firsts)
            n_chunks, n_repeated, all_spans, kept = [], [], [], []
            own_ids = pc.struct_field(rest.column("row"), id_col).to_pylist()
            own_texts = pc.fill_null(pc.struct_field(rest.column("row"), text_col).cast(pa.binary()), b"")
            for block, i, (text, ends) in zip(rest.column("block").to_pylist(), own_ids, chunked(own_texts)):
                owners: list = []
                for d in digests(text, ends):
                    key = (block, d)
                    own = known.get(key)
                    if own is None:
                        owners.append(None)
                    elif own == (i, block) and key not in met_first:
                        met_first.add(key)
                        owners.append(None)
                    else:
                        owners.append((own[0],))
                spans = repeated_spans(text, ends, owners, min_run)
                n_chunks.append(len(ends))
                n_repeated.append(len(owners) - owners.count(None))
                at = characters(text, [x for a, b, _ in spans for x in (a, b)])
                all_spans.append([{"start": a, "end": b, "owner_id": o} for a, b, (_, _, o) in zip(at[::2], at[1::2], spans)])
                stays = [0, *(x for a, b, _ in spans for x in (a, b)), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(stays[::2], stays[1::2])))
            yield pa.RecordBatch.from_arrays(
                [rest.column("row"), pa.array(n_chunks, pa.int32()), pa.array(n_repeated, pa.int32()),
                 pa.array(all_spans, span_arrow), pa.array(kept, pa.binary())],
                names=["row", "n_chunks", "n_repeated", "spans", "kept"])

    return met.mapInArrow(cut, spec)


def repeated_passages(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """One row per repeated span: ``doc_id, owner_id, start, end, n_chars``; documents without one have no row."""
    found = repeats(docs.select(id_col, options.get("text_col", "text")), id_col=id_col, **options)
    return (found.select(F.col(f"row.`{id_col}`").alias("doc_id"), F.explode("spans").alias("s"))
            .select("doc_id", "s.owner_id", "s.start", "s.end", (F.col("s.end") - F.col("s.start")).alias("n_chars")))


def cut_repeats(docs: DataFrame, *, text_col: str = "text", length_col: str | None = None, **options) -> DataFrame:
    """``docs`` with repeated spans cut out of the text; ``length_col``, if named, gets the new length.

    A row whose text had words and of which nothing but white space is left goes; every other row stays.
    """
    found = repeats(docs, text_col=text_col, **options).select("row", "spans", F.col("kept").cast("string").alias("kept"))
    found = found.where((F.size("spans") == 0) | (F.length(F.trim(F.regexp_replace("kept", r"\s+", " "))) > 0))
    cut = F.size("spans") > 0
    out = []
    for c in docs.columns:
        own = F.col(f"row.`{c}`")
        if c == text_col:
            own = F.when(cut, F.col("kept")).otherwise(own)
        elif c == length_col:
            own = F.when(cut, F.length("kept").cast(docs.schema[c].dataType)).otherwise(own)
        out.append(own.alias(c))
    return found.select(*out)
