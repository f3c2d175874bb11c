"""Token ids as a binary file: canonical length-limited Huffman code in independent blocks.

File format: a folder with two Parquet tables.

``code``    one row: ``lengths`` (binary, one unsigned byte per id, 0: the id does not
            occur), ``limit`` (the longest allowed code) and ``total`` (ids in the file).
            Codes are canonical: ascending by (length, id), first code 0.
``blocks``  one row per block of whole documents: ``start`` (ids before it, which orders
            the blocks), ``doc_ids``, ``starts``, ``counts`` (arrays, one entry per
            document), ``n_tokens``, ``payload`` (the bits, first bit highest, zero-filled
            to whole bytes) and ``checkpoints`` (bit offsets of every ``EVERY``-th id).

A block decodes alone, and every checkpoint in it does; a document longer than a block
has a block to itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import drop, scratch, ship, text_bytes
from .token_ids import END_ID, tokenised, with_start

#: Code lengths: the least limit (more ids than 2**LIMIT raise it) and what the decoder's 32-bit window can take.
LIMIT, MOST_BITS = 18, 25
PART_BYTES = 24 << 20
BLOCK_TOKENS = 1 << 17
EVERY = 128
CODE = "lengths binary, limit int, total long"
BLOCKS = ("start long, doc_ids array<{id_type}>, starts array<long>, counts array<long>, "
          "n_tokens long, payload binary, checkpoints binary")


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal code lengths of at most ``limit`` bits by package-merge.

    ``counts`` has one entry per symbol; symbols with count 0 get length 0.  Weights are
    merged pairwise ``limit - 1`` times; a symbol's length is the number of lists in which it
    stands among the cheapest ``2 * (n - 1)`` items.
    """
    lengths = np.zeros(len(counts), dtype=np.uint8)
    used = np.flatnonzero(counts)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError("more symbols than codes of the allowed length")
    order = used[np.lexsort((used, counts[used]))]
    leaf = counts[order].astype(np.int64)
    n = len(leaf)
    levels = []  # for each list: whether the items, cheapest first, are leaves
    weights, is_leaf = leaf, np.ones(n, dtype=bool)
    for _ in range(limit - 1):
        levels.append(is_leaf)
        paired = weights[: len(weights) // 2 * 2].reshape(-1, 2).sum(axis=1)
        joined = np.concatenate([leaf, paired])
        rank = np.argsort(joined, kind="stable")
        weights, is_leaf = joined[rank], rank < n
    levels.append(is_leaf)
    take, depth = 2 * (n - 1), np.zeros(n, dtype=np.int64)
    for is_leaf in reversed(levels):
        leaves = int(is_leaf[:take].sum())
        depth[:leaves] += 1
        take = 2 * (take - leaves)
    lengths[order] = depth
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The code of each symbol, ascending by (length, symbol)."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    code = last = 0
    for s in np.lexsort((np.arange(len(lengths)), lengths)):
        if n := int(lengths[s]):
            code <<= n - last
            codes[s], last = code, n
            code += 1
    return codes


def decode_table(lengths: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Symbol and length for every ``limit``-bit prefix."""
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    spans = np.int64(1) << (limit - lengths[order].astype(np.int64))
    symbols = np.zeros(1 << limit, dtype=np.uint32)
    sizes = np.ones(1 << limit, dtype=np.uint8)
    filled = int(spans.sum())
    symbols[:filled] = np.repeat(order, spans)
    sizes[:filled] = np.repeat(lengths[order], spans)
    return symbols, sizes


def encode_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray, every: int = EVERY) -> tuple[bytes, np.ndarray]:
    """The bits of ``ids`` and the bit offset of every ``every``-th one."""
    ids = ids.astype(np.intp, copy=False)
    size = lengths[ids]
    ends = np.cumsum(size, dtype=np.int64)
    starts = ends - size
    words = np.zeros((int(ends[-1]) + 63) // 64 + 1 if len(ids) else 1, dtype=np.uint64)
    # codes at the top of a word; a zero length shifts by less than a word and is never used
    top = (codes << (np.uint64(64) - np.maximum(lengths, 1).astype(np.uint64)))[ids]
    at, inside = starts >> 6, (starts & 63).astype(np.uint64)
    if len(ids):
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        words[at[first]] = np.bitwise_or.reduceat(top >> inside, first)
        over = np.flatnonzero(inside + size > 64)  # at most one code leaves each word
        words[at[over] + 1] |= top[over] << (np.uint64(64) - inside[over])
    used = (int(ends[-1]) + 7) // 8 if len(ids) else 0
    return words.astype(">u8").tobytes()[:used], starts[::every].copy()


def decode_bits(payload: bytes, n: int, checkpoints: np.ndarray, symbols: np.ndarray, sizes: np.ndarray,
                limit: int, every: int = EVERY) -> np.ndarray:
    """All ``n`` ids; the stretches between checkpoints are decoded side by side."""
    data = np.frombuffer(payload + b"\0" * 8, dtype=np.uint8)
    # 32 bits from each byte on
    wide = ((data[:-3].astype(np.uint32) << 24) | (data[1:-2].astype(np.uint32) << 16)
            | (data[2:-1].astype(np.uint32) << 8) | data[3:])
    lanes = len(checkpoints)
    out = np.zeros((every, lanes), dtype=np.uint32)
    at = checkpoints.astype(np.int64)
    last = n - (lanes - 1) * every if lanes else 0
    shift = np.uint32(32 - limit)
    mask = (1 << limit) - 1
    for k in range(min(every, n)):
        live = lanes if k < last else lanes - 1
        pos = at[:live]
        key = ((wide[pos >> 3] << (pos & 7).astype(np.uint32)) >> shift) & mask
        out[k, :live] = symbols[key]
        at[:live] += sizes[key]
    return out.T.reshape(-1)[:n]


def token_counts(tokens: DataFrame) -> np.ndarray:
    """How often each id occurs in all rows: the counts that each task of ``tokenised`` wrote, summed by task and then by Spark."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(0, dtype=np.int64)
        for batch in parts:
            for held in batch.column("used"):
                ids, n = np.frombuffer(held.as_py(), "<i8").reshape(2, -1)
                if ids[-1] >= len(seen):
                    seen = np.pad(seen, (0, int(ids[-1]) + 1 - len(seen)))
                seen[ids] += n
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(seen[used])], names=["id", "n"])

    # at most one row per id of the vocabulary reaches the driver
    used = tokens.where(F.col("used").isNotNull()).select("used")
    rows = used.mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    ids, n = rows.column("id").to_numpy(), rows.column("n").to_numpy()
    out = np.zeros(int(ids.max()) + 1 if len(ids) else 0, dtype=np.int64)
    out[ids] = n
    return out


def write_ids(docs: DataFrame, path: str, vocabulary_path: str, *, parts: int | None = None, limit: int = LIMIT,
              block_tokens: int = BLOCK_TOKENS, every: int = EVERY, end_id: int = END_ID,
              id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the ids of every document to ``path`` in ascending ``id_col`` order.

    Null or empty text is one end id.  Equal ids are ordered by a hash of their text, null
    ids come first; every row is written.  Codes take ``limit`` bits at most, or as many as
    the number of used ids needs (2**25 ids are the most).  Without rows the folder has a code table of
    length 0 and no block.  Only ``id_col`` and ``text_col`` are read.
    """
    spark = docs.sparkSession
    ship(spark)
    if parts is None:
        held = docs.agg(F.sum(F.octet_length(text_bytes(text_col)))).first()[0] or 0
        parts = max(spark.sparkContext.defaultParallelism, -(-held // PART_BYTES))
    tokens = tokenised(docs, vocabulary_path, id_col=id_col, text_col=text_col, end_id=end_id, ordered=parts, counted=True)
    counts = token_counts(tokens)
    limit = max(limit, (int(np.count_nonzero(counts)) - 1).bit_length())
    if limit > MOST_BITS:
        raise ValueError(f"more than 2**{MOST_BITS} different ids")
    lengths = code_lengths(counts, limit)
    spark.createDataFrame([(bytearray(lengths.tobytes()), limit, int(counts.sum()))], CODE).coalesce(1).write.parquet(f"{path}/code")
    placed = with_start(tokens.where(F.col("used").isNull())).select("doc_id", "start", "n_tokens", "ids")
    shared = spark.sparkContext.broadcast((canonical(lengths), lengths))
    spec = BLOCKS.format(id_type=placed.schema["doc_id"].dataType.simpleString())
    id_arrow = placed.limit(0).toArrow().schema.field("doc_id").type
    schema = pa.schema([("start", pa.int64()), ("doc_ids", pa.list_(id_arrow)),
                        ("starts", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("n_tokens", pa.int64()),
                        ("payload", pa.binary()), ("checkpoints", pa.binary())])

    def blocks(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, sizes = shared.value
        held, size = [], 0

        def close() -> pa.RecordBatch:
            docs_, starts, counts_, ids = zip(*held)
            payload, offsets = encode_bits(np.frombuffer(b"".join(ids), "<u4"), codes, sizes, every)
            row = (starts[0], docs_, starts, counts_, size, payload, offsets.astype("<i8").tobytes())
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in rows:
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "start", "n_tokens", "ids"))):
                if held and (size + row[2] > block_tokens or row[1] != held[-1][1] + held[-1][2]):
                    yield close()
                    held, size = [], 0
                held.append(row)
                size += row[2]
        if held:
            yield close()

    placed.mapInArrow(blocks, spec).write.parquet(f"{path}/blocks")
    drop(tokens)


def read_ids(spark: SparkSession, path: str, every: int = EVERY) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of every document in the files at ``path``."""
    ship(spark)
    code = spark.read.parquet(f"{path}/code").first()
    lengths, limit = np.frombuffer(bytes(code["lengths"]), dtype=np.uint8), code["limit"]
    shared = spark.sparkContext.broadcast(lengths)  # one byte per id of the vocabulary
    rows = spark.read.parquet(f"{path}/blocks").select("doc_ids", "starts", "counts", "n_tokens", "payload", "checkpoints")
    id_type = rows.schema["doc_ids"].dataType.elementType.simpleString()

    def decode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, sizes = decode_table(shared.value, limit)
        for batch in parts:
            for k in range(batch.num_rows):
                n = batch.column("n_tokens")[k].as_py()
                offsets = np.frombuffer(batch.column("checkpoints")[k].as_py(), "<i8")
                raw = decode_bits(batch.column("payload")[k].as_py(), n, offsets, symbols, sizes, limit, every).astype("<u4").tobytes()
                docs, starts, counts = (batch.column(c)[k].values for c in ("doc_ids", "starts", "counts"))
                ends = np.cumsum(counts.to_numpy()) * 4
                ids = [raw[b - 4 * c : b] for b, c in zip(ends.tolist(), counts.to_pylist())]
                yield pa.RecordBatch.from_arrays([docs, starts, counts, pa.array(ids, pa.binary())],
                                                 names=["doc_id", "start", "n_tokens", "ids"])

    return rows.mapInArrow(decode, f"doc_id {id_type}, start long, n_tokens long, ids binary")


def id_digests(docs: DataFrame, vocabulary_path: str, **options) -> DataFrame:
    """Write the documents' ids, read them back, and return each document's digest."""
    spark = docs.sparkSession
    path = scratch(spark, "token-file")
    write_ids(docs, path, vocabulary_path, **options)
    return read_ids(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
