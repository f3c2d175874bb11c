"""Packing: all documents' tokens joined end to end and cut into fixed windows."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import ship
from .token_ids import END_ID, tokenised, with_start

WINDOW = 2048
PIECES = ("doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, sequence_length long, padded_length long, ids binary")


def power_of_two(n: int) -> bool:
    return n > 0 and n & (n - 1) == 0


def pack(docs: DataFrame, vocabulary_path: str, *, window: int = WINDOW, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Concatenate and cut: one row per piece (the part of one document in one sequence).

    Pass one tokenises every document and writes the ids with their position inside their
    task.  The tasks' totals, summed up in task order, give every document's global start.
    Pass two cuts at multiples of ``window``: a piece lies in sequence ``start // window``
    at ``start % window``.  Each sequence but the last is full; the last one is padded to
    ``window`` unless its length is a power of two (``padded_length``).  ``ids`` holds
    the piece's ids as little-endian unsigned 32-bit integers.

    Null or empty text is one end id.  Equal rows and equal ids are packed each on its
    own; null ids are kept.  No documents give no rows.  Only ``id_col`` and ``text_col``
    are read, so other columns cannot clash.
    """
    ship(docs.sparkSession)
    tokens = tokenised(docs, vocabulary_path, id_col=id_col, text_col=text_col, end_id=end_id)
    placed = with_start(tokens).select("doc_id", "start", "ids")
    total = tokens.agg({"n_tokens": "sum"}).first()[0] or 0
    id_type = placed.schema["doc_id"].dataType.simpleString()
    spec = PIECES.format(id_type=id_type)
    names = [x.split()[0] for x in spec.split(", ")]

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            doc, columns = [], [[] for _ in names[1:]]
            for i, (start, ids) in enumerate(zip(batch.column("start").to_pylist(), batch.column("ids").to_pylist())):
                n, at = len(ids) // 4, 0
                while at < n:
                    sequence, offset = divmod(start + at, window)
                    length = min(window - offset, n - at)
                    full = min(window, total - sequence * window)
                    piece = ids[4 * at : 4 * (at + length)]
                    doc.append(i)
                    row = (at, length, zlib.crc32(piece), n, sequence, offset, full,
                           full if power_of_two(full) else window, piece)
                    for c, v in zip(columns, row):
                        c.append(v)
                    at += length
            types = [pa.int64()] * (len(columns) - 1) + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(doc, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, types))],
                names=names)

    return placed.mapInArrow(cut, spec)
