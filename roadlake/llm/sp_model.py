"""Reading a SentencePiece model file: the protobuf fields that encoding needs.

The file is a protobuf message; fields are read by their public numbers, and fields that are
absent have the public defaults.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass

# FIXED VALUES: kinds of pieces and of models in the file format
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass(frozen=True)
class Model:
    pieces: list[tuple[str, float, int]]  # text, score, kind
    model_type: int
    byte_fallback: bool
    unk_id: int
    charsmap: bytes
    add_dummy_prefix: bool
    remove_extra_whitespaces: bool
    escape_whitespaces: bool


def fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """``(number, value)`` of each field: varints as int, the others as their bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 0x7F) << shift
            shift += 7
            if b < 0x80:
                return value

    while at < len(raw):
        key = varint()
        number, kind = key >> 3, key & 7
        if kind == 0:
            yield number, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield number, raw[at : at + size]
        at += size


def parse_model(raw: bytes) -> Model:
    pieces: list[tuple[str, float, int]] = []
    trainer: dict[int, int | bytes] = {}
    normaliser: dict[int, int | bytes] = {}
    for number, value in fields(raw):
        if number == 1:
            piece = dict(fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            pieces.append((piece.get(1, b"").decode("utf-8"), score, piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(fields(value))
        elif number == 3:
            normaliser = dict(fields(value))
    unknown = [k for k, p in enumerate(pieces) if p[2] == UNKNOWN]
    return Model(pieces, trainer.get(3, UNIGRAM), bool(trainer.get(35, 0)), unknown[0] if unknown else 0,
                 normaliser.get(2, b""), bool(normaliser.get(3, 1)), bool(normaliser.get(4, 1)), bool(normaliser.get(5, 1)))


def read_model(path: str) -> Model:
    if os.path.getsize(path) > 64 << 20:
        raise ValueError(f"{path} is too large to send to every task")
    with open(path, "rb") as f:
        return parse_model(f.read())
