"""The vectorised word table against bytes.split and a dictionary."""

import random

import numpy as np
import pytest

from roadlake.llm.words import Growing, WordNumbers, spans


def texts(seed, n=60):
    rng = random.Random(seed)
    alphabet = [bytes([b]) for b in (*range(9, 14), 32, 32, 32, 0, 1, 97, 98, 99, 195, 169, 255)]
    out = [b"".join(rng.choices(alphabet, k=rng.randint(0, 80))) for _ in range(n)]
    return out + [b"", b" ", b"x" * 16, b"x" * 17, b"x" * 16 + b"\0", b"a\0", b"a", b"\0", b" lead", b"trail\n", b"y" * 500]


@pytest.mark.parametrize("seed", range(4))
def test_words_are_those_of_split(seed):
    batch = texts(seed)
    data, starts, ends, n_words = spans(batch)
    assert [data[a:b] for a, b in zip(starts, ends)] == [w for t in batch for w in t.split()]
    assert n_words.tolist() == [len(t.split()) for t in batch]
    assert [len(x) for x in spans([])[1:]] == [0, 0, 0]


def test_numbers():
    table, known, words = WordNumbers(slots=4), {}, []
    for seed in range(6):
        batch = texts(seed) + [f"word{k}".encode() for k in range(seed * 400, seed * 400 + 900)]
        data, starts, ends, _ = spans(batch)
        numbers, new = table.numbers(data, starts, ends)
        words += new
        assert not set(new) & set(known)
        known |= {w: len(known) + k for k, w in enumerate(new)}
        flat = [w for t in batch for w in t.split()]
        assert numbers.tolist() == [known[w] for w in flat] and [words[n] for n in numbers] == flat
    assert table.count == len(words) == len(set(words))


def test_growing():
    g = Growing(np.int64)
    for k in range(0, 5000, 700):
        g.extend(np.arange(k, k + 700))
    assert g.values[: g.count].tolist() == list(range(g.count))
