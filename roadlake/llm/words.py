"""Numbers for the words of texts, a whole batch at a time.

Splitting, comparing and looking up words one by one costs a few cache misses each in a
Python dictionary.  Here a batch of texts stays one byte string: words are offsets into
it, words of up to 16 bytes are compared as two 64-bit integers and their length, and the
table of known words is a numpy hash table whose probes are vectorised.  Longer words go
through a dictionary.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PAD = b" " * 16
_MASK = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def spans(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The texts joined, the words' starts and ends in that, and each text's number of words.

    Words are what ``bytes.split`` gives: runs without the six ASCII white-space bytes.
    """
    joined = b" ".join(texts) + _PAD
    data = np.frombuffer(joined, dtype=np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if not space[0]:
        edge = np.r_[0, edge]
    starts, ends = edge[0::2], edge[1::2]
    limits = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, dtype=np.int64)
    upto = np.searchsorted(starts, limits)
    return joined, starts, ends, np.diff(upto, prepend=0)


class WordNumbers:
    """Words numbered from 0 in the order in which they were met."""

    def __init__(self, slots: int = 1 << 16):
        self.count = 0
        self.table = np.full(slots, -1, dtype=np.int32)
        self.keys = np.zeros((1024, 2), dtype=np.uint64)
        self.sizes = np.zeros(1024, dtype=np.uint8)  # 0: a long word
        self.long: dict[bytes, int] = {}

    def _keys(self, data: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        windows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(data, dtype=np.uint8), 16)
        keys = windows[starts].view("<u8")
        keys[:, 0] &= _MASK[np.minimum(sizes, 8)]
        keys[:, 1] &= _MASK[np.maximum(sizes, 8) - 8]
        return keys

    def _slots(self, keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        h = (keys[:, 0] ^ (keys[:, 1] * _B) ^ (sizes.astype(np.uint64) * _C)) * _A
        h ^= h >> np.uint64(29)
        return (h * _B >> np.uint64(64 - (len(self.table).bit_length() - 1))).astype(np.int64)

    def _find(self, keys: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, dtype=np.int64)
        slot = self._slots(keys, sizes)
        open_ = np.arange(len(keys))
        while len(open_):
            got = self.table[slot]
            there = got >= 0
            open_, slot, got = open_[there], slot[there], got[there]
            same = (self.keys[got] == keys[open_]).all(axis=1) & (self.sizes[got] == sizes[open_])
            out[open_[same]] = got[same]
            open_, slot = open_[~same], (slot[~same] + 1) & (len(self.table) - 1)
        return out

    def _place(self, numbers: np.ndarray) -> None:
        slot = self._slots(self.keys[numbers], self.sizes[numbers])
        while len(numbers):
            _, first = np.unique(slot, return_index=True)
            first = first[self.table[slot[first]] < 0]
            self.table[slot[first]] = numbers[first]
            rest = np.ones(len(numbers), dtype=bool)
            rest[first] = False
            numbers, slot = numbers[rest], (slot[rest] + 1) & (len(self.table) - 1)

    def _add(self, words: list[bytes]) -> None:
        """Number new, distinct words."""
        need = self.count + len(words)
        if need > len(self.sizes):
            grown = max(need, 3 * len(self.sizes) // 2)
            self.keys = np.concatenate([self.keys, np.zeros((grown - len(self.keys), 2), dtype=np.uint64)])
            self.sizes = np.concatenate([self.sizes, np.zeros(grown - len(self.sizes), dtype=np.uint8)])
        numbers = np.arange(self.count, need)
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        short = sizes <= 16
        ends = np.cumsum(sizes)
        self.keys[numbers] = self._keys(b"".join(words) + _PAD, ends - sizes, np.minimum(sizes, 16))
        self.sizes[numbers] = np.where(short, sizes, 0)
        self.long.update((words[k], self.count + k) for k in np.flatnonzero(~short).tolist())
        self.count = need
        if 2 * need > len(self.table):
            slots = len(self.table)
            while 2 * need > slots:
                slots *= 2
            self.table = np.full(slots, -1, dtype=np.int32)
            numbers = np.arange(need)
        self._place(numbers[self.sizes[numbers] > 0])

    def numbers(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
        """The number of every word, and the words met for the first time, in the order of their numbers."""
        sizes = ends - starts
        out = np.full(len(starts), -1, dtype=np.int64)
        short = sizes <= 16
        at = np.flatnonzero(short)
        keys, small = self._keys(data, starts[at], sizes[at]), sizes[at].astype(np.uint8)
        out[at] = self._find(keys, small)
        over = np.flatnonzero(~short)
        long = [data[a:b] for a, b in zip(starts[over].tolist(), ends[over].tolist())]
        get = self.long.get
        out[over] = np.fromiter((get(w, -1) for w in long), dtype=np.int64, count=len(long))
        lacking = np.flatnonzero(out[at] < 0)
        new = dict.fromkeys(data[a:b] for a, b in zip(starts[at[lacking]].tolist(), ends[at[lacking]].tolist()))
        new.update(dict.fromkeys(w for w in long if w not in self.long))
        words = list(new)
        if words:
            self._add(words)
            out[at[lacking]] = self._find(keys[lacking], small[lacking])
            out[over] = np.fromiter(map(self.long.__getitem__, long), dtype=np.int64, count=len(long))
        return out, words


class Growing:
    """An array that values are appended to."""

    def __init__(self, dtype):
        self.values, self.count = np.zeros(1024, dtype=dtype), 0

    def extend(self, more: np.ndarray) -> None:
        need = self.count + len(more)
        if need > len(self.values):
            self.values = np.concatenate([self.values, np.zeros(max(need, 3 * len(self.values) // 2) - len(self.values), dtype=self.values.dtype)])
        self.values[self.count : need] = more
        self.count = need


class IdPool:
    """Ids of words, as little-endian unsigned 32-bit integers; keeps those of the words it has met.

    ``learn`` gives the ids of a list of new words.  Beyond ``cap`` words it starts anew.
    """

    def __init__(self, learn: Callable[[list[bytes]], list[bytes]], cap: int):
        self.learn, self.cap = learn, cap
        self.clear()

    def clear(self) -> None:
        self.known = WordNumbers()
        self.ids, self.begins, self.sizes = Growing(np.dtype("<u4")), Growing(np.int32), Growing(np.int32)

    def numbers(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        numbers, new = self.known.numbers(data, starts, ends)
        if new:
            ids = self.learn(new)
            size = np.array([len(x) for x in ids], dtype=np.int64) // 4
            self.begins.extend(self.ids.count + np.cumsum(size) - size)
            self.sizes.extend(size)
            self.ids.extend(np.frombuffer(b"".join(ids), "<u4"))
        return numbers

    def joined(self, numbers: np.ndarray, n_words: np.ndarray) -> list[bytes]:
        """The ids of the first ``n_words[0]`` words one after the other, then of the next, and so on."""
        size = self.sizes.values[numbers]
        upto = np.cumsum(size, dtype=np.int64)
        at = np.repeat(self.begins.values[numbers] - upto + size, size)
        at += np.arange(len(at))
        flat = self.ids.values[at].tobytes()
        cut = (np.r_[0, upto][np.cumsum(n_words)] * 4).tolist()
        return [flat[a:b] for a, b in zip([0, *cut[:-1]], cut)]
