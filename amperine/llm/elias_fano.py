"""Elias-Fano sequences and an n-gram trie of them in one memory-mapped file, searched with numpy."""

from __future__ import annotations

import mmap
import tempfile

import numpy as np

_WORD = 64
_MOST_LOW = 56


def encode(values: np.ndarray) -> list[np.ndarray]:
    """Parts of the Elias-Fano form of non-decreasing unsigned integers.

    n values below u take floor(log2(u / n)) low bits each as they are, and about two bits each
    for the rest, in unary; a count of set bits every 64 bits makes the unary part searchable.
    """
    values = values.astype(np.uint64)
    n = len(values)
    low = 0 if not n else min(_MOST_LOW, max(0, (int(values[-1]) + 1) // n).bit_length() - 1)
    low = max(low, 0)
    high = (values >> np.uint64(low)).astype(np.int64)
    bits = np.zeros(-(-(n + (int(high[-1]) if n else 0) + 1) // _WORD) * _WORD, bool)
    bits[high + np.arange(n)] = True
    upper = np.packbits(bits, bitorder="little")
    before = np.concatenate([[0], np.cumsum(bits.reshape(-1, _WORD).sum(1))]).astype(np.int64)
    if low:
        spread = (values[:, None] >> np.arange(low, dtype=np.uint64) & np.uint64(1)).astype(np.uint8)
        lower = np.packbits(spread.ravel(), bitorder="little")
    else:
        lower = np.zeros(0, np.uint8)
    return [np.array([n, low]), upper, before, np.concatenate([lower, np.zeros(8, np.uint8)])]


class Sequence:
    """Reads the parts of `encode`; every method takes and returns arrays."""

    def __init__(self, parts: list[np.ndarray]):
        (self.n, self.low), upper, self.before, lower = (int(x) for x in parts[0]), *parts[1:]
        self.upper = upper.view("<u8")
        self.lower = np.ndarray(max(0, len(lower) - 7), "<u8", lower, strides=(1,))
        self.before_zeros = np.arange(len(self.before)) * _WORD - self.before
        self.zeros = int(self.before_zeros[-1])

    def _select(self, k: np.ndarray, before: np.ndarray, flip: int) -> np.ndarray:
        """Place of the k-th set bit of the unary part, or with flip = -1 of the k-th unset one."""
        at = np.searchsorted(before, k, "right") - 1
        left = (k - before[at]).astype(np.uint8)
        word = self.upper[at] ^ np.uint64(flip & 0xFFFFFFFFFFFFFFFF)
        at = at * _WORD
        for half in (32, 16, 8, 4, 2, 1):
            ones = np.bitwise_count(word & np.uint64((1 << half) - 1))
            beyond = left >= ones
            left = left - ones * beyond
            word = word >> (np.uint64(half) * beyond)
            at = at + half * beyond
        return at

    def _low(self, i: np.ndarray) -> np.ndarray:
        at = i * self.low
        return (self.lower[at >> 3] >> (at & 7).astype(np.uint64)) & np.uint64((1 << self.low) - 1)

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        if not len(i):
            return np.zeros(0, np.uint64)
        high = (self._select(i, self.before, 0) - i).astype(np.uint64)
        return high << np.uint64(self.low) | self._low(i)

    def successor(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first element >= value, and whether it is equal to it."""
        if not len(value) or not self.n:
            return np.zeros(len(value), np.int64), np.zeros(len(value), bool)
        high = np.minimum(value >> np.uint64(self.low), np.uint64(self.zeros)).astype(np.int64)
        target = value & np.uint64((1 << self.low) - 1)
        # elements with these upper bits lie between two unset bits of the unary part
        start = np.where(high > 0, self._bucket(np.maximum(high - 1, 0)), 0)
        stop = self._bucket(high)
        end = stop.copy()
        while (start < stop).any():
            middle = (start + stop) >> 1
            less = (start < stop) & (self._low(np.minimum(middle, self.n - 1)) < target)
            start, stop = np.where(less, middle + 1, start), np.where(less, stop, middle)
            stop = np.maximum(start, stop)
        inside = start < end
        return start, inside & (self._low(np.minimum(start, self.n - 1)) == target)

    def _bucket(self, high: np.ndarray) -> np.ndarray:
        """Number of elements with upper bits of at most `high`."""
        known = high < self.zeros
        place = self._select(np.where(known, high, 0), self.before_zeros, -1)
        return np.minimum(np.where(known, place - high, self.n), self.n)


class Mapped:
    """Named arrays in one file that is mapped into memory and has no name on disk."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.places: dict[str, tuple[int, np.ndarray]] = {}
        with tempfile.TemporaryFile() as file:
            at = 0
            for name, array in arrays.items():
                data = np.ascontiguousarray(array)
                self.places[name] = (at, np.empty(0, data.dtype)), len(data)
                raw = data.tobytes()
                file.write(raw + bytes(-len(raw) % 8))
                at += len(raw) + -len(raw) % 8
            file.write(bytes(8))
            file.flush()
            self.size = at
            self.memory = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)

    def __getitem__(self, name: str) -> np.ndarray:
        (at, kind), n = self.places[name]
        return np.frombuffer(self.memory, kind.dtype, n, at)


class Trie:
    """Three levels of word ids with pointers, and values by node.

    A level holds the children of all nodes above, in order. Within a node's children ids rise;
    each is stored on a base of one more than the last stored value before the node's first child,
    so the level is one rising sequence, and a child is found by the successor of its id on that base.
    """

    LEVELS = ("one", "two", "three", "to_two", "to_three")

    def __init__(self, one: np.ndarray, two: np.ndarray, three: np.ndarray, two_of: np.ndarray, three_of: np.ndarray,
                 values: dict[str, np.ndarray]):
        """one: ids; two, three: ids under the nodes two_of, three_of of the level above."""
        arrays = dict(values)
        starts_two = np.searchsorted(two_of, np.arange(len(one) + 1))
        starts_three = np.searchsorted(three_of, np.arange(len(two) + 1))
        for name, values_ in (
            ("one", one), ("two", _raised(two, starts_two)), ("three", _raised(three, starts_three)),
            ("to_two", starts_two), ("to_three", starts_three),
        ):
            for k, part in enumerate(encode(values_)):
                arrays[f"{name}.{k}"] = part
        self.mapped = Mapped(arrays)
        self.level = {name: Sequence([self.mapped[f"{name}.{k}"] for k in range(4)]) for name in self.LEVELS}

    def word(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.level["one"].successor(ids.astype(np.uint64))

    def child(self, level: str, parent: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in `level` ("two" or "three") of the parent's child with that id, and whether there is one."""
        pointers, children = self.level[f"to_{level}"], self.level[level]
        start, stop = pointers[parent].astype(np.int64), pointers[parent + 1].astype(np.int64)
        base = np.zeros(len(parent), np.uint64)
        later = start > 0
        base[later] = children[start[later] - 1] + np.uint64(1)
        place, equal = children.successor(base + ids.astype(np.uint64))
        return place, equal & (place >= start) & (place < stop)

    def __getitem__(self, name: str) -> np.ndarray:
        return self.mapped[name]


def _raised(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """ids plus, for each range, one more than the last raised value of the range before."""
    if not len(ids):
        return ids.astype(np.uint64)
    ends = starts[1:][np.diff(starts) > 0]
    last = ids[ends - 1].astype(np.uint64)
    base = np.concatenate([[0], np.cumsum(last + np.uint64(1))[:-1]]).astype(np.uint64)
    return ids.astype(np.uint64) + np.repeat(base, np.diff(np.concatenate([[0], ends])))
