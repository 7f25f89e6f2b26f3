"""Elias-Fano coding of monotone sequences, read in place from mapped bytes, many places at once.

A value's low bits are packed at a fixed width; its high bits are a unary bit string in which
the i-th one stands at ``high + i``.  A count of ones per 64-bit word makes selection a search.
"""

from __future__ import annotations

import numpy as np

_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)
# _SELECT[b, k]: place of the k-th one (from 0) in byte b.
_SELECT = np.zeros((256, 8), np.uint8)
for _byte in range(256):
    for _k, _bit in enumerate([i for i in range(8) if _byte >> i & 1]):
        _SELECT[_byte, _k] = _bit


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Values of ``width`` bits one behind the other, with eight bytes to spare at the end."""
    if not width:
        return np.zeros(8, np.uint8)
    out = []
    for part in np.array_split(values.astype(np.uint64), max(1, len(values) // 65536)) if len(values) else []:
        bits = (part[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
        out.append(bits.astype(np.uint8).ravel())
    bits = np.concatenate(out) if out else np.zeros(0, np.uint8)
    return np.concatenate((np.packbits(bits, bitorder="little"), np.zeros(8, np.uint8)))


def encode(values: np.ndarray) -> dict[str, np.ndarray]:
    """Arrays that ``Sequence`` reads; ``values`` never descend and are not negative."""
    n = len(values)
    top = int(values[-1]) if n else 0
    width = max(0, (top // max(n, 1)).bit_length() - 1)
    high = (values >> width).astype(np.int64)
    n_words = (int(high[-1]) + n) // 64 + 1 if n else 1
    bits = np.zeros(n_words * 64, np.uint8)
    bits[high + np.arange(n)] = 1
    words = np.packbits(bits, bitorder="little").view("<u8")
    ones = _ONES[words.view(np.uint8)].reshape(-1, 8).sum(axis=1, dtype=np.int64)
    before = np.concatenate(([0], np.cumsum(ones)))[:-1]
    return {
        "shape": np.array([n, width], np.int64),
        "low": _pack(values & ((1 << width) - 1), width),
        "high": words,
        "before": before.astype(np.int64 if n >= 1 << 31 else np.int32),
    }


class Sequence:
    """A coded sequence; all methods take and give arrays."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.n, self.width = (int(x) for x in arrays["shape"])
        self._low, self._high, self._before = arrays["low"], arrays["high"], arrays["before"]

    def _low_bits(self, i: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(i), np.int64)
        bit = i * self.width
        at = (bit >> 3)[:, None] + np.arange(8)
        window = np.ascontiguousarray(self._low[at]).view("<u8")[:, 0]
        return ((window >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.width) - 1)).astype(np.int64)

    @staticmethod
    def _select_in_words(words: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Place of the k-th one (from 0) in each word."""
        bytes_ = np.ascontiguousarray(words).view(np.uint8).reshape(-1, 8)
        sums = np.cumsum(_ONES[bytes_], axis=1, dtype=np.int64)
        byte = (sums <= k[:, None]).sum(axis=1)
        byte = np.minimum(byte, 7)
        rows = np.arange(len(words))
        ahead = np.where(byte > 0, sums[rows, byte - 1], 0)
        return byte * 8 + _SELECT[bytes_[rows, byte], np.clip(k - ahead, 0, 7)]

    def access(self, i: np.ndarray) -> np.ndarray:
        """Values at places ``i``."""
        word = np.searchsorted(self._before, i, side="right") - 1
        place = word * 64 + self._select_in_words(self._high[word], i - self._before[word])
        return ((place - i) << self.width) | self._low_bits(i)

    def _first_with_high(self, h: np.ndarray) -> np.ndarray:
        """How many values have high bits below ``h``: ones before the h-th zero."""
        n_words = len(self._high)
        zeros_before = np.arange(n_words) * 64 - self._before
        k = h - 1  # the zero that ends the run of high bits h - 1
        word = np.searchsorted(zeros_before, k, side="right") - 1
        word = np.maximum(word, 0)
        place = word * 64 + self._select_in_words(~self._high[word], k - zeros_before[word])
        return np.where(h > 0, np.minimum(place - k, self.n), 0)

    def successor(self, begin: np.ndarray, end: np.ndarray, target: np.ndarray) -> np.ndarray:
        """First place in ``[begin, end)`` whose value is at least ``target``, or ``end``."""
        if not self.n:
            return end.copy()
        high = target >> self.width
        top = int(len(self._high)) * 64 - self.n  # zeros in the bit string
        beyond = high >= top
        high = np.minimum(high, max(top - 1, 0))
        low = np.where(beyond, end, np.clip(self._first_with_high(high), begin, end))
        stop = np.where(beyond, end, np.clip(self._first_with_high(high + 1), begin, end))
        wanted = target & ((1 << self.width) - 1)
        while True:  # halve the run of equal high bits
            open_ = np.flatnonzero(low < stop)
            if not len(open_):
                return low
            middle = (low[open_] + stop[open_]) >> 1
            less = self._low_bits(middle) < wanted[open_]
            low[open_[less]] = middle[less] + 1
            stop[open_[~less]] = middle[~less]


def join_ranges(values: np.ndarray, pointers: np.ndarray) -> np.ndarray:
    """Make ascending ranges one monotone sequence: each is raised by the last value before it."""
    lengths = np.diff(pointers)
    lasts = np.where(lengths > 0, values[np.maximum(pointers[1:] - 1, 0)] if len(values) else 0, 0)
    bases = np.concatenate(([0], np.cumsum(lasts)))[:-1]
    return values + np.repeat(bases, lengths)


def find_in_ranges(
    pointers: Sequence, values: Sequence, node: np.ndarray, wanted: np.ndarray
) -> np.ndarray:
    """Place of ``wanted`` among the successors of each context ``node``, or -1.

    The pointers give the context's range; the value before it is what its members were raised by.
    """
    begin, end = pointers.access(node), pointers.access(node + 1)
    base = np.zeros(len(node), np.int64)
    inner = np.flatnonzero((begin > 0) & (begin < end))
    base[inner] = values.access(begin[inner] - 1)
    target = base + wanted
    at = values.successor(begin, end, target)
    out = np.full(len(node), -1, np.int64)
    inside = np.flatnonzero(at < end)
    hit = inside[values.access(at[inside]) == target[inside]]
    out[hit] = at[hit]
    return out
