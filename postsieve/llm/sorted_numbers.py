"""Ascending 64-bit numbers and counts as small blocks of bytes, for shuffles of very many of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def _planes(values: np.ndarray) -> bytes:
    """Bytes of one significance together, compressed."""
    width = values.dtype.itemsize
    return pa.compress(values.view(np.uint8).reshape(-1, width).T.tobytes(), codec="zstd", asbytes=True)


def _values(blob: bytes, n: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = pa.decompress(blob, decompressed_size=width * n, codec="zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(width, n).T.copy().view(kind)[:, 0]


def packed_names(names: np.ndarray) -> bytes:
    """Ascending numbers as differences."""
    return _planes(np.diff(names, prepend=np.zeros(1, np.uint64)))


def unpacked_names(blob: bytes, n: int) -> np.ndarray:
    return np.cumsum(_values(blob, n, np.uint64), dtype=np.uint64)


def packed_counts(counts: np.ndarray) -> bytes:
    """Counts; what 32 bits do not hold is the largest number that they do."""
    return _planes(np.minimum(counts, (1 << 32) - 1).astype(np.uint32))


def unpacked_counts(blob: bytes, n: int) -> np.ndarray:
    return _values(blob, n, np.uint32).astype(np.int64)


def grouped(names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(order, group, first)``: the sorting permutation, each sorted name's group, where groups begin."""
    order = np.argsort(names)
    ordered = names[order]
    new = np.ones(len(names), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return order, np.cumsum(new) - 1, np.flatnonzero(new)
