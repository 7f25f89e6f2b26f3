"""64-bit hashes of all words of a batch of texts, computed on whole buffers with numpy.

A word is a run of bytes other than ASCII white space.  A text's hash sequence depends only on
its words, so equal words have equal hashes in every task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute

from postsieve.llm import tokens

#: Bytes handled at once; a longer word is handled in one piece.
CHUNK = 1 << 20
_R = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a fixed permutation)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _byte_values(lower: bool) -> np.ndarray:
    code = np.arange(256, dtype=np.uint64)
    if lower:
        code[ord("A") : ord("Z") + 1] += np.uint64(32)
    values = mix(code + np.uint64(1))
    values[_SPACE] = 0
    return values


_VALUES = {lower: _byte_values(lower) for lower in (False, True)}
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]  # of _R and of its inverse


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_R, pow(_R, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array and the offsets of its texts; NULL is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(flat: np.ndarray, breaks: np.ndarray, chunk: int = CHUNK):
    """Cut the buffer before white space or at breaks: ``(start, end)`` of about ``chunk`` bytes."""
    start, n = 0, len(flat)
    while start < n:
        end = min(start + chunk, n)
        if end < n:
            back = np.flatnonzero(_SPACE[flat[start + 1 : end]])
            at = np.searchsorted(breaks, end, side="right") - 1
            cut = max(start + 1 + int(back[-1]) if len(back) else 0, int(breaks[at]) if at >= 0 else 0)
            if cut <= start:  # one word fills the chunk: go on to its end
                step = chunk
                while cut <= start and end < n:
                    ahead = np.flatnonzero(_SPACE[flat[end : end + step]])
                    at = np.searchsorted(breaks, end, side="left")
                    stop = int(breaks[at]) if at < len(breaks) else n
                    if len(ahead) and end + int(ahead[0]) < stop:
                        cut = end + int(ahead[0])
                    elif stop <= end + step:
                        cut = stop
                    else:
                        end += step
                cut = cut if cut > start else n
            end = cut
        yield start, end
        start = end


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hashes, starts, counts)``: of each word its hash and first byte, of each text its words."""
    tokens.forget()  # stages that hash words encode nothing
    flat, offsets = text_buffer(texts)
    values, found, starts = _VALUES[lower], [], []
    breaks = offsets[:-1]
    for begin, end in pieces(flat, breaks):
        part = flat[begin:end]
        inside = ~_SPACE[part]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        inner = breaks[np.searchsorted(breaks, begin) : np.searchsorted(breaks, end)] - begin
        first[inner] = inside[inner]
        at = np.flatnonzero(first)
        if not len(at):
            continue
        up, down = _power_tables(len(part))
        total = np.cumsum(values[part] * up, dtype=np.uint64)
        ends = np.append(at[1:], len(part)) - 1
        before = np.where(at > 0, total[at - 1], np.uint64(0))
        found.append(mix((total[ends] - before) * down[at]))
        starts.append(at + begin)
    hashes = np.concatenate(found) if found else np.zeros(0, np.uint64)
    where = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    counts = np.diff(np.searchsorted(where, offsets))
    return hashes, where, counts


def small_batches(batch: pa.RecordBatch, text: str = "text", size: int = 4 << 20):
    """Slices of a batch with about ``size`` bytes of text each (one text at least)."""
    bytes_each = pa.compute.binary_length(batch.column(text)).fill_null(0).to_numpy()
    block = np.cumsum(bytes_each, dtype=np.int64) // size
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:]):
        if a < b:
            yield batch.slice(a, b - a)


def distinct(values: np.ndarray) -> np.ndarray:
    """The different values, ascending."""
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) else values


def windows(hashes: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words within one text, and the number of them per text."""
    per_text = np.maximum(counts - n + 1, 0)
    total = len(hashes) - n + 1
    if total <= 0:
        return np.zeros(0, np.uint64), np.zeros(len(counts), np.int64)
    out = np.zeros(total, np.uint64)
    for i in range(n):
        out = mix(out + hashes[i : i + total])
    ends = np.cumsum(counts)
    owner_end = np.repeat(ends, counts)[:total]
    return out[np.arange(total) + n <= owner_end], per_text
