"""Words and hashes of many texts at once, in numpy over the Arrow buffers.

A slice holds whole rows of about ``SLICE`` bytes, so memory follows the slice
and not the batch; a longer text is a slice of its own. Hashes are 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
ROWS = 4096

_RANDOM = np.random.default_rng(20240501)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RANDOM.integers(1, 1 << 63, 1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_U = np.uint64


def byte_class(inside) -> np.ndarray:
    """Table over the 256 byte values: True where a word byte stands."""
    table = np.zeros(256, bool)
    table[list(inside)] = True
    return table


#: Bytes of ``[^\x20\x09-\x0D]+``.
NOT_SPACE = byte_class(x for x in range(256) if x != 0x20 and not 9 <= x <= 13)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def slices(column: pa.Array, size: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row, bytes, offsets)`` for runs of rows; null is empty text."""
    if not len(column):
        return
    column = column.cast(pa.large_string()).fill_null("")
    _, bounds, data = column.buffers()
    off = np.frombuffer(bounds, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(off, off[low] + size, "right")) - 1)
        high = min(high, len(column), low + ROWS)
        yield low, high, data[off[low]:off[high]], off[low:high + 1] - off[low]
        low = high


class Spans:
    """Maximal runs of word bytes; runs end where a text ends.

    ``start``/``end`` are byte positions, ``first[d]:first[d + 1]`` the runs of text d.
    """

    def __init__(self, data: np.ndarray, off: np.ndarray, inside: np.ndarray = NOT_SPACE):
        word = inside[data]
        start, end = word.copy(), word.copy()
        start[1:] &= ~word[:-1]
        end[:-1] &= ~word[1:]
        edge = off[(off > 0) & (off < len(data))]
        start[edge] = word[edge]
        end[edge - 1] = word[edge - 1]
        self.start, self.end = np.flatnonzero(start), np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.start, off)
        self.doc = np.repeat(np.arange(len(off) - 1), np.diff(self.first))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes of each span; spans do not overlap and may be empty."""
    length = end - start
    out = np.zeros(len(start), np.uint64)
    full = length > 0
    n = length[full]
    if len(n):
        begin = np.cumsum(n) - n
        place = np.arange(int(n.sum())) - np.repeat(begin, n)
        with np.errstate(over="ignore"):
            value = _BYTE[data[place + np.repeat(start[full], n)]] * _PLACE[place & 1023]
            if n.max() > 1024:
                far = np.flatnonzero(place >= 1024)
                value[far] *= mix((place[far] >> 10).astype(np.uint64) + _U(7)) | _U(1)
            out[full] = np.add.reduceat(value, begin)
    with np.errstate(over="ignore"):
        return mix(out + length.astype(np.uint64) * _U(0x9E3779B97F4A7C15))


def grams(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k values from each place on; k - 1 fewer than the values."""
    if len(values) < k:
        return np.zeros(0, np.uint64)
    out, size = values, 1
    with np.errstate(over="ignore"):
        while size < k:
            step = min(size, k - size)
            out = mix(out[:-step] * _U(0x9FB21C651E98DF25) + out[step:] * _U(0xD6E8FEB86659FD93) + _U(size))
            size += step
    return out


def inside_text(spans: Spans, k: int) -> np.ndarray:
    """Whether the k words from each place on belong to one text, per gram."""
    doc = spans.doc
    return doc[:len(doc) - k + 1] == doc[k - 1:] if len(doc) >= k else np.zeros(0, bool)


def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` between consecutive ``bounds``."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]
