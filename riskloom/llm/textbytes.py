"""Whole batches of texts as one run of bytes, for numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: bytes of text that are worked on at a time (a longer text goes alone)
PIECE = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: space and tab .. carriage return
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column without nulls, and where each row begins (one more entry than rows)."""
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    starts = starts.astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[starts[0]:starts[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, starts - starts[0]


def pieces(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, starts) of runs of rows with about PIECE bytes."""
    if not len(column):
        return
    raw, starts = text_bytes(column)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(starts, starts[low] + PIECE, "right")) - 1)
        yield low, high, raw[starts[low]:starts[high]], starts[low:high + 1] - starts[low]
        low = high


def lower(raw: np.ndarray) -> np.ndarray:
    return _LOWER[raw]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing step (splitmix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def random_words(seed: int, size: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**64, size, dtype=np.uint64)


class RangeHash:
    """64-bit hashes of any byte ranges of a run: sums of random words by byte, times powers of an odd base."""

    def __init__(self, seed: int) -> None:
        self.byte = random_words(seed, 256)
        self.base = int(random_words(seed + 1, 1)[0]) | 1
        self.inverse = pow(self.base, -1, 2**64)
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if len(self.up) <= size:
            size = max(size + 1, 2 * PIECE)
            self.up = np.full(size, self.base, np.uint64)
            self.up[0] = 1
            np.multiply.accumulate(self.up, out=self.up)
            self.down = np.full(size, self.inverse, np.uint64)
            self.down[0] = 1
            np.multiply.accumulate(self.down, out=self.down)

    def sums(self, raw: np.ndarray) -> np.ndarray:
        self._grow(len(raw))
        out = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.byte[raw] * self.up[:len(raw)], out=out[1:])
        return out

    def ranges(self, sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of [begin, end); the length goes in as well."""
        return mix64((sums[end] - sums[begin]) * self.down[begin] + (end - begin).astype(np.uint64))


def words(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word, and the row it lies in; words never cross rows."""
    solid = ~BLANK[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[starts] = True
    before = np.zeros(len(raw), bool)
    before[1:] = solid[:-1]
    after = np.zeros(len(raw), bool)
    after[:-1] = solid[1:]
    begin = np.flatnonzero(solid & (~before | edge[:-1]))
    end = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return begin, end, np.searchsorted(starts, begin, "right") - 1
