"""Vectorised work on the UTF-8 bytes of a text column, in Arrow batches.

A batch's texts lie one after another in one byte array; words, shingles and
substrings are found by array operations over whole slices of it, with no loop
over rows. Slices are about ``SLICE_BYTES`` long, so that memory stays bounded
whatever the batch; a longer text makes one slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15
_U = np.uint64

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: All but ASCII letters and digits and the bytes of other characters.
NOT_WORD = np.ones(256, bool)
NOT_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE_VALUES = np.random.RandomState(20).randint(1, 1 << 62, 256, dtype=np.int64).astype(_U)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


class _Powers:
    """Powers of the multiplier and of its inverse modulo 2**64, as far as asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(0, _U)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SLICE_BYTES)
            steps = np.ones(size, _U)
            steps[1:] = _U(_MULTIPLIER)
            self.up = np.multiply.accumulate(steps)
            steps[1:] = _U(pow(_MULTIPLIER, -1, 1 << 64))
            self.down = np.multiply.accumulate(steps)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


class Texts:
    """Some rows' texts as bytes: row ``i`` is ``data[starts[i]:starts[i + 1]]``."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, first_row: int = 0):
        self.data, self.starts, self.first_row = data, starts, first_row
        self._sums: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.starts) - 1

    def row_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, places, side="right") - 1

    def lowered(self) -> Texts:
        """A-Z in lower case; other letters stay."""
        return Texts(LOWER[self.data], self.starts, self.first_row)

    def words(self, gaps: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and row of each run of bytes outside ``gaps``, white space at first."""
        inside = ~gaps[self.data]
        if not len(inside):
            none = np.zeros(0, np.int64)
            return none, none, none
        breaks = self.starts[1:-1]
        breaks = breaks[(breaks > 0) & (breaks < len(inside))]
        before = np.empty(len(inside), bool)
        before[0], before[1:] = False, inside[:-1]
        before[breaks] = False
        after = np.empty(len(inside), bool)
        after[-1], after[:-1] = False, inside[1:]
        after[breaks - 1] = False
        first = np.flatnonzero(inside & ~before)
        last = np.flatnonzero(inside & ~after) + 1
        return first, last, self.row_of(first)

    def span_hash(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """A 64-bit fingerprint of each span's bytes, the same wherever it stands."""
        n = len(self.data)
        up, down = _POWERS.get(n + 1)
        if self._sums is None:
            self._sums = np.zeros(n + 1, _U)
            np.cumsum(_BYTE_VALUES[self.data] * up[:n], out=self._sums[1:])
        found = (self._sums[last] - self._sums[first]) * down[first]
        return mix(found + (last - first).astype(_U))


def text_bytes(column: pa.Array) -> Texts:
    """A string column's bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    starts = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    if not len(column):
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[starts[0] : starts[-1]]
    return Texts(data, starts - starts[0])


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """The column's texts in order, some rows at a time; ``first_row`` tells where."""
    whole = text_bytes(column)
    low = 0
    while low < len(whole):
        high = int(np.searchsorted(whole.starts, whole.starts[low] + limit, side="right")) - 1
        high = max(high, low + 1)
        at, end = whole.starts[low], whole.starts[high]
        yield Texts(whole.data[at:end], whole.starts[low : high + 1] - at, low)
        low = high


def shingle_hash(words: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint and row of each run of ``size`` words of a row, from word fingerprints.

    A row with fewer words has its whole sequence as one. Words are in row order.
    """
    n = len(words)
    if not n:
        return words, rows
    starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    counts = np.diff(np.r_[starts, n])
    left = np.repeat(starts + counts, counts) - np.arange(n)  # words from here to the row's end
    value = np.zeros(n, _U)
    for k in range(size):
        at = np.minimum(np.arange(n) + k, n - 1)
        value = mix(value * _U(_MULTIPLIER) + np.where(left > k, words[at], _U(k + 1)))
    whole = left >= size
    whole[starts] = True
    return value[whole], rows[whole]
