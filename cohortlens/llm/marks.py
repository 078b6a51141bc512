"""Marks of sets: sets that link share one, others hardly ever do.

The elements of a set are dealt to parts by their fingerprints. Two sets that differ in
at most ``changes`` elements agree in all parts but as many, so of ``changes + 1 + spare``
parts they agree in ``spare + 1``. A mark is the fingerprint of a whole part. A set leaves
out its ``spare`` weakest marks, those of parts with the fewest rare elements: of the parts
in which two sets agree, the strongest is left out by neither. Unlike a single element, a
part of several is not in two texts by chance, however many texts there are.

How many changes a link allows follows from sizes, so sizes form bands. A pair is told by
the band of its smaller set: a set has marks for its own band and for each below it with
sets of like size. Sets that allow no change have none, as only equal ones link.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from cohortlens.llm.anchors import _offsets, _packed, _rows_by_bucket, _unpacked
from cohortlens.llm.textbytes import mix

SPARE = 8  # parts for each that is left out
MOST_MARKS = 1 << 16  # marks that are held before they are sent, or
MARKS_A_BUCKET = 64  # as many for each bucket, so that packed rows stay sizeable
_U = np.uint64
_LOW = _U(0xFFFFFFFF)


class Bands:
    """Sizes up to ``most`` in bands, each with the ``changes`` that a link allows and its ``spare`` parts."""

    def __init__(self, percent: int, most: int):
        starts = [1]
        while starts[-1] <= most:
            starts.append(max(starts[-1] + 1, starts[-1] * 5 // 4))
        self.starts = np.array(starts)
        last = self.starts[1:] - 1
        self.changes = (100 - percent) * (last + 100 * last // percent) // (100 + percent)
        self.spare = np.where(self.changes > 0, 1 + self.changes // SPARE, 0)

    def of(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, n, side="right") - 1


def of_sets(
    value: np.ndarray, is_rare: np.ndarray, rows: np.ndarray, n: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """Marks and their rows, of sets of sizes ``n`` whose elements lie by row."""
    bands = Bands(percent, int(n.max(initial=0)))
    high, low = bands.of(n), bands.of(np.maximum(-(-percent * n // 100), 1))
    dealt, told = mix(value ^ _U(0xC2B2AE3D27D4EB4F)) >> _U(32), mix(value)
    found = [(np.zeros(0, _U), np.zeros(0, np.int64))]
    for below in range(int((high - low).max(initial=-1)) + 1):
        band = np.maximum(high - below, 0)
        has = (n > 0) & (high - below >= low) & (bands.changes[band] > 0)
        spare = bands.spare[band]
        parts = np.where(has, bands.changes[band] + 1 + spare, 0)
        total, base = int(parts.sum()), np.cumsum(parts) - parts
        own = has[rows]
        at = rows[own]
        place = base[at] + ((dealt[own] * parts[at].astype(_U)) >> _U(32)).astype(np.int64)

        def summed(of: np.ndarray) -> np.ndarray:
            # Sums of 32 bits are exact in doubles.
            return np.bincount(place, weights=of[own], minlength=total).astype(_U)

        row = np.repeat(np.arange(len(n)), parts)
        number = np.arange(total) - base[row]
        mark = mix((band[row].astype(_U) << _U(32)) + number.astype(_U))
        mark = mix(summed(told & _LOW) + mix(summed(told >> _U(32)) + mark))
        weak = _U(255) - np.minimum(summed(is_rare), _U(255))
        key = (row.astype(_U) << _U(48)) | (weak << _U(40)) | (mark & _U((1 << 40) - 1))
        order = np.argsort(key, kind="stable")[number < (parts - spare)[row]]
        found.append((mark[order], row[order]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def sent(base: int, mark: np.ndarray, row: np.ndarray, buckets: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """Distinct marks by bucket, each with its first row, and the links (row, first row) of others.

    However many rows have a mark, it is sent once, so that a common one is no larger a task.
    """
    bucket = ((mark >> _U(32)) * _U(buckets)) >> _U(32)
    key = (bucket << _U(32)) | (mark & _LOW)
    order = np.lexsort((row, key))
    key, row = key[order], row[order]
    new, head = _heads(key, row)
    links = _distinct(row[~new] + base, head[~new] + base)
    key, row = key[new], row[new]
    bounds = _offsets(key >> _U(32), buckets)
    columns = {
        "marks": _packed((key & _LOW).astype(np.uint32), bounds),
        "rows": _packed(row.astype(np.uint16), bounds),
    }
    return _rows_by_bucket(base, key >> _U(32), columns, buckets), links


def _heads(mark: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted marks, which are the first of their kind, and the row of the first of each."""
    new = np.r_[True, mark[1:] != mark[:-1]][: len(mark)]
    return new, row[np.flatnonzero(new)[np.cumsum(new) - 1]]


def _distinct(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The pairs (a, b) of differing ends, each once, as two rows."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][: len(a)] & (a != b)
    return np.stack((a[new], b[new]))


def met(table: pa.Table) -> pa.Table:
    """Links (a, b) of the places that share a mark of a bucket, to the first that has it."""
    mark, counts = _unpacked(table["marks"], np.uint32)
    row, _ = _unpacked(table["rows"], np.uint16)
    place = np.repeat(table["slice"].to_numpy(), counts) + row
    order = np.lexsort((place, mark))
    mark, place = mark[order], place[order]
    new, head = _heads(mark, place)
    links = _distinct(place[~new], head[~new])
    return pa.table({"a": links[0], "b": links[1]})


class Sender:
    """Marks of the rows of one piece, sent when it ends or when they are many."""

    def __init__(self, base: int, buckets: int, write: Callable[[pa.RecordBatch, np.ndarray], Iterator]):
        self.base, self.buckets, self.write = base, buckets, write
        self.held: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, mark: np.ndarray, row: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append((mark, row))
        if sum(len(m) for m, _ in self.held) > max(MOST_MARKS, MARKS_A_BUCKET * self.buckets):
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            mark, row = (np.concatenate(x) for x in zip(*self.held, strict=True))
            self.held = []
            yield from self.write(*sent(self.base, mark, row, self.buckets))
