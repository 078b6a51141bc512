"""Periodic runs of words: difference-cover longest common extensions on a harmonic grid.

A run is a stretch of words with smallest period ``q`` and at least ``max(12, 2 * q)``
words that neither neighbouring word extends. Every run of period ``p`` holds a grid
place ``i = k * p`` whose word equals that of ``i + p``, so for every period only the
grid's places are looked at (n log n of them in a text of n words), and each that
matches is extended forwards and backwards by a longest common extension (LCE):

* Only suffixes at the places of a difference cover modulo ``MODULUS`` are sorted, by
  their first ``MODULUS`` words and then by doubling, which stays inside the cover.
* For any two places the cover has a shift below ``MODULUS`` that takes both into it.
  As many words are compared one by one; where all agree, the rest is the least value
  between both suffixes in the array of common prefixes of sorted neighbours, found
  with a sparse table.

Texts are worked on whole, slice by slice of the Arrow batches, with one separator of
its own after each text, so that nothing is shuffled and no extension leaves a text.
Memory is a bounded slice, or one text and the tables over it where that is longer.

Defined cases: a null, empty or blank text has no words and no run; a text of a null
key is left as it is (there is no number to damage it by); repeated rows are judged
each for itself, ties between runs go to the smallest start and then period; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.textbytes import Texts, slices

LEAST_LENGTH = 12
# A perfect difference set, so every difference modulo 31 occurs in it.
MODULUS = 31
COVER = (1, 5, 11, 24, 25, 27)
GRID_POINTS = 1 << 20  # places looked at together

RUNS = "array<struct<start:long,length:long,period:long>>"


def _shifts() -> np.ndarray:
    """For residues a and b, the least d with a + d and b + d both in the cover."""
    inside = np.zeros(MODULUS, bool)
    inside[list(COVER)] = True
    d = np.arange(MODULUS)
    a, b = d[:, None, None], d[None, :, None]
    return np.argmax(inside[(a + d) % MODULUS] & inside[(b + d) % MODULUS], axis=2)


SHIFTS = _shifts()


class Extensions:
    """Longest common extensions, forwards, of places of ``ids``.

    ``ids`` must hold a value found nowhere else behind every text.
    """

    def __init__(self, ids: np.ndarray):
        self.ids = np.r_[ids, np.full(MODULUS + 1, -1)]  # never compared equal: behind a separator
        n = len(ids)
        places = np.arange(n)
        self.places = places[np.isin(places % MODULUS, COVER)]
        self.index = np.full(n + MODULUS, -1)
        self.index[self.places] = np.arange(len(self.places))
        self._sort()
        self._sparse()

    def _sort(self) -> None:
        """Order the cover's suffixes; ``names`` keeps each doubling's classes."""
        at, m = self.places, len(self.places)
        name = np.zeros(m, np.int64)
        tied = np.arange(m)
        for k in range(MODULUS):  # by words, the ties only
            tied, name = self._refined(tied, name, self.ids[at[tied] + k])
            if not len(tied):
                break
        self.names = [name]
        step = MODULUS
        while len(tied):
            # A tie reaches beyond the shift: its text goes on there.
            follows = name[self.index[at[tied] + step]]
            tied, name = self._refined(tied, name.copy(), follows)
            self.names.append(name)
            step *= 2
        self.order = np.argsort(name)
        self.rank = np.empty(m, np.int64)
        self.rank[self.order] = np.arange(m)

    @staticmethod
    def _refined(tied, name, value) -> tuple[np.ndarray, np.ndarray]:
        """Split classes by ``value``; a class is named by its first place in the order."""
        order = np.lexsort((value, name[tied]))
        own, value = tied[order], value[order]
        old = name[own]
        first = np.r_[True, old[1:] != old[:-1]]
        new = first | np.r_[True, value[1:] != value[:-1]]
        place = np.arange(len(own))
        start = np.maximum.accumulate(np.where(first, place, 0))
        head = np.maximum.accumulate(np.where(new, place, 0))
        name[own] = old + head - start
        size = np.diff(np.r_[np.flatnonzero(new), len(own)])
        return own[np.repeat(size, size) > 1], name

    def _sparse(self) -> None:
        """Common prefixes of neighbours, and their minima over spans of powers of two."""
        a, b = self.places[self.order[:-1]], self.places[self.order[1:]]
        common = np.zeros(len(a), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            step = MODULUS << k  # by so many words names[k] tells suffixes apart
            same = self.names[k][self.index[a + common]] == self.names[k][self.index[b + common]]
            common[same] += step
        open_ = np.arange(len(a))
        for _ in range(MODULUS):
            open_ = open_[self.ids[a[open_] + common[open_]] == self.ids[b[open_] + common[open_]]]
            if not len(open_):
                break
            common[open_] += 1
        self.table = [common]
        span = 1
        while span * 2 <= len(common):
            last = self.table[-1]
            self.table.append(np.minimum(last[:-span], last[span:]))
            span *= 2

    def get(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that agree from places i and j (i < j) on."""
        shift = SHIFTS[i % MODULUS, j % MODULUS]
        out = np.zeros(len(i), np.int64)
        open_ = np.arange(len(i))
        for k in range(MODULUS):
            open_ = open_[shift[open_] > k]
            same = self.ids[i[open_] + k] == self.ids[j[open_] + k]
            out[open_[same]] += 1
            open_ = open_[same]
            if not len(open_):
                break
        reached = np.flatnonzero(out == shift)
        x = self.rank[self.index[i[reached] + shift[reached]]]
        y = self.rank[self.index[j[reached] + shift[reached]]]
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.log2(high - low).astype(np.int64)
        for k in np.unique(level):
            own = np.flatnonzero(level == k)
            row = self.table[k]
            least = np.minimum(row[low[own]], row[high[own] - (1 << k)])
            out[reached[own]] += least
        return out


def _grid(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods of the grids of all texts, some periods at a time."""
    half = sizes // 2
    text = np.repeat(np.arange(len(sizes)), half)
    period = np.arange(half.sum()) - np.repeat(np.cumsum(half) - half, half) + 1
    points = (sizes[text] - 1) // period  # k * p with k * p + p inside the text
    upto = np.cumsum(points)
    low = 0
    while low < len(points):
        high = int(np.searchsorted(upto, (upto[low - 1] if low else 0) + GRID_POINTS, side="right"))
        high = max(high, low + 1)
        own = slice(low, high)
        n = points[own]
        k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        p = np.repeat(period[own], n)
        yield np.repeat(starts[text[own]], n) + k * p, p
        low = high


def periodic_runs(words: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Text, start, length and period of the runs of texts of word numbers, in that order."""
    sizes = np.array([len(w) for w in words], np.int64)
    none = (np.zeros(0, np.int64),) * 4
    if not len(sizes) or sizes.max(initial=0) < LEAST_LENGTH:
        return none
    bounds = np.r_[0, np.cumsum(sizes + 1)]  # a separator before each text and one at the end
    ids = np.empty(bounds[-1] + 1, np.int64)
    ids[bounds] = -2 - np.arange(len(bounds))
    starts = bounds[:-1] + 1
    inside = np.ones(len(ids), bool)
    inside[bounds] = False
    ids[inside] = np.concatenate(words)
    n = len(ids)
    found = []
    ahead = behind = None
    for i, p in _grid(starts, sizes):
        same = ids[i] == ids[i + p]
        i, p = i[same], p[same]
        if not len(i):
            continue
        if ahead is None:
            ahead, behind = Extensions(ids), Extensions(ids[::-1])
        after = ahead.get(i, i + p)
        before = behind.get(n - i - p, n - i)  # from i + p - 1 and i - 1 backwards
        whole = after + before >= np.maximum(p, LEAST_LENGTH - p)
        i, p, after, before = (x[whole] for x in (i, p, after, before))
        if len(i):
            found.append(np.unique(np.stack([i - before, i + p + after, p], axis=1), axis=0))
    if not found:
        return none
    # Multiples of a run's smallest period give the same stretch; the smallest comes first.
    start, end, period = np.unique(np.concatenate(found), axis=0).T
    new = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])]
    start, end, period = start[new], end[new], period[new]
    order = np.lexsort((period, start))
    start, end, period = start[order], end[order], period[order]
    text = np.searchsorted(starts, start, side="right") - 1
    return text, start - starts[text], end - start, period


@dataclass(frozen=True)
class Damage:
    """Which texts get a repeated unit, and from which word on, from the key's checksum."""

    one_in: int = 10

    def source(self, key: int | None, n: int) -> np.ndarray | None:
        """For each of ``n`` words the original word that stands there, None if unchanged."""
        if key is None or not n:
            return None
        h = zlib.crc32(str(key).encode())
        if h % self.one_in:
            return None
        g = h // self.one_in
        a = g % n
        place = np.arange(n)
        return np.where(place < a, place, a + (place - a) % (1 + (n - a) // (3 + g % 8)))


def _numbered(part: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, the first word of each row, and exact word numbers."""
    first, last, rows = part.words()
    inside = np.zeros(len(part.data) + 1, np.int32)
    inside[first] += 1
    inside[last] -= 1
    letters = part.data[np.cumsum(inside[:-1]) > 0]
    offsets = np.r_[0, np.cumsum(last - first)].astype(np.int64)
    column = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(letters.tobytes())]
    )
    numbers = column.dictionary_encode().indices.to_numpy().astype(np.int64)
    return first, last, np.searchsorted(rows, np.arange(len(part) + 1)), numbers


def _joined(part: Texts, first: np.ndarray, last: np.ndarray) -> bytes:
    """Words joined by one space."""
    if not len(first):
        return b""
    size = last - first + 1
    ends = np.cumsum(size)
    out = part.data[np.minimum(np.arange(ends[-1]) + np.repeat(first - ends + size, size), len(part.data) - 1)]
    out[ends - 1] = 0x20
    return out[:-1].tobytes()


def collapsed(
    docs: DataFrame, key: str = "doc_id", text: str = "text", damage: Damage | None = None
) -> DataFrame:
    """Per row: doc_id, n_words, its ``runs`` by start and period, and the text ``collapsed``.

    A collapsed text keeps of each run the first period only; its words are joined by
    one space. ``damage`` repeats words of some texts first.
    """
    schema = f"doc_id long, n_words long, runs {RUNS}, collapsed string"

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                first, last, bounds, numbers = _numbered(part)
                keys = batch.column(0).slice(part.first_row, len(part))
                source = np.arange(len(first))
                for i, k in enumerate(keys.to_pylist() if damage else ()):
                    moved = damage.source(k, int(bounds[i + 1] - bounds[i]))
                    if moved is not None:
                        source[bounds[i] : bounds[i + 1]] = bounds[i] + moved
                numbers = numbers[source]
                row, start, length, period = periodic_runs(np.split(numbers, bounds[1:-1]))
                size, begin = len(first) + 1, bounds[row] + start
                change = np.bincount(begin + period, minlength=size) - np.bincount(begin + length, minlength=size)
                kept = np.cumsum(change[:-1]) == 0
                texts = []
                for i in range(len(part)):
                    own = source[bounds[i] : bounds[i + 1]][kept[bounds[i] : bounds[i + 1]]]
                    texts.append(_joined(part, first[own], last[own]))
                offsets = np.searchsorted(row, np.arange(len(part) + 1)).astype(np.int32)
                runs = pa.StructArray.from_arrays(
                    [pa.array(x) for x in (start, length, period)], ["start", "length", "period"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        keys,
                        pa.array(np.diff(bounds)),
                        pa.ListArray.from_arrays(pa.array(offsets), runs),
                        pa.array(texts, pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(find, schema)


def digested(found: DataFrame) -> DataFrame:
    """Per row of ``collapsed``: doc_id, n_runs, the longest run and both digests."""
    line = "concat_ws('', transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\\n'))"
    longest = "array_max(transform(runs, r -> struct(r.length, -r.start AS s, -r.period AS p)))"
    top = found.withColumn("top", F.expr(longest))
    return top.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.expr("-top.s").alias("start"),
        F.col("top.length").alias("length"),
        F.expr("-top.p").alias("period"),
        F.expr("1000 * top.length div -top.p").alias("exponent_milli"),
        F.sha2(F.expr(line).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
