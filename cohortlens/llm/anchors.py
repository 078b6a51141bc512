"""Removal of repeated windows of words by fixed-block anchors.

A window is ``window`` consecutive words of one document. It goes where the same words
start earlier too: in a document of a smaller key, or earlier in the same one. Blocks
are half as long, so every window holds a whole one of its document's non-overlapping
blocks (at words 0, 10, 20, ...), and its copies hold the same words at any place.

1. Index and probes: the blocks of all documents are the index, and every rolling run
   of a block's length is a probe. Documents travel in slices of bounded size; a slice
   sends each of its fingerprints once, packed by bucket, whatever number of times it
   has it, so that a very common block is no larger a task than a rare one. A bucket
   answers with a bit for each: is it a block that another place holds too.
2. Extension: a hit is extended to every window that holds it, and hits side by side to
   one maximal stretch of windows. Only windows of stretches travel further, each once
   for a slice, with its first place there; a bucket answers whether an earlier place
   than that exists. No pair of places is ever listed.
3. A slice removes what its windows cover: those whose first place lies elsewhere, and
   all but the first of others.

The texts are shuffled once, by slice; all three steps read that shuffle. Answers are
bits, joined to the slice that asked. What a slice sent is worked out again from its
texts, so nothing else is kept. Probes are told apart by 32 bits within a bucket (a
false hit only lets a window travel), windows by 96 bits and the bucket.

Defined cases: a text that is null, empty or has fewer words than a window keeps all;
a null key counts as the largest key; rows of one key are one document, so places of the
same key and word number are the same place and remove nothing from each other, as in
rows that repeat; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.textbytes import Texts, mix, slices

SLICE_BYTES = 1 << 20
MOST_SLICE_BYTES = 1 << 25
BYTES_A_BUCKET = 1 << 12  # a slice's texts for each bucket, so that packed rows stay sizeable
_U = np.uint64
_MULTIPLIERS = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
LAST_KEY = (1 << 63) - 1
ASKED = "slice long, bucket long, lone binary, blocks binary"
PLACED = "slice long, bucket long, low binary, high binary, doc binary, word binary"
ANSWER = "step int, slice long, bucket long, bits binary"


@dataclass(frozen=True)
class Windows:
    """Windows of ``window`` words, found by blocks of half as many, in ``buckets`` of fingerprints."""

    window: int = 20
    buckets: int = 200

    @property
    def block(self) -> int:
        return self.window // 2


def _packed(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The values between two offsets as one binary each."""
    width = values.dtype.itemsize
    bounds = pa.py_buffer((offsets * width).astype(np.int32))
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(offsets) - 1, [None, bounds, pa.py_buffer(np.ascontiguousarray(values))]
    )


def _unpacked(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column, and how many each row has."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    if not len(column) or offsets[0] == offsets[-1]:
        return np.zeros(0, dtype), np.zeros(len(column), np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data.view(dtype), np.diff(offsets) // np.dtype(dtype).itemsize


def _bits(flags: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The flags of each row as a binary of bits."""
    ends = np.cumsum(counts)
    return pa.array(
        [np.packbits(flags[e - n : e]).tobytes() for e, n in zip(ends, counts, strict=True)], pa.binary()
    )


class Slice:
    """The words of some documents and the fingerprints of their runs of words."""

    def __init__(self, part: Texts, docs: np.ndarray, windows: Windows):
        self.part, self.windows = part, windows
        self.first, self.last, self.row = part.words()
        self.bounds = np.searchsorted(self.row, np.arange(len(part) + 1))
        self.word = np.arange(len(self.row)) - self.bounds[self.row]  # number within the document
        self.left = self.bounds[self.row + 1] - np.arange(len(self.row))  # words from here on
        self.doc = docs[self.row]
        self.value = part.span_hash(self.first, self.last)

    def run_hash(self, at: np.ndarray, size: int, which: int = 0) -> np.ndarray:
        """A fingerprint of the ``size`` words from each place."""
        out = np.zeros(len(at), _U)
        own = self.value if not which else mix(self.value ^ _U(_MULTIPLIERS[1]))
        for k in range(size):
            out = out * _U(_MULTIPLIERS[which]) + own[at + k]
        return mix(out)

    def bucket_of(self, value: np.ndarray) -> np.ndarray:
        return ((value >> _U(32)) * _U(self.windows.buckets)) >> _U(32)

    def asked(self) -> None:
        """Distinct probes by bucket, ``lone`` ones before those that are also blocks."""
        size = self.windows.block
        self.at = np.flatnonzero(self.left >= size)
        value = self.run_hash(self.at, size)
        bucket = self.bucket_of(value)
        key, inverse = np.unique((bucket << _U(32)) | (value & _U(0xFFFFFFFF)), return_inverse=True)
        block = np.zeros(len(key), bool)
        block[inverse[self.word[self.at] % size == 0]] = True
        order = np.lexsort((block, key >> _U(32)))  # stable: by bucket, blocks last
        place = np.empty(len(key), np.int64)
        place[order] = np.arange(len(key))
        self.probe = place[inverse]  # of each place in ``at``, which probe
        self.key, self.is_block = key[order], block[order]
        self.known = self.is_block & (np.bincount(self.probe, minlength=len(key)) > 1)
        self.probe_bucket = self.key >> _U(32)

    def stretches(self, hits: np.ndarray) -> np.ndarray:
        """First words of all windows that hold a hit probe."""
        size, window = self.windows.block, self.windows.window
        at = self.at[hits[self.probe]]
        low = np.maximum(at - (window - size - 1), self.bounds[self.row[at]])
        change = np.bincount(low, minlength=len(self.row) + 1)
        change -= np.bincount(at + 1, minlength=len(self.row) + 1)
        return np.flatnonzero((np.cumsum(change[:-1]) > 0) & (self.left >= window))

    def placed(self, hits: np.ndarray) -> None:
        """Distinct windows of the stretches by bucket, each with its first place."""
        self.start = self.stretches(hits)
        one = self.run_hash(self.start, self.windows.window)
        two = self.run_hash(self.start, self.windows.window, 1)
        doc, word = self.doc[self.start], self.word[self.start]
        order = np.lexsort((word, doc, two, one))
        a, b = one[order], two[order]
        new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][: len(a)]
        group = np.cumsum(new) - 1
        head = order[new]  # place in ``start`` of each group's first
        by_bucket = np.lexsort((word[head], doc[head], self.bucket_of(one[head])))
        place = np.empty(len(head), np.int64)
        place[by_bucket] = np.arange(len(head))
        self.group = np.empty(len(order), np.int64)
        self.group[order] = place[group]
        head = head[by_bucket]
        self.one, self.two = one[head], two[head]
        self.head_doc, self.head_word = doc[head], word[head]
        self.window_bucket = self.bucket_of(self.one)

    def removed(self, elsewhere: np.ndarray) -> np.ndarray:
        """Whether each word is covered by a window that starts earlier too."""
        later = self.doc[self.start] > self.head_doc[self.group]
        same = self.doc[self.start] == self.head_doc[self.group]
        later |= same & (self.word[self.start] > self.head_word[self.group])
        gone = self.start[later | elsewhere[self.group]]
        size = len(self.row) + 1
        change = np.bincount(gone, minlength=size)
        change -= np.bincount(gone + self.windows.window, minlength=size)
        return np.cumsum(change[:-1]) > 0


def _rows_by_bucket(number: int, bucket: np.ndarray, columns: dict[str, pa.Array], buckets: int):
    """One row for each bucket that has values."""
    own = np.flatnonzero(np.bincount(bucket.astype(np.int64), minlength=buckets))
    arrays = [pa.array(np.full(buckets, number)), pa.array(np.arange(buckets)), *columns.values()]
    whole = pa.RecordBatch.from_arrays(arrays, ["slice", "bucket", *columns])
    return whole.take(pa.array(own))


def _offsets(bucket: np.ndarray, buckets: int) -> np.ndarray:
    return np.searchsorted(bucket, np.arange(buckets + 1).astype(bucket.dtype))


def _answers(step: int, table: pa.Table, flags: np.ndarray, counts: np.ndarray) -> pa.Table:
    """The bits of rows that have any."""
    rows = np.repeat(np.arange(len(counts)), counts)
    some = pa.array(np.flatnonzero(np.bincount(rows[flags], minlength=len(counts))))
    arrays = [
        pa.array(np.full(len(counts), step, np.int32)),
        table["slice"].combine_chunks(),
        table["bucket"].combine_chunks(),
        _bits(flags, counts),
    ]
    return pa.table(arrays, ["step", "slice", "bucket", "bits"]).take(some)


def _known_blocks(table: pa.Table) -> pa.Table:
    """Bits of a bucket's probes, lone ones first: a block that another place holds too."""
    lone, n_lone = _unpacked(table["lone"], np.uint32)
    block, n_block = _unpacked(table["blocks"], np.uint32)
    index, inverse, times = np.unique(block, return_inverse=True, return_counts=True)
    if not len(index):
        return _answers(1, table.slice(0, 0), np.zeros(0, bool), np.zeros(0, np.int64))
    at = np.minimum(np.searchsorted(index, lone), len(index) - 1)
    hit = index[at] == lone
    times[at[hit]] += 1
    again = times[inverse] > 1
    # Rows hold their lone probes and then their blocks.
    counts = n_lone + n_block
    ends = np.cumsum(counts)
    flags = np.zeros(int(counts.sum()), bool)
    flags[np.arange(len(lone)) + np.repeat(ends - counts - np.cumsum(n_lone) + n_lone, n_lone)] = hit
    flags[np.arange(len(block)) + np.repeat(ends - n_block - np.cumsum(n_block) + n_block, n_block)] = again
    return _answers(1, table, flags, counts)


def _not_first(table: pa.Table) -> pa.Table:
    """Bits of a bucket's windows: an earlier place than this one has the same words."""
    low, counts = _unpacked(table["low"], np.uint32)
    high, _ = _unpacked(table["high"], _U)
    doc, _ = _unpacked(table["doc"], np.int64)
    word, _ = _unpacked(table["word"], np.uint32)
    order = np.lexsort((word, doc, high, low))
    a, b, d, w = low[order], high[order], doc[order], word[order]
    new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][: len(a)]
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(a) else order
    flags = np.zeros(len(a), bool)
    flags[order] = (d != d[head]) | (w != w[head])
    return _answers(2, table, flags, counts)


def _flags(answers: pa.Table, step: int, bucket: np.ndarray, buckets: int) -> np.ndarray:
    """The bits told for a slice's values, which lie by bucket; no answer is all false."""
    out = np.zeros(len(bucket), bool)
    offsets = _offsets(bucket, buckets)
    for s, b, bits in zip(*(answers[c].to_pylist() for c in ("step", "bucket", "bits")), strict=True):
        if s == step:
            low, high = offsets[b], offsets[b + 1]
            out[low:high] = np.unpackbits(np.frombuffer(bits, np.uint8), count=high - low)
    return out


def _sliced(docs: DataFrame, key: str, text: str, slice_bytes: int) -> DataFrame:
    """Rows with the number of their slice: neighbours of about ``slice_bytes`` together."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(batch.column(1), slice_bytes):
                own = batch.slice(part.first_row, len(part))
                numbers = pa.array(np.full(len(part), at))
                yield pa.RecordBatch.from_arrays([numbers, *own.columns], ["slice", "doc_id", "text"])
                at += 1

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(number, "slice long, doc_id long, text string")


def _slice_of(texts: pa.Table, windows: Windows) -> Slice:
    """A slice's words; rows that a shuffle brought in any order are taken by key and text."""
    docs = texts["doc_id"].combine_chunks().fill_null(LAST_KEY).to_numpy()
    (part,) = slices(texts["text"].combine_chunks(), 1 << 62)
    return Slice(part, docs, windows)


def _in_order(texts: pa.Table) -> pa.Table:
    return texts.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def deduplicated(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = 20
) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, the removed ``cuts`` and the text ``kept``.

    Cuts are maximal runs of removed words, by number from 0, end exclusive; kept words
    are joined by one space. ``window`` is even.
    """
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slice_bytes = min(max(SLICE_BYTES, buckets * BYTES_A_BUCKET), MOST_SLICE_BYTES)
    windows = Windows(window, buckets)
    texts = _sliced(docs, key, text, slice_bytes).repartition(buckets, "slice")

    def ask(number: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        own = _slice_of(_in_order(table), windows)
        own.asked()
        bounds = _offsets(own.probe_bucket, buckets)
        small = (own.key & _U(0xFFFFFFFF)).astype(np.uint32)
        blocks = np.r_[0, np.cumsum(own.is_block)][bounds]
        columns = {
            "lone": _packed(small[~own.is_block], bounds - blocks),
            "blocks": _packed(small[own.is_block], blocks),
        }
        return pa.Table.from_batches([_rows_by_bucket(number[0].as_py(), own.probe_bucket, columns, buckets)])

    def extend(number: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        own = _slice_of(_in_order(table), windows)
        own.asked()
        own.placed(own.known | _flags(answers, 1, own.probe_bucket, buckets))
        bounds = _offsets(own.window_bucket, buckets)
        columns = {
            "low": _packed((own.one & _U(0xFFFFFFFF)).astype(np.uint32), bounds),
            "high": _packed(own.two, bounds),
            "doc": _packed(own.head_doc, bounds),
            "word": _packed(own.head_word.astype(np.uint32), bounds),
        }
        return pa.Table.from_batches([_rows_by_bucket(number[0].as_py(), own.window_bucket, columns, buckets)])

    def cut(number: tuple[pa.Scalar, ...], table: pa.Table, answers: pa.Table) -> pa.Table:
        table = _in_order(table)
        own = _slice_of(table, windows)
        own.asked()
        own.placed(own.known | _flags(answers, 1, own.probe_bucket, buckets))
        gone = own.removed(_flags(answers, 2, own.window_bucket, buckets))
        data, kept, starts, ends, sizes = own.part.data.tobytes(), [], [], [], []
        for i in range(len(own.part)):
            low, high = own.bounds[i], own.bounds[i + 1]
            edges = np.flatnonzero(np.diff(np.r_[False, gone[low:high], False]))
            starts.append(edges[::2])
            ends.append(edges[1::2])
            sizes.append(len(edges) // 2)
            stay = np.flatnonzero(~gone[low:high]) + low
            kept.append(
                b" ".join(data[a:b] for a, b in zip(own.first[stay].tolist(), own.last[stay].tolist(), strict=True))
            )
        spans = pa.StructArray.from_arrays(
            [pa.array(np.concatenate(x).astype(np.int64)) for x in (starts, ends)], ["start", "end"]
        )
        removed = np.bincount(own.row[gone], minlength=len(own.part)).astype(np.int64)
        offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
        return pa.table(
            [
                table["doc_id"],
                pa.array(np.diff(own.bounds)),
                pa.array(removed),
                pa.ListArray.from_arrays(offsets, spans),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            ["doc_id", "n_words", "n_removed", "cuts", "kept"],
        )

    by_slice = texts.groupBy("slice")
    asked = by_slice.applyInArrow(ask, ASKED)
    hits = asked.groupBy("bucket").applyInArrow(_known_blocks, ANSWER)
    placed = by_slice.cogroup(hits.groupBy("slice")).applyInArrow(extend, PLACED)
    earlier = placed.groupBy("bucket").applyInArrow(_not_first, ANSWER)
    schema = "doc_id long, n_words long, n_removed long, cuts array<struct<start:long,end:long>>, kept string"
    return by_slice.cogroup(hits.union(earlier).groupBy("slice")).applyInArrow(cut, schema)
