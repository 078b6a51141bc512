"""Removal of repeated byte strings by sorting suffixes, exact to the byte.

A byte goes if it lies in some string of ``LENGTH`` bytes that starts at another place
too, in any document. Sorting every suffix would move each text hundreds of times, so
only suffixes at anchors are sorted: the anchor of a start ``p`` is the place of the
least fingerprint in the ``REACH`` bytes from ``p`` on. It depends on these bytes
alone, so equal strings have equal anchors, and all starts with one anchor lie side by
side (an interval). Suffixes are compared by tokens that are fingerprints of their
leading bytes:

1. An interval's suffix has two tokens, the bytes that every string of the interval
   holds, and all bytes that any of them holds. Suffixes are range-partitioned by
   sampled splitters of (tokens, place), so that a run of equal suffixes spreads over
   many buckets; buckets are sorted by multikey quicksort, and neighbours compared,
   across buckets too. Both tokens shared: every start of the interval is repeated.
   Not even the first shared: none is.
2. Starts of the other intervals, near the ends of repeated passages, are suffixes by
   themselves, sorted and compared in the same way. Along with them go the starts of
   one interval of each set of equal ones that shares its first token with them.

A string is known by two 64-bit fingerprints, of it and of its part from the anchor.
Only intervals and starts move, and per document the lists of what repeats; texts
are joined to these by broadcast while they are few, by a shuffle beyond.

Defined cases: null is the empty text; a text shorter than ``LENGTH`` keeps all; rows
that repeat, with the same key or another, repeat each other's strings; keys may be
null; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm import in_pieces
from cohortlens.llm.textbytes import Texts, mix, slices
from cohortlens.sources.staging import staged, unstage

LENGTH = 400
REACH = 160
SLICE = 1 << 19
BUCKET_ROWS = 400_000
BROADCAST_ROWS = 1_000_000  # spans that are sent to every task; beyond, texts are shuffled
_U = np.uint64
SUFFIX = "t1 long, t2 long, doc_id long, mark long, low int, high int, weight int"


def _anchors(part: Texts, reach: int) -> np.ndarray:
    """Per place, that of the least fingerprint of eight bytes in ``reach`` from there on."""
    n = len(part.data)
    word = part.data.astype(_U)
    for step in (1, 2, 4):
        word[:-step] |= word[step:] << _U(8 * step)
    key = (mix(word) & _U(0xFFFFFFFF00000000)) | np.arange(n, dtype=_U)
    size = 1
    while size * 2 <= reach:
        key = _least(key, key, size)
        size *= 2
    return (_least(key, key, reach - size) & _U(0xFFFFFFFF)).astype(np.int64)


def _least(a: np.ndarray, b: np.ndarray, shift: int) -> np.ndarray:
    out = a.copy()
    if 0 < shift < len(a):
        np.minimum(a[:-shift], b[shift:], out=out[:-shift])
    return out


def _starts(part: Texts, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Every place where a string begins, and its row."""
    n = np.maximum(np.diff(part.starts) - length + 1, 0)
    row = np.repeat(np.arange(len(part)), n)
    return np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + part.starts[row], row


def intervals(part: Texts, length: int = LENGTH, reach: int = REACH):
    """First start, last start, row, and both tokens of every interval."""
    start, row = _starts(part, length)
    if not len(start):
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(_U), none.view(_U)
    anchor = _anchors(part, reach)[start]
    new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])])
    low, high = start[new], start[np.r_[new[1:] - 1, len(start) - 1]]
    at = anchor[new]
    return (
        low,
        high,
        row[new],
        part.span_hash(at, at + length - reach + 1),
        part.span_hash(low, high + length),
    )


def multikey_order(tokens: list[np.ndarray]) -> np.ndarray:
    """Order by the first token; only runs of equal ones are sorted by the next, and so on."""
    order = np.argsort(tokens[0], kind="quicksort")
    band = tokens[0][order]
    run = np.cumsum(np.r_[True, band[1:] != band[:-1]]) if len(band) else band
    for token in tokens[1:]:
        size = np.bincount(run)[run] if len(run) else run
        equal = np.flatnonzero(size > 1)
        own = order[equal]
        order[equal] = own[np.lexsort((token[own], run[equal]))]
        value = token[order]
        new = np.r_[True, (value[1:] != value[:-1]) | (run[1:] != run[:-1])][: len(run)]
        run = np.cumsum(new)
    return order


def compared(suffixes: DataFrame) -> DataFrame:
    """A staged table of the suffixes that share a first token, with ``same1``, ``same2``: another one has the first token, or both.

    ``lead`` marks the first of equal ones, ``mixed`` that its first token's run has
    others, or may have as it reaches a bucket's edge.
    """
    spark = suffixes.sparkSession
    n = suffixes.count()
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // BUCKET_ROWS))
    placed = suffixes.repartitionByRange(buckets, "t1", "t2", "doc_id", "low", "mark")

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        tokens = [table[t].to_numpy() for t in ("t1", "t2")]
        order = multikey_order(tokens)
        t1, t2 = (t[order] for t in tokens)
        # A whole interval that stands for equal ones counts as two.
        twice = table["weight"].to_numpy()[order] > 1
        eq1 = t1[1:] == t1[:-1]
        eq2 = eq1 & (t2[1:] == t2[:-1])
        same1 = np.r_[False, eq1] | np.r_[eq1, False] | twice
        same2 = np.r_[False, eq2] | np.r_[eq2, False] | twice
        lead = ~np.r_[False, eq2]
        run = np.cumsum(~np.r_[False, eq1]) - 1
        kinds = np.bincount(run, lead)
        kinds[[0, -1]] += 1
        edge = np.zeros(len(t1), np.int32)
        edge[0] += 1
        edge[-1] += 2
        bucket = np.full(len(t1), TaskContext.get().partitionId())
        sorted_rows = table.take(pa.array(order))
        out = [pa.array(x) for x in (same1, same2, lead, kinds[run] > 1, edge, bucket)]
        names = [*table.column_names, "same1", "same2", "lead", "mixed", "edge", "bucket"]
        kept = pa.Table.from_arrays([*sorted_rows.columns, *out], names)
        # Unless it is at an edge, a suffix that shares nothing is done with.
        kept = kept.filter(pa.array(same1 | (edge > 0)))
        yield from kept.to_batches()

    flags = ", same1 boolean, same2 boolean, lead boolean, mixed boolean, edge int, bucket long"
    rows = staged(placed.mapInArrow(sort, SUFFIX + flags))
    # Two rows of each bucket, in the order of all suffixes.
    edges = rows.where("edge > 0").select("bucket", "edge", "t1", "t2")
    ends = edges.select(
        "bucket", "t1", "t2", F.explode(F.expr("CASE edge WHEN 3 THEN array(1, 2) ELSE array(edge) END")).alias("end")
    )
    along = Window.orderBy("bucket", "end")

    def meets(step, column):
        return F.coalesce(step(column).over(along) == F.col(column), F.lit(False))

    before1, after1 = meets(F.lag, "t1"), meets(F.lead, "t1")
    near = ends.select(
        "bucket",
        "end",
        F.when(F.col("end") == 1, before1).otherwise(after1).alias("near1"),
        F.when(F.col("end") == 1, before1 & meets(F.lag, "t2"))
        .otherwise(after1 & meets(F.lead, "t2"))
        .alias("near2"),
    )
    near = near.groupBy("bucket").agg(
        *[
            F.coalesce(F.bool_or(F.when(F.col("end") == e, F.col(f"near{k}"))), F.lit(False)).alias(f"n{e}{k}")
            for e in (1, 2)
            for k in (1, 2)
        ]
    )
    first, last = F.col("edge").bitwiseAND(1) > 0, F.col("edge").bitwiseAND(2) > 0
    at_edge = rows.where("edge > 0").join(near, "bucket")
    for k in (1, 2):
        crossing = (first & F.col(f"n1{k}")) | (last & F.col(f"n2{k}"))
        at_edge = at_edge.withColumn(f"same{k}", F.col(f"same{k}") | crossing)
    fixed = rows.where("edge = 0").unionByName(at_edge.select(*rows.columns)).where("same1")
    shared = staged(fixed.drop("edge", "bucket"))
    unstage(rows)
    return shared


def _documents(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows by key and text fingerprint: rows that agree in both are one document here."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(key).cast("long").alias("doc_id"), F.xxhash64(body).alias("mark"), body.alias("text")
    )


def _suffix_batch(batch, part: Texts, row, t1, t2, low, high, weight) -> pa.RecordBatch:
    at = pa.array(part.first_row + row)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(t1.view(np.int64)),
            pa.array(t2.view(np.int64)),
            batch.column(0).take(at),
            batch.column(1).take(at),
            pa.array((low - part.starts[row]).astype(np.int32)),
            pa.array((high - part.starts[row]).astype(np.int32)),
            pa.array(np.full(len(row), weight, np.int32) if np.isscalar(weight) else weight),
        ],
        ["t1", "t2", "doc_id", "mark", "low", "high", "weight"],
    )


def _with_lists(rows: DataFrame, lists: DataFrame, few: bool, how: str) -> DataFrame:
    """Documents beside the ``spans`` listed for them, broadcast if they are ``few``."""
    lists = lists.withColumnsRenamed({"doc_id": "own_id", "mark": "own_mark"})
    same = rows["doc_id"].eqNullSafe(lists["own_id"]) & (rows["mark"] == lists["own_mark"])
    return rows.join(F.broadcast(lists) if few else lists, same, how).select(
        "doc_id", "mark", "text", "spans"
    )


def _bounds(column: pa.Array, row: int, names: tuple[str, ...]) -> np.ndarray:
    """The structs of a row's list, by row; a null list is empty."""
    own = column[row].values
    if own is None or not len(own):
        return np.zeros((0, len(names)), np.int64)
    return np.stack([own.field(n).to_numpy().astype(np.int64) for n in names], axis=1)


def repeated_bytes(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Per document (doc_id, mark) with repeated strings, the spans that they cover."""
    rows = _documents(docs, key, text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(2), SLICE):
                low, high, row, t1, t2 = intervals(part, length)
                yield _suffix_batch(batch, part, row, t1, t2, low, high, 1)

    anchored = staged(rows.mapInArrow(in_pieces(cut), SUFFIX))
    sorted_ = compared(anchored)
    unstage(anchored)
    whole = sorted_.where("same2").select("doc_id", "mark", "low", "high")
    open_ = sorted_.where("NOT same2 OR (lead AND mixed)").select(
        "doc_id", "mark", "low", "high", F.when(F.col("same2"), 2).otherwise(1).alias("weight")
    )

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(2), SLICE):
                anchor = _anchors(part, REACH)
                for i in range(len(part)):
                    bounds = _bounds(batch.column(3), part.first_row + i, ("low", "high", "weight"))
                    size = bounds[:, 1] - bounds[:, 0] + 1
                    weight = np.repeat(bounds[:, 2], size).astype(np.int32)
                    start = np.repeat(bounds[:, 0] - np.cumsum(size) + size, size) + np.arange(size.sum())
                    start += part.starts[i]
                    at = anchor[start]
                    yield _suffix_batch(
                        batch,
                        part,
                        np.full(len(start), i),
                        part.span_hash(start, start + length),
                        part.span_hash(at, at + length - REACH + 1),
                        start,
                        start,
                        weight,
                    )

    few = open_.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    value = F.struct("low", "high", "weight")
    near = open_.groupBy("doc_id", "mark").agg(F.collect_list(value).alias("spans"))
    near = _with_lists(rows, near, few, "inner")
    starts = staged(near.mapInArrow(in_pieces(single), SUFFIX))
    found = compared(starts)
    unstage(starts)
    repeats = whole.union(
        found.where("same2 AND weight = 1").select("doc_id", "mark", "low", "high")
    )
    # One list for each text, of its own places only, put together into spans at once.
    lists = repeats.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("low", "high")).alias("spans"))

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            offsets = column.offsets.to_numpy()
            flat = column.values
            low = flat.field("low").to_numpy().astype(np.int64)
            end = flat.field("high").to_numpy().astype(np.int64) + length
            lows, ends, sizes = [], [], []
            for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                order = np.argsort(low[a:b], kind="stable")
                first, last = low[a:b][order], np.maximum.accumulate(end[a:b][order])
                new = np.flatnonzero(np.r_[True, first[1:] > last[:-1]])
                lows.append(first[new])
                ends.append(last[np.r_[new[1:] - 1, len(last) - 1]])
                sizes.append(len(new))
            spans = pa.StructArray.from_arrays(
                [pa.array(np.concatenate(x)) for x in (lows, ends)], ["low", "high"]
            )
            bounds = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.ListArray.from_arrays(bounds, spans)], ["doc_id", "mark", "spans"]
            )

    covered = staged(
        lists.mapInArrow(cover, "doc_id long, mark long, spans array<struct<low:long,high:long>>")
    )
    unstage(sorted_, found)
    return covered


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the removed ``cuts``."""
    covered = repeated_bytes(docs, key, text, length)
    few = covered.select(F.sum(F.size("spans"))).first()[0] or 0
    joined = _with_lists(_documents(docs, key, text), covered, few <= BROADCAST_ROWS, "left")
    schema = (
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        "cuts array<struct<low:long,high:long>>"
    )

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, body in enumerate(batch.column(2).cast(pa.large_binary())):
                data = body.as_py()
                cuts = _bounds(batch.column(3), i, ("low", "high")).tolist()
                digest, at = hashlib.sha256(), 0
                for low, high in cuts:
                    digest.update(data[at:low])
                    at = high
                digest.update(data[at:])
                removed = sum(high - low for low, high in cuts)
                out.append((len(data), removed, len(cuts), digest.hexdigest(), [{"low": a, "high": b} for a, b in cuts]))
            columns = list(zip(*out, strict=True)) or [[]] * 5
            cut_type = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
            types = [pa.int64()] * 3 + [pa.string(), cut_type]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "cuts"],
            )

    return joined.mapInArrow(in_pieces(remove), schema)
