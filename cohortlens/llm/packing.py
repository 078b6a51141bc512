"""Packing texts into windows by non-negative least squares over length combinations.

A text's ids are cut at multiples of the window; whole windows need no packing. The
rest of each text, its tail, has a class: its length in units of ``UNIT`` ids, rounded
up. The histogram of classes, one count per class whatever the corpus, is all that
reaches the driver. There every combination of up to three classes that fills a window
exactly is enumerated, non-negative least squares finds how often to use each, the
counts are rounded down to what the histogram allows, and the tails left over are
packed greedily: laid one after another and cut where a window is full.

Tails meet their places by rank within their class. Ranks are counted within slices of
keys, with the counts of earlier slices added, so that a class holding a third of all
rows is not ranked in one task.

Padding is less than ``3 * UNIT`` ids in a window of a combination and none elsewhere
but in the last window. Defined cases: null is the empty text, which is its end id
alone; repeated rows are packed each; keys may be null; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm import in_pieces
from cohortlens.llm.tokens import VOCABULARY, encoded_slices
from cohortlens.sources.staging import staged, unstage

WINDOW = 2048
UNIT = 8
END_ID = 1
SLICE_ROWS = 100_000  # rows of a slice in which ranks are counted
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, class int, "
    "tail binary, own long"
)


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The x >= 0 with least |a x - b|, by the active-set method."""
    x = np.zeros(a.shape[1])
    used = np.zeros(a.shape[1], bool)
    slope = a.T @ b
    ridge = 1e-9 * max(1.0, float(np.abs(a).max(initial=0)) ** 2)  # combinations may be dependent
    small = 1e-6 * max(1.0, float(np.abs(b).max(initial=0)))
    for _ in range(3 * a.shape[1]):
        waiting = np.where(used, -np.inf, slope)
        pick = int(waiting.argmax())
        if waiting[pick] <= small or used.sum() >= a.shape[0]:
            break
        used[pick] = True
        while True:
            at = np.flatnonzero(used)
            own = a[:, at]
            trial = np.linalg.solve(own.T @ own + ridge * np.eye(len(at)), own.T @ b)
            if trial.min() > 0:
                break
            falling = trial <= 0
            step = np.min(x[at][falling] / np.maximum(x[at][falling] - trial[falling], 1e-300))
            x[at] += step * (trial - x[at])
            used[at[x[at] <= 1e-12 * max(1.0, x.max())]] = False
            x[~used] = 0
            if not used.any():
                break
        x[:] = 0
        x[at] = np.maximum(trial, 0)
        slope = a.T @ (b - a[:, at] @ x[at])
    return x


def combinations(classes: int) -> list[tuple[int, ...]]:
    """All ways to fill ``classes`` units with two or three classes, larger ones first."""
    pairs = [(classes - b, b) for b in range(1, classes // 2 + 1)]
    triples = [
        (classes - b - c, b, c)
        for c in range(1, classes // 3 + 1)
        for b in range(c, (classes - c) // 2 + 1)
    ]
    return pairs + triples


@dataclass
class Plan:
    """Where tails go: of class ``c``, ranks from ``low`` to ``high`` fill slot ``slot`` of
    windows ``base`` onwards; ranks from ``left[c]`` are left over."""

    segments: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    left: dict[int, int] = field(default_factory=dict)
    windows: int = 0


def plan(histogram: dict[int, int], classes: int = WINDOW // UNIT) -> Plan:
    """Combinations, their counts, and what is left, from tails per class."""
    out = Plan(left={c: 0 for c in histogram})
    h = np.zeros(classes + 1)
    for c, n in histogram.items():
        h[c] = n
    ways = [w for w in combinations(classes) if all(h[c] > 0 for c in w)]
    if not ways:
        return out
    a = np.zeros((classes + 1, len(ways)))
    for j, way in enumerate(ways):
        for c in way:
            a[c, j] += 1
    scale = h.max()
    counts = nonnegative_least_squares(a, h / scale) * scale
    there = {c: int(n) for c, n in histogram.items()}
    for j in np.argsort(-counts, kind="stable"):
        need = {c: ways[j].count(c) for c in ways[j]}
        n = min(int(counts[j]), *(there[c] // k for c, k in need.items()))
        if n > 0:
            for slot, c in enumerate(ways[j]):
                low = out.left[c]
                out.segments.append((c, low, low + n, slot, out.windows))
                out.left[c] += n
                there[c] -= n
            out.windows += n
    return out


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def encoded(docs: DataFrame, key: str, text: str, vocabulary: str) -> DataFrame:
    """Whole windows and tails of every text; a tail's ids come along in two-byte or wider ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            for part, flat, bounds in encoded_slices(batch.column(1), vocabulary):
                row, start, size, crc, total, tails = [], [], [], [], [], []
                for i, (low, high) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
                    ids = np.append(flat[low:high], flat.dtype.type(END_ID))
                    for at in range(0, len(ids), WINDOW):
                        own = ids[at : at + WINDOW]
                        row.append(part.first_row + i)
                        start.append(at)
                        size.append(len(own))
                        crc.append(_crc(own))
                        total.append(len(ids))
                        tails.append(own.tobytes() if len(own) < WINDOW else None)
                length = np.array(size, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        keys.take(pa.array(row, pa.int64())),
                        *(pa.array(x, pa.int64()) for x in (start, length, crc, total)),
                        pa.array(-(-length // UNIT), pa.int32()),
                        pa.array(tails, pa.binary()),
                        pa.array(np.arange(len(row)) * 0 + flat.dtype.itemsize, pa.int64()),
                    ],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", "tail", "own"],
                )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(in_pieces(cut), PIECES)


def _ranked(pieces: DataFrame, by: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """``name``: the sum of ``value`` over earlier rows with the same ``by``, through slices."""
    within = Window.partitionBy(*by, "slice").orderBy(*order)
    running = F.sum(value).over(within.rowsBetween(Window.unboundedPreceding, -1))
    sums = pieces.groupBy(*by, "slice").agg(F.sum(value).alias("total"))
    before = Window.partitionBy(*by).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*by, "slice", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    placed = pieces.withColumn("inner", F.coalesce(running, F.lit(0)))
    return (
        placed.join(sums, [*by, "slice"])
        .withColumn(name, F.col("inner") + F.col("base"))
        .drop("inner", "base")
    )


def packed(
    docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY
) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    raw = staged(encoded(docs, key, text, vocabulary))
    rows = raw.agg(F.count(F.lit(1)), F.max("own")).first()
    n_slices = max(1, -(-rows[0] // SLICE_ROWS))
    dtype = np.uint16 if rows[1] == 2 else np.uint32
    order = ["doc_id", "start", "ids_crc32", "doc_tokens", "length"]
    pieces = raw.drop("own").withColumn(
        "slice", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "length"), F.lit(n_slices)).cast("long")
    )
    pieces = _ranked(pieces.withColumn("one", F.lit(1).cast("long")), ["class"], order, "one", "rank")
    pieces = staged(pieces.drop("one"))
    full = WINDOW // UNIT
    # A tail of almost a window shares its class with the whole windows.
    found = {r["class"]: r["count"] for r in pieces.groupBy("class").count().collect()}
    made = plan({c: n for c, n in found.items() if c < full})
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    whole = pieces.where(F.col("class") == full).select(
        *names[:5],
        (F.col("rank") + made.windows).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    # At most a few hundred combinations of three classes each, whatever the corpus.
    segments = spark.createDataFrame(
        made.segments or [(-1, 0, 0, 0, 0)], "class int, low long, high long, slot int, first long"
    )
    combined = pieces.join(F.broadcast(segments), "class").where("rank >= low AND rank < high")
    combined = combined.withColumn("sequence_id", F.col("first") + F.col("rank") - F.col("low"))
    beside = Window.partitionBy("sequence_id").orderBy("slot")
    earlier = F.sum("length").over(beside.rowsBetween(Window.unboundedPreceding, -1))
    combined = combined.select(
        *names[:5], "sequence_id", F.coalesce(earlier, F.lit(0)).cast("long").alias("offset")
    )

    limits = spark.createDataFrame(
        list(made.left.items()) or [(-1, 0)], "class int, from_rank long"
    )
    left = pieces.join(F.broadcast(limits), "class").where("rank >= from_rank")
    left = left.withColumn("all", F.lit(1))
    laid = _ranked(left, ["all"], ["class", *order, "rank"], "length", "place")
    first = F.expr(f"place div {WINDOW}")
    last = F.expr(f"(place + length - 1) div {WINDOW}")
    cut = laid.withColumn("window", F.explode(F.sequence(first, last)))
    cut = cut.withColumn("low", F.greatest(F.col("window") * WINDOW - F.col("place"), F.lit(0)))
    cut = cut.withColumn(
        "high", F.least((F.col("window") + 1) * WINDOW - F.col("place"), F.col("length"))
    )

    @F.pandas_udf("long")
    def crc_of(tail: pd.Series, low: pd.Series, high: pd.Series) -> pd.Series:
        return pd.Series(
            [_crc(np.frombuffer(t, dtype)[a:b]) for t, a, b in zip(tail, low, high, strict=True)], dtype="int64"
        )

    base = made.windows + found.get(full, 0)
    cut = cut.select(
        "doc_id",
        (F.col("start") + F.col("low")).alias("start"),
        (F.col("high") - F.col("low")).alias("length"),
        crc_of("tail", "low", "high").alias("ids_crc32"),
        "doc_tokens",
        (F.col("window") + base).alias("sequence_id"),
        (F.col("place") + F.col("low") - F.col("window") * WINDOW).alias("offset"),
    )
    unstage(raw)
    return whole.unionByName(combined).unionByName(cut)


def sequences(
    pieces: DataFrame,
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """The packed ids themselves: per sequence its ids in order, for keys that are unique."""

    def all_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, flat, bounds in encoded_slices(batch.column(1), vocabulary):
                rows = [
                    np.append(flat[a:b], flat.dtype.type(END_ID)).astype(np.int32)
                    for a, b in zip(bounds[:-1], bounds[1:], strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first_row, len(part)),
                        pa.array(rows, pa.list_(pa.int32())),
                    ],
                    ["doc_id", "ids"],
                )

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    ids = rows.mapInArrow(in_pieces(all_ids), "doc_id long, ids array<int>")
    own = F.slice("ids", (F.col("start") + 1).cast("int"), F.col("length").cast("int"))
    placed = pieces.join(ids, "doc_id").select("sequence_id", "offset", own.alias("ids"))
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(
        F.flatten(F.transform(ordered, lambda x: x["ids"])).alias("ids")
    )
