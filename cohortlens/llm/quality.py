"""Quality classifier: an additive model with pairwise terms over counts of a text.

Features of whole texts are array sums over bytes and words. Boosted shallow trees
give each feature a look-up table, and some pairs of features a grid, fitted on at
most ``SAMPLE_ROWS`` labelled texts, those whose keys hash lowest; a text's score is
the sum of what its bins hold. Labels, language, source and key are no inputs.

Defined cases: null and empty texts have all features 0 and get a score; a key with
several labels takes their majority, ties good; rows with a null label teach nothing;
without any label of both kinds every score is the smoothed share of good labels;
repeated rows score alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import in_pieces
from cohortlens.llm.boosting import AdditiveModel, fit_additive
from cohortlens.llm.textbytes import IS_SPACE, Texts, shingle_hash, slices

SAMPLE_ROWS = 40_000
GOOD_FROM = 0.3
FOLDS, HELD_OUT = 5, 0

_CLASSES = {
    "capitals": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digits": b"0123456789",
    "stops": b".,;:?!",
    "shouts": b"!?",
    "symbols": b"#*$%&|<>",
    "brackets": b"()[]{}\"'",
    "lines": b"\n",
    "other_signs": b"@+-/=\\^_`~",
}
FEATURES = (
    *_CLASSES,
    "log_words",
    "word_bytes",
    "long_words",
    "same_as_before",
    "distinct_words",
    "distinct_triples",
    "ends_in_stop",
    "sign_words",
    "equal_lines",
    "wide_bytes",
)
_TABLES = []
for _signs in _CLASSES.values():
    _one = np.zeros(256, bool)
    _one[list(_signs)] = True
    _TABLES.append(_one)
_STOPS, _LINE = _TABLES[2], _TABLES[6]
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_NOT_LINE = np.zeros(256, bool)
_NOT_LINE[10] = True


def _per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.r_[0, np.cumsum(values, dtype=np.int64)]
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _distinct(values: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and all values, counted per row."""
    order = np.lexsort((values, rows))
    v, r = values[order], rows[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    return np.bincount(r[new], minlength=n), np.bincount(r, minlength=n)


def features(part: Texts) -> np.ndarray:
    """One row of ``FEATURES`` for each text, shares of bytes, words or lines mostly."""
    n = len(part)
    size = np.maximum(np.diff(part.starts), 1)
    first, last, rows = part.words()
    words = np.bincount(rows, minlength=n)
    some = np.maximum(words, 1)
    out = [_per_row(table[part.data], part.starts) / size for table in _TABLES]
    length = last - first
    out += [np.log1p(words), np.bincount(rows, length, n) / some]
    out.append(np.bincount(rows, length > 20, n) / some)
    hashes = part.span_hash(first, last)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    out.append(np.bincount(rows, same, n) / some)
    distinct, _ = _distinct(hashes, rows, n)
    out.append(distinct / some)
    distinct, total = _distinct(*shingle_hash(hashes, rows, 3), n)
    out.append(distinct / np.maximum(total, 1))
    out.append(np.bincount(rows, _STOPS[part.data[last - 1]], n) / some)
    letters = np.r_[0, np.cumsum(_LETTER[part.data], dtype=np.int64)]
    signs = (letters[np.maximum(last - 1, first)] - letters[first]) < (length - 1)
    out.append(np.bincount(rows, signs | ((length == 1) & ~_LETTER[part.data[first]]), n) / some)
    first, last, rows = part.words(_NOT_LINE)
    spaces = np.r_[0, np.cumsum(IS_SPACE[part.data], dtype=np.int64)]
    full = spaces[last] - spaces[first] < last - first
    first, last, rows = first[full], last[full], rows[full]
    distinct, total = _distinct(part.span_hash(first, last), rows, n)
    out.append((total - distinct) / np.maximum(total, 1))
    out.append(_per_row(part.data >= 128, part.starts) / size)
    return np.stack(out, axis=1).astype(np.float64)


def fold(key, folds: int):
    """crc32 of the key as text, modulo ``folds``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def learned(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality"
) -> AdditiveModel:
    """The model of the labelled texts outside the held-out fold."""
    known = labels.select(F.col(key).alias("key"), F.col(label).alias("label"))
    known = known.where(F.col("key").isNotNull() & F.col("label").isNotNull())
    known = known.where(fold("key", FOLDS) != HELD_OUT).groupBy("key")
    known = known.agg((F.avg("label") >= 0.5).cast("double").alias("y"))
    known = known.orderBy(F.xxhash64("key"), "key").limit(SAMPLE_ROWS)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    # At most SAMPLE_ROWS pairs of numbers.
    rows = rows.join(F.broadcast(known), "key").select("text", "y")
    schema = "y double, " + ", ".join(f"{f} double" for f in FEATURES)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(0)):
                y = batch.column(1).slice(part.first_row, len(part))
                yield pa.RecordBatch.from_arrays(
                    [y, *map(pa.array, features(part).T)], ["y", *FEATURES]
                )

    # Rows that repeat a key could be many more than keys: the bound holds for both.
    table = rows.mapInArrow(in_pieces(counted), schema).limit(SAMPLE_ROWS).toArrow()
    x = np.stack([table[f].to_numpy() for f in FEATURES], axis=1)
    y = table["y"].to_numpy()
    order = np.lexsort((*x.T, y))  # the order in which tasks end must not matter
    return fit_additive(x[order], y[order])


def scored(
    docs: DataFrame, model: AdditiveModel, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: doc_id, held_out, score (0 to 1) and predicted (1 is good)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(fold(key, FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        F.col(text).alias("text"),
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [shared.value.score(features(part)) for part in slices(batch.column(2))]
            score = np.concatenate(values or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(score), pa.array((score >= GOOD_FROM).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return rows.mapInArrow(in_pieces(score), "doc_id long, held_out boolean, score double, predicted int")
