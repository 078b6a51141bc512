"""Language of each word and text: script ranges, n-gram scores, Viterbi.

A word's bytes tell its script; only languages seen in that script are candidates. A
word's score in a language is the sum of log probabilities of its three-byte windows,
counted over every text of known language. Viterbi with a penalty for switching then
labels the words, so that spans of mixed-language text come out; a text's language is
that of most of its letters.

The counts are a table of ``SLOTS`` per language, whatever the corpus; each task sums
its own before anything is shuffled. Defined cases: texts that are null or have no
letter are ``und`` with score 0; texts of null language teach nothing; with nothing
learned all are ``und``; ties go to the language first by name; repeated rows are
labelled alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import in_pieces
from cohortlens.llm.quality import fold
from cohortlens.llm.textbytes import LOWER, Texts, slices

UNKNOWN = "und"
SLOTS = 1 << 16
SWITCH = 12.0  # log probability lost where the language changes
SCRIPT_SHARE = 0.005  # of a language's words, for it to be a candidate in a script
SMOOTHING = 0.5
FOLDS, HELD_OUT = 3, 1

#: Scripts by the first byte of a letter's UTF-8 form: Latin, Greek, Cyrillic with Armenian,
#: Hebrew, Arabic and its neighbours, Indic and South-East Asian, other, East Asian, Korean, rare.
_RANGES = [
    (65, 90), (97, 122), (0xC2, 0xCB), (0xCC, 0xCF), (0xD0, 0xD5), (0xD6, 0xD7), (0xD8, 0xDF),
    (0xE0, 0xE1), (0xE2, 0xE2), (0xE3, 0xE9), (0xEA, 0xEF), (0xF0, 0xF4),
]
_SCRIPT = np.zeros(256, np.uint8)
for _number, (_low, _high) in enumerate(_RANGES):
    _SCRIPT[_low : _high + 1] = max(1, _number - 1)
N_SCRIPTS = int(_SCRIPT.max()) + 1
_GAP = np.ones(256, bool)
_GAP[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _slots(part: Texts) -> np.ndarray:
    """The slot of the three-byte window about each byte; bytes that are no letters are 0."""
    letters = np.where(_GAP[part.data], 0, LOWER[part.data]).astype(np.uint32)
    n = len(letters)
    before, after = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
    before[1:], after[:-1] = letters[:-1], letters[1:]
    inner = part.starts[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    before[inner] = 0
    after[inner - 1] = 0
    value = before | (letters << np.uint32(8)) | (after << np.uint32(16))
    return ((value * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.int64)


def _word_scripts(part: Texts, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    kinds = _SCRIPT[part.data]
    if not len(first):
        return np.zeros(0, np.uint8)
    edges = np.empty(2 * len(first), np.int64)
    edges[0::2], edges[1::2] = first, last
    closed = np.r_[kinds, np.uint8(0)]
    return np.maximum.reduceat(closed, edges)[0::2]


@dataclass
class Languages:
    names: list[str]
    scores: np.ndarray  # slot × language: log probabilities
    allowed: np.ndarray  # script × language

    def words(self, part: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Each word's start, end, row, and score in every language."""
        first, last, rows = part.words(_GAP)
        slots = _slots(part)
        scripts = _word_scripts(part, first, last)
        out = np.empty((len(first), len(self.names)), np.float64)
        for j in range(len(self.names)):
            sums = np.r_[0.0, np.cumsum(self.scores[:, j][slots], dtype=np.float64)]
            out[:, j] = sums[last] - sums[first]
            out[~self.allowed[scripts, j], j] -= 1e6
        return first, last, rows, out


def viterbi(scores: np.ndarray, rows: np.ndarray, n_rows: int, penalty: float = SWITCH) -> np.ndarray:
    """The best language of every word of each row: all rows at once, word by word."""
    counts = np.bincount(rows, minlength=n_rows)
    starts = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    starts, counts = starts[order], counts[order]
    label = np.zeros(len(scores), np.int64)
    if not len(scores):
        return label
    # Where the best way to a word's language comes from another language, and from which.
    switched = np.zeros(scores.shape, bool)
    origin = np.zeros(len(scores), np.int64)
    active = len(counts) - np.searchsorted(counts[::-1], np.arange(counts[0]), side="right")
    value = scores[starts[: active[0]]]
    for t in range(1, counts[0]):
        k = active[t]
        at = starts[:k] + t
        value = value[:k]
        best = value.argmax(1)
        change = (value[np.arange(k), best] - penalty)[:, None]
        switched[at] = change > value
        origin[at] = best
        value = np.maximum(value, change) + scores[at]
        ended = np.flatnonzero(counts[:k] == t + 1)
        label[at[ended]] = value[ended].argmax(1)
    single = np.flatnonzero(counts == 1)
    label[starts[single]] = scores[starts[single]].argmax(1)
    for t in range(counts[0] - 1, 0, -1):
        at = starts[: active[t]] + t
        own = label[at]
        label[at - 1] = np.where(switched[at, own], origin[at], own)
    return label


def learned(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Languages:
    """Window counts of every text of known language outside the held-out fold."""
    known = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.col(key).alias("key"))
    known = known.where("lang IS NOT NULL AND text IS NOT NULL")
    known = known.where(F.coalesce(fold("key", FOLDS) != HELD_OUT, F.lit(False)))
    known = known.select("lang", "text")

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, np.ndarray] = {}

        def listed(lang: str, own: np.ndarray) -> pa.RecordBatch:
            at = np.flatnonzero(own)
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(own[at])],
                ["lang", "slot", "n"],
            )

        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), object)
            for part in slices(batch.column(1)):
                own = names[part.first_row : part.first_row + len(part)]
                first, last, rows = part.words(_GAP)
                slots = _slots(part)
                scripts = _word_scripts(part, first, last)
                row = np.repeat(np.arange(len(part)), np.diff(part.starts))
                inside = ~_GAP[part.data]
                for name in set(own.tolist()):
                    picked = own == name
                    found = np.bincount(slots[inside & picked[row]], minlength=SLOTS)
                    kinds = np.bincount(scripts[picked[rows]], minlength=N_SCRIPTS)
                    kept[name] = kept.get(name, 0) + np.r_[found, kinds]
            if len(kept) > 64:  # many languages: pass on what there is
                for name in sorted(kept):
                    yield listed(name, kept.pop(name))
        for name in sorted(kept):
            yield listed(name, kept[name])

    seen = known.mapInArrow(in_pieces(counts), "lang string, slot long, n long")
    table = seen.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(table["lang"].to_pylist()))
    total = np.zeros((SLOTS + N_SCRIPTS, len(names)))
    column = np.searchsorted(np.array(names, object), np.array(table["lang"].to_pylist(), object))
    total[table["slot"].to_numpy(), column] = table["n"].to_numpy()
    grams, scripts = total[:SLOTS] + SMOOTHING, total[SLOTS:]
    share = scripts / np.maximum(scripts.sum(0), 1)
    return Languages(names, np.log(grams / grams.sum(0)), share >= SCRIPT_SHARE)


def spans(part: Texts, model: Languages) -> Iterator[tuple[int, int, int, int]]:
    """Row, first byte, end byte and language number of each run of words of one language."""
    first, last, rows, scores = model.words(part)
    label = viterbi(scores, rows, len(part))
    new = np.flatnonzero(np.r_[True, (label[1:] != label[:-1]) | (rows[1:] != rows[:-1])][: len(label)])
    ends = np.r_[new[1:], len(label)] if len(new) else new
    for a, b in zip(new.tolist(), ends.tolist(), strict=True):
        row = int(rows[a])
        yield row, int(first[a] - part.starts[row]), int(last[b - 1] - part.starts[row]), int(label[a])


def _with_letter(part: Texts, words: np.ndarray) -> np.ndarray:
    """Rows that have a letter; only those without an ASCII one are looked at singly."""
    plain = np.zeros(256, np.int64)
    plain[[*range(65, 91), *range(97, 123)]] = 1
    sums = np.r_[0, np.cumsum(plain[part.data])]
    sure = sums[part.starts[1:]] > sums[part.starts[:-1]]
    for i in np.flatnonzero(~sure & (words > 0)):
        body = part.data[part.starts[i] : part.starts[i + 1]].tobytes().decode("utf-8", "replace")
        sure[i] = any(c.isalpha() for c in body)
    return sure


def identified(docs: DataFrame, model: Languages, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score (its share of the letters) and spans."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(fold(key, FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        F.col(text).alias("text"),
    )
    schema = "doc_id long, held_out boolean, lang_pred string, score double, n_spans long"

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = np.array([*model.names, UNKNOWN], object)
        for batch in batches:
            for part in slices(batch.column(2)):
                n = len(part)
                weight = np.zeros((n, len(model.names) + 1))
                n_spans = np.zeros(n, np.int64)
                known = np.zeros(n, bool)
                if model.names:
                    first, last, rows, scores = model.words(part)
                    own = viterbi(scores, rows, n)
                    np.add.at(weight, (rows, own), last - first)
                    new = np.ones(len(own), bool)
                    new[1:] = (own[1:] != own[:-1]) | (rows[1:] != rows[:-1])
                    n_spans = np.bincount(rows[new], minlength=n)
                    known = _with_letter(part, np.bincount(rows, minlength=n))
                best = np.where(known, weight.argmax(1), len(model.names))
                share = weight.max(1) / np.maximum(weight.sum(1), 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.slice(part.first_row, n) for c in batch.columns[:2]),
                        pa.array(names[best].tolist(), pa.string()),
                        pa.array(np.where(known, share, 0.0)),
                        pa.array(n_spans),
                    ],
                    ["doc_id", "held_out", "lang_pred", "score", "n_spans"],
                )

    return rows.mapInArrow(in_pieces(label), schema)
