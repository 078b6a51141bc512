"""Benchmark decontamination: BM25 over test items, every training passage a query.

The inverted index holds the test items, cut into sections of at most
``SECTION_WORDS`` words; impacts are BM25 weights divided by the section's score for
itself, so that a passage holding a whole section scores 1. Items are few beside the
corpus, but no bound on them is assumed: they are indexed in shards of at most
``SHARD_BYTES`` of text, built in tasks with weights by the counts over all of them,
and every document is searched against each shard.

Texts are cut into overlapping passages of ``PASSAGE_WORDS`` words, so that every
section lies whole in one. Each is searched by block-max WAND, for many passages at a
time: a passage whose terms' greatest impacts cannot reach the threshold is passed
over; then item blocks whose greatest impacts for its terms cannot; only what is left
is scored. Everything at or above the threshold is retrieved. A retrieved section is
verified: enough of its question's word n-grams and of its answer's words must stand
in the passage.

Words are runs of letters and digits, A-Z in lower case. Defined cases: a null or
empty text matches nothing; an item without words is not indexed; an item's answer,
where no column gives it, is its last sentence if it has several; equal items each
match; repeated rows match alike; an empty table on either side gives no rows.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import in_pieces
from cohortlens.llm.textbytes import NOT_WORD, Texts, slices, text_bytes
from cohortlens.sources.staging import staged, unstage

SECTION_WORDS = 64
PASSAGE_WORDS = 128
BLOCK = 16  # sections that share an upper bound
SHARD_BYTES = 8 << 20
THRESHOLD = 0.5
K1, B = 1.2, 0.75
NGRAM = 5
QUESTION_SHARE = 0.6
ANSWER_SHARE = 0.6
RESULT = "doc_id long, item_id long, score double, question_share double, answer_share double"


def _word_hashes(part: Texts) -> tuple[np.ndarray, np.ndarray]:
    part = part.lowered()
    first, last, rows = part.words(NOT_WORD)
    return part.span_hash(first, last), rows


def words_of(text: str | None) -> np.ndarray:
    """Fingerprints of a text's words."""
    return _word_hashes(text_bytes(pa.array([text], pa.string())))[0]


def split_answer(text: str | None) -> tuple[str, str]:
    """Question and answer: the last sentence answers, if there are several."""
    sentences = [s for s in re.split(r"(?<=[.?!])\s+", text or "") if s.strip()]
    if len(sentences) < 2:
        return text or "", ""
    return " ".join(sentences[:-1]), sentences[-1]


@dataclass(frozen=True)
class Section:
    item: int
    words: np.ndarray
    question: np.ndarray
    answer: np.ndarray


def _ngrams(words: np.ndarray) -> set[bytes]:
    if len(words) < NGRAM:
        return {words.tobytes()} if len(words) else set()
    return {words[i : i + NGRAM].tobytes() for i in range(len(words) - NGRAM + 1)}


def sections(items: list[tuple[int, str, str]]) -> list[Section]:
    """Items (id, question, answer) in pieces of about equal length."""
    out = []
    for item, question, answer in items:
        q, a = words_of(question), words_of(answer)
        words = np.r_[q, a]
        parts = max(1, -(-len(words) // SECTION_WORDS))
        edges = [len(words) * k // parts for k in range(parts + 1)]
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            if high > low:
                cut = min(max(len(q), low), high)
                out.append(Section(item, words[low:high], words[low:cut], words[cut:high]))
    return out


@dataclass(frozen=True)
class Counts:
    """What BM25 needs of all sections: their number, mean length, and per word how many have it."""

    number: int
    mean: float
    having: dict[int, int]

    @staticmethod
    def of(parts: list[Section]) -> Counts:
        mean = float(np.mean([len(p.words) for p in parts])) if parts else 1.0
        return Counts(len(parts), mean, Counter(w for p in parts for w in set(p.words.tolist())))


class Index:
    """Postings of a shard's sections with per-block upper bounds.

    ``counts`` are those of the sections of all shards; without them, of these.
    """

    def __init__(self, parts: list[Section], counts: Counts | None = None):
        self.parts = parts
        counts = counts or Counts.of(parts)
        lengths = np.array([len(p.words) for p in parts], float)
        self.terms = np.unique(np.concatenate([np.zeros(0, np.uint64), *(p.words for p in parts)]))
        df = np.array([counts.having[int(t)] for t in self.terms], float)
        idf = np.log1p((counts.number - df + 0.5) / (df + 0.5))
        rows = []
        mean = counts.mean
        for number, part in enumerate(parts):
            word, tf = np.unique(part.words, return_counts=True)
            at = np.searchsorted(self.terms, word)
            weight = idf[at] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[number] / mean))
            rows.append((at, np.full(len(at), number), weight / weight.sum()))
        none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        term, section, impact = map(np.concatenate, zip(none, *rows, strict=True))
        order = np.lexsort((section, term))
        self.section, self.impact = section[order], impact[order]
        self.first = np.searchsorted(term[order], np.arange(len(self.terms) + 1))
        # The same by block of sections.
        block = self.section // BLOCK
        key = term[order] * (len(parts) // BLOCK + 1) + block
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
        self.block = block[new]
        self.block_max = np.maximum.reduceat(self.impact, new) if len(new) else self.impact
        self.first_block = np.searchsorted(term[order][new], np.arange(len(self.terms) + 1))
        self.bound = np.zeros(len(self.terms))
        np.maximum.at(self.bound, term, impact)

    def term_numbers(self, words: np.ndarray) -> np.ndarray:
        """Term of each word, -1 where it is in no section."""
        at = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        return np.where(self.terms[at] == words, at, -1)


def _spread(first: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each term's postings: which of ``terms`` and which posting."""
    counts = first[terms + 1] - first[terms]
    owner = np.repeat(np.arange(len(terms)), counts)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return owner, first[terms][owner] + inside


def _passages(rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, end word and row of the overlapping passages of each row."""
    step = PASSAGE_WORDS // 2
    counts = np.bincount(rows, minlength=n_rows)
    ends = np.cumsum(counts)
    n = np.where(counts > 0, np.maximum(1, -(-(counts - step) // step)), 0)
    row = np.repeat(np.arange(n_rows), n)
    number = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    first = (ends - counts)[row] + number * step
    return first, np.minimum(first + PASSAGE_WORDS, ends[row]), row


def retrieved(index: Index, words: np.ndarray, rows: np.ndarray, n_rows: int, threshold: float):
    """Every (passage start, end, row, section, score) that reaches the threshold."""
    if not len(index.terms) or not len(words):
        return []
    first, last, row = _passages(rows, n_rows)
    term = index.term_numbers(words)
    bound = np.r_[0.0, np.cumsum(np.where(term >= 0, index.bound[term], 0.0))]
    able = np.flatnonzero(bound[last] - bound[first] >= threshold - 1e-9)
    if not len(able):
        return []
    first, last, row = first[able], last[able], row[able]
    size = last - first
    passage = np.repeat(np.arange(len(first)), size)
    place = np.arange(len(passage)) - np.repeat(np.cumsum(size) - size, size) + first[passage]
    known = term[place] >= 0
    n_terms = len(index.terms)
    pair = np.unique(passage[known] * n_terms + term[place][known])
    passage, terms = pair // n_terms, pair % n_terms
    total = np.bincount(passage, index.bound[terms], len(first))
    live = total[passage] >= threshold - 1e-9
    passage, terms = passage[live], terms[live]
    n_blocks = len(index.parts) // BLOCK + 1
    owner, posting = _spread(index.first_block, terms)
    key, inverse = np.unique(passage[owner] * n_blocks + index.block[posting], return_inverse=True)
    best = np.bincount(inverse, index.block_max[posting], len(key))
    hopeful = key[best >= threshold - 1e-9]
    if not len(hopeful):
        return []
    live = np.isin(passage, hopeful // n_blocks)
    passage, terms = passage[live], terms[live]
    owner, posting = _spread(index.first, terms)
    section = index.section[posting]
    live = np.isin(passage[owner] * n_blocks + section // BLOCK, hopeful)
    owner, posting, section = owner[live], posting[live], section[live]
    key, inverse = np.unique(passage[owner] * len(index.parts) + section, return_inverse=True)
    score = np.bincount(inverse, index.impact[posting], len(key))
    hit = np.flatnonzero(score >= threshold - 1e-9)
    return [
        (int(first[p]), int(last[p]), int(row[p]), int(s), float(score[h]))
        for h, p, s in zip(hit, key[hit] // len(index.parts), key[hit] % len(index.parts), strict=True)
    ]


def verified(section: Section, passage: np.ndarray) -> tuple[float, float]:
    """Shares of the question's n-grams and of the answer's words that the passage has."""
    asked = _ngrams(section.question)
    if len(section.question) >= NGRAM:
        there = _ngrams(passage)
        question = len(asked & there) / len(asked)
    else:
        question = float(np.isin(section.question, passage).mean()) if len(asked) else 1.0
    answer = np.unique(section.answer)
    return question, float(np.isin(answer, passage).mean()) if len(answer) else 1.0


def _shards(items: DataFrame, item: str, question: str, answer: str | None) -> Iterator[Index]:
    """The indexes of all shards, one after another.

    Items are cut, their words counted and the indexes built in tasks; the weights in
    every index are by the counts over all shards, so scores are the same however many
    there are. Of an index no more than ``SHARD_BYTES`` of text passes the driver.
    """
    rows = items.select(
        F.col(item).cast("long").alias("item"),
        F.col(question).alias("question"),
        (F.col(answer) if answer else F.lit(None).cast("string")).alias("answer"),
    ).where("item IS NOT NULL")
    bytes_ = F.octet_length(F.concat_ws(" ", "question", "answer"))
    total = rows.agg(F.sum(bytes_)).first()[0] or 0
    n = max(1, -(-total // SHARD_BYTES))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("item", "question"), F.lit(n)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for own, asked, told, shard in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                pair = (asked or "", told or "") if answer else split_answer(asked)
                for k, s in enumerate(sections([(own, *pair)])):
                    out.append((shard, own, k, s.words.view(np.int64), len(s.question)))
            columns = zip(*out, strict=True) if out else [[]] * 5
            types = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64()]
            names = ["shard", "item", "place", "words", "cut"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names
            )

    schema = "shard long, item long, place long, words array<long>, cut long"
    parts = staged(rows.mapInArrow(cut, schema))
    sums = parts.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size("words")).alias("mean")).first()
    words = parts.select("shard", F.explode(F.array_distinct("words")).alias("word"))
    having = words.groupBy("word").agg(F.count(F.lit(1)).alias("having"))
    terms = words.distinct().join(having, "word").select(F.col("shard").alias("own"), "word", "having")

    def build(own: pa.Table, terms: pa.Table) -> pa.Table:
        own = own.sort_by([("item", "ascending"), ("place", "ascending"), ("cut", "ascending")])
        listed = []
        for item, words, cut in zip(*(own[c].to_pylist() for c in ("item", "words", "cut")), strict=True):
            words = np.array(words, np.int64).view(np.uint64)
            listed.append(Section(item, words, words[:cut], words[cut:]))
        word = np.array(terms["word"].to_pylist(), np.int64).view(np.uint64)
        counts = Counts(sums.n, sums.mean, dict(zip(word.tolist(), terms["having"].to_pylist(), strict=True)))
        index = pickle.dumps(Index(listed, counts))
        return pa.table({"shard": own["shard"].slice(0, 1), "index": pa.array([index], pa.binary())})

    paired = parts.groupBy("shard").cogroup(terms.groupBy("own"))
    built = staged(paired.applyInArrow(build, "shard long, index binary"))
    unstage(parts)
    for shard in range(n):
        found = built.where(F.col("shard") == shard).first()
        yield pickle.loads(found["index"]) if found else Index([])
    unstage(built)


def _found(index: Index, column: pa.Array, threshold: float) -> dict[tuple[int, int], tuple[float, float, float]]:
    """Best score and shares by row of ``column`` and item found in it."""
    best: dict[tuple[int, int], tuple[float, float, float]] = {}
    for part in slices(column):
        words, of = _word_hashes(part)
        for low, high, row, s, score in retrieved(index, words, of, len(part), threshold):
            section = index.parts[s]
            shares = verified(section, words[low:high])
            if shares[0] >= QUESTION_SHARE and shares[1] >= ANSWER_SHARE:
                at = (part.first_row + row, section.item)
                best[at] = max(best.get(at, (0.0, 0.0, 0.0)), (score, *shares))
    return best


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    question: str = "text",
    answer: str | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per text and item found in it: best score and shares of question and answer."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = None
    for index in _shards(items, item, question, answer):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                best = _found(index, batch.column(1), threshold)
                ids = batch.column(0).take(pa.array([r for r, _ in best], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([i for _, i in best], pa.int64())]
                    + [pa.array([v[k] for v in best.values()], pa.float64()) for k in range(3)],
                    ["doc_id", "item_id", "score", "question_share", "answer_share"],
                )

        one = rows.mapInArrow(in_pieces(search), RESULT)
        found = one if found is None else found.union(one)
    return found


def uncontaminated(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item: str = "item_id",
    question: str = "text",
    answer: str | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of ``docs`` in whose text no item is found, each judged by itself, whatever its key."""
    before = None
    for number, index in enumerate(_shards(items, item, question, answer)):
        if number:  # one index at a time in a task; what is left is written in between
            docs = staged(docs)
            if before is not None:
                unstage(before)
            before = docs
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def clean(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kept = np.ones(batch.num_rows, bool)
                kept[[r for r, _ in _found(shared.value, batch.column(0), threshold)]] = False
                yield batch.filter(pa.array(kept))

        rows = docs.select(F.col(text).alias("text"), F.struct(*docs.columns).alias("row"))
        docs = rows.mapInArrow(in_pieces(clean), rows.schema).select("row.*")
    return docs
