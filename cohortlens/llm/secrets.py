"""Secrets in texts: fixed patterns, and guess cost of values in credential contexts.

Three base patterns name spans of kinds ``assign``, ``access`` and ``hex``. Besides,
a value that stands where a credential would (after ``pwd:``, ``login =``, in
``scheme://user:value@host`` and the like) becomes a span of kind ``guess`` if no one
base span contains all of it and guessing it is dear. The cost is the least, over all ways to cut
the value into known words, dates, repeats, keyboard walks and brute-force characters,
of the sum of the pieces' decimal logarithms of guesses, found by dynamic programming.
Known words are a fixed list and, after them, at most ``LISTED_WORDS`` words that most
of the documents have (those of equal count together or not at all), counted outside of credential values, so that a secret's copies
never make it a word. Nothing but the cost decides, be the value of letters only.

A span is a whole base match, or the value alone for ``guess``; places are code
points, the end exclusive. Defined cases: null is the empty text, which has no span;
equal rows get equal spans; long values are costed whole; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import in_pieces
from cohortlens.llm.textbytes import slices
from cohortlens.sources.staging import staged, unstage

KINDS = ("assign", "access", "hex", "guess")
ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_FROM, ACCESS_FROM, HEX_FROM = 12, 18, 16
CONTEXT = re.compile(
    r"""(?i:(?:pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|api[_-]?key|access[_-]?key"""
    r"""|login|credentials?|auth))["']?\x20*[:=]\x20*["']?([^\s"',;<>]{6,})""",
    re.ASCII,
)
USERINFO = re.compile(r"://[^\s/:@]+:([^\s/@]{6,})@")
KEYWORDS = ("pass", "pwd", "pin", "secret", "token", "key", "login", "credential", "auth", "://")

#: Frequent parts of passwords, the most frequent first.
COMMON = (
    "password", "qwerty", "welcome", "admin", "letmein", "monkey", "dragon", "master", "login",
    "hello", "secret", "example", "changeme", "default", "test", "user", "guest", "root", "love",
    "iloveyou", "sunshine", "princess", "football", "baseball", "shadow", "superman", "batman",
    "trustno", "access", "summer", "winter", "spring", "autumn", "monday", "friday", "january",
    "october", "house", "green", "black", "white", "orange", "purple", "silver", "golden", "cookie",
    "cheese", "coffee", "computer", "internet", "samsung", "google", "apple", "your", "my", "the",
    "here", "value", "token", "key", "api", "none", "null", "true", "false", "placeholder",
)
WORD_COST = {word: math.log10(rank + 2) for rank, word in enumerate(COMMON)}
#: Words counted over the documents: how many are listed, of which sizes, in how many rows at least.
LISTED_WORDS, LISTED_SIZES, LISTED_ROWS = 50_000, range(4, 25), 2
LONGEST_WORD = LISTED_SIZES[-1]
WORD = re.compile(r"[^\W\d_]+")
#: Rows of keys that lie side by side, and letter and digit order.
WALKS = (
    "`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./", "abcdefghijklmnopqrstuvwxyz",
)
LEET = str.maketrans("@430157$", "aaeoists")
STEPS = {a + b for row in WALKS for a, b in zip(row[:-1], row[1:], strict=True)}
STEPS |= {b + a for a, b in map(tuple, STEPS)}
DATE = re.compile(r"(?:\d{1,4}([-/._])\d{1,2}\1\d{1,4}|(?:19|20)\d{6}|\d{4}(?:19|20)\d{2})")
YEAR = re.compile(r"(?:19|20)\d\d")
DATE_COST, YEAR_COST = math.log10(365 * 120), math.log10(120)
PIECE_COST = math.log10(2)
DEAR_FROM = 8.0  # decimal logarithm of guesses


def _brute(c: str) -> float:
    size = 10 if c.isdigit() else 26 if c.isalpha() else 33
    return math.log10(size)


def _runs(text: str, joined) -> list[int]:
    """Per place, the end of the longest run from it in which neighbours are ``joined``."""
    ends = [0] * len(text)
    for i in range(len(text) - 1, -1, -1):
        more = i + 1 < len(text) and joined(text[i], text[i + 1])
        ends[i] = ends[i + 1] if more else i + 1
    return ends


def _unit_repeats(text: str) -> dict[int, list[tuple[int, int]]]:
    """Per place, units (size, times) of two or more characters that follow one another from it."""
    n, found = len(text), {}
    for size in range(2, min(LONGEST_WORD, n // 2) + 1):
        same = 0  # characters from a place on that equal those a unit further
        for i in range(n - size - 1, -1, -1):
            same = same + 1 if text[i] == text[i + size] else 0
            if same >= size and len(set(text[i : i + size])) > 1:
                found.setdefault(i, []).append((size, same // size + 1))
    return found


def guess_cost(value: str, listed: dict[str, float] = WORD_COST) -> float:
    """Decimal logarithm of the guesses that the cheapest segmentation takes."""
    low = value.lower()
    plain = low.translate(LEET)
    n = len(value)
    best = [0.0] + [math.inf] * n
    repeats = _runs(low, lambda a, b: a == b) if len(low) == n else list(range(1, n + 1))
    walks = _runs(low, lambda a, b: a + b in STEPS) if len(low) == n else list(range(1, n + 1))
    again = _unit_repeats(low) if len(low) == n else {}
    for i in range(n):
        here = best[i] + (PIECE_COST if i else 0.0)

        def offer(end: int, cost: float) -> None:
            best[end] = min(best[end], cost)

        offer(i + 1, best[i] + _brute(value[i]))
        for end in range(i + 2, min(n, i + LONGEST_WORD) + 1):
            cost = listed.get(plain[i:end])
            if cost is not None:
                changed = (value[i:end] != low[i:end]) + (low[i:end] != plain[i:end])
                offer(end, here + cost + changed * PIECE_COST)
        if repeats[i] - i > 2:
            offer(repeats[i], here + _brute(value[i]) + math.log10(repeats[i] - i))
        for size, times in again.get(i, ()):
            offer(i + size * times, here + guess_cost(value[i : i + size], listed) + math.log10(times))
        if walks[i] - i > 2:
            offer(walks[i], here + math.log10(47 * (walks[i] - i)))
        if value[i].isdigit():
            date, year = DATE.match(value, i), YEAR.match(value, i)
            if date:
                offer(date.end(), here + DATE_COST)
            if year:
                offer(year.end(), here + YEAR_COST)
    return best[n]


def base_spans(text: str, hex_too: bool = True) -> list[tuple[str, int, int]]:
    """Spans of the base patterns, by kind."""
    out = []
    low = text.lower()
    if (":" in text or "=" in text) and any(k in low for k in ("passw", "secret", "token", "key")):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_FROM:
                out.append(("assign", *m.span()))
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_FROM]
    if hex_too:
        out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return out


def credentials(text: str) -> list[tuple[int, int]]:
    """Places of the values in credential contexts, each once."""
    if not (":" in text or "=" in text):
        return []
    low = text.lower()
    if not any(k in low for k in KEYWORDS):
        return []
    found = [m for pattern in (CONTEXT, USERINFO) for m in pattern.finditer(text)]
    return list(dict.fromkeys((m.start(1), m.start(1) + len(m[1].rstrip(".,:;!?)]}"))) for m in found))


def found_spans(
    text: str, hex_too: bool = True, listed: dict[str, float] = WORD_COST
) -> list[tuple[str, int, int]]:
    """All spans by start, then kind as listed."""
    base = base_spans(text, hex_too)
    out = list(base)
    for start, end in credentials(text):
        if any(s <= start and end <= e for _, s, e in base):
            continue
        if guess_cost(text[start:end], listed) >= DEAR_FROM:
            out.append(("guess", start, end))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span, overlapping ones together, put as ``[SECRET]``."""
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


_HEX_BYTE = np.zeros(256, bool)
_HEX_BYTE[[*range(48, 58), *range(97, 103)]] = True


def _rows_with_hex(column: pa.Array) -> np.ndarray:
    """Rows with a run of sixteen or more hexadecimal digits."""
    out = np.zeros(len(column), bool)
    for part in slices(column):
        sums = np.r_[0, np.cumsum(_HEX_BYTE[part.data], dtype=np.int32)]
        full = np.flatnonzero(sums[HEX_FROM:] - sums[:-HEX_FROM] == HEX_FROM)
        out[part.first_row + np.unique(part.row_of(full))] = True
    return out


def words_outside(text: str) -> set[str]:
    """A text's words, in lower case, that stand outside of credential values."""
    at, kept = 0, []
    for start, end in sorted(credentials(text)):
        kept.append(text[at:start])
        at = max(at, end)
    kept.append(text[at:])
    words = {w for part in kept for w in set(WORD.findall(part.lower()))}
    return {w for w in words if len(w) in LISTED_SIZES}


def word_costs(docs: DataFrame, text: str = "text") -> dict[str, float]:
    """The fixed words' costs, and after them those of the words in most rows of ``docs``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = Counter(w for body in batch.column(0).to_pylist() if body for w in words_outside(body))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["word", "n"]
            )

    counts = docs.select(F.col(text).alias("text")).mapInArrow(in_pieces(count), "word string, n long")
    rows = counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LISTED_ROWS)
    rows = staged(rows)
    # The least count that no more than the listed words reach, from a histogram of the counts:
    # only those words come to the driver.
    least, total = LISTED_ROWS, 0
    for n, words in sorted(rows.groupBy("n").count().collect(), reverse=True):
        total += words
        if total > LISTED_WORDS:
            least = n + 1
            break
    most = sorted(rows.where(F.col("n") >= least).collect(), key=lambda r: (-r.n, r.word))
    unstage(rows)
    ranked = {r.word: math.log10(len(COMMON) + rank + 2) for rank, r in enumerate(most)}
    return ranked | WORD_COST


def scanned(docs: DataFrame, key: str = "doc_id", text: str = "text", carry: str | None = None) -> DataFrame:
    """Per row: its key, ``spans``, digests, counts and ``redacted`` (null if unchanged)."""
    schema = (
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, "
        "redacted string"
    )
    columns = [F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")]
    rows = docs.select(*columns, *([F.col(carry)] if carry else []))
    if carry:
        schema += f", {carry} {docs.schema[carry].dataType.simpleString()}"
    shared = docs.sparkSession.sparkContext.broadcast(word_costs(docs, text))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            with_hex = _rows_with_hex(batch.column(1))
            counts = np.zeros((3, len(with_hex)), np.int64)
            digests, listed, redacted = [], [], []
            for i, body in enumerate(batch.column(1).to_pylist()):
                spans = found_spans(body or "", bool(with_hex[i]), shared.value)
                base = [s for s in spans if s[0] != "guess"]
                for kind, _, _ in base:
                    counts[KINDS.index(kind), i] += 1
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                listed.append(joined(spans))
                redacted.append(redact(body, spans) if spans else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, counts), pa.array(digests), pa.array(listed),
                 pa.array(redacted, pa.string()), *batch.columns[2:]],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "redacted",
                 *([carry] if carry else [])],
            )

    return rows.mapInArrow(in_pieces(scan), schema)
