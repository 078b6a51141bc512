"""Token ids of whole texts by a public byte-level BPE vocabulary, mostly from arrays.

A text is cut into pieces by the vocabulary's own rule (letters, digits, other signs,
white space, English contractions) with array operations over code points; each
distinct piece is encoded once by the tokenizer library and then looked up. Texts with
characters outside the scripts that the array rule covers, or with anything like a
special token, go to the library whole. Ids are those of ``Tokenizer.encode`` with
``add_special_tokens=False`` either way.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa

from cohortlens.llm.textbytes import _MULTIPLIER, _POWERS, Texts, mix, slices

VOCABULARY = "byte_bpe_50k.json"
SLOTS = 1 << 20  # pieces remembered by a Python worker
STORE_LIMIT = 8_000_000  # ids remembered before all are forgotten

BLANK, SPACE, LETTER, DIGIT, SIGN, OTHER = range(6)
_TABLE_SIZE = 0x2100


def _classes() -> np.ndarray:
    table = np.full(_TABLE_SIZE + 1, OTHER, np.uint8)
    for c in [*range(0x530), *range(0x2010, 0x2028), *range(0x2030, 0x205F), 0x20AC]:
        kind = unicodedata.category(chr(c))
        if kind != "Cn":
            table[c] = LETTER if kind[0] == "L" else DIGIT if kind[0] == "N" else SIGN
    table[[*range(0x09, 0x0E), 0x85, 0xA0]] = SPACE
    table[0x20] = BLANK
    return table


CLASSES = _classes()
_VALUES = mix(np.arange(1, _TABLE_SIZE + 2, dtype=np.uint64) * np.uint64(_MULTIPLIER))


def piece_starts(points: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Whether a piece begins, per code point. ``rows`` holds the first point of each row."""
    n = len(points)
    kind = CLASSES[np.minimum(points, _TABLE_SIZE)]
    white = kind <= SPACE
    group = np.where(white, SPACE, kind)
    row_start = np.zeros(n + 1, bool)
    row_start[rows] = True
    row_start[n] = True
    run = row_start[:n].copy()
    run[1:] |= group[1:] != group[:-1]
    at = np.flatnonzero(run)
    end = np.r_[at[1:], n]
    is_white = white[at]
    row_end = row_start[end]
    flag = run.copy()
    # White space before a word: its last blank goes with the word, its last other one is alone.
    inner = is_white & ~row_end
    last = end[inner] - 1
    blank = kind[last] == BLANK
    flag[end[inner][blank]] = False
    flag[last] = True
    # Contractions: an apostrophe by itself, no blank before it, letters after it.
    mark = at[(points[at] == 39) & (end - at == 1) & ~row_end]
    if len(mark):
        joined = (mark > 0) & ~row_start[mark] & (kind[mark - 1] == BLANK)
        mark = mark[~joined & (kind[np.minimum(mark + 1, n - 1)] == LETTER)]
        # Two letters after it; past the row's end nothing matches.
        c1 = points[mark + 1]
        c2 = np.where(row_start[np.minimum(mark + 2, n)], 0, points[np.minimum(mark + 2, n - 1)])
        pairs = ((c1 == 114) & (c2 == 101)) | ((c1 == 118) & (c2 == 101)) | ((c1 == 108) & (c2 == 108))
        size = np.where(np.isin(c1, [115, 116, 109, 100]), 2, np.where(pairs, 3, 0))
        mark, size = mark[size > 0], size[size > 0]
        flag[mark + 1] = False
        rest = mark + size
        inside = rest < n
        rest = rest[inside]
        flag[rest[~run[rest]]] = True
    return flag


class Encoder:
    """Encodes slices of texts; keeps what it has met."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.dtype = np.uint16 if self.library.get_vocab_size() <= 1 << 16 else np.uint32
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(SLOTS, np.uint64)
        self.place = np.zeros(SLOTS, np.int64)
        self.size = np.zeros(SLOTS, np.int32)
        self.store = np.zeros(1 << 16, self.dtype)
        self.used = 0

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def _keep(self, lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        size = np.fromiter(map(len, lists), np.int32, len(lists))
        flat = np.fromiter((i for ids in lists for i in ids), self.dtype, int(size.sum()))
        place = self.used + np.cumsum(size) - size
        while self.used + len(flat) > len(self.store):
            self.store = np.r_[self.store, np.zeros_like(self.store)]
        self.store[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        return place, size

    def _pieces(self, part: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
        """Place and size in the store of each piece, pieces before each row, odd rows."""
        text = part.data.tobytes().decode("utf-8", "replace")
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        heads = np.r_[0, np.cumsum((part.data & 0xC0) != 0x80)]
        rows = heads[part.starts]
        kind = CLASSES[np.minimum(points, _TABLE_SIZE)]
        odd = set((np.searchsorted(rows, np.flatnonzero(kind == OTHER), "right") - 1).tolist())
        at = text.find("<|")
        while at >= 0:
            odd.add(int(np.searchsorted(rows, at, "right") - 1))
            at = text.find("<|", at + 2)
        first = np.flatnonzero(piece_starts(points, rows[:-1][rows[:-1] < len(points)]))
        last = np.r_[first[1:], len(points)] if len(first) else first
        up, down = _POWERS.get(len(points) + 1)
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(_VALUES[np.minimum(points, _TABLE_SIZE)] * up[:-1], out=sums[1:])
        key = mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64))
        slot = (key & np.uint64(SLOTS - 1)).astype(np.int64)
        place, size = self.place[slot], self.size[slot]
        missed = np.flatnonzero((self.keys[slot] != key) | (size == 0))
        if len(missed):
            _, one, which = np.unique(key[missed], return_index=True, return_inverse=True)
            new = missed[one]
            lists = self._encoded(
                [text[a:b] for a, b in zip(first[new].tolist(), last[new].tolist(), strict=True)]
            )
            new_place, new_size = self._keep(lists)
            self.keys[slot[new]] = key[new]
            self.place[slot[new]], self.size[slot[new]] = new_place, new_size
            # Slots shared by two new pieces hold the last one written.
            self.keys[slot[new]] = np.where(self.place[slot[new]] == new_place, key[new], self.keys[slot[new]])
            place[missed], size[missed] = new_place[which], new_size[which]
        return place, size, np.searchsorted(first, rows), sorted(odd)

    def lengths(self, part: Texts) -> np.ndarray:
        """Ids of each row's text, counted."""
        if self.used > STORE_LIMIT:
            self._forget()
        _, size, bounds, odd = self._pieces(part)
        sums = np.r_[0, np.cumsum(size, dtype=np.int64)]
        counts = sums[bounds[1:]] - sums[bounds[:-1]]
        if odd:
            counts[odd] = [len(ids) for ids in self._encoded([_row(part, i) for i in odd])]
        return counts

    def ids(self, part: Texts) -> tuple[np.ndarray, np.ndarray]:
        """All rows' ids one after another, and each row's bounds among them."""
        if self.used > STORE_LIMIT:
            self._forget()
        place, size, bounds, odd = self._pieces(part)
        ends = np.cumsum(size, dtype=np.int64)
        flat = self.store[np.repeat(place - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
        starts = np.r_[0, ends][bounds]
        if odd:
            rows = [flat[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
            for i, ids in zip(odd, self._encoded([_row(part, i) for i in odd]), strict=True):
                rows[i] = np.array(ids, self.dtype)
            flat, starts = np.concatenate(rows), np.r_[0, np.cumsum([len(r) for r in rows])]
        return flat, starts


def _row(part: Texts, i: int) -> str:
    return part.data[part.starts[i] : part.starts[i + 1]].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(vocabulary: str = VOCABULARY) -> Encoder:
    """The worker's encoder of a public vocabulary, by its file name."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(public_tokenizers.path(vocabulary))


def encoded_slices(column: pa.Array, vocabulary: str) -> Iterator[tuple[Texts, np.ndarray, np.ndarray]]:
    """Texts, ids and row bounds, some rows at a time."""
    for part in slices(column):
        yield (part, *encoder(vocabulary).ids(part))
