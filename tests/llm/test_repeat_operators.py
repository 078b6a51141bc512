"""Conversation repair, periodic runs and repeated windows, held to plain Python."""

import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlens.llm import anchors, registry, runs, turns
from cohortlens.llm.anchors import LAST_KEY

from .conftest import ODD, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Conversations


def cheapest(rows):
    """The least (cost, edits) by a search over all edits, and the rows that it writes.

    Rows are (role, text, fault).
    """
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    names = {"s": "system", "u": "user", "a": "assistant"}
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, edits, at, state, lines = heapq.heappop(queue)
        if (at, state) in done:
            continue
        done.add((at, state))
        if at == len(rows) and state in ("", "a"):
            return cost, edits, "\n".join(lines)
        role = after[state]
        heapq.heappush(queue, (cost + 5, edits + "I", at, role, (*lines, names[role] + ":")))
        if at == len(rows):
            continue
        own, text, fault = rows[at]
        heapq.heappush(queue, (cost + 2, edits + "D", at + 1, state, lines))
        if fault in ("blank", "duplicate"):
            continue
        more = cost + 5 * (fault == "truncated")
        if own[:1] == role or (own[:1] == "s" and state == ""):
            heapq.heappush(queue, (more, edits + "K", at + 1, own[:1], (*lines, f"{own}:{text}")))
        heapq.heappush(queue, (more + 1, edits + "R", at + 1, role, (*lines, f"{names[role]}:{text}")))
    raise AssertionError


def plain_report(table, damaged):
    whole = {}
    for key, turn, role, text in table:
        out = whole.setdefault(key, [])
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if key is None else key}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20 if damaged else 9
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = (turn is not None, turn or 0, "user" if kind == 4 else role, sha(text), text)
        out += [row] * (0 if kind == 0 else 2 if kind == 3 else 1)
    found = {}
    for key, rows in whole.items():
        seen, faults = set(), []
        rows.sort()
        for *_, role, _, text in rows:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else None
            faults.append(fault or ("truncated" if body[-1] not in ".!?" else None))
            seen.add((role, text))
        told = [r[1] for r in rows if r[0]]
        gaps = max(told) - min(told) + 1 - len(set(told)) if told else 0
        initials = [r[2][:1] for r in rows]
        illegal = sum(x + y not in ("su", "ua", "au") for x, y in itertools.pairwise(initials))
        cost, edits, text = cheapest([(r[2], r[4], f) for r, f in zip(rows, faults, strict=True)])
        n = Counter(faults)
        found[key] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, edits, sha(text))
    return found


REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def conversations(seed, n):
    r = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "No!", "Why?", "so far", " \t", "", None, "end. ", "end. \n", "the same."]
    rows = []
    for key in [None, *range(n)]:
        at = 0
        for _ in range(r.randint(1, 9)):
            at += r.choice([0, 1, 1, 1, 3])
            rows.append((key, None if r.random() < 0.1 else at, r.choice(roles), r.choice(texts)))
    return rows + rows[5:9]


@pytest.mark.parametrize("damaged", [False, True])
@pytest.mark.parametrize("parts", [1, 7])
def test_conversations_match_a_search_over_all_edits(spark, damaged, parts):
    rows = conversations(parts, 60)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    table = table.repartition(parts).withColumns({c: F.lit("clash") for c in ("kind", "code", "audit", "copies")})
    found = turns.report(table, turns.Damage() if damaged else None).collect()
    got = {r.conv_id: tuple(r[c] for c in REPORT) for r in found}
    assert len(found) == len(got)
    assert got == plain_report(rows, damaged)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 11), max_size=60))
def test_repair_of_codes_is_the_least(codes):
    fault = {0: None, 1: "blank", 2: "truncated"}
    role = ["tool", "system", "user", "assistant"]
    cost, edits, _ = cheapest([(role[c % 4], "x", fault[c // 4]) for c in codes])
    assert turns.repair(bytes(codes)) == (cost, edits)


def test_a_conversation_that_loses_all_rows_and_an_empty_table(spark):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    schema = "conv_id long, turn long, role string, text string"
    table = spark.createDataFrame([(gone, 0, "user", "x.")], schema)
    assert turns.report(table, turns.Damage()).collect() == [(gone, 0, 0, 0, 0, 0, 0, "", sha(""))]
    assert turns.report(table.limit(0), turns.Damage()).collect() == []


def test_one_large_conversation_in_many_partitions(spark):
    """A conversation that holds nearly all rows gives one whole string of edits."""
    r = random.Random(5)
    rows = [(1, i, r.choice(["user", "assistant"]), f"{r.randrange(3000)}.") for i in range(6000)]
    rows += [(2, 0, "user", "a."), (2, 1, "assistant", "b.")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: tuple(r[c] for c in REPORT) for r in turns.report(table.repartition(5)).collect()}
    assert found == plain_report(rows, False)


def test_repaired_turns_are_what_the_digest_is_of(spark):
    rows = conversations(11, 30)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    seen = turns.examined(turns.conversations_of(table))
    found = turns.edits(seen)
    lines = {}
    for r in turns.repaired(seen, found).orderBy("conv_id", "place").collect():
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    told = {r.conv_id: r.repaired_sha256 for r in turns.digests(seen, found).collect()}
    assert told == {k: sha("\n".join(lines.get(k, []))) for k in told}
    assert set(lines) <= set(told)


# Runs


def plain_runs(words):
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def test_shifts_lead_into_the_cover():
    cover = set(runs.COVER)
    for a, b in itertools.product(range(runs.MODULUS), repeat=2):
        d = int(runs.SHIFTS[a, b])
        assert {(a + d) % runs.MODULUS, (b + d) % runs.MODULUS} <= cover


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_runs_match_every_period(data):
    r = random.Random(data.draw(st.integers(0, 1 << 30)))
    texts = []
    for _ in range(r.randint(1, 4)):
        n, k = r.randint(0, 150), r.choice([1, 2, 3, 8, 60])
        words = [r.randrange(k) for _ in range(n)]
        if n and r.random() < 0.6:
            a = r.randrange(n)
            p = 1 + (n - a) // r.randint(2, 9)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        texts.append(np.array(words * r.choice([1, 1, 2, 3]), np.int64))
    text, start, length, period = runs.periodic_runs(texts)
    for i, words in enumerate(texts):
        own = text == i
        got = list(zip(start[own].tolist(), length[own].tolist(), period[own].tolist(), strict=True))
        assert got == plain_runs(words.tolist())


def test_extensions_match_word_by_word():
    r = random.Random(2)
    words = [r.randrange(2) for _ in range(40)] * 6 + [-2] + [r.randrange(2) for _ in range(300)]
    ids = np.array([*words, -3])
    pairs = np.array([sorted(r.sample(range(len(words)), 2)) for _ in range(3000)])

    def common(i, j):
        n = 0
        while ids[i + n] == ids[j + n]:
            n += 1
        return n

    got = runs.Extensions(ids).get(pairs[:, 0], pairs[:, 1])
    assert got.tolist() == [common(i, j) for i, j in pairs]


def plain_collapse(key, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(key).encode()), len(words)
    if key is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        words = [words[i if i < a else a + (i - a) % (1 + (n - a) // (3 + g % 8))] for i in range(n)]
    found = plain_runs(words)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    top = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None,) * 3)
    return (
        key, len(found), *top, 1000 * top[1] // top[2] if found else None,
        sha("".join(f"{s},{length},{q}\n" for s, length, q in found)),
        sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def test_collapsed_texts(spark, documents, odd, empty):
    rows = [(i, prose(i, 60)) for i in range(100, 160)] + [(7, "a b c d e f " * 4), (8, "ä " * 30)]
    rows = [*rows, *[(k, t) for k, t in ODD if len(t or "") < 9000]]
    found = runs.digested(runs.collapsed(documents(rows).repartition(3), damage=runs.Damage()))
    assert Counter(map(tuple, found.collect())) == Counter(plain_collapse(k, t) for k, t in rows)
    assert any(r.n_runs for r in found.collect() if (r.doc_id or 0) >= 100)
    long = runs.collapsed(odd).where("doc_id = 8").first()  # 30,000 times one word
    assert [tuple(r) for r in long.runs] == [(0, 30_000, 1)]
    assert long.collapsed == "word"
    assert runs.digested(runs.collapsed(empty)).collect() == []


# Repeated windows


def plain_cut(rows, window):
    first, out = {}, []
    texts = [(LAST_KEY if k is None else k, WORD.findall(t or "")) for k, t in rows]
    for k, words in texts:
        for i in range(len(words) - window + 1):
            own = tuple(words[i : i + window])
            first[own] = min(first.get(own, (k, i)), (k, i))
    for (key, _), (k, words) in zip(rows, texts, strict=True):
        gone = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < (k, i):
                gone |= set(range(i, i + window))
        out.append((key, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return Counter(out)


def planted(seed):
    r = random.Random(seed)
    known = [f"w{i}" for i in range(300)]
    shared = [[r.choice(known) for _ in range(60)] for _ in range(6)]
    rows = [(None, None), (None, " ".join(shared[0])), (0, ""), (2, "same " * 400), (3, "same " * 25)]
    for i in range(10, 120):
        words = [r.choice(known) for _ in range(r.randint(0, 120))]
        if r.random() < 0.6:
            at = r.randrange(30)
            words += r.choice(shared)[at : at + r.randint(15, 60)] + r.choices(known, k=r.randint(0, 40))
        text = rows[-r.randint(1, 5)][1] if r.random() < 0.1 else " ".join(words)
        rows.append((i if r.random() < 0.95 else i - 1, text))
    return [*rows, rows[20], rows[20]]


@pytest.mark.parametrize("parts", [1, 6])
@pytest.mark.parametrize("window", [20, 6])
def test_windows_match_all_places(spark, documents, monkeypatch, parts, window):
    monkeypatch.setattr(anchors, "SLICE_BYTES", 3000)  # many slices
    monkeypatch.setattr(anchors, "BYTES_A_BUCKET", 10)
    rows = planted(parts)
    docs = documents(rows).repartition(parts).withColumn("slice", F.lit("clash"))
    found = anchors.deduplicated(docs, window=window).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in found) == plain_cut(rows, window)
    for r in found:
        assert sum(c.end - c.start for c in r.cuts) == r.n_removed


def test_windows_of_odd_rows(spark, odd, empty):
    found = anchors.deduplicated(odd).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in found) == plain_cut(ODD, 20)
    assert anchors.deduplicated(empty).collect() == []


def test_texts_are_shuffled_once(spark, documents):
    """All steps read one shuffle of the texts."""
    found = anchors.deduplicated(documents(planted(3))).agg(F.sum("n_removed"))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("== Initial Plan ==")]
    assert final.count("REPARTITION_BY_NUM") - final.count("ReusedExchange") <= 1


@pytest.mark.parametrize("name", ["op11_conversation_repair", "op12_periodic_runs", "op13_substring_dedup"])
def test_queries_leave_the_session_alone(spark, name):
    before = dict(spark.conf.getAll)
    registry.queries()[name](spark, "/root/testdata/sf0.001").count()
    assert dict(spark.conf.getAll) == before
