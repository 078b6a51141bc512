"""Repair of the turn structure of conversations, by a square-root checkpointed DP.

Rows of a conversation are kept, given another role, deleted, or have empty turns put
between them, at the least total cost, so that roles read: a system turn or none, then
user and assistant in turn, ended by the assistant. Of the cheapest edits the
ASCII-least string of initials (D, I, K, R) is taken.

1. Faults are found by Spark: equal rows of a turn are one row with a count, a row is a
   duplicate if the least turn of its role and text is an earlier one, and blank and
   truncated texts are told by patterns. What the DP needs of a row is one byte.
2. Rows are range-partitioned by conversation and order, so that a large conversation
   is sorted by many tasks, each of which makes it one string of codes.
3. The DP walks a conversation's codes backwards with the costs to the end from each
   state of the pattern, and stores them only at checkpoints, one for each square root
   of the length. Walking forward, it works out a block's costs again from the
   checkpoint behind it, and at each step takes the least initial that is tight: whose
   cost and the cost from where it leads add up to the cost here. Costs less their
   least one take few values, so that steps are looked up once met.
4. Rows and edits are laid together in order and read as a stream, which gives the
   repaired turns, or their digest. A digest of a conversation is one task's work by
   its nature, as is its string of edits; both are streamed, in memory of one byte a row.

Defined cases: rows lie by turn, nulls first, then role, then the digest of the text;
null role and text are one space, a blank text; a role that does not start with s, u
or a, an empty one too, is in no legal place; equal rows are duplicates of the first;
null conversation keys are one conversation; a table without rows gives none; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.sources.staging import staged, unstage

KEEP, RENAME, DELETE, INSERT, CUT = 0, 1, 2, 5, 5  # costs; CUT is added for undeleted truncated rows
SOUND, FAULTY, TRUNCATED = 0, 1, 2
START, SYSTEM, USER, ASSISTANT = range(4)  # states of the pattern: the role last written
ROLES = ("", "system", "user", "assistant")
OTHER = 0  # a role's class is the state that it leads to; this one leads nowhere
AFTER = (USER, USER, ASSISTANT, USER)  # what an inserted or renamed turn leads to
FAR = 1 << 40
BATCH = 2_000  # rows written at once
SEGMENT_ROWS = 1 << 16  # codes that lie in one row on their way to the DP
Vector = tuple[int, int, int, int]

# What counts as white space, as an end of a sentence.
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"


def _place(role: int, state: int) -> int | None:
    """Where a row of this role leads if it is kept, None if it may not stand here."""
    if role == SYSTEM:
        return SYSTEM if state == START else None
    return role if role != OTHER and AFTER[state] == role else None


def _with_inserts(costs: list[int]) -> tuple[int, ...]:
    user = min(costs[USER], INSERT + costs[ASSISTANT])
    assistant = min(costs[ASSISTANT], INSERT + costs[USER])
    return min(costs[START], INSERT + user), min(costs[SYSTEM], INSERT + user), user, assistant


def _choices(code: int, state: int, behind: Vector) -> list[tuple[str, int, int]]:
    """Initial, state and cost to the end of what may be done with a row, least initial first."""
    fault, role = divmod(code, 4)
    found = [("D", state, DELETE + behind[state])]
    if fault != FAULTY:
        more = CUT * (fault == TRUNCATED)
        kept = _place(role, state)
        if kept is not None:
            found.append(("K", kept, KEEP + more + behind[kept]))
        found.append(("R", AFTER[state], RENAME + more + behind[AFTER[state]]))
    return found


END: Vector = _with_inserts([0, FAR, FAR, 0])


@cache
def _before(code: int, behind: Vector) -> tuple[Vector, int]:
    """Costs before a row from those behind it, less their least one, and that."""
    costs = _with_inserts([min(c for _, _, c in _choices(code, s, behind)) for s in range(4)])
    least = min(costs)
    return tuple(c - least for c in costs), least


@cache
def _edit(code: int, state: int, behind: Vector) -> tuple[str, int]:
    """The least tight edits up to and with a row, and the state that they lead to."""
    costs, least = _before(code, behind)
    edits = ""
    while True:
        tight = [(e, s) for e, s, c in _choices(code, state, behind) if c - least == costs[state]]
        inserted = AFTER[state]
        may_insert = INSERT + costs[inserted] == costs[state]
        if tight and (tight[0][0] == "D" or not may_insert):
            return edits + tight[0][0], tight[0][1]
        edits, state = edits + "I", inserted


def repair(codes: bytes) -> tuple[int, str]:
    """The least cost of a conversation's codes, and the ASCII-least edits of that cost."""
    n = len(codes)
    step = isqrt(n) + 1
    # Costs behind the last row of each block of ``step`` rows.
    checkpoints: list[Vector] = []
    behind, cost = END, 0
    for at in range(n - 1, -1, -1):
        if at == n - 1 or at % step == step - 1:
            checkpoints.append(behind)
        behind, least = _before(codes[at], behind)
        cost += least
    cost += behind[START]
    out, state = [], START
    for low in range(0, n, step):
        block = codes[low : low + step]
        costs = [checkpoints.pop()]
        for code in reversed(block):
            costs.append(_before(code, costs[-1])[0])
        costs.pop()
        for code in block:
            edits, state = _edit(code, state, costs.pop())
            out.append(edits)
    return cost, "".join(out) + "I" * (END[state] // INSERT)


@dataclass(frozen=True)
class Damage:
    """Faults put into rows by the checksum of ``conversation:turn``."""

    one_in: int = 20

    def done(self, rows: DataFrame) -> DataFrame:
        """Of every ``one_in`` rows one dropped, emptied, unended, repeated, made the user's."""
        name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
        kind = F.crc32(name.cast("binary")) % self.one_in
        whole = rows.withColumn("kind", kind).where("kind <> 0")
        text = F.when(F.col("kind") == 1, "").when(
            F.col("kind") == 2, F.translate("text", ENDS, "")
        )
        changed = whole.withColumns(
            {
                "text": text.otherwise(F.col("text")),
                "role": F.when(F.col("kind") == 4, "user").otherwise(F.col("role")),
                "copy": F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))),
            }
        )
        return changed.select("conv_id", "turn", "role", "text")


def conversations_of(
    table: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The four columns that are used; null role and text are one space."""
    return table.select(
        F.col(key).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )


def _role_class(role: Column) -> Column:
    initial = F.substring(role, 1, 1)
    found = F.lit(OTHER)
    for state in (SYSTEM, USER, ASSISTANT):
        found = F.when(initial == ROLES[state][0], state).otherwise(found)
    return found


def examined(rows: DataFrame) -> DataFrame:
    """A staged table of distinct rows with their ``copies`` and what is wrong with them.

    ``blank`` and ``truncated`` are of the text, ``again`` tells that the role and text
    stand in an earlier turn; further copies of a row are duplicates in any case.
    """
    body = F.rtrim(F.col("text"), F.lit(BLANKS))
    looked = rows.withColumns(
        {"blank": body == "", "truncated": ~F.substring(body, -1, 1).isin(list(ENDS))}
    )
    looked = looked.withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))
    counted = looked.groupBy("conv_id", "turn", "role", "digest").agg(
        F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in ("text", "blank", "truncated")]
    )
    counted = staged(counted.withColumn("at", F.struct(F.col("turn").isNotNull().alias("told"), "turn")))
    least = counted.groupBy("conv_id", "role", "digest").agg(F.min("at").alias("least"))
    least = least.select(*[F.col(c).alias(f"own_{c}") for c in least.columns])
    met = counted.join(
        least,
        counted["conv_id"].eqNullSafe(least["own_conv_id"])
        & (counted["role"] == least["own_role"])
        & (counted["digest"] == least["own_digest"]),
    )
    again = ~F.col("at").eqNullSafe(F.col("own_least"))
    fault = F.when(F.col("blank") | again, FAULTY).when(F.col("truncated"), TRUNCATED).otherwise(SOUND)
    out = staged(
        met.select(
            "conv_id", "turn", "role", "digest", "text", "copies", "blank", "truncated",
            again.alias("again"),
            (fault * 4 + _role_class(F.col("role"))).cast("int").alias("code"),
        )
    )
    unstage(counted)
    return out


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows as strings of codes, one or more for each conversation of a partition."""
    place = TaskContext.get().partitionId() << 33
    for batch in batches:
        if not batch.num_rows:
            continue
        code = batch.column(1).to_numpy().astype(np.uint8)
        copies = batch.column(2).to_numpy()
        # A copy is the row again, as a faulty one.
        first = np.cumsum(copies) - copies
        codes = np.repeat(code % 4 + 4 * FAULTY, copies).astype(np.uint8)
        codes[first] = code
        own = batch.column(0).fill_null(0).to_numpy()
        null = batch.column(0).is_null().to_numpy(zero_copy_only=False)
        new = np.r_[True, (own[1:] != own[:-1]) | (null[1:] != null[:-1])]
        starts = np.flatnonzero(new)
        bounds = np.r_[first[starts], len(codes)]
        out = [
            (row, codes[at : min(at + SEGMENT_ROWS, high)].tobytes())
            for row, low, high in zip(starts, bounds[:-1], bounds[1:], strict=True)
            for at in range(low, high, SEGMENT_ROWS)
        ]
        rows = np.array([row for row, _ in out])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(rows)),
                pa.array(place + np.arange(len(out))),
                pa.array([x for _, x in out], pa.binary()),
            ],
            ["conv_id", "place", "codes"],
        )
        place += len(out)


LEGAL_PAIRS = ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's least cost, edits and illegal pairs; its codes lie one after another."""

    def told(key, held):
        codes = b"".join(held)
        role = np.frombuffer(codes, np.uint8) % 4
        pair = role[:-1].astype(np.int64) * 4 + role[1:]
        illegal = int((~np.isin(pair, [a * 4 + b for a, b in LEGAL_PAIRS])).sum())
        return key, illegal, *repair(codes)

    def batch(rows):
        types = [pa.int64()] * 3 + [pa.string()]
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
            ["conv_id", "illegal", "cost", "audit"],
        )

    done, key, held = [], None, []
    for rows in batches:
        for own, codes in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
            if held and own != key:
                done.append(told(key, held))
                held = []
            key = own
            held.append(codes)
            if len(done) == BATCH:
                yield batch(done)
                done = []
    if held:
        yield batch([*done, told(key, held)])


def edits(rows: DataFrame) -> DataFrame:
    """A staged table of conv_id, illegal, cost and audit of the conversations of ``examined`` rows."""
    buckets = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "digest")]
    narrow = rows.select("conv_id", "turn", "role", "digest", "code", "copies")
    sorted_ = narrow.repartitionByRange(buckets, *order).sortWithinPartitions(*order)
    codes = sorted_.select("conv_id", "code", "copies").mapInArrow(
        _segments, "conv_id long, place long, codes binary"
    )
    codes = staged(codes)
    schema = "conv_id long, illegal long, cost long, audit string"
    lined = codes.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    found = staged(lined.select("conv_id", "codes").mapInArrow(_edited, schema))
    unstage(codes)
    return found


def _stream(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's edits and then its rows in order, in one partition."""
    told = found.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
        F.lit("").alias("digest"), F.col("audit").alias("text"), F.lit(1).cast("long").alias("copies"),
    )
    whole = told.union(rows.select("conv_id", F.lit(1), "turn", "role", "digest", "text", "copies"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "kind", "turn", "role", "digest")]
    return whole.repartition("conv_id").sortWithinPartitions(*order).drop("digest")


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list | None]]:
    """For each conversation its key and None, then (key, [turn, edit, role, text]) for each edit."""
    conv_id, audit, at, state = None, "", 0, START

    def written(edit, turn, role, text):
        nonlocal state
        if edit == "K":
            state = next(s for s in (SYSTEM, USER, ASSISTANT) if role.startswith(ROLES[s][0]))
        elif edit != "D":
            state = AFTER[state]
            role = ROLES[state]
        return conv_id, [turn, edit, role, text]

    def inserts():
        nonlocal at
        while at < len(audit) and audit[at] == "I":
            at += 1
            yield written("I", None, "", "")

    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "kind", "turn", "role", "text", "copies"))
        for key, kind, turn, role, text, copies in zip(*columns, strict=True):
            if kind == 0:
                yield from inserts()
                conv_id, audit, at, state = key, text, 0, START
                yield key, None
                continue
            for _ in range(copies):
                yield from inserts()
                at += 1
                yield written(audit[at - 1], turn, role, text)
    yield from inserts()


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, ``place`` from 0, the original turn, the edit, role and text."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows):
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["conv_id", "place", "turn", "edit", "role", "text"],
            )

        types = [pa.int64()] * 3 + [pa.string()] * 3
        held, place = [], 0
        for key, edit in _applied(batches):
            if edit is None:
                place = 0
            elif edit[1] != "D":
                held.append((key, place, *edit))
                place += 1
            if len(held) == BATCH:
                yield batch(held)
                held = []
        if held:
            yield batch(held)

    schema = "conv_id long, place long, turn long, edit string, role string, text string"
    return _stream(rows, found).mapInArrow(write, schema)


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Per conversation the digest of its repaired ``role:text``, joined by line feeds."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows):
            keys, texts = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array(texts, pa.string())], ["conv_id", "repaired_sha256"]
            )

        done, sha, key, lines = [], None, None, 0
        for own, edit in _applied(batches):
            if edit is None:
                if sha is not None:
                    done.append((key, sha.hexdigest()))
                sha, key, lines = hashlib.sha256(), own, 0
                if len(done) >= BATCH:
                    yield batch(done)
                    done = []
            elif edit[1] != "D":
                sha.update(f"{chr(10) if lines else ''}{edit[2]}:{edit[3]}".encode())
                lines += 1
        if sha is not None:
            yield batch([*done, (key, sha.hexdigest())])

    return _stream(rows, found).mapInArrow(digest, "conv_id long, repaired_sha256 string")


def report(table: DataFrame, damage: Damage | None = None) -> DataFrame:
    """Per conversation of ``table``: gaps, its faults and illegal pairs, cost, audit and digest.

    ``damage`` puts faults into the rows first; a conversation may lose all of its rows.
    """
    whole = conversations_of(table)
    rows = examined(damage.done(whole) if damage else whole)
    found = edits(rows)

    def some(condition: Column, times: Column) -> Column:
        return F.sum(F.when(condition, times).otherwise(0))

    one, more, blank = F.lit(1), F.col("copies") - 1, F.col("blank")
    counts = rows.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"),
        some(blank, F.col("copies")).alias("blank"),
        some(~blank, more + F.col("again").cast("long")).alias("duplicate"),
        some(~blank & ~F.col("again") & F.col("truncated"), one).alias("truncated"),
    )
    out = whole.select("conv_id").distinct()
    for part in (counts, found, digests(rows, found)):
        own = part.withColumnRenamed("conv_id", "own_id")
        out = out.join(own, out["conv_id"].eqNullSafe(own["own_id"]), "left").drop("own_id")
    empty = F.lit(hashlib.sha256().hexdigest())
    return out.select(
        "conv_id",
        *[
            F.coalesce(c, F.lit(0)).cast("long").alias(c)
            for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
        ],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", empty).alias("repaired_sha256"),
    )
