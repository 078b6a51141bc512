"""Exact set-similarity join of texts by their word shingles: grouped prefix join.

Two sets with Jaccard similarity of at least ``t`` share an element among the first
``n - ceil(t * n) + 1`` of each, under any one order of all elements. The order
here is by how often a bounded sample has an element, then by fingerprint, so that
shared boilerplate seldom stands in a prefix.

1. Equal sets become one class; classes of the same size and prefix one group. Sets that
   link share a mark (``marks``), the fingerprint of several elements at once. Groups
   connected by marks are a family, and only families of several groups go on: texts
   that have no more in common than single elements, of which there are the more the
   more texts there are, go here. An element is one of its family's.
2. Prefix elements of one group alone pair nothing and go. Prefixes of linked sets share
   more than one element unless the sets differ much in size: by the sizes that a group
   meets along its elements, it must share ``least`` of them. A group with fewer links
   with nothing; of the others all but the last ``least - 1``, by how many groups have
   them, are indexed: two that share ``least`` share one of these (a prefix of the prefix,
   by exact counts whatever the sample showed). Elements that exactly the same groups
   have are one with a ``weight``, so near copies do not meet at each that they share.
3. The index is range-partitioned by (element, group), so that a hot element is spread
   over many tasks. Along a run of equal elements every group meets the first ``PIVOTS``
   of the run's part in its partition, and, where a run may lie in several partitions,
   the first ``PIVOTS`` of the whole run too: those first that share most of their
   prefix, copies with the fewest changes of their own. Most true links are found
   without listing all pairs of a run: a row makes ``PIVOTS`` of them and one open row at
   most, however long its run. Pairs of unlike sizes are dropped, and those that must share
   more than the index ``has`` of one of them.
4. Group pairs are expanded to class pairs, and each is verified on whole sets. For
   that, classes linked by candidate pairs are laid together (in cells of bounded
   size, a pair in that of its end with fewer pairs), so that a text travels about
   once, not once for each pair.
5. Runs that were not wholly paired and whose members lie in several components are
   looked at again across the components: no link that could join two of them is left
   out. Links inside a component change nothing and are not looked for. Runs of up to
   ``SHORT_RUN`` classes are paired in full, with the same bound on what prefixes share.
   In longer ones, near copies of one text, each class is laid against one pivot and
   keeps its changes: elements that it lacks and elements that it has beyond the
   pivot's. How many changes two classes must share in order to link follows from their
   sizes alone. Those that need share none link with the class of least weight; the
   others are joined on their rarest changes, a prefix join once more, but without the
   text that all of them share. Classes that differ from the pivot by more than half of
   their size are paired in full with all others of the run.

Elements are 59-bit fingerprints; a false equality within a pair of texts has a
probability of about 1e-12. Defined cases: null, empty or blank text has an empty
set, links with nothing and is its own component; rows with a null key have a null
component; repeated rows share a class, and rows of one key are one document, which
links where any of its texts does; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm import in_pieces, marks
from cohortlens.llm.components import components
from cohortlens.llm.textbytes import Texts, shingle_hash, slices
from cohortlens.sources.staging import staged, unstage

PIVOTS = 2  # only speed hangs on it: what these leave unconnected is looked at again
LISTED_ELEMENTS = 64  # elements of a group that travel with each of its rows; beyond, pairs are made at every one
GROUP_PIVOTS = 8  # members of a group that all members of a paired group meet
SAMPLE_ROWS = 20_000  # rows looked at for frequent elements; only speed hangs on it
SAMPLE_COUNT = 3  # times in the sample that make an element frequent
FREQUENT_LIMIT = 100_000  # frequent elements sent to every task, 8 bytes each
BROADCAST_ROWS = 500_000  # candidates' keys sent to every task; beyond, texts are shuffled
SHORT_RUN = 32  # classes of an open run that are paired in full; of a longer one, changes are joined
CELL_CLASSES = 256  # classes of one component that are verified together
BUCKETS = 4  # of marks for each shuffle partition; 32 bits tell them apart within one, so
LEAST_BUCKETS = 256  # only speed hangs on them
SLICE_BYTES = 1 << 17  # of texts whose marks are worked out at once
LEVEL_BITS = 4  # the order's first bits: how often the sample has an element, by powers of two


@dataclass(frozen=True)
class Join:
    """Shingles of ``size`` words; sets link when 100 * common >= percent * union."""

    size: int = 5
    percent: int = 80

    def prefix(self, n: np.ndarray) -> np.ndarray:
        """Elements of a set of ``n`` of which a linked set must share one."""
        return np.where(n > 0, n - -(-self.percent * n // 100) + 1, 0)

    def after_prefix(self, n: Column) -> Column:
        """Elements of a set of ``n`` beyond its prefix."""
        return F.ceil(self.percent * n / 100) - 1

    def needed(self, n: Column, k: Column) -> Column:
        """Elements that the prefixes of linked sets of ``n`` and ``k`` share at least."""
        common = F.ceil(self.percent * (n + k) / (100 + self.percent))
        return common - F.greatest(self.after_prefix(n), self.after_prefix(k))

    def can_share(self, n, k, least, has) -> np.ndarray:
        """Whether sets of ``n`` and ``k`` are of like sizes and ``has`` indexed elements are enough to link."""
        after = -(-self.percent * np.maximum(n, k) // 100) - 1
        needed = -(-self.percent * (n + k) // (100 + self.percent)) - after
        alike = self.percent * np.maximum(n, k) <= 100 * np.minimum(n, k)
        return alike & (needed - least < has)

    def could_share(self, n: str, k: str, least: Column, has: Column) -> Column:
        """``can_share`` of columns."""
        alike = self.percent * F.greatest(n, k) <= 100 * F.least(n, k)
        return alike & (self.needed(F.col(n), F.col(k)) - least < has)


def _elements(part: Texts, join: Join, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct elements and their rows, by row and then in the order of all elements.

    ``frequent`` holds elements as they shall be ordered, sorted by fingerprint.
    """
    part = part.lowered()
    first, last, rows = part.words()
    value, rows = shingle_hash(part.span_hash(first, last), rows, join.size)
    value >>= np.uint64(LEVEL_BITS + 1)
    if len(frequent) and len(value):
        plain = frequent & np.uint64((1 << (63 - LEVEL_BITS)) - 1)
        at = np.minimum(np.searchsorted(plain, value), len(frequent) - 1)
        value = np.where(plain[at] == value, frequent[at], value)
    order = np.lexsort((value, rows))
    value, rows = value[order], rows[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (rows[1:] != rows[:-1])
    return value[new], rows[new]


def frequent_elements(docs: DataFrame, text: str, join: Join) -> np.ndarray:
    """Elements found often in a sample of about ``SAMPLE_ROWS`` rows, under their places in the order."""
    n = max(docs.count(), 1)
    sample = docs.select(text).where(F.pmod(F.xxhash64(text), F.lit(n)) < SAMPLE_ROWS)

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(0)):
                value, _ = _elements(part, join, np.zeros(0, np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64))], ["value"])

    seen = sample.mapInArrow(in_pieces(elements), "value long").groupBy("value").count()
    often = seen.where(F.col("count") >= SAMPLE_COUNT).orderBy(F.desc("count"), "value")
    found = often.limit(FREQUENT_LIMIT).toPandas()
    level = np.minimum(np.log2(np.maximum(found["count"], 2)).astype(np.uint64), (1 << LEVEL_BITS) - 1)
    value = found["value"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(value)
    return (value | (level.to_numpy() << np.uint64(63 - LEVEL_BITS)))[order]


SETS = {
    "place": pa.int64(),
    "doc_id": pa.int64(),
    "n": pa.int64(),
    "f1": pa.int64(),
    "f2": pa.int64(),
    "prefix": pa.list_(pa.int64()),
    "bucket": pa.int64(),
    "marks": pa.binary(),
    "rows": pa.binary(),
    "other": pa.int64(),
}


def _row_batch(count: int, **columns) -> pa.RecordBatch:
    """A batch of ``SETS`` whose other columns are null."""
    filled = [pa.array(columns[c], t) if c in columns else pa.nulls(count, t) for c, t in SETS.items()]
    return pa.RecordBatch.from_arrays(filled, list(SETS))


def shingle_sets(docs: DataFrame, key: str, text: str, join: Join, frequent, buckets: int) -> DataFrame:
    """Per row: its ``place``, key, set size ``n``, fingerprints ``f1``, ``f2`` of the set, its ``prefix``.

    Besides, with a null ``n``, the ``marks`` of a ``bucket`` and their ``rows`` from
    ``place`` on, and places with an ``other`` whose mark they share.
    """

    def sent(packed: pa.RecordBatch, links: np.ndarray) -> Iterator[pa.RecordBatch]:
        columns = dict(zip(("place", "bucket", "marks", "rows"), packed.columns, strict=True))
        yield _row_batch(packed.num_rows, **columns)
        if links.size:
            yield _row_batch(links.shape[1], place=links[0], other=links[1])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        for batch in batches:
            keyed = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            sender = marks.Sender(base, buckets, sent)
            for part in slices(batch.column(1), SLICE_BYTES):
                value, rows = _elements(part, join, frequent)
                n = np.bincount(rows, minlength=len(part))
                ends = np.cumsum(n)
                starts = ends - n
                sums = np.r_[np.uint64(0), np.cumsum(value * np.uint64(0x9E3779B97F4A7C15))]
                squares = np.r_[np.uint64(0), np.cumsum(value * (value ^ (value >> np.uint64(29))))]
                wanted = join.prefix(n)
                place = np.arange(len(value)) - np.repeat(starts, n)
                prefix = value[place < np.repeat(wanted, n)].view(np.int64)
                offsets = np.r_[0, np.cumsum(wanted)].astype(np.int32)
                yield _row_batch(
                    len(part),
                    place=base + part.first_row + np.arange(len(part)),
                    doc_id=batch.column(0).slice(part.first_row, len(part)),
                    n=n.astype(np.int64),
                    f1=(sums[ends] - sums[starts]).view(np.int64),
                    f2=(squares[ends] - squares[starts]).view(np.int64),
                    prefix=pa.ListArray.from_arrays(pa.array(offsets), pa.array(prefix)),
                )
                level = np.uint64(63 - LEVEL_BITS)
                is_rare, plain = value >> level == 0, value & np.uint64((1 << int(level)) - 1)
                own = keyed[part.first_row : part.first_row + len(part)]
                mark, row = marks.of_sets(plain, is_rare, rows, np.where(own, n, 0), join.percent)
                yield from sender.add(mark, row + part.first_row)
            yield from sender.flush()
            base += batch.num_rows

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(
        in_pieces(summed),
        "place long, doc_id long, n long, f1 long, f2 long, prefix array<long>, "
        "bucket long, marks binary, rows binary, other long",
    )


def _families(sets: DataFrame, same: DataFrame) -> DataFrame:
    """A staged table of ``node`` and ``component`` of the places that marks or ``same`` (a, b) connect."""
    packed = sets.where("bucket IS NOT NULL").select(F.col("place").alias("slice"), "bucket", "marks", "rows")
    links = packed.groupBy("bucket").applyInArrow(marks.met, "a long, b long")
    within = sets.where("other IS NOT NULL").select(F.col("place").alias("a"), F.col("other").alias("b"))
    return components(links.union(within).union(same))


def _run_pairs(join: Join):
    """Pairs of groups along runs of equal elements, in a partition sorted by them.

    Rows out: kind 1, a pair (x, y) with sizes (n, k) and the larger ``least`` of both,
    once for each element that it meets in; kind 4, the same in a run that is not wholly paired; kind 2, element x
    and group y at a partition's edge; kind 3, element x and group y of a run that was
    not wholly paired; both with the group's size n, and its ``own`` as k. All with the
    element's ``weight`` and the (lesser) ``has``.
    """

    def rows(kind: int, x, y, n, k, least, has, weight) -> pa.RecordBatch:
        columns = [np.full(len(x), kind), x, y, n, k, least, has, weight]
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], ["kind", "x", "y", "n", "k", "least", "has", "weight"]
        )

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 8  # first rows of the run that may go on
        seen = crowds = 0  # rows of that run so far, and groups of more than GROUP_PIVOTS classes
        told = False  # whether its rows went out as kind 3
        first_run = True
        for batch in batches:
            if not batch.num_rows:
                continue
            old = len(held[0])
            token, gid, n, m, least, own, has, weight = (
                np.concatenate((h, c.to_numpy())) for h, c in zip(held, batch.columns, strict=True)
            )
            goes_on = old > 0 and len(token) > old and token[old] == token[0]
            start = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
            size = np.diff(np.r_[start, len(token)])
            run = np.repeat(np.arange(len(start)), size)
            rank = np.arange(len(token)) - start[run]
            count = np.where(np.arange(len(token)) >= old, np.minimum(rank, PIVOTS), 0)
            later = np.repeat(np.arange(len(token)), count)
            inside = np.arange(len(later)) - np.repeat(np.cumsum(count) - count, count)
            pivot = start[run[later]] + inside
            most, fewest = np.maximum(least[pivot], least[later]), np.minimum(has[pivot], has[later])
            could = join.can_share(n[pivot], n[later], most, fewest)
            pivot, later, most, fewest = pivot[could], later[could], most[could], fewest[could]
            crowd = (m > GROUP_PIVOTS).astype(np.int64)
            total = np.add.reduceat(crowd, start)
            if old:
                total[0] += crowds - crowd[:old].sum()
            is_open = (size > PIVOTS + 1) | (total > 1)
            is_open[0] |= first_run or told
            is_open[-1] = (told and len(start) == 1) or seen * goes_on + size[-1] > PIVOTS + 1
            if first_run and len(start) > 1:
                edge = slice(0, min(size[0], PIVOTS))
                yield rows(2, *(c[edge] for c in (token, gid, n, own, least, has, weight)))
            partly = is_open[run[later]]
            for kind, these in ((1, ~partly), (4, partly)):
                p, q = pivot[these], later[these]
                x, y = np.minimum(gid[p], gid[q]), np.maximum(gid[p], gid[q])
                yield rows(kind, x, y, n[p], n[q], most[these], fewest[these], weight[q])
            out = is_open[run]
            if told:
                out[:old] = False
            yield rows(3, *(c[out] for c in (token, gid, n, own, least, has, weight)))
            # What is known of the last run.
            if len(start) > 1:
                first_run = False
                seen, told, crowds = int(size[-1]), bool(is_open[-1]), int(total[-1])
            else:
                seen, told, crowds = seen + len(token) - old, bool(is_open[-1]), int(total[-1])
            kept = slice(start[-1], start[-1] + (PIVOTS if told else PIVOTS + 1))
            held = [c[kept] for c in (token, gid, n, m, least, own, has, weight)]
        if seen:
            token, gid, n, _, least, own, has, weight = held
            if not told:
                yield rows(3, token, gid, n, own, least, has, weight)
            edge = slice(0, PIVOTS)
            yield rows(2, *(c[edge] for c in (token, gid, n, own, least, has, weight)))

    return pairs


def _indexed(index: DataFrame, join: Join) -> DataFrame:
    """A staged table of the rows (token, gid, n, m) that can pair, with ``least``, ``own``, ``has`` and ``weight``.

    ``least`` is the number of prefix elements that a group must share with any other,
    ``own`` that of its elements which no other group has in its prefix, ``has`` that of
    its elements in the index. A token stands for the ``weight`` that the same groups have.
    """
    index = index.repartition("token")
    shared = index.groupBy("token").agg(
        F.count(F.lit(1)).alias("times"), F.min("n").alias("low"), F.max("n").alias("high")
    )
    met = index.join(shared.where("times > 1"), "token")
    # Of the sizes that it meets, those that could link; the most unlike one needs least.
    p, n = join.percent, F.col("n")
    low = F.greatest("low", F.ceil(p * n / 100))
    high = F.least("high", F.floor(100 * n / p))
    met = met.where(F.col("low") <= F.floor(100 * n / p)).where(F.col("high") >= F.ceil(p * n / 100))
    # Rounding lets a size between need one less than the largest.
    least = F.least(join.needed(n, F.least(low, n)), join.needed(n, F.greatest(high, n)) - 1)
    groups = met.groupBy("gid", "n", "m").agg(
        F.sort_array(F.collect_list(F.struct("times", "token"))).alias("tokens"),
        F.greatest(F.min(least), F.lit(1)).cast("long").alias("least"),
    )
    groups = groups.where(F.size("tokens") >= F.col("least"))
    own = (n - join.after_prefix(n) - F.size("tokens")).cast("long")
    has = F.size("tokens") - F.col("least").cast("int") + 1
    kept = F.slice("tokens", F.lit(1), has)
    rows = groups.select(
        F.explode(kept).alias("at"), "gid", "n", "m", "least", own.alias("own"), has.cast("long").alias("has")
    )
    rows = staged(rows.select(F.col("at.token").alias("token"), "gid", "n", "m", "least", "own", "has"))
    # Two hashes of 64 bits tell a token's groups; one group alone pairs nothing.
    told = [F.bit_xor(F.xxhash64(F.lit(i), "gid")).alias(f"s{i}") for i in (1, 2)]
    sets = rows.groupBy("token").agg(F.count(F.lit(1)).alias("groups"), *told).where("groups > 1")
    alike = sets.groupBy("groups", "s1", "s2").agg(F.min("token").alias("token"), F.count(F.lit(1)).alias("weight"))
    index = staged(rows.join(alike.select("token", "weight"), "token"))
    unstage(rows)
    return index


def _met_heads(runs: DataFrame, join: Join) -> DataFrame:
    """Pairs of the groups of runs at partitions' edges with the first of the whole run.

    The first of a run are the first of its part in some partition, so they are among
    the rows of kind 2. A partition has two edges: there are few heads, whatever the rows.
    """
    edges = runs.where("kind = 2").select("x", "y", "n", "k", "least", "has").distinct()
    rank = F.row_number().over(Window.partitionBy("x").orderBy("k", "y"))
    heads = staged(
        edges.withColumn("at", rank)
        .where(F.col("at") <= PIVOTS)
        .select(
            F.col("x").alias("token"),
            F.col("y").alias("head"),
            *[F.col(c).alias(f"head_{c}") for c in ("n", "least", "has")],
        )
    )
    few = heads.count() <= BROADCAST_ROWS
    rows = runs.where("kind = 3").select(
        F.col("x").alias("token"), F.col("y").alias("gid"), "n", "least", "has", "weight"
    )
    could = join.could_share("n", "head_n", F.greatest("least", "head_least"), F.least("has", "head_has"))
    met = rows.join(F.broadcast(heads) if few else heads, "token").where("gid <> head").where(could)
    # A pair of two heads is met from both sides.
    return met.select(
        "token",
        F.least("gid", "head").alias("x"),
        F.greatest("gid", "head").alias("y"),
        F.least("n", "head_n").alias("n"),
        F.greatest("n", "head_n").alias("k"),
        F.greatest("least", "head_least").alias("least"),
        "weight",
    ).distinct()


def _expanded(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """Class pairs of group pairs (a, b): each member meets the other group's pivots."""
    # Ranks to a limit are taken in every task before the shuffle, so no group is gathered.
    rank = F.row_number().over(Window.partitionBy("gid").orderBy("cid"))
    pivots = members.withColumn("rank", rank).where(F.col("rank") <= GROUP_PIVOTS).drop("rank")

    def met(left: DataFrame, right: DataFrame) -> DataFrame:
        left = left.select(F.col("gid").alias("a"), F.col("cid").alias("ca"))
        right = right.select(F.col("gid").alias("b"), F.col("cid").alias("cb"))
        return pairs.join(left, "a").join(right, "b").where("ca <> cb")

    both = met(pivots, members).union(met(members, pivots))
    return both.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct()


def _texts_of(nodes: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """The distinct texts of the keys in a staged table, as (node, text)."""
    texts = docs.select(F.col(key).cast("long").alias("node"), F.col(text).alias("text"))
    few = nodes.count() <= BROADCAST_ROWS
    texts = texts.join(F.broadcast(nodes) if few else nodes, "node", "left_semi")
    return texts.dropDuplicates(["node", "text"])


def _verified(pairs: DataFrame, docs: DataFrame, key: str, text: str, join: Join) -> DataFrame:
    """The pairs (a, b) of class keys whose whole sets link."""
    # A pair is verified where its end with fewer pairs lives: a pivot's text travels to
    # the cells of its members, theirs only to their own.
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node")
    degree = ends.agg(F.count(F.lit(1)).alias("degree"))
    home = components(pairs)
    sized = home.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / CELL_CLASSES).alias("parts"))
    cell = F.xxhash64("component", F.pmod(F.xxhash64("node"), F.col("parts")))
    side = home.join(sized, "component").join(degree, "node").select("node", "degree", cell.alias("cell"))
    side = staged(side)
    unstage(home)

    def of(end: str) -> DataFrame:
        return side.select(
            F.col("node").alias(end), F.col("degree").alias(f"d{end}"), F.col("cell").alias(f"cell_{end}")
        )

    at = F.when(F.struct("da", "a") < F.struct("db", "b"), F.col("cell_a")).otherwise(F.col("cell_b"))
    placed = staged(pairs.join(of("a"), "a").join(of("b"), "b").select(at.alias("cell"), "a", "b"))
    needed = placed.select(F.col("cell").alias("place"), F.explode(F.array("a", "b")).alias("node"))
    cells = _texts_of(side.select("node"), docs, key, text).join(needed.distinct(), "node")
    cells = cells.select(F.col("place").alias("cell"), "node", "text")

    def linked_sets(x: np.ndarray, y: np.ndarray) -> bool:
        if join.percent * max(len(x), len(y)) > 100 * min(len(x), len(y)):
            return False
        both = np.concatenate((x, y))
        both.sort()
        common = int(np.count_nonzero(both[1:] == both[:-1]))
        return 100 * common >= join.percent * (len(both) - common)

    def linked(texts: pa.Table, pairs: pa.Table) -> pa.Table:
        nodes = texts["node"].to_numpy()
        sets: dict[int, list[np.ndarray]] = {}
        if len(pairs):
            for part in slices(texts["text"].combine_chunks()):
                value, rows = _elements(part, join, np.zeros(0, np.uint64))
                ends = np.searchsorted(rows, np.arange(len(part) + 1))
                for i in range(len(part)):
                    own = value[ends[i] : ends[i + 1]]
                    if len(own):
                        sets.setdefault(int(nodes[part.first_row + i]), []).append(own)
        found = [
            (a, b)
            for a, b in zip(pairs["a"].to_pylist(), pairs["b"].to_pylist(), strict=True)
            if any(linked_sets(x, y) for x in sets[a] for y in sets[b])
        ]
        columns = np.array(found, np.int64).reshape(-1, 2).T
        return pa.table({"a": columns[0], "b": columns[1]})

    matched = cells.groupBy("cell").cogroup(placed.groupBy("cell"))
    links = staged(matched.applyInArrow(linked, "a long, b long"))
    unstage(side, placed)
    return links


def _changes(rows: DataFrame, docs: DataFrame, key: str, text: str, join: Join) -> DataFrame:
    """Of staged rows (pivot, cid, component), each text's changes of the pivot's text.

    ``delta`` holds the elements that the text has beyond the pivot's, and those that it
    lacks as their complement; it is left empty where they are more than half of the
    text's size, ``is_far``. Two texts x and y of a pivot p have
    |p| - lacks(x) - lacks(y) + s elements in common, s being the changes that they share.
    So they link exactly when 2 * (100 + percent) * s reaches the sum of their weights.
    """
    nodes = staged(rows.select(F.explode(F.array("pivot", "cid")).alias("node")).distinct())
    texts = staged(_texts_of(nodes, docs, key, text))
    pivots = rows.select(F.col("pivot").alias("node")).distinct()
    heads = texts.join(pivots, "node").groupBy(F.col("node").alias("pivot")).agg(F.min("text").alias("head"))
    met = rows.join(texts.withColumnRenamed("node", "cid"), "cid").join(heads, "pivot")
    share = 100 + join.percent

    def sets(texts: pa.Array) -> Iterator[np.ndarray]:
        for part in slices(texts):
            value, rows = _elements(part, join, np.zeros(0, np.uint64))
            ends = np.searchsorted(rows, np.arange(len(part) + 1))
            for i in range(len(part)):
                yield value[ends[i] : ends[i + 1]].view(np.int64)

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, first, which = np.unique(batch.column(0).to_numpy(), return_index=True, return_inverse=True)
            heads = list(sets(batch.column(4).take(pa.array(first))))
            sizes, weights, deltas, far = [], [], [], []
            for own, at in zip(sets(batch.column(3)), which, strict=True):
                head = heads[at]
                lacks = np.setdiff1d(head, own, assume_unique=True)
                changes = np.concatenate((np.setdiff1d(own, head, assume_unique=True), ~lacks))
                far.append(2 * len(changes) > len(own))
                sizes.append(len(own))
                weights.append(2 * join.percent * len(own) + share * (2 * len(lacks) - len(head)))
                deltas.append(changes[: 0 if far[-1] else None])
            offsets = np.r_[0, np.cumsum([len(d) for d in deltas])].astype(np.int32)
            delta = pa.ListArray.from_arrays(
                pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *deltas]))
            )
            columns = [batch.column(0), batch.column(1), batch.column(2)]
            columns += [pa.array(np.array(c, np.int64)) for c in (sizes, weights)]
            yield pa.RecordBatch.from_arrays(
                [*columns, delta, pa.array(far, pa.bool_())],
                ["pivot", "cid", "component", "n", "weight", "delta", "is_far"],
            )

    schema = "pivot long, cid long, component long, n long, weight long, delta array<long>, is_far boolean"
    found = met.select("pivot", "cid", "component", "text", "head").mapInArrow(in_pieces(compared), schema)
    # Another text of a class's key may be blank; that set links with nothing.
    found = staged(found.where("n > 0").withColumn("copy", F.xxhash64("delta")))
    unstage(nodes, texts)
    return found


def _linked_by_changes(
    rows: DataFrame, docs: DataFrame, key: str, text: str, join: Join
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links and pairs yet to verify, (a, b) each, that may join components of a pivot's rows.

    Third, the rows (pivot, cid) that are far from their pivot, whose pairs are not among them.
    """
    compared = _changes(rows, docs, key, text, join)
    far = staged(compared.where("is_far").select("pivot", "cid").distinct())
    changed = compared.where("NOT is_far")
    share = 2 * (100 + join.percent)
    low = F.min(F.struct("weight", "cid", "component")).alias("low")
    best = changed.groupBy("pivot", "component").agg(low).select("pivot", "low.*")
    first = best.groupBy("pivot").agg(low).select(
        "pivot", *[F.col(f"low.{c}").alias(f"first_{c}") for c in ("weight", "cid", "component")]
    )
    best = staged(best.join(first, "pivot"))
    # Where any two need share nothing, each of them links with the lightest of all.
    is_near = (F.col("component") != F.col("first_component")) & (F.col("weight") + F.col("first_weight") <= 0)
    links = staged(best.where(is_near).select(F.col("cid").alias("a"), F.col("first_cid").alias("b")))
    heart = F.when(is_near, F.col("first_component")).otherwise(F.col("component"))
    hearted = best.withColumn("heart", heart)
    apart = hearted.where("heart <> first_component").groupBy("pivot").agg(F.min("weight").alias("second_weight"))
    names = ("pivot", "component", "heart", "first_component", "first_weight")
    hearts = hearted.select(*names).join(apart, "pivot")
    lightest = F.when(F.col("heart") == F.col("first_component"), F.col("second_weight"))
    lightest = lightest.otherwise(F.col("first_weight"))
    least = F.greatest(F.ceil((F.col("weight") + lightest) / share), F.lit(1)).cast("int")
    row = ("pivot", "cid", "copy", "heart", "n", "weight", "least")
    at = changed.join(hearts, ["pivot", "component"]).withColumn("least", least)
    at = staged(at.where(F.size("delta") >= F.col("least")).select(*row, F.explode("delta").alias("element")))
    # Only changes found in several components can link any.
    times = at.groupBy("pivot", "element").agg(
        F.count(F.lit(1)).alias("times"), F.min("heart").alias("lo"), F.max("heart").alias("hi")
    )
    met = at.join(times.where("lo <> hi").drop("lo", "hi"), ["pivot", "element"])
    met = met.groupBy(*row).agg(F.sort_array(F.collect_list(F.struct("times", "element"))).alias("delta"))
    met = met.where(F.size("delta") >= F.col("least"))
    kept = F.slice("delta", F.lit(1), F.size("delta") - F.col("least") + 1)
    met = staged(met.select(*row, F.explode(kept).alias("at")).select(*row, F.col("at.element").alias("element")))
    other = met.select("pivot", "element", *[F.col(c).alias(f"o_{c}") for c in row[1:]])
    both = met.join(other, ["pivot", "element"]).where(
        (F.col("cid") < F.col("o_cid"))
        & (F.col("heart") != F.col("o_heart"))
        & (join.percent * F.greatest("n", "o_n") <= 100 * F.least("n", "o_n"))
    )
    both = both.groupBy(*row, *[f"o_{c}" for c in row[1:]]).agg(F.count(F.lit(1)).alias("common"))
    # Of what two share, all but fewer than the larger ``least`` is indexed in both.
    most = F.col("common") + F.greatest("least", "o_least") - 1
    both = both.where(share * most >= F.col("weight") + F.col("o_weight"))
    pairs = staged(both.select(F.col("cid").alias("a"), F.col("o_cid").alias("b")).distinct())
    unstage(compared, best, at, met)
    return links, pairs, far


def similar(
    docs: DataFrame, join: Join, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_shingles and component_id, the least key reachable by links."""
    spark = docs.sparkSession
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    frequent = frequent_elements(docs, text, join)
    sets = shingle_sets(docs, key, text, join, frequent, max(BUCKETS * shuffles, LEAST_BUCKETS))
    sets = staged(sets.withColumns({"h1": F.xxhash64("n", "prefix"), "h2": F.xxhash64(F.lit(1), "prefix", "n")}))
    whole = sets.where("n > 0 AND doc_id IS NOT NULL")
    classes = whole.groupBy("n", "f1", "f2").agg(
        F.min("doc_id").alias("cid"), F.min("place").alias("place"), *[F.first(h).alias(h) for h in ("h1", "h2")]
    )
    firsts = classes.groupBy("h1", "h2").agg(F.min("cid").alias("gid"), F.min("place").alias("head"))
    grouped = staged(classes.drop("place").join(firsts, ["h1", "h2"]))
    # Rows of one key are one document, whatever their texts.
    known = whole.select("doc_id", "place", "n", "f1", "f2").join(grouped, ["n", "f1", "f2"])
    known = staged(known.select("doc_id", "cid", "place", "head"))
    same = known.where("doc_id <> cid").select(F.col("doc_id").alias("a"), F.col("cid").alias("b")).distinct()
    members = grouped.select("gid", "cid")
    sized = grouped.groupBy("gid", "h1", "h2").agg(
        F.count(F.lit(1)).alias("m"), F.first("n").alias("n"), F.first("head").alias("head")
    )
    families = _families(sets, known.where("place <> head").select(F.col("place").alias("a"), F.col("head").alias("b")))
    family = families.select(F.col("node").alias("head"), F.col("component").alias("family"))
    marked = staged(sized.select("gid", "n", F.col("m").cast("long").alias("m"), "head").join(family, "head"))
    several = marked.groupBy("family").count().where("count > 1").select("family")
    near = staged(marked.join(several, "family", "left_semi").withColumnRenamed("head", "place"))
    prefixes = sets.where("n > 0").select("place", "prefix")
    index = prefixes.join(F.broadcast(near) if near.count() <= BROADCAST_ROWS else near, "place")
    index = index.select("family", F.explode("prefix").alias("token"), "gid", "n", "m")
    # Within an element's place in the order, told apart by family.
    own = F.xxhash64("token", "family").bitwiseAND(F.lit((1 << 32) - 1))
    token = F.col("token").bitwiseAND(F.lit(-1 << 32)).bitwiseOR(own)
    index = index.select(token.alias("token"), "gid", "n", "m")
    index = _indexed(index, join)
    sizes = staged(sets.where("n IS NOT NULL").select("doc_id", "n"))
    unstage(sets, families, marked, near)
    rows = index.select("token", "gid", "n", "m", "least", "own", "has", "weight")
    rows = rows.repartitionByRange(shuffles, "token", "own", "gid").sortWithinPartitions("token", "own", "gid")
    schema = "kind long, x long, y long, n long, k long, least long, has long, weight long"
    met = rows.mapInArrow(_run_pairs(join), schema)
    # A pair that could link has as many indexed elements in common: all that it needs but
    # those that neither index holds.
    needed = join.needed(F.col("n"), F.col("k")) - F.col("least") + 1
    is_pair = F.col("kind").isin(1, 4)
    ends = {"n": F.when(is_pair, F.least("n", "k")), "k": F.when(is_pair, F.greatest("n", "k"))}
    met = met.withColumns({c: F.coalesce(size, c) for c, size in ends.items()})
    pair = ("x", "y", "n", "k", "least")
    counted = F.sum("weight").alias("common")
    runs = staged(met.groupBy("kind", *pair).agg(counted, F.max("has").alias("has"), F.max("weight").alias("weight")))
    unstage(index)
    heads = _met_heads(runs, join).groupBy(*pair).agg(counted)
    runs_of = runs.drop("has", "weight")
    met = runs_of.where("kind IN (1, 4)").unionByName(heads.withColumn("kind", F.lit(5).cast("long")))

    def met_as(kind: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("common"))), F.lit(0))

    # What is met with a run's first may have been met within a partition too.
    common = met_as(1) + F.greatest(met_as(4), met_as(5))
    met = met.groupBy(*pair).agg(common.alias("common")).where(F.col("common") >= needed)
    larger = sized.where("m > 1").select("gid")
    members = staged(members)
    group_pairs = met.select("x", "y")
    group_pairs = group_pairs.union(larger.select(F.col("gid").alias("x"), F.col("gid").alias("y")))
    group_pairs = group_pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    pairs = staged(_expanded(group_pairs.distinct(), members))
    links = _verified(pairs, docs, key, text, join)
    found = components(links.union(same))
    # Runs that were not wholly paired are looked at again, across their components.
    open_rows = runs.where("kind = 3").select(
        F.col("x").alias("token"), F.col("y").alias("gid"), "n", "least", "has", "weight", F.col("k").alias("changes")
    )
    large = sized.where(F.col("m") > GROUP_PIVOTS + 1)
    # Members of one group have equal prefixes: what the index has of them bounds no pair.
    one, none = F.lit(1), F.lit(0)
    open_rows = open_rows.union(large.select(F.col("gid").alias("token"), "gid", "n", one, none, one, none))
    member_rows = open_rows.distinct().join(members.select("gid", "cid"), "gid")
    named = member_rows.join(found.withColumnRenamed("node", "cid"), "cid", "left").select(
        "token", "gid", "cid", "n", "least", "has", "weight", "changes", F.coalesce("component", "cid").alias("component")
    )
    mixed = named.groupBy("token").agg(
        F.min("component").alias("lo"),
        F.max("component").alias("hi"),
        F.count(F.lit(1)).alias("rows"),
        F.min(F.struct("changes", "cid")).alias("first"),
    )
    mixed = mixed.where("lo <> hi").select(
        "token", F.when(F.col("rows") > SHORT_RUN, F.col("first.cid")).alias("pivot")
    )
    named = staged(named.drop("changes").join(mixed, "token"))
    # A pivot's runs become one, whose pairs hold those of each.
    long_rows = staged(named.where("pivot IS NOT NULL").select("pivot", "cid", "component").distinct())
    changed = [] if long_rows.isEmpty() else _linked_by_changes(long_rows, docs, key, text, join)
    # A pair is made at the first element that both have, where lists of them are short.
    lists = named.groupBy("gid").agg(F.sort_array(F.collect_set(F.struct("token", "weight"))).alias("own"))
    lists = lists.select("gid", F.when(F.size("own") <= LISTED_ELEMENTS, F.col("own")).alias("own"))
    # Of long runs, pairs with an end far from the pivot are made here too.
    rows = named.withColumn("whole", F.col("pivot").isNull())
    if changed:
        far = changed[2].withColumn("is_far", F.lit(True))
        whole = F.col("whole") | F.col("is_far").isNotNull()
        rows = rows.join(far, ["pivot", "cid"], "left").withColumn("whole", whole)
    wanted = rows.where("whole").select("token").distinct()
    left = staged(rows.join(wanted, "token", "left_semi").join(lists, "gid"))
    unstage(named)
    names = ("gid", "cid", "n", "least", "has", "component", "own", "whole")
    other = left.select(F.col("token").alias("o_token"), *[F.col(c).alias(f"o_{c}") for c in names])
    shared = F.array_intersect("own", "o_own")
    could = join.could_share("n", "o_n", F.greatest("least", "o_least"), F.least("has", "o_has"))
    rest = left.where("whole").join(
        other,
        (F.col("token") == F.col("o_token"))
        & ((F.col("cid") < F.col("o_cid")) | ~F.col("o_whole"))
        & (F.col("component") != F.col("o_component"))
        & ((F.col("gid") == F.col("o_gid")) | could)
        & F.coalesce(F.get(shared, F.lit(0))["token"] == F.col("token"), F.lit(True)),
    )
    rest = rest.select(
        F.least("cid", "o_cid").alias("a"),
        F.greatest("cid", "o_cid").alias("b"),
        F.least("gid", "o_gid").alias("x"),
        F.greatest("gid", "o_gid").alias("y"),
        F.least("n", "o_n").alias("n"),
        F.greatest("n", "o_n").alias("k"),
        F.greatest("least", "o_least").alias("least"),
        F.when(F.size(shared) > 0, F.aggregate(shared, F.lit(0).cast("long"), lambda sum_, at: sum_ + at["weight"]))
        .otherwise(F.col("weight"))
        .alias("met"),
    )
    rest = rest.groupBy("a", "b", *pair).agg(F.sum("met").alias("in_open"))
    # With what they share in wholly paired runs, all of what their prefixes share.
    closed = runs.where("kind = 1").select("x", "y", F.col("common").alias("in_closed"))
    rest = rest.join(closed, ["x", "y"], "left")
    common = F.col("in_open") + F.coalesce("in_closed", F.lit(0))
    rest = rest.where((F.col("x") == F.col("y")) | (common >= needed))
    rest = rest.select("a", "b")
    for more in changed[1:2]:
        rest = rest.union(more)
    rest = staged(rest.distinct().join(pairs, ["a", "b"], "left_anti"))
    further = list(changed[:1])
    if not rest.isEmpty():
        further.append(_verified(rest, docs, key, text, join))
    final = found
    if further:
        ends = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        for more in further:
            ends = ends.union(more)
        final = components(ends)
        unstage(found)
    unstage(runs, members, pairs, links, long_rows, left, rest, grouped, known, *changed, *further[len(changed[:1]) :])
    return sizes.join(final, sizes["doc_id"] == final["node"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
    )
