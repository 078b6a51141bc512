"""Connected components of a table of links, by large-star and small-star rounds.

Each task first puts its own links together into stars, which leaves few rounds. Every round is two aggregations and joins of the links; hot nodes are combined
before the shuffle, and a round's links are written, so no lineage grows and no
component is ever gathered anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.sources.staging import staged, unstage


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Link the larger (``large``) or the other neighbours of each node to its least one."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    both = both.union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    if not large:
        both = both.where("v < u")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    met = both.join(least, "u")
    if large:
        met = met.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        met = met.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return met.where("a <> b").distinct()


def _own_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's links as stars about the least node of what they connect."""
    for batch in batches:
        head: dict[int, int] = {}

        def find(x: int) -> int:
            top = x
            while (up := head.get(top, top)) != top:
                top = up
            while (up := head.get(x, x)) != top:
                head[x], x = top, up
            return top

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            head[max(a, b)] = min(a, b)
        ends = [(x, find(x)) for x in head]
        ends = [e for e in ends if e[0] != e[1]]
        columns = np.array(ends, np.int64).reshape(-1, 2).T
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b"])


def _settled(links: DataFrame) -> bool:
    """Every node has one link, to a node that has none: the stars are the components."""
    ends = links.select(F.col("a").alias("x"), F.lit(1).alias("out")).union(
        links.select(F.col("b").alias("x"), F.lit(0).alias("out"))
    )
    odd = ends.groupBy("x").agg(F.sum("out").alias("n"), F.count(F.lit(1)).alias("all"))
    return odd.where((F.col("n") > 1) | ((F.col("n") > 0) & (F.col("all") > 1))).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """A staged table of ``node`` and ``component`` (least node reachable) of the nodes of links (a, b).

    Links are of longs, in either direction, repeated or looped at will; null ends
    link nothing. Nodes without a link are not returned.
    """
    ordered = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    whole = ordered.where("a <> b").where("a IS NOT NULL AND b IS NOT NULL")
    now = staged(whole.mapInArrow(_own_stars, "a long, b long").distinct())
    while not _settled(now):
        following = staged(_star(_star(now, large=True), large=False))
        unstage(now)
        now = following
    nodes = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    heads = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    found = staged(nodes.union(heads))
    unstage(now)
    return found
