"""Token counts: an exact histogram of encoded lengths, and what its suffix sums answer.

Texts are encoded and counted, and only (length, number of texts) pairs are shuffled,
combined in each batch before that. Sums over longer lengths then give, for every
length as a context limit, how many texts and ids lie within and beyond it and how
many ids truncation keeps, all exact. The sums run in blocks of lengths, with the sums
of later blocks added, so that they never pass through one task however long texts are.

Defined cases: null is the empty text, of length 0; repeated rows count each; an empty
table gives no limits, and null as every quantile.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm import in_pieces
from cohortlens.llm.textbytes import slices
from cohortlens.llm.tokens import VOCABULARY, encoder
from cohortlens.sources.staging import staged

BLOCK = 4096  # lengths summed together
COUNTS = "n_docs", "n_tokens"


def histogram(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``length`` and ``n_docs`` of every encoded length that occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [encoder(vocabulary).lengths(part) for part in slices(batch.column(0))]
            length, n = np.unique(np.concatenate(found or [np.zeros(0, np.int64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(length.astype(np.int64)), pa.array(n.astype(np.int64))], ["length", "n"]
            )

    seen = docs.select(text).mapInArrow(in_pieces(count), "length long, n long")
    return seen.groupBy("length").agg(F.sum("n").alias("n_docs"))


def limits(counted: DataFrame) -> DataFrame:
    """For each length as a limit: texts and ids from there on, and totals within it.

    ``docs_from`` and ``tokens_from`` count texts of this length or longer,
    ``truncated_tokens`` the ids left when every text is cut to this length, and
    ``share_within`` the share of texts no longer than it (the quantile it stands at).
    The histogram is written first, as its rows are used twice.
    """
    counted = staged(counted)
    rows = counted.withColumn("n_tokens", F.col("length") * F.col("n_docs"))
    rows = rows.withColumn("block", F.expr(f"length div {BLOCK}"))
    longer = Window.partitionBy("block").orderBy(F.desc("length"))
    longer = longer.rowsBetween(Window.unboundedPreceding, 0)
    blocks = rows.groupBy("block").agg(*[F.sum(c).alias(f"block_{c}") for c in COUNTS])
    # One row for every 4096 lengths up to the longest text: few, whatever the corpus.
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "block",
        *[F.coalesce(F.sum(f"block_{c}").over(later), F.lit(0)).alias(f"later_{c}") for c in COUNTS],
        *[F.sum(f"block_{c}").over(Window.partitionBy()).alias(f"all_{c}") for c in COUNTS],
    )
    summed = rows.join(blocks, "block").select(
        "length",
        *COUNTS,
        (F.sum("n_docs").over(longer) + F.col("later_n_docs")).alias("docs_from"),
        (F.sum("n_tokens").over(longer) + F.col("later_n_tokens")).alias("tokens_from"),
        "all_n_docs",
        "all_n_tokens",
    )
    within = F.col("all_n_tokens") - F.col("tokens_from")
    beyond = F.col("docs_from") - F.col("n_docs")
    return summed.select(
        "length",
        *COUNTS,
        "docs_from",
        "tokens_from",
        (within + F.col("docs_from") * F.col("length")).alias("truncated_tokens"),
        ((F.col("all_n_docs") - beyond) / F.col("all_n_docs")).alias("share_within"),
    )


def answers(counted: DataFrame, context_limits: list[int], quantiles: list[float]) -> DataFrame:
    """One row per asked limit or quantile, from the histogram alone.

    A limit's row has the ids in all, the texts longer than it and the ids that
    truncation to it keeps; a quantile's row the least length that its share of texts
    does not exceed.
    """
    each = F.explode(F.array(*[F.lit(x).cast("long") for x in context_limits])).alias("asked")
    by_limit = (
        counted.select("length", "n_docs", each)
        .groupBy("asked")
        .agg(
            F.sum(F.col("length") * F.col("n_docs")).alias("total_tokens"),
            F.sum(F.when(F.col("length") > F.col("asked"), F.col("n_docs")).otherwise(0)).alias(
                "longer_docs"
            ),
            F.sum(F.least("length", "asked") * F.col("n_docs")).alias("truncated_tokens"),
        )
    )
    at = limits(counted)
    least = at.agg(
        *[
            F.min(F.when(F.col("share_within") >= q, F.col("length"))).alias(f"q{i}")
            for i, q in enumerate(quantiles)
        ]
    )
    each = [
        F.struct(F.lit(q).alias("quantile"), F.col(f"q{i}").alias("length"))
        for i, q in enumerate(quantiles)
    ]
    rows = F.explode(F.array(*each))
    by_quantile = least.select(rows.alias("x")).select("x.quantile", "x.length")
    return by_limit.unionByName(by_quantile, allowMissingColumns=True)
