"""Row positions, numbered blocks and per-group caps, without a global sort."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from cohortlens.sources.staging import staged

SLICE = "slice_no"
SLICE_ROW = "slice_row"
CHUNK = "chunk_no"


def stage_in_order(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` range-partitioned and sorted by ``by`` and ``order``, written once.

    Adds the slice (partition) of each row and its running number. A group that
    holds many rows spans as many slices as it needs; ``order`` must be unique in
    it, as equal keys cannot be parted. Runs a job.
    """
    keys = [*by, *order]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return staged(
        ranged.select(
            *df.columns,
            F.spark_partition_id().alias(SLICE),
            F.monotonically_increasing_id().alias(SLICE_ROW),
        )
    )


def number_chunks(
    slices: DataFrame,
    chunk_size: int,
    by: Sequence[str],
    slice_col: str = SLICE,
    row_col: str = SLICE_ROW,
    max_chunks: int = 0,
) -> DataFrame:
    """Block number, from 1, of every row of a staged frame by its position in ``by``.

    A row's position is the row count of the earlier slices of its group plus its
    distance from the first row of its slice; the running sum is over one row per
    slice. With ``max_chunks`` only rows of the first blocks remain, and slices
    past the cap are dropped before the join. Runs a job over the slice columns.
    """
    offsets = (
        slices.groupBy(*by, slice_col)
        .agg(F.count(F.lit(1)).alias("n"), F.min(row_col).alias("first_row"))
        .withColumn("offset", F.coalesce(F.sum("n").over(_earlier(by, slice_col)), F.lit(0)))
        .drop("n")
    )
    if max_chunks:
        offsets = offsets.where(F.col("offset") < max(max_chunks, 0) * chunk_size)
    numbered = _with_offsets(slices, offsets, [*by, slice_col])
    position = F.col("offset") + F.col(row_col) - F.col("first_row")
    kept = [c for c in slices.columns if c not in (slice_col, row_col)]
    numbered = numbered.withColumn("position", position).select(
        *kept, F.expr(f"cast(position div {int(chunk_size)} + 1 as bigint)").alias(CHUNK)
    )
    return cap_chunks(numbered, max_chunks)


def running_total(
    df: DataFrame, by: Sequence[str], order: Sequence[str], amount: str, name: str
) -> DataFrame:
    """Sum of ``amount`` over the earlier rows of the group in ``order``, as ``name``.

    Groups of any size: sums run inside slices, and over one total per slice.
    ``order`` must be unique within a group. Runs jobs.
    """
    slices = stage_in_order(df, by, order)
    offsets = (
        slices.groupBy(*by, SLICE)
        .agg(F.sum(amount).alias("slice_total"))
        .withColumn("offset", F.coalesce(F.sum("slice_total").over(_earlier(by, SLICE)), F.lit(0)))
        .drop("slice_total")
    )
    before = (
        Window.partitionBy(*by, SLICE)
        .orderBy(SLICE_ROW)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = F.coalesce(F.sum(amount).over(before), F.lit(0))
    joined = _with_offsets(slices, offsets, [*by, SLICE])
    return joined.select(*df.columns, (F.col("offset") + inside).alias(name))


def _earlier(by: Sequence[str], slice_col: str) -> WindowSpec:
    """The slices of the same group before this one."""
    return Window.partitionBy(*by).orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)


def _with_offsets(slices: DataFrame, offsets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the values of their slice, a table whose size Spark knows as it is written."""
    values = [c for c in offsets.columns if c not in keys]
    offsets = staged(offsets.select(*[F.col(k).alias(f"o_{k}") for k in keys], *values))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"o_{k}")) for k in keys])
    return slices.join(offsets, same)


def cap_chunks(df: DataFrame, max_chunks: int, chunk: str = CHUNK) -> DataFrame:
    """The first ``max_chunks`` blocks of each group; 0 keeps all, a negative cap none."""
    return df if max_chunks == 0 else df.where(F.col(chunk) <= max_chunks)
