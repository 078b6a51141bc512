"""Distribution of a number by group, and deterministic samples of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlens.functions import Hasher, bucket_of, row_hash
from cohortlens.operators.blocks import running_total
from cohortlens.sources.staging import staged

QUARTILES = (0.25, 0.5, 0.75)
WHISKER = 1.5
# Hash values are cut into this many ranges when a sample has a row limit.
HASH_RANGES = 1 << 16
COPY = "copy_no"
COPY_RUN = 1_000_000  # equal rows that one task unfolds at a time


def number_equal_rows(df: DataFrame, columns: Sequence[str], name: str = COPY) -> DataFrame:
    """The rows of ``columns``, each with its number, from 1, among its equals.

    Together with the columns it is a key that depends on the rows alone, not on
    files or partitions: equal rows are interchangeable, so it does not matter which
    has which number. Equal rows are counted before the shuffle, and a count is
    unfolded in runs, so that frequent rows do not meet in one task.
    """
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    last = F.expr(f"(_n - 1) div {COPY_RUN}")
    runs = counted.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    runs = runs.repartition("_run", *columns)
    first = F.col("_run") * COPY_RUN
    numbers = F.sequence(first + 1, F.least(first + COPY_RUN, F.col("_n")))
    return runs.select(*columns, F.explode(numbers).alias(name))


def in_open_range(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """Rows with ``lo`` < ``col`` < ``hi``."""
    return df.where((F.col(col) > lo) & (F.col(col) < hi))


def box_stats(df: DataFrame, by: str, value: str, coded: bool = False) -> DataFrame:
    """Quartiles and whiskers per group, outliers left out.

    Whiskers end at the farthest values within 1.5 quartile distances of the
    box, and never inside the box. Equal values are counted before anything
    else, and quartiles come from running counts, no group in one task; that runs
    jobs. With ``coded``, for values known to be few whatever the row count, one
    task holds the distinct values of a group instead: the same result sooner.
    """
    counted = (
        df.where(F.col(by).isNotNull() & F.col(value).isNotNull())
        .groupBy(by, value)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if coded:
        points = F.array(*[F.lit(p) for p in QUARTILES])
        quartiles = counted.groupBy(by).agg(F.percentile(value, points, F.col("n")).alias("q"))
    else:
        counted = staged(running_total(counted, [by], [value], "n", "before"))
        quartiles = _ranked_quartiles(counted, by, value)
    reach = F.lit(WHISKER) * (F.col("q")[2] - F.col("q")[0])
    inside = F.col(value).between(F.col("q")[0] - reach, F.col("q")[2] + reach)
    return (
        counted.join(quartiles, by)
        .groupBy(by)
        .agg(
            F.sum("n").alias("n_values"),
            F.first("q").alias("q"),
            F.min(F.when(inside, F.col(value))).alias("lowest"),
            F.max(F.when(inside, F.col(value))).alias("highest"),
        )
        .select(
            by,
            "n_values",
            F.least("lowest", F.col("q")[0]).alias("whisker_low"),
            F.col("q")[0].alias("q1"),
            F.col("q")[1].alias("median"),
            F.col("q")[2].alias("q3"),
            F.greatest("highest", F.col("q")[2]).alias("whisker_high"),
        )
        .orderBy(by)
    )


def _ranked_quartiles(counted: DataFrame, by: str, value: str) -> DataFrame:
    """Linearly interpolated quartiles of counted values with running counts.

    Written out, as is the size of the groups, so that Spark knows how small the
    tables are that it joins.
    """
    totals = staged(counted.groupBy(by).agg(F.sum("n").alias("total")))
    sized = counted.join(totals, by)
    holds = []
    for point in QUARTILES:
        place = F.lit(point) * (F.col("total") - 1)
        lower = F.floor(place)
        for rank in (lower, F.least(lower + 1, F.col("total") - 1)):
            here = (F.col("before") <= rank) & (rank < F.col("before") + F.col("n"))
            holds.append(F.max(F.when(here, F.col(value))))
    found = sized.groupBy(by).agg(
        F.first("total").alias("total"), *[h.alias(f"h{i}") for i, h in enumerate(holds)]
    )
    quartiles = []
    for i, point in enumerate(QUARTILES):
        place = F.lit(point) * (F.col("total") - 1)
        part = place - F.floor(place)
        low, high = F.col(f"h{2 * i}"), F.col(f"h{2 * i + 1}")
        quartiles.append(low * (1 - part) + high * part)
    return staged(found.select(by, F.array(*quartiles).alias("q")))


def hash_sample(
    df: DataFrame,
    key: Sequence[str],
    columns: Sequence[str],
    per_mille: int,
    limit: int | None = None,
    salt: str = "",
    hasher: Hasher = row_hash,
) -> DataFrame:
    """``columns`` of about ``per_mille`` of 1000 rows, chosen by the hash of ``key``.

    The same rows come back whatever the partitioning; rows of equal key stay
    together. With ``limit``, the rows of lowest hash are kept, ties settled by
    the output columns. The hash ranges that can hold them are found first from
    one count per range, and equal rows travel as one row with a count; the cut
    among what is left is made by running counts, in no single task. Runs jobs.
    """
    hashed = df.select(hasher(key, salt).alias("_hash"), *columns)
    sampled = hashed.where(bucket_of(F.col("_hash")) < per_mille)
    if limit is None:
        return sampled.select(*columns)

    span = (1 << 32) // HASH_RANGES
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    last_range = (
        sampled.groupBy(F.expr(f"_hash div {span}").alias("_range"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("earlier", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .where(F.col("earlier") < limit)
        .agg(F.max("_range").alias("last"))
    )
    candidates = sampled.where(F.expr(f"_hash div {span}") <= last_range.scalar())
    distinct = candidates.groupBy("_hash", *columns).agg(F.count(F.lit(1)).alias("n"))
    placed = running_total(distinct, [], ["_hash", *columns], "n", "_earlier")
    room = F.lit(limit) - F.col("_earlier")
    return (
        placed.withColumn("take", F.least(F.col("n"), room))
        .where(F.col("take") > 0)
        .select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("take"))).alias("_copy"))
        .drop("_copy")
    )
