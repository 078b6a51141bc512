"""Outcome rates by coded groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import code_label

COUNT = "respondent_count"
RATE = "disease_rate"
PERCENT = "rate_percent"


def present(keys: Sequence[str]) -> Column:
    """True where no key is NULL."""
    every = F.lit(True)
    for key in keys:
        every = every & F.col(key).isNotNull()
    return every


def rate_by(
    df: DataFrame,
    keys: Sequence[str],
    target: str,
    where: Column | None = None,
    drop_null_keys: bool = True,
    alias: Mapping[str, str] | None = None,
    percent: bool = False,
    descending: bool = False,
    rate: str = RATE,
) -> DataFrame:
    """Row count and mean (``rate``) of a 0/1 ``target`` per group, sorted by the keys.

    Counts and sums are combined before the shuffle, so it carries one row per
    group and task however the rows are spread over the groups.
    """
    if where is not None:
        df = df.where(where)
    if drop_null_keys:
        df = df.where(present(keys))
    rates = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(COUNT), F.avg(target).alias(RATE)
    )
    return _finish(rates, keys, alias, percent, descending, rate)


def rate_grain(df: DataFrame, keys: Sequence[str], target: str) -> DataFrame:
    """Counts and target sums at the finest grain of several coded keys.

    Every rate over a subset of ``keys`` follows from it by ``roll_up`` without
    reading the rows again. Its size is the product of the code domains.
    """
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(target).alias("known"),
        F.sum(target).alias("positive"),
    )


def roll_up(
    grain: DataFrame,
    keys: Sequence[str],
    where: Column | None = None,
    alias: Mapping[str, str] | None = None,
    percent: bool = False,
    descending: bool = False,
    rate: str = RATE,
) -> DataFrame:
    """The result of ``rate_by`` computed from a ``rate_grain``, NULL targets included."""
    if where is not None:
        grain = grain.where(where)
    rates = (
        grain.where(present(keys))
        .groupBy(*keys)
        .agg(
            F.sum("n").alias(COUNT),
            F.sum("known").alias("known"),
            F.sum("positive").alias("positive"),
        )
        .withColumn(RATE, F.try_divide("positive", "known"))
    )
    return _finish(rates, keys, alias, percent, descending, rate)


def _finish(
    rates: DataFrame,
    keys: Sequence[str],
    alias: Mapping[str, str] | None,
    percent: bool,
    descending: bool,
    rate: str,
) -> DataFrame:
    alias = alias or {}
    order = [F.desc(k) if descending else F.asc(k) for k in keys]
    values = [F.col(COUNT), F.col(RATE).alias(rate)]
    if percent:
        values.append((F.col(RATE) * 100).alias(PERCENT))
    return rates.orderBy(*order).select(*[F.col(k).alias(alias.get(k, k)) for k in keys], *values)


def label_codes(df: DataFrame, col: str, labels: Mapping[int, str], name: str) -> DataFrame:
    """Text of a coded column as ``name``; with the column's own name it is replaced."""
    return df.withColumn(name, code_label(F.col(col), labels))


def matrix_of(
    rates: DataFrame,
    row: str,
    col: str,
    values: Sequence[int],
    prefix: str,
    percent: bool = False,
) -> DataFrame:
    """Rates of two keys as a table: ``row`` down, ``col`` across, NULL for missing pairs.

    Listing the column values spares the job that would look for them; a value that
    is not listed is an error.
    """
    listed = F.col(col).isNull() | F.col(col).isin(list(values))
    message = F.concat(F.lit(f"{col} has a value that is not listed: "), F.col(col).cast("string"))
    rates = rates.withColumn(col, F.when(listed, F.col(col)).otherwise(F.raise_error(message)))
    cell = F.first(F.col(RATE) * 100 if percent else F.col(RATE))
    cells = rates.groupBy(row).pivot(col, list(values)).agg(cell).orderBy(row)
    return cells.select(row, *[F.col(f"`{v}`").alias(f"{prefix}{v}") for v in values])


def rate_matrix(
    df: DataFrame,
    row: str,
    col: str,
    values: Sequence[int],
    target: str,
    prefix: str,
    where: Column | None = None,
    percent: bool = False,
) -> DataFrame:
    """Mean target by ``row`` and ``col`` as a table; the rows are read once."""
    return matrix_of(rate_by(df, [row, col], target, where), row, col, values, prefix, percent)
