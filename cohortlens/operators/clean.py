"""Row filters and derived columns of the cleaned table."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions import additive_score, binary_flag

#: Years have four digits, so there are more bins than years, and only equal ones are merged.
YEARS = 10_000


def keep_valid_target(df: DataFrame, col: str, codes: Sequence[int]) -> DataFrame:
    """Rows whose outcome code is one of ``codes``; NULL never is."""
    return df.where(F.col(col).isin(*codes))


def add_target(df: DataFrame, col: str, yes: int, name: str) -> DataFrame:
    """0/1 outcome: 1 for code ``yes``, else 0."""
    return df.withColumn(name, F.when(F.col(col) == yes, F.lit(1)).otherwise(F.lit(0)))


def add_scaled(df: DataFrame, col: str, divisor: int, name: str) -> DataFrame:
    """A number stored as an integer multiple, back in its own unit."""
    return df.withColumn(name, F.col(col).cast("double") / F.lit(divisor))


def recode_binary(df: DataFrame, rules: Mapping[str, tuple[str, int, int]]) -> DataFrame:
    """Three-valued flags: output name → (source, yes code, no code)."""
    return df.withColumns({out: binary_flag(*rule) for out, rule in rules.items()})


def add_score(df: DataFrame, flags: Sequence[str], name: str) -> DataFrame:
    """Number of set flags; NULL if any flag is NULL."""
    return df.withColumn(name, additive_score(flags))


def quality_report(df: DataFrame, key: str, name: str = "row_count") -> DataFrame:
    """Rows per key in one aggregation; the total is the sum over it."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name)).orderBy(key)


def observed_counts(df: DataFrame, key: str) -> tuple[DataFrame, Observation]:
    """``df``, and its rows per year ``key`` as a by-product of whatever runs it next."""
    observation = Observation()
    return (
        df.observe(
            observation,
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col(key).isNull()).alias("without"),
            F.histogram_numeric(F.col(key).cast("double"), F.lit(YEARS)).alias("bins"),
        ),
        observation,
    )


def counts_of(observation: Observation, spark: SparkSession, key: str, name: str = "row_count") -> DataFrame:
    """The observed rows per ``key``, nulls first as in ``quality_report``."""
    found = observation.get
    rows = [(None, int(found["without"]))] if found["without"] else []
    counts: Counter[int] = Counter()
    for bin_ in found["bins"] or []:  # a task's bins lie beside those of others
        if bin_["x"] != int(bin_["x"]):
            raise ValueError(f"{key} has values that are no years of four digits")
        counts[int(bin_["x"])] += int(bin_["y"])
    rows += sorted(counts.items())
    return spark.createDataFrame(rows, f"`{key}` int, `{name}` long")


def preview(df: DataFrame, key: Sequence[str], rows: int = 5) -> DataFrame:
    """The first rows by ``key``, then by all other columns."""
    others = [c for c in df.columns if c not in key]
    return df.orderBy(*key, *others).limit(rows)
