"""Column selection, alignment, union and typing of raw frames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import lenient
from cohortlens.spec import SurveySpec


def keep_available(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    available = set(df.columns)
    return df.select(*[c for c in columns if c in available])


def align_columns(df: DataFrame, spec: SurveySpec, carry: Sequence[str] = ()) -> DataFrame:
    """All survey columns in order, absent ones as typed NULL, then ``carry``."""
    available = df.columns
    if available == [*spec.columns, *carry]:
        return df
    return df.select(
        *[
            F.col(c) if c in available else F.lit(None).cast(spec.raw_type(c)).alias(c)
            for c in spec.columns
        ],
        *carry,
    )


def lenient_cast(df: DataFrame, spec: SurveySpec) -> DataFrame:
    """Survey columns in their fixed types, in one projection; other columns as they are."""
    changed = {
        f.name: lenient(F.col(f.name), f.dataType, spec.raw_type(f.name))
        for f in df.schema.fields
        if f.name in spec.columns and f.dataType != spec.raw_type(f.name)
    }
    return df.withColumns(changed) if changed else df


def align_union(
    frames: Sequence[DataFrame], spec: SurveySpec, carry: Sequence[str] = ()
) -> DataFrame:
    """Rows of all frames, matched by column name under the survey's schema."""
    aligned = [lenient_cast(align_columns(df, spec, carry), spec) for df in frames]
    return reduce(DataFrame.unionByName, aligned)
