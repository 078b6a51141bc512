"""Readers for yearly files, landed parts and the cleaned table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.functions import LEADING_YEAR, PART_YEAR, year_from_name
from cohortlens.sources.headers import as_paths, header_groups
from cohortlens.spec import SurveySpec

YEARLY_GLOB = "[0-9][0-9][0-9][0-9]*.csv"
# Where a row lies in its input: file, first byte of its split, row within the split.
POSITION_COLUMNS = ("source_file", "source_split", "source_row")
ROW_KEY = ("stored_file", "stored_row")


def with_file_year(
    df: DataFrame,
    pattern: str,
    strict: bool = False,
    name_col: str | None = None,
    year: str = "YEAR",
) -> DataFrame:
    """Set ``year`` from the base file name, replacing any such column of the file."""
    name = F.col(name_col or "_metadata.file_name")
    kept = [F.col(f"`{c}`") for c in df.columns if c != year]
    return df.select(year_from_name(name, pattern, strict).alias(year), *kept)


def read_survey(
    spark: SparkSession,
    paths: str | Sequence[str],
    spec: SurveySpec,
    year_pattern: str = PART_YEAR,
    strict: bool = False,
    glob: str | None = None,
    positions: bool = False,
) -> DataFrame:
    """Raw CSV files as one frame of the survey's columns, matched by header name.

    Every column is text except the year, which comes from the file name. Columns
    a file lacks are NULL. Paths may be one path, a list, or hold wildcards of any
    file system Spark can reach. ``positions`` adds ``POSITION_COLUMNS``.
    """
    answers = [c for c in spec.columns if c != spec.year]
    frames = []
    for layout in header_groups(spark, paths, answers, glob):
        present = [c for c in answers if c in layout.names]
        reader = (
            spark.read.schema(layout.schema)
            .option("header", True)
            .option("enforceSchema", False)
            .option("columnPruning", True)
            .option("escape", '"')
        )
        if glob:
            reader = reader.option("pathGlobFilter", glob)
        scan = reader.csv(list(layout.paths))
        columns = [
            F.col(f"`{c}`") if c in present else F.lit(None).cast("string").alias(c)
            for c in answers
        ]
        year = year_from_name(F.col("_metadata.file_name"), year_pattern, strict)
        if positions:
            columns += [
                F.col("_metadata.file_path").alias(POSITION_COLUMNS[0]),
                F.col("_metadata.file_block_start").alias(POSITION_COLUMNS[1]),
                F.monotonically_increasing_id().alias(POSITION_COLUMNS[2]),
            ]
        frames.append(scan.select(year.alias(spec.year), *columns))
    raw = reduce(DataFrame.unionByName, frames)
    extra = POSITION_COLUMNS if positions else ()
    return raw.select(*spec.columns, *extra)


def read_yearly(
    spark: SparkSession, directory: str, spec: SurveySpec, positions: bool = False
) -> DataFrame:
    """All ``YYYY*.csv`` files of a directory; the name's leading year is required."""
    return read_survey(
        spark,
        directory,
        spec,
        year_pattern=LEADING_YEAR,
        strict=True,
        glob=YEARLY_GLOB,
        positions=positions,
    )


def read_parts(
    spark: SparkSession, uri: str | Sequence[str], spec: SurveySpec, fmt: str = "parquet"
) -> DataFrame:
    """Parts of one or more folders that ``write_parts`` landed: text columns, year from
    the directory.
    """
    answers = [T.StructField(c, T.StringType()) for c in spec.columns if c != spec.year]
    schema = T.StructType([*answers, T.StructField(spec.year, T.IntegerType())])
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    frames = [reader.format(fmt).load(folder).select(*spec.columns) for folder in as_paths(uri)]
    return reduce(DataFrame.unionByName, frames)


def read_cleaned(
    spark: SparkSession,
    path: str | Sequence[str],
    spec: SurveySpec,
    view: str | None = None,
    fmt: str = "parquet",
    row_key: bool = False,
) -> DataFrame:
    """The cleaned table under its fixed schema, as a temp view too if named.

    Without inference, a column that holds only NULLs keeps its type. ``row_key``
    adds ``ROW_KEY``, the place of each row in the stored Parquet table.
    """
    schema = spec.cleaned_schema
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    key = (
        [
            F.col("_metadata.file_name").alias(ROW_KEY[0]),
            F.col("_metadata.row_index").alias(ROW_KEY[1]),
        ]
        if row_key
        else []
    )
    cleaned = reader.schema(schema).format(fmt).load(as_paths(path)).select(*schema.names, *key)
    if view:
        cleaned.createOrReplaceTempView(view)
    return cleaned
