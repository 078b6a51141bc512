"""Grouping of CSV files by header, because one scan knows only one header.

A multi-file CSV scan gives columns their names by position. Files whose
headers differ therefore need separate scans; each scan also checks every file
header against the expected names, so a wrong grouping fails instead of
swapping columns.
"""

from __future__ import annotations

import csv
import re
import warnings
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Lines of byte order marks and white space only.
BLANK = r"(?U)^\uFEFF*[\s\x1C-\x1F]*$"
PLACES = (1 << 33) - 1  # of a row id, the bits that count a task's rows


@dataclass(frozen=True)
class FileLayout:
    """Column names by position, and the paths of the files that share them."""

    names: tuple[str, ...]
    paths: tuple[str, ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, T.StringType()) for n in self.names])


def as_paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def layout_names(header: str | None, wanted: Sequence[str]) -> tuple[str, ...]:
    """Names for a header line: wanted columns keep theirs, others get their position.

    The first of several equal names is the one that counts.
    """
    cells = next(csv.reader([(header or "").lstrip("\ufeff")]), [])
    names: list[str] = []
    for index, cell in enumerate(cells or [""]):
        name = cell.strip()
        known = name in wanted and name not in names
        names.append(name if known else f"_position_{index}")
    return tuple(names)


def listed_files(spark: SparkSession, paths: Sequence[str], glob: str | None) -> DataFrame:
    """``path``, ``uri`` and ``length`` of every input file; contents are not read."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    listed = reader.load(list(paths))
    return listed.select("path", F.col("_metadata.file_path").alias("uri"), "length")


def escaped(path: str) -> str:
    """A listed path as a pattern that matches only itself."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


@contextmanager
def _one_split_a_task(spark: SparkSession) -> Iterator[None]:
    """Scans started within give every split of a file a task."""
    name = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, spark.conf.get("spark.sql.files.maxPartitionBytes"))
        yield
    finally:
        spark.conf.set(name, before)


def first_lines(spark: SparkSession, paths: Sequence[str], glob: str | None) -> dict[str, str]:
    """The first line that is not blank of each file, by path; files without one are left out.

    One job over the splits of all files, in Spark's own reader and without parsing
    cells; one line of each split leaves its task.
    """
    # Blank lines are passed over as in any CSV scan.
    reader = spark.read.schema("line string").option("sep", "\x01").option("quote", "")
    reader = reader.option("mode", "PERMISSIVE")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.csv(list(paths)).select(
        F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_block_start").alias("start"), "line"
    )
    written = lines.where(~F.col("line").rlike(BLANK)).withColumn("place", F.monotonically_increasing_id())
    firsts = written.where(F.col("place").bitwiseAND(PLACES) == 0).drop("place")
    with _one_split_a_task(spark):
        found = firsts.groupBy("uri").agg(F.min_by("line", "start").alias("line")).collect()
    return {unquote(row.uri): row.line for row in found}


def header_groups(
    spark: SparkSession,
    paths: str | Sequence[str],
    wanted: Sequence[str],
    glob: str | None = None,
) -> list[FileLayout]:
    """Input files grouped by where their header puts the wanted columns.

    Files with nothing but blank lines are passed over; files without any wanted
    column are reported by a warning. One layout for all files keeps the paths as given; otherwise
    file names (never file contents) reach the driver, which lists them for any scan.
    """
    paths = as_paths(paths)
    if listed_files(spark, paths, glob).isEmpty():
        raise ValueError(f"no input files in {paths}")
    grouped: dict[tuple[str, ...], list[str]] = {}
    for path, header in first_lines(spark, paths, glob).items():
        grouped.setdefault(layout_names(header, wanted), []).append(path)
    strange = sorted(p for names, own in grouped.items() if not {*names} & {*wanted} for p in own)
    if strange:
        warnings.warn(
            f"{len(strange)} files name no survey column, {strange[:5]} among them", stacklevel=2
        )
    if len(grouped) <= 1:
        names = next(iter(grouped), layout_names("", wanted))
        return [FileLayout(names, tuple(paths))]
    return [
        FileLayout(names, tuple(escaped(p) for p in sorted(grouped[names])))
        for names in sorted(grouped)
    ]
