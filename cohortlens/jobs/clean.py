"""Clean landed parts or part files: ``--input PATH... --output URI``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from cohortlens.operators.clean import counts_of, preview
from cohortlens.plans.cleaning import clean_survey
from cohortlens.sinks import write_cleaned
from cohortlens.sources import read_cleaned, read_parts, read_survey
from cohortlens.spec import CARDIO, SurveySpec


def clean(
    spark: SparkSession,
    source: str | Sequence[str],
    target: str,
    spec: SurveySpec = CARDIO,
    landed: str | None = None,
    fmt: str = "parquet",
    rebalance: bool = False,
) -> DataFrame:
    """Write the cleaned table and return its rows per year.

    ``landed`` names the format of parts written by the collect job; without it
    the input is ``part_YYYY_N.csv`` files. The raw input is read once, and the years
    are counted as they are written.
    """
    if landed:
        raw = read_parts(spark, source, spec, landed)
    else:
        raw = read_survey(spark, source, spec)
    counted = write_cleaned(clean_survey(raw, spec), target, spec.year, fmt, rebalance)
    return counts_of(counted, spark, spec.year)


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", nargs="+", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--landed", choices=("parquet", "csv"), help="format of landed parts")
    parser.add_argument("--format", choices=("parquet", "csv"), default="parquet")
    parser.add_argument("--rebalance", action="store_true", help="even out the written files")
    options = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("cohortlens-clean").getOrCreate()
    per_year = clean(
        spark,
        options.input,
        options.output,
        landed=options.landed,
        fmt=options.format,
        rebalance=options.rebalance,
    )
    counts = per_year.collect()  # one row per year
    for row in counts:
        print(*row)
    print("rows:", sum(row["row_count"] for row in counts))
    stored = read_cleaned(spark, options.output, CARDIO, fmt=options.format)
    preview(stored, [CARDIO.year]).show()


if __name__ == "__main__":
    main()
