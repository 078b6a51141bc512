"""Yearly files to result tables in one session: ``--input DIR --work URI --output-dir URI``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from cohortlens.jobs.analyze import analyze
from cohortlens.jobs.clean import clean
from cohortlens.jobs.collect import collect
from cohortlens.sinks import ROWS_PER_FILE
from cohortlens.spec import CARDIO, SurveySpec


def run(
    spark: SparkSession,
    source: str,
    work: str,
    output_dir: str,
    spec: SurveySpec = CARDIO,
    chunk_size: int = 20_000,
    max_chunks: int = 0,
    sample_size: int = 100_000,
    language: str = "ko",
    rows_per_file: int = ROWS_PER_FILE,
    fmt: str = "parquet",
    exact_chunks: bool = False,
    rebalance: bool = True,
) -> list[str]:
    """Collect, clean and analyse; any path may be on any file system Spark can reach."""
    parts, cleaned = f"{work}/raw", f"{work}/cleaned"
    collect(
        spark, source, parts, spec, chunk_size, max_chunks, rows_per_file, fmt, exact_chunks, rebalance
    )
    clean(spark, parts, cleaned, spec, landed=fmt, fmt=fmt)
    return analyze(spark, cleaned, output_dir, spec, sample_size, language, fmt)


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True, help="folder of YYYY*.csv files")
    parser.add_argument("--work", required=True, help="folder for parts and the cleaned table")
    parser.add_argument("--output-dir", required=True)
    parser.add_argument("--chunk-size", type=int, default=20_000)
    parser.add_argument("--max-chunks", type=int, default=0)
    parser.add_argument("--bmi-sample-size", type=int, default=100_000)
    parser.add_argument("--rows-per-file", type=int, default=ROWS_PER_FILE)
    parser.add_argument("--format", choices=("parquet", "csv"), default="parquet")
    parser.add_argument("--exact-chunks", action="store_true", help="one file per block")
    parser.add_argument("--no-rebalance", action="store_true", help="land without a shuffle")
    parser.add_argument("--labels", choices=sorted(CARDIO.labels), default="ko")
    options = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("cohortlens-pipeline").getOrCreate()
    for name in run(
        spark,
        options.input,
        options.work,
        options.output_dir,
        chunk_size=options.chunk_size,
        max_chunks=options.max_chunks,
        sample_size=options.bmi_sample_size,
        language=options.labels,
        rows_per_file=options.rows_per_file,
        fmt=options.format,
        exact_chunks=options.exact_chunks,
        rebalance=not options.no_rebalance,
    ):
        print("written:", name)


if __name__ == "__main__":
    main()
