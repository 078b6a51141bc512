"""Land yearly CSV files as parts: ``--input DIR --output URI``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cohortlens.operators.blocks import number_chunks
from cohortlens.sinks import ROWS_PER_FILE, SOURCE, write_parts
from cohortlens.sources import POSITION_COLUMNS, read_yearly
from cohortlens.spec import CARDIO, SurveySpec


def collect(
    spark: SparkSession,
    source: str,
    target: str,
    spec: SurveySpec = CARDIO,
    chunk_size: int = 20_000,
    max_chunks: int = 0,
    rows_per_file: int = ROWS_PER_FILE,
    fmt: str = "parquet",
    exact_chunks: bool = False,
    rebalance: bool = True,
) -> None:
    """Known columns of every ``YYYY*.csv`` under ``source``, landed by year.

    Blocks are counted per source file in file order. Numbers are only worked out
    when they matter: for a cap, or when each block shall be a file. Source files
    are never removed.
    """
    if max_chunks == 0 and not exact_chunks:
        raw = read_yearly(spark, source, spec)
        write_parts(raw, target, spec.year, rows_per_file, fmt, rebalance=rebalance)
        return
    file, split, row = POSITION_COLUMNS
    # Places are counted in a scan of no columns; only rows within the cap are kept after.
    placed = read_yearly(spark, source, spec, positions=True)
    numbered = number_chunks(placed, chunk_size, [file], split, row, max_chunks)
    numbered = numbered.withColumn(SOURCE, F.substring_index(file, "/", -1)).drop(file)
    write_parts(
        numbered, target, spec.year, rows_per_file, fmt, exact_chunks, rebalance, block_rows=chunk_size
    )


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True, help="folder of YYYY*.csv files")
    parser.add_argument("--output", required=True, help="folder or URI of the parts")
    parser.add_argument("--chunk-size", type=int, default=20_000, help="rows of a block")
    parser.add_argument("--max-chunks", type=int, default=0, help="blocks kept per file, 0: all")
    parser.add_argument("--rows-per-file", type=int, default=ROWS_PER_FILE)
    parser.add_argument("--format", choices=("parquet", "csv"), default="parquet")
    parser.add_argument("--exact-chunks", action="store_true", help="one file per block")
    parser.add_argument("--no-rebalance", action="store_true", help="write without a shuffle")
    options = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("cohortlens-collect").getOrCreate()
    collect(
        spark,
        options.input,
        options.output,
        chunk_size=options.chunk_size,
        max_chunks=options.max_chunks,
        rows_per_file=options.rows_per_file,
        fmt=options.format,
        exact_chunks=options.exact_chunks,
        rebalance=not options.no_rebalance,
    )


if __name__ == "__main__":
    main()
