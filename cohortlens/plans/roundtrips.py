"""Tables written to files and read back: the survey through every reader and writer.

The rows are those of the coded ``lineitem`` survey, as text the way extracts have
them, so what comes back can be compared with the table it was made from.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.jobs import clean, collect, pipeline
from cohortlens.operators.blocks import CHUNK
from cohortlens.operators.clean import counts_of
from cohortlens.plans.cleaning import clean_survey
from cohortlens.plans.coded_lineitem import coded_lineitem
from cohortlens.sinks import save_query, write_cleaned, write_parts
from cohortlens.sources import read_cleaned, read_parts, read_survey
from cohortlens.sources.staging import compiled, hadoop_path, shared_folder
from cohortlens.spec import CARDIO

# Columns that yearly files of odd years lack.
LATE_COLUMNS = ("TOLDHI2", "MEDCOST")


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared one, removed when the session ends."""
    path = f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"
    where, files = hadoop_path(spark, path)
    files.mkdirs(where)
    files.deleteOnExit(where)
    return path


def as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw survey with its codes as an extract writes them: ``3.0``."""
    coded = coded_lineitem(spark, sf_dir)
    texts = [
        F.concat(F.col(c).cast("int").cast("string"), F.lit(".0")).alias(c)
        for c in CARDIO.columns
        if c != CARDIO.year
    ]
    return coded.select(CARDIO.year, *texts)


def landed(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    folder = scratch(spark)
    write_parts(as_text(spark, sf_dir), folder, CARDIO.year, fmt=fmt, rebalance=True)
    return read_parts(spark, folder, CARDIO, fmt)


def stored(spark: SparkSession, sf_dir: str, fmt: str) -> DataFrame:
    folder = f"{scratch(spark)}/cleaned"
    cleaned = clean_survey(coded_lineitem(spark, sf_dir), CARDIO)
    write_cleaned(cleaned, folder, CARDIO.year, fmt)
    return read_cleaned(spark, folder, CARDIO, view=f"{CARDIO.view}_{fmt}", fmt=fmt)


def yearly_files(spark: SparkSession, sf_dir: str, name: str = "{year}_{n}.csv") -> str:
    """A folder of headed CSV files named by year; headers differ by year."""
    folder, out = scratch(spark), scratch(spark)
    raw = as_text(spark, sf_dir)
    odd = F.col(CARDIO.year) % 2 == 1
    early = raw.where(odd).drop(*LATE_COLUMNS)
    early = early.select(*reversed(early.columns))
    for part, rows in (("odd", early), ("even", raw.where(~odd))):
        with compiled(spark):
            rows.write.partitionBy(CARDIO.year).option("header", True).csv(f"{folder}/{part}")
        where, files = hadoop_path(spark, f"{folder}/{part}")
        for year in files.listStatus(where):
            kept = [f.getPath() for f in files.listStatus(year.getPath())] if year.isDirectory() else []
            value = year.getPath().getName().partition("=")[2]
            for n, path in enumerate(p for p in kept if p.getName().endswith(".csv")):
                target, _ = hadoop_path(spark, f"{out}/{name.format(year=value, n=n)}")
                files.rename(path, target)
    return out


def part_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part files with drifting headers, read by name."""
    folder = yearly_files(spark, sf_dir, "part_{year}_{n}.csv")
    return read_survey(spark, [f"{folder}/part_*.csv"], CARDIO)


def collected_and_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly files through the collect and clean jobs, blocks as files."""
    work = scratch(spark)
    source = yearly_files(spark, sf_dir)
    collect.collect(spark, source, f"{work}/raw", chunk_size=5000, exact_chunks=True)
    clean.clean(spark, f"{work}/raw", f"{work}/cleaned", landed="parquet")
    return read_cleaned(spark, f"{work}/cleaned", CARDIO)


def written_year_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per year as observed while the cleaned table is written."""
    cleaned = clean_survey(coded_lineitem(spark, sf_dir), CARDIO)
    counted = write_cleaned(cleaned, f"{scratch(spark)}/cleaned", CARDIO.year, rebalance=True)
    return counts_of(counted, spark, CARDIO.year)


def relanded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of all years, then of the even years again: rows per year and block."""
    folder = scratch(spark)
    rows = as_text(spark, sf_dir)
    numbered = rows.withColumn(CHUNK, F.lit(1).cast("long"))
    write_parts(numbered, folder, CARDIO.year, by_chunk=True)
    again = rows.where(F.col(CARDIO.year) % 2 == 0).withColumn(CHUNK, F.lit(2).cast("long"))
    write_parts(again, folder, CARDIO.year, by_chunk=True)
    stored = spark.read.schema(f"{CARDIO.outcome} string, {CARDIO.year} int, {CHUNK} long").parquet(folder)
    return stored.groupBy(CARDIO.year, CHUNK).agg(F.count(F.lit(1)).alias("row_count"))


def analysed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The age by score table that the whole pipeline of jobs leaves."""
    work = scratch(spark)
    pipeline.run(spark, yearly_files(spark, sf_dir), work, f"{work}/out")
    schema = "age_group int, risk_score int, respondent_count long, disease_rate double"
    reader = spark.read.schema(schema).option("header", True)
    return reader.csv(f"{work}/out/analysis_age_risk_matrix")


def saved_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query over the registered view, saved by name and read back."""
    cleaned = clean_survey(coded_lineitem(spark, sf_dir), CARDIO)
    cleaned.createOrReplaceTempView(CARDIO.view)
    folder = scratch(spark)
    sql = f"SELECT YEAR, count(*) AS n, sum(Has_Disease) AS cases FROM {CARDIO.view} GROUP BY YEAR"
    save_query(spark, sql, folder, "by_year")
    reader = spark.read.schema("YEAR int, n long, cases long").option("header", True)
    return reader.csv(f"{folder}/by_year")
