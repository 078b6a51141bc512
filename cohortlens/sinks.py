"""Writers of landed parts, the cleaned table and result tables."""

from __future__ import annotations

import uuid
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators.blocks import CHUNK
from cohortlens.operators.clean import observed_counts
from cohortlens.sources.staging import compiled, hadoop_path, staged, unstage

ROWS_PER_FILE = 10_000_000
TASK_ROWS = 500_000  # rows of a block of unknown size that one task gets
RESULT_ROWS = 1_000_000  # rows of a result that still become one file
SOURCE = "source_name"
# Folders that readers pass over: new blocks on their way in, old ones on their way out.
INCOMING, OUTGOING = "_incoming", "_outgoing"


def write_parts(
    df: DataFrame,
    uri: str,
    year: str = "YEAR",
    rows_per_file: int = ROWS_PER_FILE,
    fmt: str = "parquet",
    by_chunk: bool = False,
    rebalance: bool = False,
    block_rows: int | None = None,
) -> None:
    """Land raw rows under ``uri``, one directory per year, replacing only those years.

    Every task writes its own rows straight to the target file system. A split of
    a wide extract leaves little once narrowed; ``rebalance`` shuffles the narrow
    rows by year into full-sized files and splits a year too large for one task.
    With ``by_chunk`` the rows carry block numbers, and source files if blocks are
    counted per file, and each block gets its own directory. Blocks known to hold at
    most ``block_rows`` become one file each; without that bound the rows are staged
    and counted, and a block of more than ``TASK_ROWS`` is dealt to several tasks, so
    none gets more than it can sort. All blocks are written beside the old ones first; then each year's
    folder is put in the place of the old one, so that a write that fails leaves the
    blocks landed before, and the rows are worked out once.
    """
    spark = df.sparkSession

    def write(rows: DataFrame, target: str, folders: list[str]) -> None:
        writer = (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", rows_per_file)
            .partitionBy(*folders)
        )
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.format(fmt).save(target)

    with compiled(spark):
        if not by_chunk:
            df = df.drop(CHUNK, SOURCE)
            write(df.hint("rebalance", F.col(year)) if rebalance else df, uri, [year])
            return
        restore_years(spark, uri)
        target = f"{uri}/{INCOMING}-{uuid.uuid4().hex}"
        folders = [year, *(c for c in (SOURCE, CHUNK) if c in df.columns)]
        kept = [] if block_rows else [staged(df)]
        try:
            dealt = df.repartition(*folders) if block_rows else _dealt(kept[0], folders)
            write(dealt, target, folders)
            swap_years(spark, target, uri)
        finally:
            unstage(*kept)
            where, files = hadoop_path(spark, target)
            files.delete(where, True)


def _dealt(rows: DataFrame, folders: list[str]) -> DataFrame:
    """Staged rows with each block in one task, and one of more than ``TASK_ROWS`` in several."""
    spark = rows.sparkSession
    blocks = rows.groupBy(*folders).agg(F.count(F.lit(1)).alias("n"))
    large = blocks.where(F.col("n") > TASK_ROWS).select(
        *[F.col(c).alias(f"_large_{c}") for c in folders],
        F.ceil(F.col("n") / TASK_ROWS).alias("_slices"),
    )
    total = rows.count()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_ROWS))
    # At most one large block for each ``TASK_ROWS`` rows, so the table is short.
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_large_{c}")) for c in folders])
    slice_ = F.coalesce(F.pmod(F.col("_row"), F.col("_slices")), F.lit(0))
    placed = rows.withColumn("_row", F.col("_metadata.row_index"))
    placed = placed.join(F.broadcast(large), same, "left")
    # Ranges, as hashes would lay several slices together.
    return placed.repartitionByRange(parts, *folders, slice_).select(*rows.columns)


def _folders(spark: SparkSession, uri: str) -> list[str]:
    """Names of the folders within a folder, which may be missing."""
    where, files = hadoop_path(spark, uri)
    if not files.exists(where):
        return []
    return sorted(f.getPath().getName() for f in files.listStatus(where) if f.isDirectory())


def _move(spark: SparkSession, source: str, target: str) -> None:
    here, files = hadoop_path(spark, source)
    there, _ = hadoop_path(spark, target)
    files.mkdirs(there.getParent())
    if not files.rename(here, there):
        raise OSError(f"could not move {source} to {target}")


def swap_years(spark: SparkSession, incoming: str, uri: str) -> None:
    """Put each year's folder of ``incoming`` in the place of that in ``uri``.

    The old folder moves aside first and goes last, so at each moment the whole old or
    the whole new year is there; ``restore_years`` mends a swap that was cut short.
    """
    outgoing = f"{uri}/{OUTGOING}-{uuid.uuid4().hex}"
    years = [name for name in _folders(spark, incoming) if "=" in name]
    present = set(_folders(spark, uri))
    for name in years:
        if name in present:
            _move(spark, f"{uri}/{name}", f"{outgoing}/{name}")
        _move(spark, f"{incoming}/{name}", f"{uri}/{name}")
    where, files = hadoop_path(spark, outgoing)
    files.delete(where, True)


def restore_years(spark: SparkSession, uri: str) -> None:
    """Undo what a swap that was cut short left: old years whose new ones never arrived.

    Only one job at a time may land blocks under ``uri``.
    """
    present = set(_folders(spark, uri))
    for name in sorted(present):
        if name.startswith(f"{OUTGOING}-"):
            for year in _folders(spark, f"{uri}/{name}"):
                if year not in present:
                    _move(spark, f"{uri}/{name}/{year}", f"{uri}/{year}")
        if name.startswith((f"{OUTGOING}-", f"{INCOMING}-")):
            where, files = hadoop_path(spark, f"{uri}/{name}")
            files.delete(where, True)


def write_cleaned(
    df: DataFrame, uri: str, year: str = "YEAR", fmt: str = "parquet", rebalance: bool = False
) -> Observation:
    """Write the cleaned table, replacing it; rows per year are observed by the way.

    ``clean.counts_of`` turns the observation into a table, without another scan.

    Parquet is laid out by year. Parts hold one year each, so tasks write few
    files without a shuffle; for input that mixes years, ``rebalance`` evens out
    the files first and splits a year too large for one task.
    """
    if rebalance:
        df = df.hint("rebalance", F.col(year))
    # Behind the shuffle, where a task that runs again is counted once.
    df, observation = observed_counts(df, year)
    writer = df.write.mode("overwrite")
    with compiled(df.sparkSession):
        if fmt == "csv":
            writer.option("header", True).csv(uri)
        else:
            writer.partitionBy(year).format(fmt).save(uri)
    return observation


def save_result(df: DataFrame, directory: str, name: str, one_file_rows: int = RESULT_ROWS) -> None:
    """Store a result as headed CSV in ``directory/name``, in its own order.

    Up to ``one_file_rows`` rows become one file, more rows several whose names are in
    order. The result is written once as it is worked out, by all its tasks, and
    counted there; only rows known to be few pass through one task.
    """
    order = "_result_order"
    rows = staged(df.withColumn(order, F.monotonically_increasing_id()))
    whole = rows.orderBy(order).drop(order)
    if rows.count() <= one_file_rows:
        whole = whole.coalesce(1)
    whole.write.mode("overwrite").option("header", True).csv(f"{directory}/{name}")
    unstage(rows)


def save_query(spark: SparkSession, sql: str, directory: str, name: str) -> DataFrame:
    """Run SQL over the registered views, store its result by name and return it.

    A result of any size; ``save_result`` tells how many files it becomes.
    """
    result = spark.sql(sql)
    save_result(result, directory, name)
    return result
