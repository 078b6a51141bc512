"""Tables written once to the cluster's shared folder and read back."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Bytes of a method beyond which HotSpot interprets it for good.
JIT_LIMIT = 8000


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """Plans started within never run in a generated method that is too large for the JIT.

    A projection of many coded columns fused with its scan is such a method. Left to
    Spark's default it is interpreted; beyond this limit its columns are worked out in
    methods of their own.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, str(min(int(before), JIT_LIMIT)))
        yield
    finally:
        spark.conf.set(name, before)


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, else a folder in its warehouse.

    One rule for every master: both are folders that all executors of a cluster
    reach, so nothing lands in a machine's own temporary folder. A warehouse on the
    local file system is that only where driver and executors are one machine; on a
    cluster it is an error, and ``spark.checkpoint.dir`` must be set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir") + "/stages"
        _, files = hadoop_path(spark, folder)
        if files.getScheme() == "file" and not spark.sparkContext.master.startswith("local"):
            raise ValueError(
                f"executors may not reach {folder}: set spark.checkpoint.dir to a shared folder"
            )
    return folder.rstrip("/")


def hadoop_path(spark: SparkSession, path: str):
    """A path of any file system Spark reaches, and that file system."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def staged(df: DataFrame) -> DataFrame:
    """``df`` materialised as Parquet, so that non-deterministic columns stay fixed.

    Columnar storage lets later passes read only what they need, and losing an
    executor never re-runs what produced the table. ``unstage`` removes it; what is
    left goes when the session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stage-{uuid.uuid4().hex}"
    where, files = hadoop_path(spark, path)
    df.write.parquet(path)
    files.deleteOnExit(where)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.staged_at = path
    return kept


def unstage(*frames: DataFrame) -> None:
    """Remove staged tables that no later action reads."""
    for df in frames:
        where, files = hadoop_path(df.sparkSession, df.staged_at)
        files.delete(where, True)
