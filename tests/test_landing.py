"""Counts taken while writing, years swapped whole, results of any size, shared folders."""

import glob
import sys
import types

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from cohortlens import sinks
from cohortlens.operators.blocks import CHUNK
from cohortlens.operators.clean import counts_of, observed_counts, quality_report
from cohortlens.sources import staging
from cohortlens.spec import CARDIO

YEAR = CARDIO.year


def blocks(spark, rows):
    """Rows (year, block, answer) as numbered rows."""
    return spark.createDataFrame(rows, f"`{YEAR}` int, `{CHUNK}` long, answer string")


def landed(spark, folder):
    schema = f"answer string, `{YEAR}` int, `{CHUNK}` long"
    return sorted(tuple(r) for r in spark.read.schema(schema).parquet(folder).collect())


@pytest.mark.parametrize("parts", [1, 5])
def test_observed_counts_equal_a_second_scan(spark, parts):
    rows = spark.range(997).select(
        F.when(F.col("id") % 50 != 0, (2000 + F.col("id") % 7).cast("int")).alias(YEAR)
    )
    rows, observation = observed_counts(rows.repartition(parts), YEAR)
    rows.write.format("noop").mode("overwrite").save()
    found = counts_of(observation, spark, YEAR)
    expected = quality_report(rows, YEAR)
    assert found.collect() == expected.collect()
    assert found.schema == expected.schema or found.dtypes == expected.dtypes


def test_observed_counts_of_no_rows(spark):
    rows, observation = observed_counts(spark.createDataFrame([], f"`{YEAR}` int"), YEAR)
    rows.write.format("noop").mode("overwrite").save()
    assert counts_of(observation, spark, YEAR).collect() == []


def test_write_cleaned_counts_without_another_scan(spark, tmp_path):
    spec = CARDIO
    rows = spark.range(40).select(
        *[
            (F.lit(2001) + F.col("id") % 2).cast(f.dataType).alias(f.name)
            if f.name == YEAR
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in spec.cleaned_schema
        ]
    )
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    once = rows.mapInArrow(count, rows.schema)
    observation = sinks.write_cleaned(once, str(tmp_path / "cleaned"), YEAR, rebalance=True)
    assert [tuple(r) for r in counts_of(observation, spark, YEAR).collect()] == [(2001, 20), (2002, 20)]
    assert seen.value == 40


def test_a_year_is_replaced_whole_and_others_stay(spark, tmp_path):
    folder = str(tmp_path / "raw")
    sinks.write_parts(blocks(spark, [(2001, 1, "a"), (2001, 2, "b"), (2002, 1, "c"), (None, 1, "d")]), folder, YEAR, by_chunk=True)
    sinks.write_parts(blocks(spark, [(2001, 1, "e"), (None, 3, "f")]), folder, YEAR, by_chunk=True)
    assert landed(spark, folder) == sorted([("e", 2001, 1), ("c", 2002, 1), ("f", None, 3)], key=lambda r: r[0])
    assert not glob.glob(f"{folder}/_[io]*")


def test_a_write_that_fails_keeps_the_old_year(spark, tmp_path):
    folder = str(tmp_path / "raw")
    sinks.write_parts(blocks(spark, [(2001, 1, "a"), (2002, 1, "b")]), folder, YEAR, by_chunk=True)
    failing = blocks(spark, [(2001, 1, "x"), (2002, 1, "y")])
    failing = failing.withColumn("answer", F.when(F.col(YEAR) == 2001, F.col("answer")).otherwise(F.raise_error(F.lit("lost"))))
    with pytest.raises(Exception, match="lost"):
        sinks.write_parts(failing, folder, YEAR, by_chunk=True)
    assert landed(spark, folder) == [("a", 2001, 1), ("b", 2002, 1)]
    assert not glob.glob(f"{folder}/_[io]*")


def test_a_swap_cut_short_is_mended(spark, tmp_path, monkeypatch):
    """A crash between moving the old year aside and the new one in loses nothing."""
    folder = str(tmp_path / "raw")
    sinks.write_parts(blocks(spark, [(2001, 1, "a"), (2002, 1, "b")]), folder, YEAR, by_chunk=True)
    move, moves = sinks._move, []

    def crash(spark, source, target):
        moves.append(source)
        if len(moves) == 4:  # the second year's new folder
            raise KeyboardInterrupt
        move(spark, source, target)

    monkeypatch.setattr(sinks, "_move", crash)
    with pytest.raises(KeyboardInterrupt):
        sinks.write_parts(blocks(spark, [(2001, 1, "x"), (2002, 1, "y")]), folder, YEAR, by_chunk=True)
    monkeypatch.undo()
    sinks.write_parts(blocks(spark, [(2003, 1, "z")]), folder, YEAR, by_chunk=True)
    assert landed(spark, folder) == [("b", 2002, 1), ("x", 2001, 1), ("z", 2003, 1)]


def test_rows_of_blocks_are_worked_out_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = blocks(spark, [(2001 + i % 3, i % 2, str(i)) for i in range(30)])
    sinks.write_parts(rows.mapInArrow(count, rows.schema), str(tmp_path / "raw"), YEAR, by_chunk=True)
    assert seen.value == 30


@pytest.mark.parametrize(("limit", "files"), [(100, 1), (99, None)])
def test_results_keep_their_order_in_one_or_many_files(spark, tmp_path, limit, files):
    result = spark.range(100).repartition(8).orderBy(F.desc("id"))
    sinks.save_result(result, str(tmp_path), "out", one_file_rows=limit)
    parts = sorted(glob.glob(f"{tmp_path}/out/part-*.csv"))
    assert len(parts) == files if files else len(parts) >= 1
    lines = [int(x) for p in parts for x in open(p).read().split("\n")[1:] if x]
    assert lines == list(range(99, -1, -1))


def test_results_do_not_narrow_the_stage_before(spark, tmp_path):
    """Eight partitions are worked on by eight tasks, though one file is written."""
    tasks = spark.sparkContext.accumulator(0)

    def count(batches):
        tasks.add(1)
        yield from batches

    rows = spark.range(0, 80, 1, 8).mapInArrow(count, "id long")
    sinks.save_result(rows, str(tmp_path), "out")
    assert tasks.value == 8
    assert len(glob.glob(f"{tmp_path}/out/part-*.csv")) == 1


def test_a_cluster_without_a_shared_folder_is_an_error(spark, monkeypatch):
    conf = {"spark.sql.warehouse.dir": "file:/tmp/warehouse"}
    context = types.SimpleNamespace(
        master="spark://host:7077", getCheckpointDir=lambda: None,
        _jvm=spark.sparkContext._jvm, _jsc=spark.sparkContext._jsc,
    )
    session = types.SimpleNamespace(
        conf=types.SimpleNamespace(get=lambda k, d=None: conf.get(k, d)), sparkContext=context
    )
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_folder(session)
    context.master = "local[4]"
    assert staging.shared_folder(session) == "file:/tmp/warehouse/stages"
    context.master = "spark://host:7077"
    conf["spark.checkpoint.dir"] = "hdfs://shared/checkpoints/"
    assert staging.shared_folder(session) == "hdfs://shared/checkpoints"


def test_the_entry_survives_a_missing_library(monkeypatch):
    """A library that only the training-text queries need may be missing."""
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)
    import __spark_entry__ as entry

    assert "rate_by_age" in entry.queries()
    assert "pipeline" not in entry.queries()
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)


def test_a_large_block_is_dealt_to_several_tasks(spark, tmp_path, monkeypatch):
    """Rows per task stay bounded, small blocks stay one file, and copies are kept."""
    monkeypatch.setattr(sinks, "TASK_ROWS", 20)
    rows = [(2001, 1, str(i % 3)) for i in range(100)]
    rows += [(2002, 1, "b"), (2002, 1, "b"), (None, 2, None), (2001, None, "d")]
    folder = str(tmp_path / "raw")
    sinks.write_parts(blocks(spark, rows).repartition(3), folder, YEAR, by_chunk=True)
    large = glob.glob(f"{folder}/{YEAR}=2001/{CHUNK}=1/part-*")
    assert len(large) >= 3
    assert max(spark.read.parquet(p).count() for p in large) <= 40
    for block in (f"{YEAR}=2002/{CHUNK}=1", f"{YEAR}=__HIVE_DEFAULT_PARTITION__/{CHUNK}=2"):
        assert len(glob.glob(f"{folder}/{block}/part-*")) == 1
    schema = f"answer string, `{YEAR}` int, `{CHUNK}` long"
    found = [tuple(r) for r in spark.read.schema(schema).parquet(folder).collect()]
    assert sorted(found, key=str) == sorted([(a, y, c) for y, c, a in rows], key=str)


def test_blocks_of_known_size_stay_one_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "TASK_ROWS", 5)
    rows = [(2001, 1 + i // 10, str(i)) for i in range(30)]
    folder = str(tmp_path / "raw")
    sinks.write_parts(blocks(spark, rows).repartition(3), folder, YEAR, by_chunk=True, block_rows=10)
    assert len(glob.glob(f"{folder}/{YEAR}=2001/{CHUNK}=*/part-*.parquet")) == 3


@pytest.mark.parametrize("by_chunk", [False, True])
def test_rows_are_landed_by_methods_that_the_jit_takes(spark, tmp_path, monkeypatch, by_chunk):
    name = "spark.sql.codegen.hugeMethodLimit"
    before, seen, save = spark.conf.get(name), [], DataFrameWriter.save

    def spied(self, *args, **options):
        seen.append(int(spark.conf.get(name)))
        return save(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "save", spied)
    sinks.write_parts(blocks(spark, [(2001, 1, "a")]), str(tmp_path / "raw"), YEAR, by_chunk=by_chunk)
    assert seen and max(seen) <= 8000
    assert spark.conf.get(name) == before
