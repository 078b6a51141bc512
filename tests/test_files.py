"""Scans and sinks on files with drifting headers."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from cohortlens import sinks
from cohortlens.operators import shape
from cohortlens.operators.blocks import number_chunks
from cohortlens.plans.cleaning import clean_survey
from cohortlens.sources import (
    POSITION_COLUMNS,
    ROW_KEY,
    header_groups,
    read_cleaned,
    read_parts,
    read_survey,
    read_yearly,
    staged,
)
from cohortlens.sources import headers as header_module
from cohortlens.sources.headers import layout_names
from cohortlens.spec import CARDIO


def write(folder, name, text, encoding="utf-8"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding=encoding)
    return str(folder / name)


def values(df, *columns):
    key = lambda r: tuple((v is not None, v) for v in r)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=key)


@pytest.fixture
def parts(tmp_path):
    folder = tmp_path / "part_2010_x"
    write(folder, "part_2011_1.csv", "YEAR,SEX,CVDINFR4,_BMI5\n1999,1.0,2,2683\n1999,,abc,NaN\n")
    write(folder, "part_2012_1.csv", "_BMI5,MEDCOST,other,CVDINFR4,SEX\n3000.0,1,9,1.0,2\n")
    write(folder, "part_x.csv", "SEX,CVDINFR4\n1,1\n", encoding="utf-8-sig")
    return folder


EXPECTED = [
    (None, "1", "1", None, None),
    (2011, None, "abc", None, "NaN"),
    (2011, "1.0", "2", None, "2683"),
    (2012, "2", "1.0", "1", "3000.0"),
]
SHOWN = ("YEAR", "SEX", "CVDINFR4", "MEDCOST", "_BMI5")


def test_columns_match_by_header(spark, parts):
    raw = read_survey(spark, str(parts / "part_*.csv"), CARDIO)
    assert raw.columns == list(CARDIO.columns)
    assert values(raw, *SHOWN) == EXPECTED
    typed = shape.lenient_cast(raw, CARDIO)
    assert values(typed, "YEAR", "SEX", "CVDINFR4", "MEDCOST") == [
        (None, 1, 1, None),
        (2011, None, None, None),
        (2011, 1, 2, None),
        (2012, 2, 1, 1),
    ]


def test_path_forms(spark, parts):
    names = [str(parts / n) for n in ("part_2011_1.csv", "part_2012_1.csv", "part_x.csv")]
    for form in (names, str(parts), [str(parts)], [str(parts / "part_*.csv")]):
        assert values(read_survey(spark, form, CARDIO), *SHOWN) == EXPECTED
    assert values(read_survey(spark, names[:1], CARDIO), *SHOWN) == EXPECTED[1:3]


@pytest.mark.parametrize("n", [3, 40])
def test_headers_of_few_and_many_files(spark, tmp_path, n):
    """Blank first lines, byte order marks and odd names, alike for any number of files."""
    for i in range(n):
        columns = "SEX,CVDINFR4" if i % 2 else "CVDINFR4,junk,SEX"
        cells = f"{i},1" if i % 2 else f"1,SEX,{i}"
        name = ("part_2011_%d[a].csv", "part_2011_{%d}.csv", "part_2011_%d+ *.csv")[i % 3] % i
        write(tmp_path, name, "\n" * (i % 3 == 0) + f"{columns}\n{cells}\n")
    write(tmp_path, "part_2011_98.csv", "a,b\n5,6\n")
    write(tmp_path, "part_2011_99.csv", "\n\n")
    with pytest.warns(UserWarning, match="1 files name no survey column"):
        groups = header_groups(spark, str(tmp_path), CARDIO.columns)
    assert sorted(len(g.paths) for g in groups) == sorted([1, n // 2, n - n // 2])
    with pytest.warns(UserWarning):
        found = values(read_survey(spark, str(tmp_path), CARDIO), "SEX", "CVDINFR4")
    want = [(None, None), *[(str(i), "1") for i in range(n)]]
    assert sorted(found, key=str) == sorted(want, key=str)


def test_header_of_a_large_file_takes_one_task(spark, tmp_path):
    """A file of many splits is not read to its end."""
    write(tmp_path, "part_2011_1.csv", "SEX,CVDINFR4\n" + "1,2\n" * 200_000)
    write(tmp_path, "part_2011_2.csv", "CVDINFR4,SEX\n" + "2,1\n" * 200_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        found = header_module.first_lines(spark, [str(tmp_path)], None)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(found.values()) == ["CVDINFR4,SEX", "SEX,CVDINFR4"]
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000"


def test_one_header_keeps_paths(spark, tmp_path):
    for i in range(3):
        write(tmp_path, f"part_2011_{i}.csv", "SEX,CVDINFR4\n1,2\n")
    groups = header_groups(spark, str(tmp_path), CARDIO.columns)
    assert [g.paths for g in groups] == [(str(tmp_path),)]


def test_layout_names():
    names = layout_names('﻿SEX,"_BMI5",x, CVDINFR4 ,SEX,', ["SEX", "_BMI5", "CVDINFR4"])
    assert names == ("SEX", "_BMI5", "_position_2", "CVDINFR4", "_position_4", "_position_5")
    assert layout_names(None, ["SEX"]) == ("_position_0",)


def test_wrong_grouping_fails_instead_of_swapping(spark, tmp_path, monkeypatch):
    write(tmp_path, "part_2011_1.csv", "SEX,CVDINFR4\n1,2\n")
    write(tmp_path, "part_2011_2.csv", "CVDINFR4,SEX\n1,2\n")
    found = {f"file:{tmp_path}/part_2011_{i}.csv": "SEX,CVDINFR4" for i in (1, 2)}
    monkeypatch.setattr(header_module, "first_lines", lambda *_: found)
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_survey(spark, str(tmp_path), CARDIO).collect()


def test_quoted_cells_keep_their_columns(spark, tmp_path):
    """Quotes inside a cell are doubled; a backslash is an ordinary character."""
    lines = ['note,"SEX",CVDINFR4', '"a, ""b""",1,2', '"c\\",2,1', '"",,"1.0"']
    write(tmp_path, "part_2011_1.csv", "\n".join(lines))
    found = values(read_survey(spark, str(tmp_path), CARDIO), "SEX", "CVDINFR4")
    assert found == [(None, "1.0"), ("1", "2"), ("2", "1")]


def test_missing_input_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_survey(spark, str(tmp_path / "part_*.csv"), CARDIO)
    write(tmp_path, "notes.txt", "x")
    with pytest.raises(ValueError, match="no input files"):
        read_yearly(spark, str(tmp_path), CARDIO)


def test_yearly_files(spark, tmp_path):
    write(tmp_path, "2011.csv", "SEX,CVDINFR4\n1,2\n")
    write(tmp_path, "2012_llcp.csv", "CVDINFR4,SEX\n1,2\n")
    write(tmp_path, "part_2013_1.csv", "CVDINFR4,SEX\n1,9\n")
    assert values(read_yearly(spark, str(tmp_path), CARDIO), "YEAR", "SEX", "CVDINFR4") == [
        (2011, "1", "2"),
        (2012, "2", "1"),
    ]


@pytest.mark.parametrize("cap", [0, 1, 2, -1])
def test_chunks_follow_file_order(spark, tmp_path, cap):
    """Rows 0..6 in blocks of three; splits of a few bytes make many slices."""
    write(tmp_path, "2011.csv", "SEX\n" + "\n".join(str(i) for i in range(7)) + "\n")
    write(tmp_path, "2012.csv", "CVDINFR4,SEX\n" + "\n".join(f"1,{i}" for i in range(500)))
    sizes = {"spark.sql.files.maxPartitionBytes": "40", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in sizes}
    for k, v in sizes.items():
        spark.conf.set(k, v)
    try:
        placed = staged(read_yearly(spark, str(tmp_path), CARDIO, positions=True))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    file, split, row = POSITION_COLUMNS
    assert placed.select(split).distinct().count() > 20
    found = number_chunks(placed, 3, [file], split, row, cap)
    expected = [
        (year, i, i // 3 + 1)
        for year, n in ((2011, 7), (2012, 500))
        for i in range(n)
        if cap == 0 or i // 3 + 1 <= cap
    ]
    assert values(found, "YEAR", F.col("SEX").cast("int"), "chunk_no") == expected


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_landed_parts_round_trip(spark, parts, tmp_path, fmt):
    raw = read_survey(spark, str(parts), CARDIO)
    target = str(tmp_path / "landed")
    sinks.write_parts(raw, target, fmt=fmt, rebalance=True)
    assert values(read_parts(spark, target, CARDIO, fmt), *SHOWN) == EXPECTED
    only = raw.where("YEAR = 2011").limit(1)
    sinks.write_parts(only, target, fmt=fmt)
    kept = values(read_parts(spark, target, CARDIO, fmt), "YEAR")
    assert kept == [(None,), (2011,), (2012,)]


def test_rows_per_file_and_exact_chunks(spark, tmp_path):
    write(tmp_path / "in", "2011.csv", "SEX\n" + "\n".join(str(i) for i in range(10)))
    raw = read_yearly(spark, str(tmp_path / "in"), CARDIO)
    sinks.write_parts(raw, str(tmp_path / "a"), rows_per_file=4, fmt="csv")
    assert len(list((tmp_path / "a").glob("YEAR=2011/*.csv"))) == 3
    file, split, row = POSITION_COLUMNS
    placed = staged(read_yearly(spark, str(tmp_path / "in"), CARDIO, positions=True))
    blocks = number_chunks(placed, 4, [file], split, row).drop(file)
    sinks.write_parts(blocks, str(tmp_path / "b"), by_chunk=True)
    files = sorted(p.parent.name for p in (tmp_path / "b").glob("YEAR=2011/*/*.parquet"))
    assert files == ["chunk_no=1", "chunk_no=2", "chunk_no=3"]
    assert read_parts(spark, str(tmp_path / "b"), CARDIO).count() == 10


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
@pytest.mark.parametrize("rebalance", [False, True])
def test_cleaned_round_trip(spark, parts, tmp_path, fmt, rebalance):
    """A column of NULLs keeps its type, and every value survives."""
    cleaned = clean_survey(read_survey(spark, str(parts), CARDIO), CARDIO).drop("POORHLTH")
    cleaned = cleaned.withColumn("POORHLTH", F.lit(None).cast("int"))
    cleaned = cleaned.select(*CARDIO.cleaned_schema.names)
    target = str(tmp_path / "cleaned")
    sinks.write_cleaned(cleaned, target, fmt=fmt, rebalance=rebalance)
    back = read_cleaned(spark, target, CARDIO, view="round_trip", fmt=fmt)
    assert back.dtypes == cleaned.dtypes
    assert values(back, "*") == values(cleaned, "*")
    assert spark.sql("SELECT count(*) FROM round_trip").first()[0] == 3


def test_row_key_is_unique(spark, parts, tmp_path):
    cleaned = clean_survey(read_survey(spark, str(parts), CARDIO), CARDIO)
    sinks.write_cleaned(cleaned, str(tmp_path / "c"))
    back = read_cleaned(spark, str(tmp_path / "c"), CARDIO, row_key=True)
    assert back.columns == [*CARDIO.cleaned_schema.names, *ROW_KEY]
    assert back.select(*ROW_KEY).distinct().count() == back.count() == 3


def test_cleaned_scan_prunes_and_pushes(spark, parts, tmp_path):
    cleaned = clean_survey(read_survey(spark, str(parts), CARDIO), CARDIO)
    sinks.write_cleaned(cleaned, str(tmp_path / "c"))
    back = read_cleaned(spark, str(tmp_path / "c"), CARDIO)
    query = back.where("YEAR = 2011 AND _AGEG5YR BETWEEN 1 AND 13").select("Has_Disease")
    plan = query._sc._jvm.PythonSQLUtils.explainString(query._jdf.queryExecution(), "simple")
    assert "PartitionFilters: [isnotnull(YEAR" in plan
    assert "GreaterThanOrEqual(_AGEG5YR,1)" in plan
    assert "ReadSchema: struct<_AGEG5YR:int,Has_Disease:int>" in plan


def test_save_query_returns_and_stores(spark, tmp_path):
    spark.range(3).createOrReplaceTempView("numbers")
    found = sinks.save_query(
        spark, "SELECT id, id * 2 AS double FROM numbers", str(tmp_path), "doubled"
    )
    assert found.count() == 3
    files = list((tmp_path / "doubled").glob("*.csv"))
    assert len(files) == 1
    assert sorted(files[0].read_text().split()) == ["0,0", "1,2", "2,4", "id,double"]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_every_landed_folder_is_cleaned(spark, tmp_path, fmt):
    from cohortlens.jobs import clean

    folders = []
    for i, year in enumerate((2011, 2012)):
        source = tmp_path / f"in{i}"
        source.mkdir()
        write(source, f"part_{year}_1.csv", "SEX,CVDINFR4\n1,1\n2,2\n")
        folders.append(str(tmp_path / f"landed{i}"))
        sinks.write_parts(read_survey(spark, str(source), CARDIO), folders[-1], fmt=fmt)
    counts = clean.clean(spark, folders, str(tmp_path / "out"), landed=fmt).collect()
    assert {r["YEAR"]: r["row_count"] for r in counts} == {2011: 2, 2012: 2}


def test_headers_are_found_without_sending_lines_to_python(spark, tmp_path, monkeypatch):
    """Files of several splits, blank lines before the header among them."""
    write(tmp_path, "part_2011_1.csv", "﻿\n \t\n　\n SEX,CVDINFR4\n" + "1,2\n" * 50_000)
    write(tmp_path, "part_2011_2.csv", "\n" * 100_000 + "CVDINFR4,SEX\n2,1\n")
    write(tmp_path, "part_2011_3.csv", "\n \n")
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", None, raising=False)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        found = header_module.first_lines(spark, [str(tmp_path)], None)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    lines = {path.rpartition("/")[2]: line for path, line in found.items()}
    assert lines == {"part_2011_1.csv": " SEX,CVDINFR4", "part_2011_2.csv": "CVDINFR4,SEX"}
