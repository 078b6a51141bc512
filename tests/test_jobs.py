"""The jobs on yearly files in a temporary folder."""

import csv
import random

import pytest

from cohortlens.jobs import analyze, clean, collect, pipeline
from cohortlens.sources import read_cleaned, read_parts
from cohortlens.spec import CARDIO

ALL_TABLES = {
    "analysis_age_disease_rate",
    "analysis_age_disease_rate_labelled",
    "analysis_blood_pressure_disease_rate",
    "analysis_risk_score_disease_rate",
    "analysis_year_disease_rate",
    "analysis_age_risk_matrix",
    "analysis_age_risk_percent",
    "analysis_bmi_distribution_sample",
    "analysis_bmi_box_statistics",
    "analysis_model_metrics",
    "analysis_model_coefficients",
}


def yearly(folder, years=(2011, 2012), rows=400):
    """Extracts whose headers differ by year; cells as exported, with blanks."""
    folder.mkdir()
    pick = random.Random(1)
    for year in years:
        columns = ["CVDINFR4", "BPHIGH4", "TOLDHI2", "DIABETE3", "SMOKE100", "SEX", "_AGEG5YR"]
        columns += ["_BMI5", "IDATE"]
        if year % 2:
            columns = [*reversed(columns), "MEDCOST"]
        with (folder / f"{year}.csv").open("w", newline="") as out:
            writer = csv.DictWriter(out, columns)
            writer.writeheader()
            for _ in range(rows):
                cells = {
                    "CVDINFR4": pick.choice(["1.0", "2.0", "2.0", "7.0", ""]),
                    "BPHIGH4": pick.choice(["1.0", "3.0", "4.0"]),
                    "TOLDHI2": pick.choice(["1.0", "2.0"]),
                    "DIABETE3": pick.choice(["1.0", "3.0"]),
                    "SMOKE100": pick.choice(["1.0", "2.0", "9.0"]),
                    "SEX": pick.choice(["1", "2"]),
                    "_AGEG5YR": str(pick.randint(1, 14)),
                    "_BMI5": str(pick.randint(900, 8100)),
                    "IDATE": "b'01042011'",
                    "MEDCOST": "1.0",
                }
                writer.writerow({k: v for k, v in cells.items() if k in columns})
    return str(folder)


def table(folder, name):
    (path,) = (folder / name).glob("*.csv")
    with path.open(encoding="utf-8", newline="") as lines:
        return list(csv.DictReader(lines))


def test_pipeline_writes_every_table(spark, tmp_path):
    source, out = yearly(tmp_path / "in"), tmp_path / "out"
    names = pipeline.run(spark, source, str(tmp_path / "work"), str(out))
    assert set(names) == ALL_TABLES
    assert sorted(p.name for p in (tmp_path / "in").iterdir()) == ["2011.csv", "2012.csv"]

    cleaned = read_cleaned(spark, str(tmp_path / "work" / "cleaned"), CARDIO)
    rows = [r.asDict() for r in cleaned.collect()]
    for year in (2011, 2012):
        group = [r for r in rows if r["YEAR"] == year]
        (line,) = [
            r for r in table(out, "analysis_year_disease_rate") if r["year"] == str(year)
        ]
        assert int(line["respondent_count"]) == len(group)
        share = sum(r["Has_Disease"] for r in group) / len(group)
        assert float(line["disease_rate"]) == pytest.approx(share)
    ages = [int(r["age_group"]) for r in table(out, "analysis_age_disease_rate")]
    assert ages == list(range(1, 14))
    pressure = [r["blood_pressure_group"] for r in table(out, PRESSURE)]
    assert pressure == list(CARDIO.labels["ko"].flag.values())
    scores = [r["risk_score"] for r in table(out, "analysis_risk_score_disease_rate")]
    assert scores == ["0", "1", "2", "3", "4"]
    quality = {r["metric"]: float(r["value"]) for r in table(out, "analysis_model_metrics")}
    complete = [
        r
        for r in rows
        if all(r[f] is not None for f in CARDIO.features)
        and 1 <= r["_AGEG5YR"] <= 13
        and 10 <= r["BMI_Real"] <= 80
    ]
    assert quality["model_input_rows"] == len(complete)
    assert 0 < quality["test_rows"] < len(complete)
    weights = table(out, "analysis_model_coefficients")
    assert list(weights[0]) == ["feature", "feature_korean", "coefficient", "odds_ratio"]
    assert len(weights) == 7
    sample = table(out, "analysis_bmi_distribution_sample")
    assert list(sample[0]) == ["Has_Disease", "BMI_Real", "disease_label"]
    assert all(10 < float(r["BMI_Real"]) < 80 for r in sample)


PRESSURE = "analysis_blood_pressure_disease_rate"


def test_collect_cap_counts_rows_per_file(spark, tmp_path):
    source = yearly(tmp_path / "in", rows=50)
    target = str(tmp_path / "raw")
    collect.main(
        ["--input", source, "--output", target, "--chunk-size", "15", "--max-chunks", "2"]
    )
    counts = read_parts(spark, target, CARDIO).groupBy("YEAR").count().collect()
    assert {tuple(r) for r in counts} == {(2011, 30), (2012, 30)}


def test_collect_exact_chunks_as_csv(spark, tmp_path):
    source = yearly(tmp_path / "in", years=(2011,), rows=25)
    target = tmp_path / "raw"
    collect.collect(spark, source, str(target), chunk_size=10, fmt="csv", exact_chunks=True)
    assert len(list(target.glob("YEAR=2011/source_name=2011.csv/chunk_no=*/*.csv"))) == 3
    assert read_parts(spark, str(target), CARDIO, "csv").count() == 25


def test_clean_part_files_and_report(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "part_2011_1.csv").write_text("CVDINFR4,SEX\n1.0,1\n2.0,2\n9,1\n,1\n")
    (folder / "part_2012_1.csv").write_text("SEX,CVDINFR4\n1,2\n")
    per_year = clean.clean(
        spark, [str(folder / "part_*.csv")], str(tmp_path / "cleaned"), fmt="csv"
    )
    assert [tuple(r) for r in per_year.collect()] == [(2011, 2), (2012, 1)]


def test_analyze_csv_in_english_without_model_rows(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "part_2011_1.csv").write_text(
        "CVDINFR4,BPHIGH4,_AGEG5YR,_BMI5\n1,1,1,2500\n2,3,2,3000\n"
    )
    clean.clean(spark, str(folder), str(tmp_path / "cleaned"), fmt="csv")
    out = tmp_path / "out"
    names = analyze.analyze(
        spark, str(tmp_path / "cleaned"), str(out), language="en", fmt="csv"
    )
    assert set(names) == ALL_TABLES - {"analysis_model_metrics", "analysis_model_coefficients"}
    assert [r["blood_pressure_group"] for r in table(out, PRESSURE)] == [
        "high blood pressure",
        "no high blood pressure",
    ]
    assert spark.sql("SELECT count(*) FROM cardio").first()[0] == 2


def test_command_lines(spark, tmp_path, capsys):
    source = yearly(tmp_path / "in")
    raw, cleaned, out = (str(tmp_path / n) for n in ("raw", "cleaned", "out"))
    collect.main(["--input", source, "--output", raw])
    clean.main(["--input", raw, "--landed", "parquet", "--output", cleaned])
    analyze.main(["--input", cleaned, "--output-dir", out, "--bmi-sample-size", "5"])
    assert "rows:" in capsys.readouterr().out
    assert len(table(tmp_path / "out", "analysis_bmi_distribution_sample")) == 5


def test_runs_over_rewritten_tables_agree(spark, tmp_path):
    """Sample, split and coefficients depend on the rows, not on how they were stored."""
    source = yearly(tmp_path / "in")
    found = []
    for i, fmt in enumerate(("parquet", "csv")):
        out = tmp_path / f"out{i}"
        pipeline.run(spark, source, str(tmp_path / f"work{i}"), str(out), fmt=fmt, rebalance=not i)
        sample = table(out, "analysis_bmi_distribution_sample")
        found.append(
            (
                sorted(map(str, sample)),
                sorted(str(r) for r in table(out, "analysis_model_metrics")),
                [(r["feature"], round(float(r["coefficient"]), 9)) for r in table(out, COEFFICIENTS)],
            )
        )
    assert found[0] == found[1] and found[0][0]


COEFFICIENTS = "analysis_model_coefficients"


def test_blocks_of_two_files_and_of_a_rerun(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name in ("2011a", "2011b"):
        (folder / f"{name}.csv").write_text("SEX,CVDINFR4\n" + "1,2\n" * 25)
    target = tmp_path / "raw"
    collect.collect(spark, str(folder), str(target), chunk_size=10, exact_chunks=True)
    files = list(target.glob("YEAR=2011/source_name=*/chunk_no=*/*.parquet"))
    assert len(files) == 6
    assert max(spark.read.parquet(str(f)).count() for f in files) == 10
    collect.collect(spark, str(folder), str(target), chunk_size=10, max_chunks=1, exact_chunks=True)
    assert read_parts(spark, str(target), CARDIO).count() == 20
