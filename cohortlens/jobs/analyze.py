"""Answer the survey's questions: ``--input PATH... --output-dir URI``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from cohortlens.functions import fast_row_hash
from cohortlens.operators.rates import rate_grain
from cohortlens.plans import answers
from cohortlens.plans.modelling import train_test_report
from cohortlens.sinks import save_result
from cohortlens.sources import read_cleaned, staged, unstage
from cohortlens.spec import CARDIO, SurveySpec

# Names of the result tables.
AGE = "analysis_age_disease_rate"
PRESSURE = "analysis_blood_pressure_disease_rate"
SCORE = "analysis_risk_score_disease_rate"
YEAR = "analysis_year_disease_rate"
AGE_SCORE = "analysis_age_risk_matrix"
SAMPLE = "analysis_bmi_distribution_sample"
METRICS = "analysis_model_metrics"
COEFFICIENTS = "analysis_model_coefficients"
# Tables that stand for what used to be read off charts.
AGE_LABELLED = "analysis_age_disease_rate_labelled"
MATRIX = "analysis_age_risk_percent"
BOX = "analysis_bmi_box_statistics"


def analyze(
    spark: SparkSession,
    source: str | Sequence[str],
    output_dir: str,
    spec: SurveySpec = CARDIO,
    sample_size: int = 100_000,
    language: str = "ko",
    fmt: str = "parquet",
) -> list[str]:
    """Write the result tables and return their names.

    All rates come from one pass over the table. The sample and the train/test split
    depend on the rows alone, so they are the same for every way of storing them.
    Without model rows no model table is written.
    """
    cleaned = read_cleaned(spark, source, spec, view=spec.view, fmt=fmt)
    written: list[str] = []

    def save(name, result):
        save_result(result, output_dir, name)
        written.append(name)

    keys = [spec.age, spec.flags[0], spec.score, spec.year]
    grain = staged(rate_grain(cleaned, keys, spec.target))
    rate = answers.rate_from(grain)
    save(AGE, answers.by_age(rate, spec))
    save(AGE_LABELLED, answers.by_age_labelled(rate, spec, language))
    save(PRESSURE, answers.by_pressure(rate, spec, language))
    save(SCORE, answers.by_score(rate, spec))
    save(YEAR, answers.by_year(rate, spec))
    save(AGE_SCORE, answers.by_age_and_score(rate, spec))
    save(MATRIX, answers.age_score_matrix(rate, spec, language))
    save(
        SAMPLE,
        answers.scaled_sample(cleaned, spec, None, sample_size, language, fast_row_hash),
    )
    save(BOX, answers.scaled_box(cleaned, spec, language, spec.scaled_coded))
    report = train_test_report(cleaned, spec, None, language, fast_row_hash)
    if report is not None:
        save(METRICS, report.metrics)
        save(COEFFICIENTS, report.coefficients)
    unstage(grain)
    return written


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", nargs="+", required=True)
    parser.add_argument("--output-dir", required=True)
    parser.add_argument("--bmi-sample-size", type=int, default=100_000)
    parser.add_argument("--labels", choices=sorted(CARDIO.labels), default="ko")
    parser.add_argument("--format", choices=("parquet", "csv"), default="parquet")
    options = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("cohortlens-analyze").getOrCreate()
    for name in analyze(
        spark,
        options.input,
        options.output_dir,
        sample_size=options.bmi_sample_size,
        language=options.labels,
        fmt=options.format,
    ):
        print("written:", name)


if __name__ == "__main__":
    main()
