"""The survey's questions as queries over the cleaned table.

Each rate query takes ``rate``, which is ``rate_by`` on rows or ``roll_up`` on
a grain built once for all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import Hasher, row_hash
from cohortlens.operators import distribution, rates
from cohortlens.spec import SurveySpec

Rate = Callable[..., DataFrame]
# Result column names.
AGE_GROUP = "age_group"
AGE_LABEL = "age_label"
PRESSURE_GROUP = "blood_pressure_group"
SCORE_NAME = "risk_score"
YEAR_NAME = "year"
OUTCOME_LABEL = "disease_label"
# Keeps the sample apart from the train/test split, which hashes the same rows.
SAMPLE_SALT = "sample"


def rate_on(spec: SurveySpec, rows: DataFrame) -> Rate:
    """Rates straight from rows."""
    return lambda keys, **options: rates.rate_by(rows, keys, spec.target, **options)


def rate_from(grain: DataFrame) -> Rate:
    """Rates rolled up from a grain."""
    return lambda keys, **options: rates.roll_up(grain, keys, **options)


def known_age(spec: SurveySpec):
    return F.col(spec.age).between(*spec.age_range)


def by_age(rate: Rate, spec: SurveySpec, percent: bool = False) -> DataFrame:
    return rate(
        [spec.age], where=known_age(spec), alias={spec.age: AGE_GROUP}, percent=percent
    )


def by_age_labelled(rate: Rate, spec: SurveySpec, language: str = "ko") -> DataFrame:
    ages = spec.labels[language].age
    return rates.label_codes(by_age(rate, spec, percent=True), AGE_GROUP, ages, AGE_LABEL)


def by_pressure(rate: Rate, spec: SurveySpec, language: str = "ko") -> DataFrame:
    """Listed with the flag's "yes" first; the code itself is not shown."""
    flag = spec.flags[0]
    found = rate([flag], alias={flag: PRESSURE_GROUP}, descending=True)
    return rates.label_codes(found, PRESSURE_GROUP, spec.labels[language].flag, PRESSURE_GROUP)


def by_score(rate: Rate, spec: SurveySpec) -> DataFrame:
    return rate([spec.score], alias={spec.score: SCORE_NAME})


def by_year(rate: Rate, spec: SurveySpec) -> DataFrame:
    return rate([spec.year], alias={spec.year: YEAR_NAME})


def by_age_and_score(rate: Rate, spec: SurveySpec) -> DataFrame:
    names = {spec.age: AGE_GROUP, spec.score: SCORE_NAME}
    return rate([spec.age, spec.score], where=known_age(spec), alias=names)


def age_score_matrix(rate: Rate, spec: SurveySpec, language: str = "ko") -> DataFrame:
    """Percentages by labelled age band and score."""
    cells = rates.matrix_of(
        by_age_and_score(rate, spec),
        AGE_GROUP,
        SCORE_NAME,
        spec.score_values,
        "score_",
        percent=True,
    )
    return rates.label_codes(cells, AGE_GROUP, spec.labels[language].age, AGE_LABEL)


def scaled_sample(
    cleaned: DataFrame,
    spec: SurveySpec,
    key: Sequence[str] | None = None,
    limit: int | None = 100_000,
    language: str = "ko",
    hasher: Hasher = row_hash,
) -> DataFrame:
    """A tenth of the outcome/number pairs inside the open range, at most ``limit``.

    Chosen by the hash of ``key``; without one, rows are told apart by their values
    and their number among equals, the same however the table is stored.
    """
    inside = distribution.in_open_range(cleaned, spec.scaled, *spec.scaled_range)
    columns = [spec.target, spec.scaled]
    if key is None:
        inside = distribution.number_equal_rows(inside, columns)
        key = [*columns, distribution.COPY]
    sample = distribution.hash_sample(inside, key, columns, 100, limit, SAMPLE_SALT, hasher)
    return rates.label_codes(sample, spec.target, spec.labels[language].outcome, OUTCOME_LABEL)


def scaled_box(
    cleaned: DataFrame, spec: SurveySpec, language: str = "ko", coded: bool = False
) -> DataFrame:
    inside = distribution.in_open_range(cleaned, spec.scaled, *spec.scaled_range)
    box = distribution.box_stats(inside, spec.target, spec.scaled, coded)
    return rates.label_codes(box, spec.target, spec.labels[language].outcome, OUTCOME_LABEL)
