"""The logistic model from cleaned rows to its two report tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import Hasher, row_hash
from cohortlens.operators import model
from cohortlens.operators.distribution import COPY, number_equal_rows
from cohortlens.sources.staging import staged
from cohortlens.spec import SurveySpec


def _scored(fitted: PipelineModel | model.Logit, rows: DataFrame) -> DataFrame:
    return fitted.score(rows) if isinstance(fitted, model.Logit) else model.score(fitted, rows)


def _fitted(train: DataFrame, spec: SurveySpec, exact: bool) -> PipelineModel | model.Logit:
    if exact:
        return model.fit_to_the_end(train, spec.features)
    return model.fit_logistic(train, spec.features, weight=model.WEIGHT)


@dataclass
class ModelReport:
    """A fitted model and what its two tables are made of; each runs when asked for."""

    fitted: PipelineModel | model.Logit
    test: DataFrame
    input_rows: float
    spec: SurveySpec
    language: str

    @cached_property
    def metrics(self) -> DataFrame:
        return model.metrics(_scored(self.fitted, self.test), self.input_rows, model.WEIGHT)

    @cached_property
    def coefficients(self) -> DataFrame:
        labels = self.spec.labels[self.language]
        return model.coefficients(
            self.fitted, self.spec.features, labels.features, labels.feature_column
        )


def counted_combinations(
    cleaned: DataFrame,
    spec: SurveySpec,
    key: Sequence[str] | None = None,
    hasher: Hasher = row_hash,
) -> DataFrame:
    """Model rows counted per split, label and features: the one pass over all rows.

    The split goes by the hash of ``key``; without one, rows are told apart by their
    values and their number among equals, the same however the table is stored.
    """
    frame = model.model_frame(cleaned, spec, key or ())
    if key is None:
        values = [model.LABEL, *spec.features]
        frame, key = number_equal_rows(frame, values), [*values, COPY]
    marked = model.mark_split(frame, key, hasher=hasher)
    return model.collapse(marked, [model.TRAIN, model.LABEL, *spec.features])


def train_test_report(
    cleaned: DataFrame,
    spec: SurveySpec,
    key: Sequence[str] | None = None,
    language: str = "ko",
    hasher: Hasher = row_hash,
    exact: bool = False,
) -> ModelReport | None:
    """Fit on the train rows, for evaluation on the others; None without any model rows.

    ``exact`` fits to the optimum instead of for a number of iterations.

    The counted combinations are written once, so that the iterations and the
    evaluation never go back to the rows.
    """
    combinations = staged(counted_combinations(cleaned, spec, key, hasher))
    input_rows = combinations.agg(F.sum(model.WEIGHT)).first()[0]
    if not input_rows:
        return None
    train = combinations.where(model.TRAIN)
    test = combinations.where(~F.col(model.TRAIN))
    fitted = _fitted(train, spec, exact)
    return ModelReport(fitted, test, input_rows, spec, language)


def score_test_rows(
    cleaned: DataFrame,
    spec: SurveySpec,
    key: Sequence[str],
    hasher: Hasher = row_hash,
    exact: bool = False,
) -> DataFrame:
    """Every test row with the class and probability the fitted model gives it."""
    marked = model.mark_split(model.model_frame(cleaned, spec, key), key, hasher=hasher)
    marked = staged(marked)
    train, test = marked.where(model.TRAIN), marked.where(~F.col(model.TRAIN)).drop(model.TRAIN)
    counted = staged(model.collapse(train, [model.LABEL, *spec.features]))
    return model.predictions(_scored(_fitted(counted, spec, exact), test), key)
