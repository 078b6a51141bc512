"""From raw columns to the cleaned table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from cohortlens.operators import clean, shape
from cohortlens.spec import SurveySpec


def clean_survey(raw: DataFrame, spec: SurveySpec, carry: Sequence[str] = ()) -> DataFrame:
    """Typed survey columns of rows with a valid outcome, then the derived columns.

    One scan, one filter, one projection; ``carry`` columns come last.
    """
    typed = shape.lenient_cast(shape.align_columns(raw, spec, carry), spec)
    valid = clean.keep_valid_target(typed, spec.outcome, spec.outcome_codes)
    rules = {rule.output: (rule.source, rule.yes, rule.no) for rule in spec.recodes}
    with_target = clean.add_target(valid, spec.outcome, spec.outcome_yes, spec.target)
    scaled = clean.add_scaled(with_target, spec.scaled_source, spec.scaled_divisor, spec.scaled)
    scored = clean.add_score(clean.recode_binary(scaled, rules), spec.flags, spec.score)
    return scored.select(*spec.columns, *spec.derived, *carry)
