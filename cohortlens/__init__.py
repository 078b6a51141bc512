"""Coded-survey analytics as lazy PySpark DataFrame operators."""

from cohortlens.spec import CARDIO, Labels, Recode, SurveySpec

__all__ = ["CARDIO", "Labels", "Recode", "SurveySpec"]
