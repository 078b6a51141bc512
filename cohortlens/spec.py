"""Declarative description of a coded survey.

Operators take their column names, codes, bounds and labels from a
``SurveySpec``, so the same operators run on any coded table.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from types import MappingProxyType

from pyspark.sql import types as T


@dataclass(frozen=True)
class Recode:
    """``output`` is 1 where ``source`` = ``yes``, 0 where it is ``no``, else NULL."""

    output: str
    source: str
    yes: int
    no: int


@dataclass(frozen=True)
class Labels:
    """Display texts of one language."""

    age: MappingProxyType
    flag: MappingProxyType
    outcome: MappingProxyType
    features: MappingProxyType
    feature_column: str


@dataclass(frozen=True)
class SurveySpec:
    columns: tuple[str, ...]
    float_columns: frozenset[str]
    year: str
    outcome: str
    outcome_codes: tuple[int, ...]
    outcome_yes: int
    target: str
    scaled_source: str
    scaled_divisor: int
    scaled: str
    recodes: tuple[Recode, ...]
    score: str
    age: str
    age_range: tuple[int, int]
    scaled_range: tuple[int, int]
    sex: str
    sex_codes: tuple[int, ...]
    features: tuple[str, ...]
    view: str
    #: The scaled number has few distinct values however many rows there are.
    scaled_coded: bool
    labels: MappingProxyType = field(repr=False)

    @property
    def flags(self) -> tuple[str, ...]:
        return tuple(rule.output for rule in self.recodes)

    @property
    def score_values(self) -> tuple[int, ...]:
        """Every value the score can take: the number of flags that are set."""
        return tuple(range(len(self.recodes) + 1))

    @property
    def derived(self) -> tuple[str, ...]:
        return (self.target, self.scaled, *self.flags, self.score)

    def raw_type(self, name: str) -> T.DataType:
        return T.FloatType() if name in self.float_columns else T.IntegerType()

    @property
    def raw_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, self.raw_type(c)) for c in self.columns])

    @property
    def cleaned_schema(self) -> T.StructType:
        fields = list(self.raw_schema.fields)
        for name in self.derived:
            kind = T.DoubleType() if name == self.scaled else T.IntegerType()
            fields.append(T.StructField(name, kind))
        return T.StructType(fields)


# Column names, codes, bounds and label texts of the survey.
COLUMNS = (
    "YEAR",
    "CVDINFR4",
    "BPHIGH4",
    "TOLDHI2",
    "DIABETE3",
    "SMOKE100",
    "SEX",
    "_AGEG5YR",
    "_BMI5",
    "GENHLTH",
    "PHYSHLTH",
    "MENTHLTH",
    "POORHLTH",
    "EXERANY2",
    "HLTHPLN1",
    "MEDCOST",
    "CHECKUP1",
    "ADDEPEV2",
    "_EDUCAG",
    "_INCOMG",
)
KOREAN = Labels(
    age=MappingProxyType(
        {
            1: "18-24세",
            2: "25-29세",
            3: "30-34세",
            4: "35-39세",
            5: "40-44세",
            6: "45-49세",
            7: "50-54세",
            8: "55-59세",
            9: "60-64세",
            10: "65-69세",
            11: "70-74세",
            12: "75-79세",
            13: "80세 이상",
        }
    ),
    flag=MappingProxyType({1: "고혈압 있음", 0: "고혈압 없음"}),
    outcome=MappingProxyType({1: "심근경색 경험자", 0: "비경험자"}),
    features=MappingProxyType(
        {
            "BP_Risk": "고혈압",
            "Cholesterol_Risk": "고콜레스테롤",
            "Diabetes_Risk": "당뇨",
            "Smoking_Risk": "흡연",
            "SEX": "성별",
            "_AGEG5YR": "연령대",
            "BMI_Real": "BMI",
        }
    ),
    feature_column="feature_korean",
)
ENGLISH = Labels(
    age=MappingProxyType(
        {
            1: "18-24",
            2: "25-29",
            3: "30-34",
            4: "35-39",
            5: "40-44",
            6: "45-49",
            7: "50-54",
            8: "55-59",
            9: "60-64",
            10: "65-69",
            11: "70-74",
            12: "75-79",
            13: "80 or older",
        }
    ),
    flag=MappingProxyType({1: "high blood pressure", 0: "no high blood pressure"}),
    outcome=MappingProxyType({1: "heart attack", 0: "no heart attack"}),
    features=MappingProxyType(
        {
            "BP_Risk": "high blood pressure",
            "Cholesterol_Risk": "high cholesterol",
            "Diabetes_Risk": "diabetes",
            "Smoking_Risk": "smoking",
            "SEX": "sex",
            "_AGEG5YR": "age band",
            "BMI_Real": "BMI",
        }
    ),
    feature_column="feature_name",
)

# Roles, codes, recodes, bounds and features of the survey's columns.
CARDIO = SurveySpec(
    columns=COLUMNS,
    float_columns=frozenset({"_BMI5"}),
    year="YEAR",
    outcome="CVDINFR4",
    outcome_codes=(1, 2),
    outcome_yes=1,
    target="Has_Disease",
    scaled_source="_BMI5",
    scaled_divisor=100,
    scaled="BMI_Real",
    recodes=(
        Recode("BP_Risk", "BPHIGH4", 1, 3),
        Recode("Cholesterol_Risk", "TOLDHI2", 1, 2),
        Recode("Diabetes_Risk", "DIABETE3", 1, 3),
        Recode("Smoking_Risk", "SMOKE100", 1, 2),
    ),
    score="Risk_Score",
    age="_AGEG5YR",
    age_range=(1, 13),
    scaled_range=(10, 80),
    sex="SEX",
    sex_codes=(1, 2),
    features=(
        "BP_Risk",
        "Cholesterol_Risk",
        "Diabetes_Risk",
        "Smoking_Risk",
        "SEX",
        "_AGEG5YR",
        "BMI_Real",
    ),
    view="cardio",
    scaled_coded=True,
    labels=MappingProxyType({"ko": KOREAN, "en": ENGLISH}),
)
