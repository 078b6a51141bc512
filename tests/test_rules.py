"""Each rule on small literal frames."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cohortlens.functions import LEADING_YEAR, PART_YEAR, year_from_name
from cohortlens.operators import clean, distribution, model, rates, shape
from cohortlens.plans.cleaning import clean_survey
from cohortlens.spec import CARDIO


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


@pytest.mark.parametrize(
    ("text", "whole", "real"),
    [
        ("3", 3, 3.0),
        ("3.0", 3, 3.0),
        ("3.7", 3, 3.7),
        ("-3.7", -3, -3.7),
        (" 2 ", 2, 2.0),
        ("1e2", 100, 100.0),
        ("5.4e-79", 0, 0.0),
        ("", None, None),
        ("abc", None, None),
        (None, None, None),
        ("3e10", None, 3e10),
    ],
)
def test_lenient_cast_of_text(spark, text, whole, real):
    raw = spark.createDataFrame([(text, text)], "SEX string, _BMI5 string")
    typed = shape.lenient_cast(raw, CARDIO)
    assert dict(typed.dtypes) == {"SEX": "int", "_BMI5": "float"}
    found = typed.first()
    assert found.SEX == whole
    assert found._BMI5 == (None if real is None else pytest.approx(real, rel=1e-6))


def test_lenient_cast_of_numbers(spark):
    raw = spark.createDataFrame(
        [(1.9, 5, 2512), (float("nan"), 1 << 40, None), (None, None, 3)],
        "SEX double, YEAR bigint, _BMI5 int",
    )
    assert values(shape.lenient_cast(raw, CARDIO), "SEX", "YEAR", "_BMI5") == [
        (1, 5, 2512.0),
        (None, None, None),
        (None, None, 3.0),
    ]


def test_nan_text_is_no_code(spark):
    raw = spark.createDataFrame([("NaN",), ("Infinity",)], "SEX string")
    assert values(shape.lenient_cast(raw, CARDIO), "SEX") == [(None,), (None,)]


def test_align_keeps_order_and_types(spark):
    raw = spark.createDataFrame([(2, 2011, "x")], "SEX int, YEAR int, other string")
    aligned = shape.align_columns(raw, CARDIO, ["other"])
    assert aligned.columns == [*CARDIO.columns, "other"]
    assert dict(aligned.dtypes)["_BMI5"] == "float"
    assert values(aligned, "YEAR", "SEX", "MEDCOST", "other") == [(2011, 2, None, "x")]


def test_union_keeps_repeated_rows(spark):
    one = spark.createDataFrame([(1, 2011)], "SEX int, YEAR int")
    two = spark.createDataFrame([(2012, "1.0"), (2011, "1")], "YEAR int, SEX string")
    both = shape.align_union([one, two], CARDIO)
    assert sorted(values(both, "YEAR", "SEX")) == [(2011, 1), (2011, 1), (2012, 1)]


def test_keep_available(spark):
    df = spark.createDataFrame([(1, 2, 3)], "SEX int, other int, YEAR int")
    assert shape.keep_available(df, CARDIO.columns).columns == ["YEAR", "SEX"]


def survey(spark, rows):
    """Rows of outcome, pressure, cholesterol, diabetes, smoking, sex, age, number."""
    names = ["CVDINFR4", "BPHIGH4", "TOLDHI2", "DIABETE3", "SMOKE100", "SEX", "_AGEG5YR"]
    schema = ", ".join(f"{n} int" for n in names) + ", _BMI5 float"
    return clean_survey(spark.createDataFrame(rows, schema), CARDIO)


def test_cleaned_table(spark):
    cleaned = survey(
        spark,
        [
            (1, 1, 1, 1, 1, 1, 5, 2683.0),
            (2, 3, 2, 3, 2, 2, 14, None),
            (7, 1, 1, 1, 1, 1, 5, 2500.0),
            (None, 1, 1, 1, 1, 1, 5, 2500.0),
            (2, 2, 1, 1, 1, 9, 5, 99999.0),
            (2, 4, 7, 2, 9, 1, None, 1.0),
            (2, 1, 2, 1, 2, 1, 5, 2500.0),
        ],
    )
    assert cleaned.schema.names == CARDIO.cleaned_schema.names
    assert [f.dataType for f in cleaned.schema] == [
        f.dataType for f in CARDIO.cleaned_schema
    ]
    assert values(cleaned, *CARDIO.derived) == [
        (1, 26.83, 1, 1, 1, 1, 4),
        (0, None, 0, 0, 0, 0, 0),
        (0, 999.99, None, 1, 1, 1, None),
        (0, 0.01, None, None, None, None, None),
        (0, 25.0, 1, 0, 1, 0, 2),
    ]


def test_quality_report_and_preview(spark):
    df = spark.createDataFrame([(2, 1), (1, 9), (2, 0), (None, 4)], "YEAR int, v int")
    assert values(clean.quality_report(df, "YEAR"), "*") == [(None, 1), (1, 1), (2, 2)]
    assert values(clean.preview(df, ["YEAR"], 3), "*") == [(None, 4), (1, 9), (2, 0)]


@pytest.fixture
def coded(spark):
    return spark.createDataFrame(
        [(1, 0, 1), (1, 0, 0), (1, 1, 0), (2, 1, 1), (None, 1, 1), (14, 0, 1), (2, None, 0)],
        "age int, score int, y int",
    )


def test_rates_are_sorted_and_drop_null_keys(coded):
    assert values(rates.rate_by(coded, ["age"], "y"), "*") == [
        (1, 3, pytest.approx(1 / 3)),
        (2, 2, 0.5),
        (14, 1, 1.0),
    ]
    kept = rates.rate_by(coded, ["age"], "y", drop_null_keys=False)
    assert values(kept, "age") == [(None,), (1,), (2,), (14,)]


def test_rates_options(coded):
    found = rates.rate_by(
        coded,
        ["score"],
        "y",
        where=F.col("age").between(1, 13),
        alias={"score": "s"},
        percent=True,
        descending=True,
    )
    assert found.columns == ["s", "respondent_count", "disease_rate", "rate_percent"]
    assert values(found, "*") == [(1, 2, 0.5, 50.0), (0, 2, 0.5, 50.0)]


def test_empty_input_has_no_rates(coded):
    assert rates.rate_by(coded.where("age > 99"), ["age"], "y").count() == 0


def test_labels(coded):
    labelled = rates.label_codes(coded, "age", {1: "one", 2: "two"}, "label")
    assert set(values(labelled, "age", "label")) == {
        (1, "one"),
        (2, "two"),
        (None, None),
        (14, None),
    }


def test_matrix_has_null_for_missing_pairs(coded):
    matrix = rates.rate_matrix(coded, "age", "score", [0, 1, 2], "y", "s_", percent=True)
    assert matrix.columns == ["age", "s_0", "s_1", "s_2"]
    assert values(matrix, "*") == [
        (1, 50.0, 0.0, None),
        (2, None, 100.0, None),
        (14, 100.0, None, None),
    ]


def test_open_range_leaves_out_both_ends(spark):
    df = spark.createDataFrame([(10.0,), (10.5,), (80.0,), (79.9,), (None,)], "v double")
    assert values(distribution.in_open_range(df, "v", 10, 80), "v") == [(10.5,), (79.9,)]


def test_model_bounds_keep_both_ends(spark):
    good = (1, 1, 1, 1, 1, 1, 5)
    cleaned = survey(
        spark,
        [
            (*good, 1000.0),
            (*good, 8000.0),
            (*good, 999.0),
            (*good, 8001.0),
            (*good, None),
            (1, 1, 1, 1, 1, 9, 5, 2500.0),
            (1, 1, 1, 1, 1, 1, 14, 2500.0),
            (1, 2, 1, 1, 1, 1, 5, 2500.0),
        ],
    )
    frame = model.model_frame(cleaned, CARDIO)
    assert frame.columns == ["label", *CARDIO.features]
    assert {kind for _, kind in frame.dtypes} == {"double"}
    assert values(frame, "BMI_Real") == [(10.0,), (80.0,)]


def test_model_frame_drops_nan(spark):
    fields = ["Has_Disease", *CARDIO.features]
    rows = [(1.0,) * 6 + (5.0, 20.0), (1.0, float("nan")) + (1.0,) * 4 + (5.0, 20.0)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in fields))
    assert model.model_frame(df, CARDIO).count() == 1


def test_threshold_accuracy(spark):
    df = spark.createDataFrame([(2, 1), (3, 0), (1, 0), (None, 1)], "s int, y int")
    assert values(model.threshold_accuracy(df, "s", 2, "y"), "*") == [
        (3, 2, pytest.approx(2 / 3))
    ]
    empty = model.threshold_accuracy(df.where("s > 9"), "s", 2, "y")
    assert values(empty, "*") == [(0, 0, 0.0)]


@pytest.mark.parametrize("coded", [True, False])
def test_auc_equals_pairs(spark, coded):
    rows = [(s, y) for s in range(5) for y in (0, 1) for _ in range((s * 3 + y * 5) % 7)]
    pairs = [(a, b) for a, y in rows if y for b, z in rows if not z]
    won = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in pairs) / len(pairs)
    df = spark.createDataFrame(rows, "s int, y int")
    found = model.auc_by_score(df.repartition(5), "s", "y", coded).first()
    assert found.auc == pytest.approx(won, abs=1e-12)
    only_yes = model.auc_by_score(df.where("y = 1"), "s", "y", coded).first()
    assert only_yes.auc is None


@pytest.mark.parametrize(
    ("name", "part", "leading"),
    [
        ("part_2011_3.csv", 2011, None),
        ("2012.csv", None, 2012),
        ("2012_x.csv", None, 2012),
        ("part_x.csv", None, None),
        ("201.csv", None, None),
    ],
)
def test_year_from_name(spark, name, part, leading):
    df = spark.createDataFrame([(name,)], "n string")
    found = df.select(
        year_from_name(F.col("n"), PART_YEAR), year_from_name(F.col("n"), LEADING_YEAR)
    ).first()
    assert tuple(found) == (part, leading)


def test_strict_year_fails_without_one(spark):
    df = spark.createDataFrame([("part_x.csv",)], "n string")
    with pytest.raises(PySparkException, match="no year in file name"):
        df.select(year_from_name(F.col("n"), PART_YEAR, strict=True)).collect()


def test_label_languages_cover_the_same_codes():
    ko, en = CARDIO.labels["ko"], CARDIO.labels["en"]
    assert list(ko.age) == list(en.age) == list(range(1, 14))
    assert list(ko.features) == list(en.features) == list(CARDIO.features)
    assert set(ko.flag) == set(en.flag) == set(ko.outcome) == {0, 1}
