"""The logistic fit against an independent Newton solver, and its report tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import model
from cohortlens.plans.cleaning import clean_survey
from cohortlens.plans.coded_lineitem import ROW_KEY, coded_lineitem
from cohortlens.plans.modelling import score_test_rows, train_test_report
from cohortlens.spec import CARDIO

TABLES = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def cleaned(spark):
    return clean_survey(coded_lineitem(spark, TABLES), CARDIO, ROW_KEY).cache()


@pytest.fixture(scope="module")
def split(cleaned):
    train, test = model.hash_split(model.model_frame(cleaned, CARDIO, ROW_KEY), ROW_KEY)
    return train.cache(), test.cache()


def newton(features, label, reg):
    """Minimise mean log-loss + reg/2 · Σ(σw)², the intercept free; σ sample deviations."""
    count, width = features.shape
    design = np.hstack([np.ones((count, 1)), features])
    penalty = np.diag(np.r_[0.0, reg * features.std(axis=0, ddof=1) ** 2])
    weights = np.zeros(width + 1)
    for _ in range(50):
        chance = 1 / (1 + np.exp(-design @ weights))
        gradient = design.T @ (chance - label) / count + penalty @ weights
        curvature = (design * (chance * (1 - chance))[:, None]).T @ design / count + penalty
        step = np.linalg.solve(curvature, gradient)
        weights -= step
        if np.abs(step).max() < 1e-12:
            break
    return weights[0], weights[1:]


def slopes(spark, fitted):
    table = model.coefficients(fitted, CARDIO.features, CARDIO.labels["en"].features, "name")
    found = {r.feature: r.coefficient for r in table.collect()}
    return np.array([found[f] for f in CARDIO.features])


@pytest.fixture(scope="module")
def solution(split):
    frame = split[0].toPandas()
    return newton(frame[list(CARDIO.features)].to_numpy(), frame["label"].to_numpy(), 0.01)


def test_fit_on_rows_equals_newton(spark, split, solution):
    fitted = model.fit_logistic(split[0], CARDIO.features)
    assert slopes(spark, fitted) == pytest.approx(solution[1], abs=1e-4)
    assert fitted.stages[-1].intercept == pytest.approx(solution[0], abs=1e-4)


def test_fit_on_counts_equals_newton(spark, split, solution):
    counted = model.collapse(split[0], [model.LABEL, *CARDIO.features])
    fitted = model.fit_logistic(counted, CARDIO.features, weight=model.WEIGHT)
    assert slopes(spark, fitted) == pytest.approx(solution[1], abs=1e-4)
    assert fitted.stages[-1].intercept == pytest.approx(solution[0], abs=1e-4)


def test_fit_to_the_end_is_the_optimum(spark, split, solution):
    """Newton steps over counted rows meet an independent solver more closely than the iterations."""
    train, test = split
    counted = model.collapse(train, [model.LABEL, *CARDIO.features])
    exact = model.fit_to_the_end(counted, CARDIO.features)
    again = model.fit_to_the_end(counted.repartition(7), CARDIO.features)
    assert exact.values == pytest.approx(again.values, abs=1e-10)
    loose = model.fit_logistic(counted, CARDIO.features, weight=model.WEIGHT, max_iter=200, tol=1e-12)
    assert exact.values == pytest.approx(model._plain_coefficients(loose), abs=1e-4)
    scored = exact.score(test.limit(50)).collect()
    for row in scored:
        margin = exact.intercept + sum(v * row[f] for f, v in zip(CARDIO.features, exact.values, strict=True))
        assert row.probability_yes == pytest.approx(1 / (1 + math.exp(-margin)))
        assert row.prediction == float(margin > 0)


def test_exact_fit_of_a_constant_feature(spark):
    rows = [(float(i % 3 == 0), 1.0, float(i % 5), 1.0) for i in range(60)]
    table = spark.createDataFrame(rows, "label double, same double, other double, weight double")
    fitted = model.fit_to_the_end(table, ["same", "other"])
    assert fitted.values[0] == 0.0
    assert fitted.values[1] == pytest.approx(
        model._plain_coefficients(model.fit_logistic(table, ["same", "other"], weight="weight", max_iter=200, tol=1e-12))[1],
        abs=1e-5,
    )


def test_weighted_auc_counts_rows(spark):
    rows = [(0.2, 0.0, 3.0), (0.2, 1.0, 1.0), (0.7, 1.0, 4.0), (0.7, 0.0, 2.0), (0.9, 0.0, 1.0)]
    table = spark.createDataFrame(rows, "p double, label double, weight double")
    single = table.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("weight").cast("int"))))
    whole = model.auc_by_score(single, "p", "label").first()
    assert model.auc_by_score(table, "p", "label", weight="weight").first() == whole
    pairs = [(a, b) for a in single.collect() for b in single.collect() if a.label > b.label]
    won = sum(1.0 if a.p > b.p else 0.5 if a.p == b.p else 0.0 for a, b in pairs)
    assert whole.auc == pytest.approx(won / len(pairs))


def test_counts_of_a_hot_combination(spark):
    """Half of the rows are equal, so weights are far from uniform."""
    generator = np.random.default_rng(3)
    x = np.round(generator.normal(0, 2, (300, 2)), 1)
    y = (generator.random(300) < 1 / (1 + np.exp(-x[:, 0]))).astype(float)
    rows = [(float(b), float(a[0]), float(a[1])) for a, b in zip(x, y, strict=True)]
    rows += [(1.0, 3.0, -1.0)] * 300
    frame = spark.createDataFrame(rows, "label double, a double, b double")
    counted = model.collapse(frame, ["label", "a", "b"])
    fitted = model.fit_logistic(counted, ["a", "b"], weight=model.WEIGHT)
    table = model.coefficients(fitted, ["a", "b"], {"a": "A", "b": "B"}, "name").collect()
    found = {r.feature: r.coefficient for r in table}
    data = np.array(rows)
    intercept, expected = newton(data[:, 1:], data[:, 0], 0.01)
    assert [found["a"], found["b"]] == pytest.approx(list(expected), abs=1e-3)
    assert fitted.stages[-1].intercept == pytest.approx(intercept, abs=1e-3)


def test_constant_feature_gets_no_weight(spark):
    frame = spark.createDataFrame(
        [(float(i % 3 == 0), float(i), 5.0) for i in range(40)],
        "label double, a double, b double",
    )
    counted = model.collapse(frame, ["label", "a", "b"])
    fitted = model.fit_logistic(counted, ["a", "b"], weight=model.WEIGHT)
    table = model.coefficients(fitted, ["a", "b"], {"a": "A", "b": "B"}, "name").collect()
    assert {r.feature: r.coefficient for r in table}["b"] == 0.0


def test_report(spark, cleaned, split):
    report = train_test_report(cleaned, CARDIO, ROW_KEY)
    quality = {r.metric: r.value for r in report.metrics.collect()}
    assert list(quality) == ["model_input_rows", "test_rows", "auc", "accuracy"]
    assert quality["model_input_rows"] == 8342
    assert quality["test_rows"] == split[1].count() == 1652
    direct = model.fit_logistic(split[0], CARDIO.features)
    scored = {
        r.metric: r.value
        for r in model.metrics(model.score(direct, split[1]), 8342).collect()
    }
    assert quality["accuracy"] == pytest.approx(scored["accuracy"], abs=1e-9)
    assert quality["auc"] == pytest.approx(scored["auc"], abs=1e-3)

    weights = report.coefficients.collect()
    assert report.coefficients.columns == [
        "feature",
        "feature_korean",
        "coefficient",
        "odds_ratio",
    ]
    assert {r.feature for r in weights} == set(CARDIO.features)
    ordered = [r.coefficient for r in weights]
    assert ordered == sorted(ordered, reverse=True)
    for r in weights:
        assert r.odds_ratio == pytest.approx(math.exp(r.coefficient))
        assert r.feature_korean == CARDIO.labels["ko"].features[r.feature]


def test_auc_by_score_equals_evaluator(split):
    fitted = model.fit_logistic(split[0], CARDIO.features)
    scored = model.predictions(model.score(fitted, split[1]))
    exact = model.auc_by_score(scored, "probability_yes", model.LABEL).first().auc
    table = model.metrics(model.score(fitted, split[1]), 0).collect()
    assert {r.metric: r.value for r in table}["auc"] == pytest.approx(exact, abs=1e-3)
    sliced = model.auc_by_score(scored, "probability_yes", model.LABEL, coded=False).first()
    assert sliced.auc == pytest.approx(exact, abs=1e-12)


def test_predictions_cover_every_test_row(cleaned, split):
    scored = score_test_rows(cleaned, CARDIO, ROW_KEY)
    assert scored.columns == [*ROW_KEY, "label", "prediction", "probability_yes"]
    found = scored.collect()
    assert len(found) == split[1].count()
    for r in found:
        assert 0 <= r.probability_yes <= 1
        assert r.prediction == float(r.probability_yes > 0.5)


def test_metrics_without_test_rows(split):
    fitted = model.fit_logistic(split[0], CARDIO.features)
    none = model.score(fitted, split[1].where("label > 5"))
    table = {r.metric: r.value for r in model.metrics(none, 10).collect()}
    assert table == {"model_input_rows": 10.0, "test_rows": 0.0, "auc": 0.0, "accuracy": 0.0}


def test_no_report_without_model_rows(cleaned):
    assert train_test_report(cleaned.where("SEX = 5"), CARDIO, ROW_KEY) is None
