"""Logistic model of a 0/1 outcome: frame, split, fit, scores, quality."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, and_

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import ElementwiseProduct, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortlens.functions import Hasher, bucket_of, row_hash
from cohortlens.operators.blocks import running_total
from cohortlens.spec import SurveySpec

LABEL = "label"
WEIGHT = "weight"
TRAIN = "is_train"


def model_frame(df: DataFrame, spec: SurveySpec, carry: Sequence[str] = ()) -> DataFrame:
    """Label and features as doubles, complete rows within the closed bounds only.

    Filters are on the stored columns, so they reach the scan; the bounds already
    exclude NULL and NaN in the columns they test.
    """
    bounded = {spec.age, spec.scaled, spec.sex}
    complete = [c for c in (spec.target, *spec.features) if c not in bounded]
    kinds = dict(df.dtypes)
    numbers = [c for c in complete if kinds[c] in ("float", "double")]
    return df.where(
        reduce(and_, [F.col(c).isNotNull() for c in complete])
        & reduce(and_, [~F.isnan(c) for c in numbers], F.lit(True))
        & F.col(spec.age).between(*spec.age_range)
        & F.col(spec.scaled).between(*spec.scaled_range)
        & F.col(spec.sex).isin(*spec.sex_codes)
    ).select(
        F.col(spec.target).cast("double").alias(LABEL),
        *[F.col(f).cast("double").alias(f) for f in spec.features],
        *carry,
    )


def mark_split(
    df: DataFrame,
    key: Sequence[str],
    train_per_mille: int = 800,
    salt: str = "",
    hasher: Hasher = row_hash,
) -> DataFrame:
    """Add the split flag: hash bucket of ``key`` below ``train_per_mille`` of 1000."""
    return df.withColumn(TRAIN, bucket_of(hasher(key, salt)) < train_per_mille)


def hash_split(
    df: DataFrame,
    key: Sequence[str],
    train_per_mille: int = 800,
    salt: str = "",
    hasher: Hasher = row_hash,
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; together they are all rows, whatever the partitioning."""
    marked = mark_split(df, key, train_per_mille, salt, hasher)
    return marked.where(TRAIN).drop(TRAIN), marked.where(~F.col(TRAIN)).drop(TRAIN)


def collapse(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per distinct combination of ``columns``, with its row count as weight.

    Coded features have few combinations, so a fit over the result repeats its
    passes over those instead of over all rows. Counts are combined before the
    shuffle.
    """
    return df.groupBy(*columns).agg(F.count(F.lit(1)).cast("double").alias(WEIGHT))


def fit_logistic(
    train: DataFrame,
    features: Sequence[str],
    max_iter: int = 20,
    reg: float = 0.01,
    weight: str | None = None,
    tol: float = 1e-6,
) -> PipelineModel:
    """Binary logistic regression with an L2 penalty on standardised coefficients.

    With ``weight`` each row stands for that many equal rows. Spark's own
    standardisation reads weights as importances, not counts, so features are
    divided by their exact sample deviations first and the penalty is taken on
    those. Runs the jobs of the fit.
    """
    assembler = VectorAssembler(
        inputCols=list(features), outputCol="features", handleInvalid="skip"
    )
    regression = LogisticRegression(labelCol=LABEL, maxIter=max_iter, regParam=reg, tol=tol)
    if weight is None:
        return _without_summary(Pipeline(stages=[assembler, regression]).fit(train))
    scale = [1 / d if d > 0 else 0.0 for d in _sample_deviations(train, features, weight)]
    scaler = ElementwiseProduct(
        scalingVec=Vectors.dense(scale), inputCol="features", outputCol="scaled_features"
    )
    regression.setFeaturesCol("scaled_features").setWeightCol(weight).setStandardization(False)
    return _without_summary(Pipeline(stages=[assembler, scaler, regression]).fit(train))


def _without_summary(fitted: PipelineModel) -> PipelineModel:
    """The model without its training summary, which holds on to the session.

    A session that has observed a query cannot be sent to tasks, and with it no model
    that holds on to it.
    """
    regression = fitted.stages[-1]
    none = SparkSession.active().sparkContext._jvm.scala.Option.empty()
    regression._java_obj.setSummary(none)
    return fitted


def _sample_deviations(df: DataFrame, features: Sequence[str], weight: str) -> list[float]:
    """Sample standard deviations of features whose rows count ``weight`` times."""
    w = F.col(weight)
    first = df.agg(
        F.sum(w).alias("total"),
        *[(F.sum(w * F.col(f)) / F.sum(w)).alias(f"mean_{i}") for i, f in enumerate(features)],
    ).first()
    if not first.total or first.total < 2:
        return [0.0] * len(features)
    squares = df.agg(
        *[
            F.sum(w * F.pow(F.col(f) - F.lit(first[f"mean_{i}"]), 2)).alias(f"square_{i}")
            for i, f in enumerate(features)
        ]
    ).first()
    return [math.sqrt(square / (first.total - 1)) for square in squares]


@dataclass(frozen=True)
class Logit:
    """A fitted model as plain numbers: ``intercept`` and one coefficient a feature."""

    features: tuple[str, ...]
    intercept: float
    values: tuple[float, ...]

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with ``probability_yes`` and ``prediction``, as plain expressions."""
        terms = [F.col(f) * F.lit(v) for f, v in zip(self.features, self.values, strict=True)]
        margin = reduce(add, terms, F.lit(self.intercept))
        return df.withColumns(
            {
                "probability_yes": 1 / (1 + F.exp(-margin)),
                "prediction": (margin > 0).cast("double"),
            }
        )


def fit_to_the_end(
    train: DataFrame,
    features: Sequence[str],
    reg: float = 0.01,
    weight: str = WEIGHT,
    steps: int = 50,
    tol: float = 1e-12,
) -> Logit:
    """The exact optimum of ``fit_logistic``'s objective, by Newton steps from zero.

    Each step is one aggregation of the counted combinations into a gradient and a
    matrix of the features' number squared, solved on the driver; steps end when no
    standardised coefficient moves by more than ``tol``.
    """
    deviations = _sample_deviations(train, features, weight)
    scale = np.array([1.0, *[1 / d if d > 0 else 0.0 for d in deviations]])
    x = [F.lit(1.0), *[F.col(f) * F.lit(float(s)) for f, s in zip(features, scale[1:], strict=True)]]
    size, w = len(x), F.col(weight)
    penalty = np.diag([0.0, *[reg] * len(features)])
    b = np.zeros(size)
    for _ in range(steps):
        margin = reduce(add, [term * F.lit(float(v)) for term, v in zip(x, b, strict=True)])
        p = 1 / (1 + F.exp(-margin))
        sums = [F.sum(w * (p - F.col(LABEL)) * x[i]) for i in range(size)]
        sums += [F.sum(w * p * (1 - p) * x[i] * x[j]) for i in range(size) for j in range(i + 1)]
        found = train.agg(F.sum(w).alias("n"), *[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
        total = np.array(found[1:], float) / found["n"]
        curve = np.zeros((size, size))
        curve[np.tril_indices(size)] = total[size:]
        curve += np.tril(curve, -1).T + penalty
        move = np.linalg.lstsq(curve, total[:size] + penalty @ b, rcond=None)[0]
        b = b - move
        if np.abs(move).max() <= tol:
            break
    values = b * scale
    return Logit(tuple(features), float(values[0]), tuple(float(v) for v in values[1:]))


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with the model's ``rawPrediction``, ``probability`` and ``prediction``."""
    return model.transform(df)


def predictions(scored: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Label, predicted class and probability of class 1 as plain columns."""
    if "probability_yes" not in scored.columns:
        scored = scored.withColumn("probability_yes", vector_to_array("probability")[1])
    return scored.select(*carry, LABEL, "prediction", "probability_yes")


def coefficients(
    model: PipelineModel | Logit,
    features: Sequence[str],
    labels: Mapping[str, str],
    label_column: str,
) -> DataFrame:
    """Feature, display name, coefficient and odds ratio, largest coefficient first."""
    values = list(model.values) if isinstance(model, Logit) else _plain_coefficients(model)
    rows = [(f, labels[f], v) for f, v in zip(features, values, strict=True)]
    table = SparkSession.active().createDataFrame(
        rows, f"feature string, `{label_column}` string, coefficient double"
    )
    return table.withColumn("odds_ratio", F.exp("coefficient")).orderBy(F.desc("coefficient"))


def _plain_coefficients(model: PipelineModel) -> list[float]:
    """A fitted pipeline's coefficients, of the features as they are stored."""
    regression = model.stages[-1]
    values = [float(v) for v in regression.coefficients]
    for stage in model.stages:
        if isinstance(stage, ElementwiseProduct):
            values = [float(v * s) for v, s in zip(values, stage.getScalingVec(), strict=True)]
    return values


def metrics(scored: DataFrame, input_rows: int, weight: str | None = None) -> DataFrame:
    """``model_input_rows``, ``test_rows``, ``auc`` and ``accuracy`` as four rows.

    The area under the ROC curve is exact: from running sums over all distinct
    probabilities, ties counted half. Without test rows both rates are 0, and the area
    is 0 where only one class was tested. Runs the evaluation.
    """
    rows = F.lit(1.0) if weight is None else F.col(weight)
    if "probability_yes" not in scored.columns:
        scored = scored.withColumn("probability_yes", vector_to_array("probability")[1])
    hits = F.when(F.col("prediction") == F.col(LABEL), rows)
    counts = scored.agg(F.sum(rows).alias("n"), F.sum(hits).alias("correct")).first()
    tested = counts.n or 0.0
    auc = accuracy = 0.0
    if tested:
        accuracy = (counts.correct or 0.0) / tested
        auc = auc_by_score(scored, "probability_yes", LABEL, weight=weight).first().auc or 0.0
    values = [
        ("model_input_rows", float(input_rows)),
        ("test_rows", float(tested)),
        ("auc", float(auc)),
        ("accuracy", float(accuracy)),
    ]
    return scored.sparkSession.createDataFrame(values, "metric string, value double")


def auc_by_score(
    df: DataFrame, score: str, label: str, coded: bool = False, weight: str | None = None
) -> DataFrame:
    """Exact area under the ROC curve of a score, ties counted half.

    With ``weight`` each row stands for that many equal rows.

    The running sum is over distinct scores, in slices; that runs jobs. With
    ``coded``, for scores known to take few values, one task sums over them instead.
    """
    yes, no = F.col(label), 1 - F.col(label)
    if weight is not None:
        yes, no = yes * F.col(weight), no * F.col(weight)
    by_score = (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(score)
        .agg(F.sum(yes).alias("positive"), F.sum(no).alias("negative"))
    )
    if coded:
        earlier = Window.orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
        below = F.coalesce(F.sum("negative").over(earlier), F.lit(0))
        by_score = by_score.withColumn("below", below)
    else:
        by_score = running_total(by_score, [], [score], "negative", "below")
    return (
        by_score.withColumn(
            "won", F.col("positive") * (F.col("below") + F.col("negative") / 2)
        )
        .agg(
            F.sum("positive").cast("bigint").alias("positives"),
            F.sum("negative").cast("bigint").alias("negatives"),
            F.sum("won").alias("won"),
        )
        .select(
            "positives",
            "negatives",
            F.try_divide(
                "won", F.col("positives").cast("double") * F.col("negatives").cast("double")
            ).alias("auc"),
        )
    )


def threshold_accuracy(df: DataFrame, score: str, threshold: float, label: str) -> DataFrame:
    """Share of rows where ``score`` ≥ ``threshold`` agrees with the label; 0 without rows."""
    hit = (F.col(score) >= threshold).cast("int") == F.col(label)
    return (
        df.where(F.col(score).isNotNull())
        .agg(F.count(F.lit(1)).alias("test_rows"), F.count_if(hit).alias("correct"))
        .select(
            "test_rows",
            "correct",
            F.coalesce(F.try_divide("correct", "test_rows"), F.lit(0.0)).alias("accuracy"),
        )
    )

