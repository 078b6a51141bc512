
from __future__ import annotations

import dataclasses
import sys
import warnings
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cohortlens.functions import LEADING_YEAR, PART_YEAR
from cohortlens.operators import blocks, clean, distribution, model, rates, shape
from cohortlens.plans import answers, roundtrips
from cohortlens.plans.cleaning import clean_survey
from cohortlens.plans.coded_lineitem import ROW_KEY, coded_lineitem, supporting_rule
from cohortlens.plans.modelling import (
    counted_combinations,
    score_test_rows,
    train_test_report,
)
from cohortlens.sources import staged, with_file_year
from cohortlens.spec import CARDIO

try:
    import corpus_pipeline
    from cohortlens.llm import registry as llm
except ImportError as gone:
    # The queries of the survey need neither the subpackage nor its libraries.
    if (gone.name or "").rpartition(".")[2] not in ("llm", "registry", "corpus_pipeline"):
        warnings.warn(f"queries over training text are left out: {gone}", stacklevel=1)
    corpus_pipeline = llm = None

Query = Callable[[SparkSession, str], DataFrame]
LANGUAGE = "ko"
CHUNK_SIZE = 1000
CHUNK_CAP = 2
CAPPED_SAMPLE = 1000


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_survey(coded_lineitem(spark, sf_dir), CARDIO, ROW_KEY)


def rate(spark: SparkSession, sf_dir: str) -> answers.Rate:
    return answers.rate_on(CARDIO, cleaned(spark, sf_dir))


def recode_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = [rule.source for rule in CARDIO.recodes]
    return (
        cleaned(spark, sf_dir)
        .groupBy(*codes, *CARDIO.flags)
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def score_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.rate_by(
        cleaned(spark, sf_dir), [CARDIO.score], CARDIO.target, drop_null_keys=False
    )


def view_rate_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned(spark, sf_dir).createOrReplaceTempView(CARDIO.view)
    return spark.sql(
        f"SELECT YEAR, count(*) AS respondents, sum(Has_Disease) AS cases "
        f"FROM {CARDIO.view} GROUP BY YEAR"
    )


def rates_from_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = [CARDIO.age, CARDIO.flags[0], CARDIO.score, CARDIO.year]
    grain = rates.rate_grain(cleaned(spark, sf_dir), keys, CARDIO.target)
    return answers.by_age_and_score(answers.rate_from(grain), CARDIO)


def quality_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    marks = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return rates.rate_by(
        marks.join(texts, "doc_id"), ["lang"], "quality", percent=True, rate="quality_rate"
    )


def quality_by_source_rolled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates over all documents, of which many have no label, from a finer grain."""
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "source")
    marks = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    grain = rates.rate_grain(texts.join(marks, "doc_id", "left"), ["lang", "source"], "quality")
    return rates.roll_up(grain, ["source"], rate="quality_rate")


def hash_sample(limit: int) -> Query:
    return lambda spark, sf_dir: answers.scaled_sample(
        cleaned(spark, sf_dir), CARDIO, ROW_KEY, limit, LANGUAGE
    )


def model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.model_frame(cleaned(spark, sf_dir), CARDIO, ROW_KEY)


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = model.mark_split(model_rows(spark, sf_dir), ROW_KEY)
    return marked.groupBy(model.TRAIN).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.col(model.LABEL).cast("int")).alias("positives"),
    )


def combination_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted_combinations(cleaned(spark, sf_dir), CARDIO, ROW_KEY)


def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = train_test_report(cleaned(spark, sf_dir), CARDIO, ROW_KEY, LANGUAGE, exact=True)
    return report.metrics.withColumn("value", F.round("value", 6))


def model_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = train_test_report(cleaned(spark, sf_dir), CARDIO, ROW_KEY, LANGUAGE, exact=True)
    return report.coefficients.withColumns(
        {c: F.round(c, 6) for c in ("coefficient", "odds_ratio")}
    )


def model_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score_test_rows(cleaned(spark, sf_dir), CARDIO, ROW_KEY, exact=True)
    return found.withColumn("probability_yes", F.round("probability_yes", 6))


def score_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model of the outcome on the score alone, fitted to the end, and its quality."""
    spec = dataclasses.replace(CARDIO, features=(CARDIO.score,))
    counted = staged(counted_combinations(cleaned(spark, sf_dir), spec, ROW_KEY))
    fitted = model.fit_logistic(
        counted.where(model.TRAIN), spec.features, max_iter=200, weight=model.WEIGHT, tol=1e-13
    )
    found = model.coefficients(fitted, spec.features, {CARDIO.score: "score"}, "label")
    test = model.score(fitted, counted.where(~F.col(model.TRAIN)))
    hits = F.when(F.col("prediction") == F.col(model.LABEL), F.col(model.WEIGHT)).otherwise(0)
    quality = test.agg(
        F.sum(model.WEIGHT).cast("long").alias("test_rows"), F.sum(hits).cast("long").alias("correct")
    ).first()
    return found.select(
        "feature",
        F.round("coefficient", 4).alias("coefficient"),
        F.round("odds_ratio", 4).alias("odds_ratio"),
        F.lit(quality["test_rows"]).cast("long").alias("test_rows"),
        F.lit(quality["correct"]).cast("long").alias("correct"),
    )


def orders_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.select(F.year("o_orderdate").alias("order_year"), "o_orderkey")


def chunk_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    slices = blocks.stage_in_order(
        orders_by_year(spark, sf_dir), ["order_year"], ["o_orderkey"]
    )
    return blocks.number_chunks(slices, CHUNK_SIZE, ["order_year"])


def chunk_cap_per_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    slices = blocks.stage_in_order(
        orders_by_year(spark, sf_dir), ["order_year"], ["o_orderkey"]
    )
    capped = blocks.number_chunks(slices, CHUNK_SIZE, ["order_year"], max_chunks=CHUNK_CAP)
    return capped.groupBy("order_year", blocks.CHUNK).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"),
    )


def keep_available_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    partial = coded_lineitem(spark, sf_dir).drop("TOLDHI2", *CARDIO.columns[9:])
    mixed = partial.select(*sorted(partial.columns, reverse=True))
    return shape.keep_available(mixed, CARDIO.columns)


def year_from_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    year = F.year("o_orderdate").cast("string")
    part = F.concat(F.lit("part_"), year, F.lit("_"), F.month("o_orderdate"), F.lit(".csv"))
    name = (
        F.when(F.col("o_orderkey") % 3 == 0, part)
        .when(F.col("o_orderkey") % 3 == 1, F.concat(year, F.lit(".csv")))
        .otherwise(F.lit("misc.csv"))
    )
    named = orders.select("o_orderkey", name.alias("file_name"))
    lenient = with_file_year(named, PART_YEAR, name_col="file_name", year="part_year")
    return with_file_year(lenient, LEADING_YEAR, name_col="file_name", year="leading_year")


def lenient_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    digit = F.col("l_linenumber").cast("string")
    case = (F.col("l_orderkey") + F.col("l_partkey")) % 6
    text = (
        F.when(case == 0, digit)
        .when(case == 1, F.concat(digit, F.lit(".0")))
        .when(case == 2, F.concat(digit, F.lit(".7")))
        .when(case == 3, F.lit(""))
        .when(case == 4, F.lit("abc"))
    )
    raw = lines.select(
        *ROW_KEY,
        text.alias("answer"),
        text.alias(CARDIO.outcome),
        text.alias(CARDIO.scaled_source),
    )
    return shape.lenient_cast(raw, CARDIO)


def align_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = coded_lineitem(spark, sf_dir)
    early = coded.where(F.col("YEAR") <= 1997).drop("TOLDHI2", "MEDCOST")
    late = coded.where(F.col("YEAR") > 1997).drop("SMOKE100", "_INCOMG")
    late = late.select(*reversed(late.columns))
    return shape.align_union([early, late], CARDIO, ROW_KEY)


def entry(spark: SparkSession) -> DataFrame:
    """Outcome rate by age band and risk score over the smallest tables."""
    return answers.by_age_and_score(rate(spark, "/root/testdata/sf0.001"), CARDIO)


def queries() -> dict[str, Query]:
    """Every registered query: name → (spark, table folder) → DataFrame."""
    added = {} if llm is None else llm.queries() | {
        "pipeline": llm.importable(corpus_pipeline.run)
    }
    return PLAIN | added


PLAIN: dict[str, Query] = {
    "survey_clean": cleaned,
    "recode_counts": recode_counts,
    "score_distribution": score_distribution,
    "year_counts": lambda s, d: clean.quality_report(cleaned(s, d), CARDIO.year),
    "rate_by_age": lambda s, d: answers.by_age(rate(s, d), CARDIO),
    "rate_by_bp": lambda s, d: answers.by_pressure(rate(s, d), CARDIO, LANGUAGE),
    "rate_by_score": lambda s, d: answers.by_score(rate(s, d), CARDIO),
    "rate_by_year": lambda s, d: answers.by_year(rate(s, d), CARDIO),
    "rate_age_by_score": lambda s, d: answers.by_age_and_score(rate(s, d), CARDIO),
    "rates_from_one_pass": rates_from_one_pass,
    "view_rate_by_year": view_rate_by_year,
    "quality_by_language": quality_by_language,
    "quality_by_source_rolled": quality_by_source_rolled,
    "labelled_age_rates": lambda s, d: answers.by_age_labelled(rate(s, d), CARDIO, LANGUAGE),
    "rate_matrix": lambda s, d: answers.age_score_matrix(rate(s, d), CARDIO, LANGUAGE),
    "bmi_box_stats": lambda s, d: answers.scaled_box(
        cleaned(s, d), CARDIO, LANGUAGE, CARDIO.scaled_coded
    ),
    "bmi_box_stats_ranked": lambda s, d: answers.scaled_box(cleaned(s, d), CARDIO, LANGUAGE),
    "hash_sample": hash_sample(100_000),
    "hash_sample_capped": hash_sample(CAPPED_SAMPLE),
    "preview_top5": lambda s, d: clean.preview(cleaned(s, d), [CARDIO.year, *ROW_KEY]),
    "model_frame": model_rows,
    "split_counts": split_counts,
    "combination_counts": combination_counts,
    "auc_by_score": lambda s, d: model.auc_by_score(
        cleaned(s, d), CARDIO.score, CARDIO.target, coded=True
    ),
    "auc_by_score_ranked": lambda s, d: model.auc_by_score(
        cleaned(s, d), CARDIO.scaled, CARDIO.target
    ),
    "threshold_accuracy": lambda s, d: model.threshold_accuracy(
        cleaned(s, d), CARDIO.score, 2, CARDIO.target
    ),
    "model_metrics": model_metrics,
    "model_coefficients": model_coefficients,
    "model_predictions": model_predictions,
    "score_model": score_model,
    "chunk_numbering": chunk_numbering,
    "chunk_cap_per_year": chunk_cap_per_year,
    "keep_available_columns": keep_available_columns,
    "year_from_name": year_from_name,
    "lenient_cast": lenient_cast,
    "align_union": align_union,
    "landed_parquet": lambda s, d: roundtrips.landed(s, d, "parquet"),
    "landed_csv": lambda s, d: roundtrips.landed(s, d, "csv"),
    "stored_parquet": lambda s, d: roundtrips.stored(s, d, "parquet"),
    "stored_csv": lambda s, d: roundtrips.stored(s, d, "csv"),
    "part_files": roundtrips.part_files,
    "collected_and_cleaned": roundtrips.collected_and_cleaned,
    "analysed": roundtrips.analysed,
    "saved_query": roundtrips.saved_query,
    "written_year_counts": roundtrips.written_year_counts,
    "relanded_blocks": roundtrips.relanded,
}


# The coded survey and its cleaned form, as SQL over lineitem.
_SUPPORTING = ", ".join(
    f'{supporting_rule(i)} AS "{c}"' for i, c in enumerate(CARDIO.columns[9:])
)
_CODED = f"""
coded AS (
  SELECT
    CAST(year(l_shipdate) AS INTEGER) AS "YEAR",
    CASE
      WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 7
      WHEN l_suppkey % 25 = 0 THEN NULL
      WHEN CAST(round(l_discount * 100) AS INTEGER)
        + CASE WHEN l_linenumber IN (1, 6) THEN 3 ELSE 0 END
        + CASE WHEN l_orderkey % 14 >= 8 THEN 2 ELSE 0 END >= 11 THEN 1
      ELSE 2
    END AS "CVDINFR4",
    CASE l_linenumber WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 3 WHEN 4 THEN 4
      WHEN 5 THEN 3 WHEN 6 THEN 1 ELSE 7 END AS "BPHIGH4",
    CASE WHEN l_suppkey % 10 <= 3 THEN 1 WHEN l_suppkey % 10 <= 7 THEN 2
      WHEN l_suppkey % 10 = 8 THEN 7 END AS "TOLDHI2",
    CASE l_partkey % 8 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 6 THEN 4 WHEN 7 THEN 9
      ELSE 3 END AS "DIABETE3",
    CASE WHEN l_quantity <= 20 THEN 1 WHEN l_quantity <= 45 THEN 2 ELSE 9 END AS "SMOKE100",
    CASE WHEN l_orderkey % 50 = 0 THEN 9
      ELSE CAST(l_orderkey % 2 + 1 AS INTEGER) END AS "SEX",
    CAST(l_orderkey % 14 + 1 AS INTEGER) AS "_AGEG5YR",
    CASE WHEN round(l_tax * 100) = 8 THEN NULL
      ELSE CAST(CAST(floor(l_extendedprice / 12) AS INTEGER) AS REAL) END AS "_BMI5",
    {_SUPPORTING},
    l_orderkey, l_linenumber
  FROM lineitem
)"""
_FLAGS = ",\n    ".join(
    f'CASE "{r.source}" WHEN {r.yes} THEN 1 WHEN {r.no} THEN 0 END AS "{r.output}"'
    for r in CARDIO.recodes
)
_SURVEY = ", ".join(f'"{c}"' for c in CARDIO.columns)
_CLEANED = f"""{_CODED},
flagged AS (
  SELECT {_SURVEY},
    CASE WHEN "CVDINFR4" = 1 THEN 1 ELSE 0 END AS "Has_Disease",
    CAST("_BMI5" AS DOUBLE) / 100 AS "BMI_Real",
    {_FLAGS},
    l_orderkey, l_linenumber
  FROM coded WHERE "CVDINFR4" IN (1, 2)
),
cleaned AS (
  SELECT {_SURVEY}, "Has_Disease", "BMI_Real", {", ".join(CARDIO.flags)},
    {" + ".join(CARDIO.flags)} AS "Risk_Score", l_orderkey, l_linenumber
  FROM flagged
)"""
_RATE = "count(*) AS respondent_count, avg(Has_Disease) AS disease_rate"
_KNOWN_AGE = "_AGEG5YR BETWEEN 1 AND 13"
_HASH = "CAST('0x' || substr(md5(l_orderkey || ':' || l_linenumber), 1, 8) AS BIGINT)"
_SAMPLE_HASH = _HASH.replace("md5(", f"md5('{answers.SAMPLE_SALT}:' || ")
_COMPLETE = " AND ".join(f'"{f}" IS NOT NULL' for f in CARDIO.features)
_MODEL = f"""{_CLEANED},
model AS (
  SELECT CAST(Has_Disease AS DOUBLE) AS label,
    {", ".join(f'CAST("{f}" AS DOUBLE) AS "{f}"' for f in CARDIO.features)},
    l_orderkey, l_linenumber, {_HASH} % 1000 < 800 AS is_train
  FROM cleaned
  WHERE {_COMPLETE} AND {_KNOWN_AGE} AND BMI_Real BETWEEN 10 AND 80 AND SEX IN (1, 2)
)"""


def _newton(rounds: int = 25, penalty: float = 0.01) -> str:
    """A logistic fit on the standardised score by Newton steps, one after another."""
    steps = []
    for i in range(1, rounds + 1):
        steps.append(
            f"""g{i} AS MATERIALIZED (
  SELECT b0, b1, sum(n * (p - label)) / sum(n) AS d0,
    sum(n * (p - label) * x) / sum(n) + {penalty} * b1 AS d1,
    sum(n * p * (1 - p)) / sum(n) AS h00, sum(n * p * (1 - p) * x) / sum(n) AS h01,
    sum(n * p * (1 - p) * x * x) / sum(n) + {penalty} AS h11
  FROM (SELECT *, 1 / (1 + exp(-(b0 + b1 * x))) AS p FROM grouped, fit{i - 1})
  GROUP BY b0, b1
),
fit{i} AS MATERIALIZED (
  SELECT b0 - (h11 * d0 - h01 * d1) / (h00 * h11 - h01 * h01) AS b0,
    b1 - (h00 * d1 - h01 * d0) / (h00 * h11 - h01 * h01) AS b1
  FROM g{i}
)"""
        )
    return ",\n".join(steps)


_SCORE_MODEL = f"""{_CLEANED},
known AS (
  SELECT CAST(Has_Disease AS DOUBLE) AS label, CAST(Risk_Score AS DOUBLE) AS score,
    {_HASH} % 1000 < 800 AS is_train
  FROM cleaned
  WHERE Risk_Score IS NOT NULL AND {_KNOWN_AGE} AND BMI_Real BETWEEN 10 AND 80 AND SEX IN (1, 2)
),
scale AS (SELECT stddev_samp(score) AS s FROM known WHERE is_train),
grouped AS MATERIALIZED (
  SELECT label, score / s AS x, CAST(count(*) AS DOUBLE) AS n
  FROM known, scale WHERE is_train GROUP BY label, score, s
),
fit0 AS MATERIALIZED (SELECT 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1),
{_newton()},
final AS (SELECT b0, b1 / s AS b1 FROM fit25, scale)
SELECT 'Risk_Score' AS feature, round(any_value(b1), 4) AS coefficient,
  round(exp(any_value(b1)), 4) AS odds_ratio, count(*) AS test_rows,
  count(*) FILTER (WHERE CAST(b0 + b1 * score > 0 AS INTEGER) = label) AS correct
FROM known, final WHERE NOT is_train"""


def _fit_sql(rounds: int = 15, penalty: float = 0.01) -> str:
    """A logistic fit on all features by Newton steps, each solved by elimination."""
    names = list(CARDIO.features)
    size = len(names) + 1
    x = ["1.0", *[f"x{i}" for i in range(1, size)]]
    margin = " + ".join(f"b[{i + 1}] * {x[i]}" for i in range(size))
    rows = []
    for i in range(size):
        cells = [
            f"sum(n * p * (1 - p) * {x[i]} * {x[j]}) / sum(n)" + (f" + {penalty}" if i == j > 0 else "")
            for j in range(size)
        ]
        slope = f"sum(n * (p - label) * {x[i]}) / sum(n)" + (f" + {penalty} * any_value(b)[{i + 1}]" if i else "")
        rows.append(f"[{', '.join([*cells, slope])}]")
    steps = []
    for r in range(1, rounds + 1):
        solved = f"step{r}"
        for k in range(1, size + 1):
            solved = f"""(SELECT b, list_transform(m, lambda row, i: CASE WHEN i = {k}
      THEN list_transform(row, lambda v: v / row[{k}])
      ELSE list_transform(row, lambda v, j: v - row[{k}] / m[{k}][{k}] * m[{k}][j]) END) AS m
    FROM {solved})"""
        steps.append(
            f"""step{r} AS MATERIALIZED (
  SELECT any_value(b) AS b, [{", ".join(rows)}] AS m
  FROM (SELECT *, 1 / (1 + exp(-({margin}))) AS p FROM grouped, fit{r - 1})
),
fit{r} AS MATERIALIZED (
  SELECT list_transform(b, lambda v, i: v - m[i][{size + 1}]) AS b FROM {solved}
)"""
        )
    scales = ", ".join(f'stddev_samp("{f}") AS s{i}' for i, f in enumerate(names, 1))
    scaled = ", ".join(f'"{f}" / s{i} AS x{i}' for i, f in enumerate(names, 1))
    plain = ", ".join(f"b[{i + 1}] / s{i}" for i in range(1, size))
    chance = " + ".join(f'c[{i}] * "{f}"' for i, f in enumerate(names, 1))
    return f"""{_MODEL},
scale AS (SELECT {scales} FROM model WHERE is_train),
grouped AS MATERIALIZED (
  SELECT label, {scaled}, CAST(count(*) AS DOUBLE) AS n
  FROM model, scale WHERE is_train GROUP BY ALL
),
fit0 AS MATERIALIZED (SELECT list_transform(range({size}), lambda i: 0.0::DOUBLE) AS b),
{",".join(steps)},
final AS MATERIALIZED (SELECT b[1] AS b0, [{plain}] AS c FROM fit{rounds}, scale),
tested AS (
  SELECT l_orderkey, l_linenumber, label, b0 + {chance} AS margin
  FROM model, final WHERE NOT is_train
)"""


def _labelled(column: str, labels) -> str:
    cases = " ".join(f"WHEN {code} THEN '{text}'" for code, text in labels.items())
    return f"CASE {column} {cases} END"


def _sample_sql(limit: int, outcome: str) -> str:
    return f"""WITH {_CLEANED}
SELECT Has_Disease, BMI_Real, {outcome} AS disease_label
FROM (
  SELECT Has_Disease, BMI_Real, {_SAMPLE_HASH} AS h FROM cleaned
  WHERE BMI_Real > 10 AND BMI_Real < 80
)
WHERE h % 1000 < 100 ORDER BY h, Has_Disease, BMI_Real LIMIT {limit}"""


def _auc_sql(score: str) -> str:
    return f"""WITH {_CLEANED},
graded AS (
  SELECT {score} AS score, sum(Has_Disease) AS pos, sum(1 - Has_Disease) AS neg
  FROM cleaned WHERE {score} IS NOT NULL GROUP BY {score}
),
won AS (
  SELECT pos, neg,
    CAST(pos AS DOUBLE) * (sum(neg) OVER (ORDER BY score) - CAST(neg AS DOUBLE) / 2) AS w
  FROM graded
)
SELECT CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives,
  sum(w) / (CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc
FROM won"""


def oracle_sql() -> dict[str, str]:
    """SQL whose result equals that of the query of the same name."""
    labels = CARDIO.labels[LANGUAGE]
    age = _labelled("_AGEG5YR", labels.age)
    outcome = _labelled("Has_Disease", labels.outcome)
    recoded = ", ".join([r.source for r in CARDIO.recodes] + list(CARDIO.flags))
    cells = ", ".join(
        f"avg(Has_Disease) FILTER (WHERE Risk_Score = {v}) * 100 AS score_{v}"
        for v in CARDIO.score_values
    )
    early_gone, late_gone = {"TOLDHI2", "MEDCOST"}, {"SMOKE100", "_INCOMG"}
    early = ", ".join(f'NULL AS "{c}"' if c in early_gone else f'"{c}"' for c in CARDIO.columns)
    late = ", ".join(f'NULL AS "{c}"' if c in late_gone else f'"{c}"' for c in CARDIO.columns)
    kept = ", ".join(f'"{c}"' for c in CARDIO.columns[:9] if c != "TOLDHI2")
    first_five = ", ".join(
        f'"{c}" NULLS FIRST' for c in ("YEAR", *ROW_KEY, *CARDIO.columns[1:], *CARDIO.derived)
    )
    age_by_score = f"""WITH {_CLEANED}
SELECT _AGEG5YR AS age_group, Risk_Score AS risk_score, {_RATE} FROM cleaned
WHERE {_KNOWN_AGE} AND Risk_Score IS NOT NULL GROUP BY _AGEG5YR, Risk_Score"""
    box = f"""WITH {_CLEANED},
inside AS (SELECT Has_Disease, BMI_Real FROM cleaned WHERE BMI_Real > 10 AND BMI_Real < 80),
box AS (
  SELECT Has_Disease, count(*) AS n_values, quantile_cont(BMI_Real, 0.25) AS q1,
    quantile_cont(BMI_Real, 0.5) AS median, quantile_cont(BMI_Real, 0.75) AS q3
  FROM inside GROUP BY Has_Disease
)
SELECT Has_Disease, n_values, least(q1, min(BMI_Real)) AS whisker_low, q1, median, q3,
  greatest(q3, max(BMI_Real)) AS whisker_high, {outcome} AS disease_label
FROM box JOIN inside USING (Has_Disease)
WHERE BMI_Real BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)
GROUP BY Has_Disease, n_values, q1, median, q3"""
    numbered = f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, o_orderkey,
  (row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderkey) - 1)
    // {CHUNK_SIZE} + 1 AS chunk_no
FROM orders"""
    texts = ", ".join(f"""CAST(CAST("{c}" AS INTEGER) AS VARCHAR) || '.0' AS "{c}\"""" for c in CARDIO.columns[1:])
    drifted = ", ".join(
        f"""CASE WHEN "YEAR" % 2 = 0 THEN "{c}" END AS "{c}\"""" for c in roundtrips.LATE_COLUMNS
    )
    from_files = _CLEANED.replace(
        "flagged AS (", f"early AS (SELECT * REPLACE ({drifted}) FROM coded),\nflagged AS ("
    ).replace("FROM coded WHERE", "FROM early WHERE")
    no_key = "* EXCLUDE (l_orderkey, l_linenumber)"
    added = {} if llm is None else llm.oracle_sql()
    return added | {
        "survey_clean": f"WITH {_CLEANED} SELECT * FROM cleaned",
        "recode_counts": f"""WITH {_CLEANED}
SELECT {recoded}, count(*) AS row_count FROM cleaned GROUP BY {recoded}""",
        "score_distribution": f"""WITH {_CLEANED}
SELECT Risk_Score, {_RATE} FROM cleaned GROUP BY Risk_Score""",
        "year_counts": f"""WITH {_CLEANED}
SELECT "YEAR", count(*) AS row_count FROM cleaned GROUP BY "YEAR" """,
        "written_year_counts": f"""WITH {_CLEANED}
SELECT "YEAR", count(*) AS row_count FROM cleaned GROUP BY "YEAR" """,
        "relanded_blocks": f"""WITH {_CODED}
SELECT "YEAR", CAST(CASE WHEN "YEAR" % 2 = 0 THEN 2 ELSE 1 END AS BIGINT) AS chunk_no,
  count(*) AS row_count
FROM coded GROUP BY "YEAR" """,
        "rate_by_age": f"""WITH {_CLEANED}
SELECT _AGEG5YR AS age_group, {_RATE} FROM cleaned WHERE {_KNOWN_AGE} GROUP BY _AGEG5YR""",
        "rate_by_bp": f"""WITH {_CLEANED}
SELECT {_labelled("BP_Risk", labels.flag)} AS blood_pressure_group, {_RATE}
FROM cleaned WHERE BP_Risk IS NOT NULL GROUP BY BP_Risk""",
        "rate_by_score": f"""WITH {_CLEANED}
SELECT Risk_Score AS risk_score, {_RATE} FROM cleaned
WHERE Risk_Score IS NOT NULL GROUP BY Risk_Score""",
        "rate_by_year": f"""WITH {_CLEANED}
SELECT "YEAR" AS year, {_RATE} FROM cleaned WHERE "YEAR" IS NOT NULL GROUP BY "YEAR" """,
        "rate_age_by_score": age_by_score,
        "rates_from_one_pass": age_by_score,
        "view_rate_by_year": f"""WITH {_CLEANED}
SELECT "YEAR", count(*) AS respondents, CAST(sum(Has_Disease) AS BIGINT) AS cases
FROM cleaned GROUP BY "YEAR" """,
        "quality_by_language": """SELECT lang, count(*) AS respondent_count,
  avg(quality) AS quality_rate, avg(quality) * 100 AS rate_percent
FROM labels JOIN documents USING (doc_id) WHERE lang IS NOT NULL GROUP BY lang""",
        "quality_by_source_rolled": """SELECT source, count(*) AS respondent_count,
  avg(quality) AS quality_rate
FROM documents LEFT JOIN labels USING (doc_id) WHERE source IS NOT NULL GROUP BY source""",
        "labelled_age_rates": f"""WITH {_CLEANED}
SELECT _AGEG5YR AS age_group, {_RATE}, avg(Has_Disease) * 100 AS rate_percent,
  {age} AS age_label
FROM cleaned WHERE {_KNOWN_AGE} GROUP BY _AGEG5YR""",
        "rate_matrix": f"""WITH {_CLEANED}
SELECT _AGEG5YR AS age_group, {cells}, {age} AS age_label
FROM cleaned WHERE {_KNOWN_AGE} AND Risk_Score IS NOT NULL GROUP BY _AGEG5YR""",
        "bmi_box_stats": box,
        "bmi_box_stats_ranked": box,
        "hash_sample": _sample_sql(100_000, outcome),
        "hash_sample_capped": _sample_sql(CAPPED_SAMPLE, outcome),
        "preview_top5": f"WITH {_CLEANED} SELECT * FROM cleaned ORDER BY {first_five} LIMIT 5",
        "model_frame": f"WITH {_MODEL} SELECT * EXCLUDE (is_train) FROM model",
        "split_counts": f"""WITH {_MODEL}
SELECT is_train, count(*) AS row_count, CAST(sum(label) AS BIGINT) AS positives
FROM model GROUP BY is_train""",
        "combination_counts": f"""WITH {_MODEL}
SELECT * EXCLUDE (l_orderkey, l_linenumber), CAST(count(*) AS DOUBLE) AS weight
FROM model GROUP BY ALL""",
        "auc_by_score": _auc_sql("Risk_Score"),
        "auc_by_score_ranked": _auc_sql("BMI_Real"),
        "threshold_accuracy": f"""WITH {_CLEANED},
judged AS (
  SELECT count(*) AS test_rows,
    count(*) FILTER (WHERE CAST(Risk_Score >= 2 AS INTEGER) = Has_Disease) AS correct
  FROM cleaned WHERE Risk_Score IS NOT NULL
)
SELECT test_rows, correct,
  CASE WHEN test_rows = 0 THEN 0.0::DOUBLE
    ELSE CAST(correct AS DOUBLE) / test_rows END AS accuracy
FROM judged""",
        "score_model": f"WITH {_SCORE_MODEL}",
        "model_coefficients": f"""WITH {_fit_sql()}
SELECT unnest([{", ".join(f"'{f}'" for f in CARDIO.features)}]) AS feature,
  unnest([{", ".join(f"'{labels.features[f]}'" for f in CARDIO.features)}]) AS "{labels.feature_column}",
  unnest(list_transform(c, lambda v: round(v, 6))) AS coefficient,
  unnest(list_transform(c, lambda v: round(exp(v), 6))) AS odds_ratio
FROM final""",
        "model_predictions": f"""WITH {_fit_sql()}
SELECT l_orderkey, l_linenumber, label, CAST(margin > 0 AS DOUBLE) AS prediction,
  round(1 / (1 + exp(-margin)), 6) AS probability_yes
FROM tested""",
        "model_metrics": f"""WITH {_fit_sql()},
graded AS (
  SELECT 1 / (1 + exp(-margin)) AS p, sum(label) AS pos, sum(1 - label) AS neg
  FROM tested GROUP BY p
),
won AS (SELECT pos, neg, pos * (sum(neg) OVER (ORDER BY p) - neg / 2) AS w FROM graded)
SELECT 'model_input_rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM model
UNION ALL SELECT 'test_rows', CAST(count(*) AS DOUBLE) FROM tested
UNION ALL SELECT 'auc', round(sum(w) / (sum(pos) * sum(neg)), 6) FROM won
UNION ALL SELECT 'accuracy',
  round(CAST(count(*) FILTER (WHERE CAST(margin > 0 AS DOUBLE) = label) AS DOUBLE) / count(*), 6) FROM tested""",
        "chunk_numbering": numbered,
        "chunk_cap_per_year": f"""SELECT order_year, chunk_no, count(*) AS row_count,
  min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
FROM ({numbered}) WHERE chunk_no <= {CHUNK_CAP} GROUP BY order_year, chunk_no""",
        "keep_available_columns": f"WITH {_CODED} SELECT {kept} FROM coded",
        "year_from_name": """WITH named AS (
  SELECT o_orderkey, CASE o_orderkey % 3
      WHEN 0 THEN 'part_' || year(o_orderdate) || '_' || month(o_orderdate) || '.csv'
      WHEN 1 THEN year(o_orderdate) || '.csv'
      ELSE 'misc.csv' END AS file_name
  FROM orders
)
SELECT o_orderkey, file_name,
  TRY_CAST(nullif(regexp_extract(file_name, 'part_(\\d{4})_', 1), '') AS INTEGER) AS part_year,
  TRY_CAST(nullif(regexp_extract(file_name, '^(\\d{4})', 1), '') AS INTEGER) AS leading_year
FROM named""",
        "lenient_cast": """WITH answers AS (
  SELECT l_orderkey, l_linenumber, CASE (l_orderkey + l_partkey) % 6
      WHEN 0 THEN CAST(l_linenumber AS VARCHAR)
      WHEN 1 THEN l_linenumber || '.0'
      WHEN 2 THEN l_linenumber || '.7'
      WHEN 3 THEN ''
      WHEN 4 THEN 'abc' END AS answer
  FROM lineitem
)
SELECT l_orderkey, l_linenumber, answer,
  CAST(trunc(TRY_CAST(answer AS DOUBLE)) AS INTEGER) AS "CVDINFR4",
  TRY_CAST(answer AS REAL) AS "_BMI5"
FROM answers""",
        "landed_parquet": f'WITH {_CODED} SELECT "YEAR", {texts} FROM coded',
        "landed_csv": f'WITH {_CODED} SELECT "YEAR", {texts} FROM coded',
        "stored_parquet": f"WITH {_CLEANED} SELECT {no_key} FROM cleaned",
        "stored_csv": f"WITH {_CLEANED} SELECT {no_key} FROM cleaned",
        "part_files": f"""WITH {_CODED}
SELECT * REPLACE ({drifted}) FROM (SELECT "YEAR", {texts} FROM coded)""",
        "collected_and_cleaned": f"WITH {from_files} SELECT {no_key} FROM cleaned",
        "analysed": f"""WITH {from_files}
SELECT _AGEG5YR AS age_group, Risk_Score AS risk_score, {_RATE} FROM cleaned
WHERE {_KNOWN_AGE} AND Risk_Score IS NOT NULL GROUP BY _AGEG5YR, Risk_Score""",
        "saved_query": f"""WITH {_CLEANED}
SELECT "YEAR", count(*) AS n, CAST(sum(Has_Disease) AS BIGINT) AS cases
FROM cleaned GROUP BY "YEAR" """,
        "align_union": f"""WITH {_CODED}
SELECT {early}, l_orderkey, l_linenumber FROM coded WHERE "YEAR" <= 1997
UNION ALL BY NAME
SELECT {late}, l_orderkey, l_linenumber FROM coded WHERE "YEAR" > 1997""",
    }
