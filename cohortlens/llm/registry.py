"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import (
    anchors,
    decontaminate,
    jaccard,
    langid,
    lengths,
    packing,
    quality,
    runs,
    secrets,
    sql,
    suffixes,
    turns,
    urls,
    votes,
)

_ROOT = str(Path(__file__).resolve().parents[2])
WINDOW = 20
NGRAMS = jaccard.Join(size=4, percent=85)
Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.scored(docs, quality.learned(docs, labels))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_documents(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return votes.judged(_documents(spark, sf_dir)).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.deduplicated(_documents(spark, sf_dir)).drop("cuts")
    return found.withColumn("n_kept", F.col("n_bytes") - F.col("n_removed"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contaminated(_documents(spark, sf_dir), items)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.limits(lengths.histogram(_documents(spark, sf_dir)))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(_documents(spark, sf_dir), NGRAMS)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scanned(_documents(spark, sf_dir)).drop("redacted")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return langid.identified(docs, langid.learned(docs))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return turns.report(table, turns.Damage())


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digested(runs.collapsed(_documents(spark, sf_dir), damage=runs.Damage()))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = anchors.deduplicated(_documents(spark, sf_dir), window=WINDOW)
    kept = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    left = (F.col("n_words") - F.col("n_removed")).alias("n_kept")
    return found.select("doc_id", "n_words", "n_removed", kept, left)


def importable(query: Query) -> Query:
    """``query`` with this package on the path of the Python workers, as on the driver's."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        workers = spark.sparkContext.environment
        paths = [p for p in workers.get("PYTHONPATH", "").split(os.pathsep) if p]
        if _ROOT not in paths:
            workers["PYTHONPATH"] = os.pathsep.join([*paths, _ROOT])
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    """Every operator over its whole table, by name."""
    found = {
        "op1_quality_gam": op1_quality_gam,
        "op2_packing": op2_packing,
        "op3_quality_rules": op3_quality_rules,
        "op4_suffix_dedup": op4_suffix_dedup,
        "op5_decontaminate": op5_decontaminate,
        "op6_token_counts": op6_token_counts,
        "op7_ngram_join": op7_ngram_join,
        "op8_secrets": op8_secrets,
        "op9_language": op9_language,
        "op10_url_filter": op10_url_filter,
        "op11_conversation_repair": op11_conversation_repair,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_substring_dedup": op13_substring_dedup,
    }
    return {name: importable(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    """Token ids, trained models and searches are beyond SQL; tests hold them to brute force."""
    return {
        "op3_quality_rules": sql.quality_rules(),
        "op7_ngram_join": sql.ngram_join(NGRAMS.size, NGRAMS.percent),
        "op11_conversation_repair": sql.conversation_repair(),
        "op12_periodic_runs": sql.periodic_runs(runs.LEAST_LENGTH, runs.Damage().one_in),
        "op13_substring_dedup": sql.substring_dedup(WINDOW),
    }
