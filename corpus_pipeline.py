"""A corpus from documents to packed sequences, in stages of the llm operators.

Each stage takes the columns of ``documents`` and, but for the last, returns them.
Empty tables pass through; rows with a null key are judged like others, but are in no
group of near duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import decontaminate, jaccard, packing, secrets, votes
from cohortlens.sources.staging import staged, unstage

BROADCAST_KEYS = 1_000_000  # keys sent to every task; beyond, documents are shuffled
NEAR = jaccard.Join(size=5, percent=80)


def _listed(keys: DataFrame) -> DataFrame:
    few = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    return F.broadcast(keys) if few else keys


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules keep.

    A verdict depends on a text alone, so texts are counted once, and the rejected
    ones are known by their fingerprints.
    """
    mark = F.xxhash64(F.coalesce("text", F.lit("")))
    judged = votes.judged(docs.select(mark.alias("mark"), "text"), carry="mark")
    rejected = staged(judged.where("NOT kept").select("mark").distinct())
    return docs.join(_listed(rejected), mark == rejected["mark"], "left_anti")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents one, that with the least key.

    Rows are judged one by one, by a fingerprint of key and text: differing texts of one
    key are different documents, and of rows that agree in key and text the least by
    their other columns stays.
    """
    node = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text"))
    rows = docs.withColumn("node", node)
    found = staged(jaccard.similar(rows, NEAR, key="node").select(F.col("doc_id").alias("node"), "component_id"))
    keyed = rows.select("node", F.struct("doc_id", "node").alias("key"))
    again = found.where("node IS NOT NULL").groupBy("node").count().where("count > 1").select("node")
    crowded = found.where("node <> component_id").select("component_id").distinct()
    members = found.distinct().join(crowded, "component_id", "left_semi")
    members = keyed.join(_listed(members), "node")
    least = members.groupBy("component_id").agg(F.min("key").alias("stays"))
    others = members.join(least, "component_id").where("key <> stays").select("node").distinct()
    kept = rows.join(_listed(staged(others)), "node", "left_anti")
    if again.isEmpty():
        return kept.select(*docs.columns)
    again = _listed(again)
    row = F.struct(*docs.columns)
    once = kept.join(again, "node", "left_semi").groupBy("node").agg(F.min(row).alias("row"))
    single = kept.join(again, "node", "left_anti").select(*docs.columns)
    return single.unionByName(once.select("row.*"))


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.uncontaminated(docs, items)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their texts put out."""
    rows = docs.select("doc_id", "text", F.struct(*docs.columns).alias("row"))
    scanned = secrets.scanned(rows, carry="row").withColumn("same", F.col("redacted").isNull())
    changed = {
        "text": F.col("redacted"),
        "n_chars": F.length("redacted").cast(docs.schema["n_chars"].dataType),
    }
    return scanned.select(
        *[
            F.when(F.col("same"), F.col(f"row.{c}")).otherwise(changed[c]).alias(c)
            if c in changed
            else F.col(f"row.{c}")
            for c in docs.columns
        ]
    )


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of ids."""
    return packing.packed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_free", benchmark_free),
    ("without_secrets", without_secrets),
    ("packed", packed),
]

#: Token ids and expectation-maximisation are beyond SQL; tests hold stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
        if before is not None:
            unstage(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
