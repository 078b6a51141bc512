"""A coded survey computed by rule from the ``lineitem`` table.

It has the columns and code domains of a raw extract, so every operator can run
on the given tables at any scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlens.spec import CARDIO


def supporting_rule(i: int) -> str:
    """Codes of the ``i``-th column after those with a rule of their own, in any SQL."""
    codes = f"CAST((l_orderkey * {i + 1} + l_linenumber) % {i + 5} + 1 AS INTEGER)"
    return f"CASE WHEN l_suppkey % {i + 7} = 0 THEN NULL ELSE {codes} END"


ROW_KEY = ("l_orderkey", "l_linenumber")

RULES = {
    "YEAR": "year(l_shipdate)",
    "CVDINFR4": """CASE
        WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 7
        WHEN l_suppkey % 25 = 0 THEN NULL
        WHEN int(rint(l_discount * 100)) + if(l_linenumber IN (1, 6), 3, 0)
            + if(l_orderkey % 14 >= 8, 2, 0) >= 11 THEN 1
        ELSE 2 END""",
    "BPHIGH4": "coalesce(get(array(1, 2, 3, 4, 3, 1), l_linenumber - 1), 7)",
    "TOLDHI2": "get(array(1, 1, 1, 1, 2, 2, 2, 2, 7, NULL), int(l_suppkey % 10))",
    "DIABETE3": "get(array(1, 2, 3, 3, 3, 3, 4, 9), int(l_partkey % 8))",
    "SMOKE100": "CASE WHEN l_quantity <= 20 THEN 1 WHEN l_quantity <= 45 THEN 2 ELSE 9 END",
    "SEX": "if(l_orderkey % 50 = 0, 9, int(l_orderkey % 2 + 1))",
    "_AGEG5YR": "int(l_orderkey % 14 + 1)",
    "_BMI5": "if(rint(l_tax * 100) = 8, NULL, float(int(floor(l_extendedprice / 12))))",
    **{c: supporting_rule(i) for i, c in enumerate(CARDIO.columns[9:])},
}


def coded_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw survey columns plus the row key."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return lines.selectExpr(*[f"{RULES[c]} AS {c}" for c in CARDIO.columns], *ROW_KEY)
