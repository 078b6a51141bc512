"""Every registered query against its SQL equivalent in DuckDB, on whole tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

TABLES = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES, ORACLE = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{TABLES}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    yield connection
    connection.close()


def rows(records):
    def plain(value):
        if isinstance(value, bool) or value is None or isinstance(value, str):
            return (value is not None, str(value))
        number = float(value)
        return (True, "nan" if math.isnan(number) else f"{number:.10g}")

    return sorted(tuple(plain(v) for v in record) for record in records)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(contract.PLAIN) == set(contract.PLAIN.keys() & ORACLE)


@pytest.mark.parametrize("name", sorted(contract.PLAIN.keys() & ORACLE))
def test_query_equals_oracle(spark, duck, name):
    found = QUERIES[name](spark, TABLES)
    expected = duck.execute(ORACLE[name])
    columns = [c[0] for c in expected.description]
    assert sorted(found.columns) == sorted(columns)
    ours = [tuple(r) for r in found.select(*[f"`{c}`" for c in columns]).collect()]
    theirs = expected.fetchall()
    assert len(ours) == len(theirs) > 0
    assert rows(ours) == rows(theirs)


def test_entry(spark):
    assert contract.entry(spark).count() == 64
