"""Every registered query against its oracle on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the supplied tables")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, (bool, int)):
        return float(value)
    return float(value) if type(value).__name__ == "Decimal" else value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(plain(r[i]) for i in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, oracle, name):
    df = contract.queries()[name](spark, FOLDER)
    got = table(df.columns, df.collect())
    if name not in contract.oracle_sql():
        assert got
        return
    answer = oracle.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == table(columns, answer.fetchall())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 1
