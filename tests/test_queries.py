"""Every registered query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from tamiz.workload.ingest import INGEST_ORACLES, INGEST_QUERIES
from tamiz.workload.oracles import ORACLES
from tamiz.workload.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle(small_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{small_dir}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(INGEST_QUERIES) == set(INGEST_ORACLES)
    assert set(QUERIES) | set(INGEST_QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 3


@pytest.mark.parametrize("name", sorted(QUERIES | INGEST_QUERIES))
def test_query_equals_sql(spark, small_dir, oracle, name):
    got = contract.queries()[name](spark, small_dir)
    want = oracle.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert table(got.columns, got.collect()) == table(columns, want.fetchall())
