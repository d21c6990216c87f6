"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from tools.check_queries import TABLES, normal

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    cursor = duck.execute(SQL[name])
    assert got == normal([d[0] for d in cursor.description], cursor.fetchall())


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_survey_row_is_covered_by_a_query_with_sql():
    from lodestock.catalog import QUERIES as registered

    covered = {c for q in registered.values() if q.sql is not None for c in q.covers}
    assert {f"O-{i:02d}" for i in range(1, 122)} <= covered
