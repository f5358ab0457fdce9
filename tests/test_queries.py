"""Registered queries against their SQL counterpart on the smallest tables."""
import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import rows
from oppflow import catalog

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
# one of each kind; check.py runs all of them at the larger scale
SAMPLE = [
    "keywords_by_state", "b2_grants_gov", "b10_table_rows", "b18_nyscr_strategies", "c2_first_wins_in_batch", "d5_tag_records",
    "e4_key_terms", "e8_top_terms", "e14_top_phrases", "f4_top_recipients", "i7_fold_preferences", "k2_stream_daily_counts",
]


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        connection.execute(f"create view {file.split('.')[0]} as select * from '{FOLDER}/{file}'")
    return connection


@pytest.mark.parametrize("name", SAMPLE)
def test_equals_sql(spark, db, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = db.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, df.collect()) == rows(columns, cursor.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
