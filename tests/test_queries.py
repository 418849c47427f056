"""Every core query against its SQL on the smallest tables."""

import os
from collections import Counter

import pytest

from lexmill.plans import round_trips  # noqa: F401  registers its queries
from lexmill.plans.queries import QUERIES, SQL

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def rows(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    value = lambda v: round(v, 6) if isinstance(v, float) else v
    return Counter(tuple(value(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def tables():
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, tables, name):
    made = QUERIES[name](spark, DATA)
    want = tables.sql(SQL[name])
    assert sorted(made.columns) == sorted(want.columns)
    assert rows([tuple(r) for r in made.collect()], made.columns) == rows(want.fetchall(), want.columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_dictionary_has_the_public_hash(spark):
    from lexmill.functions.hashes import term_hash
    from lexmill.operators import index
    from lexmill.plans.queries import _terms

    assert all(r["hash"] == term_hash(r["term"]) for r in index.build(_terms(spark, DATA), "doc_id").dictionary.limit(200).collect())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 20
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
