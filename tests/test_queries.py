"""Every registered query against its SQL on the smallest test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as registry

from vendorlens.plans.oracles import oracles
from vendorlens.plans.queries import queries as registered

from .compare import difference, sql_connection

SMALL = "/root/testdata/sf0.001"
QUERIES, SQL = registered(), oracles()


@pytest.fixture(scope="module")
def con():
    return sql_connection(SMALL)


def test_every_query_has_its_sql():
    assert sorted(QUERIES) == sorted(SQL)
    assert set(QUERIES) <= set(registry.queries()) and set(SQL) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    found = QUERIES[name](spark, SMALL).toPandas()
    assert len(found) > 0 or name in ("key_violations",)
    assert difference(found, con.sql(SQL[name]).df()) is None


def test_entry(spark):
    assert registry.entry(spark).count() == 1713
