"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import differential
import pytest

import __spark_entry__  # noqa: F401  (registers all queries)
from ledgerline.queries.registry import ORACLE_SQL, QUERIES

from conftest import SMALL


@pytest.fixture(scope="module")
def con():
    return differential.duck(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, con, name):
    assert differential.difference(spark, con, QUERIES[name], ORACLE_SQL[name], SMALL) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
