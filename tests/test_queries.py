"""Every registered query against its SQL equivalent."""

import pytest
from conftest import FOLDER

from __spark_entry__ import entry
from check import compare, sql_tables
from signalmill.plans import all_queries as queries
from signalmill.plans import all_sql as oracle_sql

NO_SQL: set[str] = set()


@pytest.fixture(scope="module")
def db():
    return sql_tables(FOLDER)


def test_every_query_has_sql_or_a_reason():
    assert set(queries()) - set(oracle_sql()) == NO_SQL
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(set(queries()) - NO_SQL))
def test_query_equals_sql(spark, db, name):
    assert compare(queries()[name](spark, FOLDER), db.execute(oracle_sql()[name])) == "ok"


def test_entry_gives_one_row_per_day(spark):
    assert entry(spark).count() == 30
