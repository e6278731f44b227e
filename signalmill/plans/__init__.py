"""Ready-made queries over the dataset tables, with their SQL equivalents."""

from signalmill.plans import (
    file_plans,
    relational_plans,
    signal_plans,
    sql_table_plans,
    stream_plans,
    topic_plans,
    word_plans,
)

_CATALOGUES = [
    signal_plans.CATALOGUE,
    relational_plans.CATALOGUE,
    word_plans.CATALOGUE,
    file_plans.CATALOGUE,
    topic_plans.CATALOGUE,
    stream_plans.CATALOGUE,
    sql_table_plans.CATALOGUE,
]


def all_queries():
    """Every query by name, each called with a session and a dataset folder."""
    return {name: run for c in _CATALOGUES for name, run in c.queries.items()}


def all_sql():
    """The SQL equivalent of each query that has one."""
    return {name: sql for c in _CATALOGUES for name, sql in c.sql.items()}
