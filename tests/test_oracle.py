"""Every query of the core against its SQL over the smallest tables."""

import pytest

from siltstone.plans import feed_problems, feed_queries, function_queries, search_queries, stats_queries
from tests_compare import rows_of, rows_of_sql

MODULES = (feed_problems, stats_queries.registry, function_queries.registry, search_queries.registry, feed_queries.registry)
QUERIES = {k: v for m in MODULES for k, v in m.queries().items()}
SQL = {k: v for m in MODULES for k, v in m.oracle_sql().items()}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, duck, name):
    cols, rows = rows_of(QUERIES[name](spark, small))
    if name in SQL:
        assert (cols, rows) == rows_of_sql(duck, SQL[name])
    else:
        assert cols


def test_sql_names_queries():
    assert set(SQL) <= set(QUERIES)
