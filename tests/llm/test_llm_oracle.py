"""The queries of this package against their SQL over the smallest tables."""

import pytest

from siltstone.llm import queries as q
from tests_compare import rows_of, rows_of_sql


@pytest.mark.parametrize("name", sorted(q.queries()))
def test_query(spark, small, duck, name):
    cols, rows = rows_of(q.queries()[name](spark, small))
    if name in q.oracle_sql():
        assert (cols, rows) == rows_of_sql(duck, q.oracle_sql()[name])
    else:
        assert cols
