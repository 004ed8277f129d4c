import pytest
from sql import compare

from roadlake.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    compare(spark, queries.queries()[name], queries.oracle_sql()[name])
