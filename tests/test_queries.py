import pytest
from sql import compare

from roadlake import dataset_queries as datasets
from roadlake.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    compare(spark, QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(datasets.SQL))
def test_dataset_equals_its_sql(spark, name):
    compare(spark, datasets.QUERIES[name], datasets.SQL[name])


def test_capped_windows_add_up(spark):
    rows = QUERIES["capped_windows"](spark, "/root/testdata/sf0.001").collect()
    spans = sorted((r["window_start_us"], r["window_end_us"]) for r in rows)
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and all(r["n"] < 500 for r in rows)
