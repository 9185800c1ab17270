import pytest

import __spark_entry__ as entry_points
from compare import difference
from revflow.workload import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(entry_points.queries()) & set(entry_points.oracle_sql())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert len(df.columns) == 36 and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, name):
    df = entry_points.queries()[name](spark, FOLDER)
    assert difference(df, entry_points.oracle_sql()[name], FOLDER) is None
