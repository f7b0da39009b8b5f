"""Every registered query against its SQL on the smallest tables."""

import compare
import pytest
from duebook.plans import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_rows_equal(spark, con, name):
    mine = compare.spark_rows(QUERIES[name](spark, SF))
    assert mine[1], "a query whose result is empty proves nothing"
    assert compare.differences(mine, compare.duck_rows(con, ORACLES[name])) is None
    spark.catalog.clearCache()
