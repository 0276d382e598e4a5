"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.check_oracle import compare, duck

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    assert {"trend_forecast", "isolation_forest_rows"} <= set(QUERIES) - set(ORACLES)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables absent")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    frame = QUERIES[name](spark, SF_DIR).toPandas()
    if name in ORACLES:
        problem = compare(frame, duck(SF_DIR).execute(ORACLES[name]).df())
        assert problem is None, problem
    elif name != "trend_forecast":
        assert len(frame.columns) > 0
