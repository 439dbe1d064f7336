import os

import pytest

from tests.oracle import DATA, same
from tracewright.plans import queries as Q

pytestmark = pytest.mark.skipif(not os.path.isdir(f"{DATA}/sf0.001"), reason="no test tables")


@pytest.mark.parametrize("name", sorted(Q.SQL))
def test_same_rows_as_sql(spark, name):
    same(spark, Q.QUERIES[name], Q.SQL[name])


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.SQL)))
def test_runs_without_sql(spark, name):
    assert Q.QUERIES[name](spark, f"{DATA}/sf0.001").count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() == 1000
