"""Every registered query of the core with SQL gives what the SQL gives; the entry point works."""

import os

import pytest
from compare import DATA, engine, same

from cairnlake import plans

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return engine()


@pytest.mark.parametrize("name", list(plans.SQL))
def test_sql(spark, con, name):
    same(spark, con, plans.QUERIES[name], plans.SQL[name])


@pytest.mark.parametrize("name", [n for n in plans.QUERIES if n not in plans.SQL])
def test_runs(spark, name):
    df = plans.QUERIES[name](spark, DATA)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())
