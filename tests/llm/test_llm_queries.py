"""Every registered query of this package: against SQL, or at least over all rows."""

import os

import pytest
from compare import DATA, engine, same

from cairnlake.llm import registry

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return engine()


@pytest.mark.parametrize("name", list(registry.SQL))
def test_sql(spark, con, name):
    same(spark, con, registry.QUERIES[name], registry.SQL[name])


def test_every_document_is_encoded(spark):
    assert registry.QUERIES["p6_ids"](spark, DATA).count() == spark.read.parquet(f"{DATA}/documents.parquet").count()


def test_shares_add_up(spark):
    rows = registry.QUERIES["p7_shares"](spark, DATA).collect()
    assert abs(sum(r.share for r in rows) - 1) < 1e-9 and all(r.tokens_taken <= r.tokens_available * r.max_repeats for r in rows)


def test_found_is_restored(spark):
    found, back = ({r.doc_id for r in registry.QUERIES[q](spark, DATA).collect()} for q in ("p8_found", "p8_restored"))
    assert found == back and found
