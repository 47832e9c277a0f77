"""Every registered query against its SQL counterpart on the smallest tables."""

import pytest

import __spark_entry__ as entry
from docspark.plans.catalog import QUERIES
from docspark.plans.oracles import ORACLES
from tests.check_oracles import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_equals_sql(spark, con, name):
    ok, message = compare(spark, con, name, SF)
    assert ok, message


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    # Those for training data, where they are present, have tests of their own instead.
    assert set(ORACLES) == set(QUERIES)


def test_entry_has_a_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns == ["page_id", "media_type", "title", "content", "language", "raw_score", "confidence"]
    assert df.count() == 50
