"""Every registered query against its SQL counterpart."""

import pytest

import __spark_entry__ as entry
from checks.compare import connect, differences
from checks.oracles import all_oracles
from checks.queries import all_queries

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_entry_has_tracking_columns(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["source_host", "target_host", "model_name"]
    assert df.limit(1).count() == 1
