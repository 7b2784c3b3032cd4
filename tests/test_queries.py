"""Every registered query against its SQL on the smallest driver tables."""

from pathlib import Path

import pytest

import __spark_entry__ as E
from citymart.plans.oracles import ORACLES
from citymart.plans.queries import QUERIES
from tools.compare import compare

SF_DIR = Path(E.SMOKE_DIR)

pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="driver tables are not here")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, name):
    assert compare(spark, name, str(SF_DIR)) == []


def test_only_training_has_no_sql():
    assert set(QUERIES) - set(ORACLES) == {"price_regression"}
    assert set(ORACLES) <= set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_entry_yields_rows(spark):
    assert E.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["property_analytics", "latest_orders", "integrated", "describe"])
def test_queries_without_broadcast(spark, name):
    """Beyond the broadcast threshold the same queries run on shuffled joins."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        assert compare(spark, name, str(SF_DIR)) == []
    finally:
        spark.conf.set(key, before)
