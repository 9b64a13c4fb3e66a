"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import differences
from conftest import SF_DIR

import __spark_entry__ as entry_points
from obs_engine.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, connection, name):
    assert differences(spark, connection, name, SF_DIR) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    flagship = entry_points.entry(spark)
    assert flagship.columns[:2] == ["year_month", "city"]
    assert flagship.count() > 0
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())
