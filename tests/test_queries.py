"""Every registered query against its SQL on the given tables."""

from __future__ import annotations

import os

import compare
import pytest

from starmill.catalog import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return compare.connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert compare.differences(spark, connection, QUERIES[name], ORACLES[name], FOLDER) is None


@pytest.mark.parametrize(
    "name",
    ["event_movement", "event_fact", "snapshot_with_counts", "lookup_unknown", "flag_lookup",
     "role_play", "calendar", "merge_insert_update"],
)
def test_query_equals_sql_without_broadcast(spark, connection, name):
    """With every lookup table too large to broadcast, as at scale."""
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        difference = compare.differences(spark, connection, QUERIES[name], ORACLES[name], FOLDER)
    finally:
        spark.conf.set(setting, before)
    assert difference is None


def test_entry_points(spark):
    import __spark_entry__ as entry_points

    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
    assert not entry_points.entry(spark).isEmpty()
