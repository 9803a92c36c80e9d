"""Large member tables: filters of key hashes, and hash keys that collide."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starmill.operators import dimensions
from starmill.operators.dimensions import new_members, unseen_members, without_strangers
from starmill.operators.facts import event_fact
from starmill.operators.filters import MAX_BITS, filter_bits, key_filter, may_be_in
from starmill.operators.lookups import join_in_buckets
from starmill.sources import BucketedTable


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_filter_keeps_every_key_and_few_others(spark, kind):
    keys = spark.range(0, 5000, 7).select(F.col("id").cast(kind).alias("k"))
    stored = spark.range(100_000).select(F.col("id").cast(kind).alias("k"), F.lit(1).alias("x"))
    bits = filter_bits(keys.count())
    passing = may_be_in(stored, "k", key_filter(keys, "k", bits), bits)
    assert passing.join(keys, "k", "left_semi").count() == keys.count()
    assert passing.count() < keys.count() + 0.12 * 100_000 and passing.columns == ["k", "x"]
    assert may_be_in(stored, "k", key_filter(keys.filter("false"), "k", 6), 6).isEmpty()


def test_filter_size_is_bounded():
    assert filter_bits(0) == 6 and filter_bits(1000) == 14 and filter_bits(10**12) == MAX_BITS


def test_new_members_beside_a_large_table(spark, monkeypatch):
    existing = spark.range(20_000).selectExpr("id + 1 AS sk", "CAST(id * 3 AS STRING) AS code", "id AS mark")
    source = spark.range(900).selectExpr("CAST(id % 300 AS STRING) AS code", "IF(id % 3 = 0, (id % 300) div 3, -1) AS mark")
    small = new_members(existing, source, "code", "sk", alike=True, fingerprint="mark").collect()
    monkeypatch.setattr(dimensions, "fits_broadcast", lambda df: False)
    large = new_members(existing, source, "code", "sk", alike=True, fingerprint="mark").collect()
    assert sorted(map(tuple, small)) == sorted(map(tuple, large)) and len(small) == 200
    assert sorted(r["sk"] for r in small) == list(range(20_001, 20_201))


def test_stored_members_are_filtered_before_they_are_shuffled(spark):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        stored = spark.range(50_000).selectExpr("CAST(id AS STRING) AS code")
        members, known = without_strangers(stored.filter("code < '11'"), stored, "code")
        plan = unseen_members(members, known, "code")._jdf.queryExecution().executedPlan().toString()
        assert known.count() < 0.2 * 50_000
    finally:
        spark.conf.set(setting, before)
    right = plan[plan.rindex("Exchange hashpartitioning(code"):]
    assert "BroadcastHashJoin" in right and "shiftright" in right


def test_member_stored_with_another_fingerprint_fails(spark):
    existing = spark.createDataFrame([(1, "a", 10), (2, "b", None)], "sk bigint, code string, mark bigint")
    same = spark.createDataFrame([("a", 10), ("b", 7), ("c", 5)], "code string, mark bigint")
    found = new_members(existing, same, "code", "sk", fingerprint="mark")
    assert [tuple(r) for r in found.collect()] == [("c", 5, 3)]
    other = spark.createDataFrame([("a", 11)], "code string, mark bigint")
    with pytest.raises(Exception, match="two members under one code: a"):
        new_members(existing, other, "code", "sk", fingerprint="mark").collect()


@pytest.fixture
def in_buckets(spark, tmp_path):
    """Movement with one key in a third of its rows, and entities, in eight buckets."""
    movement = spark.range(30_000).selectExpr("IF(id % 3 = 0, 7, id % 900) AS k", "id AS event", "id % 5 AS d")
    entities = spark.range(1, 800).selectExpr("id AS k", "id * 10 AS place")
    tables = []
    for name, df in (("movement", movement), ("entities", entities)):
        stored = BucketedTable(spark, str(tmp_path / name), df.schema, "k", 8)
        stored.append(df)
        tables.append(stored)
    return movement, entities, *tables


def test_join_of_buckets_needs_no_exchange(spark, in_buckets):
    movement, entities, events, persons = in_buckets
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        for how in ("inner", "left"):
            joined = join_in_buckets(events.read(), persons.read(), "k", how)
            found = sorted(map(tuple, joined.select("k", "event", "place").collect()), key=str)
            plain = movement.join(entities, "k", how).select("k", "event", "place").collect()
            assert found == sorted(map(tuple, plain), key=str)
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" in plan
            assert plan.count("BroadcastHashJoin") >= 2  # the heavy key goes its own way
        days = spark.range(5).selectExpr("id AS day", "id + 100 AS day_key")
        fact = event_fact(
            events.read(), persons.read(), "k", ["place"], days.withColumnRenamed("day", "c"), "d", "key", "c",
            "day_key", "", "n", in_buckets=True,
        )
        assert fact.count() == movement.join(entities, "k").count()
    finally:
        spark.conf.set(setting, before)


def test_buckets_are_appended_to_and_replaced(spark, in_buckets):
    movement, _, events, persons = in_buckets
    events.append(movement.limit(100))
    assert events.read().count() == 30_100
    persons.replace(spark.createDataFrame([(5, 50)], "k bigint, place bigint"))
    again = BucketedTable(spark, persons.path, "k bigint, place bigint", "k", 8)
    assert [tuple(r) for r in again.read().collect()] == [(5, 50)]
    with pytest.raises(ValueError, match="would repeat"):
        join_in_buckets(events.read(), persons.read(), "k", "full")
