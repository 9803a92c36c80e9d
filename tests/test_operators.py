from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starmill.functions import code_text, parse_day
from starmill.operators import checks, dimensions, lookups, numbering
from starmill.operators.numbering import number_stored
from starmill.plans.model import WAREHOUSE
from starmill.plans.warehouse import EVENT_COLUMNS, event_load, staged_events
from starmill.session import finer_tasks, footer_aggregates
from starmill.sources import Tables, empty, written
from starmill.sources.tables import stamped


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def test_number_rows_is_dense_ordered_and_stable(spark, rows):
    df = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("code"))
    numbered = numbering.number_rows(df, ["code"], "sk", after=10)
    expected = [
        (code, i) for i, code in enumerate(sorted(r.code for r in df.collect()), start=11)
    ]
    assert [tuple(r) for r in numbered.orderBy("sk").select("code", "sk").collect()] == expected
    assert rows(numbered) == rows(numbered)


def test_number_rows_has_no_single_task_over_the_data(spark):
    df = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("code"))
    numbered = numbering.number_rows(df, ["code"], "sk")
    window_line = next(line for line in plan_of(numbered).splitlines() if "Window [" in line)
    assert "code" not in window_line


def test_number_rows_of_nothing(spark):
    df = spark.createDataFrame([], "code string")
    assert numbering.number_rows(df, ["code"], "sk").count() == 0


def test_last_key_ignores_the_unknown_member(spark):
    assert numbering.last_key(spark.createDataFrame([], "sk bigint"), "sk") == 0
    assert numbering.last_key(spark.createDataFrame([(-1,)], "sk bigint"), "sk") == 0
    assert numbering.last_key(spark.createDataFrame([(-1,), (7,)], "sk bigint"), "sk") == 7


def test_last_stored_key_comes_from_footers(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "tables"))
    schema = "sk bigint, part string"
    assert numbering.last_stored_key(tables, "t", schema, "sk") == 0
    rows = spark.range(1, 101).select(
        F.col("id").alias("sk"), F.when(F.col("id") <= 60, "a").otherwise("b").alias("part")
    )
    tables.replace_deliveries("t", rows, "part")
    assert numbering.last_stored_key(tables, "t", schema, "sk") == 100
    replaced = spark.createDataFrame([("b",), ("b",)], "part string")
    assert numbering.last_stored_key(tables, "t", schema, "sk", "part", replaced) == 60
    with footer_aggregates(spark):
        plan = plan_of(tables.read("t", schema).agg(F.max("sk")))
    assert "PushedAggregation: [MAX(sk)]" in plan
    assert "BatchScan" not in plan_of(tables.read("t", schema))


def test_with_unknown_twice_is_once(spark, rows):
    df = spark.createDataFrame([(1, "a")], "sk bigint, label string")
    once = numbering.with_unknown(df, "sk", {"label": "?"})
    twice = numbering.with_unknown(once, "sk", {"label": "?"})
    assert rows(once) == rows(twice) == [(-1, "?"), (1, "a")]


def test_resolve_mixed_types_and_misses(spark, rows):
    facts = spark.createDataFrame([("1",), ("2",), ("M",), (None,)], "code string")
    domain = spark.createDataFrame([(10, 1), (-1, -1)], "sk bigint, cd bigint")
    found = lookups.resolve(facts, [lookups.Lookup(domain, "code", "cd", "sk", "key")])
    assert rows(found) == [("1", 10), ("2", -1), ("M", -1), (None, -1)]


def test_resolve_fails_on_a_doubled_code(spark):
    facts = spark.createDataFrame([("1",)], "code string")
    domain = spark.createDataFrame([(10, "1"), (11, "1")], "sk bigint, cd string")
    with pytest.raises(PySparkException, match="not unique"):
        lookups.resolve(facts, [lookups.Lookup(domain, "code", "cd", "sk", "key")]).collect()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_join_spreading_heavy_equals_plain_join(spark, rows, how):
    key = F.when(F.col("id") < 3000, F.lit(-1)).when(F.col("id") < 4000, F.lit(None)).otherwise(
        F.col("id")
    )
    left = spark.range(9000).select("id", key.cast("bigint").alias("k"))
    right = spark.range(-1, 7000).select(F.col("id").alias("rk"), (F.col("id") * 2).alias("v"))
    heavy = lookups.heavy_values(left, ["k", "id"])
    assert heavy == {"k": [-1, None], "id": []}
    spread = lookups.join_spreading_heavy(left, right, "k", "rk", how=how)
    plain = left.join(right, left.k == right.rk, how).select("id", "k", "v")
    assert rows(spread) == rows(plain)


def test_many_heavy_keys_are_a_broadcast_table(spark, rows, monkeypatch):
    left = spark.range(5000).selectExpr("IF(id % 3 = 0, NULL, id % 40) AS k", "id")
    right = spark.range(30).selectExpr("id AS rk", "id * 2 AS v")
    shares = {None: 0.33, **{k: 0.015 for k in range(40)}}
    plain = rows(left.join(right, left.k == right.rk, "left").select("k", "id", "v"))
    monkeypatch.setattr(lookups, "_LITERAL_KEYS", 8)
    spread = lookups.join_spreading_heavy(left, right, "k", "rk", how="left", heavy=shares)
    assert rows(spread, "k", "id", "v") == plain
    plan = spread._jdf.queryExecution().optimizedPlan().toString()
    assert "__salted" in plan and " INSET " not in plan


def test_join_spreading_heavy_spreads(spark):
    """The largest task of the shuffle holds far less than the heavy key's rows."""
    left = spark.range(80000).select(
        "id", F.when(F.col("id") < 40000, F.lit(-1)).otherwise(F.col("id")).alias("k")
    )
    right = spark.range(-1, 80000).select(F.col("id").alias("rk"), F.lit(1).alias("v"))
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = {name: spark.conf.get(name) for name in names}
    for name, value in zip(names, ("-1", "false")):
        spark.conf.set(name, value)
    try:
        joined = lookups.join_large(left, right, "k", "rk")
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 25000
        assert sum(r["count"] for r in sizes) == 80000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_heavy_keys_follow_the_partitions(spark, rows):
    """With many partitions a key of 0.1 % outweighs one of them and is spread."""
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    key = F.when(F.col("id") < 200, F.lit(-1)).otherwise(F.col("id"))
    left = spark.range(200_000).select("id", key.alias("k"))
    right = spark.range(-1, 200_000, 7).select(F.col("id").alias("rk"), F.lit(1).alias("v"))
    assert lookups.heavy_values(left, ["k"]) == {"k": []}
    spark.conf.set(setting, "600")
    try:
        shares = lookups.heavy_shares(left, ["k"])["k"]
        assert -1 in shares and 0.0009 < shares[-1] < 0.002
        spread = lookups.join_spreading_heavy(left, right, "k", "rk", how="inner", heavy=shares)
        plain = left.join(right, left.k == right.rk)
        summed = [F.count("*"), F.sum("id"), F.sum((F.col("k") == -1).cast("int"))]
        assert spread.agg(*summed).first() == plain.agg(*summed).first()
    finally:
        spark.conf.set(setting, before)


def test_heavy_shares_of_no_rows_and_only_nulls(spark):
    empty = spark.range(0).select("id", F.lit("x").alias("k"))
    assert lookups.heavy_shares(empty, ["id", "k"]) == {"id": {}, "k": {}}
    nulls = spark.range(10).select(F.lit(None).cast("bigint").alias("k"))
    assert lookups.heavy_shares(nulls, ["k"]) == {"k": {None: 1.0}}


def test_resolve_beyond_broadcast_equals_resolve(spark, rows):
    facts = spark.range(20000).select(
        "id",
        F.when(F.col("id") < 9000, "x").when(F.col("id") > 15000, F.col("id").cast("string")).alias("a"),
        F.when(F.col("id") < 9000, "7.0").otherwise(F.col("id").cast("string")).alias("b"),
    )
    texts = spark.range(15000, 18000).select(
        F.col("id").cast("string").alias("code"), (F.col("id") * 2).alias("sk")
    )
    numbers = spark.range(5, 12000).select(F.col("id").alias("code"), (F.col("id") + 1).alias("sk"))
    wanted = [
        lookups.Lookup(texts, "a", "code", "sk", "a_key"),
        lookups.Lookup(numbers, "b", "code", "sk", "b_key", unique=True),
    ]
    small = rows(lookups.resolve(facts, wanted))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1b")
    try:
        assert not lookups.fits_broadcast(texts)
        large = lookups.resolve(facts, wanted)
        assert "BroadcastHashJoin" not in plan_of(large)
        assert "__left_salt" in plan_of(large)
        assert rows(large) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_insert_unseen_twice_is_once(spark, rows):
    existing = spark.createDataFrame([(5, "a", "A")], "sk bigint, code string, label string")
    listed = spark.createDataFrame([("b", "B"), ("a", "Z"), ("b", "B")], "code string, label string")
    once = dimensions.insert_unseen(existing, listed, "code", "sk")
    twice = dimensions.insert_unseen(once, listed, "code", "sk")
    assert rows(once) == rows(twice) == [(5, "a", "A"), (6, "b", "B")]


def test_upsert_twice_is_once(spark, rows):
    existing = spark.createDataFrame([(1, "a", "old"), (9, "z", "kept")], "sk bigint, code string, label string")
    listed = spark.createDataFrame([(1, "a", "new"), (2, "b", "B")], "sk bigint, code string, label string")
    once = dimensions.upsert(existing, listed, "sk")
    assert rows(once) == rows(dimensions.upsert(once, listed, "sk"))
    assert rows(once) == [(1, "a", "new"), (2, "b", "B"), (9, "z", "kept")]


def test_merge_actions_and_null_labels(spark, rows):
    target = spark.createDataFrame(
        [(1, "a", "A", 1), (2, "b", "B", 1), (3, "c", None, 1), (4, "d", None, 1)],
        "sk bigint, code string, label string, stamp int",
    )
    source = spark.createDataFrame(
        [("a", "A", 2), ("b", "B2", 2), ("c", None, 2), ("d", "D", 2), ("e", "E", 2), ("e", "E", 2)],
        "code string, label string, stamp int",
    )
    merged = dimensions.merge(target, source, "code", "sk", ["label"], ["stamp"])
    assert rows(merged) == [
        (1, "a", "A", 1, "keep"),
        (2, "b", "B2", 2, "update"),
        (3, "c", None, 1, "keep"),
        (4, "d", "D", 2, "update"),
        (5, "e", "E", 2, "insert"),
    ]
    again = dimensions.merge(merged.drop("action"), source, "code", "sk", ["label"], ["stamp"])
    assert rows(dimensions.audit(again)) == [("keep", 5)]


def test_keys_of_old_members_never_change(spark):
    first = spark.createDataFrame([("m",), ("x",)], "code string")
    none = spark.createDataFrame([], "sk bigint, code string")
    known = dimensions.new_members(none, first, "code", "sk").select("sk", "code")
    later = spark.createDataFrame([("a",), ("m",), (None,)], "code string")
    added = dimensions.new_members(known, later, "code", "sk").select("sk", "code")
    assert [tuple(r) for r in known.unionByName(added).orderBy("sk").collect()] == [
        (1, "m"),
        (2, "x"),
        (3, "a"),
    ]


def test_calendar(spark):
    holidays = spark.sql("SELECT DATE '2020-01-01' AS day UNION ALL SELECT DATE '2020-01-01'")
    days = dimensions.calendar(spark, "2018-01-01", "2024-12-31", holidays)
    assert days.count() == 2557
    assert tuple(days.filter("day = '2020-01-01'").first())[0] == 731
    assert [r.day_key for r in days.filter("is_holiday").collect()] == [731]


def test_checks(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, v string")
    parent = spark.createDataFrame([(1,)], "p int")
    assert rows(checks.key_violations(df, ["k"])) == [(1, 2)]
    assert rows(checks.orphans(df, "k", parent, "p")) == [(2, 1)]
    assert rows(checks.null_counts(df, ["k", "v"])) == [("k", 0), ("v", 1)]
    assert checks.first_rows(df, 2).count() == 2
    assert rows(checks.top_by_key(df, "k", 1)) == [(2, None)]


def test_tables_versions_and_self_replacement(spark, rows, tmp_path):
    tables = Tables(spark, str(tmp_path / "tables"))
    schema = "k int"
    assert tables.read("t", schema).count() == 0
    tables.replace("t", spark.createDataFrame([(1,)], schema))
    old = tables.read("t", schema)
    tables.replace("t", old.select((F.col("k") + 1).alias("k")))
    assert rows(tables.read("t", schema)) == [(2,)]
    assert rows(old) == [(1,)]
    tables.append("t", spark.createDataFrame([(3,)], schema))
    assert rows(tables.read("t", schema)) == [(2,), (3,)]
    # A version without its success marker is not read.
    (tmp_path / "tables" / "t" / "v000003").mkdir()
    assert rows(tables.read("t", schema)) == [(2,), (3,)]


def test_written_keeps_schema(spark):
    df = stamped(spark.range(3), None)
    assert written(df, "x").dtypes == df.dtypes


def test_one_row_per_key_keeps_the_greatest(spark, rows):
    df = spark.createDataFrame(
        [("a", "x", 1), ("a", "x", 1), ("a", "z", 0), ("b", None, 5)],
        "code string, label string, n int",
    )
    assert rows(dimensions.one_row_per_key(df, "code")) == [("a", "z", 0), ("b", None, 5)]
    assert rows(dimensions.one_row_per_key(df.select("code"), "code")) == [("a",), ("b",)]


def test_hierarchy_keys_survive_a_reordered_delivery(spark, rows):
    def build(names, states, towns):
        return dimensions.hierarchy(
            [
                dimensions.Level(
                    spark.createDataFrame(names, "state string, name string"),
                    states, "state", "state_key", ["name"],
                ),
                dimensions.Level(
                    spark.createDataFrame(
                        [("t1", "One", "s1"), ("t2", "Two", "s9")],
                        "town string, name string, state string",
                    ),
                    towns, "town", "town_key", ["name"], parent_code="state",
                ),
            ]
        )

    none = (
        spark.createDataFrame([], "state_key bigint, state string, name string"),
        spark.createDataFrame([], "town_key bigint, town string, name string, state_key bigint"),
    )
    first = build([("s1", "B"), ("s2", "A")], *none)
    assert rows(first[0], "state_key", "state") == [(1, "s1"), (2, "s2")]
    assert rows(first[1], "town_key", "town", "state_key") == [(1, "t1", 1), (2, "t2", -1)]
    later = build([("s0", "C"), ("s2", "A"), ("s1", "B")], *first)
    assert rows(later[0], "state_key", "state") == [(1, "s1"), (2, "s2"), (3, "s0")]
    assert rows(later[1]) == rows(first[1])


def test_year_dimension_refuses_what_is_no_year(spark, rows):
    df = spark.createDataFrame([(2020,), (2018,), (2020,), (None,)], "year int")
    assert rows(dimensions.year_dimension(df, "year", "k")) == [(1, 2018), (2, 2020)]
    bad = spark.createDataFrame([(20201,)], "year int")
    with pytest.raises(PySparkException, match="not a year"):
        dimensions.year_dimension(bad, "year", "k").collect()


def test_plans_stay_native(spark):
    """No Python runs on rows, and lookups of code lists are broadcast."""
    codes = dimensions.code_list(spark, [("a",), ("b",)], "sk bigint, code string")
    facts = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    found = lookups.resolve(facts, [lookups.Lookup(codes, "event_type", "code", "sk", "k")])
    plan = plan_of(found)
    assert "BroadcastHashJoin" in plan
    assert not any(word in plan for word in ("Python", "Pandas", "CartesianProduct"))


def test_one_row_per_key_sorts_no_raw_rows(spark):
    """Whole rows are combined by hashing before the first exchange."""
    df = spark.range(1000).selectExpr("id % 7 AS code", "CAST(id % 3 AS STRING) AS label")
    plan = dimensions.one_row_per_key(df, "code")._jdf.queryExecution().sparkPlan().toString()
    lowest = [line for line in plan.splitlines() if "Aggregate" in line][-1]
    assert "HashAggregate" in lowest and "code" in lowest
    executed = dimensions.one_row_per_key(df, "code")._jdf.queryExecution().executedPlan().toString()
    below = executed[executed.rindex("Exchange") :]
    assert "HashAggregate" in below and "Sort" not in below


def test_colliding_members_fail_the_load(spark):
    from starmill.operators.dimensions import one_row_per_key

    rows = "key string, name string"
    same = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", None), ("b", None)], rows)
    assert one_row_per_key(same, "key", alike=True).count() == 2
    for other in ("y", None):
        differing = spark.createDataFrame([("a", "x"), ("a", other)], rows)
        with pytest.raises(Exception, match="rows of one key differ"):
            one_row_per_key(differing, "key", alike=True).collect()


def test_finer_tasks_put_the_setting_back(spark):
    name = "spark.sql.adaptive.coalescePartitions.minPartitionNum"
    before = spark.conf.get(name, None)
    with finer_tasks(spark):
        assert int(spark.conf.get(name)) == 4 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(name, None) == before


def test_numbers_of_stored_rows_take_no_name_apart_per_row(spark):
    stored = written(spark.range(100).repartition(5), "stored")
    numbered = number_stored(stored, "n", 7)
    assert sorted(r.n for r in numbered.collect()) == list(range(8, 108))
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    # Once per file, below the window that orders the files.
    assert plan.count("regexp_extract(") <= 1


def test_small_new_members_need_no_pass_for_heavy_keys(spark, monkeypatch):
    passes = []
    found = lookups.heavy_shares
    monkeypatch.setattr(
        lookups, "heavy_shares", lambda df, columns, *a: passes.extend(columns) or found(df, columns, *a)
    )
    row = {c: "1" for c in EVENT_COLUMNS} | {"CAUSABAS": "V011", "LINHAA": "*R092*J18", "DTOBITO": "1022020"}
    rows = [tuple({**row, "OCUP": str(n % 3), "source_path": "/in/a.csv"}.values()) for n in range(30)]
    source = spark.createDataFrame(rows, [*EVENT_COLUMNS, "source_path"])
    load = event_load(
        staged_events(source), lambda name: empty(spark, WAREHOUSE[name].columns), datetime(2024, 5, 1)
    )
    assert load.persons.count() == 3 and load.causes.count() == 1
    keys = load.movement.select("SK_PESSOA", "SK_CAUSAOBITO", "CD_OBITO").collect()
    assert sorted(k.CD_OBITO for k in keys) == list(range(1, 31))
    assert {k.SK_PESSOA for k in keys} == {1, 2, 3} and {k.SK_CAUSAOBITO for k in keys} == {1}
    assert passes == []


def test_days_and_codes_by_number_equal_those_by_pattern(spark):
    days = {
        "1022020": "2020-02-01", "01022020": "2020-02-01", "29022020": "2020-02-29", "29022021": None,
        "29021900": None, "31042020": None, "00012020": None, "01010000": None, "+1022020": None,
        " 1022020": "2020-02-01", "1022020.0": "2020-02-01", "0 102202": None, "15132020": None, None: None,
    }
    codes = {"1.0": "1", "01.0": "1", "-1.0": "-1", "1 .0": "1 .0", "a.0": "a.0", ".0": ".0", "1.00": "1"}
    df = spark.createDataFrame([(k, v) for k, v in days.items()], "t string, v string")
    for r in df.select("t", "v", parse_day(F.col("t")).cast("string").alias("got")).collect():
        assert r.got == r.v, r.t
    df = spark.createDataFrame([(k, v) for k, v in codes.items()], "t string, v string")
    for r in df.select("t", "v", code_text(F.col("t")).alias("got")).collect():
        assert r.got == r.v, r.t
