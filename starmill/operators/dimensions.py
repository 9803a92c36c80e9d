"""Dimension loads. Each returns the new table; writing it is the caller's step."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starmill.functions.dates import day_parts
from starmill.functions.values import UNKNOWN_KEY, UNKNOWN_LABEL
from starmill.operators.filters import filter_bits, key_filter, may_be_in
from starmill.operators.lookups import Lookup, fits_broadcast, join_large, members_flag, resolve
from starmill.operators.numbering import last_key, number_rows
from starmill.sources.scratch import written

ACTION = "action"
INSERT, UPDATE, KEEP = "insert", "update", "keep"


def code_list(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Fixed rows of a code list; the first column of the schema is the position.

    The rows are literals of the plan, so Spark knows that they are few and broadcasts
    them. (Of rows shipped from Python it assumes the worst.)
    """
    fields = StructType.fromDDL(schema).fields
    literals = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip((i, *row), fields)])
        for i, row in enumerate(rows, start=1)
    ]
    return spark.range(1).select(F.inline(F.array(*literals)))


def one_row_per_key(source: DataFrame, key: str, alike: bool = False) -> DataFrame:
    """Source with one row per key; of repeated rows the greatest remains.

    Repeated rows combine in each task before any shuffle, first whole rows and then
    rows per key, so a key that holds a third of the source costs no task more than any
    other. With ``alike``, rows of one key that differ fail the job, as two members whose
    hash keys collide would.
    """
    others = [c for c in source.columns if c != key]
    if not others:
        return source.distinct()
    variants = source.groupBy(key, *others).agg(F.count("*").alias("__n"))
    # Without the count Spark would drop the first aggregate, and the maximum of structs
    # would sort the raw rows of every task.
    row = F.struct(*others)
    least = [F.min(row).alias("__least")] if alike else []
    chosen = variants.groupBy(key).agg(
        F.max(row).alias("__row"), F.sum("__n").alias("__n"), *least
    )
    if alike:
        differ = F.raise_error(F.concat(F.lit(f"rows of one {key} differ: "), F.col(key).cast("string")))
        kind = dict(chosen.dtypes)["__row"]
        checked = F.when(F.col("__row") != F.col("__least"), differ.cast(kind)).otherwise(F.col("__row"))
        chosen = chosen.withColumn("__row", checked)
    return chosen.filter("__n > 0").select(
        *[F.col(key) if c == key else F.col(f"__row.{c}").alias(c) for c in source.columns]
    )


def insert_unseen(existing: DataFrame, rows: DataFrame, code: str, key: str) -> DataFrame:
    """Domain load: add the codes the table lacks and change nothing else."""
    numbered = new_members(existing, rows, code, key)
    return existing.unionByName(numbered.select(*existing.columns))


def upsert(existing: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Domain load by given key: listed rows replace those of equal key."""
    kept = existing.join(rows.select(key), key, "left_anti")
    return rows.unionByName(kept.select(*rows.columns))


def merge(
    target: DataFrame,
    source: DataFrame,
    code: str,
    key: str,
    compare: Sequence[str],
    carry: Sequence[str] = (),
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Type-1 merge with an ``action`` column.

    Unseen codes are inserted under the next keys, in code order unless ``order_by``
    says otherwise. A code whose ``compare`` columns
    differ takes them, and the ``carry`` columns such as the load stamp, from the
    source. All other target rows are kept, including those absent from the source.
    """
    incoming = one_row_per_key(source.filter(F.col(code).isNotNull()), code)
    others = [c for c in incoming.columns if c != code]
    new = incoming.select(
        F.col(code).alias("__code"), *[F.col(c).alias(f"__new_{c}") for c in others]
    )
    taken = [*compare, *carry]
    differs = F.lit(False)
    for column in compare:
        differs = differs | ~F.col(f"__new_{column}").eqNullSafe(F.col(column))
    action = (
        F.when(F.col("__stored").isNull(), F.lit(INSERT))
        .when(F.col("__code").isNotNull() & differs, F.lit(UPDATE))
        .otherwise(F.lit(KEEP))
    )
    # One join tells what becomes of every row. It is written once: inserts are numbered
    # from it, after the last key found in it.
    stored = target.withColumn("__stored", F.lit(True))
    both = stored.join(new, F.col(code) == F.col("__code"), "full_outer")
    both = written(both.withColumn(ACTION, action), "merging")
    matched = both.filter(F.col(ACTION) != INSERT).select(
        *[
            F.when(F.col(ACTION) == UPDATE, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c)
            if c in taken else c
            for c in target.columns
        ],
        ACTION,
    )
    unseen = both.filter(F.col(ACTION) == INSERT).select(
        F.col("__code").alias(code), *[F.col(f"__new_{c}").alias(c) for c in others]
    )
    inserted = number_rows(unseen, list(order_by) or [code], key, last_key(both, key))
    return matched.unionByName(
        inserted.select(*target.columns, F.lit(INSERT).alias(ACTION))
    )


def audit(merged: DataFrame) -> DataFrame:
    """Rows by action of a merge."""
    return merged.groupBy(ACTION).agg(F.count("*").alias("n_rows"))


def new_members(
    existing: DataFrame,
    source: DataFrame,
    code: str,
    key: str,
    after: int | None = None,
    alike: bool = False,
    fingerprint: str | None = None,
) -> DataFrame:
    """Members of a delivery that the dimension lacks, keyed after its last key.

    ``source`` may hold millions of rows per member: they combine per task first.
    ``after`` gives the last key where the caller knows it without a scan. With ``alike``,
    rows of one code that differ fail the job. ``fingerprint`` names a column of both sides, a
    second hash of what the code is a hash of: a member that is stored under its code with
    another fingerprint fails the job, as the code would stand for two members.
    """
    # The aggregate leaves the members partitioned and sorted by code, as the anti-join
    # needs them, so only the existing codes are shuffled for it.
    members = one_row_per_key(source.filter(F.col(code).isNotNull()), code, alike)
    known = existing.select(code, *([fingerprint] if fingerprint else []))
    if not fits_broadcast(known):
        members, known = without_strangers(members, known, code)
    unseen = unseen_members(members, known, code, fingerprint)
    return number_rows(unseen, [code], key, last_key(existing, key) if after is None else after)


def without_strangers(members: DataFrame, known: DataFrame, code: str) -> tuple[DataFrame, DataFrame]:
    """A delivery's members, written once, and those stored members that may be among them.

    A stored table of any size is then read but not shuffled: what crosses the network is
    the delivery's members and about as many stored ones.
    """
    members = written(members, "members")
    bits = filter_bits(members.count())
    return members, may_be_in(known, code, key_filter(members, code, bits), bits)


def unseen_members(
    members: DataFrame, known: DataFrame, code: str, fingerprint: str | None = None
) -> DataFrame:
    """Members whose code is not known; of a known code, the fingerprint must agree."""
    if fingerprint is None:
        return members.join(known.select(code), code, "left_anti")
    stored = known.select(F.col(code).alias("__code"), F.col(fingerprint).alias("__stored"))
    joined = members.join(stored, F.col(code) == F.col("__code"), "left")
    stop = F.raise_error(F.concat(F.lit(f"two members under one {code}: "), F.col(code).cast("string")))
    collides = F.col("__code").isNotNull() & (F.col("__stored") != F.col(fingerprint))
    unseen = F.when(collides, stop.cast("boolean")).otherwise(F.col("__code").isNull())
    return joined.filter(unseen).select(*members.columns)


@dataclass(frozen=True)
class Level:
    """One level of a hierarchy, listed top first.

    ``rows`` has the natural ``code``, its ``attributes`` and, below the top, the
    parent's natural code in ``parent_code``.
    """

    rows: DataFrame
    existing: DataFrame
    code: str
    key: str
    attributes: Sequence[str]
    parent_code: str | None = None
    order_by: Sequence[str] = ()


def hierarchy(levels: Sequence[Level], stamp_column: str | None = None) -> list[DataFrame]:
    """Merge a hierarchy level by level, resolving each parent's key.

    Members match on their natural code, so a reordered delivery never moves a key.
    A child without a known parent hangs below the unknown member.
    """
    tables: list[DataFrame] = []
    parent: Level | None = None
    for level in levels:
        rows = level.rows
        compare = list(level.attributes)
        if parent is not None:
            rows = resolve(
                rows,
                [Lookup(tables[-1], level.parent_code, parent.code, parent.key, parent.key)],
            )
            if level.parent_code != level.code:
                rows = rows.drop(level.parent_code)
            compare.append(parent.key)
        carry = [stamp_column] if stamp_column else []
        merged = merge(level.existing, rows, level.code, level.key, compare, carry, level.order_by)
        tables.append(merged.drop(ACTION))
        parent = level
    return tables


def one_row_or_fail(table: DataFrame, key: str) -> DataFrame:
    """Table whose key is checked by the job that reads it: a doubled key would multiply
    the rows that it is joined to."""
    others = [c for c in table.columns if c != key]
    row = F.struct(*others) if others else F.struct(F.lit(None).cast("string").alias("none"))
    doubled = F.raise_error(F.concat(F.lit(f"{key} is not unique: "), F.col(key).cast("string")))
    checked = table.groupBy(key).agg(F.count("*").alias("__n"), F.min(row).alias("__row"))
    kind = dict(checked.dtypes)["__row"]
    checked = checked.select(
        key, F.when(F.col("__n") > 1, doubled.cast(kind)).otherwise(F.col("__row")).alias("__row")
    )
    return checked.select(
        *[F.col(key) if c == key else F.col(f"__row.{c}").alias(c) for c in table.columns]
    )


def flatten_chain(base: DataFrame, parents: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Snowflake to one row per member: inner joins up the parent keys.

    The unknown members link to each other, so the unknown row survives.
    """
    for parent, key in parents:
        base = join_large(base, one_row_or_fail(parent, key), key, key, how="inner")
    return base


def flatten_star(base: DataFrame, roles: Sequence[tuple[str, DataFrame, str, dict]]) -> DataFrame:
    """Left-join attribute tables by key and fill what is missing.

    Each role is (key in ``base``, table, key in the table, {output: (column, default)}).
    The same table may serve several roles.
    """
    for number, (base_key, table, table_key, outputs) in enumerate(roles):
        picked = one_row_or_fail(table.select(table_key, *{c for c, _ in outputs.values()} - {table_key}), table_key)
        picked = picked.select(
            F.col(table_key).alias(f"__key_{number}"),
            *[F.col(c).alias(f"__{number}_{out}") for out, (c, _) in outputs.items()],
        )
        base = join_large(base, picked, base_key, f"__key_{number}").select(
            *base.columns,
            *[
                F.coalesce(F.col(f"__{number}_{out}"), F.lit(default)).alias(out)
                for out, (_, default) in outputs.items()
            ],
        )
    return base


def year_dimension(years: DataFrame, column: str, key: str) -> DataFrame:
    """Distinct years, keyed from 1 in order; rows without a year have no member.

    The one ordered task numbers at most 10,000 rows, whatever the size of the source: a
    year of other than four digits fails the job.
    """
    year = F.col(column).cast("int")
    checked = F.when(year.between(0, 9999), year).otherwise(
        F.raise_error(F.concat(F.lit("not a year: "), F.col(column).cast("string"))).cast("int")
    )
    distinct = years.filter(F.col(column).isNotNull()).select(checked.alias(column)).distinct()
    return distinct.select(
        F.row_number().over(Window.orderBy(column)).cast("bigint").alias(key), column
    )


def calendar(
    spark: SparkSession, first_day, last_day, holidays: DataFrame, key: str = "day_key"
) -> DataFrame:
    """One row per day, both ends included, with parts and a holiday flag.

    The key is the position of the day, so no numbering pass is needed.
    """
    ends = spark.range(1).select(
        F.lit(first_day).cast("date").alias("first"), F.lit(last_day).cast("date").alias("last")
    )
    return calendar_between(ends, "first", "last", holidays, key)


def calendar_between(
    ends: DataFrame, first: str, last: str, holidays: DataFrame, key: str = "day_key"
) -> DataFrame:
    """Calendar between the two day columns of a one-row table."""
    days = ends.select(first, F.explode(F.sequence(first, last)).alias("day"))
    parts = day_parts(F.col("day"))
    rows = days.select(
        (F.datediff("day", first) + 1).cast("bigint").alias(key),
        "day",
        *[column.alias(name) for name, column in parts.items()],
    )
    return members_flag(rows, "day", holidays, "is_holiday")


def unknown_values(codes: Sequence[str], labels: Sequence[str], **others) -> Mapping:
    """Values of an unknown member: unknown code, unknown label, and the rest as given."""
    return {
        **{c: UNKNOWN_KEY for c in codes},
        **{c: UNKNOWN_LABEL for c in labels},
        **others,
    }
