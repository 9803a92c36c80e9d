"""Code-to-key resolution and the joins that pull attributes.

A lookup table is broadcast only when Spark's size estimate allows it. Beyond that both
sides are shuffled, with the rows of heavy keys spread over many tasks: dirty or missing
codes put a large share of all facts on one key.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.functions.values import UNKNOWN_KEY

_SOURCE, _CODE, _VALUE, _SALT = "__source", "__code", "__value", "__salt"
_LITERAL_KEYS = 64
_TASK_GROUPS = 1024  # so many sketches at most meet in the last merge


@dataclass(frozen=True)
class Lookup:
    """Resolve ``source`` of the facts against ``code`` of a table, giving ``key``.

    ``unique`` states that the load of the table keeps its codes unique, so that a large
    table is not aggregated just to check it.
    """

    table: DataFrame
    source: str
    code: str
    key: str
    name: str
    unique: bool = False


def one_per_code(table: DataFrame, code: str, value: str) -> DataFrame:
    """(code, value) pairs, failing the job when a code occurs twice.

    A doubled code would multiply facts. The check runs inside the same job, as part
    of the aggregate that brings the table to one row per code.
    """
    doubled = F.concat(F.lit(f"{code} is not unique: "), F.col(code).cast("string"))
    return (
        table.filter(F.col(code).isNotNull())
        .groupBy(F.col(code))
        .agg(
            F.when(F.count("*") > 1, F.raise_error(doubled).cast(dict(table.dtypes)[value]))
            .otherwise(F.min(value))
            .alias(value)
        )
    )


def _pairs(facts: DataFrame, lookup: Lookup) -> tuple[DataFrame, bool]:
    """(code, value) pairs of a lookup, and whether the sides need one type: text."""
    kinds = dict(facts.dtypes)[lookup.source], dict(lookup.table.dtypes)[lookup.code]
    as_text = kinds[0] != kinds[1]
    pairs = lookup.table.select(lookup.code, lookup.key)
    if not lookup.unique:
        pairs = one_per_code(pairs, lookup.code, lookup.key)
    code = F.col(lookup.code).cast("string") if as_text else F.col(lookup.code)
    return pairs.select(code.alias(_CODE), F.col(lookup.key).alias(_VALUE)), as_text


def _resolved(facts: DataFrame, lookups: Sequence[Lookup], how: str, default) -> DataFrame:
    prepared = [(lookup, *_pairs(facts, lookup)) for lookup in lookups]
    large = [lookup.source for lookup, pairs, _ in prepared if not fits_broadcast(pairs)]
    # One pass over the facts as they come, not one per join over the joins before it.
    heavy = heavy_shares(facts, large) if large else {}
    for lookup, pairs, as_text in prepared:
        source = F.col(lookup.source)
        kept = [c for c in facts.columns if c != lookup.name]
        keyed = facts.withColumn(_SOURCE, source.cast("string") if as_text else source)
        listed = heavy.get(lookup.source)
        if listed is None:
            joined = keyed.join(pairs, F.col(_SOURCE) == F.col(_CODE), how)
        else:
            if as_text:
                listed = {None if v is None else str(v): share for v, share in listed.items()}
            joined = join_spreading_heavy(keyed, pairs, _SOURCE, _CODE, how=how, heavy=listed)
        value = F.col(_VALUE) if default is None else F.coalesce(_VALUE, F.lit(default))
        facts = joined.select(*kept, value.alias(lookup.name))
    return facts


def resolve(
    facts: DataFrame, lookups: Sequence[Lookup], default: int | None = UNKNOWN_KEY
) -> DataFrame:
    """Left-join each lookup; a miss gives the unknown key (or null for ``None``)."""
    return _resolved(facts, lookups, "left", default)


def resolve_or_drop(facts: DataFrame, lookup: Lookup) -> DataFrame:
    """Inner lookup: rows whose code is unknown leave the result."""
    return _resolved(facts, [lookup], "inner", None)


def flag_lookup(
    facts: DataFrame, source: str, flags: DataFrame, code: str, flag: str, name: str
) -> DataFrame:
    """1 where any row of the flag list marks the code, 0 where it is absent or unmarked."""
    marked = flags.groupBy(code).agg(
        F.max(F.coalesce(F.col(flag) == 1, F.lit(False)).cast("int")).alias(_VALUE)
    )
    return resolve(facts, [Lookup(marked, source, code, _VALUE, name, unique=True)], 0)


def members_flag(df: DataFrame, column: str, members: DataFrame, name: str) -> DataFrame:
    """Boolean: the value occurs in a one-column table."""
    listed = members.select(F.col(members.columns[0]).alias(_CODE)).distinct()
    marked = listed.withColumn(_VALUE, F.lit(True))
    lookup = Lookup(marked, column, _CODE, _VALUE, name, unique=True)
    return resolve(df, [lookup], False)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark, by its size estimate and threshold, would broadcast the frame."""
    threshold = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= threshold


def heavy_shares(df: DataFrame, columns: Sequence[str], limit: int = 64) -> dict[str, dict]:
    """Per column the values that hold the largest shares of the rows, with their shares.

    A value is heavy from half the rows of an even shuffle partition on, or from one in
    ``4 * limit`` rows where partitions are few; null counts as a value. Bounded frequency
    sketches per task are merged in groups of tasks and then once, in one pass with no
    shuffle of the values. The shares only steer a join; no row of a result depends on them.
    """
    partitions = _partitions(df)
    tracked = min(max(limit * 64, 16 * partitions), 1_000_000)
    listed = min(max(limit, 2 * partitions), tracked)
    sketches, merged = [], []
    for number, column in enumerate(columns):
        name = f"`{column}`"
        sketches += [
            F.expr(f"approx_top_k_accumulate({name}, {tracked})").alias(f"sketch_{number}"),
            F.count_if(F.col(name).isNull()).alias(f"nulls_{number}"),
        ]
        combined = f"approx_top_k_combine(sketch_{number}, {tracked})"
        merged += [
            F.expr(f"approx_top_k_estimate({combined}, {listed})").alias(f"top_{number}"),
            F.sum(f"nulls_{number}").alias(f"nulls_{number}"),
        ]
    tasks = df.select(*columns, (F.spark_partition_id() % _TASK_GROUPS).alias("__tasks"))
    grouped = tasks.groupBy("__tasks").agg(F.count("*").alias("rows"), *sketches)
    # Grouped by a constant: sketches of nothing, as of empty partitions, do not merge.
    row = grouped.groupBy(F.lit("all")).agg(F.sum("rows").alias("rows"), *merged).first()
    if row is None:
        return {column: {} for column in columns}
    rows = row["rows"]
    floor = min(rows / (limit * 4), rows / (2 * partitions))
    heavy: dict[str, dict] = {}
    for number, column in enumerate(columns):
        top = row[f"top_{number}"] or []
        counts = {t["item"]: t["count"] for t in top if t["item"] is not None and t["count"] >= floor}
        if (row[f"nulls_{number}"] or 0) > floor:
            counts[None] = row[f"nulls_{number}"]
        heavy[column] = {value: count / rows for value, count in counts.items()}
    return heavy


def heavy_values(df: DataFrame, columns: Sequence[str], limit: int = 64) -> dict[str, list]:
    """The values that ``heavy_shares`` finds, without their shares."""
    return {column: list(shares) for column, shares in heavy_shares(df, columns, limit).items()}


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _with_salts(df: DataFrame, key: str, shares: Mapping, partitions: int, name: str) -> DataFrame:
    """Add the number of salts of a key: a power of two by its share, 1 for keys not listed.

    A few keys are literals of the plan. More are a broadcast table: at most two rows per
    shuffle partition, however many partitions there are.
    """
    numbers = {
        value: min(partitions, 2 ** math.ceil(math.log2(max(2.0, 4 * share * partitions))))
        for value, share in shares.items()
        if value is not None
    }
    if len(numbers) > _LITERAL_KEYS:
        schema = f"__salted {dict(df.dtypes)[key]}, `{name}` int"
        listed = F.broadcast(df.sparkSession.createDataFrame(list(numbers.items()), schema))
        salted = df.join(listed, F.col(key) == F.col("__salted"), "left")
        return salted.select(*df.columns, F.coalesce(name, F.lit(1)).alias(name))
    groups: dict[int, list] = {}
    for value, number in numbers.items():
        groups.setdefault(number, []).append(value)
    number = F.lit(1)
    for salts, values in groups.items():
        number = F.when(F.col(key).isin(values), salts).otherwise(number)
    return df.withColumn(name, number)


def join_spreading_heavy(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    spread_by: Sequence[str] | None = None,
    how: str = "left",
    heavy: Mapping | Sequence | None = None,
) -> DataFrame:
    """Inner or left equi-join of two large tables in which a few keys hold many rows.

    ``right`` holds one row per key. Rows of a heavy key are spread over salts, as many
    as its share of the rows asks for, and the key's single right row is repeated once per
    salt. Other keys keep salt 0, so they are shuffled as usual. ``heavy`` gives the heavy
    keys, with their shares where known, at most two per shuffle partition.

    The salt is a hash of columns that differ within the key, by default of the task and
    all columns. It does not depend on the order of rows, so a retried task sends each
    row to the same place.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"join type {how!r} would repeat the salted right rows")
    values = [c for c in right.columns if c != right_key]
    dim = right.withColumnRenamed(right_key, "__right_key")
    match = F.col(left_key) == F.col("__right_key")
    if heavy is None:
        heavy = heavy_shares(left, [left_key])[left_key]
    if not heavy:
        return left.join(dim, match, how).select(*left.columns, *values)

    shares = heavy if isinstance(heavy, Mapping) else dict.fromkeys(heavy, 1.0)
    partitions = _partitions(left)
    spreading = spread_by or [F.spark_partition_id(), *left.columns]
    facts = _with_salts(left, left_key, shares, partitions, "__salts")
    salts = F.when(F.col(left_key).isNull(), partitions).otherwise(F.col("__salts"))
    facts = facts.withColumn("__left_salt", F.pmod(F.xxhash64(*spreading), salts).cast("int"))
    dim = _with_salts(dim, "__right_key", shares, partitions, "__salts_right")
    dim = dim.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.col("__salts_right") - 1)))
    match = match & (F.col("__left_salt") == F.col(_SALT))
    return facts.join(dim, match, how).select(*left.columns, *values)


def join_large(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    spread_by: Sequence[str] | None = None,
    how: str = "left",
) -> DataFrame:
    """Join to a table with one row per key that may be of any size.

    Small by estimate: a plain join, which Spark broadcasts. Else the spreading join.
    """
    heavy = [] if fits_broadcast(right) else None
    return join_spreading_heavy(left, right, left_key, right_key, spread_by, how, heavy)


def join_in_buckets(
    left: DataFrame, right: DataFrame, key: str, how: str = "inner", heavy: Sequence | None = None
) -> DataFrame:
    """Inner or left equi-join of two large tables that are stored in buckets of the key.

    Neither side is shuffled: bucket meets bucket. A heavy key would fill its bucket's task, so
    the rows of heavy keys leave that join and meet their few right rows by broadcast, in the
    splits in which they are read. ``right`` holds one row per key. ``heavy`` lists the heavy
    keys; without it one pass over the left keys finds them, at most two per bucket or
    shuffle partition.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"join type {how!r} would repeat right rows")
    if heavy is None:
        heavy = [v for v in heavy_values(left, [key])[key] if v is not None]
    if not heavy:
        return left.join(right, key, how)
    kind = dict(left.dtypes)[key]
    listed = left.sparkSession.createDataFrame([(v,) for v in heavy], f"`{key}` {kind}")
    cold = left.join(F.broadcast(listed), key, "left_anti").join(right, key, how)
    few = right.join(F.broadcast(listed), key, "left_semi")  # a row per heavy key
    hot = left.join(F.broadcast(listed), key, "left_semi").join(F.broadcast(few), key, how)
    return cold.unionByName(hot)
