"""Fact loads: events, periodic snapshots, and snapshots with event counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.operators.lookups import Lookup, join_in_buckets, join_large, resolve, resolve_or_drop


def event_fact(
    movement: DataFrame,
    entities: DataFrame,
    entity_key: str,
    pulled: Sequence[str],
    days: DataFrame,
    day: str,
    day_key: str,
    calendar_day: str,
    calendar_key: str,
    row_id: str,
    measure: str,
    in_buckets: bool = False,
) -> DataFrame:
    """Event fact: attributes pulled from a large entity, calendar key, count of 1.

    Movement and entity may both be large, and one entity (say, the one with every
    attribute missing) may hold a large share of the movement, hence the spread join; or,
    where both are stored in buckets of the entity's key, a join of buckets without a
    shuffle. Events without an entity leave the fact; ``missing_entities`` counts them.
    """
    wanted = entities.select(entity_key, *pulled)
    if in_buckets:
        joined = join_in_buckets(movement, wanted, entity_key)
    else:
        joined = join_large(movement, wanted, entity_key, entity_key, [row_id], "inner")
    dated = resolve(joined, [Lookup(days, day, calendar_day, calendar_key, day_key)])
    return dated.drop(day).withColumn(measure, F.lit(1).cast("bigint"))


def missing_entities(movement: DataFrame, entities: DataFrame, entity_key: str) -> DataFrame:
    """Events per entity key that has no entity: the rejects of ``event_fact``.

    Counting per key first leaves one row per key to join, however skewed the keys.
    """
    counts = movement.groupBy(entity_key).agg(F.count("*").alias("n_rows"))
    return counts.join(entities.select(entity_key), entity_key, "left_anti")


def count_events(events: DataFrame, year: Column, place: str, name: str) -> DataFrame:
    """Events per year and place, for events with a known day."""
    return (
        events.select(year.alias("year"), F.col(place))
        .filter(F.col("year").isNotNull())
        .groupBy("year", place)
        .agg(F.count("*").alias(name))
    )


def snapshot_with_counts(
    base: DataFrame,
    counts: DataFrame,
    years: DataFrame,
    year_key: str,
    place: str,
    count: str,
) -> DataFrame:
    """Base measure per year and place with the event count, 0 where none happened.

    Both sides have the grain (year, place) already, so no raw event is shuffled
    here. Years outside the year dimension leave both sides; events of a place or
    year without a base measure are not counted.
    """
    keyed_base = resolve_or_drop(base, Lookup(years, "year", "year", year_key, year_key))
    keyed_counts = resolve_or_drop(counts, Lookup(years, "year", "year", year_key, year_key))
    joined = keyed_base.drop("year").join(
        keyed_counts.select(year_key, place, count), [year_key, place], "left"
    )
    return joined.withColumn(count, F.coalesce(F.col(count), F.lit(0)).cast("bigint"))


def snapshot_load(
    source: DataFrame,
    place: Lookup,
    quantity: Column,
    period: Column,
    outputs: tuple[str, str],
    keep: Sequence[str] = (),
) -> DataFrame:
    """Periodic snapshot: cleaned quantity per place and period; unknown places leave."""
    period_name, quantity_name = outputs
    cleaned = source.select(
        place.source, period.alias(period_name), quantity.alias(quantity_name), *keep
    )
    return resolve_or_drop(cleaned, place).select(place.name, period_name, quantity_name, *keep)
