"""Mart analyses: totals by place and group, rates, relations and multi-level totals."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.sources.scratch import written


def totals(
    facts: DataFrame,
    dimensions: Sequence[tuple[DataFrame, str, str]],
    by: Sequence[str],
    measure: str,
    name: str,
) -> DataFrame:
    """Sum of a measure by attributes of dimensions or of the facts themselves.

    Each dimension is (table, key in the facts, key in the table). The measure is summed
    per combination of keys before any join, so the joins move one row per combination
    instead of one per event, however many events a key holds.
    """
    own = [c for c in by if c in facts.columns]
    keys = [key for _, key, _ in dimensions]
    rows = facts.groupBy(*dict.fromkeys(keys + own)).agg(F.sum(measure).alias(name))
    for number, (table, key, table_key) in enumerate(dimensions):
        wanted = [c for c in table.columns if c in by and c not in own]
        dim = table.select(F.col(table_key).alias(f"__key_{number}"), *wanted)
        rows = rows.join(dim, F.col(key) == F.col(f"__key_{number}"), "inner")
    return rows.groupBy(*by).agg(F.sum(name).cast("bigint").alias(name))


def age_band(born: Column, day: Column, width: int = 10) -> Column:
    """First year of the age band at a day; null when either day is unknown."""
    before_birthday = F.month(day) * 100 + F.day(day) < F.month(born) * 100 + F.day(born)
    age = F.year(day) - F.year(born) - before_birthday.cast("int")
    return (F.floor(age / width) * width).cast("int")


def rate_per(events: str, base: str, per: int = 100_000) -> Column:
    """Aggregate: events per so many of the base; null where the base is 0."""
    return F.try_divide(F.sum(events) * F.lit(per), F.sum(base))


def relation(df: DataFrame, group: Sequence[str], first: str, second: str, name: str) -> DataFrame:
    """Correlation of two measures summed per group."""
    sums = df.groupBy(*group).agg(F.sum(first).alias("a"), F.sum(second).alias("b"))
    return sums.agg(F.corr("a", "b").alias(name))


def multi_level(df: DataFrame, levels: Sequence[str], measure: str, name: str) -> DataFrame:
    """Totals at every level of a hierarchy, the grand total included."""
    return _levels(_finest(df, levels, measure, name).rollup(*levels), name)


def all_combinations(df: DataFrame, by: Sequence[str], measure: str, name: str) -> DataFrame:
    """Totals for every subset of the attributes."""
    return _levels(_finest(df, by, measure, name).cube(*by), name)


def _finest(df: DataFrame, by: Sequence[str], measure: str, name: str) -> DataFrame:
    # Grouping sets repeat every input row once per set, so they get the totals of the
    # finest level, not the events.
    return df.groupBy(*by).agg(F.sum(measure).alias(name))


def _levels(grouped, name: str) -> DataFrame:
    return grouped.agg(
        F.sum(name).cast("bigint").alias(name), F.grouping_id().cast("int").alias("level")
    )


def standardised_rate(
    strata: DataFrame,
    group: Sequence[str],
    stratum: str,
    events: str,
    base: str,
    weights: DataFrame,
    weight: str,
    per: int = 100_000,
    z: float = 1.959964,
) -> DataFrame:
    """Directly standardised rates per group, with an interval for Poisson counts.

    ``strata`` has events and base per group and stratum (such as an age band), in any number
    of rows; ``weights`` the weight of each stratum, in any unit. A group's rate is the
    weighted mean of its rates per stratum over the strata in which it has a base. Columns:
    the group, ``crude``, ``rate``, ``low``, ``high`` (no less than 0), ``events``. The sums per
    group and stratum are made before the weights are joined. Strata without a weight, and
    groups without a base, have no part.
    """
    sums = strata.groupBy(*group, stratum).agg(F.sum(events).alias("__d"), F.sum(base).alias("__n"))
    listed = weights.groupBy(stratum).agg(F.sum(weight).cast("double").alias("__w"))
    cells = sums.filter("__n > 0").join(listed, stratum)
    share = F.col("__w") / F.col("__n")
    rates = cells.groupBy(*group).agg(
        F.sum("__d").alias("events"),
        F.sum("__n").alias("__base"),
        F.sum("__w").alias("__weight"),
        F.sum(share * F.col("__d")).alias("__rate"),
        F.sum(share * share * F.col("__d")).alias("__var"),
    )
    rate = F.try_divide(F.col("__rate") * per, F.col("__weight"))
    spread = F.try_divide(F.sqrt("__var") * (per * z), F.col("__weight"))
    return rates.select(
        *group,
        (F.col("events") * F.lit(per) / F.col("__base")).alias("crude"),
        rate.alias("rate"),
        F.greatest(F.lit(0.0), rate - spread).alias("low"),
        (rate + spread).alias("high"),
        F.col("events").cast("bigint").alias("events"),
    )


def top_groups(
    df: DataFrame,
    levels: Sequence[str],
    group: str,
    measure: str,
    name: str,
    count: int = 3,
    least: int = 5,
) -> DataFrame:
    """The groups with the highest totals within each member of each level, ranked.

    Totals per finest level and group are rolled up once; cells below ``least`` are left out
    before ranks are given, as small numbers of persons must not be shown. ``level`` is the
    number of levels that are rolled up (0: finest). Equal totals are ranked by group. Spark
    limits the rows of a rank in each task before they are shuffled.
    """
    finest = df.groupBy(*levels, group).agg(F.sum(measure).alias(name))
    above = [levels[: len(levels) - up] for up in range(len(levels) + 1)]
    sets = [[F.col(c) for c in [*kept, group]] for kept in above]
    totals = finest.groupingSets(sets, *levels, group).agg(
        F.sum(name).cast("bigint").alias(name), F.grouping_id().alias("__set")
    )
    up = F.lit(len(levels))
    for number, kept in enumerate(above):
        bits = sum(1 << (len(levels) - i) for i in range(len(kept), len(levels)))
        up = F.when(F.col("__set") == bits, number).otherwise(up)
    shown = totals.filter(F.col(name) >= least).withColumn("level", up.cast("int"))
    order = Window.partitionBy("level", *levels).orderBy(F.desc(name), F.col(group).asc_nulls_last())
    ranked = shown.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)
    return ranked.select("level", *levels, "rank", group, name)


def distinct_sketches(df: DataFrame, by: Sequence[str], entity: str, bits: int = 14) -> DataFrame:
    """Sketch of the distinct entities per finest combination, to be stored and merged.

    ``bits`` sets the size, 2 ** bits cells; the relative standard error is about
    ``sketch_error(bits)``. An entity in many rows costs no more than in one.
    """
    return df.groupBy(*by).agg(F.hll_sketch_agg(entity, bits).alias("sketch"))


def sketch_error(bits: int) -> float:
    """Relative standard error of a merged sketch, with a margin for its form."""
    return 1.04 / math.sqrt(2**bits) * 1.25


def distinct_by_level(sketches: DataFrame, levels: Sequence[str], name: str) -> DataFrame:
    """Distinct entities at every level of a hierarchy, out of stored sketches.

    Counts of distinct persons do not add up over levels; their sketches do.
    """
    merged = sketches.rollup(*levels).agg(
        F.hll_union_agg("sketch", True).alias("__union"), F.grouping_id().cast("int").alias("level")
    )
    return merged.select(*levels, "level", F.hll_sketch_estimate("__union").cast("bigint").alias(name))


@dataclass(frozen=True)
class PoissonFit:
    """Coefficients by term, the deviance of the fit, and how many steps it took."""

    coefficients: Mapping[str, float]
    errors: Mapping[str, float]
    deviance: float
    steps: int


def poisson_regression(
    cells: DataFrame,
    factors: Sequence[str],
    events: str,
    base: str,
    steps: int = 50,
    tolerance: float = 1e-10,
) -> PoissonFit:
    """Log-linear model of event rates on several factors at once.

    Each factor's smallest value is its reference; the terms are ``intercept`` and
    ``factor=value``. Rows are summed per combination of factors first and stored; a step of
    iteratively reweighted least squares is then one aggregate of k x k sums over these
    cells, k being the number of terms, so what reaches the driver does not grow with the rows.
    Cells without a base, or with a missing factor, have no part.
    """
    complete = cells.filter(" AND ".join(f"`{c}` IS NOT NULL" for c in factors))
    sums = complete.groupBy(*factors).agg(
        F.sum(events).cast("double").alias("__d"), F.sum(base).cast("double").alias("__n")
    )
    sums = written(sums.filter("__n > 0"), "cells")
    names, terms = ["intercept"], [F.lit(1.0)]
    for factor in factors:
        values = sorted(r[0] for r in sums.select(factor).distinct().collect())  # terms of the model
        names += [f"{factor}={value}" for value in values[1:]]
        terms += [(F.col(factor) == F.lit(value)).cast("double") for value in values[1:]]
    size = len(terms)
    total = sums.agg(F.sum("__d"), F.sum("__n")).first()
    if not total[1] or not total[0]:
        raise ValueError("a rate model needs events and a base")
    beta = np.zeros(size)
    beta[0] = math.log(total[0] / total[1])
    design = sums.select("__d", "__n", F.array(*terms).alias("__x"))
    before = math.inf
    for step in range(1, steps + 1):
        eta = F.aggregate(
            F.zip_with("__x", F.array(*[F.lit(float(b)) for b in beta]), lambda x, b: x * b),
            F.lit(0.0), lambda a, v: a + v,
        )
        fitted = design.withColumn("__eta", eta).withColumn("__mu", F.col("__n") * F.exp("__eta"))
        working = F.col("__mu") * F.col("__eta") + F.col("__d") - F.col("__mu")
        x = [F.col("__x")[i] for i in range(size)]
        squares = [F.sum(F.col("__mu") * x[i] * x[j]) for i in range(size) for j in range(i, size)]
        sides = [F.sum(working * x[i]) for i in range(size)]
        unfit = F.when(F.col("__d") > 0, F.col("__d") * F.ln(F.col("__d") / F.col("__mu"))).otherwise(0.0)
        deviance = 2 * F.sum(unfit - F.col("__d") + F.col("__mu"))
        row = fitted.agg(*[c.alias(f"c{i}") for i, c in enumerate([*squares, *sides, deviance])]).first()
        matrix, at = np.zeros((size, size)), 0
        for i in range(size):
            for j in range(i, size):
                matrix[i, j] = matrix[j, i] = row[at]
                at += 1
        inverse = np.linalg.pinv(matrix)
        beta = inverse @ np.array(row[at : at + size])
        if abs(before - row[-1]) <= tolerance * (abs(row[-1]) + tolerance):
            break
        before = row[-1]
    errors = np.sqrt(np.maximum(np.diag(inverse), 0))
    return PoissonFit(dict(zip(names, map(float, beta))), dict(zip(names, map(float, errors))), float(row[-1]), step)
