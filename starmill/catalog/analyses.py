"""Mart analyses on the star tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmill.catalog.facts import SNAPSHOT_SQL, snapshot
from starmill.catalog.registry import query, table
from starmill.operators.dimensions import flatten_chain
from starmill.operators.lookups import join_large
from starmill.plans.analysis import (
    age_band,
    all_combinations,
    distinct_by_level,
    distinct_sketches,
    multi_level,
    poisson_regression,
    rate_per,
    relation,
    sketch_error,
    standardised_rate,
    top_groups,
    totals,
)
from starmill.sources import written


def _places(spark, folder):
    nations = table(spark, folder, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    return flatten_chain(nations, [(table(spark, folder, "region"), "r_regionkey")])


def _orders(spark, folder):
    """Orders as facts: year, status, and a count of one."""
    return table(spark, folder, "orders").select(
        "o_custkey",
        "o_orderstatus",
        F.year("o_orderdate").alias("year"),
        F.lit(1).alias("one"),
    )


def _customer_places(spark, folder):
    customers = table(spark, folder, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    return customers.join(_places(spark, folder), "n_nationkey")


@query(
    "mart_by_region",
    """
    SELECT r_name, n_name, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_orders
    FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY ALL
    """,
)
def mart_by_region(spark, folder):
    """Events by region, place and year."""
    dimension = (_customer_places(spark, folder), "o_custkey", "c_custkey")
    by = ["r_name", "n_name", "year"]
    return totals(_orders(spark, folder), [dimension], by, "one", "n_orders")


@query(
    "mart_by_group",
    """
    WITH born AS (
      SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS born FROM orders GROUP BY 1),
    aged AS (
      SELECT c_mktsegment, o_orderstatus,
             year(o_orderdate) - year(born)
               - CASE WHEN strftime(o_orderdate, '%m%d') < strftime(born, '%m%d')
                      THEN 1 ELSE 0 END AS age
      FROM orders JOIN born USING (o_custkey) JOIN customer ON o_custkey = c_custkey)
    SELECT c_mktsegment, o_orderstatus, CAST(floor(age / 2.0) * 2 AS INTEGER) AS age_band,
           count(*) AS n_orders
    FROM aged GROUP BY ALL
    """,
)
def mart_by_group(spark, folder):
    """Events by group and age band; a customer's first order counts as birth."""
    orders = table(spark, folder, "orders").select(
        "o_custkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("day")
    )
    # Orders per customer, day and status first, so both joins move counts.
    daily = orders.groupBy("o_custkey", "day", "o_orderstatus").agg(F.count("*").alias("n"))
    born = orders.groupBy("o_custkey").agg(F.min("day").alias("born"))
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment"
    )
    people = born.join(customers, "o_custkey")
    aged = daily.join(people, "o_custkey").select(
        "c_mktsegment",
        "o_orderstatus",
        age_band(F.col("born"), F.col("day"), 2).alias("age_band"),
        "n",
    )
    return aged.groupBy("c_mktsegment", "o_orderstatus", "age_band").agg(
        F.sum("n").alias("n_orders")
    )


@query(
    "mart_rate",
    SNAPSHOT_SQL
    + """
    SELECT n_name, CAST(round(sum(n_events) * 100000 / sum(base), 4) AS DOUBLE) AS rate
    FROM snapshot JOIN nation ON place = n_nationkey GROUP BY 1
    """,
)
def mart_rate(spark, folder):
    """Events per 100,000 of the base measure."""
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    joined = snapshot(spark, folder).join(nations, F.col("place") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(F.round(rate_per("n_events", "base"), 4).alias("rate"))


@query(
    "mart_relation",
    SNAPSHOT_SQL
    + """
    SELECT round(corr(a, b), 6) AS relation
    FROM (SELECT place, sum(n_events) AS a, sum(base) AS b FROM snapshot GROUP BY 1)
    """,
)
def mart_relation(spark, folder):
    """Correlation of events and base over places."""
    related = relation(snapshot(spark, folder), ["place"], "n_events", "base", "relation")
    return related.select(F.round("relation", 6).alias("relation"))


@query(
    "mart_rollup",
    """
    SELECT r_name, n_name, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_orders,
           CAST(grouping(r_name, n_name, CAST(year(o_orderdate) AS INTEGER)) AS INTEGER) AS level
    FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY ROLLUP (r_name, n_name, CAST(year(o_orderdate) AS INTEGER))
    """,
)
def mart_rollup(spark, folder):
    """Totals by region, by place within it, by year within that, and overall."""
    return multi_level(
        mart_by_region(spark, folder), ["r_name", "n_name", "year"], "n_orders", "n_orders"
    )


@query(
    "mart_cube",
    """
    SELECT r_name, o_orderstatus, count(*) AS n_orders,
           CAST(grouping(r_name, o_orderstatus) AS INTEGER) AS level
    FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY CUBE (r_name, o_orderstatus)
    """,
)
def mart_cube(spark, folder):
    """Totals for every combination of region and status."""
    dimension = (_customer_places(spark, folder), "o_custkey", "c_custkey")
    by = ["r_name", "o_orderstatus"]
    rows = totals(_orders(spark, folder), [dimension], by, "one", "n_orders")
    return all_combinations(rows, by, "n_orders", "n_orders")


def _placed_orders(spark, folder, *columns):
    """Orders per customer and the given columns, beside the customer's attributes."""
    counts = table(spark, folder, "orders").groupBy("o_custkey", *columns).agg(F.count("*").alias("n"))
    customers = _customer_places(spark, folder).select("c_custkey", "c_mktsegment", "n_name", "r_name")
    return join_large(counts, customers, "o_custkey", "c_custkey", how="inner")


@query(
    "mart_standard_rate",
    """
    WITH cells AS (
      SELECT n_name, c_mktsegment, count(*) FILTER (o_orderstatus = 'F') AS d, count(*) AS n
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
      GROUP BY ALL),
    weights AS (SELECT c_mktsegment, count(*) AS w FROM customer GROUP BY 1),
    rates AS (
      SELECT n_name, sum(d) AS events, sum(d) * 1000 / sum(n) AS crude,
             sum(w * d / n) * 1000 / sum(w) AS rate,
             sqrt(sum(w * w * d / (n * n))) * 1000 * 1.959964 / sum(w) AS spread
      FROM cells JOIN weights USING (c_mktsegment) GROUP BY 1)
    SELECT n_name, round(CAST(crude AS DOUBLE), 6) AS crude, round(rate, 6) AS rate,
           round(greatest(0, rate - spread), 6) AS low, round(rate + spread, 6) AS high,
           CAST(events AS BIGINT) AS events
    FROM rates
    """,
)
def mart_standard_rate(spark, folder):
    """Finished orders per 1,000, with the segments of every nation weighted alike."""
    placed = _placed_orders(spark, folder, "o_orderstatus")
    finished = F.when(F.col("o_orderstatus") == "F", F.col("n")).otherwise(0)
    cells = placed.withColumn("finished", finished)
    customers = table(spark, folder, "customer").groupBy("c_mktsegment").agg(F.count("*").alias("w"))
    rates = standardised_rate(cells, ["n_name"], "c_mktsegment", "finished", "n", customers, "w", 1000)
    shown = [F.round(c, 6).alias(c) for c in ("crude", "rate", "low", "high")]
    return rates.select("n_name", *shown, "events")


@query(
    "mart_top_groups",
    """
    WITH totals AS (
      SELECT r_name, n_name, c_mktsegment || ' ' || o_orderpriority AS who, count(*) AS n_orders,
             grouping(r_name) + grouping(n_name) AS level
      FROM orders JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
      GROUP BY GROUPING SETS ((r_name, n_name, who), (r_name, who), (who))),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY level, r_name, n_name ORDER BY n_orders DESC, who) AS rank
      FROM totals WHERE n_orders >= 5)
    SELECT CAST(level AS INTEGER) AS level, r_name, n_name, CAST(rank AS INTEGER) AS rank, who, n_orders
    FROM ranked WHERE rank <= 3
    """,
)
def mart_top_groups(spark, folder):
    """The three largest groups of each nation, of each region and of all; none below 5."""
    placed = _placed_orders(spark, folder, "o_orderpriority")
    who = placed.withColumn("who", F.concat_ws(" ", "c_mktsegment", "o_orderpriority"))
    return top_groups(who, ["r_name", "n_name"], "who", "n", "n_orders", 3, 5)


@query(
    "mart_distinct_persons",
    """
    SELECT r_name, n_name, o_orderstatus,
           CAST(grouping(r_name, n_name, o_orderstatus) AS INTEGER) AS level,
           count(DISTINCT o_custkey) AS exact, true AS within_bound
    FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY ROLLUP (r_name, n_name, o_orderstatus)
    """,
)
def mart_distinct_persons(spark, folder):
    """Distinct customers on every level out of stored sketches, beside the exact numbers.

    A customer has one nation, so exact numbers roll up by it; over statuses they do not.
    """
    placed = _placed_orders(spark, folder, "o_orderstatus")
    levels = ["r_name", "n_name", "o_orderstatus"]
    sketches = written(distinct_sketches(placed, levels, "o_custkey"), "sketches")
    counted = distinct_by_level(sketches, levels, "persons")
    exact = placed.rollup(*levels).agg(
        F.count_distinct("o_custkey").alias("exact"), F.grouping_id().cast("int").alias("__level")
    )
    exact = exact.withColumnsRenamed({c: f"__{c}" for c in levels})
    same = F.col("level") == F.col("__level")
    for c in levels:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    joined = counted.join(exact, same)
    off = F.abs(F.col("persons") - F.col("exact"))
    bound = F.greatest(F.lit(1.0), F.col("exact") * (4 * sketch_error(14)))
    return joined.select(*levels, "level", "exact", (off <= bound).alias("within_bound"))


@query(
    "mart_poisson",
    """
    WITH a AS (SELECT o_orderstatus AS v, count(*) AS n FROM orders GROUP BY 1),
    b AS (SELECT o_orderpriority AS v, count(*) AS n FROM orders GROUP BY 1),
    total AS (SELECT count(*) AS n FROM orders)
    SELECT 'intercept' AS term,
           round(ln((SELECT arg_min(n, v) FROM a) * (SELECT arg_min(n, v) FROM b) / (SELECT n FROM total)), 6)
             AS coefficient
    UNION ALL
    SELECT 'o_orderstatus=' || v, round(ln(n / (SELECT arg_min(n, v) FROM a)), 6)
    FROM a WHERE v > (SELECT min(v) FROM a)
    UNION ALL
    SELECT 'o_orderpriority=' || v, round(ln(n / (SELECT arg_min(n, v) FROM b)), 6)
    FROM b WHERE v > (SELECT min(v) FROM b)
    """,
)
def mart_poisson(spark, folder):
    """Orders by status and priority at once; with an even base the fit has a closed form."""
    factors = ["o_orderstatus", "o_orderpriority"]
    cells = table(spark, folder, "orders").groupBy(*factors).agg(F.count("*").alias("n"))
    fit = poisson_regression(cells.withColumn("base", F.lit(1)), factors, "n", "base")
    rows = [(term, round(value, 6)) for term, value in fit.coefficients.items()]
    return spark.createDataFrame(rows, "term string, coefficient double")
