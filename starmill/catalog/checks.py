"""Data checks and load reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmill.catalog.registry import query, table
from starmill.operators.checks import (
    first_rows,
    key_violations,
    load_report,
    null_counts,
    orphans,
    top_by_key,
)


@query(
    "pk_violations",
    """
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
    GROUP BY 1, 2 HAVING count(*) > 1
    """,
)
def pk_violations(spark, folder):
    return key_violations(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "unique_violations",
    "SELECT p_name, count(*) AS n_rows FROM part GROUP BY 1 HAVING count(*) > 1",
)
def unique_violations(spark, folder):
    return key_violations(table(spark, folder, "part"), ["p_name"])


@query(
    "fk_orphans",
    """
    SELECT l_partkey, count(*) AS n_rows FROM lineitem
    WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_type <> 'LARGE') GROUP BY 1
    """,
)
def fk_orphans(spark, folder):
    """Lines whose part is not in a list that lacks one type of part."""
    parts = table(spark, folder, "part").filter("p_type <> 'LARGE'")
    return orphans(table(spark, folder, "lineitem"), "l_partkey", parts, "p_partkey")


@query(
    "null_counts",
    """
    SELECT 'event_type' AS column_name, count(*) - count(nullif(event_type, 'error')) AS n_nulls
    FROM events
    UNION ALL SELECT 'user_id', count(*) - count(nullif(user_id, 1)) FROM events
    UNION ALL SELECT 'value', count(*) - count(value) FROM events
    """,
)
def null_counts_query(spark, folder):
    events = table(spark, folder, "events").select(
        F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"),
        F.nullif(F.col("user_id"), F.lit(1)).alias("user_id"),
        "value",
    )
    counts = null_counts(events, ["event_type", "user_id", "value"])
    return counts.select(F.col("column_name").cast("string").alias("column_name"), "n_nulls")


@query(
    "top_keys",
    "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey DESC LIMIT 5",
)
def top_keys(spark, folder):
    """The last five keys, as shown after a load."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return top_by_key(orders, "o_orderkey")


@query(
    "preview",
    """
    SELECT count(*) AS n_rows, count(*) AS n_known, count(DISTINCT o_orderkey) AS n_keys
    FROM (SELECT o_orderkey FROM orders LIMIT 5)
    """,
)
def preview(spark, folder):
    """A look at a table: which rows it shows is open, so it is counted that they are its own."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    shown = first_rows(orders, 5).groupBy("o_orderkey", "o_custkey").agg(F.count("*").alias("n"))
    known = shown.join(orders.withColumn("known", F.lit(1)), ["o_orderkey", "o_custkey"], "left")
    return known.agg(
        F.sum("n").alias("n_rows"),
        F.sum("known").cast("bigint").alias("n_known"),
        F.count_distinct("o_orderkey").alias("n_keys"),
    )


@query(
    "load_report",
    """
    SELECT 'orders' AS step, count(*) AS n_rows FROM orders
    UNION ALL SELECT 'lineitem', count(*) FROM lineitem
    UNION ALL SELECT 'returned', count(*) FROM lineitem WHERE l_returnflag = 'R'
    """,
)
def load_report_query(spark, folder):
    lines = table(spark, folder, "lineitem")
    return load_report(
        {
            "orders": table(spark, folder, "orders"),
            "lineitem": lines,
            "returned": lines.filter("l_returnflag = 'R'"),
        }
    )
