"""Filters, recodes, dates, numbers and codes."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmill.catalog.registry import query, table
from starmill.functions import (
    business_key,
    code_prefix,
    code_text,
    compose_code,
    composite_code,
    day_parts,
    day_text,
    equals_flag,
    first_code_in_chain,
    known,
    locale_number,
    map_values,
    missing_as,
    parse_day,
    recode,
    strip_footnote,
    terminal_code,
    without_character,
    year_of_day_text,
    zero_pad,
)


@query(
    "present_filter",
    """
    SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS day
    FROM events WHERE event_type <> 'error'
    """,
)
def present_filter(spark, folder):
    events = table(spark, folder, "events")
    kind = F.nullif(F.col("event_type"), F.lit("error"))
    return events.filter(kind.isNotNull()).select(
        "event_id", "user_id", "event_type", F.col("ts").cast("date").alias("day")
    )


@query(
    "recode_default",
    """
    WITH coded AS (
      SELECT o_orderkey,
             CASE WHEN o_orderstatus <> 'P'
                  THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS code
      FROM orders)
    SELECT o_orderkey,
           CASE WHEN code IS NULL OR code = 5 THEN 2 ELSE code END AS recoded,
           CAST(coalesce(code, -1) AS INTEGER) AS filled,
           CASE WHEN code = 1 THEN 1 ELSE 0 END AS is_urgent
    FROM coded
    """,
)
def recode_default(spark, folder):
    orders = table(spark, folder, "orders")
    code = F.when(F.col("o_orderstatus") != "P", F.substring("o_orderpriority", 1, 1).cast("int"))
    return orders.select("o_orderkey", code.alias("code")).select(
        "o_orderkey",
        recode(F.col("code"), 2, {5: 2}).alias("recoded"),
        missing_as(F.col("code"), -1).alias("filled"),
        equals_flag(F.col("code"), 1).cast("int").alias("is_urgent"),
    )


@query(
    "pad_parse_date",
    """
    WITH texts AS (
      SELECT o_orderkey,
             CASE WHEN o_orderpriority = '5-LOW' THEN '3102' || strftime(o_orderdate, '%Y')
                  WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
                  ELSE CAST(day(o_orderdate) AS VARCHAR) || strftime(o_orderdate, '%m%Y') END
               AS raw
      FROM orders),
    padded AS (SELECT o_orderkey, lpad(raw, 8, '0') AS padded FROM texts),
    parsed AS (
      SELECT *, CAST(try_strptime(padded, '%d%m%Y') AS DATE) AS parsed FROM padded)
    SELECT o_orderkey, padded, parsed,
           coalesce(strftime(parsed, '%d-%m-%Y'), '-1') AS shown,
           strftime(parsed, '%d') AS day_part, strftime(parsed, '%m') AS month_part,
           strftime(parsed, '%Y') AS year_part
    FROM parsed
    """,
)
def pad_parse_date(spark, folder):
    orders = table(spark, folder, "orders")
    raw = (
        F.when(
            F.col("o_orderpriority") == "5-LOW",
            F.concat(F.lit("3102"), F.date_format("o_orderdate", "yyyy")),
        )
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None).cast("string"))
        .otherwise(F.date_format("o_orderdate", "dMMyyyy"))
    )
    texts = orders.select("o_orderkey", F.concat(raw, F.lit(".0")).alias("raw"))
    parsed = texts.select(
        "o_orderkey",
        zero_pad(code_text(F.col("raw")), 8).alias("padded"),
        parse_day(F.col("raw")).alias("parsed"),
    )
    parts = day_parts(F.col("parsed"))
    return parsed.select(
        "*",
        day_text(F.col("parsed")).alias("shown"),
        *[column.alias(f"{name.split("_")[0]}_part") for name, column in parts.items()],
    )


@query(
    "year_from_text",
    """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_orders
    FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' GROUP BY ALL
    """,
)
def year_from_text(spark, folder):
    orders = table(spark, folder, "orders")
    shown = (
        F.when(F.col("o_orderstatus") == "P", F.lit("-1"))
        .when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("string"))
        .otherwise(day_text(F.col("o_orderdate")))
    )
    return (
        orders.select(shown.alias("shown"))
        .filter(known(F.col("shown")))
        .groupBy(year_of_day_text(F.col("shown")).alias("year"))
        .agg(F.count("*").alias("n_orders"))
    )


@query(
    "compose_code",
    """
    WITH codes AS (
      SELECT c_custkey,
             CAST(c_nationkey + 11 AS VARCHAR) ||
             CASE WHEN length(CAST(c_custkey AS VARCHAR)) < 5
                  THEN lpad(CAST(c_custkey AS VARCHAR), 5, '0')
                  ELSE CAST(c_custkey AS VARCHAR) END AS code
      FROM customer)
    SELECT c_custkey, CAST(substr(code, 1, 6) AS BIGINT) AS place_code,
           substr(code, 1, 3) AS prefix
    FROM codes
    """,
)
def compose_code_query(spark, folder):
    customers = table(spark, folder, "customer")
    parent = (F.col("c_nationkey") + 11).cast("double").cast("string")
    child = F.col("c_custkey").cast("string")
    code = compose_code(parent, child, 5, 6)
    return customers.select(
        "c_custkey", code.alias("place_code"), code_prefix(code, 3).alias("prefix")
    )


@query(
    "first_code_in_chain",
    """
    WITH chains AS (
      SELECT p_partkey, p_brand, p_size,
             CASE WHEN p_type = 'LARGE' THEN NULL ELSE '*' || p_type || '*' || p_brand END AS a,
             CASE WHEN p_size > 25 THEN NULL ELSE '*' || upper(p_name) || '*X1*Y2' END AS b,
             CASE WHEN p_size > 40 THEN p_name END AS c
      FROM part),
    firsts AS (
      SELECT *, CASE WHEN a IS NOT NULL THEN split_part(a, '*', 2)
                     WHEN b IS NOT NULL THEN split_part(b, '*', 2) END AS found FROM chains)
    SELECT p_partkey, '*' || found AS first_code,
           substr('*' || coalesce(found, replace(p_brand, '#', '')), 1, 4) AS terminal,
           replace(p_brand, '#', '')
             || substr('*' || coalesce(found, replace(p_brand, '#', '')), 1, 4) AS pair
    FROM firsts
    """,
)
def first_code_query(spark, folder):
    parts = table(spark, folder, "part")
    chain = [
        F.when(F.col("p_type") != "LARGE", F.concat(F.lit("*"), "p_type", F.lit("*"), "p_brand")),
        F.when(F.col("p_size") <= 25, F.concat(F.lit("*"), F.upper("p_name"), F.lit("*X1*Y2"))),
        F.when(F.col("p_size") > 40, F.col("p_name")),
    ]
    basic = without_character(F.col("p_brand"), "#")
    terminal = terminal_code(chain, basic)
    return parts.select(
        "p_partkey",
        first_code_in_chain(chain).alias("first_code"),
        terminal.alias("terminal"),
        composite_code(basic, terminal).alias("pair"),
    )


@query(
    "locale_number",
    """
    SELECT c_custkey, CAST(trunc(c_acctbal) AS BIGINT) AS from_text,
           CAST(trunc(c_acctbal) AS BIGINT) AS from_number
    FROM customer
    """,
)
def locale_number_query(spark, folder):
    customers = table(spark, folder, "customer")
    shown = F.translate(F.format_number("c_acctbal", 2), ",.", ".,")
    marked = F.when(
        F.col("c_mktsegment") == "BUILDING", F.concat(shown, F.lit(" (1)"))
    ).otherwise(F.concat(F.lit(" "), shown))
    return customers.select(
        "c_custkey",
        locale_number(strip_footnote(marked)).alias("from_text"),
        locale_number(F.col("c_acctbal")).alias("from_number"),
    )


@query(
    "business_key",
    """
    SELECT c_custkey,
           substr(md5(coalesce(CAST(nullif(c_nationkey, 24) AS VARCHAR), '-1') || '|' ||
                      coalesce(nullif(c_mktsegment, 'BUILDING'), '-1') || '|' || c_name), 1, 16)
             AS person_code
    FROM customer
    """,
)
def business_key_query(spark, folder):
    customers = table(spark, folder, "customer")
    nation = F.nullif(F.col("c_nationkey"), F.lit(24)).cast("double").cast("string")
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return customers.select(
        "c_custkey",
        business_key([code_text(nation), code_text(segment), F.col("c_name")]).alias("person_code"),
    )


@query(
    "map_values",
    """
    SELECT c_custkey, n_name,
           CASE n_name WHEN 'NATION_0' THEN 'North' WHEN 'NATION_1' THEN 'South'
                       WHEN 'NATION_2' THEN 'East' END AS area
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    """,
)
def map_values_query(spark, folder):
    areas = {"NATION_0": "North", "NATION_1": "South", "NATION_2": "East"}
    customers = table(spark, folder, "customer")
    nations = table(spark, folder, "nation")
    joined = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select("c_custkey", "n_name", map_values(F.col("n_name"), areas).alias("area"))
