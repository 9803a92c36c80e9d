"""Event and snapshot loads, and the facts built from them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from starmill.catalog.registry import query, table
from starmill.functions import compose_code, locale_number, strip_footnote
from starmill.operators.dimensions import calendar, code_list, year_dimension
from starmill.operators.facts import (
    count_events,
    event_fact,
    missing_entities,
    snapshot_load,
    snapshot_with_counts,
)
from starmill.operators.lookups import Lookup, join_large, resolve_or_drop
from starmill.operators.numbering import number_rows, number_stored, with_unknown
from starmill.plans.mart import death_fact, population_fact, year_table
from starmill.plans.model import WAREHOUSE
from starmill.plans.warehouse import (
    cause_rows,
    event_load,
    person_rows,
    staged_events,
    unseen_causes,
    unseen_persons,
)
from starmill.sources import BucketedTable, empty, scratch_folder, written
from starmill.sources.tables import dealt_evenly

STAMP = datetime(2024, 5, 1, 12, 30)

EVENTS_SQL = """
    WITH source AS (
      SELECT CAST(l_linenumber AS VARCHAR) AS number,
             CASE WHEN l_tax = 0.08 THEN NULL
                  ELSE 'V' || lpad(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), 2, '0')
                       || CASE WHEN l_linestatus = 'F' THEN '1' ELSE '' END END AS cause,
             CASE WHEN l_returnflag <> 'R' THEN '*R0' || l_linenumber || '2'
                  WHEN l_linestatus = 'F' THEN NULL
                  ELSE '*X' || l_linenumber END AS chain,
             CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(l_shipdate AS DATE) END AS died,
             CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS born,
             o_orderstatus AS sex, substr(o_orderpriority, 1, 1) AS race,
             CAST(length(c_mktsegment) AS VARCHAR) AS school,
             CASE WHEN o_orderstatus <> 'P' THEN '1' END AS marital,
             c_nationkey AS nation, l_linenumber, year(l_shipdate) AS shipped,
             CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN NULL
                  WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'N' THEN 2
                  ELSE 3 END AS circumstance
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      JOIN customer ON o_custkey = c_custkey),
    keyed AS (
      SELECT *,
             substr(md5(race || '|' || sex || '|' || coalesce(strftime(born, '%d%m%Y'), '-1')
               || '|' || school || '|' || coalesce(marital, '-1') || '|' || nation || '|'
               || (nation + 110000)), 1, 16) AS person,
             substr(cause, 1, 3) AS basic, substr(coalesce(chain, '*' || cause), 1, 4) AS terminal
      FROM source WHERE circumstance IS NOT NULL),
    coded AS (SELECT *, basic || terminal AS pair FROM keyed),
    persons AS (
      SELECT *, row_number() OVER (ORDER BY person) AS sk FROM (
        SELECT DISTINCT person, race, sex, born, school, marital, nation FROM coded)),
    causes AS (
      SELECT *, row_number() OVER (ORDER BY pair) AS sk FROM (
        SELECT DISTINCT pair, basic, terminal FROM coded WHERE pair IS NOT NULL)),
    towns AS (SELECT n_nationkey + 1 AS sk, n_nationkey + 110000 AS code FROM nation
              WHERE n_regionkey <> 4),
    catalogue AS (
      SELECT code, row_number() OVER (ORDER BY code) AS sk FROM (
        SELECT DISTINCT 'V' || lpad(CAST(CAST(l_quantity AS INTEGER) AS VARCHAR), 2, '0') AS code
        FROM lineitem WHERE l_quantity <= 40
        UNION SELECT DISTINCT 'R0' || l_linenumber FROM lineitem))
"""


def event_source(spark, folder):
    """Lines as a delivered event file: all text, lost zeros, blanks, mixed codes."""
    lines = dealt_evenly(table(spark, folder, "lineitem"), "l_orderkey", "l_linenumber")
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"
    )
    customers = table(spark, folder, "customer").select(
        "c_custkey", "c_mktsegment", "c_nationkey"
    )
    bought = join_large(orders, customers, "o_custkey", "c_custkey", ["o_orderkey"], "inner")
    joined = join_large(lines, bought, "l_orderkey", "o_orderkey", how="inner")

    def text(column):
        return column.cast("string")

    def year_text(day):
        year = F.year(day)
        plain = F.lpad(text(year), 4, "0")
        return F.when(year.between(1, 9999), plain).otherwise(F.date_format(day, "yyyy"))

    def day_text(day):
        return F.concat(text(F.dayofmonth(day)), F.lpad(text(F.month(day)), 2, "0"), year_text(day))

    number = F.col("l_linenumber")
    quantity = F.lpad(text(F.col("l_quantity").cast("int")), 2, "0")
    flag, line_status = F.col("l_returnflag"), F.col("l_linestatus")
    is_pending = F.col("o_orderstatus") == "P"
    return joined.select(
        text(number).alias("TIPOBITO"),
        F.when(
            F.col("l_tax") != 0.08,
            F.concat(F.lit("V"), quantity, F.when(line_status == "F", "1").otherwise("")),
        ).alias("CAUSABAS"),
        F.when(flag != "R", F.concat(F.lit("*R0"), text(number), F.lit("2*J18"))).alias("LINHAA"),
        F.when(line_status == "F", F.lit("sem marca")).alias("LINHAB"),
        F.concat(F.lit("*X"), text(number)).alias("LINHAC"),
        F.lit(None).cast("string").alias("LINHAD"),
        F.when(
            F.col("o_orderpriority") == "5-LOW",
            F.concat(F.lit("3102"), year_text("l_shipdate")),
        )
        .otherwise(day_text("l_shipdate"))
        .alias("DTOBITO"),
        F.when(~is_pending, F.concat(day_text("o_orderdate"), F.lit(".0"))).alias(
            "DTNASC"
        ),
        F.col("o_orderstatus").alias("SEXO"),
        F.concat(F.substring("o_orderpriority", 1, 1), F.lit(".0")).alias("RACACOR"),
        text(F.length("c_mktsegment")).alias("ESCFALAGR1"),
        F.when(~is_pending, F.lit("1")).alias("ESTCIV"),
        text(F.col("c_nationkey")).alias("OCUP"),
        text(F.col("c_nationkey") + 110000).alias("CODMUNNATU"),
        text(number + 110000).alias("CODMUNOCOR"),
        F.when(number == 7, F.lit("9")).when(number != 6, text(number)).alias("ACIDTRAB"),
        F.when((flag == "A") & (line_status == "F"), F.lit(None).cast("string"))
        .when(flag == "A", F.lit("1"))
        .when(flag == "N", F.lit("2"))
        .otherwise(F.lit("3"))
        .alias("CIRCOBITO"),
        F.when(number <= 5, text(number)).alias("TPOBITOCOR"),
        F.concat(F.lit("/in/lines_"), year_text("l_shipdate"), F.lit(".csv")).alias(
            "source_path"
        ),
    )


def stand_in_warehouse(spark, folder):
    """Lookup tables for the event load, out of code lists and the given tables."""
    nations = table(spark, folder, "nation")
    lines = table(spark, folder, "lineitem")
    quantity = F.lpad(F.col("l_quantity").cast("int").cast("string"), 2, "0")
    codes = (
        lines.filter("l_quantity <= 40")
        .select(F.concat(F.lit("V"), quantity).alias("CD_CID_CAUSA"))
        .union(lines.select(F.concat(F.lit("R0"), F.col("l_linenumber").cast("string"))))
        .distinct()
    )
    tables = {
        "DWCD_MUNICIPIO": nations.filter("n_regionkey <> 4").selectExpr(
            "n_nationkey + 1L AS SK_MUNICIPIO", "n_nationkey + 110000L AS CD_MUNICIPIO"
        ),
        "DWCD_OCUP": nations.filter("n_regionkey <> 0").selectExpr(
            "n_nationkey + 100L AS SK_OCUP", "CAST(n_nationkey AS BIGINT) AS CD_OCUP"
        ),
        "DWCD_CIDS": number_rows(codes, ["CD_CID_CAUSA"], "SK_CID").withColumn(
            "CD_CID_LINHA", F.concat(F.lit("*"), "CD_CID_CAUSA")
        ),
    }
    for name, listed, kind in (
        ("SEXO", ["F", "O"], "string"),
        ("RACACOR", [1, 2, 3, 4], "bigint"),
        ("ESCFAL", [8, 9, 10], "bigint"),
        ("ESTCIV", [1], "bigint"),
        ("CIRCOBITO", [1, 2], "bigint"),
        ("TPLOCOR", [1, 2, 3, 4, 5, 9], "bigint"),
    ):
        columns = f"SK_{name} bigint, CD_{name} {kind}"
        tables[f"DWCD_{name}"] = code_list(spark, [(c,) for c in listed], columns)
    for name in ("DWCD_PESSOA", "DWCD_CAUSAOBITO", "DWMV_OBITO"):
        tables[name] = empty(spark, WAREHOUSE[name].columns)
    return tables.__getitem__


def _staged(spark, folder):
    return staged_events(event_source(spark, folder))


@query(
    "event_movement",
    EVENTS_SQL
    + """
    SELECT CAST(coalesce(towns.sk, -1) AS BIGINT) AS SK_MUNICIPIO,
           coalesce(causes.sk, -1) AS SK_CAUSAOBITO, persons.sk AS SK_PESSOA,
           CAST(CASE WHEN circumstance < 3 THEN circumstance ELSE -1 END AS BIGINT)
             AS SK_CIRCOBITO,
           CAST(CASE WHEN l_linenumber <= 5 THEN l_linenumber ELSE -1 END AS BIGINT)
             AS SK_TPLOCOR,
           l_linenumber = 1 AS ST_ACIDTRAB, l_linenumber = 1 AS ST_FETAL, died AS DT_OBITO,
           '/in/lines_' || shipped || '.csv' AS ENTREGA
    FROM coded JOIN persons USING (person) LEFT JOIN causes USING (pair)
    LEFT JOIN towns ON towns.code = l_linenumber + 110000
    """,
)
def event_movement(spark, folder):
    """The whole event load: cleaning, new members, lookups, flags, event numbers."""
    return load(spark, folder).movement.drop("CD_OBITO", "DT_CARGA")


def load(spark, folder):
    return event_load(_staged(spark, folder), stand_in_warehouse(spark, folder), STAMP)


_MOVEMENT_SQL = (
    EVENTS_SQL
    + """,
    movement AS (
      SELECT CAST(coalesce(place.sk, -1) AS BIGINT) AS town_key,
             CAST(coalesce(birth.sk, -1) AS BIGINT) AS birth_key,
             coalesce(causes.sk, -1) AS cause_key, persons.sk AS person_key, died, l_linenumber,
             circumstance
      FROM coded JOIN persons USING (person) LEFT JOIN causes USING (pair)
      LEFT JOIN towns place ON place.code = l_linenumber + 110000
      LEFT JOIN towns birth ON birth.code = coded.nation + 110000)
"""
)


@query(
    "death_fact",
    _MOVEMENT_SQL
    + """
    SELECT person_key AS SK_PESSOA, town_key AS SK_LOCAL_OBITO, birth_key AS SK_LOCAL_NASC,
           cause_key AS SK_CAUSA,
           CAST(CASE WHEN died < DATE '2001-01-01'
                THEN date_diff('day', DATE '1995-01-01', died) + 1 ELSE -1 END AS BIGINT)
             AS SK_DT_OBITO,
           CAST(CASE WHEN circumstance < 3 THEN circumstance ELSE -1 END AS BIGINT)
             AS SK_CIRCOBITO,
           CAST(CASE WHEN l_linenumber <= 5 THEN l_linenumber ELSE -1 END AS BIGINT)
             AS SK_TPLOCOR,
           l_linenumber = 1 AS ST_ACIDTRAB,
           l_linenumber = 1 AS ST_FETAL, CAST(1 AS BIGINT) AS QTD_OBITO
    FROM movement
    """,
)
def death_fact_query(spark, folder):
    """Mart fact from loaded events: both place roles, days beyond the calendar."""
    loaded = load(spark, folder)
    no_holidays = empty(spark, "day date")
    days = calendar(spark, "1995-01-01", "2000-12-31", no_holidays, "SK_TEMPO_DIA")
    # Stored, as the mart finds them: Spark then knows their size.
    persons = written(with_unknown(loaded.persons, "SK_PESSOA", {"SK_MUNICIPIO": -1}), "persons")
    fact = death_fact(loaded.movement, persons, days.withColumnRenamed("day", "DATA"))
    return fact.drop("CD_OBITO")


@query(
    "population_fact",
    _MOVEMENT_SQL
    + """,
    population AS (
      SELECT CAST(year(l_shipdate) AS INTEGER) AS year, towns.sk AS town_key,
             count(*) * 1000 AS people
      FROM lineitem JOIN towns ON towns.code = l_linenumber + 110000
      WHERE year(l_shipdate) <> 1997 GROUP BY ALL),
    years AS (
      SELECT year, row_number() OVER (ORDER BY year) AS sk
      FROM (SELECT DISTINCT year FROM population)),
    deaths AS (
      SELECT year(died) AS year, town_key, count(*) AS n FROM movement
      WHERE died IS NOT NULL GROUP BY ALL)
    SELECT years.sk AS SK_TEMPO, CAST(town_key AS BIGINT) AS SK_LOCAL,
           people AS QTD_POPULACAO, coalesce(n, 0) AS QTD_MORTES
    FROM population JOIN years USING (year) LEFT JOIN deaths USING (year, town_key)
    """,
)
def population_fact_query(spark, folder):
    """Mart fact of people and deaths per year and place; one year has no estimate."""
    towns = stand_in_warehouse(spark, folder)("DWCD_MUNICIPIO")
    lines = table(spark, folder, "lineitem").select(
        F.year("l_shipdate").alias("ANO"), (F.col("l_linenumber") + 110000).alias("code")
    )
    # People per year and code first: the lookup then sees totals, not lines.
    totals = lines.filter("ANO <> 1997").groupBy("ANO", "code").agg(
        (F.count("*") * 1000).alias("QTD_POPULACAO")
    )
    town = Lookup(towns, "code", "CD_MUNICIPIO", "SK_MUNICIPIO", "SK_MUNICIPIO")
    population = written(resolve_or_drop(totals, town).drop("code"), "population")
    movement = load(spark, folder).movement
    return population_fact(population, movement, year_table(population))


@query(
    "event_numbers",
    """
    SELECT count(*) AS n_events, CAST(1 AS BIGINT) AS first_number, count(*) AS last_number,
           count(*) AS n_numbers
    FROM lineitem WHERE NOT (l_returnflag = 'A' AND l_linestatus = 'F')
    """,
)
def event_numbers(spark, folder):
    """Event numbers are dense: as many as events, from 1 to their count."""
    numbered = number_stored(_staged(spark, folder), "CD_OBITO")
    return numbered.agg(
        F.count("*").alias("n_events"),
        F.min("CD_OBITO").alias("first_number"),
        F.max("CD_OBITO").alias("last_number"),
        F.count_distinct("CD_OBITO").alias("n_numbers"),
    )


@query(
    "event_persons",
    EVENTS_SQL
    + """
    SELECT persons.sk AS SK_PESSOA, person AS CD_PESSOA,
           CAST(CASE sex WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE -1 END AS BIGINT) AS SK_SEXO,
           CAST(CASE WHEN race = '5' THEN '-1' ELSE race END AS BIGINT) AS SK_RACACOR,
           CAST(CAST(school AS INTEGER) - 7 AS BIGINT) AS SK_ESCFAL,
           CAST(coalesce(marital, '-1') AS BIGINT) AS SK_ESTCIV,
           CAST(coalesce(towns.sk, -1) AS BIGINT) AS SK_MUNICIPIO,
           CAST(CASE WHEN n_regionkey = 0 THEN -1 ELSE nation + 100 END AS BIGINT) AS SK_OCUP,
           born AS DT_NASC
    FROM persons JOIN nation ON n_nationkey = nation
    LEFT JOIN towns ON towns.code = nation + 110000
    """,
)
def event_persons(spark, folder):
    """New persons of the event load, with their six resolved keys."""
    read = stand_in_warehouse(spark, folder)
    unseen = unseen_persons(_staged(spark, folder), read)
    return person_rows(unseen, read, STAMP).drop("DT_CARGA", "CD_CONFERE")


@query(
    "event_causes",
    EVENTS_SQL
    + """
    SELECT causes.sk AS SK_CAUSAOBITO, pair AS CD_CAUSAOBITO,
           coalesce(a.sk, -1) AS SK_CIDBAS, coalesce(b.sk, -1) AS SK_CIDTERM
    FROM causes LEFT JOIN catalogue a ON a.code = basic
    LEFT JOIN catalogue b ON '*' || b.code = terminal
    """,
)
def event_causes(spark, folder):
    """New cause pairs of the event load: one catalogue in two roles."""
    read = stand_in_warehouse(spark, folder)
    unseen = unseen_causes(_staged(spark, folder), read)
    return cause_rows(unseen, read, STAMP).drop("DT_CARGA")


@query(
    "snapshot_load",
    """
    SELECT c_custkey AS place_key, CAST(year(o_orderdate) AS INTEGER) AS period,
           CAST(count(*) * 1234567 AS BIGINT) AS quantity
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE c_mktsegment <> 'BUILDING' GROUP BY 1, 2
    """,
)
def snapshot_load_query(spark, folder):
    """Quantities as printed numbers with footnotes, per composed place code and year."""
    orders = table(spark, folder, "orders")
    counts = orders.groupBy("o_custkey", F.year("o_orderdate").alias("period")).agg(
        F.translate(F.format_number(F.count("*") * 1234567, 2), ",.", ".,").alias("shown")
    )
    customers = table(spark, folder, "customer")
    # State 11 and a nine-digit town number: codes stay whole for every customer.
    delivered = counts.select(
        compose_code(F.lit("11.0"), F.col("o_custkey").cast("string"), 9, 20).alias("place_code"),
        "period",
        F.concat("shown", F.lit(" (1)")).alias("shown"),
    )
    places = customers.filter("c_mktsegment <> 'BUILDING'").select(
        F.col("c_custkey").alias("place_key"),
        (F.col("c_custkey") + 11_000_000_000).alias("code"),
    )
    return snapshot_load(
        delivered,
        Lookup(places, "place_code", "code", "place_key", "place_key"),
        locale_number(strip_footnote(F.col("shown"))),
        F.col("period"),
        ("period", "quantity"),
    )


@query(
    "event_fact",
    """
    SELECT l_orderkey AS order_key, o_custkey, CAST(l_linenumber AS INTEGER) AS l_linenumber,
           CAST(CASE WHEN l_shipdate < TIMESTAMP '2001-01-01'
                THEN date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) + 1
                ELSE -1 END AS BIGINT) AS day_key,
           CAST(1 AS BIGINT) AS n_events
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus <> 'P'
    """,
)
def event_fact_query(spark, folder):
    """Lines as events, orders as entities (some unknown), days beyond the calendar."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        "l_linenumber",
        F.col("l_shipdate").cast("date").alias("day"),
        F.concat_ws("/", "l_partkey", "l_suppkey", "l_linenumber").alias("row_id"),
    )
    orders = table(spark, folder, "orders").filter("o_orderstatus <> 'P'")
    entities = orders.select(F.col("o_orderkey").alias("order_key"), "o_custkey")
    days = calendar(spark, "1995-01-01", "2000-12-31", empty(spark, "holiday date"))
    fact = event_fact(
        lines, entities, "order_key", ["o_custkey"], days.withColumnRenamed("day", "calendar_day"),
        "day", "event_day_key", "calendar_day", "day_key", "row_id", "n_events",
    )
    return fact.drop("row_id").withColumnRenamed("event_day_key", "day_key")


@query(
    "event_fact_in_buckets",
    """
    SELECT l_orderkey % 1000 * CAST(l_linenumber > 2 AS INTEGER) AS entity, CAST(l_linenumber AS INTEGER) AS l_linenumber,
           o_custkey, CAST(1 AS BIGINT) AS n_events,
           CAST(CASE WHEN l_shipdate < TIMESTAMP '2001-01-01'
                THEN date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) + 1
                ELSE -1 END AS BIGINT) AS day_key
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey % 1000 * CAST(l_linenumber > 2 AS INTEGER)
    """,
)
def event_fact_in_buckets(spark, folder):
    """The event fact of movement and entities stored in buckets: no shuffle, though one entity
    holds almost a third of the events."""
    entity = (F.col("l_orderkey") % 1000 * (F.col("l_linenumber") > 2).cast("int")).alias("entity")
    lines = table(spark, folder, "lineitem").select(
        entity, "l_linenumber", F.col("l_shipdate").cast("date").alias("day")
    )
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("entity"), "o_custkey")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = []
    for name, rows in (("movement", lines), ("entities", orders)):
        kept = BucketedTable(spark, scratch_folder(spark, name), rows.schema, "entity", buckets)
        kept.append(rows)
        stored.append(kept.read())
    days = calendar(spark, "1995-01-01", "2000-12-31", empty(spark, "holiday date"))
    fact = event_fact(
        stored[0], stored[1], "entity", ["o_custkey"], days.withColumnRenamed("day", "calendar_day"),
        "day", "event_day_key", "calendar_day", "day_key", "", "n_events", in_buckets=True,
    )
    return fact.withColumnRenamed("event_day_key", "day_key")


@query(
    "event_rejects",
    """
    SELECT l_orderkey, count(*) AS n_rows FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
    GROUP BY 1
    """,
)
def event_rejects(spark, folder):
    """Events that the inner join of the event fact leaves out."""
    orders = table(spark, folder, "orders").filter("o_orderstatus <> 'P'")
    entities = orders.select(F.col("o_orderkey").alias("l_orderkey"))
    return missing_entities(table(spark, folder, "lineitem"), entities, "l_orderkey")


def snapshot(spark, folder):
    """Orders per year and nation as base measure, returned lines as events."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    placed = join_large(orders, customers, "o_custkey", "c_custkey", ["o_orderkey"], "inner")
    base = (
        placed.groupBy(F.year("o_orderdate").alias("year"), F.col("c_nationkey").alias("place"))
        .agg(F.count("*").alias("base"))
        .filter("year <> 1997")
    )
    returned = (
        table(spark, folder, "lineitem")
        .filter("l_returnflag = 'R'")
        .select("l_orderkey", F.col("l_shipdate").cast("date").alias("day"))
    )
    events = join_large(
        returned, placed.select("o_orderkey", F.col("c_nationkey").alias("place")),
        "l_orderkey", "o_orderkey", how="inner",
    )
    counts = count_events(events, F.year("day"), "place", "n_events")
    base = written(base, "base")
    years = year_dimension(base, "year", "year_key")
    return snapshot_with_counts(base, counts, years, "year_key", "place", "n_events")


SNAPSHOT_SQL = """
    WITH base AS (
      SELECT CAST(year(o_orderdate) AS INTEGER) AS year, c_nationkey AS place, count(*) AS base
      FROM orders JOIN customer ON o_custkey = c_custkey
      WHERE year(o_orderdate) <> 1997 GROUP BY 1, 2),
    years AS (
      SELECT year, row_number() OVER (ORDER BY year) AS year_key
      FROM (SELECT DISTINCT year FROM base)),
    counts AS (
      SELECT year(l_shipdate) AS year, c_nationkey AS place, count(*) AS n
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      JOIN customer ON o_custkey = c_custkey WHERE l_returnflag = 'R' GROUP BY 1, 2),
    snapshot AS (
      SELECT year_key, place, base, coalesce(n, 0) AS n_events
      FROM base JOIN years USING (year) LEFT JOIN counts USING (year, place))
"""


@query("snapshot_with_counts", SNAPSHOT_SQL + "SELECT * FROM snapshot")
def snapshot_with_counts_query(spark, folder):
    """Base measure with event counts; one year has no base and leaves."""
    return snapshot(spark, folder)
