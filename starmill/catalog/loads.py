"""Event loads on a filled warehouse, and the mart dimensions built from loaded tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from starmill.catalog import facts
from starmill.catalog.registry import query, table
from starmill.operators.checks import key_collisions
from starmill.operators.dimensions import unseen_members, without_strangers
from starmill.operators.lookups import join_large
from starmill.plans.mart import (
    calendar_ends,
    cause_table,
    day_table,
    person_table,
    place_table,
    refresh_deaths_of,
    year_table,
)
from starmill.plans.model import REJECTS, WAREHOUSE, Table, checker, rule_counts
from starmill.plans.warehouse import POPULATION_COLUMNS, load_event_rows, load_population
from starmill.session import finer_tasks
from starmill.sources import BrokenRules, Tables, scratch_folder, written

_LOOKUPS = ("MUNICIPIO", "OCUP", "CIDS", "SEXO", "RACACOR", "ESCFAL", "ESTCIV", "CIRCOBITO", "TPLOCOR")


@query(
    "event_replay",
    facts.EVENTS_SQL
    + """,
    person_keys AS (
      SELECT person, row_number() OVER (ORDER BY min(shipped) > 1995, person) AS sk
      FROM coded GROUP BY person),
    cause_keys AS (
      SELECT pair, row_number() OVER (ORDER BY min(shipped) > 1995, pair) AS sk
      FROM coded WHERE pair IS NOT NULL GROUP BY pair)
    SELECT CAST(coalesce(towns.sk, -1) AS BIGINT) AS SK_MUNICIPIO,
           coalesce(cause_keys.sk, -1) AS SK_CAUSAOBITO, person_keys.sk AS SK_PESSOA,
           CAST(CASE WHEN circumstance < 3 THEN circumstance ELSE -1 END AS BIGINT)
             AS SK_CIRCOBITO,
           CAST(CASE WHEN l_linenumber <= 5 THEN l_linenumber ELSE -1 END AS BIGINT)
             AS SK_TPLOCOR,
           l_linenumber = 1 AS ST_ACIDTRAB, l_linenumber = 1 AS ST_FETAL, died AS DT_OBITO,
           '/in/lines_' || shipped || '.csv' AS ENTREGA, CAST(1 AS BIGINT) AS n_with_number
    FROM coded JOIN person_keys USING (person) LEFT JOIN cause_keys USING (pair)
    LEFT JOIN towns ON towns.code = l_linenumber + 110000
    """,
)
def event_replay(spark, folder):
    """Deliveries up to 1995 loaded, then all deliveries, then that of 1996 again.

    Keys of known members stay, new ones continue them, no event is doubled, and every
    event number is in use once.
    """
    tables = Tables(spark, scratch_folder(spark, "warehouse"))
    read = facts.stand_in_warehouse(spark, folder)
    for name in _LOOKUPS:
        tables.replace(f"DWCD_{name}", read(f"DWCD_{name}"))
    with finer_tasks(spark):
        delivered = written(facts.event_source(spark, folder), "delivered")
    year = F.regexp_extract("source_path", r"_(\d{4})", 1).cast("int")
    for rows in (delivered.filter(year <= 1995), delivered, delivered.filter(year == 1996)):
        load_event_rows(tables, rows, facts.STAMP)
    movement = tables.read("DWMV_OBITO", WAREHOUSE["DWMV_OBITO"].columns)
    same = F.count("*").over(Window.partitionBy("CD_OBITO"))
    return movement.withColumn("n_with_number", same).drop("CD_OBITO", "DT_CARGA")


@query(
    "person_dimension",
    facts.EVENTS_SQL
    + """
    SELECT persons.sk AS SK_PESSOA, person AS CD_PESSOA, born AS DT_NASC,
           CAST(coalesce(towns.sk, -1) AS BIGINT) AS SK_MUNICIPIO,
           CASE WHEN sex IN ('F', 'O') THEN sex ELSE '-1' END AS CD_SEXO,
           CASE WHEN sex IN ('F', 'O') THEN 'SEXO ' || sex ELSE 'Não Informado' END AS DS_SEXO,
           CAST(CASE WHEN race = '5' THEN '-1' ELSE race END AS BIGINT) AS CD_RACACOR,
           CASE WHEN race = '5' THEN 'Não Informado' ELSE 'RACACOR ' || race END AS DS_RACACOR,
           CAST(coalesce(marital, '-1') AS BIGINT) AS CD_ESTCIV,
           coalesce('ESTCIV ' || marital, 'Não Informado') AS DS_ESTCIV,
           CAST(CASE WHEN n_regionkey = 0 THEN -1 ELSE nation END AS BIGINT) AS CD_OCUP,
           CASE WHEN n_regionkey = 0 THEN 'Não Informado' ELSE 'OCUP ' || nation END AS DS_OCUP,
           CAST(school AS BIGINT) AS CD_ESCFAL, 'ESCFAL ' || school AS DS_ESCFAL
    FROM persons JOIN nation ON n_nationkey = nation
    LEFT JOIN towns ON towns.code = nation + 110000
    """,
)
def person_dimension(spark, folder):
    """Loaded persons with code and label of five attributes."""
    read = facts.stand_in_warehouse(spark, folder)
    domains = {
        name: read(f"DWCD_{name}").withColumn(
            f"DS_{name}", F.concat(F.lit(f"{name} "), F.col(f"CD_{name}").cast("string"))
        )
        for name in ("SEXO", "RACACOR", "ESTCIV", "OCUP", "ESCFAL")
    }
    flat = person_table(facts.load(spark, folder).persons, domains)
    return flat.drop("DT_CARGA", "CD_CONFERE", *[f"SK_{name}" for name in domains])


@query(
    "cause_dimension",
    facts.EVENTS_SQL
    + """
    SELECT causes.sk AS SK_CAUSA, pair AS CD_CAUSAOBITO,
           coalesce(a.code, 'Não Informado') AS CD_CID_BASICA,
           coalesce('cause ' || a.code, 'Não Informado') AS DS_CID_BASICA,
           coalesce(b.code, 'Não Informado') AS CD_CID_TERMINAL,
           coalesce('cause ' || b.code, 'Não Informado') AS DS_CID_TERMINAL
    FROM causes LEFT JOIN catalogue a ON a.code = basic
    LEFT JOIN catalogue b ON '*' || b.code = terminal
    """,
)
def cause_dimension(spark, folder):
    """Loaded cause pairs with code and label of both causes, from one catalogue."""
    catalogue = facts.stand_in_warehouse(spark, folder)("DWCD_CIDS").select(
        "SK_CID",
        F.col("CD_CID_CAUSA").alias("CD_CID"),
        F.concat(F.lit("cause "), "CD_CID_CAUSA").alias("DS_CID"),
    )
    flat = cause_table(facts.load(spark, folder).causes, catalogue)
    return flat.drop("DT_CARGA", "SK_CIDBAS", "SK_CIDTERM")


@query(
    "place_dimension",
    """
    SELECT CAST(c_custkey AS BIGINT) AS SK_LOCAL, CAST(c_custkey + 110000 AS BIGINT) AS CD_MUNICIPIO,
           c_name AS NM_MUNICIPIO, c_acctbal > 9000 AS ST_CAPITAL,
           CAST(n_nationkey AS BIGINT) AS CD_ESTADO, n_name AS NM_ESTADO,
           CAST(r_regionkey + 1 AS BIGINT) AS CD_REGIAO, r_name AS NM_REGIAO
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
)
def place_dimension(spark, folder):
    """Customers as towns of nations as states of regions, one row per town."""
    towns = table(spark, folder, "customer").selectExpr(
        "CAST(c_custkey AS BIGINT) AS SK_MUNICIPIO", "c_custkey + 110000L AS CD_MUNICIPIO",
        "c_name AS NM_MUNICIPIO", "c_acctbal > 9000 AS ST_CAPITAL",
        "c_nationkey + 1L AS SK_ESTADO", "current_timestamp() AS DT_CARGA",
    )
    states = table(spark, folder, "nation").selectExpr(
        "n_nationkey + 1L AS SK_ESTADO", "CAST(n_nationkey AS BIGINT) AS CD_ESTADO",
        "n_name AS NM_ESTADO", "n_regionkey + 1L AS SK_REGIAO", "current_timestamp() AS DT_CARGA",
    )
    regions = table(spark, folder, "region").selectExpr(
        "r_regionkey + 1L AS SK_REGIAO", "r_name AS NM_REGIAO", "current_timestamp() AS DT_CARGA"
    )
    return place_table(towns, states, regions)


@query(
    "day_dimension",
    """
    WITH ends AS (
      SELECT CAST(date_trunc('year', min(o_orderdate)) AS DATE) AS first,
             CAST(date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE)
               AS last
      FROM orders),
    days AS (
      SELECT first, CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS day
      FROM ends)
    SELECT CAST(date_diff('day', first, day) + 1 AS BIGINT) AS SK_TEMPO_DIA, day AS DATA,
           strftime(day, '%d') AS DIA, strftime(day, '%m') AS MES, strftime(day, '%Y') AS ANO,
           day IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_totalprice > 300000)
             AS ST_FERIADO
    FROM days
    """,
)
def day_dimension(spark, folder):
    """Calendar widened from one given year to the whole years of the orders."""
    orders = table(spark, folder, "orders").withColumn("DT_OBITO", F.col("o_orderdate").cast("date"))
    holidays = orders.filter("o_totalprice > 300000").select(F.col("DT_OBITO").alias("holiday"))
    ends = calendar_ends(orders, date(1995, 1, 1), date(1995, 12, 31))
    return day_table(spark, holidays.distinct(), *ends)


@query(
    "event_load_report",
    facts.EVENTS_SQL
    + """,
    movement AS (
      SELECT towns.sk AS town, causes.sk AS cause, circumstance, l_linenumber
      FROM coded LEFT JOIN causes USING (pair) LEFT JOIN towns ON towns.code = l_linenumber + 110000),
    counts AS (
      SELECT 'events read' AS step, 'rows' AS measure, count(*) AS n_rows FROM source
      UNION ALL SELECT 'events read', 'no_circumstance', count(*) FROM source WHERE circumstance IS NULL
      UNION ALL SELECT 'events read', 'surplus_fields', 0
      UNION ALL SELECT 'events read', 'missing_fields', 0
      UNION ALL SELECT 'events read', 'unread_day', count(*) FROM coded WHERE died IS NULL
      UNION ALL SELECT 'DWCD_PESSOA added', 'rows', count(*) FROM persons
      UNION ALL SELECT 'DWCD_CAUSAOBITO added', 'rows', count(*) FROM causes
      UNION ALL SELECT 'DWMV_OBITO stored', 'rows', count(*) FROM movement
      UNION ALL SELECT 'DWMV_OBITO stored', 'unknown_SK_MUNICIPIO', count(*) FROM movement WHERE town IS NULL
      UNION ALL SELECT 'DWMV_OBITO stored', 'unknown_SK_CAUSAOBITO', count(*) FROM movement WHERE cause IS NULL
      UNION ALL SELECT 'DWMV_OBITO stored', 'unknown_SK_PESSOA', 0
      UNION ALL SELECT 'DWMV_OBITO stored', 'unknown_SK_CIRCOBITO', count(*) FROM movement WHERE circumstance = 3
      UNION ALL SELECT 'DWMV_OBITO stored', 'unknown_SK_TPLOCOR', count(*) FROM movement WHERE l_linenumber > 5
      UNION ALL SELECT 'events rejected', 'rows', count(*) FROM source WHERE circumstance IS NULL)
    SELECT step, measure, CAST(n_rows AS BIGINT) AS n_rows FROM counts
    """,
)
def event_load_report(spark, folder):
    """Counts of an event load, all taken while its steps write their rows."""
    tables = Tables(spark, scratch_folder(spark, "warehouse"))
    read = facts.stand_in_warehouse(spark, folder)
    for name in _LOOKUPS:
        tables.replace(f"DWCD_{name}", read(f"DWCD_{name}"))
    load = load_event_rows(tables, facts.event_source(spark, folder), facts.STAMP)
    return load.report.frame()


@query(
    "population_rejects",
    """
    SELECT 'unknown town' AS reason,
           '11;' || c_nationkey * 10 || ';' || format('{:t.}', n * 1000) || ' (1)' AS line,
           CAST(year AS INTEGER) AS year
    FROM (SELECT c_nationkey, year(o_orderdate) AS year, count(*) AS n
          FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
    WHERE c_nationkey % 5 = 0
    """,
)
def population_rejects(spark, folder):
    """Estimates per year and nation as towns of one state; a fifth of the towns are unknown."""
    tables = Tables(spark, scratch_folder(spark, "warehouse"))
    towns = table(spark, folder, "nation").filter("n_nationkey % 5 <> 0").selectExpr(
        "n_nationkey + 1L AS SK_MUNICIPIO", "n_nationkey + 110000L AS CD_MUNICIPIO"
    )
    tables.replace("DWCD_MUNICIPIO", towns)
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, folder, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("year"))
    counts = join_large(orders.agg(F.count("*").alias("n")), customers, "o_custkey", "c_custkey", how="inner")
    counts = counts.groupBy("c_nationkey", "year").agg(
        F.translate(F.format_number(F.sum("n") * 1000, 0), ",", ".").alias("shown")
    )
    path = scratch_folder(spark, "estimates")
    # The last digit is a check digit, which the composed code leaves out.
    columns = [F.lit("11"), (F.col("c_nationkey") * 10).cast("string"), F.concat("shown", F.lit(" (1)"))]
    lines = counts.select(
        *[c.alias(n) for c, n in zip(columns, POPULATION_COLUMNS)],
        F.concat(F.lit("estimate_"), "year").alias("delivery"),
    )
    lines.write.partitionBy("delivery").csv(path, sep=";", header=True)
    load_population(tables, path, facts.STAMP)
    rejects = tables.read("DWRJ_POPULACAO", REJECTS["DWRJ_POPULACAO"])
    year = F.regexp_extract("ENTREGA", r"_(\d{4})$", 1).cast("int")
    return rejects.select(F.col("MOTIVO").alias("reason"), F.col("LINHA").alias("line"), year.alias("year"))


# Lines as a table with declared rules, some of which it breaks.
_LINE_TABLE = Table(
    "", ("l_orderkey", "l_linenumber"),
    {"l_orderkey": ("orders", "o_orderkey"), "l_partkey": ("part", "p_partkey")},
)


def _ruled_lines(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.nullif("l_returnflag", F.lit("R")).alias("flag")
    )
    parents = {
        "orders": table(spark, folder, "orders").filter("o_orderstatus <> 'P'"),
        "part": table(spark, folder, "part"),
    }
    return lines, parents.__getitem__


@query(
    "rules_in_one_aggregate",
    """
    SELECT 'missing flag' AS rule, count(*) AS n_rows FROM lineitem WHERE l_returnflag = 'R'
    UNION ALL
    SELECT 'reference l_orderkey', count(*) FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
    UNION ALL
    SELECT 'reference l_partkey', count(*) FROM lineitem
    WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
    UNION ALL
    SELECT 'key l_orderkey, l_linenumber',
           (SELECT count(*) FROM lineitem)
           - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
    UNION ALL
    SELECT unnest(['missing l_orderkey', 'missing l_linenumber', 'missing l_partkey']), 0
    """,
)
def rules_in_one_aggregate(spark, folder):
    """Rows that break each declared rule of a table, all counted in one aggregate."""
    lines, read = _ruled_lines(spark, folder)
    counts = rule_counts(_LINE_TABLE, lines, read)
    return counts.unpivot([], list(counts.columns), "rule", "n_rows").select(
        F.col("rule").cast("string").alias("rule"), "n_rows"
    )


@query(
    "refused_version",
    """
    SELECT l_orderkey, CAST(min(l_linenumber) AS INTEGER) AS l_linenumber, min(l_partkey) AS l_partkey,
           'x' AS flag
    FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
    GROUP BY l_orderkey
    """,
)
def refused_version(spark, folder):
    """A sound version is published; the whole lines, which break the rules, are refused after
    they were written, and readers stay with the sound one."""
    tables = Tables(spark, scratch_folder(spark, "tables"))
    lines, read = _ruled_lines(spark, folder)
    check = checker({"lines": _LINE_TABLE}, "lines", read)
    known = read("orders").select(F.col("o_orderkey").alias("l_orderkey"))
    sound = lines.join(known, "l_orderkey", "left_semi").groupBy("l_orderkey").agg(
        F.min("l_linenumber").cast("int").alias("l_linenumber"),
        F.min("l_partkey").alias("l_partkey"),
        F.lit("x").alias("flag"),
    )
    tables.replace("lines", sound, check)
    try:
        tables.replace("lines", lines, check)
    except BrokenRules as refused:
        if set(refused.broken) != {"missing flag", "reference l_orderkey", "key l_orderkey, l_linenumber"}:
            raise
    else:
        raise AssertionError("a version that breaks its rules was published")
    return tables.read("lines", "l_orderkey bigint, l_linenumber int, l_partkey bigint, flag string")


@query(
    "person_collisions",
    """
    WITH stored AS (
      SELECT c_custkey % 97 AS code, arg_min(c_mktsegment, c_custkey) AS segment,
             CAST(arg_min(c_nationkey, c_custkey) AS INTEGER) AS nation
      FROM customer WHERE c_custkey % 2 = 0 GROUP BY 1)
    SELECT c_custkey AS member, c_custkey % 97 AS code, c_mktsegment AS segment,
           CAST(c_nationkey AS INTEGER) AS nation
    FROM customer JOIN stored ON code = c_custkey % 97
    WHERE c_custkey % 2 = 1 AND (segment <> c_mktsegment OR nation <> c_nationkey)
    """,
)
def person_collisions(spark, folder):
    """Delivered members whose (here much too short) hash key is stored for another member."""
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("member"),
        (F.col("c_custkey") % 97).alias("code"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").cast("int").alias("nation"),
    )
    attributes = ["segment", "nation"]
    first = F.min_by(F.struct(*attributes), "member").alias("first")
    stored = customers.filter("member % 2 = 0").groupBy("code").agg(first).select("code", "first.*")
    return key_collisions(customers.filter("member % 2 = 1"), stored, "code", attributes)


@query(
    "unseen_without_shuffle",
    """
    SELECT o_custkey AS code, count(*) AS n_orders FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') GROUP BY 1
    """,
)
def unseen_without_shuffle(spark, folder):
    """Codes of a delivery that a large stored table lacks: a filter of the delivery's key hashes
    leaves most stored rows where they are, before the anti-join."""
    delivered = table(spark, folder, "orders").groupBy(F.col("o_custkey").alias("code")).agg(
        F.count("*").alias("n_orders")
    )
    stored = table(spark, folder, "customer").filter("c_mktsegment <> 'BUILDING'")
    members, known = without_strangers(delivered, stored.select(F.col("c_custkey").alias("code")), "code")
    return unseen_members(members, known, "code")


@query(
    "refresh_by_delivery",
    """
    WITH people AS (
      SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(l_linenumber AS BIGINT) AS place,
             count(*) * 1000 AS people
      FROM lineitem WHERE year(l_shipdate) <> 1997 GROUP BY ALL),
    years AS (SELECT year, row_number() OVER (ORDER BY year) AS sk FROM (SELECT DISTINCT year FROM people)),
    deaths AS (
      SELECT year(l_shipdate) AS year, CAST(l_linenumber AS BIGINT) AS place, count(*) AS n
      FROM lineitem
      WHERE (year(l_shipdate) <> 1996 OR l_returnflag = 'R') AND l_linestatus = 'F'
        AND year(l_shipdate) <> 1998
      GROUP BY ALL)
    SELECT sk AS SK_TEMPO, place AS SK_LOCAL, CAST(people AS BIGINT) AS QTD_POPULACAO, coalesce(n, 0) AS QTD_MORTES
    FROM people JOIN years USING (year) LEFT JOIN deaths USING (year, place)
    """,
)
def refresh_by_delivery(spark, folder):
    """Lines as deaths, a delivery per year. One delivery is corrected and one emptied; the
    counts are refreshed from these two deliveries and the stored totals of the others."""
    warehouse, mart = (Tables(spark, scratch_folder(spark, n)) for n in ("warehouse", "mart"))
    year = F.year("l_shipdate")
    lines = table(spark, folder, "lineitem").select(
        F.col("l_linenumber").cast("bigint").alias("SK_MUNICIPIO"),
        F.when(F.col("l_linestatus") == "F", F.col("l_shipdate").cast("date")).alias("DT_OBITO"),
        F.concat(F.lit("/in/lines_"), year, F.lit(".csv")).alias("ENTREGA"),
        "l_returnflag",
        year.alias("ANO"),
    )
    population = lines.filter("ANO <> 1997").groupBy("SK_MUNICIPIO", "ANO").agg(
        (F.count("*") * 1000).alias("QTD_POPULACAO")
    )
    warehouse.replace_deliveries(
        "DWMV_POPULACAO", population.withColumn("ENTREGA", F.lit("/in/all")), "ENTREGA"
    )
    years = year_table(population).withColumn("DT_CARGA", F.lit(facts.STAMP))
    mart.replace("DIME_TEMPO_ANO", years)
    mart.replace("DIME_LOCAL", population.select(F.col("SK_MUNICIPIO").alias("SK_LOCAL")).distinct())
    deaths = lines.drop("l_returnflag", "ANO")
    warehouse.replace_deliveries("DWMV_OBITO", deaths, "ENTREGA")
    every = [f"/in/lines_{y}.csv" for y in range(1990, 2010)]
    refresh_deaths_of(warehouse, mart, every, facts.STAMP)
    corrected = lines.filter("ANO = 1996 AND l_returnflag = 'R'").select(*deaths.columns)
    changed = ["/in/lines_1996.csv", "/in/lines_1998.csv"]
    warehouse.replace_deliveries("DWMV_OBITO", corrected, "ENTREGA", changed[1:])
    return refresh_deaths_of(warehouse, mart, changed, facts.STAMP).drop("DT_CARGA")
