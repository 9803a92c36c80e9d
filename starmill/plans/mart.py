"""Full refresh of the star-schema mart from the warehouse."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.functions.values import UNKNOWN_KEY, UNKNOWN_LABEL, UNKNOWN_STAMP
from starmill.operators.dimensions import (
    calendar,
    flatten_chain,
    flatten_star,
    year_dimension,
)
from starmill.operators.facts import count_events, event_fact, snapshot_with_counts
from starmill.operators.numbering import with_unknown
from starmill.plans.model import MART, WAREHOUSE, checker
from starmill.sources import Tables, written
from starmill.sources.tables import stamped

# Deaths per delivery, year and place, kept beside the mart.
PARTIALS, PARTIALS_COLUMNS = "PARC_MORTES", "ANO int, SK_LOCAL bigint, QTD_MORTES bigint, ENTREGA string"
DELIVERY = "ENTREGA"

# The days the calendar covers.
FIRST_DAY = date(2018, 1, 1)
LAST_DAY = date(2024, 12, 31)


def year_table(population: DataFrame) -> DataFrame:
    return year_dimension(population, "ANO", "SK_TEMPO_ANO")


def place_table(towns: DataFrame, states: DataFrame, regions: DataFrame) -> DataFrame:
    flat = flatten_chain(
        towns.drop("DT_CARGA"),
        [(states.drop("DT_CARGA"), "SK_ESTADO"), (regions.drop("DT_CARGA"), "SK_REGIAO")],
    )
    return flat.select(
        F.col("SK_MUNICIPIO").alias("SK_LOCAL"),
        "CD_MUNICIPIO",
        "NM_MUNICIPIO",
        "ST_CAPITAL",
        "CD_ESTADO",
        "NM_ESTADO",
        F.col("SK_REGIAO").alias("CD_REGIAO"),
        "NM_REGIAO",
    )


def person_table(persons: DataFrame, domains: dict[str, DataFrame]) -> DataFrame:
    roles = []
    for name in ("SEXO", "RACACOR", "ESTCIV", "OCUP", "ESCFAL"):
        code = f"CD_{name}"
        unknown = str(UNKNOWN_KEY) if dict(domains[name].dtypes)[code] == "string" else UNKNOWN_KEY
        outputs = {code: (code, unknown), f"DS_{name}": (f"DS_{name}", UNKNOWN_LABEL)}
        roles.append((f"SK_{name}", domains[name], f"SK_{name}", outputs))
    return flatten_star(persons, roles)


def cause_table(causes: DataFrame, catalogue: DataFrame) -> DataFrame:
    roles = [
        (
            key,
            catalogue,
            "SK_CID",
            {
                f"CD_CID_{role}": ("CD_CID", UNKNOWN_LABEL),
                f"DS_CID_{role}": ("DS_CID", UNKNOWN_LABEL),
            },
        )
        for key, role in (("SK_CIDBAS", "BASICA"), ("SK_CIDTERM", "TERMINAL"))
    ]
    return flatten_star(causes, roles).withColumnRenamed("SK_CAUSAOBITO", "SK_CAUSA")


def calendar_ends(deaths: DataFrame, first_day: date, last_day: date) -> tuple[date, date]:
    """The given days, moved by whole years where deaths lie outside them."""
    days = deaths.agg(F.min("DT_OBITO").alias("first"), F.max("DT_OBITO").alias("last")).first()
    if days["first"] is None:
        return first_day, last_day
    return (
        min(first_day, date(days["first"].year, 1, 1)),
        max(last_day, date(days["last"].year, 12, 31)),
    )


def day_table(
    spark: SparkSession, holidays: DataFrame, first_day: date = FIRST_DAY, last_day: date = LAST_DAY
) -> DataFrame:
    """Days of the calendar, both ends included."""
    days = calendar(spark, first_day, last_day, holidays, "SK_TEMPO_DIA")
    return days.select(
        "SK_TEMPO_DIA",
        F.col("day").alias("DATA"),
        F.col("day_of_month").alias("DIA"),
        F.col("month").alias("MES"),
        F.col("year").alias("ANO"),
        F.col("is_holiday").alias("ST_FERIADO"),
    )


def death_partials(deaths: DataFrame) -> DataFrame:
    """Deaths per delivery, year and place: totals that add up over deliveries. Deaths on an
    unknown day have no year and no part."""
    return (
        deaths.select(
            F.year("DT_OBITO").alias("ANO"), F.col("SK_MUNICIPIO").alias("SK_LOCAL"), DELIVERY
        )
        .filter("ANO IS NOT NULL")
        .groupBy("ANO", "SK_LOCAL", DELIVERY)
        .agg(F.count("*").alias("QTD_MORTES"))
        .select(*[c.split()[0] for c in PARTIALS_COLUMNS.split(", ")])
    )


def population_fact(population: DataFrame, deaths: DataFrame, years: DataFrame) -> DataFrame:
    counts = count_events(
        deaths.withColumnRenamed("SK_MUNICIPIO", "SK_LOCAL"),
        F.year("DT_OBITO"),
        "SK_LOCAL",
        "QTD_MORTES",
    )
    return _population_fact(population, counts, years)


def population_fact_of_partials(
    population: DataFrame, partials: DataFrame, years: DataFrame
) -> DataFrame:
    """The same fact out of stored partial totals; no event is read."""
    counts = partials.groupBy(F.col("ANO").alias("year"), "SK_LOCAL").agg(
        F.sum("QTD_MORTES").alias("QTD_MORTES")
    )
    return _population_fact(population, counts, years)


def _population_fact(population: DataFrame, counts: DataFrame, years: DataFrame) -> DataFrame:
    base = population.select(
        F.col("ANO").alias("year"), F.col("SK_MUNICIPIO").alias("SK_LOCAL"), "QTD_POPULACAO"
    )
    keyed = years.withColumnsRenamed({"ANO": "year", "SK_TEMPO_ANO": "SK_TEMPO"})
    return snapshot_with_counts(base, counts, keyed, "SK_TEMPO", "SK_LOCAL", "QTD_MORTES")


def death_fact(deaths: DataFrame, persons: DataFrame, days: DataFrame) -> DataFrame:
    birthplace = persons.select("SK_PESSOA", F.col("SK_MUNICIPIO").alias("SK_LOCAL_NASC"))
    fact = event_fact(
        deaths.drop("DT_CARGA", "ENTREGA").withColumnsRenamed(
            {"SK_MUNICIPIO": "SK_LOCAL_OBITO", "SK_CAUSAOBITO": "SK_CAUSA"}
        ),
        birthplace,
        "SK_PESSOA",
        ["SK_LOCAL_NASC"],
        days.filter(F.col("DATA").isNotNull()),
        "DT_OBITO",
        "SK_DT_OBITO",
        "DATA",
        "SK_TEMPO_DIA",
        "CD_OBITO",
        "QTD_OBITO",
    )
    return fact


def _publish(mart: Tables, name: str, df: DataFrame, stamp: datetime) -> DataFrame:
    columns = [c.split()[0] for c in MART[name].columns.split(", ")]
    check = checker(MART, name, lambda parent: mart.read(parent, MART[parent].columns))
    return mart.replace(name, stamped(df, stamp).select(*columns), check)


def _store_partials(mart: Tables, deaths: DataFrame, deliveries: Sequence[str] | None) -> DataFrame:
    """Partial totals of some deliveries, or of all; those of deliveries without deaths go."""
    partials = written(death_partials(deaths), "partials")
    left = {r[0] for r in partials.select(DELIVERY).distinct().collect()}  # one row per file
    stored = mart.read(PARTIALS, PARTIALS_COLUMNS)
    if deliveries is None:
        deliveries = [r[0] for r in stored.select(DELIVERY).distinct().collect()]
    mart.replace_deliveries(PARTIALS, partials, DELIVERY, set(deliveries) - left)
    return mart.read(PARTIALS, PARTIALS_COLUMNS)


def refresh_deaths_of(
    warehouse: Tables, mart: Tables, deliveries: Sequence[str], stamp: datetime
) -> DataFrame:
    """Refresh the death counts of the population fact after deliveries were loaded again.

    Only the events of these deliveries are read, by their partitions; the others are in the
    stored partial totals. The totals are replaced first, and the fact is made from all of
    them, so a run that failed in between is simply repeated. Equals a full refresh of the
    fact as long as years and places are those of the mart.
    """
    deaths = warehouse.read("DWMV_OBITO", WAREHOUSE["DWMV_OBITO"].columns)
    changed = deaths.filter(F.col(DELIVERY).isin(list(deliveries)))
    partials = _store_partials(mart, changed, deliveries)
    population = warehouse.read("DWMV_POPULACAO", WAREHOUSE["DWMV_POPULACAO"].columns)
    years = mart.read("DIME_TEMPO_ANO", MART["DIME_TEMPO_ANO"].columns).drop("DT_CARGA")
    fact = population_fact_of_partials(population, partials, years)
    return _publish(mart, "FATO_POPULACAO", fact, stamp)


def refresh_mart(
    warehouse: Tables,
    root: str,
    holidays: DataFrame,
    stamp: datetime,
    first_day: date = FIRST_DAY,
    last_day: date = LAST_DAY,
) -> Tables:
    """Rebuild all mart tables. ``holidays`` is a one-column table of days. Each table is
    published once its new version keeps its declared rules, dimensions before facts.

    The calendar runs from ``first_day`` to ``last_day``, and over the whole years of
    deaths before and after them.
    """
    spark = warehouse.spark
    mart = Tables(spark, root)

    def source(name: str) -> DataFrame:
        return warehouse.read(name, WAREHOUSE[name].columns)

    def publish(name: str, df: DataFrame) -> DataFrame:
        return _publish(mart, name, df, stamp)

    population, deaths = source("DWMV_POPULACAO"), source("DWMV_OBITO")
    years = publish("DIME_TEMPO_ANO", year_table(population))
    publish("DIME_CIRCOBITO", source("DWCD_CIRCOBITO"))
    publish("DIME_TPLOCOR", source("DWCD_TPLOCOR"))
    publish(
        "DIME_LOCAL",
        place_table(source("DWCD_MUNICIPIO"), source("DWCD_ESTADO"), source("DWCD_REGIAO")),
    )
    domains = {n: source(f"DWCD_{n}") for n in ("SEXO", "RACACOR", "ESTCIV", "OCUP", "ESCFAL")}
    publish("DIME_PESSOA", person_table(source("DWCD_PESSOA"), domains))
    publish("DIME_CAUSA", cause_table(source("DWCD_CAUSAOBITO"), source("DWCD_CIDS")))
    unknown_day = {"ST_FERIADO": False, "DT_CARGA": UNKNOWN_STAMP}
    listed = day_table(spark, holidays, *calendar_ends(deaths, first_day, last_day))
    days = publish("DIME_TEMPO_DIA", with_unknown(listed, "SK_TEMPO_DIA", unknown_day))
    partials = _store_partials(mart, deaths, None)
    publish("FATO_POPULACAO", population_fact_of_partials(population, partials, years))
    publish("FATO_OBITO", death_fact(deaths, source("DWCD_PESSOA"), days))
    return mart
