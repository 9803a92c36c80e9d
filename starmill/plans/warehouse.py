"""Loads of the public-health warehouse: code lists, catalogues, places, events."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.functions import (
    business_key,
    code_prefix,
    code_text,
    compose_code,
    composite_code,
    equals_flag,
    locale_number,
    map_values,
    parse_day,
    recode,
    terminal_code,
    whole_number,
    without_character,
    zero_pad,
)
from starmill.functions.values import UNKNOWN_KEY, UNKNOWN_STAMP, strip_footnote
from starmill.operators.checks import key_violations
from starmill.operators.dimensions import (
    ACTION,
    Level,
    code_list,
    hierarchy,
    insert_unseen,
    merge,
    new_members,
    unknown_values,
    upsert,
)
from starmill.operators.lookups import Lookup, flag_lookup, resolve
from starmill.operators.numbering import last_stored_key, number_stored, with_unknown
from starmill.operators.reports import LoadReport
from starmill.plans import code_lists
from starmill.plans.model import REJECTS, WAREHOUSE, checker, guarded
from starmill.session import finer_tasks, split_generated_code
from starmill.sources import (
    FileLedger,
    Tables,
    delivered_files,
    delivery_name,
    delivery_names,
    period_of_path,
    read_delimited,
    read_table_export,
    written,
    written_apart,
)
from starmill.sources.delimited import LINE, REASON, SHORT, SOURCE_PATH, SURPLUS
from starmill.sources.tables import stamped
from starmill.streaming import load_arrived_files

DELIVERY = "ENTREGA"
# Why a load leaves a row out.
NO_CIRCUMSTANCE, UNKNOWN_TOWN = "no circumstance", "unknown town"

# Column names of the delivered files.
EVENT_COLUMNS = [
    "TIPOBITO",
    "CAUSABAS",
    "DTOBITO",
    "CODMUNOCOR",
    "DTNASC",
    "SEXO",
    "RACACOR",
    "ESCFALAGR1",
    "ESTCIV",
    "OCUP",
    "ACIDTRAB",
    "CIRCOBITO",
    "TPOBITOCOR",
    "CODMUNNATU",
    "LINHAA",
    "LINHAB",
    "LINHAC",
    "LINHAD",
]
POPULATION_COLUMNS = ["COD. UF", "COD. MUNIC", "POPULAÇÃO ESTIMADA"]
CAUSE_COLUMNS = {"CAT": "CD_CID", "DESCRICAO": "DS_CID"}
OCCUPATION_COLUMNS = {"CODIGO": "CD_OCUP", "TITULO": "DS_OCUP"}
PLACE_COLUMNS = {
    "UF": "CD_ESTADO",
    "Nome_UF": "NM_ESTADO",
    "Código Município Completo": "CD_MUNICIPIO",
    "Nome_Município": "NM_MUNICIPIO",
}
CAPITAL_COLUMNS = ["codigo_ibge", "capital"]

Reader = Callable[[str], DataFrame]


def _read(tables: Tables, name: str) -> DataFrame:
    return tables.read(name, WAREHOUSE[name].columns)


def _publish(tables: Tables, name: str, df: DataFrame) -> None:
    """Replace a table by a version that keeps all its declared rules."""
    tables.replace(name, df, checker(WAREHOUSE, name, lambda parent: _read(tables, parent)))


def _domain_unknown(name: str) -> Mapping:
    return unknown_values([f"CD_{name}"], [f"DS_{name}"], DT_CARGA=UNKNOWN_STAMP)


def load_code_list(tables: Tables, name: str, rows: Sequence[tuple], stamp: datetime) -> None:
    """Domain load that only adds unseen codes."""
    columns = WAREHOUSE[f"DWCD_{name}"].columns.split(", DT_CARGA")[0]
    listed = stamped(code_list(tables.spark, rows, columns), stamp).drop(f"SK_{name}")
    existing = _read(tables, f"DWCD_{name}")
    loaded = insert_unseen(existing, listed, f"CD_{name}", f"SK_{name}")
    _publish(tables, f"DWCD_{name}", with_unknown(loaded, f"SK_{name}", _domain_unknown(name)))


def upsert_code_list(tables: Tables, name: str, rows: Sequence[tuple], stamp: datetime) -> None:
    """Domain load by position: labels of listed keys are refreshed."""
    columns = WAREHOUSE[f"DWCD_{name}"].columns.split(", DT_CARGA")[0]
    listed = stamped(code_list(tables.spark, rows, columns), stamp)
    loaded = upsert(_read(tables, f"DWCD_{name}"), listed, f"SK_{name}")
    _publish(tables, f"DWCD_{name}", with_unknown(loaded, f"SK_{name}", _domain_unknown(name)))


def load_code_lists(tables: Tables, stamp: datetime) -> None:
    load_code_list(tables, "CIRCOBITO", code_lists.CIRCUMSTANCES, stamp)
    upsert_code_list(tables, "ESCFAL", code_lists.SCHOOLING, stamp)
    load_code_list(tables, "ESTCIV", code_lists.MARITAL_STATUS, stamp)
    load_code_list(tables, "RACACOR", code_lists.RACES, stamp)
    upsert_code_list(tables, "SEXO", code_lists.SEXES, stamp)
    upsert_code_list(tables, "TPLOCOR", code_lists.PLACE_TYPES, stamp)


def load_causes(tables: Tables, paths: str | Sequence[str], stamp: datetime) -> DataFrame:
    """Merge the cause catalogue; returns the merge with its action column."""
    source = read_delimited(tables.spark, paths, CAUSE_COLUMNS, encoding="ISO-8859-1")
    plain = without_character(F.col("CD_CID"), ".")
    rows = stamped(
        source.select(
            "CD_CID",
            F.concat(F.lit("*"), plain).alias("CD_CID_LINHA"),
            plain.alias("CD_CID_CAUSA"),
            "DS_CID",
        ),
        stamp,
    )
    return _merge_catalogue(
        tables, "DWCD_CIDS", rows, "CD_CID", "SK_CID", "DS_CID",
        unknown_values([], ["DS_CID"], DT_CARGA=UNKNOWN_STAMP)
        | {c: str(UNKNOWN_KEY) for c in ("CD_CID", "CD_CID_LINHA", "CD_CID_CAUSA")},
    )


def load_occupations(tables: Tables, paths: str | Sequence[str], stamp: datetime) -> DataFrame:
    """Merge the occupation catalogue; returns the merge with its action column."""
    source = read_delimited(tables.spark, paths, OCCUPATION_COLUMNS, encoding="ISO-8859-1")
    rows = stamped(source.select(whole_number(F.col("CD_OCUP")).alias("CD_OCUP"), "DS_OCUP"), stamp)
    return _merge_catalogue(
        tables, "DWCD_OCUP", rows, "CD_OCUP", "SK_OCUP", "DS_OCUP", _domain_unknown("OCUP")
    )


def _merge_catalogue(tables, name, rows, code, key, label, unknown) -> DataFrame:
    merged = written(
        merge(_read(tables, name), rows, code, key, [label], ["DT_CARGA"]), "merged"
    )
    _publish(tables, name, with_unknown(merged.drop(ACTION), key, unknown))
    return merged


def load_places(
    tables: Tables,
    place_paths: str | Sequence[str],
    capital_paths: str | Sequence[str],
    stamp: datetime,
) -> None:
    """Regions, states and municipalities, each under its parent's key."""
    spark = tables.spark
    places = read_delimited(spark, place_paths, PLACE_COLUMNS)
    capitals = read_delimited(spark, capital_paths, CAPITAL_COLUMNS, sep=",").select(
        code_prefix(F.col("codigo_ibge"), 6).try_cast("bigint").alias("capital_code"),
        whole_number(F.col("capital")).alias("capital"),
    )
    regions = upsert(
        _read(tables, "DWCD_REGIAO"),
        stamped(code_list(spark, code_lists.REGIONS, "SK_REGIAO bigint, NM_REGIAO string"), stamp),
        "SK_REGIAO",
    )
    regions = with_unknown(
        regions, "SK_REGIAO", unknown_values([], ["NM_REGIAO"], DT_CARGA=UNKNOWN_STAMP)
    )

    state_rows = stamped(
        places.select(
            whole_number(F.col("CD_ESTADO")).alias("CD_ESTADO"),
            "NM_ESTADO",
            map_values(F.col("NM_ESTADO"), code_lists.REGION_OF_STATE).alias("region_name"),
        ),
        stamp,
    )
    state_rows = resolve(
        state_rows, [Lookup(regions, "region_name", "NM_REGIAO", "SK_REGIAO", "SK_REGIAO")]
    ).drop("region_name")
    town_rows = stamped(
        places.select(
            code_prefix(F.col("CD_MUNICIPIO"), 6).try_cast("bigint").alias("CD_MUNICIPIO"),
            whole_number(F.col("CD_ESTADO")).alias("CD_ESTADO"),
            "NM_MUNICIPIO",
        ),
        stamp,
    )
    town_rows = flag_lookup(
        town_rows, "CD_MUNICIPIO", capitals, "capital_code", "capital", "ST_CAPITAL"
    ).withColumn("ST_CAPITAL", F.col("ST_CAPITAL") == 1)
    states, towns = hierarchy(
        [
            Level(
                state_rows,
                _read(tables, "DWCD_ESTADO"),
                "CD_ESTADO",
                "SK_ESTADO",
                ["NM_ESTADO", "SK_REGIAO"],
                order_by=["NM_ESTADO"],
            ),
            Level(
                town_rows,
                _read(tables, "DWCD_MUNICIPIO"),
                "CD_MUNICIPIO",
                "SK_MUNICIPIO",
                ["NM_MUNICIPIO", "ST_CAPITAL"],
                parent_code="CD_ESTADO",
            ),
        ],
        "DT_CARGA",
    )
    _publish(tables, "DWCD_REGIAO", regions)
    _publish(
        tables,
        "DWCD_ESTADO",
        with_unknown(
            states,
            "SK_ESTADO",
            unknown_values(["CD_ESTADO", "SK_REGIAO"], ["NM_ESTADO"], DT_CARGA=UNKNOWN_STAMP),
        ),
    )
    _publish(
        tables,
        "DWCD_MUNICIPIO",
        with_unknown(
            towns,
            "SK_MUNICIPIO",
            unknown_values(
                ["CD_MUNICIPIO", "SK_ESTADO"],
                ["NM_MUNICIPIO"],
                ST_CAPITAL=False,
                DT_CARGA=UNKNOWN_STAMP,
            ),
        ),
    )


def population_rows(source: DataFrame, towns: DataFrame, stamp: datetime) -> DataFrame:
    """Population per municipality and year of the delivery; other rows have a ``MOTIVO``.

    Rows without a known town are marked and keep what was delivered in ``LINHA``.
    """
    state, town, quantity = (F.col(f"`{c}`") for c in POPULATION_COLUMNS)
    coded = source.select(
        compose_code(state, town, 5, 6).alias("town_code"),
        locale_number(strip_footnote(quantity)).alias("QTD_POPULACAO"),
        period_of_path(F.col(SOURCE_PATH)).alias("ANO"),
        F.concat_ws(";", state, town, quantity).alias("line"),
        delivery_name(F.col(SOURCE_PATH)).alias(DELIVERY),
    )
    town_key = Lookup(towns, "town_code", "CD_MUNICIPIO", "SK_MUNICIPIO", "SK_MUNICIPIO")
    keyed = resolve(coded, [town_key], None)
    lost = F.col("SK_MUNICIPIO").isNull()
    return stamped(keyed, stamp).select(
        "SK_MUNICIPIO", "ANO", "QTD_POPULACAO", "DT_CARGA", DELIVERY,
        F.when(lost, F.lit(UNKNOWN_TOWN)).alias("MOTIVO"),
        F.when(lost, F.col("line")).alias("LINHA"),
    )


def _store_rejects(
    tables: Tables, name: str, rejects: DataFrame, report: LoadReport, step: str, delivered: Iterable[str]
) -> None:
    """Keep what a load left out, per delivery; those of a delivery loaded again go."""
    columns = [c.split()[0] for c in REJECTS[name].split(", ")]
    rejects = rejects.select(*columns)
    left = {r[0] for r in rejects.select(DELIVERY).distinct().collect()}  # one row per file
    tables.replace_deliveries(
        name, report.counting(step, rejects), DELIVERY, set(delivered) - left
    )


def load_population(tables: Tables, paths: str | Sequence[str], stamp: datetime) -> LoadReport:
    """Population estimates; delivering a file again replaces it.

    Fails before anything is stored when a quantity or the year of a file cannot be read,
    or when two files state the same town and year. Rows of unknown towns are stored
    apart, with the reason. One pass over the files writes both and counts them.
    """
    report = LoadReport(tables.spark)
    source = read_table_export(tables.spark, paths, POPULATION_COLUMNS)
    delivered = delivery_names(source.inputFiles())
    rows = population_rows(source, _read(tables, "DWCD_MUNICIPIO"), stamp)
    left_out = F.col("MOTIVO").isNotNull()
    rows = report.counting("population read", rows, left_out=F.count_if(left_out))
    rows, rejects = written_apart(rows.withColumn("left_out", left_out), "left_out", "population")
    rows = rows.drop("MOTIVO", "LINHA")
    unread = rows.filter(F.col("ANO").isNull() | F.col("QTD_POPULACAO").isNull())
    bad = unread.select(DELIVERY).first()
    if bad:
        raise ValueError(f"unreadable year or quantity in {bad[0]}")
    replaced = tables.spark.createDataFrame([(d,) for d in sorted(delivered)], f"{DELIVERY} string")
    stored = _read(tables, "DWMV_POPULACAO").join(replaced, DELIVERY, "left_anti")
    key = ["SK_MUNICIPIO", "ANO"]
    twice = key_violations(stored.select(key).unionByName(rows.select(key)), key).first()
    if twice:
        raise ValueError(f"town and year stated twice: {twice.asDict()}")
    kept = {r[0] for r in rows.select(DELIVERY).distinct().collect()}  # one row per file
    counted = report.counting("population stored", guarded(rows, "DWMV_POPULACAO"))
    tables.replace_deliveries("DWMV_POPULACAO", counted, DELIVERY, delivered - kept)
    _store_rejects(tables, "DWRJ_POPULACAO", rejects, report, "population rejected", delivered)
    return report


def clean_events(source: DataFrame, by_file: bool = False) -> DataFrame:
    """Event rows with a known circumstance, codes in canonical text, keys derived.

    A row's delivery is its file or folder, or always its file with ``by_file``.
    """
    marked = marked_events(source, by_file)
    return marked.filter(F.col("MOTIVO").isNull()).drop("MOTIVO", "LINHA", "unread_day")


def marked_events(source: DataFrame, by_file: bool = False) -> DataFrame:
    """All delivered event rows, cleaned; those to leave out have a ``MOTIVO`` and, in
    ``LINHA``, what was delivered. ``unread_day`` marks a day of death that is no day.

    Left out are rows that do not fit their header, where the reader marked them, and rows
    without a circumstance.

    Two steps: the second names cleaned codes again, and Spark evaluates the columns of
    the first step once. Birth days stay text here; only new persons need them parsed.
    """
    codes = [
        "SEXO", "RACACOR", "ESCFALAGR1", "ESTCIV", "OCUP", "CODMUNNATU", "CODMUNOCOR",
        "CIRCOBITO", "TPOBITOCOR",
    ]
    chain = [F.col(f"LINHA{letter}") for letter in "ABCD"]
    ragged = F.col(REASON) if REASON in source.columns else F.lit(None).cast("string")
    line = F.col(LINE) if LINE in source.columns else F.lit(None).cast("string")
    reason = F.coalesce(ragged, F.when(F.col("CIRCOBITO").isNull(), F.lit(NO_CIRCUMSTANCE)))
    delivered = F.to_json(F.struct(*EVENT_COLUMNS))
    cleaned = source.select(
        reason.alias("MOTIVO"),
        F.when(reason.isNotNull(), F.coalesce(line, delivered)).alias("LINHA"),
        F.col("DTOBITO").isNotNull().alias("has_day"),
        *[code_text(F.col(name)).alias(name) for name in codes],
        zero_pad(whole_number(F.col("DTNASC")), 8).alias("birth_text"),
        parse_day(F.col("DTOBITO")).alias("DT_OBITO"),
        code_prefix(F.col("CAUSABAS"), 3).alias("basic_code"),
        terminal_code(chain, F.col("CAUSABAS")).alias("terminal_code"),
        equals_flag(recode(whole_number(F.col("ACIDTRAB")), 2, {9: 2}), 1).alias("ST_ACIDTRAB"),
        equals_flag(whole_number(F.col("TIPOBITO")), 1).alias("ST_FETAL"),
        (F.col(SOURCE_PATH) if by_file else delivery_name(F.col(SOURCE_PATH))).alias(DELIVERY),
    )
    person = [
        F.col("RACACOR"),
        F.col("SEXO"),
        F.col("birth_text"),
        F.col("ESCFALAGR1"),
        F.col("ESTCIV"),
        F.col("OCUP"),
        F.col("CODMUNNATU"),
    ]
    return cleaned.select(
        *[c for c in cleaned.columns if c != "has_day"],
        (F.col("has_day") & F.col("DT_OBITO").isNull()).alias("unread_day"),
        business_key(person).alias("CD_PESSOA"),
        composite_code(F.col("basic_code"), F.col("terminal_code")).alias("CD_CAUSAOBITO"),
    )


def _code_key(read: Reader, name: str, source: str) -> Lookup:
    return Lookup(read(f"DWCD_{name}"), source, f"CD_{name}", f"SK_{name}", f"SK_{name}")


def unseen_persons(events: DataFrame, read: Reader, after: int | None = None) -> DataFrame:
    """Numbered persons of the events that the warehouse lacks.

    Two persons under one hash key fail the job, be they of this delivery or one of them
    stored: ``CD_CONFERE`` is a second hash of their attributes. The text ``-1`` and a missing
    value are one value to the key, so they are one here.
    """
    attributes = ["SEXO", "RACACOR", "ESCFALAGR1", "ESTCIV", "OCUP", "CODMUNNATU", "birth_text"]
    unknown = F.lit(str(UNKNOWN_KEY))
    persons = events.select("CD_PESSOA", *[F.nullif(F.col(c), unknown).alias(c) for c in attributes])
    parts = [F.coalesce(F.col(c), unknown) for c in attributes]
    persons = persons.withColumn("CD_CONFERE", F.xxhash64(*parts))
    return new_members(
        read("DWCD_PESSOA"), persons, "CD_PESSOA", "SK_PESSOA", after, alike=True, fingerprint="CD_CONFERE"
    )


def person_rows(unseen: DataFrame, read: Reader, stamp: datetime) -> DataFrame:
    """New persons with the keys of their six attributes."""
    keyed = resolve(
        unseen.withColumn("DT_NASC", parse_day(F.col("birth_text"))),
        [
            _code_key(read, "SEXO", "SEXO"),
            _code_key(read, "RACACOR", "RACACOR"),
            _code_key(read, "ESCFAL", "ESCFALAGR1"),
            _code_key(read, "ESTCIV", "ESTCIV"),
            _code_key(read, "MUNICIPIO", "CODMUNNATU"),
            _code_key(read, "OCUP", "OCUP"),
        ],
    )
    return stamped(keyed, stamp).select(*read("DWCD_PESSOA").columns)


def unseen_causes(events: DataFrame, read: Reader, after: int | None = None) -> DataFrame:
    """Numbered cause pairs of the events that the warehouse lacks."""
    pairs = events.select("CD_CAUSAOBITO", "basic_code", "terminal_code")
    known = read("DWCD_CAUSAOBITO")
    return new_members(known, pairs, "CD_CAUSAOBITO", "SK_CAUSAOBITO", after)


def cause_rows(unseen: DataFrame, read: Reader, stamp: datetime) -> DataFrame:
    """New cause pairs with the keys of both causes in the one catalogue."""
    catalogue = read("DWCD_CIDS")
    keyed = resolve(
        unseen,
        [
            Lookup(catalogue, "basic_code", "CD_CID_CAUSA", "SK_CID", "SK_CIDBAS"),
            Lookup(catalogue, "terminal_code", "CD_CID_LINHA", "SK_CID", "SK_CIDTERM"),
        ],
    )
    return stamped(keyed, stamp).select(*read("DWCD_CAUSAOBITO").columns)


def movement_rows(
    events: DataFrame,
    persons: DataFrame,
    causes: DataFrame,
    read: Reader,
    stamp: datetime,
    after: int,
) -> DataFrame:
    """Numbered events with all keys, the new members' among them.

    ``events`` must be stored: an event's number is its place in the stored files.
    """
    keyed = number_stored(
        events.select(
            "CD_PESSOA", "CD_CAUSAOBITO", "CODMUNOCOR", "CIRCOBITO", "TPOBITOCOR",
            "ST_ACIDTRAB", "ST_FETAL", "DT_OBITO", DELIVERY,
        ),
        "CD_OBITO",
        after,
    )

    def every(name: str, added: DataFrame) -> DataFrame:
        columns = [f"CD_{name}", f"SK_{name}"]
        return read(f"DWCD_{name}").select(columns).unionByName(added.select(columns))

    def member(name: str, added: DataFrame) -> Lookup:
        code, key = f"CD_{name}", f"SK_{name}"
        return Lookup(every(name, added), code, code, key, key, unique=True)

    movement = resolve(
        keyed,
        [
            member("PESSOA", persons),
            member("CAUSAOBITO", causes),
            _code_key(read, "CIRCOBITO", "CIRCOBITO"),
            _code_key(read, "TPLOCOR", "TPOBITOCOR"),
            _code_key(read, "MUNICIPIO", "CODMUNOCOR"),
        ],
    )
    columns = [c.split()[0] for c in WAREHOUSE["DWMV_OBITO"].columns.split(", ")]
    return stamped(movement, stamp).select(*columns)


@dataclass(frozen=True)
class EventLoad:
    """What one delivery of events adds: new persons, new causes, and the movement."""

    persons: DataFrame
    causes: DataFrame
    movement: DataFrame
    report: LoadReport | None = None


@dataclass(frozen=True)
class StagedEvents:
    """Cleaned events, written once, and beside them the rows that were left out."""

    events: DataFrame
    rejects: DataFrame


def stage_events(source: DataFrame, report: LoadReport, by_file: bool = False) -> StagedEvents:
    """Clean, count and write all delivered rows in one pass.

    Three steps use the events, and their place in the files numbers them without a shuffle.
    """
    marked = marked_events(source, by_file)
    left_out = F.col("MOTIVO").isNotNull()
    reasons = {
        r.replace(" ", "_"): F.count_if(F.col("MOTIVO") == r) for r in (NO_CIRCUMSTANCE, SURPLUS, SHORT)
    }
    unread = F.count_if(F.col("unread_day") & ~left_out)
    counted = report.counting("events read", marked, **reasons, unread_day=unread)
    flagged = counted.drop("unread_day").withColumn("left_out", left_out)
    with split_generated_code(source.sparkSession), finer_tasks(source.sparkSession):
        events, rejects = written_apart(flagged, "left_out", "events")
    return StagedEvents(events.drop("MOTIVO", "LINHA"), rejects.select("MOTIVO", "LINHA", DELIVERY))


def staged_events(source: DataFrame, by_file: bool = False) -> DataFrame:
    """The cleaned events of ``stage_events``."""
    return stage_events(source, LoadReport(source.sparkSession), by_file).events


@dataclass(frozen=True)
class LastKeys:
    """Keys in use; an event's number excludes the deliveries about to be replaced."""

    person: int = 0
    cause: int = 0
    event: int = 0


def last_keys(tables: Tables, events: DataFrame) -> LastKeys:
    """Keys in use, read from file footers: the movement is as large as all events."""

    def last(name: str, key: str, **without) -> int:
        return last_stored_key(tables, name, WAREHOUSE[name].columns, key, **without)

    return LastKeys(
        last("DWCD_PESSOA", "SK_PESSOA"),
        last("DWCD_CAUSAOBITO", "SK_CAUSAOBITO"),
        last("DWMV_OBITO", "CD_OBITO", by=DELIVERY, without=events),
    )


def event_load(
    events: DataFrame, read: Reader, stamp: datetime, last: LastKeys = LastKeys()
) -> EventLoad:
    """Staged events against the warehouse that ``read`` gives.

    New members are written once: the movement and their own tables both use them, and of
    files Spark knows the size, so that it broadcasts those that are small enough.
    """
    persons = written(unseen_persons(events, read, last.person), "persons")
    causes = written(unseen_causes(events, read, last.cause), "causes")
    return EventLoad(
        person_rows(persons, read, stamp),
        cause_rows(causes, read, stamp),
        movement_rows(events, persons, causes, read, stamp, last.event),
    )


def store_events(
    tables: Tables, load: EventLoad, emptied: Iterable[str] = (), report: LoadReport | None = None
) -> None:
    """Members first, movement last: a failure between leaves members without events,
    which the next run finds and uses. Stored events of ``emptied`` deliveries go. Rows that
    lack a required value fail their write, before any of them is stored."""
    report = report or LoadReport(tables.spark)
    for name, key, rows, unknown in (
        (
            "DWCD_PESSOA",
            "SK_PESSOA",
            load.persons,
            unknown_values(
                ["SK_SEXO", "SK_RACACOR", "SK_ESCFAL", "SK_ESTCIV", "SK_MUNICIPIO", "SK_OCUP"],
                [],
                CD_PESSOA=str(UNKNOWN_KEY),
                DT_CARGA=UNKNOWN_STAMP,
            ),
        ),
        (
            "DWCD_CAUSAOBITO",
            "SK_CAUSAOBITO",
            load.causes,
            unknown_values(
                ["SK_CIDBAS", "SK_CIDTERM"],
                [],
                CD_CAUSAOBITO=str(UNKNOWN_KEY),
                DT_CARGA=UNKNOWN_STAMP,
            ),
        ),
    ):
        first_load = _read(tables, name).filter(F.col(key) == UNKNOWN_KEY).isEmpty()
        rows = report.counting(f"{name} added", guarded(rows, name))
        tables.append(name, with_unknown(rows, key, unknown) if first_load else rows)
    keys = [c for c in load.movement.columns if c.startswith("SK_")]
    unknown = {f"unknown_{c}": F.count_if(F.col(c) == UNKNOWN_KEY) for c in keys}
    movement = guarded(load.movement, "DWMV_OBITO")
    movement = report.counting("DWMV_OBITO stored", movement, **unknown)
    tables.replace_deliveries("DWMV_OBITO", movement, DELIVERY, emptied)


def load_event_rows(
    tables: Tables,
    source: DataFrame,
    stamp: datetime,
    by_file: bool = False,
    delivered: Iterable[str] = (),
) -> EventLoad:
    """Delivered event rows, batch or micro-batch, into the warehouse.

    The load's ``report`` has the rows read, left out by reason, added and stored, and the
    unknown keys among them. Rows left out are kept in ``DWRJ_OBITO``.

    ``delivered`` lists the deliveries, also those without rows, whose stored events then
    go. A stream may get the files of a folder in several runs: it loads ``by_file``, so
    that a later file does not replace an earlier one.
    """
    report = LoadReport(tables.spark)
    staged = stage_events(source, report, by_file)
    events = staged.events
    load = event_load(
        events, lambda name: _read(tables, name), stamp, last_keys(tables, events)
    )
    present = {r[0] for r in events.select(DELIVERY).distinct().collect()}  # one row per file
    store_events(tables, load, set(delivered) - present, report)
    rejects = stamped(staged.rejects, stamp)
    _store_rejects(tables, "DWRJ_OBITO", rejects, report, "events rejected", set(delivered) | present)
    return replace(load, report=report)


def load_events(tables: Tables, paths: str | Sequence[str], stamp: datetime) -> EventLoad:
    """Deliveries of events; delivering a file again replaces its events, also when the
    new file has none."""
    source = read_delimited(tables.spark, paths, EVENT_COLUMNS, ragged="mark")
    delivered = delivery_names(delivered_files(tables.spark, paths))
    return load_event_rows(tables, source, stamp, delivered=delivered)


def load_arrived_events(tables: Tables, folder: str, stamp: datetime, checkpoint: str) -> list[str]:
    """Event files that are new in a folder, then those corrected or emptied since.

    Returns the names of the latter. The ledger of loaded files lies beside the tables.
    """
    ledger = FileLedger(tables.spark, f"{tables.root}/LEDGER_OBITO")

    def load(rows: DataFrame, delivered: Sequence[str]) -> None:
        load_event_rows(tables, rows, stamp, by_file=True, delivered=delivered)

    columns = {c: c for c in EVENT_COLUMNS}
    return load_arrived_files(
        tables.spark, folder, columns, load, checkpoint, ledger, ragged="mark"
    )


@dataclass(frozen=True)
class Deliveries:
    """Paths of all delivered files."""

    causes: str | Sequence[str]
    places: str | Sequence[str]
    capitals: str | Sequence[str]
    population: str | Sequence[str]
    occupations: str | Sequence[str]
    events: Sequence[str]


def build_warehouse(
    spark: SparkSession, root: str, deliveries: Deliveries, stamp: datetime
) -> Tables:
    """Full warehouse build. An error in any step stops it."""
    tables = Tables(spark, root)
    load_code_lists(tables, stamp)
    load_causes(tables, deliveries.causes, stamp)
    load_places(tables, deliveries.places, deliveries.capitals, stamp)
    load_population(tables, deliveries.population, stamp)
    load_occupations(tables, deliveries.occupations, stamp)
    load_events(tables, deliveries.events, stamp)
    return tables
