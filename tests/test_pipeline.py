"""Whole warehouse and mart from small delivered files, against plain Python."""

from __future__ import annotations

import hashlib
import random
import shutil
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from starmill.plans import code_lists
from starmill.plans.mart import calendar_ends, refresh_deaths_of, refresh_mart
from starmill.plans.model import (
    MART,
    REJECTS,
    WAREHOUSE,
    checker,
    guarded,
    presented,
    rule_counts,
    violations,
)
from starmill.plans.warehouse import (
    EVENT_COLUMNS,
    Deliveries,
    build_warehouse,
    load_arrived_events,
    load_causes,
    load_code_lists,
    load_event_rows,
    load_events,
    load_occupations,
    load_places,
    load_population,
)
from starmill.sources import BrokenRules, Tables
from starmill.streaming import load_new_files

STAMP = datetime(2024, 5, 1, 12, 30)
LATER = datetime(2024, 6, 1, 12, 30)

TOWNS = [
    ("12", "Acre", "1200401", "Rio Branco"),
    ("12", "Acre", "1200013", "Acrelândia"),
    ("35", "São Paulo", "3550308", "São Paulo"),
    ("99", "Atlântida", "9900001", "Nenhures"),
]
CAUSES = [
    ("V01", "Pedestre"),
    ("X95", "Disparo"),
    ("R09.2", "Parada respiratória"),
    ("J18", "Pneumonia"),
]
OCCUPATIONS = [("10105", "Oficial"), ("999991", "Estudante")]


def write_lines(path, lines, encoding="utf-8"):
    path.write_bytes(("\n".join(lines) + "\n").encode(encoding))
    return str(path)


def event_row(rng):
    pick = rng.choice
    return {
        "TIPOBITO": pick(["1", "2", ""]),
        "CAUSABAS": pick(["V01", "X954", "X95", "Y99", ""]),
        "DTOBITO": pick(["1022020", "15032019", "31022020", "", "1012018", "20072023"]),
        "CODMUNOCOR": pick(["120040", "355030", "111111", ""]),
        "DTNASC": pick(["5051980", "31121999", "", "99999999"]),
        "SEXO": pick(["1", "2", "M", "0", ""]),
        "RACACOR": pick(["1", "1.0", "4", ""]),
        "ESCFALAGR1": pick(["0", "00", "5", "99", ""]),
        "ESTCIV": pick(["1", "9", ""]),
        "OCUP": pick(["10105", "999991", ""]),
        "ACIDTRAB": pick(["1", "2", "9", ""]),
        "CIRCOBITO": pick(["1", "3", "9", ""]),
        "TPOBITOCOR": pick(["1", "9", ""]),
        "CODMUNNATU": pick(["120001", "355030", ""]),
        "LINHAA": pick(["*R092*J18", "", "no mark"]),
        "LINHAB": pick(["*J18", ""]),
        "LINHAC": pick(["*X95", ""]),
        "LINHAD": "",
        "CODMUNRES": "1",
    }


def write_events(path, rows, reverse=False):
    columns = [*EVENT_COLUMNS, "CODMUNRES"]
    columns = columns[::-1] if reverse else columns
    lines = [";".join(columns)] + [";".join(r[c] for c in columns) for r in rows]
    return write_lines(path, lines)


@pytest.fixture(scope="module")
def delivered(tmp_path_factory):
    folder = tmp_path_factory.mktemp("delivered")
    rng = random.Random(7)
    events = {year: [event_row(rng) for _ in range(150)] for year in (2019, 2020)}
    # A third of all events belongs to the one person without any attribute.
    for rows in events.values():
        for row in rows[:50]:
            for c in ("DTNASC", "SEXO", "RACACOR", "ESCFALAGR1", "ESTCIV", "OCUP", "CODMUNNATU"):
                row[c] = ""
    paths = [
        write_events(folder / f"deaths_{year}.csv", rows, reverse=year == 2020)
        for year, rows in events.items()
    ]
    population = [
        write_lines(
            folder / f"estimate_{year}.csv",
            [
                "ESTIMATIVAS;;",
                "COD. UF;COD. MUNIC;POPULAÇÃO ESTIMADA",
                "12;40;1.234 (1)",
                "12;00013;500",
                "35;50308;12.345.678,9",
                "77;1;9",
                "Fonte: nota;;",
            ],
        )
        for year in (2018, 2019, 2020)
    ]
    deliveries = Deliveries(
        causes=write_lines(
            folder / "causes.csv",
            ["CAT;DESCRICAO;OUTRA"] + [f"{c};{d};x" for c, d in CAUSES + CAUSES[:1]],
            "latin-1",
        ),
        places=write_lines(
            folder / "places.csv",
            ["UF;Nome_UF;Código Município Completo;Nome_Município"] + [";".join(t) for t in TOWNS],
        ),
        capitals=write_lines(
            folder / "capitals.csv",
            ["codigo_ibge,nome,capital", "1200401,a,1", "3550308,b,1", "3550308,b,0", "1200013,c,0"],
        ),
        population=population,
        occupations=write_lines(
            folder / "occupations.csv",
            ["CODIGO;TITULO"] + [f"{c};{t}" for c, t in OCCUPATIONS],
            "latin-1",
        ),
        events=paths,
    )
    return deliveries, events


@pytest.fixture(scope="module")
def catalogues(spark, delivered, tmp_path_factory):
    """Folder of a warehouse with code lists and catalogues and nothing else."""
    deliveries, _ = delivered
    tables = Tables(spark, str(tmp_path_factory.mktemp("catalogues") / "w"))
    load_code_lists(tables, STAMP)
    load_causes(tables, deliveries.causes, STAMP)
    load_places(tables, deliveries.places, deliveries.capitals, STAMP)
    load_occupations(tables, deliveries.occupations, STAMP)
    return tables.root


@pytest.fixture
def tables(spark, catalogues, tmp_path):
    """A warehouse of its own to load movements into."""
    shutil.copytree(catalogues, tmp_path / "w")
    return Tables(spark, str(tmp_path / "w"))


@pytest.fixture(scope="module")
def built(spark, delivered, tmp_path_factory):
    deliveries, _ = delivered
    root = tmp_path_factory.mktemp("built")
    warehouse = build_warehouse(spark, str(root / "warehouse"), deliveries, STAMP)
    holidays = spark.sql("SELECT explode(array(DATE '2020-01-01', DATE '2019-12-25')) AS day")
    mart = refresh_mart(warehouse, str(root / "mart"), holidays, STAMP)
    return warehouse, mart


def read(tables, name):
    model = WAREHOUSE if name in WAREHOUSE else MART
    return tables.read(name, model[name].columns)


def day_of(text):
    digits = text.zfill(8)
    try:
        return date(int(digits[4:]), int(digits[2:4]), int(digits[:2]))
    except ValueError:
        return None


def canonical(text):
    return str(int(float(text))) if text.replace(".", "").isdigit() else text or "-1"


def expected_event(row):
    """Codes of one event, worked out row by row; None when the row is dropped."""
    if not row["CIRCOBITO"]:
        return None
    parts = [
        canonical(row["RACACOR"]),
        canonical(row["SEXO"]),
        row["DTNASC"].zfill(8) if row["DTNASC"] else "-1",
        *[canonical(row[c]) for c in ("ESCFALAGR1", "ESTCIV", "OCUP", "CODMUNNATU")],
    ]
    person = hashlib.md5("|".join(parts).encode()).hexdigest()[:16]
    chain = next((row[f"LINHA{x}"] for x in "ABCD" if row[f"LINHA{x}"]), "")
    terminal = "*" + chain.split("*")[1] if "*" in chain else "*" + row["CAUSABAS"]
    cause = row["CAUSABAS"][:3] + terminal[:4] if row["CAUSABAS"] else "-1"
    return {
        "person": person,
        "cause": cause,
        "town": {"120040": 120040, "355030": 355030}.get(row["CODMUNOCOR"], -1),
        "circumstance": int(row["CIRCOBITO"]) if row["CIRCOBITO"] in "1234" else -1,
        "place_type": int(row["TPOBITOCOR"] or -1),
        "work": row["ACIDTRAB"] == "1",
        "fetal": row["TIPOBITO"] == "1",
        "day": day_of(row["DTOBITO"]),
        "birthplace": int(row["CODMUNNATU"] or -1),
    }


def expected_events(events):
    found = [expected_event(r) for rows in events.values() for r in rows]
    return [e for e in found if e]


def movement_rows(warehouse):
    """Stored events with their keys turned back into codes."""
    events = read(warehouse, "DWMV_OBITO")
    for table, key, code in (
        ("DWCD_MUNICIPIO", "SK_MUNICIPIO", "CD_MUNICIPIO"),
        ("DWCD_CAUSAOBITO", "SK_CAUSAOBITO", "CD_CAUSAOBITO"),
        ("DWCD_PESSOA", "SK_PESSOA", "CD_PESSOA"),
        ("DWCD_CIRCOBITO", "SK_CIRCOBITO", "CD_CIRCOBITO"),
        ("DWCD_TPLOCOR", "SK_TPLOCOR", "CD_TPLOCOR"),
    ):
        events = events.join(read(warehouse, table).select(key, code), key)
    return Counter(
        tuple(r)
        for r in events.select(
            "CD_PESSOA", "CD_CAUSAOBITO", "CD_MUNICIPIO", "CD_CIRCOBITO", "CD_TPLOCOR",
            "ST_ACIDTRAB", "ST_FETAL", "DT_OBITO",
        ).collect()
    )


FIELDS = ("person", "cause", "town", "circumstance", "place_type", "work", "fetal", "day")


def test_movement_equals_row_by_row_result(built, delivered):
    expected = Counter(tuple(e[f] for f in FIELDS) for e in expected_events(delivered[1]))
    assert movement_rows(built[0]) == expected


def test_event_numbers_are_dense(built):
    numbers = sorted(r.CD_OBITO for r in read(built[0], "DWMV_OBITO").collect())
    assert numbers == list(range(1, len(numbers) + 1))


def test_places(built):
    places = {r.CD_MUNICIPIO: r for r in read(built[1], "DIME_LOCAL").collect()}
    assert set(places) == {-1, 120040, 120001, 355030, 990000}
    assert (places[120040].NM_ESTADO, places[120040].NM_REGIAO) == ("Acre", "Norte")
    assert places[355030].ST_CAPITAL and places[120040].ST_CAPITAL
    assert not places[120001].ST_CAPITAL and not places[990000].ST_CAPITAL
    assert places[990000].NM_REGIAO == "Não Informado"
    states = {r.NM_ESTADO: r.SK_ESTADO for r in read(built[0], "DWCD_ESTADO").collect()}
    assert states == {"Não Informado": -1, "Acre": 1, "Atlântida": 2, "São Paulo": 3}


def test_code_lists(built):
    schooling = {r.CD_ESCFAL: r.DS_ESCFAL for r in read(built[0], "DWCD_ESCFAL").collect()}
    assert schooling == dict(code_lists.SCHOOLING) | {-1: "Não Informado"}
    sexes = {r.SK_SEXO: r.CD_SEXO for r in read(built[0], "DWCD_SEXO").collect()}
    assert sexes == {-1: "-1", 1: "0", 2: "1", 3: "2", 4: "9", 5: "M", 6: "F", 7: "I"}
    assert len(code_lists.REGION_OF_STATE) == 27


def test_population(built):
    towns = {r.SK_MUNICIPIO: r.CD_MUNICIPIO for r in read(built[0], "DWCD_MUNICIPIO").collect()}
    loaded = {
        (towns[r.SK_MUNICIPIO], r.ANO, r.QTD_POPULACAO)
        for r in read(built[0], "DWMV_POPULACAO").collect()
    }
    assert loaded == {
        (town, year, quantity)
        for year in (2018, 2019, 2020)
        for town, quantity in ((120004, 0), (120001, 500), (355030, 12345678))
        if town != 120004
    }


def test_population_fact(built, delivered):
    places = {r.SK_LOCAL: r.CD_MUNICIPIO for r in read(built[1], "DIME_LOCAL").collect()}
    years = {r.SK_TEMPO_ANO: r.ANO for r in read(built[1], "DIME_TEMPO_ANO").collect()}
    assert years == {1: 2018, 2: 2019, 3: 2020}
    deaths = Counter(
        (e["day"].year, e["town"]) for e in expected_events(delivered[1]) if e["day"]
    )
    for row in read(built[1], "FATO_POPULACAO").collect():
        assert row.QTD_MORTES == deaths[(years[row.SK_TEMPO], places[row.SK_LOCAL])]
    assert read(built[1], "FATO_POPULACAO").count() == 6


def test_death_fact(built, delivered):
    mart = built[1]
    days = {r.SK_TEMPO_DIA: r.DATA for r in read(mart, "DIME_TEMPO_DIA").collect()}
    places = {r.SK_LOCAL: r.CD_MUNICIPIO for r in read(mart, "DIME_LOCAL").collect()}
    facts = read(mart, "FATO_OBITO").collect()
    found = Counter(
        (days[r.SK_DT_OBITO], places[r.SK_LOCAL_OBITO], places[r.SK_LOCAL_NASC], r.QTD_OBITO)
        for r in facts
    )
    expected = Counter(
        (e["day"], e["town"], e["birthplace"], 1) for e in expected_events(delivered[1])
    )
    assert found == expected
    assert len(days) == 2558
    assert days[-1] is None


def test_person_and_cause_labels(built, delivered):
    persons = read(built[1], "DIME_PESSOA")
    nobody = hashlib.md5(b"-1|-1|-1|-1|-1|-1|-1").hexdigest()[:16]
    key = read(built[0], "DWCD_PESSOA").filter(f"CD_PESSOA = '{nobody}'").first().SK_PESSOA
    row = persons.filter(f"SK_PESSOA = {key}").first()
    assert (row.CD_SEXO, row.DS_SEXO, row.CD_OCUP, row.DT_NASC) == ("-1", "Não Informado", -1, None)
    assert presented(persons).filter(f"SK_PESSOA = {key}").first().DT_NASC == "-1"
    assert presented(persons).filter(f"SK_PESSOA = {key}").first().DT_CARGA == "01-05-2024 12:30"
    causes = {
        (r.CD_CID_BASICA, r.CD_CID_TERMINAL) for r in read(built[1], "DIME_CAUSA").collect()
    }
    # "*R09" is cut from R092, which the catalogue lists as R09.2: no match, as published.
    assert ("V01", "V01") in causes and ("X95", "J18") in causes and ("V01", "-1") in causes


def test_all_declared_rules_hold(built):
    warehouse, mart = built
    assert violations(WAREHOUSE, lambda n: read(warehouse, n)).collect() == []
    assert violations(MART, lambda n: read(mart, n)).collect() == []


def test_a_broken_rule_is_found(spark, built):
    warehouse = built[0]

    def broken(name):
        df = read(warehouse, name)
        return df.filter("SK_ESTADO <> 1") if name == "DWCD_ESTADO" else df

    found = [(r.table_name, r.rule, r.columns) for r in violations(WAREHOUSE, broken).collect()]
    assert found == [("DWCD_MUNICIPIO", "reference", "SK_ESTADO")]


def test_loading_again_changes_nothing(spark, delivered, tmp_path):
    deliveries, _ = delivered
    warehouse = build_warehouse(spark, str(tmp_path / "w"), deliveries, STAMP)

    def snapshot():
        return {
            name: sorted(
                map(str, read(warehouse, name).drop("DT_CARGA").collect())
            )
            for name in WAREHOUSE
        }

    before = snapshot()
    load_code_lists(warehouse, LATER)
    load_places(warehouse, deliveries.places, deliveries.capitals, LATER)
    load_population(warehouse, deliveries.population[1], LATER)
    causes = load_causes(warehouse, deliveries.causes, LATER)
    occupations = load_occupations(warehouse, deliveries.occupations, LATER)
    assert {r.action for r in causes.unionByName(occupations, True).collect()} == {"keep"}
    load_events(warehouse, deliveries.events, LATER)
    assert snapshot() == before
    # One of the two files again: its events are replaced, the other's stay.
    events_before = movement_rows(warehouse)
    load_events(warehouse, deliveries.events[1:], LATER)
    assert movement_rows(warehouse) == events_before
    assert violations(WAREHOUSE, lambda n: read(warehouse, n)).collect() == []


def test_changed_catalogue_is_merged(spark, delivered, tmp_path):
    deliveries, _ = delivered
    tables = Tables(spark, str(tmp_path / "w"))
    load_occupations(tables, deliveries.occupations, STAMP)
    changed = write_lines(
        tmp_path / "occupations2.csv", ["CODIGO;TITULO", "10105;Oficial geral", "7;Novo"], "latin-1"
    )
    merged = load_occupations(tables, changed, LATER)
    actions = {r.CD_OCUP: (r.SK_OCUP, r.action) for r in merged.collect()}
    assert actions == {
        -1: (-1, "keep"), 10105: (1, "update"), 999991: (2, "keep"), 7: (3, "insert"),
    }
    stored = {r.CD_OCUP: (r.DS_OCUP, r.DT_CARGA) for r in read(tables, "DWCD_OCUP").collect()}
    assert stored[10105] == ("Oficial geral", LATER) and stored[999991] == ("Estudante", STAMP)


def test_missing_column_stops_the_load(spark, tmp_path):
    bad = write_lines(tmp_path / "bad.csv", ["CODIGO;NOME", "1;x"])
    with pytest.raises(ValueError, match="TITULO"):
        load_occupations(Tables(spark, str(tmp_path / "w")), bad, STAMP)


def test_streamed_files_equal_batch_load(spark, delivered, built, tables, tmp_path):
    deliveries, events = delivered
    folder = tmp_path / "arriving"
    folder.mkdir()

    def load(batch):
        load_event_rows(tables, batch, STAMP)

    names = {c: c for c in EVENT_COLUMNS}
    for year, rows in events.items():
        write_events(folder / f"deaths_{year}.csv", rows)
        load_new_files(spark, str(folder), names, load, str(tmp_path / "checkpoint"))
    load_new_files(spark, str(folder), names, load, str(tmp_path / "another"))
    assert movement_rows(tables) == movement_rows(built[0])


def test_calendar_covers_days_outside_its_bounds(spark):
    bounds = date(2018, 1, 1), date(2024, 12, 31)
    deaths = spark.sql("SELECT explode(array(DATE '2017-05-01', DATE '2025-02-03', NULL)) AS DT_OBITO")
    assert calendar_ends(deaths, *bounds) == (date(2017, 1, 1), date(2025, 12, 31))
    inside = deaths.filter("DT_OBITO IS NULL")
    assert calendar_ends(inside, *bounds) == bounds


def test_population_rejects_and_counts(spark, delivered, tables, tmp_path):
    deliveries, _ = delivered
    path = tmp_path / "estimate_2018.csv"
    path.write_bytes(type(path)(deliveries.population[0]).read_bytes())
    report = load_population(tables, str(path), STAMP)
    counts = {(step, measure): n for step, measure, n in report.rows()}
    assert counts == {
        ("population read", "rows"): 4, ("population read", "left_out"): 2,
        ("population stored", "rows"): 2, ("population rejected", "rows"): 2,
    }

    def rejects():
        rows = tables.read("DWRJ_POPULACAO", REJECTS["DWRJ_POPULACAO"]).collect()
        return sorted((r.MOTIVO, r.LINHA) for r in rows)

    assert rejects() == [("unknown town", "12;40;1.234 (1)"), ("unknown town", "77;1;9")]
    # The corrected delivery has no unknown town: its rejects go with its rows.
    write_lines(path, ["COD. UF;COD. MUNIC;POPULAÇÃO ESTIMADA", "12;00013;7"])
    load_population(tables, str(path), LATER)
    assert rejects() == []


def test_event_rejects_and_counts(spark, delivered, tables, tmp_path):
    deliveries, events = delivered
    path = tmp_path / "deaths_2019.csv"
    write_events(path, events[2019])
    with path.open("a", encoding="utf-8") as file:
        file.write("1;2;3\n" + ";" * 40 + "\n")
    load = load_events(tables, [str(path)], STAMP)
    counts = {(step, measure): n for step, measure, n in load.report.rows()}
    kept = expected_events({2019: events[2019]})
    empty = sum(1 for r in events[2019] if not r["CIRCOBITO"])
    assert counts["events read", "rows"] == len(events[2019]) + 2
    assert counts["events read", "no_circumstance"] == empty
    assert counts["events read", "surplus_fields"] == counts["events read", "missing_fields"] == 1
    assert counts["events read", "unread_day"] == sum(
        1 for r in events[2019] if r["CIRCOBITO"] and r["DTOBITO"] and not day_of(r["DTOBITO"])
    )
    assert counts["events rejected", "rows"] == empty + 2
    assert counts["DWMV_OBITO stored", "rows"] == len(kept)
    assert counts["DWMV_OBITO stored", "unknown_SK_MUNICIPIO"] == sum(1 for e in kept if e["town"] == -1)
    assert counts["DWCD_PESSOA added", "rows"] == len({e["person"] for e in kept})
    stored = tables.read("DWRJ_OBITO", REJECTS["DWRJ_OBITO"]).collect()
    reasons = Counter(r.MOTIVO for r in stored)
    assert reasons == {"no circumstance": empty, "surplus fields": 1, "missing fields": 1}
    assert {r.LINHA for r in stored if r.MOTIVO == "missing fields"} == {"1;2;3"}
    assert movement_rows(tables) == Counter(tuple(e[f] for f in FIELDS) for e in kept)
    # Delivered again without a fault: nothing of it is left among the rejects.
    write_events(path, [r for r in events[2019] if r["CIRCOBITO"]])
    load_events(tables, [str(path)], LATER)
    assert tables.read("DWRJ_OBITO", REJECTS["DWRJ_OBITO"]).isEmpty()
    assert movement_rows(tables) == Counter(tuple(e[f] for f in FIELDS) for e in kept)


def test_corrected_event_files_replace_what_they_held(spark, delivered, tables, tmp_path):
    deliveries, events = delivered
    folder = tmp_path / "arriving"
    folder.mkdir()

    def run():
        return load_arrived_events(tables, str(folder), STAMP, str(tmp_path / "checkpoint"))

    write_events(folder / "deaths_2019.csv", events[2019])
    write_events(folder / "deaths_2020.csv", events[2020], reverse=True)
    assert run() == []
    write_events(folder / "deaths_2019.csv", events[2019][:60], reverse=True)
    (folder / "deaths_2020.csv").write_text("")
    assert sorted(name[-15:] for name in run()) == ["deaths_2019.csv", "deaths_2020.csv"]
    assert run() == []
    kept = expected_events({2019: events[2019][:60]})
    assert movement_rows(tables) == Counter(tuple(e[f] for f in FIELDS) for e in kept)


def test_broken_version_is_not_published(spark, built, tables):
    towns = read(tables, "DWCD_MUNICIPIO")
    before = sorted(map(str, towns.collect()))
    broken = towns.unionByName(towns.limit(1)).withColumn(
        "SK_ESTADO", F.when(F.col("CD_MUNICIPIO") == 120040, 77).otherwise(F.col("SK_ESTADO"))
    ).withColumn("NM_MUNICIPIO", F.nullif("NM_MUNICIPIO", F.lit("São Paulo")))
    check = checker(WAREHOUSE, "DWCD_MUNICIPIO", lambda name: read(tables, name))
    with pytest.raises(BrokenRules) as error:
        tables.replace("DWCD_MUNICIPIO", broken, check)
    assert error.value.broken == {
        "missing NM_MUNICIPIO": 1, "reference SK_ESTADO": 1, "key SK_MUNICIPIO": 1,
    }
    assert sorted(map(str, read(tables, "DWCD_MUNICIPIO").collect())) == before
    plan = rule_counts(WAREHOUSE["DWMV_OBITO"], read(built[0], "DWMV_OBITO"), lambda n: read(built[0], n))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("CD_OBITO#") and text.count("Aggregate [count") == 1
    # The refused version is cleaned away once a sound one follows it.
    tables.replace("DWCD_MUNICIPIO", towns, check)
    assert len(tables.clean("DWCD_MUNICIPIO", keep=1)) == 2 and tables.clean("DWCD_MUNICIPIO", 1) == []
    assert sorted(map(str, read(tables, "DWCD_MUNICIPIO").collect())) == before


def test_rows_without_a_required_value_are_not_added(spark, built):
    movement = read(built[0], "DWMV_OBITO")
    assert guarded(movement, "DWMV_OBITO").count() == movement.count()
    lacking = movement.withColumn("SK_PESSOA", F.lit(None).cast("bigint")).limit(1)
    with pytest.raises(Exception, match="DWMV_OBITO lacks SK_PESSOA"):
        guarded(lacking, "DWMV_OBITO").collect()


def test_refresh_of_a_delivery_equals_a_full_refresh(spark, delivered, tmp_path):
    deliveries, events = delivered
    path = tmp_path / "deaths_2019.csv"
    write_events(path, events[2019])
    first = Deliveries(**{**vars(deliveries), "events": [str(path), deliveries.events[1]]})
    warehouse = build_warehouse(spark, str(tmp_path / "w"), first, STAMP)
    holidays = spark.sql("SELECT explode(array(DATE '2020-01-01')) AS day")
    mart = refresh_mart(warehouse, str(tmp_path / "m"), holidays, STAMP)
    write_events(path, events[2019][:40])
    load_events(warehouse, [str(path)], LATER)
    refreshed = refresh_deaths_of(warehouse, mart, [str(path)], LATER).drop("DT_CARGA")
    full = refresh_mart(warehouse, str(tmp_path / "full"), holidays, LATER)
    expected = sorted(map(str, read(full, "FATO_POPULACAO").drop("DT_CARGA").collect()))
    assert sorted(map(str, refreshed.collect())) == expected
    counted = expected_events({2019: events[2019][:40], 2020: events[2020]})
    assert sum(r.QTD_MORTES for r in refreshed.collect()) < len(counted)
