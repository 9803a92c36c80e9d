"""Tables of the warehouse and the mart: columns, keys and references.

Table and column names are fixed values: they are the interface that reports read.
Days are dates and flags booleans inside; ``presented`` gives the text forms.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.functions.dates import PRESENTED_STAMP, day_text
from starmill.operators.checks import key_violations, null_counts, orphans
from starmill.operators.lookups import join_large


@dataclass(frozen=True)
class Table:
    """Columns in DDL form, the key, and {column: (table, column)} references."""

    columns: str
    key: tuple[str, ...]
    references: dict[str, tuple[str, str]] = field(default_factory=dict)


def _domain(name: str, code_type: str = "bigint") -> Table:
    return Table(
        f"SK_{name} bigint, CD_{name} {code_type}, DS_{name} string, DT_CARGA timestamp",
        (f"SK_{name}",),
    )


WAREHOUSE = {
    "DWCD_REGIAO": Table("SK_REGIAO bigint, NM_REGIAO string, DT_CARGA timestamp", ("SK_REGIAO",)),
    "DWCD_ESTADO": Table(
        "SK_ESTADO bigint, CD_ESTADO bigint, NM_ESTADO string, SK_REGIAO bigint,"
        " DT_CARGA timestamp",
        ("SK_ESTADO",),
        {"SK_REGIAO": ("DWCD_REGIAO", "SK_REGIAO")},
    ),
    "DWCD_MUNICIPIO": Table(
        "SK_MUNICIPIO bigint, CD_MUNICIPIO bigint, SK_ESTADO bigint, NM_MUNICIPIO string,"
        " ST_CAPITAL boolean, DT_CARGA timestamp",
        ("SK_MUNICIPIO",),
        {"SK_ESTADO": ("DWCD_ESTADO", "SK_ESTADO")},
    ),
    "DWMV_POPULACAO": Table(
        "SK_MUNICIPIO bigint, ANO int, QTD_POPULACAO bigint, DT_CARGA timestamp, ENTREGA string",
        ("SK_MUNICIPIO", "ANO"),
        {"SK_MUNICIPIO": ("DWCD_MUNICIPIO", "SK_MUNICIPIO")},
    ),
    "DWCD_RACACOR": _domain("RACACOR"),
    "DWCD_SEXO": _domain("SEXO", "string"),
    "DWCD_ESCFAL": _domain("ESCFAL"),
    "DWCD_ESTCIV": _domain("ESTCIV"),
    "DWCD_OCUP": _domain("OCUP"),
    "DWCD_CIRCOBITO": _domain("CIRCOBITO"),
    "DWCD_TPLOCOR": _domain("TPLOCOR"),
    "DWCD_CIDS": Table(
        "SK_CID bigint, CD_CID string, CD_CID_LINHA string, CD_CID_CAUSA string, DS_CID string,"
        " DT_CARGA timestamp",
        ("SK_CID",),
    ),
    "DWCD_CAUSAOBITO": Table(
        "SK_CAUSAOBITO bigint, CD_CAUSAOBITO string, SK_CIDBAS bigint, SK_CIDTERM bigint,"
        " DT_CARGA timestamp",
        ("SK_CAUSAOBITO",),
        {"SK_CIDBAS": ("DWCD_CIDS", "SK_CID"), "SK_CIDTERM": ("DWCD_CIDS", "SK_CID")},
    ),
    "DWCD_PESSOA": Table(
        "SK_PESSOA bigint, CD_PESSOA string, SK_SEXO bigint, SK_RACACOR bigint,"
        " SK_ESCFAL bigint, SK_ESTCIV bigint, SK_MUNICIPIO bigint, SK_OCUP bigint,"
        " DT_NASC date, CD_CONFERE bigint, DT_CARGA timestamp",
        ("SK_PESSOA",),
        {
            f"SK_{name}": (f"DWCD_{name}", f"SK_{name}")
            for name in ("SEXO", "RACACOR", "ESCFAL", "ESTCIV", "MUNICIPIO", "OCUP")
        },
    ),
    "DWMV_OBITO": Table(
        "CD_OBITO bigint, SK_MUNICIPIO bigint, SK_CAUSAOBITO bigint, SK_PESSOA bigint,"
        " SK_CIRCOBITO bigint, SK_TPLOCOR bigint, ST_ACIDTRAB boolean, ST_FETAL boolean,"
        " DT_OBITO date, DT_CARGA timestamp, ENTREGA string",
        ("CD_OBITO",),
        {
            f"SK_{name}": (f"DWCD_{name}", f"SK_{name}")
            for name in ("MUNICIPIO", "CAUSAOBITO", "PESSOA", "CIRCOBITO", "TPLOCOR")
        },
    ),
}

MART = {
    "DIME_TEMPO_ANO": Table("SK_TEMPO_ANO bigint, ANO int, DT_CARGA timestamp", ("SK_TEMPO_ANO",)),
    "DIME_CIRCOBITO": _domain("CIRCOBITO"),
    "DIME_TPLOCOR": _domain("TPLOCOR"),
    "DIME_PESSOA": Table(
        "SK_PESSOA bigint, CD_SEXO string, DS_SEXO string, CD_RACACOR bigint, DS_RACACOR string,"
        " CD_ESTCIV bigint, DS_ESTCIV string, CD_OCUP bigint, DS_OCUP string, CD_ESCFAL bigint,"
        " DS_ESCFAL string, DT_NASC date, DT_CARGA timestamp",
        ("SK_PESSOA",),
    ),
    "DIME_TEMPO_DIA": Table(
        "SK_TEMPO_DIA bigint, DATA date, DIA string, MES string, ANO string, ST_FERIADO boolean,"
        " DT_CARGA timestamp",
        ("SK_TEMPO_DIA",),
    ),
    "DIME_CAUSA": Table(
        "SK_CAUSA bigint, CD_CID_BASICA string, DS_CID_BASICA string, CD_CID_TERMINAL string,"
        " DS_CID_TERMINAL string, DT_CARGA timestamp",
        ("SK_CAUSA",),
    ),
    "DIME_LOCAL": Table(
        "SK_LOCAL bigint, CD_MUNICIPIO bigint, NM_MUNICIPIO string, ST_CAPITAL boolean,"
        " CD_ESTADO bigint, NM_ESTADO string, CD_REGIAO bigint, NM_REGIAO string,"
        " DT_CARGA timestamp",
        ("SK_LOCAL",),
    ),
    "FATO_OBITO": Table(
        "CD_OBITO bigint, SK_PESSOA bigint, SK_LOCAL_OBITO bigint, SK_LOCAL_NASC bigint,"
        " SK_DT_OBITO bigint, SK_CAUSA bigint, SK_CIRCOBITO bigint, SK_TPLOCOR bigint,"
        " ST_FETAL boolean, ST_ACIDTRAB boolean, QTD_OBITO bigint, DT_CARGA timestamp",
        ("CD_OBITO",),
        {
            "SK_LOCAL_OBITO": ("DIME_LOCAL", "SK_LOCAL"),
            "SK_LOCAL_NASC": ("DIME_LOCAL", "SK_LOCAL"),
            "SK_CAUSA": ("DIME_CAUSA", "SK_CAUSA"),
            "SK_DT_OBITO": ("DIME_TEMPO_DIA", "SK_TEMPO_DIA"),
            "SK_PESSOA": ("DIME_PESSOA", "SK_PESSOA"),
            "SK_CIRCOBITO": ("DIME_CIRCOBITO", "SK_CIRCOBITO"),
            "SK_TPLOCOR": ("DIME_TPLOCOR", "SK_TPLOCOR"),
        },
    ),
    "FATO_POPULACAO": Table(
        "SK_TEMPO bigint, SK_LOCAL bigint, QTD_POPULACAO bigint, QTD_MORTES bigint,"
        " DT_CARGA timestamp",
        ("SK_TEMPO", "SK_LOCAL"),
        {
            "SK_TEMPO": ("DIME_TEMPO_ANO", "SK_TEMPO_ANO"),
            "SK_LOCAL": ("DIME_LOCAL", "SK_LOCAL"),
        },
    ),
}

# Rows that a load left out, with the reason, kept per delivery like what it stored.
REJECTS = {
    "DWRJ_OBITO": "MOTIVO string, LINHA string, DT_CARGA timestamp, ENTREGA string",
    "DWRJ_POPULACAO": "MOTIVO string, LINHA string, DT_CARGA timestamp, ENTREGA string",
}

# Columns where null is a value: an unknown day is null until it is presented, and the
# unknown person has no fingerprint.
_MAY_BE_NULL = {"DT_NASC", "DT_OBITO", "DATA", "DIA", "MES", "ANO", "CD_CONFERE"}


def presented(df: DataFrame) -> DataFrame:
    """Text days and stamps and 0/1 flags, the forms that reports read."""
    shown = []
    for name, kind in df.dtypes:
        column = F.col(name)
        if kind == "date":
            column = day_text(column)
        elif kind.startswith("timestamp"):
            column = F.date_format(column, PRESENTED_STAMP)
        elif kind == "boolean":
            column = column.cast("int")
        shown.append(column.alias(name))
    return df.select(*shown)


def violations(model: dict[str, Table], read) -> DataFrame:
    """Broken keys, references and required columns of all tables, as counted rows.

    ``read`` gives the DataFrame of a table name. An empty result means all is well.
    """
    found = []
    for name, table in model.items():
        df = read(name)
        repeated = key_violations(df, table.key)
        found.append(_finding(repeated, name, "key", ", ".join(table.key)))
        for column, (parent, parent_key) in table.references.items():
            loose = orphans(df, column, read(parent), parent_key)
            found.append(_finding(loose, name, "reference", column))
        required = [c for c in df.columns if c not in _MAY_BE_NULL]
        missing = null_counts(df, required).filter("n_nulls > 0")
        found.append(
            missing.select(
                F.lit(name).alias("table_name"),
                F.lit("missing").alias("rule"),
                F.col("column_name").cast("string").alias("columns"),
                F.col("n_nulls").alias("n_rows"),
            )
        )
    result = found[0]
    for part in found[1:]:
        result = result.unionByName(part)
    return result


def rule_counts(table: Table, df: DataFrame, read) -> DataFrame:
    """One row: per declared rule of a table the number of rows that break it.

    All rules are one aggregate over the table: missing values, rows beyond the first of a
    key, and references, which a left join to the parents' keys marks before. ``read`` gives
    the DataFrame of a parent by name.
    """
    counts = {}
    required = [c for c in df.columns if c not in _MAY_BE_NULL]
    for column in required:
        counts[f"missing {column}"] = F.count_if(F.col(column).isNull())
    for number, (column, (parent, parent_key)) in enumerate(table.references.items()):
        parents = read(parent).select(F.col(parent_key).alias(f"__key_{number}")).distinct()
        parents = parents.withColumn(f"__found_{number}", F.lit(True))
        df = join_large(df, parents, column, f"__key_{number}")
        lost = F.col(f"__found_{number}").isNull() & F.col(column).isNotNull()
        counts[f"reference {column}"] = F.count_if(lost)
    distinct = F.count_distinct(F.struct(*table.key))
    counts[f"key {', '.join(table.key)}"] = F.count(F.lit(1)) - distinct
    return df.agg(*[count.alias(rule) for rule, count in counts.items()])


def checker(model: dict[str, Table], name: str, read):
    """Check of a table's new version, for ``Tables.replace``: the rules that it breaks."""

    def check(df: DataFrame) -> dict[str, int]:
        found = rule_counts(model[name], df, read).first().asDict()
        return {rule: count for rule, count in found.items() if count}

    return check


def guarded(df: DataFrame, name: str) -> DataFrame:
    """Rows to add to a table; the write fails, and stores nothing, on a missing value in a
    required column. For loads that add to a version instead of replacing it."""
    required = [c for c in df.columns if c not in _MAY_BE_NULL]
    lacking = [F.when(F.col(c).isNull(), F.lit(c)) for c in required]
    stop = F.raise_error(F.concat(F.lit(f"{name} lacks "), F.concat_ws(", ", *lacking)))
    broken = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in required])
    return df.filter(F.when(broken, stop.cast("boolean")).otherwise(True))


def _finding(rows: DataFrame, table: str, rule: str, columns: str) -> DataFrame:
    return (
        rows.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"))
        .filter("n_rows > 0")
        .select(
            F.lit(table).alias("table_name"),
            F.lit(rule).alias("rule"),
            F.lit(columns).alias("columns"),
            "n_rows",
        )
    )
