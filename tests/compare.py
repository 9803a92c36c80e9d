"""Run a registered query and its SQL side by side and compare all rows."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(folder: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')"
        )
    return connection


def _value(x):
    if isinstance(x, float):
        return ("nan",) if math.isnan(x) else x
    if isinstance(x, dt.datetime):
        return x.replace(tzinfo=None)
    return x


def _ordered(rows):
    return sorted(rows, key=lambda row: [(v is None, str(type(v)), str(v)) for v in row])


def spark_rows(df):
    names = sorted(df.columns)
    rows = [tuple(_value(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect()]
    kinds = dict(df.dtypes)
    return names, [kinds[n] for n in names], _ordered(rows)


def duck_rows(connection, sql):
    result = connection.execute(sql)
    names = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]).upper() for c in result.description}
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_value(row[i]) for i in order) for row in result.fetchall()]
    return sorted(names), [kinds[n] for n in sorted(names)], _ordered(rows)


SAME = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "date": "DATE", "boolean": "BOOLEAN",
}


def differences(spark, connection, query, sql, folder):
    """Text of the first differences, or None when names, types and rows agree."""
    names, kinds, rows = spark_rows(query(spark, folder))
    other_names, other_kinds, other_rows = duck_rows(connection, sql)
    if names != other_names:
        return f"columns {names} / {other_names}"
    wrong = [(n, k, o) for n, k, o in zip(names, kinds, other_kinds) if SAME.get(k, k) != o]
    if wrong:
        return f"types {wrong}"
    if len(rows) != len(other_rows):
        return f"row counts {len(rows)} / {len(other_rows)}; {rows[:3]} / {other_rows[:3]}"
    unlike = [(a, b) for a, b in zip(rows, other_rows) if a != b]
    if unlike:
        return f"{len(unlike)} rows differ on {names}: {unlike[:3]}"
    if not rows:
        return "no rows on either side"
    return None
