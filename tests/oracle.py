"""Compare a Spark result with the same question asked in SQL."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


# Spark types and the SQL types they have to come back as
TYPES = {
    "smallint": "SMALLINT",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def _value(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_value(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def spark_result(df):
    return _sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def sql_result(connection, sql):
    cursor = connection.execute(sql)
    return _sorted_rows([d[0] for d in cursor.description], cursor.fetchall())


def difference(df, connection, sql) -> str | None:
    """None when both sides agree in columns, rows, values and value types."""
    columns, rows = spark_result(df)
    want_columns, want_rows = sql_result(connection, sql)
    if columns != want_columns:
        return f"columns {columns} != {want_columns}"
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    want_types = {name: str(kind) for name, kind, *_ in described}
    types = {f.name: TYPES.get(f.dataType.simpleString(), "?") for f in df.schema}
    if types != want_types:
        return f"types {types} != {want_types}"
    if len(rows) != len(want_rows):
        return f"{len(rows)} rows != {len(want_rows)}"
    for row, want in zip(rows, want_rows, strict=True):
        if row != want or [type(v) for v in row] != [type(v) for v in want]:
            return f"{row} != {want}"
    return None
