"""Compare Spark results with DuckDB's, order of rows ignored."""

from __future__ import annotations

from datetime import date, datetime

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duckdb_over(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


# Spark type -> DuckDB type that holds the same values.
SAME_TYPE = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "date": "DATE",
}


def rows_of(frame: DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    return sorted((tuple(row[c] for c in columns) for row in frame.collect()), key=_sortable)


def assert_same(frame: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> None:
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    types = dict(zip(names, (str(t[1]) for t in result.description)))
    assert sorted(frame.columns) == sorted(names)
    expected_types = {name: SAME_TYPE[kind] for name, kind in frame.dtypes}
    described = {
        row[0]: row[1] for row in connection.execute(f"DESCRIBE {sql}").fetchall()
    }
    assert expected_types == described, types
    order = [names.index(c) for c in sorted(names)]
    expected = sorted(
        (tuple(row[i] for i in order) for row in connection.execute(sql).fetchall()),
        key=_sortable,
    )
    assert rows_of(frame) == expected


def _sortable(row: tuple) -> tuple:
    return tuple((value is None, _plain(value)) for value in row)


def _plain(value):
    if value is None:
        return ""
    return value.isoformat() if isinstance(value, (date, datetime)) else value
