"""Run queries next to their SQL and compare the rows, whatever their order."""

from __future__ import annotations

import math
from datetime import datetime
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES

TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS FROM '{file}'")
    return connection


def _sortable(row: tuple) -> tuple:
    return tuple(("", "") if v is None else (type(v).__name__, "NaN" if v != v else v) for v in row)


def _normal(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value.replace(tzinfo=None) if isinstance(value, datetime) else value


def difference(spark: SparkSession, connection: duckdb.DuckDBPyConnection, sf_dir: str, name: str) -> str | None:
    """None when both sides agree on columns, types and every value; else what differs."""
    result = QUERIES[name](spark, sf_dir)
    columns = sorted(result.columns)
    expected = connection.execute(ORACLES[name])
    kinds = {c[0]: str(c[1]) for c in expected.description}
    if columns != sorted(kinds):
        return f"columns {columns} and {sorted(kinds)}"
    for column, kind in result.dtypes:
        if TYPES[kind] != connection.execute(f"SELECT typeof({column}) FROM ({ORACLES[name]}) LIMIT 1").fetchone()[0]:
            return f"type of {column}: {kind}"
    place = [list(kinds).index(c) for c in columns]
    theirs = sorted(
        (tuple(_normal(row[i]) for i in place) for row in connection.execute(ORACLES[name]).fetchall()), key=_sortable
    )
    ours = sorted((tuple(_normal(row[c]) for c in columns) for row in result.collect()), key=_sortable)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows, {len(theirs)} expected"
    for mine, other in zip(ours, theirs):
        if mine != other:
            return f"{columns}: {mine}, {other} expected"
    return None
