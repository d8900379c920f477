"""Compare a Spark frame with DuckDB's answer, value by value."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter
from pathlib import Path
from typing import Any

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duckdb_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    cursor = connection.execute(sql)
    return [column[0] for column in cursor.description], cursor.fetchall()


def _plain(value: Any) -> Any:
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    if isinstance(value, (int, str, decimal.Decimal, datetime.date, datetime.datetime)):
        return value
    return str(value)


def as_bag(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


# How each DuckDB type appears in Spark.
SPARK_TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "FLOAT": "float",
    "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz",
}


def duckdb_types(sf_dir: str, sql: str) -> dict[str, str]:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    return {row[0]: SPARK_TYPES.get(row[1], row[1].lower().replace(" ", "")) for row in described}
