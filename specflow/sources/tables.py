"""Catalog tables and JDBC tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from specflow.operators.layout import SPREAD
from specflow.plans.spec import Sink, Source, SpecError, quoted, secret

# The four reader options that together split a JDBC read into parallel ranges.
RANGE_OPTIONS = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def read_table(spark: SparkSession, source: Source, placed: bool = False) -> DataFrame:
    """The declared columns of a catalog table, so the scan reads no others.

    With ``placed``, a table that is laid out for joins also shows where its rows lie.
    """
    table = spark.table(source.table)
    names = [column.name for column in source.columns]
    if placed and SPREAD in table.columns and SPREAD not in names:
        names.append(SPREAD)
    return table.select(*(quoted(name) for name in names))


def connection_options(end: Source | Sink) -> dict[str, str]:
    """Connection settings; credentials may be environment references."""
    settings = {
        "url": end.url,
        "driver": end.driver,
        "dbtable": end.table,
        "user": secret(end.user),
        "password": secret(end.password),
    }
    return {name: value for name, value in settings.items() if value is not None}


def read_jdbc(spark: SparkSession, source: Source) -> DataFrame:
    """A JDBC table with the database's own schema.

    Without range options Spark reads the table through one connection. A large
    table should name a numeric, date or timestamp ``partitionColumn`` with its
    bounds and ``numPartitions``; rows outside the bounds still arrive, in the
    first and last range.
    """
    given = [name for name in RANGE_OPTIONS if name in source.options]
    if given and len(given) < len(RANGE_OPTIONS):
        missing = [name for name in RANGE_OPTIONS if name not in given]
        raise SpecError(f"source {source.id}: a parallel read also needs {', '.join(missing)}")
    own = {name: str(value) for name, value in source.options.items()}
    return spark.read.format("jdbc").options(**connection_options(source), **own).load()
