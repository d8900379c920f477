"""Read any described source as a lazy DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from specflow.plans.spec import Source
from specflow.sources.files import read_file
from specflow.sources.schema import declared_schema
from specflow.sources.tables import read_jdbc, read_table

__all__ = ["declared_schema", "read"]


def read(spark: SparkSession, source: Source, placed: bool = False) -> DataFrame:
    """``placed`` is for joins: tables that are laid out for them then show where their rows lie."""
    if source.file_type == "hivetable":
        return read_table(spark, source, placed)
    if source.file_type == "jdbcclient":
        return read_jdbc(spark, source)
    return read_file(spark, source)
