"""Declared columns as a Spark schema."""

from __future__ import annotations

from pyspark.sql import types as T

from specflow.plans.spec import Source, spark_type

_SPARK_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def declared_schema(source: Source) -> T.StructType:
    """The schema a source declares, in declaration order.

    Position and length travel as field metadata. Nullability is descriptive:
    file readers treat every column as nullable, and the ``required`` rule is
    what checks for nulls.
    """
    fields = []
    for column in source.columns:
        extent = {"colPos": column.position, "length": column.length}
        fields.append(
            T.StructField(
                column.name,
                _SPARK_TYPES[spark_type(column.type, strict=True)],
                column.nullable,
                {name: value for name, value in extent.items() if value is not None},
            )
        )
    return T.StructType(fields)
