"""Check each row against the rules of its columns, as native column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specflow.plans.spec import NUMERIC_TYPES, SinkColumn, SpecError, quoted, spark_type

VALID_COLUMN = "valid"
ERROR_COLUMN = "errMsg"


def with_rules(df: DataFrame, columns: Iterable[SinkColumn]) -> DataFrame:
    """Add ``valid`` (``Y`` or ``N``) and ``errMsg`` (the first broken rule, or empty).

    Rules are tried in column order and, within a column, in the order required,
    type, minimum, maximum, minimum length, maximum length. A null passes every
    rule but ``required``. Columns that already carry the two names are replaced.
    Bounds on what is no number, lengths of what is no text, and either on a column
    that is not there are refused.
    """
    messages = [message for column in columns for message in rule_messages(df.schema, column)]
    error = F.coalesce(*messages, F.lit("")) if messages else F.lit("")
    kept = [name for name in df.columns if name.lower() not in (VALID_COLUMN, ERROR_COLUMN.lower())]
    checked = df.select(*(quoted(name) for name in kept), error.alias(ERROR_COLUMN))
    valid = F.when(F.col(ERROR_COLUMN) == "", "Y").otherwise("N").alias(VALID_COLUMN)
    return checked.select(*(quoted(name) for name in kept), valid, ERROR_COLUMN)


def rule_messages(schema: T.StructType, column: SinkColumn) -> Iterator[Column]:
    """For each rule of a column, its message where the rule is broken and null elsewhere."""
    _refuse_unusable(schema, column)
    if column.name not in schema.names:
        if column.required:
            yield F.lit(_missing(column))
        return
    value, data_type = F.col(quoted(column.name)), schema[column.name].dataType
    shown = _shown(value, data_type)
    if column.required:
        yield F.when(value.isNull(), _missing(column))
    yield from _type_messages(value, data_type, shown, spark_type(column.type, strict=False))
    if isinstance(data_type, T.NumericType):
        if column.minimum is not None:
            yield F.when(
                value < column.minimum, F.concat(shown, F.lit(f" is less than the minimum of {column.minimum}"))
            )
        if column.maximum is not None:
            yield F.when(
                value > column.maximum, F.concat(shown, F.lit(f" is greater than the maximum of {column.maximum}"))
            )
    if isinstance(data_type, T.StringType) or _kind(spark_type(column.type, strict=False)) is None:
        # types outside the documented ones are checked as the text they are written as
        length = F.length(value.cast("string"))
        if column.min_length is not None:
            yield F.when(length < column.min_length, F.concat(shown, F.lit(" is too short")))
        if column.max_length is not None:
            yield F.when(length > column.max_length, F.concat(shown, F.lit(" is too long")))


def _refuse_unusable(schema: T.StructType, column: SinkColumn) -> None:
    """Rules that no row could ever break are a mistake in the description."""
    bounded = column.minimum is not None or column.maximum is not None
    measured = column.min_length is not None or column.max_length is not None
    if column.name not in schema.names:
        if bounded or measured:
            raise SpecError(f"column {column.name}: its rules need a column of that name")
        return
    # a column that is not what it is declared as breaks the type rule instead
    declared = spark_type(column.type, strict=False)
    data_type, kind = schema[column.name].dataType, _kind(declared)
    if bounded and not isinstance(data_type, T.NumericType) and kind not in ("integer", "number"):
        raise SpecError(f"column {column.name}: a minimum or maximum needs numbers")
    if measured and not isinstance(data_type, T.StringType) and kind is not None and declared != "string":
        raise SpecError(f"column {column.name}: a minimum or maximum length needs text")


def _missing(column: SinkColumn) -> str:
    return f"'{column.name}' is a required property"


def _shown(value: Column, data_type: T.DataType) -> Column:
    text = value.cast("string")
    if isinstance(data_type, (T.NumericType, T.BooleanType)):
        return text
    return F.concat(F.lit("'"), text, F.lit("'"))


def _type_messages(value: Column, data_type: T.DataType, shown: Column, declared: str) -> Iterator[Column]:
    """The type rule. Mapped columns are cast, so it only bites on a query's own columns
    and on floating-point values that are not numbers."""
    expected = _kind(declared)
    if expected is None:
        return
    message = F.lit(f" is not of type '{expected}'")
    if expected not in _kinds_of(data_type):
        yield F.when(value.isNotNull(), F.concat(shown, message))
    elif isinstance(data_type, T.FractionalType) and not isinstance(data_type, T.DecimalType):
        not_finite = F.isnan(value) | value.isin(float("inf"), float("-inf"))
        yield F.when(not_finite, F.concat(F.lit("'"), shown, F.lit("'"), message))


def _kind(declared: str) -> str | None:
    if declared == "int":
        return "integer"
    if declared in NUMERIC_TYPES:
        return "number"
    if declared == "boolean":
        return "boolean"
    if declared in ("string", "timestamp"):
        return "string"
    return None


def _kinds_of(data_type: T.DataType) -> tuple[str, ...]:
    if isinstance(data_type, T.IntegralType):
        return ("integer", "number")
    if isinstance(data_type, T.NumericType):
        return ("number",)
    if isinstance(data_type, T.BooleanType):
        return ("boolean",)
    if isinstance(data_type, (T.StringType, T.DatetimeType, T.BinaryType, T.NullType)):
        return ("string",)
    return ()
