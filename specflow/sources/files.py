"""File sources: delimited text, JSON lines, Parquet, ORC and fixed-width text."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specflow.plans.spec import Source, SourceColumn, SpecError
from specflow.sources.headers import by_header, read_declared, read_inferred
from specflow.sources.multiline import SPLIT_RECORDS, read_records
from specflow.sources.schema import declared_schema


def file_options(source: Source) -> dict[str, str]:
    """Reader options; the source's own ``options`` (``multiLine``, ``escape``, ...) win."""
    options = {}
    if source.file_type in ("csv", "delimited"):
        options = {
            "sep": source.delimiter,
            "quote": source.quote,
            "header": str(source.header).lower(),
        }
        if source.infer_schema:
            options["inferSchema"] = "true"
    return {**options, **{name: str(value) for name, value in source.options.items()}}


def reader_format(source: Source) -> str:
    return {"delimited": "csv", "fixedWidth": "text"}.get(source.file_type, source.file_type)


def read_file(spark: SparkSession, source: Source) -> DataFrame:
    """A batch frame over the source's files. Delimited files whose headers name the columns are read by name."""
    reader = spark.read.format(reader_format(source)).options(**file_options(source))
    if source.file_type == "fixedWidth":
        return slice_lines(reader.load(source.location), source)
    if _is_split(source):
        return read_records(spark, source.location, file_options(source), declared_schema(source))
    if _has_names(source):
        found = _read_by_name(spark, source, _files_of(spark, source))
        if found is not None:
            return found
    if not source.infer_schema:
        reader = reader.schema(declared_schema(source))
    return reader.load(source.location)


def read_files(spark: SparkSession, source: Source, paths: list[str]) -> DataFrame:
    """As :func:`read_file`, over these files; their names are taken as they are, also where they look like patterns."""
    if not paths:
        empty = spark.createDataFrame([], "value string" if source.file_type == "fixedWidth" else declared_schema(source))
        return slice_lines(empty, source) if source.file_type == "fixedWidth" else empty
    reader = spark.read.format(reader_format(source)).options(**file_options(source)).option("__globPaths__", "false")
    if source.file_type == "fixedWidth":
        return slice_lines(reader.load(paths), source)
    if _has_names(source):
        found = _read_by_name(spark, source, paths)
        if found is not None:
            return found
    return reader.schema(declared_schema(source)).load(paths)


def _is_split(source: Source) -> bool:
    asked = {name.lower(): str(value).lower() for name, value in source.options.items()}.get(SPLIT_RECORDS.lower()) == "true"
    if asked and (source.file_type not in ("csv", "delimited") or source.infer_schema):
        raise SpecError(f"source {source.id}: {SPLIT_RECORDS} is for delimited text with declared columns")
    return asked


def _has_names(source: Source) -> bool:
    return source.file_type in ("csv", "delimited") and source.header and "header" not in {name.lower() for name in source.options}


def _files_of(spark: SparkSession, source: Source) -> list[str]:
    """The files at the source's location, as its reader lists them; their contents are not read."""
    listed = spark.read.format("text").options(**{k: v for k, v in file_options(source).items() if k.lower() in ("recursivefilelookup", "pathglobfilter", "modifiedafter", "modifiedbefore")})
    return [_decoded(path) for path in listed.load(source.location).inputFiles()]


def _decoded(uri: str) -> str:
    """Listings name files as URIs."""
    return unquote(uri)


def _read_by_name(spark: SparkSession, source: Source, paths: list[str]) -> DataFrame | None:
    groups = by_header(spark, sorted(paths), source)
    plain = {name: value for name, value in file_options(source).items() if name.lower() not in ("recursivefilelookup", "pathglobfilter")}
    reader = spark.read.format("csv").options(**plain).option("__globPaths__", "false")
    if source.infer_schema:
        return read_inferred(reader, groups, source)
    schema = declared_schema(source)
    if set(groups) == {tuple(schema.names)}:
        return None  # by position is by name
    return read_declared(reader, groups, source, schema)


def slice_lines(lines: DataFrame, source: Source) -> DataFrame:
    """Cut each line into trimmed text fields by position and length.

    Fields lie side by side in the order of their positions. Text beyond the last
    field is dropped, and a field that starts past the end of its line is null.
    With a record size, only lines of exactly that many characters are kept.
    """
    if source.record_size:
        lines = lines.where(F.length("value") == source.record_size)
    return lines.select(*_slices(source))


def _slices(source: Source) -> list[Column]:
    start, slices = 1, []
    for column in sorted(source.columns, key=_position):
        if not column.length:
            raise SpecError(f"source {source.id}: column {column.name} has no length")
        text = F.trim(F.substring("value", start, column.length))
        slices.append(F.when(F.length("value") >= start, text).alias(column.name))
        start += column.length
    return slices


def _position(column: SourceColumn) -> int:
    if column.position is None:
        raise SpecError(f"column {column.name} has no position")
    return column.position
