"""What a pipeline is: sources, sinks, mappings and the steps between them.

Everything here is a small frozen description. Nothing touches Spark data; a
description that cannot be run raises :class:`SpecError` when it is built, so a
typing mistake never turns into a silently wrong column.
"""

from __future__ import annotations

import os
import re
from collections.abc import Mapping as MappingType
from dataclasses import dataclass, field
from typing import Any


class SpecError(ValueError):
    """A pipeline description that cannot be run as written."""


# The file types, save modes and type names a description may use.
SOURCE_FILE_TYPES = ("json", "parquet", "orc", "csv", "delimited", "fixedWidth", "hivetable", "jdbcclient")
SINK_FILE_TYPES = ("json", "parquet", "orc", "csv", "delimited", "hivetable", "jdbcclient")
SAVE_MODES = ("append", "overwrite", "ignore", "errorifexists")
TYPE_NAMES = {
    "string": "string",
    "int": "int",
    "integer": "int",
    "long": "bigint",
    "longinteger": "bigint",
    "float": "float",
    "singlereal": "float",
    "double": "double",
    "real": "double",
    "boolean": "boolean",
    "bool": "boolean",
    "timestamp": "timestamp",
    "datetime": "timestamp",
}
NUMERIC_TYPES = ("int", "bigint", "float", "double")

_ENVIRONMENT_REFERENCE = re.compile(r"^\$\{env:([A-Za-z_][A-Za-z0-9_]*)\}$")


def spark_type(declared: str, *, strict: bool) -> str:
    """The Spark type for a declared name; ``strict`` allows the documented names only."""
    name = declared.strip()
    known = TYPE_NAMES.get(name.lower())
    if known is not None:
        return known
    if strict:
        raise SpecError(f"unknown column type {declared!r}; use one of {sorted(TYPE_NAMES)}")
    return name


def secret(value: str | None) -> str | None:
    """A credential as given, or taken from the environment for ``${env:NAME}``."""
    reference = _ENVIRONMENT_REFERENCE.match(value or "")
    if reference is None:
        return value
    name = reference.group(1)
    if name not in os.environ:
        raise SpecError(f"environment variable {name} is not set")
    return os.environ[name]


def quoted(*parts: str) -> str:
    """A (qualified) column name safe to place in a SQL expression."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def _check_choice(what: str, value: str, allowed: tuple[str, ...]) -> None:
    if value not in allowed:
        raise SpecError(f"{what} {value!r} is not one of {', '.join(allowed)}")


def _check_ids(what: str, columns: tuple[Any, ...]) -> None:
    for attribute in ("col_id", "name"):
        values = [getattr(column, attribute) for column in columns]
        repeated = sorted({str(v) for v in values if values.count(v) > 1})
        if repeated:
            raise SpecError(f"{what}: {attribute} given twice: {', '.join(repeated)}")


@dataclass(frozen=True)
class SourceColumn:
    name: str
    type: str = "string"
    col_id: int = 0
    position: int | None = None
    length: int | None = None
    nullable: bool = True


@dataclass(frozen=True)
class Source:
    id: str
    file_type: str
    columns: tuple[SourceColumn, ...] = ()
    location: str | None = None
    header: bool = False
    delimiter: str = ","
    quote: str = '"'
    infer_schema: bool = False
    record_size: int = 0
    table: str | None = None
    url: str | None = None
    driver: str | None = None
    user: str | None = field(default=None, repr=False)
    password: str | None = field(default=None, repr=False)
    options: MappingType[str, Any] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        _check_choice(f"source {self.id}: file type", self.file_type, SOURCE_FILE_TYPES)
        _check_ids(f"source {self.id}", self.columns)
        if self.file_type in ("hivetable", "jdbcclient"):
            if not self.table:
                raise SpecError(f"source {self.id}: a table name is needed")
        elif not self.location:
            raise SpecError(f"source {self.id}: a location is needed")
        if self.file_type == "jdbcclient" and not self.url:
            raise SpecError(f"source {self.id}: a url is needed")
        if self.infer_schema and self.file_type not in ("csv", "delimited"):
            raise SpecError(f"source {self.id}: only delimited text can infer its schema")
        if self.infer_schema and not self.header:
            raise SpecError(f"source {self.id}: an inferred schema takes its names from the header")
        if not self.columns and not self.infer_schema and self.file_type != "jdbcclient":
            raise SpecError(f"source {self.id}: no columns are declared")

    def column(self, col_id: int) -> SourceColumn:
        for column in self.columns:
            if column.col_id == col_id:
                return column
        raise SpecError(f"source {self.id} has no column with id {col_id}")


@dataclass(frozen=True)
class SinkColumn:
    name: str
    type: str = "string"
    col_id: int = 0
    transform: str | None = None
    default: str | None = None
    required: bool = False
    minimum: float | int | None = None
    maximum: float | int | None = None
    min_length: int | None = None
    max_length: int | None = None


@dataclass(frozen=True)
class Sink:
    id: str
    file_type: str
    columns: tuple[SinkColumn, ...] = ()
    location: str | None = None
    mode: str = "errorifexists"
    compression: str | None = None
    num_partitions: int | None = None
    partition_by: tuple[str, ...] = ()
    header: bool = False
    delimiter: str = ","
    quote: str = '"'
    table: str | None = None
    url: str | None = None
    driver: str | None = None
    user: str | None = field(default=None, repr=False)
    password: str | None = field(default=None, repr=False)
    options: MappingType[str, Any] = field(default_factory=dict, repr=False)
    rebalance: bool = True
    bucket_by: tuple[str, ...] = ()
    buckets: int | None = None

    def __post_init__(self) -> None:
        _check_choice(f"sink {self.id}: file type", self.file_type, SINK_FILE_TYPES)
        _check_choice(f"sink {self.id}: mode", self.mode, SAVE_MODES)
        _check_ids(f"sink {self.id}", self.columns)
        if self.file_type in ("hivetable", "jdbcclient"):
            if not self.table:
                raise SpecError(f"sink {self.id}: a table name is needed")
        elif not self.location:
            raise SpecError(f"sink {self.id}: a location is needed")
        if self.file_type == "jdbcclient" and not self.url:
            raise SpecError(f"sink {self.id}: a url is needed")
        if self.file_type == "jdbcclient" and self.partition_by:
            raise SpecError(f"sink {self.id}: a JDBC table cannot be partitioned by a column")
        if self.num_partitions is not None and self.num_partitions < 1:
            raise SpecError(f"sink {self.id}: numPartitions must be at least 1")
        self._check_buckets()

    def _check_buckets(self) -> None:
        if not self.bucket_by and self.buckets is None:
            return
        if not self.bucket_by or self.buckets is None or self.buckets < 1:
            raise SpecError(f"sink {self.id}: a layout for joins needs its columns and a number of buckets")
        if self.file_type != "hivetable":
            raise SpecError(f"sink {self.id}: only catalog tables can be laid out for joins")
        if self.num_partitions is not None:
            raise SpecError(f"sink {self.id}: the buckets decide the number of files")
        if set(self.bucket_by) & set(self.partition_by):
            raise SpecError(f"sink {self.id}: a column either parts the table or its buckets")

    def column(self, col_id: int) -> SinkColumn:
        for column in self.columns:
            if column.col_id == col_id:
                return column
        raise SpecError(f"sink {self.id} has no column with id {col_id}")

    @property
    def is_file(self) -> bool:
        return self.file_type not in ("hivetable", "jdbcclient")

    @property
    def format(self) -> str:
        """The Spark writer format; ``delimited`` is another name for ``csv``."""
        return "csv" if self.file_type == "delimited" else self.file_type

    @property
    def path(self) -> str:
        """Where a file sink writes: ``<location>/<id>_<type>/<type>``."""
        base = (self.location or "").rstrip("/")
        return f"{base}/{self.id}_{self.file_type}/{self.file_type}"


@dataclass(frozen=True)
class Link:
    """One mapped column; no source column means the sink column's default."""

    source_id: str
    sink_id: str
    sink_column: int
    source_column: int | None = None


@dataclass(frozen=True)
class JoinKey:
    left_id: str
    left_column: int
    right_id: str
    right_column: int

    @classmethod
    def parse(cls, text: str) -> tuple["JoinKey", ...]:
        """``A:2=B:1``; further pairs follow after commas."""
        return tuple(cls(*_join_pair(pair)) for pair in text.split(","))


def _join_pair(pair: str) -> tuple[str, int, str, int]:
    sides = pair.split("=")
    if len(sides) != 2:
        raise SpecError(f"join {pair!r} is not written as source:column=source:column")
    left, right = (_column_reference(side, "join") for side in sides)
    return (*left, *right)


def _column_reference(text: str, what: str) -> tuple[str, int]:
    owner, colon, col_id = text.strip().rpartition(":")
    if not colon or not owner or not col_id.strip().isdigit():
        raise SpecError(f"{what} refers to a column as {text!r}; write id:column")
    return owner.strip(), int(col_id)


@dataclass(frozen=True)
class Predicate:
    """A filter: one source column followed by free SQL, e.g. ``='Fitness'``."""

    source_id: str
    source_column: int
    tail: str

    @classmethod
    def parse(cls, text: str) -> "Predicate":
        reference, at, tail = text.partition("@")
        if not at:
            raise SpecError(f"filter {text!r} is not written as source:column@condition")
        return cls(*_column_reference(reference, "filter"), tail)


@dataclass(frozen=True)
class Pipeline:
    id: str
    sources: tuple[Source, ...]
    sinks: tuple[Sink, ...]
    links: tuple[Link, ...] = ()
    joins: tuple[JoinKey, ...] = ()
    predicate: Predicate | None = None
    query: str | None = None
    validation: bool = False
    active: bool = True

    def __post_init__(self) -> None:
        for what, members in (("source", self.sources), ("sink", self.sinks)):
            ids = [member.id for member in members]
            if not ids:
                raise SpecError(f"pipeline {self.id}: no {what} is given")
            if len(set(ids)) != len(ids):
                raise SpecError(f"pipeline {self.id}: a {what} is given twice")
        if self.query is not None:
            if self.links or self.joins or self.predicate is not None:
                raise SpecError(f"pipeline {self.id}: a query replaces mapping, join and filter")
            return
        for link in self.links:
            column = self.sink(link.sink_id).column(link.sink_column)
            if link.source_column is None:
                self.source(link.source_id)
                if column.default is None:
                    raise SpecError(
                        f"pipeline {self.id}: {link.sink_id}.{column.name} has neither a source column nor a default"
                    )
            else:
                self._check_column(link.source_id, link.source_column)
        for sink in self.sinks:
            if not any(link.sink_id == sink.id for link in self.links):
                raise SpecError(f"pipeline {self.id}: nothing is mapped to sink {sink.id}")
        for key in self.joins:
            self._check_column(key.left_id, key.left_column)
            self._check_column(key.right_id, key.right_column)
        if self.predicate is not None:
            self._check_column(self.predicate.source_id, self.predicate.source_column)
        if len(self.sources) > 1 and not self.joins:
            raise SpecError(f"pipeline {self.id}: several sources need a join")

    def _check_column(self, source_id: str, col_id: int) -> None:
        self.source(source_id).column(col_id)

    def source(self, source_id: str) -> Source:
        for source in self.sources:
            if source.id == source_id:
                return source
        raise SpecError(f"pipeline {self.id} has no source {source_id}")

    def sink(self, sink_id: str) -> Sink:
        for sink in self.sinks:
            if sink.id == sink_id:
                return sink
        raise SpecError(f"pipeline {self.id} has no sink {sink_id}")

    def sql_texts(self) -> list[str]:
        """All SQL that the description holds: query, filter, templates and defaults."""
        columns = [column for sink in self.sinks for column in sink.columns]
        texts = [self.query, self.predicate and self.predicate.tail]
        texts += [text for column in columns for text in (column.transform, column.default)]
        return [text for text in texts if text]
