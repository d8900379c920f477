"""Read pipelines from their JSON files.

One file per record: ``src_<id>.json`` and ``srcCols_<id>.json`` for a source,
``dest_<id>.json`` and ``destCols_<id>.json`` for a sink, ``prc_<id>.json`` for
a process and ``colMapping_<mapId>.json`` for its mapping. The files are small
driver-side configuration; the data they describe never passes through here.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from configparser import ConfigParser
from dataclasses import dataclass
from functools import partial
from pathlib import Path
from typing import Any

from specflow.plans.spec import (
    JoinKey,
    Link,
    Pipeline,
    Predicate,
    Sink,
    SinkColumn,
    Source,
    SourceColumn,
    SpecError,
)

_NO_TRANSFORM = "NA"
_NO_COLUMN = -1


def flag(value: Any, default: bool = False) -> bool:
    """A JSON true/false, or its text in any case."""
    if value is None or value == "":
        return default
    text = str(value).strip().lower()
    if text not in ("true", "false"):
        raise SpecError(f"{value!r} is neither true nor false")
    return text == "true"


def whole(value: Any) -> int | None:
    if value is None or value == "":
        return None
    try:
        return int(str(value).strip())
    except ValueError:
        raise SpecError(f"{value!r} is not a whole number") from None


def number(value: Any) -> int | float | None:
    if value is None or value == "":
        return None
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return value
    text = str(value).strip()
    try:
        return int(text)
    except ValueError:
        pass
    try:
        return float(text)
    except ValueError:
        raise SpecError(f"{value!r} is not a number") from None


def _required(record: dict[str, Any], name: str) -> Any:
    if record.get(name) in (None, ""):
        raise SpecError(f"field {name} is missing in {sorted(record)}")
    return record[name]


def source_from(record: dict[str, Any], columns: list[dict[str, Any]]) -> Source:
    return Source(
        id=_required(record, "srcId"),
        file_type=_required(record, "fileType"),
        columns=tuple(
            SourceColumn(
                name=_required(column, "colName"),
                type=column.get("colType") or "string",
                col_id=whole(_required(column, "colId")),
                position=whole(column.get("colPos")),
                length=whole(column.get("length")),
                nullable=flag(column.get("isNullable"), default=True),
            )
            for column in columns
        ),
        location=record.get("srcLocation"),
        header=flag(record.get("header")),
        delimiter=record.get("delimiter") or ",",
        quote=record.get("quote") or '"',
        infer_schema=flag(record.get("inferSchema")),
        record_size=whole(record.get("recordSize")) or 0,
        table=record.get("table"),
        url=record.get("url"),
        driver=record.get("driver"),
        user=record.get("user"),
        password=record.get("password"),
        options=record.get("options") or {},
    )


def sink_from(record: dict[str, Any], columns: list[dict[str, Any]]) -> Sink:
    sink_id = _required(record, "destId")
    sink_columns = tuple(_sink_column(column) for column in columns)
    return Sink(
        id=sink_id,
        file_type=_required(record, "fileType"),
        columns=sink_columns,
        location=record.get("destLocation"),
        mode=record.get("mode") or "errorifexists",
        compression=record.get("compression"),
        num_partitions=whole(record.get("numPartitions")),
        partition_by=_columns_named(sink_id, "partitionBy", record.get("partitionBy"), sink_columns),
        header=flag(record.get("header")),
        delimiter=record.get("delimiter") or ",",
        quote=record.get("quote") or '"',
        table=record.get("table"),
        url=record.get("url"),
        driver=record.get("driver"),
        user=record.get("user"),
        password=record.get("password"),
        options=record.get("options") or {},
        rebalance=flag(record.get("rebalance"), default=True),
        bucket_by=_columns_named(sink_id, "bucketBy", record.get("bucketBy"), sink_columns),
        buckets=whole(record.get("buckets")),
    )


def _sink_column(column: dict[str, Any]) -> SinkColumn:
    transform = column.get("transFunc")
    return SinkColumn(
        name=_required(column, "colName"),
        type=column.get("colType") or "string",
        col_id=whole(_required(column, "colId")),
        transform=None if transform in (None, "", _NO_TRANSFORM) else transform,
        default=column.get("default"),
        required=flag(column.get("required")),
        minimum=number(column.get("minimum")),
        maximum=number(column.get("maximum")),
        min_length=whole(column.get("minLength")),
        max_length=whole(column.get("maxLength")),
    )


def _columns_named(sink_id: str, what: str, given: Any, columns: tuple[SinkColumn, ...]) -> tuple[str, ...]:
    if not given:
        return ()
    names = []
    for reference in given if isinstance(given, list) else [given]:
        owner, _, col_id = str(reference).rpartition(":")
        if owner != sink_id:
            raise SpecError(f"sink {sink_id}: {what} {reference!r} names another sink")
        matching = [column.name for column in columns if column.col_id == whole(col_id)]
        if not matching:
            raise SpecError(f"sink {sink_id} has no column with id {col_id}")
        names += matching
    return tuple(names)


@dataclass(frozen=True)
class MetadataStore:
    """The folders that hold the records."""

    processes: str
    mappings: str
    sources: str
    source_columns: str
    sinks: str
    sink_columns: str

    @classmethod
    def under(cls, root: str) -> "MetadataStore":
        base = Path(root)
        process, source, sink = (str(base / part) for part in ("process", "source", "dest"))
        return cls(process, process, source, source, sink, sink)

    @classmethod
    def from_ini(cls, path: str, section: str) -> "MetadataStore":
        """The folders named in one section of an INI file."""
        parser = ConfigParser()
        if not parser.read(path):
            raise SpecError(f"configuration file {path} was not found")
        if section not in parser:
            raise SpecError(f"configuration file {path} has no section {section}")
        names = parser[section]
        try:
            return cls(
                processes=names["prcDetails"],
                mappings=names["prcMapping"],
                sources=names["srcDetails"],
                source_columns=names["srcCols"],
                sinks=names["destDetails"],
                sink_columns=names["destCols"],
            )
        except KeyError as missing:
            raise SpecError(f"section {section} of {path} lacks {missing}") from None

    def _records(self, folder: str, name: str) -> list[dict[str, Any]]:
        path = Path(folder) / name
        try:
            loaded = json.loads(path.read_text(encoding="utf-8"))
        except FileNotFoundError:
            raise SpecError(f"metadata file {path} was not found") from None
        except json.JSONDecodeError as broken:
            raise SpecError(f"metadata file {path} is not JSON: {broken}") from None
        return loaded if isinstance(loaded, list) else [loaded]

    def _owned(self, folder: str, prefix: str, key: str, owner: str) -> list[dict[str, Any]]:
        return [r for r in self._records(folder, f"{prefix}_{owner}.json") if r.get(key) == owner]

    def source(self, source_id: str) -> Source:
        records = self._owned(self.sources, "src", "srcId", source_id)
        if len(records) != 1:
            raise SpecError(f"source {source_id}: expected one record, found {len(records)}")
        return source_from(records[0], self._owned(self.source_columns, "srcCols", "srcId", source_id))

    def sink(self, sink_id: str) -> Sink:
        records = self._owned(self.sinks, "dest", "destId", sink_id)
        if len(records) != 1:
            raise SpecError(f"sink {sink_id}: expected one record, found {len(records)}")
        return sink_from(records[0], self._owned(self.sink_columns, "destCols", "destId", sink_id))

    def process_files(self, pattern: str = r"prc_.*\.json") -> list[str]:
        """The process files whose whole name matches."""
        names = (path.name for path in Path(self.processes).glob("*.json"))
        return sorted(name for name in names if re.fullmatch(pattern, name))

    def active(self, process_file: str) -> list[tuple[str, Callable[[], Pipeline]]]:
        """The active processes of a file: their ids, and how to load each."""
        records = self._records(self.processes, process_file)
        return [(_required(r, "prcId"), partial(self._pipeline, r)) for r in records if flag(r.get("isActive"))]

    def pipelines(self, process_file: str) -> Iterator[Pipeline]:
        """The active pipelines of one process file."""
        return (load() for _, load in self.active(process_file))

    def pipeline(self, process_id: str) -> Pipeline:
        for active_id, load in self.active(f"prc_{process_id}.json"):
            if active_id == process_id:
                return load()
        raise SpecError(f"process {process_id} is not active or not described")

    def _pipeline(self, record: dict[str, Any]) -> Pipeline:
        process_id, map_id = _required(record, "prcId"), _required(record, "mapId")
        mapping = self._owned(self.mappings, "colMapping", "mapId", map_id)
        if not mapping:
            raise SpecError(f"process {process_id}: mapping {map_id} is empty")
        validation = flag(record.get("validation"))
        if flag(record.get("queryProvided")):
            return self._query_pipeline(process_id, mapping, validation)
        links = tuple(
            Link(
                source_id=_required(row, "srcId"),
                sink_id=_required(row, "destId"),
                sink_column=whole(_required(row, "destColId")),
                source_column=_mapped_column(row.get("srcColId")),
            )
            for row in mapping
        )
        joins, predicate = record.get("joinCol"), record.get("filterCondition")
        return Pipeline(
            id=process_id,
            sources=tuple(self.source(i) for i in dict.fromkeys(link.source_id for link in links)),
            sinks=tuple(self.sink(i) for i in dict.fromkeys(link.sink_id for link in links)),
            links=links,
            joins=JoinKey.parse(joins) if joins else (),
            predicate=Predicate.parse(predicate) if predicate else None,
            validation=validation,
        )

    def _query_pipeline(self, process_id: str, mapping: list[dict[str, Any]], validation: bool) -> Pipeline:
        if len(mapping) != 1:
            raise SpecError(f"process {process_id}: a query mapping holds one record, found {len(mapping)}")
        row = mapping[0]
        return Pipeline(
            id=process_id,
            sources=tuple(self.source(i) for i in dict.fromkeys(_id_list(row, "srcId"))),
            sinks=tuple(self.sink(i) for i in dict.fromkeys(_id_list(row, "destId"))),
            query=_required(row, "query"),
            validation=validation,
        )


def _id_list(row: dict[str, Any], name: str) -> list[str]:
    given = _required(row, name)
    return given if isinstance(given, list) else [given]


def _mapped_column(value: Any) -> int | None:
    col_id = whole(value)
    return None if col_id in (None, _NO_COLUMN) else col_id
