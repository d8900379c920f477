"""What the registered queries share: the given tables as sources, and a registry."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specflow.plans.run import run_all, sink_frames
from specflow.plans.session import pipeline_session
from specflow.plans.spec import Link, Pipeline, Sink, SinkColumn, Source, SourceColumn
from specflow.sinks.storage import new_folder
from specflow.sources import read

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The columns of the given tables.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp"
    ),
    "events": "event_id long, ts timestamp, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
}


def query(key: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its DuckDB equivalent where one exists."""

    def register(function: Query) -> Query:
        QUERIES[key] = function
        if oracle is not None:
            ORACLES[key] = oracle
        return function

    return register


def session_for(spark: SparkSession, pipeline: Pipeline | None = None) -> SparkSession:
    session = pipeline_session(spark, pipeline)
    session.conf.set("spark.sql.session.timeZone", "UTC")
    return session


def columns_of(table: str, names: list[str] | None = None) -> tuple[SourceColumn, ...]:
    declared = [part.split() for part in TABLES[table].split(", ")]
    kept = [(name, kind) for name, kind in declared if names is None or name in names]
    return tuple(SourceColumn(name, kind, position) for position, (name, kind) in enumerate(kept, 1))


def given(table: str, sf_dir: str, source_id: str | None = None) -> Source:
    """A given table as a Parquet source."""
    return Source(source_id or table, "parquet", columns_of(table), f"{sf_dir}/{table}.parquet")


def col_id(source: Source, name: str) -> int:
    return next(column.col_id for column in source.columns if column.name == name)


def link(source: Source, name: str | None, sink_id: str, position: int) -> Link:
    return Link(source.id, sink_id, position, None if name is None else col_id(source, name))


def mapped(
    source: Source, targets: list[tuple[str | None, SinkColumn]], sink_id: str = "out"
) -> tuple[tuple[SinkColumn, ...], tuple[Link, ...]]:
    """Sink columns numbered in order, and their links to the source."""
    columns, links = [], []
    for position, (name, column) in enumerate(targets, 1):
        columns.append(SinkColumn(**{**column.__dict__, "col_id": position}))
        links.append(link(source, name, sink_id, position))
    return tuple(columns), tuple(links)


def same_columns(source: Source) -> list[tuple[str | None, SinkColumn]]:
    return [(column.name, SinkColumn(column.name, column.type)) for column in source.columns]


def lazy(spark: SparkSession, source: Source, targets: list[tuple[str | None, SinkColumn]], **settings: Any) -> DataFrame:
    """The frame a one-source pipeline would write."""
    columns, links = mapped(source, targets)
    sink = Sink("out", "parquet", columns, location="unused")
    pipeline = Pipeline("query", (source,), (sink,), links, **settings)
    return plain_times(sink_frames(session_for(spark, pipeline), pipeline)["out"])


def copy(
    spark: SparkSession,
    source: Source,
    file_type: str,
    targets: list[tuple[str | None, SinkColumn]] | None = None,
    times: int = 1,
    **settings: Any,
) -> Sink:
    """Run a one-source pipeline into a new sink and return the sink."""
    session = session_for(spark)
    columns, links = mapped(source, targets or same_columns(source))
    settings.setdefault("location", new_folder(session, "query"))
    sink = Sink("out", file_type, columns, **settings)
    for _ in range(times):
        run_all(session, [Pipeline("copy", (source,), (sink,), links)])
    return sink


def reread(spark: SparkSession, sink: Sink, columns: tuple[SourceColumn, ...], **settings: Any) -> DataFrame:
    """A file sink's rows, read as a declared source."""
    settings.setdefault("location", sink.path)
    return plain_times(read(session_for(spark), Source("back", sink.file_type, columns, **settings)))


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the given tables hold them."""
    return df.select(
        *(
            F.col(field.name).cast("timestamp_ntz").alias(field.name)
            if isinstance(field.dataType, T.TimestampType)
            else F.col(field.name)
            for field in df.schema.fields
        )
    )
