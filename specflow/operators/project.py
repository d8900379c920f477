"""Map source columns to sink columns."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specflow.functions.templates import expand
from specflow.plans.spec import Link, Pipeline, Sink, quoted, spark_type


def project(df: DataFrame, pipeline: Pipeline, sink: Sink) -> DataFrame:
    """The sink's columns from a frame whose columns are addressed as source.column."""
    return df.select(*sink_columns(df, pipeline, sink))


def sink_columns(df: DataFrame, pipeline: Pipeline, sink: Sink) -> list[Column]:
    """The sink's columns, grouped by source in order of first appearance in the mapping."""
    links = [link for link in pipeline.links if link.sink_id == sink.id]
    groups = list(dict.fromkeys(link.source_id for link in links))
    links.sort(key=lambda link: groups.index(link.source_id))
    tried = [_mapped_column(pipeline, sink, link, lenient=True) for link in links]
    if _can_select(df, tried):
        return tried
    return [
        column if _can_select(df, [column]) else _mapped_column(pipeline, sink, link, lenient=False)
        for column, link in zip(tried, links, strict=True)
    ]


def _can_select(df: DataFrame, columns: list[Column]) -> bool:
    try:
        df.select(*columns)
    except AnalysisException as refused:
        if "DATATYPE_MISMATCH" not in (refused.getCondition() or ""):
            raise
        return False
    return True


def _mapped_column(pipeline: Pipeline, sink: Sink, link: Link, lenient: bool) -> Column:
    """One sink column: default, template or plain copy, cast to the declared type.

    A value that does not fit its type becomes null. Pairs of types that ``try_cast``
    refuses are left to the plain cast. A sink default applies only where no source
    column is mapped.
    """
    target = sink.column(link.sink_column)
    if link.source_column is None:
        value = F.expr(target.default)
    else:
        name = quoted(link.source_id, pipeline.source(link.source_id).column(link.source_column).name)
        value = F.expr(expand(target.transform, name)) if target.transform else F.col(name)
    declared = spark_type(target.type, strict=False)
    return (value.try_cast(declared) if lenient else value.cast(declared)).alias(target.name)
