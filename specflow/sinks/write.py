"""Write a frame to any described sink."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from specflow.operators.layout import KEYS_SUFFIX, SPREAD, bucket_number, frequent_keys, keys_frame, spread
from specflow.operators.profiling import observed, observed_sides
from specflow.operators.rules import VALID_COLUMN
from specflow.plans.spec import Sink, SpecError, quoted
from specflow.sinks.storage import beside, create_empty, delete, exists, move_into, recover, swap_in, written_once
from specflow.sources.tables import connection_options

_INVALID_SUFFIX = "_INVALID"
_CONNECTIONS = 8
_BUCKET = f"{SPREAD}_bucket"


@dataclass(frozen=True)
class Written:
    """What one write did; ``states`` are what its profile can be merged from, ``part`` the sink and side."""

    target: str
    skipped: bool
    rows: int | None
    profile: list[dict[str, Any]]
    states: list[dict[str, Any]] = field(default_factory=list)
    part: str = ""


#: Names the increments of a landing: a folder level of files, a partition column of tables.
INCREMENT = "batch_id"


def target_of(sink: Sink, suffix: str = "", increment: int | None = None) -> str:
    if not sink.is_file:
        return sink.table + suffix
    return sink.path + suffix + ("" if increment is None else f"/{INCREMENT}={increment}")


def write(
    df: DataFrame, sink: Sink, suffix: str = "", increment: int | None = None, profiles: bool = False
) -> Written:
    """Write all rows in one pass, which also counts them and, if asked, profiles them.

    An ``ignore`` write into a JDBC table is left to the database and not counted.
    An ``increment`` of a table replaces that partition and no other.
    """
    target = target_of(sink, suffix, increment)
    if sink.is_file:
        recover(df.sparkSession, target)
    if sink.mode == "ignore":
        if sink.file_type == "jdbcclient":
            _save(_writer(distributed(df, sink), sink), sink, target)
            return Written(target, skipped=False, rows=None, profile=[])
        if _is_there(df.sparkSession, sink, target):
            return Written(target, skipped=True, rows=None, profile=[])
    if sink.bucket_by:
        return _write_laid_out(df, sink, target, suffix, profiles)
    # above the last shuffle, so that only tasks that commit their output count
    counted, observation = observed(distributed(df, sink), f"rows of {target}", profiles)
    if increment is not None and not sink.is_file:
        _replace_increment(counted, sink, target, increment)
    elif sink.is_file:
        _save_files(counted, sink, target)
    else:
        _save(_writer(counted, sink), sink, target)
    return Written(target, False, observation.rows, observation.records(), observation.states(), sink.id + suffix)


def _write_laid_out(df: DataFrame, sink: Sink, target: str, suffix: str, profiles: bool) -> Written:
    """Write a table bucketed and sorted by its keys, with frequent keys spread over buckets.

    The rows are stored once, as their keys are counted before they are dealt out. Frequent keys are listed before the
    rows are there: a list that names more than the table holds is harmless, one that names less would lose rows of joins.
    """
    spark = df.sparkSession
    with written_once(df) as rows:
        listed = frequent_keys(rows, sink.bucket_by, sink.buckets)
        keys = replace(sink, table=target + KEYS_SUFFIX, partition_by=(), bucket_by=(), buckets=None, compression=None, options=_beside_options(sink))
        _save(_writer(keys_frame(spark, listed), replace(keys, mode="append")), keys, keys.table)
        counted, observation = observed(distributed(spread(rows, sink.bucket_by, listed), sink), f"rows of {target}", profiles)
        _save(_writer(counted, sink), sink, target)
        if sink.mode != "append":
            _save(_writer(keys_frame(spark, listed), replace(keys, mode="overwrite")), keys, keys.table)
    profile, states = (
        [column for column in columns if column["column_name"] != SPREAD] for columns in (observation.records(), observation.states())
    )
    return Written(target, False, observation.rows, profile, states, sink.id + suffix)


def _beside_options(sink: Sink) -> dict[str, str]:
    """A table with a place of its own has its keys beside it."""
    return {name: value.rstrip("/") + KEYS_SUFFIX for name, value in _own_options(sink).items() if name.lower() == "path"}


def write_split(
    checked: DataFrame, sink: Sink, increment: int | None = None, profiles: bool = False, repeatable: bool = False
) -> tuple[Written, Written]:
    """Write valid rows to the sink and the rest beside it, under ``_INVALID``.

    Files are written in one pass, into a layout split by side whose folders then take their places. Tables are
    written one after the other: the checked rows are computed once, into a table laid out by validity, so each side
    reads only its own files. Rows that are ``repeatable``, because a second reading is cheap and surely the same, are
    read by each side instead.
    """
    if sink.is_file and not _is_dynamic(checked.sparkSession, sink):
        return _write_tagged(checked, sink, increment, profiles)
    if repeatable:
        return _write_sides(checked, sink, increment, profiles)
    with written_once(checked, partition_by=(VALID_COLUMN,)) as rows:
        return _write_sides(rows, sink, increment, profiles)


#: What marks the rows of either side, and what its place is called.
_SIDES = {"Y": "", "N": _INVALID_SUFFIX}


def _write_sides(rows: DataFrame, sink: Sink, increment: int | None, profiles: bool) -> tuple[Written, Written]:
    valid, invalid = (write(rows.where(F.col(VALID_COLUMN) == f), sink, s, increment, profiles) for f, s in _SIDES.items())
    return valid, invalid


def _write_tagged(checked: DataFrame, sink: Sink, increment: int | None, profiles: bool) -> tuple[Written, Written]:
    spark = checked.sparkSession
    targets = {flag: target_of(sink, suffix, increment) for flag, suffix in _SIDES.items()}
    for target in targets.values():
        recover(spark, target)
    there = {flag: _is_there(spark, sink, target) for flag, target in targets.items()}
    if sink.mode == "errorifexists" and any(there.values()):
        raise AnalysisException(f"[PATH_ALREADY_EXISTS] a path of sink {sink.id} is there already: {', '.join(targets.values())}")
    skipped = [flag for flag in _SIDES if sink.mode == "ignore" and there[flag]]
    if len(skipped) == len(_SIDES):
        return tuple(Written(target, skipped=True, rows=None, profile=[]) for target in targets.values())
    tag = f"side_{uuid.uuid4().hex}"
    rows = distributed(checked.withColumn(tag, F.col(VALID_COLUMN)), replace(sink, partition_by=_tagged(sink, tag)))
    counted, sides = observed_sides(rows, f"rows of {targets['Y']}", tag, tuple(_SIDES), profiles)
    staged = f"{beside(targets['Y'], 'side')}_{uuid.uuid4().hex}"
    try:
        _save(_writer(counted, replace(sink, mode="errorifexists", partition_by=(tag, *sink.partition_by))), sink, staged)
        for flag, target in targets.items():
            if flag not in skipped:
                _commit_side(spark, checked, sink, f"{staged}/{tag}={flag}", target)
    finally:
        delete(spark, staged)
    return tuple(
        Written(targets[flag], skipped=True, rows=None, profile=[]) if flag in skipped
        else Written(targets[flag], False, side.rows, side.records(), side.states(), sink.id + _SIDES[flag])
        for flag, side in zip(_SIDES, sides, strict=True)
    )


def _tagged(sink: Sink, tag: str) -> tuple[str, ...]:
    """What rows are rebalanced on: without partition columns nothing, as each task may write both sides."""
    return (tag, *sink.partition_by) if sink.partition_by else ()


def _commit_side(spark: SparkSession, checked: DataFrame, sink: Sink, staged: str, target: str) -> None:
    if not exists(spark, staged):
        # no rows on this side: a file that has the columns, where the format keeps them
        _save_files(spark.createDataFrame([], checked.schema), sink, target)
    elif sink.mode == "append":
        move_into(spark, staged, target)
        create_empty(spark, f"{target}/_SUCCESS")
    else:
        create_empty(spark, f"{staged}/_SUCCESS")
        swap_in(spark, staged, target)


def distributed(df: DataFrame, sink: Sink) -> DataFrame:
    """How rows are spread over output files.

    A requested number of partitions is made by a shuffle, so the work before it
    keeps its full width; a database gets a bounded number of connections either
    way. Output partitioned by column is rebalanced on those columns: each value
    lands in few, evenly sized files, and a value holding a large share of the rows
    is split over many tasks; so are buckets of a table that is laid out for joins. All other output is written where it is computed.
    """
    if sink.num_partitions is not None:
        return df.repartition(sink.num_partitions)
    if sink.file_type == "jdbcclient":
        return df.repartition(_CONNECTIONS)
    if sink.bucket_by and sink.rebalance:
        placed = df.withColumn(_BUCKET, bucket_number(sink.bucket_by, sink.buckets))
        return placed.hint("rebalance", *(F.col(quoted(name)) for name in (*sink.partition_by, _BUCKET))).drop(_BUCKET)
    if sink.partition_by and sink.rebalance:
        return df.hint("rebalance", *(F.col(quoted(name)) for name in sink.partition_by))
    return df


def _writer(df: DataFrame, sink: Sink) -> DataFrameWriter:
    writer = df.write.mode(sink.mode)
    if sink.file_type == "jdbcclient":
        return writer.format("jdbc").options(**_own_options(sink))
    if sink.is_file:
        writer = writer.format(sink.format).option("compression", sink.compression or "none")
        if sink.format == "csv":
            writer = writer.options(sep=sink.delimiter, quote=sink.quote, header=str(sink.header).lower())
    elif sink.compression:
        writer = writer.option("compression", sink.compression)
    if sink.partition_by:
        writer = writer.partitionBy(*sink.partition_by)
    if sink.bucket_by:
        placed = (*sink.bucket_by, SPREAD)
        writer = writer.bucketBy(sink.buckets, *placed).sortBy(*placed)
    return writer.options(**_own_options(sink))


def _own_options(sink: Sink) -> dict[str, str]:
    return {name: str(value) for name, value in sink.options.items()}


def _save(writer: DataFrameWriter, sink: Sink, target: str) -> None:
    if sink.file_type == "hivetable":
        writer.saveAsTable(target)
    elif sink.file_type == "jdbcclient":
        writer.options(**connection_options(replace(sink, table=target))).save()
    else:
        writer.save(target)


def _save_files(df: DataFrame, sink: Sink, target: str) -> None:
    """Write files; what they overwrite stays until they are all there."""
    spark = df.sparkSession
    if sink.mode != "overwrite" or _is_dynamic(spark, sink):
        _save(_writer(df, sink), sink, target)
        return
    staged = f"{beside(target, 'stage')}_{uuid.uuid4().hex}"
    try:
        _save(_writer(df, replace(sink, mode="errorifexists")), sink, staged)
        swap_in(spark, staged, target)
    finally:
        delete(spark, staged)


def _is_dynamic(spark: SparkSession, sink: Sink) -> bool:
    """Whether an overwrite replaces only the partitions that it writes."""
    name = "partitionOverwriteMode"
    chosen = {k.lower(): str(v) for k, v in sink.options.items()}.get(name.lower(), spark.conf.get(f"spark.sql.sources.{name}"))
    return sink.mode == "overwrite" and bool(sink.partition_by) and chosen.lower() == "dynamic"


def _replace_increment(df: DataFrame, sink: Sink, table: str, increment: int) -> None:
    """Make the rows one partition of a table, in place of what an earlier try left there."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        partitioned = replace(sink, mode="ignore", partition_by=(INCREMENT, *sink.partition_by))
        columns = df.withColumn(INCREMENT, F.lit(increment).cast("bigint")).schema
        _save(_writer(spark.createDataFrame([], columns), partitioned), partitioned, table)
    if not any(column.name == INCREMENT and column.isPartition for column in spark.catalog.listColumns(table)):
        raise SpecError(f"sink {sink.id}: table {table} has no partition column {INCREMENT}")
    names = ", ".join(quoted(name) for name in spark.table(table).columns if name != INCREMENT)
    places = ", ".join([f"{INCREMENT} = {increment}", *(quoted(name) for name in sink.partition_by)])
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({places}) SELECT {names} FROM {{rows}}", rows=df)


def _is_there(spark: SparkSession, sink: Sink, target: str) -> bool:
    if sink.file_type == "hivetable":
        return spark.catalog.tableExists(target)
    return exists(spark, target)
