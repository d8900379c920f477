"""Delimited files with header lines, read by column name.

Files are grouped by their header, and each group is read in the order of its own. Only the first line of each file is
looked at, on the driver, which lists the files anyway; several at a time.
"""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specflow.plans.spec import Source, SpecError, quoted

_AT_ONCE = 16

#: From narrow to wide: a column has the first type that holds all its files' values, and text if none does.
_WIDER = (T.IntegerType(), T.LongType(), T.DecimalType(38, 0), T.DoubleType())


def by_header(spark: SparkSession, paths: list[str], source: Source) -> dict[tuple[str, ...], list[str]]:
    """The files of each header. Files without a line have none and are left out."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    charset = next((str(v) for k, v in source.options.items() if k.lower() in ("encoding", "charset")), "UTF-8")

    def first_line(path: str) -> str | None:
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        stream = hadoop_path.getFileSystem(conf).open(hadoop_path)
        try:
            codec = codecs.getCodec(hadoop_path)
            packed = stream if codec is None else codec.createInputStream(stream)
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(packed, charset))
            line = reader.readLine()
            while line is not None and not line.strip():  # as the reader of the files does
                line = reader.readLine()
            return line
        finally:
            stream.close()

    with ThreadPoolExecutor(_AT_ONCE) as pool:
        lines = list(pool.map(first_line, paths))
    found: dict[tuple[str, ...], list[str]] = {}
    for path, line in zip(paths, lines, strict=True):
        if line is not None:
            found.setdefault(tuple(_names(line.removeprefix("﻿"), source)), []).append(path)
    return found


def _names(line: str, source: Source) -> list[str]:
    if len(source.delimiter) > 1:
        return [name.strip().strip(source.quote or '"') for name in line.split(source.delimiter)]
    (names,) = csv.reader([line], delimiter=source.delimiter, quotechar=source.quote or None, quoting=csv.QUOTE_MINIMAL if source.quote else csv.QUOTE_NONE)
    return [name.strip() for name in names]


def read_declared(reader: DataFrameReader, groups: dict[tuple[str, ...], list[str]], source: Source, schema: T.StructType) -> DataFrame | None:
    """The declared columns of files that name them, whatever their order; other columns are passed over.

    None where no header names a declared column: such files are read by position. Headers that name some are refused.
    """
    declared = {name.lower(): name for name in schema.names}
    named = {header: {n.lower() for n in header} & declared.keys() for header in groups}
    if not any(named.values()):
        return None
    for header, known in named.items():
        if missing := [declared[name] for name in declared if name not in known]:
            raise SpecError(f"source {source.id}: {groups[header][0]} has no column {', '.join(missing)}")
        if repeated := sorted(name for name in known if [n.lower() for n in header].count(name) > 1):
            raise SpecError(f"source {source.id}: {groups[header][0]} has column {', '.join(repeated)} more than once")
    parts = []
    for header, paths in groups.items():
        fields = []
        for place, name in enumerate(header):
            known = name.lower() in declared
            fields.append(T.StructField(declared[name.lower()] if known else f"column {place}", schema[declared[name.lower()]].dataType if known else T.StringType()))
        parts.append(reader.schema(T.StructType(fields)).load(paths).select(*(F.col(quoted(name)) for name in schema.names)))
    return reduce(DataFrame.unionByName, parts)


def read_inferred(reader: DataFrameReader, groups: dict[tuple[str, ...], list[str]], source: Source) -> DataFrame | None:
    """The columns that any file names, in order of first appearance; a file without one has nulls there.

    Each group's types are inferred, then agreed upon for each name, and the files are read as agreed, so that a value
    reads the same in whichever file it is. None if there is one header only.
    """
    if len(groups) < 2:
        return None
    inferred = {header: reader.load(paths).schema for header, paths in groups.items()}
    agreed: dict[str, T.DataType] = {}
    for header, schema in inferred.items():
        if len({name.lower() for name in header}) < len(header):
            raise SpecError(f"source {source.id}: {groups[header][0]} has a column more than once")
        for name, field in zip(header, schema.fields, strict=True):
            agreed[name] = wider(agreed[name], field.dataType) if name in agreed else field.dataType
    parts = []
    for header, paths in groups.items():
        fields = T.StructType([T.StructField(name, agreed[name]) for name in header])
        parts.append(reader.option("inferSchema", "false").schema(fields).load(paths))
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return united.select(*(F.col(quoted(name)) for name in agreed))


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both."""
    for one, other in ((a, b), (b, a)):
        if one == other or isinstance(one, T.NullType):
            return other
        if isinstance(one, T.DateType) and isinstance(other, (T.TimestampType, T.TimestampNTZType)):
            return other
    places = [_WIDER.index(t) if t in _WIDER else 2 if isinstance(t, T.DecimalType) else None for t in (a, b)]
    return T.StringType() if None in places else _WIDER[max(places)]
