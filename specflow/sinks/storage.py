"""Shared working folders, and what is known about files already there."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specflow.plans.spec import SpecError, quoted

_SHARED_FOLDER = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it.

    Only a session that runs in a single process may do without.
    """
    named = spark.conf.get(_SHARED_FOLDER, None) or spark.sparkContext.getConf().get(_SHARED_FOLDER)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise SpecError(f"set {_SHARED_FOLDER} to a folder that all executors share")
    return _single_process_folder()


@cache
def _single_process_folder() -> str:
    return tempfile.mkdtemp(prefix="specflow-")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """An unused path in the shared folder, in a part of it that is removed when the application ends."""
    own = f"{shared_folder(spark)}/specflow/{spark.sparkContext.applicationId}"
    file_system, hadoop_path = _file_system(spark, own)
    file_system.mkdirs(hadoop_path)
    file_system.deleteOnExit(hadoop_path)
    return f"{own}/{purpose}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    file_system, hadoop_path = _file_system(spark, path)
    return file_system.exists(hadoop_path)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it is not there."""
    file_system, hadoop_path = _file_system(spark, path)
    return [entry.getPath().getName() for entry in file_system.listStatus(hadoop_path)] if file_system.exists(hadoop_path) else []


def file_status(spark: SparkSession, path: str) -> tuple[int, int] | None:
    """A file's time and length; None if it is not there."""
    file_system, hadoop_path = _file_system(spark, path)
    if not file_system.exists(hadoop_path):
        return None
    status = file_system.getFileStatus(hadoop_path)
    return status.getModificationTime(), status.getLen()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Make a small file that is there whole or not at all."""
    file_system, hadoop_path = _file_system(spark, path)
    waiting = spark._jvm.org.apache.hadoop.fs.Path(hadoop_path.getParent(), f".{hadoop_path.getName()}.{uuid.uuid4().hex}")
    stream = file_system.create(waiting, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    file_system.delete(hadoop_path, False)
    if not file_system.rename(waiting, hadoop_path):
        raise OSError(f"could not write {path}")


@contextmanager
def written_once(df: DataFrame, partition_by: tuple[str, ...] = ()) -> Iterator[DataFrame]:
    """The frame's rows from a table written once to the shared folder.

    For frames that several writes consume: the work behind them runs once, every
    consumer sees the same rows even where an expression is not repeatable, and a
    lost executor costs a re-read, not a re-run. The table is dropped at the end.
    Columns without a type, which no table can hold, are kept as text.
    """
    spark = df.sparkSession
    untyped = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NullType)]
    for name in untyped:
        df = df.withColumn(name, F.col(quoted(name)).cast("string"))
    path = new_folder(spark, "stage")
    try:
        df.write.partitionBy(*partition_by).parquet(path)
        yield spark.read.schema(df.schema).parquet(path).select(*(quoted(name) for name in df.columns))
    finally:
        file_system, hadoop_path = _file_system(spark, path)
        file_system.delete(hadoop_path, True)


def delete(spark: SparkSession, path: str) -> None:
    file_system, hadoop_path = _file_system(spark, path)
    file_system.delete(hadoop_path, True)


def move(spark: SparkSession, path: str, target: str) -> None:
    """Give a file or folder another path, where nothing is yet."""
    file_system, hadoop_path = _file_system(spark, path)
    new = spark._jvm.org.apache.hadoop.fs.Path(target)
    if file_system.exists(new):
        raise FileExistsError(target)
    file_system.mkdirs(new.getParent())
    if not file_system.rename(hadoop_path, new):
        raise OSError(f"could not move {path} to {target}")


def create_empty(spark: SparkSession, path: str) -> None:
    file_system, hadoop_path = _file_system(spark, path)
    file_system.create(hadoop_path, True).close()


def files_below(spark: SparkSession, path: str) -> Iterator[tuple[str, str]]:
    """Each file below a folder: its path, and the part of it after the folder."""
    file_system, hadoop_path = _file_system(spark, path)
    root = file_system.makeQualified(hadoop_path).toString()
    listed = file_system.listFiles(hadoop_path, True)
    while listed.hasNext():
        found = listed.next().getPath().toString()
        yield found, found[len(root) + 1 :]


def beside(path: str, purpose: str) -> str:
    """A name in the path's folder that readers pass over, for rows that wait to take the path's place."""
    folder, _, name = path.rstrip("/").rpartition("/")
    # a name with = would be read as a partition, hidden or not
    return f"{folder}/_specflow_{purpose}_{name.replace('=', '-')}"


def swap_in(spark: SparkSession, staged: str, target: str) -> None:
    """Let a folder take the place of a path; what was there goes only when the folder is in its place.

    Three renames, each of which :func:`recover` can tell from what it finds: the folder is named as the coming one,
    which says that it is whole; the old one is put aside; the coming one takes the path.
    """
    recover(spark, target)
    move(spark, staged, beside(target, "new"))
    recover(spark, target)


def recover(spark: SparkSession, target: str) -> None:
    """Finish a swap that broke off at a path, if there is one."""
    new, old = beside(target, "new"), beside(target, "old")
    if exists(spark, new):
        if exists(spark, target):
            delete(spark, old)
            move(spark, target, old)
        move(spark, new, target)
    if exists(spark, old):
        if exists(spark, target):
            delete(spark, old)
        else:
            move(spark, old, target)


def move_into(spark: SparkSession, staged: str, target: str) -> None:
    """Add the files of a folder to another, in the same places below it."""
    for path, place in list(files_below(spark, staged)):
        move(spark, path, f"{target}/{place}")
