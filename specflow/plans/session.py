"""The session a pipeline runs in."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from specflow.functions.masking import register_masks
from specflow.plans.spec import Pipeline

# Settings that make templates and queries behave as documented:
# a value that does not fit becomes null, and date patterns are read leniently.
SEMANTICS = {
    "spark.sql.ansi.enabled": "false",
    "spark.sql.legacy.timeParserPolicy": "LEGACY",
}

# Defaults the caller may override. The running query splits hot join keys, even where
# that costs a further shuffle, and early: a hot key's rows compress well, so by bytes it
# looks smaller than it is. A task that writes few partition values keeps a file open for
# each instead of sorting.
EXECUTION = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}

_SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
_INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_MERGED_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_SCAN_BYTES = "spark.sql.files.maxPartitionBytes"
_MEGABYTE = 1024 * 1024
_SHUFFLE_BYTES = 64 * _MEGABYTE
_LARGEST_MERGED = 512 * _MEGABYTE
_MOST_SHUFFLE_TASKS = 50_000
_MOST_SCAN_TASKS = 200_000
_UNKNOWN_BYTES = 1 << 60


def pipeline_session(spark: SparkSession, pipeline: Pipeline | None = None) -> SparkSession:
    """A session of its own for one run: same cluster and catalog, own views and settings.

    It starts from the caller's settings and leaves them untouched. The masking
    functions are defined unless the given pipeline mentions none.
    """
    session = spark.newSession()
    chosen = {name: value for name, value in spark.conf.getAll.items() if name.startswith("spark.sql.")}
    for name, value in {**EXECUTION, **chosen, **SEMANTICS}.items():
        if session.conf.isModifiable(name):
            session.conf.set(name, value)
    if pipeline is None or any("mask_" in text.lower() for text in pipeline.sql_texts()):
        register_masks(session)
    return session


def size_tasks(session: SparkSession, frames: Iterable[DataFrame], chosen: Mapping[str, str] | None = None) -> None:
    """Fit the tasks of scans and shuffles to the sources, as far as the caller left that open.

    Shuffles start wide enough that a partition fits in memory, and the running
    query merges small ones. For a very large input, tasks read and merge more
    bytes, so that their number stays within what one driver can schedule and
    output does not fall apart into small files: beyond ``_MOST_SHUFFLE_TASKS``
    (about 3 TB) partitions grow with the input. A caller who wants them smaller
    sets the initial number of partitions. Files and tables count alike. What the
    caller set is read from the session, or given where a session is sized anew for
    each increment.
    """
    total = sum(plan_bytes(frame) for frame in frames)
    chosen = session.conf.getAll if chosen is None else chosen
    width = min(total // _SHUFFLE_BYTES, _MOST_SHUFFLE_TASKS)
    if _INITIAL_PARTITIONS not in chosen:
        session.conf.unset(_INITIAL_PARTITIONS)
        if width > int(session.conf.get(_SHUFFLE_PARTITIONS)):
            session.conf.set(_INITIAL_PARTITIONS, str(width))
    per_task = total // _MOST_SCAN_TASKS
    for setting, wanted in ((_SCAN_BYTES, per_task), (_MERGED_BYTES, min(per_task, _LARGEST_MERGED))):
        if setting not in chosen:
            session.conf.unset(setting)
            if wanted > _bytes(session.conf.get(setting)):
                session.conf.set(setting, str(wanted))


def plan_bytes(df: DataFrame) -> int:
    """What the optimizer knows of a frame's size, from listings it keeps; 0 if it knows nothing."""
    known = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return 0 if known >= _UNKNOWN_BYTES else known


def _bytes(setting: str) -> int:
    return int(setting.removesuffix("b"))
