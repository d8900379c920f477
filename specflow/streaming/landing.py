"""Process each file of a landing folder once, then archive it."""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from specflow.operators.profiling import STATE_SCHEMA, finished, merged_states
from specflow.plans.audit import AuditLog
from specflow.plans.run import write_sinks
from specflow.plans.session import pipeline_session, size_tasks
from specflow.plans.spec import Pipeline, Source, SpecError
from specflow.sinks.storage import write_text
from specflow.sinks.write import INCREMENT, Written
from specflow.sources import read
from specflow.sources.files import read_files
from specflow.streaming.deliveries import Deliveries, RunningDeliveries


def land(
    spark: SparkSession,
    pipeline: Pipeline,
    checkpoint: str,
    archive: str | None = None,
    streamed_source: str | None = None,
    max_files_per_batch: int | None = None,
    every: str | None = None,
    audit: AuditLog | None = None,
    profiles: str | None = None,
) -> StreamingQuery | RunningDeliveries:
    """Run a pipeline over the files that arrived since the last call.

    One source is read in increments (the first, unless named); the others are read whole for each increment.
    Deliveries are remembered in ``checkpoint`` by path, time and length, so each is processed once even across
    restarts, a name that is delivered again is read again, and however old a file is, it is read. Files are moved to
    ``archive`` once their increment is committed, by the next look at the folder. ``max_files_per_batch`` bounds an
    increment, so a backlog is worked off in steps that fit the cluster. With ``every``, the query keeps running and
    looks for files at that interval.

    Each increment is a folder of its own below a file sink, or a partition of a
    table, named by ``batch_id``; a retry replaces it. ``audit`` gets the events of
    every increment. A failed increment ends the query. With a folder for ``profiles``, the write
    of each increment leaves the states of its columns there, from which :func:`increment_profile` makes
    the profile of all increments.
    """
    session = pipeline_session(spark, pipeline)
    source_id = streamed_source or pipeline.sources[0].id
    source = _landed(pipeline, source_id)
    for sink in pipeline.sinks:
        if sink.file_type == "jdbcclient":
            raise SpecError(f"sink {sink.id}: increments are written to files or catalog tables")
        if any(column.name.lower() == INCREMENT for column in sink.columns):
            raise SpecError(f"sink {sink.id}: {INCREMENT} names the increments")
        if sink.bucket_by:
            raise SpecError(f"sink {sink.id}: increments are not laid out for joins")
    # Each increment has a place of its own, replaced when the increment is retried.
    retryable = replace(pipeline, sinks=tuple(replace(sink, mode="overwrite") for sink in pipeline.sinks))
    log = audit if audit is not None else AuditLog(spark)
    chosen = session.conf.getAll
    deliveries = Deliveries(session, source.location, checkpoint, archive, max_files_per_batch)

    def write_increment(claimed: DataFrame, batch_id: int) -> None:
        with log.recorded(pipeline.id, f"increment {batch_id} of {pipeline.id}"):
            own, delivered = claimed.sparkSession, claimed.collect()
            paths = deliveries.paths(delivered)
            if len(paths) < len(delivered):
                log.info(pipeline.id, f"{len(delivered) - len(paths)} files were replaced before they were read")
            frames = {s.id: read_files(own, source, paths) if s.id == source_id else read(own, s) for s in pipeline.sources}
            size_tasks(own, frames.values(), chosen)
            states: list[dict] = []

            def report(written: Written) -> None:
                log.written(pipeline.id, written)
                states.extend({**state, "part": written.part} for state in written.states)

            write_sinks(own, retryable, profiles=profiles is not None, given=frames, increment=batch_id, report=report)
            if profiles is not None:
                lines = "".join(json.dumps(state) + "\n" for state in states)
                write_text(own, f"{profiles}/{INCREMENT}-{batch_id:012d}.json", lines)

    return deliveries.start(deliveries.stream().writeStream.foreachBatch(write_increment), every)


def increment_profile(spark: SparkSession, profiles: str) -> DataFrame:
    """``part`` (sink and side), column_name and the statistics of all increments, from their states alone."""
    states = spark.read.schema(f"{STATE_SCHEMA}, part string").json(profiles)
    return finished(merged_states(states, "part"), "part")


def _landed(pipeline: Pipeline, source_id: str) -> Source:
    source = pipeline.source(source_id)
    if not source.location:
        raise SpecError(f"source {source.id}: increments are read from files")
    if source.infer_schema:
        raise SpecError(f"source {source.id}: a landing folder needs declared columns")
    return source
