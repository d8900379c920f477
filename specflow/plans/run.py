"""Turn a pipeline into one lazy plan per sink, and run it."""

from __future__ import annotations

import time
import traceback
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specflow.functions.templates import is_repeatable
from specflow.operators.layout import SPREAD
from specflow.operators.profiling import profile, profile_json, records_of
from specflow.operators.project import project, sink_columns
from specflow.operators.relate import join_sources, sql_step, where
from specflow.operators.rules import with_rules
from specflow.plans.audit import AuditLog
from specflow.plans.metadata import MetadataStore
from specflow.plans.session import pipeline_session, size_tasks
from specflow.plans.spec import Pipeline, SpecError, quoted
from specflow.sinks.storage import written_once
from specflow.sinks.write import Written, write, write_split
from specflow.sources import read


@dataclass
class RunResult:
    """What became of one pipeline."""

    pipeline_id: str
    written: list[Written] = field(default_factory=list)
    error: str | None = None
    seconds: float = 0.0

    @property
    def succeeded(self) -> bool:
        return self.error is None


class PipelineFailures(RuntimeError):
    """Raised after all pipelines were tried, naming those that failed."""


def combined(session: SparkSession, pipeline: Pipeline, given: dict[str, DataFrame] | None = None) -> DataFrame:
    """All sources brought together: read, joined and filtered, or queried.

    ``given`` frames stand in for sources that are already at hand, such as one
    increment of a stream. Outside the query form, columns are addressed as
    source.column.
    """
    given = given or {}
    frames = {s.id: given[s.id] if s.id in given else read(session, s, bool(pipeline.joins)) for s in pipeline.sources}
    if pipeline.query is not None:
        return sql_step(session, frames, pipeline.query)
    sources = {source.id: source for source in pipeline.sources}
    base = join_sources(frames, sources, pipeline.joins)
    return base if pipeline.predicate is None else where(base, pipeline.predicate, sources)


def sink_frames(
    session: SparkSession, pipeline: Pipeline, given: dict[str, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """The lazy frame of each sink, checked where the pipeline validates."""
    base = combined(session, pipeline, given)
    if pipeline.query is not None:
        frames = {sink.id: base for sink in pipeline.sinks}
    else:
        frames = {sink.id: project(base, pipeline, sink) for sink in pipeline.sinks}
    return _checked(frames, pipeline)


def _checked(frames: dict[str, DataFrame], pipeline: Pipeline) -> dict[str, DataFrame]:
    if not pipeline.validation:
        return frames
    return {sink.id: with_rules(frames[sink.id], sink.columns) for sink in pipeline.sinks}


def write_sinks(
    session: SparkSession,
    pipeline: Pipeline,
    profiles: bool = False,
    given: dict[str, DataFrame] | None = None,
    increment: int | None = None,
    report: Callable[[Written], None] = lambda written: None,
) -> None:
    """Write every sink of a pipeline, or one ``increment`` of each.

    What several sinks share is computed once and stored, so that sources are read once, however many sinks there are,
    and every sink sees the same rows. Every finished write is reported.
    """
    if len(pipeline.sinks) == 1:
        frames = sink_frames(session, pipeline, given)
        twice = pipeline.validation and not pipeline.sinks[0].is_file and _is_columnar_scan(pipeline) and all(is_repeatable(f) for f in frames.values())
        _write_frames(frames, pipeline, profiles, increment, report, twice)
        return
    base = combined(session, pipeline, given)
    if pipeline.query is None:
        # One struct per sink: only mapped columns are stored, and names may repeat between sinks.
        base = base.select(*(F.struct(*sink_columns(base, pipeline, sink)).alias(sink.id) for sink in pipeline.sinks))
    with written_once(base) as rows:
        if pipeline.query is not None:
            frames = {sink.id: rows for sink in pipeline.sinks}
        else:
            frames = {sink.id: rows.select(f"{quoted(sink.id)}.*") for sink in pipeline.sinks}
        _write_frames(_checked(frames, pipeline), pipeline, profiles, increment, report, repeatable=True)


def _is_columnar_scan(pipeline: Pipeline) -> bool:
    columnar = all(source.file_type in ("parquet", "orc", "hivetable") for source in pipeline.sources)
    return columnar and not pipeline.joins and pipeline.query is None


def _write_frames(
    frames: dict[str, DataFrame],
    pipeline: Pipeline,
    profiles: bool,
    increment: int | None,
    report: Callable[[Written], None],
    repeatable: bool,
) -> None:
    for sink in pipeline.sinks:
        if pipeline.validation:
            for side in write_split(frames[sink.id], sink, increment, profiles, repeatable):
                report(side)
        else:
            report(write(frames[sink.id], sink, "", increment, profiles))


def run(
    spark: SparkSession, pipeline: Pipeline, audit: AuditLog | None = None, profiles: bool = False
) -> RunResult:
    """Run one pipeline; a failure is recorded in the result and the audit log.

    With ``profiles``, the log also gets the column statistics of every source,
    at the cost of one more scan of each, and of every sink.
    """
    audit = audit if audit is not None else AuditLog(spark)
    result = RunResult(pipeline.id)
    started = time.monotonic()

    def report(written: Written) -> None:
        result.written.append(written)
        audit.written(pipeline.id, written, profile_json(written.profile) if profiles else None)

    try:
        with audit.recorded(pipeline.id, pipeline.id):
            session = pipeline_session(spark, pipeline)
            frames = {source.id: read(session, source, bool(pipeline.joins)) for source in pipeline.sources}
            size_tasks(session, frames.values())
            if profiles:
                for source_id, frame in frames.items():
                    audit.profiled(pipeline.id, source_id, profile_json(records_of(profile(frame.drop(SPREAD)))))
            write_sinks(session, pipeline, profiles, given=frames, report=report)
    except Exception as failure:
        result.error = f"{type(failure).__name__}: {failure}"
    result.seconds = time.monotonic() - started
    return result


def run_all(
    spark: SparkSession,
    pipelines: Iterable[Pipeline],
    audit: AuditLog | None = None,
    profiles: bool = False,
    at_once: int = 1,
) -> list[RunResult]:
    """Run the active pipelines, ``at_once`` at a time; failures do not stop the others.

    Once all were tried, failures are raised together. Pipelines that run at the
    same time must not depend on each other.
    """
    audit = audit if audit is not None else AuditLog(spark)
    active = [pipeline for pipeline in pipelines if pipeline.active]
    return _all_succeeded(_each(lambda pipeline: run(spark, pipeline, audit, profiles), active, at_once))


def _each(work: Callable[[Any], RunResult], items: list, at_once: int) -> list[RunResult]:
    if at_once < 1:
        raise SpecError("at least one pipeline runs at a time")
    if at_once == 1:
        return [work(item) for item in items]
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(work, items))


def run_processes(
    spark: SparkSession,
    store: MetadataStore,
    pattern: str,
    audit: AuditLog | None = None,
    profiles: bool = False,
    at_once: int = 1,
) -> list[RunResult]:
    """Run the active processes of all process files whose name matches, as :func:`run_all` does.

    A process whose description is faulty counts as failed.
    """
    audit = audit if audit is not None else AuditLog(spark)

    def process(described: tuple[str, Callable[[], Pipeline]]) -> RunResult:
        process_id, load = described
        try:
            pipeline = load()
        except SpecError as fault:
            failed = RunResult(process_id, error=f"SpecError: {fault}")
            audit.error(process_id, failed.error, traceback.format_exc())
            return failed
        return run(spark, pipeline, audit, profiles)

    active = [described for process_file in store.process_files(pattern) for described in store.active(process_file)]
    return _all_succeeded(_each(process, active, at_once))


def _all_succeeded(results: list[RunResult]) -> list[RunResult]:
    failed = [result for result in results if not result.succeeded]
    if failed:
        raise PipelineFailures("; ".join(f"{r.pipeline_id}: {r.error}" for r in failed))
    return results
