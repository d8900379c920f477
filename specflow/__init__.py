"""Metadata-driven ingestion on Spark: described sources, mappings, rules and sinks."""

from specflow.plans.audit import AuditLog
from specflow.plans.metadata import MetadataStore
from specflow.plans.run import PipelineFailures, RunResult, run, run_all, run_processes, sink_frames
from specflow.plans.session import pipeline_session
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

__all__ = [
    "AuditLog",
    "JoinKey",
    "Link",
    "MetadataStore",
    "Pipeline",
    "PipelineFailures",
    "Predicate",
    "RunResult",
    "Sink",
    "SinkColumn",
    "Source",
    "SourceColumn",
    "SpecError",
    "pipeline_session",
    "run",
    "run_all",
    "run_processes",
    "sink_frames",
]
