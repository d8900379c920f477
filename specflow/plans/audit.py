"""Run events: when a pipeline started and finished, what it wrote, what failed."""

from __future__ import annotations

import json
import time
import traceback
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone
from threading import Lock
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specflow.sinks.storage import delete, exists, files_below, names_in, write_text
from specflow.sinks.write import Written

EVENT_SCHEMA = (
    "key string, pipeline_id string, step int, at timestamp, level string, message string, "
    "target string, rows bigint, detail string"
)

#: An event as a durable table keeps it: ``work`` is what was started or ended, ``event`` which of the two.
TABLE_SCHEMA = f"run string, {EVENT_SCHEMA}, work string, event string"
_STARTED, _ENDED = "started", "ended"


class AuditLog:
    """Collects the events of a run; a handful of rows for each pipeline.

    Events carry a key of pipeline, application and day, under which a log topic
    can be routed (see :mod:`specflow.streaming.log_route`). Several threads may add
    to one log.

    With a ``folder``, every event is written there as it happens, a file for each run, pipeline and step, so none is
    lost with the driver and none is there twice. Work of earlier runs that never ended is found by :meth:`unfinished`,
    and put on record by :meth:`recover`.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None) -> None:
        self._spark = spark
        self._folder = None if folder is None else folder.rstrip("/")
        self._events: list[tuple] = []
        self._steps: Counter[str] = Counter()
        self._lock = Lock()
        self.run = f"{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:12]}"

    @contextmanager
    def recorded(self, pipeline_id: str, work: str) -> Iterator[None]:
        """Record the start, the end or failure, and the time of what happens inside; a failure is raised again."""
        started = time.monotonic()
        self._add(pipeline_id, "INFO", f"Started processing {work}", work=work, event=_STARTED)
        try:
            yield
            self.info(pipeline_id, f"Finished processing {work}")
        except Exception as failure:
            self.error(pipeline_id, f"{type(failure).__name__}: {failure}", traceback.format_exc())
            raise
        finally:
            message = f"Total time taken to process {work} is {time.monotonic() - started:.1f} s"
            self._add(pipeline_id, "INFO", message, work=work, event=_ENDED)

    def info(self, pipeline_id: str, message: str) -> None:
        self._add(pipeline_id, "INFO", message)

    def error(self, pipeline_id: str, message: str, detail: str) -> None:
        self._add(pipeline_id, "ERROR", message, detail=detail)

    def profiled(self, pipeline_id: str, source_id: str, profile: str) -> None:
        self._add(pipeline_id, "INFO", f"Profiled {source_id}", source_id, detail=profile)

    def written(self, pipeline_id: str, written: Written, profile: str | None = None) -> None:
        verb = "Skipped" if written.skipped else "Wrote"
        self._add(pipeline_id, "INFO", f"{verb} {written.target}", written.target, written.rows, profile)

    def _add(
        self,
        pipeline_id: str,
        level: str,
        message: str,
        target: str | None = None,
        rows: int | None = None,
        detail: str | None = None,
        work: str | None = None,
        event: str | None = None,
    ) -> None:
        context = self._spark.sparkContext
        now = datetime.now(timezone.utc)
        key = f"{pipeline_id}-{context.appName}-{context.applicationId}-{now:%Y-%m-%d}"
        with self._lock:
            self._steps[pipeline_id] += 1
            values = (key, pipeline_id, self._steps[pipeline_id], now, level, message, target, rows, detail)
            self._events.append(values)
        if self._folder is not None:
            self._keep((self.run, *values, work, event))

    def _keep(self, values: tuple) -> None:
        row = dict(zip(_names(TABLE_SCHEMA), values, strict=True))
        name = f"{quote(row['pipeline_id'], safe='')}-{row['step']:06d}"
        write_text(self._spark, f"{self._folder}/{_OPEN}/{quote(row['run'], safe='')}/{name}.json", json.dumps(row, default=str) + "\n")

    def frame(self) -> DataFrame:
        """The events so far; ``step`` numbers those of each pipeline."""
        return self._spark.createDataFrame(self._events, EVENT_SCHEMA)

    def append_to(self, path: str) -> None:
        """Add the events so far to an audit table, as one small file."""
        self.frame().coalesce(1).write.mode("append").json(path)

    def topic_frame(self) -> DataFrame:
        """The events as keyed JSON messages, ready for a topic writer."""
        body = F.struct(
            F.col("at").cast("string").alias("Timestamp"),
            F.col("level").alias("LogLevel"),
            F.col("message").alias("LogMsg"),
        )
        return self.frame().select("key", F.to_json(body).alias("value"))

    def records(self) -> list[str]:
        """The events as JSON text, for plain logging."""
        return [json.dumps(dict(zip(_names(EVENT_SCHEMA), event)), default=str) for event in self._events]

    def unfinished(self, idle_seconds: float = 0) -> DataFrame:
        """run, pipeline_id, work, step, at: what earlier runs began and never ended, with their last step and its time.

        Runs of other drivers that still go on look the same: ``idle_seconds`` leaves out those with a later event.
        """
        events = kept_events(self._spark, self._folder).where(F.col("run") != self.run)
        last = events.groupBy("run", "pipeline_id").agg(F.max("step").alias("step"), F.max("at").alias("at"))
        marks = events.where(F.col("event").isNotNull()).groupBy("run", "pipeline_id", "work")
        begun, ended = (F.count_if(F.col("event") == event) for event in (_STARTED, _ENDED))
        open_work = marks.agg((begun - ended).alias("left")).where("left > 0").drop("left")
        idle = F.col("at") <= F.current_timestamp() - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(idle_seconds))
        return open_work.join(last, ["run", "pipeline_id"]).where(idle)

    def recover(self, idle_seconds: float = 0) -> list[str]:
        """Put on record that work of earlier runs never ended; gives their pipelines.

        The events belong to those runs, under steps of their own, so two drivers that recover at once leave one of each.
        """
        found = self.unfinished(idle_seconds).orderBy("run", "pipeline_id", "work").collect()
        steps: Counter[tuple[str, str]] = Counter()
        for row in found:
            steps[row.run, row.pipeline_id] += 1
            step = row.step + steps[row.run, row.pipeline_id]
            key = f"{row.pipeline_id}-recovered"
            message = f"Never finished processing {row.work}"
            now = datetime.now(timezone.utc)
            self._keep((row.run, key, row.pipeline_id, step, now, "ERROR", message, None, None, None, row.work, _ENDED))
        return sorted({row.pipeline_id for row in found})

    def gather(self) -> None:
        """Put the small files of runs that are over into one table; a run with open work keeps its files."""
        open_runs = {quote(row.run, safe="") for row in self.unfinished().select("run").distinct().collect()} | {quote(self.run, safe="")}
        over = [name for name in names_in(self._spark, f"{self._folder}/{_OPEN}") if name not in open_runs]
        if not over:
            return
        folders = [f"{self._folder}/{_OPEN}/{name}" for name in over]
        rows = self._spark.read.schema(_KEPT_SCHEMA).json(folders).coalesce(1)
        # a gathering that broke off leaves events in both places; readers see each once
        rows.write.mode("append").parquet(f"{self._folder}/{_GATHERED}")
        for folder in folders:
            delete(self._spark, folder)


_OPEN, _GATHERED = "events", "gathered"

#: Times are kept as text, which every session reads alike.
_KEPT_SCHEMA = TABLE_SCHEMA.replace("at timestamp", "at string")


def _names(schema: str) -> list[str]:
    return [part.strip().split(" ")[0] for part in schema.split(",")]


def kept_events(spark: SparkSession, folder: str) -> DataFrame:
    """The events of all runs that a folder holds, each once."""
    parts = [spark.createDataFrame([], _KEPT_SCHEMA)]
    if exists(spark, f"{folder}/{_OPEN}") and next(files_below(spark, f"{folder}/{_OPEN}"), None):
        parts.append(spark.read.schema(_KEPT_SCHEMA).option("recursiveFileLookup", "true").json(f"{folder}/{_OPEN}"))
    if exists(spark, f"{folder}/{_GATHERED}"):
        parts.append(spark.read.schema(_KEPT_SCHEMA).parquet(f"{folder}/{_GATHERED}"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.dropDuplicates(["run", "pipeline_id", "step"]).withColumn("at", F.col("at").cast("timestamp"))
