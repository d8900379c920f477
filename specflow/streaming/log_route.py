"""Route keyed log events to one folder per key."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from specflow.plans.spec import SpecError
from specflow.sinks.storage import create_empty, delete, exists, move_into
from specflow.streaming.deliveries import Deliveries, RunningDeliveries
from specflow.streaming.trigger import started

_EVENT_SCHEMA = "key string, value string"

#: Keys that a batch counts to find the frequent ones: memory and error of the count are bounded by them.
_COUNTED_KEYS, _FREQUENT_KEYS = 10_000, 1_000


@dataclass(frozen=True)
class FileEvents:
    """Key and value from the JSON files that are delivered to a folder."""

    spark: SparkSession
    location: str


def keyed_events(spark: SparkSession, location: str) -> FileEvents:
    """Key and value from JSON files; a name that is delivered again is read again."""
    return FileEvents(spark, location)


def topic_events(spark: SparkSession, servers: str, topic: str, starting: str = "earliest") -> DataFrame:
    """A stream of key and value from a topic; needs the Kafka connector on the cluster."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .load()
    )
    return raw.select(F.col("key").cast("string"), F.col("value").cast("string"))


def routable() -> Column:
    """Events without a key or a value are dropped."""
    return F.col("key").isNotNull() & F.col("value").isNotNull()


def route_log(
    events: FileEvents | DataFrame,
    target: str,
    checkpoint: str,
    files_per_key: int | None = None,
    every: str | None = None,
    rows_per_file: int | None = None,
    max_files_per_batch: int | None = None,
) -> StreamingQuery | RunningDeliveries:
    """Append each event's value to the folder of its key.

    Tasks write where they read, so a key holding most of the events is spread over all of them. Where many tasks meet
    many keys, they can be gathered, at the cost of a shuffle: ``files_per_key`` gives each key of a batch at most so
    many files, ``rows_per_file`` one file to a rare key and as many as its rows need to a frequent one. With ``every``,
    the query keeps running at that interval.

    Files are told apart by path, time and length, at most ``max_files_per_batch`` make a batch, and each batch arrives
    once: it is staged, and its files are moved to their folders when it is whole. A streaming frame, such as that of a
    topic, is written by Spark's own file sink.
    """
    if isinstance(events, FileEvents):
        return _route_files(events, target, checkpoint, files_per_key, every, rows_per_file, max_files_per_batch)
    if rows_per_file is not None:
        raise SpecError("rows_per_file needs events from files")
    writer = _gathered(events.where(routable()), files_per_key).writeStream.format("text").partitionBy("key")
    return started(writer.option("path", target).option("checkpointLocation", checkpoint), every)


def _gathered(kept: DataFrame, files_per_key: int | None) -> DataFrame:
    if files_per_key is None:
        return kept
    return kept.repartition("key", F.pmod(F.xxhash64("value"), F.lit(files_per_key)))


def sized(kept: DataFrame, rows_per_file: int) -> DataFrame:
    """The rows dealt out so that a key gets a file for each ``rows_per_file`` rows it has, one at least, one a task at most.

    Frequent keys are found by a summary of bounded size, so neither the plan nor the driver grows with the keys. A key
    that it misses or counts too low gets fewer files, never fewer rows.
    """
    counted = kept.agg(F.expr(f"approx_top_k(key, {_FREQUENT_KEYS}, {_COUNTED_KEYS})").alias("top")).first().top
    files = [(r["item"], math.ceil(r["count"] / rows_per_file)) for r in counted if r["count"] > rows_per_file]
    part = F.lit(0)
    if files:
        known = F.create_map(*(F.lit(x) for pair in files for x in pair))
        parts = F.coalesce(F.element_at(known, F.col("key")), F.lit(1))
        # rows of a task in turn, as a frequent value would keep its rows together
        part = F.pmod(F.monotonically_increasing_id(), parts)
    width = int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return kept.repartitionById(width, F.pmod(F.xxhash64("key") + part, F.lit(width)).cast("int"))


def _route_files(
    events: FileEvents, target: str, checkpoint: str, files_per_key: int | None, every: str | None, rows_per_file: int | None, max_files: int | None
) -> StreamingQuery | RunningDeliveries:
    if exists(events.spark, f"{target}/_spark_metadata"):
        raise SpecError(f"{target} was filled by a stream that lists its files itself; route into another folder")
    deliveries = Deliveries(events.spark, events.location, checkpoint, max_files=max_files)

    def append(claimed: DataFrame, batch_id: int) -> None:
        spark = claimed.sparkSession
        staged, whole = f"{target}/_specflow_batch_{batch_id}", f"{checkpoint}/routed/{batch_id}"
        if not exists(spark, whole):
            delete(spark, staged)
            paths = deliveries.paths(claimed.collect())
            if paths:
                kept = spark.read.schema(_EVENT_SCHEMA).option("__globPaths__", "false").json(paths).where(routable())
                kept = _gathered(kept, files_per_key) if rows_per_file is None else sized(kept, rows_per_file)
                kept.write.partitionBy("key").text(staged)
                delete(spark, f"{staged}/_SUCCESS")
            create_empty(spark, whole)
        # a batch that is tried again from here on only moves what is left
        if exists(spark, staged):
            move_into(spark, staged, target)
            delete(spark, staged)
        delete(spark, f"{checkpoint}/routed/{batch_id - 1}")

    return deliveries.start(deliveries.stream().writeStream.foreachBatch(append), every)
