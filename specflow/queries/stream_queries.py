"""Incremental runs over whole given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specflow.plans.spec import JoinKey, Pipeline, Sink, SinkColumn, Source
from specflow.queries.common import col_id, columns_of, copy, given, link, mapped, query, session_for
from specflow.sinks.storage import delete, file_status, move, names_in, new_folder
from specflow.sources import read
from specflow.streaming import keyed_events, land, route_log


def _landed(spark: SparkSession, sf_dir: str, targets: list, validation: bool) -> tuple[SparkSession, Sink]:
    """All events, arriving in two deliveries that are each processed by one run."""
    session = session_for(spark)
    root = new_folder(session, "query")
    arrivals = Source("events", "json", columns_of("events"), f"{root}/landing")
    columns, links = mapped(arrivals, targets)
    sink = Sink("out", "parquet", columns, root)
    pipeline = Pipeline("landing", (arrivals,), (sink,), links, validation=validation)
    events = read(session, given("events", sf_dir)).withColumn("ts", F.col("ts").cast("string"))
    early = F.col("event_type").isin("click", "view")
    for delivery in (early, ~early):
        events.where(delivery).write.mode("append").json(arrivals.location)
        land(session, pipeline, f"{root}/checkpoint", f"{root}/archive", max_files_per_batch=4)
    return session, sink


@query(
    "stream_landing",
    "SELECT event_id AS id, ts AS happened, event_type AS kind, value * 2 AS doubled FROM events",
)
def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = [
        ("event_id", SinkColumn("id", "Long")),
        ("ts", SinkColumn("happened", "timestamp_ntz")),
        ("event_type", SinkColumn("kind", "String")),
        ("value", SinkColumn("doubled", "Double", transform="{0} * 2")),
    ]
    session, sink = _landed(spark, sf_dir, targets, validation=False)
    return session.read.schema("id bigint, happened timestamp_ntz, kind string, doubled double").parquet(sink.path).drop("batch_id")


@query(
    "stream_landing_table",
    """SELECT e.event_id AS id, c.c_name AS name, e.value AS value, (e.event_type NOT IN ('click', 'view'))::INTEGER AS batch
FROM events e JOIN customer c ON e.user_id = c.c_custkey WHERE e.value >= 10""",
)
def stream_landing_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two increments of events, joined with a catalog table, into a catalog table."""
    session = session_for(spark)
    root = new_folder(session, "query")
    names, target = (f"specflow_{uuid.uuid4().hex}" for _ in range(2))
    copy(session, given("customer", sf_dir), "hivetable", table=names, options={"path": f"{root}/names"})
    customers = Source("customer", "hivetable", columns_of("customer"), table=names)
    arrivals = Source("events", "json", columns_of("events"), f"{root}/landing")
    columns = (SinkColumn("id", "Long", 1), SinkColumn("name", "String", 2), SinkColumn("value", "Double", 3, minimum=10))
    links = (link(arrivals, "event_id", "out", 1), link(customers, "c_name", "out", 2), link(arrivals, "value", "out", 3))
    sink = Sink("out", "hivetable", columns, table=target)
    joins = JoinKey.parse(f"events:{col_id(arrivals, 'user_id')}=customer:{col_id(customers, 'c_custkey')}")
    pipeline = Pipeline("landing", (arrivals, customers), (sink,), links, joins, validation=True)
    events = session.read.parquet(f"{sf_dir}/events.parquet")
    early = F.col("event_type").isin("click", "view")
    for delivery in (early, ~early):
        events.where(delivery).write.mode("append").json(arrivals.location)
        land(session, pipeline, f"{root}/checkpoint", f"{root}/archive")
    return session.table(target).select("id", "name", "value", F.col("batch_id").cast("int").alias("batch"))


@query(
    "stream_landing_validated",
    """SELECT event_id AS id, value, value >= 50 AS in_target,
CASE WHEN value >= 50 THEN '' ELSE value::VARCHAR || ' is less than the minimum of 50' END AS errMsg FROM events""",
)
def stream_landing_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = [("event_id", SinkColumn("id", "Long")), ("value", SinkColumn("value", "Double", minimum=50))]
    session, sink = _landed(spark, sf_dir, targets, validation=True)
    schema = "id bigint, value double, errMsg string"
    sides = [
        session.read.schema(schema).parquet(sink.path + suffix).drop("batch_id").withColumn("in_target", F.lit(suffix == ""))
        for suffix in ("", "_INVALID")
    ]
    return sides[0].unionByName(sides[1])


def _set_time(session: SparkSession, path: str, time: int) -> None:
    hadoop_path = session._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(session._jsc.hadoopConfiguration()).setTimes(hadoop_path, time, -1)


def _keyed_twice(spark: SparkSession, sf_dir: str, root: str, **settings) -> None:
    """All events, keyed by type, through one file name: delivered, routed, delivered again with the old time, routed."""
    session = session_for(spark)
    events = session.read.parquet(f"{sf_dir}/events.parquet")
    early = F.col("event_type").isin("click", "view")
    keyed = F.expr("nullif(event_type, 'error')").alias("key"), F.when(F.col("value") >= 1, F.col("props")).alias("value")
    topic, time = f"{root}/topic/events.json", None
    for number, delivery in enumerate((early, ~early)):
        events.where(delivery).select(*keyed).coalesce(1).write.json(f"{root}/made-{number}")
        (part,) = [name for name in names_in(session, f"{root}/made-{number}") if name.startswith("part-")]
        delete(session, topic)
        move(session, f"{root}/made-{number}/{part}", topic)
        time = time or file_status(session, topic)[0]
        _set_time(session, topic, time)
        for _ in range(2):
            route_log(keyed_events(session, f"{root}/topic"), f"{root}/logs", f"{root}/checkpoint", **settings)


@query(
    "stream_log_route",
    "SELECT event_type AS key, props AS value FROM events WHERE event_type <> 'error' AND value >= 1",
)
def stream_log_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events keyed by type, under one name that is delivered twice; some lose their key, some their value, and are dropped."""
    root = new_folder(spark, "query")
    _keyed_twice(spark, sf_dir, root)
    return session_for(spark).read.schema("value string, key string").text(f"{root}/logs")


@query(
    "stream_log_route_sized",
    """SELECT event_type AS key, count(*) AS values_routed, true AS files_by_share FROM events
WHERE event_type <> 'error' AND value >= 1 GROUP BY event_type""",
)
def stream_log_route_sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As before, with a file for each 100 events of a key, one at least: what arrived, and whether its files are as many."""
    root, rows_per_file = new_folder(spark, "query"), 100
    _keyed_twice(spark, sf_dir, root, rows_per_file=rows_per_file)
    rows = session_for(spark).read.schema("value string, key string").text(f"{root}/logs")
    counts = rows.groupBy("key").agg(
        F.count("*").alias("values_routed"), F.countDistinct(F.col("_metadata.file_path")).alias("files")
    )
    # every key comes in one of the two batches
    tasks = int(session_for(spark).conf.get("spark.sql.shuffle.partitions"))
    right = F.col("files") == F.least(F.ceil(F.col("values_routed") / rows_per_file), F.lit(tasks))
    return counts.select("key", "values_routed", right.alias("files_by_share"))


@query(
    "stream_landing_running",
    "SELECT event_id AS id, event_type AS kind, value FROM events",
)
def stream_landing_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events through one file name, delivered twice to a landing that keeps running, the second time with the old time."""
    session = session_for(spark)
    root = new_folder(session, "query")
    arrivals = Source("events", "json", columns_of("events"), f"{root}/landing")
    columns, links = mapped(
        arrivals,
        [("event_id", SinkColumn("id", "Long")), ("event_type", SinkColumn("kind", "String")), ("value", SinkColumn("value", "Double"))],
    )
    sink = Sink("out", "parquet", columns, root)
    events = read(session, given("events", sf_dir)).withColumn("ts", F.col("ts").cast("string"))
    early = F.col("event_type").isin("click", "view")
    landed, time = f"{root}/landing/day.json", None
    query = land(session, Pipeline("landing", (arrivals,), (sink,), links), f"{root}/checkpoint", f"{root}/archive", every="2 seconds")
    try:
        for number, delivery in enumerate((early, ~early)):
            events.where(delivery).coalesce(1).write.json(f"{root}/made-{number}")
            (part,) = [name for name in names_in(session, f"{root}/made-{number}") if name.startswith("part-")]
            time = time or file_status(session, f"{root}/made-{number}/{part}")[0]
            _set_time(session, f"{root}/made-{number}/{part}", time)
            delete(session, landed)
            move(session, f"{root}/made-{number}/{part}", landed)
            query.processAllAvailable()
    finally:
        query.stop()
    return session.read.schema("id bigint, kind string, value double").parquet(sink.path).drop("batch_id")
