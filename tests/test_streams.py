"""Incremental runs."""

from __future__ import annotations

import os
import time
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException

from specflow import AuditLog, JoinKey, Link, Pipeline, Sink, SinkColumn, Source, SourceColumn, SpecError
from specflow.sinks import storage, write
from specflow.streaming import keyed_events, land, route_log
from specflow.streaming.deliveries import Deliveries

COLUMNS = (SourceColumn("k", "Int", 1), SourceColumn("v", "String", 2))


def arrivals(tmp_path, **fields):
    (tmp_path / "landing").mkdir(exist_ok=True)
    return Source("s", "csv", COLUMNS, str(tmp_path / "landing"), **fields)


def deliver(tmp_path, name, *lines):
    (tmp_path / "landing" / name).write_text("\n".join(lines) + "\n")


def pipeline_of(tmp_path, source, validation=False):
    columns = (SinkColumn("k", "Int", 1, minimum=2), SinkColumn("v", "String", 2, transform="upper({0})"))
    sink = Sink("o", "json", columns, str(tmp_path / "out"))
    return Pipeline("p", (source,), (sink,), (Link("s", "o", 1, 1), Link("s", "o", 2, 2)), validation=validation)


def run_once(spark, tmp_path, pipeline, **settings):
    land(spark, pipeline, str(tmp_path / "checkpoint"), str(tmp_path / "archive"), **settings)


def test_each_file_is_processed_once_and_archived(spark, tmp_path):
    pipeline = pipeline_of(tmp_path, arrivals(tmp_path))
    path = pipeline.sinks[0].path
    deliver(tmp_path, "one.csv", "1,a", "2,b")
    run_once(spark, tmp_path, pipeline)
    assert sorted(r.v for r in spark.read.json(path).collect()) == ["A", "B"]
    run_once(spark, tmp_path, pipeline)
    assert spark.read.json(path).count() == 2
    deliver(tmp_path, "two.csv", "3,c")
    run_once(spark, tmp_path, pipeline)
    assert sorted(r.v for r in spark.read.json(path).collect()) == ["A", "B", "C"]
    assert [p.name for p in Path(tmp_path / "archive").rglob("*.csv")] == ["one.csv"]


def test_a_name_delivered_again_and_an_old_file_are_read(spark, tmp_path):
    pipeline = pipeline_of(tmp_path, arrivals(tmp_path))
    deliver(tmp_path, "day one.csv", "1,a")
    run_once(spark, tmp_path, pipeline)
    old = time.time() - 30 * 86_400
    for archived in (False, True):
        deliver(tmp_path, "day one.csv", f"{2 + archived},b")
        deliver(tmp_path, f"late{archived}.csv", f"{4 + archived},c")
        for name in ("day one.csv", f"late{archived}.csv"):
            os.utime(tmp_path / "landing" / name, (old, old))
        run_once(spark, tmp_path, pipeline)
        run_once(spark, tmp_path, pipeline)
        old += 60
    found = sorted(r.k for r in spark.read.json(pipeline.sinks[0].path).collect())
    assert found == [1, 2, 3, 4, 5]


def test_a_backlog_is_worked_off_in_steps(spark, tmp_path):
    pipeline = pipeline_of(tmp_path, arrivals(tmp_path))
    for number in range(5):
        deliver(tmp_path, f"{number}.csv", f"{number},x")
    run_once(spark, tmp_path, pipeline, max_files_per_batch=2)
    rows = spark.read.json(pipeline.sinks[0].path).collect()
    assert sorted(r.k for r in rows) == [0, 1, 2, 3, 4]
    assert {r.batch_id for r in rows} == {0, 1, 2}


def test_a_retried_increment_replaces_its_rows(spark, tmp_path):
    """A batch that was written but not committed is written again, not twice."""
    pipeline = pipeline_of(tmp_path, arrivals(tmp_path), validation=True)
    deliver(tmp_path, "one.csv", "1,a", "2,b", "3,c")
    run_once(spark, tmp_path, pipeline)
    for name in ("0", ".0.crc"):
        committed = tmp_path / "checkpoint/commits" / name
        if committed.exists():
            committed.unlink()
    run_once(spark, tmp_path, pipeline)
    path = pipeline.sinks[0].path
    assert sorted(r.k for r in spark.read.json(path).collect()) == [2, 3]
    assert [(r.k, r.errMsg) for r in spark.read.json(path + "_INVALID").collect()] == [
        (1, "1 is less than the minimum of 2")
    ]


def test_increments_join_a_whole_source(spark, tmp_path):
    (tmp_path / "names.csv").write_text("1,one\n2,two\n")
    names = Source("names", "csv", COLUMNS, str(tmp_path / "names.csv"))
    columns = (SinkColumn("v", "String", 1), SinkColumn("name", "String", 2))
    sink = Sink("o", "parquet", columns, str(tmp_path / "out"))
    links = (Link("s", "o", 1, 2), Link("names", "o", 2, 2))
    pipeline = Pipeline("p", (arrivals(tmp_path), names), (sink,), links, JoinKey.parse("s:1=names:1"))
    deliver(tmp_path, "one.csv", "1,a", "9,z")
    run_once(spark, tmp_path, pipeline, streamed_source="s")
    deliver(tmp_path, "two.csv", "2,b")
    run_once(spark, tmp_path, pipeline, streamed_source="s")
    assert sorted((r.v, r.name) for r in spark.read.parquet(sink.path).collect()) == [("a", "one"), ("b", "two")]


def test_increments_feed_several_checked_sinks(spark, tmp_path):
    (tmp_path / "names.csv").write_text("1,one\n2,two\n")
    names = Source("names", "csv", COLUMNS, str(tmp_path / "names.csv"))
    sinks = tuple(Sink(n, "parquet", (SinkColumn("k", "Int", 1, minimum=2),), str(tmp_path / "out")) for n in "mn")
    links = (Link("s", "m", 1, 1), Link("names", "n", 1, 1))
    pipeline = Pipeline("p", (arrivals(tmp_path), names), sinks, links, JoinKey.parse("s:1=names:1"), validation=True)
    for name, line in (("one.csv", "1,a"), ("two.csv", "2,b")):
        deliver(tmp_path, name, line)
        run_once(spark, tmp_path, pipeline)
    for sink in sinks:
        sides = [spark.read.parquet(sink.path + suffix) for suffix in ("", "_INVALID")]
        assert [[(r.k, r.batch_id) for r in side.collect()] for side in sides] == [[(2, 1)], [(1, 0)]]


def test_a_landing_can_keep_running(spark, tmp_path):
    pipeline = pipeline_of(tmp_path, arrivals(tmp_path))
    deliver(tmp_path, "one.csv", "1,a")
    query = land(spark, pipeline, str(tmp_path / "checkpoint"), every="1 second")
    try:
        assert query.isActive
        query.processAllAvailable()
        deliver(tmp_path, "two.csv", "2,b")
        query.processAllAvailable()
    finally:
        query.stop()
    assert sorted(r.v for r in spark.read.json(pipeline.sinks[0].path).collect()) == ["A", "B"]


def test_fixed_width_increments(spark, tmp_path):
    columns = (SourceColumn("k", "Int", 1, 1, 2), SourceColumn("v", "String", 2, 2, 3))
    (tmp_path / "landing").mkdir()
    source = Source("s", "fixedWidth", columns, str(tmp_path / "landing"), record_size=5)
    pipeline = pipeline_of(tmp_path, source)
    deliver(tmp_path, "one.txt", "01abc", "02defg")
    run_once(spark, tmp_path, pipeline)
    assert [(r.k, r.v) for r in spark.read.json(pipeline.sinks[0].path).collect()] == [(1, "ABC")]


def test_refused_landings(spark, tmp_path):
    source = arrivals(tmp_path)
    database = Sink("o", "jdbcclient", (SinkColumn("k", "Int", 1),), table="t", url="jdbc:none", driver="none")
    with pytest.raises(SpecError, match="files or catalog tables"):
        run_once(spark, tmp_path, Pipeline("p", (source,), (database,), (Link("s", "o", 1, 1),)))
    clash = Sink("o", "json", (SinkColumn("Batch_Id", "Int", 1),), str(tmp_path / "out"))
    with pytest.raises(SpecError, match="names the increments"):
        run_once(spark, tmp_path, Pipeline("p", (source,), (clash,), (Link("s", "o", 1, 1),)))
    inferred = Source("s", "csv", COLUMNS, source.location, header=True, infer_schema=True)
    with pytest.raises(SpecError, match="declared columns"):
        run_once(spark, tmp_path, pipeline_of(tmp_path, inferred))


def uncommit(tmp_path, batch):
    for name in (str(batch), f".{batch}.crc"):
        (tmp_path / "checkpoint/commits" / name).unlink(missing_ok=True)


def test_increments_are_partitions_of_a_table(spark, tmp_path):
    columns = (SinkColumn("k", "Int", 1, minimum=2), SinkColumn("v", "String", 2))
    sink = Sink("o", "hivetable", columns, table="landed")
    links = (Link("s", "o", 1, 1), Link("s", "o", 2, 2))
    pipeline = Pipeline("p", (arrivals(tmp_path),), (sink,), links, validation=True)
    try:
        for number, name in enumerate(("one", "two")):
            deliver(tmp_path, f"{name}.csv", f"1,{name}", f"{2 + number},{name}")
            run_once(spark, tmp_path, pipeline)
        uncommit(tmp_path, 1)
        run_once(spark, tmp_path, pipeline)
        valid = spark.table("landed").collect()
        assert sorted((r.k, r.v, r.batch_id) for r in valid) == [(2, "one", 0), (3, "two", 1)]
        invalid = spark.table("landed_INVALID").collect()
        assert sorted((r.k, r.v, r.batch_id) for r in invalid) == [(1, "one", 0), (1, "two", 1)]
    finally:
        spark.sql("DROP TABLE IF EXISTS landed")
        spark.sql("DROP TABLE IF EXISTS landed_INVALID")


def test_a_retry_without_rows_leaves_none(spark, tmp_path):
    frame, sink = spark.range(3).toDF("k"), Sink("o", "hivetable", (SinkColumn("k", "Long", 1),), table="retried")
    try:
        assert write(frame, sink, increment=7).rows == 3
        assert write(frame, sink, increment=8).rows == 3
        assert write(frame.where("k < 0"), sink, increment=7).rows == 0
        assert [r.batch_id for r in spark.table("retried").collect()] == [8, 8, 8]
    finally:
        spark.sql("DROP TABLE IF EXISTS retried")


def test_a_table_without_increments_is_refused(spark):
    sink = Sink("o", "hivetable", (SinkColumn("k", "Long", 1),), table="unparted")
    spark.range(3).toDF("k").write.saveAsTable("unparted")
    try:
        with pytest.raises(SpecError, match="no partition column"):
            write(spark.range(3).toDF("k"), sink, increment=0)
        assert spark.table("unparted").count() == 3
    finally:
        spark.sql("DROP TABLE unparted")


def test_increments_leave_events(spark, tmp_path):
    pipeline, audit = pipeline_of(tmp_path, arrivals(tmp_path)), AuditLog(spark)
    deliver(tmp_path, "one.csv", "1,a", "2,b")
    run_once(spark, tmp_path, pipeline, audit=audit)
    events = audit.frame().orderBy("step").collect()
    assert [(r.message.split()[0], r.rows) for r in events] == [("Started", None), ("Wrote", 2), ("Finished", None), ("Total", None)]
    assert "increment 0 of p" in events[0].message
    deliver(tmp_path, "two.csv", "3,c")
    failing = replace(pipeline, sinks=(replace(pipeline.sinks[0], compression="none", options={"encoding": "none"}),))
    with pytest.raises(StreamingQueryException):
        run_once(spark, tmp_path, failing, audit=audit)
    assert [r.level for r in audit.frame().orderBy("step").collect()][4:] == ["INFO", "ERROR", "INFO"]
    run_once(spark, tmp_path, pipeline, audit=audit)
    assert sorted(r.v for r in spark.read.json(pipeline.sinks[0].path).collect()) == ["A", "B", "C"]


def test_each_increment_sizes_its_shuffles(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("specflow.plans.session._SHUFFLE_BYTES", 64)
    widths = []

    def noted(session, *arguments, **settings):
        widths.append(session.conf.getAll.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum"))

    monkeypatch.setattr("specflow.streaming.landing.write_sinks", noted)
    pipeline = pipeline_of(tmp_path, arrivals(tmp_path))
    for number, lines in enumerate((1_000, 1)):
        deliver(tmp_path, f"{number}.csv", *["1,a"] * lines)
    (old, new) = (time.time() - 60, time.time())
    os.utime(tmp_path / "landing/0.csv", (old, old))
    os.utime(tmp_path / "landing/1.csv", (new, new))
    run_once(spark, tmp_path, pipeline, max_files_per_batch=1)
    assert int(widths[0]) == 4_000 // 64 and widths[1] is None


def test_log_events_go_to_the_folder_of_their_key(spark, tmp_path):
    topic, logs = tmp_path / "topic", str(tmp_path / "logs")
    topic.mkdir()
    events = ['{"key":"p 1/a","value":"{\\"m\\":1}"}', '{"key":null,"value":"x"}', '{"key":"q"}', '{"key":"q","value":"two"}']
    (topic / "one.json").write_text("\n".join(events) + "\n")
    route_log(keyed_events(spark, str(topic)), logs, str(tmp_path / "checkpoint"))
    (topic / "two.json").write_text('{"key":"q","value":"three"}\n')
    route_log(keyed_events(spark, str(topic)), logs, str(tmp_path / "checkpoint"))
    rows = spark.read.schema("value string, key string").text(logs).collect()
    assert sorted((r.key, r.value) for r in rows) == [("p 1/a", '{"m":1}'), ("q", "three"), ("q", "two")]


def test_log_keys_can_be_gathered_into_few_files(spark, tmp_path):
    spark.range(0, 4000, 1, 8).selectExpr(
        "if(id % 3 = 0, 'hot', concat('k', id % 5)) as key", "cast(id as string) as value"
    ).write.json(str(tmp_path / "topic"))
    logs = tmp_path / "logs"
    route_log(keyed_events(spark, str(tmp_path / "topic")), str(logs), str(tmp_path / "checkpoint"), files_per_key=2)
    rows = spark.read.schema("value string, key string").text(str(logs))
    assert rows.select("value").distinct().count() == rows.count() == 4000
    assert {len(list(folder.glob("part-*"))) for folder in logs.glob("key=*")} <= {1, 2}


# The ledger of deliveries


def overwrite(path, *lines, keep_time):
    """Deliver a name again, with the old time or a new one."""
    before = path.stat().st_mtime_ns if path.exists() else time.time_ns()
    path.write_text("\n".join(lines) + "\n")
    if keep_time:
        os.utime(path, ns=(before, before))


@pytest.mark.parametrize("archived", [True, False])
@pytest.mark.parametrize("keep_time", [True, False])
def test_a_landing_that_keeps_running_reads_a_name_again(spark, tmp_path, archived, keep_time):
    """Also with the old time, if the length differs: deliveries are told apart by path, time and length."""
    pipeline = pipeline_of(tmp_path, arrivals(tmp_path))
    deliver(tmp_path, "day [1] *.csv", "1,a")
    archive = str(tmp_path / "archive") if archived else None
    query = land(spark, pipeline, str(tmp_path / "checkpoint"), archive, every="1 second")
    try:
        query.processAllAvailable()
        overwrite(tmp_path / "landing/day [1] *.csv", "22,b", keep_time=keep_time)
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    overwrite(tmp_path / "landing/day [1] *.csv", "333,c", keep_time=keep_time)
    for _ in range(2):
        land(spark, pipeline, str(tmp_path / "checkpoint"), archive)
    assert sorted(r.k for r in spark.read.json(pipeline.sinks[0].path).collect()) == [1, 22, 333]
    # a file that is overwritten before it is archived is gone, though it was read
    assert len(list((tmp_path / "archive").rglob("*.csv"))) in ((1, 2, 3) if archived else (0,))


def test_a_running_landing_finds_files_by_itself(spark, tmp_path):
    pipeline = pipeline_of(tmp_path, arrivals(tmp_path))
    query = land(spark, pipeline, str(tmp_path / "checkpoint"), every="1 second")
    try:
        deliver(tmp_path, "one.csv", "1,a")
        for _ in range(120):
            if Path(pipeline.sinks[0].path, "batch_id=0", "_SUCCESS").exists():
                break
            time.sleep(0.5)
    finally:
        query.stop()
    assert [r.v for r in spark.read.json(pipeline.sinks[0].path).collect()] == ["A"]


def test_the_ledger_forgets_what_has_left_the_folder(spark, tmp_path):
    """Settled claims go; what still lies in the folder is remembered in one table."""
    pipeline = pipeline_of(tmp_path, arrivals(tmp_path))
    deliver(tmp_path, "stays.csv", "0,x")
    for number in range(4):
        deliver(tmp_path, "day.csv", f"{number + 1},{'x' * number}")
        run_once(spark, tmp_path, pipeline)
    checkpoint = tmp_path / "checkpoint"
    assert len(list((checkpoint / "deliveries").glob("[0-9]*.json"))) <= 1
    land(spark, pipeline, str(checkpoint))  # from here on without an archive
    deliver(tmp_path, "more.csv", "9,z")
    land(spark, pipeline, str(checkpoint))
    land(spark, pipeline, str(checkpoint))
    (known,) = [p for p in (checkpoint / "known").iterdir() if not p.name.startswith(".")]
    assert {Path(r.path).name for r in spark.read.parquet(str(known)).collect()} <= {"more.csv", "stays.csv", "day.csv"}
    assert sorted(r.k for r in spark.read.json(pipeline.sinks[0].path).collect()) == [0, 1, 2, 3, 4, 9]


def test_a_file_replaced_before_it_was_read_is_its_own_delivery(spark, tmp_path, monkeypatch):
    """The claim of the old file finds nothing; the new one is claimed by the next look."""
    pipeline, audit = pipeline_of(tmp_path, arrivals(tmp_path)), AuditLog(spark)
    deliver(tmp_path, "one.csv", "1,a")
    checkpoint = str(tmp_path / "checkpoint")
    Deliveries(spark, pipeline.sources[0].location, checkpoint).look()
    deliver(tmp_path, "one.csv", "22,b")
    land(spark, pipeline, checkpoint, audit=audit)
    assert sorted(r.k for r in spark.read.schema("k int").json(pipeline.sinks[0].path).collect()) == [22]
    assert audit.frame().where("message like '%replaced before%'").count() == 1


def test_a_checkpoint_that_knows_paths_only_is_refused(spark, tmp_path):
    pipeline = pipeline_of(tmp_path, arrivals(tmp_path))
    deliver(tmp_path, "old.csv", "1,a")
    stream = spark.readStream.schema("k int, v string").csv(str(tmp_path / "landing")).writeStream.foreachBatch(lambda df, n: None)
    stream.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    with pytest.raises(SpecError, match="paths alone"):
        land(spark, pipeline, str(tmp_path / "checkpoint"))


@pytest.mark.parametrize("keep_time", [True, False])
def test_the_log_router_reads_a_name_again(spark, tmp_path, keep_time):
    topic, logs, checkpoint = tmp_path / "topic", str(tmp_path / "logs"), str(tmp_path / "checkpoint")
    topic.mkdir()
    (topic / "day.json").write_text('{"key":"a","value":"1"}\n')
    route_log(keyed_events(spark, str(topic)), logs, checkpoint)
    overwrite(topic / "day.json", '{"key":"b","value":"22"}', keep_time=keep_time)
    for _ in range(2):
        route_log(keyed_events(spark, str(topic)), logs, checkpoint)
    assert sorted((r.key, r.value) for r in spark.read.text(logs).collect()) == [("a", "1"), ("b", "22")]


@pytest.mark.parametrize("moved", [0, 1, 2])
def test_a_routed_batch_that_broke_off_arrives_once(spark, tmp_path, monkeypatch, moved):
    """Between staging, moving and committing, however many files have been moved."""
    topic, logs, checkpoint = tmp_path / "topic", str(tmp_path / "logs"), str(tmp_path / "checkpoint")
    topic.mkdir()
    (topic / "one.json").write_text('{"key":"a","value":"1"}\n{"key":"b","value":"2"}\n')

    def breaks_off(session, staged, target):
        for path, place in list(storage.files_below(session, staged))[:moved]:
            storage.move(session, path, f"{target}/{place}")
        raise OSError("broke off")

    with monkeypatch.context() as patched:
        patched.setattr("specflow.streaming.log_route.move_into", breaks_off)
        with pytest.raises(StreamingQueryException, match="broke off"):
            route_log(keyed_events(spark, str(topic)), logs, checkpoint)
    route_log(keyed_events(spark, str(topic)), logs, checkpoint)
    assert sorted((r.key, r.value) for r in spark.read.text(logs).collect()) == [("a", "1"), ("b", "2")]
    assert not list(Path(logs).glob("_specflow*"))


def test_frequent_keys_get_files_by_their_share(spark, tmp_path):
    events = spark.range(0, 6000, 1, 8).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 400)) as key", "cast(id as string) as value")
    events.write.json(str(tmp_path / "topic"))
    logs = tmp_path / "logs"
    route_log(keyed_events(spark, str(tmp_path / "topic")), str(logs), str(tmp_path / "checkpoint"), rows_per_file=500)
    rows = spark.read.text(str(logs))
    assert rows.select("value").distinct().count() == rows.count() == 6000
    files = {folder.name: len(list(folder.glob("part-*"))) for folder in logs.glob("key=*")}
    assert files.pop("key=hot") == 4 and set(files.values()) == {1} and len(files) == 400


def test_a_streams_own_sink_is_not_mixed_with_files(spark, tmp_path):
    (tmp_path / "logs/_spark_metadata").mkdir(parents=True)
    with pytest.raises(SpecError, match="another folder"):
        route_log(keyed_events(spark, str(tmp_path / "topic")), str(tmp_path / "logs"), str(tmp_path / "checkpoint"))
    with pytest.raises(SpecError, match="events from files"):
        route_log(spark.readStream.format("rate").load().selectExpr("'a' as key", "'b' as value"), "x", "y", rows_per_file=3)
