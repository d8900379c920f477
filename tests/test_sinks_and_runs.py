"""Writing, splitting, running and logging."""

from __future__ import annotations

import json
import subprocess
import sys
import time
from pathlib import Path

import pytest
from metadata_files import MetadataFiles
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from specflow import (
    AuditLog,
    JoinKey,
    Link,
    MetadataStore,
    Pipeline,
    PipelineFailures,
    Sink,
    SinkColumn,
    Source,
    SourceColumn,
    SpecError,
    pipeline_session,
    run,
    run_all,
    run_processes,
)
from specflow.plans.audit import kept_events
from specflow.plans.run import write_sinks
from specflow.sinks import storage, write, write_split
from specflow.sinks.write import distributed, target_of
from specflow.sources import read
from specflow.sources.tables import connection_options, read_jdbc


@pytest.fixture(scope="module")
def session(spark):
    return pipeline_session(spark)


def numbers(session, count, partitions=4):
    return session.range(0, count, 1, partitions).select("id", (F.col("id") % 3).cast("string").alias("part"))


def files_of(path):
    return [p for p in Path(path).rglob("part-*") if not p.name.endswith(".crc")]


def sink(tmp_path, file_type="parquet", **fields):
    return Sink("o", file_type, fields.pop("columns", ()), str(tmp_path / "out"), **fields)


# Layout


@pytest.mark.parametrize("file_type", ["json", "parquet", "orc", "csv", "delimited"])
def test_file_layout_and_row_count(session, tmp_path, file_type):
    target = sink(tmp_path, file_type)
    written = write(numbers(session, 10), target)
    assert written.target == str(tmp_path / f"out/o_{file_type}/{file_type}")
    assert (written.rows, written.skipped) == (10, False)
    assert files_of(written.target)


def test_requested_files_do_not_narrow_the_work_before(session, tmp_path):
    target = sink(tmp_path, num_partitions=2)
    df = numbers(session, 1000, partitions=6)
    write(df, target)
    assert len(files_of(target.path)) == 2
    assert "Exchange RoundRobinPartitioning(2)" in distributed(df, target)._jdf.queryExecution().executedPlan().toString()


def test_unpartitioned_output_is_written_where_it_is_computed(session, tmp_path):
    df = numbers(session, 100)
    assert distributed(df, sink(tmp_path)) is df


def test_partitioned_output_is_rebalanced_unless_told_otherwise(session, tmp_path):
    df = numbers(session, 1000, partitions=6)
    target = sink(tmp_path, partition_by=("part",))
    write(df, target)
    assert len(files_of(target.path)) == 3
    spread = Sink("p", "parquet", (), str(tmp_path / "out"), partition_by=("part",), rebalance=False)
    assert distributed(df, spread) is df


def test_a_hot_partition_value_is_split_over_tasks(session, tmp_path):
    """Nearly all rows share one value; it must not end up in one task or file."""
    hot = session.range(0, 300_000, 1, 6).select(
        F.when(F.col("id") % 100 == 0, F.col("id") % 5).otherwise(7).alias("part"), F.sha2(F.col("id").cast("string"), 256)
        .alias("text"),
    )
    target = sink(tmp_path, partition_by=("part",))
    session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        write(hot, target)
    finally:
        session.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(files_of(target.path + "/part=7")) > 4
    assert session.read.parquet(target.path).count() == 300_000


def test_ignore_leaves_files_and_tables_alone(session, tmp_path):
    target = sink(tmp_path, mode="ignore")
    assert write(numbers(session, 5), target).rows == 5
    second = write(numbers(session, 9), target)
    assert (second.skipped, second.rows, second.profile) == (True, None, [])
    assert session.read.parquet(target.path).count() == 5
    table = Sink("t", "hivetable", (), mode="ignore", table="ignored_twice")
    assert not write(numbers(session, 5), table).skipped
    assert write(numbers(session, 9), table).skipped
    assert session.table("ignored_twice").count() == 5


def test_errorifexists_is_an_error(session, tmp_path):
    write(numbers(session, 5), sink(tmp_path))
    with pytest.raises(AnalysisException):
        write(numbers(session, 5), sink(tmp_path))


def test_unavailable_codecs_are_errors(session, tmp_path):
    for codec in ("lzo", "brotli", "nonsense"):
        with pytest.raises(Exception):
            write(numbers(session, 5), sink(tmp_path / codec, compression=codec))


def test_microseconds_survive_text_with_a_format(session, tmp_path):
    stamp = "2024-01-02 03:04:05.678901"
    df = session.sql(f"select timestamp'{stamp}' as t")
    own = {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    for file_type in ("csv", "json"):
        target = sink(tmp_path, file_type, options=own)
        write(df, target)
        back = Source("b", file_type, (SourceColumn("t", "Timestamp", 1),), target.path, options=own)
        assert read(session, back).select(F.col("t").cast("string")).first()[0] == stamp


def test_text_with_breaks_and_quotes_survives(session, tmp_path):
    texts = ['a "quoted" word', "two\nlines", "a,b|c", "", "back\\slash", None]
    df = session.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    own = {"escape": '"', "nullValue": "\\N"}
    target = sink(tmp_path, "csv", options=own)
    write(df, target)
    columns = (SourceColumn("i", "Int", 1), SourceColumn("t", "String", 2))
    back = Source("b", "csv", columns, target.path, options={"multiLine": "true", **own})
    assert [r.t for r in read(session, back).orderBy("i").collect()] == texts


# Twin sinks


def checked(session, rows):
    return session.createDataFrame(rows, "id int, valid string, errMsg string")


@pytest.mark.parametrize(
    "rows",
    [[(1, "Y", ""), (2, "N", "bad"), (3, "Y", "")], [(1, "Y", "")], [(1, "N", "bad")], []],
)
@pytest.mark.parametrize("file_type", ["parquet", "json", "csv"])
@pytest.mark.parametrize("repeatable", [True, False])
def test_split(session, tmp_path, rows, file_type, repeatable):
    target = sink(tmp_path, file_type)
    valid, invalid = write_split(checked(session, rows), target, repeatable=repeatable)
    expected = {flag: [r for r in rows if r[1] == flag] for flag in "YN"}
    assert (valid.rows, invalid.rows) == (len(expected["Y"]), len(expected["N"]))
    assert (valid.target, invalid.target) == (target.path, target.path + "_INVALID")
    for written, flag in ((valid, "Y"), (invalid, "N")):
        reader = session.read.schema("id int, valid string, errMsg string").option("emptyValue", "")
        back = reader.format(target.format).load(written.target)
        assert sorted((r.id, r.valid, r.errMsg or "") for r in back.collect()) == expected[flag]


def test_unrepeatable_values_are_split_consistently(session, tmp_path):
    """A check on a random value must put each row on exactly one side."""
    df = session.range(2000).select("id", F.rand().alias("r"))
    rows = df.withColumn("valid", F.when(F.col("r") < 0.5, "Y").otherwise("N")).withColumn("errMsg", F.lit(""))
    target = sink(tmp_path)
    write_split(rows, target)
    sides = [session.read.parquet(target.path + suffix) for suffix in ("", "_INVALID")]
    assert sides[0].where("r >= 0.5").count() == sides[1].where("r < 0.5").count() == 0
    assert sides[0].union(sides[1]).select("id").distinct().count() == 2000


@pytest.mark.parametrize(
    "file_type, template, stores",
    [
        ("parquet", "substr({0}, 1, 2)", 0),
        ("parquet", "CASE WHEN {0} in ('a') THEN upper ({0}) ELSE cast({0} as string) END", 0),
        ("parquet", "concat({0}, rand())", 1),
        ("parquet", "my_function({0})", 0),  # its body tells that it is repeatable
        ("parquet", "concat({0}, current_timestamp)", 1),
        ("parquet", "concat({0}, unix_timestamp())", 1),
        ("csv", "upper({0})", 1),
    ],
)
@pytest.mark.parametrize("target", ["json", "hivetable"])
def test_checked_rows_of_tables_are_stored_unless_a_second_scan_is_cheap_and_the_same(
    spark, tmp_path, monkeypatch, file_type, template, stores, target
):
    """Files take one pass, so nothing has to be stored for them."""
    source = small_source(tmp_path)
    if file_type == "parquet":
        read(spark, source).write.parquet(str(tmp_path / "columnar"))
        source = Source("s", "parquet", source.columns, str(tmp_path / "columnar"))
    columns = (KV[0], SinkColumn("v", "String", 2, transform=template))
    sink = Sink("o", target, columns, str(tmp_path / "out")) if target == "json" else Sink("o", target, columns, table="checked_rows")
    pipeline = Pipeline("p", (source,), (sink,), (Link("s", "o", 1, 1), Link("s", "o", 2, 2)), validation=True)
    folders = []
    monkeypatch.setattr(storage, "new_folder", lambda spark, purpose: folders.append(str(tmp_path / purpose)) or folders[-1])
    session = pipeline_session(spark, pipeline)
    session.sql("CREATE TEMPORARY FUNCTION my_function(s STRING) RETURNS STRING RETURN upper(s)")
    written = []
    try:
        write_sinks(session, pipeline, report=written.append)
    finally:
        for suffix in ("", "_INVALID"):
            spark.sql(f"DROP TABLE IF EXISTS checked_rows{suffix}")
    assert ([w.rows for w in written], len(folders)) == ([2, 1], stores if target == "hivetable" else 0)


@pytest.mark.parametrize("width", [2, 26, 60])
@pytest.mark.parametrize("n_sinks", [1, 2])
def test_wide_checked_sinks_keep_every_row(spark, tmp_path, width, n_sinks):
    """A value that each evaluation draws anew decides the side of a row: it is drawn once for both sides and all sinks."""
    source = Source("s", "parquet", (SourceColumn("id", "Long", 1),), str(tmp_path / "in"))
    spark.range(0, 3000, 1, 4).write.parquet(source.location)
    drawn = "case when substr(hex(aes_encrypt(cast({0} as string), '0000111122223333')), 1, 1) < '8' then {0} end"
    columns = (*(SinkColumn(f"c{i}", "Long", i) for i in range(1, width)), SinkColumn("drawn", "Long", width, transform=drawn, required=True))
    sinks = tuple(Sink(f"o{n}", "parquet", columns, str(tmp_path / "out")) for n in range(n_sinks))
    links = tuple(Link("s", sink.id, i, 1) for sink in sinks for i in range(1, width + 1))
    result = run_all(spark, [Pipeline("p", (source,), sinks, links, validation=True)])[0]
    for sink, valid, invalid in zip(sinks, result.written[::2], result.written[1::2], strict=True):
        assert valid.rows + invalid.rows == 3000 and min(valid.rows, invalid.rows) > 1000
        sides = [spark.read.parquet(sink.path + suffix) for suffix in ("", "_INVALID")]
        assert sides[0].unionByName(sides[1]).select("c1").distinct().count() == 3000
        assert sides[0].where("drawn is null").count() == sides[1].where("drawn is not null").count() == 0


@pytest.mark.parametrize("mode", ["append", "overwrite", "ignore", "errorifexists"])
@pytest.mark.parametrize("partition_by", [(), ("id",)])
def test_twin_sinks_in_every_mode(session, tmp_path, mode, partition_by):
    """Both sides in one pass, added to, put in place of, or left out for what is there."""
    rows = [(1, "Y", ""), (2, "N", "bad"), (3, "Y", "")]
    target = sink(tmp_path, mode=mode, partition_by=partition_by)
    schema = "id int, valid string, errMsg string"

    def held():
        sides = [session.read.schema(schema).parquet(target.path + suffix) for suffix in ("", "_INVALID")]
        return [sorted(r.id for r in side.collect()) for side in sides]

    assert [w.rows for w in write_split(checked(session, rows), target)] == [2, 1]
    assert held() == [[1, 3], [2]]
    again = checked(session, [(7, "Y", ""), (8, "Y", "")])
    if mode == "errorifexists":
        with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
            write_split(again, target)
    else:
        written = write_split(again, target)
        assert [w.skipped for w in written] == [mode == "ignore"] * 2
    assert held() == {"append": [[1, 3, 7, 8], [2]], "overwrite": [[7, 8], []]}.get(mode, [[1, 3], [2]])
    assert not [p for p in (tmp_path / "out").rglob("_specflow*")]


def test_twin_sinks_profile_either_side(session, tmp_path):
    rows = [(1, "Y", ""), (2, "N", "bad"), (4, "Y", ""), (9, "Y", "")]
    valid, invalid = write_split(checked(session, rows), sink(tmp_path), profiles=True)
    by = [{r["column_name"]: r for r in side.profile} for side in (valid, invalid)]
    assert [(p["id"]["count"], p["id"]["min"], p["id"]["max"]) for p in by] == [(3, "1", "9"), (1, "2", "2")]
    assert by[1]["errMsg"]["max"] == "bad" and set(by[0]) == {"id", "valid", "errMsg"}


# Overwriting


def test_a_failed_overwrite_leaves_the_old_rows(session, tmp_path):
    target = sink(tmp_path, mode="overwrite")
    write(numbers(session, 10), target)
    failing = session.range(0, 100, 1, 4).select(F.expr("if(id = 99, raise_error('midway'), id)").alias("id"), F.lit("x").alias("part"))
    with pytest.raises(Exception, match="midway"):
        write(failing, target)
    assert sorted(r.id for r in session.read.parquet(target.path).collect()) == list(range(10))
    assert write(numbers(session, 4), target).rows == 4
    assert session.read.parquet(target.path).count() == 4
    # a sink may be overwritten with what is read from it
    write(session.read.parquet(target.path).where("id > 1"), target)
    assert sorted(r.id for r in session.read.parquet(target.path).collect()) == [2, 3]
    assert not list((tmp_path / "out").rglob("_specflow*"))


def test_dynamic_overwrites_replace_their_partitions_only(session, tmp_path):
    target = sink(tmp_path, mode="overwrite", partition_by=("part",), options={"partitionOverwriteMode": "dynamic"})
    write(numbers(session, 9), target)
    write(numbers(session, 9).where("part = '1'").select((F.col("id") + 100).alias("id"), "part"), target)
    assert sorted(r.id for r in session.read.parquet(target.path).collect()) == [0, 2, 3, 5, 6, 8, 101, 104, 107]


@pytest.mark.parametrize("name", ["out", "batch_id=3"])
@pytest.mark.parametrize("step", range(4))
def test_a_swap_that_broke_off_is_finished(session, tmp_path, name, step):
    """Whichever rename came last, the next write finds one whole set of rows at the path."""
    path = str(tmp_path / name)
    session.range(3).write.parquet(path)
    session.range(5).write.parquet(str(tmp_path / "staged"))
    new, old = storage.beside(path, "new"), storage.beside(path, "old")
    renames = [(str(tmp_path / "staged"), new), (path, old), (new, path)][:step]
    for a, b in renames:
        storage.move(session, a, b)
    storage.recover(session, path)
    assert session.read.parquet(path).count() == (5 if step else 3)
    assert not storage.exists(session, new) and not storage.exists(session, old)
    storage.move(session, path, old)  # nothing has come: the old rows go back
    storage.recover(session, path)
    assert session.read.parquet(path).count() == (5 if step else 3)


@pytest.mark.parametrize("mode, expected", [("append", [1, 2, 7]), ("ignore", [1, 2])])
@pytest.mark.parametrize("split", [True, False])
def test_a_write_finds_what_a_broken_off_swap_left(session, tmp_path, mode, expected, split):
    target = sink(tmp_path, mode=mode)
    checked(session, [(1, "Y", ""), (2, "Y", "")]).write.parquet(storage.beside(target.path, "new"))
    rows = checked(session, [(7, "Y", "")])
    write_split(rows, target) if split else write(rows, target)
    assert sorted(r.id for r in session.read.parquet(target.path).collect()) == expected


@pytest.mark.parametrize("n_sinks, scans", [(1, 1), (3, 1)])
def test_sources_are_scanned_once(spark, tmp_path, n_sinks, scans):
    """However many sinks there are, and with both sides of each: rows read from the source, as its tasks report them."""
    source = Source("s", "parquet", (SourceColumn("id", "Long", 1),), str(tmp_path / "in"))
    spark.range(0, 1000, 1, 4).write.parquet(source.location)
    columns = (SinkColumn("id", "Long", 1, minimum=500),)
    sinks = tuple(Sink(f"o{n}", ("parquet", "json", "orc")[n], columns, str(tmp_path / "out")) for n in range(n_sinks))
    pipeline = Pipeline("p", (source,), sinks, tuple(Link("s", s.id, 1, 1) for s in sinks), validation=True)
    session = pipeline_session(spark, pipeline)
    counter = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            counter.add(batch.num_rows)
            yield batch

    given = {"s": read(session, source).mapInArrow(counted, "id long")}
    write_sinks(session, pipeline, given=given)
    assert counter.value == 1000 * scans
    assert [spark.read.schema("id long").parquet(sinks[0].path + suffix).count() for suffix in ("", "_INVALID")] == [500, 500]


def test_the_stored_table_is_dropped(session, tmp_path):
    with storage.written_once(numbers(session, 10)) as rows:
        (path,) = {str(Path(f).parent) for f in (p.replace("file://", "") for p in rows.inputFiles())}
        assert rows.count() == 10 and storage.exists(session, path)
    assert not storage.exists(session, path)


def test_columns_without_a_type_are_stored(session):
    df = session.sql("select 1 as `a.b`, null as nothing")
    with storage.written_once(df) as rows:
        assert rows.columns == ["a.b", "nothing"] and [tuple(r) for r in rows.collect()] == [(1, None)]


def test_the_shared_folder_is_the_one_the_session_names(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    own = f"{named}/specflow/{spark.sparkContext.applicationId}"
    folder = storage.new_folder(spark, "x")
    assert folder.startswith(own + "/x-") and storage.exists(spark, own) and not storage.exists(spark, folder)


_LEAVES_A_FOLDER = """
import sys
from pyspark.sql import SparkSession
from specflow.sinks.storage import new_folder
builder = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
spark = builder.config("spark.checkpoint.dir", sys.argv[1]).getOrCreate()
spark.range(3).write.parquet(new_folder(spark, "x"))
print(len(list(__import__("pathlib").Path(sys.argv[1], "specflow").iterdir())))
"""


def test_scratch_folders_go_when_the_application_ends(tmp_path):
    shared, root = tmp_path / "shared", str(Path(__file__).resolve().parent.parent)
    command = [sys.executable, "-c", _LEAVES_A_FOLDER, str(shared)]
    done = subprocess.run(command, capture_output=True, text=True, cwd=root, timeout=120, check=True)
    assert done.stdout.split()[-1] == "1"
    for _ in range(50):  # the JVM ends a little later
        if not list((shared / "specflow").iterdir()):
            return
        time.sleep(0.2)
    raise AssertionError("the folder is still there")


# Whole runs


def small_source(tmp_path, name="s", lines=("1,a", "2,b", "3,c")):
    path = tmp_path / f"{name}.csv"
    path.write_text("\n".join(lines) + "\n")
    return Source(name, "csv", (SourceColumn("k", "Int", 1), SourceColumn("v", "String", 2)), str(path))


KV = (SinkColumn("k", "Int", 1, minimum=2), SinkColumn("v", "String", 2))


def test_validated_mesh_of_joined_sources_and_sinks(spark, tmp_path):
    """Two joined sources with equally named columns into two checked sinks."""
    a, b = small_source(tmp_path, "a"), small_source(tmp_path, "b", ("1,x", "2,y", "4,z"))
    sinks = tuple(Sink(n, "parquet", KV, str(tmp_path / "out")) for n in ("m", "n"))
    links = (Link("a", "m", 1, 1), Link("b", "m", 2, 2), Link("b", "n", 1, 1), Link("a", "n", 2, 2))
    result = run_all(spark, [Pipeline("p", (a, b), sinks, links, JoinKey.parse("a:1=b:1"), validation=True)])[0]
    assert [w.rows for w in result.written] == [1, 1, 1, 1]
    read_back = {s.id: spark.read.parquet(s.path).collect() for s in sinks}
    assert [(r.k, r.v) for r in read_back["m"]] == [(2, "y")]
    assert [(r.v, r.k) for r in read_back["n"]] == [("b", 2)]


@pytest.mark.parametrize("file_type", ["csv", "parquet"])
def test_one_source_feeds_several_sinks(spark, tmp_path, file_type):
    """A text source is read once for all sinks, a columnar one by each sink."""
    source = small_source(tmp_path)
    if file_type == "parquet":
        path = str(tmp_path / "columnar")
        read(spark, source).write.parquet(path)
        source = Source("s", "parquet", source.columns, path)
    names, drawn = (SinkColumn("v", "String", 1, transform="upper({0})"),), (SinkColumn("r", "Double", 1, default="rand()"),)
    sinks = (Sink("m", "csv", names, str(tmp_path / "out")), Sink("n", "orc", drawn, str(tmp_path / "out")),
             Sink("o", "orc", drawn, str(tmp_path / "out")))
    links = (Link("s", "m", 1, 2), Link("s", "n", 1), Link("s", "o", 1))
    result = run_all(spark, [Pipeline("p", (source,), sinks, links)])[0]
    assert [w.rows for w in result.written] == [3, 3, 3]
    assert sorted(r[0] for r in spark.read.csv(sinks[0].path).collect()) == ["A", "B", "C"]


def test_a_failed_sink_leaves_the_finished_ones_on_record(spark, tmp_path):
    source = small_source(tmp_path)
    sinks = tuple(Sink(n, "json", KV, str(tmp_path / "out"), mode="errorifexists") for n in "mn")
    (tmp_path / "out/n_json/json").mkdir(parents=True)
    links = tuple(Link("s", n, 1, 1) for n in "mn")
    audit = AuditLog(spark)
    result = run(spark, Pipeline("p", (source,), sinks, links), audit)
    assert not result.succeeded and [w.target for w in result.written] == [sinks[0].path]
    assert [e.rows for e in audit.frame().where("message like 'Wrote%'").collect()] == [3]


def test_a_query_feeds_several_checked_sinks(spark, tmp_path):
    sinks = tuple(Sink(n, "json", KV, str(tmp_path / "out")) for n in ("m", "n"))
    text = "select k, upper(v) as v from s"
    result = run_all(spark, [Pipeline("p", (small_source(tmp_path),), sinks, query=text, validation=True)])[0]
    assert [w.rows for w in result.written] == [2, 1, 2, 1]
    rows = spark.read.json(sinks[1].path + "_INVALID").collect()
    assert [(r.k, r.v, r.errMsg) for r in rows] == [(1, "A", "1 is less than the minimum of 2")]


@pytest.mark.parametrize("profiles", [True, False])
@pytest.mark.parametrize("validation", [True, False])
def test_queries_that_are_known_to_be_empty(spark, tmp_path, profiles, validation):
    sinks = (Sink("o", "parquet", KV, str(tmp_path / "out")),)
    text = "select k, v from s where 1 = 0"
    pipeline = Pipeline("p", (small_source(tmp_path),), sinks, query=text, validation=validation)
    result = run_all(spark, [pipeline], profiles=profiles)[0]
    assert {w.rows for w in result.written} == {0}
    assert all(p["count"] == 0 for w in result.written for p in w.profile)


def test_failures_are_recorded_and_do_not_stop_other_pipelines(spark, tmp_path):
    source = small_source(tmp_path)
    links = (Link("s", "o", 1, 1), Link("s", "o", 2, 2))
    missing = Source("s", "csv", source.columns, str(tmp_path / "nowhere"))
    good, bad = (
        Pipeline(name, (src,), (Sink("o", "json", KV, str(tmp_path / name)),), links)
        for name, src in (("good", source), ("bad", missing))
    )
    idle = Pipeline("idle", (missing,), good.sinks, links, active=False)
    audit = AuditLog(spark)
    with pytest.raises(PipelineFailures, match="bad: AnalysisException") as failure:
        run_all(spark, [bad, idle, good], audit)
    assert "good" not in str(failure.value)
    assert spark.read.json(good.sinks[0].path).count() == 3
    events = [(e.pipeline_id, e.step, e.level, e.message.split(" ")[0]) for e in audit.frame().collect()]
    assert events == [
        ("bad", 1, "INFO", "Started"), ("bad", 2, "ERROR", "AnalysisException:"), ("bad", 3, "INFO", "Total"),
        ("good", 1, "INFO", "Started"), ("good", 2, "INFO", "Wrote"), ("good", 3, "INFO", "Finished"),
        ("good", 4, "INFO", "Total"),
    ]


def test_process_files_are_chosen_by_their_whole_name(spark, tmp_path):
    files = MetadataFiles(tmp_path / "config")
    files.source("s", "k Int, v String", fileType="csv", srcLocation=small_source(tmp_path).location)
    files.sink("d", [{"colName": "k", "colType": "Int"}], fileType="json", destLocation=str(tmp_path / "out"))
    for name, column in (("1", 1), ("2", 9), ("12", 1), ("3", 2)):
        files.process(name, [("s", column, "d", 1)])
    store, audit = MetadataStore.under(str(tmp_path / "config")), AuditLog(spark)
    assert store.process_files(r"prc_[0-9]\.json") == ["prc_1.json", "prc_2.json", "prc_3.json"]
    with pytest.raises(PipelineFailures, match="^2: SpecError: source s has no column with id 9$"):
        run_processes(spark, store, r"prc_[0-9]\.json", audit)
    assert {e.pipeline_id: e.level for e in audit.frame().where("step = 1").collect()} == {
        "1": "INFO", "2": "ERROR", "3": "INFO",
    }


def test_audit_rows_can_be_kept_and_published(spark, tmp_path):
    source = small_source(tmp_path)
    pipeline = Pipeline("p", (source,), (Sink("o", "json", KV, str(tmp_path / "out")),), (Link("s", "o", 1, 1),))
    audit = AuditLog(spark)
    run(spark, pipeline, audit, profiles=True)
    for _ in range(2):
        audit.append_to(str(tmp_path / "audit"))
    assert spark.read.json(str(tmp_path / "audit")).count() == 2 * audit.frame().count()
    key, value = audit.topic_frame().first()
    assert key.startswith("p-specflow-tests-local-") and set(json.loads(value)) == {"Timestamp", "LogLevel", "LogMsg"}
    details = {json.loads(r)["message"].split(" ")[0]: json.loads(r)["detail"] for r in audit.records()}
    assert json.loads(details["Profiled"])[0] == {"summary": "count", "k": "3", "v": "3"}
    assert json.loads(details["Wrote"])[1] == {"summary": "mean", "k": "2.0"}


def test_events_survive_a_lost_driver(spark, tmp_path):
    """Every event is a file at once; what never ended is found by the next run, and put on record once."""
    folder = str(tmp_path / "audit")
    first, live = AuditLog(spark, folder), AuditLog(spark, folder)
    with first.recorded("a/b c", "one"):
        first.info("a/b c", "midway")
    first._add("lost", "INFO", "Started processing x", work="x", event="started")
    first._add("lost", "INFO", "Started processing y", work="y", event="started")
    assert kept_events(spark, folder).count() == first.frame().count() == 6
    assert live.unfinished(idle_seconds=3600).count() == 0 and first.unfinished().count() == 0
    assert sorted((r.pipeline_id, r.work, r.step) for r in live.unfinished().collect()) == [("lost", "x", 2), ("lost", "y", 2)]
    first.gather()  # of other runs there is nothing to gather
    assert AuditLog(spark, folder).recover() == live.recover() + ["lost"] == ["lost"]
    found = kept_events(spark, folder).where("pipeline_id = 'lost' and level = 'ERROR'").collect()
    assert sorted((r.run == first.run, r.step, r.message) for r in found) == [
        (True, 3, "Never finished processing x"), (True, 4, "Never finished processing y")
    ]
    before = kept_events(spark, folder).drop("at").collect()
    live.gather()
    assert sorted(kept_events(spark, folder).drop("at").collect()) == sorted(before) and live.recover() == []
    assert not [p for p in (tmp_path / "audit/events").rglob("*.json")]


def test_a_broken_off_gathering_shows_events_once(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "audit")
    first = AuditLog(spark, folder)
    with first.recorded("p", "p"):
        pass
    with monkeypatch.context() as patched:
        patched.setattr("specflow.plans.audit.delete", lambda spark, path: None)
        AuditLog(spark, folder).gather()
    assert kept_events(spark, folder).count() == 3
    AuditLog(spark, folder).gather()
    assert kept_events(spark, folder).count() == 3


# JDBC: no database is available, so only what is handed to Spark is checked.


class Recorder:
    """Stands in for a session and its reader, keeping the options it is given."""

    def __init__(self):
        self.given = {}

    read = property(lambda self: self)

    def format(self, name):
        self.given["format"] = name
        return self

    def options(self, **options):
        self.given |= options
        return self

    def load(self):
        return self.given


JDBC = dict(table="t", url="jdbc:some:db", driver="some.Driver", user="u", password="${env:DB_WORD}")


def test_jdbc_reads_pass_credentials_and_ranges(monkeypatch):
    monkeypatch.setenv("DB_WORD", "w")
    plain = read_jdbc(Recorder(), Source("j", "jdbcclient", **JDBC))
    assert plain == {
        "format": "jdbc", "url": "jdbc:some:db", "driver": "some.Driver", "dbtable": "t", "user": "u", "password": "w",
    }
    ranges = {"partitionColumn": "id", "lowerBound": 0, "upperBound": 10, "numPartitions": 4}
    ranged = read_jdbc(Recorder(), Source("j", "jdbcclient", options=ranges, **JDBC))
    assert {k: ranged[k] for k in ranges} == {k: str(v) for k, v in ranges.items()}
    with pytest.raises(SpecError, match="upperBound"):
        read_jdbc(Recorder(), Source("j", "jdbcclient", options={"partitionColumn": "id", "lowerBound": 0, "numPartitions": 2}, **JDBC))


def test_jdbc_writes_name_the_invalid_table(monkeypatch, session):
    monkeypatch.setenv("DB_WORD", "w")
    end = Sink("j", "jdbcclient", mode="append", **JDBC)
    assert target_of(end, "_INVALID") == "t_INVALID"
    assert connection_options(end)["dbtable"] == "t"


def test_a_database_gets_few_connections(monkeypatch, session):
    monkeypatch.setenv("DB_WORD", "w")
    df = numbers(session, 100, partitions=20)
    assert distributed(df, Sink("j", "jdbcclient", mode="append", **JDBC)).rdd.getNumPartitions() == 8
    assert distributed(df, Sink("j", "jdbcclient", num_partitions=3, **JDBC)).rdd.getNumPartitions() == 3


def test_an_unknown_jdbc_driver_is_an_error(monkeypatch, session):
    monkeypatch.setenv("DB_WORD", "w")
    with pytest.raises(Exception, match="some.Driver"):
        write(numbers(session, 3), Sink("j", "jdbcclient", mode="append", **JDBC))


def test_pipelines_can_run_at_the_same_time(spark, tmp_path):
    source, audit = small_source(tmp_path), AuditLog(spark)
    links = (Link(source.id, "o", 1, 1), Link(source.id, "o", 2, 2))
    pipelines = [
        Pipeline(f"p{n}", (source,), (Sink("o", "json", KV, str(tmp_path / f"out{n}")),), links) for n in range(4)
    ]
    bad = Pipeline("bad", (Source("x", "parquet", source.columns, str(tmp_path / "none")),), pipelines[0].sinks, (Link("x", "o", 1, 1),))
    with pytest.raises(PipelineFailures, match="^bad: [^;]*$"):
        run_all(spark, [*pipelines, bad], audit, at_once=3)
    counts = [spark.read.json(p.sinks[0].path).count() for p in pipelines]
    assert len(set(counts)) == 1 and counts[0] > 0
    steps = audit.frame().groupBy("pipeline_id").agg(F.sort_array(F.collect_list("step")).alias("steps")).collect()
    assert {r.pipeline_id: r.steps for r in steps} == {**{f"p{n}": [1, 2, 3, 4] for n in range(4)}, "bad": [1, 2, 3]}
