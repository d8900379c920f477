"""Tables laid out for joins: plans without an exchange of the table, frequent keys spread, results unchanged."""

from __future__ import annotations

import re
import uuid

import pytest
from pyspark.sql import functions as F

from specflow import JoinKey, Link, Pipeline, Sink, SinkColumn, Source, SourceColumn, SpecError, pipeline_session, run_all, sink_frames
from specflow.operators.layout import KEYS_SUFFIX, SPREAD
from specflow.plans.metadata import sink_from

ROWS, HOT, BUCKETS = 60_000, 7, 8
_FACTS = (SourceColumn("k", "Long", 1), SourceColumn("text", "String", 2))
_NAMES = (SourceColumn("k", "Long", 1), SourceColumn("name", "String", 2))


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """One key has a third of all rows, which are all alike; some keys are null or match nothing, some match twice."""
    root = tmp_path_factory.mktemp("layout")
    key = F.when(F.col("id") % 3 == 0, HOT).when(F.col("id") % 100 == 1, None).otherwise(F.col("id") % 1200)
    facts = spark.range(0, ROWS, 1, 8).select(key.alias("k"), F.when(F.col("id") % 3 == 0, "same").otherwise(F.sha2(F.col("id").cast("string"), 256)).alias("text"))
    facts.write.parquet(str(root / "facts"))
    names = spark.range(0, 1000, 1, 4).union(spark.range(5, 10)).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name"))
    names.write.parquet(str(root / "names"))
    names.select(F.format_string("0%s", "k").alias("k"), "name").write.parquet(str(root / "as_text"))
    return {name: str(root / name) for name in ("facts", "names", "as_text")}


@pytest.fixture
def session(spark):
    session = pipeline_session(spark)
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    session.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    return session


def table_of(session, source, times=1, **settings):
    columns = tuple(SinkColumn(c.name, c.type, c.col_id) for c in source.columns)
    settings = {"table": f"t_{uuid.uuid4().hex}", "bucket_by": ("k",), "buckets": BUCKETS, **settings}
    sink = Sink("o", "hivetable", columns, **settings)
    for _ in range(times):
        run_all(session, [Pipeline("copy", (source,), (sink,), tuple(Link(source.id, "o", c.col_id, c.col_id) for c in columns))])
    return sink.table


def joined(session, left, right):
    columns = (SinkColumn("k", "Long", 1), SinkColumn("text", "String", 2), SinkColumn("name", "String", 3))
    links = (Link(left.id, "o", 1, 1), Link("facts", "o", 2, 2), Link("names", "o", 3, 2))
    sink = Sink("o", "parquet", columns, "/unused")
    return sink_frames(session, Pipeline("p", (left, right), (sink,), links, JoinKey.parse(f"{left.id}:1={right.id}:1")))["o"]


def counted(df):
    return {tuple(row[:-1]): row["count"] for row in df.groupBy("k", "text", "name").count().collect()}


def expected(session, files, names="names"):
    facts, named = session.read.parquet(files["facts"]), session.read.parquet(files[names])
    return counted(facts.join(named.withColumn("k", F.col("k").cast("long")), "k").select("k", "text", "name"))


def exchanged(df):
    """The columns by which the plan deals rows out, one entry for each exchange."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


@pytest.mark.parametrize("table_first", [True, False])
def test_a_laid_out_table_is_not_shuffled_and_its_hot_key_is_spread(session, files, table_first):
    table = table_of(session, Source("facts", "parquet", _FACTS, files["facts"]))
    facts, names = Source("facts", "hivetable", _FACTS, table=table), Source("names", "parquet", _NAMES, files["names"])
    df = joined(session, *((facts, names) if table_first else (names, facts)))
    assert counted(df) == expected(session, files)
    parts = [row["count"] for row in df.groupBy(F.spark_partition_id()).count().collect()]
    hot = 2 * ROWS // 3
    assert max(parts) < hot / 2
    df.collect()
    # the other side, with its copies of the hot key; the list of keys has its own small exchanges by the key's hash
    assert sum("specflow_spread_of" in columns for columns in exchanged(df)) == 1
    assert not any(re.match(r"k#\d+L, specflow_spread#", columns) for columns in exchanged(df))
    splits = {row.splits for row in session.table(table + KEYS_SUFFIX).collect()}
    assert len(splits) == 1 and 2 <= splits.pop() <= BUCKETS


def test_two_tables_without_hot_keys_are_joined_where_they_lie(session, files):
    names = Source("names", "parquet", _NAMES, files["names"])
    a = Source("facts", "hivetable", tuple(SourceColumn(c.name, c.type, c.col_id) for c in _NAMES), table=table_of(session, names))
    b = Source("names", "hivetable", _NAMES, table=table_of(session, names))
    columns = (SinkColumn("a", "String", 1), SinkColumn("b", "String", 2))
    links = (Link("facts", "o", 1, 2), Link("names", "o", 2, 2))
    df = sink_frames(session, Pipeline("p", (a, b), (Sink("o", "parquet", columns, "/unused"),), links, JoinKey.parse("facts:1=names:1")))["o"]
    assert df.count() == 995 + 5 * 4
    df.collect()
    assert exchanged(df) == []


@pytest.mark.parametrize("mode", ["append", "overwrite"])
def test_a_table_written_again_keeps_its_joins_right(session, files, mode):
    table = table_of(session, Source("facts", "parquet", _FACTS, files["facts"]), times=2, mode=mode)
    facts, names = Source("facts", "hivetable", _FACTS, table=table), Source("names", "parquet", _NAMES, files["names"])
    times = 2 if mode == "append" else 1
    assert counted(joined(session, facts, names)) == {row: n * times for row, n in expected(session, files).items()}


def test_keys_of_another_type_still_match(session, files):
    table = table_of(session, Source("facts", "parquet", _FACTS, files["facts"]))
    text = (SourceColumn("k", "String", 1), SourceColumn("name", "String", 2))
    facts, names = Source("facts", "hivetable", _FACTS, table=table), Source("names", "parquet", text, files["as_text"])
    assert counted(joined(session, facts, names)) == expected(session, files, "as_text")
    # laid out by text: "07" and 7 are equal, but not alike, so the layout is left unused
    table = table_of(session, Source("names", "parquet", text, files["as_text"]), buckets=2)
    facts, names = Source("facts", "parquet", _FACTS, files["facts"]), Source("names", "hivetable", text, table=table)
    assert counted(joined(session, facts, names)) == expected(session, files, "as_text")


def test_an_empty_table(session, files, tmp_path):
    session.read.parquet(files["facts"]).limit(0).write.parquet(str(tmp_path / "none"))
    table = table_of(session, Source("facts", "parquet", _FACTS, str(tmp_path / "none")))
    facts, names = Source("facts", "hivetable", _FACTS, table=table), Source("names", "parquet", _NAMES, files["names"])
    assert joined(session, facts, names).collect() == []


def test_queries_and_profiles_see_declared_columns_only(session, files):
    table = table_of(session, Source("facts", "parquet", _FACTS, files["facts"]))
    assert SPREAD in session.table(table).columns
    facts = Source("facts", "hivetable", _FACTS, table=table)
    df = sink_frames(session, Pipeline("p", (facts,), (Sink("o", "json", (), "/unused"),), query="select * from facts"))["o"]
    assert df.columns == ["k", "text"]


@pytest.mark.parametrize(
    "settings",
    [{"bucket_by": ("k",)}, {"buckets": 4}, {"bucket_by": ("k",), "buckets": 0}, {"bucket_by": ("k",), "buckets": 4, "num_partitions": 2}, {"bucket_by": ("k",), "buckets": 4, "partition_by": ("k",)}],
)
def test_layouts_that_make_no_sense_are_refused(settings):
    with pytest.raises(SpecError):
        Sink("o", "hivetable", (SinkColumn("k", "Long", 1),), table="t", **settings)


def test_only_tables_are_laid_out():
    with pytest.raises(SpecError, match="catalog tables"):
        Sink("o", "parquet", (SinkColumn("k", "Long", 1),), "/x", bucket_by=("k",), buckets=4)


def test_a_layout_in_metadata():
    record = {"destId": "7", "fileType": "hivetable", "table": "t", "bucketBy": ["7:1"], "buckets": "16"}
    sink = sink_from(record, [{"colId": "1", "colName": "k", "colType": "Long"}])
    assert (sink.bucket_by, sink.buckets) == (("k",), 16)
