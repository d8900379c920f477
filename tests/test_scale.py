"""Plans and results under skew: one key holds a third of all rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from specflow import JoinKey, Link, Pipeline, Sink, SinkColumn, Source, SourceColumn, pipeline_session, sink_frames

ROWS, HOT = 300_000, 7


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("skew")
    facts = spark.range(0, ROWS, 1, 8).select(
        F.when(F.col("id") % 3 == 0, HOT).otherwise(F.col("id") % 1000).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    facts.write.parquet(str(root / "facts"))
    spark.range(0, 1000, 1, 4).select(F.col("id").alias("k"), F.concat(F.lit("n"), "id").alias("name")).write.parquet(
        str(root / "names")
    )
    return (
        Source("facts", "parquet", (SourceColumn("k", "Long", 1), SourceColumn("text", "String", 2)), str(root / "facts")),
        Source("names", "parquet", (SourceColumn("k", "Long", 1), SourceColumn("name", "String", 2)), str(root / "names")),
    )


@pytest.fixture
def session(spark):
    """Thresholds scaled down to the test's data, and no broadcast."""
    session = pipeline_session(spark)
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    session.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    session.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1MB")
    session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    session.conf.set("spark.sql.shuffle.partitions", "64")
    return session


def test_a_hot_join_key_is_split(session, sources):
    columns = (SinkColumn("text", "String", 1), SinkColumn("name", "String", 2))
    links = (Link("facts", "o", 1, 2), Link("names", "o", 2, 2))
    sink = Sink("o", "parquet", columns, "/unused")
    df = sink_frames(session, Pipeline("p", sources, (sink,), links, JoinKey.parse("facts:1=names:1")))["o"]
    rows = df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("count"), F.max("text"), F.max("name")).collect()
    hot = ROWS // 3
    assert max(r["count"] for r in rows) < hot / 2
    assert sum(r["count"] for r in rows) == ROWS


def test_a_hot_key_is_split_before_an_aggregate_on_that_key(session, sources):
    text = "select f.k, count(n.name) as c, max(f.text) as t from facts f left outer join names n on f.k = n.k group by f.k"
    df = sink_frames(session, Pipeline("p", sources, (Sink("o", "json", (), "/unused"),), query=text))["o"]
    counts = {row.k: row.c for row in df.collect()}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan
    assert sum(counts.values()) == ROWS and counts[HOT] > ROWS // 3


def test_counts_are_aggregated_before_the_shuffle(session, sources):
    text = "select k, count(*) as c, max(text) as t from facts group by k"
    df = sink_frames(session, Pipeline("p", sources[:1], (Sink("o", "json", (), "/unused"),), query=text))["o"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning")
