"""Rules and profiles over whole given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specflow.operators.profiling import profile, profile_frame
from specflow.plans.audit import AuditLog, kept_events
from specflow.plans.run import run, sink_frames, write_sinks
from specflow.plans.spec import JoinKey, Pipeline, Sink, SinkColumn, Source
from specflow.queries.common import columns_of, given, lazy, link, mapped, query, same_columns, session_for
from specflow.sinks.storage import new_folder
from specflow.sources import read
from specflow.streaming import increment_profile, land


def _checked_sql(table: str, columns: str, *broken: str) -> str:
    """A chain of rule checks in order, the first broken one giving the message."""
    chain = f"SELECT {columns}, CASE {' '.join(broken)} ELSE '' END AS errMsg FROM {table}"
    return f"SELECT *, CASE WHEN errMsg = '' THEN 'Y' ELSE 'N' END AS valid FROM ({chain})"


@query(
    "rule_required",
    _checked_sql(
        "customer",
        "c_custkey AS id, nullif(c_mktsegment, 'BUILDING') AS segment",
        "WHEN c_mktsegment = 'BUILDING' THEN '''segment'' is a required property'",
    ),
)
def rule_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = [
        ("c_custkey", SinkColumn("id", "Long", required=True)),
        ("c_mktsegment", SinkColumn("segment", "String", transform="nullif({0}, 'BUILDING')", required=True)),
    ]
    return lazy(spark, given("customer", sf_dir), targets, validation=True)


@query(
    "rule_minimum",
    _checked_sql(
        "lineitem",
        "l_orderkey AS id, l_quantity::INTEGER AS quantity",
        "WHEN l_quantity < 25 THEN l_quantity::INTEGER::VARCHAR || ' is less than the minimum of 25'",
    ),
)
def rule_minimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = [("l_orderkey", SinkColumn("id", "Long")), ("l_quantity", SinkColumn("quantity", "Int", minimum=25))]
    return lazy(spark, given("lineitem", sf_dir), targets, validation=True)


@query(
    "rule_maximum",
    _checked_sql(
        "lineitem",
        "l_orderkey AS id, l_quantity::BIGINT AS quantity",
        "WHEN l_quantity > 25 THEN l_quantity::BIGINT::VARCHAR || ' is greater than the maximum of 25'",
    ),
)
def rule_maximum(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = [("l_orderkey", SinkColumn("id", "Long")), ("l_quantity", SinkColumn("quantity", "Long", maximum=25))]
    return lazy(spark, given("lineitem", sf_dir), targets, validation=True)


@query(
    "rule_min_length",
    _checked_sql(
        "documents", "doc_id AS id, lang, text", "WHEN length(text) < 400 THEN '''' || text || ''' is too short'"
    ),
)
def rule_min_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lazy(spark, given("documents", sf_dir), _document_targets(min_length=400), validation=True)


@query(
    "rule_max_length",
    _checked_sql(
        "documents", "doc_id AS id, lang, text", "WHEN length(text) > 400 THEN '''' || text || ''' is too long'"
    ),
)
def rule_max_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lazy(spark, given("documents", sf_dir), _document_targets(max_length=400), validation=True)


def _document_targets(**lengths: int) -> list[tuple[str | None, SinkColumn]]:
    return [
        ("doc_id", SinkColumn("id", "Long")),
        ("lang", SinkColumn("lang", "String")),
        ("text", SinkColumn("text", "String", **lengths)),
    ]


@query(
    "rule_type",
    _checked_sql(
        "orders",
        "o_orderkey, o_orderstatus",
        "WHEN o_orderstatus IS NOT NULL THEN '''' || o_orderstatus || ''' is not of type ''integer'''",
    ),
)
def rule_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query's own columns keep their types, so a wrong one breaks the rule."""
    columns = (SinkColumn("o_orderkey", "Long", 1), SinkColumn("o_orderstatus", "Int", 2))
    sink = Sink("out", "json", columns, new_folder(spark, "query"))
    text = "select o_orderkey, o_orderstatus from orders"
    pipeline = Pipeline("query", (given("orders", sf_dir),), (sink,), query=text, validation=True)
    return sink_frames(session_for(spark, pipeline), pipeline)["out"]


_VALIDATE_SQL = _checked_sql(
    "customer",
    "c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment",
    "WHEN c_custkey < 10 THEN c_custkey::VARCHAR || ' is less than the minimum of 10'",
    "WHEN c_acctbal < 0 THEN c_acctbal::VARCHAR || ' is less than the minimum of 0'",
    "WHEN c_acctbal > 9000 THEN c_acctbal::VARCHAR || ' is greater than the maximum of 9000'",
    "WHEN length(c_mktsegment) < 9 THEN '''' || c_mktsegment || ''' is too short'",
    "WHEN length(c_mktsegment) > 9 THEN '''' || c_mktsegment || ''' is too long'",
)


@query("validate_flag", _VALIDATE_SQL)
def validate_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules together; each row shows the first one it breaks."""
    targets = [
        ("c_custkey", SinkColumn("id", "Long", required=True, minimum=10)),
        ("c_acctbal", SinkColumn("balance", "Double", minimum=0, maximum=9000)),
        ("c_mktsegment", SinkColumn("segment", "String", min_length=9, max_length=9)),
    ]
    return lazy(spark, given("customer", sf_dir), targets, validation=True)


@query("validate_valid", f"SELECT * FROM ({_VALIDATE_SQL}) WHERE valid = 'Y'")
def validate_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate_flag(spark, sf_dir).where(F.col("valid") == "Y")


@query("validate_invalid", f"SELECT * FROM ({_VALIDATE_SQL}) WHERE valid = 'N'")
def validate_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate_flag(spark, sf_dir).where(F.col("valid") == "N")


def _profile_sql(table: str, numbers: list[str], texts: list[str]) -> str:
    parts = [
        f"SELECT '{c}' AS column_name, count({c}) AS n, round(avg({c}), 6) AS mean, "
        f"round(stddev_samp({c}), 6) AS stddev, min({c})::DOUBLE AS low, max({c})::DOUBLE AS high, "
        f"NULL::VARCHAR AS low_text, NULL::VARCHAR AS high_text FROM {table}"
        for c in numbers
    ]
    parts += [
        f"SELECT '{c}', count({c}), avg(TRY_CAST({c} AS DOUBLE)), stddev_samp(TRY_CAST({c} AS DOUBLE)), "
        f"NULL, NULL, min({c}), max({c}) FROM {table}"
        for c in texts
    ]
    return " UNION ALL ".join(parts)


def _comparable(stats: DataFrame) -> DataFrame:
    """Minimum and maximum as numbers where they are numbers, and as text elsewhere."""
    numeric = F.col("mean").isNotNull()
    return stats.select(
        "column_name",
        F.col("count").alias("n"),
        F.round("mean", 6).alias("mean"),
        F.round("stddev", 6).alias("stddev"),
        F.when(numeric, F.col("min").try_cast("double")).alias("low"),
        F.when(numeric, F.col("max").try_cast("double")).alias("high"),
        F.when(~numeric, F.col("min")).alias("low_text"),
        F.when(~numeric, F.col("max")).alias("high_text"),
    )


@query(
    "profile_source",
    _profile_sql(
        "lineitem",
        [
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax",
        ],
        ["l_returnflag", "l_linestatus"],
    ),
)
def profile_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(profile(read(session_for(spark), given("lineitem", sf_dir))))


@query(
    "profile_sink",
    _profile_sql("orders", ["o_orderkey", "o_custkey", "o_totalprice"], ["o_orderstatus", "o_orderpriority"]),
)
def profile_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics gathered by the write itself."""
    session = session_for(spark)
    orders = given("orders", sf_dir)
    columns, links = mapped(orders, same_columns(orders))
    sink = Sink("out", "parquet", columns, new_folder(session, "query"))
    result = run(session, Pipeline("profiled", (orders,), (sink,), links), profiles=True)
    return _comparable(profile_frame(session, result.written[0].profile))


@query(
    "profile_increments",
    "SELECT part, p.* FROM (VALUES ('out'), ('out_INVALID')) AS v(part), LATERAL ("
    + _profile_sql(
        "(SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, o_orderpriority FROM orders WHERE (o_totalprice >= 100000) = (part = 'out')) t",
        ["o_orderkey", "o_custkey", "o_totalprice"],
        ["o_orderstatus", "o_orderpriority"],
    )
    + ") p",
)
def profile_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders in several increments into checked sinks; the profile of either side from the increments' states alone."""
    session = session_for(spark)
    root = new_folder(session, "query")
    arrivals = Source("orders", "parquet", columns_of("orders"), f"{root}/landing")
    kept = [("o_totalprice", SinkColumn("o_totalprice", "Double", minimum=100_000))]
    kept += [(name, column) for name, column in same_columns(arrivals) if name not in ("o_totalprice", "o_orderdate")]
    columns, links = mapped(arrivals, kept)
    pipeline = Pipeline("profiled", (arrivals,), (Sink("out", "parquet", columns, root),), links, validation=True)
    orders = read(session, given("orders", sf_dir))
    for status in ("F", "O", "P"):
        orders.where(F.col("o_orderstatus") == status).write.mode("append").parquet(arrivals.location)
        land(session, pipeline, f"{root}/checkpoint", profiles=f"{root}/profiles", max_files_per_batch=3)
    found = increment_profile(session, f"{root}/profiles").where(~F.col("column_name").isin("valid", "errMsg"))
    parts = [_comparable(found.where(F.col("part") == part)).withColumn("part", F.lit(part)) for part in ("out", "out_INVALID")]
    return parts[0].unionByName(parts[1])


@query(
    "audit_events",
    """WITH joined AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT pipeline_id, step, level, word, -1::BIGINT AS rows_written FROM (VALUES ('good', 1, 'INFO', 'Started'),
('good', 4, 'INFO', 'Finished'), ('good', 5, 'INFO', 'Total'), ('bad', 1, 'INFO', 'Started'),
('bad', 2, 'ERROR', 'AnalysisException:'), ('bad', 3, 'INFO', 'Total')) AS v(pipeline_id, step, level, word)
UNION ALL SELECT 'good', 2, 'INFO', 'Wrote', count(*) FROM joined WHERE o_totalprice >= 1000
UNION ALL SELECT 'good', 3, 'INFO', 'Wrote', count(*) FROM joined WHERE o_totalprice < 1000""",
)
def audit_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of a run that splits a join, and of one whose table is missing."""
    session = session_for(spark)
    orders, customer = given("orders", sf_dir), given("customer", sf_dir)
    columns = (SinkColumn("price", "Double", 1, minimum=1000), SinkColumn("name", "String", 2))
    sink = Sink("out", "parquet", columns, new_folder(session, "query"))
    links = (link(orders, "o_totalprice", "out", 1), link(customer, "c_name", "out", 2))
    joins = JoinKey.parse("orders:2=customer:1")
    audit = AuditLog(session)
    run(session, Pipeline("good", (orders, customer), (sink,), links, joins, validation=True), audit)
    missing = given("orders", f"{sf_dir}/missing")
    run(session, Pipeline("bad", (missing, customer), (sink,), links, joins), audit)
    return audit.frame().select(
        "pipeline_id",
        "step",
        "level",
        F.split("message", " ")[0].alias("word"),
        F.coalesce("rows", F.lit(-1)).cast("bigint").alias("rows_written"),
    )


@query(
    "audit_recovered",
    """WITH joined AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey),
n AS (SELECT count(*) FILTER (o_totalprice >= 1000) AS valid, count(*) FILTER (o_totalprice < 1000) AS invalid FROM joined)
SELECT pipeline_id, step, level, word, CASE word WHEN 'Wrote' THEN CASE step WHEN 2 THEN valid ELSE invalid END ELSE -1 END AS rows_written,
1::BIGINT AS times FROM n, (VALUES ('done', 1, 'INFO', 'Started'), ('done', 2, 'INFO', 'Wrote'), ('done', 3, 'INFO', 'Wrote'),
('done', 4, 'INFO', 'Finished'), ('done', 5, 'INFO', 'Total'), ('lost', 1, 'INFO', 'Started'), ('lost', 2, 'INFO', 'Wrote'),
('lost', 3, 'ERROR', 'Never')) AS v(pipeline_id, step, level, word)""",
)
def audit_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of a driver that finished one pipeline and was lost within another, as two later ones find and gather them."""
    session = session_for(spark)
    root = new_folder(session, "query")
    orders, customer = given("orders", sf_dir), given("customer", sf_dir)
    columns = (SinkColumn("price", "Double", 1, minimum=1000), SinkColumn("name", "String", 2))
    links = (link(orders, "o_totalprice", "out", 1), link(customer, "c_name", "out", 2))
    joins = JoinKey.parse("orders:2=customer:1")

    def joined(name: str) -> Pipeline:
        sink = Sink("out", "parquet", columns, f"{root}/{name}")
        return Pipeline(name, (orders, customer), (sink,), links, joins, validation=True)

    first = AuditLog(session, f"{root}/audit")
    run(session, joined("done"), first)
    # the driver is gone after the first of two writes: no later event is written
    work = first.recorded("lost", "lost")
    work.__enter__()
    written = []
    write_sinks(session, joined("lost"), report=written.append)
    first.written("lost", written[0])
    first._folder = None
    work.__exit__(None, None, None)
    for _ in range(2):
        later = AuditLog(session, f"{root}/audit")
        later.recover()
        later.gather()
    events = kept_events(session, f"{root}/audit")
    return events.groupBy(
        "pipeline_id", "step", "level", F.split("message", " ")[0].alias("word"), F.coalesce("rows", F.lit(-1)).cast("bigint").alias("rows_written")
    ).agg(F.count("*").alias("times"))
