"""Mapping, filters, joins and SQL steps over whole given tables."""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specflow.plans.spec import JoinKey, Pipeline, Predicate, Sink, SinkColumn, Source, SourceColumn
from specflow.plans.run import sink_frames
from specflow.queries.common import columns_of, copy, given, lazy, link, plain_times, query, session_for
from specflow.queries.source_queries import _FIXED_WIDTH_SQL, _customer_lines, _fixed_width
from specflow.sinks.storage import new_folder


@query(
    "map_cast_rename",
    """SELECT p_partkey::INTEGER AS id, p_size::VARCHAR AS size_text, p_retailprice::DECIMAL(12, 1)::VARCHAR AS price,
trunc(p_retailprice)::BIGINT AS whole_price, TRY_CAST(p_name AS DOUBLE) AS not_a_number, p_size::DOUBLE AS size_real
FROM part""",
)
def map_cast_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = [
        ("p_partkey", SinkColumn("id", "Int")),
        ("p_size", SinkColumn("size_text", "String")),
        ("p_retailprice", SinkColumn("price", "decimal(12,1)")),
        ("p_retailprice", SinkColumn("whole_price", "Long")),
        ("p_name", SinkColumn("not_a_number", "Double")),
        ("p_size", SinkColumn("size_real", "Double")),
    ]
    return lazy(spark, given("part", sf_dir), targets).withColumn("price", F.col("price").cast("string"))


@query(
    "map_transform",
    """SELECT p_partkey AS id, p_brand || '_X_Y_Z' AS brand, length(p_name)::INTEGER AS name_length,
p_size * 2 + 1 AS size FROM part""",
)
def map_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = [
        ("p_partkey", SinkColumn("id", "Long")),
        ("p_brand", SinkColumn("brand", "String", transform="concat({0} ,'_X_Y_Z')")),
        ("p_name", SinkColumn("name_length", "Int", transform="length({0})")),
        ("p_size", SinkColumn("size", "Int", transform="{0} * 2 + 1")),
    ]
    return lazy(spark, given("part", sf_dir), targets)


@query("map_passthrough", "SELECT l_orderkey AS k, l_returnflag AS v FROM lineitem")
def map_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = [("l_orderkey", SinkColumn("k", "Long")), ("l_returnflag", SinkColumn("v", "String", transform=None))]
    return lazy(spark, given("lineitem", sf_dir), targets)


@query("map_default_literal", "SELECT o_orderkey AS id, 'test_default_value' AS label, 7 AS seven FROM orders")
def map_default_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = [
        ("o_orderkey", SinkColumn("id", "Long")),
        (None, SinkColumn("label", "String", default="'test_default_value'")),
        (None, SinkColumn("seven", "Int", default="'7'")),
    ]
    return lazy(spark, given("orders", sf_dir), targets)


@query("map_default_function", "SELECT o_orderkey AS id, '24-02-03 12:05:06' AS created, 'AB' AS label FROM orders")
def map_default_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    created = "from_unixtime(unix_timestamp('2024-02-03 12:05:06'), 'yy-MM-dd hh:mm:ss')"
    targets = [
        ("o_orderkey", SinkColumn("id", "Long")),
        (None, SinkColumn("created", "String", default=created)),
        (None, SinkColumn("label", "String", default="upper(concat('a', 'b'))")),
    ]
    return lazy(spark, given("orders", sf_dir), targets)


@query("map_default_unused", "SELECT o_orderkey AS id, o_orderstatus AS status FROM orders")
def map_default_unused(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = [
        ("o_orderkey", SinkColumn("id", "Long")),
        ("o_orderstatus", SinkColumn("status", "String", default="'unused'")),
    ]
    return lazy(spark, given("orders", sf_dir), targets)


@query("filter_predicate", "SELECT l_orderkey AS id, l_quantity AS quantity FROM lineitem WHERE l_returnflag = 'R'")
def filter_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = [("l_orderkey", SinkColumn("id", "Long")), ("l_quantity", SinkColumn("quantity", "Double"))]
    return lazy(spark, given("lineitem", sf_dir), targets, predicate=Predicate.parse("lineitem:9@='R'"))


@query(
    "filter_predicate_free_sql",
    """SELECT o_orderkey AS id, o_totalprice AS price FROM orders
WHERE o_totalprice BETWEEN 1000 AND 200000 AND o_orderpriority LIKE '%H%'""",
)
def filter_predicate_free_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The condition after the column is free SQL and may name further columns."""
    targets = [("o_orderkey", SinkColumn("id", "Long")), ("o_totalprice", SinkColumn("price", "Double"))]
    tail = "orders:4@ between 1000 and 200000 and orders.o_orderpriority like '%H%'"
    return lazy(spark, given("orders", sf_dir), targets, predicate=Predicate.parse(tail))


def related(
    spark: SparkSession, sources: tuple[Source, ...], mapped: list[tuple[Source, str | None, SinkColumn]], **settings: Any
) -> DataFrame:
    """The frame of one sink fed by several joined sources."""
    columns, links = [], []
    for position, (source, name, column) in enumerate(mapped, 1):
        columns.append(SinkColumn(**{**column.__dict__, "col_id": position}))
        links.append(link(source, name, "out", position))
    sink = Sink("out", "parquet", tuple(columns), location="unused")
    pipeline = Pipeline("query", sources, (sink,), tuple(links), **settings)
    return plain_times(sink_frames(session_for(spark, pipeline), pipeline)["out"])


@query(
    "join_inner",
    """SELECT l_orderkey AS id, l_linenumber AS line, l_extendedprice AS price, o_orderdate AS ordered
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, orders = given("lineitem", sf_dir), given("orders", sf_dir)
    mapped = [
        (lineitem, "l_orderkey", SinkColumn("id", "Long")),
        (lineitem, "l_linenumber", SinkColumn("line", "Int")),
        (lineitem, "l_extendedprice", SinkColumn("price", "Double")),
        (orders, "o_orderdate", SinkColumn("ordered", "Timestamp")),
    ]
    return related(spark, (lineitem, orders), mapped, joins=JoinKey.parse("lineitem:1=orders:1"))


@query(
    "join_mixed_key",
    """SELECT c_custkey AS id, n_name AS nation, c_acctbal AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def join_mixed_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A text key equals a whole-number key of the same value."""
    sink = copy(spark, given("customer", sf_dir), "csv")
    as_text = tuple(
        SourceColumn(c.name, "String" if c.name == "c_nationkey" else c.type, c.col_id) for c in columns_of("customer")
    )
    customer, nation = Source("customer", "csv", as_text, sink.path), given("nation", sf_dir)
    mapped = [
        (customer, "c_custkey", SinkColumn("id", "Long")),
        (nation, "n_name", SinkColumn("nation", "String")),
        (customer, "c_acctbal", SinkColumn("balance", "Double")),
    ]
    return related(spark, (customer, nation), mapped, joins=JoinKey.parse("customer:3=nation:1"))


@query(
    "join_table",
    """SELECT o_orderkey AS id, c_name AS name, o_totalprice AS price
FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'""",
)
def join_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files joined with a catalog table, of which the declared columns are read."""
    session, names = session_for(spark), f"specflow_{uuid.uuid4().hex}"
    copy(session, given("customer", sf_dir), "hivetable", table=names, options={"path": new_folder(session, "query")})
    orders = given("orders", sf_dir)
    customer = Source("customer", "hivetable", columns_of("customer", ["c_custkey", "c_name", "c_mktsegment"]), table=names)
    mapped = [
        (orders, "o_orderkey", SinkColumn("id", "Long")),
        (customer, "c_name", SinkColumn("name", "String")),
        (orders, "o_totalprice", SinkColumn("price", "Double")),
    ]
    return related(
        session,
        (orders, customer),
        mapped,
        joins=JoinKey.parse("orders:2=customer:1"),
        predicate=Predicate.parse("customer:3@ = 'BUILDING'"),
    )


def laid_out(session: SparkSession, sf_dir: str, table: str, key: str, buckets: int) -> Source:
    """A given table, written to the catalog bucketed and sorted by a key, as a source."""
    name, options = f"specflow_{uuid.uuid4().hex}", {"path": new_folder(session, "query")}
    copy(session, given(table, sf_dir), "hivetable", table=name, options=options, bucket_by=(key,), buckets=buckets)
    return Source(table, "hivetable", columns_of(table), table=name)


@query(
    "join_bucketed",
    """SELECT l_orderkey AS id, l_linenumber AS line, l_extendedprice AS price, o_orderdate AS ordered
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def join_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table laid out by its key, which the join reads as it lies."""
    session = session_for(spark)
    lineitem, orders = laid_out(session, sf_dir, "lineitem", "l_orderkey", 16), given("orders", sf_dir)
    mapped = [
        (lineitem, "l_orderkey", SinkColumn("id", "Long")),
        (lineitem, "l_linenumber", SinkColumn("line", "Int")),
        (lineitem, "l_extendedprice", SinkColumn("price", "Double")),
        (orders, "o_orderdate", SinkColumn("ordered", "Timestamp")),
    ]
    return related(session, (lineitem, orders), mapped, joins=JoinKey.parse("lineitem:1=orders:1"))


@query(
    "join_bucketed_frequent",
    """SELECT c_custkey AS id, n_name AS nation, r_name AS region
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def join_bucketed_frequent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key has more rows than an even bucket, so each lies in several."""
    session = session_for(spark)
    customer = laid_out(session, sf_dir, "customer", "c_nationkey", 64)
    nation, region = given("nation", sf_dir), given("region", sf_dir)
    mapped = [
        (customer, "c_custkey", SinkColumn("id", "Long")),
        (nation, "n_name", SinkColumn("nation", "String")),
        (region, "r_name", SinkColumn("region", "String")),
    ]
    joins = JoinKey.parse("customer:3=nation:1,nation:3=region:1")
    return related(session, (customer, nation, region), mapped, joins=joins)


@query(
    "join_filter_map",
    """SELECT c_custkey AS id, c_mktsegment || '_X_Y_Z' AS segment, n_name AS nation, 'new' AS state
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name = 'NATION_7'""",
)
def join_filter_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = given("customer", sf_dir), given("nation", sf_dir)
    mapped = [
        (customer, "c_custkey", SinkColumn("id", "Long")),
        (customer, "c_mktsegment", SinkColumn("segment", "String", transform="concat({0} ,'_X_Y_Z')")),
        (customer, None, SinkColumn("state", "String", default="'new'")),
        (nation, "n_name", SinkColumn("nation", "String")),
    ]
    return related(
        spark,
        (customer, nation),
        mapped,
        joins=JoinKey.parse("customer:3=nation:1"),
        predicate=Predicate.parse("nation:2@='NATION_7'"),
    )


@query(
    "join_chain",
    """SELECT l_orderkey AS id, l_linenumber AS line, c_name AS customer, n_name AS nation
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey WHERE o_orderstatus = 'F'""",
)
def join_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four sources joined pair by pair."""
    lineitem, orders, customer, nation = (
        given(table, sf_dir) for table in ("lineitem", "orders", "customer", "nation")
    )
    mapped = [
        (lineitem, "l_orderkey", SinkColumn("id", "Long")),
        (lineitem, "l_linenumber", SinkColumn("line", "Int")),
        (customer, "c_name", SinkColumn("customer", "String")),
        (nation, "n_name", SinkColumn("nation", "String")),
    ]
    return related(
        spark,
        (lineitem, orders, customer, nation),
        mapped,
        joins=JoinKey.parse("lineitem:1=orders:1,orders:2=customer:1,customer:3=nation:1"),
        predicate=Predicate.parse("orders:3@='F'"),
    )


@query(
    "join_fixed_width",
    f"""SELECT a.c_custkey AS id, a.c_name AS name, b.c_acctbal AS balance, b.c_mktsegment AS segment
FROM ({_FIXED_WIDTH_SQL}) a JOIN ({_FIXED_WIDTH_SQL}) b ON a.c_custkey = b.c_custkey
WHERE b.c_mktsegment <> 'BUILDING'""",
)
def join_fixed_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two fixed-width sources joined on their text keys."""
    lines = _customer_lines(spark, sf_dir)
    left, right = (
        Source(source_id, "fixedWidth", declared.columns, lines, record_size=declared.record_size)
        for source_id, declared in (("a", _fixed_width(lines, 62)), ("b", _fixed_width(lines, 62)))
    )
    mapped = [
        (left, "c_custkey", SinkColumn("id", "String")),
        (left, "c_name", SinkColumn("name", "String")),
        (right, "c_acctbal", SinkColumn("balance", "String")),
        (right, "c_mktsegment", SinkColumn("segment", "String")),
    ]
    return related(
        spark,
        (left, right),
        mapped,
        joins=JoinKey.parse("a:1=b:1"),
        predicate=Predicate.parse("b:5@<>'BUILDING'"),
    )


def queried(spark: SparkSession, sf_dir: str, tables: tuple[str, ...], text: str) -> DataFrame:
    """The result of a SQL step; the sink's own column list is not applied."""
    sink = Sink("out", "json", (SinkColumn("unused", "String", 1),), new_folder(spark, "query"))
    pipeline = Pipeline("query", tuple(given(table, sf_dir) for table in tables), (sink,), query=text)
    return plain_times(sink_frames(session_for(spark, pipeline), pipeline)["out"])


_LEFT_JOIN_COUNT = """select c.c_mktsegment, count(o.o_orderkey) as cnt_orders
from customer c left outer join orders o on c.c_custkey = o.o_custkey group by c.c_mktsegment"""


@query("sql_step_left_join_count", _LEFT_JOIN_COUNT)
def sql_step_left_join_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queried(spark, sf_dir, ("customer", "orders"), _LEFT_JOIN_COUNT)


_SINGLE_SOURCE = """select l_returnflag, l_linestatus, count(*) as cnt_lines, sum(l_quantity) as sum_qty
from lineitem where l_quantity > 10 group by l_returnflag, l_linestatus"""


@query("sql_step_single_source", _SINGLE_SOURCE)
def sql_step_single_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queried(spark, sf_dir, ("lineitem",), _SINGLE_SOURCE)


_THREE_SOURCES = """select n.n_name, r.r_name, count(c.c_custkey) as cnt_customers, min(c.c_acctbal) as low,
max(c.c_acctbal) as high from nation n join region r on n.n_regionkey = r.r_regionkey
left outer join customer c on c.c_nationkey = n.n_nationkey group by n.n_name, r.r_name"""


@query("sql_step_three_sources", _THREE_SOURCES)
def sql_step_three_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queried(spark, sf_dir, ("nation", "region", "customer"), _THREE_SOURCES)


@query(
    "flagship",
    """SELECT s_suppkey AS supplier_id, n_name || '_X_Y_Z' AS nation, s_name AS supplier_name, 'active' AS state
FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_name LIKE 'NATION_1%'""",
)
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Join, filter, transform, default and cast: the usual shape of a process."""
    supplier, nation = given("supplier", sf_dir), given("nation", sf_dir)
    mapped = [
        (supplier, "s_suppkey", SinkColumn("supplier_id", "Long")),
        (nation, "n_name", SinkColumn("nation", "String", transform="concat({0} ,'_X_Y_Z')")),
        (supplier, "s_name", SinkColumn("supplier_name", "String", transform=None)),
        (supplier, None, SinkColumn("state", "String", default="'active'")),
    ]
    return related(
        spark,
        (supplier, nation),
        mapped,
        joins=JoinKey.parse("supplier:3=nation:1"),
        predicate=Predicate.parse("nation:2@ like 'NATION_1%'"),
    )
