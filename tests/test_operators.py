"""Operators on small frames, checked against plain Python where there is a rule to restate."""

from __future__ import annotations

import gzip
import math
from collections import Counter
from functools import reduce

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specflow import JoinKey, Link, Pipeline, Predicate, Sink, SinkColumn, Source, SourceColumn, SpecError
from specflow import pipeline_session, sink_frames
from specflow.functions import is_repeatable, mask_first_n, mask_last_n, mask_show_first_n, mask_show_last_n
from specflow.operators import profile, with_rules
from specflow.operators.profiling import finished, merged_states, profile_json, profile_states, records_of
from specflow.plans.run import combined
from specflow.plans.session import size_tasks
from specflow.queries import QUERIES
from specflow.sources import read
from specflow.sources.headers import wider


@pytest.fixture(scope="module")
def session(spark):
    return pipeline_session(spark)


def text_source(tmp_path, name, lines, columns, **fields):
    path = tmp_path / f"{name}.txt"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    declared = tuple(SourceColumn(n, t, i) for i, (n, t) in enumerate(columns, 1))
    return Source(name, "csv", declared, str(path), **fields)


def one_sink(columns, **fields):
    return Sink("o", "json", columns, "/unused", **fields)


def simple(source, *columns, **settings):
    """A pipeline that maps the source's columns in order."""
    numbered = tuple(SinkColumn(**{**c.__dict__, "col_id": i}) for i, c in enumerate(columns, 1))
    links = tuple(Link(source.id, "o", i, None if c.default is not None else i) for i, c in enumerate(columns, 1))
    return Pipeline("p", (source,), (one_sink(numbered),), links, **settings)


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


# Masks


MASKS = {
    "mask_first_n": (mask_first_n, lambda s, n: mask(s[:n]) + s[n:]),
    "mask_last_n": (mask_last_n, lambda s, n: s[: max(len(s) - n, 0)] + mask(s[max(len(s) - n, 0) :])),
    "mask_show_first_n": (mask_show_first_n, lambda s, n: s[:n] + mask(s[n:])),
    "mask_show_last_n": (mask_show_last_n, lambda s, n: mask(s[: max(len(s) - n, 0)]) + s[max(len(s) - n, 0) :]),
}


def mask(text):
    kinds = [(str.isupper, "X"), (str.islower, "x"), (str.isdigit, "n")]
    return "".join(next((letter for test, letter in kinds if test(c)), c) for c in text)


@pytest.mark.parametrize("name", MASKS)
@pytest.mark.parametrize("count", [-2, 0, 1, 4, 7, 99])
def test_masks(session, name, count):
    texts = ["Abc-1234 Zz", "ab", "", "ABCDEFG", "1234567", None]
    df = session.createDataFrame([(t,) for t in texts], "s string")
    function, expected = MASKS[name]
    found = df.select("s", function(F.col("s"), count), F.expr(f"{name}(s, {count})")).collect()
    for text, by_column, by_sql in found:
        wanted = None if text is None else expected(text, max(count, 0))
        assert (by_column, by_sql) == (wanted, wanted)


@pytest.mark.parametrize("name", MASKS)
def test_masks_take_four_unless_told(session, name):
    df = session.createDataFrame([("Abcdefg123",)], "s string")
    assert df.select(F.expr(f"{name}(s) = {name}(s, 4)")).first()[0]


def test_masks_are_defined_where_a_pipeline_uses_them(spark, tmp_path):
    source = text_source(tmp_path, "a", ["Ab1"], [("v", "String")])
    for template in ("mask_first_n({0}, 2)", "MASK_SHOW_LAST_N({0}, 1)"):
        pipeline = simple(source, SinkColumn("v", transform=template))
        df = sink_frames(pipeline_session(spark, pipeline), pipeline)["o"]
        assert rows(df) == [("Xx1",)]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("concat(v ,'_X_Y_Z')", True),
        ("from_unixtime(unix_timestamp(v, 'dd-MM-yyyy'),'yyyy/MM/dd')", True),
        ("v + 1", True),
        ("RAND()", False),
        ("`rand`(3)", False),
        ("rand/**/()", False),
        ("upper(uuid ())", False),
        ("v in (select 1)", True),
        ("v in (select rand())", False),
        ("unix_timestamp()", False),
        ("current_timestamp", False),
        ("current_date", False),
        ("localtimestamp()", False),
        ("now()", False),
        ("date_add(current_date(), 1)", False),
        ("hex(aes_encrypt(v, '0000111122223333'))", False),
        ("hex(aes_encrypt(v, '0000111122223333', 'CBC'))", False),
        ("hex(aes_encrypt(v, '0000111122223333', 'ECB'))", True),
        ("hex(aes_encrypt(v, '0000111122223333', 'GCM', 'DEFAULT', unhex('000000000000000000000000')))", True),
        ("v in (select hex(aes_encrypt('1', '0000111122223333')))", False),
        ("concat(v, 'aes_encrypt(')", True),
        ("own_function(v)", False),
    ],
)
def test_repeatable_frames(spark, text, expected):
    spark.udf.register("own_function", lambda v: v)
    for width in (1, 2, 26, 60):  # a plan's text is shortened beyond 25 columns
        frame = spark.range(1).select(*(F.lit("1").alias(f"c{i}") for i in range(1, width)), F.lit("1").alias("v"))
        assert is_repeatable(frame.select("*", F.expr(text))) is expected
        if " in (" not in text and "uuid" not in text:
            assert is_repeatable(frame.where(F.expr(f"({text}) is not null"))) is expected


# Mapping


def test_values_that_do_not_fit_become_null(session, tmp_path):
    source = text_source(tmp_path, "a", ["abc,12.7", "12,3000000000", " 7 ,x"], [("i", "String"), ("n", "String")])
    df = sink_frames(session, simple(source, SinkColumn("i", "Int"), SinkColumn("n", "Int")))["o"]
    assert rows(df) == [(12, None), (7, None), (None, None)]


def test_templates_null_out_bad_values_too(session, tmp_path):
    source = text_source(tmp_path, "a", ["abc", "12"], [("v", "String")])
    df = sink_frames(session, simple(source, SinkColumn("v", "Int", transform="cast({0} as int) + 1")))["o"]
    assert rows(df) == [(13,), (None,)]


def test_both_date_shapes_are_read(session, tmp_path):
    source = text_source(tmp_path, "a", ["1-5-1981", "17-11-1981", "never"], [("d", "String")])
    template = "from_unixtime(unix_timestamp({0}, 'dd-MM-yyyy'),'yyyy/MM/dd')"
    df = sink_frames(session, simple(source, SinkColumn("d", "String", transform=template)))["o"]
    assert rows(df) == [("1981/05/01",), ("1981/11/17",), (None,)]


def test_other_braces_in_templates_are_kept(session, tmp_path):
    source = text_source(tmp_path, "a", ["abc"], [("v", "String")])
    df = sink_frames(session, simple(source, SinkColumn("v", transform="concat({0}, '{1}{x}')")))["o"]
    assert rows(df) == [("abc{1}{x}",)]


def test_columns_are_grouped_by_source(session, tmp_path):
    a = text_source(tmp_path, "a", ["1,x"], [("k", "Int"), ("v", "String")])
    b = text_source(tmp_path, "b", ["1,y"], [("k", "Int"), ("v", "String")])
    columns = tuple(SinkColumn(n, "String", i) for i, n in enumerate(("one", "two", "three"), 1))
    links = (Link("a", "o", 1, 1), Link("b", "o", 2, 2), Link("a", "o", 3, 2))
    pipeline = Pipeline("p", (a, b), (one_sink(columns),), links, JoinKey.parse("a:1=b:1"))
    df = sink_frames(session, pipeline)["o"]
    assert df.columns == ["one", "three", "two"] and rows(df) == [("1", "x", "y")]


def test_odd_column_names(session, tmp_path):
    source = text_source(tmp_path, "a-b.c", ["1,2"], [("x y", "Int"), ("p.q`r", "Int")])
    pipeline = simple(
        source,
        SinkColumn("a b", "Int", transform="{0} + 1"),
        SinkColumn("c.d", "Int", required=True),
        predicate=Predicate.parse("a-b.c:2@ > 1"),
        validation=True,
    )
    df = sink_frames(session, pipeline)["o"]
    assert df.columns == ["a b", "c.d", "valid", "errMsg"] and rows(df) == [(2, 2, "Y", "")]


# Joins


def test_text_key_equals_whole_number_key(session, tmp_path):
    a = text_source(tmp_path, "a", ["2,x", "02,y", "z,bad", ",none"], [("k", "String"), ("v", "String")])
    b = text_source(tmp_path, "b", ["2", "3"], [("k", "Int")])
    columns = (SinkColumn("v", "String", 1), SinkColumn("k", "Int", 2))
    links = (Link("a", "o", 1, 2), Link("b", "o", 2, 1))
    pipeline = Pipeline("p", (a, b), (one_sink(columns),), links, JoinKey.parse("a:1=b:1"))
    df = sink_frames(session, pipeline)["o"]
    assert rows(df) == [("x", 2), ("y", 2)]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(try_cast(" in plan


def test_two_keys_between_the_same_sources(session, tmp_path):
    a = text_source(tmp_path, "a", ["1,1", "1,2", "2,1"], [("x", "Int"), ("y", "Int")])
    b = text_source(tmp_path, "b", ["1,2", "2,2"], [("x", "Int"), ("y", "Int")])
    columns = (SinkColumn("x", "Int", 1), SinkColumn("y", "Int", 2))
    links = (Link("a", "o", 1, 1), Link("b", "o", 2, 2))
    pipeline = Pipeline("p", (a, b), (one_sink(columns),), links, JoinKey.parse("a:1=b:1,a:2=b:2"))
    assert rows(sink_frames(session, pipeline)["o"]) == [(1, 2)]


def test_unconnected_sources_are_refused(session, tmp_path):
    sources = tuple(text_source(tmp_path, n, ["1"], [("k", "Int")]) for n in "abcd")
    links = tuple(Link(s.id, "o", i, 1) for i, s in enumerate(sources, 1))
    columns = tuple(SinkColumn(s.id, "Int", i) for i, s in enumerate(sources, 1))
    pipeline = Pipeline("p", sources, (one_sink(columns),), links, JoinKey.parse("a:1=b:1,c:1=d:1"))
    with pytest.raises(SpecError, match="connect"):
        combined(session, pipeline)


def test_filter_with_several_sinks_is_applied_once_to_each(session, tmp_path):
    source = text_source(tmp_path, "a", ["1", "2", "3"], [("k", "Int")])
    sinks = tuple(Sink(n, "json", (SinkColumn(n, "Int", 1),), "/unused") for n in ("m", "n"))
    links = (Link("a", "m", 1, 1), Link("a", "n", 1, 1))
    pipeline = Pipeline("p", (source,), sinks, links, predicate=Predicate.parse("a:1@ >= 2"))
    frames = sink_frames(session, pipeline)
    assert rows(frames["m"]) == rows(frames["n"]) == [(2,), (3,)]


def test_filter_reaches_the_scan(session):
    columns = (SourceColumn("l_orderkey", "Long", 1), SourceColumn("l_returnflag", "String", 2),
               SourceColumn("l_quantity", "Double", 3))
    source = Source("a", "parquet", columns, "/root/testdata/sf0.001/lineitem.parquet")
    pipeline = Pipeline("p", (source,), (one_sink((SinkColumn("id", "Long", 1),)),), (Link("a", "o", 1, 1),),
                        predicate=Predicate.parse("a:2@='R'"))
    plan = sink_frames(session, pipeline)["o"]._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_returnflag,R)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in plan


def test_query_views_do_not_leak(spark, tmp_path):
    source = text_source(tmp_path, "only_here", ["1"], [("k", "Int")])
    pipeline = Pipeline("p", (source,), (one_sink(()),), query="select k + 1 as k from only_here")
    assert rows(sink_frames(pipeline_session(spark), pipeline)["o"]) == [(2,)]
    assert not spark.catalog.tableExists("only_here")
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


# Fixed width


def fixed(tmp_path, lines, widths, **fields):
    path = tmp_path / "lines.txt"
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    columns = tuple(SourceColumn(f"f{i}", "Int", i, i, w) for i, w in enumerate(widths, 1))
    return Source("f", "fixedWidth", fields.pop("columns", columns), str(path), **fields)


def test_fixed_width_slices(session, tmp_path):
    lines = ["ab cd^e1", "ab", "ab  ", "      x9zzz", ""]
    df = read(session, fixed(tmp_path, lines, (2, 4, 2)))
    assert {f.dataType.simpleString() for f in df.schema.fields} == {"string"}
    assert [tuple(r) for r in df.collect()] == [
        ("ab", "cd^", "e1"),
        ("ab", None, None),
        ("ab", "", None),
        ("", "", "x9"),
        (None, None, None),
    ]


def test_fixed_width_record_size_and_column_order(session, tmp_path):
    shuffled = (SourceColumn("second", "String", 1, 2, 2), SourceColumn("first", "String", 2, 1, 3))
    source = fixed(tmp_path, ["abcde", "abcdef", "abcd"], (), columns=shuffled, record_size=5)
    df = read(session, source)
    assert df.columns == ["first", "second"] and rows(df) == [("abc", "de")]


@pytest.mark.parametrize("column", [SourceColumn("f", "Int", 1, 1), SourceColumn("f", "Int", 1, None, 3)])
def test_fixed_width_needs_positions_and_lengths(session, tmp_path, column):
    with pytest.raises(SpecError):
        read(session, fixed(tmp_path, ["abc"], (), columns=(column,)))


# Rules


def brute_force(row, columns):
    """The first broken rule of a row, as plain Python."""
    for column in columns:
        value = row[column.name]
        if value is None:
            if column.required:
                return f"'{column.name}' is a required property"
            continue
        if isinstance(value, str):
            if column.min_length is not None and len(value) < column.min_length:
                return f"'{value}' is too short"
            if column.max_length is not None and len(value) > column.max_length:
                return f"'{value}' is too long"
        else:
            if column.minimum is not None and value < column.minimum:
                return f"{value} is less than the minimum of {column.minimum}"
            if column.maximum is not None and value > column.maximum:
                return f"{value} is greater than the maximum of {column.maximum}"
    return ""


bounds = st.one_of(st.none(), st.integers(-5, 5))
lengths = st.one_of(st.none(), st.integers(0, 4))
rule_sets = st.tuples(
    st.builds(SinkColumn, st.just("i"), st.just("Int"), st.just(1), required=st.booleans(), minimum=bounds, maximum=bounds),
    st.builds(
        SinkColumn, st.just("s"), st.just("String"), st.just(2), required=st.booleans(), min_length=lengths,
        max_length=lengths,
    ),
)
values = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(-9, 9)), st.one_of(st.none(), st.text("aé😀'", max_size=6))),
    min_size=1,
    max_size=12,
)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rule_sets, values)
def test_rules_match_brute_force(session, columns, data):
    df = with_rules(session.createDataFrame(data, "i int, s string"), columns)
    assert df.columns == ["i", "s", "valid", "errMsg"]
    for row in df.collect():
        expected = brute_force({"i": row.i, "s": row.s}, columns)
        assert (row.errMsg, row.valid) == (expected, "N" if expected else "Y")


def test_exact_bounds_and_numbers_that_are_not_numbers(session):
    data = [(1.4,), (1.5,), (math.nan,), (math.inf,), (None,)]
    columns = (SinkColumn("d", "Double", 1, minimum=1.5),)
    found = [r.errMsg for r in with_rules(session.createDataFrame(data, "d double"), columns).collect()]
    assert found == [
        "1.4 is less than the minimum of 1.5", "", "'NaN' is not of type 'number'",
        "'Infinity' is not of type 'number'", "",
    ]


def test_a_required_column_that_is_not_there(session):
    df = with_rules(session.createDataFrame([(1,)], "i int"), (SinkColumn("x", "Int", 1, required=True),))
    assert rows(df) == [(1, "N", "'x' is a required property")]


def test_columns_named_like_the_verdict_are_replaced(session):
    df = session.createDataFrame([(1, "x", "y")], "i int, Valid string, errMsg string")
    columns = (SinkColumn("i", "Int", 1), SinkColumn("errMsg", "String", 2, min_length=2))
    checked = with_rules(df, columns)
    assert checked.columns == ["i", "valid", "errMsg"] and rows(checked) == [(1, "N", "'y' is too short")]


def test_no_rules_means_all_valid(session):
    assert rows(with_rules(session.createDataFrame([(1,)], "i int"), ())) == [(1, "Y", "")]


# Profiles


def test_profile_of_numbers_and_text(session):
    df = session.createDataFrame([(1, "10", "b"), (3, " 2.5 ", "a"), (None, "x", None)], "n int, t string, u string")
    found = {r["column_name"]: r for r in records_of(profile(df))}
    assert found["n"] == {"column_name": "n", "count": 2, "mean": 2.0, "stddev": pytest.approx(2**0.5), "min": "1", "max": "3"}
    assert (found["t"]["count"], found["t"]["mean"], found["t"]["min"]) == (3, 6.25, " 2.5 ")
    assert (found["u"]["mean"], found["u"]["min"], found["u"]["max"]) == (None, "a", "b")
    assert '"summary": "mean", "n": "2.0", "t": "6.25"' in profile_json(list(found.values()))


def test_states_of_parts_merge_to_the_profile_of_all(session):
    """However the rows are parted, also into empty parts and parts without numbers; far from zero, and with long keys."""
    rows = [(2**60 + i, 1e9 + i / 8, None if i % 5 == 0 else f"{i % 7}", "t" if i < 3 else None, -i) for i in range(40)]
    df = session.createDataFrame(rows, "k long, x double, s string, t string, n int").repartition(4)
    parts = [df.where("n > 0"), df.where("n = 0"), df.where("n < -20"), df.where("n between -20 and -1"), df.where("n = -3 and t = 'x'")]
    states = [profile_states(part) for part in parts]
    merged = finished(merged_states(reduce(DataFrame.unionByName, states)))
    found, expected = ({r["column_name"]: r for r in records_of(p)} for p in (merged, profile(df)))
    for name, record in expected.items():
        for statistic in ("count", "min", "max"):
            assert found[name][statistic] == record[statistic]
        for statistic in ("mean", "stddev"):
            expected_value = record[statistic]
            assert found[name][statistic] == (None if expected_value is None else pytest.approx(expected_value, rel=1e-7))
    assert found["k"]["min"] == str(2**60) and found["k"]["max"] == str(2**60 + 39)


def test_a_profile_scans_once(session):
    df = session.createDataFrame([(1, "a", 2.5)], "n int, t string, x double")
    plan = profile(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") + plan.count("LocalTableScan") == 1


def test_profile_without_profiled_columns(session):
    assert profile(session.createDataFrame([(True,)], "b boolean")).count() == 0


# Task sizes


INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
MERGED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
SCANNED = "spark.sql.files.maxPartitionBytes"


def sized(spark, tmp_path, monkeypatch, total, **chosen):
    session = pipeline_session(spark)
    for name, value in chosen.items():
        session.conf.set(name, value)
    monkeypatch.setattr("specflow.plans.session.plan_bytes", lambda _: total)
    size_tasks(session, [spark.range(1)])
    return tuple(session.conf.get(name, None) for name in (INITIAL, MERGED, SCANNED))


def test_small_inputs_change_nothing(spark, tmp_path, monkeypatch):
    before = tuple(spark.conf.get(name, None) for name in (INITIAL, MERGED, SCANNED))
    assert sized(spark, tmp_path, monkeypatch, 1000) == before


def test_tasks_follow_the_input_size(spark, tmp_path, monkeypatch):
    terabyte = 1024**4
    width, merged, scanned = sized(spark, tmp_path, monkeypatch, terabyte)
    assert (width, merged, scanned) == (str(terabyte // (64 * 1024**2)), None, None)
    scanned_each, largest_merged = str(100 * terabyte // 200_000), str(512 * 1024**2)
    assert sized(spark, tmp_path, monkeypatch, 100 * terabyte) == ("50000", largest_merged, scanned_each)


def test_chosen_task_sizes_are_kept(spark, tmp_path, monkeypatch):
    chosen = {INITIAL: "123", MERGED: "32MB", SCANNED: "64MB"}
    assert sized(spark, tmp_path, monkeypatch, 100 * 1024**4, **chosen) == ("123", "32MB", "64MB")


def test_files_and_tables_of_the_same_data_get_the_same_width(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("specflow.plans.session._SHUFFLE_BYTES", 1024)
    rows = spark.range(20_000).select(F.col("id").cast("int").alias("k"))
    rows.write.parquet(str(tmp_path / "files"))
    rows.write.saveAsTable("sized_as_files")
    columns, widths = (SourceColumn("k", "Int", 1),), []
    try:
        for source in (Source("f", "parquet", columns, str(tmp_path / "files")), Source("t", "hivetable", columns, table="sized_as_files")):
            session = pipeline_session(spark)
            size_tasks(session, [read(session, source)])
            widths.append(int(session.conf.get(INITIAL)))
    finally:
        spark.sql("DROP TABLE sized_as_files")
    assert widths[0] > 8 and abs(widths[0] - widths[1]) <= 0.1 * widths[0]


def test_casts_that_try_cast_refuses(spark, tmp_path):
    source = text_source(tmp_path, "a", ["2020-01-02"], [("v", "String")])
    pipeline = simple(source, SinkColumn("v", "Int", transform="to_date({0})"))
    assert rows(sink_frames(pipeline_session(spark, pipeline), pipeline)["o"]) == [(None,)]
    pipeline = simple(source, SinkColumn("v", "Timestamp", transform="true"))
    assert rows(sink_frames(pipeline_session(spark, pipeline), pipeline)["o"])[0][0] is not None


def test_lengths_of_other_types(session):
    frame = session.sql("SELECT date'2020-01-02' AS d")
    column = SinkColumn("d", "date", 1, min_length=50)
    assert [r.valid for r in with_rules(frame, [column]).collect()] == ["N"]


@pytest.mark.parametrize(
    "column, message",
    [
        (SinkColumn("v", "String", 1, minimum=2), "needs numbers"),
        (SinkColumn("k", "Int", 1, max_length=2), "needs text"),
        (SinkColumn("t", "Timestamp", 1, min_length=2), "needs text"),
        (SinkColumn("K", "Int", 1, minimum=2), "of that name"),
    ],
)
def test_rules_that_cannot_apply_are_refused(session, column, message):
    frame = session.sql("SELECT 1 AS k, 'a' AS v, timestamp'2020-01-01' AS t")
    with pytest.raises(SpecError, match=message):
        with_rules(frame, [column])


def test_aes_gives_the_published_cipher_text(session):
    """The example of Spark's own function reference."""
    cipher = session.sql("SELECT base64(aes_encrypt('Spark SQL', '1234567890abcdef', 'ECB', 'PKCS'))").head()[0]
    assert cipher == "3lmwu+Mw0H3fi5NDvcu9lg=="


# Headers


def headed(tmp_path, files, columns=("Int", "String", "Double"), **fields):
    folder = tmp_path / "headed"
    folder.mkdir()
    for name, text in files.items():
        (folder / name).write_bytes(gzip.compress(text.encode()) if name.endswith(".gz") else text.encode())
    names = ("a", "b", "c")
    declared = tuple(SourceColumn(n, kind, i) for i, (n, kind) in enumerate(zip(names, columns), 1))
    return Source("s", "csv", declared, str(folder), header=True, **fields)


def test_columns_are_read_by_their_header(spark, tmp_path):
    """Other orders, case, quotes, further columns, byte order marks, blank lines, packed and empty files, odd file names."""
    files = {
        "1.csv": "a,b,c\n1,x,1.5\n", "2.csv": "c,a,b\n2.5,2,y\n", "3 [x] %41.csv": 'B,"more, or less",A,c\nz,?,3,3.5\n',
        "4.csv.gz": "b,c,a\nw,4.5,4\n", "5.csv": "", "6.csv": "\ufeffc,b,a\n5.5,v,5\n", "7.csv": "c,b,a\n",
    }
    found = read(pipeline_session(spark), headed(tmp_path, files))
    assert found.dtypes == [("a", "int"), ("b", "string"), ("c", "double")]
    assert sorted(map(tuple, found.collect())) == [(1, "x", 1.5), (2, "y", 2.5), (3, "z", 3.5), (4, "w", 4.5), (5, "v", 5.5)]


@pytest.mark.parametrize(
    "header, message",
    [("a,c,d", "no column b"), ("a,b,c,B", "column b more than once")],
)
def test_headers_that_lack_a_column_are_refused(spark, tmp_path, header, message):
    with pytest.raises(SpecError, match=message):
        read(pipeline_session(spark), headed(tmp_path, {"1.csv": "a,b,c\n1,x,1.5\n", "2.csv": f"{header}\n1,2,3\n"}))


def test_files_with_other_names_are_read_by_position(spark, tmp_path):
    source = headed(tmp_path, {"1.csv": "x;y;z\n1;p;1.5\n", "2.csv": "u;v;w\n2;q;2.5\n"}, delimiter=";")
    assert sorted(map(tuple, read(pipeline_session(spark), source).collect())) == [(1, "p", 1.5), (2, "q", 2.5)]


def test_inferred_types_are_agreed_on_by_name(spark, tmp_path):
    files = {"1.csv": "a,b,c\n1,01,7\n", "2.csv": "c,a,b\n8,2.5,x\n", "3.csv": "b,d,a\ny,true,3000000000\n"}
    found = read(pipeline_session(spark), headed(tmp_path, files, infer_schema=True))
    assert found.dtypes == [("a", "double"), ("b", "string"), ("c", "int"), ("d", "boolean")]
    rows = sorted(tuple(r)[:3] for r in found.collect())
    assert rows == [(1.0, "01", 7), (2.5, "x", 8), (3e9, "y", None)]


def test_the_lattice_of_types():
    kinds = [T.NullType(), T.IntegerType(), T.LongType(), T.DecimalType(20, 0), T.DoubleType(), T.BooleanType(), T.DateType(), T.TimestampType(), T.StringType()]
    for a in kinds:
        assert wider(a, a) == a
        for b in kinds:
            assert wider(a, b) == wider(b, a)
            for c in kinds:
                if not {type(x) for x in (a, b, c)} >= {T.DecimalType}:
                    assert wider(wider(a, b), c) == wider(a, wider(b, c))
    assert wider(T.IntegerType(), T.DoubleType()) == T.DoubleType() and wider(T.BooleanType(), T.LongType()) == T.StringType()


# Records over several lines, cut by many tasks


@pytest.mark.parametrize("escape", ['"', "\\"])
@pytest.mark.parametrize("block", ["7b", "40b", "1m"])
@pytest.mark.parametrize("header", [True, False])
def test_records_over_several_blocks(spark, tmp_path, escape, block, header):
    """However small the blocks, and over however many a record goes: what Spark reads from the whole files."""
    texts = ["plain", 'quo"ted', "two\nlines", "a\n\n\nb" * 9, '"\n"', "", None, "comma, and\nbreak", '\n', "x" * 99, 'end"', "cr\r\nlf", "ü\nß"]
    session = pipeline_session(spark)
    session.conf.set("spark.sql.files.maxPartitionBytes", block)
    session.conf.set("spark.sql.files.openCostInBytes", "0")
    rows = [(i, text, -i) for i, text in enumerate(texts * 3)]
    options = {"escape": escape, "nullValue": "NULL", "multiLine": "true"}
    frame = session.createDataFrame(rows, "i int, t string, n int")
    frame.coalesce(1).write.options(header=header, **options).csv(str(tmp_path / "in"))
    frame.coalesce(1).write.mode("append").options(header=header, **options).csv(str(tmp_path / "in"))
    columns = tuple(SourceColumn(n, k, i) for i, (n, k) in enumerate((("i", "Int"), ("t", "String"), ("n", "Int")), 1))
    whole = Source("s", "csv", columns, str(tmp_path / "in"), header=header, options=options)
    split = Source("s", "csv", columns, str(tmp_path / "in"), header=header, options={**options, "splitRecords": "true"})
    found, expected = (Counter(map(tuple, read(session, source).collect())) for source in (split, whole))
    assert found == expected and sum(found.values()) == 2 * len(rows)


def test_blocks_of_a_larger_file_share_tasks(spark, tmp_path):
    """As many blocks of 64 KB as the file has, but not a task for each: every record comes once, and soon."""
    text = F.concat(F.col("doc_id").cast("string"), F.repeat(F.lit('a line, "of" text?\n'), 5000))
    documents = spark.range(120).select(F.col("id").alias("doc_id"))
    documents = documents.select("doc_id", text.alias("text"), F.lit("en").alias("lang"), F.lit("s,t").alias("source"), F.length(text).cast("long").alias("n_chars"))
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["src_csv_multiline_split"](spark, str(tmp_path))
    assert found.rdd.getNumPartitions() < 100  # 174 blocks
    expected = documents.withColumn("many_tasks", F.lit(True))
    assert found.columns == expected.columns and found.count() == 120
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()


def test_split_records_need_declared_text(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a\n")
    columns = (SourceColumn("a", "String", 1),)
    for settings, message in (({"quote": "||"}, "one character"), ({"options": {"splitRecords": "true", "encoding": "UTF-16"}}, "UTF-8")):
        fields = {"options": {"splitRecords": "true"}, **settings}
        with pytest.raises(SpecError, match=message):
            read(spark, Source("s", "csv", columns, str(tmp_path / "x.csv"), **fields))
    with pytest.raises(SpecError, match="declared columns"):
        read(spark, Source("s", "csv", (), str(tmp_path / "x.csv"), header=True, infer_schema=True, options={"splitRecords": "true"}))
