"""A query on an option must fail where the option is ignored."""

from __future__ import annotations

from dataclasses import replace
from importlib import import_module

import pytest
from compare import as_bag, duckdb_rows
from pyspark.errors import PySparkException
from test_queries import SF_DIR

from specflow.queries import ORACLES, QUERIES
from specflow.sources import files

writing = import_module("specflow.sinks.write")
projecting = import_module("specflow.operators.project")


def agrees(spark, key):
    try:
        df = QUERIES[key](spark, SF_DIR)
        actual = as_bag(df.columns, [tuple(row) for row in df.collect()])
    except PySparkException:
        return False
    return actual == as_bag(*duckdb_rows(SF_DIR, ORACLES[key]))


# Read options left out: the delimiter and header of Spark itself are used, and its quote.
@pytest.mark.parametrize("key, option", [("src_csv_delimiter", "sep"), ("src_csv_quote", "quote"), ("src_csv_header", "header")])
def test_read_options(spark, monkeypatch, key, option):
    assert agrees(spark, key)
    whole = files.file_options
    monkeypatch.setattr(files, "file_options", lambda s: {k: v for k, v in whole(s).items() if k != option})
    assert not agrees(spark, key)


@pytest.mark.parametrize(
    "key, ignored",
    [
        ("sink_csv", {"header": False}),
        ("sink_csv", {"delimiter": ","}),
        ("sink_csv", {"quote": '"', "options": {"escape": '"'}}),
        ("sink_delimited", {"delimiter": ","}),
        ("sink_partition_by", {"partition_by": ()}),
        ("sink_mode_overwrite", {"mode": "append"}),
    ],
)
def test_write_options(spark, monkeypatch, key, ignored):
    """The reader is told the same, so that a round trip alone would not notice."""
    monkeypatch.setattr(writing, "_writer", lambda df, sink, whole=writing._writer: whole(df, replace(sink, **ignored)))
    if "mode" in ignored:  # an overwrite is staged, so its mode is decided before there is a writer
        files_of = writing._save_files
        monkeypatch.setattr(writing, "_save_files", lambda df, sink, target: files_of(df, replace(sink, **ignored), target))
    told = {name: value for name, value in ignored.items() if name in ("header", "delimiter", "quote")}
    read_options = files.file_options
    monkeypatch.setattr(files, "file_options", lambda s: read_options(replace(s, **told) if s.file_type != "parquet" else s))
    assert not agrees(spark, key)


@pytest.mark.parametrize("key", ["fn_aes_encrypt_blocks", "fn_aes_encrypt_nonce"])
def test_encryption_left_out(spark, monkeypatch, key):
    assert agrees(spark, key)
    whole = projecting.expand
    monkeypatch.setattr(projecting, "expand", lambda *given: whole(*given).replace("aes_encrypt(", "coalesce("))
    assert not agrees(spark, key)
