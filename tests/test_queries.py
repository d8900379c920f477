"""Every registered query against DuckDB on the same tables."""

from __future__ import annotations

import os

import pytest
from compare import as_bag, duckdb_rows, duckdb_types

from __spark_entry__ import entry
from specflow.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["supplier_id", "supplier_name", "state", "nation"]
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_duckdb(spark, key):
    df = QUERIES[key](spark, SF_DIR)
    columns, rows = duckdb_rows(SF_DIR, ORACLES[key])
    assert sorted(df.columns) == sorted(columns)
    expected = as_bag(columns, rows)
    actual = as_bag(df.columns, [tuple(row) for row in df.collect()])
    assert sum(expected.values()) > 0
    missing, extra = expected - actual, actual - expected
    assert not missing and not extra, f"missing {list(missing)[:3]}, extra {list(extra)[:3]}"
    types = {field.name: field.dataType.simpleString() for field in df.schema.fields}
    assert types == duckdb_types(SF_DIR, ORACLES[key])


def test_callers_session_is_untouched(spark):
    before = dict(spark.conf.getAll)
    QUERIES["flagship"](spark, SF_DIR).count()
    assert dict(spark.conf.getAll) == before
    assert not [table for table in spark.catalog.listTables() if table.isTemporary]
