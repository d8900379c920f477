from __future__ import annotations

import os
import zlib
from collections.abc import Callable

import pytest
from pyspark.sql import DataFrame

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return SF_DIR


@pytest.fixture(scope="session")
def documents(spark) -> DataFrame:
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents) -> dict[int, str]:
    return {r.doc_id: r.text for r in documents.collect()}


@pytest.fixture
def docs_of(spark) -> Callable[..., DataFrame]:
    """A documents table with columns whose names operators use inside."""

    def make(rows: list[tuple]) -> DataFrame:
        full = [(*row, *(None,) * (5 - len(row)), 7, "x", None) for row in rows]
        return spark.createDataFrame(full, DOCUMENTS + ", copy int, words string, size long")

    return make


def fold(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % 4
