"""The queries of this subpackage and their DuckDB equivalents."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

LLM_QUERIES: dict[str, Query] = {}
LLM_ORACLES: dict[str, str] = {}


def importable(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The function (of a session and more), after which Python workers look for this package where the driver has it.

    Enough where they share that folder; elsewhere the package is installed or sent along (``--py-files``).
    """

    @wraps(function)
    def run(spark: SparkSession, *arguments) -> DataFrame:
        root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
        paths = [x for x in environment.get("PYTHONPATH", "").split(os.pathsep) if x]
        if root not in paths:
            environment["PYTHONPATH"] = os.pathsep.join([*paths, root])
        return function(spark, *arguments)

    return run


def query(key: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its DuckDB equivalent where SQL can express it."""

    def register(function: Query) -> Query:
        LLM_QUERIES[key] = importable(function)
        if oracle is not None:
            LLM_ORACLES[key] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
