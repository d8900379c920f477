"""Every operator as a query over the given tables, with its DuckDB equivalent."""

from specflow.queries import (  # noqa: F401  (importing registers the queries)
    function_queries,
    mapping_queries,
    rule_queries,
    sink_queries,
    source_queries,
    stream_queries,
)
from specflow.queries.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
