"""The steps of a pipeline, each a DataFrame in and a DataFrame out."""

from specflow.operators.profiling import observed, profile, profile_json
from specflow.operators.project import project, sink_columns
from specflow.operators.relate import join_sources, sql_step, where
from specflow.operators.rules import ERROR_COLUMN, VALID_COLUMN, with_rules

__all__ = [
    "ERROR_COLUMN",
    "VALID_COLUMN",
    "join_sources",
    "observed",
    "profile",
    "profile_json",
    "project",
    "sink_columns",
    "sql_step",
    "where",
    "with_rules",
]
