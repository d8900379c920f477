"""Operations for training data. Nothing else in the library imports this subpackage."""

from specflow.llm import queries  # noqa: F401  (importing registers the queries)
from specflow.llm.registry import LLM_ORACLES, LLM_QUERIES

__all__ = ["LLM_ORACLES", "LLM_QUERIES"]
