"""Partial masking: upper case to ``X``, lower case to ``x``, digits to ``n``.

The same four functions exist as Column functions and, for templates and
queries, as SQL functions that the optimizer inlines. Both are built from
``mask`` and ``substring`` only, so they stay in generated code. Null stays
null; a count beyond the text covers all of it, and one below zero none of it.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_DEFAULT_COUNT = 4


def _head(text: Column, count: Column) -> Column:
    return F.substr(text, F.lit(1), count)


def _tail(text: Column, after: Column) -> Column:
    return F.substr(text, after + 1)


def _from_start(n: int) -> Column:
    return F.lit(max(n, 0))


def _before_last(text: Column, n: int) -> Column:
    return F.greatest(F.length(text) - max(n, 0), F.lit(0))


def mask_first_n(text: Column, n: int = _DEFAULT_COUNT) -> Column:
    """Mask the first ``n`` characters."""
    cut = _from_start(n)
    return F.concat(F.mask(_head(text, cut)), _tail(text, cut))


def mask_last_n(text: Column, n: int = _DEFAULT_COUNT) -> Column:
    """Mask the last ``n`` characters."""
    cut = _before_last(text, n)
    return F.concat(_head(text, cut), F.mask(_tail(text, cut)))


def mask_show_first_n(text: Column, n: int = _DEFAULT_COUNT) -> Column:
    """Mask all but the first ``n`` characters."""
    cut = _from_start(n)
    return F.concat(_head(text, cut), F.mask(_tail(text, cut)))


def mask_show_last_n(text: Column, n: int = _DEFAULT_COUNT) -> Column:
    """Mask all but the last ``n`` characters."""
    cut = _before_last(text, n)
    return F.concat(F.mask(_head(text, cut)), _tail(text, cut))


_FROM_START = "greatest(n, 0)"
_BEFORE_LAST = "greatest(length(s) - greatest(n, 0), 0)"
_SQL_BODIES = {
    "mask_first_n": "concat(mask(substr(s, 1, {cut})), substr(s, {cut} + 1))".format(cut=_FROM_START),
    "mask_last_n": "concat(substr(s, 1, {cut}), mask(substr(s, {cut} + 1)))".format(cut=_BEFORE_LAST),
    "mask_show_first_n": "concat(substr(s, 1, {cut}), mask(substr(s, {cut} + 1)))".format(cut=_FROM_START),
    "mask_show_last_n": "concat(mask(substr(s, 1, {cut})), substr(s, {cut} + 1))".format(cut=_BEFORE_LAST),
}


def register_masks(spark: SparkSession) -> None:
    """Define the SQL forms as temporary functions of this session."""
    for name, body in _SQL_BODIES.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING, n INT DEFAULT {_DEFAULT_COUNT}) "
            f"RETURNS STRING RETURN {body}"
        )
