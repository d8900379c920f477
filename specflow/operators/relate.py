"""Join, filter, or run a whole query over the sources."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specflow.operators.layout import SPREAD, co_located
from specflow.plans.spec import JoinKey, Predicate, Source, SpecError, quoted


def join_sources(
    frames: Mapping[str, DataFrame], sources: Mapping[str, Source], keys: tuple[JoinKey, ...]
) -> DataFrame:
    """Inner equi-joins along ``keys``; each column stays addressable as source.column.

    Sources are attached one at a time to those already joined; several keys
    between the same sources form one condition. How each join runs is left to
    the optimizer, which broadcasts a side only when its measured size allows it
    and splits hot keys while the query runs. A table that is laid out on the keys
    is joined where its buckets lie.
    """
    ids = list(frames)
    joined, joined_ids = frames[ids[0]].alias(ids[0]), {ids[0]}
    waiting = list(keys)
    while waiting:
        ready = [key for key in waiting if len({key.left_id, key.right_id} & joined_ids) == 1]
        if not ready:
            raise SpecError("the joins do not connect all sources")
        new_id = ({ready[0].left_id, ready[0].right_id} - joined_ids).pop()
        reachable = joined_ids | {new_id}
        used = [k for k in waiting if new_id in (k.left_id, k.right_id) and {k.left_id, k.right_id} <= reachable]
        condition = reduce(lambda a, b: a & b, (_key_equality(frames, sources, key) for key in used))
        joined, new, placed = co_located(joined, joined_ids, frames[new_id].alias(new_id), new_id, used, sources, frames)
        joined = joined.join(new, condition if placed is None else condition & placed, "inner")
        joined_ids = reachable
        waiting = [key for key in waiting if key not in used]
    if joined_ids != set(ids):
        raise SpecError("the joins do not connect all sources")
    return joined


def _key_equality(frames: Mapping[str, DataFrame], sources: Mapping[str, Source], key: JoinKey) -> Column:
    """Equality of two key columns; text is read as the other side's type.

    Text that does not read as that type matches nothing. Saying so lets such rows
    be dropped before they are shuffled, all with the same null key.
    """
    left, left_type = _key(frames, sources, key.left_id, key.left_column)
    right, right_type = _key(frames, sources, key.right_id, key.right_column)
    if left_type != right_type:
        if isinstance(left_type, T.StringType):
            left = left.try_cast(right_type)
            return (left == right) & left.isNotNull()
        if isinstance(right_type, T.StringType):
            right = right.try_cast(left_type)
            return (left == right) & right.isNotNull()
    return left == right


def _key(
    frames: Mapping[str, DataFrame], sources: Mapping[str, Source], source_id: str, col_id: int
) -> tuple[Column, T.DataType]:
    name = sources[source_id].column(col_id).name
    return F.col(quoted(source_id, name)), frames[source_id].select(quoted(name)).schema[0].dataType


def where(df: DataFrame, predicate: Predicate, sources: Mapping[str, Source]) -> DataFrame:
    """Keep the rows whose source column meets the condition."""
    name = sources[predicate.source_id].column(predicate.source_column).name
    return df.where(F.expr(f"{quoted(predicate.source_id, name)} {predicate.tail}"))


def sql_step(spark: SparkSession, frames: Mapping[str, DataFrame], query: str) -> DataFrame:
    """Run a user's query with every source visible under its id.

    The views belong to the given session, so each pipeline run should bring its own.
    """
    for source_id, frame in frames.items():
        frame.drop(SPREAD).createOrReplaceTempView(quoted(source_id))
    return spark.sql(query)
