"""Tables laid out for joins: bucketed and sorted by their keys, with frequent keys spread over several buckets.

A bucketed table joins on its keys without being shuffled, but then all rows of a key meet in one task, which the running
query can't split. So rows are bucketed by their keys and a small number, ``SPREAD``: always 0 for an ordinary key, and
0, 1, 2, ... in turn for a key that has more rows than an even bucket. A table beside the laid-out one lists those keys.
A join repeats the other side's rows of a listed key once for each number, and then joins on keys and number: each row of
the laid-out side still meets each row of the other side once.

The list holds hashes of keys and is bounded by the number of buckets for each write. Any key may be listed, and with
more numbers than are in use, without a change to results.
"""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specflow.plans.spec import JoinKey, Source, quoted

#: The column that tells parts of a frequent key apart, and what the table of such keys is called after its own.
SPREAD, KEYS_SUFFIX = "specflow_spread", "_SPREAD"

_KEYS_SCHEMA = "key bigint, splits int"

#: Frequent keys that one write lists at most, and how many keys are counted for each to find them.
_LISTED, _COUNTED, _MOST_COUNTED = 50_000, 20, 1_000_000


def key_of(columns: Mapping[str, Column]) -> Column:
    """What stands for a key: a hash of its columns, in order of their names."""
    return F.xxhash64(*(columns[name] for name in sorted(columns)))


def _own_key(keys: tuple[str, ...]) -> Column:
    return key_of({name: F.col(quoted(name)) for name in keys})


def frequent_keys(rows: DataFrame, keys: tuple[str, ...], buckets: int) -> list[tuple[int, int]]:
    """Keys with more rows than an even bucket, as hashes, each with the number of buckets its rows would fill.

    One pass with a summary of bounded size. A key that it misses stays in one bucket.
    """
    listed = min(buckets, _LISTED)
    tracked = min(_MOST_COUNTED, max(1_000, _COUNTED * listed))
    top = F.expr(f"approx_top_k(key, {listed}, {tracked})").alias("top")
    found = rows.select(_own_key(keys).alias("key")).agg(F.count("*").alias("n"), top).first()
    even = max(1, math.ceil(found.n / buckets))
    return [(r["item"], math.ceil(r["count"] / even)) for r in found.top or () if r["count"] > even]


def keys_frame(spark: SparkSession, listed: list[tuple[int, int]]) -> DataFrame:
    return spark.createDataFrame(listed, _KEYS_SCHEMA).coalesce(1)


def spread(rows: DataFrame, keys: tuple[str, ...], listed: list[tuple[int, int]]) -> DataFrame:
    """The rows with their number, in turn within a task, so that rows that are alike are spread, too."""
    if not listed:
        return rows.withColumn(SPREAD, F.lit(0))
    turn, own = f"{SPREAD}_turn", f"{SPREAD}_key"
    numbered = rows.withColumn(turn, F.monotonically_increasing_id()).withColumn(own, _own_key(keys))
    found = numbered.join(keys_frame(rows.sparkSession, listed), F.col(own) == F.col("key"), "left")
    number = F.coalesce(F.pmod(F.col(turn), F.col("splits")), F.lit(0)).cast("int")
    return found.select(*(numbered[quoted(name)] for name in rows.columns), number.alias(SPREAD))


def bucket_number(keys: tuple[str, ...], buckets: int) -> Column:
    """The bucket a row belongs to, as Spark numbers them."""
    return F.pmod(F.hash(*(F.col(quoted(name)) for name in (*keys, SPREAD))), F.lit(buckets))


@dataclass(frozen=True)
class Layout:
    """How a table is laid out; ``keys`` are its bucket columns without the spread."""

    table: str
    keys: tuple[str, ...]
    buckets: int

    def listed(self, spark: SparkSession) -> DataFrame:
        """Every frequent key once. A table that is appended to has a list for each write."""
        return spark.table(self.table + KEYS_SUFFIX).groupBy("key").agg(F.max("splits").alias("splits"))


def layout_of(spark: SparkSession, table: str) -> Layout | None:
    """The layout of a table that was written for joins; None for any other."""
    if not spark.catalog.tableExists(table) or not spark.catalog.tableExists(table + KEYS_SUFFIX):
        return None
    names = [column.name for column in spark.catalog.listColumns(table) if column.isBucket]
    if SPREAD not in names:
        return None
    described = spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Num Buckets'").first()
    return Layout(table, tuple(name for name in names if name != SPREAD), int(described.data_type))


def _keys_on(side: str, other: set[str], used: list[JoinKey], sources: Mapping[str, Source]) -> dict[str, tuple[str, str]]:
    """For each key column of a source, the source and column it is joined with."""
    found = {}
    for key in used:
        ends = ((key.left_id, key.left_column), (key.right_id, key.right_column))
        for (own_id, own), (far_id, far) in (ends, ends[::-1]):
            if own_id == side and far_id in other:
                found.setdefault(sources[own_id].column(own).name, (far_id, sources[far_id].column(far).name))
    return found


def _as_own(own: T.DataType, far: T.DataType, column: Column) -> Column | None:
    """The far column as the own side's type, where whatever equals an own value becomes just that value."""
    whole = (T.IntegerType, T.LongType)
    if own == far and not isinstance(own, (T.FloatType, T.DoubleType)):
        return column
    if isinstance(own, whole) and isinstance(far, (*whole, T.StringType)):
        return column.try_cast(own)
    return None


def co_located(
    joined: DataFrame, joined_ids: set[str], new: DataFrame, new_id: str, used: list[JoinKey], sources: Mapping[str, Source], frames: Mapping[str, DataFrame]
) -> tuple[DataFrame, DataFrame, Column | None]:
    """Both sides of a join and what must hold beside the equality of keys, so that a laid-out side is not shuffled.

    The new source, or else the joined one while it is the only one, may be laid out on the join's keys. If both are, in
    as many buckets and without frequent keys, neither is shuffled.
    """
    sides = {}
    for side, other in ((new_id, joined_ids), *((only, {new_id}) for only in joined_ids if len(joined_ids) == 1)):
        if SPREAD not in frames[side].columns:
            continue
        layout = layout_of(new.sparkSession, sources[side].table)
        on = _keys_on(side, other, used, sources)
        if layout is not None and set(layout.keys) <= set(on):
            far = {name: _as_own(frames[side].schema[name].dataType, frames[i].schema[n].dataType, F.col(quoted(i, n))) for name, (i, n) in on.items() if name in layout.keys}
            if all(column is not None for column in far.values()):
                sides[side] = (layout, far)
    if not sides:
        return joined, new, None
    if len(sides) == 2:
        layouts = [layout for layout, _ in sides.values()]
        if layouts[0].buckets == layouts[1].buckets and all(layout.listed(new.sparkSession).isEmpty() for layout in layouts):
            a, b = (F.col(quoted(side, SPREAD)) for side in sides)
            return joined, new, a == b
    side = next(iter(sides))
    layout, far = sides[side]
    copy = f"{SPREAD}_of_{side}"
    if side == new_id:
        joined = _repeated(joined, layout, far, copy)
    else:
        new = _repeated(new, layout, far, copy)
    return joined, new, F.col(quoted(side, SPREAD)) == F.col(quoted(copy))


def _repeated(rows: DataFrame, layout: Layout, far: Mapping[str, Column], copy: str) -> DataFrame:
    """The rows with the numbers under which a laid-out side may hold their key; rows of frequent keys once for each."""
    own, splits = f"{copy}_key", f"{copy}_splits"
    listed = layout.listed(rows.sparkSession).select(F.col("key").alias(own), F.col("splits").alias(splits))
    found = rows.join(listed, key_of(far) == F.col(quoted(own)), "left")
    return found.withColumn(copy, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(quoted(splits)), F.lit(1)) - 1)))
