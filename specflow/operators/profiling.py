"""Column statistics of a source or sink: count, mean, standard deviation, minimum, maximum.

Statistics are made from states that can be merged, so that those of all increments together come from the states of
each, without a look at their rows.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specflow.plans.spec import quoted

# The statistics, in the order they are reported.
STATISTICS = ("count", "mean", "stddev", "min", "max")

PROFILE_SCHEMA = T.StructType(
    [
        T.StructField("column_name", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("stddev", T.DoubleType()),
        T.StructField("min", T.StringType()),
        T.StructField("max", T.StringType()),
    ]
)


# Text that reads as a number; checking first is far cheaper than a failed cast on every row.
_NUMBER = r"(?i)^\s*[-+]?((\d+\.?\d*|\.\d+)(e[-+]?\d+)?[df]?|nan|inf|infinity)\s*$"


def _columns_of(df: DataFrame, kind: type[T.DataType]) -> list[str]:
    return [field.name for field in df.schema.fields if isinstance(field.dataType, kind)]


def _number(df: DataFrame, name: str, value: Column) -> Column:
    """The value as a number; null for text that does not read as one."""
    number = value.try_cast("double")
    return F.when(value.rlike(_NUMBER), number) if isinstance(df.schema[name].dataType, T.StringType) else number


def _statistics(df: DataFrame, name: str, where: Column | None = None) -> dict[str, Column]:
    value = F.col(quoted(name)) if where is None else F.when(where, F.col(quoted(name)))
    number = _number(df, name, value)
    return {
        "count": F.count(value),
        "mean": F.avg(number),
        "stddev": F.stddev(number),
        "min": F.min(value).cast("string"),
        "max": F.max(value).cast("string"),
    }


#: What is kept of a column: ``numbers`` of its values have ``mean``, and squared deviations from it that sum to ``m2``.
STATE_SCHEMA = (
    "column_name string, is_number boolean, count bigint, numbers bigint, mean double, m2 double, min string, max string"
)


def _state(df: DataFrame, name: str, where: Column | None = None) -> dict[str, Column]:
    """What the state needs beyond the statistics."""
    value = F.col(quoted(name)) if where is None else F.when(where, F.col(quoted(name)))
    return {"numbers": F.count(_number(df, name, value))}


def profile_states(df: DataFrame) -> DataFrame:
    """The state of each number or text column, one row for each, in one pass with partial sums in every task."""
    numbers = _columns_of(df, T.NumericType)
    rows = []
    for name in [*numbers, *_columns_of(df, T.StringType)]:
        stats, more = _statistics(df, name), _state(df, name)
        number = _number(df, name, F.col(quoted(name)))
        rows.append(
            F.struct(
                F.lit(name).alias("column_name"), F.lit(name in numbers).alias("is_number"), stats["count"].alias("count"),
                more["numbers"].alias("numbers"), stats["mean"].alias("mean"),
                (F.var_pop(number) * more["numbers"]).alias("m2"), stats["min"].alias("min"), stats["max"].alias("max"),
            )
        )
    if not rows:
        return df.sparkSession.createDataFrame([], STATE_SCHEMA)
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def merged_states(states: DataFrame, *by: str) -> DataFrame:
    """One state for each column (and value of ``by``) from any number of them, as if their rows had been profiled at once."""
    key = [*by, "column_name"]
    same = W.partitionBy(*key)
    # as a distance from one of the means, so that far from zero no digits are lost
    pivot = F.min("mean").over(same)
    away = F.sum((F.col("mean") - F.col("pivot")) * F.col("numbers")).over(same)
    mean = F.col("pivot") + away / F.nullif(F.sum("numbers").over(same), F.lit(0))
    moved = states.withColumn("pivot", pivot).withColumn("mean_of_all", mean)
    # deviations from the common mean, not sums of squares, which would cancel each other out
    m2 = F.sum(F.col("m2") + F.col("numbers") * F.pow(F.col("mean") - F.col("mean_of_all"), 2))

    def end(name: str, most: bool) -> Column:
        order = F.struct(F.col(name).try_cast("double"), F.col(name).try_cast("decimal(38,9)"), F.col(name))
        order = F.when(F.col(name).isNotNull(), order)
        number = (F.max_by if most else F.min_by)(name, order)
        return F.when(F.first("is_number"), number).otherwise((F.max if most else F.min)(name)).alias(name)

    return moved.groupBy(*key).agg(
        F.first("is_number").alias("is_number"), F.sum("count").alias("count"), F.sum("numbers").alias("numbers"),
        F.first("mean_of_all").alias("mean"), m2.alias("m2"), end("min", False), end("max", True),
    )


def finished(states: DataFrame, *by: str) -> DataFrame:
    """The statistics that states stand for."""
    stddev = F.when(F.col("numbers") > 1, F.sqrt(F.col("m2") / (F.col("numbers") - 1)))
    return states.select(*by, "column_name", "count", "mean", stddev.alias("stddev"), "min", "max")


def profile(df: DataFrame) -> DataFrame:
    """One row per number or text column; other types have no mean. One scan of the frame."""
    return finished(profile_states(df))


def observed(df: DataFrame, name: str, full: bool) -> tuple[DataFrame, "WriteObservation"]:
    """The frame with its rows counted, and profiled if asked, by whichever write consumes it.

    Counting is free. A full profile adds work to every row, but no further pass.
    """
    columns = _columns_of(df, T.NumericType) + _columns_of(df, T.StringType) if full else []
    observation = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    for position, column in enumerate(columns):
        metrics += [c.alias(f"{s}_{position}") for s, c in {**_statistics(df, column), **_state(df, column)}.items()]
    return df.observe(observation, *metrics), WriteObservation(observation, columns, _columns_of(df, T.NumericType))


def observed_sides(
    df: DataFrame, name: str, side: str, values: tuple[str, ...], full: bool
) -> tuple[DataFrame, list["WriteObservation"]]:
    """As :func:`observed`, for each value of the column ``side`` by itself."""
    own = df.drop(side)
    columns = _columns_of(own, T.NumericType) + _columns_of(own, T.StringType) if full else []
    observation = Observation(name)
    metrics = []
    for number, value in enumerate(values):
        where = F.col(side) == value
        metrics.append(F.count_if(where).alias(f"rows_of_{number}"))
        for position, column in enumerate(columns):
            own_metrics = {**_statistics(own, column, where), **_state(own, column, where)}
            metrics += [c.alias(f"{s}_{position}_of_{number}") for s, c in own_metrics.items()]
    sides = [WriteObservation(observation, columns, _columns_of(own, T.NumericType), f"_of_{number}") for number in range(len(values))]
    return df.observe(observation, *metrics), sides


class WriteObservation:
    """Results of :func:`observed`, available once the write has finished."""

    def __init__(self, observation: Observation, columns: list[str], numbers: list[str], suffix: str = "") -> None:
        self._observation = observation
        self._columns = columns
        self._numbers = set(numbers)
        self._suffix = suffix

    @property
    def rows(self) -> int:
        return self._observation.get[f"rows{self._suffix}"]

    def records(self) -> list[dict[str, Any]]:
        values = self._observation.get
        return [
            {"column_name": column, **{s: values[f"{s}_{position}{self._suffix}"] for s in STATISTICS}}
            for position, column in enumerate(self._columns)
        ]

    def states(self) -> list[dict[str, Any]]:
        """The columns' states, as records."""
        found = []
        for position, record in enumerate(self.records()):
            numbers, stddev = self._observation.get[f"numbers_{position}{self._suffix}"], record.pop("stddev")
            m2 = stddev * stddev * (numbers - 1) if numbers > 1 else 0.0 if numbers else None
            found.append({**record, "is_number": record["column_name"] in self._numbers, "numbers": numbers, "m2": m2})
        return found


def records_of(stats: DataFrame) -> list[dict[str, Any]]:
    """The rows of :func:`profile`, one per column, as plain records."""
    return [row.asDict() for row in stats.collect()]


def profile_frame(spark: SparkSession, records: list[dict[str, Any]]) -> DataFrame:
    """Profile records, one per column, as a frame."""
    rows = [tuple(record[field.name] for field in PROFILE_SCHEMA.fields) for record in records]
    return spark.createDataFrame(rows, PROFILE_SCHEMA)


def profile_json(records: list[dict[str, Any]]) -> str:
    """Profile records as the JSON published with a run: one object per statistic."""
    summary = []
    for statistic in STATISTICS:
        values = {r["column_name"]: str(r[statistic]) for r in records if r[statistic] is not None}
        summary.append({"summary": statistic, **values})
    return json.dumps(summary)
