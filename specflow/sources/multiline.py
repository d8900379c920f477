"""Delimited text whose fields hold line breaks, read by many tasks a file.

A file's blocks are read as lines. Whether a block begins inside quotes is told by the quotes before it: each task counts
those of its blocks, and their running sum is odd where a field is open. Then each task cuts its lines into records;
a record that goes on in the next blocks leaves fragments, which alone are shuffled to be joined. Records are parsed by
Spark. Quotes must stand in quoted fields only, as writers put them; a quote within a plain field would turn everything
after it inside out, so this reading is asked for (``splitRecords``), not the default.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specflow.plans.spec import SpecError

SPLIT_RECORDS = "splitRecords"
_LISTING = ("recursivefilelookup", "pathglobfilter", "modifiedafter", "modifiedbefore")
#: Rows and characters that a task holds before it hands them on.
_ROWS_HELD, _TEXT_HELD = 10_000, 4 << 20
_NOT_PARSING = (*_LISTING, "multiline", "header", "inferschema", "linesep", SPLIT_RECORDS.lower())


def read_records(spark: SparkSession, location: str | list[str], options: dict[str, str], schema: T.StructType) -> DataFrame:
    """The rows of delimited files, by position."""
    by_name = {name.lower(): value for name, value in options.items()}
    quote, escape = by_name.get("quote", '"'), by_name.get("escape", "\\")
    if len(quote) != 1 or len(escape) > 1:
        raise SpecError(f"{SPLIT_RECORDS} needs a quote of one character")
    if by_name.get("encoding", by_name.get("charset", "UTF-8")).upper() != "UTF-8" or by_name.get("linesep", "\n") != "\n":
        raise SpecError(f"{SPLIT_RECORDS} reads UTF-8 text with line feeds")
    _workers_find_package(spark)
    listing = {name: value for name, value in options.items() if name.lower() in _LISTING}
    lines = spark.read.options(**listing).option("lineSep", "\n").text(location)
    lines = lines.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))
    counted = lines.mapInArrow(_counted(quote, escape), "path string, block long, quotes long")
    blocks = counted.groupBy("path", "block").agg(F.sum("quotes").alias("quotes"))
    before = F.sum("quotes").over(W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    # one entry for each block that begins inside a field: far fewer than tasks can be scheduled for
    inside = {(r.path, r.block) for r in blocks.withColumn("before", before).where(F.col("before") % 2 == 1).select("path", "block").collect()}
    begins = spark.sparkContext.broadcast(inside)
    parts = lines.mapInArrow(_cut(quote, escape, begins), "path string, block long, kind string, first boolean, record string")
    if by_name.get("header", "false").lower() == "true":
        parts = parts.where(~F.col("first"))
    fragments = parts.where(F.col("kind") != "whole")
    number = F.sum((F.col("kind") == "opens").cast("long")).over(W.partitionBy("path").orderBy("block", F.col("kind") == "opens"))
    pieces = F.sort_array(F.collect_list(F.struct("block", F.col("kind") == "opens", "record")))
    joined = fragments.withColumn("number", number).groupBy("path", "number").agg(F.concat_ws("\n", F.transform(pieces, lambda p: p["record"])).alias("record"))
    records = parts.where(F.col("kind") == "whole").select("record").unionByName(joined.select("record"))
    parsing = {name: value for name, value in options.items() if name.lower() not in _NOT_PARSING} | {"multiLine": "true", "lineSep": "\n"}
    fields = T.StructType([T.StructField(field.name, field.dataType) for field in schema.fields])
    row = F.from_csv("record", F.lit(_ddl(fields)), parsing)
    return records.select(row.alias("row")).select("row.*")


def _workers_find_package(spark: SparkSession) -> None:
    """Python workers look for this package where the driver has it; elsewhere it is installed or sent along."""
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [path for path in environment.get("PYTHONPATH", "").split(os.pathsep) if path]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{field.name.replace('`', '``')}` {field.dataType.simpleString()}" for field in schema.fields)


def _unescaped(values: pa.Array, quote: str, escape: str) -> pa.Array:
    """The lines without escaped characters, where those are not doubled quotes."""
    return values if escape in ("", quote) else pc.replace_substring_regex(values, f"(?s){re.escape(escape)}.", "")


def _counted(quote: str, escape: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            quotes = pc.count_substring(_unescaped(batch.column("value"), quote, escape), quote)
            table = pa.table({"path": batch.column("path"), "block": batch.column("block"), "quotes": quotes})
            sums = table.group_by(["path", "block"]).aggregate([("quotes", "sum")])
            yield pa.RecordBatch.from_arrays(
                [sums.column(n).combine_chunks() for n in ("path", "block")] + [sums.column("quotes_sum").combine_chunks().cast(pa.int64())],
                names=["path", "block", "quotes"],
            )

    return count


def _cut(quote: str, escape: str, begins):
    """Records of a block; what the block before has begun as ``goes on`` or ``ends``, what the next goes on with as ``opens``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, is_open, goes_on, seen, size = None, [], False, False, False, 0
        out: list[tuple] = []

        def told(kind: str) -> None:
            nonlocal held, seen, size
            record = "\n".join(held)
            if kind in ("whole", "ends"):
                record = record.removesuffix("\r")
            held = []
            if record.strip() or kind != "whole":
                out.append((*at, kind, at[1] == 0 and not seen, record))
                seen = True
                size += len(record)

        def block_ends() -> None:
            if held:
                told(("goes on" if goes_on else "opens") if is_open else "whole")

        for batch in batches:
            values = batch.column("value")
            odd = pc.bit_wise_and(pc.count_substring(_unescaped(values, quote, escape), quote), 1).to_pylist()
            places = zip(batch.column("path").to_pylist(), batch.column("block").to_pylist(), strict=True)
            for place, value, toggles in zip(places, values.to_pylist(), odd, strict=True):
                if place != at:
                    if at is not None:
                        block_ends()
                    at, held, is_open, seen = place, [], place in begins.value, False
                    goes_on = is_open
                held.append(value)
                is_open ^= bool(toggles)
                if not is_open:
                    told("ends" if goes_on else "whole")
                    goes_on = False
                if len(out) >= _ROWS_HELD or size >= _TEXT_HELD:
                    yield _rows(out)
                    out.clear()
                    size = 0
        if at is not None:
            block_ends()
        if out:
            yield _rows(out)

    return cut


def _rows(out: list[tuple]) -> pa.RecordBatch:
    columns = zip(*out, strict=True)
    kinds = (pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["path", "block", "kind", "first", "record"])
