"""Document fingerprints: a digest of quartiles of byte-triplet counts, and how alike two digests are.

Every three neighbouring bytes of a text are hashed into one of 128 buckets. The digest has two bits for each
bucket, which quarter of the bucket counts it falls in, after a byte for the length (its logarithm) and a
check byte. Two digests differ by the steps between the codes of each bucket (0 to 3, and twice that where one
is lowest and the other highest), and by the steps between the length codes, of which at most ``_MOST_STEPS``
count. The likeness is one minus the difference over the largest possible one, so it is from 0 to 1.

Defined results: a null text is like an empty one; texts under three bytes have empty buckets, and their
lengths still tell them apart; equal texts have equal digests; rows of one doc_id follow each other by the hash
of their text, and rows without an id come first.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 128
_MOST_STEPS = 24
_FURTHEST = 6
_LARGEST = BUCKETS * _FURTHEST + _MOST_STEPS
_MULTIPLIER = np.uint32(0x9E3779B1)
_MOST_RANGES = 40_000


def fingerprint(data: bytes) -> bytes:
    """34 bytes: length code, check byte, two bits for each bucket."""
    counts = np.zeros(BUCKETS, np.int64)
    raw = np.frombuffer(data, np.uint8)
    for start in range(0, max(0, len(raw) - 2), 1 << 20):
        part = raw[start : start + (1 << 20) + 2].astype(np.uint32)
        triplets = (part[:-2] << 16) | (part[1:-1] << 8) | part[2:]
        counts += np.bincount((triplets * _MULTIPLIER) >> 25, minlength=BUCKETS)
    quartiles = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = np.searchsorted(quartiles, counts, side="left").astype(np.uint8).reshape(-1, 4)
    packed = codes[:, 0] | (codes[:, 1] << 2) | (codes[:, 2] << 4) | (codes[:, 3] << 6)
    length = min(255, round(10 * np.log1p(len(raw)))) if len(raw) else 0
    return bytes([length, int(counts @ np.arange(1, BUCKETS + 1)) % 251]) + packed.tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """1 for equal digests, less for each step between them, 0 at the largest difference."""
    x, y = (np.frombuffer(d, np.uint8)[2:, None] >> np.arange(0, 8, 2) & 3 for d in (a, b))
    steps = np.abs(x.astype(int) - y.astype(int))
    apart = int(np.where(steps == 3, _FURTHEST, steps).sum())
    return 1 - (apart + min(_MOST_STEPS, abs(a[0] - b[0]))) / _LARGEST


def _bounds_below(value: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are less than the value, which is not null.

    In two steps, so that a row is compared with a few hundred of them at most.
    """
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    below = lambda numbers: F.size(F.filter(numbers, lambda b: b < value))
    before = F.greatest(below(F.array(*(F.lit(g[0]) for g in groups))) - 1, F.lit(0))
    group = F.element_at(F.array(*(F.array(*map(F.lit, g)) for g in groups)), before + 1)
    return before * step + below(group)


def with_next(docs: DataFrame, rows_per_range: int = 4_000) -> DataFrame:
    """doc_id, text, part, halo: ranges of ascending doc_id, each followed by the first row of the next range.

    The ranges' bounds are quantiles of all ids; as literals they give every evaluation the same ranges. Rows without
    an id come first, in ranges of the hash of their text. After the last range comes the very first row again. Halo
    rows only serve their predecessors. The number of ranges follows the rows up to ``_MOST_RANGES`` of either kind,
    beyond which ranges grow (they are sorted with spilling and read as a stream).
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    every, named = rows.agg(F.count("*"), F.count("doc_id")).head()
    parts = min(_MOST_RANGES, max(1, named // rows_per_range))
    shares = [i / parts for i in range(1, parts)]
    bounds = rows.agg(F.percentile_approx("doc_id", shares, 10 * parts).alias("b")).head()["b"] if shares else []
    unnamed = min(_MOST_RANGES, -(-(every - named) // rows_per_range))
    by_text = F.least(F.floor((F.xxhash64("text") / float(1 << 64) + 0.5) * unnamed), F.lit(unnamed - 1))
    by_id = unnamed + _bounds_below(F.col("doc_id"), sorted(set(bounds or [])))
    rows = rows.withColumn("part", F.when(F.col("doc_id").isNull(), by_text).otherwise(by_id).cast("int"))
    order = F.struct(F.col("doc_id").isNotNull(), "doc_id", F.xxhash64("text"))
    firsts = sorted(rows.groupBy("part").agg(F.min(order).alias("o")).collect())  # one small row for each range
    if not firsts:
        return rows.withColumn("halo", F.lit(False))
    keys = spark.createDataFrame(
        [(first.o[1], first.o[2], before.part) for before, first in zip([firsts[-1], *firsts[:-1]], firsts, strict=True)],
        "id long, hash long, before int",
    )
    found = rows.join(F.broadcast(keys), F.col("doc_id").eqNullSafe(F.col("id")) & (F.xxhash64("text") == F.col("hash")))
    # rows that are alike in id and text are one halo
    halos = found.groupBy("before").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
    halos = halos.select("doc_id", "text", F.col("before").alias("part"), F.lit(True).alias("halo"))
    both = rows.withColumn("halo", F.lit(False)).unionByName(halos)
    return both.repartition(parts + unnamed, "part").sortWithinPartitions(
        "part", "halo", F.col("doc_id").asc_nulls_first(), F.xxhash64("text")
    )


def edited(text: str, following: str) -> str:
    """The text with its last quarter of code points replaced by as many of the following text's first."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    before: tuple[int | None, str, bytes] | None = None
    for batch in batches:
        columns = (batch.column(name) for name in ("doc_id", "text", "halo"))
        for doc_id, text, halo in zip(*columns, strict=True):
            text, halo = text.as_py(), halo.as_py()
            own = fingerprint(text.encode())
            if before:
                changed = edited(before[1], text).encode()
                print_of = fingerprint(changed)
                out.append(
                    (before[0], len(before[1]), hashlib.sha256(changed).hexdigest(), before[2].hex(), print_of.hex(),
                     likeness(before[2], print_of), likeness(before[2], own))
                )
            before = None if halo else (doc_id.as_py(), text, own)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), _RESULT.types, strict=True)], schema=_RESULT)
            out = []


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row for each document: digests of its text and of its edited text, and how alike they and the next one are."""
    return with_next(docs).select("doc_id", "text", "halo").mapInArrow(_compare, RESULT)
