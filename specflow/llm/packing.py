"""Best-fit packing into sequences of several permitted lengths.

Documents are dealt by hash into groups of bounded size; each group is packed by itself, so no task holds an
unbounded number of documents and a hot source is spread like any other. A document longer than the longest length is
cut into pieces of that length and a last one.

Within a group, pieces go from long to short. A piece goes where the least room is left over among the open bins it
fits in. If it fits nowhere, a bin is opened in the permitted length of least cost: the tokens it leaves unused in
expectation, given that the pieces still to come fill it up to their mean size, plus ``BIN_COST`` tokens for the bin
itself, for each token of capacity. At the end each bin is cut down to the shortest permitted length that holds its
contents.

Defined results: a null or empty text has no piece and no row in ``pieces``, and one row without a bin in the
query; documents without an id are dealt by their text; repeated rows are packed each; ties go by id and text;
extra columns are ignored.
"""

from __future__ import annotations

import bisect

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specflow.llm.mixing import size_in_words

LENGTHS = (512, 1024, 2048, 4096)
BIN_COST = 16
_GROUP_ROWS = 4_000


def opening(size: int, left: int, pieces: int, lengths: tuple[int, ...]) -> int:
    """The permitted length of least cost for a bin that begins with this piece; ``left`` tokens in ``pieces`` still come."""
    mean = left / pieces if pieces else 0.0

    def cost(length: int) -> float:
        room = length - size
        # later pieces fill the room but for half a piece, as far as there are any
        unused = max(room - left, min(room, mean / 2))
        return (unused + BIN_COST) / length

    return min((x for x in lengths if x >= size), key=lambda x: (cost(x), x))


def pack(sizes: list[int], lengths: tuple[int, ...] = LENGTHS) -> tuple[list[tuple[int, int]], list[int]]:
    """For each piece, in order of falling size, its bin and offset; and the bins' final lengths."""
    lengths = tuple(sorted(lengths))
    placed: list[tuple[int, int]] = []
    used: list[int] = []
    open_bins: list[tuple[int, int]] = []  # (room left, bin), in order
    left = sum(sizes)
    for i, size in enumerate(sizes):
        left -= size
        at = bisect.bisect_left(open_bins, (size, -1))
        if at < len(open_bins):
            room, number = open_bins.pop(at)
        else:
            room, number = opening(size, left, len(sizes) - i - 1, lengths), len(used)
            used.append(0)
        placed.append((number, used[number]))
        used[number] += size
        if room > size:
            bisect.insort(open_bins, (room - size, number))
    return placed, [lengths[bisect.bisect_left(lengths, u)] for u in used]


_PIECES = "doc_id long, text_hash long, piece int, size long, n_tokens int, pack_group long, bin int, offset int, capacity int"
_NAMES = [column.split()[0] for column in _PIECES.split(", ")]
_TYPES = [{"long": pa.int64(), "int": pa.int32()}[column.split()[1]] for column in _PIECES.split(", ")]


def _pack_group(lengths: tuple[int, ...]):
    def run(group: pa.Table) -> pa.Table:
        rows = []
        longest = max(lengths)
        columns = (group.column(name).to_pylist() for name in ("doc_id", "text_hash", "size"))
        for doc_id, copy, size in zip(*columns, strict=True):
            for piece, start in enumerate(range(0, size, longest)):
                rows.append((min(longest, size - start), doc_id, copy, piece, size))
        # missing ids sort as the largest
        rows.sort(key=lambda r: (-r[0], r[1] is None, r[1] or 0, r[2], r[3]))
        placed, capacities = pack([r[0] for r in rows], lengths)
        number = group.column("pack_group")[0].as_py()
        out = [(d, c, p, s, n, number, b, o, capacities[b]) for (n, d, c, p, s), (b, o) in zip(rows, placed, strict=True)]
        return pa.Table.from_arrays([pa.array(column, t) for column, t in zip(zip(*out, strict=True), _TYPES, strict=True)], _NAMES)

    return run


def pieces(docs: DataFrame, lengths: tuple[int, ...] = LENGTHS, size: Column | None = None) -> DataFrame:
    """One row for each piece: doc_id, text_hash, piece, size (the document's), n_tokens, pack_group, bin, offset, capacity.

    ``size`` is a document's length in tokens, its words if not given. A bin is named by pack_group and bin.
    """
    size = size_in_words(F.col("text")) if size is None else size
    rows = docs.select(F.col("doc_id").cast("long"), size.cast("long").alias("size"), F.xxhash64("text").alias("text_hash"))
    groups = max(1, -(-rows.select("doc_id").count() // _GROUP_ROWS))
    # rows alike in id and text get a number, so many copies don't meet in one group
    rows = rows.filter(F.col("size") > 0).groupBy("doc_id", "text_hash", "size").agg(F.count("*").alias("n"))
    rows = rows.withColumn("number", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).drop("n")
    dealt = F.pmod(F.xxhash64("doc_id", "text_hash", "number"), F.lit(groups))
    return rows.withColumn("pack_group", dealt).groupBy("pack_group").applyInArrow(_pack_group(lengths), _PIECES)


def packed(docs: DataFrame, lengths: tuple[int, ...] = LENGTHS, size: Column | None = None) -> DataFrame:
    """The pieces, and one row without a bin for each document without words."""
    size = F.coalesce(size_in_words(F.col("text")) if size is None else size, F.lit(0)).cast("long")
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), size.alias("size")).filter("size <= 0")
    missing = {name: F.lit(None).cast("int") for name in ("piece", "bin", "offset", "capacity")}
    wordless = rows.withColumns({**missing, "n_tokens": F.lit(0), "pack_group": F.lit(None).cast("long")})
    return pieces(docs, lengths, size).unionByName(wordless)
