"""Exact dedup by distributed MSD radix partitioning.

Documents are split by their leading characters, the groups by the following ones, and so on; each round takes
several times as many characters as the one before, so even a text of a gigabyte needs about a dozen rounds.
A document alone in its group has no equal and leaves. Documents whose text has ended within a group are equal.
No digest decides: the text itself is compared, piece after piece.

A round counts its groups with map-side sums and joins the counts back, a join that Spark splits where one
group holds much of the rows (a merge join at every size, so that the work grows evenly). What is left is written to the shared folder: it has copies and long common
beginnings only, each with the rest of its text.

Texts are equal when they are identical after each run of ``[\\x20\\x09-\\x0D]`` became one space.

Defined results: null counts as empty; empty texts are equal to each other and not to blank ones (one space);
rows without an id rank after all others, and a group of such rows keeps one, with a null keep_id; of rows
alike in id and text one is kept; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specflow.llm.tables import written

_FIRST_PIECE = 64
_GROWTH = 8
_BLANKS = "[\\t-\\r][\\t-\\r ]*| [\\t-\\r ]+"  # the runs that are not one space already


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), _BLANKS, " ")


def _groups(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The groups of several rows: their keys, how many rows, the smallest id, and the smallest row number if there is one.

    Written, so that the join with them has its own exchange on either side, which Spark can split at a hot group.
    """
    sums = [F.count("*").alias("size"), F.min("doc_id").alias("keep_id")]
    if "row" in rows.columns:
        sums.append(F.min("row").alias("next_group"))
    return written(rows.groupBy(*keys).agg(*sums).filter(F.col("size") > 1), "radix-groups")


def equal_groups(docs: DataFrame) -> DataFrame:
    """doc_id, text_sha256, keep_id, group_size of the rows that have an equal."""
    text = normalised(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("rest"))
    rows = rows.withColumn("piece", F.substring("rest", 1, _FIRST_PIECE))
    met = rows.join(_groups(rows, ["piece"]).hint("merge"), "piece")
    whole = F.sha2("rest", 256).alias("text_sha256")
    ended = F.length("piece") < _FIRST_PIECE
    # the row number is fixed by this write; all later rounds name rows and groups by it
    left = met.select("doc_id", "rest", whole, "keep_id", "size", ended.alias("ended"), F.monotonically_increasing_id().alias("row"))
    left = written(left, "radix")
    done = [left.filter("ended")]
    left = left.filter("not ended").withColumn("group", F.lit(0).cast("long"))
    length, at = _FIRST_PIECE * _GROWTH, 1
    while not left.isEmpty():
        # the first of these rounds begins at the text's first character, as the group so far has no number
        rows = left.select("doc_id", "row", "group", "text_sha256", "rest").withColumn("piece", F.substring("rest", at, length))
        met = rows.join(_groups(rows, ["group", "piece"]).hint("merge"), ["group", "piece"])
        ended = F.length("piece") < length
        rest = F.when(ended, F.lit("")).otherwise(F.expr(f"substring(rest, {length + 1})"))
        left = met.select(
            "doc_id", "row", "text_sha256", "keep_id", "size", rest.alias("rest"), ended.alias("ended"), F.col("next_group").alias("group")
        )
        left = written(left, "radix")
        done.append(left.filter("ended"))
        left = left.filter("not ended")
        length *= _GROWTH
    columns = ["doc_id", "text_sha256", "keep_id", F.col("size").alias("group_size")]
    found = done[0].select(*columns)
    for more in done[1:]:
        found = found.unionByName(more.select(*columns))
    return found


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    # rows alike in id and text are one row with a number here, so that the join meets each once
    rows = docs.select(F.col("doc_id").cast("long"), F.sha2(normalised(F.col("text")), 256).alias("text_sha256"))
    rows = rows.groupBy("doc_id", "text_sha256").agg(F.count("*").alias("n"))
    groups = equal_groups(docs).groupBy("doc_id", "text_sha256").agg(
        F.first("keep_id").alias("keep_id"), F.first("group_size").alias("group_size"), F.lit(True).alias("met")
    )
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.text_sha256") == F.col("b.text_sha256"))
    met = F.coalesce("met", F.lit(False))
    joined = rows.alias("a").join(groups.alias("b"), same, "left").select(
        "a.doc_id",
        F.when(met, F.col("keep_id")).otherwise(F.col("a.doc_id")).alias("keep_id"),
        F.when(met, F.col("group_size")).otherwise(1).cast("long").alias("group_size"),
        "a.text_sha256",
        F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("number"),
    )
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("number") == 1)
    return joined.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")
