"""What the operators share on the Spark side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from specflow.sinks.storage import new_folder

#: The share of documents that models are judged on and never learn from: this remainder of crc32(doc_id) by four.
HELD_OUT_REMAINDER = 2

#: The parts of a row's ``copy``: bits of its text's hash, and a number among the texts of one id that agree in those.
TAG_BITS, NUMBER_BITS = 23, 10


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The frame, written to the folder that all executors share and read from there.

    Cuts the lineage: a lost executor costs a re-read, and every later use sees the same rows.
    """
    path = new_folder(df.sparkSession, f"llm-{purpose}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, by four; null for a null id."""
    return F.crc32(doc_id.cast("string")) % 4


def held_out(doc_id: Column) -> Column:
    """False for a null id, which is in no fold and is never learned from either."""
    return F.coalesce(fold_of(doc_id) == HELD_OUT_REMAINDER, F.lit(False))


def _keyed(docs: DataFrame) -> DataFrame:
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(F.coalesce(doc_id, F.xxhash64("text")).alias("id_key"), doc_id.isNull().alias("no_id"), "text")
    return rows.withColumn("tag", F.shiftrightunsigned(_text_key(), 64 - TAG_BITS))


def _text_key() -> Column:
    """Another hash than the id_key of a row without an id."""
    return F.xxhash64("no_id", "text")


def named_rows(docs: DataFrame) -> DataFrame:
    """id_key, tag, no_id, text, copy: the rows named by two numbers, those alike in id and text as one.

    id_key is the id, or the hash of the text if it is missing (no_id). ``copy`` tells the texts of one id_key apart: the
    first bits of another hash (``tag``), and a number among the texts with that tag, in order, so any evaluation gives a
    text the same number. The rows are dealt out by id_key and tag, so no task gets all texts of one id; rows alike are
    made one before they are dealt out as well as after. One id may have about 2^33 texts.
    """
    # not mapInArrow: a plan that is used several times shares its exchange only if no Python comes before it
    texts = _keyed(docs).groupBy("id_key", "tag").agg(F.collect_set(F.struct("no_id", "text")).alias("texts"))
    rows = texts.select("id_key", "tag", F.posexplode(F.sort_array("texts")).alias("number", "row"))
    return rows.select("id_key", "tag", "row.no_id", "row.text", (F.shiftleft("tag", NUMBER_BITS) + F.col("number")).alias("copy"))


def counted(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The named rows with ``n``: how many rows of the documents are alike in id and text."""
    alike = _keyed(docs).groupBy("id_key", "tag", _text_key().alias("text_key")).agg(F.count("*").alias("n"))
    numbers = F.map_from_entries(F.collect_list(F.struct("text_key", "n")))
    found = alike.groupBy(F.col("id_key").alias("of"), F.col("tag").alias("of_tag")).agg(numbers.alias("numbers"))
    joined = rows.join(found, (F.col("id_key") == F.col("of")) & (F.col("tag") == F.col("of_tag")))
    return joined.withColumn("n", F.col("numbers")[_text_key()]).drop("of", "of_tag", "numbers")


def id_of_row() -> Column:
    return F.when(F.col("no_id"), F.lit(None)).otherwise(F.col("id_key")).cast("long").alias("doc_id")


def rows_kept(docs: DataFrame, identity: Column, decisions: DataFrame, name: str) -> DataFrame:
    """The documents named by (doc_id, ``name``) in the decisions, with the decisions' other columns.

    ``identity`` is what ``name`` holds for a document. Rows alike in both are one row of the result. One exchange
    serves the join and the removal of repeated rows.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))
    wanted = decisions.withColumn("id_key", key).withColumnRenamed(name, "content_key").drop("doc_id")
    rows = docs.withColumn("id_key", key).withColumn("content_key", identity)
    return rows.join(wanted, ["id_key", "content_key"]).dropDuplicates(["id_key", "content_key"]).drop("id_key", "content_key")
