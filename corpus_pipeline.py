"""A corpus made ready for training: language, exact and near duplicates, mixture, packed sequences.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps; the last returns the packed pieces. Every
stage works on all rows its predecessor kept; between stages they are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specflow.llm import exact_dedup, language, mixing, near_dedup, packing
from specflow.llm.registry import importable, query, table
from specflow.llm.tables import rows_kept, written

#: A document goes if no language has at least this probability.
LEAST_SCORE = 0.5


def _wrapped(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text, ``more``, and all other columns as one, so that no name of theirs can clash with a stage's own."""
    others = [F.col(_quoted(c)) for c in docs.columns if c != "text"]
    return docs.select("doc_id", "text", *more, F.struct(*others).alias("document"))


def _unwrapped(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of the documents again."""
    return rows.select(*(F.col("text") if c == "text" else F.col("document").getField(c).alias(c) for c in docs.columns))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those whose language can't be told."""
    told = language.languages(_wrapped(docs, "lang"), carry=("document",))
    kept = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return _unwrapped(told.filter(kept), docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    kept = exact_dedup.exact_duplicates(docs).filter("kept").select("doc_id", "text_sha256")
    identity = F.sha2(exact_dedup.normalised(F.col("text")), 256)
    return _unwrapped(rows_kept(_wrapped(docs), identity, kept, "text_sha256"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    kept = near_dedup.near_duplicates(docs).filter("kept").select("doc_id", "text_hash")
    return _unwrapped(rows_kept(_wrapped(docs), F.xxhash64("text"), kept, "text_hash"), docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it."""
    taken = mixing.mixed(docs).groupBy("doc_id", "text_hash").agg(F.sum("times").alias("mixture_times"))
    rows = rows_kept(_wrapped(docs), F.xxhash64("text"), taken.filter("mixture_times > 0"), "text_hash")
    repeated = rows.withColumn("mixture_number", F.explode(F.sequence(F.lit(1).cast("long"), "mixture_times")))
    return _unwrapped(repeated, docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in sequences."""
    return packing.pieces(docs)


STAGES = [
    ("language_id", importable(language_id)),
    ("exact_dedup", importable(exact_duplicates)),
    ("near_dedup", importable(near_duplicates)),
    ("mixture", importable(mixture)),
    ("packing", importable(packed)),
]

#: Learned models, random draws and a greedy packing: SQL can't express run().
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = written(stage(spark, rows, sf_dir), name)
    return rows
