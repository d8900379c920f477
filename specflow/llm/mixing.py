"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source has a target in words. A target of several times its source first takes the whole source that often
(complete epochs); the rest is a weighted sample without replacement: each document gets an exponential key,
-ln(u) divided by its quality weight, and the documents of the least keys are taken until their sizes reach the
rest. u comes from a hash of the document, so reruns agree.

The prefix sums need no task that holds a source: keys are cut into buckets whose number follows the source's rows,
the buckets' sums (one small row each) are added up in order, and only the one bucket in which a source's sample
ends is put in order document by document. The sample ends at the document that brings it nearest to the rest.

Quality weights come from the text: the share of its characters that are not punctuation or other signs, at least
a tenth, so clean prose goes before junk.

Defined results: sources are ordered by code point, a null source last; an empty or null text has size 0 and is
never counted; a source of size 0 has target 0; documents without an id are drawn by their text; repeated rows share
a key, and a sample may end between them; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from specflow.llm.tables import written

WEIGHTS = (5.0, 2.0, 1.0)
TOTAL_SHARE = 1.5
MOST_EPOCHS = 2.0
_ROWS_PER_BUCKET = 5_000
_SEED = 20_011


def size_in_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t-\\r]+")), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """From 0.1 to 1: the share of characters other than ASCII signs."""
    signs = F.regexp_count(text, F.lit(r"[!-/:-@\[-`{-~]"))
    return F.coalesce(F.greatest(F.lit(0.1), 1 - signs / F.greatest(F.length(text), F.lit(1))), F.lit(0.1))


def _ranked(sources: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """The sources with their weight, by rank in code point order, null last; dealt out and counted by range."""
    ordered = sources.sort(F.col("source").asc_nulls_last())
    numbered = ordered.rdd.zipWithIndex().map(lambda x: (*x[0], x[1]))
    schema = "source string, rows long, source_size long, rank long"
    table = sources.sparkSession.createDataFrame(numbered, schema)
    cycle = F.array(*map(F.lit, weights))
    return table.withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")))


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = TOTAL_SHARE, most: float = MOST_EPOCHS) -> DataFrame:
    """source, rows, source_size, target from source, rows, source_size.

    Shares by weight; what exceeds ``most`` times a source is shared anew among the others, until none does. Each
    pass is one sum over the sources; only totals reach the driver.
    """
    # written once: the ranks come from the order of the sources
    table = written(_ranked(sources, weights), "sources").withColumn("limit", most * F.col("source_size"))
    total = share * (table.agg(F.sum("source_size")).head()[0] or 0)
    level, full = 0.0, -1
    while True:
        capped = F.col("weight") * level >= F.col("limit")
        row = table.agg(
            F.sum(F.when(capped, F.col("limit"))).alias("taken"),
            F.sum(F.when(~capped, F.col("weight"))).alias("open"),
            F.count(F.when(capped, 1)).alias("full"),
        ).head()
        if not row["open"] or row["full"] == full:
            break
        full = row["full"]
        level = (total - (row["taken"] or 0.0)) / row["open"]
    target = F.least(F.col("weight") * level, F.col("limit"))
    return table.select("source", "rows", "source_size", target.alias("target"))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def mixed(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = TOTAL_SHARE, most: float = MOST_EPOCHS, weight: Column | None = None
) -> DataFrame:
    """doc_id, source, text_hash, size, source_size, target, taken (the words the mix takes, repeats counted), times."""
    text = F.col("text")
    weight = quality_weight(text) if weight is None else weight
    # 52 bits of a hash, in the open interval from 0 to 1
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(_SEED), "doc_id", "text"), 12) + 0.5) / float(1 << 52)
    rows = docs.select(
        F.col("doc_id").cast("long"), "source", size_in_words(text).alias("size"), weight.cast("double").alias("weight"),
        u.alias("u"), F.xxhash64("text").alias("text_hash"),
    )
    rows = written(rows, "sizes")  # numbers only; the texts are read once
    rows = rows.withColumn("key", -F.log("u") / F.col("weight"))
    sources = rows.groupBy("source").agg(F.count("*").alias("rows"), F.sum("size").alias("source_size"))
    means = rows.groupBy(F.col("source").alias("of")).agg(F.avg("weight").alias("mean"))
    # a hot source is spread by bucket, never gathered; its row here is one of a few numbers
    goals = written(targets(sources, weights, share, most), "targets")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goals = goals.withColumn("epochs", epochs)
    goals = goals.withColumn("rest", F.greatest(F.col("target") - F.col("epochs") * F.col("source_size"), F.lit(0.0)))
    goals = goals.withColumn("buckets", F.ceil(F.col("rows") / _ROWS_PER_BUCKET))
    goals = goals.join(means, _same("source", "of")).drop("of").withColumnRenamed("source", "of")
    known = rows.join(goals, _same("source", "of")).drop("of")
    # for weights near their mean, this spreads keys evenly from 0 to 1
    spread = 1 - F.exp(-F.col("key") * F.col("mean"))
    known = known.withColumn("bucket", F.floor(F.col("buckets") * spread))
    sums = known.groupBy("source", "bucket", "rest").agg(F.sum("size").alias("size"))
    so_far = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    sums = sums.withColumn("end", F.sum("size").over(so_far)).withColumn("before", F.col("end") - F.col("size"))
    sums = sums.select(F.col("source").alias("of"), F.col("bucket").alias("in"), "before", "end")
    placed = known.join(sums, _same("source", "of") & (F.col("bucket") == F.col("in")))
    whole = placed.filter((F.col("end") <= F.col("rest")) | (F.col("before") >= F.col("rest")))
    whole = whole.withColumn("chosen", F.col("end") <= F.col("rest"))
    cut = placed.filter((F.col("end") > F.col("rest")) & (F.col("before") < F.col("rest")))
    in_order = W.partitionBy("source").orderBy("key", "doc_id", "text_hash").rowsBetween(W.unboundedPreceding, W.currentRow)
    cut = cut.withColumn("sum", F.col("before") + F.sum("size").over(in_order))
    # up to the rest, and the document beyond it if that ends nearer
    nearer = F.col("sum") - F.col("rest") < F.col("rest") - (F.col("sum") - F.col("size"))
    cut = cut.withColumn("chosen", (F.col("sum") <= F.col("rest")) | nearer).drop("sum")
    times = F.col("epochs") + F.col("chosen").cast("long")
    return whole.unionByName(cut).select(
        "doc_id", "source", "text_hash", "size", "source_size", "target", (F.col("size") * times).alias("taken"), times.alias("times")
    )
