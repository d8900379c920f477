"""MinHash near-dedup: improved consistent weighted sampling over TF-IDF shingles, banded, verified.

A document is the weighted set of its runs of five words (all its words, if it has fewer). A shingle weighs
its count times 1 + ``IDF_SHARE`` * idf, where idf goes from 0 for a shingle in every document to 1 for one in at
most ``COMMON`` of them. Frequencies are counted over all documents in a fixed number of hashed columns, whose
number bounds what is sent to tasks; only columns above that share matter, so collisions rarely do.

Improved consistent weighted sampling draws, for each hash function, one shingle with a level of its weight; two
documents draw the same with the probability of their weighted Jaccard similarity. ``ROWS`` draws make a band's key,
and two documents are candidates if one of ``BANDS`` keys agrees. The random numbers of a shingle come from a table
of 65,536 draws by its hash.

Candidates are verified: weighted Jaccard similarity of the whole texts of at least ``SIMILARITY`` is a link, and a
class is what links connect. Documents with equal words are one text from the start and need no pairs. In a bucket
every text is first compared with one member drawn by hash, another in each band, so a large group of near copies
becomes one class from pairs in proportion to its size. What is left are buckets that still hold several classes.
Those of at most ``SMALL`` members are compared in full. The others are groups of texts that are mostly somewhat
alike; their members are banded anew with ``FINE_BANDS`` keys of ``FINE_ROWS`` draws, which part texts under the
similarity far better and join those above it as surely (a pair at the similarity is missed by all bands with a
probability of about one in a thousand), and the buckets of these bands are compared in full where they hold several
classes.

Comparing a bucket in full is one task's work on texts that it holds together: those outside the bucket's largest
class against all of other classes. Only links that join classes leave the task, no pairs. A bucket of more than
``BLOCK`` texts, or of texts that weigh more than ``BLOCK_WEIGHT`` together (about as many words), is dealt out as pairs
of blocks, so no task holds more than about two blocks, and there is no cap. What is known of a bucket is written before
its members are joined with it, so that Spark can split a large one.

Defined results: null and blank texts have no shingles and are alone in their classes; rows alike in id and
text are in one class; rows without an id are classed by their text, and a class of them alone has a null id; a
class is named by its smallest id; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specflow.llm.arrays import Words, mix, run_hashes, slices, words_of
from specflow.llm.tables import written

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 12
ROWS = 3
SMALL = 8
FINE_BANDS = 60
FINE_ROWS = 10
BLOCK = 1_000
BLOCK_WEIGHT = 2_000_000
COMMON = 1e-3
IDF_SHARE = 0.25
_COLUMN_BITS = 22
_CHUNK_BITS = 12
_DRAWS = 1 << 16


def _shingles(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, shingle and count of each distinct shingle of each text, in that order."""
    runs = run_hashes(words.codes, SHINGLE)
    starts = np.flatnonzero(words.runs_from(SHINGLE))
    owner, found = words.texts[starts], runs[starts]
    short = np.flatnonzero((words.counts > 0) & (words.counts < SHINGLE))
    if len(short):
        owner, found = np.append(owner, short), np.append(found, words.wholes[short])
    order = np.lexsort((found, owner))
    owner, found = owner[order], found[order]
    first = np.ones(len(found), bool)
    first[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    heads = np.flatnonzero(first)
    return owner[heads], found[heads], np.diff(np.append(heads, len(found)))


def _column_of(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - _COLUMN_BITS)).astype(np.int64)


def _column_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's document frequency of every column, in chunks; chunk -1 has the number of documents."""
    counts = np.zeros(1 << _COLUMN_BITS, np.int32)
    documents = 0
    for batch in batches:
        for piece in slices(batch):
            _, shingles, _ = _shingles(words_of(piece.column("text")))
            np.add.at(counts, _column_of(shingles), 1)
            documents += piece.num_rows
    chunks = [x.tobytes() for x in counts.reshape(-1, 1 << _CHUNK_BITS)]
    numbers = [*range(len(chunks)), -1]
    chunks.append(np.array([documents], np.int32).tobytes())
    yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(chunks, pa.binary())], names=["chunk", "counts"])


def _column_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chunks' sums, as the columns that have any; chunks of one number come one after the other."""
    number, total = None, np.zeros(0, np.int64)

    def out() -> pa.RecordBatch:
        at = np.flatnonzero(total)
        columns = (number << _CHUNK_BITS) + at if number >= 0 else np.full(len(at), -1)
        return pa.RecordBatch.from_pydict({"column": columns.astype(np.int64), "n": total[at]})

    for batch in batches:
        for chunk, counts in zip(batch.column("chunk").to_pylist(), batch.column("counts"), strict=True):
            part = np.frombuffer(counts.as_buffer(), np.int32).astype(np.int64)
            if chunk == number:
                total += part
            else:
                if number is not None:
                    yield out()
                number, total = chunk, part
    if number is not None:
        yield out()


class Weights:
    """What a shingle's column says about its weight: 1 + IDF_SHARE unless it is common."""

    def __init__(self, columns: np.ndarray, counts: np.ndarray, documents: int) -> None:
        inverse = np.log(documents / np.minimum(counts, documents)) / np.log(1 / COMMON)
        self.columns = columns
        self.weights = 1 + IDF_SHARE * np.clip(inverse, 0, 1)

    def __call__(self, shingles: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weights = np.full(len(shingles), 1 + IDF_SHARE)
        if len(self.columns):
            wanted = _column_of(shingles)
            at = np.minimum(np.searchsorted(self.columns, wanted), len(self.columns) - 1)
            weights = np.where(self.columns[at] == wanted, self.weights[at], weights)
        return weights * counts


def weights_of(docs: DataFrame) -> Weights:
    """Counted over all documents; the columns that reach the driver are at most the mean number of shingles over COMMON."""
    counted = docs.select("text").mapInArrow(_column_counts, "chunk int, counts binary")
    sums = counted.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_column_sums, "column long, n long")
    sums = written(sums, "frequencies")
    documents = sums.filter("column = -1").head()
    if not documents:
        return Weights(np.zeros(0, np.int64), np.ones(0), 1)
    # as Arrow: a row each of Python's own takes ten times the memory
    common = sums.filter((F.col("column") >= 0) & (F.col("n") > COMMON * documents["n"])).toArrow()
    columns, counts = (common.column(name).to_numpy() for name in ("column", "n"))
    order = np.argsort(columns)
    return Weights(columns[order], counts[order].astype(float), documents["n"])


@cache
def _draws() -> tuple[np.ndarray, ...]:
    """r and c of the gamma distribution with shape 2, and beta uniform; as r, log(c), beta.

    And what follows from them for the weight that most shingles have: level and rank.
    """
    random = np.random.default_rng(20_100_613)
    r, log_c, beta = random.gamma(2, 1, _DRAWS), np.log(random.gamma(2, 1, _DRAWS)), random.random(_DRAWS)
    level, rank = _level_and_rank(np.log(1 + IDF_SHARE), r, log_c, beta)
    return r, log_c, beta, level, rank


def _level_and_rank(log_weight, r: np.ndarray, log_c: np.ndarray, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The level of the weight under these draws, and the logarithm of what the least of wins."""
    level = np.floor(log_weight / r + beta)
    return level.astype(np.int64), log_c - r * (level - beta + 1)


def band_keys(
    owner: np.ndarray, shingles: np.ndarray, weights: np.ndarray, bands: int = BANDS, rows: int = ROWS, first: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """The texts that have shingles, and the keys of their bands (one row for each text).

    ``first`` is the number of the first hash function used.
    """
    heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, np.int64)
    if not len(heads):
        return heads, np.zeros((0, bands), np.uint64)
    sizes = np.diff(np.append(heads, len(owner)))
    r, log_c, beta, usual_level, usual_rank = _draws()
    other = np.flatnonzero(weights != 1 + IDF_SHARE)
    log_other = np.log(weights[other])
    keys = np.empty((len(heads), bands), np.uint64)
    odd = mix(np.arange(first + 1, first + bands * rows + 1, dtype=np.uint64)) | np.uint64(1)
    for band in range(bands):
        key = np.full(len(heads), first + band, np.uint64)
        for row in range(rows):
            # shingles are hashes already; the high bits of a product with an odd number choose the draw
            draw = (shingles * odd[band * rows + row]) >> np.uint64(48)
            rank = usual_rank[draw]
            level_of_other, rank[other] = _level_and_rank(log_other, *(x[draw[other]] for x in (r, log_c, beta)))
            least = np.flatnonzero(rank == np.repeat(np.minimum.reduceat(rank, heads), sizes))
            # the first of equal ranks; shingles are in order
            chosen = least[np.searchsorted(least, heads)]
            level = usual_level[draw[chosen]]
            at = np.minimum(np.searchsorted(other, chosen), max(0, len(other) - 1))
            if len(other):
                level = np.where(other[at] == chosen, level_of_other[at], level)
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + mix(shingles[chosen] ^ (level.view(np.uint64) << np.uint64(1))))
        keys[:, band] = key
    return owner[heads], keys


_SIGNED = "doc_id long, hash long, words long, weight double, bands array<long>"


def _sign(weights):
    """Of each document the hash that names its words, its total weight and the keys of its bands; null if it has no words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh = weights.value
        for batch in batches:
            for piece in slices(batch):
                words = words_of(piece.column("text"))
                owner, shingles, counts = _shingles(words)
                weight = weigh(shingles, counts)
                texts, keys = band_keys(owner, shingles, weight)
                blank = words.counts == 0
                ends = np.zeros(piece.num_rows + 1, np.int32)
                ends[texts + 1] = BANDS
                bands = pa.ListArray.from_arrays(pa.array(np.cumsum(ends, dtype=np.int32)), pa.array(keys.reshape(-1).view(np.int64)))
                columns = {
                    "doc_id": piece.column("doc_id"),
                    "hash": piece.column("hash"),
                    "words": pa.array(words.wholes.view(np.int64), mask=blank),
                    "weight": pa.array(np.bincount(owner, weight, minlength=piece.num_rows), mask=blank),
                    "bands": bands,
                }
                yield pa.RecordBatch.from_pydict(columns)

    return sign


_FINE = "words long, weight double, bands array<long>"


def _sign_finely(weights):
    """The finer bands of texts that have words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh = weights.value
        for batch in batches:
            for piece in slices(batch):
                owner, shingles, counts = _shingles(words_of(piece.column("text")))
                weight = weigh(shingles, counts)
                texts, keys = band_keys(owner, shingles, weight, FINE_BANDS, FINE_ROWS, first=BANDS * ROWS)
                ends = pa.array(np.arange(0, keys.size + 1, FINE_BANDS, dtype=np.int32))
                columns = {
                    "words": piece.column("words").take(pa.array(texts)),
                    "weight": pa.array(np.bincount(owner, weight, minlength=piece.num_rows)[texts]),
                    "bands": pa.ListArray.from_arrays(ends, pa.array(keys.reshape(-1).view(np.int64))),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return sign


def _similarities(weights):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh = weights.value
        for batch in batches:
            for piece in slices(batch, "a_text", 1 << 20):
                sides = []
                for column in ("a_text", "b_text"):
                    owner, shingles, counts = _shingles(words_of(piece.column(column)))
                    sides.append((owner, shingles, weigh(shingles, counts)))
                owner, shingles, weight = (np.concatenate(x) for x in zip(*sides, strict=True))
                order = np.lexsort((shingles, owner))
                owner, shingles, weight = owner[order], shingles[order], weight[order]
                both = np.flatnonzero((owner[1:] == owner[:-1]) & (shingles[1:] == shingles[:-1]))
                n = piece.num_rows
                shared = np.bincount(owner[both], np.minimum(weight[both], weight[both + 1]), minlength=n)
                total = np.bincount(owner, weight, minlength=n)
                similarity = shared / np.maximum(total - shared, 1e-300)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("a"), piece.column("b"), pa.array(similarity)], names=["a", "b", "similarity"]
                )

    return compare


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and class (its smallest node) of all nodes that links join.

    Labels fall to the least of the neighbours', then to the label's own label, until none changes; each round is a
    join and a sum over the links, with nothing on the driver but the count of changes.
    """
    edges = links.select(F.col(a).alias("x"), F.col(b).alias("y"))
    edges = written(edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct(), "edges")
    labels = written(edges.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.first("x")).alias("class")), "labels")
    while True:
        near = edges.join(labels, F.col("y") == F.col("node")).groupBy(F.col("x").alias("node")).agg(F.min("class").alias("near"))
        lower = labels.join(near, "node").withColumn("to", F.least("class", "near"))
        onto = labels.select(F.col("node").alias("to"), F.col("class").alias("onto"))
        lower = lower.join(onto, "to", "left")
        after = lower.select("node", F.least("to", F.coalesce("onto", "to")).alias("class"), F.col("class").alias("was"))
        after = written(after, "labels")
        labels = after.select("node", "class")
        if after.filter(F.col("class") != F.col("was")).isEmpty():
            return labels


def _class_of(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs a, b with the classes a_class and b_class; a text in no class is one by itself."""
    for side in ("a", "b"):
        named = classes.select(F.col("node").alias(side), F.col("class").alias(f"{side}_class"))
        pairs = pairs.join(named, side, "left").withColumn(f"{side}_class", F.coalesce(f"{side}_class", side))
    return pairs


def _merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """node and class after more links; only links between classes are followed, each once."""
    across = _class_of(links.select("a", "b"), classes).filter("a_class <> b_class").select("a_class", "b_class").distinct()
    across = written(across, "links")
    if across.isEmpty():
        return classes
    onto = connected(across, "a_class", "b_class").select(F.col("node").alias("old"), F.col("class").alias("new"))
    moved = classes.join(onto, F.col("class") == F.col("old"), "left").select("node", F.coalesce("new", "class").alias("class"))
    joined = onto.join(classes, F.col("old") == F.col("node"), "left_anti").select(F.col("old").alias("node"), F.col("new").alias("class"))
    return written(moved.unionByName(joined), "labels")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (the smallest id of its class), class_size, kept (the row that stays), text_hash of every document."""
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("hash"))
    weights = docs.sparkSession.sparkContext.broadcast(weights_of(rows))
    signed = written(rows.mapInArrow(_sign(weights), _SIGNED), "signatures")
    # one node for each text: its words' hash names it
    texts = signed.filter(F.col("words").isNotNull()).groupBy("words")
    texts = texts.agg(F.first("bands").alias("bands"), F.first("weight").alias("weight"))
    members = _buckets(texts)
    candidates = _texts_of(rows, signed, members.select("words").distinct())
    verified = written(_verify(_stars(members, similarity), candidates, weights), "verified")
    classes = connected(verified.filter(F.col("similarity") >= similarity))
    unresolved = _unresolved(members, classes)
    large = unresolved.filter(F.col("n") > SMALL).select("words").distinct()
    small = _within(unresolved.filter(F.col("n") <= SMALL), candidates, weights, similarity)
    classes = _merged(classes, written(small, "links"))
    finely = candidates.join(large, "words", "left_semi").mapInArrow(_sign_finely(weights), _FINE)
    fine = _buckets(written(finely, "signatures"))
    classes = _merged(classes, written(_within(_unresolved(fine, classes), candidates, weights, similarity), "links"))
    return _by_document(signed, classes)


def _buckets(texts: DataFrame) -> DataFrame:
    """words, weight, band, key for each text in each bucket that holds several, with the bucket's size n, heft and hub.

    From words, weight and bands of the texts.
    """
    members = texts.select("words", "weight", F.posexplode("bands").alias("band", "key"))
    drawn = F.min(F.struct(F.xxhash64("words", "band").alias("drawn"), "words", "weight"))
    buckets = members.groupBy("band", "key").agg(drawn.alias("hub"), F.count("*").alias("n"), F.sum("weight").alias("heft")).filter("n > 1")
    buckets = buckets.select("band", "key", "n", "heft", F.col("hub.words").alias("hub"), F.col("hub.weight").alias("hub_weight"))
    # written, so that Spark can split the join at a large bucket
    return written(members.join(written(buckets, "hubs"), ["band", "key"]), "buckets")


def _stars(members: DataFrame, similarity: float) -> DataFrame:
    """The pairs a, b of each member with its bucket's hub that the ratio of their weights leaves possible."""
    ratio = F.least("weight", "hub_weight") >= similarity * F.greatest("weight", "hub_weight")
    pairs = members.filter((F.col("words") != F.col("hub")) & ratio)
    return pairs.select(F.least("words", "hub").alias("a"), F.greatest("words", "hub").alias("b")).distinct()


def _texts_of(rows: DataFrame, signed: DataFrame, wanted: DataFrame) -> DataFrame:
    """words and text of the wanted texts, each once."""
    holder = F.min(F.struct("doc_id", "hash")).alias("holder")
    # one holder of equal texts before they meet, however many there are
    holders = signed.filter(F.col("words").isNotNull()).groupBy("words").agg(holder).join(wanted, "words", "left_semi").select("words", "holder.*")
    same = F.col("r.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("r.hash") == F.col("h.hash"))
    found = rows.alias("r").join(holders.alias("h"), same).select("words", "text")
    return written(found.dropDuplicates(["words"]), "candidates")


def _verify(pairs: DataFrame, candidates: DataFrame, weights) -> DataFrame:
    """a, b, similarity of the pairs."""
    a = candidates.select(F.col("words").alias("a"), F.col("text").alias("a_text"))
    b = candidates.select(F.col("words").alias("b"), F.col("text").alias("b_text"))
    whole = pairs.join(a, "a").join(b, "b").select("a", "b", "a_text", "b_text")
    return whole.mapInArrow(_similarities(weights), "a long, b long, similarity double")


def _unresolved(members: DataFrame, classes: DataFrame) -> DataFrame:
    """The members of buckets that hold several classes, with their class and whether it is their bucket's largest (main)."""
    known = members.join(classes.withColumnRenamed("node", "words"), "words", "left")
    known = known.withColumn("class", F.coalesce("class", "words"))
    known = written(known, "known")
    sizes = known.groupBy("band", "key", "class").agg(F.count("*").alias("members"))
    several = sizes.groupBy("band", "key").agg(F.count("*").alias("classes"), F.max(F.struct("members", "class")).alias("most"))
    several = several.filter("classes > 1").select("band", "key", F.col("most.class").alias("largest"))
    # written, so that Spark can split the join at a large bucket
    known = known.join(written(several, "several"), ["band", "key"]).withColumn("main", F.col("class") == F.col("largest"))
    return written(known.select("band", "key", "n", "heft", "words", "weight", "class", "main"), "unresolved")


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _links_within(weights, similarity: float):
    """Of texts held together, links that join classes, enough of them to connect what is similar."""

    def compare(group: pa.Table) -> pa.Table:
        names, classes, main = (group.column(c).to_numpy() for c in ("words", "class", "main"))
        owner, shingles, counts = _shingles(words_of(group.column("text").combine_chunks()))
        weight = weights.value(shingles, counts)
        totals = np.bincount(owner, weight, minlength=len(names))
        offsets = np.searchsorted(owner, np.arange(len(names) + 1))
        _, column = np.unique(shingles, return_inverse=True)
        own = np.zeros(column.max() + 1 if len(column) else 0)
        # labels of classes joined so far in this group
        _, label = np.unique(classes, return_inverse=True)
        links = []
        for i in np.flatnonzero(~main):
            mine = slice(offsets[i], offsets[i + 1])
            own[column[mine]] = weight[mine]
            shared = np.bincount(owner, np.minimum(own[column], weight), minlength=len(names))
            own[column[mine]] = 0
            near = shared >= similarity * (totals + totals[i] - shared)
            near[i] = False
            for j in np.flatnonzero(near):
                if label[i] != label[j]:
                    links.append((names[i], names[j]))
                    label[label == label[j]] = label[i]
        return pa.Table.from_pydict({"a": [a for a, _ in links], "b": [b for _, b in links]}, schema=_LINKS)

    return compare


def _within(unresolved: DataFrame, candidates: DataFrame, weights, similarity: float) -> DataFrame:
    """Links a, b between texts of different classes in one bucket, each bucket compared in full.

    A large bucket's members are in blocks by hash, and each two blocks (one with itself too) are a group.
    """
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("heft") / BLOCK_WEIGHT))
    own = F.pmod(F.xxhash64("words"), blocks)
    dealt = unresolved.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    dealt = dealt.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
    held = dealt.select("band", "key", "low", "high", "words", "class", "main").join(candidates, "words")
    return held.groupBy("band", "key", "low", "high").applyInArrow(_links_within(weights, similarity), "a long, b long")


def _by_document(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """One row for each document, from its words' class; a document without words is a class by itself."""
    # rows alike in id and text are one row with a number until the end
    rows = signed.groupBy("doc_id", "words", "hash").agg(F.count("*").alias("n"))
    rows = rows.join(classes.withColumnRenamed("node", "words"), "words", "left").withColumn("class", F.coalesce("class", "words"))
    # nulls come last: a row without an id doesn't stay if another can
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "words", "hash")).alias("first")
    names = rows.filter(F.col("class").isNotNull()).groupBy("class").agg(first, F.sum("n").alias("class_size"))
    # written, so that Spark can split the join at a large class
    joined = rows.join(written(names, "classes"), "class", "left").withColumn("number", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    alone = F.col("class").isNull()
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("words") == F.col("first.words"))
    stays &= (F.col("hash") == F.col("first.hash")) & (F.col("number") == 1)
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        F.when(alone, 1).otherwise(F.col("class_size")).cast("long").alias("class_size"),
        F.when(alone, True).otherwise(stays).alias("kept"),
        F.col("hash").alias("text_hash"),
    )
