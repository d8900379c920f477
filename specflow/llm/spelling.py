"""Spelling variant grouping: words one edit apart, found by probing generated edits against Bloom filters.

Words are counted in tasks first, then by Spark. The vocabulary's words are put into a blocked Bloom filter with one
shard for each word length, which is broadcast. Every word then tries its neighbourhood: each deletion of a code point,
each replacement by a greater letter (a lesser one is found from the other word, as is each insertion, which is the
other word's deletion). An edit costs a few operations on the word's hash; its text is never made. Only edits that the
shard of their length may hold travel, as pairs of hashes, to the exact join with the vocabulary, where both words are
compared and false positives go.

The filter's bytes are bounded. A vocabulary that needs more is dealt into parts by hash, and every part is broadcast
and probed by itself, so nothing that is broadcast grows with the data.

A word's form is its most frequent neighbour if that is ``ratio`` times as frequent as the word. Forms are followed by
doubling: after k joins, 2^k steps. Counts grow ``ratio``-fold at each step, so 64-bit counts allow no long chains.

Defined results: a null text has no words; a missing id is written as nothing in a run's hash (``:run``); repeated rows
count repeatedly; extra columns are ignored; an empty table gives no rows. Words of any length are kept, as whole texts
may be one run.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specflow.llm.arrays import mix
from specflow.llm.filters import BITS_A_KEY, BLOCK_WORDS, block_of, blocks_for, contains, filter_of
from specflow.llm.tables import written

SHORTEST, LEAST, RATIO, DELETES = 6, 5, 5, 199
#: Bytes of the filter that is broadcast at a time.
FILTER_BYTES = 1 << 25
#: Words of this length and longer share the last shard.
LONGEST_SHARD = 63
#: Words that a task counts before it hands them on, and edits that it probes at a time.
_COUNTED, _PROBED = 400_000, 1 << 18
_TEXT_BYTES = 1 << 22

#: The letters that words are made of, a to z and U+00C0 to U+00FF, by code point.
LETTERS = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)], np.uint32)
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf]){%d,}" % SHORTEST)

_STEP = 0x9E3779B97F4A7C15
_INVERSE = np.uint64(pow(_STEP, -1, 1 << 64))
_CODES = mix(np.arange(1, 0x101, dtype=np.uint64) * np.uint64(_STEP))


def _shortened(run: bytes, start: int, deletes: int) -> bytes:
    """The run, without one of its code points if its hash says so; ``start`` is the crc32 of what stands before it."""
    h = zlib.crc32(run, start)
    if h % deletes:
        return run
    word = run.decode()
    at = h % len(word)
    return (word[:at] + word[at + 1 :]).encode()


def _counted(deletes: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def handed_on() -> pa.RecordBatch:
            words = pa.array(list(total), pa.binary()).cast(pa.string())
            found = pa.RecordBatch.from_pydict({"word": words, "n": pa.array(list(total.values()), pa.int64())})
            total.clear()
            return found

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                if (buffer := text.as_buffer()) is None:
                    continue
                start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                data = buffer.to_pybytes().lower()  # of bytes: A-Z only
                # a very long text is counted in parts; what a run becomes depends on the run alone
                runs = iter(_RUN.findall(data)) if len(data) <= _TEXT_BYTES else (m.group() for m in _RUN.finditer(data))
                while some := Counter(islice(runs, _COUNTED)):
                    for run, n in some.items():
                        total[_shortened(run, start, deletes)] += n
                    if len(total) > _COUNTED:
                        yield handed_on()
        if total:
            yield handed_on()

    return count


def words_of(docs: DataFrame, deletes: int = DELETES, least: int = LEAST) -> DataFrame:
    """word, n: the words of at least six code points that occur ``least`` times."""
    rows = docs.select("doc_id", "text").mapInArrow(_counted(deletes), "word string, n long")
    words = rows.groupBy("word").agg(F.sum("n").alias("n"))
    return words.filter((F.col("n") >= least) & (F.length("word") >= SHORTEST))


class _Letters:
    """Some words as flat code points, with sums of their hashes."""

    def __init__(self, words: pa.Array) -> None:
        self.points = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32)
        lengths = np.array([len(w) for w in words.to_pylist()], np.int64)
        self.offsets = np.append(0, np.cumsum(lengths))
        self.lengths = lengths
        self.word = np.repeat(np.arange(len(lengths)), lengths)
        self.place = np.arange(len(self.points)) - self.offsets[:-1][self.word]
        most = int(lengths.max(initial=0)) + 1
        powers = np.full(most, _STEP, np.uint64)
        powers[0] = 1
        self.power = np.cumprod(powers)[self.place] if len(self.points) else np.zeros(0, np.uint64)
        self.terms = _CODES[self.points] * self.power
        sums = np.zeros(len(self.points) + 1, np.uint64)
        np.cumsum(self.terms, out=sums[1:])
        self.before = sums[:-1] - sums[self.offsets[:-1]][self.word]
        self.sums = sums[self.offsets[1:]] - sums[self.offsets[:-1]]


def _finished(sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return mix(sums + lengths.astype(np.uint64))


def word_keys(words: pa.Array) -> np.ndarray:
    letters = _Letters(words)
    return _finished(letters.sums, letters.lengths)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        key = pa.array(word_keys(batch.column("word")).view(np.int64))
        yield pa.RecordBatch.from_arrays([key, *batch.columns], names=["key", *batch.schema.names])


def _edits(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The words' deletions and replacements by greater letters: hash, length, and number of the word."""
    text = _Letters(words)
    # of equal neighbours only the first is deleted: the others give the same
    first = np.ones(len(text.points), bool)
    first[1:] = (text.points[1:] != text.points[:-1]) | (text.place[1:] == 0)
    at = np.flatnonzero(first)
    for begin in range(0, len(at), _PROBED):
        i = at[begin : begin + _PROBED]
        word = text.word[i]
        after = text.sums[word] - text.before[i] - text.terms[i]
        lengths = text.lengths[word] - 1
        yield _finished(text.before[i] + after * _INVERSE, lengths), lengths, word
    block = max(1, _PROBED // len(LETTERS))
    for begin in range(0, len(text.points), block):
        own = slice(begin, begin + block)
        i, letter = np.nonzero(text.points[own, None] < LETTERS[None, :])
        i = i + begin
        word = text.word[i]
        changed = text.sums[word] - text.terms[i] + _CODES[LETTERS[letter]] * text.power[i]
        yield _finished(changed, text.lengths[word]), text.lengths[word], word


class _Shards:
    """Where in the table each length's blocks are, and which part of the vocabulary the table has."""

    def __init__(self, counts: dict[int, int], part: int, parts: int) -> None:
        lengths = range(max(counts, default=0) + 1)
        sizes = [blocks_for(-(-counts.get(n, 0) // parts), 1 << 62) if n in counts else 0 for n in lengths]
        self.sizes = np.array([*sizes, 0], np.int64)
        self.begins = np.append(0, np.cumsum(self.sizes))[:-1]
        self.n_blocks, self.part, self.parts = int(self.sizes.sum()), part, parts

    def block(self, keys: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The key's block; -1 where the table has no shard of its length, or not the key's part of the vocabulary."""
        shard = np.minimum(np.minimum(lengths, LONGEST_SHARD), len(self.sizes) - 1)
        sizes = self.sizes[shard]
        inside = (sizes > 0) & (keys % np.uint64(self.parts) == self.part)
        return np.where(inside, self.begins[shard] + block_of(keys, sizes), -1)


def _placed(shards: _Shards):
    def place(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        keys = batch.column("key").to_numpy().view(np.uint64)
        return keys, shards.block(keys, batch.column("length").to_numpy().astype(np.int64))

    return place


def _probed(shards: _Shards, table):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("key").to_numpy()
            for begin in range(0, batch.num_rows, 2000):
                words = batch.column("word").slice(begin, 2000)
                for keys, lengths, word in _edits(words):
                    blocks = shards.block(keys, lengths)
                    there = np.flatnonzero(blocks >= 0)
                    there = there[contains(table.value, keys[there], blocks[there])]
                    if len(there):
                        columns = {"key": pa.array(own[begin + word[there]]), "near_key": pa.array(keys[there].view(np.int64))}
                        yield pa.RecordBatch.from_pydict(columns)

    return probe


def neighbours(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """key, near, near_n, word, n: each word with each word one edit away, both ways. ``words`` has key, word, n."""
    spark = words.sparkSession
    shard = F.least(F.length("word"), F.lit(LONGEST_SHARD)).alias("shard")
    counts = {r.shard: r.n for r in words.groupBy(shard).agg(F.count("*").alias("n")).collect()}
    parts = max(1, -(-sum(counts.values()) * BITS_A_KEY // (8 * filter_bytes)))
    found = None
    for part in range(parts):
        shards = _Shards(counts, part, parts)
        keys = words.select("key", F.length("word").alias("length"))
        table = spark.sparkContext.broadcast(filter_of(keys, max(1, shards.n_blocks), _placed(shards)))
        met = words.select("key", "word").mapInArrow(_probed(shards, table), "key long, near_key long")
        found = met if found is None else found.unionByName(met)
    near = words.select(F.col("key").alias("near_key"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    # false positives go at the first join already, but for words that share a hash
    met = written(found.join(near.hint("merge"), "near_key").drop("near_key"), "spelling-pairs")
    both = met.join(words.hint("merge"), "key").filter(F.levenshtein("word", "near", 1) == 1)
    return both.select("word", "n", "near", "near_n").unionByName(
        both.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    )


def variants(
    docs: DataFrame, least: int = LEAST, ratio: int = RATIO, deletes: int = DELETES, filter_bytes: int = FILTER_BYTES
) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word."""
    words = words_of(docs, deletes, least).mapInArrow(_keyed, "key long, word string, n long")
    words = written(words, "spelling-words")
    near = neighbours(words, filter_bytes).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best")
    )
    joined = words.select("word", "n").join(near, "word", "left")
    form_n = -F.col("best.minus")
    is_form = F.coalesce(form_n.cast("decimal(20,0)") >= F.col("n").cast("decimal(20,0)") * ratio, F.lit(False))
    forms = written(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, form_n).alias("form_n"),
        ),
        "spelling-forms",
    )
    # only words with a form can move; a word without one is its own root
    steps = forms.filter("form is not null").select("word", F.col("form").alias("root"))
    while not steps.isEmpty():
        follow = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if steps.join(follow, "root", "semi").isEmpty():
            break
        steps = written(steps.join(follow.hint("merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
    rooted = forms.join(steps, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
