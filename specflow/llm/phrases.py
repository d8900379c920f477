"""Phrase collocation mining: phrases of two to four words counted in HAT-tries of word ids, scored, and thinned out.

Texts are lower-cased (A-Z only) and split at ``[.,;:!?\\x0A-\\x0D]`` into pieces, those at spaces and tabs into words.
A word's id is a 64-bit hash of it and its language; ids are checked over the whole vocabulary, and drawn anew with
another seed should two words share one, so they name words exactly.

Counting goes by length, as a phrase is no more frequent than its parts: words, pairs of words that may be frequent,
then longer phrases all of whose pairs may be. "May be" is a Bloom filter of a bounded size, which refuses none.

In a task, phrases go into a HAT-trie: a shallow trie over the digits of the word ids, whose leaves are containers of
phrases kept by hash, equal ones as one with a count. A container that grows too large is burst into one for each
next digit. When the trie holds too many phrases, its largest subtree is spilled whole, as a run sorted by word ids.
Spark deals the runs out by the phrases' words, a hot first word over many partitions, and merges them there by summing.

Scores are exact: sums and products are decimals of 38 digits.

Defined results: a null or empty text has no words; a null language is ``und``; repeated rows count repeatedly; rows
without an id count like others; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from specflow.llm.arrays import _BYTE_CODES, mix, slices, span_hashes, text_bytes
from specflow.llm.filters import block_of, blocks_for, contains, filter_of
from specflow.llm.tables import written

LEAST = 30
LONGEST = 4
TOP = 2000
#: A phrase goes if a longer one has at least this share of its count (per cent).
COVERED = 80
#: A filter of frequent words or pairs has at most so many bytes.
FILTER_BYTES = 1 << 25
#: Phrases in a container before it is burst, phrases buffered before equal ones are made one, phrases in a task's trie.
BURST, BUFFERED, HELD = 1 << 16, 1 << 15, 1 << 19
_DIGIT = 4
#: Bytes of text that a task cuts into words at a time.
_SLICE = 1 << 20
#: Parts that a language's phrases are ranked in first, so that no task ranks all of them.
_PARTS_OF_LANGUAGE = 64
_SEEDS = 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK, _GAP = np.zeros(256, bool), np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP[[0x20, 0x09]] = True
_GAP |= _BREAK
UNKNOWN = "und"


def _language_codes(langs: pa.Array, seed: int) -> np.ndarray:
    coded = langs.fill_null(UNKNOWN).dictionary_encode()
    of = [xxhash.xxh3_64_intdigest(x.encode(), seed) for x in coded.dictionary.to_pylist()]
    return np.array(of, np.uint64)[coded.indices.to_numpy()] if of else np.zeros(0, np.uint64)


#: The columns of the vocabulary, and how many words a task holds before equal ones become one and go on.
_WORD = ["id", "lang", "word", "n"]
WORDS_HELD = 300_000


class _Text:
    """The words of some texts: ids, whether the next word follows in the same piece, and where they stand."""

    def __init__(self, rows: pa.RecordBatch, seed: int) -> None:
        raw, offsets = text_bytes(rows.column("text"))
        self.bytes = _LOWER[raw]
        solid = ~_GAP[self.bytes]
        edge = np.zeros(len(solid) + 1, bool)
        edge[offsets] = True
        begins, ends = solid.copy(), solid.copy()
        begins[1:] &= ~solid[:-1] | edge[1:-1]
        ends[:-1] &= ~solid[1:] | edge[1:-1]
        self.starts, self.stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.rows = np.searchsorted(offsets, self.starts, side="right") - 1
        hashes = span_hashes(_BYTE_CODES[self.bytes], self.starts, self.stops)
        self.ids = mix(hashes ^ _language_codes(rows.column("lang"), seed)[self.rows])
        breaks = np.zeros(len(solid) + 1, np.int32)
        np.cumsum(_BREAK[self.bytes], out=breaks[1:])
        self.joined = np.zeros(len(self.ids), bool)
        same = self.rows[1:] == self.rows[:-1]
        self.joined[:-1] = same & (breaks[self.starts[1:]] == breaks[self.stops[:-1]])


def _first_words(rows: pa.RecordBatch, seed: int) -> pa.Table:
    """id, lang, word, n of the words of some rows."""
    text = _Text(rows, seed)
    order = np.argsort(text.ids, kind="stable")
    ids = text.ids[order]
    heads = np.flatnonzero(np.append(True, ids[1:] != ids[:-1])) if len(ids) else np.zeros(0, np.int64)
    first, data = order[heads], text.bytes.tobytes()
    words = [data[s:e] for s, e in zip(text.starts[first].tolist(), text.stops[first].tolist(), strict=True)]
    langs = rows.column("lang").fill_null(UNKNOWN).take(pa.array(text.rows[first]))
    n = np.diff(np.append(heads, len(ids)))
    return pa.table([pa.array(ids[heads].view(np.int64)), langs, pa.array(words, pa.binary()).cast(pa.string()), pa.array(n)], _WORD)


def _vocabulary(seed: int):
    def merged(parts: list[pa.Table]) -> pa.Table:
        rows = pa.concat_tables(parts)
        ids = rows.column("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        heads = np.flatnonzero(np.append(True, np.diff(ids[order]) != 0))
        n = pa.array(np.add.reduceat(rows.column("n").to_numpy()[order], heads))
        # words that share an id within a task would hide here: they are told apart by their texts
        first = rows.take(pa.array(order[heads]))
        own = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(ids))))
        texts, expected = rows.column("word").take(pa.array(order)), first.column("word").take(pa.array(own))
        if not pc.all(pc.equal(texts, expected)).as_py():
            return rows
        return first.set_column(3, "n", n)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for piece in slices(batch, most=_SLICE):
                found = _first_words(piece, seed)
                if found.num_rows:
                    parts.append(found)
                    held += found.num_rows
                if held > WORDS_HELD:
                    yield from merged(parts).combine_chunks().to_batches(1 << 16)
                    parts, held = [], 0
        if parts:
            yield from merged(parts).combine_chunks().to_batches(1 << 16)

    return count


def vocabulary(docs: DataFrame) -> tuple[DataFrame, int]:
    """id, lang, word, n: every word with its count; and the seed under which no two words share an id."""
    rows = docs.select("text", "lang")
    for seed in range(_SEEDS):
        counted = rows.mapInArrow(_vocabulary(seed), "id long, lang string, word string, n long").repartition("id")
        words = written(counted.groupBy("id", "lang", "word").agg(F.sum("n").alias("n")), "phrases-words")
        if words.groupBy("id").count().filter("count > 1").isEmpty():
            return words, seed
    raise ArithmeticError("two words share an id under every seed")


class _Container:
    """Phrases kept by hash, equal ones as one with a count."""

    def __init__(self, depth: int) -> None:
        self.depth, self.size, self.buffered, self.parts = depth, 0, 0, []

    def add(self, phrases: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((phrases, counts))
        self.buffered += len(phrases)
        self.size += len(phrases)
        if self.buffered > max(BUFFERED, self.size // 2):
            self.fold()

    def fold(self) -> tuple[np.ndarray, np.ndarray]:
        """Equal phrases become neighbours by their hash, and one. Others with one hash may stay apart until the merge."""
        phrases = np.concatenate([p for p, _ in self.parts])
        counts = np.concatenate([c for _, c in self.parts])
        order = np.argsort(_hash(phrases), kind="stable")
        phrases, counts = phrases[order], counts[order]
        heads = np.flatnonzero(np.append(True, (phrases[1:] != phrases[:-1]).any(axis=1)))
        phrases, counts = phrases[heads], np.add.reduceat(counts, heads)
        self.parts, self.size, self.buffered = [(phrases, counts)], len(phrases), 0
        return phrases, counts


def _hash(phrases: np.ndarray) -> np.ndarray:
    found = phrases[:, 0]
    for i in range(1, phrases.shape[1]):
        found = mix(found + np.uint64(i)) ^ phrases[:, i]
    return mix(found)


class HatTrie:
    """Counts phrases of ``width`` word ids (zero where a phrase is shorter); gives sorted runs of whole subtrees."""

    def __init__(self, width: int) -> None:
        self.width, self.held = width, 0
        self.root: dict[int, object] = {}

    def _digit(self, phrases: np.ndarray, depth: int) -> np.ndarray:
        word, shift = divmod(depth * _DIGIT, 64)
        return (phrases[:, word] >> np.uint64(64 - _DIGIT - shift)).astype(np.int64) & ((1 << _DIGIT) - 1)

    def _into(self, node: dict, phrases: np.ndarray, counts: np.ndarray, depth: int) -> None:
        digit = self._digit(phrases, depth)
        order = np.argsort(digit.astype(np.uint8), kind="stable")
        ends = np.cumsum(np.bincount(digit, minlength=1 << _DIGIT))
        for d, (begin, end) in enumerate(zip(np.append(0, ends), ends, strict=False)):
            if begin == end:
                continue
            some, n = phrases[order[begin:end]], counts[order[begin:end]]
            child = node.setdefault(d, _Container(depth + 1))
            if isinstance(child, dict):
                self._into(child, some, n, depth + 1)
                continue
            before = child.size
            child.add(some, n)
            if child.size > BURST and (depth + 2) * _DIGIT <= 64 * self.width:
                child.fold()
                if child.size > BURST:
                    node[d] = {}
                    self.held -= before
                    self._into(node[d], *child.parts[0], depth + 1)
                    continue
            self.held += child.size - before

    def add(self, phrases: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Counts the phrases once each; gives the runs that had to make room."""
        for begin in range(0, len(phrases), HELD // 4):
            some = phrases[begin : begin + HELD // 4]
            self._into(self.root, some, np.ones(len(some), np.int64), 0)
            while self.held > HELD:
                yield from self._spill(max(self.root, key=lambda d: _size(self.root[d])))

    def _spill(self, digit: int) -> Iterator[pa.RecordBatch]:
        tree = self.root.pop(digit)
        self.held -= _size(tree)
        parts = [c.fold() for c in _containers(tree)]
        phrases, counts = np.concatenate([p for p, _ in parts]), np.concatenate([c for _, c in parts])
        order = np.lexsort(phrases.T[::-1])
        columns = [pa.array(phrases[order, i].view(np.int64)) for i in range(self.width)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(counts[order])], names=[*_IDS[: self.width], "n"])

    def rest(self) -> Iterator[pa.RecordBatch]:
        for digit in sorted(self.root):
            yield from self._spill(digit)


def _containers(tree) -> Iterator[_Container]:
    for child in tree.values() if isinstance(tree, dict) else ():
        yield from _containers(child)
    if isinstance(tree, _Container):
        yield tree


def _size(tree) -> int:
    return sum(c.size for c in _containers(tree))


_IDS = [f"c{i}" for i in range(1, LONGEST + 1)]


def _pairs(seed: int, frequent):
    """Pairs of words that may be frequent."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, table = HatTrie(2), frequent.value
        for batch in batches:
            for piece in slices(batch, most=_SLICE):
                text = _Text(piece, seed)
                fits = contains(table, text.ids)
                fits[:-1] &= fits[1:] & text.joined[:-1]
                at = np.flatnonzero(fits[:-1])
                yield from trie.add(np.stack([text.ids[at], text.ids[at + 1]], axis=1))
        yield from trie.rest()

    return count


def _longer(seed: int, longest: int, frequent):
    """Phrases of three words and more, all pairs of which may be frequent."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, table = HatTrie(longest), frequent.value
        for batch in batches:
            for piece in slices(batch, most=_SLICE):
                text = _Text(piece, seed)
                at = np.flatnonzero(text.joined)
                fits = np.zeros(len(text.ids), bool)
                fits[at] = contains(table, _hash(np.stack([text.ids[at], text.ids[at + 1]], axis=1)))
                at = np.flatnonzero(fits)
                for n in range(3, longest + 1):
                    at = at[fits[np.minimum(at + n - 2, len(fits) - 1)] & (at + n - 2 < len(fits))]
                    phrases = np.zeros((len(at), longest), np.uint64)
                    for i in range(n):
                        phrases[:, i] = text.ids[at + i]
                    yield from trie.add(phrases)
        yield from trie.rest()

    return count


def _merged(runs: DataFrame, least: int, width: int) -> DataFrame:
    """The runs merged: c1 to c4 (zero where shorter) and a, of the phrases that are frequent."""
    # the tries have summed already: a sum before the shuffle would only hold the same phrases once more
    dealt = runs.repartition(*_IDS[:width])
    sums = dealt.groupBy(*_IDS[:width]).agg(F.sum("n").alias("a")).filter(F.col("a") >= least)
    return sums.select(*(F.col(c) if i < width else F.lit(0).cast("long").alias(c) for i, c in enumerate(_IDS)), "a")


def _filter(spark, hashes: DataFrame, most_bytes: int):
    keys = hashes.count()
    n_blocks = blocks_for(keys, most_bytes)

    def placed(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        columns = [batch.column(i).to_numpy().view(np.uint64) for i in range(batch.num_columns)]
        key = columns[0] if len(columns) == 1 else _hash(np.stack(columns, axis=1))
        return key, block_of(key, n_blocks)

    return spark.sparkContext.broadcast(filter_of(hashes, n_blocks, placed))


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, filter_bytes: int = FILTER_BYTES) -> tuple[DataFrame, DataFrame]:
    """The vocabulary (id, lang, word, n), and the phrases of one to ``longest`` words (c1 to c4, len, a) found so often."""
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"phrases have two to {LONGEST} words")
    spark, rows = docs.sparkSession, docs.select("text", "lang")
    words, seed = vocabulary(docs)
    often = words.filter(F.col("n") >= least)
    one = _filter(spark, often.select("id"), filter_bytes)
    ids = ", ".join(f"{c} long" for c in _IDS[:2])
    pairs = written(_merged(rows.mapInArrow(_pairs(seed, one), f"{ids}, n long"), least, 2), "phrases-pairs")
    zeros = [F.lit(0).cast("long").alias(c) for c in _IDS[1:]]
    found = often.select(F.col("id").alias("c1"), *zeros, F.col("n").alias("a"), F.lit(1).alias("len"))
    # an id of zero names no word before the last word of a phrase, so a phrase's length is where its ids end
    length = sum(((F.col(c) != 0).cast("int") for c in _IDS[2:]), F.lit(2))
    if longest > 2:
        two = _filter(spark, pairs.select("c1", "c2"), filter_bytes)
        ids = ", ".join(f"{c} long" for c in _IDS[:longest])
        longer = rows.mapInArrow(_longer(seed, longest, two), f"{ids}, n long")
        longer = written(_merged(longer, least, longest), "phrases-longer")
        pairs = pairs.unionByName(longer)
    return words, found.unionByName(pairs.withColumn("len", length))


def _part(begin: int, end: int) -> list[Column]:
    """The ids of the words from ``begin`` to ``end`` as the key of a phrase."""
    return [(F.col(_IDS[begin + i]) if begin + i < end else F.lit(0).cast("long")).alias(f"p{i + 1}") for i in range(LONGEST)]


_PARTS = [f"p{i}" for i in range(1, LONGEST + 1)]


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, covered: int = COVERED, top: int = TOP, filter_bytes: int = FILTER_BYTES
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language.

    a is the phrase's count, l and r those of its two parts at its worst cut (the first of equals), n the language's
    words, score floor(2000000 * a / (l + r)). A phrase within a longer one that has ``covered`` per cent of its count goes.
    """
    words, found = frequent_phrases(docs, least, longest, filter_bytes)
    found = written(found, "phrases-found")
    phrases = found.filter("len > 1")

    def parts(of: int, spans: list[tuple[int, int]], *more) -> DataFrame:
        wanted = F.explode(F.array(*(F.struct(F.lit(k).alias("part"), *_part(b, e)) for k, (b, e) in enumerate(spans))))
        return phrases.filter(F.col("len") == of).select(*_IDS, "a", *more, wanted.alias("p")).select(*_IDS, "a", *more, "p.*")

    # parts 0, 2, 4 are the first words of the cuts, 1, 3, 5 the rest
    cuts = None
    for n in range(2, longest + 1):
        own = parts(n, [span for k in range(1, n) for span in ((0, k), (k, n))], "len")
        cuts = own if cuts is None else cuts.unionByName(own)
    counts = found.select(*(F.col(c).alias(f"f{c}") for c in _IDS), F.col("a").alias("f"))
    # a part is a phrase whose ids match and which is as long: ids past its end are zero in both
    met = cuts.join(counts.hint("merge"), [F.col(p) == F.col(f"f{c}") for p, c in zip(_PARTS, _IDS, strict=True)])
    sums = [F.max(F.when(F.col("part") == k, F.col("f"))).alias(f"f{k}") for k in range(2 * (longest - 1))]
    cut = met.groupBy(*_IDS, "a", "len").agg(*sums)
    scored = []
    for k in range(longest - 1):
        both = F.expr(f"cast(f{2 * k} as decimal(20, 0)) + cast(f{2 * k + 1} as decimal(20, 0))")
        score = F.expr(f"(cast(2000000 as decimal(8, 0)) * cast(a as decimal(20, 0))) div (cast(f{2 * k} as decimal(20, 0)) + cast(f{2 * k + 1} as decimal(20, 0)))")
        scored.append(F.when(both.isNotNull(), F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"f{2 * k}").alias("l"), F.col(f"f{2 * k + 1}").alias("r"))))
    worst = cut.select(*_IDS, "a", "len", (F.least(*scored) if len(scored) > 1 else scored[0]).alias("w"))
    if longest > 2:
        inner = None
        for n in range(3, longest + 1):
            own = parts(n, [(b, b + m) for m in range(2, n) for b in range(n - m + 1)])
            inner = own if inner is None else inner.unionByName(own)
        within = inner.groupBy(*_PARTS).agg(F.max("a").alias("longer"))
        goes = F.expr(f"cast(100 as decimal(4, 0)) * cast(longer as decimal(20, 0)) >= cast({int(covered)} as decimal(10, 0)) * cast(a as decimal(20, 0))")
        joined = worst.join(within, [F.col(c) == F.col(p) for c, p in zip(_IDS, _PARTS, strict=True)], "left")
        worst = joined.filter(F.col("longer").isNull() | ~goes).drop(*_PARTS, "longer")
    often = words.filter(F.col("n") >= least).select("id", "lang", "word")
    lang = worst.join(often.select("id", "lang").hint("merge"), F.col("c1") == F.col("id")).drop("id")
    # ties at the last place stay until the phrases' texts are there
    part = F.pmod(F.xxhash64(*_IDS), F.lit(_PARTS_OF_LANGUAGE))
    for own in (["lang", "part"], ["lang"]):
        best = W.partitionBy(*own).orderBy(F.col("w.score").desc(), F.col("a").desc())
        lang = lang.withColumn("part", part).withColumn("place", F.rank().over(best)).filter(F.col("place") <= top).drop("place", "part")
    ids = F.posexplode(F.filter(F.array(*_IDS), lambda x: x != 0)).alias("i", "id")
    named = lang.select(*_IDS, "lang", "a", "w", ids).join(often.select("id", "word").hint("merge"), "id")
    texts = named.groupBy(*_IDS, "lang", "a", "w").agg(F.sort_array(F.collect_list(F.struct("i", "word"))).alias("words"))
    phrase = F.concat_ws(" ", F.col("words.word")).alias("phrase")
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    full = texts.select("lang", phrase, "a", F.col("w.l").alias("l"), F.col("w.r").alias("r"), F.col("w.score").alias("score"))
    best = W.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = full.withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
