"""Token counts by rank-synchronous array merging.

The vocabulary file gives the merges of a byte-pair encoding in order of rank. Pre-tokens are held as ragged
arrays: the symbols of all sequences one after the other, and the number of the sequence each belongs to. A
round looks up the rank of every neighbouring pair, takes the least of each sequence, and merges that pair
wherever it stands in the sequence, from the left, in all sequences at once. When no sequence has a pair
left, the surviving symbols are counted. Merging all places of the lowest pair at once gives the same as one
at a time: a pair made by a merge always ranks after it.

Each distinct pre-token is merged once for each Python worker while it is remembered (a bounded number is).

Defined results: a null or empty text has no bytes and no tokens; special strings inside a text count as one
token each, as the library's default has it; repeated rows are counted each; extra columns are ignored.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specflow.llm.arrays import slices

# Capitals with lower-case forms that the library's case table has and Python's is too old for.
_NEWER_CASE = {"\ua7cb": "\u0264", "\ua7dc": "\u019b"}

_REMEMBERED = 400_000
_AT_ONCE = 50_000


def byte_symbols() -> list[str]:
    """How byte-level vocabularies spell each byte: printable ones as themselves, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(byte if byte in plain else next(others)) for byte in range(256)]


class Vocabulary:
    """The parts of a tokenizer file that decide how many tokens a text has."""

    def __init__(self, content: str) -> None:
        described = json.loads(content)
        model = described["model"]
        if model["type"] != "BPE" or not model["end_of_word_suffix"]:
            raise ValueError("expected byte-pair merges with an end-of-word suffix")
        split, by_bytes = described["pre_tokenizer"]["pretokenizers"]
        if (split["behavior"], split["invert"], by_bytes["type"]) != ("Removed", True, "ByteLevel"):
            raise ValueError("expected pre-tokens to be the matches of a pattern, spelt in bytes")
        kinds = [x["type"] for x in described["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("expected NFC, white space and lower case as normalisation")
        ids, suffix = model["vocab"], model["end_of_word_suffix"]
        self.pattern = regex.compile(split["pattern"]["Regex"])
        special = [x["content"] for x in described["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        symbols = byte_symbols()
        self.inner = np.array([ids[x] for x in symbols], np.int64)
        self.last = np.array([ids[x + suffix] for x in symbols], np.int64)
        self.size = max(ids.values()) + 1
        merges = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        pairs = np.array([ids[a] * self.size + ids[b] for a, b in merges], np.int64)
        order = np.argsort(pairs)
        self.pairs, self.ranks = pairs[order], order
        self.merged = np.array([ids[a + b] for a, b in merges], np.int64)  # by rank

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols; the number of merges for a pair that has none."""
        pairs = left * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pairs, self.ranks[at], len(self.pairs))


def count_symbols(vocabulary: Vocabulary, words: list[bytes]) -> np.ndarray:
    """How many symbols each word, none of them empty, ends up with."""
    lengths = np.array([len(x) for x in words], np.int64)
    data = np.frombuffer(b"".join(words), np.uint8)
    owner = np.repeat(np.arange(len(words)), lengths)
    symbols = vocabulary.inner[data]
    ends = np.cumsum(lengths) - 1
    symbols[ends] = vocabulary.last[data[ends]]
    counts = lengths.copy()
    none = len(vocabulary.pairs)
    while len(symbols) > 1:
        ranks = vocabulary.ranks_of(symbols[:-1], symbols[1:])
        ranks[owner[1:] != owner[:-1]] = none
        ranks = np.append(ranks, none)
        heads = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        least = np.minimum.reduceat(ranks, heads)
        sizes = np.diff(np.append(heads, len(symbols)))
        lowest = np.repeat(least, sizes)
        chosen = _from_the_left((ranks == lowest) & (lowest < none))
        at = np.flatnonzero(chosen)
        symbols[at] = vocabulary.merged[ranks[at]]
        stays = np.ones(len(symbols), bool)
        stays[at + 1] = False
        counts -= np.bincount(owner[at], minlength=len(words))
        stays &= lowest < none  # a sequence without pairs is done
        symbols, owner = symbols[stays], owner[stays]
    return counts


def _from_the_left(chosen: np.ndarray) -> np.ndarray:
    """Every other place of each run of neighbouring places, from the first: pairs must not overlap."""
    at = np.flatnonzero(chosen)
    if len(at):
        first = np.append(True, np.diff(at) != 1)
        since = at - np.maximum.accumulate(np.where(first, at, -1))
        chosen[at[since % 2 == 1]] = False
    return chosen


class Counter:
    """Counts the tokens of texts, remembering pre-tokens it has met."""

    def __init__(self, content: str) -> None:
        self.vocabulary = Vocabulary(content)
        self.known: dict[str, int] = {}

    def pre_tokens(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens of a text, and how many special strings stand between them."""
        special = self.vocabulary.special
        if special is None or not special.search(text):
            return self._plain(text), 0
        parts = special.split(text)
        return [x for part in parts for x in self._plain(part)], len(parts) - 1

    def _plain(self, text: str) -> list[str]:
        if not text.isascii():
            # a final sigma is like any other here, while lower() tells them apart
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            for capital, small in _NEWER_CASE.items():
                text = text.replace(capital, small)
        return self.vocabulary.pattern.findall(text.lower())

    def counts(self, texts: list[str | None]) -> list[int]:
        split = [self.pre_tokens(x or "") for x in texts]
        known = self.known
        new = list(set().union(*(words for words, _ in split)).difference(known))
        if len(known) + len(new) > _REMEMBERED:
            known = self.known = {}
            new = list(set().union(*(words for words, _ in split)))
        for start in range(0, len(new), _AT_ONCE):
            some = new[start : start + _AT_ONCE]
            known.update(zip(some, count_symbols(self.vocabulary, [x.encode() for x in some]).tolist(), strict=True))
        return [sum(map(known.__getitem__, words)) + special for words, special in split]


@cache
def _counter(content: str) -> Counter:
    """One for each Python worker, which runs many tasks."""
    return Counter(content)


def token_counts(docs: DataFrame, tokenizer_file: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, and whether the tokens are more than ``limit``.

    The file is read on the driver and broadcast; its size doesn't depend on the data.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(content.value)
        for batch in batches:
            for piece in slices(batch):
                texts = piece.column("text")
                sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
                tokens = pa.array(counter.counts(texts.to_pylist()), pa.int64())
                columns = {"doc_id": piece.column("doc_id"), "n_bytes": sizes, "n_tokens": tokens}
                yield pa.RecordBatch.from_pydict(columns)

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    counted = rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
