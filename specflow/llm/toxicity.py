"""Toxicity: a weighted lexicon, matched by Aho-Corasick in folded text, against length, with exception phrases.

Folding brings letters that look alike together: marks are stripped, Greek and Cyrillic doubles become Latin,
digits and signs that stand for letters become those letters, and i and l are one letter. Everything else
becomes a space. An entry matches at the beginning of a folded word and may be a stem.

The lexicon is a short general list plus what the labels teach: the stems that labelled toxic documents have far
more often than clean ones (near copies of a sampled document are left out, as they are no further evidence),
weighted by the logarithm of the odds, if a likelihood-ratio test finds that too unlikely to be chance among all
stems looked at. An exception phrase is an entry's word with the word after it which clean
documents have; where it stands, the entry doesn't count. The general list has its own.

The score is 1 - exp(-sum / norm): the weights of all matches, over a norm that grows with the logarithm of the length.

Learning uses at most ``SAMPLE`` toxic and twice as many clean documents, the least hashes of their ids, outside the
held-out fold.

Defined results: null and empty texts score 0; a document labelled twice is toxic if one label says so; without
labels the general list is used alone; repeated rows score alike; extra columns are ignored.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specflow.llm.arrays import mix, run_hashes, slices, words_of
from specflow.llm.tables import HELD_OUT_REMAINDER, fold_of, held_out, written

THRESHOLD = 0.3
SAMPLE = 3_000
_STEM_LENGTHS = range(3, 9)
_LEAST_LOG_ODDS = 3.0

# A general list of insults, and phrases in which such a word is harmless.
GENERAL_LEXICON = dict.fromkeys("idiot moron stupid scumbag pathetic worthless disgusting loser imbecile".split(), 3.0)
GENERAL_EXCEPTIONS = ("stupid simple", "loser bracket", "moron test")

# Characters that stand for Latin letters.
_DOUBLES = {
    "a": "аαɑ@4", "b": "вβЬ8", "c": "сϲ", "e": "еεєё3", "h": "һн", "i": "іιıl1", "j": "ј", "k": "кκ",
    "m": "м", "n": "ηп", "o": "оοσ0ø", "p": "рρ", "s": "ѕ$5", "t": "тτ7", "u": "υ", "v": "ν", "w": "ωш",
    "x": "хχ", "y": "уγ",
}
_SIGNS = "@$"


@cache
def _folding() -> np.ndarray:
    """For each code point the letter it folds to, or a space."""
    double = {ord(c): ord(letter) for letter, cs in _DOUBLES.items() for c in cs}
    table = np.full(0x110000, 0x20, np.uint32)
    for point in range(0x110000):
        if point in double:
            table[point] = double[point]
        elif chr(point).isalpha():
            base = unicodedata.normalize("NFKD", chr(point))[0].lower()[0]
            table[point] = double.get(ord(base), ord(base))
    return table


def fold(text: str) -> str:
    """The folded text, between two spaces."""
    points = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    folded = _folding()[points]
    for sign in _SIGNS:  # a sign is a letter between letters only
        at = np.flatnonzero(points == ord(sign))
        alone = (folded[at - 1] == 0x20) | (folded[np.minimum(at + 1, len(points) - 1)] == 0x20)
        folded[at[alone]] = 0x20
    return folded.tobytes().decode("utf-32-le", "surrogatepass")


@dataclass
class Lexicon:
    """Folded stems with their weights, and folded phrases of an entry's word and more."""

    stems: dict[str, float]
    exceptions: list[str] = field(default_factory=list)

    def automaton(self) -> ahocorasick.Automaton:
        matcher = ahocorasick.Automaton()
        for stem, weight in self.stems.items():
            matcher.add_word(f" {stem}", weight)
        for phrase in self.exceptions:
            stems = [w for s, w in self.stems.items() if phrase.startswith(s)]
            if stems:
                matcher.add_word(f" {phrase} ", -max(stems))
        matcher.make_automaton()
        return matcher


def general_lexicon() -> Lexicon:
    stems = {fold(w).strip(): weight for w, weight in GENERAL_LEXICON.items()}
    return Lexicon(stems, [fold(p).strip() for p in GENERAL_EXCEPTIONS])


def score(folded: str, matcher: ahocorasick.Automaton) -> tuple[float, float]:
    """The score of a folded text, and the weight of its matches."""
    total = sum(weight for _, weight in matcher.iter(folded)) if len(matcher) else 0.0
    if total <= 0:
        return 0.0, 0.0
    norm = 1 + math.log1p(len(folded) / 1000)
    return 1 - math.exp(-total / (4 * norm)), total


def _stem_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and clean documents of a task each stem and each phrase of two words stands."""
    toxic, clean = Counter(), Counter()
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            words = fold(text or "").split()
            found = {w[:n] for w in set(words) for n in _STEM_LENGTHS if len(w) >= n}
            found.update(f"{a} {b}" for a, b in zip(words, words[1:], strict=False))
            (toxic if label else clean).update(found)
    terms = sorted(toxic.keys() | clean.keys())
    columns = {"term": terms, "toxic": [toxic[t] for t in terms], "clean": [clean[t] for t in terms]}
    yield pa.RecordBatch.from_pydict(columns, schema=pa.schema([("term", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())]))


def _surprise(toxic: str, clean: str, all_toxic: int, all_clean: int):
    """Twice the log-likelihood ratio of a term's counts against the same share in both labels."""
    t, c = F.col(toxic).cast("double"), F.col(clean).cast("double")
    share = (t + c) / (all_toxic + all_clean)

    def part(found, expected):
        return F.when(found > 0, found * F.log(found / expected)).otherwise(0.0)

    return 2 * (
        part(t, share * all_toxic) + part(c, share * all_clean)
        + part(all_toxic - t, (1 - share) * all_toxic) + part(all_clean - c, (1 - share) * all_clean)
    )


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each document the least of three hashes of its runs of five words."""
    for batch in batches:
        for piece in slices(batch):
            words = words_of(piece.column("text"))
            runs = run_hashes(words.codes, 5)
            runs = runs[:, None] * mix(np.arange(1, 4, dtype=np.uint64)) | np.uint64(1)
            least = words.wholes[:, None].repeat(3, axis=1)
            usable = words.runs_from(5)
            for i in np.flatnonzero(words.counts >= 5):
                least[i] = runs[words.offsets[i] : words.offsets[i + 1]][usable[words.offsets[i] : words.offsets[i + 1]]].min(axis=0)
            columns = {name: piece.column(name) for name in ("id", "hash", "toxic")}
            columns |= {f"m{k}": pa.array(least[:, k].view(np.int64)) for k in range(3)}
            yield pa.RecordBatch.from_pydict(columns)


def _without_copies(sample: DataFrame) -> list[tuple[int, int, bool]]:
    """id, hash, toxic of the sample's documents but those that share one of three signatures with one before them.

    A few numbers for each document of the bounded sample reach the driver.
    """
    ddl = "id long, hash long, toxic boolean, m0 long, m1 long, m2 long"
    rows = sorted(map(tuple, sample.select("id", "hash", "toxic", "text").mapInArrow(_signatures, ddl).collect()))
    met: set[tuple[int, int]] = set()
    kept = []
    for doc_id, hashed, toxic, *signature in rows:
        own = set(enumerate(signature))
        if not own & met:
            kept.append((doc_id, hashed, toxic))
        met |= own
    return kept


def _drawn(rows: DataFrame, label: int, n: int) -> DataFrame:
    """The n ids of a label with the least hashes.

    Ids are counted first, so that only about twice as many as wanted are ever ordered, however many labels there are.
    """
    rows = rows.filter(F.col("toxic") == label)
    draw = F.xxhash64("id")
    low = draw / float(1 << 64) + 0.5 < F.lit((2 * n + 100) / max(1, rows.count()))
    return rows.filter(low).orderBy(draw, "id").limit(n)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Lexicon:
    """The general list and what labelled documents outside the held-out fold add to it."""
    general = general_lexicon()
    rows = labels.select(F.col("doc_id").cast("long").alias("id"), "toxic").filter(
        (fold_of(F.col("id")) != HELD_OUT_REMAINDER) & F.col("toxic").isNotNull()
    )
    rows = rows.groupBy("id").agg(F.max("toxic").alias("toxic"))
    ids = _drawn(rows, 0, 2 * sample).unionByName(_drawn(rows, 1, sample))  # three times ``sample`` ids at most, so it may be sent to every task
    chosen = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(F.broadcast(ids), "id")
    chosen = written(chosen.select("id", F.xxhash64("text").alias("hash"), "text", (F.col("toxic") == 1).alias("toxic")), "sample")
    kept = _without_copies(chosen)
    all_toxic, all_clean = sum(row[2] for row in kept), sum(not row[2] for row in kept)
    if not all_toxic or not all_clean:
        return general
    names = docs.sparkSession.createDataFrame([row[:2] for row in kept], "id long, hash long")
    chosen = chosen.join(F.broadcast(names), ["id", "hash"])
    counts = chosen.select("text", "toxic").mapInArrow(_stem_counts, "term string, toxic long, clean long")
    counts = counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    odds = F.log((F.col("toxic") + 0.5) / (all_toxic + 1)) - F.log((F.col("clean") + 0.5) / (all_clean + 1))
    counts = counts.withColumn("odds", odds).withColumn("surprise", _surprise("toxic", "clean", all_toxic, all_clean))
    # 40: chance passes this once in a billion and a half terms
    stems = counts.filter(~F.col("term").contains(" ") & (F.col("odds") >= _LEAST_LOG_ODDS) & (F.col("surprise") >= 40)).collect()
    learned: dict[str, float] = {}
    # of stems with about the same odds the longest, which say more
    for row in sorted(stems, key=lambda r: (-round(4 * r["odds"]), -len(r["term"]), -r["odds"], r["term"])):
        if not any(row["term"].startswith(s) or s.startswith(row["term"]) for s in learned):
            learned[row["term"]] = row["odds"]
    lexicon = Lexicon({**general.stems, **learned}, list(general.exceptions))
    begins = [f"^{s}" for s in lexicon.stems]
    phrases = counts.filter(F.col("term").contains(" ") & F.col("term").rlike("|".join(begins)))
    harmless = phrases.filter((F.col("clean") >= 3) & (F.col("toxic") == 0)).select("term").collect()
    lexicon.exceptions.extend(sorted(r["term"] for r in harmless))
    return lexicon


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted and matched (the weight of the matches) of every document."""
    lexicon = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, sample))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = lexicon.value.automaton()
        for batch in batches:
            for piece in slices(batch):
                scores = [score(fold(x), matcher) if x else (0.0, 0.0) for x in piece.column("text").to_pylist()]
                columns = [
                    piece.column("doc_id"), piece.column("held_out"),
                    pa.array([s for s, _ in scores], pa.float64()), pa.array([m for _, m in scores], pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "score", "matched"])

    rows = docs.select(F.col("doc_id").cast("long"), "text", held_out(F.col("doc_id")).alias("held_out"))
    judged = rows.mapInArrow(judge, "doc_id long, held_out boolean, score double, matched double")
    predicted = (F.col("score") >= threshold).cast("int")
    return judged.select("doc_id", "held_out", "score", predicted.alias("predicted"), "matched")
