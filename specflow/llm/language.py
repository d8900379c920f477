"""Language ID: multinomial logistic regression on TF-IDF of character n-grams, learned by FTRL, then calibrated.

Features are the runs of one to four characters of a text in lower case, in which everything but letters is a
space; they are hashed into a fixed number of columns. A document is the vector of its n-gram shares times their
inverse document frequency, counted over all documents that may be learned from. Weights are learned by
follow-the-regularised-leader with both an absolute and a squared penalty, so columns without use keep weight zero;
then one temperature, fitted on documents set aside from the sample, makes the probabilities honest.

Learning uses a sample of at most ``SAMPLE`` documents for each language, the least hashes of their ids; counting and
prediction use all documents and whole texts.

Defined results: a null text, or one without a letter, is ``und`` with score 0; without any document to learn from
everything is ``und``; documents without an id or language are not learned from; repeated rows get equal answers;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from specflow.llm.arrays import slices
from specflow.llm.tables import HELD_OUT_REMAINDER, fold_of, held_out

UNKNOWN = "und"
SAMPLE = 600
BITS = 15
LONGEST = 4
_COUNTED_AT_ONCE = 64
_MULTIPLIER = np.uint32(0x9E3779B1)


@cache
def _letters() -> np.ndarray:
    """For each code point its lower case if it is a letter, else a space."""
    table = np.full(0x110000, 0x20, np.uint32)
    for point in range(0x110000):
        letter = chr(point)
        if letter.isalpha():
            lower = letter.lower()
            table[point] = ord(lower) if len(lower) == 1 else point
    return table


def _characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' letters and spaces, each text after one space of its own, and where each begins."""
    joined = "".join(" " + (x or "") for x in texts)
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([1 + len(x or "") for x in texts], out=offsets[1:])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _letters()[points], offsets


def _columns(characters: np.ndarray, n: int) -> np.ndarray:
    """The column of the n characters that end at each place; the first n - 1 places reach back over the start."""
    hashes = characters + np.uint32(n * 0x10000)
    for back in range(1, n):
        shifted = np.roll(characters, back)
        hashes = hashes * np.uint32(0x01000193) ^ shifted
    return (hashes * _MULTIPLIER) >> np.uint32(32 - BITS)


def _all_columns(characters: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length n the columns, and which places count: whole n-grams of one text that end in no gap of spaces."""
    within = np.arange(len(characters)) - np.repeat(offsets[:-1], np.diff(offsets))
    gap = characters == 0x20
    empty = gap.copy()
    empty[1:] &= gap[:-1]
    empty[0] = gap[0]
    for n in range(1, LONGEST + 1):
        use = within >= n - 1
        use &= ~(gap if n == 1 else empty)
        yield _columns(characters, n), use


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # column by language, with the inverse document frequencies in
    bias: np.ndarray
    temperature: float

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        characters, offsets = _characters(texts)
        has_letter = np.add.reduceat((characters != 0x20).astype(np.int64), offsets[:-1]) > 0
        sums = np.zeros((len(texts), len(self.languages)))
        used = np.zeros(len(texts))
        for columns, use in _all_columns(characters, offsets):
            columns = np.where(use, columns, 1 << BITS)  # the last row of the weights is zero
            for k in range(len(self.languages)):
                sums[:, k] += np.add.reduceat(self.weights[:, k][columns], offsets[:-1])
            used += np.add.reduceat(use.astype(np.int64), offsets[:-1])
        logits = (sums / np.maximum(used, 1)[:, None] + self.bias) / self.temperature
        best = logits.argmax(axis=1)
        scores = 1 / np.exp(logits - logits.max(axis=1, keepdims=True)).sum(axis=1)
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), has_letter.tolist(), strict=True)]
        return names, np.where(has_letter, scores, 0.0)


def _vector(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The columns a text has, and the number of its n-grams in each."""
    characters, offsets = _characters([text])
    found = np.concatenate([columns[use] for columns, use in _all_columns(characters, offsets)])
    columns, counts = np.unique(found, return_counts=True)
    return columns.astype(np.uint16), counts.astype(np.int32)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many of a task's documents have each column; one row for each column, and -1 for the documents."""
    counts = np.zeros(1 << BITS, np.int64)
    documents = 0
    for batch in batches:
        for start in range(0, batch.num_rows, _COUNTED_AT_ONCE):
            texts = batch.column("text").slice(start, _COUNTED_AT_ONCE).to_pylist()
            characters, offsets = _characters(texts)
            owner = np.repeat(np.arange(len(texts), dtype=np.int64) << BITS, np.diff(offsets))
            met = np.zeros(len(texts) << BITS, bool)
            for columns, use in _all_columns(characters, offsets):
                met[owner[use] | columns[use]] = True
            counts += np.count_nonzero(met.reshape(len(texts), -1), axis=0)
            documents += len(texts)
    column = np.append(np.flatnonzero(counts), -1)
    yield pa.RecordBatch.from_pydict({"column": column, "n": np.append(counts[counts > 0], documents)})


def ftrl(
    vectors: Sequence[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, width: int,
    passes: int = 4, alpha: float = 1.0, beta: float = 1.0, absolute: float = 1e-3, squared: float = 1e-3,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by follow-the-regularised-leader (proximal), one document at a time in a fixed random order.

    z sums the gradients corrected for how far weights have moved, n their squares; a weight is zero while |z| is at
    most the absolute penalty.
    """
    z, n = np.zeros((width + 1, classes)), np.zeros((width + 1, classes))

    def weights_at(columns: np.ndarray) -> np.ndarray:
        zs = z[columns]
        rate = (beta + np.sqrt(n[columns])) / alpha + squared
        return np.where(np.abs(zs) <= absolute, 0.0, -(zs - np.sign(zs) * absolute) / rate)

    order = np.random.default_rng(7)
    for _ in range(passes):
        for i in order.permutation(len(labels)):
            columns, values = vectors[i]
            columns = np.append(columns, width)  # the bias
            values = np.append(values, 0.1)
            w = weights_at(columns)
            logits = values @ w
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1
            gradient = values[:, None] * p
            moved = (np.sqrt(n[columns] + gradient**2) - np.sqrt(n[columns])) / alpha
            z[columns] += gradient - moved * w
            n[columns] += gradient**2
    learned = weights_at(np.arange(width + 1))
    return learned[:-1], 0.1 * learned[-1]


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits under which the labels are likeliest, searched on a fixed grid from 0.05 to 20."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 200))

    def loss(t: float) -> float:
        scaled = logits / t
        scaled = scaled - scaled.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(scaled).sum(axis=1)) - scaled[np.arange(len(labels)), labels]))

    return float(min(grid, key=loss))


def sampled(usable: DataFrame, sample: int) -> DataFrame:
    """doc_id, lang, hash (of the text) of each language's ``sample`` rows with the least hashes of their ids.

    Ids are counted first, approximately, so that only about twice as many as wanted are ever ranked, however large the
    language is: with so many expected, chance leaves less than wanted in far under one of 10^20 draws.
    """
    known = usable.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("ids"))  # a row for each language
    draw = F.xxhash64("doc_id")
    low = draw / float(1 << 64) + 0.5 < (2 * sample + 100) / F.col("ids")
    ids = usable.join(F.broadcast(known), "lang").filter(low).select("lang", "doc_id", F.xxhash64("text").alias("hash")).distinct()
    order = W.partitionBy("lang").orderBy(draw, "doc_id", "hash")
    return ids.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= sample).drop("rank")


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Instead of texts, the columns they have with the counts of their n-grams, packed: bounded, however long a text is."""
    for batch in batches:
        for piece in slices(batch):
            found = [_vector(text) for text in piece.column("text").to_pylist()]
            packed = [pa.array([x[k].tobytes() for x in found], pa.binary()) for k in (0, 1)]
            columns = [*(piece.column(c) for c in ("doc_id", "lang", "hash")), *packed]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang", "hash", "columns", "counts"])


class _Vectors(Sequence):
    """The columns and values of packed documents, each unpacked when it is asked for: the driver holds only the packed ones."""

    def __init__(self, packed: pa.Table, rows: Iterable[int], inverse: np.ndarray) -> None:
        self.packed, self.rows, self.inverse = packed, list(rows), inverse

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        columns, counts = (self.packed.column(name)[self.rows[i]].as_buffer() for name in ("columns", "counts"))
        columns, counts = np.frombuffer(columns, np.uint16).astype(np.int64), np.frombuffer(counts, np.int32)
        return columns, counts / counts.sum() * self.inverse[columns] * 10

    def of(self, numbers: np.ndarray) -> _Vectors:
        return _Vectors(self.packed, (self.rows[i] for i in numbers), self.inverse)


def learn(docs: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model from the documents that have an id outside the held-out fold, a text and a language."""
    usable = docs.select(F.col("doc_id").cast("long"), "text", "lang").filter(
        (fold_of(F.col("doc_id")) != HELD_OUT_REMAINDER) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    rows = usable.select("text").mapInArrow(_frequencies, "column long, n long")
    found = rows.groupBy("column").agg(F.sum("n").alias("n")).toArrow()
    column, count = (found.column(name).to_numpy() for name in ("column", "n"))
    documents = int(count[column < 0].sum())
    names = sampled(usable, sample).select("doc_id", "hash").distinct()  # ``sample`` rows for each language at most
    chosen = usable.withColumn("hash", F.xxhash64("text")).join(F.broadcast(names), ["doc_id", "hash"])
    vectors = chosen.select("doc_id", "lang", "hash", "text").mapInArrow(
        _vectors, "doc_id long, lang string, hash long, columns binary, counts binary"
    )
    # a row that is there several times is learned from once
    rows = vectors.dropDuplicates(["doc_id", "lang", "hash"]).toArrow()
    keys = list(zip(*(rows.column(name).to_pylist() for name in ("doc_id", "lang", "hash")), strict=True))
    picked = sorted((i for i, size in enumerate(pc.binary_length(rows.column("columns")).to_pylist()) if size), key=keys.__getitem__)
    if not picked:
        return None
    languages = sorted({keys[i][1] for i in picked})
    inverse = np.zeros(1 << BITS)
    counted = column >= 0
    inverse[column[counted]] = np.log((1 + documents) / (1 + count[counted])) + 1
    vectors = _Vectors(rows.select(["columns", "counts"]), picked, inverse)
    labels = np.array([languages.index(keys[i][1]) for i in picked])
    aside = np.random.default_rng(11).permutation(len(picked))
    aside, fitted = aside[: len(picked) // 5], aside[len(picked) // 5 :]
    weights, bias = ftrl(vectors.of(fitted), labels[fitted], len(languages), 1 << BITS)
    logits = np.array([values @ weights[columns] + bias for columns, values in vectors.of(aside)]).reshape(len(aside), len(languages))
    scaled = np.vstack([weights * inverse[:, None] * 10, np.zeros(len(languages))])
    return Model(languages, np.asfortranarray(scaled.astype(np.float32)), bias, temperature(logits, labels[aside]))


def languages(docs: DataFrame, sample: int = SAMPLE, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text, held_out, lang_pred and score of every document, and the columns to carry along.

    See the module for what is learned from.
    """
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, sample))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        for batch in batches:
            for piece in slices(batch):
                texts = piece.column("text").to_pylist()
                names, scores = known.predict(texts) if known else ([UNKNOWN] * len(texts), np.zeros(len(texts)))
                columns = [*piece.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*piece.schema.names, "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), "text", *carry, held_out(F.col("doc_id")).alias("held_out"))
    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(predict, schema)
