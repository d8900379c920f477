"""Substring dedup: every run of words that occurs elsewhere, found by sorted hashes of windows.

Not suffix trees: a window of ``window`` words is named by hashes of four parts of it, its first eight words and three
blocks of the others (128 bits in all). Range partitioning by these names gives each task a range of windows, Spark's
sort lays equal ones side by side (and spills), and one pass over them tells which windows occur several times. There
are no common prefixes and no nodes of other depths, so maximal repeats are not named; the words that repeated windows
cover are, which is all that the removal needs. The code calls groups of equal beginnings subtrees and their windows leaves.

Two measures keep the groups small; neither loses a repeat:

* A suffix is only planted if it can have a twin. Each window is represented by the least hash among its
  runs of eight words. Equal windows have equal representatives at equal places, so a window whose
  representative occurs once in the corpus is unique. Only one word in fourteen is a representative.
* A batch sends equal paths as one row with the places of all, so a passage that a third of all documents
  share is one row per batch, not one per document.

Defined results: a null or blank text has no words; texts shorter than a window lose nothing; repeated rows
are each other's repeats, looked for once and counted; extra columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specflow.llm.arrays import Words, run_hashes, slices, words_of
from specflow.llm.tables import NUMBER_BITS, counted, id_of_row, named_rows

WINDOW = 35
PREFIX = 8

#: A word's place: its row's id_key, and in one number the row's copy and the word's position.
_PLACE = np.dtype([("id_key", "<i8"), ("place", "<i8")])
_POSITION_BITS = 30  # a text has less than 2^31 bytes
_LEAF = "prefix long, blocks long, id_key long, place long, more binary"


def _places(rows: pa.RecordBatch, numbers: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """The places of words, by the number of their row in the batch and their position in its text."""
    found = np.empty(len(numbers), _PLACE)
    found["id_key"] = rows.column("id_key").to_numpy()[numbers]
    copies = rows.column("copy").to_numpy().astype(np.int64)[numbers]
    found["place"] = (copies << _POSITION_BITS) | positions
    return found


def _leaves(prefix: np.ndarray, blocks: np.ndarray, places: np.ndarray) -> pa.RecordBatch:
    """One row for each path: its first place and, packed, its others (null if it has none)."""
    order = np.lexsort((places["place"], places["id_key"], blocks, prefix))
    prefix, blocks, places = prefix[order], blocks[order], places[order]
    first = np.ones(len(prefix), bool)
    first[1:] = (prefix[1:] != prefix[:-1]) | (blocks[1:] != blocks[:-1])
    heads = np.flatnonzero(first)
    sizes = np.diff(np.append(heads, len(prefix))) - 1
    ends = np.zeros(len(heads) + 1, np.int32)
    np.cumsum(sizes * _PLACE.itemsize, out=ends[1:])
    others = pa.py_buffer(places[~first].tobytes())
    valid = pa.py_buffer(np.packbits(sizes > 0, bitorder="little"))
    columns = {
        "prefix": pa.array(prefix[heads].view(np.int64)),
        "blocks": pa.array(blocks[heads].view(np.int64)),
        "id_key": pa.array(places["id_key"][heads]),
        "place": pa.array(places["place"][heads]),
        "more": pa.Array.from_buffers(pa.binary(), len(heads), [valid, pa.py_buffer(ends), others]),
    }
    return pa.RecordBatch.from_pydict(columns)


def _representatives(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each run of eight words, and for each window the place of the least among its runs."""
    runs = run_hashes(words.codes, PREFIX)
    width = window - PREFIX + 1
    least, place, span = runs, np.arange(len(runs)), 1
    while span < width:
        by = min(span, width - span)
        if len(least) <= by:
            return runs, np.zeros(0, np.int64)
        later = least[by:] < least[:-by]
        place = np.where(later, place[by:], place[:-by])
        least = np.where(later, least[by:], least[:-by])
        span += by
    return runs, place


def _gathered(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    if parts:
        yield _leaves(*(np.concatenate(column) for column in zip(*parts, strict=True)))


def _representative_leaves(window: int):
    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for piece in slices(batch):
                words = words_of(piece.column("text"))
                runs, place = _representatives(words, window)
                place = np.unique(place[words.runs_from(window)])
                rows = words.texts[place]
                places = _places(piece, rows, place - words.offsets[rows])
                parts.append((runs[place], np.zeros(len(place), np.uint64), places))
            yield from _gathered(parts)

    return plant


def _path(words: Words, runs: np.ndarray, starts: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The four edges of the suffixes that start at these words: the prefix, and three blocks in one number."""
    cuts = np.linspace(PREFIX, window, 4).astype(int)
    blocks = np.zeros(len(starts), np.uint64)
    for begin, end, bits in zip(cuts[:-1], cuts[1:], (21, 21, 22), strict=True):
        hashes = run_hashes(words.codes, int(end - begin))[starts + begin]
        blocks = (blocks << np.uint64(bits)) | (hashes >> np.uint64(64 - bits))
    return runs[starts], blocks


def _window_leaves(window: int):
    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for piece in slices(batch):
                words = words_of(piece.column("text"))
                runs, place = _representatives(words, window)
                if not len(place):
                    continue
                twin = _marked(words, piece)
                starts = np.flatnonzero(words.runs_from(window) & twin[place])
                if len(starts):
                    rows = words.texts[starts]
                    places = _places(piece, rows, starts - words.offsets[rows])
                    parts.append((*_path(words, runs, starts, window), places))
            yield from _gathered(parts)

    return plant


def _marked(words: Words, rows: pa.RecordBatch) -> np.ndarray:
    """Which words the rows' lists of places name. The lists have the places of all rows with their id_key and tag."""
    marked = np.zeros(len(words.codes), bool)
    copies = rows.column("copy").to_numpy() & ((1 << NUMBER_BITS) - 1)
    for name in ("places", "others"):
        lists = rows.column(name)
        places = np.asarray(lists.flatten()).astype(np.int64)
        numbers = np.repeat(np.arange(rows.num_rows), np.asarray(lists.value_lengths().fill_null(0)))
        own = places >> _POSITION_BITS == copies[numbers]
        marked[words.offsets[numbers[own]] + (places[own] & ((1 << _POSITION_BITS) - 1))] = True
    return marked


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The places below full-depth nodes with several leaves; leaves come sorted by path.

    The last row of a batch waits for the next batch, as its twin may come first there.
    """
    held: pa.RecordBatch | None = None
    met = False  # whether the held row has a twin before it
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([held, batch] if held else [batch]).combine_chunks().to_batches()[0]
        yield from _places_below(rows, met, complete=False)
        if rows.num_rows > 1:
            last, before = rows.slice(rows.num_rows - 1), rows.slice(rows.num_rows - 2, 1)
            met = last.column(0)[0] == before.column(0)[0] and last.column(1)[0] == before.column(1)[0]
        held = rows.slice(rows.num_rows - 1)
    if held:
        yield from _places_below(held, met, complete=True)


def _places_below(rows: pa.RecordBatch, met: bool, complete: bool) -> Iterator[pa.RecordBatch]:
    prefix, blocks = rows.column("prefix").to_numpy(), rows.column("blocks").to_numpy()
    alike = (prefix[1:] == prefix[:-1]) & (blocks[1:] == blocks[:-1])
    several = np.asarray(rows.column("more").is_valid())
    several[1:] |= alike
    several[:-1] |= alike
    several[0] |= met
    if not complete:
        several[-1] = False
    picked = rows.filter(pa.array(several))
    others = np.frombuffer(b"".join(picked.column("more").drop_null().to_pylist()), _PLACE)
    columns = {name: pa.array(np.concatenate([picked.column(name).to_numpy(), others[name]])) for name in _PLACE.names}
    yield pa.RecordBatch.from_pydict(columns)


def _with_places(rows: DataFrame, places: DataFrame, how: str) -> DataFrame:
    """The rows with what is found for their id_key and tag: ``places`` of number 0, as positions, and ``others``.

    Both sides are dealt out by these two. Few texts of one id share a tag, so a row meets hardly any places but its own.
    """
    tag = F.shiftright("place", _POSITION_BITS + NUMBER_BITS)
    place = F.col("place").bitwiseAND((1 << _POSITION_BITS + NUMBER_BITS) - 1)
    first = place < 1 << _POSITION_BITS
    lists = F.collect_list(F.when(first, place.cast("int"))).alias("places"), F.collect_list(F.when(~first, place)).alias("others")
    found = places.groupBy(F.col("id_key").alias("of"), tag.alias("of_tag")).agg(*lists)
    return rows.join(found, (F.col("id_key") == F.col("of")) & (F.col("tag") == F.col("of_tag")), how).drop("of", "of_tag")


def repeated_starts(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """id_key, tag, no_id, text, n, copy, ``places`` and ``others``: where windows begin that also begin elsewhere.

    Rows alike in id and text are one row here, ``n`` of them; with ``n`` over 1 every window is a repeat, listed or not.
    All of it is one plan: the documents are dealt out once and read from that exchange three times.
    """
    if window <= PREFIX + 2:
        raise ValueError(f"a window needs more than {PREFIX + 2} words")
    rows = named_rows(docs)
    place = "id_key long, place long"
    representatives = rows.mapInArrow(_representative_leaves(window), _LEAF)
    twins = representatives.repartition("prefix").sortWithinPartitions("prefix", "blocks").mapInArrow(_repeated, place)
    leaves = _with_places(rows, twins, "inner").mapInArrow(_window_leaves(window), _LEAF)
    subtrees = leaves.repartitionByRange("prefix", "blocks").sortWithinPartitions("prefix", "blocks")
    return counted(_with_places(rows, subtrees.mapInArrow(_repeated, place), "left"), docs)


_KEPT = "id_key long, no_id boolean, n long, n_words long, n_removed long, kept string"

#: Rows alike are listed again in lists of at most this many.
_LISTED = 10_000


def _without(window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                words = words_of(piece.column("text"))
                # a window covers the words from its start: starts so far less ends so far
                steps = np.zeros(len(words.codes) + window, np.int32)
                marked, whole = _marked(words, piece), words.runs_from(window)
                marked[: len(whole)] |= whole & (piece.column("n").to_numpy() > 1)[words.texts[: len(whole)]]
                starts = np.flatnonzero(marked)
                steps[starts] += 1
                steps[starts + window] -= 1
                stays = np.cumsum(steps)[: len(words.codes)] == 0
                kept = []
                for text, begin, end in zip(piece.column("text").to_pylist(), words.offsets, words.offsets[1:], strict=False):
                    kept.append(b" ".join(compress((text or "").encode().split(), stays[begin:end].tolist())).decode())
                removed = words.counts - np.add.reduceat(np.append(stays, False).astype(np.int64), words.offsets[:-1]) * (words.counts > 0)
                columns = {
                    "id_key": piece.column("id_key"), "no_id": piece.column("no_id"), "n": piece.column("n"),
                    "n_words": pa.array(words.counts), "n_removed": pa.array(removed), "kept": pa.array(kept, pa.string()),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return cut


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and ``kept``: the words outside all repeated windows, joined by one space."""
    cut = repeated_starts(docs, window).mapInArrow(_without(window), _KEPT)
    lists = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(_LISTED).cast("long")))
    listed = cut.withColumn("before", lists).withColumn("left", F.least(F.col("n") - F.col("before"), F.lit(_LISTED)))
    rows = listed.withColumn("number", F.explode(F.sequence(F.lit(1).cast("long"), "left")))
    return rows.select(id_of_row(), "n_words", "n_removed", "kept")
