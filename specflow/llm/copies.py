"""Suffix-array dedup: byte strings that occur elsewhere, from longest-previous-factor arrays over sparse suffix arrays.

Texts are UTF-8 bytes. Suffixes are planted at anchors only: each window of ``window`` bytes is represented by the
least hash among its runs of 64 bytes. Equal windows have equal representatives at equal places, so windows that are
equal share an anchor, and about one byte in 170 is one. A window has more than half of its other bytes on one side of
its anchor, so equal windows also share a core: the anchor and that half. Anchors are known by their two cores, and
cores that occur at one place only are dropped, by counts that are summed in tasks before they travel: a line that all
documents have makes no group, unless a window's half around it is the same.

An anchor's suffix travels once for each core, with the bytes that windows on that side can have, those before the
anchor backwards. Equal ones of a batch travel once. Spark deals them out by the core's hash and sorts them, so that
each group of equal cores is a suffix array. Its longest common prefixes come from neighbours. Suffixes with the same
bytes before them form classes, one for each branching of those bytes; in each class, in suffix order, the previous and
the next suffix of smaller position give the longest previous factor of every suffix, those of greater position its
longest next factor. A class that agrees in d bytes before the anchor and a factor of r bytes from it make a repeat of
d + r bytes; those of a window and more are marked at all places of the suffix. Bytes behind such marks are removed:
everywhere (``keep="none"``), or at all places but the first (``keep="first"``, in the order of doc_id).

A passage that very many documents share has a suffix for each of its surroundings. Cores with more than ``most_places``
places are not gathered: the windows that have them are counted by their hashes, with the first and the last place of
each summed in tasks, and those with two are joined back to their places, a join that Spark splits.

Equal texts are one text here, with a count: copies beyond one are whole repeats, and no place of theirs travels.

Defined results: a null or empty text has no bytes and nothing to remove; texts shorter than a window lose nothing; rows
alike are each other's copies; a missing id comes last in order; matches never cross documents; extra columns are
ignored; an empty table gives no rows. A cut may part the bytes of a character: what is kept is binary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specflow.llm.arrays import _BYTE_CODES, mix, run_hashes, slices, span_hashes, text_bytes
from specflow.llm.tables import written

WINDOW = 400
GRAM = 64
#: Places of a core up to which its suffixes meet in one task: about a hundred megabytes of their bytes.
MOST_PLACES = 1 << 17
_SLICE = 1 << 20
#: Bytes whose anchors are looked for at a time: each takes about 65 bytes of memory.
_HASHED = 1 << 18
#: Suffixes whose bytes are gathered at a time.
_CONTEXTS = 1 << 10
_SECOND = mix(_BYTE_CODES)
#: No byte of UTF-8 text: stands where a text has ended.
_END = 0xFF
_LAST = (1 << 63) - 1


def _text_keys() -> list[Column]:
    text = F.coalesce("text", F.lit(""))
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(GRAM), text, F.lit(WINDOW)).alias("k2")]


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values, the place of its least (the first of equals)."""
    least, place, span = values, np.arange(len(values), dtype=np.int32), 1
    while span < width:
        by = min(span, width - span)
        if len(least) <= by:
            return np.zeros(0, np.int32)
        later = least[by:] < least[:-by]
        place = np.where(later, place[by:], place[:-by])
        least = np.where(later, least[by:], least[:-by])
        span += by
    return place


#: An anchor with one of its cores is a number: the place doubled, plus the side.
_BEHIND, _BEFORE = 0, 1


class _Cores:
    """Where the cores of anchors, and the windows that have them, begin and end."""

    def __init__(self, window: int) -> None:
        # windows that begin ``far`` bytes before their anchor, or more, have the core before it; the others that behind
        far = (window - GRAM + 1) // 2
        self.before = (far, window - GRAM)
        self.behind = (window - far + 1, window - far)
        self.window = window

    def core(self, at: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begins = np.where(side == _BEHIND, at, at - self.before[0])
        return begins, np.where(side == _BEHIND, at + self.behind[0], at + GRAM)

    def reach(self, at: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All bytes that windows with the core can have."""
        begins = at - np.where(side == _BEHIND, self.before[0] - 1, self.before[1])
        return begins, at + np.where(side == _BEHIND, self.window, self.behind[1])


def _core_hashes(codes: np.ndarray, begins: np.ndarray, ends: np.ndarray, side: np.ndarray) -> np.ndarray:
    return mix(span_hashes(codes, begins, ends) ^ side.astype(np.uint64))


def _anchors(window: int):
    cores = _Cores(window)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, most=_HASHED):
                data, offsets = text_bytes(piece.column("text"))
                codes = _BYTE_CODES[data]
                places = least_places(run_hashes(codes, GRAM), window - GRAM + 1)
                # windows that stay in their text: their starts end where the text's last window begins
                inside = np.zeros(len(places) + 1, np.int32)
                long = np.flatnonzero(np.diff(offsets) >= window)
                np.add.at(inside, offsets[:-1][long], 1)
                np.add.at(inside, np.minimum(offsets[1:][long] - window + 1, len(places)), -1)
                at = np.unique(places[np.cumsum(inside[:-1]) > 0]).astype(np.int64)
                at, side = np.repeat(at, 2), np.tile([_BEHIND, _BEFORE], len(at))
                rows = np.searchsorted(offsets, at, side="right") - 1
                begins, ends = cores.core(at, side)
                # where a core would leave the text, no window has it
                whole = (begins >= offsets[rows]) & (ends <= offsets[rows + 1])
                at, side, rows = at[whole], side[whole], rows[whole]
                hashes = _core_hashes(codes, begins[whole], ends[whole], side)
                columns = {
                    "core": pa.array(hashes.view(np.int64)), "k1": piece.column("k1").take(pa.array(rows)),
                    "k2": piece.column("k2").take(pa.array(rows)), "anchor": pa.array(2 * (at - offsets[rows]) + side),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return find


class _Anchored:
    """The anchors of some texts, each with a core: places in the bytes, and the begin and end of the bytes around each."""

    def __init__(self, rows: pa.RecordBatch, window: int, column: str = "anchors") -> None:
        self.data, offsets = text_bytes(rows.column("text"))
        self.text_begins = offsets
        lists, cores = rows.column(column), _Cores(window)
        self.rows = np.repeat(np.arange(rows.num_rows), np.asarray(lists.value_lengths()))
        anchors = np.asarray(lists.flatten())
        side = anchors & 1
        self.pos = (anchors >> 1).astype(np.int32)
        self.at = offsets[self.rows] + self.pos
        begins, ends = cores.reach(self.at, side)
        self.begins, self.ends = np.maximum(offsets[self.rows], begins), np.minimum(offsets[self.rows + 1], ends)
        codes = _BYTE_CODES[self.data]
        left = (self.at - self.begins).astype(np.uint64)
        self.cores = _core_hashes(codes, *cores.core(self.at, side), side)
        # bytes before the anchor tell the sides apart, too: one side has fewer than any of the other
        self.c1 = mix(span_hashes(codes, self.begins, self.ends) ^ left)
        self.c2 = mix(span_hashes(_SECOND[self.data], self.begins, self.ends) + left)


def _suffixes(window: int):
    """core, context, c1, c2, n_left, n_right, first_id, k1, pos, several: one row for equal ones of a slice."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, most=_SLICE):
                found = _Anchored(piece, window)
                first_id = piece.column("first_id").fill_null(_LAST).to_numpy()[found.rows]
                k1 = piece.column("k1").to_numpy()[found.rows]
                order = np.lexsort((found.pos, k1, first_id, found.c2, found.c1))
                c1, c2 = found.c1[order], found.c2[order]
                head = np.ones(len(order), bool)
                head[1:] = (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1])
                several = np.diff(np.append(np.flatnonzero(head), len(order))) > 1
                for begin in range(0, len(several), _CONTEXTS):
                    some = slice(begin, begin + _CONTEXTS)
                    own = order[head][some]
                    columns = {
                        "core": pa.array(found.cores[own].view(np.int64)), "context": _context(found, own, window),
                        "c1": pa.array(found.c1[own].view(np.int64)), "c2": pa.array(found.c2[own].view(np.int64)),
                        "n_left": pa.array((found.at - found.begins)[own].astype(np.int32)),
                        "n_right": pa.array((found.ends - found.at)[own].astype(np.int32)),
                        "first_id": pa.array(first_id[own]), "k1": pa.array(k1[own]), "pos": pa.array(found.pos[own]),
                        "several": pa.array(several[some]),
                    }
                    yield pa.RecordBatch.from_pydict(columns)

    return cut


def _windows(window: int):
    """Every window around the places of much-used cores: its two hashes, text and begin."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, most=_SLICE):
                found = _Anchored(piece, window, "hot")
                codes, more = _BYTE_CODES[found.data], _SECOND[found.data]
                starts = [np.arange(b, e - window + 1) for b, e in zip(found.begins.tolist(), found.ends.tolist(), strict=True)]
                rows = np.repeat(found.rows, [len(x) for x in starts])
                starts = np.concatenate([*starts, np.zeros(0, np.int64)])
                starts, first = np.unique(starts, return_index=True)  # neighbouring anchors share windows
                rows = rows[first]
                for begin in range(0, len(starts), 1 << 16):
                    own, of = starts[begin : begin + (1 << 16)], pa.array(rows[begin : begin + (1 << 16)])
                    offsets = found.text_begins[rows[begin : begin + (1 << 16)]]
                    columns = {
                        "w1": pa.array(span_hashes(codes, own, own + window).view(np.int64)),
                        "w2": pa.array(span_hashes(more, own, own + window).view(np.int64)),
                        "first_id": piece.column("first_id").fill_null(_LAST).take(of), "k1": piece.column("k1").take(of),
                        "k2": piece.column("k2").take(of), "begin": pa.array((own - offsets).astype(np.int64)),
                    }
                    yield pa.RecordBatch.from_pydict(columns)

    return name


_SUFFIX = (
    "core long, context binary, c1 long, c2 long, n_left int, n_right int, first_id long, k1 long, pos int, several boolean"
)


def _context(found: _Anchored, own: np.ndarray, window: int) -> pa.Array:
    """The bytes from each anchor on, then those before it backwards, both filled up to one length."""
    at = found.at[own, None]
    places = np.concatenate([at + np.arange(window), at - 1 - np.arange(window - GRAM)], axis=1)
    inside = (places >= found.begins[own, None]) & (places < found.ends[own, None])
    bytes_ = np.where(inside, found.data[np.where(inside, places, 0)], _END).astype(np.uint8)
    width = 2 * window - GRAM
    ends = np.arange(0, (len(own) + 1) * width, width, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(own), [None, pa.py_buffer(ends), pa.py_buffer(bytes_.tobytes())])


def _members(window: int):
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, most=_SLICE):
                found = _Anchored(piece, window)
                rows = pa.array(found.rows)
                columns = {
                    "c1": pa.array(found.c1.view(np.int64)), "c2": pa.array(found.c2.view(np.int64)),
                    "k1": piece.column("k1").take(rows), "k2": piece.column("k2").take(rows), "pos": pa.array(found.pos),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return name


def _common(rows: np.ndarray) -> np.ndarray:
    """How many leading bytes each row shares with the next."""
    found = np.empty(max(0, len(rows) - 1), np.int64)
    for begin in range(0, len(found), 1 << 13):
        own, after = rows[begin : begin + (1 << 13)], rows[begin + 1 : begin + (1 << 13) + 1]
        differ = own[: len(after)] != after
        found[begin : begin + len(after)] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return found


def previous_factors(places: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For suffixes in order: the longest prefix that each shares with one of a smaller place.

    The previous and the next smaller place in suffix order give it: of all suffixes with smaller places, those two
    are the nearest in order, and share most. One pass with a stack, as each suffix is the next smaller one of those
    that it takes off the stack.
    """
    found = np.zeros(len(places), np.int64)
    stack: list[list[int]] = []  # of a suffix: its number, place, and what it shares with the one below it on the stack
    for i, place in enumerate(places.tolist()):
        shared = int(common[i - 1]) if i else 0
        while stack and stack[-1][1] > place:
            number, _, below = stack.pop()
            found[number] = max(found[number], shared)
            shared = min(shared, below)
        if stack:
            found[i] = shared
        stack.append([i, place, shared])
    return found


def _classes(common: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Of sorted strings: each set that agrees in more bytes than any set around it, as bytes, first and last."""
    stack: list[tuple[int, int]] = []
    for i, shared in enumerate([*common.tolist(), -1]):
        first = i
        while stack and stack[-1][0] > shared:
            depth, first = stack.pop()
            yield depth, first, i
        if shared >= 0 and (not stack or stack[-1][0] < shared):
            stack.append((shared, first))


def repeats_of_group(
    common: np.ndarray, left: np.ndarray, n_left: np.ndarray, places: np.ndarray, window: int, first: bool
) -> tuple[np.ndarray, np.ndarray]:
    """The repeat around each suffix of a group: how far it goes before its anchor and behind it, zero if there is none.

    ``common`` is what neighbours in suffix order share, ``left`` their bytes before the anchor, backwards. All repeats
    of a suffix have its anchor in common, so together they are one.
    """
    before, behind = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
    order = np.argsort(np.ascontiguousarray(left).view(f"S{left.shape[1]}")[:, 0], kind="stable")
    shared_left = np.minimum(_common(left[order]), np.minimum(n_left[order][1:], n_left[order][:-1]))
    for depth, low, high in _classes(shared_left):
        ranks = np.sort(order[low : high + 1])
        shared = np.minimum.reduceat(common[: ranks[-1]], ranks[:-1])
        if depth + shared.max() < window:
            continue
        factors = previous_factors(places[ranks], shared)
        if not first:
            factors = np.maximum(factors, previous_factors(-places[ranks], shared))
        long = depth + factors >= window
        before[ranks[long]] = np.maximum(before[ranks[long]], depth)
        behind[ranks[long]] = np.maximum(behind[ranks[long]], factors[long])
    return before, behind


def _factors(window: int, first: bool):
    """c1, c2, own_k1, own_pos, and how far the repeat goes around the first place of a suffix, and around its others."""

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            cores = batch.column("core").to_numpy()
            ends = np.flatnonzero(cores[1:] != cores[:-1]) + 1
            if held and batch.num_rows and held[-1].column("core")[held[-1].num_rows - 1].as_py() != cores[0]:
                ends = np.append(0, ends)
            if not len(ends):
                held.append(batch)
                continue
            # groups before the last one are whole
            yield from whole([*held, batch.slice(0, ends[-1])])
            held = [batch.slice(ends[-1])]
        if held:
            yield from whole(held)

    def whole(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts).combine_chunks()
        if rows.num_rows:
            yield _spans(rows.to_batches()[0], window, first)

    return follow


def _spans(rows: pa.RecordBatch, window: int, first: bool) -> pa.RecordBatch:
    width = 2 * window - GRAM
    column = {name: rows.column(name).to_numpy(zero_copy_only=False) for name in rows.schema.names if name != "context"}
    # equal suffixes of different slices are neighbours: one suffix, the least place of which is its place
    head = np.ones(rows.num_rows, bool)
    head[1:] = (column["c1"][1:] != column["c1"][:-1]) | (column["c2"][1:] != column["c2"][:-1])
    head[1:] |= column["core"][1:] != column["core"][:-1]
    number = np.cumsum(head) - 1
    order = np.lexsort((column["pos"], column["k1"], column["first_id"], number))
    least = order[np.flatnonzero(np.append(True, number[order][1:] != number[order][:-1]))]
    heads = np.flatnonzero(head)
    several = np.logical_or.reduceat(column["several"], heads) | (np.diff(np.append(heads, rows.num_rows)) > 1)
    n_left, n_right, cores = (column[name][heads].astype(np.int64) for name in ("n_left", "n_right", "core"))
    context = rows.column("context")
    begin = np.frombuffer(context.buffers()[1], np.int32)[context.offset]
    bytes_ = np.frombuffer(context.buffers()[2], np.uint8)[begin : begin + rows.num_rows * width].reshape(-1, width)[heads]
    right, left = bytes_[:, :window], bytes_[:, window:]
    common = np.minimum(_common(right), np.minimum(n_right[1:], n_right[:-1]))
    places = np.empty(len(heads), np.int64)
    places[np.lexsort((column["pos"][least], column["k1"][least], column["first_id"][least]))] = np.arange(len(heads))
    before, behind = np.zeros(len(heads), np.int64), np.zeros(len(heads), np.int64)
    edges = np.flatnonzero(np.append(True, cores[1:] != cores[:-1]))
    sizes = np.diff(np.append(edges, len(cores)))
    # groups of two are one comparison before the anchor and one behind it
    twos = edges[sizes == 2]
    pair = np.stack([twos, twos + 1], axis=1).reshape(-1)
    d = np.minimum(_common(left[pair])[::2], np.minimum(n_left[twos], n_left[twos + 1])) if len(twos) else twos
    long = d + common[twos] >= window if len(twos) else np.zeros(0, bool)
    for i in (twos, twos + 1):
        told = long & (places[i] > places[2 * twos + 1 - i]) if first else long
        before[i[told]], behind[i[told]] = d[told], common[twos[told]]
    for e, size in zip(edges[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
        own = slice(e, e + size)
        before[own], behind[own] = repeats_of_group(common[e : e + size - 1], left[own], n_left[own], places[own], window, first)
    # at several places, all of the suffix and of the bytes before it repeats, at its first place too unless that stays
    whole = several & (n_left + n_right >= window)
    other_before, other_behind = np.where(whole, n_left, before), np.where(whole, n_right, behind)
    if not first:
        before, behind = other_before, other_behind
    told = np.flatnonzero((behind > 0) | (other_behind > 0))
    at = least[told]
    columns = {"c1": column["c1"][at], "c2": column["c2"][at], "own_k1": column["k1"][at], "own_pos": column["pos"][at]}
    for name, values in (("before", before), ("behind", behind), ("other_before", other_before), ("other_behind", other_behind)):
        columns[name] = values[told].astype(np.int32)
    return pa.RecordBatch.from_pydict({name: pa.array(values) for name, values in columns.items()})


_FACTORS = "c1 long, c2 long, own_k1 long, own_pos int, before int, behind int, other_before int, other_behind int"
_CUT = "k1 long, k2 long, first_id long, n long, n_bytes long, removed array<struct<begin: int, end: int>>, kept binary"


def _without(window: int, first: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, most=_SLICE):
                removed, kept, sizes = [], [], []
                for text, n, marks in zip(piece.column("text"), piece.column("n").to_pylist(), piece.column("marks"), strict=True):
                    data = (buffer := text.as_buffer()) and buffer.to_pybytes() or b""
                    spans = _united(np.asarray(marks.values) if marks.is_valid else np.zeros(0, np.int64))
                    if n > 1 and len(data) >= window and not first:
                        spans = [(0, len(data))]
                    stays = [0, *(x for span in spans for x in span), len(data)]
                    kept.append(b"".join(data[b:e] for b, e in zip(stays[::2], stays[1::2], strict=True)))
                    removed.append([{"begin": b, "end": e} for b, e in spans])
                    sizes.append(len(data))
                columns = [piece.column(name) for name in ("k1", "k2", "first_id", "n")]
                span = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
                columns += [pa.array(sizes, pa.int64()), pa.array(removed, span), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["k1", "k2", "first_id", "n", "n_bytes", "removed", "kept"])

    return cut


def _united(marks: np.ndarray) -> list[tuple[int, int]]:
    """Marks (begin in the high 32 bits, end in the low) as maximal spans, in order. Spans that touch are one."""
    if not len(marks):
        return []
    marks = np.sort(marks)
    begins, ends = marks >> 32, np.maximum.accumulate(marks & 0xFFFFFFFF)
    new = np.flatnonzero(np.append(True, begins[1:] > ends[:-1]))
    return list(zip(begins[new].tolist(), ends[np.append(new[1:] - 1, len(ends) - 1)].tolist(), strict=True))


def cut_texts(docs: DataFrame, window: int = WINDOW, keep: str = "none", most_places: int = MOST_PLACES) -> DataFrame:
    """k1, k2, first_id, n, n_bytes, ``removed`` (spans), ``kept``: every distinct text, of n documents, without repeats.

    With ``keep="first"`` it is what the text's first document keeps; the others keep nothing if it has a window.
    """
    if window <= 2 * GRAM or keep not in ("none", "first"):
        raise ValueError(f"a window needs more than {2 * GRAM} bytes, and keep is none or first")
    first = keep == "first"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_text_keys(), "text")
    key = ["k1", "k2"]
    anchors = rows.select(*key, "text").mapInArrow(_anchors(window), "core long, k1 long, k2 long, anchor long")
    anchors = written(anchors, "copies-anchors")
    place = F.xxhash64(*key, "anchor")
    twice = anchors.groupBy("core").agg(F.min(place).alias("least"), F.max(place).alias("most"), F.count("*").alias("n"))
    twice = twice.filter("least <> most").select("core", (F.col("n") > most_places).alias("is_hot"))
    # few and short rows: with a file for each partition, tasks would do little but make files
    twice = written(twice.repartition(docs.sparkSession.sparkContext.defaultParallelism), "copies-cores")
    met = anchors.join(twice.hint("merge"), "core")
    chosen = (F.collect_set(F.when(hot, F.col("anchor"))) for hot in (~F.col("is_hot"), F.col("is_hot")))
    lists = met.groupBy(*key).agg(*(c.alias(name) for c, name in zip(chosen, ("anchors", "hot"), strict=True)))
    # one exchange of the texts serves the suffixes, their places, and the cut
    texts = rows.groupBy(*key).agg(F.first("text").alias("text"), F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
    anchored = texts.join(lists.hint("merge"), key)
    suffixes = anchored.mapInArrow(_suffixes(window), _SUFFIX).repartition("core").sortWithinPartitions("core", "context")
    factors = suffixes.mapInArrow(_factors(window, first), _FACTORS)
    members = anchored.mapInArrow(_members(window), "c1 long, c2 long, k1 long, k2 long, pos int")
    told = members.join(factors.hint("merge"), ["c1", "c2"])
    own = (F.col("own_k1") == F.col("k1")) & (F.col("own_pos") == F.col("pos"))
    begin = F.col("pos").cast("long") - F.when(own, F.col("before")).otherwise(F.col("other_before"))
    behind = F.when(own, F.col("behind")).otherwise(F.col("other_behind"))
    mark = (F.shiftleft(begin, 32) + F.col("pos") + behind).alias("mark")
    marks = told.filter(behind > 0).select(*key, mark)
    if not twice.filter("is_hot").isEmpty():
        marks = marks.unionByName(_hot_marks(anchored, window, first))
    marks = marks.groupBy(*key).agg(F.collect_set("mark").alias("marks"))
    return texts.join(marks.hint("merge"), key, "left").select(*key, "text", "first_id", "n", "marks").mapInArrow(_without(window, first), _CUT)


def _hot_marks(anchored: DataFrame, window: int, first: bool) -> DataFrame:
    """k1, k2, mark: the windows around the places of much-used cores that are several times there."""
    columns = "w1 long, w2 long, first_id long, k1 long, k2 long, begin long"
    windows = anchored.where(F.size("hot") > 0).mapInArrow(_windows(window), columns)
    place = F.struct("first_id", "k1", "begin")
    several = windows.groupBy("w1", "w2").agg(F.min(place).alias("least"), F.max(place).alias("most")).filter("least <> most")
    several = written(several.select("w1", "w2", "least"), "copies-windows")
    found = windows.join(several.hint("merge"), ["w1", "w2"])
    if first:
        found = found.filter(place != F.col("least"))
    return found.select("k1", "k2", (F.shiftleft("begin", 32) + F.col("begin") + window).alias("mark"))


def of_documents(docs: DataFrame, cut: DataFrame, window: int = WINDOW, keep: str = "none") -> DataFrame:
    """doc_id and ``whole``, with the columns of the cut texts, for each document.

    ``whole``: the document loses all its bytes, as it is a later copy of a text that keeps its first.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *_text_keys())
    joined = rows.groupBy("doc_id", "k1", "k2").agg(F.count("*").alias("alike")).join(cut.hint("merge"), ["k1", "k2"])
    joined = joined.withColumn("number", F.explode(F.sequence(F.lit(1).cast("long"), "alike")))
    later = ~(F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("number") == 1))
    whole = later & (F.col("n_bytes") >= window) if keep == "first" else F.lit(False)
    return joined.withColumn("whole", whole).drop("k1", "k2", "alike", "number", "first_id", "n")


def without_copies(docs: DataFrame, window: int = WINDOW, keep: str = "none", most_places: int = MOST_PLACES) -> DataFrame:
    """doc_id, n_bytes, ``removed`` (spans), ``kept`` (binary) for every document."""
    found = of_documents(docs, cut_texts(docs, window, keep, most_places), window, keep)
    all_of_it = F.array(F.struct(F.lit(0).alias("begin"), F.col("n_bytes").cast("int").alias("end")))
    return found.select(
        "doc_id", "n_bytes", F.when(F.col("whole"), all_of_it).otherwise(F.col("removed")).alias("removed"),
        F.when(F.col("whole"), F.lit(b"")).otherwise(F.col("kept")).alias("kept"),
    )
