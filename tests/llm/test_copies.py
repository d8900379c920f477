"""Suffix-array dedup against brute force."""

from __future__ import annotations

import random
import tracemalloc
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from specflow.llm import LLM_QUERIES, copies
from specflow.sinks.storage import shared_folder


def _removed(texts: list[bytes], window: int) -> list[list[tuple[int, int]]]:
    """Brute force: the maximal spans covered by strings of ``window`` bytes that start at two places."""
    starts = defaultdict(list)
    for t, text in enumerate(texts):
        for i in range(len(text) - window + 1):
            starts[text[i : i + window]].append((t, i))
    gone = [np.zeros(len(t) + 2, bool) for t in texts]
    for places in starts.values():
        if len(places) > 1:
            for t, i in places:
                gone[t][i + 1 : i + window + 1] = True
    edges = [np.flatnonzero(g[1:] != g[:-1]) for g in gone]
    return [list(zip(e[::2].tolist(), e[1::2].tolist(), strict=True)) for e in edges]


def _expected(rows, window):
    spans = _removed([(t or "").encode() for _, t in rows], window)
    out = Counter()
    for (doc_id, text), own in zip(rows, spans, strict=True):
        data, at, kept = (text or "").encode(), 0, b""
        for b, e in own:
            kept, at = kept + data[at:b], e
        out[doc_id, len(data), tuple(own), kept + data[at:]] += 1
    return out


def _found(docs, window, keep="none", most_places=copies.MOST_PLACES):
    rows = copies.without_copies(docs, window, keep, most_places).collect()
    return Counter((r.doc_id, r.n_bytes, tuple((s.begin, s.end) for s in r.removed), bytes(r.kept)) for r in rows)


def _mosaics(seed: int, n: int) -> list[str]:
    """Texts of shared and own pieces, cut anywhere and changed here and there: repeats of all lengths around a window."""
    draw = random.Random(seed)
    pool = ["".join(draw.choice("abcdeé \n") for _ in range(draw.choice((30, 120, 200, 260, 420)))) for _ in range(12)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(draw.randrange(1, 7)):
            piece = draw.choice(pool)
            a, b = sorted(draw.sample(range(len(piece) + 1), 2)) if draw.random() < 0.5 else (0, len(piece))
            piece = piece[a:b]
            if draw.random() < 0.3 and piece:
                k = draw.randrange(len(piece))
                piece = piece[:k] + draw.choice(("X", "", "YZ")) + piece[k + 1 :]
            parts.append(piece)
        texts.append("".join(parts))
    return texts


@pytest.mark.parametrize("seed, most_places", [(0, copies.MOST_PLACES), (1, copies.MOST_PLACES), (2, copies.MOST_PLACES), (3, 0), (4, 9)])
def test_mosaics(docs_of, seed, most_places):
    """Whether no group, all groups or some are too large for a task."""
    rows = list(enumerate(_mosaics(seed, 150)))
    expected = _expected(rows, 150)
    assert _found(docs_of(rows), 150, most_places=most_places) == expected
    assert sum(bool(r[2]) for r in expected) > 40 and any(len(r[2]) > 1 for r in expected)


def test_odd_texts(docs_of):
    """Periodic and constant texts, zero bytes, ends of texts that are beginnings of others, repeated rows, missing ids and texts."""
    base = "".join(random.Random(5).choice("pqrstuvw") for _ in range(900))
    rows = [
        (1, "a" * 1000), (2, "b" + "a" * 299), (3, "ab" * 400), (4, "abc" * 100 + "x" + "abc" * 100), (5, "\x00" * 500), (6, "z" + "\x00" * 300),
        (7, base), (8, base[:300]), (9, base[200:460] + "!"), (10, base[641:]), (11, "?" + base[750:]), (12, None), (13, ""), (14, "short"),
        (15, "short"), (16, "ü" * 200), (16, "ü" * 200), (None, "q" * 10), (None, base[:299]), (17, "y" * 150), (18, "y" * 151), (19, "w" * 150),
    ]
    assert _found(docs_of(rows), 150) == _expected(rows, 150)
    assert copies.without_copies(docs_of([])).collect() == []
    assert _found(docs_of([(None, base), (None, base)]), 400) == {(None, 900, ((0, 900),), b""): 2}


@pytest.mark.parametrize("most_places", [copies.MOST_PLACES, 0])
def test_first_copies_stay(docs_of, most_places):
    """With keep="first" each string that repeats is removed at all places but its first, by id."""
    texts = _mosaics(7, 80)
    rows = [(100 + i, t) for i, t in enumerate(texts)] + [(5, texts[3]), (5, texts[3]), (None, texts[9])]
    window = 150
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0]))
    seen, expected = {}, Counter()
    for i in order:
        data = (rows[i][1] or "").encode()
        stays = np.ones(len(data), bool)
        for at in range(len(data) - window + 1):
            if seen.setdefault(data[at : at + window], (i, at)) != (i, at):
                stays[at : at + window] = False
        expected[rows[i][0], np.frombuffer(data, np.uint8)[stays].tobytes()] += 1
    found = Counter()
    for (doc_id, _, _, kept), n in _found(docs_of(rows), window, "first", most_places).items():
        found[doc_id, kept] += n
    assert sum(found.values()) == len(rows)
    # texts of one id that are equal have no order; all others do
    assert found == expected


def test_factors_against_brute_force():
    draw = random.Random(2)
    for _ in range(200):
        words = sorted({"".join(draw.choice("ab") for _ in range(draw.randrange(1, 9))) for _ in range(draw.randrange(1, 12))})
        places = np.array(draw.sample(range(100), len(words)))

        def shared(a, b):
            n = 0
            while n < min(len(a), len(b)) and a[n] == b[n]:
                n += 1
            return n

        common = np.array([shared(a, b) for a, b in zip(words, words[1:], strict=False)], np.int64)
        expected = [max((shared(w, v) for v, q in zip(words, places, strict=True) if q < p), default=0) for w, p in zip(words, places, strict=True)]
        assert copies.previous_factors(places, common).tolist() == expected
        classes = {(d, i, j) for d, i, j in copies._classes(common)}
        wanted = set()
        for i in range(len(words)):
            for j in range(i + 1, len(words)):
                d = int(common[i:j].min())
                if (i == 0 or common[i - 1] < d) and (j == len(words) - 1 or common[j] < d):
                    wanted.add((d, i, j))
        assert classes == wanted


def test_anchors_are_found_in_little_memory():
    """A worker hashes a quarter of a megabyte at a time, whatever a batch has."""
    draw = random.Random(8)
    texts = ["".join(draw.choices("abcdefgh \n", k=4000)) for _ in range(300)]
    keys = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_pydict({"k1": keys, "k2": keys, "text": texts})
    find = copies._anchors(copies.WINDOW)
    n = sum(found.num_rows for found in find(iter([batch])))
    tracemalloc.start()
    try:
        assert sum(found.num_rows for found in find(iter([batch]))) == n > 10_000
        assert tracemalloc.get_traced_memory()[1] < 32_000_000
    finally:
        tracemalloc.stop()


def test_cores_are_few_files(spark, docs_of):
    """Cores that occur twice are short rows: however many the partitions, they make no more files than tasks run at once."""
    rows = list(enumerate(_mosaics(9, 150)))
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.rglob("llm-copies-cores-*"))
    settings = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        assert _found(docs_of(rows), 150) == _expected(rows, 150)
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
    (made,) = set(folder.rglob("llm-copies-cores-*")) - before
    files = list(made.glob("part-*"))
    assert 0 < len(files) <= spark.sparkContext.defaultParallelism
    assert spark.read.parquet(str(made)).count() > 60


def test_documents(spark, sf_dir, texts):
    """The query over the whole table."""
    import hashlib

    rows = LLM_QUERIES["op12_copies"](spark, sf_dir).collect()
    found = {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows}
    expected = {
        (i, n, sum(e - b for b, e in spans), len(spans), hashlib.sha256(kept).hexdigest())
        for i, n, spans, kept in _expected(sorted(texts.items()), copies.WINDOW)
    }
    assert len(rows) == len(texts) and found == expected and sum(r.n_removed > 0 for r in rows) > 50
