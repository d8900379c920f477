"""Spelling variants and phrases against brute force."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql.classic import dataframe as classic

from specflow.llm import filters, phrases, spelling

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _words(rows, deletes):
    n: Counter = Counter()
    for doc_id, text in rows:
        for run in _RUN.findall(text or ""):
            run = run.translate(_LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % deletes == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def _near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def _variants(rows, deletes=spelling.DELETES):
    n = _words(rows, deletes)
    near = {w: [x for x in n if _near(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


@pytest.mark.parametrize("filter_bytes", [spelling.FILTER_BYTES, 256])
def test_spelling(spark, documents, filter_bytes):
    """Real texts with many deletions; with a small filter the vocabulary is probed in parts."""
    rows = [(r.doc_id, r.text) for r in documents.limit(150).collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = spelling.variants(df, deletes=7, filter_bytes=filter_bytes)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    found = [tuple(r) for r in found.collect()]
    expected = _variants(rows, deletes=7)
    assert len(found) == len(expected) > 100 and set(found) == expected
    assert sum(r[4] > 0 for r in expected) > 20 and any(r[1] for r in expected)


def test_spelling_of_odd_words(docs_of):
    """Every kind of edit, ties, chains of forms, letters beyond ASCII, case, long words, missing ids and texts."""
    long = "xy" * 5000
    counts = {
        "ababab": 5, "abababa": 25, "abababab": 125, "aababab": 25, "éàÿ×÷ß": 30, "éàÿ×÷ÿ": 6, "aaaaaa": 5, "aaaaaaa": 5, "aaaaaaaa": 4,
        long: 5, long[:-1]: 6, long + "é": 40, "STRASSE": 7, "strasze": 36, "ÄRGERN": 5, "ärgern": 5, "zzzzzzz": 9,
    }
    rows = [(i % 3 or None, " ".join([w] * n) + ".") for i, (w, n) in enumerate(counts.items())]
    rows += [(5, None), (6, ""), (7, "1 2 3"), (8, "abababab1abababab"), (1, "strasse strasse"), (1, "strasse strasse")]
    found = spelling.variants(docs_of(rows), deletes=10**6)
    assert {tuple(r) for r in found.collect()} == _variants(rows, 10**6)
    by = {r[0]: r for r in _variants(rows, 10**6)}
    assert by["ababab"][2] == "abababab" and by["ababab"][1] == "aababab"
    assert spelling.variants(docs_of([])).collect() == []


def test_filters(spark):
    keys = np.random.default_rng(1).integers(0, 1 << 64, 5000, np.uint64)
    n_blocks = filters.blocks_for(len(keys), 1 << 20)
    rows = [(int(k), int(b)) for k, b in zip(keys.view(np.int64), filters.block_of(keys, n_blocks), strict=True)]
    table = filters.filter_of(spark.createDataFrame(rows, "key long, block long"), n_blocks)
    others = np.random.default_rng(2).integers(0, 1 << 64, 100_000, np.uint64)
    assert filters.contains(table, keys).all() and filters.contains(table, others).mean() < 0.01
    assert filters.blocks_for(10**12, 1 << 20) * 64 == 1 << 20


def test_filters_are_built_in_one_python_pass(spark, monkeypatch):
    """A second one would have a second worker in each task, whose memory an executor keeps."""
    plans, real = [], classic.DataFrame.toArrow

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df)

    monkeypatch.setattr(classic.DataFrame, "toArrow", seen)
    pairs = spark.createDataFrame([(i, -i) for i in range(1, 200)], "c1 long, c2 long")
    table = phrases._filter(spark, pairs, 1 << 20).value
    ids = np.arange(1, 200)
    assert filters.contains(table, phrases._hash(np.stack([ids, -ids], axis=1).view(np.uint64))).all()
    words = spark.createDataFrame([("abcdef", 9), ("abcdeg", 7), ("klmnop", 5)], "word string, n long")
    words = words.mapInArrow(spelling._keyed, "key long, word string, n long").localCheckpoint()
    assert spelling.neighbours(words).count() == 2
    assert [plan.count("MapInArrow") for plan in plans] == [1, 1]


def _collocations(rows, least, top, covered=80):
    split, words = re.compile("[.,;:!?\n\x0b\x0c\r]"), re.compile("[^ \t]+")
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in split.split((text or "").translate(_LOWER)):
            w = tuple(words.findall(piece))
            n[lang] += len(w)
            f.update((lang, w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    cands = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    gone = set()
    for (lang, w), a in cands.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                if 100 * a >= covered * cands[lang, w[i : i + k]]:
                    gone.add((lang, w[i : i + k]))
    out = []
    for lang in n:
        scored = []
        for (of, w), a in cands.items():
            if of == lang and (of, w) not in gone:
                cuts = [(2000000 * a // (f[of, w[:k]] + f[of, w[k:]]), k) for k in range(1, len(w))]
                score, k = min(cuts)
                scored.append((-score, -a, " ".join(w).encode(), f[of, w[:k]], f[of, w[k:]]))
        for rank, (s, a, phrase, left, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, r, n[lang], -s))
    return Counter(out)


def _phrase_rows(docs):
    return [(r.text, r.lang) for r in docs.collect()]


@pytest.mark.parametrize("top", [2000, 7])
def test_phrases(documents, top):
    docs = documents.limit(400)
    found = phrases.collocations(docs, least=6, top=top)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert Counter(tuple(r) for r in found.collect()) == _collocations(_phrase_rows(docs), 6, top)


def test_phrases_of_odd_texts(docs_of):
    rows = [
        (1, "A b C. a B c! a b c", None), (2, "a b c", "und"), (2, "a b c", "und"), (3, None, "en"), (4, "", None), (5, "x", "xx"),
        (None, "é é é é é é\té  é", "en"), (6, "a b\vc\x0ed \x00 a b", "en"), (7, "a,b;c:d " * 3000, "de"), (8, "p q " * 3000, "de"),
        (9, "Ä ä A a b " * 20, "ö"),
    ]
    docs = docs_of(rows)
    for least in (1, 2, 4):
        found = Counter(tuple(r) for r in phrases.collocations(docs, least=least).collect())
        assert found == _collocations([(t, lang) for _, t, lang in rows], least, 2000)
    assert phrases.collocations(docs_of([])).collect() == []


def test_trie_bursts_and_spills(monkeypatch):
    """However small its containers and its room, a trie's runs add up, and each is sorted."""
    monkeypatch.setattr(phrases, "BURST", 50)
    monkeypatch.setattr(phrases, "BUFFERED", 20)
    monkeypatch.setattr(phrases, "HELD", 400)
    draw = np.random.default_rng(3)
    ids = draw.integers(0, 1 << 64, 60, np.uint64)
    given = ids[np.minimum(draw.zipf(1.3, (5000, 2)) - 1, 59)]
    trie = phrases.HatTrie(2)
    runs = [run for begin in range(0, 5000, 700) for run in trie.add(given[begin : begin + 700])]
    runs += list(trie.rest())
    found: Counter = Counter()
    for run in runs:
        rows = list(zip(*(run.column(i).to_numpy().view(np.uint64).tolist() for i in range(2)), strict=True))
        assert rows == sorted(rows)
        for row, n in zip(rows, run.column("n").to_pylist(), strict=True):
            found[row] += n
    assert found == Counter(map(tuple, given.tolist())) and len(runs) > 20 and trie.held == 0


def test_colliding_ids_are_drawn_anew(docs_of, monkeypatch):
    """Two words that share an id under one seed get other ids under the next."""
    real = phrases._vocabulary

    def colliding(seed):
        def count(batches):
            for batch in real(seed)(batches):
                ids = batch.column("id").to_numpy()
                yield batch.set_column(0, "id", pa.array(ids % 2 if seed == 0 else ids))

        return count

    monkeypatch.setattr(phrases, "_vocabulary", colliding)
    words, seed = phrases.vocabulary(docs_of([(1, "a b c d e", "en")]))
    assert seed == 1 and words.count() == 5
