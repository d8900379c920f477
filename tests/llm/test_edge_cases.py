"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, for every operator on documents."""

from __future__ import annotations

import hashlib

import pytest
from conftest import fold
from pyspark.sql import functions as F

from specflow.llm import exact_dedup, fingerprints, language, mixing, near_dedup, packing, repeats, tables, tokens, toxicity
from specflow.llm.queries import tokenizer_path

LONG = " ".join(f"w{i % 9000}" for i in range(60_000))
ROWS = [
    (1, "a b c d e f g", "en", "s"),
    (1, "a b c d e f g", "en", "s"),
    (2, None, None, None),
    (3, "", "en", "s"),
    (4, " \t ", "de", "s"),
    (None, "a b c d e f g", "en", "s"),
    (None, None, None, None),
    (5, LONG, "en", "t"),
    (6, LONG, "de", None),
    (7, "123 !!", "de", "t"),
    (8, "ü", "de", "t"),
]

RUNS = {
    "toxicity": lambda d: toxicity.toxicity(d, d.sparkSession.createDataFrame([(1, 1), (1, 0), (None, 1), (5, None)], "doc_id long, toxic int")),
    "fingerprints": fingerprints.fingerprints,
    "near": near_dedup.near_duplicates,
    "language": language.languages,
    "packing": packing.pieces,
    "tokens": lambda d: tokens.token_counts(d, tokenizer_path()),
    "exact": exact_dedup.exact_duplicates,
    "mixing": mixing.mixed,
    "repeats": repeats.without_repeats,
}


@pytest.mark.parametrize("name", sorted(RUNS))
def test_empty_table(docs_of, name):
    assert RUNS[name](docs_of([])).collect() == []


@pytest.mark.parametrize("name", sorted(set(RUNS) - {"packing"}))
def test_one_row_for_each_row(docs_of, name):
    found = RUNS[name](docs_of(ROWS)).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in ROWS)


def test_exact(docs_of):
    found = {(r.doc_id, r.kept): r for r in exact_dedup.exact_duplicates(docs_of(ROWS)).collect()}
    assert found[1, True].group_size == found[1, False].group_size == found[None, False].group_size == 3
    assert found[3, False].keep_id == 2 and found[2, True].group_size == 3  # null and empty texts
    assert found[4, True].text_sha256 == hashlib.sha256(b" ").hexdigest()
    assert found[6, False].keep_id == 5
    alone = exact_dedup.exact_duplicates(docs_of([(None, "x"), (None, "x"), (None, "y")])).collect()
    assert sorted((r.keep_id is None, r.kept, r.group_size) for r in alone) == [(True, False, 2), (True, True, 1), (True, True, 2)]


def test_exact_splits_at_every_length(docs_of):
    ends = [0, 1, 63, 64, 65, 511, 512, 513, 4096, 4608, 4609, 33000, 40000]
    base = "x" * 50_000
    rows = [(i, base[:n]) for i, n in enumerate(ends)] + [(100 + i, base[:n]) for i, n in enumerate(ends)]
    rows += [(200 + i, base[:n] + "é") for i, n in enumerate(ends)]
    found = {r.doc_id: r for r in exact_dedup.exact_duplicates(docs_of(rows)).collect()}
    for i in range(len(ends)):
        assert (found[100 + i].keep_id, found[100 + i].group_size, found[i].kept) == (i, 2, True)
        assert found[200 + i].group_size == 1


def test_near(docs_of):
    found = near_dedup.near_duplicates(docs_of(ROWS)).collect()
    same = [r for r in found if r.class_id == 1]
    assert len(same) == 3 and sum(r.kept for r in same) == 1 and {r.class_size for r in same} == {3}
    assert all(r.kept and r.class_size == 1 for r in found if r.doc_id in (2, 3, 4, 7, 8))
    assert {r.class_id for r in found if r.doc_id in (5, 6)} == {5}


def test_language(docs_of):
    found = {r.doc_id: r for r in language.languages(docs_of(ROWS)).collect()}
    assert {found[i].lang_pred for i in (2, 3, 4, 7)} == {"und"}
    assert found[8].lang_pred != "und" and all(0 <= r.score <= 1 for r in found.values())
    assert not found[None].held_out
    assert [found[i].held_out for i in range(1, 9)] == [fold(i) == 2 for i in range(1, 9)]


def test_language_sample(spark):
    """The least hashes of each language, counted by text, also where copies of one row are a third of all."""
    rows = [(i, f"t{i}", "en" if i % 5 else "de") for i in range(6_000)] + [(1, "t1", "en")] * 3_000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    drawn = sorted((r.lang, r.draw, r.doc_id) for r in docs.distinct().select("lang", "doc_id", F.xxhash64("doc_id").alias("draw")).collect())
    expected = {d for lang in ("de", "en") for d in [x[2] for x in drawn if x[0] == lang][:50]}
    found = [r.doc_id for r in language.sampled(docs, 50).collect()]
    assert len(found) == 100 and set(found) == expected


def test_fingerprints(docs_of):
    found = {}
    for r in fingerprints.fingerprints(docs_of(ROWS)).collect():
        found.setdefault(r.doc_id, []).append(r)
    assert len({r.fingerprint for r in found[1] + found[None] if r.n_chars}) == 1
    assert found[2][0].n_chars == 0 and found[2][0].edited_sha256 == hashlib.sha256(b"").hexdigest()
    assert found[5][0].near_next == 1.0


def test_fingerprints_of_many_rows_without_ids(docs_of):
    """Ranges of rows without an id, followed by those with one, give what one range gives."""
    docs = docs_of([(i if i % 3 else None, f"text number {i * i}") for i in range(200)])
    columns = ("doc_id", "text", "halo")

    def printed(rows_per_range):
        rows = fingerprints.with_next(docs, rows_per_range).select(*columns)
        return {tuple(r) for r in rows.mapInArrow(fingerprints._compare, fingerprints.RESULT).collect()}

    assert printed(7) == printed(1_000) and len(printed(7)) == 200
    parts = fingerprints.with_next(docs, 7).filter("doc_id is null and not halo").groupBy("part").count().collect()
    assert len(parts) >= 8 and max(r["count"] for r in parts) <= 25


def test_toxicity_sample(spark):
    rows = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(8_000)], "id long, toxic int")
    expected = [r.id for r in rows.filter("toxic = 1").orderBy(F.xxhash64("id"), "id").limit(100).collect()]
    assert sorted(r.id for r in toxicity._drawn(rows, 1, 100).collect()) == sorted(expected)
    assert toxicity._drawn(rows, 1, 5_000).count() == 2_000 and toxicity._drawn(rows, 2, 5).count() == 0


def test_repeats(docs_of):
    found = {r.doc_id: r for r in repeats.without_repeats(docs_of(ROWS)).collect()}
    assert (found[5].n_words, found[5].n_removed, found[5].kept) == (60_000, 60_000, "")
    assert (found[1].n_words, found[1].n_removed, found[1].kept) == (7, 0, "a b c d e f g")
    assert (found[4].n_words, found[4].kept) == (0, "")


def test_mixing(docs_of):
    found = mixing.mixed(docs_of(ROWS)).collect()
    assert all(r.taken <= 2 * r["size"] for r in found)
    by = {r.doc_id: r for r in found}
    assert by[2]["size"] == by[3]["size"] == 0 and by[6].source_size == 60_000


def test_packing(docs_of):
    found = packing.pieces(docs_of(ROWS)).collect()
    assert {r.doc_id for r in found} == {1, None, 5, 6, 7, 8}
    assert sum(r.n_tokens for r in found) == 7 * 3 + 2 * 60_000 + 3


def test_packed_has_documents_without_words(docs_of):
    found = packing.packed(docs_of(ROWS)).collect()
    assert {r.doc_id for r in found} == {r[0] for r in ROWS}
    assert sorted(str(r.doc_id) for r in found if r.bin is None) == ["2", "3", "4", "None"]
    assert len(found) == packing.pieces(docs_of(ROWS)).count() + 4


def test_packing_keeps_long_ids_beside_a_missing_one(docs_of):
    ids = [2**53 + 1, 2**53 + 2, 2**62 + 1, -(2**62) - 1, 2**63 - 1, None]
    found = packing.pieces(docs_of([(i, f"a b {n}") for n, i in enumerate(ids)])).collect()
    assert len({r.pack_group for r in found}) == 1
    assert sorted(map(str, (r.doc_id for r in found))) == sorted(map(str, ids))


def test_toxicity(docs_of):
    rows = [(1, "You іdi0t, you  ST@PID m0r0n."), (2, "the loser bracket"), (3, None), (4, ""), (5, "a fine day, mormon")]
    found = {r.doc_id: r for r in RUNS["toxicity"](docs_of(rows)).collect()}
    assert found[1].predicted == 1
    assert all(found[i].score == 0 for i in (2, 3, 4, 5))


def test_repeats_without_ids(docs_of):
    """Rows without an id lose the same words as if they had one, whichever of them are alike."""
    shared = " ".join(f"s{i}" for i in range(40))
    rows = [f"{' '.join(f'a{n}b{i}' for i in range(20))} {shared if n % 3 else ''}" for n in range(30)]
    rows += [rows[0], rows[1], rows[1], None, None, ""]
    given = docs_of(list(enumerate(rows)))
    cut = [repeats.without_repeats(docs) for docs in (given, given.withColumn("doc_id", F.lit(None).cast("long")))]
    found = [sorted(map(tuple, df.select("n_words", "n_removed", "kept").collect())) for df in cut]
    assert found[0] == found[1] and len(found[0]) == len(rows)
    assert sum(removed for _, removed, _ in found[0]) >= 20 * 40


@pytest.mark.parametrize("tag_bits", [tables.TAG_BITS, 1])
def test_repeats_of_many_rows_alike(docs_of, monkeypatch, tag_bits):
    """Places grow with the words, not with the square of a group: copies of a row, with and without id, and texts of one id."""
    def text(name, n):
        return " ".join(f"{name}{i}" for i in range(n))

    rows = [(1, text("a", 60))] * 400 + [(None, text("b", 60))] * 400 + [(2, f"c{n} {text('c', 60)}") for n in range(400)]
    rows += [(3, text("a", 40)), (3, "x"), (None, text("b", 36)), (4, text("d", 60)), (5, "y z"), (5, "y z")]
    if tag_bits == tables.TAG_BITS:
        lists = repeats.repeated_starts(docs_of(rows)).select("places").collect()
        assert sum(len(r.places or []) for r in lists) <= sum(len(row[1].split()) for row in rows)
    monkeypatch.setattr(tables, "TAG_BITS", tag_bits)  # with one bit, texts of one id are told apart by number
    found = [tuple(r) for r in repeats.without_repeats(docs_of(rows)).collect()]
    expected = [(1, 60, 60, "")] * 400 + [(None, 60, 60, "")] * 400 + [(2, 61, 60, f"c{n}") for n in range(400)]
    expected += [(3, 40, 40, ""), (3, 1, 0, "x"), (None, 36, 36, ""), (4, 60, 0, text("d", 60)), (5, 2, 0, "y z"), (5, 2, 0, "y z")]
    assert sorted(found, key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("limit", ["BLOCK", "BLOCK_WEIGHT"])
def test_near_in_small_blocks(documents, monkeypatch, limit):
    """Dealing a bucket out in blocks finds the same classes, whether texts or words are many."""
    monkeypatch.setattr(near_dedup, "SMALL", 1)
    whole = {tuple(r) for r in near_dedup.near_duplicates(documents).select("doc_id", "class_id").collect()}
    monkeypatch.setattr(near_dedup, limit, 2)
    assert {tuple(r) for r in near_dedup.near_duplicates(documents).select("doc_id", "class_id").collect()} == whole
