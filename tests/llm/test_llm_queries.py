"""The registered queries on the given tables: against DuckDB, brute force, a library, or held-out labels."""

from __future__ import annotations

import hashlib
import sys
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from conftest import fold

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from compare import as_bag, duckdb_rows  # noqa: E402

from specflow.llm import LLM_ORACLES, LLM_QUERIES, fingerprints, packing, tokens, warc  # noqa: E402
from specflow.llm.queries import tokenizer_path  # noqa: E402


@pytest.mark.parametrize("key", sorted(LLM_ORACLES))
def test_matches_duckdb(spark, sf_dir, key):
    df = LLM_QUERIES[key](spark, sf_dir)
    columns, rows = duckdb_rows(sf_dir, LLM_ORACLES[key])
    expected, actual = as_bag(columns, rows), as_bag(df.columns, [tuple(r) for r in df.collect()])
    assert sorted(df.columns) == sorted(columns) and expected and expected == actual


def test_toxicity(spark, sf_dir):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = LLM_QUERIES["op1_toxicity"](spark, sf_dir).collect()
    assert all(r.held_out == (fold(r.doc_id) == 2) and r.predicted == (r.score >= 0.3) for r in rows)
    judged = Counter((labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels)
    assert judged[0, 1] <= 0.02 * (judged[0, 0] + judged[0, 1])
    assert judged[1, 1] >= 0.6 * (judged[1, 0] + judged[1, 1])  # a small table teaches few stems


def test_fingerprints(spark, sf_dir, texts):
    rows = {r.doc_id: r for r in LLM_QUERIES["op2_fingerprints"](spark, sf_dir).collect()}
    assert rows.keys() == texts.keys()
    ids = sorted(texts)
    for i, after in zip(ids, ids[1:] + ids[:1], strict=True):
        text, cut = texts[i], len(texts[i]) // 4
        changed = (text[: len(text) - cut] + texts[after][:cut]).encode()
        own, other, next_one = (fingerprints.fingerprint(x) for x in (text.encode(), changed, texts[after].encode()))
        expected = (len(text), hashlib.sha256(changed).hexdigest(), own.hex(), other.hex(),
                    fingerprints.likeness(own, other), fingerprints.likeness(own, next_one))
        assert tuple(rows[i])[1:] == expected


def _weighted(texts):
    """Brute force: each text's shingles with their weights."""
    import math

    sets = {}
    for i, text in texts.items():
        words = text.encode().split()
        n = min(5, len(words))
        sets[i] = Counter(tuple(words[j : j + n]) for j in range(len(words) - n + 1)) if n else Counter()
    df = Counter(s for c in sets.values() for s in c)
    n = len(texts)

    def weight(s):
        return 1 + 0.25 * min(1.0, math.log(n / df[s]) / math.log(1000)) if df[s] > n / 1000 else 1.25

    return {i: {s: k * weight(s) for s, k in c.items()} for i, c in sets.items()}, df


def test_near_duplicates(spark, sf_dir, texts):
    rows = {r.doc_id: r for r in LLM_QUERIES["op3_near_dedup"](spark, sf_dir).collect()}
    sets, df = _weighted(texts)
    holders = defaultdict(list)
    for i, s in sets.items():
        for shingle in s:
            if df[shingle] > 1:
                holders[shingle].append(i)
    pairs = {(a, b) for h in holders.values() for a in h for b in h if a < b}
    links = []
    for a, b in pairs:
        shared = sum(min(w, sets[b][s]) for s, w in sets[a].items() if s in sets[b])
        if shared >= 0.8 * (sum(sets[a].values()) + sum(sets[b].values()) - shared):
            links.append((a, b))
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    expected = {i: root(i) for i in texts}
    sizes = Counter(expected.values())
    wrong = [i for i in texts if rows[i].class_id != expected[i]]
    # links just at 0.8 may fall to either side where columns collide
    assert len(links) > 20 and len(wrong) <= 0.002 * len(texts), wrong
    assert all(rows[i].kept == (expected[i] == i) and rows[i].class_size == sizes[expected[i]] for i in texts if i not in wrong) or wrong


def test_language(spark, sf_dir, documents):
    langs = {r.doc_id: r.lang for r in documents.collect()}
    rows = LLM_QUERIES["op4_language"](spark, sf_dir).collect()
    judged = [(r.lang_pred == langs[r.doc_id], r.score) for r in rows if r.held_out and langs[r.doc_id]]
    assert sum(ok for ok, _ in judged) >= 0.97 * len(judged)
    # calibrated: the mean score is near the share of right answers
    assert abs(sum(s for _, s in judged) / len(judged) - sum(ok for ok, _ in judged) / len(judged)) < 0.05


def test_token_counts(spark, sf_dir, texts):
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(tokenizer_path())
    ids = sorted(texts)
    counts = [len(e.ids) for e in reference.encode_batch([texts[i] for i in ids], add_special_tokens=False)]
    rows = {r.doc_id: r for r in LLM_QUERIES["op7_tokens"](spark, sf_dir).collect()}
    assert [rows[i].n_tokens for i in ids] == counts
    assert all(rows[i].n_bytes == len(texts[i].encode()) and rows[i].over_limit == (rows[i].n_tokens > 2048) for i in ids)


def test_token_counts_of_odd_texts():
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(tokenizer_path())
    with open(tokenizer_path(), encoding="utf-8") as file:
        counter = tokens.Counter(file.read())
    odd = [
        "", " \n\t ", "a<|endoftext|>b", "<|startoftext|><|endoftext|>", "<|EndOfText|>", "it's we'll I'M don'T", "ΣΊΣΥΦΟΣ ΟΔΟΣ", "é İi ß ẞ",
        "aaaaaaaaaaaaaaaaaaaaaaa" * 50, "1234567 ٣٤ ½", "日本語のテキスト", "🙂🙂👩‍👩‍👧", "!!!???...$$$&&&", "x" * 5000, "a b c​d", "\x00\x01",
        "ﬁ ǅ ŉ", "l'été d'où's",
    ]
    assert counter.counts(odd) == [len(reference.encode(t, add_special_tokens=False).ids) for t in odd]


def test_token_counts_of_every_code_point():
    """One text for each code point, by itself and between letters."""
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(tokenizer_path())
    with open(tokenizer_path(), encoding="utf-8") as file:
        counter = tokens.Counter(file.read())
    points = [chr(i) for i in range(0x20000) if not 0xD800 <= i < 0xE000]
    for texts in (points, [f"a{c}b" for c in points]):
        expected = [len(e.ids) for e in reference.encode_batch(texts, add_special_tokens=False)]
        found = counter.counts(texts)
        assert [t for t, a, b in zip(texts, found, expected, strict=True) if a != b] == []


def _targets(sizes: dict) -> dict:
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[s] for s in capped)
        share = sum(weight[s] for s in order if s not in capped)
        target = {s: 2 * sizes[s] if s in capped else rest * weight[s] / share for s in order}
        over = {s for s in order if target[s] > 2 * sizes[s]}
        if not over:
            return target
        capped |= over


def test_mixing(spark, sf_dir, documents):
    rows = LLM_QUERIES["op9_mixing"](spark, sf_dir).collect()
    sizes, taken = Counter(), Counter()
    texts = {r.doc_id: (r.source, len((r.text or "").encode().split())) for r in documents.collect()}
    for r in rows:
        assert texts[r.doc_id] == (r.source, r["size"])
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        assert r.taken % max(1, r["size"]) == 0 and r.taken <= 2 * r["size"]
    targets = _targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
    longest = defaultdict(int)
    for r in rows:
        longest[r.source] = max(longest[r.source], r["size"])
    assert all(abs(taken[s] - targets[s]) <= longest[s] / 2 + 1 for s in sizes)
    again = {(r.doc_id, r.taken) for r in LLM_QUERIES["op9_mixing"](spark, sf_dir).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}


def test_mixing_prefers_quality_in_key_order(spark):
    """Brute force of the sample in one source: documents by exponential key, up to the target."""
    from pyspark.sql import functions as F

    from specflow.llm import mixing

    words = [("good " * (3 + i % 7)).strip() for i in range(300)] + [("b?!? " * (3 + i % 7)).strip() for i in range(300)]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(words)], "doc_id long, text string, source string")
    rows = mixing.mixed(docs, weights=(1.0,), share=0.4, most=2.0).collect()
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(mixing._SEED), "doc_id", "text"), 12) + 0.5) / float(1 << 52)
    keys = {r.doc_id: (r.k, r.n) for r in docs.select("doc_id", (-F.log(u) / mixing.quality_weight(F.col("text"))).alias("k"), mixing.size_in_words(F.col("text")).alias("n")).collect()}
    rest, so_far, expected = 0.4 * sum(n for _, n in keys.values()), 0, set()
    for i in sorted(keys, key=lambda i: keys[i]):
        n = keys[i][1]
        if so_far + n <= rest or so_far + n - rest < rest - so_far:
            expected.add(i)
        if so_far + n > rest:
            break
        so_far += n
    assert {r.doc_id for r in rows if r.taken} == expected
    assert sum(i < 300 for i in expected) > 1.5 * sum(i >= 300 for i in expected)


def test_packing(spark, sf_dir, texts):
    rows = LLM_QUERIES["op6_packing"](spark, sf_dir).collect()
    found = Counter()
    bins = defaultdict(list)
    for r in rows:
        found[r.doc_id] += r.n_tokens
        bins[r.pack_group, r.bin].append(r)
    assert found == {i: n for i, t in texts.items() if (n := len(t.encode().split()))}
    for members in bins.values():
        used, at = sum(r.n_tokens for r in members), 0
        capacity = {r.capacity for r in members}
        assert capacity == {min(x for x in packing.LENGTHS if x >= used)}
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.n_tokens
    assert sum(r.n_tokens for r in rows) >= 0.9 * sum(m[0].capacity for m in bins.values())


def test_packing_takes_the_best_fit():
    sizes = [60, 50, 40, 30, 10]
    assert packing.pack(sizes, (100,)) == ([(0, 0), (1, 0), (0, 60), (1, 50), (1, 80)], [100, 100])
    # a bin opened large is cut down to what it holds, and a piece without company gets the least length
    assert packing.pack([70], (64, 80, 100)) == ([(0, 0)], [80])
    placed, capacities = packing.pack([90, 40, 30, 20], (64, 100, 128))
    used = Counter()
    for (number, offset), size in zip(placed, [90, 40, 30, 20], strict=True):
        assert offset == used[number]
        used[number] += size
    assert capacities == [min(x for x in (64, 100, 128) if x >= used[i]) for i in range(len(capacities))]


def test_warc(spark, sf_dir, tmp_path):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = LLM_QUERIES["op5_warc"](spark, sf_dir).collect()
    assert Counter(r.type for r in rows) == {"metadata": pages.count(), "conversion": pages.count()}
    html = {r.page_id: r.html for r in pages.collect()}
    for r in rows:
        assert r.block_digest == warc.digest(r.block.encode()) and r.content_length == len(r.block.encode())
        assert r.source_payload_digest == warc.digest(html[r.page_id].encode())
        if r.type == "conversion":
            assert "<script" not in r.block and "track(" not in r.block
        else:
            assert f"source-record-id: {r.refers_to}\r\n" in r.block and "http-header-content-type: text/html" in r.block
    # a round trip through files
    responses = warc.responses(pages)
    warc.write_warc(responses, str(tmp_path / "in"))
    read = warc.read_warc(spark, str(tmp_path / "in"))
    assert Counter(bytes(r.record) for r in read.collect()) == Counter(bytes(r.record) for r in responses.collect())
    warc.write_warc(warc.derivatives(read), str(tmp_path / "out"))
    again = warc.read_warc(spark, str(tmp_path / "out")).collect()
    assert len(again) == len(rows)


def test_warc_edge_cases(spark):
    pages = spark.createDataFrame([(1, None, None, 5), (2, "http://a/", "", 5), (2, "http://a/", "", 5), (None, "http://b/", "<p>x&amp;y<br>z", 5)], "page_id long, url string, html string, record int")
    rows = warc.derivatives(warc.responses(pages)).collect()
    assert len(rows) == 8 and {r.block for r in rows if r.type == "conversion"} == {"", "x&y\nz"}
    assert warc.derivatives(warc.responses(pages.limit(0))).collect() == []
    odd = [(b"WARC/1.1\r\nWARC-Type: request\r\n\r\nGET /",), (None,), (b"WARC/1.1\r\nWARC-Type: response\r\n\r\nHTTP/1.1 200 OK",)]
    assert len(warc.derivatives(spark.createDataFrame(odd, "record binary")).collect()) == 2
