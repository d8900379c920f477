"""What models are made of reaches the driver in a compact form: its Python memory stays near the size of the numbers."""

from __future__ import annotations

import random
import tracemalloc

from specflow.llm import language, near_dedup


def _peak(make):
    """What ``make`` returns, and the most bytes of Python and NumPy that it held at once."""
    tracemalloc.start()
    try:
        return make(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_common_columns(docs_of):
    """Of few documents every column is common: each takes some numbers, not a row of Python's own."""
    draw = random.Random(5)
    docs = docs_of([(i, " ".join(f"w{draw.randrange(10**6)}" for _ in range(3_000)), "en", "s") for i in range(20)])
    weights, peak = _peak(lambda: near_dedup.weights_of(docs))
    assert len(weights.columns) > 50_000 and (weights.columns[1:] > weights.columns[:-1]).all()
    assert peak < 64 * len(weights.columns) + 1_000_000


def test_sampled_vectors(docs_of):
    """Vectors to learn from stay packed: six bytes for each column of a document, outside of Python."""
    draw = random.Random(6)
    letters = {"aa": "abcdefghijklm", "bb": "nopqrstuvwxyz"}
    rows = [(i, " ".join("".join(draw.choices(letters[lang], k=6)) for _ in range(2_000)), lang, "s") for i in range(120) for lang in letters]
    docs = docs_of(rows)
    model, peak = _peak(lambda: language.learn(docs))
    assert model.languages == ["aa", "bb"] and model.predict(["nopq zyx"])[0] == ["bb"]
    assert peak < 20_000_000
