"""Weights of words that no template has."""

from __future__ import annotations

import math
from collections import Counter

import pytest
from tidemark.llm import licenses

MIT = "Released under the MIT License."


def files():
    """A notice beside two words that most files have."""
    prose = [(f"p/{i}", "en on " + " ".join(f"w{i * 7 + j}" for j in range(7))) for i in range(200)]
    return [*prose, ("n/one", f"{MIT} en on"), ("n/two", f"start\n{MIT} en on\nend")]


def test_common_words_beside_a_notice_weigh_little(spark):
    rows = files()
    df = Counter(t for _, text in rows for t in set(licenses.terms_of(text)))

    def vector(text):
        own = Counter(licenses.terms_of(text))
        return {t: c * (math.log((len(rows) + 1) / (df[t] + 1)) + 1) for t, c in own.items()}

    a, b = vector(f"{MIT} en on"), vector(MIT)
    dot = sum(w * b.get(t, 0) for t, w in a.items())
    want = dot / math.sqrt(sum(w * w for w in a.values()) * sum(w * w for w in b.values()))
    out = licenses.scan(spark.createDataFrame(rows, "path string, text string").repartition(4))
    got = {r["path"]: r for r in out.collect()}
    for path in ("n/one", "n/two"):
        assert (got[path]["licence"], got[path]["origin"]) == ("MIT", "header")
        assert got[path]["cosine"] == pytest.approx(want, abs=1e-8)


def test_frequencies_cover_all_words(spark):
    rows = files()
    df = Counter(t for _, text in rows for t in set(licenses.terms_of(text)))
    table = licenses.document_frequencies(spark.createDataFrame(rows, "path string, text string"))
    assert {r["term"]: r["files"] for r in table.collect()} == {**df, "": len(rows)}
