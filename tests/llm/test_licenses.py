from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tidemark.llm import licenses

from .common import documents, odd_rows

MIT = "Released under the MIT License."
GPL = "This work is licensed under the GNU General Public License, version 3."
CC = "Licensed under CC BY-NC 4.0."

FILES = [
    ("a/LICENSE", MIT),
    ("a/b/c/one", "some words\nand more of them"),
    ("a/b/c/two", f"header\n{GPL}\nbody of the file " + "word " * 300),
    ("a/b/d/COPYING", "  " + CC),
    ("a/b/d/e/f/three", "text without a notice"),
    ("a/b/d/e/f/four", None),
    ("a/x", ""),
    ("other/five", "the license of the work is under version"),
    ("six", "nothing"),
    ("a//odd", "nothing"),
    (None, "nothing"),
    (None, MIT),
    ("ab/LICENCE", "Licensed under the Apache License, Version 2.0."),
    ("a/b/c/one", "some words\nand more of them"),
    ("b/foreign", f"{MIT} nothing prose"),
    ("mit/LICENSE", "Copyright someone\n" + dict(licenses.licence_texts())["MIT"]),
    ("mit/src/code", "nothing"),
    ("wrapped/code", "# some code\n# This work is licensed under the\n# GNU General Public\n# License, version 3.\nx = 1\n" + "y = 2\n" * 60),
    ("z/long", "\n".join(["line of prose"] * 3000 + [MIT] + ["x" * 20_000])),
]


def brute(files):
    texts = [(p, t or "") for p, t in files]
    df = Counter(t for _, text in texts for t in set(licenses.terms_of(text)))
    n = len(texts)

    def vector(text):
        own = Counter(licenses.terms_of(text))
        return {t: c * (math.log((n + 1) / (df[t] + 1)) + 1) for t, c in own.items()}

    def norm(v):
        return math.sqrt(sum(w * w for w in v.values()))

    notes = [(name, vector(text)) for name, text in licenses.TEMPLATES]
    whole = notes + [(name, vector(text)) for name, text in licenses.licence_texts()]

    def best(text, templates):
        own = vector(text)
        if not own:
            return 0.0, 0, None
        return max(
            (round(sum(w * v.get(t, 0) for t, w in own.items()) / norm(own) / norm(v), 9), -i, name)
            for i, (name, v) in enumerate(templates)
        )

    notices, licensed = {}, {}
    for path, text in texts:
        lines = text.split("\n")
        runs = ["\n".join(lines[i : i + n]) for i in range(len(lines)) for n in range(1, licenses.RUN + 1)]
        lines = [best(run, notes) for run in runs]
        cosine, _, name = max(lines, key=lambda x: (x[0], x[2] or ""))
        if path is not None and cosine >= licenses.HEADER:
            notices[path] = max(notices.get(path, (0.0, "")), (cosine, name))
        cosine, _, name = best(text, whole)
        if path is not None and cosine >= licenses.WHOLE_FILE:
            above = re.sub("/?[^/]*$", "", path)
            licensed[above] = min(licensed.get(above, (0, "~")), (-cosine, path, name))
    out = []
    for path, _ in texts:
        if path in notices:
            out.append((path, notices[path][1], notices[path][0], "header", path))
            continue
        above = None if path is None else re.sub("/?[^/]*$", "", path)
        while above is not None and above not in licensed:
            above = None if above == "" else above.rpartition("/")[0]
        if above is None:
            out.append((path, None, None, None, None))
        else:
            away, source, name = licensed[above]
            out.append((path, name, -away, "inherited", source))
    return sorted(out, key=str)


@pytest.mark.parametrize("clashing", [False, True])
def test_scan_equals_brute_force(spark, both_plans, clashing):
    df = spark.createDataFrame(FILES, "path string, text string").repartition(4)
    if clashing:
        names = "licence cosine term row line best directory above i i_path dot0 count".split()
        df = df.withColumns({c: F.lit("extra") for c in names})
    got = sorted((tuple(r) for r in licenses.scan(df).collect()), key=str)
    want = brute(FILES)
    assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], abs=1e-8)
    assert {w[3] for w in want} == {"header", "inherited", None}


OWNERS = "Copyright (c) 2019-2024 A. Person and the Example Project contributors\n\n"
WHOLE = ["Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "GPL-3.0", "ISC", "MIT", "MPL-2.0"]


def test_whole_licences_pass_to_their_directories(spark):
    texts = dict(licenses.licence_texts())
    files = [(f"{name}/LICENSE", OWNERS + texts[name]) for name in WHOLE]
    files += [(f"{name}/src/code", f"words of file {i}") for i, name in enumerate(WHOLE)]
    # Prose with a notice, and one with a licence quoted in a long text, are no licence files.
    files += [("prose/a", f"{MIT} " + "and then some prose of its own " * 3), ("prose/b", "no notice")]
    files += [("book/a", "chapter verse page " * 400 + texts["ISC"]), ("book/b", "no notice")]
    out = {r["path"]: r for r in licenses.scan(spark.createDataFrame(files, "path string, text string")).collect()}
    for name in WHOLE:
        row = out[f"{name}/src/code"]
        assert (row["licence"], row["origin"], row["from_path"]) == (name, "inherited", f"{name}/LICENSE")
        assert row["cosine"] > 0.9
    assert out["prose/b"]["licence"] is None and out["book/b"]["licence"] is None


def test_notices_may_be_wrapped(spark):
    wrapped = [("a/one", FILES[[p for p, _ in FILES].index("wrapped/code")][1]), ("a/two", "nothing")]
    wrapped += [(f"b/{i}", f"the public work number {i} is under this") for i in range(40)]
    df = spark.createDataFrame(wrapped, "path string, text string")
    out = {r["path"]: r for r in licenses.scan(df).collect()}
    assert (out["a/one"]["licence"], out["a/one"]["origin"]) == ("GPL-3.0", "header")
    assert out["a/two"]["licence"] is None


def test_documents_are_files(spark):
    rows = [*odd_rows(), (400, f"prose here\n{CC}", "en", "s1", 0), (401, MIT, "de", "s2", 0), (402, "x", "de", "s2", 0)]
    out = licenses.scan_documents(documents(spark, rows)).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(r[0]) for r in rows)
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[400]["licence"] == "CC-BY-NC-4.0" and by_id[400]["origin"] == "header"
    assert by_id[401]["licence"] == "MIT"
    assert (by_id[402]["licence"], by_id[402]["from_path"]) == ("MIT", "s2/de/401")


def test_words_left_out_cannot_reach_the_threshold():
    df = {"the": 900, "of": 800, "under": 300, "license": 40, "this": 700}
    weights = licenses.Weights(licenses.TEMPLATES, df, 1000)
    for threshold in (0.3, 0.6):
        telling = set(weights.telling(threshold))
        for v in weights.vectors:
            assert math.sqrt(sum(w * w for t, w in v.items() if t not in telling)) < threshold
        assert telling


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], "path string, text string")).collect() == []


def test_main_path_is_sql_only(spark):
    df = licenses.scan(spark.createDataFrame(FILES, "path string, text string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
