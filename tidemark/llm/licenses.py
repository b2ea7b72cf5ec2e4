"""Licence scan: TF-IDF cosine to templates, then inheritance along paths.

A file's own licence is that of its line, or run of adjacent lines, nearest to a notice. A file that as a whole
is near to a licence's text or to a notice is the licence file of its directory, and
files without a licence of their own take that of the nearest directory above them
that has one. Word statistics cover all words of all files. Texts are never shuffled:
what moves are word counts, and words of the few lines and files that can reach the
threshold at all, which meet the counts as a table.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import cache
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored, text_of

HEADER = 0.6
# A notice may be wrapped over so many adjacent lines.
RUN = 3
# High enough that a text which merely has a notice in it is no licence file.
WHOLE_FILE = 0.8

# Licence notices as their licences or usual practice word them.
TEMPLATES: list[tuple[str, str]] = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license. See LICENSE in the project root for license information."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright. CC0 1.0 Universal."),
]



@cache
def licence_texts() -> list[tuple[str, str]]:
    """(name, whole text) of usual licences, without copyright lines. Read where the
    plan is made, never in a task."""
    folder = Path(__file__).with_name("licence_texts")
    return [(p.stem, p.read_text("utf-8")) for p in sorted(folder.glob("*.txt"))]


_TERM = "[a-z0-9]+"


def terms_of(text: str) -> list[str]:
    return re.findall(_TERM, text.lower())


def _terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_TERM), F.lit(0))


class Weights:
    """Inverse document frequencies over all files, and unit vectors of templates.
    ``df`` holds the words of the templates; those of all others stay in a table."""

    def __init__(self, templates: list[tuple[str, str]], df: dict[str, int], files: int) -> None:
        self.names = [name for name, _ in templates]
        self.files = files
        counts = [Counter(terms_of(text)) for _, text in templates]
        self.idf = {
            t: math.log((files + 1) / (df.get(t, 0) + 1)) + 1 for t in sorted(set().union(*counts))
        }
        self.df = df
        self.vectors = []
        for own in counts:
            raw = {t: n * self.idf[t] for t, n in own.items()}
            norm = math.sqrt(sum(w * w for w in raw.values()))
            self.vectors.append({t: w / norm for t, w in raw.items()})

    def telling(self, threshold: float) -> list[str]:
        """Words of which a text must have one to reach ``threshold``. The most
        frequent words are left out as long as, for every template, a text that
        shares no others stays below it: its cosine is at most the length of the
        template's vector on the words left out."""
        left = [0.0] * len(self.vectors)
        kept = []
        for t in sorted(self.idf, key=lambda t: (self.idf[t], t)):
            more = [a + v.get(t, 0.0) ** 2 for a, v in zip(left, self.vectors, strict=True)]
            if max(more) < (threshold * 0.999) ** 2:
                left = more
            else:
                kept.append(t)
        return kept


def document_frequencies(files: DataFrame) -> DataFrame:
    """Stored (term, files): in how many files each word occurs; the term "" stands
    for the file itself. Only words and counts move, added up before they do."""
    own = F.concat(F.array(F.lit("")), F.array_distinct(_terms(F.col("text"))))
    rows = files.select(F.explode(own).alias("term"))
    return stored(rows.groupBy("term").agg(F.count("*").alias("files")))


def known_frequencies(frequencies: DataFrame, vocabulary: list[str]) -> tuple[dict[str, int], int]:
    """Of the words of the vocabulary, in how many files they occur, and how many
    files there are. At most one row per word of the templates comes back."""
    rows = frequencies.where(F.col("term").isin("", *vocabulary)).collect()
    counted = {r["term"]: r["files"] for r in rows}
    return counted, counted.pop("", 0)


def cosines(texts: DataFrame, keys: list[str], weights: Weights, frequencies: DataFrame) -> DataFrame:
    """(keys, licence, cosine) of the best template for each (keys, text); of equal
    ones the first. ``frequencies`` as from :func:`document_frequencies`."""
    # A row per word of the templates, whatever the input.
    known = [(t, [v.get(t, 0.0) for v in weights.vectors]) for t in sorted(weights.idf)]
    known = F.broadcast(texts.sparkSession.createDataFrame(known, "term string, own array<double>"))
    words = texts.select(*keys, F.explode(_terms(F.col("text"))).alias("term"))
    counted = words.groupBy(*keys, "term").count().join(frequencies, "term", "left")
    seen = F.coalesce("files", F.lit(0)) + 1
    weight = F.col("count") * (F.log(F.lit(weights.files + 1.0) / seen) + 1)
    dots = [
        F.sum(F.col("w") * F.coalesce(F.col("own")[i], F.lit(0.0))).alias(f"dot{i}")
        for i in range(len(weights.vectors))
    ]
    met = counted.withColumn("w", weight).join(known, "term", "left")
    summed = met.groupBy(*keys).agg(F.sum(F.col("w") * F.col("w")).alias("norm2"), *dots)
    best = F.greatest(
        *[
            F.struct(
                F.round(F.col(f"dot{i}") / F.sqrt("norm2"), 9).alias("cosine"),
                F.lit(-i).alias("at"),
                F.lit(name).alias("licence"),
            )
            for i, name in enumerate(weights.names)
        ]
    )
    return summed.select(*keys, best.alias("best")).select(*keys, "best.licence", "best.cosine")


def _with_any(text: Column, words: list[str]) -> Column:
    return F.lower(text).rlike(r"(?<![a-z0-9])(?:" + "|".join(words) + r")(?![a-z0-9])")


def scan(
    files: DataFrame,
    templates: list[tuple[str, str]] = TEMPLATES,
    header: float = HEADER,
    whole: float = WHOLE_FILE,
    texts: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """One row per file (path, text): path, licence, cosine, origin (``header`` or
    ``inherited``) and from_path, the file that holds the notice. Without a licence
    all but the path are null.

    Paths are split at ``/``. Null and empty texts have no notice; rows that share a
    path are one file, which has the best of their notices, and come back as often
    as they are; a null path lies in no directory. Lines are separated by newlines
    and all of them are looked at, one by one and as runs of up to ``RUN``. Whole files are compared with ``templates``
    and with ``texts``, those of the usual licences unless given. Of licence files in a directory the
    nearest to its template counts, then the first path.
    """
    own = files.select(files["path"].alias("path"), text_of(files).alias("text"))
    everything = [*templates, *(licence_texts() if texts is None else texts)]
    vocabulary = sorted({t for _, text in everything for t in terms_of(text)})
    frequencies = document_frequencies(own)
    known = known_frequencies(frequencies, vocabulary)
    weights, whole_weights = Weights(templates, *known), Weights(everything, *known)

    has_line = _with_any(F.col("text"), weights.telling(header))
    telling = F.array(*[F.lit(t) for t in whole_weights.telling(whole)])
    # A few files in a hundred; from here on only these.
    near = own.withColumns(
        {"has_line": has_line, "may_be_whole": F.arrays_overlap(_terms(F.col("text")), telling)}
    ).where("has_line or may_be_whole")
    near = stored(near.withColumn("row", F.monotonically_increasing_id()))
    cut = near.where("has_line").select("path", "row", F.split("text", "\n").alias("lines"))
    # Made inside one expression: the lines of a file are not copied per line.
    runs = F.transform(
        "lines",
        lambda _, i: F.transform(
            F.sequence(F.lit(1), F.least(F.lit(RUN), F.size("lines") - i)),
            lambda n: F.array_join(F.slice("lines", i + 1, n), "\n"),
        ),
    )
    starts = cut.select("path", "row", F.posexplode(runs).alias("line", "runs"))
    lines = starts.select("path", "row", "line", F.posexplode("runs").alias("more", "text"))
    lines = lines.where(_with_any(F.col("text"), weights.telling(header)))
    best = F.max(F.struct("cosine", "licence")).alias("best")
    notices = cosines(lines, ["path", "row", "line", "more"], weights, frequencies).where(F.col("cosine") >= header)
    notices = stored(notices.groupBy("path").agg(best).select("path", "best.licence", "best.cosine"))

    whole_files = near.where("may_be_whole")
    licence_files = cosines(whole_files, ["path", "row"], whole_weights, frequencies)
    licence_files = licence_files.where(F.col("cosine") >= whole)
    directory = F.regexp_replace("path", "/?[^/]*$", "")
    nearest = F.min(F.struct((-F.col("cosine")).alias("away"), "path", "licence")).alias("own")
    licensed = licence_files.where(F.col("path").isNotNull()).groupBy(directory.alias("above"))
    licensed = licensed.agg(nearest).select(
        "above",
        F.col("own.licence").alias("i_licence"),
        (-F.col("own.away")).alias("i_cosine"),
        F.col("own.path").alias("i_path"),
    )

    paths = own.select("path", directory.alias("directory"))
    parts = F.split("directory", "/")
    above = F.transform(
        F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/")
    )
    places = paths.where(F.col("directory").isNotNull()).select("directory").distinct()
    places = places.select("directory", F.explode(F.array_distinct(above)).alias("above"))
    inherited = places.join(licensed, "above").groupBy("directory").agg(
        F.max(F.struct(F.length("above").alias("near"), "i_licence", "i_cosine", "i_path")).alias("i")
    )

    told = paths.join(notices, "path", "left").join(inherited, "directory", "left")
    has = F.col("licence").isNotNull()
    return told.select(
        "path",
        F.coalesce("licence", "i.i_licence").alias("licence"),
        F.when(has, F.col("cosine")).otherwise(F.col("i.i_cosine")).alias("cosine"),
        F.when(has, "header").when(F.col("i").isNotNull(), "inherited").alias("origin"),
        F.when(has, F.col("path")).otherwise(F.col("i.i_path")).alias("from_path"),
    )


def document_paths(docs: DataFrame) -> DataFrame:
    """Documents as files: source, language and id are the path."""
    return docs.select(
        F.concat_ws("/", docs["source"], docs["lang"], docs["doc_id"].cast("string")).alias("path"),
        docs["text"].alias("text"),
    )


def scan_documents(docs: DataFrame) -> DataFrame:
    """The scan over documents as files, with doc_id, which is the last part of a
    path. A document without an id has the path of its directory and keeps a null."""
    found = scan(document_paths(docs))
    last = F.element_at(F.split("path", "/"), -1)
    return found.select(last.try_cast("long").alias("doc_id"), *found.columns)
