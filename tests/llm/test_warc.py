from __future__ import annotations

import gzip
import hashlib
import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tidemark.llm import warc

from .common import CLASHING, tuples

PAGES = "page_id long, url string, html string"


def odd_pages():
    chance = random.Random(4)
    marks = ["\r\n\r\n", "\r\n", "\r", "\n", "WARC/1.1\r\n", "é", "\U0001f600", "x" * 50, ""]
    out = [(i, f"http://h/{i}", "".join(chance.choices(marks, k=chance.randint(0, 60)))) for i in range(80)]
    long = "".join(chance.choices(marks, k=20_000))
    copied = "<p>" + "same " * 40
    out += [
        (100, None, None),
        (101, "", ""),
        (102, "http://a b\r\nX: y", "\r\n\r\n"),
        (103, "http://long", long),
        (104, "http://long2", long),
        (105, "http://short", "x" * 99),
        (106, "http://short", "x" * 99),
        (107, "http://edge", "y" * 100),
        (108, "http://edge", "y" * 100),
        (109, "http://bytes", "é" * 50),
        (110, "http://bytes", "é" * 50),
        (None, "http://none", copied),
    ]
    out += [(200 + i, "http://copy", copied) for i in range(40)]
    out += [(300, "http://again", copied)] * 3 + [(301, "http://twice", "z" * 150)] * 2
    return out


def expected(rows, least=100):
    data = [(i, (h or "").encode()) for i, _, h in rows]
    first = {}
    for i, p in data:
        if i is not None and len(p) >= least:
            first[p] = min(i, first.get(p, i))
    out = []
    for i, p in data:
        to = first.get(p)
        again = i is not None and to is not None and i > to
        kind = "revisit" if again else "response"
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), kind, to if again else None))
    return sorted(out, key=lambda r: [(v is None, str(v)) for v in r])


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, PAGES).repartition(parts)


@pytest.mark.parametrize("clashing", [False, True])
def test_round_trip(spark, both_plans, clashing):
    rows = odd_pages()
    pages = frame(spark, rows)
    if clashing:
        pages = pages.withColumns({c: F.lit("extra") for c in [*CLASHING, "digest", "number", "data", "last"]})
    out = warc.round_trip(pages)
    assert tuples(out.drop("target_uri")) == expected(rows)


@pytest.mark.parametrize("chunk", [7, 64, 1000])
def test_chunks_put_payloads_together(spark, tmp_path, chunk):
    rows = [r for r in odd_pages() if r[0] is not None and r[0] < 200]
    warc.write_archives(frame(spark, rows), f"{tmp_path}/a", chunk=chunk, least=10**9)
    got = {}
    for r in warc.read_chunks(spark, f"{tmp_path}/a", chunk=max(chunk, 200)).collect():
        got.setdefault((r["page_id"], r["record_id"]), []).append(r)
    assert len(got) == len(rows)
    html = {i: (h or "").encode() for i, _, h in rows}
    for (page, _), chunks in got.items():
        chunks.sort(key=lambda r: r["chunk"])
        assert [r["chunk"] for r in chunks] == list(range(len(chunks)))
        assert [r["last"] for r in chunks] == [False] * (len(chunks) - 1) + [True]
        so_far = b""
        for r in chunks:
            assert len(r["data"]) <= max(chunk, 200)
            so_far += bytes(r["data"])
            assert r["payload_bytes"] == len(so_far)
            assert r["payload_digest"] == hashlib.sha256(so_far).hexdigest()
        assert so_far == html[page]


def test_files_are_warc(spark, tmp_path):
    """A plain reader by Content-Length gets through every file."""
    rows = odd_pages()
    warc.write_archives(frame(spark, rows), f"{tmp_path}/a", chunk=500)
    kinds, ids = [], set()
    for path in Path(f"{tmp_path}/a").glob("*.gz"):
        data, at = gzip.decompress(path.read_bytes()), 0
        while at < len(data):
            end = data.index(b"\r\n\r\n", at)
            head = data[at:end].decode()
            assert head.startswith("WARC/1.1\r\n")
            field = dict(line.split(": ", 1) for line in head.split("\r\n")[1:])
            size = int(field["Content-Length"])
            block = data[end + 4 : end + 4 + size]
            assert field["WARC-Block-Digest"] == f"sha256:{hashlib.sha256(block).hexdigest()}"
            assert not re.search(r"\s", field["WARC-Target-URI"])
            assert data[end + 4 + size : end + 8 + size] == b"\r\n\r\n"
            kinds.append(field["WARC-Type"])
            ids.add(field["WARC-Record-ID"])
            at = end + 8 + size
    assert len(ids) == len(kinds)
    assert kinds.count("response") + kinds.count("revisit") == len(rows)
    assert "continuation" in kinds


def test_reader_streams_records_it_did_not_cut():
    """A record of many chunks passes without being held."""
    payload = random.Random(1).randbytes(100_000) + b"\r\n\r\n" * 10
    body = b"HTTP/1.1 200 OK\r\n\r\n" + payload
    head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:a>\r\nContent-Length: {len(body)}"
    lines = (head.encode() + b"\r\n\r\n" + body + b"\r\n\r\n").split(b"\n")[:-1]
    reader, seen, most = warc.ArchiveReader(1000), b"", 0
    for line in lines:
        for row in reader.feed(line):
            most = max(most, len(row[-1]))
            seen += row[-1]
            last = row
    assert seen == payload and most <= 1000
    assert last[2] and last[8] == hashlib.sha256(payload).hexdigest()


def test_empty_table(spark):
    assert warc.round_trip(frame(spark, [])).collect() == []
