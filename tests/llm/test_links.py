from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F
from tidemark.llm import links
from tidemark.llm.oracles import ORACLES

from .common import CLASHING, tuples

COLUMNS = ["page_id", "host", "path", "rule", "verdict", "trust", "distrust"]
SCHEMA = "page_id long, url string, html string"
URLS = (
    "http://example.org",
    "http://example.org/",
    "HTTP://Sub.EXAMPLE.org/es/1?x=/fr/#y",
    "http://example.org/en/12",
    "http://notexample.org/en/12",
    "http://org/x",
    "http://a.com/fr/",
    "http://a.com/fr",
    "http://a.com/de/x",
    "http://a.com?p=/de/",
    "//a.com/de/",
    "://",
    "no address",
    "",
    "a://b://c/de/",
    "http://example.org:80/es/",
    "http://ÉCOLE.com/de/é",
)


def page(hosts, chance):
    forms = ('<a href="http://{}/x">', "<A class=q HREF = '//{}'>", "<a\nhref=https://{}?q>", '<a href="ftp://{}#f">')
    return "<p>" + " ".join(chance.choice(forms).format(h) for h in hosts) + '<a href="/own">'


def web(seed: int, hosts: int, pages: int) -> list[tuple]:
    chance = random.Random(seed)
    names = [f"h{i}.{chance.choice(['example.org', 'com', 'net', 'B.net'])}" for i in range(hosts)]
    paths = ["/", "/es/1", "/en/1", "/en/2", "/fr/", "/de/1", "/it/"]
    out = []
    for i in range(pages):
        own = names[0] if chance.random() < 0.33 else chance.choice(names)  # a hot host
        out.append((i, f"http://{own}{chance.choice(paths)}?q=1", page(chance.choices(names, k=3), chance)))
    return out


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows, rounds=links.ROUNDS):
    judged, edges = [], set()
    for page_id, url, html in rows:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = lower(re.match("[^/?#]*", rest)[0])
        path = re.match("[^/?#]*([^?#]*)", rest)[1]
        fits = [r for r in links.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
        best = max(fits, key=lambda r: len(r[0] + r[1]), default=None)
        judged.append((page_id, host, path, best))
        for tag in re.findall(r"<a\s[^>]*", html or "", re.I):
            found = re.search(r"href\s*=\s*[\"']?\s*(?:[a-z]+:)?//([^/?#\"'\s>]+)", tag, re.I)
            if found and lower(found[1]) != host:
                edges.add((host, lower(found[1])))

    def ranks(edges, says):
        seeds = Counter(host for _, host, _, rule in judged if rule and rule[2] == says)
        start = {h: n * links.UNIT // seeds.total() for h, n in seeds.items()}
        degree, rank = Counter(s for s, _ in edges), dict(start)
        for _ in range(rounds):
            new = defaultdict(int)
            for h, n in start.items():
                new[h] += n - n * 85 // 100
            for s, d in edges:
                new[d] += rank.get(s, 0) * 85 // 100 // degree[s]
            rank = new
        total = sum(rank.values())
        return {h: n * links.UNIT // total for h, n in rank.items()}

    trust, distrust = ranks(edges, "allow"), ranks({(d, s) for s, d in edges}, "block")
    out = []
    for page_id, host, path, rule in judged:
        t, d = trust.get(host, 0), distrust.get(host, 0)
        own = "block" if 2 * d > t + d else "allow"
        out.append((page_id, host, path, rule and rule[0] + rule[1], rule[2] if rule else own, t, d))
    return sorted(out, key=lambda r: [(v is None, str(v)) for v in r])


def test_against_brute_force(spark, both_plans):
    rows = web(1, 20, 200)
    got = tuples(links.judge_urls(spark.createDataFrame(rows, SCHEMA).repartition(3), rounds=5), *COLUMNS)
    assert got == brute(rows, 5)
    # Hosts without a rule of their own get either verdict from the links.
    assert {r[4] for r in got if r[3] is None} == {"allow", "block"}


def test_against_sql(spark, tmp_path):
    rows = [*web(2, 12, 100), *[(1000 + i, u, "<a href=//a.com/>") for i, u in enumerate(URLS)]]
    df = spark.createDataFrame(rows, SCHEMA)
    df.write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    cursor = con.execute(ORACLES["op13_url_filter"])
    names = [c[0] for c in cursor.description]
    want = [tuple(r[names.index(c)] for c in COLUMNS) for r in cursor.fetchall()]
    got = tuples(links.judge_urls(df), *COLUMNS)
    assert got == sorted(want, key=lambda r: [(v is None, str(v)) for v in r])


def test_trust_and_distrust_flow_opposite_ways(spark):
    rows = [
        (0, "http://good.org/", '<a href="http://cited.net/">'),
        (1, "http://bad.com/de/", '<a href="http://victim.net/">'),
        (2, "http://spam.net/", '<a href="http://bad.com/">'),
        (3, "http://cited.net/", ""),
        (4, "http://victim.net/", ""),
        (5, "http://alone.net/", ""),
    ]
    got = {r.host: r for r in links.judge_urls(spark.createDataFrame(rows, SCHEMA), rounds=4).collect()}
    assert got["spam.net"].verdict == "block" and got["spam.net"].distrust > 0
    assert got["cited.net"].verdict == "allow" and got["cited.net"].trust > 0
    assert got["victim.net"].verdict == "allow" and got["victim.net"].distrust == 0
    assert (got["alone.net"].verdict, got["alone.net"].trust) == ("allow", 0)


@pytest.mark.parametrize("clashing", [False, True])
def test_odd_rows(spark, clashing):
    rows = [(i, u, "<a href=//a.com/>") for i, u in enumerate(URLS)]
    rows += [(None, None, None), (50, None, "x" * 100_000), (51, "http://a.net/" + "y" * 50_000, "<a " * 1000)]
    rows += [(52, "http://a.net/", '<a href="//A.com">')] * 3
    df = spark.createDataFrame(rows, SCHEMA)
    if clashing:
        extra = {c: F.lit(1) for c in [*CLASHING, "host", "path", "rule", "verdict", "trust", "src", "dst"]}
        df = df.withColumns(extra)
    assert tuples(links.judge_urls(df, rounds=3), *COLUMNS) == brute(rows, 3)


def test_empty_table_and_no_seeds(spark):
    assert links.judge_urls(spark.createDataFrame([], SCHEMA)).collect() == []
    only = spark.createDataFrame([(1, "http://a.net/", '<a href="//b.net/">')], SCHEMA)
    assert tuples(links.judge_urls(only), *COLUMNS) == [(1, "a.net", "/", None, "allow", 0, 0)]


def test_no_python_runs(spark):
    df = links.judge_urls(spark.createDataFrame(web(3, 5, 20), SCHEMA), rounds=2)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
