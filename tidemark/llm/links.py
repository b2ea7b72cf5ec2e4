"""URL filter: rules on host and path, and for the rest a verdict per host from the
link graph.

Trust starts at hosts with pages that a rule allows and follows links; distrust
starts at hosts with pages that a rule blocks and runs against the links, to the
hosts that point there. Both are personalised PageRank over host edges. Ranks are
whole numbers, so sums do not depend on the order of rows and runs agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored

# (host, path, verdict)
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

UNIT = 10**15  # all of trust, and all of distrust
DAMPING = 85  # of 100
ROUNDS = 16
THRESHOLD = 500  # of 1000: a host is blocked above this share of distrust

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The host of an anchor's address with a scheme, or with the page's own ("//host").
# Other addresses stay on the page's host.
LINK = (
    r"<[aA][\x09-\x0D\x20][^>]*?[hH][rR][eE][fF][\x09-\x0D\x20]*=[\x09-\x0D\x20]*"
    r"[\x22\x27]?[\x09-\x0D\x20]*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#\x22\x27\x09-\x0D\x20>]+)"
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower
    case; path: from there up to ``?``, ``#`` or the end. Both are empty for a null
    or an address without ``://``. Ports and user names stay part of the host."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    at = F.locate("://", text)
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, by the length of host and path
    together, then of the host; nulls if none fits. ``rules`` becomes part of the
    plan, so it is a list of hundreds, not of millions."""
    name = verdict = F.lit(None).cast("string")
    for own, start, says in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]), r)):
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(start)
        name = F.when(fits, own + start).otherwise(name)
        verdict = F.when(fits, says).otherwise(verdict)
    return name, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """Distinct (src, dst) between different hosts, from columns host and html. A
    page names each host once; equal pairs are combined before they are shuffled."""
    found = F.array_distinct(F.regexp_extract_all(F.coalesce(F.col("html").cast("string"), F.lit("")), F.lit(LINK), 1))
    links = pages.select(F.col("host").alias("src"), F.explode(found).alias("to"))
    links = links.select("src", F.translate("to", UPPER, LOWER).alias("dst"))
    return links.where("src <> dst").distinct()


def _parts(df: DataFrame, value: str, name: str) -> DataFrame:
    """The whole numbers ``value`` as parts of UNIT of their kind's sum."""
    totals = df.groupBy("kind").agg(F.sum(value).alias("total"))  # a row per kind
    part = F.expr(f"CAST((CAST({value} AS DECIMAL(20, 0)) * {UNIT}) div total AS BIGINT)")
    return df.join(F.broadcast(totals), "kind").select("kind", "host", part.alias(name))


def propagate(
    edges: DataFrame, seeds: DataFrame, damping: int = DAMPING, rounds: int = ROUNDS
) -> DataFrame:
    """(kind, host, rank) by personalised PageRank, for a few kinds of rank at once,
    each with edges (kind, src, dst) and seeds (kind, host, n) of its own: a host
    passes ``damping`` percent of its rank on, in equal parts to the hosts it points
    to, and the rest comes from the seeds.

    Rank of hosts that point nowhere goes back to the seeds in proportion; that
    multiplies all ranks by one number, so it is done once at the end by bringing
    their sum to UNIT. ``edges`` has to be stored. Each round is stored; it ends
    early when no rank changes. No seeds: no rows. Memory and shuffles are those of
    the edges, whatever a host's degree: parts are added up before the shuffle.
    """
    start = stored(_parts(seeds, "n", "start").where("start > 0"))
    degrees = edges.groupBy("kind", "src").agg(F.count("*").alias("degree"))
    out = stored(edges.join(degrees, ["kind", "src"]).withColumnRenamed("src", "host"))
    kept = start.select("kind", "host", F.expr(f"start - start * {damping} div 100").alias("rank"))
    ranks, state = start.withColumnRenamed("start", "rank"), None
    for _ in range(rounds):
        part = F.expr(f"(rank * {damping} div 100) div degree").alias("rank")
        sent = out.join(ranks, ["kind", "host"]).select("kind", F.col("dst").alias("host"), part)
        ranks = sent.unionByName(kept).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        ranks = stored(ranks.where("rank > 0"))
        seen = ranks.agg(F.count("*"), F.sum(F.xxhash64("kind", "host", "rank").cast("decimal(38,0)"))).first()
        if tuple(seen) == state:
            break
        state = tuple(seen)
    return _parts(ranks, "rank", "rank")


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    damping: int = DAMPING,
    rounds: int = ROUNDS,
    threshold: int = THRESHOLD,
) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, host, path, rule,
    verdict, and the host's trust and distrust in parts of 10**15.

    The verdict is the rule's; without one, ``block`` if distrust is more than
    ``threshold`` thousandths of trust and distrust together, else ``allow``. A host
    weighs as a seed by its pages under a rule of the kind.

    Null or malformed urls have an empty host and path and no rule; a null html has
    no links. Hosts that no seed reaches have no trust and no distrust and are
    allowed. Repeated rows are judged each; an empty table gives an empty result;
    other columns are ignored. A host may hold any share of the rows: its counts
    and links combine before they are shuffled, and the last join leaves hot hosts
    to adaptive execution.
    """
    host, path = host_and_path(pages["url"])
    parts = pages.select(pages["page_id"].alias("page_id"), host.alias("host"), path.alias("path"), pages["html"].alias("html"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    edges = stored(host_edges(parts))
    ruled = parts.drop("html").withColumns({"rule": rule, "said": verdict})
    pages_by = ruled.groupBy("host").agg(
        F.count(F.when(F.col("said") == "allow", 1)).alias("trust"),
        F.count(F.when(F.col("said") == "block", 1)).alias("distrust"),
    )
    hosts = stored(pages_by)
    kinds = ("trust", "distrust")
    seeds = [hosts.select(F.lit(k).alias("kind"), "host", F.col(k).alias("n")).where("n > 0") for k in kinds]
    back = edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"))
    both = stored(edges.select(F.lit("trust").alias("kind"), "src", "dst").unionByName(back))
    ranks = propagate(both, seeds[0].unionByName(seeds[1]), damping, rounds)
    of = [F.sum(F.when(F.col("kind") == k, F.col("rank"))).alias(k) for k in kinds]
    reached = ranks.groupBy("host").agg(*of)
    hosts = hosts.select("host").join(reached, "host", "left").fillna(0, list(kinds))
    distrusted = F.col("distrust") * 1000 > (F.col("trust") + F.col("distrust")) * threshold
    own = F.when(distrusted, "block").otherwise("allow")
    return ruled.join(hosts.withColumn("own", own), "host").select(
        "page_id", "host", "path", "rule", F.coalesce("said", "own").alias("verdict"), "trust", "distrust"
    )
