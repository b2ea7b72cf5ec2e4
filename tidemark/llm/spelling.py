"""Spelling variants: words of the corpus one edit apart, and the form each leads to.

Letters are hashed to a few symbols. The whole one-edit neighbourhood of a reduced
word is then short enough to be written out, and a plain join with the reduced
vocabulary finds all candidates: two words one edit apart reduce to words at most
one edit apart. Candidates are verified on the words themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored

SYMBOLS = 6  # letters are told apart by their code point modulo this
SHORTEST = 6  # code points of a word
LEAST = 5  # occurrences of a word
TIMES = 5  # as frequent, at least, is the form of a word
FAULT = 199  # one run in this many loses a letter

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LETTERS = LOWER + "".join(map(chr, range(0xC0, 0x100)))


def runs(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """Column ``word``: every maximal run of letters (A-Z, a-z, U+00C0 to U+00FF) of
    ``text`` with at least ``shortest`` of them, A-Z in lower case; and ``doc_id``."""
    # Greedy from a run's first letter, so a run is found whole or not at all.
    pattern = F.lit(rf"[A-Za-zÀ-ÿ]{{{shortest},}}")
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    found = docs.select(docs["doc_id"].alias("doc_id"), F.explode(F.regexp_extract_all(text, pattern, 0)).alias("run"))
    # lower() changes more letters than A-Z, but what it leaves alone has none of them.
    own = F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(F.translate("run", UPPER, LOWER))
    return found.select("doc_id", own.alias("word"))


def with_faults(words: DataFrame, fault: int = FAULT) -> DataFrame:
    """Column ``word`` after one letter is deleted where the CRC-32 of
    ``<doc_id>:<word>`` is divisible by ``fault``, at that number modulo the length.
    A null doc_id counts as empty text."""
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "word")
    hashed = words.select("word", F.crc32(key.cast("binary")).alias("h"))
    cut = F.expr("concat(substring(word, 1, int(h % length(word))), substring(word, int(h % length(word)) + 2))")
    return hashed.select(F.when(F.col("h") % fault == 0, cut).otherwise(F.col("word")).alias("word"))


def vocabulary(words: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """(word, n): the distinct words long and frequent enough. Counts combine before
    they are shuffled, so a very frequent word is one row per task."""
    counted = words.where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least)


def neighbourhoods(reduced: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(id, near): for each reduced word (id, r) the hashes of all strings over the
    alphabet at most one edit away, itself included, each once.

    Of equal results only one is written: a letter of a run is deleted at the run's
    end only, a symbol is inserted at the end of a run of itself, and none is
    replaced by itself.
    """
    at = reduced.select("id", "r", F.explode(F.sequence(F.lit(0), F.length("r"))).alias("i"))
    at = at.select(
        "id",
        F.expr("substring(r, 1, i)").alias("head"),
        F.expr("substring(r, i + 1, 1)").alias("own"),
        F.expr("substring(r, i + 2, 1)").alias("following"),
        F.expr("substring(r, i + 2)").alias("rest"),
    )
    # Behind the last letter, own is empty: deleting it gives the word itself.
    edits = [F.when((F.col("own") == "") | (F.col("own") != F.col("following")), F.concat("head", "rest"))]
    for s in "".join(_symbols(symbols)):
        other = (F.col("own") != s) & (F.col("own") != "")
        edits.append(F.when(other, F.concat("head", F.lit(s), "rest")))
        edits.append(F.when(F.col("own") != s, F.concat("head", F.lit(s), "own", "rest")))
    out = at.select("id", F.explode(F.array(*edits)).alias("near")).where("near IS NOT NULL")
    return out.select("id", F.xxhash64("near").alias("near"))


def _symbols(n: int) -> list[str]:
    return [chr(ord("a") + i) for i in range(n)]


def near_pairs(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(word, n, near, near_n), both ways round, for words of ``words`` (word, n) that
    differ by exactly one inserted, deleted or replaced code point.

    ``words`` has to be stored and its words distinct, of the letters that
    :func:`runs` finds. Reduced words travel as hashes; where two of them agree by
    chance there are more candidates, never fewer. Every join is on a key; a
    reduced word has as many words as letters fall together, and adaptive execution
    splits a partition with many.
    """
    alphabet = _symbols(symbols)
    symbol_of = "".join(alphabet[ord(c) % symbols] for c in LETTERS)
    own = words.withColumn("r", F.translate("word", LETTERS, symbol_of))
    own = own.select("word", "n", "r", F.xxhash64("r").alias("id"))
    reduced = stored(own.select("id", "r").distinct())
    ids = reduced.select(F.col("id").alias("to")).distinct()
    around = neighbourhoods(reduced, symbols)
    close = around.join(ids, around["near"] == ids["to"]).select("id", "to")
    a = own.select("id", "word", "n")
    b = own.select(F.col("id").alias("to"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    candidates = close.join(a, "id").join(b, "to")
    one = F.levenshtein("word", "near", 1) == 1
    return candidates.where(one).select("word", "n", "near", "near_n").distinct()


def forms(words: DataFrame, pairs: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, n, n_near, form, form_n): a word's form is its near word of largest n,
    the first in code-point order of equals, if that is ``times`` its own n or more."""
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    out = words.select("word", "n").join(near, "word", "left")
    found = -F.col("best.less") >= F.col("n") * times
    return out.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(found, F.col("best.form")).alias("form"),
        F.when(found, -F.col("best.less")).alias("form_n"),
    )


def roots(formed: DataFrame) -> DataFrame:
    """(word, root) for words that have a form: the last one, form by form.

    Each round lets every word point to what its target points to, so the length
    that is left halves; forms are ``times`` as frequent as their words, so chains
    end and are short. ``formed`` has to be stored, and each round is.
    """
    links = stored(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        following = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = links.join(following, "root", "left")
        moved = stored(moved.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moves")))
        if moved.where("moves").isEmpty():
            return moved.select("word", "root")
        links = moved.select("word", "root")


def spelling_variants(
    docs: DataFrame,
    symbols: int = SYMBOLS,
    shortest: int = SHORTEST,
    least: int = LEAST,
    times: int = TIMES,
    fault: int = FAULT,
) -> DataFrame:
    """Words of ``docs`` (doc_id, text) with their forms: word, form, root, n, n_near,
    form_n.

    Null and empty texts have no words; texts are read whole; repeated rows count
    each; a null doc_id is an empty text in the hash; an empty table gives an empty
    result; other columns are ignored. Of near words equally frequent, the first in
    code-point order is the form. A word without near words has n_near 0, no form
    and itself as root.
    """
    words = stored(vocabulary(with_faults(runs(docs, shortest), fault), shortest, least))
    formed = stored(forms(words, near_pairs(words, symbols), times))
    last = roots(formed)
    out = formed.join(last, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
