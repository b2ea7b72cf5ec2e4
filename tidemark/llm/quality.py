"""A quality classifier learned from trusted positives and unlabelled text.

Non-negative PU learning: with class prior p, positives P and unlabelled text U,
the risk of a scorer f is p E_P[l(f)] + max(0, E_U[l(-f)] - p E_P[l(-f)]). The
prior is estimated too, from the best bin of a positives-against-unlabelled
classifier. Fitting uses a bounded sample; scoring covers every text, in one scan
without a shuffle.

A text is described by what its characters look like, not by its words: counts of
character-class triples over the whole text, and how often words, neighbours and
lines repeat.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import python_ready, fresh, text_of

THRESHOLD = 0.3
FOLDS = 5
# At most so many positives and unlabelled texts take part in the fit.
POSITIVES = 4000
UNLABELLED = 8000

# Classes of bytes: small letter, capital, digit, blank, line end, ".", ",", "!",
# other closing marks, brackets and quotes, symbols, bar, beyond ASCII.
_CLASSES = (
    b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b" \t",
    b"\n\r\x0b\x0c",
    b".",
    b",",
    b"!",
    b"?:;-'",
    b"\"()[]{}<>/\\",
    b"#$%&*+=@^_~`",
    b"|",
)
KINDS = len(_CLASSES) + 1
SHAPES = KINDS**3
FEATURES = SHAPES + 6


def features(texts: list[str]):
    """One row of FEATURES numbers per text."""
    import numpy as np

    kinds = np.full(256, KINDS - 1, dtype=np.uint8)
    for kind, members in enumerate(_CLASSES):
        kinds[list(members)] = kind
    kinds[:32][kinds[:32] == KINDS - 1] = 4
    out = np.zeros((len(texts), FEATURES), dtype=np.float32)
    for i, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass")
        shape = kinds[np.frombuffer(data, dtype=np.uint8)].astype(np.int32)
        if len(shape) > 2:
            triples = (shape[:-2] * KINDS + shape[1:-1]) * KINDS + shape[2:]
            counts = np.bincount(triples, minlength=SHAPES)
            out[i, :SHAPES] = np.sqrt(counts / len(triples))
        words = data.split()
        n = len(words)
        lines = data.split(b"\n")
        same = sum(map(bytes.__eq__, words, words[1:]))
        out[i, SHAPES:] = (
            len(set(words)) / n if n else 1.0,
            same / n if n else 0.0,
            min(1.0, same / 4),
            len(set(lines)) / len(lines),
            np.log1p(n) / 10,
            min(1.0, len(data) / (n * 20)) if n else 0.0,
        )
    return out


def packed(x) -> bytes:
    """One text's features without the zeros, which are nearly all: places as unsigned
    16-bit numbers, then values of 16 bits."""
    import numpy as np

    x = x.astype(np.float16)
    at = np.flatnonzero(x)
    return at.astype("<u2").tobytes() + x[at].tobytes()


def unpacked(data: bytes):
    import numpy as np

    half = len(data) // 2
    return np.frombuffer(data[:half], "<u2"), np.frombuffer(data[half:], np.float16)


@dataclass(frozen=True)
class Scorer:
    """Weights of two layers; ``score`` is the estimated chance of a good text."""

    layers: tuple
    prior: float

    def margin(self, x):
        import numpy as np

        w1, b1, w2, b2 = self.layers
        return np.maximum(x @ w1 + b1, 0) @ w2 + b2

    def score(self, texts: list[str]):
        import numpy as np

        return 1 / (1 + np.exp(-np.clip(self.margin(features(texts)), -30, 30).astype(np.float64)))


def _fit(x_p, x_u, prior: float | None, seed: int, epochs: int, hidden: int = 16):
    """Adam on the non-negative risk, or, without a prior, on plain logistic loss of
    positives against unlabelled."""
    import numpy as np

    rng = np.random.default_rng(seed)
    width = x_p.shape[1]
    params = [
        rng.normal(0, (2 / width) ** 0.5, (width, hidden)).astype(np.float32),
        np.zeros(hidden, np.float32),
        rng.normal(0, hidden**-0.5, hidden).astype(np.float32),
        np.zeros(1, np.float32),
    ]
    first = [np.zeros_like(p) for p in params]
    second = [np.zeros_like(p) for p in params]
    step, size = 0, 256

    def sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def gradient(x, slope):
        """Of the sum of slope * margin."""
        w1, b1, w2, _ = params
        h = np.maximum(x @ w1 + b1, 0)
        back = np.outer(slope, w2) * (h > 0)
        return [x.T @ back, back.sum(0), h.T @ slope, slope.sum(keepdims=True)]

    def margin(x):
        return np.maximum(x @ params[0] + params[1], 0) @ params[2] + params[3]

    for _ in range(epochs):
        order_u, order_p = rng.permutation(len(x_u)), rng.permutation(len(x_p))
        for at in range(0, len(order_u), size):
            u = x_u[order_u[at : at + size]]
            p = x_p[np.take(order_p, np.arange(at, at + size), mode="wrap")]
            m_u, m_p = margin(u), margin(p)
            as_bad_u, as_bad_p = sigmoid(m_u) / len(u), sigmoid(m_p) / len(p)
            as_good_p = -sigmoid(-m_p) / len(p)
            if prior is None:
                grads = [a + b for a, b in zip(gradient(u, as_bad_u), gradient(p, as_good_p), strict=True)]
            else:
                bad_risk = np.logaddexp(0, m_u).mean() - prior * np.logaddexp(0, m_p).mean()
                rest = [
                    a - prior * b
                    for a, b in zip(gradient(u, as_bad_u), gradient(p, as_bad_p), strict=True)
                ]
                if bad_risk < 0:  # overfitted: step back from the negative part alone
                    grads = [-r for r in rest]
                else:
                    good = gradient(p, prior * as_good_p)
                    grads = [a + b for a, b in zip(good, rest, strict=True)]
            step += 1
            for i, grad in enumerate(grads):
                grad = grad + 1e-4 * params[i]
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.999 * second[i] + 0.001 * grad**2
                rate = 3e-3 * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
                params[i] = (params[i] - rate * first[i] / (second[i] ** 0.5 + 1e-8)).astype(np.float32)
    return tuple(params)


def estimate_prior(m_p, m_u, confidence: float = 0.1) -> float:
    """Share of good texts among the unlabelled: the smallest ratio, over cuts from
    the top, of the unlabelled above a cut to the positives above it, each cut
    charged for its uncertainty."""
    import numpy as np

    cuts = np.sort(np.r_[m_p, m_u])
    q_p = 1 - np.searchsorted(np.sort(m_p), cuts) / len(m_p)
    q_u = 1 - np.searchsorted(np.sort(m_u), cuts) / len(m_u)
    unsure = (np.log(4 / confidence) / 2) ** 0.5 * (len(m_u) ** -0.5 + len(m_p) ** -0.5)
    usable = q_p > 0.01
    bound = (q_u[usable] + unsure) / q_p[usable]
    best = int(np.argmin(bound))
    return float(np.clip(q_u[usable][best] / q_p[usable][best], 0.05, 0.95))


def learn(positives: list[str], unlabelled: list[str], seed: int = 10, epochs: int = 30) -> Scorer:
    """Fit on texts. Without texts of either kind every score is 0.5."""
    import numpy as np

    if not positives or not unlabelled:
        empty = (np.zeros((FEATURES, 1)), np.zeros(1), np.zeros(1), np.zeros(1))
        return Scorer(empty, 0.5)
    return learn_features(features(positives), features(unlabelled), seed, epochs)


def learn_features(x_p, x_u, seed: int = 10, epochs: int = 30) -> Scorer:
    held_p, held_u = max(1, len(x_p) // 3), max(1, len(x_u) // 3)
    apart = _fit(x_p[held_p:] if len(x_p) > 1 else x_p, x_u[held_u:] if len(x_u) > 1 else x_u, None, seed, 8)
    probe = Scorer(apart, 0.5)
    prior = estimate_prior(probe.margin(x_p[:held_p]), probe.margin(x_u[:held_u]))
    return Scorer(_fit(x_p, x_u, prior, seed, epochs), prior)


def is_held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; those without an id are."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def train(
    docs: DataFrame,
    labels: DataFrame,
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
    seed: int = 10,
) -> Scorer:
    """Fit on at most ``positives`` texts with a label of good quality outside the
    held-out fold, and at most ``unlabelled`` texts of all documents, whose labels
    are not looked at. Both are seeded samples; only their features, of whole texts,
    reach the driver, without zeros: about 130 bytes a text."""
    import numpy as np

    python_ready(docs.sparkSession)

    def order(c: Column) -> Column:
        return F.xxhash64(c, F.lit(seed))

    good = labels.where(
        (labels["quality"] == 1) & labels["doc_id"].isNotNull() & ~is_held_out(labels["doc_id"])
    )
    good = good.select(labels["doc_id"].alias("doc_id")).distinct()
    trusted = good.orderBy(order(F.col("doc_id")), "doc_id").limit(positives)

    own = docs.select(docs["doc_id"].alias("doc_id"), text_of(docs).alias("text"))
    total = own.count()
    # A bound on the hash lets through a little more than what is wanted, so that
    # few texts are described in vain; the lowest hashes of these are the sample.
    share = min(1.0, 1.2 * unlabelled / max(1, total) + 0.0005)
    edge = int(-(2**63) + share * (2**64 - 1))
    mixed = own.where(order(F.col("doc_id")) <= F.lit(edge)) if share < 1 else own

    @F.pandas_udf("binary")
    def described(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([packed(x) for x in features(list(batch))], dtype="object")

    def collected(df: DataFrame, most: int):
        rows = df.select(order(F.col("doc_id")).alias("at"), described("text").alias("x"))
        rows = rows.orderBy("at", "x").limit(most).collect()
        out = np.zeros((len(rows), FEATURES), np.float32)
        for n, r in enumerate(rows):
            at, values = unpacked(r["x"])
            out[n, at] = values
        return out

    # The trusted ids are bounded by ``positives``.
    x_p = collected(own.join(F.broadcast(trusted), "doc_id"), positives)
    x_u = collected(mixed, unlabelled)
    if not len(x_p) or not len(x_u):
        return learn([], [])
    return learn_features(x_p, x_u, seed)


def scores(text: Column, scorer: Scorer) -> Column:
    @F.pandas_udf("double")
    def quality(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(scorer.score(list(batch)), dtype="float64")

    return quality(text)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **how) -> DataFrame:
    """One row per document: doc_id, held_out, score and predicted.

    Null texts are scored as empty ones. Rows without an id are scored too and
    count as held out, as a label cannot name them. Without usable labels or
    documents every score is 0.5. Only the text enters a score.
    """
    scorer = train(docs, labels, **how)
    scored = docs.select(
        docs["doc_id"].alias("doc_id"),
        is_held_out(docs["doc_id"]).alias("held_out"),
        scores(text_of(docs), scorer).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **how) -> DataFrame:
    """The documents whose score reaches the threshold, all columns as they are.

    A null text is scored like an empty one and stays null; rows without an id and
    repeated rows are judged by their text, so copies stay or go together. Without
    labels every score is 0.5, which keeps all rows; an empty table stays empty.
    """
    scorer = train(docs, labels, **how)
    (score,) = fresh(docs, "score")
    scored = docs.withColumn(score, scores(text_of(docs), scorer))
    return scored.where(F.col(score) >= threshold).drop(score)
