"""The fit against a plain one: the non-negative risk as it is defined, text by text,
and its gradient by differences."""

from __future__ import annotations

import math

import numpy as np
import pytest
from tidemark.llm import quality

HIDDEN, DECAY = 3, 1e-4


def margin(flat, x):
    width = len(x)
    w1 = flat[: width * HIDDEN].reshape(width, HIDDEN)
    b1, w2, b2 = np.split(flat[width * HIDDEN :], [HIDDEN, 2 * HIDDEN])
    hidden = [max(0.0, sum(x[i] * w1[i, j] for i in range(width)) + b1[j]) for j in range(HIDDEN)]
    return sum(h * w for h, w in zip(hidden, w2, strict=True)) + b2[0]


def loss(z):
    """Logistic: of a text that should have a high margin, and has ``z``."""
    return math.log1p(math.exp(-z))


def parts(flat, p, u, prior):
    """Risk of the positives, and of the unlabelled as bad ones without the good
    among them, which is below zero only by overfitting."""
    m_p, m_u = [margin(flat, x) for x in p], [margin(flat, x) for x in u]
    good = prior * sum(loss(m) for m in m_p) / len(m_p)
    bad = sum(loss(-m) for m in m_u) / len(m_u) - prior * sum(loss(-m) for m in m_p) / len(m_p)
    return good, bad


def gradient(of, flat, step=1e-6):
    out = np.zeros_like(flat)
    for i in range(len(flat)):
        up, down = flat.copy(), flat.copy()
        up[i] += step
        down[i] -= step
        out[i] = (of(up) - of(down)) / (2 * step)
    return out


def plain_fit(x_p, x_u, prior, seed, epochs):
    """All texts in one batch; also which parts of the risk were stepped along."""
    rng, width = np.random.default_rng(seed), x_p.shape[1]
    w1 = rng.normal(0, (2 / width) ** 0.5, (width, HIDDEN)).ravel()
    w2 = rng.normal(0, HIDDEN**-0.5, HIDDEN)
    flat = np.r_[w1, np.zeros(HIDDEN), w2, 0.0]
    first, second, negative = np.zeros_like(flat), np.zeros_like(flat), []
    for step in range(1, epochs + 1):
        rng.permutation(len(x_u))
        wrapped = np.take(rng.permutation(len(x_p)), np.arange(256), mode="wrap")
        p, u = x_p[wrapped], x_u
        negative.append(parts(flat, p, u, prior)[1] < 0)
        if negative[-1]:
            slope = -gradient(lambda f: parts(f, p, u, prior)[1], flat)
        else:
            slope = gradient(lambda f: sum(parts(f, p, u, prior)), flat)
        slope = slope + DECAY * flat
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
        by = 3e-3 * math.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        flat = flat - by * first / (np.sqrt(second) + 1e-8)
    return flat, negative


@pytest.mark.parametrize(("shift", "prior", "below"), [(0.0, 0.4, False), (6.0, 0.95, True)])
def test_fit_follows_the_non_negative_risk(shift, prior, below):
    taken = set()
    for seed in range(4):
        rng = np.random.default_rng(100 + seed)
        x_p = (rng.normal(0, 1, (8, 2)) + shift).astype(np.float32)
        x_u = rng.normal(0, 1, (12, 2)).astype(np.float32)
        want, negative = plain_fit(x_p.astype(float), x_u.astype(float), prior, seed, epochs=3)
        got = quality._fit(x_p, x_u, prior, seed, epochs=3, hidden=HIDDEN)
        assert np.concatenate([g.ravel() for g in got]) == pytest.approx(want, abs=5e-4)
        taken |= set(negative)
    assert below in taken
