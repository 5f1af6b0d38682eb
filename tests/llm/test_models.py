"""The trained models against plain versions: Kneser-Ney, ridge, isotonic calibration."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from roundbook.llm import quality, toxicity
from roundbook.llm.toxicity import DISCOUNT, SHARED, TOP


def plain_ratios(rows):
    """Order and gram to log P(toxic) - log P(ordinary), and of contexts' back-off weights."""
    every, by_class = set(), {0: Counter(), 1: Counter()}
    for text, cls in rows:
        for w in toxicity.words_of(text):
            padded = " " * (TOP - 1) + w + " "
            grams = [padded[i : i + TOP] for i in range(len(w) + 1)]
            every.update(grams)
            if cls in by_class:
                by_class[cls].update(grams)
    counts = Counter(g[-SHARED:] for g in every)
    letters = len({g[-1] for g in counts})
    total, kinds = Counter(), Counter()
    for g, n in counts.items():
        total[g[:-1]] += n
        kinds[g[:-1]] += 1
    lower = {g: (n - DISCOUNT + DISCOUNT * kinds[g[:-1]] / letters) / total[g[:-1]] for g, n in counts.items()}
    p, out = {0: lower, 1: lower}, {}
    for order in range(SHARED + 1, TOP + 1):
        n = by_class if order == TOP else {k: Counter(g[-order:] for g in {x[-order - 1 :] for x in by_class[k]}) for k in (0, 1)}
        grams = set(n[0]) | set(n[1])
        t, kinds = {k: Counter() for k in (0, 1)}, {k: Counter() for k in (0, 1)}
        for k in (0, 1):
            for g, c in n[k].items():
                t[k][g[:-1]] += c
                kinds[k][g[:-1]] += 1
        b = {k: defaultdict(lambda: 1.0, {h: DISCOUNT * kinds[k][h] / t[k][h] for h in t[k]}) for k in (0, 1)}
        p = {k: {g: max(n[k][g] - DISCOUNT, 0) / max(t[k][g[:-1]], 1) + b[k][g[:-1]] * p[k][g[1:]] for g in grams} for k in (0, 1)}
        out |= {(order, g): math.log(p[1][g] / p[0][g]) for g in grams}
        out |= {(-order, h): math.log(b[1][h] / b[0][h]) for h in {g[:-1] for g in grams}}
    return out


def test_kneser_ney_equals_its_definition(spark):
    rng = random.Random(8)
    words = ["ab", "abba", "abab", "baba", "cab", "abbacus", "a", "Éab", "zz"]
    rows = [(" ".join(rng.choice(words[: rng.choice([4, 9])]) for _ in range(rng.randint(0, 12))), rng.choice([0, 0, 1, -1])) for _ in range(80)] + [(None, 1), ("", 0), ("zz zz", 1)]
    docs = spark.createDataFrame(rows, "text string, cls int").repartition(3)
    got = {(r["order"], r["gram"]): r["ratio"] for r in toxicity.model(toxicity.gram_counts(docs)).collect()}
    want = plain_ratios(rows)
    assert got.keys() == want.keys() and len(want) > 100
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


@pytest.mark.parametrize("seed", range(20))
def test_isotonic_means_equal_the_min_max_formula(seed):
    rng = np.random.default_rng(seed)
    weight = rng.integers(0, 4, 30).astype(float)
    hits = np.array([rng.integers(0, int(w) + 1) for w in weight], float)
    got, full = quality.pooled(weight, hits), np.flatnonzero(weight)
    for i in full:
        best = max(min(hits[a : b + 1].sum() / weight[a : b + 1].sum() for b in full if b >= i) for a in full if a <= i)
        assert abs(got[i] - best) < 1e-12
    assert (np.diff(got) >= -1e-12).all()
    assert (quality.pooled(np.zeros(5), np.zeros(5)) == 0.5).all()


def test_ridge_equals_the_dense_solution(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(500, quality.N_STATISTICS)) * rng.random(quality.N_STATISTICS) * 5
    y = (x[:, 0] + rng.normal(size=500) > 0).astype(int)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "doc_id long, x array<double>").repartition(7)
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "doc_id long, quality int")
    mean, dev, weights, calibrated = quality.fit(rows, labels)
    fold = np.array([zlib.crc32(str(i).encode()) % 5 for i in range(500)])
    seen = x[fold != 0]
    assert np.allclose(mean, seen.mean(axis=0)) and np.allclose(dev, seen.std(axis=0) + 1e-6)
    z = quality.mapped(x[fold > 1], mean, dev)
    gram = z.T @ z
    dense = np.linalg.solve(gram + quality.RIDGE * (1 + np.trace(gram) / len(gram)) * np.eye(len(gram)), z.T @ y[fold > 1])
    assert np.allclose(weights, dense)
    at = quality._bin(quality.mapped(x[fold == 1], mean, dev) @ weights)
    assert np.allclose(calibrated, quality.pooled(np.bincount(at, minlength=quality.BINS), np.bincount(at, y[fold == 1], quality.BINS)))
