"""Quality by random Fourier features of document statistics.

Each text becomes a fixed list of statistics; a fixed random map approximates a
Gaussian kernel on them; ridge regression is solved from normal equations that
every task adds up over its own rows; and isotonic regression turns the ridge
score into a probability. All labelled training rows take part: the equations
have a fixed size, and only their partial sums (first per task, then per group
of tasks) travel.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

COMPONENTS, WIDTH, RIDGE, SEED = 256, 4.0, 1e-3, 7
#: Score bins of the isotonic fit, and the range of ridge scores they cover.
BINS, LOW, HIGH = 2048, -0.5, 1.5
#: Tasks whose partial sums meet in one group.
GROUP = 64
_LETTERS = re.compile(r"[^\W\d_]+")


def statistics(text: str | None) -> list[float]:
    """Statistics of one whole text; all zero for null, empty and blank texts."""
    text = text or ""
    words = text.split()
    n, size = len(words), len(text)
    if not n:
        return [0.0] * 18
    letters = sum(map(len, _LETTERS.findall(text)))
    digits = sum(map(str.isdigit, text)) if re.search(r"\d", text) else 0
    upper = sum(map(str.isupper, words))
    counts = Counter(words)
    lines = text.split("\n")
    kinds = Counter(w[-1] for w in words)
    bare = sum(1 for w in words if not _LETTERS.search(w))
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    pairs = len(set(zip(words, words[1:])))
    odd = size - letters - digits - text.count(" ") - len(lines) + 1
    ends = kinds["."] + kinds[","]
    line_words = Counter(lines)
    top = counts.most_common(1)[0][1]
    return [
        np.log1p(n),
        np.log1p(size / n),
        letters / size,
        digits / size,
        odd / size,
        upper / n,
        len(counts) / n,
        top / n,
        repeats / n,
        (pairs + 1) / n,
        bare / n,
        sum(c for k, c in kinds.items() if not k.isalnum() and k not in ".,") / n,
        ends / n,
        np.log1p(len(lines) / n * 100),
        len(line_words) / len(lines),
        sum(map(str.istitle, words)) / n,
        sum(len(w) <= 2 for w in words) / n,
        (len(counts) / n**0.7),
    ]


N_STATISTICS = 18


def _summed(rows: DataFrame, part, size: int) -> np.ndarray:
    """The sum over all rows of ``part`` (a function of a pandas batch, giving
    ``size`` numbers): added up per task, per group of tasks, then here."""

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for pdf in batches:
            total += part(pdf)
        yield pd.DataFrame({"g": [TaskContext.get().partitionId() // GROUP], "v": [total.tobytes()]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"g": [0], "v": [np.sum([np.frombuffer(v) for v in pdf["v"]], axis=0).tobytes()]})

    sums = rows.mapInPandas(own, "g long, v binary").groupBy("g").applyInPandas(add, "g long, v binary")
    return np.sum([np.zeros(size), *(np.frombuffer(r["v"]) for r in sums.toLocalIterator())], axis=0)


def pooled(weight: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """Isotonic means (pool adjacent violators) over ordered bins; empty bins take their left neighbour's."""
    blocks: list[list[float]] = []
    for i in np.flatnonzero(weight):
        blocks.append([weight[i], hits[i], i])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            w, h, _ = blocks.pop()
            blocks[-1][0] += w
            blocks[-1][1] += h
    out = np.full(len(weight), blocks[0][1] / blocks[0][0] if blocks else 0.5)
    for w, h, i in blocks:
        out[int(i) :] = h / w
    return out


def _bin(score: np.ndarray) -> np.ndarray:
    return np.clip((score - LOW) / (HIGH - LOW) * BINS, 0, BINS - 1).astype(int)


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of every row's whole text, worked out once."""

    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts])

    return written(docs.select("doc_id", F.pandas_udf(of, "array<double>")("text").alias("x")), "statistics")


def fit(rows: DataFrame, labels: DataFrame, label: str = "quality") -> tuple[np.ndarray, ...]:
    """Means, deviations, ridge weights and calibrated bins from ``rows``
    (doc_id, x) and ``labels``. Labels of ids whose crc32 as text leaves 0
    modulo 5 are not read; remainder 1 calibrates, the others fit the weights."""
    fold = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5).cast("int")
    known = labels.filter(F.col(label).isin(0, 1) & (fold != 0)).groupBy("doc_id").agg(F.max(label).alias("y"))
    seen = written(rows.join(known, "doc_id").select("x", F.col("y").cast("double").alias("y"), fold.alias("fold")), "training")
    k, m = N_STATISTICS, COMPONENTS + 1

    def moments(pdf: pd.DataFrame) -> np.ndarray:
        x = np.array(pdf["x"].tolist(), float).reshape(-1, k)
        return np.concatenate([[len(x)], x.sum(axis=0), (x**2).sum(axis=0)])

    s = _summed(seen, moments, 1 + 2 * k)
    n = max(1.0, s[0])
    mean = s[1 : k + 1] / n
    dev = np.sqrt(np.maximum(s[k + 1 :] / n - mean**2, 0)) + 1e-6

    def normal(pdf: pd.DataFrame) -> np.ndarray:
        z = mapped(np.array(pdf["x"].tolist(), float).reshape(-1, k), mean, dev)
        return np.concatenate([(z.T @ z).ravel(), z.T @ pdf["y"].to_numpy()])

    s = _summed(seen.filter("fold <> 1"), normal, m * m + m)
    gram = s[: m * m].reshape(m, m)
    weights = np.linalg.solve(gram + RIDGE * (1 + np.trace(gram) / m) * np.eye(m), s[m * m :])

    def bins(pdf: pd.DataFrame) -> np.ndarray:
        at = _bin(mapped(np.array(pdf["x"].tolist(), float).reshape(-1, k), mean, dev) @ weights)
        return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at, weights=pdf["y"], minlength=BINS)]).astype(float)

    s = _summed(seen.filter("fold = 1"), bins, 2 * BINS)
    return mean, dev, weights, pooled(s[:BINS], s[BINS:])


def mapped(x: np.ndarray, mean: np.ndarray, dev: np.ndarray) -> np.ndarray:
    """Random Fourier features (and a constant) of statistics, standardised first."""
    rng = np.random.default_rng(SEED)
    w, b = rng.normal(size=(N_STATISTICS, COMPONENTS)) / WIDTH, rng.uniform(0, 2 * np.pi, COMPONENTS)
    z = np.clip((x - mean) / dev, -8, 8)
    return np.column_stack([np.sqrt(2 / COMPONENTS) * np.cos(z @ w + b), np.ones(len(x))])


def score(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality", threshold: float = 0.3) -> DataFrame:
    """Per row of ``docs``: doc_id, _score (probability of label 1), _good (0/1).

    Null, empty and blank texts have the statistics 0 and a score like any
    other; repeated rows score alike; labels that are null or not 0/1 are
    ignored, and without any label all scores are 0.5. Other columns are not
    read.
    """
    rows = described(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    mean, dev, weights, calibrated = fit(rows, labels, label)

    def of(x: pd.Series) -> pd.Series:
        return pd.Series(calibrated[_bin(mapped(np.array(x.tolist(), float).reshape(-1, N_STATISTICS), mean, dev) @ weights)])

    scored = rows.select("doc_id", F.pandas_udf(of, "double")("x").alias("_score"))
    return scored.withColumn("_good", (F.col("_score") >= threshold).cast("int"))
