"""Language by sparse multinomial logistic regression on character n-grams.

A text is the bag of its lower-cased letter n-grams of one to three characters,
words bounded by one space, hashed to ``DIMENSIONS`` places and weighted by
TF-IDF: the gram's share of the text's grams times its inverse document
frequency. Document frequencies come from all training rows. The weights are
trained in one pass of follow-the-regularised-leader with elastic-net penalties
over a bounded sample; most of them are exactly zero. One temperature, fitted on
other sampled rows, makes the softmax a probability.

Training reads only text and language of rows outside the held-out fold.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import mix64, read_parquet, shared_path, uri, written

ORDERS, BITS = 3, 18
DIMENSIONS = 1 << BITS
#: Rows that train the weights, and rows that fit the temperature, at most: shared out
#: evenly among the languages.
SAMPLE, CALIBRATION = 20_000, 5_000
#: Rate, its offset, lasso and ridge of the training; texts are scaled by ``SCALE``.
ALPHA, BETA, LASSO, RIDGE, SCALE = 0.5, 0.1, 0.05, 0.01, 20.0
#: Code points that a task takes grams from at a time, and characters of a block of texts.
STEP, BLOCK = 500_000, 1_000_000
UNKNOWN = "und"
_SPACE = 32
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


@cache
def _characters() -> np.ndarray:
    """Of every code point: 2 for a letter, 1 for a mark (part of a word), 0 for others."""
    out = np.zeros(0x110000, np.uint8)
    for k in range(0x110000):
        c = chr(k)
        out[k] = 2 if c.isalpha() else unicodedata.category(c)[0] == "M"
    return out


def _codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block of texts: code points with every run of other characters as one
    space, the text number of each, and whether each text has a letter."""
    lowered = [" " + t.lower() + " " if t else " " for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.array([len(t) for t in lowered])
    starts = np.cumsum(lengths) - lengths
    kind = _characters()[codes]
    letters = np.add.reduceat(kind == 2, starts) > 0
    doc = np.repeat(np.arange(len(texts)), lengths)
    codes = np.where(kind > 0, codes, np.uint32(_SPACE))
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != _SPACE) | (codes[:-1] != _SPACE) | (doc[1:] != doc[:-1])
    return codes[keep], doc[keep], letters


def _grams(codes: np.ndarray, doc: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, place of the gram), some code points at a time, order by order;
    text numbers ascend within each. A lone space is no gram, nor is one that
    begins in one text and ends in another."""
    for at in range(0, len(codes), STEP):
        to = min(len(codes), at + STEP)
        h = np.zeros(to - at, np.uint64)
        for n in range(1, ORDERS + 1):
            end = min(to, len(codes) - n + 1)
            if end <= at:
                break
            h = h[: end - at] * _FACTORS[1] + (codes[at + n - 1 : end + n - 1].astype(np.uint64) + np.uint64(n)) * _FACTORS[0]
            valid = doc[at:end] == doc[at + n - 1 : end + n - 1] if n > 1 else codes[at:end] != _SPACE
            yield doc[at:end][valid], (mix64(h[valid] ^ _FACTORS[2]) >> np.uint64(64 - BITS)).astype(np.int64)


def _text_blocks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``BLOCK`` characters; a longer text is a range of its own."""
    at, size = 0, 0
    for k, t in enumerate(texts):
        if k > at and size + len(t or "") > BLOCK:
            yield at, k
            at, size = k, 0
        size += len(t or "")
    if at < len(texts):
        yield at, len(texts)


def _document_frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How many rows of the task hold each gram: ``(gram, rows)``."""
    total = np.zeros(DIMENSIONS, np.int64)
    for pdf in batches:
        texts = pdf["text"].tolist()
        for at, to in _text_blocks(texts):
            codes, doc, _ = _codes(texts[at:to])
            if to == at + 1:
                there = np.zeros(DIMENSIONS, bool)
                for _, gram in _grams(codes, doc):
                    there[gram] = True
                total += there
            else:
                both = np.sort(np.concatenate([d * DIMENSIONS + g for d, g in _grams(codes, doc)] or [np.empty(0, np.int64)]))
                first = np.ones(len(both), bool)
                first[1:] = both[1:] != both[:-1]
                total += np.bincount(both[first] % DIMENSIONS, minlength=DIMENSIONS)
    at = np.flatnonzero(total)
    yield pd.DataFrame({"gram": at, "rows": total[at]})


def _idf(folder: str, n_rows: int) -> np.ndarray:
    rows = read_parquet(folder, ["gram", "rows"])
    counts = np.zeros(DIMENSIONS)
    counts[rows["gram"].to_numpy()] = rows["rows"].to_numpy()
    return np.log((1 + n_rows) / (1 + counts)) + 1


def _features(folder: str, n_rows: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The sampled rows' grams and weights as bytes."""
    idf = _idf(folder, n_rows)
    for pdf in batches:
        for at in range(0, len(pdf), 200):
            part = pdf.iloc[at : at + 200]
            out = []
            for t in part["text"]:
                n = np.zeros(DIMENSIONS)
                for _, gram in _grams(*_codes([t])[:2]):
                    n += np.bincount(gram, minlength=DIMENSIONS)
                grams = np.flatnonzero(n)
                x = n[grams] * idf[grams] * SCALE / max(1.0, n.sum())
                out.append((grams.astype(np.uint32).tobytes(), x.astype(np.float32).tobytes()))
            yield pd.DataFrame({"lang": part["lang"].to_numpy(), "place": part["place"].to_numpy(), "fit": part["fit"].to_numpy(), "grams": [g for g, _ in out], "x": [x for _, x in out]})


class Ftrl:
    """Follow-the-regularised-leader for multinomial logistic regression, one row at a time."""

    def __init__(self, classes: int, dimensions: int = DIMENSIONS + 1):
        self.z, self.n = np.zeros((dimensions, classes)), np.zeros((dimensions, classes))

    def weights(self, at) -> np.ndarray:
        """The leader's weights: zero wherever the lasso outweighs the gradients' sum."""
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= LASSO, 0.0, (np.sign(z) * LASSO - z) / ((BETA + np.sqrt(n)) / ALPHA + RIDGE))

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        error = softmax(x @ w)
        error[label] -= 1
        g = x[:, None] * error
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least log loss (golden section over its logarithm)."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        s = logits / np.exp(t)
        top = s.max(axis=1)
        return float(np.mean(np.log(np.exp(s - top[:, None]).sum(axis=1)) + top - s[np.arange(len(labels)), labels]))

    low, high, ratio = -4.0, 4.0, (5**0.5 - 1) / 2
    a, b = high - ratio * (high - low), low + ratio * (high - low)
    fa, fb = loss(a), loss(b)
    for _ in range(50):
        if fa <= fb:
            high, b, fb = b, a, fa
            a = high - ratio * (high - low)
            fa = loss(a)
        else:
            low, a, fa = a, b, fb
            b = low + ratio * (high - low)
            fb = loss(b)
    return float(np.exp((low + high) / 2))


def _train(langs: list[str], batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One pass over the sample, the rows that fit the temperature last: ``(gram, class,
    weight)``; gram ``DIMENSIONS`` is the bias, class -1 the temperature."""
    model, place = Ftrl(len(langs)), {x: k for k, x in enumerate(langs)}
    logits, labels = [], []
    for pdf in batches:
        for lang, fit, grams, x in zip(pdf["lang"], pdf["fit"], pdf["grams"], pdf["x"]):
            at = np.append(np.frombuffer(grams, np.uint32).astype(np.int64), DIMENSIONS)
            values = np.append(np.frombuffer(x, np.float32).astype(float), 1.0)
            if fit:
                model.learn(at, values, place[lang])
            else:
                logits.append(values @ model.weights(at))
                labels.append(place[lang])
    weights = model.weights(slice(None))
    at, cls = np.nonzero(weights)
    t = temperature(np.array(logits).reshape(-1, len(langs)), np.array(labels, np.int64))
    yield pd.DataFrame({"gram": np.append(at, 0), "class": np.append(cls, -1), "weight": np.append(weights[at, cls], t)})


def held_out(doc_id: Column, of: int = 5) -> Column:
    """Whether crc32 of the id as text is divisible by ``of``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % of == 0, F.lit(False))


def fit(docs: DataFrame) -> tuple[str, list[str], int]:
    """Train on ``docs`` (doc_id, text, lang): the folder of the model, its languages and
    the number of training rows. Rows of the held-out fold, without id, text or
    language, are not learned from."""
    spark = docs.sparkSession
    known = docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs, n_rows = sorted(counts), sum(counts.values())
    here = shared_path(spark, "language-model")
    if not langs:
        return here, [], 0
    known.select("text").mapInPandas(_document_frequencies, "gram long, rows long").groupBy("gram").agg(F.sum("rows").alias("rows")).write.parquet(f"{here}/rows")
    quota = [max(1, most // len(langs)) for most in (SAMPLE, CALIBRATION)]
    # A hash keeps a little more than the quota where the table is read, without a
    # shuffle of texts; the window then makes it exact.
    share = {x: min(1.0, 1.2 * sum(quota) / counts[x] + 100 / counts[x]) for x in langs}
    chance = F.element_at(F.create_map(*[F.lit(v) for pair in share.items() for v in pair]), F.col("lang"))
    drawn = known.select("doc_id", "lang", "text", F.xxhash64("doc_id", F.lit(12)).alias("draw")).filter((F.col("draw") / F.lit(2.0**64) + 0.5) < chance)
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id", "text"))
    sample = drawn.withColumn("nth", nth).filter(F.col("nth") <= sum(quota))
    # Every row of a language at the same pace: the fifth part of each goes to the temperature.
    every = sum(quota) // quota[1]
    sample = sample.select("lang", "text", F.xxhash64("draw").alias("place"), (F.col("nth") % every != 0).alias("fit"))
    features = written(sample.repartition("place").mapInPandas(partial(_features, uri(f"{here}/rows"), n_rows), "lang string, place long, fit boolean, grams binary, x binary"), "features")
    ordered = features.repartition(1).sortWithinPartitions(F.desc("fit"), "place", "lang")
    ordered.mapInPandas(partial(_train, langs), "gram long, class int, weight double").write.parquet(f"{here}/weights")
    return here, langs, n_rows


class Model:
    """A trained model as a task reads it: per gram its IDF times its weights."""

    def __init__(self, folder: str, langs: list[str], n_rows: int):
        rows = read_parquet(f"{folder}/weights", ["gram", "class", "weight"])
        gram, cls, weight = (rows[c].to_numpy() for c in ("gram", "class", "weight"))
        self.temperature = float(weight[cls == -1][0])
        table = np.zeros((DIMENSIONS + 1, len(langs)))
        table[gram[cls >= 0], cls[cls >= 0]] = weight[cls >= 0]
        self.bias = table[DIMENSIONS]
        self.table = (table[:DIMENSIONS] * (_idf(f"{folder}/rows", n_rows) * SCALE)[:, None]).astype(np.float32)
        self.langs = np.array(langs, object)

    def predict(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Language and calibrated probability of each text of a block."""
        codes, doc, letters = _codes(texts)
        sums, grams = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        for d, gram in _grams(codes, doc):
            if not len(d):
                continue
            at = np.flatnonzero(np.append(True, d[1:] != d[:-1]))
            sums[d[at]] += np.add.reduceat(self.table[gram], at, axis=0, dtype=np.float64)
            grams[d[at]] += np.diff(np.append(at, len(d)))
        p = softmax((sums / np.maximum(grams, 1)[:, None] + self.bias) / self.temperature)
        best = p.argmax(axis=1)
        return np.where(letters, self.langs[best], UNKNOWN), np.where(letters, p[np.arange(len(texts)), best], 0.0)


def language(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every row, in training rows too.

    A null text and one without a letter are ``und`` with score 0, and so are all
    texts if there is nothing to learn from. Whole texts are read, however long.
    Ties go to the language that sorts first. Rows of null id are not held out
    and not learned from; repeated rows are judged alike; an empty input gives no
    rows; other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    folder, langs, n_rows = fit(rows)
    named = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    if not langs:
        return named.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    place = uri(folder)

    @F.pandas_udf("lang_pred string, score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Model(place, langs, n_rows)
        for texts in batches:
            texts = texts.tolist()
            found = [model.predict(texts[a:b]) for a, b in _text_blocks(texts)] or [(np.empty(0, object), np.empty(0))]
            yield pd.DataFrame({"lang_pred": np.concatenate([x for x, _ in found]), "score": np.concatenate([s for _, s in found])})

    return named.select("doc_id", "held_out", judge("text").alias("found")).select("doc_id", "held_out", "found.lang_pred", "found.score")
