"""Toxicity by class-conditional Kneser-Ney models.

Two character models of words, one per class, give log-likelihoods. Orders
``TOP`` to ``SHARED + 1`` hold the class's own (continuation) counts from the
labelled training rows; order ``SHARED`` is one distribution for both classes
and is what a rare expression falls back to. It counts the different grams of
order ``TOP`` over all documents, so it goes on learning with the corpus. A word starts from its own beginning, so an expression is judged
wherever it stands.

A text is judged by its words' log-likelihood ratios (toxic over ordinary):
their mean over all occurrences, which is the ratio normalised by length; and,
over its different words, their mean, the strongest, and the numbers of strong
ones in proportion to the text's length.
A logistic curve, fitted on training rows that gave no counts, turns them into
a probability.

All labelled training rows give counts; only the rows that fit the curve are
bounded (``MAX_CURVE``). The models grow with the corpus, so no worker holds
them: each executor has them as sorted files that its workers map.
"""

from __future__ import annotations

import fcntl
import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import file_system, mix64, shared_path, unused, uri, written

TOP, SHARED, DISCOUNT = 6, 3, 0.75
#: Rows that fit the curve at most, about.
MAX_CURVE = 200_000
#: Words whose ratio a Python worker keeps; at that number the table starts anew.
KEPT_WORDS = 300_000
#: Texts whose words are held at a time.
CHUNK = 200
#: Word ratios that the strong words of a text are counted above, and the
#: number of words below which a text counts as that long.
ABOVE, FEWEST = (2.0, 3.0, 4.0, 6.0), 30
FEATURES = 6 + len(ABOVE)
_ORDERS = [sign * order for order in range(SHARED + 1, TOP + 1) for sign in (1, -1)]
_WORDS = re.compile(r"[^\W\d_]+")
_PAD = " " * (TOP - 1)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters."""
    return _WORDS.findall(text.lower()) if text else []


def _windows(words: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """The padded words as one string, the position of every predicted
    character (letters and the blank behind a word) and its word's number."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + TOP)
    which = np.repeat(np.arange(len(words)), size + 1)
    own = np.arange(len(which)) - np.repeat(np.cumsum(size + 1) - size - 1, size + 1)
    return "".join([_PAD + w + " " for w in words]), (ends - size - 1)[which] + own, which


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _keys(codes: np.ndarray, last: np.ndarray, order: int) -> np.ndarray:
    """One 64-bit key for the ``order`` characters that end at each position."""
    key = np.full(len(last), order, np.uint64)
    for k in range(order):
        key += (codes[last - k] + np.uint64(1)) * _FACTORS[k]
    return mix64(key)


def _grams(counts: dict[str, int], order: int) -> pd.DataFrame:
    """Grams of the given order in words that occur so often."""
    words = list(counts)
    text, last, which = _windows(words)
    _, first, group = np.unique(_keys(_codes(text), last, order), return_index=True, return_inverse=True)
    n = np.bincount(group, weights=np.fromiter(counts.values(), np.int64, len(words))[which]).astype(np.int64)
    ends = last[first].tolist()
    return pd.DataFrame({"gram": [text[i - order + 1 : i + 1] for i in ends], "n": n})


def gram_counts(docs: DataFrame) -> DataFrame:
    """(kind, gram, n) from ``docs`` (text, cls): grams of order ``TOP`` of
    class 1 and 0 rows, and of every row (kind -1)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            by_class, every = {0: Counter(), 1: Counter()}, Counter()
            for text, cls in zip(pdf["text"].tolist(), pdf["cls"].tolist()):
                words = words_of(text)
                every.update(words)
                if cls in by_class:
                    by_class[cls].update(words)
            for kind, counts in ((0, by_class[0]), (1, by_class[1]), (-1, every)):
                if counts:
                    yield _grams(counts, TOP).assign(kind=kind)[["kind", "gram", "n"]]

    return docs.mapInPandas(count, "kind int, gram string, n long").groupBy("kind", "gram").agg(F.sum("n").alias("n"))


def _next(grams: DataFrame, order: int) -> DataFrame:
    """Continuation counts one order down: different grams with that ending."""
    return grams.groupBy(F.substring("gram", 2, order - 1).alias("gram")).agg(F.sum((F.col("n1") > 0).cast("long")).alias("n1"), F.sum((F.col("n0") > 0).cast("long")).alias("n0"))


def model(counts: DataFrame) -> DataFrame:
    """(order, gram, ratio): log P(toxic) - log P(ordinary) of every gram a
    class has, and (minus its order) the same of every context's back-off weight."""
    shared = counts.filter("kind = -1").groupBy(F.expr(f"substring(gram, {TOP - SHARED + 1}, {SHARED})").alias("gram")).agg(F.count("*").alias("n"))
    context = F.substring("gram", 1, SHARED - 1)
    totals = shared.groupBy(context.alias("h")).agg(F.sum("n").alias("t"), F.count("*").alias("kinds"))
    letters = max(1, shared.agg(F.countDistinct(F.substring("gram", SHARED, 1))).first()[0])
    lower = shared.withColumn("h", context).join(totals, "h")
    p = (F.col("n") - DISCOUNT + DISCOUNT * F.col("kinds") / letters) / F.col("t")
    lower = lower.select("gram", p.alias("p1"), p.alias("p0"))
    grams = {TOP: counts.filter("kind >= 0").groupBy("gram").agg(*(F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in (1, 0)))}
    for order in range(TOP - 1, SHARED, -1):
        grams[order] = _next(grams[order + 1], order + 1)
    found = None
    for order in range(SHARED + 1, TOP + 1):
        own = grams[order].withColumn("h", F.substring("gram", 1, order - 1))
        sums = [x for k in (1, 0) for x in (F.sum(f"n{k}").alias(f"t{k}"), F.sum((F.col(f"n{k}") > 0).cast("long")).alias(f"k{k}"))]
        bow = [F.when(F.col(f"t{k}") > 0, DISCOUNT * F.col(f"k{k}") / F.col(f"t{k}")).otherwise(1.0).alias(f"b{k}") for k in (1, 0)]
        contexts = own.groupBy("h").agg(*sums).select("h", "t1", "t0", *bow)
        ending = lower.withColumnRenamed("gram", "s")
        probs = [(F.greatest(F.col(f"n{k}") - DISCOUNT, F.lit(0.0)) / F.greatest(F.col(f"t{k}"), F.lit(1)) + F.col(f"b{k}") * F.col(f"p{k}")).alias(f"q{k}") for k in (1, 0)]
        joined = own.join(contexts, "h").withColumn("s", F.substring("gram", 2, order - 1)).join(ending, "s")
        lower = written(joined.select("gram", *probs).toDF("gram", "p1", "p0"), f"order-{order}")
        rows = lower.select(F.lit(order).alias("order"), "gram", F.log(F.col("p1") / F.col("p0")).alias("ratio"))
        rows = rows.unionByName(contexts.select(F.lit(-order).alias("order"), F.col("h").alias("gram"), F.log(F.col("b1") / F.col("b0")).alias("ratio")))
        found = rows if found is None else found.unionByName(rows)
    return found


def keyed(rows: DataFrame) -> str:
    """A model as numbers alone (order, key of the gram, ratio), written in the
    shared folder in ascending order, from where every executor takes it."""

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for order, own in pdf.groupby("order"):
                n = abs(order) - (order < 0)
                keys = _keys(_codes("".join(own["gram"])), np.arange(1, len(own) + 1) * n - 1, n)
                yield pd.DataFrame({"order": own["order"], "key": keys.view(np.int64), "ratio": own["ratio"].astype(np.float32)})

    path = shared_path(rows.sparkSession, "ratios")
    numbers = rows.mapInPandas(number, "order int, key long, ratio float")
    numbers.repartitionByRange("order", "key").sortWithinPartitions("order", "key").write.parquet(path)
    return uri(path)


def _local(folder: str, root: str) -> str:
    """The model's keys and ratios of each order as plain files in a folder of
    this executor; made by the first of its workers, a row group at a time."""
    own = os.path.join(root, f"ratios-{zlib.crc32(folder.encode())}-{os.path.basename(folder)}")
    os.makedirs(own, exist_ok=True)
    with open(os.path.join(own, "lock"), "w") as lock:
        fcntl.flock(lock, fcntl.LOCK_EX)
        if not os.path.exists(os.path.join(own, "done")):
            for order in _ORDERS:
                for kind in ("keys", "values"):
                    open(os.path.join(own, f"{order}.{kind}"), "wb").close()
            fs, path = file_system(folder)
            files = sorted(f.path for f in fs.get_file_info(pafs.FileSelector(path, allow_not_found=True)) if f.path.endswith(".parquet"))
            for name in files:  # in the order of their ranges
                for batch in pq.ParquetFile(fs.open_input_file(name)).iter_batches(columns=["order", "key", "ratio"]):
                    orders, keys, ratios = (batch.column(k).to_numpy() for k in range(3))
                    for order in np.unique(orders).tolist():
                        for kind, x in (("keys", keys), ("values", ratios)):
                            with open(os.path.join(own, f"{order}.{kind}"), "ab") as out:
                                out.write(x[orders == order].tobytes())
            open(os.path.join(own, "done"), "w").close()
    return own


class Table:
    """Ascending keys and their values, mapped from files: pages in use are
    shared by the workers of a machine and count for none of them."""

    def __init__(self, folder: str, order: int):
        self.keys, self.values = (self._mapped(os.path.join(folder, f"{order}.{kind}"), t) for kind, t in (("keys", np.int64), ("values", np.float32)))

    @staticmethod
    def _mapped(path: str, dtype: type) -> np.ndarray:
        return np.memmap(path, dtype, "r").view(np.ndarray) if os.path.getsize(path) else np.empty(0, dtype)

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values (0 where there is none) and whether there is one."""
        out, found = np.zeros(len(keys), np.float32), np.zeros(len(keys), bool)
        if len(self.keys) and len(keys):
            wanted, back = np.unique(keys.view(np.int64), return_inverse=True)
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            hit = self.keys[at] == wanted
            out, found = np.where(hit, self.values[at], np.float32(0))[back], hit[back]
        return out, found


class Ratios(dict):
    """Word to its log-likelihood ratio; knows the words met so far."""

    _made: dict[str, Ratios] = {}

    def __init__(self, folder: str):
        super().__init__()
        local = _local(folder, SparkFiles.getRootDirectory())
        self.tables = {order: Table(local, order) for order in _ORDERS}

    @classmethod
    def shared(cls, folder: str) -> Ratios:
        """The model of the folder, mapped once by each Python worker."""
        if folder not in cls._made:
            cls._made.clear()
            cls._made[folder] = cls(folder)
        return cls._made[folder]

    def learn(self, words: set[str]) -> None:
        if len(self) + len(words) > KEPT_WORDS:
            self.clear()
        new = [w for w in words if w not in self]
        if not new:
            return
        text, last, which = _windows(new)
        codes, ratio, left = _codes(text), np.zeros(len(last)), np.arange(len(last))
        for order in range(TOP, SHARED, -1):
            if not len(left):
                break
            got, found = self.tables[order].get(_keys(codes, last[left], order))
            ratio[left[found]] += got[found]
            left = left[~found]
            ratio[left] += self.tables[-order].get(_keys(codes, last[left] - 1, order - 1))[0]
        self.update(zip(new, np.bincount(which, weights=ratio, minlength=len(new)).tolist()))

    def features(self, texts: list) -> np.ndarray:
        """Per text: mean ratio over all occurrences of words; and over its
        different words the mean, the three highest, how many exceed each of
        ``ABOVE`` (logarithms), and the logarithm of the number of words, by
        which the curve puts those counts in proportion."""
        out = np.zeros((len(texts), FEATURES))
        out[:, -1] = np.log(FEWEST)
        for at in range(0, len(texts), CHUNK):
            lists = [Counter(words_of(t)) for t in texts[at : at + CHUNK]]
            self.learn(set().union(*lists))
            for row, words in zip(out[at:], lists):
                if words:
                    r = np.fromiter(map(self.__getitem__, words), float, len(words))
                    n = np.fromiter(words.values(), float, len(words))
                    whole, r = r @ n / n.sum(), np.sort(r)[::-1]
                    top = np.zeros(3)
                    top[: len(r)] = r[:3]
                    row[:] = whole, r.mean(), *top, *(np.log1p((r > t).sum()) for t in ABOVE), np.log(max(FEWEST, len(r)))
        return out


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic weights on standardised columns: means, deviations, weights."""
    mean, dev = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = np.column_stack([np.ones(len(x)), (x - mean) / dev])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.eye(len(w)), z.T @ (y - p) - w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return np.concatenate([mean, dev, w])


def probability(x: np.ndarray, fitted: np.ndarray) -> np.ndarray:
    k = x.shape[1]
    z = fitted[2 * k] + ((x - fitted[:k]) / fitted[k : 2 * k]) @ fitted[2 * k + 1 :]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _known(labels: DataFrame, label: str) -> DataFrame:
    """One row per doc_id (label 1 if any says so)."""
    return labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias("cls"))


def _sample(rows: DataFrame, most: int) -> DataFrame:
    """At most about ``most`` of the rows, by hash of the id."""
    n = rows.count()
    return rows if n <= most else rows.filter(F.expr(f"pmod(xxhash64(doc_id), {n}) < {most}"))


def held_out(doc_id: Column, of: int, rest: int) -> Column:
    """Whether crc32 of the id as text leaves ``rest``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % of == rest, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_CURVE) -> tuple[str, np.ndarray]:
    """The folder of the models' ratios and the curve, from ``docs`` (doc_id, text) and
    ``labels`` (doc_id, toxic). Labels of held-out ids (remainder 2) are not
    read; ids with remainder 3 fit the curve (about ``most`` of them), all others
    give class counts."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    known = written(_known(labels.select("doc_id", "toxic").filter(fold != 2), "toxic"), "labels")
    rows = docs.select("doc_id", "text")
    counted = rows.join(known.filter(fold != 3), "doc_id", "left").select("text", F.coalesce("cls", F.lit(-1)).alias("cls"))
    folder = keyed(model(written(gram_counts(counted), "grams")))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = Ratios.shared(folder).features(pdf["text"].tolist())
            yield pd.DataFrame({f"x{i}": x[:, i] for i in range(FEATURES)} | {"y": pdf["cls"].astype(float)})

    schema = ", ".join([*(f"x{i} double" for i in range(FEATURES)), "y double"])
    seen = rows.join(F.broadcast(_sample(known.filter(fold == 3), most)), "doc_id").select("text", "cls").mapInPandas(features, schema).toPandas().to_numpy()
    x, y = seen[:, :FEATURES], seen[:, FEATURES]
    if not 0 < y.sum() < len(y):  # nothing to tell the classes apart
        return folder, np.concatenate([np.zeros(FEATURES), np.ones(FEATURES), [-5.0, 5.0], np.zeros(FEATURES - 1)])
    return folder, _logistic(x, y)


def score(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.3, most: int = MAX_CURVE) -> DataFrame:
    """``docs`` with two more columns at the end, ``_score`` (0 to 1) and ``_toxic`` (0/1),
    or with further underscores if there are columns of these names.

    Null, empty and wordless texts score what no evidence scores; repeated rows
    score alike; labels that are null or not 0/1 and null ids are ignored; with
    labels of one class or none, scores follow the ratio alone (0 where there
    is none). Other columns pass through.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    folder, fitted = fit(rows, labels, most)

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(probability(Ratios.shared(folder).features(texts.tolist()), fitted))

    of.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    name = unused(docs, "_score")
    scored = docs.select("*", F.pandas_udf(of, "double")(F.col(text)).alias(name))
    return scored.select("*", (F.col(name) >= threshold).cast("int").alias(unused(scored, "_toxic")))
