"""SimHash near-duplicates by tiled exact comparison.

Distinct fingerprints are sorted into classes by the population counts of
their ``parts`` equal parts and cut into tiles of a bounded size. Two
fingerprints within ``radius`` bits differ by at most ``radius`` in the sum of
their parts' population counts, so only tiles of classes that close are
compared: numpy exclusive-or and bit counts over the whole tile pair. A tile
pair gives back a spanning forest of its links (never all pairs), and the
forests are joined to connected components. All links are found; the work is
quadratic in the number of distinct fingerprints, divided by what the classes
skip, so ``parts`` follows that number.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns, unused, written
from .components import components

SHINGLE, RADIUS, SEED = 4, 4, 42
#: Fingerprints in a tile, on average at most.
TILE = 2048
#: Fingerprints a class should hold on average before classes are made finer.
PER_CLASS = 1000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash: A-Z lower-cased, words between ASCII white space, each
    shingle hashed by XXH64 (repeats count); a bit is set where over half the
    hashes have it. No words: 0. Fewer words than a shingle: one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[-n:].tolist())), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) for every row; fp is the fingerprint's bits as a long."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            fp = np.fromiter((fingerprint(t, shingle) for t in pdf["t"]), np.uint64, len(pdf))
            yield pd.DataFrame({"d": pdf["d"], "fp": fp.view(np.int64)})

    rows = docs.select(F.col(doc_id).cast("string").alias("d"), F.col(text).alias("t")).mapInPandas(make, "d string, fp long")
    return rows.select(F.col("d").cast("long").alias("doc_id"), "fp")


def _class_of(fp, parts: int):
    """The parts' population counts as the base-128 digits of a long."""
    bits = 64 // parts
    digits = [F.bit_count(F.shiftrightunsigned(fp, bits * i).bitwiseAND(F.lit((1 << bits) - 1) if bits < 64 else F.lit(-1))) * F.lit(128**i).cast("long") for i in range(parts)]
    return sum(digits[1:], digits[0]).cast("long")


def _offsets(parts: int, radius: int) -> list[int]:
    """Class differences within the radius, one of each pair of opposites."""
    near = [()]
    for _ in range(parts):
        near = [(*v, d) for v, d in product(near, range(-radius, radius + 1)) if sum(map(abs, v)) + abs(d) <= radius]
    return sorted({sum(d * 128**i for i, d in enumerate(v)) for v in near if v >= (0,) * parts})


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node reachable from each of ``n`` nodes over the edges (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def linked(left: np.ndarray, right: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its group) over all links of a tile pair; a
    forest over left followed by right."""
    nodes = left if same else np.concatenate([left, right])
    shift, label = 0 if same else len(left), None
    a, b = np.empty(0, np.int64), np.empty(0, np.int64)
    for at in range(0, len(left), 256):
        i, j = np.nonzero(np.bitwise_count(left[at : at + 256, None] ^ right[None, :]) <= radius)
        if same:
            i, j = i[i + at < j], j[i + at < j]
        if len(i):
            a, b = np.concatenate([a, i + at]), np.concatenate([b, j + shift])
            if len(a) > 4 * len(nodes):
                label = _forest(len(nodes), a, b)
                a, b = np.arange(len(nodes)), label
    if not len(a):
        return nodes[:0], nodes[:0]
    label = _forest(len(nodes), a, b)
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def links(fps: DataFrame, radius: int = RADIUS, parts: int | None = None, tile: int = TILE) -> DataFrame:
    """Edges (u, v) that connect exactly the fingerprints linked within the
    radius, directly or in steps. ``fps``: distinct longs in column fp.

    Pairs of tiles are listed from the classes' counts (an equality join on the
    class number), then meet their fingerprints by two joins on the tile.
    """
    if parts is None:
        n, parts = fps.count(), 1
        while parts < 8 and n > PER_CLASS * (2.5 * (32 / parts) ** 0.5) ** (2 * parts):
            parts *= 2
    classed = fps.select("fp", _class_of(F.col("fp"), parts).alias("c"))
    counts = written(classed.groupBy("c").agg(F.ceil(F.count("*") / tile).cast("int").alias("n")), "classes")
    tiles = classed.join(counts, "c").withColumn("s", F.expr("int(pmod(xxhash64(fp), n))")).groupBy("c", "s").agg(F.collect_list("fp").alias("t"))
    tiles = written(tiles, "tiles")
    near = counts.withColumn("o", F.explode(F.array(*map(F.lit, _offsets(parts, radius))))).select("c", "n", (F.col("c") + F.col("o").cast("long")).alias("c2"))
    pairs = near.join(counts.select(F.col("c").alias("c2"), F.col("n").alias("n2")), "c2")
    pairs = pairs.withColumn("s", F.explode(F.expr("sequence(0, n - 1)"))).withColumn("s2", F.explode(F.expr("sequence(0, n2 - 1)"))).filter("c <> c2 OR s <= s2")
    pairs = pairs.select("c", "s", "c2", "s2").join(tiles, ["c", "s"])
    pairs = pairs.join(tiles.select(F.col("c").alias("c2"), F.col("s").alias("s2"), F.col("t").alias("t2")), ["c2", "s2"])

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [linked(np.asarray(l, np.int64).view(np.uint64), np.asarray(r, np.int64).view(np.uint64), radius, same) for l, r, same in pdf.itertuples(index=False)]
            yield pd.DataFrame({k: np.concatenate([o[i] for o in out]).view(np.int64) for i, k in enumerate("uv")})

    return pairs.select("t", "t2", F.expr("c = c2 AND s = s2")).mapInPandas(compare, "u long, v long")


def _component_ids(rows: DataFrame, radius: int) -> DataFrame:
    """(fp, component_id) of every distinct fingerprint in ``rows`` (doc_id, fp)."""
    least = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(least.select("fp"), radius))
    named = least.join(roots, F.col("fp") == F.col("u"), "left").select("fp", "least", F.coalesce("v", "fp").alias("root"))
    named = written(named, "roots")
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return named.join(ids, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) for every row: the smallest doc_id reachable
    over links of at most ``radius`` differing bits, its own included.

    Null and empty texts have fingerprint 0 and are linked like any other.
    Repeated rows share a fingerprint; equal texts are collapsed before any
    comparison. Rows with a null doc_id keep it, and their component's id is
    null only if all its ids are. No rows give no rows; further columns are
    not read.
    """
    rows = written(fingerprints(docs, doc_id=doc_id, text=text, shingle=shingle), "fingerprints")
    return rows.join(_component_ids(rows, radius), "fp").select("doc_id", "fp", "component_id")


def representatives(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id's (a null
    id only where the component has no other), and of rows that repeat the id
    the one with the smallest text hash and place. Columns stay as they are."""

    def make(texts: pd.Series) -> pd.Series:
        return pd.Series(np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts)).view(np.int64))

    # Written once, so that a row's number is the same wherever it is read.
    fp, row = unused(docs, "_fp"), unused(docs, "_row")
    rows = written(docs.select("*", F.pandas_udf(make, "long")(F.col(text)).alias(fp), F.monotonically_increasing_id().alias(row)), "fingerprinted")
    keys = rows.select(F.col(fp).alias("fp"), F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"), F.col(row).alias("row"))
    named = keys.join(_component_ids(keys.select("doc_id", "fp"), radius), "fp")
    # Components without any id are told apart by their fingerprints' smallest row.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash", "row")).alias("first")
    with_id = named.filter("component_id IS NOT NULL").groupBy("component_id").agg(first)
    without = named.filter("component_id IS NULL").groupBy("fp").agg(first)
    kept = with_id.select("first.row").unionByName(without.select("first.row")).select(F.col("row").alias(row))
    return rows.join(kept, row, "left_semi").select(*columns(docs))
