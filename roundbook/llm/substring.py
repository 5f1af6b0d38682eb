"""Substring deduplication by Rabin-Karp hashes of every token window.

Every window of ``WINDOW`` consecutive words has a rolling hash. Spark deals the
hashes of all documents to buckets, where those that start at two or more
places are counted; each part of the corpus gets back the repeated hashes of
its own windows and removes every word such a window covers (repeated windows
that touch or overlap merge into maximal intervals).

A window is known by two independent numbers, 63 bits by which it is dealt and
sorted and 24 more that are compared too: about n^2 / 2^88 unlucky pairs among n
windows, less than one in 100 TB. They travel as sorted arrays cut into byte
planes, one per part and bucket: the upper bytes of sorted numbers hardly change,
so the shuffle's compression takes them away again. A window that repeats within
a part is sent once, so a passage that a third of the corpus shares costs each
bucket one entry per part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix64, read_parquet, shared_path, uri, written
from .packed import pack

WINDOW = 35
#: Bytes of text per bucket, and windows a task holds before it sends them.
BUCKET_BYTES, HELD_WINDOWS = 10_000_000, 2_000_000
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class _Rolling:
    """Polynomial hashes of ranges of words, modulo 2^64: powers of an odd base and of
    its inverse. (The words' own hashes are no polynomials: two texts of 1,024
    characters of two kinds would suffice to make those collide, for any base.)"""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def ranges(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of values[start:end] for each pair; equal ranges, equal hashes."""
        if len(self.up) <= len(values):
            n = 2 * len(values)
            self.up, self.down = (np.full(n + 1, b, np.uint64) for b in (self.base, self.inverse))
            for powers in (self.up, self.down):
                powers[0] = 1
                np.cumprod(powers, out=powers)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * self.up[: len(values)], dtype=np.uint64)])
        return mix64((sums[ends] - sums[starts]) * self.down[starts])


#: Two seeds of word hashes and two bases: the hash that windows are dealt by, and the check.
_SEEDS, _ROLLS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93), (_Rolling(0xC2B2AE3D27D4EB4F), _Rolling(0xA0761D6478BD642F))
_BLOCK = 1 << 20


def words_at(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of every word in UTF-8 bytes."""
    edge = np.diff(np.concatenate([[True], _SPACE[text], [True]]).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def word_hashes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
    """For each seed, 64-bit hashes of the words: up to 16 bytes, of their packing and
    length; longer ones, XXH64."""
    lengths = ends - starts
    short, long = np.flatnonzero(lengths <= 16), np.flatnonzero(lengths > 16).tolist()
    first, second = pack(text, starts[short], lengths[short])
    for seed in _SEEDS:
        out = np.empty(len(starts), np.uint64)
        out[short] = mix64(mix64(mix64(first ^ np.uint64(seed)) + second) ^ lengths[short].astype(np.uint64))
        for k in long:
            out[k] = xxhash.xxh64_intdigest(text[starts[k] : ends[k]], seed)
        yield out


def window_hashes(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Hashes of all windows of ``window`` words, as records of 63 bits (``h``) and 24
    independent ones (``c``); block by block, so the tables of powers stay small."""
    n = max(0, len(starts) - window + 1)
    out = np.empty(n, WINDOW_HASH)
    for at in range(0, n, _BLOCK):
        first = np.arange(min(_BLOCK, n - at))
        s, e = (x[at : at + len(first) + window - 1] for x in (starts, ends))
        text_of, low = text[s[0] : e[-1]], s[0]
        for name, words, roll, shift in zip(("h", "c"), word_hashes(text_of, s - low, e - low), _ROLLS, (1, 40)):
            out[name][at : at + len(first)] = roll.ranges(words, first, first + window) >> np.uint64(shift)
    return out


WINDOW_HASH = np.dtype([("h", np.uint64), ("c", np.uint32)])


def _order(h: np.ndarray) -> np.ndarray:
    """An order that sorts 63-bit numbers: the upper bits are sorted together with the
    place, which is faster than an index sort and nearly always enough."""
    low = np.uint64(max(1, len(h).bit_length()))
    packed = np.sort((h << np.uint64(1) >> low << low) | np.arange(len(h), dtype=np.uint64))
    order = (packed & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    return order if (h[order][1:] >= h[order][:-1]).all() else np.argsort(h)


def different(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different windows, sorted by ``h`` then ``c``, and how often each occurs."""
    windows = windows[_order(windows["h"])]
    same_h = np.flatnonzero(windows["h"][1:] == windows["h"][:-1])
    if (windows["c"][same_h + 1] < windows["c"][same_h]).any():
        windows = windows[np.lexsort((windows["c"], windows["h"]))]
    new = np.ones(len(windows), bool)
    new[1:] = (windows["h"][1:] != windows["h"][:-1]) | (windows["c"][1:] != windows["c"][:-1])
    at = np.flatnonzero(new)
    return windows[at], np.diff(np.append(at, len(windows)))


def planes(windows: np.ndarray) -> bytes:
    """Sorted windows byte by byte, the highest byte of all first: what compresses well
    stands together. Eleven bytes a window: the upper byte of ``c`` is empty."""
    h, c = (windows[name].astype(kind).view(np.uint8).reshape(len(windows), -1).T for name, kind in (("h", ">u8"), ("c", ">u4")))
    return np.ascontiguousarray(np.concatenate([h, c[1:]])).tobytes()


def from_planes(blob: bytes) -> np.ndarray:
    n = len(blob) // 11
    all_ = np.frombuffer(blob, np.uint8).reshape(11, n)
    out = np.empty(n, WINDOW_HASH)
    out["h"] = np.ascontiguousarray(all_[:8].T).view(">u8").reshape(n)
    out["c"] = np.ascontiguousarray(np.concatenate([np.zeros((1, n), np.uint8), all_[8:]]).T).view(">u4").reshape(n)
    return out


class Known:
    """Different windows, sorted, as two plain arrays to search in."""

    def __init__(self, windows: np.ndarray):
        self.h, self.c = np.ascontiguousarray(windows["h"]), np.ascontiguousarray(windows["c"])

    def holds(self, windows: np.ndarray) -> np.ndarray:
        """Which windows are among them."""
        out, h, c = np.zeros(len(windows), bool), np.ascontiguousarray(windows["h"]), windows["c"]
        at, left = np.searchsorted(self.h, h), np.arange(len(windows))
        while len(left):  # one turn, unless known windows share their first number
            left = left[at[left] < len(self.h)]
            left = left[self.h[at[left]] == h[left]]
            hit = self.c[at[left]] == c[left]
            out[left[hit]] = True
            left = left[~hit]
            at[left] += 1
        return out


def covered(repeated: np.ndarray, n_words: int, window: int = WINDOW) -> np.ndarray:
    """Which words a repeated window covers."""
    change = np.zeros(n_words + 1, np.int64)
    at = np.flatnonzero(repeated)
    np.add.at(change, at, 1)
    np.add.at(change, at + window, -1)
    return np.cumsum(change[:-1]) > 0


def kept_text(text: np.ndarray, starts: np.ndarray, ends: np.ndarray, keep: np.ndarray) -> str:
    """The kept words joined by one space."""
    change = np.zeros(len(text) + 2, np.int64)
    change[starts[keep]] += 1
    np.add.at(change, ends[keep] + 1, -1)
    out = np.append(text, np.uint8(0x20))
    out[ends] = 0x20
    return out[np.cumsum(change[: len(out)]) > 0].tobytes()[:-1].decode("utf-8", "surrogatepass")


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def _sent(copy: DataFrame, buckets: int, window: int) -> DataFrame:
    """(bucket, part, hashes): sorted distinct hashes; the lowest bit of each
    (shifted up) says whether it occurred more than once among those sent together."""

    def flush(part: int, held: list[np.ndarray]) -> pd.DataFrame:
        windows, counts = different(np.concatenate(held))
        marked = windows.copy()
        marked["h"] = (windows["h"] << np.uint64(1)) | (counts > 1).astype(np.uint64)
        # Buckets are ranges of the hash, so the sorted array is cut, not sorted again.
        cuts = np.searchsorted(windows["h"], np.array([(k << 63) // buckets for k in range(buckets + 1)], np.uint64))
        cuts[-1] = len(windows)
        full = np.flatnonzero(np.diff(cuts))
        return pd.DataFrame({"bucket": full, "part": part, "hashes": [planes(marked[cuts[k] : cuts[k + 1]]) for k in full]})

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        size, now = 0, None
        for pdf in batches:
            for part, t in zip(pdf["part"].tolist(), pdf["text"].tolist()):
                if held and (part != now or size >= HELD_WINDOWS):
                    yield flush(now, held)
                    held, size = [], 0
                now, text = part, _bytes(t)
                hashes = window_hashes(text, *words_at(text), window)
                if len(hashes):
                    held.append(hashes)
                    size += len(hashes)
        if held:
            yield flush(now, held)

    return copy.select("part", "text").mapInPandas(send, "bucket long, part int, hashes binary")


def _repeated(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one bucket: the windows of each part that start at two places or more."""
    own, twice_here = [], []
    for blob in pdf["hashes"]:
        windows = from_planes(blob)
        twice_here.append((windows["h"] & np.uint64(1)) == 1)
        windows["h"] >>= np.uint64(1)
        own.append(windows)
    all_, counts = different(np.concatenate(own))
    twice, _ = different(np.concatenate([all_[counts > 1], *(w[t] for w, t in zip(own, twice_here))]))
    twice = Known(twice)
    found = [w[twice.holds(w)] for w in own]
    return pd.DataFrame([(p, planes(f)) for p, f in zip(pdf["part"], found) if len(f)], columns=["part", "hashes"])


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row: doc_id, n_words, n_removed and kept (the words that stay, joined
    by one space).

    Null, empty and short texts have no windows and keep their words. Repeated
    rows make each other's windows repeated, as do repeats within one text.
    Null ids are kept, an empty input gives no rows, other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    copy = written(rows.withColumn("part", F.spark_partition_id()), "texts")
    total = copy.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    # A task per bucket: the buckets follow the input, whatever the session's shuffle partitions.
    found = _sent(copy, buckets, window).repartition(buckets, "bucket").groupBy("bucket").applyInPandas(_repeated, "part int, hashes binary")
    answers = shared_path(spark, "repeats")
    found.repartition("part").write.partitionBy("part").parquet(answers)
    folder = uri(answers)

    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, known = None, Known(np.empty(0, WINDOW_HASH))
        for pdf in batches:
            out = []
            for part, t in zip(pdf["part"].tolist(), pdf["text"].tolist()):
                if part != now:
                    now, known = part, Known(_answers(folder, part))
                bytes_ = _bytes(t)
                starts, ends = words_at(bytes_)
                hashes = window_hashes(bytes_, starts, ends, window)
                hit = covered(known.holds(hashes), len(starts), window)
                out.append((len(starts), int(hit.sum()), kept_text(bytes_, starts, ends, ~hit)))
            yield pd.concat([pdf[["doc_id"]].reset_index(drop=True), pd.DataFrame(out, columns=["n_words", "n_removed", "kept"])], axis=1)

    id_type = rows.schema["doc_id"].dataType.simpleString()
    shown = copy.withColumn("doc_id", F.col("doc_id").cast("string"))
    done = shown.mapInPandas(remove, "doc_id string, n_words long, n_removed long, kept string")
    return done.withColumn("doc_id", F.col("doc_id").cast(id_type))


def _answers(folder: str, part: int) -> np.ndarray:
    """The repeated windows of a part, sorted; none where no file was written for it."""
    parts = [from_planes(h.as_py()) for h in read_parquet(f"{folder}/part={part}", ["hashes"])["hashes"]]
    return different(np.concatenate(parts))[0] if parts else np.empty(0, WINDOW_HASH)
