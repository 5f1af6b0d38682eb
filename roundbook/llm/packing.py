"""Best-fit packing by large-item matching.

Documents are cut only where they exceed the capacity; pieces are then packed
into sequences ("bins") in three steps, all on the histogram of piece lengths
(pieces of equal length are interchangeable, and there are at most ``capacity``
lengths, whatever the number of documents):

1. pieces above half the capacity open a bin each, the longest first;
2. pieces above a third (so at most two of them share a bin) are matched
   greedily: each open bin, from the fullest, takes the largest that fits;
   what is left of them is paired among itself, the largest with the largest
   partner that fits;
3. smaller pieces, the longest first, go to the open bin with the smallest gap
   that holds them (best fit); a new bin opens only where no gap does.

The plan says how many bins of each composition there are. Each piece finds
its place from its rank among the pieces of its length: a count per partition
and length, added up over partitions, plus its position in its own partition.
No row of pieces leaves the cluster, and no group of them meets in one task.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import read_parquet, shared_path, unused, uri, written
from .encoding import Encoder

CAPACITY = 2048
PIECES = "doc_id long, piece int, start long, length long, ids binary, part int, nth long"


def encode_pieces(docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """Ids of every whole text (null: empty) plus an end id, cut at ``capacity``.

    One row per piece: doc_id, piece (from 0), start (the document's ids before
    it), length, ids (little-endian unsigned 32-bit), and what ranks it: part
    (the writing task) and nth (its position among that task's pieces of equal
    length). Written once in the shared folder. Repeated rows give pieces of
    their own; an empty input gives no rows; other columns are ignored.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, part, seen = Encoder.shared(tokenizer), TaskContext.get().partitionId(), defaultdict(int)
        for pdf in batches:
            rows = []
            for d, t in zip(pdf["d"].tolist(), pdf["t"].tolist()):
                ids = np.append(encode(t or ""), np.uint32(end_id)).astype("<u4")
                for k, at in enumerate(range(0, len(ids), capacity)):
                    own = ids[at : at + capacity]
                    rows.append((d, k, at, len(own), own.tobytes(), part, seen[len(own)]))
                    seen[len(own)] += 1
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids", "part", "nth"])
            out["doc_id"] = pd.array([None if d is None else int(d) for d in out["doc_id"]], "Int64")
            yield out

    rows = docs.select(F.col(doc_id).cast("long").cast("string").alias("d"), F.col(text).alias("t"))
    return written(rows.mapInPandas(cut, PIECES), "pieces")


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """(how many bins, lengths in each) for so many pieces of each length.

    Works on groups of equal bins, so its cost follows the number of different
    lengths and compositions, not the number of pieces.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    if any(not 0 < n <= capacity for n in left):
        raise ValueError("a length outside 1 to the capacity")
    open_bins: dict[int, list[list]] = defaultdict(list)  # gap: groups [count, lengths]
    gaps: list[int] = []  # the gaps that occur, ascending

    def put(count: int, lengths: tuple[int, ...]) -> None:
        gap = capacity - sum(lengths)
        if not open_bins[gap]:
            insort(gaps, gap)
        open_bins[gap].append([count, lengths])

    def take(gap: int, at_most: int) -> tuple[int, tuple[int, ...]]:
        group = open_bins[gap][-1]
        n = min(at_most, group[0])
        group[0] -= n
        if not group[0]:
            open_bins[gap].pop()
            if not open_bins[gap]:
                gaps.remove(gap)
        return n, group[1]

    third = [n for n in sorted(left, reverse=True) if 2 * n <= capacity < 3 * n]
    for n in sorted((n for n in left if 2 * n > capacity), reverse=True):
        put(left.pop(n), (n,))
    # Step 2: bins from the fullest that can take any of the middle pieces.
    for gap in [g for g in gaps if third and g >= third[-1]]:
        for n in third:
            while n <= gap and left.get(n, 0) and open_bins[gap] and len(open_bins[gap][0][1]) == 1:
                count, lengths = open_bins[gap][0]
                used = min(count, left[n])
                left[n] -= used
                open_bins[gap][0][0] -= used
                if not open_bins[gap][0][0]:
                    open_bins[gap].pop(0)
                    if not open_bins[gap]:
                        gaps.remove(gap)
                put(used, (*lengths, n))
    for i, n in enumerate(third):
        if left.get(n, 0) >= 2:
            put(left[n] // 2, (n, n))
            left[n] %= 2
        if left.get(n, 0):
            partner = next((m for m in third[i + 1 :] if left.get(m, 0)), None)
            left[n] = 0
            if partner is None:
                put(1, (n,))
            else:
                left[partner] -= 1
                put(1, (n, partner))
    # Step 3: the longest first, each to the smallest gap that holds it.
    for n in sorted((n for n, c in left.items() if c), reverse=True):
        rest = left[n]
        while rest:
            at = bisect_left(gaps, n)
            if at == len(gaps):
                per = capacity // n
                whole, over = divmod(rest, per)
                if whole:
                    put(whole, (n,) * per)
                if over:
                    put(1, (n,) * over)
                break
            used, lengths = take(gaps[at], rest)
            put(used, (*lengths, n))
            rest -= used
    merged: dict[tuple[int, ...], int] = defaultdict(int)
    for groups in open_bins.values():
        for count, lengths in groups:
            merged[lengths] += count
    return [(c, lengths) for lengths, c in sorted(merged.items(), reverse=True)]


def _slots(plan: list[tuple[int, tuple[int, ...]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first ranks of its runs, their first sequence, places in each bin, offset of the first place.

    Of a composition with ``m`` places for a length in each of ``c`` bins, rank
    ``r`` of the run takes place ``r % m`` of bin ``r // m``.
    """
    runs: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    rank: dict[int, int] = defaultdict(int)
    sequence = 0
    for count, lengths in plan:
        offset, at = 0, 0
        while at < len(lengths):
            n = lengths[at]
            m = 1
            while at + m < len(lengths) and lengths[at + m] == n:
                m += 1
            runs[n].append((rank[n], sequence, m, offset))
            rank[n] += count * m
            offset += m * n
            at += m
        sequence += count
    return {n: tuple(np.array(c, np.int64) for c in zip(*r)) for n, r in runs.items()}


def pack(pieces: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (of :func:`encode_pieces`, further columns kept) with
    sequence_id and offset (columns of these names are replaced).

    Equal numbers of pieces of a length in each part are counted and added up
    over parts; the driver gets at most ``capacity`` totals. A task reads the
    counts before its own part from the shared folder, so no piece is shuffled.
    """
    spark = pieces.sparkSession
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = written(counts, "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.sparkContext.broadcast(_slots(plan_bins(histogram, capacity)))
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    firsts = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    here = shared_path(spark, "piece-ranks")
    firsts.repartition("part").write.partitionBy("part").parquet(here)
    folder = uri(here)

    def place(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        now, ranks = None, np.zeros(0, np.int64)
        for lengths, parts, nths in batches:
            n, part, r = lengths.to_numpy(), parts.to_numpy(), nths.to_numpy().copy()
            for one in np.unique(part).tolist():
                if one != now:
                    now, ranks = one, _ranks(f"{folder}/part={one}", capacity)
                r[part == one] += ranks[n[part == one]]
            sequence, offset = np.empty(len(n), np.int64), np.empty(len(n), np.int64)
            for one in np.unique(n):
                at = np.flatnonzero(n == one)
                first, seq, m, off = slots.value[int(one)]
                run = np.searchsorted(first, r[at], "right") - 1
                own = r[at] - first[run]
                sequence[at] = seq[run] + own // m[run]
                offset[at] = off[run] + own % m[run] * one
            yield pd.DataFrame({"sequence_id": sequence, "offset": offset})

    place.__annotations__ = {"batches": Iterator[tuple[pd.Series, ...]], "return": Iterator[pd.DataFrame]}
    placed, name = F.pandas_udf(place, "sequence_id long, offset long"), unused(pieces, "_place")
    ranked = pieces.select("*", placed("length", "part", "nth").alias(name))
    keep = [c for c in ranked.columns if c.lower() not in ("part", "nth", "sequence_id", "offset", name)]
    return ranked.select(*[F.col("`" + c.replace("`", "``") + "`") for c in keep], f"{name}.sequence_id", f"{name}.offset")


def _ranks(folder: str, capacity: int) -> np.ndarray:
    """For each length, how many pieces of it the parts before this one have."""
    rows = read_parquet(folder, ["length", "first"])
    out = np.zeros(capacity + 1, np.int64)
    out[rows["length"].to_numpy()] = rows["first"].to_numpy()
    return out


def packed_sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves: sequence_id, n_tokens, ids (concatenated in
    offset order), doc_ids. At most ``capacity`` pieces meet in a group."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("p")).select(
        "sequence_id", "n_tokens", F.expr("aggregate(p, X'', (a, x) -> concat(a, x.ids))").alias("ids"), F.col("p.doc_id").alias("doc_ids")
    )
