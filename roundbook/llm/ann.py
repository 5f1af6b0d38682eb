"""Approximate nearest neighbours with a hierarchical k-means tree.

The tree is fitted on a bounded sample of the vectors (``SAMPLE``); every row
is then indexed under the leaf it descends to. A query visits leaves best-bin
first: a priority queue holds the open branches by the distance to their
centre. How many leaves to visit is calibrated: the true neighbours of a
bounded set of rows are found by brute force over all rows, and visits widen
until the wanted share of them lies in visited leaves.

Leaves are dealt to tiles of bounded size, a leaf that holds a third of all rows to
many. The queries stand once in the shared folder, each with its vector and a bit for
every leaf; the task of a tile reads them in parts of bounded size and compares the
rows of each leaf with the queries that visit it. So neither a task's memory nor what
is shuffled grows with the number of visits, only the comparing does.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .common import parquet_batches, shared_path, uri, written

SAMPLE, BRANCHES, LEAF_ROWS = 20_000, 8, 512
CALIBRATION, RECALL = 200, 0.97
#: Leaves of a query that are searched before the others, for a bound.
FIRST_VISITS = 8
#: Rows of a tile, and queries that it reads at once, at most; fewer where vectors are
#: long (``VALUES`` components of them) or where fewer than ``TILES`` tiles would come out.
TILE_ROWS, TILE_QUERIES, TILES, VALUES = 16_384, 2048, 64, 1 << 20
#: Pairs whose rough distance is held at once, and whose exact one is.
ROUGH, EXACT = 1 << 17, 1 << 18
FOUND = "key long, vec_id long, score double"
#: A query with the leaves it visits first and later, a bit each.
VISITS = "key long, query_id long, n int, q binary, near binary, far binary, more boolean"


class Tree:
    """Centres of all nodes and the children of each; a leaf has none."""

    def __init__(self, x: np.ndarray, rows: int, seed: int = 11):
        """``x``: sampled vectors; ``rows``: how many rows the whole table has."""
        rng, x = np.random.default_rng(seed), np.unique(x, axis=0)
        self.centres: list[np.ndarray] = [x.mean(axis=0) if len(x) else np.zeros(x.shape[1])]
        self.children: list[list[int]] = [[]]
        scale, todo = rows / max(1, len(x)), [(0, x)]
        while todo:
            node, own = todo.pop()
            if len(own) * scale <= LEAF_ROWS or len(own) < 2 * BRANCHES:
                continue
            centres, member = self._means(own, rng)
            if len(centres) < 2:
                continue
            for k, centre in enumerate(centres):
                self.children[node].append(len(self.centres))
                todo.append((len(self.centres), own[member == k]))
                self.centres.append(centre)
                self.children.append([])
        self.centre = np.array(self.centres)
        self.kids = [np.array(c, np.int64) for c in self.children]
        self.leaves = [i for i, c in enumerate(self.children) if not c]
        self.parent = {k: i for i, c in enumerate(self.children) for k in c}
        self.place = {leaf: i for i, leaf in enumerate(self.leaves)}

    @staticmethod
    def _means(x: np.ndarray, rng) -> tuple[np.ndarray, np.ndarray]:
        centres = x[rng.choice(len(x), BRANCHES, replace=False)]
        for _ in range(12):
            member = _squares(x, centres).argmin(axis=1)
            full = np.flatnonzero(np.bincount(member, minlength=len(centres)))
            new = np.array([x[member == k].mean(axis=0) for k in full])
            if new.shape == centres.shape and np.allclose(new, centres):
                break
            centres = new
        return centres, _squares(x, centres).argmin(axis=1)

    def descend(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        at = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, own = todo.pop()
            at[own] = node
            if len(own) and len(self.kids[node]):
                nearest = _squares(x[own], self.centre[self.kids[node]]).argmin(axis=1)
                todo += [(int(k), own[nearest == i]) for i, k in enumerate(self.kids[node])]
        return at

    def best_bins(self, q: np.ndarray) -> Iterator[int]:
        """Leaves in the order a query visits them."""
        yield from self._in_order(_squares(q[None], self.centre)[0].tolist(), [0])

    def _in_order(self, far: list[float], start: list[int]) -> Iterator[int]:
        """Leaves below some nodes, best-bin first, by a query's distances to all centres."""
        queue = [(far[node], node) for node in start]
        heapq.heapify(queue)
        while queue:
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                yield node
            for k in self.children[node]:
                heapq.heappush(queue, (far[k], k))

    def visited(self, q: np.ndarray, visits: int, first: int, rows: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Which leaves (in the order of ``leaves``) each query visits, and which of them are
        its ``first`` ones: the ``visits`` that come first in ``best_bins``, and more until
        they hold more than ``least`` rows.

        A leaf comes before another if the largest distance on its way from the root is the
        smaller one, since its way lies open in the queue until it is visited. Only leaves
        that share this distance need the queue.
        """
        far = _squares(q, self.centre)
        worst = far.copy()
        worst[:, 0] = 0
        for node, kids in enumerate(self.children):
            if kids:  # they were numbered in one go
                part = worst[:, kids[0] : kids[-1] + 1]
                np.maximum(part, worst[:, node, None], out=part)
        worst = worst[:, self.leaves]
        n = min(visits, len(self.leaves))
        last = np.partition(worst, n - 1, axis=1)[:, n - 1, None]
        seen = worst <= last
        for one in np.flatnonzero(seen.sum(axis=1) > n).tolist():
            own, start, most = far[one].tolist(), set(), last[one, 0]
            for at in np.flatnonzero(worst[one] == most).tolist():
                up = [self.leaves[at]]
                while up[-1]:
                    up.append(self.parent[up[-1]])
                start.add([node for node in up if own[node] == most and node or len(up) == 1][-1])
            seen[one] = worst[one] < most
            for leaf in islice(self._in_order(own, sorted(start)), n - int(seen[one].sum())):
                seen[one, self.place[leaf]] = True
        for one in np.flatnonzero(seen @ rows <= least).tolist():
            seen[one], had = False, 0
            for at, leaf in enumerate(self._in_order(far[one].tolist(), [0])):
                if at >= n and had > least:
                    break
                seen[one, self.place[leaf]] = True
                had += int(rows[self.place[leaf]])
        early = seen.copy()
        if first < len(self.leaves):
            early[:] = False
            np.put_along_axis(early, np.argpartition(np.where(seen, worst, np.inf), first - 1, axis=1)[:, :first], True, axis=1)
        return seen, early & seen


class Forest:
    """A tree for each length of vectors; leaves are numbered through."""

    def __init__(self, sample: list[np.ndarray], rows: dict[int, int]):
        """``sample``: vectors; ``rows``: how many rows the table has of each length."""
        own: dict[int, list[np.ndarray]] = {n: [] for n in rows}
        for v in sample:
            own[len(v)].append(v)
        self.trees, self.first, at = {}, {}, 0
        for n in sorted(rows):
            self.trees[n] = Tree(np.array(own[n]).reshape(-1, n), rows[n])
            self.first[n] = at
            at += len(self.trees[n].centres)

    def descend(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector; all are of one length."""
        return self.first[x.shape[1]] + self.trees[x.shape[1]].descend(x)

    def best_bins(self, q: np.ndarray) -> Iterator[int]:
        """Leaves of the query's length in the order it visits them; none where no row has it."""
        if len(q) in self.trees:
            for node in self.trees[len(q)].best_bins(q):
                yield self.first[len(q)] + node


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(axis=1)[:, None] - 2 * x @ y.T + (y**2).sum(axis=1), 0)


def _vectors(column: pd.Series) -> list[np.ndarray]:
    return [np.asarray(v, np.float64) for v in column]


def _by_length(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each length of the vectors in a column without nulls, where they stand, and their matrix."""
    values, sizes = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)
    start = np.cumsum(sizes) - sizes
    for n in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == n)
        x = values.reshape(-1, n) if len(at) == len(sizes) else values[start[at][:, None] + np.arange(n)]
        yield n, at, x.astype(np.float64)


def _sides(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors with their squares and ones beside them, as queries and as rows: the product of
    the two has the squares of the distances."""
    with np.errstate(over="ignore", invalid="ignore"):
        squares, one = (v**2).sum(axis=1)[:, None], np.ones((len(v), 1))
        return np.hstack([-2 * v, one, squares]), np.hstack([v, squares, one])


def _near(q: np.ndarray, x: np.ndarray, most: int, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) of two sides where the row may be among the query's ``most`` nearest
    and within its bound: by a product of matrices, with room for all of its rounding, so
    that none is missed."""
    squares, largest = q[:, -1], max(q[:, -1].max(), x[:, -2].max())
    if not 1e-200 < largest < 1e200:  # squares and their sums may over- or underflow
        return np.divmod(np.arange(len(q) * len(x)), len(x))
    rough = q @ x.T
    room = 8 * (q.shape[1] + 2) * np.finfo(np.float64).eps * (squares + x[:, -2].max())
    limit = bound**2 * (1 + 1e-12) + room
    may = rough <= limit[:, None]
    found = np.flatnonzero(may)
    if len(x) > most and len(found) > 2 * most:
        many = np.flatnonzero(np.count_nonzero(may, axis=1) > 2 * most)
        if len(many):
            part = rough[many]
            may[many] &= part <= (np.partition(part, most - 1, axis=1)[:, most - 1] + 2 * room[many])[:, None]
            found = np.flatnonzero(may)
    return np.divmod(found, len(x))


def _beyond(q: np.ndarray, balls: list[tuple[np.ndarray, float]], bound: np.ndarray) -> np.ndarray:
    """Whether all that is in a ball (centre, radius) lies beyond a query's bound; with room
    for rounding, and never where squares overflow."""
    x, radius = _sides(np.array([c for c, _ in balls]))[1], np.array([r for _, r in balls])
    with np.errstate(over="ignore", invalid="ignore"):
        room = 8 * (q.shape[1] + 2) * np.finfo(np.float64).eps * (q[:, -1, None] + x[:, -2])
        return np.sqrt(np.maximum(q @ x.T - room, 0)) > (bound[:, None] + radius) * (1 + 1e-9)


def _ball(x: np.ndarray) -> tuple[np.ndarray, float]:
    """The mean of some vectors and their largest distance from it."""
    with np.errstate(over="ignore", invalid="ignore"):
        centre = x.mean(axis=0)
        return centre, float(np.sqrt(((x - centre) ** 2).sum(axis=1).max()))


def _nearest(one: np.ndarray, row: np.ndarray, q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of some pairs the ``k`` nearest of each query but its own, with their exact distances."""
    d = np.empty(len(one))
    some = max(1, 2 * VALUES // max(1, x.shape[1]))
    with np.errstate(over="ignore"):
        for i in range(0, len(one), some):
            d[i : i + some] = np.sqrt(((q[one[i : i + some]] - x[row[i : i + some]]) ** 2).sum(axis=1))
    left = np.flatnonzero(np.isfinite(d) & ~((ids[row] == q_ids[one]) & (d == 0)))
    left = left[np.lexsort((ids[row[left]], d[left], one[left]))]
    count = np.bincount(one[left], minlength=len(q))
    rank = np.arange(len(left)) - (np.cumsum(count) - count)[one[left]]
    left = left[rank < k]
    return one[left], row[left], d[left]


def _most(ids: np.ndarray, k: int) -> int:
    """How many rows hold the ``k`` nearest but the query's own: these are as near as can be."""
    return k + (int(np.unique(ids, return_counts=True)[1].max()) if len(ids) else 0)


def nearest(keys: np.ndarray, q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int, bound: np.ndarray | None = None) -> pd.DataFrame:
    """Each query's ``k`` nearest rows but its own (its id and its vector), by exact
    distance, then id; ``keys`` tell queries apart. Rows beyond a query's ``bound`` may
    be left out. Distances are computed exactly where a row may be among them."""
    out = []
    bound = np.full(len(q), np.inf) if bound is None else bound
    most, left, right = _most(ids, k), _sides(q)[0], _sides(x)[1]
    step = max(1, 4 * ROUGH // max(1, len(x)))
    for at in range(0, len(q) if len(x) else 0, step):
        one, row = _near(left[at : at + step], right, most, bound[at : at + step])
        one, row, d = _nearest(one + at, row, q_ids, q, ids, x, k)
        out.append(pd.DataFrame({"key": keys[one], "vec_id": ids[row], "score": d, "at": row}))
    return pd.concat(out) if out else pd.DataFrame({"key": [], "vec_id": [], "score": [], "at": []})


def usable(rows: DataFrame) -> DataFrame:
    """Rows (vec_id, v) whose vector is neither null nor zero and has only finite
    components; rows that repeat both id and vector are one."""
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    good = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda c: c != 0))
    return good.dropDuplicates(["vec_id", "v"])


def _top(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("key").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _sampled(rows: DataFrame, n: int, most: int, salt: int) -> pd.DataFrame:
    """About ``most`` rows at most, by hash; brought to the driver."""
    part = rows if n <= most else rows.filter(F.expr(f"pmod(xxhash64(vec_id, {salt}), {n}) < {most}"))
    return part.orderBy("vec_id").limit(2 * most).toPandas()


def _visits(indexed: DataFrame, forest: Forest, picked: pd.DataFrame, k: int) -> int:
    """Leaves to visit so that the wanted share of true neighbours is found."""
    ids, vectors = picked["vec_id"].to_numpy(np.int64), _vectors(picked["v"])
    lengths = np.array([len(v) for v in vectors])

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, own = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("leaf", "vec_id"))
            for n, at, x in _by_length(batch.column("v")):
                keys = np.flatnonzero(lengths == n)
                if len(keys):
                    got = nearest(keys, ids[keys], np.array([vectors[i] for i in keys]), own[at], x, k)
                    found = [np.asarray(got[c], kind) for c, kind in (("key", np.int64), ("vec_id", np.int64), ("score", np.float64), ("at", np.int64))]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*found[:3], leaf[at][found[3]])], names=["key", "vec_id", "score", "leaf"])

    true = _top(indexed.mapInArrow(brute, FOUND + ", leaf long"), k).select("key", "leaf").toPandas()
    wanted = dict(tuple(true.groupby("key")["leaf"]))
    ranks = []
    for one, vector in enumerate(vectors):
        order = {leaf: i for i, leaf in enumerate(forest.best_bins(vector))}
        ranks += [order[leaf] + 1 for leaf in wanted.get(one, [])]
    ranks.sort()
    return ranks[min(len(ranks) - 1, int(np.ceil(RECALL * len(ranks))))] if ranks else 1


def search(vectors: DataFrame, queries: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each
    row of ``queries`` (same columns), its own id left out.

    Null, zero and non-finite vectors take no part on either side. Every row is a
    candidate: vectors of another length than the query's have no distance from
    it, so each length is searched by itself; rows that share an id but not the
    vector count each, as candidates and as queries (two such queries both have
    ranks from 1); rows that repeat both count once. Fewer candidates than ``k``
    are all returned; ties go to the smaller id; equal vectors share a leaf. No
    rows or no queries give no rows; other columns are not read.
    """
    spark = vectors.sparkSession

    def named(df: DataFrame) -> DataFrame:
        kind = df.select(F.col(vector)).schema[0].dataType  # floats are kept as such: half the bytes, the same numbers
        single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
        return usable(df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<float>" if single else "array<double>").alias("v")))

    rows = written(named(vectors), "vectors")
    lengths = {r["n"]: r["count"] for r in rows.groupBy(F.size("v").alias("n")).count().collect()}
    n = sum(lengths.values())
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    forest = Forest(_vectors(_sampled(rows, n, SAMPLE, 1)["v"]), lengths)
    sent = spark.sparkContext.broadcast(forest)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = np.empty(batch.num_rows, np.int64)
            for _, at, x in _by_length(batch.column("v")):
                leaf[at] = sent.value.descend(x)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(leaf)], names=["vec_id", "v", "leaf"])

    indexed = written(rows.mapInArrow(index, rows.schema.simpleString()[7:-1].replace(":", " ") + ", leaf long"), "leaves")
    sizes = {r["leaf"]: r["count"] for r in indexed.groupBy("leaf").count().collect()}  # one per leaf: bounded by the sample
    held = {m: np.array([sizes.get(forest.first[m] + leaf, 0) for leaf in tree.leaves]) for m, tree in forest.trees.items()}
    visits = _visits(indexed, forest, _sampled(rows, n, CALIBRATION, 2), k)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = lambda bits: [b.tobytes() for b in np.packbits(bits, axis=1)]
        for batch in batches:
            for m, at, q in _by_length(batch.column("q")):
                tree = sent.value.trees[m]
                step = max(1, VALUES // len(tree.centres))
                for i in range(0, len(at), step):
                    some, part = at[i : i + step], q[i : i + step]
                    seen, early = tree.visited(part, visits, FIRST_VISITS, held[m], k)
                    late = seen & ~early
                    own = [batch.column(c).take(pa.array(some)) for c in ("key", "query_id")]
                    told = [pa.array(b, pa.binary()) for b in ([v.tobytes() for v in part], packed(early), packed(late))]
                    yield pa.RecordBatch.from_arrays([*own, pa.array(np.full(len(some), m, np.int32)), *told, pa.array(late.any(axis=1))], names=["key", "query_id", "n", "q", "near", "far", "more"])

    # Neighbouring leaves share a tile; one too large for a tile has several.
    shape, tiles = [], 0
    for m, tree in forest.trees.items():
        most, full = max(1, min(TILE_ROWS, VALUES // m, max(2048, -(-n // TILES)))), 0
        for leaf in tree.leaves:
            rows_in = sizes.get(forest.first[m] + leaf, 0)
            if full and full + rows_in > most:
                tiles, full = tiles + 1, 0
            shape.append((forest.first[m] + leaf, tiles, -(-rows_in // most) or 1))
            full += rows_in
            if full >= most:
                tiles, full = tiles + -(-full // most), 0
        tiles += 1
    shape = F.broadcast(spark.createDataFrame(shape, "leaf long, tile int, parts int"))  # one row per leaf
    tiled = indexed.join(shape, "leaf").select(F.expr("tile + int(pmod(xxhash64(vec_id, v), parts))").alias("tile"), "leaf", "vec_id", "v")
    at_once = max(1, min(TILE_QUERIES, VALUES // max(lengths)))

    def met(asked: str, leaves: str) -> DataFrame:
        """Each query's nearest rows in each tile among the leaves it visits, as far as its bound;
        ``asked``: folder of the queries, ``leaves``: their column of bits."""
        columns = ["key", "query_id", "n", "q", leaves] + ["bound"] * (leaves == "far")

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tile = pa.Table.from_batches(list(batches)).combine_chunks()
            ids, leaf = (tile.column(c).to_numpy() for c in ("vec_id", "leaf"))
            m, _, x = next(_by_length(tile.column("v").combine_chunks()))  # a tile has leaves of one tree
            order = np.argsort(leaf, kind="stable")
            ids, leaf, x = ids[order], leaf[order], x[order]
            right, most = _sides(x)[1], _most(ids, k)
            cuts = [*np.flatnonzero(np.diff(leaf, prepend=-1)).tolist(), len(leaf)]
            balls = [_ball(x[i:j]) for i, j in zip(cuts, cuts[1:])]
            places = [sent.value.trees[m].place[int(leaf[c]) - sent.value.first[m]] for c in cuts[:-1]]
            for part in parquet_batches(asked, columns, at_once):
                part = part.filter(pa.compute.equal(part.column("n"), m))
                if not part.num_rows:
                    continue
                keys, q_ids = (part.column(c).to_numpy() for c in ("key", "query_id"))
                bits, q = (np.frombuffer(b"".join(part.column(c).to_pylist()), kind).reshape(len(keys), -1) for c, kind in ((leaves, np.uint8), ("q", np.float64)))
                bound = part.column("bound").to_numpy() if leaves == "far" else np.full(len(keys), np.inf)
                left, pairs, many = _sides(q)[0], [], 0
                beyond = _beyond(left, balls, bound)
                for i, place in enumerate(places):
                    asks = np.flatnonzero((bits[:, place >> 3] & (128 >> (place & 7)) != 0) & ~beyond[:, i])
                    here = right[cuts[i] : cuts[i + 1]]
                    step = max(1, ROUGH // len(here))
                    for j in range(0, len(asks), step):
                        some = asks[j : j + step]
                        one, row = _near(left[some], here, most, bound[some])
                        pairs.append((some[one], row + cuts[i]))
                        many += len(one)
                        if many >= EXACT:
                            yield found(pairs, keys, q_ids, q, ids, x, bound)
                            pairs, many = [], 0
                if many:
                    yield found(pairs, keys, q_ids, q, ids, x, bound)

        def found(pairs: list, keys, q_ids, q, ids, x, bound) -> pa.RecordBatch:
            one, row, d = _nearest(*(np.concatenate(p) for p in zip(*pairs)), q_ids, q, ids, x, k)
            near = d <= bound[one]
            return pa.RecordBatch.from_arrays([pa.array(keys[one[near]]), pa.array(ids[row[near]]), pa.array(d[near])], names=["key", "vec_id", "score"])

        return tiled.repartitionById(tiles, "tile").groupBy("tile").applyInArrow(meet, FOUND)  # a task per tile

    def put(df: DataFrame, name: str) -> str:
        path = shared_path(spark, name)
        df.write.option("compression", "zstd").parquet(path)
        return path

    own = named(queries).filter(F.size("v").isin(list(lengths))).repartition(spark.sparkContext.defaultParallelism)
    own = own.select(F.monotonically_increasing_id().alias("key"), F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    # Written once, so that a query's key is the same wherever it is read again.
    path = put(own.mapInArrow(visit, VISITS), "visits")
    asked = spark.read.schema(VISITS).parquet(path)
    # The first leaves bound each query's k-th distance; the others then give
    # back only rows within it.
    near = written(met(uri(path), "near"), "near")
    later = asked.filter("more")
    if not later.isEmpty():
        bounds = _top(near, k).filter(F.col("rank") == k).select("key", F.col("score").alias("bound"))
        later = later.join(bounds, "key", "left").select("key", "query_id", "n", "q", "far", F.coalesce("bound", F.lit(float("inf"))).alias("bound"))
        near = near.unionByName(met(uri(put(later, "later")), "far"))
    return _top(near, k).join(asked.select("key", "query_id"), "key").select("query_id", "rank", "vec_id", "score")
