"""Exact word counts of a task, by the packing of :mod:`.packed`."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from .packed import blocks, buckets, radix_order, run_starts

#: Counted words that a task holds before it merges them, and sends them on.
HELD = 600_000
#: Rows of a record batch.
ROWS = 100_000


class Counter:
    """Occurrences of each word in each group, and the number of rows they stand in.

    A group is the tuple of a row's first ``keys`` columns, the text is the next
    column. ``split`` gives the words of a block of texts: its bytes, and start,
    end and text number of every word. ``zero_bytes``: words may hold zero bytes.
    """

    def __init__(self, split: Callable, keys: int, zero_bytes: bool = False, held: int = 0):
        self.split, self.keys, self.zero_bytes, self.most = split, keys, zero_bytes, held or HELD
        self._clear()

    def _clear(self) -> None:
        self.groups: dict[tuple, int] = {}
        self.packed: list[tuple[np.ndarray, ...]] = []
        self.long: dict[tuple[int, bytes], list[int]] = {}
        self.size = 0

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows ``(keys, w0, w1, rest, n, docs)``: a packed word, or the bytes of a long
        one; and a row without a word for each group, counting nothing."""
        for batch in batches:
            self.add(list(zip(*(batch.column(k).to_pylist() for k in range(self.keys)))), batch.column(self.keys))
            if self.size + len(self.long) >= self.most:
                self.merge()
                if self.size + len(self.long) >= self.most // 2:
                    yield from self.take()
        yield from self.take()

    def add(self, keys: list[tuple], texts: pa.Array) -> None:
        """Count the words of some rows."""
        group = np.array([self.groups.setdefault(g, len(self.groups)) for g in keys], np.int64)
        for at, to, data, offsets in blocks(texts):
            low, starts, ends, doc = self.split(data, offsets)
            here, local = np.unique(group[at:to], return_inverse=True)
            for bucket in buckets(low, starts, ends - starts, self.zero_bytes):
                docs = doc[bucket.at]
                group_of = local[docs].astype(np.uint32)
                order = bucket.order(group_of >> np.uint32(16), group_of & np.uint32(0xFFFF))
                self._runs(bucket, order, here[group_of[order]], docs[order])

    def _runs(self, bucket, order: np.ndarray, group: np.ndarray, docs: np.ndarray) -> None:
        """Counts of one sorted bucket: occurrences, and rows, which stand in their
        order within each run since the sort is stable."""
        keys = bucket.keys(order)
        at = run_starts(group, *keys)
        new_row = np.ones(len(docs), np.int64)
        new_row[1:] = docs[1:] != docs[:-1]
        new_row[at] = 1
        n, rows = np.diff(np.append(at, len(docs))), np.add.reduceat(new_row, at)
        if bucket.long is None:
            self.packed.append((group[at].astype(np.uint32), keys[0][at], keys[1][at], n.astype(np.uint32), rows.astype(np.uint32)))
            self.size += len(at)
        else:
            for g, word, a, b in zip(group[at].tolist(), keys[0][at].tolist(), n.tolist(), rows.tolist()):
                have = self.long.setdefault((g, word), [0, 0])
                have[0] += a
                have[1] += b

    def merge(self) -> None:
        """Equal words of what is held become one row each."""
        if not self.packed:
            return
        columns = [np.concatenate(c) for c in zip(*self.packed)]
        self.packed = []
        order = radix_order(columns[:3], [32, 64, 64])
        columns = [c[order] for c in columns]
        at = run_starts(*columns[:3])
        self.packed = [(*(c[at] for c in columns[:3]), *(np.add.reduceat(c, at, dtype=np.int64) for c in columns[3:]))]
        self.size = len(at)

    def take(self) -> Iterator[pa.RecordBatch]:
        """All that is held."""
        self.merge()
        none = np.zeros(len(self.groups), np.int64)
        yield self._rows(np.arange(len(none)), None, None, None, none, none)
        for group, first, second, n, rows in self.packed:
            for k in range(0, len(group), ROWS):
                s = slice(k, k + ROWS)
                yield self._rows(group[s], first[s].view(np.int64), second[s].view(np.int64), None, n[s], rows[s])
        words = sorted(self.long)
        for k in range(0, len(words), ROWS):
            part = words[k : k + ROWS]
            counts = np.array([self.long[w] for w in part], np.int64)
            yield self._rows(np.array([g for g, _ in part]), None, None, [w for _, w in part], counts[:, 0], counts[:, 1])
        self._clear()

    def _rows(self, group, w0, w1, rest, n, rows) -> pa.RecordBatch:
        names, at, size = list(self.groups), pa.array(group, pa.int64()), len(group)
        column = lambda values, kind: pa.nulls(size, kind) if values is None else pa.array(values, kind)
        columns = [pa.array([name[k] for name in names], pa.string()).take(at) for k in range(self.keys)]
        columns += [column(w0, pa.int64()), column(w1, pa.int64()), column(rest, pa.binary()), column(n, pa.int64()), column(rows, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, [*(f"key{k}" for k in range(self.keys)), "w0", "w1", "rest", "n", "docs"])
