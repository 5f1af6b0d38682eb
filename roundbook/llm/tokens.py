"""Token-ID output: Arrow IPC files of fixed-size-list batches.

Documents are encoded in ascending document order, an end id closes each, and
the ids run on from document to document, cut into sequences of equal length.
A shard (one range of documents) is a pair of Arrow IPC files:

* ``tokens-*.arrow``: ``input_ids`` FixedSizeList<uint16|uint32>[L] and
  ``mask`` FixedSizeList<uint8>[L / 8, rounded up]: a bit per id, lowest first, 0 on
  the padding after the shard's last id. Each sequence's bits begin at a byte of
  their own and nothing is compressed, so a memory map gives ids and mask of
  sequence ``i`` as views, without a copy.
* ``docs-*.arrow``: ``doc_id``, ``start`` (in the shard) and ``n_tokens``.

The manifest (Parquet, written by Spark's committer) names the files of the
successful task attempts; files of attempts that failed are never read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import file_system, shared_path, uri
from .encoding import Encoder, id_type

SEQUENCE_LENGTH = 2048
BATCH_SEQUENCES = 64
MANIFEST = "part int, tokens_uri string, docs_uri string, n_docs long, n_tokens long"
DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class ShardWriter:
    """Writes one shard; holds at most one batch of sequences in memory."""

    def __init__(self, folder: str, length: int, dtype: np.dtype):
        fs, path = file_system(folder)
        fs.create_dir(path, recursive=True)
        name = uuid.uuid4().hex
        self.length, self.dtype = length, dtype
        self.schema = pa.schema([("input_ids", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.uint8(), -(-length // 8)))])
        self.uris = f"{folder}/tokens-{name}.arrow", f"{folder}/docs-{name}.arrow"
        self._sinks = [fs.open_output_stream(f"{path}/{kind}-{name}.arrow") for kind in ("tokens", "docs")]
        self._tokens = pa.ipc.new_file(self._sinks[0], self.schema)
        self._docs = pa.ipc.new_file(self._sinks[1], DOCS)
        self._held: list[np.ndarray] = []
        self._n_held = self.n_tokens = self.n_docs = 0
        self._rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self._rows.append((doc_id, self.n_tokens, len(ids)))
        self.n_tokens += len(ids)
        self.n_docs += 1
        self._held.append(ids.astype(self.dtype, copy=False))
        self._n_held += len(ids)
        if self._n_held >= self.length * BATCH_SEQUENCES:
            self._flush(False)
        if len(self._rows) >= 10_000:
            self._flush_docs()

    def _flush(self, last: bool) -> None:
        """Writes whole batches alone, so that sequence ``i`` lies in batch
        ``i // BATCH_SEQUENCES``; only the last flush writes a shorter one."""
        ids = np.concatenate(self._held) if self._held else np.empty(0, self.dtype)
        batch, padding = self.length * BATCH_SEQUENCES, -len(ids) % self.length if last else 0
        if padding:
            ids = np.concatenate([ids, np.zeros(padding, self.dtype)])
        full = len(ids) if last else len(ids) // batch * batch
        for at in range(0, full, batch):
            end = min(full, at + batch)
            self._write(ids[at:end], self.length - padding if end == len(ids) else self.length)
        rest = ids[full:].copy()
        self._held, self._n_held = [rest], len(rest)

    def _write(self, ids: np.ndarray, valid_in_last: int) -> None:
        mask = np.ones(len(ids), bool)
        mask[len(ids) - self.length + valid_in_last :] = False
        bits = np.packbits(mask.reshape(-1, self.length), axis=1, bitorder="little")
        cols = [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), n) for x, n in ((ids, self.length), (bits, bits.shape[1]))]
        self._tokens.write_batch(pa.record_batch(cols, schema=self.schema))

    def _flush_docs(self) -> None:
        if self._rows:
            self._docs.write_batch(pa.record_batch([pa.array(c, pa.int64()) for c in zip(*self._rows)], schema=DOCS))
            self._rows = []

    def close(self) -> None:
        self._flush(True)
        self._flush_docs()
        self._tokens.close()
        self._docs.close()
        for s in self._sinks:
            s.close()


def open_file(path: str) -> pa.ipc.RecordBatchFileReader:
    """The file for random access: a memory map where the path is local."""
    fs, path = file_system(path)
    return pa.ipc.open_file(pa.memory_map(path) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(path))


def sequence(reader: pa.ipc.RecordBatchFileReader, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and packed mask of sequence ``i`` of a shard, both views into the file."""
    batch, j = reader.get_batch(i // BATCH_SEQUENCES), i % BATCH_SEQUENCES
    columns = (batch.column(name) for name in ("input_ids", "mask"))
    return tuple(c.values.to_numpy()[j * c.type.list_size : (j + 1) * c.type.list_size] for c in columns)


def valid(mask: np.ndarray, length: int) -> np.ndarray:
    """A packed mask as booleans."""
    return np.unpackbits(mask, count=length, bitorder="little").astype(bool)


def write_tokens(
    docs: DataFrame, tokenizer: str, *, doc_id: str = "doc_id", text: str = "text", end_id: int = 2, length: int = SEQUENCE_LENGTH, folder: str | None = None
) -> DataFrame:
    """Encode whole texts and write them as shards; returns the manifest.

    Rows go to range partitions by (doc_id, text hash), so shards follow one
    another in ascending doc_id order (null ids first) and a repeated doc_id
    spreads over partitions. Null and empty texts are documents of one id (the
    end id). Rows repeated in the input are documents of their own. An empty
    input gives an empty manifest. Columns other than the two named are ignored.
    """
    spark = docs.sparkSession
    out = uri(folder or shared_path(spark, "tokens"))
    dtype = id_type(tokenizer, end_id)

    def shard(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer, encode = None, Encoder.shared(tokenizer)
        for pdf in batches:
            for i, t in zip(pdf["d"].tolist(), pdf["t"].tolist()):
                writer = writer or ShardWriter(out, length, dtype)
                ids = encode(t or "")
                writer.add(None if i is None or i != i else int(i), np.append(ids, end_id))
        if writer:
            writer.close()
            yield pd.DataFrame([(TaskContext.get().partitionId(), *writer.uris, writer.n_docs, writer.n_tokens)])

    rows = docs.select(F.col(doc_id).cast("long").cast("string").alias("d"), F.col(doc_id).cast("long").alias("k"), F.col(text).alias("t"))
    keys = [F.col("k").asc_nulls_first(), F.xxhash64("t").asc()]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    manifest = f"{out}/manifest"
    dealt.select("d", "t").mapInPandas(shard, MANIFEST).write.parquet(manifest)
    return spark.read.schema(MANIFEST).parquet(manifest)


def read_tokens(manifest: DataFrame, *, with_ids: bool = False) -> DataFrame:
    """Documents read back from the files: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32 (of the ids as little-endian unsigned
    32-bit numbers) and, if asked for, the ids.

    The driver adds up one number per shard; documents stream batch by batch.
    """
    spark: SparkSession = manifest.sparkSession
    shards = manifest.orderBy("part").collect()
    bases = accumulate([s["n_tokens"] for s in shards], initial=0)
    listed = [(s["tokens_uri"], s["docs_uri"], b) for s, b in zip(shards, bases)]

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for tokens_uri, docs_uri, base in pdf.itertuples(index=False):
                yield from _shard_documents(tokens_uri, docs_uri, base, with_ids)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    files = spark.createDataFrame(listed, "tokens_uri string, docs_uri string, base long")
    return files.repartition(max(1, len(listed))).mapInPandas(documents, schema)


def _shard_documents(tokens_uri: str, docs_uri: str, base: int, with_ids: bool) -> Iterator[pd.DataFrame]:
    tokens, docs = open_file(tokens_uri), open_file(docs_uri)
    at, held, left = 0, np.empty(0, np.uint16), 0
    for k in range(docs.num_record_batches):
        index = docs.get_batch(k).to_pydict()
        rows = []
        for doc_id, start, n in zip(index["doc_id"], index["start"], index["n_tokens"]):
            crc, parts, need = 0, [], n
            while need:
                if not left:
                    held = tokens.get_batch(at).column("input_ids").values.to_numpy()
                    at, left = at + 1, len(held)
                got = held[len(held) - left :][:need]
                crc = zlib.crc32(got.astype("<u4").tobytes(), crc)
                left, need = left - len(got), need - len(got)
                if with_ids:
                    parts.append(got.astype(np.int32))
            rows.append((doc_id, base + start, n, crc, *([np.concatenate(parts)] if with_ids else [])))
        yield pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids).astype({"doc_id": "Int64"})
