"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roundbook.plans.config import ensure_checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder named by ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Cuts the lineage in a way that survives lost executors: the files are on
    storage that every machine reads, and Spark's committer leaves only whole
    files of successful tasks.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the given folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column has it, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def columns(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever characters their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def uri(path: str) -> str:
    """``file:/x`` as Hadoop writes it, as the ``file:///x`` that Arrow reads."""
    return "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system for a URI (or a plain local path), and the path in it."""
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def read_parquet(folder: str, columns: list[str]) -> pa.Table:
    """The Parquet files of a folder, read by a task itself; none, no rows."""
    fs, path = file_system(folder)
    files = sorted(f.path for f in fs.get_file_info(pafs.FileSelector(path, allow_not_found=True)) if f.path.endswith(".parquet"))
    tables = [pq.ParquetFile(fs.open_input_file(f)).read(columns) for f in files]
    return pa.concat_tables(tables) if tables else pa.table({c: [] for c in columns})


def parquet_batches(folder: str, columns: list[str], rows: int) -> Iterator[pa.RecordBatch]:
    """The Parquet files of a folder, read by a task itself, ``rows`` rows at once at most."""
    fs, path = file_system(folder)
    for f in sorted(f.path for f in fs.get_file_info(pafs.FileSelector(path)) if f.path.endswith(".parquet")):
        with fs.open_input_file(f) as file:
            yield from pq.ParquetFile(file).iter_batches(rows, columns=columns)


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser on an array of unsigned 64-bit numbers."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    return x ^ (x >> np.uint64(31))


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every window of ``w`` values (doubling steps, O(n log w))."""
    if len(x) < w:
        return x[:0]
    have, out = 1, x
    while have * 2 <= w:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < w:
        out = np.minimum(out[: len(x) - w + 1], out[w - have : w - have + len(x) - w + 1])
    return out
