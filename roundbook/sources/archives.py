"""Export archives: listing (S5), extraction (S2, S3) and audit.

The ZIP format has no Spark reader, so each archive is one row of a listing
DataFrame and its work runs inside ``mapInPandas`` on an executor: the task
opens the archive by path (the folder must be on storage every executor
mounts) and streams the member in chunks, so neither the driver nor a task
ever holds an archive or a CSV whole. The listing is read with the
``binaryFile`` source *without* its ``content`` column.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import human_size
from .collections import expected_collections

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 8 << 20  # bytes per read when streaming a member


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """``(collection, path, size, modified)`` for every ``*.zip`` in ``folder``.

    Zero-length files are not listed by the ``binaryFile`` source; the audit
    reports such collections as missing or empty.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(
        F.regexp_replace(name, r"\.zip$", "").alias("collection"),
        "path",
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


def _local(path: str) -> str:
    return path[5:] if path.startswith("file:") else path


def extract_archives(
    spark: SparkSession,
    zip_folder: str,
    out_folder: str,
    date_str: str,
    skip_existing: bool = True,
    num_tasks: int | None = None,
) -> DataFrame:
    """Extract the first ``.csv`` member of each archive as
    ``{collection}.{date}.{md5[:8]}.csv`` in ``out_folder`` (S2).

    Returns ``(collection, status, csv_path, bytes, error)`` per archive;
    ``status`` is ``extracted``, ``failed`` or ``skipped`` (a CSV for the
    collection already exists, S3).
    """
    listing = list_archives(spark, zip_folder)
    out_local = _local(out_folder)
    if skip_existing:
        try:
            done = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(out_folder)
            done = done.select(F.split(F.element_at(F.split("path", "/"), -1), r"\.")[0].alias("collection"))
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):  # only a missing folder means that nothing is there
                raise
            done = spark.createDataFrame([], "collection string")
        skipped = listing.join(done, "collection", "left_semi").select(
            "collection", F.lit("skipped").alias("status"), F.lit(None).cast("string").alias("csv_path"),
            F.lit(None).cast("long").alias("bytes"), F.lit(None).cast("string").alias("error"),
        )
        todo = listing.join(done, "collection", "left_anti")
    else:
        skipped, todo = None, listing
    n = num_tasks or max(1, spark.sparkContext.defaultParallelism)
    todo = todo.select("collection", "path").repartition(n, "collection")

    def extract(batches):
        import hashlib
        import os
        import zipfile

        for pdf in batches:
            rows = []
            for coll, path in zip(pdf["collection"], pdf["path"]):
                tmp = os.path.join(out_local, f".{coll}.{date_str}.partial")
                try:
                    with zipfile.ZipFile(_local(path)) as zf:
                        members = [m for m in zf.namelist() if m.endswith(".csv")]
                        if not members:
                            raise ValueError("no CSV file in archive")
                        h, size = hashlib.md5(), 0
                        with zf.open(members[0]) as src, open(tmp, "wb") as dst:
                            while True:
                                buf = src.read(CHUNK)
                                if not buf:
                                    break
                                h.update(buf)
                                dst.write(buf)
                                size += len(buf)
                    final = os.path.join(out_local, f"{coll}.{date_str}.{h.hexdigest()[:8]}.csv")
                    os.replace(tmp, final)
                    rows.append((coll, "extracted", final, size, None))
                except Exception as e:  # report per archive, keep going
                    if os.path.exists(tmp):
                        os.remove(tmp)
                    rows.append((coll, "failed", None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["collection", "status", "csv_path", "bytes", "error"])

    import os

    os.makedirs(out_local, exist_ok=True)
    schema = "collection string, status string, csv_path string, bytes long, error string"
    out = todo.mapInPandas(extract, schema)
    return out.unionByName(skipped) if skipped is not None else out


def extraction_summary(results: DataFrame) -> DataFrame:
    """Counts of extracted / skipped / failed archives (S3)."""
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def audit_archives(
    spark: SparkSession,
    zip_folder: str,
    manifest: DataFrame | None = None,
    full: bool = False,
    num_tasks: int | None = None,
) -> DataFrame:
    """One row per known collection: is its archive present, readable, complete?

    Columns: ``collection, display_name, path, size, size_text, expected_size,
    status, issue``. ``status`` is ``valid``, ``corrupted`` or
    ``missing_or_empty``; ``issue`` a code (``missing``, ``bad_format``,
    ``no_entries``, ``unreadable``, ``crc``, ``size``) with its detail behind a
    colon. The quick check opens the archive and requires at
    least one entry; ``full=True`` also verifies every member's CRC (a
    damaged member is reported, not ignored). The size is compared with the
    manifest's ``content_length`` when that is known (blank = not checked).
    Files of unknown collections are ignored (S15, S16, J7, J8, F10).
    """
    expected = expected_collections(spark)
    listing = list_archives(spark, zip_folder).join(expected.select("collection"), "collection", "left_semi")
    n = num_tasks or max(1, spark.sparkContext.defaultParallelism)

    def problem(path: str) -> str | None:
        """The issue code of one archive, with its detail; None for a sound one."""
        import zipfile

        if not zipfile.is_zipfile(path):
            return "bad_format"
        try:
            with zipfile.ZipFile(path) as archive:
                damaged = archive.testzip() if full else None
                return "no_entries" if not archive.infolist() else damaged and f"crc:{damaged}"
        except (zipfile.BadZipFile, OSError, RuntimeError, NotImplementedError) as e:
            return f"unreadable:{e}"

    def check(batches):
        for pdf in batches:
            issues = [problem(_local(path)) for path in pdf["path"]]
            yield pd.DataFrame({"collection": pdf["collection"], "zip_issue": issues})

    checked = listing.select("collection", "path").repartition(n, "collection").mapInPandas(
        check, "collection string, zip_issue string"
    )
    files = listing.join(checked, "collection")
    if manifest is not None:
        m = manifest.select(
            "collection",
            F.when(F.trim("content_length") != "", F.col("content_length").try_cast("long")).alias("expected_size"),
        )
    else:
        m = spark.createDataFrame([], "collection string, expected_size long")
    rows = expected.join(files, "collection", "left").join(m, "collection", "left")
    size_issue = F.when(
        F.col("expected_size").isNotNull() & (F.col("size") != F.col("expected_size")),
        F.concat_ws(":", F.lit("size"), "expected_size", "size"),
    )
    issue = F.when(F.col("path").isNull(), F.lit("missing")).otherwise(F.coalesce("zip_issue", size_issue))
    status = (
        F.when(F.col("path").isNull(), F.lit("missing_or_empty"))
        .when(issue.isNull(), F.lit("valid"))
        .otherwise(F.lit("corrupted"))
    )
    return rows.select(
        "collection", "display_name", "path", "size", human_size("size").alias("size_text"),
        "expected_size", status.alias("status"), issue.alias("issue"),
    )


def missing_collections(spark: SparkSession, present: DataFrame) -> DataFrame:
    """Known collections without a present table or file."""
    return expected_collections(spark).join(present.select("collection"), "collection", "left_anti")
