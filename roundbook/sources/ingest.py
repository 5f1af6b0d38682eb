"""Snapshot ingest: CSV exports → Parquet partitioned by ``snapshot_date``.

A snapshot is all collections exported on one date. Each collection becomes
one Parquet table partitioned by ``snapshot_date``; the newest snapshot is a
partition filter (pruned at planning or by dynamic partition pruning), not a
file-name sort.
"""

from __future__ import annotations

import datetime as dt
import re
import time
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.match import quote
from .csv_records import csv_records, first_record, parsed, text_schema

#: Types that an undocumented column is given, narrowest first, if all its cells read as one.
INFERRED = ["int", "bigint", "double", "date", "timestamp", "boolean"]


def _inferred(records: DataFrame, header: list[str]) -> T.StructType:
    """The narrowest type that holds every cell of a column, in one pass over the file."""
    text = records.filter("row > 0").select(parsed(F.col("record"), text_schema(len(header))).alias("c"))
    fits = [F.bool_and(F.col(f"c.c{i}").isNull() | F.col(f"c.c{i}").try_cast(t).isNotNull()).alias(f"c{i}_{t}") for i in range(len(header)) for t in INFERRED]
    some = [F.max(F.col(f"c.c{i}").isNotNull()).alias(f"c{i}") for i in range(len(header))]
    found = text.agg(*fits, *some).first()
    types = [next((t for t in INFERRED if found[f"c{i}_{t}"]), "string") if found[f"c{i}"] else "string" for i in range(len(header))]
    return T.StructType([T.StructField(h, T._parse_datatype_string(t)) for h, t in zip(header, types)])


def _read(spark: SparkSession, path: str, collection: str, bad: str | None = None) -> DataFrame:
    """One exported CSV in build names; ``bad`` names a column with the number of
    each row's cells that hold text where the typed column holds nothing."""
    header = [c or f"_c{i}" for i, c in enumerate(first_record(spark, path) or [])]
    if not header:
        raise ValueError(f"CSV file is empty: {path}")
    records = csv_records(spark, path)
    known = collection in schemas.TYPES
    schema = schemas.source_schema(collection, header) if known else _inferred(records, header)
    rows = records.filter("row > 0").select(parsed(F.col("record"), schema).alias("c"), parsed(F.col("record"), text_schema(len(header))).alias("t"))
    out = [F.col(f"c.{quote(f.name)}").alias(f.name) for f in schema.fields]
    if bad:
        lost = [(F.coalesce(F.trim(f"t.c{i}") != "", F.lit(False)) & F.col(f"c.{quote(f.name)}").isNull()).cast("int") for i, f in enumerate(schema.fields) if f.dataType != T.StringType()]
        out.append(sum(lost, F.lit(0)).alias(bad))
    raw = rows.select(*out)
    return schemas.to_domain(raw, collection) if known else raw.toDF(*[c.replace(".", "_") for c in raw.columns])


def read_collection(spark: SparkSession, path: str, collection: str) -> DataFrame:
    """One exported CSV as a DataFrame in build names (S1), read by many tasks.

    Documented collections are read with their declared types (dotted source
    names kept in the read schema, renamed once after the scan); the columns of
    other collections get the narrowest type that holds all their cells. Quoted
    cells may hold line breaks (:mod:`.csv_records`).
    """
    return _read(spark, path, collection)


def extracted_tables(spark: SparkSession, folder: str) -> DataFrame:
    """``(table, path, file_date)`` for extracted CSVs named ``table.DATE.hash.csv``.

    The file listing is read with the ``binaryFile`` source without its
    content column, so no file body is loaded. When a table has several
    files, the one with the newest date in its name wins.
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
        .select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"))
    )
    parts = F.split("file_name", r"\.")
    keyed = files.select(
        parts[0].alias("table"), "path",
        F.when(F.size(parts) >= 3, F.to_date(parts[1])).alias("file_date"),
    )
    return keyed.groupBy("table").agg(
        F.max_by("path", F.struct("file_date", "path")).alias("path"),  # NULL dates sort first
        F.max("file_date").alias("file_date"),
    )


_VERSION = re.compile(r"/snapshot_date=(\d{4}-\d{2}-\d{2})/(v-[^/]+)$")


def _listed(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match a glob, on whatever file system holds them."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(f.getPath().toString() for f in found or [])


def published(spark: SparkSession, root: str) -> dict[dt.date, str]:
    """The folder to read for each published snapshot of the table at ``root``.

    A snapshot is written as a version folder of its own; the marker file that
    Spark's committer creates last, when all files are in place, publishes it. The
    newest published version of a date counts. A snapshot folder without version
    folders (of another writer) is read as it is.
    """
    root = root.rstrip("/")
    dates = {p.rsplit("=", 1)[1]: p for p in _listed(spark, f"{root}/snapshot_date=*")}
    versions = [_VERSION.search(p) for p in _listed(spark, f"{root}/snapshot_date=*/v-*")]
    done = {p.rsplit("/", 1)[0] for p in _listed(spark, f"{root}/snapshot_date=*/v-*/_SUCCESS")}
    versioned = {m.group(1) for m in versions if m}
    plain = {d for d in dates if d not in versioned or _listed(spark, f"{dates[d]}/*.parquet")}
    out = {d: dates[d] for d in dates if d in plain and d not in versioned}
    for m in versions:  # in order of their names, which begin with the time
        if m and m.string in done:
            out[m.group(1)] = m.string
    for d in plain & versioned:
        out.setdefault(d, f"{dates[d]}/*.parquet")
    return {dt.date.fromisoformat(d): out[d] for d in sorted(out)}


def write_snapshot(df: DataFrame, root: str, snapshot_date: dt.date, mode: str = "ignore") -> str:
    """Write ``df`` as the snapshot ``snapshot_date`` of the table at ``root``.

    ``ignore`` keeps a published snapshot (create-if-absent), ``overwrite`` replaces
    only that snapshot, ``error`` raises if there is one. The rows are written
    aside and appear at once, when Spark's committer marks the new version: readers
    go on with the version before until then, and a write that dies leaves nothing
    that is read or taken as present. Returns the folder to read.
    """
    if mode not in ("ignore", "overwrite", "error", "errorifexists"):
        raise ValueError(f"unsupported mode {mode!r}")
    root = root.rstrip("/")
    have = published(df.sparkSession, root).get(snapshot_date)
    if have and mode == "ignore":
        return have
    if have and mode != "overwrite":
        raise ValueError(f"snapshot {snapshot_date} of {root} exists")
    path = f"{root}/snapshot_date={snapshot_date.isoformat()}/v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    return path


def import_snapshot(
    spark: SparkSession,
    csv_paths: dict[str, str],
    warehouse: str,
    snapshot_date: dt.date,
    mode: str = "ignore",
) -> DataFrame:
    """Import collections; one failing collection does not stop the rest.

    Returns one row per collection: ``(table, status, error, rows, malformed)``,
    with the ``rows`` of the snapshot and the ``malformed`` values that did not
    fit the declared type. Both are observed while the rows are written; where a
    published snapshot is kept, nothing is parsed and ``malformed`` is NULL.
    """
    results = []
    for table in sorted(csv_paths):
        try:
            root = f"{warehouse}/{table}"
            have = published(spark, root).get(snapshot_date)
            if have and mode == "ignore":
                results.append((table, "ok", None, spark.read.parquet(have).count(), None))
                continue
            seen = Observation()
            rows = _read(spark, csv_paths[table], table, bad="__rb_bad")
            counted = rows.observe(seen, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("__rb_bad"), F.lit(0)).alias("bad"))
            write_snapshot(counted.drop("__rb_bad"), root, snapshot_date, mode)
            results.append((table, "ok", None, seen.get["n"], seen.get["bad"]))
        except Exception as e:  # keep going, report the failure
            results.append((table, "failed", str(e), None, None))
    return spark.createDataFrame(results, "table string, status string, error string, rows long, malformed long")


def read_table(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    """All published snapshots of a table; ``snapshot_date`` is the partition column."""
    root = f"{warehouse.rstrip('/')}/{table}"
    folders = published(spark, root)
    if not folders:
        raise ValueError(f"no published snapshot of {root}")
    return spark.read.option("basePath", root).parquet(*folders.values())


def latest_snapshot(df: DataFrame, date_col: str = "snapshot_date") -> DataFrame:
    """Rows of the newest snapshot only.

    A filter on the partition column against a scalar subquery of its
    maximum: the subquery runs first, its value becomes a partition filter,
    and only the newest snapshot's files are scanned. For a stored table,
    :func:`read_latest` takes the date from the listing and scans nothing for it.
    """
    newest = df.select(F.max(date_col)).scalar()
    return df.where(F.col(date_col) == newest)


def snapshot_dates(spark: SparkSession, warehouse: str, table: str) -> list[dt.date]:
    """The table's published snapshot dates, oldest first, from its folders' names."""
    return list(published(spark, f"{warehouse}/{table}"))


def read_latest(spark: SparkSession, warehouse: str, table: str) -> DataFrame:
    """The newest snapshot of a stored table: a constant partition filter."""
    return read_table(spark, warehouse, table).where(F.col("snapshot_date") == F.lit(snapshot_dates(spark, warehouse, table)[-1]))


def collections_in(spark: SparkSession, warehouse: str) -> list[str]:
    """The tables of a warehouse folder that have a published snapshot, sorted."""
    tables = sorted({p.rsplit("/", 2)[1] for p in _listed(spark, f"{warehouse.rstrip('/')}/*/snapshot_date=*")})
    return [t for t in tables if published(spark, f"{warehouse}/{t}")]


def register_collections(spark: SparkSession, warehouse: str, snapshot: str | dt.date | None = "latest") -> dict[str, DataFrame]:
    """Every collection of the warehouse as a temp view of its name, for ad-hoc
    SQL: its newest snapshot, the one of a date, or (None) all of them."""
    out = {}
    for table in collections_in(spark, warehouse):
        if snapshot == "latest":
            out[table] = read_latest(spark, warehouse, table)
        else:
            all_rows = read_table(spark, warehouse, table)
            out[table] = all_rows if snapshot is None else all_rows.where(F.col("snapshot_date") == F.to_date(F.lit(str(snapshot))))
        out[table].createOrReplaceTempView(table)
    return out


def warehouse_counts(spark: SparkSession, warehouse: str) -> DataFrame:
    """``(table_name, n_rows)`` of every collection's newest snapshot."""
    return table_counts({t: read_latest(spark, warehouse, t) for t in collections_in(spark, warehouse)})


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, n_rows)`` for each table (S14, A7), empty ones included.

    One aggregation over all tables; the scans read no column, so the rows are
    counted from the files' footers.
    """
    spark = next(iter(tables.values())).sparkSession
    rows = reduce(DataFrame.unionAll, [df.select(F.lit(name).alias("table_name")) for name, df in tables.items()])
    counts = rows.groupBy("table_name").agg(F.count(F.lit(1)).alias("n"))
    names = spark.createDataFrame([(n,) for n in tables], "table_name string")
    return names.join(counts, "table_name", "left").select("table_name", F.coalesce("n", F.lit(0)).alias("n_rows"))


MANIFEST_SCHEMA = "map<string, struct<file: string, last_modified: string, content_length: string, downloaded_at: string>>"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The download manifest as rows ``(collection, file, last_modified, content_length, downloaded_at)``."""
    raw = spark.read.text(path, wholetext=True)
    m = raw.select(F.explode(F.from_json("value", MANIFEST_SCHEMA)).alias("collection", "e"))
    return m.select("collection", "e.file", "e.last_modified", "e.content_length", "e.downloaded_at")


def snapshot_date_of(manifest: DataFrame, as_of: dt.date) -> DataFrame:
    """One row ``snapshot_date``: the date of the first manifest entry.

    The manifest is written with sorted keys, so the first entry is the
    alphabetically first collection. Its ``last_modified`` date part is used;
    a missing, ``unknown`` or unparsable value falls back to ``as_of``.
    """
    first = manifest.agg(F.min_by("last_modified", "collection").alias("lm"))
    lm = F.col("lm")
    parsed = F.when(lm.isNotNull() & (F.lower(lm) != "unknown"), F.try_to_date(F.substring(lm, 1, 10), "yyyy-MM-dd"))
    return first.select(F.coalesce(parsed, F.lit(as_of)).alias("snapshot_date"))


def import_export(
    spark: SparkSession,
    zip_folder: str,
    csv_folder: str,
    manifest_path: str | None,
    warehouse: str,
    as_of: dt.date,
    mode: str = "ignore",
) -> DataFrame:
    """One import run: snapshot date, CSVs, tables (S2–S9, S14 composed).

    The snapshot date comes from the manifest (``as_of`` when missing or
    unusable). Extracted CSVs in ``csv_folder`` are used when present;
    otherwise every archive is extracted there first. Each collection is then
    written as that snapshot's partition. Returns ``(table, status, error,
    rows, malformed, snapshot_date)``; an archive that cannot be extracted is
    a ``failed`` row of its own.
    """
    from .archives import extract_archives

    if manifest_path:
        date = snapshot_date_of(read_manifest(spark, manifest_path), as_of).first()["snapshot_date"]
    else:
        date = as_of
    try:
        found = {r["table"]: r["path"] for r in extracted_tables(spark, csv_folder).collect()}
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):  # only a missing folder means that nothing was extracted
            raise
        found = {}
    broken: list[tuple] = []
    if not found:
        done = extract_archives(spark, zip_folder, csv_folder, date.isoformat()).collect()  # one row per archive
        broken = [(r["collection"], "failed", r["error"], None, None) for r in done if r["status"] == "failed"]
        found = {r["table"]: r["path"] for r in extracted_tables(spark, csv_folder).collect()}
    res = import_snapshot(spark, found, warehouse, date, mode)
    if broken:
        res = res.unionByName(spark.createDataFrame(broken, res.schema))
    return res.withColumn("snapshot_date", F.lit(date))
