"""Lookup-list source (S11) and enriched/any-query CSV sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.urls import clean_header
from .csv_records import csv_records, first_record, parsed, text_schema, used_cells

ROW_ID = "__row_id"


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """One user CSV file with a header row, every column a string, plus ``__row_id``.

    The header row is taken from the file itself and cleaned (C3): blank
    names become ``Column_{i+1}``, and so do the columns of cells beyond the
    header. Names that repeat, in any case, get ``_2``, ``_3``, …
    The file is read by many tasks; ``__row_id`` is the record's number in it, from
    1 and without gaps, since each split starts with the number of records
    before it. Rows shorter than the header are padded with NULL (written back as
    ``''``). A folder of several files is an error.
    """
    if len(spark.read.text(path).inputFiles()) > 1:
        raise ValueError(f"a lookup list is one file: {path}")
    first = first_record(spark, path)
    if first is None:
        raise ValueError(f"CSV file is empty: {path}")
    records = csv_records(spark, path)
    width = max(len(first), records.agg(F.max(used_cells(F.col("record")))).first()[0])
    taken: set[str] = set()
    names = []
    for h in clean_header(first + [None] * (width - len(first))):
        name, k = h, 1
        while name.lower() in taken:
            k += 1
            name = f"{h}_{k}"
        taken.add(name.lower())
        names.append(name)
    body = records.filter("row > 0").select(parsed(F.col("record"), text_schema(width)).alias("c"), F.col("row").alias(ROW_ID))
    return body.select("c.*", ROW_ID).toDF(*names, ROW_ID)


def plain_decimal(number: Column) -> Column:
    """A DOUBLE as text without an exponent: ``12000000.0``, ``0.5``."""
    text = number.try_cast("decimal(38,10)").cast("string")
    return F.coalesce(F.regexp_replace(text, r"(\.\d+?)0+$", "$1"), number.cast("string"))


def _write_csv(df: DataFrame, path: str) -> None:
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    quoted = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
    out = df.select(*[plain_decimal(q.cast("double")).alias(c) if c in floats else q for c, q in zip(df.columns, quoted)])
    out.write.mode("overwrite").options(header=True, emptyValue="", nullValue="", quote='"', escape='"').csv(path)


def write_enriched(df: DataFrame, path: str, order_col: str = ROW_ID) -> None:
    """Write the enriched table as CSV in input order; NULL is written as ``''``.

    The global sort range-partitions the rows, and each partition writes one
    ordered part file, so the part files read in name order give the input
    order; no task ever holds the whole table. Amounts are plain decimals.
    """
    _write_csv(df.orderBy(order_col).drop(order_col), path)


def export_csv(df: DataFrame, path: str) -> None:
    """Any query result to CSV with a header (S13): quotes doubled, amounts as
    plain decimals, NULL as ``''``."""
    _write_csv(df, path)
