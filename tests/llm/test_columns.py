"""Columns that are called like an operator's working columns; null ids and texts; repeats; no rows."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from roundbook.llm import decontam, html_text, packing, pii, simhash
from roundbook.llm.common import unused

NAMES = ["_text", "_id", "_hash", "_fp", "_row", "_score", "_toxic", "_place", "__score", "first", "n", "part", "nth", "t", "w", "h", "key", "row", "fp", "hash", "none", "component_id", "contaminated", "spans", "a.b", "c d"]


def extra(df):
    return df.select("*", *[F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("?"))).alias(c) for c in NAMES])


@pytest.fixture(scope="module")
def documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    odd = docs.limit(2).select(F.lit(None).cast("long").alias("doc_id"), "text", "lang", "source", "n_chars").union(
        docs.limit(3).select((F.col("doc_id") + 10**9).alias("doc_id"), F.lit(None).cast("string"), "lang", "source", "n_chars")).union(docs.limit(2))
    return docs.union(odd)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_every_column(spark, documents, name, stage):
    plain = sorted((r["doc_id"] is None, r["doc_id"], r["text"] or "") for r in stage(spark, documents, SF_SMALL).collect())
    wide = stage(spark, extra(documents), SF_SMALL)
    assert wide.columns == [*documents.columns, *NAMES]
    rows = wide.collect()
    assert sorted((r["doc_id"] is None, r["doc_id"], r["text"] or "") for r in rows) == plain and len(rows) > 50
    assert all(r[c] == f"{c} of {'?' if r['doc_id'] is None else r['doc_id']}" for r in rows for c in NAMES)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_without_documents(spark, documents, name, stage):
    assert stage(spark, documents.limit(0), SF_SMALL).count() == 0


def test_operators_keep_every_column(spark, documents):
    pages = extra(spark.createDataFrame([(1, "<p>x</p>"), (None, None)], "doc_id long, html string"))
    got = html_text.main_text(pages)
    assert got.columns == [*pages.columns, "__text"] and {r["__text"] for r in got.collect()} == {"x", ""}
    assert got.where("_text <> concat('_text of ', coalesce(cast(doc_id as string), '?'))").count() == 0
    items = spark.createDataFrame([("i", "w " * 30)], "item_id string, text string")
    assert decontam.clean(extra(documents), items).count() == documents.count()
    assert simhash.representatives(extra(documents)).columns == [*documents.columns, *NAMES]
    assert pii.redact(extra(documents)).columns == [*documents.columns, *NAMES]
    pieces = spark.createDataFrame([(1, 0, 0, 3, b"x" * 12, 0, 0), (2, 0, 0, 2, b"y" * 8, 1, 0), (3, 0, 0, 3, b"z" * 12, 1, 0)], packing.PIECES)
    kept = ["_place", "first", "n", "_text"]
    wide = packing.pack(pieces.select("*", *[F.lit(c).alias(c) for c in kept], F.lit(-1).alias("offset")), capacity=5)
    assert wide.columns == ["doc_id", "piece", "start", "length", "ids", *kept, "sequence_id", "offset"]
    places = {(r["sequence_id"], r["offset"]): r["length"] for r in wide.collect()}
    assert len(places) == 3 and len({s for s, _ in places}) == 2 and all(o in (0, 2, 3) for _, o in places)
    assert unused(extra(documents), "_SCORE") == "___SCORE"
