"""A training corpus from raw documents, in five stages.

Each stage calls one operator of ``roundbook.llm`` on all rows its predecessor
kept and returns a DataFrame that is written as Parquet and read again as the
next stage's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roundbook.llm import decontam, encoding, packing, pii, simhash, toxicity
from roundbook.llm.common import columns, table, written


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models reject (score 0.3 or more) go.

    Null, empty and wordless texts have no evidence against them and stay; repeated
    rows share a fate; no documents give none.
    """
    scored = toxicity.score(docs, table(spark, sf_dir, "labels"), threshold=0.3)
    return scored.filter(F.col(scored.columns[-1]) == 0).select(*columns(docs))


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component (4-word shingles, 4 bits) the document with the
    smallest id stays; of rows that repeat that id, one.

    Null and empty texts have fingerprint 0 and are a component like any other, so one
    of them stays; a null id stays only where its component has no other. No
    documents give none.
    """
    return simhash.representatives(docs, shingle=4, radius=4)


def benchmark_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go.

    Null, empty and wordless texts hold none and stay, as all do without items;
    repeated rows share a fate; no documents give none.
    """
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets; n_chars follows, where there
    is such a column.

    Every row stays. Null and empty texts stay as they are (a null text's n_chars is
    null); no documents give none.
    """
    done = pii.redact(docs)
    return done.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else done


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents' pieces with their ids and places in sequences of 2048 tokens.

    Null and empty texts are a piece of the end id alone; repeated rows are documents
    of their own; other columns of the documents are not kept; no documents
    give no pieces.
    """
    return packing.pack(packing.encode_pieces(docs, encoding.default_tokenizer(), end_id=0, capacity=2048), capacity=2048)


STAGES = [
    ("toxicity", toxic_out),
    ("simhash near-dedup", near_duplicates_out),
    ("benchmark decontamination", benchmark_out),
    ("pii", personal_data_out),
    ("best-fit packing", packed),
]

#: SQL can't express the stages' models, automata and packing; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"stage-{k + 1}")
    return docs
