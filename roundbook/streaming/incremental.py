"""Incremental runs with Structured Streaming.

The reference works in batches (a lookup CSV, an export download). The same
work arriving as files is expressed as file-source streams whose
micro-batches reuse the batch operators through ``foreachBatch``; progress
lives in the query's checkpoint location, so a restarted query (or a lost
executor) resumes without reprocessing committed files.

* :func:`enrich_stream` — lookup CSV files dropped into a folder are matched
  and enriched; results append to a Parquet table (long quarter form, so the
  schema stays fixed while each batch's quarter axis varies).
* :func:`snapshot_stream` — extracted export CSVs (``table.DATE.hash.csv``)
  dropped into a folder are appended to the ``snapshot_date`` partition named
  by their file name.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators import funding as FD
from ..operators.enrich import company_rows, matched
from ..operators.match import HOST_KEY


def enrich_stream(
    spark: SparkSession,
    landing: str,
    lookup_schema: T.StructType,
    url_col: str,
    orgs: DataFrame,
    rounds: DataFrame,
    investments: DataFrame,
    as_of: dt.date,
    out_path: str,
    checkpoint_location: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Enrich each micro-batch of lookup rows; append ``rows`` and ``quarters`` tables.

    ``out_path/rows``: input columns + ``org_uuid``, company info, funding
    info, total. ``out_path/quarters``: ``(input columns…, quarter, amount)``
    for every quarter with funding; :func:`read_quarters` keeps those on the
    axis of all rows so far. Reference tables are static inputs.
    """
    src = (
        spark.readStream.schema(lookup_schema)
        .option("header", True).option("multiLine", True).option("escape", '"')
        .csv(landing)
    )

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        keyed, found = matched(batch, orgs, url_col, checkpoint=False)
        found = found.persist()  # read by both outputs; recomputed where an executor is lost
        ids = found.select("org_uuid").distinct()
        m_orgs = orgs.join(ids, "org_uuid", "left_semi")
        m_rounds = rounds.join(ids, "org_uuid", "left_semi")
        m_inv = investments.join(m_rounds.select("round_uuid"), "round_uuid", "left_semi")
        per_org = (
            company_rows(m_orgs)
            .join(FD.funding_text(m_rounds, m_inv), "org_uuid", "left")
            .join(FD.total_funding(m_rounds), "org_uuid", "left")
        )
        info = ["org_uuid", "company_info", "funding_info", "total_funding"]
        per_host = found.select("host", "org_uuid").join(per_org, "org_uuid").selectExpr("host AS __rb_match", *[f"{c} AS __rb_{c}" for c in info])
        own = [F.col(FD.quote(c)) for c in batch.columns]
        rows = keyed.join(per_host, F.col(HOST_KEY) == F.col("__rb_match"), "left")
        rows = rows.select(*own, *[F.col(f"__rb_{c}").alias(c) for c in info[:-1]], F.col("__rb_total_funding").cast("double").alias("total_funding"))
        # one folder per batch, overwritten on retry: exactly-once output
        rows.write.mode("overwrite").parquet(f"{out_path}/rows/batch_id={batch_id}")
        # every quarter is stored: which of them are on the axis depends on all
        # batches' companies and is settled when the table is read
        q = FD.quarterly_funding(m_rounds).select(F.col("org_uuid").alias("__rb_org"), F.col("quarter").alias("__rb_quarter"), F.col("amount").alias("__rb_amount"))
        hosts = found.select(F.col("host").alias(HOST_KEY), F.col("org_uuid").alias("__rb_org"))
        quarters = keyed.join(hosts, HOST_KEY).join(q, "__rb_org").select(
            *own, F.col("__rb_org").alias("org_uuid"), F.col("__rb_quarter").alias("quarter"), F.col("__rb_amount").cast("double").alias("amount")
        )
        quarters.write.mode("overwrite").parquet(f"{out_path}/quarters/batch_id={batch_id}")
        found.unpersist()
        batch.unpersist()

    w = src.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_location)
    w = w.trigger(**trigger) if trigger else w.trigger(availableNow=True)
    return w.start()


def read_quarters(spark: SparkSession, out_path: str, orgs: DataFrame, as_of: dt.date) -> DataFrame:
    """The stored quarters on the axis of all companies matched so far: the same
    rows however the input was cut into batches."""
    ids = spark.read.parquet(f"{out_path}/rows").select("org_uuid").distinct()
    axis = FD.axis_frame(orgs.join(ids, "org_uuid", "left_semi"), as_of).select("quarter")
    return spark.read.parquet(f"{out_path}/quarters").join(axis, "quarter", "left_semi").drop("batch_id")


def snapshot_stream(
    spark: SparkSession,
    landing: str,
    collection: str,
    header: list[str],
    warehouse: str,
    checkpoint_location: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append extracted CSVs of one collection to its snapshot-partitioned table.

    ``header`` gives the source column names (fixed for a stream); the
    snapshot date is read from each file name (``table.YYYY-MM-DD.hash.csv``).
    """
    schema = schemas.source_schema(collection, header)
    src = (
        spark.readStream.schema(schema)
        .option("header", True).option("multiLine", True).option("escape", '"')
        .option("pathGlobFilter", f"{collection}.*.csv")
        .csv(landing)
        .withColumn("snapshot_date", F.to_date(F.split(F.element_at(F.split(F.input_file_name(), "/"), -1), r"\.")[1]))
    )
    out = schemas.to_domain(src, collection)  # extra columns (snapshot_date) pass through

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        # (snapshot_date, batch_id) partitions, dynamically overwritten: a
        # retried batch replaces only its own files
        (
            batch.withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("snapshot_date", "batch_id")
            .parquet(f"{warehouse}/{collection}")
        )

    w = out.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_location)
    w = w.trigger(**trigger) if trigger else w.trigger(availableNow=True)
    return w.start()
