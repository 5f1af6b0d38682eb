"""Bulk enrichment: URL list → company profile, funding history, quarters.

One DAG instead of the reference's per-row query loop:

    lookup → host (C1) → distinct hosts → match (J1) ─┐ checkpoint
    orgs ⋉ matched ids → company text (C11)          │
    rounds ⋉ matched ids → funding text (A9, A10)    ├→ per-org row → per-host
                        → total (A1), quarters (A2)  ┘   → lookup ⟕ on host (J4)
    axis (A14, F9) ──────────────────────────────────────→ wide quarters (A3)

Matching is computed once per distinct host and checkpointed (the axis job
and the output job both read it). Every join is on a key; the big inputs
(rounds, investments) are only semi-joined against the matched key set,
which AQE broadcasts when its measured size allows; a larger set is applied as
a Bloom filter at their scans before the sort-merge join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import quarters as Q
from ..functions import text as TX
from ..functions.urls import find_url_column, lookup_host
from ..plans.config import ensure_checkpoint_dir
from . import funding as FD
from .match import GRAM, HOST_KEY, UrlIndex, match_hosts
from .prefilter import semi_join

ROW_ID = "__row_id"
# Rounds of a matched company, about: sizes the filter of their ids.
ROUNDS_PER_COMPANY = 8
INFO_COLS = ["Company Information", "Investment Rounds and Funding Information", "Total Funding to Date"]


def company_rows(orgs: DataFrame) -> DataFrame:
    """``(org_uuid, founded, company_info)`` with the 1900-01-01 default."""
    founded = Q.founded_or_default("founded_on")
    return orgs.select("org_uuid", founded.alias("founded"), TX.company_info(founded=founded).alias("company_info"))


def matched(lookup: DataFrame, orgs: DataFrame, url_col: str, k: int = GRAM, checkpoint: bool = True,
            index: UrlIndex | None = None, only: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(keyed lookup with HOST_KEY, host→org matches)``; matches checkpointed.

    With ``only``, the lookup keeps that column alone: its rows are dealt to many tasks
    and written once, so that an inner join's filter on the host doesn't normalise
    each URL again at the scan.
    """
    if only is None:
        keyed = lookup.withColumn(HOST_KEY, lookup_host(FD.quote(url_col)))
    else:
        spark = lookup.sparkSession
        ensure_checkpoint_dir(spark)
        dealt = lookup.select(F.col(FD.quote(only)).alias("__rb_only"), F.col(FD.quote(url_col)).alias("__rb_url")).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
        keyed = dealt.select(F.col("__rb_only").alias(only), lookup_host("__rb_url").alias(HOST_KEY)).checkpoint(eager=True)
    found = match_hosts(keyed.select(F.col(HOST_KEY).alias("host")), orgs, k=k, index=index)
    if checkpoint:
        ensure_checkpoint_dir(lookup.sparkSession)
        found = found.checkpoint(eager=True)
    return keyed, found


def enrich(
    lookup: DataFrame,
    orgs: DataFrame,
    rounds: DataFrame,
    investments: DataFrame,
    as_of: dt.date,
    url_col: str | None = None,
    oldest_year: int | str | None = None,
    k: int = GRAM,
    checkpoint: bool = True,
    index: UrlIndex | None = None,
    broadcast_keys: int | None = None,
) -> DataFrame:
    """The enriched table: input columns, three info columns, then one column
    per quarter, newest first (S12 layout). One output row per input row.

    ``url_col`` defaults to the header rule of :func:`find_url_column`.
    ``as_of`` ends every quarter series (the reference uses today's date).
    ``index``: a URL index built from ``orgs`` (see ``build_url_index``).
    ``broadcast_keys``: see :func:`~roundbook.operators.prefilter.semi_join`.
    """
    in_cols = [c for c in lookup.columns if c != ROW_ID]
    url_col = url_col or in_cols[find_url_column(in_cols)]
    keyed, found = matched(lookup, orgs, url_col, k, checkpoint, index)

    n_ids = found.count() if checkpoint else None
    m_orgs = semi_join(orgs, found, "org_uuid", n_ids, broadcast_keys)
    m_rounds = semi_join(rounds, found, "org_uuid", n_ids, broadcast_keys)
    # at least as many rounds as companies are matched: their ids are filtered alike
    m_inv = semi_join(investments, m_rounds, "round_uuid", n_ids and ROUNDS_PER_COMPANY * n_ids, broadcast_keys)

    axis = FD.quarter_axis(m_orgs, as_of, oldest_year)
    # one aggregation of the matched rounds feeds both the total and the quarters
    per_org = (
        company_rows(m_orgs)
        .join(FD.funding_text(m_rounds, m_inv, rounds, investments), "org_uuid", "left")
        .join(FD.funding_by_quarter(m_rounds), "org_uuid", "left")
    )
    # Working columns get reserved names: a lookup list may have columns of its
    # own called host, founded or total_funding.
    info = ["company_info", "funding_info", "total_funding", "amounts"]
    per_host = found.select("host", "org_uuid").join(per_org, "org_uuid").selectExpr("host AS __rb_match", *[f"{c} AS __rb_{c}" for c in info])
    out = keyed.join(per_host, F.col(HOST_KEY) == F.col("__rb_match"), "left")
    # the few quarters with funding become the wide row only here, past all joins
    if axis:
        newest, oldest = (int(q[:4]) * 4 + int(q[-1]) - 1 for q in (axis[0], axis[-1]))
        out = out.withColumn("__rb_axis", FD.on_axis(F.col("__rb_amounts"), newest, oldest))
    # one selectExpr call: wide outputs (hundreds of quarter columns) would
    # otherwise cost several driver round-trips per column
    exprs = [FD.quote(ROW_ID)] if ROW_ID in lookup.columns else []
    exprs += [FD.quote(c) for c in in_cols]
    exprs += [
        f"__rb_company_info AS {FD.quote(INFO_COLS[0])}",
        f"__rb_funding_info AS {FD.quote(INFO_COLS[1])}",
        f"CAST(__rb_total_funding AS DOUBLE) AS {FD.quote(INFO_COLS[2])}",
    ]
    exprs += [f"__rb_axis[{i}] AS {FD.quote(q)}" for i, q in enumerate(axis)]
    return out.selectExpr(*exprs)


def enrich_long(
    lookup: DataFrame,
    orgs: DataFrame,
    rounds: DataFrame,
    as_of: dt.date,
    url_col: str,
    id_col: str,
    k: int = GRAM,
) -> DataFrame:
    """Long form of the quarter block: ``(id, org_uuid, quarter, amount)`` for
    each lookup row with a matched company and a funded quarter on the axis.
    The matches feed two branches, so they are checkpointed like in enrich."""
    keyed, found = matched(lookup, orgs, url_col, k, checkpoint=True, only=id_col)
    ids = found.select("org_uuid").distinct()
    m_orgs = orgs.join(ids, "org_uuid", "left_semi")
    m_rounds = rounds.join(ids, "org_uuid", "left_semi")
    axis = FD.axis_frame(m_orgs, as_of).select("quarter")
    q = FD.quarterly_funding(m_rounds).join(axis, "quarter", "left_semi")
    rows = keyed.select(id_col, F.col(HOST_KEY).alias("host")).join(found.select("host", "org_uuid"), "host")
    return rows.join(q, "org_uuid").select(id_col, "org_uuid", "quarter", F.col("amount").cast("double").alias("amount"))


def run_summary(matched_rows: DataFrame, orgs: DataFrame | None = None, as_of: dt.date | None = None,
                org_col: str = "org_uuid") -> DataFrame:
    """Rows processed and companies found (A13); with ``orgs`` and ``as_of``
    also the earliest and latest quarter of the run's axis (A4).

    One aggregation over the lookup rows (each matched row carries the two
    ends of its company's quarter series), so no extra join of summaries.
    """
    aggs = [F.count(F.lit(1)).alias("rows_processed"), F.count(F.col(org_col)).alias("companies_found")]
    rows = matched_rows
    if orgs is not None and as_of is not None:
        ends = orgs.select(
            F.col("org_uuid").alias(org_col),
            *[c.alias(n) for c, n in zip(Q.series_span(Q.founded_or_default("founded_on"), F.lit(as_of)), ("_f", "_l"))],
        )
        rows = rows.join(ends, org_col, "left")
        aggs += [
            Q.label_of_index(F.min("_f")).alias("earliest_quarter"),
            Q.label_of_index(F.max("_l")).alias("latest_quarter"),
        ]
    return rows.agg(*aggs)
