"""The documented analytical queries, as DataFrame operators.

Top-k results carry a unique last sort key so ties resolve the same way in
every engine; ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject (each
task keeps its own top k, then one merge of k x tasks rows).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import quarters as Q


def organizations_by_category(orgs: DataFrame, text: str, k: int = 50) -> DataFrame:
    """Companies whose category list contains ``text`` (case-sensitive), most funded first."""
    return (
        orgs.where(F.col("categories").contains(text))
        .select(
            F.col("name").alias("company_name"), "website", F.col("categories").alias("category"),
            F.col("funding_total_usd").cast("double").alias("total_funding"), "num_funding_rounds",
            F.col("founded_on").alias("founded_date"), "org_uuid",
        )
        .orderBy(F.col("total_funding").desc_nulls_last(), F.col("org_uuid"))
        .limit(k)
    )


def investor_portfolio(investments: DataFrame, rounds: DataFrame, orgs: DataFrame, text: str,
                       k: int | None = None) -> DataFrame:
    """Every investment of investors whose name contains ``text``, with round and
    company (J5), newest first; the first ``k`` of them if given."""
    inv = investments.where(F.col("investor_name").contains(text)).select(
        "round_uuid", "investor_name", "is_lead", F.col("amount_usd").alias("invested_usd")
    )
    r = rounds.select("round_uuid", "org_uuid", "round_name", F.col("amount_usd").alias("round_amount"),
                      F.col("stage").alias("investment_stage"), "announced_on")
    o = orgs.select("org_uuid", F.col("name").alias("company_name"), "website")
    out = inv.join(r, "round_uuid").join(o, "org_uuid").select(
        "investor_name", "company_name", "website", "round_name",
        F.col("round_amount").cast("double").alias("round_amount"), "investment_stage", "announced_on",
        "is_lead", "round_uuid", "org_uuid",
    )
    out = out.orderBy(F.col("announced_on").desc_nulls_last(), "round_uuid", "investor_name")
    return out if k is None else out.limit(k)


def top_investors(investments: DataFrame, k: int = 20) -> DataFrame:
    """Investors by number of investments, with the total invested."""
    return (
        investments.where(F.col("investor_name").isNotNull())
        .groupBy("investor_name")
        .agg(F.count(F.lit(1)).alias("total_investments"),
             F.sum("amount_usd").cast("double").alias("total_invested_usd"))
        .orderBy(F.col("total_investments").desc(), F.col("investor_name"))
        .limit(k)
    )


def recent_rounds(rounds: DataFrame, orgs: DataFrame, since: dt.date, k: int = 100) -> DataFrame:
    """Rounds announced on or after ``since`` with valuations, newest first."""
    r = rounds.where(F.col("announced_on") >= F.lit(since))
    return (
        r.join(orgs.select("org_uuid", F.col("name").alias("company_name"), "website"), "org_uuid")
        .select(
            "company_name", "website", F.col("amount_usd").cast("double").alias("amount_raised"),
            F.col("post_money_usd").cast("double").alias("post_money_valuation"),
            F.col("pre_money_usd").cast("double").alias("pre_money_valuation"),
            F.col("stage").alias("investment_stage"), "announced_on", "round_uuid",
        )
        .orderBy(F.col("announced_on").desc_nulls_last(), "round_uuid")
        .limit(k)
    )


def top_funded(orgs: DataFrame, k: int = 10) -> DataFrame:
    """Companies with the largest known total funding."""
    return (
        orgs.where(F.col("funding_total_usd").isNotNull())
        .select("name", F.col("funding_total_usd").cast("double").alias("total_funding"),
                "num_funding_rounds", "org_uuid")
        .orderBy(F.col("total_funding").desc(), "org_uuid")
        .limit(k)
    )


def quarterly_trend(rounds: DataFrame, k: int = 20) -> DataFrame:
    """Total raised per quarter of ``closed_on``, newest quarters first.

    The published query labels every quarter of a year alike; the real
    ``"YYYY Qn"`` label is used here.
    """
    return (
        rounds.where(F.col("amount_usd").isNotNull() & F.col("closed_on").isNotNull())
        .groupBy(Q.quarter_label("closed_on").alias("quarter"))
        .agg(F.sum("amount_usd").cast("double").alias("total_funding"))
        .orderBy(F.col("quarter").desc())
        .limit(k)
    )


def category_export(orgs: DataFrame, text: str) -> DataFrame:
    """All funded companies in a category, most funded first (S13 input)."""
    return (
        orgs.where(F.col("categories").contains(text) & F.col("funding_total_usd").isNotNull())
        .select("name", "website", F.col("funding_total_usd").cast("double").alias("total_funding"),
                "num_funding_rounds", "org_uuid")
        .orderBy(F.col("total_funding").desc(), "org_uuid")
    )


def snapshot_counts(table: DataFrame, n: int = 3, date_col: str = "snapshot_date") -> DataFrame:
    """Row count of each of the newest ``n`` snapshots of a partitioned table.

    One grouped pass that reads the date column alone; the counts of all
    snapshots (one row each) are then cut to the newest.
    """
    return table.groupBy(date_col).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.col(date_col).desc()).limit(n)
