"""Company report for many URLs at once: listing, summary, rounds by type.

The reference prints one company's report; here the same three results are
DataFrames for a whole lookup list, keyed by the lookup host.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as TX
from ..functions.urls import lookup_host
from ..plans.config import ensure_checkpoint_dir
from . import funding as FD
from .match import GRAM, match_hosts

PARTS = ("companies", "rounds", "summary", "by_type")


def company_report(lookup: DataFrame, orgs: DataFrame, rounds: DataFrame, url_col: str = "url",
                   k: int = GRAM, parts: tuple[str, ...] = PARTS) -> dict[str, DataFrame]:
    """``{"companies", "rounds", "summary", "by_type"}`` for every matched host
    (only the requested ``parts`` are built).

    * companies — ``(host, org_uuid, name, website)``; website falls back to
      ``website_url`` when blank (P4);
    * rounds — listing with position and display amounts (O1, C10);
    * summary — round counts and total (A6, A1);
    * by_type — count per non-blank investment type, ranked (A5).
    """
    hosts = lookup.select(lookup_host(url_col).alias("host"))
    found = match_hosts(hosts, orgs, k=k).select("host", "org_uuid")
    if len(parts) > 1:  # all parts read one match
        ensure_checkpoint_dir(lookup.sparkSession)
        found = found.checkpoint(eager=True)
    ids = found.select("org_uuid").distinct()
    m_rounds = rounds.join(ids, "org_uuid", "left_semi")
    out: dict[str, DataFrame] = {}
    if "companies" in parts:
        site = F.coalesce(F.when(TX.nonblank("website"), F.col("website")), F.col("website_url"))
        out["companies"] = found.join(orgs.select("org_uuid", "name", site.alias("website")), "org_uuid")
    if "rounds" in parts:
        listing = FD.rounds_listing(m_rounds, sizes=rounds).select(
            "org_uuid", "pos", "round_uuid", "round_name", "announced_on", "closed_on",
            TX.format_currency("amount_usd").alias("amount_text"),
            "investment_type", "stage", "num_investors",
            F.when(TX.nonzero("post_money_usd"), TX.format_currency("post_money_usd")).alias("post_money_text"),
            F.when(TX.nonzero("pre_money_usd"), TX.format_currency("pre_money_usd")).alias("pre_money_text"),
            "short_description",
        )
        out["rounds"] = found.join(listing, "org_uuid")
    if "summary" in parts:
        out["summary"] = found.join(FD.funding_summary(m_rounds), "org_uuid")
    if "by_type" in parts:
        out["by_type"] = found.join(FD.rounds_by_type(m_rounds), "org_uuid")
    return out
