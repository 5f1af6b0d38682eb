"""One company with a third of all rounds, one round with a third of all
investments, one URL on a third of the lookup rows: the texts must
equal those put together in plain Python."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from roundbook.operators.enrich import enrich

AS_OF = dt.date(2002, 1, 1)


@pytest.fixture(scope="module")
def skewed(spark):
    n_orgs, n_rounds, n_inv = 60, 900, 2700
    orgs = spark.range(n_orgs).selectExpr(
        "concat('o', lpad(cast(id as string), 3, '0')) org_uuid", "concat('Org ', id) name",
        "concat('https://org', id, '.example.com/') website", "cast(null as string) website_url",
        "date_add(date'1998-01-01', cast(id * 7 as int)) founded_on",
        *[f"cast(null as {t}) {c}" for c, t in [
            ("description", "string"), ("short_description", "string"), ("categories", "string"),
            ("category_groups", "string"), ("location", "string"), ("funding_stage", "string"),
            ("investor_stage", "string"), ("num_funding_rounds", "bigint"), ("num_investors", "bigint")]],
    )
    # a third of the rounds belong to o000
    rounds = spark.range(n_rounds).selectExpr(
        "concat('r', lpad(cast(id as string), 4, '0')) round_uuid",
        f"CASE WHEN id % 3 = 0 THEN 'o000' ELSE concat('o', lpad(cast(id % {n_orgs} as string), 3, '0')) END org_uuid",
        "concat('Round ', id) round_name", "date_add(date'1999-01-01', cast(id % 700 as int)) announced_on",
        "CASE WHEN id % 2 = 0 THEN date_add(date'1999-01-20', cast(id % 700 as int)) END closed_on",
        "cast(1000 + id * 10 as decimal(20,2)) amount_usd", "'Seed' investment_type", "cast(null as string) stage",
        "cast(null as decimal(20,2)) post_money_usd", "cast(null as decimal(20,2)) pre_money_usd",
        "cast(null as string) short_description", "cast(null as bigint) num_investors",
    )
    # a third of the investments go to round r0000 (owned by o000)
    inv = spark.range(n_inv).selectExpr(
        f"CASE WHEN id % 3 = 0 THEN 'r0000' ELSE concat('r', lpad(cast(id % {n_rounds} as string), 4, '0')) END round_uuid",
        "concat('Inv ', id % 97) investor_name", "CASE WHEN id % 5 = 0 THEN true WHEN id % 5 = 1 THEN false END is_lead",
        "CASE WHEN id % 4 = 0 THEN NULL ELSE cast(id as decimal(20,2)) END amount_usd",
    )
    # a third of the lookup rows carry the same URL
    lookup = spark.range(600).selectExpr(
        "id __row_id",
        f"CASE WHEN id % 3 = 0 THEN 'https://org0.example.com/x' ELSE concat('org', id % {n_orgs}, '.example.com') END Website",
    )
    return orgs, rounds, inv, lookup


def test_hot_groups_are_whole_and_ordered(spark, skewed):
    orgs, rounds, inv, lookup = skewed
    rows = sorted(enrich(lookup, orgs, rounds, inv, AS_OF).collect())
    assert len(rows) == 600
    hot = [r for r in rows if r["__row_id"] == 0][0]
    text = hot["Investment Rounds and Funding Information"]
    assert text.count(" | ") == 299  # 300 rounds of o000
    assert text.count("Inv ") == 900  # all of r0000
    mine = [r for r in rounds.collect() if r["org_uuid"] == "o000"]
    mine.sort(key=lambda r: (-r["announced_on"].toordinal(), -(r["closed_on"] or dt.date.min).toordinal(), r["round_uuid"]))
    assert [part.index(r["round_name"]) >= 0 for part, r in zip(text.split(" | "), mine)] == [True] * 300
    own = [r for r in inv.collect() if r["round_uuid"] == "r0000"]
    lead = {True: 0, False: 1, None: 2}
    own.sort(key=lambda r: (lead[r["is_lead"]], r["investor_name"]))
    names = re.findall(r"Inv \d+", text)
    assert names == [r["investor_name"] for r in own]


