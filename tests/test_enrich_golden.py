"""Hand-computed golden fixture for the bulk enrichment."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from roundbook.operators import funding as FD
from roundbook.operators.enrich import INFO_COLS, enrich
from roundbook.operators.report import company_report

AS_OF = dt.date(2021, 5, 10)
D = dt.date


@pytest.fixture(scope="module")
def golden(spark):
    orgs = spark.createDataFrame(
        [
            ("o1", "Alpha", "https://www.alpha.com/", None, D(2020, 3, 15)),
            ("o2", "NotAlpha", "https://notalpha.com", None, D(2020, 1, 1)),
            ("o3", "Beta", None, "http://shop.beta.io/x", None),
            ("o4", "Gamma", "https://gamma.dev", None, D(2022, 1, 1)),
        ],
        "org_uuid string, name string, website string, website_url string, founded_on date",
    )
    for c, t in [("description", "string"), ("short_description", "string"), ("categories", "string"),
                 ("category_groups", "string"), ("location", "string"), ("funding_stage", "string"),
                 ("investor_stage", "string"), ("num_funding_rounds", "bigint"), ("num_investors", "bigint")]:
        orgs = orgs.withColumn(c, F.lit(None).cast(t))
    rounds = spark.createDataFrame(
        [
            ("r1", "o1", "Seed", D(2020, 4, 1), None, 1000000),
            ("r2", "o1", "A", D(2020, 6, 20), D(2020, 7, 2), 2500000),
            ("r3", "o1", "Grant", D(2020, 8, 1), None, 0),
            ("r4", "o1", "B", D(2021, 4, 5), None, 500),
            ("r5", "o3", None, None, None, 700),
        ],
        "round_uuid string, org_uuid string, round_name string, announced_on date, closed_on date, amount_usd long",
    ).selectExpr(
        "round_uuid", "org_uuid", "round_name", "announced_on", "closed_on",
        "cast(amount_usd as decimal(20,2)) amount_usd", "cast(null as string) investment_type", "cast(null as string) stage",
        "cast(null as decimal(20,2)) post_money_usd", "cast(null as decimal(20,2)) pre_money_usd",
        "cast(null as string) short_description", "cast(null as bigint) num_investors",
    )
    inv = spark.createDataFrame(
        [("r2", "Zed", True, None), ("r2", "Abe", None, 500000), ("r2", None, False, None)],
        "round_uuid string, investor_name string, is_lead boolean, amount_usd long",
    ).withColumn("amount_usd", F.col("amount_usd").cast("decimal(20,2)"))
    lookup = spark.createDataFrame(
        [(0, "alpha.com"), (1, "https://www.beta.io/"), (2, "gamma.dev"), (3, "HTTPS://ALPHA.COM"),
         (4, "https://"), (5, "nosuch.org"), (6, "")],
        "__row_id long, Website string",
    )
    return orgs, rounds, inv, lookup


def test_enrich_golden(spark, golden):
    orgs, rounds, inv, lookup = golden
    out = enrich(lookup, orgs, rounds, inv, AS_OF)
    cols = out.columns
    assert cols[:5] == ["__row_id", "Website", *INFO_COLS]
    quarters = cols[5:]
    assert quarters[0] == "2021 Q2" and quarters[-1] == "1900 Q1" and len(quarters) == (2021 - 1900) * 4 + 2
    rows = {r["__row_id"]: r for r in out.collect()}
    a = rows[0]
    assert a["Company Information"] == "Name: Alpha | Founded: 2020-03-15"
    assert a["Investment Rounds and Funding Information"] == (
        "[B] Announced: 2021-04-05 Amount: $500 | [Grant] Announced: 2020-08-01 | "
        "[A] Announced: 2020-06-20 Closed: 2020-07-02 Amount: $2,500,000 Investors: Zed (Lead), Unknown, Abe ($500,000) | "
        "[Seed] Announced: 2020-04-01 Amount: $1,000,000"
    )
    assert a["Total Funding to Date"] == 3500500
    assert a["2020 Q2"] == 1000000 and a["2020 Q3"] == 2500000 and a["2021 Q2"] == 500
    assert a["2020 Q1"] is None
    assert rows[3]["Total Funding to Date"] == 3500500  # upper-case URL finds Alpha
    b = rows[1]
    assert b["Company Information"] == "Name: Beta | Founded: 1900-01-01"
    assert b["Investment Rounds and Funding Information"] == "[None] Amount: $700"
    assert b["Total Funding to Date"] == 700
    g = rows[2]
    assert g["Company Information"] == "Name: Gamma | Founded: 2022-01-01" and g["Total Funding to Date"] is None
    for i in (4, 5, 6):
        assert rows[i]["Company Information"] is None and rows[i]["Total Funding to Date"] is None


def test_enrich_alpha_alone_drops_uncovered_quarter(spark, golden):
    orgs, rounds, inv, lookup = golden
    out = enrich(lookup.where("__row_id = 0"), orgs, rounds, inv, AS_OF)
    assert out.columns[5:] == ["2021 Q1", "2020 Q4", "2020 Q3", "2020 Q2", "2020 Q1"]
    r = out.first()
    assert r["Total Funding to Date"] == 3500500 and r["2020 Q3"] == 2500000


def test_oldest_year_filter(spark, golden):
    orgs, *_ = golden
    m = orgs.where("org_uuid in ('o1', 'o3')")
    assert FD.quarter_axis(m, AS_OF, 2021) == ["2021 Q2", "2021 Q1"]
    full = FD.quarter_axis(m, AS_OF)
    assert FD.quarter_axis(m, AS_OF, 2030) == full
    assert FD.quarter_axis(m, AS_OF, "abc") == full
    frame = [r["quarter"] for r in FD.axis_frame(m, AS_OF, 2021).orderBy("quarter").collect()]
    assert frame == ["2021 Q1", "2021 Q2"]


def test_no_match_gives_no_quarter_columns(spark, golden):
    orgs, rounds, inv, lookup = golden
    out = enrich(lookup.where("__row_id >= 4"), orgs, rounds, inv, AS_OF)
    assert out.columns == ["__row_id", "Website", *INFO_COLS]
    assert out.count() == 3


def test_company_report(spark, golden):
    orgs, rounds, _, lookup = golden
    rep = company_report(lookup.withColumnRenamed("Website", "url"), orgs, rounds)
    listing = [(r["pos"], r["round_uuid"], r["amount_text"]) for r in rep["rounds"].where("host = 'alpha.com'").orderBy("pos").collect()]
    assert listing == [(1, "r4", "$500.00"), (2, "r3", "$0.00"), (3, "r2", "$2.50M"), (4, "r1", "$1.00M")]
    s = rep["summary"].where("host = 'alpha.com'").first()
    assert (s["n_rounds"], s["n_rounds_with_amount"], s["total_funding_text"]) == (4, 3, "$3.50M")
    site = rep["companies"].where("host = 'beta.io'").first()["website"]
    assert site == "http://shop.beta.io/x"
