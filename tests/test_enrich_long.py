"""enrich_long: each URL of the lookup list is normalised once."""

import datetime as dt

from roundbook.operators.enrich import enrich_long
from roundbook.plans.checks import plan_text


def test_urls_are_normalised_before_the_join_not_at_its_scan(spark):
    lookup = spark.createDataFrame([(1, "https://www.a.io/x"), (2, "b.io"), (2, "b.io"), (3, None), (None, "a.io")], "row_id int, site string")
    orgs = spark.createDataFrame([("o1", "http://a.io", None, None), ("o2", "http://b.io", None, dt.date(2000, 1, 1))], "org_uuid string, website string, website_url string, founded_on date")
    rounds = spark.createDataFrame([("o1", dt.date(2001, 2, 3), None, 5), ("o1", dt.date(2001, 3, 3), None, 6), ("o2", dt.date(2001, 2, 3), dt.date(2001, 4, 1), 7)],
                                   "org_uuid string, announced_on date, closed_on date, amount_usd int")
    df = enrich_long(lookup, orgs, rounds, dt.date(2002, 1, 1), "site", "row_id")
    got = sorted((str(r["row_id"]), r["org_uuid"], r["quarter"], r["amount"]) for r in df.collect())
    assert got == [("1", "o1", "2001 Q1", 11.0), ("2", "o2", "2001 Q2", 7.0), ("2", "o2", "2001 Q2", 7.0), ("None", "o1", "2001 Q1", 11.0)]
    assert "https?" not in plan_text(df)
