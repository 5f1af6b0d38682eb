"""URL matching: the work for common grams grows with URLs and hosts, not their product."""

import random

from test_match import brute_force

from roundbook.operators.match import _gram_counts, _org_grams, gram_candidates, match_hosts, org_texts

URLS = "org_uuid string, website string, website_url string"


def words(seed, n, length):
    rng = random.Random(seed)
    return ["".join(rng.choice("ab") for _ in range(length)) for _ in range(n)]


def jobs_of(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setJobGroup("other", "other")


def test_hosts_with_common_grams_meet_only_urls_that_contain_them(spark):
    """Every gram is in far more than 100 URLs; ten thousand was the limit before."""
    orgs = [(f"o{i}", f"http://{w}/", None) for i, w in enumerate(words(1, 1500, 14))]
    hosts = sorted({o[1][7:19] for o in orgs[:300]})
    grams = _org_grams(org_texts(spark.createDataFrame(orgs, URLS)), 4)
    hdf = spark.createDataFrame([(h,) for h in hosts], "host string")
    places = sum(sum(o[1].startswith(h, i) for o in orgs for i in range(7, 11)) for h in hosts)
    assert gram_candidates(hdf, grams, _gram_counts(grams), 4).count() == places < 5 * len(hosts)


def test_a_long_common_host_takes_no_more_jobs_than_a_short_one(spark):
    def run(length):
        host = "a" * length + ".com"
        orgs = spark.createDataFrame([(f"o{i}", f"http://{host}/{i}", None) for i in range(200)], URLS)
        hdf = spark.createDataFrame([(host,)], "host string")
        assert match_hosts(hdf, orgs, max_urls=10).first()["org_uuid"] == "o0"

    assert jobs_of(spark, "match-long", lambda: run(40)) <= jobs_of(spark, "match-short", lambda: run(6)) + 1


def test_no_broadcast_gives_the_same_matches(spark):
    """Grams, shapes and hosts joined through Bloom filters; texts that repeat, ids that are null."""
    orgs = [(f"o{i % 90:03d}", f"http://{w}/", f"https://www.{w[::-1]}.ü/" if i % 3 else None) for i, w in enumerate(words(2, 150, 12) * 2)]
    hosts = [*words(3, 60, 5), *(o[1][7:17] for o in orgs[:40]), "aba", "ü", "abab", "", None, "nosuch.org", orgs[0][1][7:-1]]
    odf, hdf = spark.createDataFrame(orgs, URLS), spark.createDataFrame([(h,) for h in hosts], "host string")
    want = brute_force(hosts, orgs)
    for most, limit in ((5, 0), (5, None), (10**9, 0), (None, 0)):
        assert {r["host"]: r["org_uuid"] for r in match_hosts(hdf, odf, max_urls=most, broadcast_rows=limit).collect()} == want
    null = match_hosts(hdf, odf.unionByName(spark.createDataFrame([(None, orgs[0][1], None)], URLS))).where(f"host = '{orgs[0][1][7:-1]}'").first()
    assert null["org_uuid"] is None and null["exact"]
