"""URL matching (J1) against a brute-force nested loop, plus plan checks."""

import re

from pyspark.sql import functions as F

from conftest import SF_SMALL
from roundbook.functions.urls import lookup_host
from roundbook.operators.match import match_hosts, match_urls
from roundbook.plans.checks import assert_no_nested_loop, assert_no_python_udf
from roundbook.sources import testviews as TV


def brute_force(hosts, orgs):
    """For each host: exact-normalised orgs first, then lowest uuid."""
    out = {}
    for h in set(hosts):
        if not h:
            continue
        best = None
        for uuid, w, wu in orgs:
            texts = [t.lower() for t in (w, wu) if t is not None]
            if any(h in t for t in texts):
                rank = 0 if any(re.fullmatch(r"(https?://)?(www\.)?" + re.escape(h) + "(/.*)?", t, re.DOTALL) for t in texts) else 1
                cand = (rank, uuid)
                best = cand if best is None or cand < best else best
        if best:
            out[h] = best[1]
    return out


def test_match_pages_vs_brute_force(spark):
    t = TV.load(spark, SF_SMALL)
    hosts_df = t["page_lookup"].select(lookup_host("url").alias("host"))
    got = {r["host"]: r["org_uuid"] for r in match_hosts(hosts_df, t["page_orgs"]).collect()}
    hosts = [r[0] for r in hosts_df.collect()]
    orgs = [tuple(r) for r in t["page_orgs"].select("org_uuid", "website", "website_url").collect()]
    assert got == brute_force(hosts, orgs)
    assert len(got) > 0


def test_match_tiers_and_hot_host(spark):
    # one very common host ("example.com") matched by every org, short hosts, exact beats lower uuid
    orgs = [(f"o{i:04d}", f"https://site{i}.example.com/", None) for i in range(300)]
    orgs += [("a0", "https://www.notalpha.com", None), ("z9", "https://alpha.com/", None), ("b1", None, "HTTP://X.IO/p")]
    hosts = ["example.com", "alpha.com", "x.io", "io", "a", "nosuch.org", "site7.example.com", "e.c"]
    odf = spark.createDataFrame(orgs, "org_uuid string, website string, website_url string")
    hdf = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = {r["host"]: r["org_uuid"] for r in match_hosts(hdf, odf).collect()}
    assert got == brute_force(hosts, orgs)
    assert got["alpha.com"] == "z9"  # exact beats the lower uuid a0


def test_match_urls_keeps_every_row(spark):
    odf = spark.createDataFrame([("o1", "https://alpha.com", None)], "org_uuid string, website string, website_url string")
    lk = spark.createDataFrame([(1, "alpha.com"), (2, ""), (3, None), (4, "https://"), (5, "alpha.com")], "id int, url string")
    got = sorted((r["id"], r["org_uuid"]) for r in match_urls(lk, odf).collect())
    assert got == [(1, "o1"), (2, None), (3, None), (4, None), (5, "o1")]


def test_match_plan_has_no_nested_loop_or_python(spark):
    t = TV.load(spark, SF_SMALL)
    df = match_urls(t["lookup"], t["organizations"], url_col="website")
    assert_no_nested_loop(df)
    assert_no_python_udf(df)


def test_filters_and_columns_reach_the_scan(spark):
    import datetime as dt

    from roundbook.operators.analytics import recent_rounds
    from roundbook.plans.checks import pushed_filters, read_schemas

    t = TV.load(spark, SF_SMALL)
    df = recent_rounds(t["funding_rounds"], t["organizations"], dt.date(1998, 1, 1))
    pushed = " ".join(pushed_filters(df))
    assert "o_orderdate" in pushed  # the date bound is pushed into the orders scan
    orders_schema = [s for s in read_schemas(df) if "o_orderkey" in s][0]
    assert "o_orderpriority" not in orders_schema  # unused columns are pruned


def test_url_index_gives_same_matches_and_bucketed_scan(spark, tmpdir_path):
    from roundbook.operators.match import build_url_index
    from roundbook.plans.checks import plan_text

    t = TV.load(spark, SF_SMALL)
    hosts = t["page_lookup"].select(lookup_host("url").alias("host"))
    idx = build_url_index(t["page_orgs"], "pages_test_idx", tmpdir_path, num_buckets=8)
    plain = {(r["host"], r["org_uuid"], r["exact"]) for r in match_hosts(hosts, t["page_orgs"]).collect()}
    indexed_df = match_hosts(hosts, t["page_orgs"], index=idx)
    assert {(r["host"], r["org_uuid"], r["exact"]) for r in indexed_df.collect()} == plain
    assert "Bucketed: true" in plan_text(indexed_df)


def test_short_unicode_hosts(spark):
    orgs = [("o1", "https://ü.de/", None), ("o2", "https://xü.de/a", None), ("o3", "https://ab.io", None)]
    hosts = ["ü", "xü", "ab", "b.i", "ö"]
    odf = spark.createDataFrame(orgs, "org_uuid string, website string, website_url string")
    hdf = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = {r["host"]: r["org_uuid"] for r in match_hosts(hdf, odf).collect()}
    assert got == brute_force(hosts, orgs)
    assert got["ü"] == "o1" and got["xü"] == "o2" and "ö" not in got


def test_hot_gram_moves_once(spark):
    """A host whose every gram is common, and hosts that all end alike: the org
    grams meet the chosen grams in one join, without a semi-join before it."""
    from roundbook.plans.checks import plan_text

    orgs = spark.range(3000).selectExpr(
        "concat('o', id) org_uuid", "concat('https://shop', id % 50, '.hotbrand.com/p', id) website",
        "cast(null as string) website_url")
    hosts = spark.createDataFrame([("hotbrand.com",), ("shop7.hotbrand.com",), ("nosuch.com",)], "host string")
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        df = match_hosts(hosts, orgs)
        got = {r["host"]: r["org_uuid"] for r in df.collect()}
        plan = plan_text(df)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    rows = [tuple(r) for r in orgs.collect()]
    assert got == brute_force(["hotbrand.com", "shop7.hotbrand.com", "nosuch.com"], rows)
    assert "LeftSemi" not in plan and "salt" not in plan


def test_index_spreads_a_hot_gram(spark, tmpdir_path):
    from roundbook.operators.match import build_url_index

    orgs = spark.range(600).selectExpr("concat('o', id) org_uuid", "concat('https://s', id, '.hotbrand.com/') website", "cast(null as string) website_url")
    index = build_url_index(orgs, "hot_index", tmpdir_path, num_buckets=4, salts=16)
    assert index.grams(spark).where("gram = 'hotb'").select("salt").distinct().count() > 8
    got = {r["host"]: r["org_uuid"] for r in match_hosts(spark.createDataFrame([("hotbrand.com",)], "host string"), orgs, index=index).collect()}
    assert got == {"hotbrand.com": "o0"}


def test_a_lookup_column_named_host_stays(spark):
    lookup = spark.createDataFrame([(1, "mine", "https://a.io/x"), (2, "own", None)], "row_id int, Host string, url string")
    orgs = spark.createDataFrame([("o1", "http://a.io", None)], "org_uuid string, website string, website_url string")
    got = [tuple(r) for r in match_urls(lookup, orgs).orderBy("row_id").collect()]
    assert got == [(1, "mine", "https://a.io/x", "a.io", "o1"), (2, "own", None, None, None)]


def test_common_grams_grow_until_they_are_rare(spark):
    """URLs and hosts over two letters: every 4-gram is common to nearly all URLs."""
    import random

    from roundbook.operators.match import _gram_counts, _org_grams, build_url_index, gram_candidates, org_texts

    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("ab") for _ in range(n))
    orgs = [(f"o{i:04d}", f"http://{word(24)}/", None) for i in range(120)]
    hosts = sorted({word(rng.randint(4, 9)) for _ in range(200)} | {o[1][7:16] for o in orgs[:50]} | {"a" * 20, "http", "abab"})
    odf = spark.createDataFrame(orgs, "org_uuid string, website string, website_url string")
    hdf = spark.createDataFrame([(h,) for h in hosts], "host string")
    want = brute_force(hosts, orgs)
    for most in (10, None):
        assert {r["host"]: r["org_uuid"] for r in match_hosts(hdf, odf, max_urls=most).collect()} == want
    grams = _org_grams(org_texts(odf), 4)
    pairs = {most: gram_candidates(hdf, grams, _gram_counts(grams), 4, max_urls=most).groupBy("host").count().collect() for most in (10, 10**9)}
    places = {h: sum(o[1].startswith(h, i) for o in orgs for i in range(len(o[1]))) for h in hosts}
    assert all(r["count"] <= max(10, places[r["host"]]) for r in pairs[10])
    assert sum(r["count"] for r in pairs[10]) * 3 < sum(r["count"] for r in pairs[10**9])


def test_index_and_delta_equal_a_rebuild(spark, tmpdir_path):
    """Inserts, changes and deletes, and a URL that goes and comes back."""
    from roundbook.operators.match import build_url_index, update_url_index

    schema = "org_uuid string, website string, website_url string"
    first = [(f"o{i}", f"https://site{i}.example.com/", f"http://other{i}.net" if i % 3 else None) for i in range(40)]
    second = [(u, w if int(u[1:]) % 5 else w.replace("site", "moved"), x) for u, w, x in first if int(u[1:]) % 7] + [("n1", "https://fresh.io", "https://fresh.io"), ("n2", None, None)]
    third = [r for r in first if int(r[0][1:]) % 4] + [("n1", "https://fresh.io/a", None)]
    frames = [spark.createDataFrame(r, schema) for r in (first, second, third)]
    hosts = spark.createDataFrame([(h,) for h in [*(f"site{i}.example.com" for i in range(40)), *(f"moved{i}" for i in range(40)), "other8.net", "fresh.io", "example.com", "io"]], "host string")
    index = build_url_index(frames[0], "delta_idx", tmpdir_path, num_buckets=4, salts=2)
    old = index
    for n, orgs in enumerate(frames[1:], 1):
        index = update_url_index(index, orgs)
        anew = build_url_index(orgs, f"anew_idx{n}", tmpdir_path, num_buckets=4, salts=2)
        for part in ("texts", "grams", "df"):
            a, b = (sorted(map(str, getattr(i, part)(spark).select(sorted(getattr(anew, part)(spark).columns)).collect())) for i in (index, anew))
            assert a == b and len(a) > 20, part
        got = {r["host"]: r["org_uuid"] for r in match_hosts(hosts, orgs, index=index).collect()}
        assert got == brute_force([r["host"] for r in hosts.collect()], [tuple(r) for r in orgs.collect()])
    assert old.texts(spark).count() == sum(2 if x else 1 for _, _, x in first)  # reads as it was
    assert spark.table("delta_idx_grams_v1").count() < spark.table("delta_idx_grams_v0").count()
