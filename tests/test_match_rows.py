"""The registered URL matching answers for every lookup row, matched or not."""

import pathlib
import shutil

import duckdb
from pyspark.sql import functions as F
from test_match import brute_force

import __spark_entry__ as E
from conftest import SF_SMALL
from roundbook.functions.urls import lookup_host
from roundbook.operators.match import match_urls
from roundbook.sources.testviews import TABLES
from scripts.oracle_check import norm_frame

PAGES = [
    (1, "http://www.alpha.example.com/a"),
    (2, "https://m.alpha.example.com/b"),  # its second lookup row has a host that others have
    (3, "https://beta.example.org/"),
    (4, "https://beta.example.org/"),  # a URL that repeats
    (5, "https:///nohost"),
    (6, "  "),
    (7, ""),
    (8, None),
    (9, "x.y/z"),
]


def test_match_urls_answers_for_every_lookup_row(spark, tmpdir_path):
    d = pathlib.Path(tmpdir_path)
    for table in TABLES:
        if table != "pages":
            shutil.copy(f"{SF_SMALL}/{table}.parquet", d)
    pages = spark.createDataFrame(PAGES, "page_id long, url string").withColumn("html", F.lit("<p>x</p>"))
    pages.write.parquet(f"{d}/pages.parquet")
    got = E.queries()["match_urls"](spark, str(d)).toPandas()
    lookup = [tuple(r) for r in spark.table("page_lookup").select("row_id", "url", lookup_host("url")).collect()]
    best = brute_force([h for *_, h in lookup], [tuple(r) for r in spark.table("page_orgs").select("org_uuid", "website", "website_url").collect()])
    assert len(lookup) == 2 * len(PAGES)
    want = {(i, url, h, best.get(h)) for i, url, h in lookup}
    rows = {tuple(None if v != v else v for v in r) for r in got[["row_id", "url", "host", "org_uuid"]].itertuples(index=False, name=None)}
    assert len(got) == len(lookup) and rows == want
    assert any(h is None for *_, h, _ in want) and {i for i, *_, o in want if o is None} and {i for i, *_, o in want if o}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{d}/pages.parquet/*.parquet')")
    assert norm_frame(con.execute(E.oracle_sql()["match_urls"]).df()) == norm_frame(got)


def test_lookup_rows_of_one_host_are_joined_by_many_tasks(spark):
    """Most rows have one host; the join's shuffle is split where neither side is broadcast."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    lookup = spark.range(0, 40000, 1, 16).selectExpr("id", "if(id % 9 = 0, concat('http://s', id % 50, '.org/', id), concat('http://hot.example.com/', id)) url")
    orgs = spark.createDataFrame([("o1", "https://hot.example.com", None), *((f"s{i}", f"http://s{i}.org", None) for i in range(50))], "org_uuid string, website string, website_url string")
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        got = match_urls(lookup, orgs).withColumn("task", F.spark_partition_id()).toPandas()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(got) == 40000
    hot = got[got["host"] == "hot.example.com"]
    assert len(hot) == sum(i % 9 > 0 for i in range(40000)) and set(hot["org_uuid"]) == {"o1"}
    assert hot["task"].nunique() > 1
