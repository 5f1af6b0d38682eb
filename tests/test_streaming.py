"""File-source streams driven to completion with an availableNow trigger."""

import datetime as dt
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from roundbook.streaming.incremental import enrich_stream, read_quarters, snapshot_stream
from test_enrich_golden import AS_OF, golden  # noqa: F401  (fixture)


def test_enrich_stream(spark, golden, tmpdir_path):  # noqa: F811
    orgs, rounds, inv, _ = golden
    landing = os.path.join(tmpdir_path, "landing")
    os.makedirs(landing)
    with open(os.path.join(landing, "a.csv"), "w") as f:
        f.write("Name,Website\nA,alpha.com\nB,https://www.beta.io/\nN,nosuch.org\n")
    schema = T.StructType([T.StructField("Name", T.StringType()), T.StructField("Website", T.StringType())])
    out = os.path.join(tmpdir_path, "out")
    q = enrich_stream(spark, landing, schema, "Website", orgs, rounds, inv, AS_OF, out,
                      os.path.join(tmpdir_path, "ckpt"))
    q.awaitTermination(300)
    rows = {r["Name"]: r for r in spark.read.parquet(f"{out}/rows").collect()}
    assert rows["A"]["total_funding"] == 3500500 and rows["N"]["org_uuid"] is None
    quarters = spark.read.parquet(f"{out}/quarters").where("Name = 'A'")
    assert {r["quarter"]: r["amount"] for r in quarters.collect()} == {"2020 Q2": 1e6, "2020 Q3": 2.5e6, "2021 Q2": 500.0}


def test_snapshot_stream(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "csv")
    os.makedirs(landing)
    with open(os.path.join(landing, "investments.2024-05-01.abcdef12.csv"), "w") as f:
        f.write("funding_round_identifier.uuid,investor_identifier.value,is_lead_investor,money_invested.value_usd\n"
                "r1,Zed,true,100\nr2,Abe,false,\n")
    header = ["funding_round_identifier.uuid", "investor_identifier.value", "is_lead_investor", "money_invested.value_usd"]
    wh = os.path.join(tmpdir_path, "wh")
    q = snapshot_stream(spark, landing, "investments", header, wh, os.path.join(tmpdir_path, "ckpt"))
    q.awaitTermination(300)
    t = spark.read.parquet(f"{wh}/investments")
    assert t.count() == 2
    assert t.select(F.max("snapshot_date")).first()[0] == dt.date(2024, 5, 1)
    assert set(t.columns) >= {"round_uuid", "investor_name", "is_lead", "amount_usd", "snapshot_date"}


def test_enrich_stream_restart_is_exactly_once(spark, golden, tmpdir_path):  # noqa: F811
    orgs, rounds, inv, _ = golden
    landing, out, ckpt = (os.path.join(tmpdir_path, d) for d in ("landing", "out", "ckpt"))
    os.makedirs(landing)
    schema = T.StructType([T.StructField("Name", T.StringType()), T.StructField("Website", T.StringType())])
    with open(os.path.join(landing, "a.csv"), "w") as f:
        f.write("Name,Website\nA,alpha.com\n")

    def run():
        enrich_stream(spark, landing, schema, "Website", orgs, rounds, inv, AS_OF, out, ckpt).awaitTermination(300)
        return sorted(r["Name"] for r in spark.read.parquet(f"{out}/rows").collect())

    assert run() == ["A"]
    assert run() == ["A"]  # restart: committed file not processed again
    with open(os.path.join(landing, "b.csv"), "w") as f:
        f.write("Name,Website\nB,gamma.dev\n")
    assert run() == ["A", "B"]  # only the new file


def test_quarters_do_not_depend_on_the_batches(spark, golden, tmpdir_path):  # noqa: F811
    orgs, rounds, inv, _ = golden
    schema = T.StructType([T.StructField("Name", T.StringType()), T.StructField("Website", T.StringType())])
    lines = ["A,alpha.com", "B,https://www.beta.io/", "G,gamma.dev"]
    seen = []
    for run, files in (("one", [lines]), ("each", [[x] for x in lines])):
        landing, out, ckpt = (os.path.join(tmpdir_path, run, d) for d in ("landing", "out", "ckpt"))
        os.makedirs(landing)
        for i, own in enumerate(files):
            with open(os.path.join(landing, f"{i}.csv"), "w") as f:
                f.write("Name,Website\n" + "\n".join(own) + "\n")
            enrich_stream(spark, landing, schema, "Website", orgs, rounds, inv, AS_OF, out, ckpt).awaitTermination(300)
        seen.append(sorted(tuple(r) for r in read_quarters(spark, out, orgs, AS_OF).select("Name", "quarter", "amount").collect()))
    assert seen[0] == seen[1] and seen[0]
