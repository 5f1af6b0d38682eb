"""Ingest, manifest, archive and lookup sources on small files made in a temp folder."""

import datetime as dt
import json
import os
import zipfile

import pytest

from roundbook.sources import archives as AR
from roundbook.sources import ingest as IN
from roundbook.sources.collections import COLLECTIONS
from roundbook.sources.lookup import read_lookup, write_enriched

ORG_CSV = (
    'identifier.uuid,identifier.value,website,founded_on.value,funding_total.value_usd,num_funding_rounds,extra.col\n'
    'u1,"Alpha, Inc",https://alpha.com,2020-03-15,1000.50,2,x\n'
    'u2,Beta,,not-a-date,,,"multi\nline"\n'
)


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_read_collection_declared_types(spark, tmpdir_path):
    p = _write(os.path.join(tmpdir_path, "organizations.csv"), ORG_CSV)
    df = IN.read_collection(spark, p, "organizations")
    assert {"org_uuid", "name", "founded_on", "funding_total_usd", "extra_col"} <= set(df.columns)
    rows = {r["org_uuid"]: r for r in df.collect()}
    assert rows["u1"]["name"] == "Alpha, Inc"
    assert rows["u1"]["founded_on"] == dt.date(2020, 3, 15)
    assert rows["u2"]["founded_on"] is None  # a bad date becomes NULL, not an error
    assert float(rows["u1"]["funding_total_usd"]) == 1000.5
    assert rows["u2"]["extra_col"] == "multi\nline"


def test_snapshots_write_ignore_overwrite_latest(spark, tmpdir_path):
    wh = os.path.join(tmpdir_path, "wh")
    a = spark.createDataFrame([(1,), (2,)], "x int")
    b = spark.createDataFrame([(3,)], "x int")
    IN.write_snapshot(a, f"{wh}/t", dt.date(2024, 1, 1))
    IN.write_snapshot(b, f"{wh}/t", dt.date(2024, 1, 1))  # ignore: kept as is
    IN.write_snapshot(b, f"{wh}/t", dt.date(2024, 2, 1))  # a later snapshot is still written
    t = IN.read_table(spark, wh, "t")
    assert sorted(r["x"] for r in t.collect()) == [1, 2, 3]
    latest = IN.latest_snapshot(t)
    assert [r["x"] for r in latest.collect()] == [3]
    from roundbook.plans.checks import plan_text

    assert any("PartitionFilters" in ln and "Subquery" in ln for ln in plan_text(latest).splitlines())
    IN.write_snapshot(b, f"{wh}/t", dt.date(2024, 1, 1), mode="overwrite")
    assert sorted(r["x"] for r in IN.read_table(spark, wh, "t").collect()) == [3, 3]


def test_import_snapshot_reports_per_table(spark, tmpdir_path):
    good = _write(os.path.join(tmpdir_path, "organizations.x.csv"), ORG_CSV)
    res = IN.import_snapshot(
        spark, {"organizations": good, "jobs": os.path.join(tmpdir_path, "nope.csv")},
        os.path.join(tmpdir_path, "wh"), dt.date(2024, 5, 1),
    )
    got = {r["table"]: (r["status"], r["rows"]) for r in res.collect()}
    assert got["organizations"] == ("ok", 2)
    assert got["jobs"][0] == "failed"


def test_manifest_and_snapshot_date(spark, tmpdir_path):
    m = {
        "organizations": {"file": "o.zip", "last_modified": "2024-03-02T10:00:00+00:00", "content_length": "10", "downloaded_at": "x"},
        "acquisitions": {"file": "a.zip", "last_modified": "2024-03-01T09:00:00+00:00", "content_length": "", "downloaded_at": "x"},
    }
    p = _write(os.path.join(tmpdir_path, "manifest.json"), json.dumps(m, indent=2, sort_keys=True))
    man = IN.read_manifest(spark, p)
    assert man.count() == 2
    assert IN.snapshot_date_of(man, dt.date(2000, 1, 1)).first()[0] == dt.date(2024, 3, 1)
    bad = {"acquisitions": {"file": "a", "last_modified": "unknown", "content_length": "", "downloaded_at": ""}}
    p2 = _write(os.path.join(tmpdir_path, "m2.json"), json.dumps(bad))
    assert IN.snapshot_date_of(IN.read_manifest(spark, p2), dt.date(2000, 1, 1)).first()[0] == dt.date(2000, 1, 1)


def test_table_counts(spark):
    t = {"a": spark.range(5), "b": spark.range(0)}
    assert {r["table_name"]: r["n_rows"] for r in IN.table_counts(t).collect()} == {"a": 5, "b": 0}


@pytest.fixture()
def zips(tmpdir_path):
    zdir = os.path.join(tmpdir_path, "zips")
    os.makedirs(zdir)
    with zipfile.ZipFile(os.path.join(zdir, "organizations.zip"), "w") as z:
        z.writestr("organizations.csv", ORG_CSV)
    with zipfile.ZipFile(os.path.join(zdir, "funding_rounds.zip"), "w", zipfile.ZIP_STORED) as z:
        z.writestr("funding_rounds.csv", "identifier.uuid\nr1\n" * 50)
    # damage one member's bytes: the archive still opens, the CRC check fails
    raw = bytearray(open(os.path.join(zdir, "funding_rounds.zip"), "rb").read())
    i = raw.find(b"r1\nidentifier")
    raw[i] = ord("X")
    open(os.path.join(zdir, "funding_rounds.zip"), "wb").write(bytes(raw))
    with zipfile.ZipFile(os.path.join(zdir, "investments.zip"), "w") as z:
        z.writestr("readme.txt", "no csv here")
    open(os.path.join(zdir, "jobs.zip"), "wb").write(b"PK\x03\x04 truncated")
    with zipfile.ZipFile(os.path.join(zdir, "people.zip"), "w"):
        pass  # no entries
    open(os.path.join(zdir, "layoffs.zip"), "wb").close()  # zero bytes
    with zipfile.ZipFile(os.path.join(zdir, "not_a_collection.zip"), "w") as z:
        z.writestr("x.csv", "a\n1\n")
    return zdir


def test_audit_archives(spark, zips, tmpdir_path):
    m = {"organizations": {"file": "o", "last_modified": "", "content_length": "1", "downloaded_at": ""},
         "investments": {"file": "i", "last_modified": "", "content_length": "", "downloaded_at": ""}}
    p = _write(os.path.join(tmpdir_path, "manifest.json"), json.dumps(m))
    quick = {r["collection"]: r for r in AR.audit_archives(spark, zips, IN.read_manifest(spark, p)).collect()}
    assert len(quick) == len(COLLECTIONS)
    assert quick["organizations"]["status"] == "corrupted" and quick["organizations"]["issue"].startswith("size:1:")
    assert quick["investments"]["status"] == "valid"  # blank manifest size is not checked
    assert quick["funding_rounds"]["status"] == "valid"  # quick mode skips CRC
    assert quick["jobs"]["issue"] == "bad_format"
    assert quick["people"]["issue"] == "no_entries"
    assert quick["layoffs"]["status"] == "missing_or_empty"
    assert quick["acquisitions"]["status"] == "missing_or_empty"
    full = {r["collection"]: r for r in AR.audit_archives(spark, zips, full=True).collect()}
    assert full["funding_rounds"]["status"] == "corrupted" and full["funding_rounds"]["issue"] == "crc:funding_rounds.csv"
    assert full["organizations"]["status"] == "valid"


def test_extract_archives(spark, zips, tmpdir_path):
    out = os.path.join(tmpdir_path, "csv")
    res = {r["collection"]: r for r in AR.extract_archives(spark, zips, out, "2024-05-01").collect()}
    assert res["organizations"]["status"] == "extracted"
    name = os.path.basename(res["organizations"]["csv_path"])
    assert name.startswith("organizations.2024-05-01.") and len(name.split(".")[2]) == 8
    assert open(res["organizations"]["csv_path"]).read() == ORG_CSV
    assert res["investments"]["status"] == "failed" and res["jobs"]["status"] == "failed"
    again = {r["collection"]: r["status"] for r in AR.extract_archives(spark, zips, out, "2024-05-01").collect()}
    assert again["organizations"] == "skipped"
    summary = {r["status"]: r["n"] for r in AR.extraction_summary(AR.extract_archives(spark, zips, out, "2024-05-01")).collect()}
    assert summary["skipped"] >= 1
    tables = {r["table"]: r["path"] for r in IN.extracted_tables(spark, out).collect()}
    assert "organizations" in tables


def test_lookup_roundtrip(spark, tmpdir_path):
    p = _write(os.path.join(tmpdir_path, "in.csv"), 'Company,,Website\nA,x,alpha.com\nB,y\n"C, Ltd",z,"https://c.io/a"\n')
    lk = read_lookup(spark, p)
    assert lk.columns == ["Company", "Column_2", "Website", "__row_id"]
    rows = lk.orderBy("__row_id").collect()
    assert [r["Company"] for r in rows] == ["A", "B", "C, Ltd"]
    assert rows[1]["Website"] is None
    out = os.path.join(tmpdir_path, "out")
    write_enriched(lk, out)
    lines = []
    for f in sorted(x for x in os.listdir(out) if x.endswith(".csv")):
        part = open(os.path.join(out, f)).read().splitlines()
        lines += part if not lines else part[1:]  # one header per part file
    assert lines[0] == "Company,Column_2,Website"
    assert lines[1:] == ["A,x,alpha.com", "B,y,", '"C, Ltd",z,https://c.io/a']


def test_missing_collections(spark):
    present = spark.createDataFrame([("organizations",), ("funding_rounds",), ("not_a_collection",)], "collection string")
    missing = {r["collection"] for r in AR.missing_collections(spark, present).collect()}
    assert len(missing) == len(COLLECTIONS) - 2
    assert "organizations" not in missing and "investments" in missing


def test_export_csv(spark, tmpdir_path):
    from roundbook.sources.lookup import export_csv

    df = spark.createDataFrame([("a", 1.5), ("b", None)], "name string, total double")
    out = os.path.join(tmpdir_path, "exp")
    export_csv(df, out)
    back = spark.read.option("header", True).csv(out)
    assert sorted((r["name"], r["total"]) for r in back.collect()) == [("a", "1.5"), ("b", None)]


def test_import_export_end_to_end(spark, zips, tmpdir_path):
    m = {"acquisitions": {"file": "a", "last_modified": "2024-06-30T08:00:00+00:00", "content_length": "", "downloaded_at": ""}}
    man = _write(os.path.join(tmpdir_path, "manifest.json"), json.dumps(m))
    wh = os.path.join(tmpdir_path, "wh")
    res = IN.import_export(spark, zips, os.path.join(tmpdir_path, "csv"), man, wh, dt.date(2000, 1, 1))
    got = {r["table"]: (r["status"], r["rows"], r["snapshot_date"]) for r in res.collect()}
    assert got["organizations"] == ("ok", 2, dt.date(2024, 6, 30))
    orgs = IN.latest_snapshot(IN.read_table(spark, wh, "organizations"))
    assert sorted(r["org_uuid"] for r in orgs.collect()) == ["u1", "u2"]


def test_lookup_keeps_every_cell_and_name(spark, tmpdir_path):
    from roundbook.operators.enrich import enrich

    long_row = ",".join(f"x{i}" for i in range(120))
    p = _write(os.path.join(tmpdir_path, "wide.csv"), f'Name,URL,url\nA,a.com,b,extra1,"ex ""2"""\nB,b.com\n{long_row}\n')
    lk = read_lookup(spark, p)
    assert lk.columns[:5] == ["Name", "URL", "url_2", "Column_4", "Column_5"] and len(lk.columns) == 121
    rows = [tuple(r) for r in lk.orderBy("__row_id").collect()]
    assert rows[0][:6] == ("A", "a.com", "b", "extra1", 'ex "2"', None) and rows[2][:120] == tuple(f"x{i}" for i in range(120))
    folder = os.path.join(tmpdir_path, "two")
    os.makedirs(folder)
    for n in "ab":
        _write(os.path.join(folder, f"{n}.csv"), "Name,URL\nA,a.com\n")
    with pytest.raises(ValueError):
        read_lookup(spark, folder)


def test_money_and_quotes_survive_the_sinks(spark, tmpdir_path):
    import csv

    from roundbook.sources.lookup import export_csv

    df = spark.createDataFrame([(0, 'say "hi", ok', 12000000.0), (1, None, 0.5), (2, "x", None), (3, "y", 1234567890123.25)], "__row_id long, t string, total double")
    for write, name in ((write_enriched, "w"), (export_csv, "e")):
        out = os.path.join(tmpdir_path, name)
        write(df, out)
        got = []
        for f in sorted(x for x in os.listdir(out) if x.endswith(".csv")):
            with open(os.path.join(out, f), newline="") as fh:
                got += [r[-2:] for r in csv.reader(fh)][1:]
        assert sorted(got) == sorted([['say "hi", ok', "12000000.0"], ["", "0.5"], ["x", ""], ["y", "1234567890123.25"]])


def test_broken_archive_and_bad_values_are_reported(spark, zips, tmpdir_path):
    res = IN.import_export(spark, zips, os.path.join(tmpdir_path, "csv"), None, os.path.join(tmpdir_path, "wh"), dt.date(2024, 1, 2))
    failed = {r["table"]: r["error"] for r in res.collect() if r["status"] == "failed"}
    assert failed and all(failed.values())
    p = _write(os.path.join(tmpdir_path, "investments.csv"), "funding_round_identifier.uuid,investor_identifier.value,is_lead_investor,money_invested.value_usd\nr1,Zed,true,abc\nr2,Abe,perhaps,5\nr3,Bo,,\n")
    row = IN.import_snapshot(spark, {"investments": p}, os.path.join(tmpdir_path, "wh2"), dt.date(2024, 1, 2)).first()
    assert (row["status"], row["rows"], row["malformed"]) == ("ok", 3, 2)


def test_registered_collections(spark, tmpdir_path):
    wh = os.path.join(tmpdir_path, "wh")
    for day, n in ((1, 3), (2, 5)):
        for name in ("organizations", "people"):
            IN.write_snapshot(spark.range(n).withColumnRenamed("id", "n"), f"{wh}/{name}", dt.date(2024, 1, day))
    assert IN.snapshot_dates(spark, wh, "people") == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    assert sorted(IN.register_collections(spark, wh)) == ["organizations", "people"]
    assert spark.sql("SELECT count(*) FROM organizations").first()[0] == 5
    IN.register_collections(spark, wh, "2024-01-01")
    assert spark.sql("SELECT count(*) FROM people").first()[0] == 3
    IN.register_collections(spark, wh, None)
    assert spark.sql("SELECT count(*) FROM people").first()[0] == 8
    assert {r["table_name"]: r["n_rows"] for r in IN.warehouse_counts(spark, wh).collect()} == {"organizations": 5, "people": 5}


def test_joins_on_the_snapshot_date_prune_files_at_run_time(spark, tmpdir_path):
    """Ad-hoc SQL over all snapshots: the dates that a join leaves become a partition filter."""
    from roundbook.plans.checks import plan_text

    wh = os.path.join(tmpdir_path, "wh")
    for day in range(1, 6):
        IN.write_snapshot(spark.range(200 * day).withColumnRenamed("id", "n"), f"{wh}/funding_rounds", dt.date(2024, 1, day))
    IN.register_collections(spark, wh, None)
    dates = spark.createDataFrame([(dt.date(2024, 1, d), "odd" if d % 2 else "even") for d in range(1, 6)], "day date, kind string")
    dates.write.parquet(os.path.join(tmpdir_path, "dates"))
    spark.read.parquet(os.path.join(tmpdir_path, "dates")).createOrReplaceTempView("dates")
    df = spark.sql("SELECT r.snapshot_date, count(*) AS n FROM funding_rounds r JOIN dates d ON r.snapshot_date = d.day WHERE d.kind = 'even' GROUP BY r.snapshot_date")
    assert any("PartitionFilters" in line and "dynamicpruning" in line for line in plan_text(df).splitlines())
    assert sorted(tuple(r) for r in df.collect()) == [(dt.date(2024, 1, 2), 400), (dt.date(2024, 1, 4), 800)]


def test_table_counts_read_no_column(spark, tmpdir_path):
    from roundbook.plans.checks import read_schemas

    spark.range(70).selectExpr("id", "id * 2 AS twice").write.parquet(f"{tmpdir_path}/a")
    spark.range(0).write.parquet(f"{tmpdir_path}/b")
    counts = IN.table_counts({"a": spark.read.parquet(f"{tmpdir_path}/a"), "b": spark.read.parquet(f"{tmpdir_path}/b")})
    assert {r["table_name"]: r["n_rows"] for r in counts.collect()} == {"a": 70, "b": 0}
    assert read_schemas(counts) and all(line.endswith("struct<>") for line in read_schemas(counts))
