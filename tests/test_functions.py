"""Scalar Column functions against hand-worked values, and their invariants."""

import datetime as dt
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roundbook.functions import quarters as Q
from roundbook.functions import text as TX
from roundbook.functions.urls import (
    AmbiguousUrlColumn,
    NoUrlColumn,
    clean_header,
    find_url_column,
    lookup_host,
    normalize_url,
)


def _eval(spark, col_fn, values, typ):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(col_fn(F.col("x"))).collect()]


# ---- C1 ---------------------------------------------------------------------
HOSTS = {
    "tesla.com": "tesla.com",
    "www.tesla.com": "tesla.com",
    "https://tesla.com": "tesla.com",
    "https://www.tesla.com": "tesla.com",
    "tesla.com/": "tesla.com",
    "tesla.com//": "tesla.com",
    "tesla.com/a/b": "tesla.com",
    "tesla.com:8080/a": "tesla.com:8080",
    "tesla.com?x=1": "tesla.com?x=1",
    "HTTPS://WWW.Tesla.COM/x": "tesla.com",
    "http://m.blog.example.org/en/1#top": "m.blog.example.org",
    "ftp://x.org/a": "ftp:",
    "https://": "",
    "www.": "",
    "/": "",
    "": "",
    None: None,
}


def test_normalize_url_values(spark):
    assert _eval(spark, normalize_url, list(HOSTS), "string") == list(HOSTS.values())


def test_lookup_host_blank_and_empty(spark):
    got = _eval(spark, lookup_host, ["  ", "", None, "https://", "/", " tesla.com "], "string")
    assert got == [None, None, None, None, None, "tesla.com"]


@settings(max_examples=40, deadline=None)
@given(st.from_regex(r"[a-c0-9][a-c0-9.:?#_%-]{0,12}", fullmatch=True), st.sampled_from(["", "/", "//", "/a", "/a/b?c", "/www.x"]))
def test_all_spellings_give_one_host(spark, host, path):
    spellings = [f"{scheme}{www}{host}{path}" for scheme in ("", "http://", "https://", "HTTP://") for www in ("", "www.", "WWW.")]
    assert set(_eval(spark, normalize_url, spellings, "string")) == {host}


# ---- C3/C4 ------------------------------------------------------------------
def test_find_url_column_documented_headers():
    assert find_url_column(["Company", "URL", "Notes"]) == 1
    assert find_url_column(["Name", "Website"]) == 1
    assert find_url_column(["domain"]) == 0
    assert find_url_column(["Name", "Website_URL", "Industry"]) == 1
    assert find_url_column(["Firm", "Stage"]) == 0
    # two candidates, exactly one names url/website
    assert find_url_column(["Company", "Website", "Site"]) == 1
    with pytest.raises(AmbiguousUrlColumn):
        find_url_column(["Site", "Web"])
    with pytest.raises(NoUrlColumn):
        find_url_column(["Name", "Stage"])


def test_clean_header():
    assert clean_header([" a ", "", None, "   "]) == ["a", "Column_2", "Column_3", "Column_4"]


# ---- C5-C7 ------------------------------------------------------------------
LABELS = {
    "2025 Q1": (2025, 1),
    "1999 Q4x": (1999, 4),
    "Q4-25": (2025, 4),
    "Q1-50": (2050, 1),
    "Q1-51": (1951, 1),
    "Q2-99": (1999, 2),
    "Q3-2025": (3925, 3),
    "garbage": (0, 0),
    "": (0, 0),
}


def test_parse_quarter(spark):
    got = _eval(spark, lambda c: Q.parse_quarter(c), list(LABELS), "string")
    assert [(r["year"], r["q"]) for r in got] == list(LABELS.values())


@settings(max_examples=30, deadline=None)
@given(st.dates(dt.date(1900, 1, 1), dt.date(2100, 1, 1)))
def test_quarter_label_round_trip(spark, day):
    row = spark.createDataFrame([(day,)], "d date").select(Q.quarter_label(F.col("d")).alias("l")).select("l", Q.parse_quarter(F.col("l")).alias("p")).first()
    assert (row["p"]["year"], row["p"]["q"]) == (day.year, {1: 1, 2: 1, 3: 1, 4: 2, 5: 2, 6: 2, 7: 3, 8: 3, 9: 3}.get(day.month, 4))


# start, end, first and last quarter, number of quarters
SERIES = [
    ("2020-05-05", "2020-05-05", "2020 Q2", "2020 Q2", 1),
    ("2020-05-20", "2020-05-03", None, None, 0),
    ("2020-01-31", "2021-02-01", "2020 Q1", "2021 Q1", 5),
    ("2020-01-15", "2021-05-10", "2020 Q1", "2021 Q2", 6),
    ("2020-02-15", "2021-05-10", "2020 Q1", "2021 Q2", 6),
    ("2020-03-15", "2021-05-10", "2020 Q1", "2021 Q1", 5),
    ("1900-01-01", "2002-01-01", "1900 Q1", "2002 Q1", 409),
]


@pytest.mark.parametrize("start,end,first,last,n", SERIES)
def test_quarter_series_values(spark, start, end, first, last, n):
    df = spark.createDataFrame([(dt.date.fromisoformat(start), dt.date.fromisoformat(end))], "a date, b date")
    got = df.select(Q.quarter_series("a", "b")).first()[0]
    assert len(got) == n and (not n or (got[0], got[-1]) == (first, last))


@settings(max_examples=40, deadline=None)
@given(st.dates(dt.date(1990, 1, 1), dt.date(2030, 1, 1)), st.dates(dt.date(1990, 1, 1), dt.date(2030, 1, 1)))
def test_quarter_series_is_one_run(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a date, b date")
    span = Q.series_span("a", "b")
    row = df.select(Q.quarter_series("a", "b").alias("s"), span[0].alias("f"), span[1].alias("l"), Q.quarter_label(F.col("a")).alias("qa")).first()
    if a > b:
        assert row["s"] == []
        return
    assert row["s"] == Q.quarter_labels_between(row["f"], row["l"], newest_first=False)
    assert len(row["s"]) == row["l"] - row["f"] + 1 and row["s"][0] == row["qa"]
    assert 0 <= (b.year * 4 + (b.month - 1) // 3) - row["l"] <= 1
    assert row["s"] == sorted(row["s"])


# ---- C10, C13, C15 ------------------------------------------------------------
MONEY = {
    None: "N/A",
    0.0: "$0.00",
    0.125: "$0.12",
    1.005: "$1.00",
    2.5: "$2.50",
    2.675: "$2.67",
    -5.0: "$-5.00",
    999.99: "$999.99",
    1000.0: "$1.00K",
    1e6: "$1.00M",
    1234567.891: "$1.23M",
    1e9: "$1.00B",
    1e12: "$1000.00B",
}


def test_format_currency_values(spark):
    assert _eval(spark, TX.format_currency, list(MONEY), "double") == list(MONEY.values())


def test_thousands_values(spark):
    want = {0.0: "0", 2.5: "2", -5.0: "-5", 999.995: "1,000", 1e6: "1,000,000", 1234567.891: "1,234,568"}
    assert _eval(spark, TX.thousands, list(want), "double") == list(want.values())


@settings(max_examples=40, deadline=None)
@given(st.lists(st.floats(min_value=0, max_value=1e13, allow_nan=False), min_size=2, max_size=40))
def test_money_reads_back(spark, xs):
    xs = sorted(xs)
    read = []
    for x, shown in zip(xs, _eval(spark, TX.format_currency, xs, "double")):
        number, unit = re.fullmatch(r"\$([0-9]+\.[0-9]{2})([KMB]?)", shown).groups()
        size = {"": 1, "K": 10**3, "M": 10**6, "B": 10**9}[unit]
        assert abs(float(number) * size - x) <= 0.00501 * size * (1 + 1e-9)
        read.append(float(number) * size)
    assert read == sorted(read)
    assert [abs(int(t.replace(",", "")) - x) <= 0.5 for t, x in zip(_eval(spark, TX.thousands, xs, "double"), xs)] == [True] * len(xs)


def test_human_size_values(spark):
    want = {None: "?", 0: "0 B", 512: "512 B", 1023: "1023 B", 1024: "1.00 KB", 1536: "1.50 KB", 1 << 20: "1.00 MB", 5 << 30: "5.00 GB", 3 << 40: "3.00 TB", 7 << 50: "7168.00 TB"}
    assert _eval(spark, TX.human_size, list(want), "long") == list(want.values())


def test_investor_and_round_text(spark):
    df = spark.createDataFrame(
        [("Zed", True, None), ("", False, None), ("Abe", None, 500000.0)],
        "investor_name string, is_lead boolean, amount_usd double",
    )
    assert [r[0] for r in df.select(TX.investor_entry()).collect()] == ["Zed (Lead)", "Unknown", "Abe ($500,000)"]
