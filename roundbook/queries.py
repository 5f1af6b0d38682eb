"""Registered queries over the driver tables, and their DuckDB oracle SQL.

Every query reads whole tables (through the stand-in views of
:mod:`roundbook.sources.testviews`) and runs the library's operators. The
oracle strings restate each result in plain SQL for DuckDB; column names
and types are aligned (money as DOUBLE, counts and positions as BIGINT).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import quarters as Q
from .functions import text as TX
from .functions.urls import lookup_host, normalize_url
from .operators import analytics as AN
from .operators import funding as FD
from .operators.enrich import company_rows, enrich, enrich_long
from .operators.match import match_hosts, match_urls
from .operators.report import company_report
from .sources import testviews as TV
from .sources.collections import COLLECTIONS

# Fixed parameters of the registered queries.
AS_OF = dt.date(2002, 1, 1)
CATEGORY = "BUILDING"
EXPORT_CATEGORY = "MACHINERY"
INVESTOR_TEXT = "#00000001"
RECENT_SINCE = dt.date(2001, 1, 1)

# keyed by the session object (not its id, which a later session could reuse)
_cache: dict[tuple[SparkSession, str], dict[str, DataFrame]] = {}


def _t(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    key = (spark, sf_dir)
    if key not in _cache:
        _cache[key] = TV.load(spark, sf_dir)
    return _cache[key]


# ---------------------------------------------------------------- SQL pieces
def _norm(x: str) -> str:
    return f"split_part(regexp_replace(regexp_replace(lower({x}), '^https?://', ''), '^www[.]', ''), '/', 1)"


def _host(x: str) -> str:
    return f"nullif({_norm(f'trim({x})')}, '')"


def _nonblank(x: str) -> str:
    return f"({x} IS NOT NULL AND {x} <> '')"


def _nonzero(x: str) -> str:
    return f"({x} IS NOT NULL AND {x} <> 0)"


def _thousands(x: str) -> str:
    return f"format('{{:,.0f}}', CAST({x} AS DOUBLE))"


def _currency(x: str) -> str:
    v = f"CAST({x} AS DOUBLE)"
    return (
        f"CASE WHEN {v} IS NULL THEN 'N/A' "
        f"WHEN {v} >= 1e9 THEN '$' || format('{{:.2f}}', {v} / 1e9) || 'B' "
        f"WHEN {v} >= 1e6 THEN '$' || format('{{:.2f}}', {v} / 1e6) || 'M' "
        f"WHEN {v} >= 1e3 THEN '$' || format('{{:.2f}}', {v} / 1e3) || 'K' "
        f"ELSE '$' || format('{{:.2f}}', {v}) END"
    )


def _qlabel(d: str) -> str:
    return f"(CAST(year({d}) AS VARCHAR) || ' Q' || CAST(quarter({d}) AS VARCHAR))"


_ENTRY = (
    f"(CASE WHEN {_nonblank('investor_name')} THEN investor_name ELSE 'Unknown' END"
    " || CASE WHEN is_lead THEN ' (Lead)' ELSE '' END"
    f" || CASE WHEN {_nonzero('amount_usd')} THEN ' ($' || {_thousands('amount_usd')} || ')' ELSE '' END)"
)


def _opt(cond: str, label: str, val: str) -> str:
    return f"CASE WHEN {cond} THEN '{label}' || {val} ELSE '' END"


_ROUND_TEXT = " || ".join(
    [
        "'[' || coalesce(round_name, 'None') || ']'",
        _opt("announced_on IS NOT NULL", " Announced: ", "CAST(announced_on AS VARCHAR)"),
        _opt("closed_on IS NOT NULL", " Closed: ", "CAST(closed_on AS VARCHAR)"),
        _opt(_nonzero("amount_usd"), " Amount: $", _thousands("amount_usd")),
        _opt(_nonblank("investment_type"), " Type: ", "investment_type"),
        _opt(_nonblank("stage"), " Stage: ", "stage"),
        _opt(_nonzero("post_money_usd"), " Post-Money Valuation: $", _thousands("post_money_usd")),
        _opt(_nonzero("pre_money_usd"), " Pre-Money Valuation: $", _thousands("pre_money_usd")),
        _opt(_nonblank("investors"), " Investors: ", "investors"),
        _opt(_nonblank("short_description"), " Details: ", "short_description"),
    ]
)

_INV_TEXT_CTE = f"""inv_text AS (
  SELECT round_uuid,
         string_agg(entry, ', ' ORDER BY is_lead DESC NULLS LAST, investor_name ASC NULLS LAST,
                    amount_usd ASC NULLS LAST, entry ASC) AS investors
  FROM (SELECT *, {_ENTRY} AS entry FROM investments) e
  GROUP BY round_uuid)"""

_ROUND_TEXT_CTE = f"""round_text AS (
  SELECT r.*, {_ROUND_TEXT} AS round_text
  FROM (SELECT fr.*, it.investors FROM funding_rounds fr LEFT JOIN inv_text it USING (round_uuid)) r)"""

_FUNDING_TEXT_CTE = """funding_text AS (
  SELECT org_uuid,
         string_agg(round_text, ' | ' ORDER BY announced_on DESC NULLS LAST, closed_on DESC NULLS LAST,
                    round_uuid ASC) AS funding_info
  FROM round_text GROUP BY org_uuid)"""

_FOUNDED = "coalesce(founded_on, DATE '1900-01-01')"

_COMPANY_INFO = "concat_ws(' | ', " + ", ".join(
    [
        f"CASE WHEN {_nonblank('name')} THEN 'Name: ' || name END",
        f"CASE WHEN {_nonblank('short_description')} THEN 'Description: ' || short_description END",
        f"CASE WHEN {_nonblank('description')} THEN 'Full Description: ' || description END",
        f"'Founded: ' || CAST({_FOUNDED} AS VARCHAR)",
        f"CASE WHEN {_nonblank('categories')} THEN 'Categories: ' || categories END",
        f"CASE WHEN {_nonblank('category_groups')} THEN 'Category Groups: ' || category_groups END",
        f"CASE WHEN {_nonblank('location')} THEN 'Location: ' || location END",
        f"CASE WHEN {_nonblank('funding_stage')} THEN 'Funding Stage: ' || funding_stage END",
        f"CASE WHEN {_nonblank('investor_stage')} THEN 'Investor Stage: ' || investor_stage END",
        f"CASE WHEN {_nonzero('num_funding_rounds')} THEN 'Number of Funding Rounds: ' || CAST(num_funding_rounds AS VARCHAR) END",
        f"CASE WHEN {_nonzero('num_investors')} THEN 'Number of Investors: ' || CAST(num_investors AS VARCHAR) END",
    ]
) + ")"


def _match_cte(lookup: str, url: str, orgs: str, name: str = "best") -> str:
    """Hosts of ``lookup.url`` matched to ``orgs`` by containment, exact first."""
    return f"""hosts AS (
  SELECT DISTINCT {_host(url)} AS host FROM {lookup} WHERE {_host(url)} IS NOT NULL),
cand AS (
  SELECT h.host, o.org_uuid,
         CASE WHEN {_norm('o.website')} = h.host OR {_norm('o.website_url')} = h.host THEN 0 ELSE 1 END AS rnk
  FROM hosts h JOIN {orgs} o
    ON contains(lower(o.website), h.host) OR contains(lower(o.website_url), h.host)),
{name} AS (
  SELECT host, org_uuid FROM (
    SELECT host, org_uuid, row_number() OVER (PARTITION BY host ORDER BY rnk, org_uuid) AS rn FROM cand) x
  WHERE rn = 1)"""


def _axis_labels(first_year: int, last: dt.date) -> list[str]:
    """Expected run axis for the oracle: 1900 Q1 (the founding default) to the
    quarter of the last 3-month step on or before ``last``, newest first."""
    return Q.quarter_labels_between(first_year * 4, last.year * 4 + (last.month - 1) // 3)


# ---------------------------------------------------------------- queries
def q_normalize_url(spark, sf_dir):
    t = _t(spark, sf_dir)
    a = t["page_lookup"].select(F.lit("page").alias("src"), "row_id", "url")
    b = t["lookup"].select(F.lit("cust").alias("src"), "row_id", F.col("website").alias("url"))
    return a.unionByName(b).select("src", "row_id", "url", normalize_url("url").alias("host"),
                                   lookup_host("url").alias("lookup_host"))


O_NORMALIZE_URL = f"""
SELECT 'page' AS src, row_id, url, {_norm('url')} AS host, {_host('url')} AS lookup_host FROM page_lookup
UNION ALL
SELECT 'cust', row_id, website, {_norm('website')}, {_host('website')} FROM lookup"""


def q_match_urls(spark, sf_dir):
    t = _t(spark, sf_dir)
    m = match_urls(t["page_lookup"], t["page_orgs"])
    return m.select("row_id", "url", "host", "org_uuid")


O_MATCH_URLS = (
    "WITH "
    + _match_cte("page_lookup", "url", "page_orgs")
    + f"""
SELECT l.row_id, l.url, {_host('l.url')} AS host, b.org_uuid
FROM page_lookup l LEFT JOIN best b ON {_host('l.url')} = b.host"""
)


def q_match_urls_outer(spark, sf_dir):
    t = _t(spark, sf_dir)
    m = match_urls(t["lookup"], t["organizations"], url_col="website")
    return m.select("row_id", "website", "host", "org_uuid")


O_MATCH_URLS_OUTER = (
    "WITH "
    + _match_cte("lookup", "website", "organizations")
    + f"""
SELECT l.row_id, l.website, {_host('l.website')} AS host, b.org_uuid
FROM lookup l LEFT JOIN best b ON {_host('l.website')} = b.host"""
)


def q_rounds_listing(spark, sf_dir):
    t = _t(spark, sf_dir)
    r = t["funding_rounds"].select("org_uuid", "round_uuid", "announced_on", "closed_on", "amount_usd")
    out = FD.rounds_listing(r)
    return out.select("org_uuid", "round_uuid", F.col("pos").cast("bigint").alias("pos"),
                      "announced_on", "closed_on", F.col("amount_usd").cast("double").alias("amount_usd"))


O_ROUNDS_LISTING = """
SELECT org_uuid, round_uuid,
       CAST(row_number() OVER (PARTITION BY org_uuid ORDER BY announced_on DESC NULLS LAST,
                               closed_on DESC NULLS LAST, round_uuid) AS BIGINT) AS pos,
       announced_on, closed_on, CAST(amount_usd AS DOUBLE) AS amount_usd
FROM funding_rounds"""


def q_rounds_by_name(spark, sf_dir):
    t = _t(spark, sf_dir)
    out = FD.rounds_for(t["organizations"], t["funding_rounds"], by="name")
    return out.select("matched_uuid", "round_uuid", "org_name")


O_ROUNDS_BY_NAME = """
SELECT o.org_uuid AS matched_uuid, r.round_uuid, r.org_name
FROM funding_rounds r JOIN organizations o ON r.org_name = o.name"""


def q_rounds_with_investors(spark, sf_dir):
    t = _t(spark, sf_dir)
    return FD.round_texts(t["funding_rounds"], t["investments"]).select("round_uuid", "investors", "round_text")


O_ROUNDS_WITH_INVESTORS = f"""
WITH {_INV_TEXT_CTE},
{_ROUND_TEXT_CTE}
SELECT round_uuid, investors, round_text FROM round_text"""


def q_company_info(spark, sf_dir):
    t = _t(spark, sf_dir)
    return company_rows(t["organizations"])


O_COMPANY_INFO = f"""
SELECT org_uuid, {_FOUNDED} AS founded, {_COMPANY_INFO} AS company_info FROM organizations"""


def q_funding_text(spark, sf_dir):
    t = _t(spark, sf_dir)
    return FD.funding_text(t["funding_rounds"], t["investments"])


O_FUNDING_TEXT = f"""
WITH {_INV_TEXT_CTE},
{_ROUND_TEXT_CTE},
{_FUNDING_TEXT_CTE}
SELECT org_uuid, funding_info FROM funding_text"""


def q_total_funding(spark, sf_dir):
    t = _t(spark, sf_dir)
    out = FD.total_funding(t["funding_rounds"])
    return out.select("org_uuid", F.col("total_funding").cast("double").alias("total_funding"))


O_TOTAL_FUNDING = f"""
SELECT org_uuid, CAST(CASE WHEN s <> 0 THEN s END AS DOUBLE) AS total_funding
FROM (SELECT org_uuid, sum(CASE WHEN {_nonzero('amount_usd')} THEN amount_usd END) AS s
      FROM funding_rounds GROUP BY org_uuid) x"""


def q_quarterly_funding(spark, sf_dir):
    t = _t(spark, sf_dir)
    out = FD.quarterly_funding(t["funding_rounds"])
    return out.select("org_uuid", "quarter", F.col("amount").cast("double").alias("amount"))


_QUARTERLY_CTE = f"""quarterly AS (
  SELECT org_uuid, {_qlabel('coalesce(closed_on, announced_on)')} AS quarter, sum(amount_usd) AS amount
  FROM funding_rounds
  WHERE {_nonzero('amount_usd')} AND coalesce(closed_on, announced_on) IS NOT NULL
  GROUP BY ALL)"""

O_QUARTERLY_FUNDING = f"""
WITH {_QUARTERLY_CTE}
SELECT org_uuid, quarter, CAST(amount AS DOUBLE) AS amount FROM quarterly"""


def q_quarterly_pivot(spark, sf_dir):
    t = _t(spark, sf_dir)
    axis = FD.quarter_axis(t["organizations"], AS_OF)
    wide = FD.quarterly_pivot(FD.quarterly_funding(t["funding_rounds"]), axis)
    return wide.selectExpr("org_uuid", *[FD.quote(q) for q in axis])


def _o_quarterly_pivot() -> str:
    axis = _axis_labels(1900, AS_OF)
    cols = ", ".join(f"CAST(sum(amount) FILTER (WHERE quarter = '{q}') AS DOUBLE) AS \"{q}\"" for q in axis)
    inlist = ", ".join(f"'{q}'" for q in axis)
    return f"""
WITH {_QUARTERLY_CTE}
SELECT org_uuid, {cols} FROM quarterly WHERE quarter IN ({inlist}) GROUP BY org_uuid"""


def q_quarter_series(spark, sf_dir):
    t = _t(spark, sf_dir)
    return FD.quarter_series(t["organizations"], AS_OF)


_SERIES_CTE = f"""series AS (
  SELECT org_uuid, {_qlabel('d')} AS quarter
  FROM (SELECT org_uuid,
               unnest(generate_series(CAST(date_trunc('month', f) AS TIMESTAMP), TIMESTAMP '{AS_OF}',
                                      INTERVAL 3 MONTH)) AS d
        FROM (SELECT org_uuid, {_FOUNDED} AS f FROM organizations) o
        WHERE f <= DATE '{AS_OF}') s)"""

O_QUARTER_SERIES = f"WITH {_SERIES_CTE}\nSELECT org_uuid, quarter FROM series"


def q_quarter_axis(spark, sf_dir):
    t = _t(spark, sf_dir)
    return FD.axis_frame(t["organizations"], AS_OF)


O_QUARTER_AXIS = f"""WITH {_SERIES_CTE}
SELECT DISTINCT quarter, CAST(split_part(quarter, ' Q', 1) AS INTEGER) AS year,
       CAST(split_part(quarter, ' Q', 2) AS INTEGER) AS q
FROM series"""


def q_parse_quarter(spark, sf_dir):
    t = _t(spark, sf_dir)
    d = F.col("o_orderdate").cast("date")
    labels = t["orders"].select(
        "o_orderkey",
        Q.quarter_label(d).alias("label_new"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string"), F.lit("-"),
                 F.lpad((F.year(d) % 100).cast("string"), 2, "0")).alias("label_old"),
        F.col("o_orderpriority").alias("label_other"),
    )
    out = labels
    for c in ["label_new", "label_old", "label_other"]:
        p = Q.parse_quarter(c)
        out = out.withColumn(c + "_year", p["year"]).withColumn(c + "_q", p["q"])
    return out


def _o_parse(c: str) -> str:
    new = f"regexp_matches({c}, '^[0-9]{{4}} Q[0-9]+')"
    old = f"regexp_matches({c}, '^Q[0-9]+-[0-9]+')"
    yy = f"CAST(regexp_extract({c}, '^Q([0-9]+)-([0-9]+)', 2) AS INTEGER)"
    year = (f"CASE WHEN {new} THEN CAST(regexp_extract({c}, '^([0-9]{{4}}) Q([0-9]+)', 1) AS INTEGER) "
            f"WHEN {old} THEN CASE WHEN {yy} <= 50 THEN {yy} + 2000 ELSE {yy} + 1900 END ELSE 0 END")
    q = (f"CASE WHEN {new} THEN CAST(regexp_extract({c}, '^([0-9]{{4}}) Q([0-9]+)', 2) AS INTEGER) "
         f"WHEN {old} THEN CAST(regexp_extract({c}, '^Q([0-9]+)-([0-9]+)', 1) AS INTEGER) ELSE 0 END")
    return f"{year} AS {c}_year, {q} AS {c}_q"


O_PARSE_QUARTER = f"""
SELECT o_orderkey, label_new, label_old, label_other,
       {_o_parse('label_new')}, {_o_parse('label_old')}, {_o_parse('label_other')}
FROM (SELECT o_orderkey, {_qlabel('CAST(o_orderdate AS DATE)')} AS label_new,
             'Q' || CAST(quarter(CAST(o_orderdate AS DATE)) AS VARCHAR) || '-'
                 || lpad(CAST(year(CAST(o_orderdate AS DATE)) % 100 AS VARCHAR), 2, '0') AS label_old,
             o_orderpriority AS label_other
      FROM orders) x"""


def q_funding_summary(spark, sf_dir):
    t = _t(spark, sf_dir)
    return FD.funding_summary(t["funding_rounds"])


O_FUNDING_SUMMARY = f"""
SELECT org_uuid, n_rounds, n_rounds_with_amount, CAST(CASE WHEN s <> 0 THEN s END AS DOUBLE) AS total_funding,
       CASE WHEN s <> 0 THEN {_currency('s')} END AS total_funding_text
FROM (SELECT org_uuid, count(*) AS n_rounds,
             count(CASE WHEN {_nonzero('amount_usd')} THEN 1 END) AS n_rounds_with_amount,
             sum(CASE WHEN {_nonzero('amount_usd')} THEN amount_usd END) AS s
      FROM funding_rounds GROUP BY org_uuid) x"""


def q_rounds_by_type(spark, sf_dir):
    t = _t(spark, sf_dir)
    out = FD.rounds_by_type(t["funding_rounds"])
    return out.select("org_uuid", "investment_type", F.col("n_rounds").cast("bigint").alias("n_rounds"),
                      F.col("type_rank").cast("bigint").alias("type_rank"))


O_ROUNDS_BY_TYPE = f"""
WITH l AS (
  SELECT org_uuid, investment_type,
         row_number() OVER (PARTITION BY org_uuid ORDER BY announced_on DESC NULLS LAST,
                            closed_on DESC NULLS LAST, round_uuid) AS pos
  FROM funding_rounds),
c AS (
  SELECT org_uuid, investment_type, count(*) AS n_rounds, min(pos) AS first_pos
  FROM l WHERE {_nonblank('investment_type')} GROUP BY org_uuid, investment_type)
SELECT org_uuid, investment_type, CAST(n_rounds AS BIGINT) AS n_rounds,
       CAST(row_number() OVER (PARTITION BY org_uuid ORDER BY n_rounds DESC, first_pos) AS BIGINT) AS type_rank
FROM c"""


def q_format_currency(spark, sf_dir):
    t = _t(spark, sf_dir)
    return t["funding_rounds"].select(
        "round_uuid",
        TX.format_currency("amount_usd").alias("amount_text"),
        TX.thousands("amount_usd").alias("amount_thousands"),
        TX.format_currency("post_money_usd").alias("post_money_text"),
        TX.format_currency(F.col("amount_usd") / 1000).alias("amount_k_text"),
    )


O_FORMAT_CURRENCY = f"""
SELECT round_uuid, {_currency('amount_usd')} AS amount_text, {_thousands('amount_usd')} AS amount_thousands,
       {_currency('post_money_usd')} AS post_money_text, {_currency('CAST(amount_usd AS DOUBLE) / 1000')} AS amount_k_text
FROM funding_rounds"""


def q_organizations_by_category(spark, sf_dir):
    return AN.organizations_by_category(_t(spark, sf_dir)["organizations"], CATEGORY, 50)


O_ORGANIZATIONS_BY_CATEGORY = f"""
SELECT name AS company_name, website, categories AS category, CAST(funding_total_usd AS DOUBLE) AS total_funding,
       num_funding_rounds, founded_on AS founded_date, org_uuid
FROM organizations WHERE contains(categories, '{CATEGORY}')
ORDER BY total_funding DESC NULLS LAST, org_uuid LIMIT 50"""


def q_top_funded(spark, sf_dir):
    return AN.top_funded(_t(spark, sf_dir)["organizations"], 10)


O_TOP_FUNDED = """
SELECT name, CAST(funding_total_usd AS DOUBLE) AS total_funding, num_funding_rounds, org_uuid
FROM organizations WHERE funding_total_usd IS NOT NULL
ORDER BY total_funding DESC, org_uuid LIMIT 10"""


def q_category_export(spark, sf_dir):
    return AN.category_export(_t(spark, sf_dir)["organizations"], EXPORT_CATEGORY)


O_CATEGORY_EXPORT = f"""
SELECT name, website, CAST(funding_total_usd AS DOUBLE) AS total_funding, num_funding_rounds, org_uuid
FROM organizations WHERE contains(categories, '{EXPORT_CATEGORY}') AND funding_total_usd IS NOT NULL"""


def q_investor_portfolio(spark, sf_dir):
    t = _t(spark, sf_dir)
    return AN.investor_portfolio(t["investments"], t["funding_rounds"], t["organizations"], INVESTOR_TEXT)


O_INVESTOR_PORTFOLIO = f"""
SELECT i.investor_name, o.name AS company_name, o.website, r.round_name,
       CAST(r.amount_usd AS DOUBLE) AS round_amount, r.stage AS investment_stage, r.announced_on,
       i.is_lead, r.round_uuid, r.org_uuid
FROM investments i
JOIN funding_rounds r ON i.round_uuid = r.round_uuid
JOIN organizations o ON r.org_uuid = o.org_uuid
WHERE contains(i.investor_name, '{INVESTOR_TEXT}')"""


def q_top_investors(spark, sf_dir):
    return AN.top_investors(_t(spark, sf_dir)["investments"], 20)


O_TOP_INVESTORS = """
SELECT investor_name, count(*) AS total_investments, CAST(sum(amount_usd) AS DOUBLE) AS total_invested_usd
FROM investments WHERE investor_name IS NOT NULL
GROUP BY investor_name ORDER BY total_investments DESC, investor_name LIMIT 20"""


def q_recent_rounds(spark, sf_dir):
    t = _t(spark, sf_dir)
    return AN.recent_rounds(t["funding_rounds"], t["organizations"], RECENT_SINCE, 100)


O_RECENT_ROUNDS = f"""
SELECT o.name AS company_name, o.website, CAST(r.amount_usd AS DOUBLE) AS amount_raised,
       CAST(r.post_money_usd AS DOUBLE) AS post_money_valuation, CAST(r.pre_money_usd AS DOUBLE) AS pre_money_valuation,
       r.stage AS investment_stage, r.announced_on, r.round_uuid
FROM funding_rounds r JOIN organizations o ON r.org_uuid = o.org_uuid
WHERE r.announced_on >= DATE '{RECENT_SINCE}'
ORDER BY r.announced_on DESC NULLS LAST, r.round_uuid LIMIT 100"""


def q_quarterly_trend(spark, sf_dir):
    return AN.quarterly_trend(_t(spark, sf_dir)["funding_rounds"], 20)


O_QUARTERLY_TREND = f"""
SELECT {_qlabel('closed_on')} AS quarter, CAST(sum(amount_usd) AS DOUBLE) AS total_funding
FROM funding_rounds WHERE amount_usd IS NOT NULL AND closed_on IS NOT NULL
GROUP BY quarter ORDER BY quarter DESC LIMIT 20"""


def q_snapshot_counts(spark, sf_dir):
    t = _t(spark, sf_dir)
    snap = t["orders"].withColumn("snapshot_date", F.make_date(F.year("o_orderdate"), F.lit(12), F.lit(31)))
    return AN.snapshot_counts(snap, 3)


O_SNAPSHOT_COUNTS = """
WITH s AS (SELECT make_date(year(o_orderdate), 12, 31) AS snapshot_date FROM orders)
SELECT snapshot_date, count(*) AS n_rows FROM s
WHERE snapshot_date IN (SELECT DISTINCT snapshot_date FROM s ORDER BY snapshot_date DESC LIMIT 3)
GROUP BY snapshot_date"""


def q_table_counts(spark, sf_dir):
    from .sources.ingest import table_counts

    t = _t(spark, sf_dir)
    return table_counts({n: t[n] for n in TV.TABLES})


O_TABLE_COUNTS = "\nUNION ALL\n".join(
    f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in TV.TABLES
)


def q_run_summary(spark, sf_dir):
    from .operators.enrich import run_summary

    t = _t(spark, sf_dir)
    m = match_urls(t["lookup"], t["organizations"], url_col="website")
    return run_summary(m, t["organizations"], AS_OF)


O_RUN_SUMMARY = (
    "WITH "
    + _match_cte("lookup", "website", "organizations")
    + f""",
{_SERIES_CTE.replace("SELECT org_uuid, " + _qlabel('d') + " AS quarter", "SELECT org_uuid, d, " + _qlabel('d') + " AS quarter")},
m AS (SELECT l.row_id, b.org_uuid FROM lookup l LEFT JOIN best b ON {_host('l.website')} = b.host),
ends AS (SELECT arg_min(quarter, d) AS earliest_quarter, arg_max(quarter, d) AS latest_quarter
         FROM series WHERE org_uuid IN (SELECT org_uuid FROM m WHERE org_uuid IS NOT NULL))
SELECT count(*) AS rows_processed, count(m.org_uuid) AS companies_found,
       (SELECT earliest_quarter FROM ends) AS earliest_quarter, (SELECT latest_quarter FROM ends) AS latest_quarter
FROM m"""
)


def q_company_report_rounds(spark, sf_dir):
    t = _t(spark, sf_dir)
    rep = company_report(t["lookup"], t["organizations"], t["funding_rounds"], url_col="website", parts=("rounds",))
    return rep["rounds"].select("host", "org_uuid", F.col("pos").cast("bigint").alias("pos"), "round_uuid",
                                "amount_text", "post_money_text")


O_COMPANY_REPORT_ROUNDS = (
    "WITH "
    + _match_cte("lookup", "website", "organizations")
    + f""",
l AS (SELECT org_uuid, round_uuid, amount_usd, post_money_usd,
             row_number() OVER (PARTITION BY org_uuid ORDER BY announced_on DESC NULLS LAST,
                                closed_on DESC NULLS LAST, round_uuid) AS pos
      FROM funding_rounds WHERE org_uuid IN (SELECT org_uuid FROM best))
SELECT b.host, b.org_uuid, CAST(l.pos AS BIGINT) AS pos, l.round_uuid, {_currency('l.amount_usd')} AS amount_text,
       CASE WHEN {_nonzero('l.post_money_usd')} THEN {_currency('l.post_money_usd')} END AS post_money_text
FROM best b JOIN l ON b.org_uuid = l.org_uuid"""
)


def q_enrich(spark, sf_dir):
    t = _t(spark, sf_dir)
    lk = t["lookup"].withColumnRenamed("row_id", "__row_id")
    out = enrich(lk, t["organizations"], t["funding_rounds"], t["investments"], AS_OF)
    return out.withColumnRenamed("__row_id", "row_id")


def _o_enrich(since: int = 1900, own: str = "l.company, l.website") -> str:
    axis = _axis_labels(since, AS_OF)
    qcols = ", ".join(f"CAST(p.\"{q}\" AS DOUBLE) AS \"{q}\"" for q in axis)
    pcols = ", ".join(f"sum(amount) FILTER (WHERE quarter = '{q}') AS \"{q}\"" for q in axis)
    return (
        "WITH "
        + _match_cte("lookup", "website", "organizations")
        + f""",
{_INV_TEXT_CTE},
{_ROUND_TEXT_CTE},
{_FUNDING_TEXT_CTE},
{_QUARTERLY_CTE},
qpivot AS (SELECT org_uuid, {pcols} FROM quarterly GROUP BY org_uuid),
info AS (SELECT org_uuid, {_COMPANY_INFO} AS company_info FROM organizations),
total AS (SELECT org_uuid, sum(CASE WHEN {_nonzero('amount_usd')} THEN amount_usd END) AS s
          FROM funding_rounds GROUP BY org_uuid)
SELECT l.row_id, {own},
       i.company_info AS "Company Information",
       ft.funding_info AS "Investment Rounds and Funding Information",
       CAST(CASE WHEN tt.s <> 0 THEN tt.s END AS DOUBLE) AS "Total Funding to Date",
       {qcols}
FROM lookup l
LEFT JOIN best b ON {_host('l.website')} = b.host
LEFT JOIN info i ON b.org_uuid = i.org_uuid
LEFT JOIN funding_text ft ON b.org_uuid = ft.org_uuid
LEFT JOIN total tt ON b.org_uuid = tt.org_uuid
LEFT JOIN qpivot p ON b.org_uuid = p.org_uuid"""
    )


def q_enrich_long(spark, sf_dir):
    t = _t(spark, sf_dir)
    return enrich_long(t["lookup"], t["organizations"], t["funding_rounds"], AS_OF, "website", "row_id")


O_ENRICH_LONG = (
    "WITH "
    + _match_cte("lookup", "website", "organizations")
    + f""",
{_QUARTERLY_CTE}
SELECT l.row_id, b.org_uuid, q.quarter, CAST(q.amount AS DOUBLE) AS amount
FROM lookup l
JOIN best b ON {_host('l.website')} = b.host
JOIN quarterly q ON q.org_uuid = b.org_uuid
WHERE q.quarter IN ({", ".join(f"'{x}'" for x in _axis_labels(1900, AS_OF))})"""
)


def q_human_size(spark, sf_dir):
    t = _t(spark, sf_dir)
    return t["documents"].select("doc_id", "n_chars", TX.human_size("n_chars").alias("size_text"))


O_HUMAN_SIZE = """
SELECT doc_id, n_chars,
       CASE WHEN n_chars IS NULL THEN '?'
            WHEN n_chars < 1024 THEN CAST(n_chars AS VARCHAR) || ' B'
            WHEN n_chars < 1048576 THEN format('{:.2f}', n_chars / 1024.0) || ' KB'
            WHEN n_chars < 1073741824 THEN format('{:.2f}', n_chars / 1048576.0) || ' MB'
            WHEN n_chars < 1099511627776 THEN format('{:.2f}', n_chars / 1073741824.0) || ' GB'
            ELSE format('{:.2f}', n_chars / 1099511627776.0) || ' TB' END AS size_text
FROM documents"""


def q_latest_snapshot(spark, sf_dir):
    from .sources.ingest import latest_snapshot

    t = _t(spark, sf_dir)
    snap = t["orders"].withColumn("snapshot_date", F.make_date(F.year("o_orderdate"), F.lit(12), F.lit(31)))
    return latest_snapshot(snap).select("snapshot_date", "o_orderkey", "o_custkey")


O_LATEST_SNAPSHOT = """
WITH s AS (SELECT make_date(year(o_orderdate), 12, 31) AS snapshot_date, o_orderkey, o_custkey FROM orders)
SELECT snapshot_date, o_orderkey, o_custkey FROM s WHERE snapshot_date = (SELECT max(snapshot_date) FROM s)"""

AXIS_SINCE = 1999


def q_quarter_axis_since(spark, sf_dir):
    t = _t(spark, sf_dir)
    return FD.axis_frame(t["organizations"], AS_OF, AXIS_SINCE)


def q_company_report_summary(spark, sf_dir):
    t = _t(spark, sf_dir)
    rep = company_report(t["lookup"], t["organizations"], t["funding_rounds"], url_col="website", parts=("summary",))
    return rep["summary"]


O_COMPANY_REPORT_SUMMARY = (
    "WITH "
    + _match_cte("lookup", "website", "organizations")
    + f"""
SELECT b.host, b.org_uuid, x.n_rounds, x.n_rounds_with_amount,
       CAST(CASE WHEN x.s <> 0 THEN x.s END AS DOUBLE) AS total_funding,
       CASE WHEN x.s <> 0 THEN {_currency('x.s')} END AS total_funding_text
FROM best b JOIN (
  SELECT org_uuid, count(*) AS n_rounds,
         count(CASE WHEN {_nonzero('amount_usd')} THEN 1 END) AS n_rounds_with_amount,
         sum(CASE WHEN {_nonzero('amount_usd')} THEN amount_usd END) AS s
  FROM funding_rounds GROUP BY org_uuid) x ON b.org_uuid = x.org_uuid"""
)


def _report(spark, sf_dir, part: str) -> DataFrame:
    t = _t(spark, sf_dir)
    return company_report(t["lookup"], t["organizations"], t["funding_rounds"], url_col="website", parts=(part,))[part]


def q_company_report_companies(spark, sf_dir):
    return _report(spark, sf_dir, "companies")


O_COMPANY_REPORT_COMPANIES = (
    "WITH "
    + _match_cte("lookup", "website", "organizations")
    + f"""
SELECT b.host, b.org_uuid, o.name, coalesce(CASE WHEN {_nonblank('o.website')} THEN o.website END, o.website_url) AS website
FROM best b JOIN organizations o ON b.org_uuid = o.org_uuid"""
)


def q_company_report_by_type(spark, sf_dir):
    out = _report(spark, sf_dir, "by_type")
    return out.select("host", "org_uuid", "investment_type", F.col("n_rounds").cast("bigint").alias("n_rounds"),
                      F.col("type_rank").cast("bigint").alias("type_rank"))


O_COMPANY_REPORT_BY_TYPE = (
    "WITH "
    + _match_cte("lookup", "website", "organizations")
    + f""",
t AS ({O_ROUNDS_BY_TYPE})
SELECT b.host, t.org_uuid, t.investment_type, t.n_rounds, t.type_rank FROM best b JOIN t ON b.org_uuid = t.org_uuid"""
)


def q_enrich_since(spark, sf_dir):
    """Enrichment from a given year on, of a list with columns named like working ones."""
    t = _t(spark, sf_dir)
    lk = t["lookup"].selectExpr("row_id AS __row_id", "website AS Website", "company AS Founded", "row_id AS Host", "upper(company) AS Total_Funding")
    out = enrich(lk, t["organizations"], t["funding_rounds"], t["investments"], AS_OF, oldest_year=AXIS_SINCE)
    return out.withColumnRenamed("__row_id", "row_id")


def q_investor_portfolio_newest(spark, sf_dir):
    t = _t(spark, sf_dir)
    return AN.investor_portfolio(t["investments"], t["funding_rounds"], t["organizations"], INVESTOR_TEXT, k=10)


O_INVESTOR_PORTFOLIO_NEWEST = O_INVESTOR_PORTFOLIO + "\nORDER BY announced_on DESC NULLS LAST, r.round_uuid, i.investor_name LIMIT 10"


def q_rounds_by_uuid_else_name(spark, sf_dir):
    t = _t(spark, sf_dir)
    orgs = t["organizations"].withColumn("org_uuid", F.when(F.col("num_funding_rounds") % 2 == 0, F.col("org_uuid")))
    orgs = orgs.where(F.col("categories") == CATEGORY)
    return FD.rounds_for(orgs, t["funding_rounds"], by="uuid_else_name").select("round_uuid", "org_uuid", "org_name")


O_ROUNDS_BY_UUID_ELSE_NAME = f"""
WITH o AS (SELECT CASE WHEN num_funding_rounds % 2 = 0 THEN org_uuid END AS org_uuid, name
           FROM organizations WHERE categories = '{CATEGORY}')
SELECT round_uuid, org_uuid, org_name FROM funding_rounds
WHERE org_uuid IN (SELECT org_uuid FROM o WHERE org_uuid IS NOT NULL)
   OR org_name IN (SELECT name FROM o WHERE org_uuid IS NULL)"""


def q_match_short_urls(spark, sf_dir):
    """Hosts of one to three characters, ASCII and not, against URLs with letters of four languages."""
    start = F.regexp_replace(F.substring("text", 1, 12), r"[^\p{L}]", "")
    docs = _t(spark, sf_dir)["documents"].select(F.col("doc_id").cast("string").alias("org_uuid"), start.alias("s"), "doc_id")
    orgs = docs.select("org_uuid", F.concat(F.lit("https://"), "s", F.lit(".io/")).alias("website"), F.lit(None).cast("string").alias("website_url"))
    hosts = docs.select(lookup_host(F.expr("substring(s, 1, int(1 + doc_id % 3))")).alias("host"))
    return match_hosts(hosts, orgs).select("host", "org_uuid")


O_MATCH_SHORT_URLS = """WITH docs AS (
  SELECT doc_id, CAST(doc_id AS VARCHAR) AS org_uuid, regexp_replace(substring(text, 1, 12), '[^\\p{L}]', '', 'g') AS s FROM documents),
short_orgs AS (SELECT org_uuid, 'https://' || s || '.io/' AS website, CAST(NULL AS VARCHAR) AS website_url FROM docs),
short_lookup AS (SELECT substring(s, 1, CAST(1 + doc_id % 3 AS INTEGER)) AS url FROM docs),
""" + _match_cte("short_lookup", "url", "short_orgs") + "\nSELECT host, org_uuid FROM best"


SNAPSHOT = dt.date(2024, 6, 30)


def _exported(spark, sf_dir: str, names: list[str]) -> tuple[str, dict[str, str]]:
    """CSV exports of domain views under their source names, in the shared folder:
    texts with commas, doubled quotes and line breaks, dates that are no dates."""
    from . import schemas
    from .plans.config import shared_folder

    t, folder, paths = _t(spark, sf_dir), shared_folder(spark, "export"), {}
    for name in names:
        df = t[name]
        if name == "organizations":
            df = df.withColumn("description", F.concat("description", F.lit(',\nthe "first"\n"one"'))).withColumn("founded_on", F.coalesce(F.col("founded_on").cast("string"), F.lit("unknown")))
        source = {dst: src for src, dst in schemas.RENAMES[name].items()}
        paths[name] = f"{folder}/{name}.csv"
        df.select(*[F.col(c).alias(source[c]) for c in df.columns]).write.options(header=True, quote='"', escape='"').csv(paths[name])
    return f"{folder}/warehouse", paths


def _imported(spark, sf_dir: str, names: list[str]) -> str:
    """The warehouse after an import of the exports."""
    from .sources.ingest import import_snapshot

    warehouse, paths = _exported(spark, sf_dir, names)
    failed = import_snapshot(spark, paths, warehouse, SNAPSHOT).where("status <> 'ok'").collect()
    if failed:
        raise RuntimeError(f"import failed: {failed}")
    return warehouse


def _import_query(name: str):
    def q(spark, sf_dir):
        from .sources.ingest import read_latest

        rows = read_latest(spark, _imported(spark, sf_dir, [name]), name)
        return rows.select(*[F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else f.name for f in rows.schema.fields])

    q.__doc__ = f"{name} exported as CSV with dotted names, imported by many tasks, read as its newest snapshot."
    return q


def _o_import(name: str) -> str:
    described = "description || ',' || chr(10) || 'the \"first\"' || chr(10) || '\"one\"'"  # NULL stays NULL
    from . import schemas

    money = [f"CAST({c} AS DOUBLE) AS {c}" for c, t in schemas.TYPES[name].items() if t == schemas.MONEY]
    columns = f"* REPLACE ({', '.join(money + [f'{described} AS description'] * (name == 'organizations'))})"
    return f"SELECT {columns}, DATE '{SNAPSHOT}' AS snapshot_date FROM {name}"


def q_import_report(spark, sf_dir):
    """What an import says of each collection: rows, and values that don't fit their type."""
    from .sources.ingest import import_snapshot

    warehouse, paths = _exported(spark, sf_dir, ["organizations", "investments"])
    return import_snapshot(spark, paths, warehouse, SNAPSHOT).select("table", "status", "rows", "malformed")


O_IMPORT_REPORT = """
SELECT 'organizations' AS "table", 'ok' AS status, count(*) AS "rows", count(*) FILTER (WHERE founded_on IS NULL) AS malformed FROM organizations
UNION ALL SELECT 'investments', 'ok', count(*), 0 FROM investments"""


def q_missing_collections(spark, sf_dir):
    """The known collections that an import of two exports leaves missing."""
    from .sources.archives import missing_collections
    from .sources.ingest import collections_in

    warehouse = _imported(spark, sf_dir, ["organizations", "funding_rounds"])
    present = spark.createDataFrame([(c,) for c in collections_in(spark, warehouse)], "collection string")
    return missing_collections(spark, present).select("collection")


def q_adhoc_sql(spark, sf_dir):
    """Plain SQL over the imported collections by name."""
    from .sources.ingest import register_collections

    register_collections(spark, _imported(spark, sf_dir, ["organizations", "funding_rounds"]))
    return spark.sql("""
        SELECT o.category_groups, r.investment_type, count(*) AS n_rounds, count(DISTINCT o.org_uuid) AS n_companies,
               CAST(sum(r.amount_usd) AS DOUBLE) AS total
        FROM organizations o JOIN funding_rounds r ON o.org_uuid = r.org_uuid
        GROUP BY o.category_groups, r.investment_type""")


O_ADHOC_SQL = """
SELECT o.category_groups, r.investment_type, count(*) AS n_rounds, count(DISTINCT o.org_uuid) AS n_companies, CAST(sum(r.amount_usd) AS DOUBLE) AS total
FROM organizations o JOIN funding_rounds r ON o.org_uuid = r.org_uuid
GROUP BY o.category_groups, r.investment_type"""


def q_adhoc_snapshots(spark, sf_dir):
    """SQL over all snapshots of a stored table: one per year of the rounds, joined
    with the dates that have many, which prunes the others' files at run time."""
    from .plans.config import shared_folder
    from .sources.ingest import register_collections, write_snapshot

    rounds, warehouse = _t(spark, sf_dir)["funding_rounds"], shared_folder(spark, "snapshots")
    for year in (1996, 1997, 1998):
        write_snapshot(rounds.where(F.year("announced_on") == year), f"{warehouse}/funding_rounds", dt.date(year, 12, 31))
    register_collections(spark, warehouse, None)
    return spark.sql("""
        WITH busy AS (SELECT snapshot_date AS day, count(*) AS n FROM funding_rounds WHERE investment_type = '1-URGENT' GROUP BY snapshot_date)
        SELECT r.snapshot_date, r.stage, count(*) AS n_rounds, CAST(sum(r.amount_usd) AS DOUBLE) AS total, max(b.n) AS n_urgent
        FROM funding_rounds r JOIN busy b ON r.snapshot_date = b.day WHERE year(b.day) > 1996
        GROUP BY r.snapshot_date, r.stage""")


O_ADHOC_SNAPSHOTS = """
WITH s AS (SELECT make_date(CAST(year(announced_on) AS BIGINT), 12, 31) AS snapshot_date, * FROM funding_rounds WHERE year(announced_on) IN (1996, 1997, 1998)),
busy AS (SELECT snapshot_date AS day, count(*) AS n FROM s WHERE investment_type = '1-URGENT' GROUP BY snapshot_date)
SELECT s.snapshot_date, s.stage, count(*) AS n_rounds, CAST(sum(s.amount_usd) AS DOUBLE) AS total, max(b.n) AS n_urgent
FROM s JOIN busy b ON s.snapshot_date = b.day WHERE year(b.day) > 1996
GROUP BY s.snapshot_date, s.stage"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "adhoc_snapshots": q_adhoc_snapshots,
    "import_organizations": _import_query("organizations"),
    "import_funding_rounds": _import_query("funding_rounds"),
    "import_investments": _import_query("investments"),
    "import_report": q_import_report,
    "missing_collections": q_missing_collections,
    "adhoc_sql": q_adhoc_sql,
    "company_report_companies": q_company_report_companies,
    "company_report_by_type": q_company_report_by_type,
    "enrich_since": q_enrich_since,
    "investor_portfolio_newest": q_investor_portfolio_newest,
    "rounds_by_uuid_else_name": q_rounds_by_uuid_else_name,
    "match_short_urls": q_match_short_urls,
    "normalize_url": q_normalize_url,
    "match_urls": q_match_urls,
    "match_urls_outer": q_match_urls_outer,
    "rounds_listing": q_rounds_listing,
    "rounds_by_name": q_rounds_by_name,
    "rounds_with_investors": q_rounds_with_investors,
    "company_info": q_company_info,
    "funding_text": q_funding_text,
    "total_funding": q_total_funding,
    "quarterly_funding": q_quarterly_funding,
    "quarterly_pivot": q_quarterly_pivot,
    "quarter_series": q_quarter_series,
    "quarter_axis": q_quarter_axis,
    "parse_quarter": q_parse_quarter,
    "funding_summary": q_funding_summary,
    "rounds_by_type": q_rounds_by_type,
    "format_currency": q_format_currency,
    "organizations_by_category": q_organizations_by_category,
    "top_funded": q_top_funded,
    "category_export": q_category_export,
    "investor_portfolio": q_investor_portfolio,
    "top_investors": q_top_investors,
    "recent_rounds": q_recent_rounds,
    "quarterly_trend": q_quarterly_trend,
    "snapshot_counts": q_snapshot_counts,
    "table_counts": q_table_counts,
    "run_summary": q_run_summary,
    "company_report_rounds": q_company_report_rounds,
    "enrich": q_enrich,
    "enrich_long": q_enrich_long,
    "human_size": q_human_size,
    "latest_snapshot": q_latest_snapshot,
    "quarter_axis_since": q_quarter_axis_since,
    "company_report_summary": q_company_report_summary,
}

# views each oracle needs, prepended as CTEs (the driver registers base tables only)
_VIEWS_FOR = {
    "normalize_url": ["page_lookup", "lookup"],
    "match_urls": ["page_lookup", "page_orgs"],
    "match_urls_outer": ["lookup", "organizations"],
    "rounds_listing": ["funding_rounds"],
    "rounds_by_name": ["organizations", "funding_rounds"],
    "rounds_with_investors": ["funding_rounds", "investments"],
    "company_info": ["organizations"],
    "funding_text": ["funding_rounds", "investments"],
    "total_funding": ["funding_rounds"],
    "quarterly_funding": ["funding_rounds"],
    "quarterly_pivot": ["funding_rounds"],
    "quarter_series": ["organizations"],
    "quarter_axis": ["organizations"],
    "parse_quarter": [],
    "funding_summary": ["funding_rounds"],
    "rounds_by_type": ["funding_rounds"],
    "format_currency": ["funding_rounds"],
    "organizations_by_category": ["organizations"],
    "top_funded": ["organizations"],
    "category_export": ["organizations"],
    "investor_portfolio": ["organizations", "funding_rounds", "investments"],
    "top_investors": ["investments"],
    "recent_rounds": ["organizations", "funding_rounds"],
    "quarterly_trend": ["funding_rounds"],
    "snapshot_counts": [],
    "table_counts": [],
    "run_summary": ["lookup", "organizations"],  # series CTE reads organizations
    "company_report_rounds": ["lookup", "organizations", "funding_rounds"],
    "enrich": ["lookup", "organizations", "funding_rounds", "investments"],
    "enrich_long": ["lookup", "organizations", "funding_rounds"],
    "human_size": [],
    "latest_snapshot": [],
    "quarter_axis_since": ["organizations"],
    "company_report_summary": ["lookup", "organizations", "funding_rounds"],
    "company_report_companies": ["lookup", "organizations"],
    "company_report_by_type": ["lookup", "organizations", "funding_rounds"],
    "enrich_since": ["lookup", "organizations", "funding_rounds", "investments"],
    "investor_portfolio_newest": ["organizations", "funding_rounds", "investments"],
    "rounds_by_uuid_else_name": ["organizations", "funding_rounds"],
    "match_short_urls": [],
    "import_organizations": ["organizations"],
    "import_funding_rounds": ["funding_rounds"],
    "import_investments": ["investments"],
    "import_report": ["organizations", "investments"],
    "missing_collections": [],
    "adhoc_sql": ["organizations", "funding_rounds"],
    "adhoc_snapshots": ["funding_rounds"],
}

_RAW_ORACLE = {
    "import_organizations": _o_import("organizations"),
    "import_funding_rounds": _o_import("funding_rounds"),
    "import_investments": _o_import("investments"),
    "import_report": O_IMPORT_REPORT,
    "missing_collections": "SELECT unnest([" + ", ".join(f"'{c}'" for c in COLLECTIONS if c not in ("organizations", "funding_rounds")) + "]) AS collection",
    "adhoc_sql": O_ADHOC_SQL,
    "adhoc_snapshots": O_ADHOC_SNAPSHOTS,
    "company_report_companies": O_COMPANY_REPORT_COMPANIES,
    "company_report_by_type": O_COMPANY_REPORT_BY_TYPE,
    "enrich_since": _o_enrich(AXIS_SINCE, 'l.website AS "Website", l.company AS "Founded", l.row_id AS "Host", upper(l.company) AS "Total_Funding"'),
    "investor_portfolio_newest": O_INVESTOR_PORTFOLIO_NEWEST,
    "rounds_by_uuid_else_name": O_ROUNDS_BY_UUID_ELSE_NAME,
    "match_short_urls": O_MATCH_SHORT_URLS,
    "normalize_url": O_NORMALIZE_URL,
    "match_urls": O_MATCH_URLS,
    "match_urls_outer": O_MATCH_URLS_OUTER,
    "rounds_listing": O_ROUNDS_LISTING,
    "rounds_by_name": O_ROUNDS_BY_NAME,
    "rounds_with_investors": O_ROUNDS_WITH_INVESTORS,
    "company_info": O_COMPANY_INFO,
    "funding_text": O_FUNDING_TEXT,
    "total_funding": O_TOTAL_FUNDING,
    "quarterly_funding": O_QUARTERLY_FUNDING,
    "quarterly_pivot": _o_quarterly_pivot(),
    "quarter_series": O_QUARTER_SERIES,
    "quarter_axis": O_QUARTER_AXIS,
    "parse_quarter": O_PARSE_QUARTER,
    "funding_summary": O_FUNDING_SUMMARY,
    "rounds_by_type": O_ROUNDS_BY_TYPE,
    "format_currency": O_FORMAT_CURRENCY,
    "organizations_by_category": O_ORGANIZATIONS_BY_CATEGORY,
    "top_funded": O_TOP_FUNDED,
    "category_export": O_CATEGORY_EXPORT,
    "investor_portfolio": O_INVESTOR_PORTFOLIO,
    "top_investors": O_TOP_INVESTORS,
    "recent_rounds": O_RECENT_ROUNDS,
    "quarterly_trend": O_QUARTERLY_TREND,
    "snapshot_counts": O_SNAPSHOT_COUNTS,
    "table_counts": O_TABLE_COUNTS,
    "run_summary": O_RUN_SUMMARY,
    "company_report_rounds": O_COMPANY_REPORT_ROUNDS,
    "enrich": _o_enrich(),
    "enrich_long": O_ENRICH_LONG,
    "human_size": O_HUMAN_SIZE,
    "latest_snapshot": O_LATEST_SNAPSHOT,
    "quarter_axis_since": O_QUARTER_AXIS + f"\nWHERE CAST(split_part(quarter, ' Q', 1) AS INTEGER) >= {AXIS_SINCE}",
    "company_report_summary": O_COMPANY_REPORT_SUMMARY,
}


def _merge_ctes(views: list[str], sql: str) -> str:
    """Put view CTEs in front of ``sql``, merging with its own WITH if any."""
    if not views:
        return sql
    head = ",\n".join(f"{v} AS ({TV.VIEW_SQL[v]})" for v in views)
    body = sql.lstrip()
    if body[:5].upper() == "WITH ":
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"


ORACLE: dict[str, str] = {k: _merge_ctes(_VIEWS_FOR[k], v) for k, v in _RAW_ORACLE.items()}
