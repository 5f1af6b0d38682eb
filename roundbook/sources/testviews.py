"""Domain views over the driver's TPC-H-style tables.

These only give rows in the domain schema (stand-in input). Each SQL text
runs unchanged in Spark and in DuckDB, so the oracle queries can embed the
same definitions as CTEs. Formulas here only shape values (NULLs, blanks,
URL spellings); no operator relies on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

VIEW_SQL: dict[str, str] = {
    "organizations": """
SELECT CAST(c.c_custkey AS STRING) AS org_uuid,
       c.c_name AS name,
       CASE WHEN c.c_custkey % 5 = 4 THEN NULL
            ELSE concat('https://www.cust', CAST(c.c_custkey AS STRING), '.example.com/') END AS website,
       CASE WHEN c.c_custkey % 3 = 0
            THEN concat('http://cust', CAST(c.c_custkey AS STRING), '.example.com/home') END AS website_url,
       CASE WHEN c.c_custkey % 6 = 1 THEN concat('About ', c.c_name) END AS description,
       concat(c.c_mktsegment, ' company in ', n.n_name) AS short_description,
       CASE WHEN c.c_custkey % 11 = 0 THEN NULL
            ELSE DATE '1995-01-01' + CAST(c.c_custkey % 700 AS INTEGER) END AS founded_on,
       c.c_mktsegment AS categories,
       r.r_name AS category_groups,
       n.n_name AS location,
       CASE WHEN c.c_acctbal > 5000 THEN 'late_stage' WHEN c.c_acctbal > 0 THEN 'early_stage' END AS funding_stage,
       CASE WHEN c.c_custkey % 9 = 2 THEN 'Seed' END AS investor_stage,
       CAST(nullif(round(c.c_acctbal), 0) AS DECIMAL(20,2)) AS funding_total_usd,
       CAST(c.c_nationkey AS BIGINT) AS num_funding_rounds,
       CAST(c.c_custkey % 4 AS BIGINT) AS num_investors
FROM customer c
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
""",
    "funding_rounds": """
SELECT CAST(o_orderkey AS STRING) AS round_uuid,
       CASE WHEN o_orderkey % 19 = 7 THEN NULL ELSE concat('Round ', CAST(o_orderkey AS STRING)) END AS round_name,
       CAST(o_custkey AS STRING) AS org_uuid,
       concat('Customer#', lpad(CAST(o_custkey AS STRING), 9, '0')) AS org_name,
       CAST(o_orderdate AS DATE) AS announced_on,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + 20 END AS closed_on,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL
            WHEN o_orderkey % 17 = 0 THEN CAST(0 AS DECIMAL(20,2))
            ELSE CAST(o_totalprice AS DECIMAL(20,2)) END AS amount_usd,
       'USD' AS currency,
       o_orderpriority AS investment_type,
       o_orderstatus AS stage,
       CAST(NULL AS BIGINT) AS num_investors,
       CASE WHEN o_orderkey % 4 = 1 THEN CAST(o_totalprice * 10 AS DECIMAL(20,2)) END AS post_money_usd,
       CASE WHEN o_orderkey % 4 = 1 THEN CAST(o_totalprice * 9 AS DECIMAL(20,2)) END AS pre_money_usd,
       CASE WHEN o_orderkey % 5 = 2 THEN concat(o_orderpriority, ' round') END AS short_description
FROM orders
""",
    "investments": """
SELECT CAST(l.l_orderkey AS STRING) AS round_uuid,
       CASE WHEN s.s_suppkey % 7 = 0 THEN NULL ELSE s.s_name END AS investor_name,
       CASE l.l_returnflag WHEN 'R' THEN true WHEN 'A' THEN false END AS is_lead,
       CASE WHEN l.l_linenumber % 3 = 0 THEN NULL ELSE CAST(l.l_extendedprice AS DECIMAL(20,2)) END AS amount_usd
FROM lineitem l
JOIN supplier s ON l.l_suppkey = s.s_suppkey
""",
    # one lookup row per customer; URL spellings vary, some cells are blank
    "lookup": """
SELECT c_custkey AS row_id,
       c_name AS company,
       CASE WHEN c_custkey % 13 = 12 THEN '  '
            WHEN c_custkey % 17 = 16 THEN concat('https://nosuch', CAST(c_custkey AS STRING), '.org/')
            WHEN c_custkey % 7 = 3 THEN concat('cust', CAST(c_custkey AS STRING), '.example')
            WHEN c_custkey % 7 = 5 THEN concat('HTTP://WWW.CUST', CAST(c_custkey AS STRING), '.EXAMPLE.COM/About')
            ELSE concat('https://cust', CAST(c_custkey AS STRING), '.example.com/about') END AS website
FROM customer
""",
    # web pages as organizations: realistic URL text for the containment join
    "page_orgs": """
SELECT CAST(page_id AS STRING) AS org_uuid,
       CASE WHEN page_id % 3 = 0 THEN NULL ELSE url END AS website,
       CASE WHEN page_id % 3 <> 1 THEN upper(url) END AS website_url
FROM pages
""",
    # page URLs, and the same URLs with their first host label removed
    "page_lookup": """
SELECT page_id * 2 AS row_id, url FROM pages
UNION ALL
SELECT page_id * 2 + 1 AS row_id,
       regexp_replace(url, '^(https?://)?(www[.])?[^./]*[.]', '') AS url
FROM pages
""",
}

# view → views it reads (beyond the base tables)
VIEW_ORDER = ["organizations", "funding_rounds", "investments", "lookup", "page_orgs", "page_lookup"]


def register_tables(spark: SparkSession, sf_dir: str, tables: list[str] | None = None) -> None:
    """Register the driver parquet tables as temp views of the same name."""
    for t in tables or TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)


def load(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All base tables and domain views as DataFrames (temp views registered)."""
    register_tables(spark, sf_dir)
    out = {t: spark.table(t) for t in TABLES}
    for name in VIEW_ORDER:
        df = spark.sql(VIEW_SQL[name])
        df.createOrReplaceTempView(name)
        out[name] = df
    return out
