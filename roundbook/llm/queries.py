"""Registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, collocation, decontam, divergence, encoding, html_text, langid, packing, pii, quality, simhash, substring, tokens, toxicity
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-ID output of all documents, read back from the files."""
    manifest = tokens.write_tokens(table(spark, sf_dir, "documents"), encoding.default_tokenizer(), end_id=2)
    return tokens.read_tokens(manifest)


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best-fit packing of all documents into sequences of 2048 tokens."""
    pieces = packing.encode_pieces(table(spark, sf_dir, "documents"), encoding.default_tokenizer(), end_id=0)
    packed = packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicate components of all documents."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: counts and digests of the spans."""
    found = pii.report(table(spark, sf_dir, "documents"))
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    joined = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(joined(of(*pii.BASE)), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id"), 4, 2).alias("held_out"), F.col("_score").alias("score"), F.col("_toxic").alias("predicted"))


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id"), 5, 0).alias("held_out"), F.col("_score").alias("score"), F.col("_good").alias("predicted"))


@query
def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    found = html_text.main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", F.col("_text").alias("text"), F.char_length("_text").cast("long").alias("n_chars"))


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in all documents."""
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", items, "contaminated")


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Removal of repeated 35-word windows from all documents."""
    done = substring.remove_repeats(table(spark, sf_dir, "documents"), window=35)
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest of all embeddings, for every id divisible by 100."""
    rows = table(spark, sf_dir, "embeddings")
    return ann.search(rows, rows.filter(F.col("vec_id") % 100 == 0), k=10)


@query
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of the sources of each language, for all documents."""
    return divergence.source_divergence(table(spark, sf_dir, "documents"), min_docs=10, top=10)


@query
def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents."""
    return langid.language(table(spark, sf_dir, "documents"))


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 closest phrases of each language, from all documents."""
    return collocation.collocations(table(spark, sf_dir, "documents"), min_count=10, top=2000)


# Words of op5 and op6, and their windows, as DuckDB lists.
ORACLE["op5_decontamination"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
       FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized) x),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM sized) l WHERE len(w) >= n) x),
m AS (SELECT doc_id, n, i, item_id FROM dw JOIN bw USING (n, s)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) x GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) x GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits ON d.doc_id = hits.doc_id LEFT JOIN items ON d.doc_id = items.doc_id"""

ORACLE["op6_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d) x),
rep AS (SELECT s FROM win GROUP BY s HAVING count(*) > 1),
hit AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 35)) AS p FROM win WHERE s IN (SELECT s FROM rep)) x),
words AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT words.doc_id, count(hit.p) AS n_removed, string_agg(x, ' ' ORDER BY words.p) FILTER (WHERE hit.p IS NULL) AS t
         FROM words LEFT JOIN hit ON words.doc_id = hit.doc_id AND words.p = hit.p GROUP BY words.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id"""

ORACLE["op11_source_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
occ AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM occ GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
grp AS (SELECT DISTINCT lang, source FROM d),
lang_sums AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
counted AS (SELECT lang, source, term, count(*) AS n FROM occ SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
cells AS (SELECT g.lang, g.source, k.term, k.n AS lang_n, coalesce(c.n, 0) AS n
          FROM grp g JOIN kept k ON g.lang = k.lang LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (SELECT lang, source, sum(n) AS total FROM cells GROUP BY lang, source),
p AS (SELECT c.lang, c.source, c.term, c.n,
             1 + CAST(1000000000 AS HUGEINT) * (c.n + 2) // (s.total + 2 * l.v) AS p,
             1 + CAST(1000000000 AS HUGEINT) * (c.lang_n + 2) // (l.total + 2 * l.v) AS q
      FROM cells c JOIN sums s ON c.lang = s.lang AND c.source = s.source JOIN lang_sums l ON c.lang = l.lang),
pair_sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
              FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
rows AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
         FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
         LEFT JOIN pair_sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
         UNION ALL
         SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM rows)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10"""

ORACLE["op13_collocations"] = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang,
                       unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                 '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
f1 AS (SELECT lang, w1, count(*) AS f FROM (SELECT lang, unnest(w) AS w1 FROM w) x GROUP BY lang, w1),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM (SELECT lang, w[i] AS w1, w[i + 1] AS w2 FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM w) y) x
       GROUP BY lang, w1, w2 HAVING count(*) >= 10),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f
       FROM (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3 FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM w) y) x
       GROUP BY lang, w1, w2, w3 HAVING count(*) >= 10),
longer AS (SELECT lang, w1, w2, max(f) AS f FROM (SELECT lang, w1, w2, f FROM f3 UNION ALL SELECT lang, w2, w3, f FROM f3) x GROUP BY lang, w1, w2),
cuts AS (SELECT p.lang, p.w1 || ' ' || p.w2 AS phrase, 1 AS k, p.f AS a, a.f AS l, b.f AS r
         FROM f2 p JOIN f1 a ON a.lang = p.lang AND a.w1 = p.w1 JOIN f1 b ON b.lang = p.lang AND b.w1 = p.w2
         LEFT JOIN longer x ON x.lang = p.lang AND x.w1 = p.w1 AND x.w2 = p.w2 WHERE x.f IS NULL OR 100 * x.f < 50 * p.f
         UNION ALL
         SELECT p.lang, p.w1 || ' ' || p.w2 || ' ' || p.w3, 1, p.f, a.f, b.f
         FROM f3 p JOIN f1 a ON a.lang = p.lang AND a.w1 = p.w1 JOIN f2 b ON b.lang = p.lang AND b.w1 = p.w2 AND b.w2 = p.w3
         UNION ALL
         SELECT p.lang, p.w1 || ' ' || p.w2 || ' ' || p.w3, 2, p.f, a.f, b.f
         FROM f3 p JOIN f2 a ON a.lang = p.lang AND a.w1 = p.w1 AND a.w2 = p.w2 JOIN f1 b ON b.lang = p.lang AND b.w1 = p.w3),
scored AS (SELECT *, CAST(1000000 AS HUGEINT) * a * a // (CAST(l AS HUGEINT) * r) AS score FROM cuts),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best),
totals AS (SELECT lang, sum(f) AS n FROM f1 GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""
