"""How far the sources of each language differ in their words.

Terms are runs of letters and other characters beyond ASCII, A-Z lower-cased.
Tasks pack them into 64-bit numbers by length buckets, sort these by radix and
count the runs (:mod:`.packed`); Spark adds the counts up by term and keeps the
terms that enough documents of the language hold. A source's smoothed share of
each kept term is compared with that of every other source, and with the
language's.

A frequent term or a hot source costs a row per task and term. The pairs of
sources are compared in blocks of terms, as a dense table of shares per block;
what comes out is a sum per pair and block, since the result itself has a row
per ordered pair.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written
from .counting import Counter
from .packed import words_in

SCALE, SMOOTH, MIN_DOCS, TOP = 1_000_000_000, 2, 10, 10
#: Rows, and compared shares, that a block of terms has at most, about.
BLOCK_ROWS, BLOCK_PAIRS = 50_000, 2_000_000_000
#: Cells of the table of shares that a block works on at a time.
CELLS = 1_000_000

#: Bytes of terms, lower-cased; 0 where a byte ends a term.
LOWER = np.zeros(256, np.uint8)
LOWER[0x41:0x5B] = np.arange(0x61, 0x7B)
LOWER[0x61:0x7B] = np.arange(0x61, 0x7B)
LOWER[0x80:] = np.arange(0x80, 0x100)

_KEY = ["w0", "w1", "rest"]
_COUNTS = "lang string, source string, w0 long, w1 long, rest binary, n long, docs long"


def split_terms(data: np.ndarray, offsets: np.ndarray):
    """Lower-cased bytes, and start, end and text number of every term."""
    low = LOWER[data]
    return low, *words_in(low, offsets, low > 0)


def term_counts(docs: DataFrame, *, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``(lang, source, w0, w1, rest, n, docs)``: how often each group of each task holds
    each term, and in how many rows. Each group also has a row without a term."""
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    counted = named.mapInArrow(lambda batches: Counter(split_terms, keys=2).run(batches), _COUNTS)
    return counted.withColumn("rest", F.col("rest").cast("string"))


def _term() -> Column:
    """The text of a term: of a packed one, its bytes without the padding."""
    bytes_of = lambda c: F.unhex(F.lpad(F.hex(c), 16, "0"))
    return F.coalesce(F.col("rest"), F.rtrim(F.concat(bytes_of("w0"), bytes_of("w1")).cast("string"), F.lit("\0")))


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS, **columns: str) -> DataFrame:
    """``(lang, source, term, n, lang_n, first)``: counts of the terms that at least
    ``min_docs`` rows of the language hold. ``first`` is 1 in one row of each (lang,
    term). Each group also has a row without a term."""
    # One shuffle: rows dealt by (lang, term) are dealt well for (lang, source, term) too.
    dealt = term_counts(docs, **columns).repartition("lang", *_KEY)
    by_source = dealt.groupBy("lang", *_KEY, "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", *_KEY)
    spread = by_source.select(
        "*", F.sum("n").over(term).alias("lang_n"), F.sum("docs").over(term).alias("lang_docs"),
        F.when(F.row_number().over(term.orderBy("source")) == 1, 1).otherwise(0).alias("first"))
    no_term = F.col("w0").isNull() & F.col("rest").isNull()
    return spread.filter(no_term | (F.col("lang_docs") >= min_docs)).select(
        "lang", "source", F.when(~no_term, _term()).alias("term"), "n", "lang_n", "first")


def _share(count: str, total: str) -> Column:
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * V)), exactly."""
    return F.expr(f"1 + (cast({count} + {SMOOTH} as decimal(20,0)) * cast({SCALE} as decimal(10,0))) div cast({total} + {SMOOTH} * n_terms as decimal(20,0))")


def _divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)); shares are at most SCALE + 1, so all fits 64 bits."""
    d = p - q
    return (d * d) // (p + q)


def _pair_sums(pdf: pd.DataFrame) -> pd.DataFrame:
    """Of one block of terms: the summed divergence of each pair of sources.

    Rows without a term hold each source's share of a term that it lacks.
    """
    lack = pdf["term"].isna().to_numpy()
    base = np.zeros(int(lack.sum()), np.int64)
    base[pdf["place"].to_numpy()[lack]] = pdf["p"].to_numpy()[lack]
    term, names = pd.factorize(pdf["term"][~lack])
    order = np.argsort(term, kind="stable")
    term, place, p = term[order], pdf["place"].to_numpy()[~lack][order], pdf["p"].to_numpy()[~lack][order]
    sums, step = np.zeros((len(base), len(base)), np.int64), max(1, CELLS // len(base))
    for low in range(0, len(names), step):
        a, b = np.searchsorted(term, [low, low + step])
        shares = np.repeat(base[:, None], min(step, len(names) - low), axis=1)
        shares[place[a:b], term[a:b] - low] = p[a:b]
        for k in range(len(base) - 1):
            sums[k, k + 1 :] += _divergence(shares[k], shares[k + 1 :]).sum(axis=1)
    i, j = np.triu_indices(len(base), 1)
    return pd.DataFrame({"lang": pdf["lang"].iloc[0], "a": i, "b": j, "value": sums[i, j]})


def source_divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, **columns: str) -> DataFrame:
    """``(lang, source, part, item, value, rank)``.

    Part ``pair``: every other source of the language and the summed divergence
    from it; part ``term``: the ``top`` terms whose share in the source exceeds
    that in the language most. Ranks go by value descending, then by item's bytes.

    Null text, lang and source read as ''. Every row is a document, repeated ids
    included. A group without terms takes part with the shares of absent terms; in
    a language without kept terms every pair has value 0 and no group has terms; a
    language of one source has no pairs. An empty input gives no rows; other
    columns are not read. ``columns`` names lang, source and text if they differ.
    """
    kept = written(kept_terms(docs, min_docs, **columns), "kept-terms")
    lang = Window.partitionBy("lang")
    totals = kept.groupBy("lang", "source").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.sum(F.when(F.col("term").isNotNull(), F.col("first")).otherwise(0)).alias("firsts"),
        F.count("term").alias("rows"))
    groups = totals.select(
        "lang", "source", "total", F.sum("total").over(lang).alias("lang_total"), F.sum("firsts").over(lang).alias("n_terms"),
        (F.row_number().over(lang.orderBy("source")) - 1).cast("int").alias("place"),
        F.sum("rows").over(lang).alias("rows"), F.count("*").over(lang).alias("n_sources"))
    groups = written(groups.select(
        "*", F.greatest(F.lit(1), F.ceil(F.col("rows") / BLOCK_ROWS), F.ceil(F.col("n_terms") * F.col("n_sources") * F.col("n_sources") / BLOCK_PAIRS)).cast("int").alias("n_blocks")), "groups")

    rows = kept.filter("term is not null").join(groups.select("lang", "source", "total", "lang_total", "n_terms", "place", "n_blocks"), ["lang", "source"])
    shares = rows.select("lang", "source", "term", "place", _share("n", "total").alias("p"), _share("lang_n", "lang_total").alias("q"),
                         F.pmod(F.xxhash64("term"), "n_blocks").cast("int").alias("block"))

    lacking = groups.filter("n_terms > 0").select(
        "lang", F.lit(None).cast("string").alias("term"), "place", _share("0", "total").alias("p"),
        F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block"))
    blocks_of = shares.select("lang", "term", "place", "p", "block").unionByName(lacking)
    sums = blocks_of.groupBy("lang", "block").applyInPandas(_pair_sums, "lang string, a int, b int, value long").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    names = groups.select("lang", "place", "source", "n_sources")
    both = sums.select("lang", "value", F.explode(F.array(F.struct(F.col("a").alias("place"), F.col("b").alias("other")), F.struct(F.col("b").alias("place"), F.col("a").alias("other")))).alias("s")).select("lang", "s.place", "s.other", "value")
    found = both.join(names.select("lang", "place", "source"), ["lang", "place"]).join(
        names.select("lang", F.col("place").alias("other"), F.col("source").alias("item")), ["lang", "other"]).select("lang", "source", "item", "value")
    bare = groups.filter("n_terms = 0").select("lang", "source", F.col("place").alias("at"))
    nothing = bare.join(bare.select("lang", F.col("source").alias("item"), F.col("at").alias("other")), "lang").filter("at <> other").select("lang", "source", "item", F.lit(0).cast("long").alias("value"))

    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(by_value).alias("rank"))
    terms = shares.filter("p > q").select("lang", "source", F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    return ranked(found.unionByName(nothing), "pair").unionByName(ranked(terms, "term").filter(F.col("rank") <= top))
