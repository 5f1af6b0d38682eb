"""Benchmark decontamination by winnowing, in DataFrame functions alone.

Of every ``WINDOW`` consecutive words the smallest hash among its ``GRAM``-word
grams is a fingerprint. Two texts that share a whole window share its
fingerprint, so an equality join of the documents' fingerprints with the
benchmark's meets every shared window. Each meeting is extended word by word to
both sides (as far as a window reaches); where at least ``WINDOW`` words agree,
those words are hit. Items of fewer words are one window of their own length,
and every gram of that length is a fingerprint.

Words travel as 64-bit hashes. Long texts are cut into overlapping chunks of
``CHUNK`` words, so no row grows with a document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns, unused, written

WINDOW, GRAM, CHUNK = 10, 5, 1024
#: Benchmark fingerprints (about 200 bytes each) that may be broadcast; beyond, the join shuffles.
BROADCAST_ROWS = 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BITS = 11  # of a position in a chunk: CHUNK + WINDOW - 1 < 2 ** _BITS


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once a row, also where ``use``
    refers to it inside a function over an array."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def word_hashes(text: Column) -> Column:
    """Hashes of a text's words: A-Z lower-cased, broken at ASCII other than
    letters and digits; none for null."""
    words = F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), _BREAK), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _chunks(rows: DataFrame) -> DataFrame:
    """``rows`` (with w: word hashes) as chunks: base, c (the chunk's words)."""

    def cut(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - 1, F.lit(0)), F.lit(CHUNK))
        return F.transform(starts, lambda i: F.struct(i.alias("base"), F.slice(w, i + 1, F.lit(CHUNK + WINDOW - 1)).alias("c")))

    parts = _once(F.col("w"), cut)
    return rows.withColumn("part", F.explode(parts)).select("*", "part.base", "part.c").drop("part", "w")


def _gram_at(c: Column, i: Column, n: int) -> Column:
    """Hash of ``n`` words from ``i`` on, its low bits replaced by ``i``."""
    return F.xxhash64(F.slice(c, i + 1, F.lit(n))).bitwiseAND(F.lit(-(1 << _BITS))).bitwiseOR(i.cast("long"))


def _marks(c: Column, n: int) -> Column:
    """Distinct (hash, position) fingerprints of a chunk for windows of ``n`` words."""
    gram = min(n, GRAM) if n == WINDOW else n
    grams = F.transform(F.sequence(F.lit(0), F.size(c) - gram), lambda i: _gram_at(c, i, gram))
    if n == WINDOW:
        width = WINDOW - GRAM + 1
        grams = F.array_distinct(_once(grams, lambda g: F.transform(F.sequence(F.lit(1), F.size(c) - WINDOW + 1), lambda j: F.array_min(F.slice(g, j, F.lit(width))))))
    reach = WINDOW - GRAM if n == WINDOW else 0
    position = lambda v: v.bitwiseAND(F.lit((1 << _BITS) - 1)).cast("int")

    def mark(v: Column) -> Column:
        lead = F.least(position(v), F.lit(reach))
        around = F.slice(c, position(v) - lead + 1, lead + gram + reach)
        return F.struct(F.lit(n).alias("n"), F.shiftright(v, _BITS).alias("h"), position(v).alias("at"), lead.alias("lead"), around.alias("around"))

    none = F.expr("cast(array() as array<struct<n:int,h:bigint,at:int,lead:int,around:array<bigint>>>)")
    return F.when(F.size(c) >= n, F.transform(grams, mark)).otherwise(none)


def _agreeing(a: Column, a0: Column, b: Column, b0: Column, step: int, most: Column) -> Column:
    """How many words agree from a[a0] and b[b0] on, in direction ``step``."""
    same = lambda k: F.get(a, a0 + (k - 1) * step) == F.get(b, b0 + (k - 1) * step)
    return F.aggregate(F.sequence(F.lit(0), F.greatest(most, F.lit(0))), F.lit(0), lambda s, k: F.when((k > 0) & (s == k - 1) & same(k), k).otherwise(s))


def _benchmark(items: DataFrame) -> tuple[DataFrame, DataFrame, list[int]]:
    """Distinct item texts (tid, item_id), their fingerprints with the tids
    that have them, and the window lengths there are."""
    rows = items.select("item_id", word_hashes(F.col("text")).alias("w")).filter(F.size("w") > 0)
    rows = written(rows.withColumn("tid", F.xxhash64("w")), "benchmark")
    texts = rows.groupBy("tid").agg(F.first("w").alias("w"))
    lengths = [r["n"] for r in texts.select(F.least(F.size("w"), F.lit(WINDOW)).alias("n")).distinct().collect()]
    chunks = _chunks(texts.withColumn("n", F.least(F.size("w"), F.lit(WINDOW))))
    marks = [chunks.filter(F.col("n") == n).select("tid", F.explode(_marks(F.col("c"), n)).alias("m")) for n in lengths]
    if not marks:
        return rows.select("tid", "item_id"), rows.sparkSession.createDataFrame([], "n int, h long, lead int, around array<long>, tids array<long>"), []
    found = marks[0]
    for m in marks[1:]:
        found = found.unionByName(m)
    found = found.groupBy("m.n", "m.h", "m.lead", "m.around").agg(F.collect_set("tid").alias("tids"))
    return rows.select("tid", "item_id"), written(found, "benchmark-marks"), sorted(lengths)


def contamination(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_hit, n_items, item_ids (sorted as
    strings), contaminated, and the hit word ranges (start, end exclusive).

    Null, empty and wordless texts have no words and no hits; so do items
    without words, which never match. Repeated rows are reported as often as
    they come; equal items all count. Null ids are kept. Without documents
    there are no rows; without items, no hits. Other columns are not read.
    """
    texts, bench, lengths = _benchmark(items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("t"), word_hashes(F.col(text)).alias("w"))
    chunks = _chunks(rows.withColumn("n_words", F.size("w").cast("long")))
    # The first mark of a chunk stands for the chunk itself; it meets no fingerprint.
    itself = F.struct(F.lit(0).alias("n"), F.xxhash64("doc_id", "t").alias("h"), F.lit(0).alias("at"), F.lit(0).alias("lead"), F.expr("cast(array() as array<bigint>)").alias("around"))
    marks = F.concat(F.array(itself), *(_marks(F.col("c"), n) for n in lengths))
    marked = chunks.select("doc_id", "t", "n_words", "base", F.explode(marks).alias("m")).select("doc_id", "t", "n_words", "base", "m.*")
    b = bench.select("n", "h", F.col("lead").alias("lead2"), F.col("around").alias("around2"), "tids")
    b = F.broadcast(b) if bench.count() <= BROADCAST_ROWS else b
    met = marked.join(b, ["n", "h"], "left").filter("n = 0 OR tids IS NOT NULL")
    gram = F.when(F.col("n") == WINDOW, GRAM).otherwise(F.col("n"))
    a, a0, o, o0 = F.col("around"), F.col("lead"), F.col("around2"), F.col("lead2")
    left = _agreeing(a, a0 - 1, o, o0 - 1, -1, F.least(a0, o0))
    right = _agreeing(a, a0, o, o0, 1, F.least(F.size(a) - a0, F.size(o) - o0))
    met = met.withColumn("l", F.when(F.col("n") > 0, left)).withColumn("r", F.when(F.col("n") > 0, right))
    met = met.filter((F.col("n") == 0) | ((F.col("r") >= gram) & (F.col("l") + F.col("r") >= F.col("n"))))
    first = F.col("base") + F.col("at")
    span = F.when(F.col("n") > 0, F.struct((first - F.col("l")).alias("start"), (first + F.col("r")).alias("end")))
    once = F.sum(F.when((F.col("n") == 0) & (F.col("base") == 0), 1)).alias("copies")
    found = met.groupBy("doc_id", "t", "n_words").agg(once, F.collect_set(span).alias("spans"), F.array_distinct(F.flatten(F.collect_set("tids"))).alias("tids"))
    merged = F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda s, x: F.struct((s["n"] + F.greatest(x["end"] - F.greatest(x["start"], s["end"]), F.lit(0))).alias("n"), F.greatest(s["end"], x["end"]).alias("end")),
    )
    found = written(found.withColumn("n_hit", merged["n"]), "hits")
    listed = found.filter(F.size("tids") > 0).select("doc_id", "t", F.explode("tids").alias("tid")).join(texts, "tid")
    listed = listed.groupBy("doc_id", "t").agg(F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("item_ids"))
    both = found.alias("f").join(listed.alias("i"), F.expr("f.t = i.t AND f.doc_id <=> i.doc_id"), "left")
    out = both.select("f.doc_id", "f.copies", "f.n_words", "f.n_hit", F.coalesce("i.item_ids", F.expr("cast(array() as array<string>)")).alias("item_ids"), F.array_sort("f.spans").alias("spans"))
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), "item_ids", (F.col("n_hit") > 0).alias("contaminated"), "spans")


def clean(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a window of an item; columns stay as
    they are. Rows are told apart by id and text, so repeated rows share a fate."""
    mark = unused(docs, "_text")
    keyed = docs.select("*", F.xxhash64(F.col(text)).alias(mark))
    key = F.struct(F.col(doc_id).alias("id"), F.col(mark).alias("hash")).alias("key")
    found = contamination(keyed.select(key, F.col(text).alias("text")), items, doc_id="key").filter("contaminated")
    hit_id, hit_mark = unused(keyed, "_id"), unused(keyed, "_hash")
    hit = found.select(F.col("doc_id.id").alias(hit_id), F.col("doc_id.hash").alias(hit_mark)).distinct()
    return keyed.join(hit, F.col(doc_id).eqNullSafe(F.col(hit_id)) & (F.col(mark) == F.col(hit_mark)), "left_anti").select(*columns(docs))
