"""URL → organization matching (J1): one company per lookup host.

Semantics: a host matches an organization whose lower-cased ``website`` or
``website_url`` *contains* the host (a literal substring test). Among the
matches, one whose URL normalises to exactly the host wins, then the lowest
``org_uuid`` — a deterministic version of the reference's ``LIMIT 1``.

Plan, all equi-joins (no nested loop, no cross join):

0. hosts become distinct, and org URLs one row per text with its lowest
   ``org_uuid``; both are dealt to many tasks and written once;
1. *gram tier* — hosts of length >= ``k``: the frequency of every ``k``-gram of
   the org URLs is counted where the URLs are read (a partial aggregation, so
   a gram that nearly all URLs have costs one row per task); each host keeps
   only its rarest gram. Where more than ``MAX_URLS`` URLs have it, the gram grows to
   the whole host at once: each place of the gram in a URL is widened by the
   offsets and lengths of the hosts that chose it (a few shapes per gram, however
   many the hosts), and the text cut out there is joined with the hosts. So a
   host meets at most ``MAX_URLS`` URLs, or the ones that do contain it. Chosen
   grams, shapes and hosts are broadcast, or else tested as Bloom filters where
   the URLs are read, so what is shuffled is about the matches, not all grams of
   all URLs. Pairs are verified with ``contains``.
   Lossless: a URL containing the host contains each of its grams. An exact
   match (URL normalises to the host) is one of these candidates too, so
   the preference is just a rank computed while verifying;
2. *short tier* — hosts shorter than ``k``: org URLs are exploded into
   their substrings shorter than ``k`` and equi-joined on the host itself
   (printable-ASCII short hosts are a bounded set, broadcast; none → pruned
   at runtime; other short hosts join only non-ASCII substrings).

The winner per host is ``min(struct(rank, org_uuid))``, a partial
aggregation, so a host with millions of candidate companies never needs a
window over one task. Where a side is too large to broadcast, the join is a plain
shuffle, so the session's skew-join setting splits a hot gram or host at run
time. The stored index (bucketed, hence not split at run time) spreads
each gram over a fixed number of salts instead (``spark.roundbook.gramSalts``).
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import normalize_url
from ..plans.config import ensure_checkpoint_dir
from .prefilter import bits_for, bloom, may_be_in

# Reserved name of the match key on lookup rows.
HOST_KEY = "__rb_host"

GRAM = 4
# Hosts whose rarest gram more URLs have than this are looked up as a whole.
MAX_URLS = 100
# Grams, shapes or hosts up to this number are broadcast.
BROADCAST_ROWS = 200_000
# Gram rows of a stored index are spread over this many salts so that a hot
# gram (one shared by a large share of all URLs) is joined by many tasks.
SALTS = 16
SALTS_CONF = "spark.roundbook.gramSalts"


def quote(name: str) -> str:
    """A column name as a SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def _salts(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get(SALTS_CONF, str(SALTS))))


def _replicate(salts: int):
    """Explode a row once per salt value ``0..salts-1``."""
    return F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")


def _grams(text, k: int):
    """Distinct substrings of length ``k`` of ``text`` (empty when shorter)."""
    n = F.length(text) - k + 1
    return F.when(
        n >= 1, F.array_distinct(F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(text, i, k)))
    ).otherwise(F.array().cast("array<string>"))


def org_texts(orgs: DataFrame, uuid_col="org_uuid", url_cols=("website", "website_url")) -> DataFrame:
    """``(org_uuid, text, host)``: one row per non-NULL URL of an organization."""
    urls = F.array(*[F.lower(F.col(c)) for c in url_cols])
    return (
        orgs.select(F.col(uuid_col).alias("org_uuid"), F.explode(urls).alias("text"))
        .where(F.col("text").isNotNull())
        .withColumn("host", normalize_url("text"))
    )


def _lowest(texts: DataFrame) -> DataFrame:
    """``(org_uuid, text, host)``: one row per text, with its lowest ``org_uuid`` (NULL
    first, as in the choice of a winner). Whether a host matches, and how well, is
    a matter of the text alone."""
    lowest = texts.groupBy("text").agg(F.min(F.struct("org_uuid")).alias("o"))
    return lowest.select("o.org_uuid", "text", normalize_url("text").alias("host"))


def _org_grams(texts: DataFrame, k: int) -> DataFrame:
    """``(org_uuid, text, text_host, _p, gram)`` for every ``k``-gram position of
    every org URL. Positions are exploded and cut with ``substring`` in a
    compiled projection (no per-element lambda); a gram repeated inside one
    URL yields a repeated row, which only weighs its frequency and never
    changes a match (the winner is a minimum)."""
    pos = F.explode(F.sequence(F.lit(1), F.length("text") - k + 1)).alias("_p")
    return (
        texts.where(F.length("text") >= k)
        .select("org_uuid", "text", F.col("host").alias("text_host"), pos)
        .select("org_uuid", "text", "text_host", "_p", F.expr(f"substring(text, _p, {int(k)})").alias("gram"))
    )


def _gram_counts(grams: DataFrame) -> DataFrame:
    return grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))


def _union(parts: list[DataFrame], *by: str) -> DataFrame:
    """All versions' rows; dealt anew where there are several, since what a union of
    bucketed scans says of its partitioning can't be relied on."""
    return parts[0] if len(parts) == 1 else reduce(DataFrame.unionByName, parts).repartition(*by)


@dataclass(frozen=True)
class UrlIndex:
    """Org URLs, their grams and the grams' frequencies, as tables.

    Version 0 is a whole org snapshot. Each later version holds what changed: the
    postings of new URLs, tombstones of those that are gone, and the differences of
    the frequencies. A posting is dead once a later version has its tombstone.
    """

    name: str
    path: str
    buckets: int
    k: int
    salts: int
    versions: int = 1

    def _parts(self, spark: SparkSession, kind: str) -> list[DataFrame]:
        """The rows of each version that no later one has a tombstone for."""
        out = []
        for v in range(self.versions):
            rows = spark.table(f"{self.name}_{kind}_v{v}")
            for later in range(v + 1, self.versions):
                rows = rows.join(spark.table(f"{self.name}_gone_v{later}"), ["org_uuid", "text"], "left_anti")
            out.append(rows)
        return out

    def postings(self, spark: SparkSession) -> list[DataFrame]:
        """``(org_uuid, text, text_host, _p, gram, salt)`` of the URLs there are now, by
        version: each part is read as it is bucketed and joined by itself."""
        return self._parts(spark, "grams")

    def texts(self, spark: SparkSession) -> DataFrame:
        """``(org_uuid, text, host)``: the URLs there are now."""
        return _union(self._parts(spark, "texts"), "org_uuid")

    def grams(self, spark: SparkSession) -> DataFrame:
        """All postings."""
        return _union(self.postings(spark), "gram", "salt")

    def df(self, spark: SparkSession) -> DataFrame:
        """``(gram, df)`` of the grams there are now."""
        parts = [spark.table(f"{self.name}_df_v{v}") for v in range(self.versions)]
        return parts[0] if len(parts) == 1 else _union(parts, "gram").groupBy("gram").agg(F.sum("df").alias("df")).where("df > 0")

    def _write(self, version: int, added: DataFrame, gone: DataFrame | None) -> "UrlIndex":
        """Write one version: the URLs added and those gone since the one before."""
        spark = added.sparkSession

        def save(df: DataFrame, kind: str, *by: str) -> None:
            out = df.repartition(self.buckets, *by).write.mode("overwrite").bucketBy(self.buckets, *by).sortBy(*by)
            out.option("path", f"{self.path}/{self.name}_{kind}_v{version}").saveAsTable(f"{self.name}_{kind}_v{version}")

        save(added, "texts", "org_uuid")
        salt = F.pmod(F.xxhash64("org_uuid"), F.lit(self.salts)).cast("int").alias("salt")
        save(_org_grams(spark.table(f"{self.name}_texts_v{version}"), self.k).select("*", salt), "grams", "gram", "salt")
        df = _gram_counts(spark.table(f"{self.name}_grams_v{version}"))
        save(added.sparkSession.createDataFrame([], "org_uuid string, text string") if gone is None else gone, "gone", "org_uuid")
        if gone is not None:
            minus = _gram_counts(_org_grams(spark.table(f"{self.name}_gone_v{version}").withColumn("host", F.lit(None).cast("string")), self.k))
            df = df.unionByName(minus.select("gram", (-F.col("df")).alias("df"))).groupBy("gram").agg(F.sum("df").alias("df")).where("df <> 0")
        save(df, "df", "gram")
        return replace(self, versions=version + 1)


def build_url_index(orgs: DataFrame, name: str, path: str, num_buckets: int = 64, k: int = GRAM,
                    salts: int | None = None) -> UrlIndex:
    """Materialise ``(gram, salt, org_uuid, text, text_host)`` bucketed by
    ``(gram, salt)`` and ``(gram, df)`` bucketed by gram, at ``path``.

    Matching many lookup lists against one org snapshot then reads the org
    side already partitioned by gram: only the host side is shuffled, and
    org URLs are not exploded again. Size the buckets like the shuffle
    partitions the org grams would need (tens of MB to ~1 GB per bucket).
    """
    index = UrlIndex(name, path.rstrip("/"), num_buckets, k, salts or _salts(orgs.sparkSession), versions=0)
    return index._write(0, org_texts(orgs).distinct(), None)


def update_url_index(index: UrlIndex, orgs: DataFrame) -> UrlIndex:
    """The index of a newer org snapshot: only URLs that came or went are written.

    The result matches like an index built anew from ``orgs``; the one given
    still reads as it was.
    """
    new, now = org_texts(orgs).distinct(), index.texts(orgs.sparkSession)
    added = new.join(now.select("org_uuid", "text"), ["org_uuid", "text"], "left_anti").select("org_uuid", "text", "host")
    gone = now.join(new.select("org_uuid", "text"), ["org_uuid", "text"], "left_anti").select("org_uuid", "text")
    return index._write(index.versions, added, gone)


def _rarest(hosts: DataFrame, df: DataFrame, k: int) -> DataFrame:
    """``(host, gram, df)``: each host's rarest ``k``-gram; none for a host with a gram
    that no URL has, since it can't match."""
    grams = hosts.select("host", F.explode(_grams(F.col("host"), k)).alias("gram"))
    rarest = F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), F.col("gram"))).alias("r")
    return grams.join(df, "gram", "left").groupBy("host").agg(rarest).where(F.col("r.df") > 0).select("host", "r.gram", "r.df")


def _meet(places: DataFrame, rows: DataFrame, column: str, n: int, limit: int) -> DataFrame:
    """``places`` joined with the ``n`` ``rows`` on ``column``: these are broadcast, or
    beyond ``limit`` tested as a Bloom filter first, so that only places which may
    have a partner are shuffled."""
    if n <= limit:
        return places.join(F.broadcast(rows), column)
    bits = bits_for(n)
    return places.where(may_be_in(column, bloom(rows, column, bits), bits)).join(rows, column)


def gram_candidates(hosts: DataFrame, org_grams: DataFrame, df: DataFrame, k: int, max_urls: int | None = None, index: UrlIndex | None = None,
                    broadcast_rows: int | None = None) -> DataFrame:
    """``(host, org_uuid, text, text_host)``: the URLs each host is compared with.

    ``hosts`` are of length ``k`` or more; ``org_grams`` and ``df`` their counterpart's
    grams and frequencies. The frequencies and the chosen grams are written once (a
    row per gram, at most one per host): how they are joined depends on how many
    there are.
    """
    max_urls = max_urls or MAX_URLS
    limit = BROADCAST_ROWS if broadcast_rows is None else broadcast_rows
    ensure_checkpoint_dir(hosts.sparkSession)
    df = df.checkpoint(eager=True) if index is None else df
    chosen = _rarest(hosts, F.broadcast(df) if df.count() <= limit else df, k).checkpoint(eager=True)
    too_common = (F.col("df") > max_urls) & (F.length("host") > F.length("gram"))
    few, common = (chosen.where(c).select("host", "gram") for c in (~too_common, too_common))
    rows = ["org_uuid", "text", "text_host"]
    if index is None:
        found = [_meet(org_grams, few, "gram", few.count(), limit)]
    else:  # each host once per salt of the bucketed grams
        salted = few.select("host", "gram", _replicate(index.salts))
        found = [salted.join(part, ["gram", "salt"]) for part in index.postings(hosts.sparkSession)]
    n_common = common.count()
    if n_common:
        # Where a gram stands in the hosts that chose it, and how long they are: a few
        # shapes per gram. Each place of the gram in a URL is cut out by them, and is
        # a candidate of a host by the gram it chose, where that stands first in it.
        shapes = common.select("gram", F.expr("instr(host, gram)").alias("_off"), F.length("host").alias("_len")).distinct()
        by_gram = shapes.groupBy("gram").agg(F.collect_list(F.struct("_off", "_len")).alias("_shapes"))
        places = _meet(org_grams.select(*rows, "_p", "gram"), by_gram, "gram", shapes.count(), limit)
        cuts = places.select(*rows, "gram", "_p", F.explode("_shapes").alias("_s")).select(*rows, "gram", "_s.*", F.expr("_p - _s._off + 1").alias("_from"))
        inside = cuts.where((F.col("_from") >= 1) & (F.col("_from") + F.col("_len") - 1 <= F.length("text")))
        whole = inside.select(*rows, "gram", "_off", F.expr("substring(text, _from, _len)").alias("host"))
        chose = common.withColumnRenamed("gram", "_chosen")
        found.append(_meet(whole, chose, "host", n_common, limit).where("gram = _chosen and instr(host, gram) = _off"))
    return reduce(DataFrame.unionByName, [f.select("host", *rows) for f in found])


def match_hosts(hosts: DataFrame, orgs: DataFrame, k: int = GRAM, host_col: str = "host",
                index: UrlIndex | None = None, max_urls: int | None = None, broadcast_rows: int | None = None) -> DataFrame:
    """``(host, org_uuid, exact)`` — the chosen organization for each matched host.

    ``hosts`` holds normalised hosts (duplicates and NULL/empty allowed);
    unmatched hosts are absent from the result. With an ``index`` built from
    the same ``orgs`` (see :func:`build_url_index`), the gram tier reads the
    bucketed org grams and frequencies instead of recomputing them. ``max_urls``
    and ``broadcast_rows`` steer the work, never the result.
    """
    spark = hosts.sparkSession
    if index is not None:
        k = index.k
    ensure_checkpoint_dir(spark)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Both sides are written once, in many tasks: each tier reads them, and a filter of
    # theirs would else be pushed to the scan and normalise each URL again for each use.
    h = hosts.select(F.col(host_col).alias("host")).distinct().repartition(tasks).checkpoint(eager=True)
    h = h.where(F.col("host").isNotNull() & (F.col("host") != ""))
    texts = _lowest(org_texts(orgs))
    texts = texts.repartition(tasks).checkpoint(eager=True) if index is None else texts
    # 0 when the URL normalises to exactly the host (preferred), else 1
    rank = F.when(F.col("text_host") == F.col("host"), 0).otherwise(1).alias("rank")

    # 1. gram tier: hosts of length >= k, joined on their rarest gram.
    org_grams = _org_grams(texts, k) if index is None else index.grams(spark)
    df = _gram_counts(org_grams) if index is None else index.df(spark)
    candidates = gram_candidates(h.where(F.length("host") >= k), org_grams, df, k, max_urls, index, broadcast_rows)
    candidates = candidates.where(F.contains(F.col("text"), F.col("host"))).select("host", "org_uuid", rank)

    # 2. short tier: hosts shorter than k, joined on org substrings of the
    # same lengths. Printable-ASCII short hosts number at most
    # 94 + 94^2 + ... + 94^(k-1) (about 840k for k = 4): a proven bound, so
    # they are broadcast, and with none AQE replaces the join by an empty
    # relation before the substring side runs. Any other short host (raw
    # Unicode) joins normally against non-ASCII substrings only.
    printable = r"^[\x21-\x7e]+$"
    short_h = h.where(F.length("host") < k)

    def org_subs(t: DataFrame) -> DataFrame:
        # every substring of length 1..k-1: from each position take lengths
        # 1..k-1 (cut short at the end of the URL, still real substrings)
        cuts = F.array(*[F.expr(f"substring(text, _p, {m})") for m in range(1, k)])
        return (
            t.select("org_uuid", "text", F.col("host").alias("text_host"),
                     F.explode(F.sequence(F.lit(1), F.length("text"))).alias("_p"))
            .select("org_uuid", "text_host", F.explode(cuts).alias("host"))
        )

    short = (
        org_subs(texts).join(F.broadcast(short_h.where(F.col("host").rlike(printable))), "host")
        .select("host", "org_uuid", rank)
    )
    # only URLs with a non-printable-ASCII character can hold such a substring
    other = (
        org_subs(texts.where(~F.col("text").rlike(printable)))
        .where(~F.col("host").rlike(printable))
        .join(short_h.where(~F.col("host").rlike(printable)), "host")
        .select("host", "org_uuid", rank)
    )
    candidates = candidates.unionByName(short).unionByName(other)

    best = (
        candidates.groupBy("host")
        .agg(F.min(F.struct("rank", "org_uuid")).alias("b"))
    )
    return best.select("host", F.col("b.org_uuid").alias("org_uuid"), (F.col("b.rank") == 0).alias("exact"))


def match_urls(lookup: DataFrame, orgs: DataFrame, url_col: str = "url", k: int = GRAM) -> DataFrame:
    """Every lookup row with ``host`` and its matched ``org_uuid`` (NULL if none).

    Rows whose URL cell is blank are kept with NULL host (F8). Matching runs
    once per distinct host and is joined back, so repeated URLs cost nothing.
    A lookup column of its own named ``host`` stays; the host is then called
    ``matched_host``.
    """
    from ..functions.urls import lookup_host

    out_host = "host" if "host" not in {c.lower() for c in lookup.columns} else "matched_host"
    keyed = lookup.withColumn(HOST_KEY, lookup_host(url_col))
    found = match_hosts(keyed.select(F.col(HOST_KEY).alias("host")), orgs, k=k)
    # Dealt anew (a row per matched host): what comes grouped by host from the matching would
    # meet all lookup rows of a host in one task, a join of two shuffles can split them.
    tasks = int(lookup.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = found.select(F.col("host").alias(HOST_KEY), F.col("org_uuid").alias("__rb_org")).repartition(tasks)
    own = [F.col(quote(c)) for c in lookup.columns]
    return keyed.join(found, HOST_KEY, "left").select(*own, F.col(HOST_KEY).alias(out_host), F.col("__rb_org").alias("org_uuid"))
