"""Phrases of two and three words that stand together more often than their parts would.

The counting follows a suffix tree built by vertical partitioning. Every place
in the corpus starts a suffix, truncated to three words and to its piece.
Suffixes are grouped by variable-length prefixes: a first word stands for all
its suffixes unless these pass the memory budget, then it is extended by the
second word, and a pair that still passes it by the third. Prefixes are laid
into groups of at most the budget, so one task can build a group's subtree on
its own: equal suffixes become leaves with totals, and the totals of the leaves
below a node are that phrase's count.

Words travel as 64-bit hashes. Whether the hash tells all words of the corpus
apart is checked on the exact word counts; if not, another seed is taken.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import mix64, read_parquet, shared_path, uri, written
from .counting import Counter
from .packed import blocks, buckets, run_starts, unpack, words_in

MIN_COUNT, TOP = 10, 2000
#: Suffixes of one group of prefixes: what a task holds at a time, about 100 bytes each.
BUDGET = 1_000_000
#: Suffixes that a task holds before it deals them to groups, and bytes of text it
#: takes them from at a time.
HELD, BLOCK = 600_000, 2_000_000
#: Prefixes that one task lays into groups, about.
LAID = 250_000
#: Bits of the filter of frequent words: 16 a word, and at most 16 MB. A false
#: positive is work only, since every phrase is counted.
FILTER_BITS = 1 << 27

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
_INSIDE = ~_BREAK
_INSIDE[[0x20, 0x09]] = False
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def split_words(data: np.ndarray, offsets: np.ndarray):
    """Lower-cased bytes, and start, end and text number of every word."""
    low = _LOWER[data]
    return low, *words_in(low, offsets, _INSIDE[low])


def packed_hash(first: np.ndarray, second: np.ndarray, seed: int) -> np.ndarray:
    """Hash of packed words."""
    return mix64(mix64(first ^ np.uint64(seed)) + second * _A)


def long_hash(word: bytes, seed: int) -> int:
    return xxhash.xxh64_intdigest(word, seed)


def lang_code(lang: str) -> np.ndarray:
    return mix64(np.array([zlib.crc32(lang.encode("utf-8", "surrogatepass"))], np.uint64))


def unit_of(h: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Place of a first word of a language in the order of prefixes."""
    return mix64(h ^ code)


def extended(unit: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Place of a prefix with one more word."""
    return mix64(unit * _B + h)


def word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """``(lang, word, n, h, unit)`` of every word of every language; ``docs`` has lang and text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return Counter(split_words, keys=1, zero_bytes=True).run(batches)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, w0, w1, rest, n = (batch.column(k) for k in range(5))
            long = np.flatnonzero(rest.is_valid().to_numpy(zero_copy_only=False))
            first, second = (w.fill_null(0).to_numpy().view(np.uint64) for w in (w0, w1))
            words, h = np.array(unpack(first, second), object), packed_hash(first, second, seed)
            words[long] = [rest[int(k)].as_py() for k in long]
            h[long] = [long_hash(w, seed) for w in words[long]]
            place, langs = pd.factorize(lang.to_pandas())
            unit = unit_of(h, np.concatenate([lang_code(x) for x in langs])[place]) if len(langs) else h
            yield pa.RecordBatch.from_arrays(
                [lang, pa.array([w.decode("utf-8", "replace") for w in words], pa.string()), n, pa.array(h.view(np.int64)), pa.array(unit.view(np.int64))],
                ["lang", "word", "n", "h", "unit"])

    counted = docs.mapInArrow(count, "lang string, w0 long, w1 long, rest binary, n long, docs long").filter("n > 0")
    summed = counted.groupBy("lang", "w0", "w1", "rest").agg(F.sum("n").alias("n"))
    return summed.mapInArrow(name, "lang string, word string, n long, h long, unit long")


def _hash_tells_apart(words: DataFrame) -> bool:
    """No two words of the corpus share a hash, and none has 0 (which ends a suffix)."""
    clash = words.groupBy("h").agg((F.min("word") != F.max("word")).alias("two")).filter("two or h = 0")
    return clash.isEmpty()


def _filter_bits(n_words: int) -> int:
    return min(FILTER_BITS, max(1 << 10, 1 << (16 * n_words).bit_length()))


def _longs(folder: str, *columns: str) -> list[np.ndarray]:
    """Columns of a small table in the shared folder."""
    rows = read_parquet(folder, list(columns))
    return [rows[c].to_numpy().astype(np.int64) for c in columns]


class Plan:
    """What a task needs to know about words and prefixes, read from the shared folder:
    the filter of frequent words, the prefixes past the budget (at most one per
    ``BUDGET`` words of the corpus and length) and where groups begin (likewise)."""

    def __init__(self, folder: str, seed: int, bits: int, names: tuple[str, ...] = ("hot1", "hot2", "cuts")):
        self.seed, self.bits = seed, bits
        self.filter = np.zeros(max(1, bits // 64), np.uint64)
        at, values = _longs(f"{folder}/filter", "at", "bits")
        self.filter[at] = values.view(np.uint64)
        self.hot1, self.hot2, self.cuts = (
            np.sort(_longs(f"{folder}/{n}", "unit")[0].view(np.uint64)) if n in names else np.empty(0, np.uint64) for n in ("hot1", "hot2", "cuts"))

    def frequent(self, unit: np.ndarray) -> np.ndarray:
        """Whether words may be frequent ones of their language."""
        bit = unit & np.uint64(self.bits - 1)
        return (self.filter[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values a sorted array holds."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def suffixes(langs: list[str], texts: pa.Array, plan: Plan) -> Iterator[tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per block: names of languages, and of each different truncated suffix the
    language's place, the three words' hashes (0: the suffix has ended) and its count.

    A suffix starts at a pair of frequent words; a rare word ends it, since no
    phrase that holds it is frequent.
    """
    for at, to, data, offsets in blocks(texts, BLOCK):
        low, starts, ends, doc = split_words(data, offsets)
        if not len(starts):
            continue
        broken = np.logical_or.reduceat(_BREAK[low], starts)[:-1]
        joined = ~broken & (doc[1:] == doc[:-1])
        ids, hashes = np.zeros(len(starts), np.int64), [np.zeros(1, np.uint64)]
        known = 1
        for bucket in buckets(low, starts, ends - starts, zero_bytes=True):
            order = bucket.order()
            keys = bucket.keys(order)
            first = run_starts(*keys)
            run = np.zeros(len(order), np.int64)
            run[first] = 1
            ids[bucket.at[order]] = known - 1 + np.cumsum(run)
            if bucket.long is None:
                hashes.append(packed_hash(keys[0][first], keys[1][first], plan.seed))
            else:
                hashes.append(np.array([long_hash(w, plan.seed) for w in keys[0][first]], np.uint64))
            known += len(first)
        h = np.concatenate(hashes)
        place, names = pd.factorize(pd.Series(langs[at:to], dtype=object))
        lang = place[doc]
        frequent = np.stack([plan.frequent(unit_of(h, lang_code(name))) for name in names])
        kept = frequent[lang, ids]
        pair = joined & kept[1:] & kept[:-1]
        i = np.flatnonzero(pair)
        third = np.zeros(len(i), np.int64)
        on = i + 2 < len(ids)
        go = np.flatnonzero(on)[pair[i[on] + 1]]
        third[go] = ids[i[go] + 2]
        first, second = lang[i] * known + ids[i], ids[i + 1] * known + third
        if len(names) * known**3 < 1 << 62:
            key, n = np.unique(first * known * known + second, return_counts=True)
            first, second = key // (known * known), key % (known * known)
        else:
            order = np.lexsort((second, first))
            first, second = first[order], second[order]
            at_run = run_starts(first, second)
            n = np.diff(np.append(at_run, len(first)))
            first, second = first[at_run], second[at_run]
        yield list(names), first // known, h[first % known], h[second // known], h[second % known], n


def _hot_pairs(docs: DataFrame, folder: str, seed: int, bits: int) -> DataFrame:
    """``(lang, h1, h2, n, unit)`` of the pairs below first words past the budget."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        plan = Plan(folder, seed, bits, ("hot1",))
        for batch in batches:
            for names, lang, h1, h2, _, n in suffixes(batch.column(0).to_pylist(), batch.column(1), plan):
                code = np.array([lang_code(x)[0] for x in names], np.uint64)
                unit = unit_of(h1, code[lang])
                hot = among(unit, plan.hot1)
                rows = pd.DataFrame({"lang": lang[hot], "h1": h1[hot].view(np.int64), "h2": h2[hot].view(np.int64), "n": n[hot], "unit": extended(unit[hot], h2[hot]).view(np.int64)})
                rows = rows.groupby(["lang", "h1", "h2", "unit"], as_index=False)["n"].sum()
                rows["lang"] = np.array(names, object)[rows["lang"]]
                yield pa.RecordBatch.from_pandas(rows[["lang", "h1", "h2", "n", "unit"]], preserve_index=False)

    return docs.mapInArrow(count, "lang string, h1 long, h2 long, n long, unit long").groupBy("lang", "h1", "h2", "unit").agg(F.sum("n").alias("n"))


def group_starts(units: DataFrame, budget: int) -> DataFrame:
    """Where groups begin in the order of prefixes: as many as fit the budget make a
    group. ``units`` has unit and n; ranges of the order are laid out independently."""

    def lay(pdf: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(pdf["unit"].to_numpy().view(np.uint64))
        unit, total = pdf["unit"].to_numpy()[order], np.cumsum(pdf["n"].to_numpy()[order])
        at, out = 0, []
        while at < len(unit):
            out.append(unit[at])
            at = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + budget, "right")))
        return pd.DataFrame({"unit": out})

    ranges = max(1, -(-units.count() // LAID))
    place = F.floor(F.shiftrightunsigned("unit", 32) * F.lit(ranges) / F.lit(1 << 32))
    return units.select("unit", "n", place.alias("range")).groupBy("range").applyInPandas(lay, "unit long")


def _dealt(docs: DataFrame, folder: str, seed: int, bits: int) -> DataFrame:
    """``(part, lang, suffixes)``: suffixes of one language that a task sends to a group."""

    def flush(names: list[str], held: list[tuple[np.ndarray, ...]], plan: Plan) -> Iterator[pa.RecordBatch]:
        lang, h1, h2, h3, n = (np.concatenate(c) for c in zip(*held))
        code = np.array([lang_code(x)[0] for x in names], np.uint64)
        unit = unit_of(h1, code[lang])
        hot = np.flatnonzero(among(unit, plan.hot1))
        unit[hot] = extended(unit[hot], h2[hot])
        hot = hot[among(unit[hot], plan.hot2)]
        unit[hot] = extended(unit[hot], h3[hot])
        part = np.maximum(np.searchsorted(plan.cuts, unit, "right") - 1, 0)
        order = np.lexsort((h1, lang, part))
        lang, part = lang[order], part[order]
        h1, h2, h3, n = h1[order], h2[order], h3[order], n[order].astype(np.uint32)
        at = run_starts(part, lang)
        ends = np.append(at, len(part))[1:]
        for k in range(0, len(at), 1000):
            cut = list(zip(at[k : k + 1000].tolist(), ends[k : k + 1000].tolist()))
            yield pa.RecordBatch.from_arrays([
                pa.array([int(part[a]) for a, _ in cut], pa.int64()), pa.array([names[lang[a]] for a, _ in cut], pa.string()),
                pa.array([b"".join(c[a:b].tobytes() for c in (h1, h2, h3, n)) for a, b in cut], pa.binary())], ["part", "lang", "suffixes"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = Plan(folder, seed, bits)
        known: dict[str, int] = {}
        held, size = [], 0
        for batch in batches:
            for names, lang, *rest in suffixes(batch.column(0).to_pylist(), batch.column(1), plan):
                to = np.array([known.setdefault(x, len(known)) for x in names], np.int64)
                held.append((to[lang], *rest))
                size += len(lang)
                if size >= HELD:
                    yield from flush(list(known), held, plan)
                    held, size = [], 0
        if size:
            yield from flush(list(known), held, plan)

    return docs.mapInArrow(deal, "part long, lang string, suffixes binary")


def equal_runs(mixed: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal keys stand together, and where their runs begin.

    Sorts the upper bits of ``mixed`` (equal for equal keys) with the place in the
    lower ones; if different keys share those bits, sorts by the keys themselves.
    """
    low = np.uint64(max(1, len(mixed).bit_length()))
    packed = np.sort((mixed >> low << low) | np.arange(len(mixed), dtype=np.uint64))
    order = (packed & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
    runs = run_starts(*(k[order] for k in keys))
    if len(run_starts(packed >> low)) != len(runs):
        order = np.lexsort(keys)
        runs = run_starts(*(k[order] for k in keys))
    return order, runs


def _subtree(pdf: pd.DataFrame, hot2: np.ndarray, least: int) -> pd.DataFrame:
    """The frequent nodes of one group's subtree: ``(lang, h1, h2, h3, a)``, h3 0 at
    depth two. The leaves of a pair in ``hot2`` are spread over groups: it shows its share."""
    lang, columns = [], [[], [], [], []]
    place, names = pd.factorize(pdf["lang"])
    for k, blob in zip(place, pdf["suffixes"]):
        n = len(blob) // 28
        for j, column in enumerate(columns):
            column.append(np.frombuffer(blob, np.uint64, n, 8 * j * n) if j < 3 else np.frombuffer(blob, np.uint32, n, 24 * n))
        lang.append(np.full(n, k, np.uint64))
    lang = np.concatenate(lang)
    h1, h2, h3, n = (np.concatenate(c) for c in columns)
    pair = mix64(mix64(h1 + lang * _C) + h2 * _A)
    order, at = equal_runs(mix64(pair + h3 * _B), lang, h1, h2, h3)
    total = np.add.reduceat(n[order].astype(np.int64), at)
    leaf = order[at]
    lang, h1, h2, h3, pair = lang[leaf], h1[leaf], h2[leaf], h3[leaf], pair[leaf]
    order, at = equal_runs(pair, lang, h1, h2)
    below = np.add.reduceat(total[order], at)
    node = order[at]
    show = below >= least
    if len(hot2):
        code = np.array([lang_code(x)[0] for x in names], np.uint64)[lang[node].astype(np.int64)]
        show |= among(extended(unit_of(h1[node], code), h2[node]), hot2)
    two, three = node[show], np.flatnonzero((total >= least) & (h3 != 0))
    both = np.concatenate([two, three])
    return pd.DataFrame({
        "lang": np.array(names, object)[lang[both].astype(np.int64)], "h1": h1[both].view(np.int64), "h2": h2[both].view(np.int64),
        "h3": np.concatenate([np.zeros(len(two), np.int64), h3[three].view(np.int64)]), "a": np.concatenate([below[show], total[three]])})


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """All words ``(lang, word, n, h, unit)`` and the phrases of two and three words with
    at least ``min_count`` occurrences ``(lang, h1, h2, h3, a)``; ``docs`` has lang and text."""
    spark = docs.sparkSession
    for seed in range(1, 100):
        words = written(word_counts(docs, seed), "words")
        if _hash_tells_apart(words):
            break
    frequent = words.filter(F.col("n") >= min_count)
    bits = _filter_bits(frequent.count())
    here = shared_path(spark, "prefixes")
    save = lambda df, name: df.write.parquet(f"{here}/{name}")
    bit = F.col("unit").bitwiseAND(F.lit(bits - 1))
    one = F.expr(f"shiftleft(1L, cast((unit & {bits - 1}L) & 63 as int))")
    save(frequent.groupBy(F.shiftright(bit, 6).alias("at")).agg(F.bit_or(one).alias("bits")), "filter")
    hot1 = frequent.filter(F.col("n") > budget).select("unit")
    save(hot1, "hot1")
    folder = uri(here)
    pairs = written(_hot_pairs(docs, folder, seed, bits), "pairs") if not hot1.isEmpty() else None
    units = frequent.filter(F.col("n") <= budget).select("unit", "n")
    if pairs is not None:
        save(pairs.filter(F.col("n") > budget).select("unit"), "hot2")
        units = units.unionByName(pairs.filter(F.col("n") <= budget).select("unit", "n"))
    save(group_starts(units, budget), "cuts")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        return _subtree(pdf, Plan(folder, seed, bits, ("hot2",)).hot2, min_count)

    # A task per group, whatever the session's shuffle partitions.
    groups = max(1, spark.read.parquet(f"{here}/cuts").count())
    nodes = _dealt(docs, folder, seed, bits).repartition(groups, "part").groupBy("part").applyInPandas(build, "lang string, h1 long, h2 long, h3 long, a long")
    return words, nodes.groupBy("lang", "h1", "h2", "h3").agg(F.sum("a").alias("a")).filter(F.col("a") >= min_count)


def _score(l: str, r: str) -> Column:
    """floor(1000000 * a * a / (l * r)) in 38-digit decimals: exact up to counts of 10^15."""
    d = lambda c: f"cast({c} as decimal(15,0))"
    return F.expr(f"(cast(1000000 as decimal(7,0)) * ({d('a')} * {d('a')})) div ({d(l)} * {d(r)})")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, *, lang: str = "lang", text: str = "text", budget: int = BUDGET) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the first ``top`` phrases of each language.

    Null text reads as empty, null lang as ``und``. Pieces end at ``. , ; : ! ?`` and
    line ends, words at spaces and tabs; A-Z are lower-cased. Every row counts,
    repeated ones too. A language without frequent phrases has no rows, nor has an
    empty input; other columns are not read. Results don't depend on ``budget``.
    """
    named = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    words, nodes = phrase_counts(named, min_count, budget)
    nodes = written(nodes, "phrases")
    word = words.filter(F.col("n") >= min_count).select("lang", "h", "word", F.col("n").alias("f"))
    two, three = nodes.filter("h3 = 0").drop("h3"), nodes.filter("h3 <> 0")

    def with_word(df: DataFrame, k: int) -> DataFrame:
        return df.join(word.select("lang", F.col("h").alias(f"h{k}"), F.col("word").alias(f"w{k}"), F.col("f").alias(f"f{k}")), ["lang", f"h{k}"])

    inside = three.select("lang", "a", F.explode(F.array(F.struct("h1", "h2"), F.struct(F.col("h2").alias("h1"), F.col("h3").alias("h2")))).alias("s"))
    longest = inside.groupBy("lang", "s.h1", "s.h2").agg(F.max("a").alias("longer"))
    alone = two.join(longest, ["lang", "h1", "h2"], "left").filter(F.expr("longer is null or 100 * longer < 50 * a")).drop("longer")
    pairs = with_word(with_word(alone, 1), 2).select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), _score("f1", "f2").alias("score"))

    front = two.select("lang", "h1", "h2", F.col("a").alias("f12"))
    back = two.select("lang", F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("a").alias("f23"))
    cut = with_word(with_word(with_word(three.join(front, ["lang", "h1", "h2"]).join(back, ["lang", "h2", "h3"]), 1), 2), 3)
    cut = cut.withColumns({"s1": _score("f1", "f23"), "s2": _score("f12", "f3")})
    early = F.col("s1") <= F.col("s2")
    triples = cut.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.when(early, F.col("f1")).otherwise(F.col("f12")).alias("l"),
                         F.when(early, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score"))

    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = pairs.unionByName(triples).withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
