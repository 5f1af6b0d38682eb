"""Source divergence against a plain version in exact integers."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from roundbook.llm import divergence
from roundbook.llm.counting import Counter as Counting
from roundbook.llm.divergence import source_divergence
from roundbook.llm.packed import blocks, buckets, pack, radix_order, unpack, words_in

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def slow(rows, min_docs, top):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall(lower(text))
        groups[lang].add(source)
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        v = len(kept)

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * v) for t in kept}

        p = {s: shares(counts[lang, s]) for s in sources}
        q = shares(sum((counts[lang, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources - {s}]
            terms = [(-f(p[s][t], q[t]), t.encode()) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, ranked in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -value, k + 1) for k, (value, item) in enumerate(ranked)]
    return sorted(out)


def rows_of(df):
    assert df.columns[:6] == ["lang", "source", "part", "item", "value", "rank"]
    assert [df.schema[c].dataType.simpleString() for c in ("value", "rank")] == ["bigint", "int"]
    return sorted(tuple(r)[:6] for r in df.collect())


def made(n, seed):
    rng = random.Random(seed)
    words = ["The", "the", "FOX", "été", "ÉTÉ", "a", "xy", "eightxyz", "ninechars", "sixteencharsabcd", "seventeencharsabc",
             "x" * 40, "y" * 300, "日本語", "naïveté", "\U0001F600", "don't", "a1b", "word-word", "\x00nul\x00"]
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "en", "fr", None, "", "de"])
        source = rng.choice(["hot", "hot", "hot", "s1", "s2", None, "", "sé"])
        rows.append((i, " ".join(rng.choice(words[rng.randint(0, 6) :]) for _ in range(rng.randint(0, 30))), lang, source))
    return rows + [(n, None, "en", "silent"), (n + 1, "", "xx", "only"), (n + 2, "12 34", "zz", "a"), (n + 2, "12 34", "zz", "b"),
                   (None, "the the", None, None), rows[0], rows[0], (n + 3, "long " * 30_000 + "z" * 100_000, "en", "s1")]


@pytest.mark.parametrize("block_rows,cells", [(divergence.BLOCK_ROWS, divergence.CELLS), (20, 6)])
def test_equals_plain_version(spark, monkeypatch, block_rows, cells):
    monkeypatch.setattr(divergence, "CELLS", cells)
    monkeypatch.setattr(divergence, "BLOCK_ROWS", block_rows)
    rows = made(300, cells)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert rows_of(source_divergence(docs, min_docs=4, top=3)) == slow(rows, 4, 3)


def test_languages_without_kept_terms_and_empty_tables(spark):
    rows = [(1, "one", "en", "a"), (2, "two", "en", "b"), (3, None, "en", "c"), (4, "x", "fr", "a")]
    assert rows_of(source_divergence(spark.createDataFrame(rows, SCHEMA))) == slow(rows, 10, 10)
    assert {r[4] for r in slow(rows, 10, 10)} == {0}
    assert rows_of(source_divergence(spark.createDataFrame([], SCHEMA))) == []


def test_columns_of_the_same_names_as_working_ones(spark):
    from pyspark.sql import functions as F

    rows = made(80, 3)
    docs = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("x").alias(c) for c in ("term", "n", "w0", "w1", "rest", "docs", "place", "block", "part", "item", "value", "rank", "p", "q")])
    assert rows_of(source_divergence(docs, min_docs=3)) == slow(rows, 3, 10)


def test_packing_is_exact_and_keeps_byte_order():
    rng = random.Random(5)
    words = sorted({bytes(rng.randrange(1, 256) for _ in range(rng.randint(1, 16))) for _ in range(3000)})
    data = np.frombuffer(b"".join(words), np.uint8)
    lengths = np.array([len(w) for w in words])
    first, second = pack(data, np.cumsum(lengths) - lengths, lengths)
    assert unpack(first, second) == words
    assert radix_order([first, second]).tolist() == list(range(len(words)))
    shuffled = np.random.default_rng(1).permutation(len(words))
    assert [words[shuffled[k]] for k in radix_order([first[shuffled], second[shuffled]])] == words


def test_words_stay_in_their_texts_and_blocks_hold_whole_texts():
    texts = ["ab", None, "", "ab c", "x" * 50, "d"]
    found = []
    for at, to, data, offsets in blocks(pa.array(texts)[0:6], most=5):
        low = divergence.LOWER[data]
        starts, ends, doc = words_in(low, offsets, low > 0)
        for bucket in buckets(low, starts, ends - starts):
            found += [(at + int(doc[k]), low[starts[k] : ends[k]].tobytes().decode()) for k in bucket.at]
    assert sorted(found) == [(0, "ab"), (3, "ab"), (3, "c"), (4, "x" * 50), (5, "d")]
    sliced = pa.array(["zz", "q w", "e"])[1:3]
    assert [(a, b, bytes(d)) for a, b, d, _ in blocks(sliced)] == [(0, 2, b"q we")]


def test_counts_merge_and_leave_in_parts():
    batch = pa.record_batch({"g": ["a", "b", "a", None], "t": ["x y x", "x", "y " + "z" * 20, None]})
    whole = {}
    for held in (10**6, 2):
        got = Counter()
        for out in Counting(divergence.split_terms, keys=1, held=held).run([batch, batch]):
            for r in out.to_pylist():
                word = r["rest"] or (r["w0"] is not None and unpack(np.array([r["w0"]]).view(np.uint64), np.array([r["w1"]]).view(np.uint64))[0])
                got[r["key0"], word] += 1000 * r["n"] + r["docs"]
        whole[held] = {k: v for k, v in got.items() if k[1]}
    assert whole[2] == whole[10**6] == {("a", b"x"): 4002, ("a", b"y"): 4004, ("b", b"x"): 2002, ("a", b"z" * 20): 2002}
