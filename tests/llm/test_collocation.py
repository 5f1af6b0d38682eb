"""Phrase mining against a plain version in exact integers."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from roundbook.llm import collocation
from roundbook.llm.collocation import collocations, equal_runs

SCHEMA = "doc_id long, text string, lang string"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def slow(rows, least, top):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang] += len(words)
            f.update((lang, words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    frequent = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    out = {}
    for (lang, phrase), a in frequent.items():
        if len(phrase) == 2 and any(q[0] == lang and len(q[1]) == 3 and phrase in (q[1][:2], q[1][1:]) and 100 * b >= 50 * a for q, b in frequent.items()):
            continue
        cuts = [(10**6 * a * a // (f[lang, phrase[:k]] * f[lang, phrase[k:]]), k) for k in range(1, len(phrase))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(phrase).encode(), f[lang, phrase[:k]], f[lang, phrase[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, found in out.items() for i, (s, a, p, l, r) in enumerate(sorted(found)[:top]))


def made(n, seed):
    rng = random.Random(seed)
    words = ["The", "the", "THE", "of", "fox", "été", "ÉTÉ", "a", "b", "x1", "-", "sixteencharsabcd", "seventeencharsabc", "y" * 90, "nul\x00", "nul", "日本"]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(words[: rng.choice([3, 6, len(words)])]) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r", "\x0b", "?"]) for _ in range(rng.randint(0, 40)))
        rows.append((i, text, rng.choice(["en", "en", "en", "fr", None, ""])))
    return rows + [(n, None, "en"), (n + 1, "", "xx"), (None, "the of the of", None), rows[0], rows[0], (n + 2, "the of the " * 3000 + "q" * 70_000, "en")]


def rows_of(df):
    assert df.columns[:8] == COLUMNS
    assert {df.schema[c].dataType.simpleString() for c in ("rank", "a", "l", "r", "n", "score")} == {"bigint"}
    return sorted(tuple(r)[:8] for r in df.select(*COLUMNS).collect())


# budgets of 100 and 7: first words, and pairs of them, pass it and are extended
@pytest.mark.parametrize("budget,held", [(collocation.BUDGET, collocation.HELD), (100, 300), (7, 50)])
def test_equals_plain_version(spark, monkeypatch, budget, held):
    monkeypatch.setattr(collocation, "HELD", held)
    rows = made(200, budget)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert rows_of(collocations(docs, min_count=4, top=60, budget=budget)) == slow(rows, 4, 60)


def test_empty_and_clashing(spark):
    from pyspark.sql import functions as F

    assert rows_of(collocations(spark.createDataFrame([], SCHEMA))) == []
    assert rows_of(collocations(spark.createDataFrame([(1, None, None), (2, "a b", "en")], SCHEMA))) == []
    rows = made(60, 2)
    docs = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("x").alias(c) for c in ("h", "h1", "h2", "a", "n", "word", "unit", "part", "phrase", "rank", "score", "suffixes")])
    assert rows_of(collocations(docs, min_count=3, top=40)) == slow(rows, 3, 40)


def test_clashing_hashes_take_another_seed(spark, monkeypatch):
    """With a hash that gives two words one number for seed 1, the second seed is used."""
    tried = []
    real = collocation._hash_tells_apart

    def tells(words):
        tried.append(words.count())
        return len(tried) > 1 and real(words)

    monkeypatch.setattr(collocation, "_hash_tells_apart", tells)
    rows = made(40, 9)
    assert rows_of(collocations(spark.createDataFrame(rows, SCHEMA), min_count=3, top=40)) == slow(rows, 3, 40)
    assert len(tried) == 2
    both = spark.createDataFrame([("en", "a", 1, 7, 0), ("fr", "a", 1, 7, 1), ("en", "b", 1, 8, 2)], "lang string, word string, n long, h long, unit long")
    assert real(both)
    assert not real(both.union(spark.createDataFrame([("fr", "c", 1, 8, 3)], both.schema)))


def test_equal_runs_survive_shared_bits():
    keys = np.array([3, 1, 3, 2, 1, 1], np.uint64)
    for mixed in (keys * np.uint64(1 << 60), np.zeros(6, np.uint64)):
        order, at = equal_runs(mixed, keys)
        runs = [sorted(order[a:b].tolist()) for a, b in zip(at, [*at[1:], 6])]
        assert sorted(runs) == [[0, 2], [1, 4, 5], [3]]
