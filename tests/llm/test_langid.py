"""Language identification: held-out accuracy, the parts against plain versions, odd rows."""

import random
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from roundbook.llm import langid
from roundbook.llm.langid import Ftrl, language, softmax, temperature
from tests.conftest import SF_MID

SCHEMA = "doc_id long, text string, lang string"
WORDS = {"aa": "kata mila sona tulu", "bb": "grünt schöß wärzt brück", "cc": "что дом рука место"}


def made(n, seed=1):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice(WORDS[lang].split()) for _ in range(rng.randint(3, 30))) + rng.choice(["", ".", " 12"]), lang)
            for i in range(n) for lang in [rng.choice(sorted(WORDS))]]


def test_held_out_rows_of_the_documents(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    got = language(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == docs.count()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    assert got.score.between(0, 1).all()
    held = got[got.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.98
    assert abs(held.score.mean() - (held.lang_pred == held.lang).mean()) < 0.02  # calibrated


def test_odd_rows(spark):
    rows = made(300) + [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 34 !?", "bb"), (1003, "́", "cc"), (1004, "katá", None), (None, "kata mila", "aa"),
                        (1005, "KATA MILA SONA", None), (1006, "kata " * 300_000, None), (7, "kata mila", "aa"), (7, "kata mila", "aa")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = [tuple(r) for r in language(docs).collect()]
    assert sorted(got, key=str) == sorted([tuple(r) for r in language(docs).collect()], key=str)
    assert len(got) == len(rows)
    by_id = {r[0]: r for r in got}
    for i in (1000, 1001, 1002, 1003):
        assert by_id[i][2:] == ("und", 0.0)
    assert by_id[None][1:3] == (False, "aa") and by_id[1005][2] == by_id[1006][2] == by_id[1004][2] == "aa"
    assert {r[2] for r in got} == {"aa", "bb", "cc", "und"}


def test_nothing_is_learned_from_held_out_rows_or_without_language(spark):
    rows = [(i, "zzyzx quux", "held") for i in range(2000) if zlib.crc32(str(i).encode()) % 5 == 0] + [(-5, "zzyzx", None)]
    got = language(spark.createDataFrame(rows, SCHEMA)).toPandas()
    assert set(got.lang_pred) == {"und"} and set(got.score) == {0.0}
    free = [(i, t, x) for i, t, x in made(400) if zlib.crc32(str(i).encode()) % 5]
    got = language(spark.createDataFrame(rows + free, SCHEMA)).toPandas()
    assert "held" not in set(got.lang_pred) and len(got) == len(rows) + len(free)
    assert language(spark.createDataFrame([], SCHEMA)).collect() == []


def test_working_names_as_columns(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(made(200), SCHEMA)
    wide = docs.select("*", *[F.lit("x").alias(c) for c in ("found", "held_out", "lang_pred", "score", "chance", "draw", "nth", "place", "fit", "gram", "n", "rows", "x", "grams")])
    a, b = (sorted((r.doc_id, r.lang_pred, r.score) for r in language(d).collect()) for d in (docs, wide))
    assert a == b


def plain_grams(text):
    """n-grams of the text's letters and single spaces, as strings."""
    kinds = langid._characters()
    s = "".join(c if kinds[ord(c)] else " " for c in f" {text.lower()} ")
    while "  " in s:
        s = s.replace("  ", " ")
    return Counter(s[i : i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1) if s[i : i + n] != " ")


@pytest.mark.parametrize("step", [langid.STEP, 3])
def test_grams_are_those_of_each_text(monkeypatch, step):
    monkeypatch.setattr(langid, "STEP", step)
    texts = ["Ab, c!", None, "", "x", "ÉTÉ  né", "1 2", "ab" * 20]
    codes, doc, letters = langid._codes(texts)
    assert letters.tolist() == [True, False, False, True, True, False, True]
    got = [Counter() for _ in texts]
    for d, gram in langid._grams(codes, doc):
        for k, g in zip(d.tolist(), gram.tolist()):
            got[k][g] += 1
    alone = {}
    for text, counts in zip(texts, got):
        expected = plain_grams(text or "")
        assert sorted(counts.values()) == sorted(expected.values())
        for k, g in langid._grams(*langid._codes([text])[:2]):
            alone.setdefault(text, Counter()).update(g.tolist())
        assert counts == alone.get(text, Counter())


def test_document_frequencies_count_each_text_once():
    texts = ["ab ab", "ab", None, "b"]
    out = pd.concat(langid._document_frequencies(iter([pd.DataFrame({"text": texts}), pd.DataFrame({"text": ["ab"]})])))
    expected = Counter(g for t in [*texts, "ab"] for g in set(plain_grams(t or "")))
    assert sorted(out["rows"]) == sorted(expected.values())


def test_ftrl_is_the_published_rule():
    """One row at a time against the per-coordinate statement of the rule."""
    rng = np.random.default_rng(4)
    model, z, n = Ftrl(3, 6), np.zeros((6, 3)), np.zeros((6, 3))
    for _ in range(200):
        at = np.sort(rng.choice(6, 3, replace=False))
        x, label = rng.random(3) * 3, int(rng.integers(3))
        w = np.zeros((3, 3))
        for i, k in enumerate(at):
            for c in range(3):
                if abs(z[k, c]) > langid.LASSO:
                    sign = 1 if z[k, c] > 0 else -1
                    w[i, c] = -(z[k, c] - sign * langid.LASSO) / ((langid.BETA + n[k, c] ** 0.5) / langid.ALPHA + langid.RIDGE)
        e = np.exp([sum(x[i] * w[i, c] for i in range(3)) for c in range(3)])
        p = e / e.sum()
        for i, k in enumerate(at):
            for c in range(3):
                g = (p[c] - (c == label)) * x[i]
                z[k, c] += g - ((n[k, c] + g * g) ** 0.5 - n[k, c] ** 0.5) / langid.ALPHA * w[i, c]
                n[k, c] += g * g
        model.learn(at, x, label)
    assert np.allclose(model.z, z) and np.allclose(model.n, n)


def test_lasso_leaves_most_weights_zero(spark):
    folder, langs, n = langid.fit(spark.createDataFrame(made(600), SCHEMA))
    model = langid.Model(langid.uri(folder), langs, n)
    assert langs == ["aa", "bb", "cc"] and (model.table != 0).any(axis=1).sum() < 500


def test_temperature_has_the_least_loss():
    rng = np.random.default_rng(2)
    logits, labels = rng.normal(size=(4000, 3)), np.empty(4000, int)
    for k, p in enumerate(softmax(logits / 2.5)):
        labels[k] = rng.choice(3, p=p)
    loss = lambda t: -np.log(softmax(logits / t)[np.arange(4000), labels]).mean()
    t = temperature(logits, labels)
    assert loss(t) <= min(loss(x) for x in np.linspace(0.2, 10, 300)) + 1e-6
    assert 2 < t < 3.2 and temperature(np.empty((0, 3)), np.empty(0, int)) == 1.0
