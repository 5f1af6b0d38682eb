"""Nearest neighbours against brute force; the pipeline's stages against their rules."""

import re

import numpy as np
import pytest

import corpus_pipeline
from conftest import SF_SMALL
from roundbook.llm import ann, pii, simhash
from test_duplicates import lower, slow_components


def slow(ids, x, queries, k):
    out = {}
    for q in queries:
        at = ids.index(q)
        d = sorted((float(np.sqrt(((x[at] - v) ** 2).sum())), i) for i, v in zip(ids, x) if i != q)
        out[q] = d[:k]
    return out


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 16)).astype(np.float32)
    x[200:700] = x[200]  # a third of all rows alike
    return x


def test_search(spark, vectors, monkeypatch):
    monkeypatch.setattr(ann, "LEAF_ROWS", 40)
    monkeypatch.setattr(ann, "TILE_ROWS", 64)
    monkeypatch.setattr(ann, "TILE_QUERIES", 4)
    rows = [(i, v.tolist(), "clash") for i, v in enumerate(vectors)]
    bad = [(5000, None, "x"), (5100, [0.0] * 16, "x"), (5200, [float("nan")] + [1.0] * 15, "x"), (5300, [None] + [1.0] * 15, "x"), (5400, [float("inf")] * 16, "x"), (None, [1.0] * 16, "x")]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, leaf string").repartition(4)
    got = {}
    for r in ann.search(df, df.filter("vec_id % 100 = 0")).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    want = slow(list(range(1500)), vectors.astype(float), range(0, 1500, 100), 10)
    assert set(got) == set(want)
    hits = 0
    for q, own in got.items():
        own.sort()
        assert [r for r, *_ in own] == list(range(1, 11))
        assert [(s, i) for _, s, i in own] == sorted((s, i) for _, s, i in own)
        exact = {i: s for s, i in slow(list(range(1500)), vectors.astype(float), [q], 1499)[q]}
        assert all(abs(exact[i] - s) < 1e-12 for _, s, i in own)
        hits += len({i for *_, i in own} & {i for _, i in want[q]})
    assert hits / (10 * len(want)) >= 0.9
    assert [i for _, i in want[300]] == [i for *_, i in sorted(got[300])]


def test_lengths_are_searched_each_by_itself_and_repeated_ids_stay(spark):
    """A short vector at the smallest id takes nothing from the others; rows that
    share an id are rows."""
    rng = np.random.default_rng(7)
    two = [(i, rng.normal(size=2).tolist()) for i in range(1, 301)]
    rows = [(0, [1.0]), *two, (400, [2.5]), (900, [1.0, 2.0, 3.0]), (7, [9.0, 9.0]), (7, [9.0, 9.0]), (500, [9.0, 9.0]), (500, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in ann.search(df, df.filter("vec_id % 100 = 0")).collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    assert got[0] == [(1.5, 400)] and got[400] == [(1.5, 0)] and 900 not in got
    kept = sorted({(i, tuple(v)) for i, v in rows if len(v) == 2})
    for q in (100, 200, 300, 500):
        want = []
        for own in [v for i, v in kept if i == q]:
            want += sorted((float(np.sqrt(((np.array(own) - np.array(v)) ** 2).sum())), i) for i, v in kept if (i, v) != (q, own))[:10]
        assert sorted(got[q]) == sorted(want)
    assert (0.0, 7) in got[500]


def test_search_of_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (100, [1.0, 2.0]), (7, [4.0, 6.0]), (100, [1.0, 2.0])], "vec_id long, embedding array<double>")
    got = [tuple(r) for r in ann.search(df, df.filter("vec_id % 100 = 0")).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 100, 0.0), (0, 2, 7, 5.0), (100, 1, 0, 0.0), (100, 2, 7, 5.0)]
    assert ann.search(df.limit(0), df).count() == 0
    assert ann.search(df, df.limit(0)).count() == 0


def test_pipeline_stages(spark, tmpdir_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    before = {r["doc_id"]: r for r in docs.collect()}
    now = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, now, SF_SMALL)
        if k + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == docs.columns
        out.write.parquet(f"{tmpdir_path}/{k}")
        out = spark.read.parquet(f"{tmpdir_path}/{k}")
        kept = {r["doc_id"] for r in out.select("doc_id").collect()}
        if name != "best-fit packing":
            assert out.count() == len(kept) and kept <= set(before)
        if name in ("pii", "best-fit packing"):
            assert kept == {r["doc_id"] for r in now.select("doc_id").collect()}  # these drop nothing
        rows = now.select("doc_id", "text").collect() if name in ("simhash near-dedup", "benchmark decontamination") else []
        if name == "simhash near-dedup":
            ids = [r["doc_id"] for r in rows]
            groups = slow_components([simhash.fingerprint(r["text"]) for r in rows], 4)
            assert kept == {min(ids[j] for j in group) for group in groups.values()}
        if name == "benchmark decontamination":
            words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
            items = [words(r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
            windows = {tuple(w[i : i + 10]) for w in items for i in range(len(w) - 9)}
            texts = {r["doc_id"]: words(r["text"]) for r in rows}
            assert min(map(len, items)) >= 10
            assert kept == {i for i, w in texts.items() if not any(tuple(w[k : k + 10]) in windows for k in range(len(w) - 9))}
        if name == "pii":
            assert all(r["text"] == pii.redacted(before[r["doc_id"]]["text"]) and r["n_chars"] == len(r["text"]) for r in out.collect())
        now = out
    assert 100 < len(kept) < len(before)


def test_run_is_registered(spark):
    import __spark_entry__ as entry

    assert "pipeline" in entry.queries() and {f"op{n}" for n in range(1, 11)} <= {q.split("_")[0] for q in entry.queries()}
    assert corpus_pipeline.run(spark, SF_SMALL).columns[:5] == ["doc_id", "piece", "start", "length", "ids"]


def test_nearest_is_exact_and_computes_few_distances(monkeypatch):
    """Ties, repeated ids, rows far from the origin and very small ones as by plain distances,
    which are computed for few pairs; a bound leaves out no row within it."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(600, 8))
    x[50:90] = x[50]
    cases = (x, np.round(x), x + 1e6, x * 1e-120, x * 1e120)
    for rows in cases:
        ids = np.concatenate([np.arange(500), np.arange(100)])
        queries, q_ids = rows[::7], ids[::7]
        got = ann.nearest(np.arange(len(queries)), q_ids, queries, ids, rows, 10)
        full = np.sqrt(((queries[:, None] - rows[None]) ** 2).sum(axis=2))
        bounds = np.sort(full, axis=1)[:, 5]
        within = ann.nearest(np.arange(len(queries)), q_ids, queries, ids, rows, 10, bounds)
        for one in range(len(queries)):
            want = sorted((d, i) for d, i in zip(full[one], ids) if not (i == q_ids[one] and d == 0) and np.isfinite(d))[:10]
            own = got[got["key"] == one]
            assert list(zip(own["score"], own["vec_id"])) == want
            own = within[within["key"] == one]
            assert [p for p in zip(own["score"], own["vec_id"]) if p[0] <= bounds[one]] == [p for p in want if p[0] <= bounds[one]]
    computed = []
    sqrt = np.sqrt
    monkeypatch.setattr(np, "sqrt", lambda v: (computed.append(np.size(v)), sqrt(v))[1])
    ann.nearest(np.arange(100), np.arange(100), x[100:200], np.arange(600) + 1000, x, 10)
    assert 0 < sum(computed) < 100 * 30
