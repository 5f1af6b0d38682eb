"""SimHash, substring removal and decontamination against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from roundbook.llm import decontam, simhash, substring
from roundbook.llm.components import components

RNG = random.Random(17)
WORDS = ["The", "the", "fox", "ÉTÉ", "été", "a", "B", "dog,", "x1", "naïve", "Zoo", "end."]


def made(n, low=0, high=60):
    rows = [(i, " ".join(RNG.choice(WORDS) + RNG.choice(["", "s", "7"]) for _ in range(RNG.randint(low, high)))) for i in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, " \t\n"), (n + 3, rows[0][1]), (n + 4, rows[1][1] + " more"), (n + 5, rows[2][1].replace(" ", "\n")), (7, rows[7][1]), (None, rows[3][1]), (n + 6, "w " * 4000)]
    return rows


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def slow_fingerprint(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    h = [xxhash.xxh64(" ".join(w[i : i + 4]).encode(), seed=42).intdigest() for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(fps, radius):
    """Smallest key reachable for each index."""
    left, out = set(range(len(fps))), {}
    while left:
        group, todo = set(), [left.pop()]
        while todo:
            i = todo.pop()
            group.add(i)
            near = {j for j in left if (fps[i] ^ fps[j]).bit_count() <= radius}
            left -= near
            todo += near
        for i in group:
            out[i] = group
    return out


def test_fingerprints():
    for _, t in made(40):
        assert simhash.fingerprint(t) == slow_fingerprint(t)


@pytest.mark.parametrize("parts", [1, 2, 4, 8])
def test_links_find_every_component(spark, parts):
    rng = np.random.default_rng(parts)
    base = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    flips = [b ^ np.uint64(sum(1 << int(x) for x in rng.choice(64, rng.integers(0, 6), replace=False))) for b in base for _ in range(8)]
    fps = sorted({int(x) for x in flips} | {0, 1, (1 << 64) - 1})
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {r["u"]: r["v"] for r in components(simhash.links(df, 4, parts, tile=16)).collect()}
    want = slow_components(fps, 4)
    for i, x in enumerate(signed):
        assert got.get(x, x) == min(signed[j] for j in want[i])


def test_near_duplicates_and_representatives(spark):
    rows = made(60, 0, 12)
    docs = spark.createDataFrame([(i, t, "fp", 3) for i, t in rows], "doc_id long, text string, component_id string, fp int").repartition(5)
    got = sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in simhash.near_duplicates(docs).collect()), key=str)
    fps = [slow_fingerprint(t) for _, t in rows]
    groups = slow_components(fps, 4)
    least = {i: min((rows[j][0] for j in groups[i] if rows[j][0] is not None), default=None) for i in groups}
    assert got == sorted(((rows[i][0], fps[i], least[i]) for i in range(len(rows))), key=str)
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(least.values()))
    none = spark.createDataFrame([], docs.schema)
    assert simhash.near_duplicates(none).count() == simhash.representatives(none).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r["u"]: r["v"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)}


def test_removed_windows(spark):
    rows = made(50, 0, 40) + [(900, "p q r s t u v w " * 30), (901, "one two three four five six seven eight nine ten " + "z" * 10)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, part int").repartition(4)
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in substring.remove_repeats(docs, window=6).collect())
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    counts = Counter(tuple(w[k : k + 6]) for w in words for k in range(len(w) - 5))
    want = Counter()
    for (i, _), w in zip(rows, words):
        hit = {j for k in range(len(w) - 5) if counts[tuple(w[k : k + 6])] > 1 for j in range(k, k + 6)}
        want[(i, len(w), len(hit), " ".join(x for j, x in enumerate(w) if j not in hit))] += 1
    assert got == want
    assert substring.remove_repeats(spark.createDataFrame([], docs.schema)).count() == 0


def test_many_buckets_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(substring, "BUCKET_BYTES", 50)
    monkeypatch.setattr(substring, "_BLOCK", 64)
    rows = [(i, " ".join(str((i * k) % 50) for k in range(300))) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(3)
    got = {r["doc_id"]: r["kept"] for r in substring.remove_repeats(docs, window=10).collect()}
    counts = Counter(tuple(t.split()[k : k + 10]) for _, t in rows for k in range(291))
    for i, t in rows:
        w = t.split()
        hit = {j for k in range(291) if counts[tuple(w[k : k + 10])] > 1 for j in range(k, k + 10)}
        assert got[i] == " ".join(x for j, x in enumerate(w) if j not in hit)


def test_contamination(spark, monkeypatch):
    monkeypatch.setattr(decontam, "CHUNK", 16)
    vocabulary = ["aa", "Bb", "cÉ", "dd", "9", "É"]
    text = lambda n: " ".join(RNG.choice(vocabulary) + RNG.choice(["", ".", " -- "]) for _ in range(n))
    items = [(1, text(14)), (2, text(30)), (10, "Bb 9 aa"), (11, "dd"), (12, None), (13, ""), (14, "... --"), (3, text(10))]
    items += [(15, items[1][1].upper()), (16, "never seen words here"), (None, items[0][1])]
    docs = [(i, text(RNG.randint(0, 60))) for i in range(25)] + [(100, None), (101, ""), (102, "x " + items[1][1] + " y"), (103, items[0][1][10:]), (104, text(9)), (0, "same"), (0, "same"), (None, items[3][1])]
    docs += [(105, "Bb 9"), (106, "zz " * 70 + items[0][1] + " zz" * 33)]
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, item_id string, n int").repartition(3)
    b = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    got = Counter((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], tuple(r["item_ids"]), r["contaminated"]) for r in decontam.contamination(d, b).collect())
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    want, dirty = Counter(), []
    for i, t in docs:
        w, hit, found = words(t), set(), []
        for item, own in items:
            o = words(own)
            n = min(10, len(o))
            windows = {tuple(o[k : k + n]) for k in range(len(o) - n + 1)} if n else set()
            places = [k for k in range(len(w) - n + 1) if n and tuple(w[k : k + n]) in windows]
            hit |= {j for k in places for j in range(k, k + n)}
            found += [str(item)] if places and item is not None else []
        want[(i, len(w), len(hit), len(found), tuple(sorted(found)), bool(hit))] += 1
        dirty += [(i, t)] if hit else []
    assert got == want
    clean = decontam.clean(d, b)
    assert clean.columns == d.columns
    assert Counter((r["doc_id"], r["text"]) for r in clean.collect()) == Counter(docs) - Counter(dirty)
    empty = spark.createDataFrame([], b.schema)
    assert decontam.contamination(d, empty).filter("contaminated OR n_items > 0").count() == 0
    assert decontam.contamination(spark.createDataFrame([], d.schema), b).count() == 0


def test_contamination_runs_without_python(spark):
    d = spark.createDataFrame([(1, "a b c d e f g h i j k")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    plan = decontam.contamination(d, b)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    monkey = decontam.contamination(d, b).select(F.sha2(F.array_join("item_ids", ","), 256).alias("s")).first()["s"]
    assert monkey == hashlib.sha256(b"1").hexdigest()


def test_words_that_polynomials_confuse_are_told_apart(spark):
    """Two documents whose first words are a 1,024-character Thue-Morse string and its
    complement share no window of 35 words."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = one.translate(str.maketrans("ab", "ba"))
    tail = " ".join(f"w{i}" for i in range(34))
    docs = spark.createDataFrame([(1, f"{one} {tail}"), (2, f"{other} {tail}")], "doc_id long, text string")
    assert [r["n_removed"] for r in substring.remove_repeats(docs, window=35).collect()] == [0, 0]


def test_windows_that_share_the_first_hash():
    """With every first hash alike the second one decides alone."""
    w = substring.window_hashes(np.frombuffer(b"a b c d a b", np.uint8), *substring.words_at(np.frombuffer(b"a b c d a b", np.uint8)), 2)
    known, counts = substring.different(w)
    assert sorted(counts) == [1, 1, 1, 2] and substring.Known(known[counts > 1]).holds(w).tolist() == [True, False, False, False, True]
    w["h"] = 5
    known, counts = substring.different(w)
    assert sorted(counts) == [1, 1, 1, 2] and substring.Known(known[counts > 1]).holds(w).tolist() == [True, False, False, False, True]
    assert (substring.from_planes(substring.planes(known)) == known).all() and len(substring.from_planes(b"")) == 0
    assert not substring.Known(known[:0]).holds(w).any()
