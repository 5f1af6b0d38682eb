"""Visits of the nearest-neighbour search: a bit per leaf, the leaves that come first best-bin first."""

import pathlib
from itertools import islice

import numpy as np
import pytest
from test_ann_pipeline import slow

from roundbook.llm import ann
from roundbook.plans.config import ensure_checkpoint_dir


@pytest.fixture(scope="module")
def tree():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 6))
    x[100:300] = np.round(x[100:300])
    return ann.Tree(x, 90_000)


def test_visited_are_the_first_of_the_best_bins(tree):
    rng = np.random.default_rng(5)
    q = np.concatenate([rng.normal(size=(60, 6)), tree.centre[:60], np.zeros((1, 6))])
    assert len(tree.leaves) > 40
    rows = rng.integers(0, 9, len(tree.leaves))
    for visits, least in ((1, 0), (3, 0), (17, 0), (len(tree.leaves), 0), (10**6, 10), (2, 40), (5, 10**9)):
        seen, early = tree.visited(q, visits, 8, rows, least)
        for one in range(len(q)):
            order = list(tree.best_bins(q[one]))
            assert sorted(order) == sorted(tree.leaves)
            n = next((i for i in range(len(order)) if i >= visits and rows[[tree.place[leaf] for leaf in order[:i]]].sum() > least), len(order))
            assert {tree.leaves[i] for i in np.flatnonzero(seen[one])} == set(islice(order, n))
            assert early[one].sum() == min(8, n) and not (early[one] & ~seen[one]).any()


def test_leaves_with_one_largest_distance_come_in_the_order_of_the_queue():
    """Below a node that is farther than all that is under it, the queue alone tells the order."""
    tree = ann.Tree(np.zeros((1, 1)), 1)
    tree.centre = np.array([[0.0], [10.0], [3.0], [1.0], [2.0], [1.5], [-4.0]])
    tree.children = [[1, 2], [3, 4, 5, 6], [], [], [], [], []]
    tree.leaves, tree.parent = [2, 3, 4, 5, 6], {1: 0, 2: 0, 3: 1, 4: 1, 5: 1, 6: 1}
    tree.place = {leaf: i for i, leaf in enumerate(tree.leaves)}
    q, rows = np.array([[0.0]]), np.ones(5)
    assert list(tree.best_bins(q[0])) == [2, 3, 5, 4, 6]
    for n, want in ((1, {2}), (2, {2, 3}), (3, {2, 3, 5}), (4, {2, 3, 5, 4}), (5, {2, 3, 5, 4, 6})):
        assert {tree.leaves[i] for i in np.flatnonzero(tree.visited(q, n, 8, rows, 0)[0][0])} == want


def test_a_query_is_written_once_however_many_leaves_it_visits(spark, monkeypatch):
    """Before, a row with the whole vector for each leaf, made in one piece by a task."""
    for name, value in (("LEAF_ROWS", 20), ("TILE_ROWS", 150), ("TILE_QUERIES", 3)):
        monkeypatch.setattr(ann, name, value)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1200, 12)).astype(np.float32)
    x[700:1000] = x[700]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(3)
    folder = pathlib.Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(folder.glob("visits-*"))
    ask = lambda: sorted(tuple(r) for r in ann.search(df, df.filter("vec_id % 40 = 0")).collect())
    got = ask()
    (new,) = set(folder.glob("visits-*")) - before
    assert spark.read.parquet(str(new)).count() == 30
    want = slow(list(range(1200)), x.astype(float), range(0, 1200, 40), 10)
    found = {(q, i) for q, _, i, _ in got}
    assert len(got) == 300 and sum((q, i) in found for q, near in want.items() for _, i in near) >= 270
    for name, value in (("ROUGH", 90), ("EXACT", 40), ("VALUES", 600)):  # the same in small parts
        if hasattr(ann, name):
            monkeypatch.setattr(ann, name, value)
    assert ask() == got


def test_a_leaf_is_passed_over_only_where_all_its_rows_are_beyond_the_bound():
    """Rows at one point, far from the origin, very small and very large ones."""
    rng = np.random.default_rng(2)
    plain = np.concatenate([rng.normal(size=(40, 5)) + 6 * rng.normal(size=5) for _ in range(12)])
    plain[80:120] = plain[80]
    for x in (plain, plain + 1e6, plain * 1e-120, plain * 1e120, plain * 1e200, np.zeros((480, 5))):
        q = x[::7]
        with np.errstate(over="ignore", invalid="ignore"):
            far = np.sqrt(((q[:, None] - x[None]) ** 2).sum(axis=2))
        balls = [ann._ball(x[i : i + 40]) for i in range(0, len(x), 40)]
        least = far.reshape(len(q), 12, 40).min(axis=2)
        for bound in (least[:, 3], np.sort(far, axis=1)[:, 10], np.zeros(len(q)), np.full(len(q), np.inf)):
            beyond = ann._beyond(ann._sides(q)[0], balls, bound)
            assert not (beyond & (least <= bound[:, None])).any()
            if x is plain and bound.max() < least.max():
                assert beyond.any()
