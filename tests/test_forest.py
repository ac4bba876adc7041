"""Importances of the forest against plain recursion, and the same wherever a node is grown."""

import numpy as np
import pytest

from touchline.operators import forest


def _rows(n, seed):
    rng = np.random.default_rng(seed)
    bins = rng.integers(0, 6, (n, 7)).astype(np.uint8)
    label = (bins[:, 1] // 3 + (rng.random(n) < 0.2) + (bins[:, 4] == 2)).clip(0, 2).astype(np.int64)
    return np.arange(n).astype(np.uint64), bins, label


def _gini(rows):
    n = sum(w for _, _, w in rows)
    by = {}
    for _, c, w in rows:
        by[c] = by.get(c, 0) + w
    return n - sum(v * v for v in by.values()) / n if n else 0


def _naive(rows, node, depth, tree, gains):
    if depth == 0 or len({c for _, c, _ in rows}) < 2:
        return
    best = (1e-9 * max(1, _gini(rows)), None, None)
    for f in forest.chosen_features(np.array([node]), len(gains), tree, 42)[0]:
        for cut in sorted({x[f] for x, _, _ in rows}):
            left, right = [r for r in rows if r[0][f] <= cut], [r for r in rows if r[0][f] > cut]
            gain = _gini(rows) - _gini(left) - _gini(right)
            if right and gain > best[0] + 1e-9:
                best = (gain, f, cut)
    if best[1] is None:
        return
    gains[best[1]] += best[0]
    for child, side in ((2 * node, [r for r in rows if r[0][best[1]] <= best[2]]), (2 * node + 1, [r for r in rows if r[0][best[1]] > best[2]])):
        _naive(side, child, depth - 1, tree, gains)


@pytest.mark.parametrize("depth", [1, 3, 30])
def test_tree_equals_plain_recursion(depth):
    ids, bins, label = _rows(250, depth)
    for tree in range(4):
        weight = forest.bootstrap(ids, tree, 42)
        want = np.zeros(7)
        _naive([(tuple(map(int, x)), int(c), int(w)) for x, c, w in zip(bins, label, weight, strict=True) if w], 1, depth, tree, want)
        assert np.allclose(forest.grow(ids, bins, label, tree, 1, depth, 3, 42), want)


def test_bootstrap_is_poisson():
    w = forest.bootstrap(np.arange(200_000), 3, 42)
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.03
    assert abs(np.corrcoef(w, forest.bootstrap(np.arange(200_000), 4, 42))[0, 1]) < 0.02


@pytest.mark.parametrize("task_rows", [30, 400])
def test_same_forest_in_one_task_or_many(spark, task_rows):
    """Upper levels by histograms of all tasks, the rest in a task each: the same gains as whole trees in a task."""
    rng = np.random.default_rng(1)
    rows = [(i, *map(float, rng.normal(size=5)), None) for i in range(1500)]
    rows = [(*r[:6], "HDA"[int(r[1] > 0) + int(r[2] + 0.3 * rng.normal() > 0.5)]) for r in rows] + [(9999, None, 1.0, 1.0, 1.0, 1.0, "H")]
    df = spark.createDataFrame(rows, "MatchId long, a double, b double, c double, d double, e double, FTResult string").repartition(3)
    whole = dict(forest.forest_importance(df, list("abcde"), trees=10).collect())
    split = dict(forest.forest_importance(df, list("abcde"), trees=10, task_rows=task_rows).collect())
    assert split == pytest.approx(whole, abs=1e-12)
    assert sum(whole.values()) == pytest.approx(1)
    assert min(whole["a"], whole["b"]) > 2 * max(whole["c"], whole["d"], whole["e"])


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(i, float(i), "H") for i in range(20)], "MatchId long, a double, FTResult string")
    assert dict(forest.forest_importance(df, ["a"], trees=3).collect()) == {"a": 0.0}
    assert dict(forest.forest_importance(df.limit(0), ["a"], trees=3).collect()) == {"a": 0.0}


@pytest.mark.parametrize("cells", [0, 1, 1000])
def test_counted_and_sorted_splits_agree(cells, monkeypatch):
    """Nodes of many rows are split from counts, others by sorting: the same gains, features and bins."""
    r = np.random.default_rng(5)
    node, bins, label = r.integers(0, 9, 4000), r.integers(0, 32, (4000, 7)).astype(np.uint8), r.integers(0, 3, 4000)
    weight, choices = r.integers(1, 4, 4000).astype(float), np.sort(np.argsort(r.random((9, 7)), axis=1)[:, :3], axis=1)
    monkeypatch.setattr(forest, "COUNTED_CELLS", cells)
    got = forest.best_splits(node, bins, label, weight, 9, choices, 3)
    want = forest._counted_splits(node, bins, label, weight, 9, choices, 3, 32)
    assert all((a == b).all() for a, b in zip(got, want, strict=True)) and (got[0] > 0).all()


def test_drawn_rows_are_shipped_in_large_pieces(spark):
    """A node's rows come in one piece per ``SHIPPED_ROWS`` source rows, with a byte for how often each is drawn."""
    df = spark.range(0, 5000, 1, 1).selectExpr("id AS MatchId", "CAST(id % 11 AS DOUBLE) AS a", "element_at(array('A', 'D', 'H'), CAST(id % 3 + 1 AS INT)) AS FTResult")
    rows = forest.binned(df, ["a"])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 500)
    try:
        lines = forest._shipped(rows, [[4]], 1, 42, {4: {1: (0, 5)}}, {4: [2, 3]}).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(r.node for r in lines) == [2, 3]
    assert all(len(r.drawn) == len(r.bins) == len(r.label) for r in lines)
