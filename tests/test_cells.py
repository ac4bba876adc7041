"""Nearest neighbours by cells: exact, with copies, and without meeting what lies too far."""

import numpy as np
import pandas as pd
import pytest

from touchline.operators import cells, knn


def expected(ids, x, q, k):
    diff = (x[None] - q[:, None]).reshape(-1, x.shape[1])
    d = np.round(np.sqrt(np.einsum("ij,ij->i", diff, diff)), cells.DIGITS).reshape(len(q), len(x))
    return [[(float(d[i, j]), int(ids[j])) for j in np.lexsort((ids, d[i]))[:k]] for i in range(len(q))]


@pytest.mark.parametrize("shift,scale", [(0.0, 1.0), (1e6, 1e-3), (0.0, 1e18)])
def test_piece_equals_brute_force(shift, scale):
    r = np.random.default_rng(1)
    x = np.concatenate([r.normal(size=(700, 3)).round(1), np.ones((100, 3))]) * scale + shift
    q, ids = np.concatenate([r.normal(size=(90, 3)) * scale + shift, x[::20]]), r.permutation(800) * 3
    piece = cells.Piece(ids, ids % 3, x, 5, leaf_rows=50)
    want = expected(ids, x, q, 5)
    for limit in (np.full(len(q), np.inf), np.array([w[-1][0] for w in want])):
        d, t, y = piece.nearest(q, limit)
        assert [list(zip(a.tolist(), b.tolist(), strict=True)) for a, b in zip(d, t, strict=True)] == want
        assert (y == t % 3).all()


def test_far_leaves_are_not_measured(monkeypatch):
    """Groups far apart: a query meets its own group's leaves only."""
    r = np.random.default_rng(2)
    x = np.concatenate([r.normal(size=(100, 4)) + 100 * g for g in range(20)])
    piece, met = cells.Piece(np.arange(2000), np.zeros(2000, int), x, 3, leaf_rows=100), []
    meet = piece._meet
    monkeypatch.setattr(piece, "_meet", lambda leaf, rows, state: (met.append(len(rows)), meet(leaf, rows, state)))
    piece.nearest(x, np.full(2000, np.inf))
    assert sum(met) <= 3 * 2000  # of 20 leaves for each query


@pytest.mark.parametrize("piece_rows", [40, 100_000])
def test_cells_equal_the_broadcast(spark, piece_rows):
    r = np.random.default_rng(3)
    rows = pd.DataFrame(np.concatenate([r.normal(size=(500, 3)).round(1), np.full((200, 3), 0.25)]), columns=list("abc"))
    rows["MatchId"], rows["label"] = np.arange(700) * 5, np.arange(700) % 3
    rows.loc[3, "a"] = None
    df = spark.createDataFrame(rows)
    plain = knn.knn_neighbours(df, df, list("abc"), "label", 6).collect()
    assert len(plain) == 6 * 699
    got = knn.knn_neighbours(df, df, list("abc"), "label", 6, max_pairs=0, piece_rows=piece_rows).collect()
    assert sorted(map(tuple, got)) == sorted(tuple(row[c] for c in got[0].__fields__) for row in plain)
