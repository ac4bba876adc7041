"""Joint softmax boosting against a plain version of one round, and its losses."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.operators import boosting as bo


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 20, (1200, 4)).astype(float)
    y = ((x[:, 0] > 9).astype(int) + ((x[:, 1] > 12) & (rng.random(1200) < 0.9))).clip(0, 2)
    w = rng.choice([0.5, 1.0, 2.0], 1200)
    data = [(i, int(y[i]), float(w[i]), *map(float, x[i])) for i in range(1200)]
    df = spark.createDataFrame(data, "MatchId long, label int, w double, a double, b double, c double, d double").repartition(5)
    return x, y, w, df


def _plain_tree(x, grad, hess, depth, rate, values):
    """Leaf value of each row for a tree grown on all rows and features."""
    total_g, total_h = grad.sum(), hess.sum()
    best = (1e-12, None)
    for f in range(x.shape[1]) if depth else []:
        for cut in np.unique(values[:, f])[:-1]:
            left = x[:, f] <= cut
            g, h = grad[left].sum(), hess[left].sum()
            if h < 1 or total_h - h < 1:
                continue
            gain = g * g / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g ** 2 / (total_h + 1)
            if gain > best[0] + 1e-9:
                best = (gain, left)
    if best[1] is None:
        return np.full(len(x), -rate * total_g / (total_h + 1))
    out = np.zeros(len(x))
    for side in (best[1], ~best[1]):
        out[side] = _plain_tree(x[side], grad[side], hess[side], depth - 1, rate, values)
    return out


@pytest.mark.parametrize("block_rows", [100, 5000])
def test_rounds_equal_a_plain_version(rows, block_rows):
    """In one task, and with sums that all tasks add up."""
    x, y, w, df = rows
    model = bo.fit_boosted(df, list("abcd"), weight="w", rounds=3, depth=3, rate=0.3, share=1.0, columns=1.0, block_rows=block_rows)
    scores = np.zeros((len(y), 3))
    for _ in range(3):
        p = bo.softmax(scores)
        scores = scores + np.stack([_plain_tree(x, w * (p[:, c] - (y == c)), w * 2 * p[:, c] * (1 - p[:, c]), 3, 0.3, x) for c in range(3)], 1)
    got = model.add_scores(np.zeros((len(y), 3)), model.binned(list(x.T)), 0)
    assert np.allclose(got, scores)
    predicted = dict(bo.predict_boosted(model, df).select("MatchId", "prediction").collect())
    assert [predicted[i] for i in range(len(y))] == scores.argmax(1).tolist()
    last = bo.loss_curve(model, df, weight="w").orderBy(F.col("round").desc()).first()
    assert last.log_loss == pytest.approx(-(w * np.log(bo.softmax(scores)[np.arange(len(y)), y])).sum() / w.sum())


def test_loss_falls_and_scores_are_refreshed(rows, monkeypatch):
    x, y, _, df = rows
    plain = bo.fit_boosted(df, list("abcd"), rounds=7, depth=2, share=0.8, columns=0.5)
    monkeypatch.setattr(bo, "REFRESH", 3)
    again = bo.fit_boosted(df, list("abcd"), rounds=7, depth=2, share=0.8, columns=0.5, block_rows=500)
    bins = plain.binned(list(x.T))
    zero = np.zeros((len(y), 3))
    assert np.allclose(plain.add_scores(zero, bins, 0), again.add_scores(zero, bins, 0))
    losses = [r.log_loss for r in bo.loss_curve(plain, df).orderBy("round").collect()]
    assert len(losses) == 7 and all(a > b for a, b in zip(losses, losses[1:], strict=False)) and losses[0] < np.log(3)


def test_edges(rows, spark):
    *_, df = rows
    with_null = df.withColumn("a", F.when(F.col("MatchId") > 5, F.col("a")))
    model = bo.fit_boosted(with_null, list("abcd"), rounds=1, depth=2)
    assert bo.predict_boosted(model, with_null).count() == 1194
    assert bo.predict_boosted(model, df.limit(0)).collect() == []
    assert bo.loss_curve(model, df.limit(0)).collect() == []
    one = bo.fit_boosted(df.withColumn("label", F.lit(1)), list("abcd"), rounds=2, depth=2)
    assert {r.prediction for r in bo.predict_boosted(one, df).collect()} == {1}



def test_scores_are_kept_from_round_to_round(rows, monkeypatch):
    """A task adds the trees of a round to its rows' scores once, not in every job since the blocks were written."""
    x, _, _, df = rows
    added, with_rounds = [], bo._with_rounds
    monkeypatch.setattr(bo, "_with_rounds", lambda blocks, model, since: added.append(len(model.rounds) - since) or with_rounds(blocks, model, since))
    settings = {"rounds": 4, "depth": 3, "share": 0.8, "columns": 0.75, "weight": "w"}
    many, one = (bo.fit_boosted(df, list("abcd"), **settings, block_rows=n) for n in (200, 5000))
    assert added == [1] * 4
    bins, zero = many.binned(list(x.T)), np.zeros((len(x), 3))
    assert np.allclose(many.add_scores(zero, bins, 0), one.add_scores(zero, bins, 0))
