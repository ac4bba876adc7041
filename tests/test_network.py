"""The neural net: gradients, batch statistics, training on blocks, early stop."""

import numpy as np
import pytest

from touchline.operators import network as nw


def _batch(n=12, width=4, seed=3):
    draw = np.random.default_rng(seed)
    return draw.normal(size=(n, width)), draw.integers(0, 3, n), draw.uniform(0.5, 2, n)


def test_gradient_equals_finite_differences():
    shape = nw.Shape((4, 6, 5, 3), (0.3, 0.2))
    x, y, w = _batch()
    draw = np.random.default_rng(0)
    weights = shape.start(1) + draw.normal(size=len(shape.start(1))) * 0.1
    masks = [(draw.random((len(x), n)) >= d) / (1 - d) for n, d in zip((6, 5), shape.dropout, strict=True)]
    _, grad, _, _ = nw.loss_and_gradient(shape, weights, x, y, w, masks)
    for i in range(len(weights)):
        step = np.zeros_like(weights)
        step[i] = 1e-6
        up, down = (nw.loss_and_gradient(shape, weights + s, x, y, w, masks)[0] for s in (step, -step))
        assert grad[i] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def test_first_adam_step_moves_by_the_rate():
    state = nw.start_state(nw.Shape((2, 3, 3), (0.0,)), 1)
    before, grad = state.weights.copy(), np.linspace(-1, 1, len(state.weights))
    nw.adam_step(state, grad)
    moved = np.abs(grad) > 1e-3
    assert np.allclose((before - state.weights)[moved], nw.ADAM_RATE * np.sign(grad[moved]), rtol=1e-3)


def _table(spark, n=1500):
    draw = np.random.default_rng(5)
    x = draw.normal(size=(n, 3))
    y = np.where(x[:, 0] * x[:, 1] > 0.3, 2, np.where(x[:, 2] > 0, 1, 0))
    rows = [(i, *map(float, r), int(c)) for i, (r, c) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, "MatchId long, a double, b double, c double, label int")


SMALL = {"hidden": (32, 16), "dropout": (0.1, 0.1), "batch": 64, "epochs": 40}


@pytest.mark.parametrize(("block_rows", "epochs"), [(10_000, 40), (400, 160)])
def test_learns_on_one_and_on_many_blocks(spark, block_rows, epochs):
    """Four blocks side by side take a quarter of the steps an epoch, so they get as many steps in four times the epochs."""
    rows = _table(spark)
    net = nw.fit_network(rows, ["a", "b", "c"], block_rows=block_rows, **SMALL | {"epochs": epochs})
    found = nw.predict_network(net, rows).collect()
    assert len(found) == 1500
    assert sum(r.label == r.prediction for r in found) / 1500 > 0.85
    assert [e.epoch for e in net.history] == list(range(1, len(net.history) + 1))
    best = min(net.history, key=lambda e: e.val_loss)
    assert net.best_epoch == best.epoch and net.history[0].val_loss > best.val_loss


def test_same_net_from_any_partitioning(spark):
    rows, how = _table(spark, 300), SMALL | {"epochs": 3}
    a = nw.fit_network(rows.repartition(5), ["a", "b", "c"], **how)
    b = nw.fit_network(rows.coalesce(1), ["a", "b", "c"], **how)
    assert np.array_equal(a.state.weights, b.state.weights) and a.history == b.history


def test_stops_when_validation_does_not_fall(spark):
    noise = _table(spark, 300).selectExpr("MatchId", "a", "b", "c", "CAST(pmod(xxhash64(MatchId), 3) AS INT) AS label")
    net = nw.fit_network(noise, ["a", "b", "c"], **SMALL | {"epochs": 100, "dropout": (0.0, 0.0)}, patience=3)
    assert len(net.history) == net.best_epoch + 3 < 100
    # The measured state is the one that is returned.
    held = [e for e in net.history if e.epoch == net.best_epoch][0]
    assert held.val_loss == min(e.val_loss for e in net.history)


def test_validation_rows_are_not_trained_on(spark):
    """With every row held back nothing is learnt; with none the train loss decides."""
    rows = _table(spark, 200)
    start = nw.start_state(nw.Shape((3, 32, 16, 3), (0.1, 0.1)), 42)
    idle = nw.fit_network(rows, ["a", "b", "c"], **SMALL | {"epochs": 2}, validation=1.0)
    assert np.array_equal(idle.state.weights, start.weights)
    free = nw.fit_network(rows, ["a", "b", "c"], **SMALL | {"epochs": 2}, validation=0.0)
    assert [(e.loss, e.accuracy) for e in free.history] == [(e.val_loss, e.val_accuracy) for e in free.history]


def test_nulls_and_an_empty_table(spark):
    rows = _table(spark, 50)
    holes = rows.selectExpr("MatchId", "IF(MatchId < 5, NULL, a) AS a", "b", "c", "label", "1 AS block", "'x' AS held")
    net = nw.fit_network(holes, ["a", "b", "c"], **SMALL | {"epochs": 1})
    assert nw.predict_network(net, holes).count() == 45
    empty = nw.fit_network(rows.limit(0), ["a", "b", "c"], **SMALL | {"epochs": 1})
    assert nw.predict_network(empty, rows).count() == 50


def test_class_weights_shift_predictions(spark):
    rows = _table(spark, 600).selectExpr("*", "IF(label = 0, 20D, 1D) AS w")
    how = SMALL | {"epochs": 15}
    plain, heavy = (nw.predict_network(nw.fit_network(rows, ["a", "b", "c"], weight=w, **how), rows).filter("prediction = 0").count()
                    for w in (None, "w"))
    assert heavy > plain
