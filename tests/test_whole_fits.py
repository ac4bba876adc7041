"""No learner is fitted on a sample of its train rows."""

from types import SimpleNamespace

import pytest

from touchline.operators import boosting as bo
from touchline.operators import models as ml
from touchline.operators import network as nw
from touchline.operators import trees as tr
from touchline.plans import learners

ROWS = 12_000


@pytest.fixture
def seen(spark, monkeypatch):
    """Row counts that reach a learner; the models themselves are not made."""
    rows = spark.range(ROWS).selectExpr("id AS MatchId", "CAST(id % 3 AS INT) AS label", f"1D AS {ml.WEIGHT}",
                                        "element_at(array('A', 'D', 'H'), CAST(id % 3 AS INT) + 1) AS FTResult")
    counts = []

    def noted(fit_rows, *_, **__):
        counts.append((fit_rows.count(), fit_rows.select("MatchId").distinct().count()))
    for module, name in ((learners, "learning_rows"), (learners, "coded_rows")):
        monkeypatch.setattr(module, name, lambda *_, **__: [rows, rows])
    for name in ("random_forest", "boosted_trees", "neural_net", "softmax_regression"):
        monkeypatch.setattr(ml, name, lambda *_, **__: SimpleNamespace(fit=noted))
    for module, name in ((bo, "fit_boosted"), (nw, "fit_network")):
        monkeypatch.setattr(module, name, noted)
    for name in ("forest_trees", "boosted_trees_by_class"):
        monkeypatch.setattr(tr, name, lambda *_: None)
    monkeypatch.setattr(learners, "fitted", lambda t, name, fit: fit())
    return SimpleNamespace(spark=spark, split=(rows, rows), scaled=(rows, rows)), counts


@pytest.mark.parametrize("learner", ["forest", "boosted", "joint_boosted", "net", "relu_net", "softmax"])
def test_every_train_row_is_fitted_on(seen, learner):
    t, counts = seen
    getattr(learners, learner)(t)
    assert counts == [(ROWS, ROWS)]


def test_many_rows_lie_in_more_partitions(spark):
    assert learners.fit_rows(spark.range(3000).withColumnRenamed("id", "MatchId")).rdd.getNumPartitions() == learners.FIT_TASKS
    many = learners.fit_rows(spark.range(101_000).withColumnRenamed("id", "MatchId"))
    assert many.rdd.getNumPartitions() == 6 and many.count() == 101_000
