"""Tree ensembles scored from flat arrays give what the fitted models give."""

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from touchline.operators import models as ml
from touchline.operators import trees as tr


@pytest.fixture(scope="module")
def rows(spark):
    plain = spark.range(900).selectExpr("id AS MatchId", "CAST(abs(xxhash64(id)) % 3 AS DOUBLE) AS label", "CAST(id % 7 AS DOUBLE) AS a",
                                        "CAST(id * 37 % 101 AS DOUBLE) / 8 AS b", "IF(id % 5 < 4, 0D, CAST(id AS DOUBLE)) AS c")
    kept = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(plain).select(
        "MatchId", "label", "features", (F.col("label") + 1).alias(ml.WEIGHT))
    return kept.repartition(4, "MatchId").persist()


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_forest(rows, spark):
    model = ml.random_forest(trees=15, depth=9, min_leaf=1).fit(rows)
    got = tr.predict_trees(tr.forest_trees(model, spark), rows)
    assert got.dtypes == ml.predict(model, rows).dtypes
    assert as_set(got) == as_set(ml.predict(model, rows)) and len({r["prediction"] for r in got.collect()}) == 3


def test_blocks_do_not_matter(rows, spark, monkeypatch):
    """An uneven last block, and a tree of a single leaf."""
    model = ml.random_forest(None, trees=3, depth=5).fit(rows)
    flat = tr.forest_trees(model, spark)
    monkeypatch.setattr(tr, "BLOCK_ROWS", 7)
    assert as_set(tr.predict_trees(flat, rows)) == as_set(ml.predict(model, rows))
    stump = ml.random_forest(None, trees=3, depth=0).fit(rows)
    assert as_set(tr.predict_trees(tr.forest_trees(stump, spark), rows)) == as_set(ml.predict(stump, rows))
    assert tr.predict_trees(flat, rows.filter("false")).count() == 0


def test_boosted_and_its_curve(rows, spark):
    model = ml.boosted_trees(rounds=6, depth=3).fit(rows)
    flat = tr.boosted_trees_by_class(model, spark)
    assert as_set(tr.predict_trees(flat, rows)) == as_set(ml.predict(model, rows))
    got = {(r["class"], r["round"]): r["loss"] for r in tr.boosting_curve(flat, rows, ml.CLASS_NAMES, ml.WEIGHT).collect()}
    assert len(got) == 3 * 6
    for c, binary in enumerate(model.models):
        data = rows.withColumn(binary.getLabelCol(), (F.col("label") == c).cast("double"))
        for i, loss in enumerate(binary.evaluateEachIteration(data)):
            assert got[ml.CLASS_NAMES[c], i + 1] == pytest.approx(loss, rel=1e-9)


def test_curve_is_one_pass_and_sends_sums(rows, spark):
    """The losses of all classes and rounds come from one scan; no class has a pass of its own, and nothing runs before the result."""
    flat = tr.boosted_trees_by_class(ml.boosted_trees(rounds=2, depth=2).fit(rows), spark)
    plan = tr.boosting_curve(flat, rows, ml.CLASS_NAMES, ml.WEIGHT)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "partial_sum" in plan
