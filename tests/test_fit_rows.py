"""What a learner is fitted on lies in a few partitions, whatever the input's."""

from pyspark.sql import functions as F

from touchline.operators import boosting
from touchline.plans import learners


def test_fit_rows_take_few_tasks(spark):
    rows = spark.range(0, 3000, 1, 50).withColumnRenamed("id", "MatchId")
    kept = learners.fit_sample(rows, 1000)
    assert kept.rdd.getNumPartitions() <= learners.FIT_TASKS
    assert 800 < kept.count() < 1200
    again = learners.fit_sample(rows.repartition(7), 1000)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, kept.collect()))


def test_one_block_does_not_pull_the_scan_into_one_task(spark, tmp_path, monkeypatch):
    spark.range(0, 400, 1, 9).select(F.col("id").alias("MatchId"), (F.col("id") % 3).cast("int").alias("label"),
                                     (F.col("id") % 7).cast("double").alias("a")).write.parquet(str(tmp_path / "rows"))
    packed, plans = boosting._pack, []

    def seen(cols, *rest):
        plans.append(cols._jdf.queryExecution().toString())
        return packed(cols, *rest)
    monkeypatch.setattr(boosting, "_pack", seen)
    model = boosting.fit_boosted(spark.read.parquet(str(tmp_path / "rows")), ["a"], rounds=2)
    assert len(model.rounds) == 2
    assert "Exchange SinglePartition" in plans[0] and "Coalesce" not in plans[0]


def test_coded_rows_are_written_once(inputs):
    """No query joins the category codes again: train and test are read from one stored table."""
    for part in (*inputs.encoded, *inputs.scaled):
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and plan.count("FileScan parquet") == 1
    assert inputs.encoded[0].schema["HomeTeam"].dataType.simpleString() == "int"


def test_a_round_moves_one_column(spark):
    """Clusters as by columns, with one packed value per row instead of a column per feature."""
    from touchline.operators import kmeans
    rows = spark.range(300).selectExpr("id AS MatchId", "CAST(id % 17 AS DOUBLE) AS a", "CAST(IF(id = 5, NULL, id % 13) AS DOUBLE) AS b")
    start = [[1.0, 1.0], [9.0, 9.0], [500.0, 500.0]]
    vectors = kmeans._vectors(rows.dropna().select("a", "b"), 2)
    assert vectors.columns == ["x"]
    want = [[r["a"], r["b"]] for r in kmeans.cluster_means(rows, ["a", "b"], start).orderBy("cluster").collect()]
    assert kmeans._update_packed(vectors, ["a", "b"], start) == want + [start[2]]


def test_rounds_cache_nothing(spark, monkeypatch):
    """Packed rows are streamed from a file: a cache of them took an executor's whole memory. The file goes with the fit."""
    import os

    from touchline.operators import kmeans
    rows = spark.range(400).selectExpr("id AS MatchId", "CAST(id % 17 AS DOUBLE) AS a", "CAST(IF(id = 5, NULL, id % 13) AS DOUBLE) AS b")
    sources, update = [], kmeans._update_packed

    def noted(vectors, *rest):
        sources.append((vectors.storageLevel.useMemory, vectors.kept_at))
        return update(vectors, *rest)
    monkeypatch.setattr(kmeans, "_update_packed", noted)
    fit = kmeans.fit_kmeans(rows, ["a", "b"], 3, max_iter=4, tol=0.0)
    assert fit.iterations == len(sources) > 0 and not any(memory for memory, _ in sources)
    assert not os.path.exists(sources[0][1].removeprefix("file:"))
