"""Copies are dropped without moving the rows that have none."""

from pyspark.sql import functions as F

from touchline.operators.cleaning import drop_copies


def test_only_rows_that_may_have_copies_are_moved(spark, monkeypatch):
    rows = spark.range(0, 2000, 1, 5).select("id", F.when(F.col("id") % 7 > 0, F.col("id") % 5).alias("a"),
                                             F.when(F.col("id") % 3 > 0, F.lit(float("nan"))).otherwise(F.lit(0.0)).alias("b"))
    copies = rows.filter("id % 50 = 0").withColumn("b", F.when(F.col("b") == 0.0, F.lit(-0.0)).otherwise(F.col("b")))
    both = rows.unionByName(copies).unionByName(copies)
    moved, plain = [], type(both).dropDuplicates

    def seen(df, *args):
        moved.append(df.count())
        return plain(df, *args)
    monkeypatch.setattr(type(both), "dropDuplicates", seen)
    found = drop_copies(both)
    assert moved == [120]
    assert found.count() == found.select("id").distinct().count() == 2000
    assert sorted(map(str, found.collect())) == sorted(map(str, plain(both).withColumn("b", F.col("b") + 0.0).collect()))


def test_rows_that_differ_in_nulls_only_are_kept(spark):
    rows = spark.createDataFrame([(1, None, 2), (1, 2, None), (None, 1, 2), (1, None, 2)], "a int, b int, c int")
    assert drop_copies(rows).count() == 3
    assert drop_copies(rows.filter("a > 5")).count() == 0
