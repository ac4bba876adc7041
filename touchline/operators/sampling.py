"""Reproducible samples and splits: chosen by a hash of the key, not by row position."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.expressions import HASH_RANGE, key_hash
from touchline.schema import KEY, TARGET


def hash_sample(df: DataFrame, fraction: float, key: str = KEY, seed: int = 42) -> DataFrame:
    """Bernoulli sample that any partitioning reproduces."""
    return df.filter(key_hash(key, f"sample{seed}") < int(fraction * HASH_RANGE))


def hash_split(df: DataFrame, fraction: float = 0.8, key: str = KEY, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test by key hash; every row is in exactly one of them."""
    h, edge = key_hash(key, seed), int(fraction * HASH_RANGE)
    return df.filter(h < edge), df.filter(h >= edge)


def random_split(df: DataFrame, fraction: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Spark's own split; repeatable only for the same input partitioning."""
    train, test = df.randomSplit([fraction, 1 - fraction], seed)
    return train, test


def stratified_sample(df: DataFrame, fraction: float, by: str = TARGET, strata=("A", "D", "H"), key: str = KEY,
                      seed: int = 42, buckets: int = 4096) -> DataFrame:
    """Exactly round(fraction * n) rows of every stratum: those with the least (hash, key).

    Sorting a whole stratum is avoided. Rows are counted per hash bucket; full
    buckets below the cut go in as they are, and only the bucket that holds the
    cut is ranked.
    """
    width = HASH_RANGE // buckets
    rows = (df.filter(F.col(by).isin(list(strata))).withColumn("_h", key_hash(key, f"strata{seed}"))
              .withColumn("_b", F.floor(F.col("_h") / width)))
    stratum = Window.partitionBy(by)
    # At most len(strata) * buckets rows.
    cut = (rows.groupBy(by, "_b").agg(F.count("*").alias("_n"))
               .withColumn("_cum", F.sum("_n").over(stratum.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)))
               .withColumn("_want", F.round(F.sum("_n").over(stratum) * F.lit(fraction)).cast("bigint"))
               .withColumn("_left", F.col("_want") - (F.col("_cum") - F.col("_n")))
               .filter("_left > 0").select(by, "_b", "_n", "_left"))
    tagged = rows.join(F.broadcast(cut), [by, "_b"])
    order = Window.partitionBy(by, "_b").orderBy("_h", key)
    edge = (tagged.filter("_left < _n").withColumn("_rn", F.row_number().over(order))
                  .filter("_rn <= _left").drop("_rn"))
    return tagged.filter("_left >= _n").unionByName(edge).select(*df.columns)


def first_by_hash(df: DataFrame, k: int, key: str = KEY, seed: int = 42) -> DataFrame:
    """The k rows with the least (hash, key): a seeded draw without replacement."""
    return df.orderBy(key_hash(key, f"draw{seed}"), key).limit(k)
