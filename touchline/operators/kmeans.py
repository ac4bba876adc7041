"""k-means by repeated assignment and averaging, and the mapping of clusters to classes."""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.expressions import argmin, squared_distance
from touchline.operators.cells import packed, unpacked
from touchline.operators.knn import dropped, kept
from touchline.operators.sampling import first_by_hash
from touchline.schema import KEY

Centres = list[list[float]]


@dataclass(frozen=True)
class KMeansFit:
    centres: Centres
    shifts: list[float] = field(default_factory=list)

    @property
    def iterations(self) -> int:
        return len(self.shifts)

    def to_frame(self, spark) -> DataFrame:
        return spark.createDataFrame([(i, c) for i, c in enumerate(self.centres)], "cluster int, centre array<double>")

    def trace(self, spark) -> DataFrame:
        return spark.createDataFrame([(i + 1, s) for i, s in enumerate(self.shifts)], "iteration int, shift double")


def initial_centres(df: DataFrame, features: list[str], k: int, key: str = KEY, seed: int = 42) -> DataFrame:
    """k seeded rows without nulls, numbered in draw order; the draw is a distributed top-k."""
    return first_by_hash(df.dropna(subset=features), k, key, seed).select(key, *features)


def cluster_column(features: list[str], centres: Centres) -> Column:
    """Nearest centre by squared distance; a tie goes to the lowest index, a null feature gives a null cluster."""
    cols = [F.col(c) for c in features]
    nearest = argmin([squared_distance(cols, [F.lit(float(v)) for v in c]) for c in centres])
    return F.when(reduce(lambda a, b: a & b, [c.isNotNull() for c in cols]), nearest)


def assign_clusters(df: DataFrame, features: list[str], centres: Centres, name: str = "cluster") -> DataFrame:
    return df.withColumn(name, cluster_column(features, centres))


def cluster_means(df: DataFrame, features: list[str], centres: Centres) -> DataFrame:
    """Size and mean vector per non-empty cluster.

    Every task assigns its rows batch by batch and emits one partial sum per
    cluster, so the shuffle carries at most k rows per task. The centres travel
    with the task rather than as literals: the generated code stays the same in
    every round and is compiled once.
    """
    # Text expressions: with many features, building columns call by call costs more than a round's work.
    rows = df.selectExpr(*[f"CAST(`{c}` AS DOUBLE) AS `{c}`" for c in features])

    def matrix(b):
        x = np.column_stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(b.num_columns)])
        return x[~np.isnan(x).any(axis=1)]
    return _means(rows, features, centres, matrix)


def _means(rows: DataFrame, features: list[str], centres: Centres, matrix) -> DataFrame:
    """The same; ``matrix`` gives the vectors of a batch."""
    at = np.array(centres, dtype=np.float64)
    names = [f"_s{i}" for i in range(len(features))]

    def combine(batches):
        size, sums = np.zeros(len(at), np.int64), np.zeros(at.shape)
        for b in batches:
            x = matrix(b)
            if len(x):
                nearest = np.stack([((x - c) ** 2).sum(axis=1) for c in at], axis=1).argmin(axis=1)
                for j in np.unique(nearest):
                    mine = x[nearest == j]
                    size[j] += len(mine)
                    sums[j] += mine.sum(axis=0)
        seen = np.flatnonzero(size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.astype(np.int32)), pa.array(size[seen]), *[pa.array(sums[seen, i]) for i in range(len(names))]],
            ["cluster", "n", *names])

    parts = rows.mapInArrow(combine, "cluster int, n bigint, " + ", ".join(f"{s} double" for s in names))
    return parts.groupBy("cluster").agg(F.expr("SUM(n) AS n"), *[
        F.expr(f"SUM({s}) / SUM(n) AS `{c}`") for s, c in zip(names, features, strict=True)])


def _vectors(rows: DataFrame, width: int) -> DataFrame:
    """One binary value per row: a round then moves one column to Python, not one per feature."""
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([packed(np.column_stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(width)]))], ["x"])
    return rows.mapInArrow(run, "x binary")


def _moved(means: DataFrame, features: list[str], centres: Centres) -> Centres:
    new = [list(c) for c in centres]
    for row in means.collect():
        new[row["cluster"]] = [row[c] for c in features]
    return new


def update_centres(df: DataFrame, features: list[str], centres: Centres) -> Centres:
    """One step. An empty cluster keeps its centre. k rows reach the driver."""
    return _moved(cluster_means(df, features, centres), features, centres)


def _update_packed(vectors: DataFrame, features: list[str], centres: Centres) -> Centres:
    """The same over packed rows."""
    return _moved(_means(vectors, features, centres, lambda b: unpacked(b.column(0), len(features))), features, centres)


def fit_kmeans(df: DataFrame, features: list[str], k: int = 3, max_iter: int = 20, tol: float = 1e-4, key: str = KEY,
               seed: int = 42, init: Centres | None = None) -> KMeansFit:
    """Iterate until the largest centre shift is below ``tol``. A round streams the packed rows from a file written once.

    Nothing is cached: with many rows the cache fills an executor's heap, beside the Python workers of every task. Rows with a
    null feature are left out.
    """
    rows = df.dropna(subset=features).select(key, *[F.col(c).cast("double").alias(c) for c in features])
    vectors = kept(_vectors(rows.select(*features), len(features)), "kmeans-rows")
    try:
        centres = init or [[float(r[c]) for c in features] for r in initial_centres(rows, features, k, key, seed).collect()]
        shifts = []
        for _ in range(max_iter):
            new = _update_packed(vectors, features, centres)
            shifts.append(max(math.dist(a, b) for a, b in zip(centres, new, strict=True)))
            centres = new
            if shifts[-1] < tol:
                break
        return KMeansFit(centres, shifts)
    finally:
        dropped(vectors)


def fit_kmeans_ml(df: DataFrame, features: list[str], k: int = 3, max_iter: int = 20, tol: float = 1e-4, seed: int = 42):
    """Spark ML's k-means with random starts, for many clusters or dimensions."""
    vectors = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip").transform(df)
    return KMeans(k=k, maxIter=max_iter, tol=tol, seed=seed, initMode="random").fit(vectors.select("features"))


def cluster_majority(assigned: DataFrame, label: str, cluster: str = "cluster") -> DataFrame:
    """Most frequent label per cluster; a tie goes to the lowest label."""
    counts = assigned.groupBy(cluster, label).agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("_m"), F.col(label).alias("_l"))).alias("_b")
    return counts.groupBy(cluster).agg(best).select(cluster, F.col("_b._l").alias("majority"), (-F.col("_b._m")).alias("n"))


def kmeans_classify(train: DataFrame, test: DataFrame, features: list[str], label: str, centres: Centres,
                    default: int = 0) -> DataFrame:
    """Test rows with ``prediction``: the train majority label of their cluster, or ``default``."""
    mapping = cluster_majority(assign_clusters(train, features, centres), label).select(
        "cluster", F.col("majority").alias("prediction"))
    out = assign_clusters(test, features, centres).join(F.broadcast(mapping), "cluster", "left")  # k rows
    return out.withColumn("prediction", F.coalesce("prediction", F.lit(default)))


def cluster_agreement(assigned: DataFrame, label: str, cluster: str = "cluster") -> DataFrame:
    """Adjusted Rand index and normalised mutual information (arithmetic mean) from the contingency counts."""
    cells = assigned.groupBy(cluster, label).agg(F.count("*").cast("double").alias("n"))
    # The contingency table has (clusters x labels) rows.
    rows = F.sum("n").over(Window.partitionBy(cluster))
    cols = F.sum("n").over(Window.partitionBy(label))
    total = F.sum("n").over(Window.partitionBy())
    cells = cells.withColumns({"a": rows, "b": cols, "t": total})
    n, a, b, t = (F.col(c) for c in ("n", "a", "b", "t"))
    # A margin appears once per cell of its row or column, so each cell adds its share n / margin of the margin's term.
    out = cells.agg(
        F.sum(n * (n - 1) / 2).alias("ij"), F.sum(n / a * (a * (a - 1) / 2)).alias("ai"), F.sum(n / b * (b * (b - 1) / 2)).alias("bj"),
        F.first(t * (t - 1) / 2).alias("all"), F.sum(n / t * F.ln(n * t / (a * b))).alias("mi"),
        (-F.sum(n / a * (a / t) * F.ln(a / t))).alias("ha"), (-F.sum(n / b * (b / t) * F.ln(b / t))).alias("hb"))
    expected = F.col("ai") * F.col("bj") / F.col("all")
    ari = F.try_divide(F.col("ij") - expected, (F.col("ai") + F.col("bj")) / 2 - expected)
    return out.select(F.coalesce(ari, F.lit(1.0)).alias("ari"),
                      F.coalesce(F.try_divide(F.col("mi"), (F.col("ha") + F.col("hb")) / 2), F.lit(1.0)).alias("nmi"))
