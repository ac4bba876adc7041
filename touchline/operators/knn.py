"""Exact k nearest neighbours and votes.

Up to ``max_query_bytes`` of query rows are broadcast to the train partitions, and
train rows are not shuffled: each task reports the k nearest of its rows for each
query, and the lists are merged. More queries, or more than ``max_pairs`` pairs,
meet the train rows cell by cell (``cells``).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.cells import DIGITS, nearest_by_cells
from touchline.operators.sampling import hash_sample
from touchline.schema import KEY
from touchline.session import scratch_path

MAX_QUERY_BYTES = 64 << 20
MAX_PAIRS = 2e10
TASK_BYTES = 128 << 20  # train data per scan task
NEIGHBOUR_SCHEMA = "query_id bigint, train_id bigint, label int, dist double"


class _Nearest:
    """The best k (distance, train id) so far for a set of query vectors."""

    def __init__(self, queries: np.ndarray, k: int, limit: np.ndarray | None = None, step: int = 512):
        self.k, self.parts = k, []
        limit = np.full(len(queries), np.inf) if limit is None else limit
        for lo in range(0, len(queries), step):
            q = queries[lo:lo + step]
            none = (np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64), np.empty(0, np.int32))
            self.parts.append([lo, q, -2.0 * q, np.einsum("ij,ij->i", q, q), limit[lo:lo + step].copy(), none])

    def add(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, step: int = 2048) -> None:
        for lo in range(0, len(x), step):
            self._add(ids[lo:lo + step], labels[lo:lo + step], x[lo:lo + step])

    def _add(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray) -> None:
        k, tq, xt = self.k, np.einsum("ij,ij->i", x, x), np.ascontiguousarray(x.T)
        for part in self.parts:
            _, q, q2, sq, limit, best = part
            # A cheap estimate picks candidates, with slack for its rounding error; they are then measured exactly.
            est = q2 @ xt
            est += tq
            bound = limit ** 2 - sq
            if np.isinf(bound).any() and len(x) > k:
                bound = np.minimum(bound, np.partition(est, k - 1, axis=1)[:, k - 1])
            qi, ti = np.nonzero(est <= (bound + 1e-7 * (1.0 + sq + tq.max()))[:, None])
            if not len(qi):
                continue
            diff = x[ti] - q[qi]
            dist = np.round(np.sqrt(np.einsum("ij,ij->i", diff, diff)), DIGITS)
            qi, d, t, y = (np.concatenate(c) for c in zip(best, (qi, dist, ids[ti], labels[ti]), strict=True))
            order = np.lexsort((t, d, qi))
            qi, d, t, y = qi[order], d[order], t[order], y[order]
            starts = np.r_[0, np.flatnonzero(np.diff(qi)) + 1]
            place = np.arange(len(qi)) - np.repeat(starts, np.diff(np.r_[starts, len(qi)]))
            keep, last = place < k, place == k - 1
            part[5] = (qi[keep], d[keep], t[keep], y[keep])
            limit[qi[last]] = np.minimum(limit[qi[last]], d[last])

    def result(self) -> tuple[np.ndarray, ...]:
        """Query positions, train ids, labels, distances."""
        if not self.parts:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0)
        rows = [(p[5][0] + p[0], p[5][2], p[5][3], p[5][1]) for p in self.parts]
        return tuple(np.concatenate(c) for c in zip(*rows, strict=True))


def _vectors(batch: pa.RecordBatch, first: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """The batch without rows that miss a feature, and its feature matrix."""
    cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(first, batch.num_columns)]
    x = np.ascontiguousarray(np.column_stack(cols), dtype=np.float64)
    whole = ~np.isnan(x).any(axis=1)
    return (batch, x) if whole.all() else (batch.filter(pa.array(whole)), x[whole])


def _side(df: DataFrame, key: str, features: list[str], label: str | None = None) -> DataFrame:
    cols = [F.col(key).cast("bigint").alias("_id")]
    if label:
        cols.append(F.col(label).cast("int").alias("_y"))
    return df.select(*cols, *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(features)])


def _rank(candidates: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("dist", "train_id")
    return candidates.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _by_broadcast(train: DataFrame, queries: pd.DataFrame, k: int, limits: dict | None = None) -> DataFrame:
    ids = queries["_id"].to_numpy()
    matrix = np.ascontiguousarray(queries.iloc[:, 1:].to_numpy(dtype=np.float64))
    limit = None if limits is None else np.array([limits.get(i, np.inf) for i in ids.tolist()])
    shared = train.sparkSession.sparkContext.broadcast((ids, matrix, limit))

    def search(batches):
        qids, q, bound = shared.value
        best = _Nearest(q, k, bound)
        for b in batches:
            b, x = _vectors(b, 2)
            best.add(b.column(0).to_numpy(), b.column(1).to_numpy(), x)
        qi, t, y, d = best.result()
        yield pa.RecordBatch.from_arrays([pa.array(qids[qi]), pa.array(t), pa.array(y.astype(np.int32)), pa.array(d)],
                                         ["query_id", "train_id", "label", "dist"])

    return train.mapInArrow(search, NEIGHBOUR_SCHEMA)


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def kept(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared folder, because more than one job reads it. The shuffle files of the writing job are then deleted."""
    path, conf = scratch_path(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(_FREED, "false")
    conf.set(_FREED, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(_FREED, before)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.kept_at = path
    return table


def dropped(*tables: DataFrame) -> None:
    """Delete tables that ``kept`` wrote and nothing reads any more."""
    for table in tables:
        jvm, conf = table.sparkSession._jvm, table.sparkSession._jsc.hadoopConfiguration()
        where = jvm.org.apache.hadoop.fs.Path(table.kept_at)
        where.getFileSystem(conf).delete(where, True)


def _searched(train: DataFrame, block: pd.DataFrame, k: int, tasks: float, bound_above_tasks: float) -> DataFrame:
    """A block of queries against all train rows, which stay where they are."""
    limits = None
    if tasks > bound_above_tasks:
        # Many tasks would each report k rows per query. A first look at 1/64 of the train rows bounds each
        # query's k-th distance, and tasks then report only rows within it.
        seen = _rank(_by_broadcast(hash_sample(train, 1 / 64, "_id"), block, k), k)
        limits = {r["query_id"]: r["dist"] for r in seen.filter(F.col("rank") == k).select("query_id", "dist").collect()}
    return _rank(_by_broadcast(train, block, k, limits), k)


def knn_neighbours(train: DataFrame, queries: DataFrame, features: list[str], label: str, k: int = 8, key: str = KEY,
                   max_query_bytes: int = MAX_QUERY_BYTES, bound_above_tasks: float = 512, max_pairs: float = MAX_PAIRS,
                   piece_rows: int | None = None, round_bytes: int | None = None) -> DataFrame:
    """(query_id, rank, train_id, label, dist) of each query's k nearest train rows; ties go to the lower train id.

    ``label`` is an integer code. Rows with a null feature are left out on both sides.
    """
    t, q = (kept(side.dropna(), name) for side, name in ((_side(train, key, features, label), "knn-train"), (_side(queries, key, features), "knn-queries")))
    n, n_train = q.count(), t.count()
    if n * (len(features) + 1) * 8 > max_query_bytes or n * n_train > max_pairs:
        sizes = {n: v for n, v in (("piece_rows", piece_rows), ("round_bytes", round_bytes)) if v is not None}
        return _rank(nearest_by_cells(t, q, len(features), k, n_train, kept, dropped, **sizes), k)
    tasks = n_train * (len(features) + 2) * 8 / TASK_BYTES
    cores = t.sparkSession.sparkContext.defaultParallelism
    if tasks < cores:
        t = t.repartition(cores)  # few rows, but each meets every query: use all cores
    return _searched(t, q.toPandas().dropna(), k, tasks, bound_above_tasks)


def knn_others(train: DataFrame, features: list[str], label: str, k: int = 8, key: str = KEY, **options) -> DataFrame:
    """The k nearest other rows of each train row, and the row itself at rank 0 and distance 0."""
    near = knn_neighbours(train, train, features, label, k + 1, key, **options)
    itself = _side(train, key, features, label).dropna().select(
        F.col("_id").alias("query_id"), F.lit(0).alias("rank"), F.col("_id").alias("train_id"), F.col("_y").alias("label"), F.lit(0.0).alias("dist"))
    others = _rank(near.filter("query_id <> train_id").drop("rank"), k)
    return others.select("query_id", "rank", "train_id", "label", "dist").union(itself)


def knn_vote(neighbours: DataFrame, weights: str = "uniform") -> DataFrame:
    """One prediction per query.

    'uniform': most votes; a tie goes to the label whose nearest voter is closest.
    'distance': largest sum of 1 / distance; neighbours at distance 0 take all the
    weight; a tie goes to the lowest label.
    """
    if weights == "uniform":
        votes = neighbours.groupBy("query_id", "label").agg(F.count("*").alias("v"), F.min("rank").alias("first"))
        best = F.max(F.struct("v", (-F.col("first")).alias("f"), "label"))
    else:
        exact = F.count_if(F.col("dist") == 0) > 0
        votes = neighbours.groupBy("query_id", "label").agg(
            F.count_if(F.col("dist") == 0).alias("zero"), F.sum(F.try_divide(F.lit(1.0), F.col("dist"))).alias("inv"),
            exact.alias("exact"))
        # Zero-distance votes rank above any finite weight.
        best = F.max(F.struct("zero", F.when(~F.col("exact"), F.col("inv")).alias("inv"), (-F.col("label")).alias("l"), "label"))
    return votes.groupBy("query_id").agg(best.alias("_b")).select("query_id", F.col("_b.label").alias("prediction"))


def knn_predict(train: DataFrame, queries: DataFrame, features: list[str], label: str, k: int = 8, key: str = KEY,
                weights: str = "uniform", **options) -> DataFrame:
    return knn_vote(knn_neighbours(train, queries, features, label, k, key, **options), weights)
