"""Fitted tree ensembles of Spark ML, scored in blocks of rows.

A fitted model is stored by its own writer and its nodes are read back as flat arrays, which every task gets. The rows of a block
go down a tree together, a level at a time, so that a row costs a few array steps per level instead of a chain of node objects.
Leaves and the order of the sums are those of the model, and so are its predictions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import OneVsRestModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.schema import KEY
from touchline.session import scratch_path

# Rows that go down a tree together: their features and positions stay in a core's cache.
BLOCK_ROWS = 2048


@dataclass(frozen=True)
class Ensemble:
    """``trees``: (depth, feature, threshold, child, value, column) each. A node has two neighbouring places in the arrays, and
    ``child`` at its first (second) place is the first place of its left (right) child. A leaf leads to itself, and its
    ``value`` is added to the scores' ``column`` (None: all columns)."""

    trees: list[tuple]
    classes: int


def _tree(nodes: dict[str, np.ndarray], value: np.ndarray, column: int | None) -> tuple:
    """Flat arrays from a tree's nodes in order of their ids."""
    left, right = nodes["left"], nodes["right"]
    own, inner = np.arange(len(left)), left >= 0
    child = 2 * np.column_stack([np.where(inner, left, own), np.where(inner, right, own)]).ravel()
    depth, level = 0, [0]
    while level := [c for n in level if inner[n] for c in (left[n], right[n])]:
        depth += 1
    feature = np.repeat(np.where(inner, nodes["feature"], 0), 2)
    return depth, feature, np.repeat(np.where(inner, nodes["threshold"], np.inf), 2), child, np.repeat(value, 2, axis=0), column


def _stored_nodes(model, spark: SparkSession) -> list[dict[str, np.ndarray]]:
    """The nodes of a fitted model, tree by tree, in order of their ids."""
    path = scratch_path(spark, "trees")
    model.write().save(path)
    node, split = F.col("nodeData"), F.col("nodeData.split")
    table = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("id"), node["prediction"].alias("prediction"), node["impurityStats"].alias("stats"),
        node["leftChild"].cast("long").alias("left"), node["rightChild"].cast("long").alias("right"),
        split["featureIndex"].cast("long").alias("feature"), split["numCategories"].alias("kinds"),
        F.coalesce(F.get(split["leftCategoriesOrThreshold"], 0), F.lit(0.0)).alias("threshold")).toArrow()  # a model's nodes
    table = table.sort_by([("tree", "ascending"), ("id", "ascending")])
    cols = {c: table.column(c).to_numpy() for c in ("tree", "prediction", "left", "right", "feature", "kinds", "threshold")}
    if (cols["kinds"] >= 0).any():
        raise ValueError("splits by category are not supported")
    cols["stats"] = table.column("stats").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
    cuts = np.flatnonzero(np.diff(cols["tree"])) + 1
    return [dict(zip(cols, part, strict=True)) for part in zip(*[np.split(v, cuts) for v in cols.values()], strict=True)]


def forest_trees(model, spark: SparkSession) -> Ensemble:
    """A random forest: each tree adds the class shares of the leaf."""
    found = _stored_nodes(model, spark)
    shares = [t["stats"] / np.maximum(t["stats"].sum(1, keepdims=True), np.finfo(float).tiny) for t in found]
    return Ensemble([_tree(t, s, None) for t, s in zip(found, shares, strict=True)], model.numClasses)


def boosted_trees_by_class(model: OneVsRestModel, spark: SparkSession) -> Ensemble:
    """Boosted binary models, one per class: each tree adds its weighted leaf value to its class."""
    trees = []
    for c, binary in enumerate(model.models):
        trees += [_tree(t, t["prediction"] * w, c) for t, w in zip(_stored_nodes(binary, spark), binary.treeWeights, strict=True)]
    return Ensemble(trees, len(model.models))


def _leaf_places(tree: tuple, x: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The leaf that each row reaches; ``x`` has the block's features one after the other."""
    depth, feature, threshold, child, *_ = tree
    at = np.zeros(len(rows), np.int64)
    for _ in range(depth):
        at += x.take(feature.take(at) * len(rows) + rows) > threshold.take(at)
        at = child.take(at)
    return at


def _blocks(batch: pa.RecordBatch):
    """(offset, features one after the other, row numbers) of a batch's blocks."""
    column, n = batch.column("_x"), batch.num_rows
    wide = column.flatten().to_numpy().reshape(n, -1) if n else np.zeros((0, 0))
    for at in range(0, n, BLOCK_ROWS):
        part = wide[at:at + BLOCK_ROWS]
        yield at, np.ascontiguousarray(part.T).ravel(), np.arange(len(part))


def _scored(prepared: DataFrame, *cols) -> DataFrame:
    return prepared.select(*cols, vector_to_array("features").alias("_x"))


def predict_trees(model: Ensemble, prepared: DataFrame, key: str = KEY) -> DataFrame:
    """(key, label, prediction). Of equal scores the lower class wins."""
    rows = _scored(prepared, F.col(key).alias("_id"), F.col("label").cast("int").alias("label"))
    # Plain arrays, so that a task need not have this module.
    shared, classes = prepared.sparkSession.sparkContext.broadcast(model.trees), model.classes

    def run(batches):
        for batch in batches:
            best = np.zeros(batch.num_rows, np.int32)
            for at, x, own in _blocks(batch):
                scores = np.zeros((len(own), classes))
                for tree in shared.value:
                    found = tree[4].take(_leaf_places(tree, x, own), axis=0)
                    if tree[5] is None:
                        scores += found
                    else:
                        scores[:, tree[5]] += found
                best[at:at + len(own)] = scores.argmax(1)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("label"), pa.array(best)], ["_id", "label", "prediction"])
    kind = prepared.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"_id {kind}, label int, prediction int").withColumnRenamed("_id", key)


def boosting_curve(model: Ensemble, prepared: DataFrame, names: dict[int, str], weight: str | None = None) -> DataFrame:
    """(class, round, loss): weighted mean log loss of each class's binary model after each round on the given rows, in one pass.

    A task reports a sum per class and round.
    """
    rows = _scored(prepared, F.col("label").cast("int").alias("label"), (F.col(weight) if weight else F.lit(1.0)).alias("weight"))
    shared = prepared.sparkSession.sparkContext.broadcast(model.trees)

    def run(batches):
        sums, n = np.zeros(len(shared.value)), 0.0
        for batch in batches:
            label, weights = batch.column("label").to_numpy(), batch.column("weight").to_numpy()
            n += weights.sum()
            for at, x, own in _blocks(batch):
                y, w = label[at:at + len(own)], weights[at:at + len(own)]
                margins = {}
                for i, tree in enumerate(shared.value):
                    c = tree[5]
                    margins[c] = margins.get(c, 0.0) + tree[4].take(_leaf_places(tree, x, own))
                    z = margins[c] * np.where(y == c, -2.0, 2.0)
                    sums[i] += 2 * w @ (np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums))), pa.array(sums), pa.array(np.full(len(sums), n))], ["_i", "_sum", "_n"])
    seen, steps = {}, []
    for i, tree in enumerate(model.trees):
        seen[tree[5]] = seen.get(tree[5], 0) + 1
        steps.append((i, names[tree[5]], seen[tree[5]]))
    rounds = prepared.sparkSession.createDataFrame(steps, "_i long, class string, round int")
    losses = rows.mapInArrow(run, "_i long, _sum double, _n double").groupBy("_i").agg((F.sum("_sum") / F.sum("_n")).alias("loss"))
    return losses.join(F.broadcast(rounds), "_i").select("class", "round", "loss")
