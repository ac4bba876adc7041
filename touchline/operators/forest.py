"""Impurity importances of a random forest whose trees grow as deep as their rows go.

Features are cut into bins once. A tree's bootstrap weight of a row and a node's choice of features are hashes, so a tree is the
same wherever its nodes are worked on. Nodes with more than ``task_rows`` rows are split by histograms that all tasks add up, one
pass over the rows a level. The rows of a smaller node are shipped to one task, which grows the whole subtree below it; as long as
the whole table is that small, a task gets it once for several trees. Only gains per tree and feature come back.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators.features import encode_target
from touchline.schema import KEY, LABELS, TARGET
from touchline.session import scratch_path

TREES, DEPTH, BINS, SEED = 200, 30, 32, 42
TASK_ROWS = 1_000_000
TREES_PER_TASK = 4
SHIPPED_ROWS = 200_000
# Nodes with fewer rows than one for this many bins are split by sorting.
COUNTED_CELLS = 1
# Nodes that one round of histograms may open; more are left for the next round.
NODES_PER_ROUND = 10_000
_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 12)]))


def scrambled(x: np.ndarray, *salts: int) -> np.ndarray:
    """64-bit hashes of numbers."""
    with np.errstate(over="ignore"):
        x = np.asarray(x).astype(np.uint64)
        for salt in salts:
            x = x ^ np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2 ** 64)
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
            x = x ^ (x >> np.uint64(31))
    return x


def bootstrap(ids: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is drawn for a tree: Poisson with mean 1."""
    return np.searchsorted(_POISSON, scrambled(ids, seed, tree) / 2.0 ** 64, "right")


def chosen_features(nodes: np.ndarray, n_features: int, tree: int, seed: int) -> np.ndarray:
    """The features that each node may split on, about the root of their number."""
    count = int(np.ceil(np.sqrt(n_features)))
    mixed = scrambled(nodes[:, None].astype(np.uint64) * np.uint64(n_features) + np.arange(n_features, dtype=np.uint64), seed + 1, tree)
    return np.sort(np.argpartition(mixed, count - 1, axis=1)[:, :count], axis=1)


def _impurity(counts: np.ndarray) -> np.ndarray:
    """Gini impurity times the number of rows; classes along the last axis."""
    n, squares = counts[..., 0].copy(), counts[..., 0] ** 2
    for c in range(1, counts.shape[-1]):  # few classes: column by column is faster than a sum along a short axis
        n += counts[..., c]
        squares += counts[..., c] ** 2
    return n - squares / np.maximum(n, 1)


def _counted_splits(node: np.ndarray, bins: np.ndarray, label: np.ndarray, weight: np.ndarray, n_nodes: int, choices: np.ndarray, classes: int,
                    most: int):
    """The same as ``best_splits`` from a grid of counts by node, bin and class: no sort, for nodes of many rows."""
    gain, feature, last = np.zeros(n_nodes), np.full(n_nodes, -1), np.full(n_nodes, -1)
    names, rows, base = np.arange(n_nodes), np.arange(len(node)) * bins.shape[1], node * (most * classes) + label
    total = np.bincount(node * classes + label, weight, n_nodes * classes).reshape(n_nodes, classes)
    whole, flat = _impurity(total), np.ascontiguousarray(bins).ravel()
    for slot in range(choices.shape[1]):
        value = flat[rows + choices[:, slot][node]]
        left = np.bincount(base + value * np.int64(classes), weight, n_nodes * most * classes).reshape(n_nodes, most, classes)
        np.cumsum(left, axis=1, out=left)
        right = total[:, None] - left
        here = whole[:, None] - _impurity(left) - _impurity(right)
        here[left.sum(2) >= total.sum(1)[:, None]] = 0
        first = here.argmax(1)  # empty bins repeat the gain of the bin before
        top = here[names, first]
        better = top > gain + 1e-9 * np.maximum(whole, 1)
        gain[better], feature[better], last[better] = top[better], choices[better, slot], first[better]
    return gain, feature, last


def best_splits(node: np.ndarray, bins: np.ndarray, label: np.ndarray, weight: np.ndarray, n_nodes: int, choices: np.ndarray, classes: int):
    """For each node its gain, feature and the last bin that goes left; a gain of 0 means no split.

    ``node`` counts from 0, ``bins`` is rows x features. Of equal gains the first feature and bin win.
    """
    most = int(bins.max(initial=0)) + 1
    if n_nodes * most <= COUNTED_CELLS * len(node):
        return _counted_splits(node, bins, label, weight, n_nodes, choices, classes, most)
    gain, feature, last = np.zeros(n_nodes), np.full(n_nodes, -1), np.full(n_nodes, -1)
    total = np.stack([np.bincount(node, weight * (label == c), n_nodes) for c in range(classes)], 1)
    whole = _impurity(total)
    rows = np.arange(len(node))
    bits = max(1, int(len(node)).bit_length())
    for slot in range(choices.shape[1]):
        bin_of = bins[rows, choices[node, slot]].astype(np.int64)
        packed = ((node.astype(np.int64) * 256 + bin_of) << bits) | rows
        packed.sort()
        order = packed & ((1 << bits) - 1)
        cell = packed >> bits  # node and bin
        new = cell[1:] != cell[:-1]
        ends = np.flatnonzero(np.append(new, True))
        own = cell[ends] // 256
        place = np.concatenate([[0], np.cumsum(new)]) * classes + label[order]
        left = np.bincount(place, weight[order], len(ends) * classes).reshape(-1, classes).cumsum(0)
        start = np.searchsorted(own, np.arange(n_nodes))  # every node has rows
        before = np.concatenate([np.zeros((1, classes)), left])[start]
        left = left - before[own]
        here = whole[own] - _impurity(left) - _impurity(total[own] - left)
        here[(total[own] - left).sum(1) <= 0] = 0  # nothing on the right
        top = np.maximum.reduceat(here, start)
        first = np.minimum.reduceat(np.where(here == top[own], np.arange(len(own)), len(own)), start)
        better = top > gain + 1e-9 * np.maximum(whole, 1)
        gain[better], feature[better], last[better] = top[better], choices[better, slot], (cell[ends] % 256)[first[better]]
    return gain, feature, last


def grow(ids, bins, label, tree: int, node_id: int, depth: int, classes: int, seed: int) -> np.ndarray:
    """Gains per feature of the subtree below a node, over the rows that are drawn for the tree."""
    return grow_drawn(bootstrap(ids, tree, seed), bins, label, tree, node_id, depth, classes, seed)


def grow_drawn(weight, bins, label, tree: int, node_id: int, depth: int, classes: int, seed: int) -> np.ndarray:
    """The same, with each row drawn ``weight`` times."""
    kept = np.flatnonzero(weight > 0)
    weight, bins, label = weight[kept].astype(np.float64), bins[kept], label[kept]
    gains = np.zeros(bins.shape[1])
    names, at = np.array([node_id], np.int64), np.zeros(len(kept), np.int64)
    for _ in range(depth):
        if not len(at):
            break
        gain, feature, last = best_splits(at, bins, label, weight, len(names), chosen_features(names, bins.shape[1], tree, seed), classes)
        np.add.at(gains, feature[gain > 0], gain[gain > 0])
        side = 2 * at + (bins[np.arange(len(at)), feature[at]] > last[at])
        # Nodes without a split end here, and so do pure ones: one class only.
        seen = np.bincount(side * classes + label, minlength=2 * len(names) * classes).reshape(-1, classes) > 0
        mixed = (seen.sum(1) > 1) & np.repeat(gain > 0, 2)
        stay = np.flatnonzero(mixed[side])
        at, weight, bins, label = (np.cumsum(mixed) - 1)[side[stay]], weight[stay], bins[stay], label[stay]
        names = np.stack([2 * names, 2 * names + 1], 1).ravel()[mixed]
    return gains


def descend(bins: np.ndarray, splits: dict[int, tuple[int, int]]) -> np.ndarray:
    """The node of each row after the given splits."""
    node, rows = np.ones(len(bins), np.int64), np.arange(len(bins))
    if not splits:
        return node
    names = np.array(sorted(splits))
    feature, last = np.array([splits[n] for n in names.tolist()]).T
    while True:
        at = np.minimum(np.searchsorted(names, node[rows]), len(names) - 1)
        inner = names[at] == node[rows]
        rows, at = rows[inner], at[inner]
        if not len(rows):
            return node
        node[rows] = 2 * node[rows] + (bins[rows, feature[at]] > last[at])


# --- tables ----------------------------------------------------------------------------------

def binned(df: DataFrame, features: list[str], label: str = TARGET, labels=LABELS, key: str = KEY, bins: int = BINS) -> DataFrame:
    """(id, label, bins): a hash of the key, the class number and one byte per feature. Rows with a null are left out."""
    rows = df.select(F.xxhash64(key).alias("id"), encode_target(label, labels).alias("label"),
                     *[F.col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)]).dropna()
    marks = [i / bins for i in range(1, bins)]
    names = [f"f{i}" for i in range(len(features))]
    cuts = rows.agg(*[F.percentile_approx(c, marks, 10_000).alias(c) for c in names]).first()
    edges = [np.unique(np.array(cuts[c] or [], float)) for c in names]

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            out = np.zeros((n, len(names)), np.uint8)
            for j, c in enumerate(names):  # values up to an edge lie left of it
                out[:, j] = np.searchsorted(edges[j], batch.column(c).to_numpy(zero_copy_only=False), "left")
            blob = pa.FixedSizeBinaryArray.from_buffers(pa.binary(len(names)), n, [None, pa.py_buffer(out.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), blob], ["id", "label", "bins"])
    return rows.mapInArrow(run, "id long, label int, bins binary")


def _arrays(batch, width: int):
    raw = b"".join(batch.column("bins").to_pylist())
    return (batch.column("id").to_numpy().view(np.uint64), np.frombuffer(raw, np.uint8).reshape(-1, width),
            batch.column("label").to_numpy().astype(np.int64))


def _histograms(rows: DataFrame, width: int, classes: int, bins_most: int, seed: int, splits: dict, open_nodes: dict) -> DataFrame:
    """(tree, node, feature, bin, n0, n1, ...) over the rows of the open nodes."""
    names = ["tree", "node", "feature", "bin", *[f"n{c}" for c in range(classes)]]

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            ids, bins, label = _arrays(batch, width)
            for tree, nodes in open_nodes.items():
                weight, node = bootstrap(ids, tree, seed), descend(bins, splits[tree])
                at = np.searchsorted(nodes, node)
                own = np.flatnonzero((weight > 0) & (nodes[np.minimum(at, len(nodes) - 1)] == node))
                choices = chosen_features(nodes, width, tree, seed)
                size = len(nodes) * choices.shape[1] * bins_most * classes
                hist = total.setdefault(tree, np.zeros(size))
                for slot in range(choices.shape[1]):
                    value = bins[own, choices[at[own], slot]].astype(np.int64)
                    cell = ((at[own] * choices.shape[1] + slot) * bins_most + value) * classes + label[own]
                    hist += np.bincount(cell, weight[own], size)
        for tree, hist in total.items():
            nodes = open_nodes[tree]
            choices = chosen_features(nodes, width, tree, seed)
            hist = hist.reshape(-1, classes)
            used = np.flatnonzero(hist.sum(1))
            n, slot, value = used // (bins_most * choices.shape[1]), used // bins_most % choices.shape[1], used % bins_most
            columns = [np.full(len(used), tree), nodes[n], choices[n, slot], value, *hist[used].astype(np.int64).T]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names)
    found = rows.mapInArrow(run, ", ".join(f"{n} long" for n in names))
    return found.groupBy("tree", "node", "feature", "bin").agg(*[F.sum(n).alias(n) for n in names[4:]])


def _split_of(classes: int):
    """The best split of one node from its histograms, and the rows by class on both sides."""
    def run(table: pa.Table) -> pa.Table:
        rows = table.sort_by([("feature", "ascending"), ("bin", "ascending")])
        feature, value = rows.column("feature").to_numpy(), rows.column("bin").to_numpy()
        counts = np.stack([rows.column(f"n{c}").to_numpy() for c in range(classes)], 1).astype(float)
        best = (0.0, -1, -1, None, None)
        total = counts[feature == feature[0]].sum(0)
        whole = _impurity(total)
        for f in np.unique(feature):
            own = feature == f
            left = np.cumsum(counts[own], axis=0)
            here = whole - _impurity(left) - _impurity(total - left)
            here[(total - left).sum(1) <= 0] = 0
            i = int(np.argmax(here))
            if here[i] > best[0] + 1e-9 * max(whole, 1):
                best = (float(here[i]), int(f), int(value[own][i]), left[i], total - left[i])
        sides = [total, total * 0] if best[3] is None else best[3:]
        size, mixed = [int(s.sum()) for s in sides], [int((s > 0).sum() > 1) for s in sides]
        line = [int(rows.column("tree")[0].as_py()), int(rows.column("node")[0].as_py()), best[0], best[1], best[2], *size, *mixed]
        return pa.table({n: [v] for n, v in zip(_SPLIT, line, strict=True)})
    return run


_SPLIT = ["tree", "node", "gain", "feature", "last", "n_left", "n_right", "mixed_left", "mixed_right"]
_SPLIT_DDL = "tree long, node long, gain double, feature long, last long, n_left long, n_right long, mixed_left long, mixed_right long"


def _upper_levels(rows: DataFrame, trees: list[int], width: int, classes: int, bins_most: int, n_rows: int, depth: int, seed: int,
                  task_rows: int):
    """Splits of the nodes too large for a task, gains of these splits, and the nodes left to be grown, each by tree."""
    splits, gains = {t: {} for t in trees}, {t: np.zeros(width) for t in trees}
    left: dict[int, list[int]] = {t: [] for t in trees}
    waiting = [(t, 1) for t in trees] if n_rows > task_rows and depth > 0 else []
    if not waiting:
        return splits, gains, {t: [1] for t in trees}
    while waiting:
        now, waiting = waiting[:NODES_PER_ROUND], waiting[NODES_PER_ROUND:]
        open_nodes = {t: np.array(sorted(n for u, n in now if u == t)) for t in {u for u, _ in now}}
        found = (_histograms(rows, width, classes, bins_most, seed, splits, open_nodes)
                 .groupBy("tree", "node").applyInArrow(_split_of(classes), _SPLIT_DDL))
        for r in found.collect():  # one row per open node
            if r.gain <= 0:
                continue
            splits[r.tree][r.node] = (r.feature, r["last"])
            gains[r.tree][r.feature] += r.gain
            for child, n, mixed in ((2 * r.node, r.n_left, r.mixed_left), (2 * r.node + 1, r.n_right, r.mixed_right)):
                if mixed and child.bit_length() <= depth:
                    (waiting.append((r.tree, child)) if n > task_rows else left[r.tree].append(child))
    return splits, gains, left


def _shipped(rows: DataFrame, groups: list[list[int]], width: int, seed: int, splits: dict, left: dict) -> DataFrame:
    """(group, node, drawn, bins, label): the rows of every node that a task is to grow, packed by ``SHIPPED_ROWS`` source rows.

    ``drawn`` has the ids if the node is the whole table, for all trees of the group; else how often each row is drawn, in a byte.
    """
    names = ["group", "node", "drawn", "bins", "label"]

    def lines(held):
        ids, bins, label = (np.concatenate(c) for c in zip(*held, strict=True))
        label = label.astype(np.uint8)
        for g, trees in enumerate(groups):
            if left[trees[0]] == [1]:
                parts = [(1, ids.tobytes(), np.arange(len(ids)))]
            else:
                drawn = bootstrap(ids, trees[0], seed).astype(np.uint8)
                own = np.flatnonzero(drawn)
                node = descend(bins[own], splits[trees[0]])
                order = np.argsort(node, kind="stable")
                names_of, starts = np.unique(node[order], return_index=True)
                wanted = set(left[trees[0]])
                parts = [(n, drawn[own[p]].tobytes(), own[p]) for n, p in zip(names_of.tolist(), np.split(order, starts[1:]), strict=True) if n in wanted]
            for some in (parts[i:i + 64] for i in range(0, len(parts), 64)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g] * len(some), pa.int32()), pa.array([n for n, _, _ in some], pa.int64()), pa.array([d for _, d, _ in some], pa.binary()),
                     pa.array([bins[p].tobytes() for _, _, p in some], pa.binary()), pa.array([label[p].tobytes() for _, _, p in some], pa.binary())], names)

    def run(batches):
        held, n = [], 0
        for batch in batches:
            held.append(_arrays(batch, width))
            n += batch.num_rows
            if n >= SHIPPED_ROWS:
                yield from lines(held)
                held, n = [], 0
        if n:
            yield from lines(held)
    return rows.mapInArrow(run, "group int, node long, drawn binary, bins binary, label binary")


def _grow_groups(groups, width: int, classes: int, depth: int, seed: int):
    def run(table: pa.Table) -> pa.Table:
        trees, node = groups[table.column("group")[0].as_py()], table.column("node")[0].as_py()
        drawn, bins, label = (np.concatenate([np.frombuffer(b, k) for b in table.column(c).to_pylist()])
                              for c, k in (("drawn", np.uint64 if node == 1 else np.uint8), ("bins", np.uint8), ("label", np.uint8)))
        out = [(t, grow_drawn(bootstrap(drawn, t, seed) if node == 1 else drawn, bins.reshape(-1, width), label.astype(np.int64), t, node,
                        depth - (node.bit_length() - 1), classes, seed)) for t in trees]
        return pa.table({"tree": np.repeat([t for t, _ in out], width), "feature": np.tile(np.arange(width), len(out)),
                         "gain": np.concatenate([g for _, g in out])})
    return run


def forest_importance(df: DataFrame, features: list[str], label: str = TARGET, labels=LABELS, key: str = KEY, trees: int = TREES,
                      depth: int = DEPTH, bins: int = BINS, seed: int = SEED, task_rows: int = TASK_ROWS) -> DataFrame:
    """(feature, importance): mean over the trees of each feature's share of the impurity that the tree takes away.

    Fitted on every row without nulls; Gini impurity, as many rows as the table has drawn for each tree, the root of the
    number of features tried at each node. An empty table, or one class only, gives importances of 0.
    """
    if not 2 <= bins <= 256:
        raise ValueError("bins must fit a byte")
    spark, width, classes = df.sparkSession, len(features), len(labels)
    path = scratch_path(spark, "binned")
    binned(df, features, label, labels, key, bins).write.parquet(path)
    rows = spark.read.parquet(path)
    n_rows = rows.count()
    all_trees = list(range(trees))
    splits, gains, left = _upper_levels(rows, all_trees, width, classes, bins, n_rows, depth, seed, task_rows)
    whole = n_rows <= task_rows
    groups = [all_trees[i:i + TREES_PER_TASK] for i in range(0, trees, TREES_PER_TASK)] if whole else [[t] for t in all_trees]
    shipped = _shipped(rows, groups, width, seed, splits, left).repartition(min(4096, max(len(groups), 1)), "group", "node")
    grown = shipped.groupBy("group", "node").applyInArrow(_grow_groups(groups, width, classes, depth, seed), "tree long, feature long, gain double")
    upper = [(t, f, float(g[f])) for t, g in gains.items() for f in range(width)]
    every = grown.union(spark.createDataFrame(upper, "tree long, feature long, gain double")).groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))
    totals = every.groupBy("tree").agg(F.sum("gain").alias("total")).withColumnRenamed("tree", "_t")  # a row per tree
    share = F.coalesce(F.try_divide("gain", "total"), F.lit(0.0))
    mean = every.join(F.broadcast(totals), F.col("tree") == F.col("_t")).groupBy("feature").agg((F.sum(share) / trees).alias("importance"))
    names = F.element_at(F.array(*[F.lit(f) for f in features]), (F.col("feature") + 1).cast("int"))
    result = mean.select(names.alias("feature"), "importance").collect()  # a row per feature
    return spark.createDataFrame([tuple(r) for r in result], "feature string, importance double")


