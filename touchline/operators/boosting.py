"""Boosted trees with one softmax loss over all classes.

Each round adds one small tree per class, grown level by level. Fit rows are kept as packed blocks with their class scores. For
each level gradients and second derivatives are summed by class, node, feature and bin; these grids give the best split of every
node. One block is worked on by one task from the first round to the last. With more blocks each task sums its own and the few
grids are added up, a small job per level over kept blocks. After a round its trees are added to the kept scores; every
``REFRESH`` rounds the scores are taken from all trees anew, so that a lost block does not lead back through all rounds.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators.forest import scrambled
from touchline.schema import KEY
from touchline.session import scratch_path

BINS, REFRESH, BLOCK_ROWS, MAX_TASKS = 32, 100, 20_000, 64


@dataclass
class Tree:
    """Splits and leaf values by node; node 1 is the root, 2n and 2n + 1 lie below n."""

    splits: dict[int, tuple[int, int]] = field(default_factory=dict)  # feature, last bin that goes left
    values: dict[int, float] = field(default_factory=dict)

    def _tables(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        feature, last = np.full(2 << depth, -1), np.zeros(2 << depth, np.int64)
        for n, (f, b) in self.splits.items():
            feature[n], last[n] = f, b
        return feature, last

    def step(self, node: np.ndarray, columns: np.ndarray, depth: int) -> np.ndarray:
        """One level down, from nodes that have a split; ``columns`` is features x rows."""
        feature, last = self._tables(depth)
        f = feature[node]
        value = columns.ravel().take(np.maximum(f, 0) * columns.shape[1] + np.arange(len(node)))
        return np.where(f >= 0, 2 * node + (value > last[node]), node)

    def nodes(self, bins: np.ndarray, depth: int) -> np.ndarray:
        feature, last = self._tables(depth)
        node, rows = np.ones(len(bins), np.int64), np.arange(len(bins))
        for _ in range(depth):
            f = feature[node]
            node = np.where(f >= 0, 2 * node + (bins[rows, f] > last[node]), node)
        return node

    def scores(self, bins: np.ndarray, depth: int) -> np.ndarray:
        table = np.zeros(2 << depth)
        table[list(self.values)] = list(self.values.values())
        return table[self.nodes(bins, depth)]


@dataclass
class Boosted:
    features: list[str]
    edges: list[np.ndarray]
    classes: int
    depth: int
    rounds: list[list[Tree]] = field(default_factory=list)

    def binned(self, columns: list[np.ndarray]) -> np.ndarray:
        """Values up to an edge lie left of it."""
        return np.stack([np.searchsorted(e, x, "left") for e, x in zip(self.edges, columns, strict=True)], 1).astype(np.uint8)

    def add_scores(self, scores: np.ndarray, bins: np.ndarray, first: int, last: int | None = None) -> np.ndarray:
        out = scores.copy()
        for trees in self.rounds[first:last]:
            for c, tree in enumerate(trees):
                out[:, c] += tree.scores(bins, self.depth)
        return out


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def drawn_features(n: int, share: float, round_no: int, class_no: int, seed: int) -> np.ndarray:
    order = np.argsort(scrambled(np.arange(n), seed + 1, round_no, class_no))
    return np.sort(order[:max(1, round(n * share))])


def split_gains(sums: np.ndarray, ridge: float, least: float) -> np.ndarray:
    """Gain of a cut after each bin, from (features x bins x 2) sums of one node; 0 where a side is too light."""
    g, h = sums[..., 0].cumsum(1), sums[..., 1].cumsum(1)
    total_g, total_h = g[0, -1], h[0, -1]
    right_g, right_h = total_g - g, total_h - h
    gain = g * g / (h + ridge) + right_g * right_g / (right_h + ridge) - total_g * total_g / (total_h + ridge)
    return np.where((h < least) | (right_h < least), 0.0, gain)


# --- fit rows --------------------------------------------------------------------------------

def _columns(rows: DataFrame, features: list[str], label: str, weight: str | None, key: str) -> DataFrame:
    return rows.select(F.xxhash64(key).alias("_id"), F.col(label).cast("int").alias("_y"),
                       (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("_w"),
                       *[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)]).dropna()


def feature_edges(columns: DataFrame, width: int, bins: int = BINS) -> list[np.ndarray]:
    """Quantiles as upper ends of the bins; of a feature with few values, these values."""
    marks = [i / bins for i in range(1, bins)]
    names = [f"_x{i}" for i in range(width)]
    found = columns.agg(*[F.percentile_approx(c, marks, 10_000).alias(c) for c in names], *[F.max(c).alias(f"m{c}") for c in names]).first()
    return [np.setdiff1d(np.array(found[c] or [], float), [found[f"m{c}"]]) for c in names]


_PACKED = "ids binary, label binary, weight binary, bins binary, scores binary"


def _pack(columns: DataFrame, model: Boosted, block_rows: int) -> DataFrame:
    """Blocks of up to ``block_rows`` rows of a task."""
    width = len(model.features)

    def packed(held: list[pa.RecordBatch]):
        table = pa.Table.from_batches(held).combine_chunks()
        bins = model.binned([table.column(f"_x{i}").to_numpy() for i in range(width)])
        line = [table.column("_id").to_numpy(), table.column("_y").to_numpy().astype(np.uint8), table.column("_w").to_numpy(), bins,
                np.zeros((len(bins), model.classes))]
        return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in line],
                                          ["ids", "label", "weight", "bins", "scores"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                part, batch = batch.slice(0, block_rows - n), batch.slice(block_rows - n)
                held.append(part)
                n += part.num_rows
                if n == block_rows:
                    yield packed(held)
                    held, n = [], 0
        if held:
            yield packed(held)
    return columns.mapInArrow(run, _PACKED)


def _unpacked(batch, model: Boosted):
    lines = zip(*[batch.column(c).to_pylist() for c in ("ids", "label", "weight", "bins", "scores")], strict=True)
    yield from _arrays(lines, model)


def _arrays(lines, model: Boosted):
    for ids, label, weight, bins, scores in lines:
        yield (np.frombuffer(ids, np.uint64), np.frombuffer(label, np.uint8).astype(np.int64), np.frombuffer(weight),
               np.frombuffer(bins, np.uint8).reshape(-1, len(model.features)), np.frombuffer(scores).reshape(-1, model.classes))


def _stored(packed: DataFrame, tasks: int) -> DataFrame:
    path = scratch_path(packed.sparkSession, "boosting")
    packed.coalesce(tasks).write.parquet(path)
    return packed.sparkSession.read.schema(packed.schema).parquet(path).coalesce(tasks)


class Part:
    """A block's rows that a round sees, their gradients and second derivatives, and their nodes in the trees that grow."""

    def __init__(self, model: Boosted, block, scores: np.ndarray, round_no: int, share: float, seed: int):
        ids, label, weight, bins = block
        seen = scrambled(ids, seed, round_no) / 2.0 ** 64 < share
        p, label, w = softmax(scores[seen]), label[seen], weight[seen]
        self.model, self.columns = model, np.ascontiguousarray(bins[seen].T)
        self.values = [(w * (p[:, c] - (label == c)), w * 2 * p[:, c] * (1 - p[:, c])) for c in range(model.classes)]
        self.node = [np.ones(len(w), np.int64)] * model.classes

    def sums(self, trees: list[Tree], open_nodes: list[list[int]]) -> np.ndarray:
        """(class, open node, feature, bin, 2): sums of gradients and second derivatives."""
        width, most = len(self.columns), max(1, *map(len, open_nodes))
        total = np.zeros((len(trees), most, width, BINS, 2))
        for c, tree in enumerate(trees):
            names, size = np.array(open_nodes[c] or [0]), max(1, len(open_nodes[c])) * BINS
            self.node[c] = tree.step(self.node[c], self.columns, self.model.depth)
            at = np.minimum(np.searchsorted(names, self.node[c]), len(names) - 1)
            own = np.flatnonzero(names[at] == self.node[c])
            columns, values, at = (self.columns, self.values[c], at) if len(own) == len(at) else (
                self.columns[:, own], [v[own] for v in self.values[c]], at[own])
            at = at * BINS
            for f in range(width):
                cell = at + columns[f]
                for j, value in enumerate(values):
                    total[c, :len(names), f, :, j] = np.bincount(cell, value, size).reshape(-1, BINS)
        return total


def gradient_sums(blocks: RDD, model: Boosted, trees: list[Tree], open_nodes: list[list[int]], round_no: int = 0, share: float = 1.0,
                  seed: int = 42) -> np.ndarray:
    """The same over all blocks, whose scores are those of all rounds before."""
    shape = (model.classes, max(1, *map(len, open_nodes)), len(model.features), BINS, 2)
    blank = Boosted(model.features, [], model.classes, model.depth)

    def run(lines):
        total = np.zeros(shape)
        for *block, scores in _arrays(lines, blank):
            part = Part(blank, block, scores, round_no, share, seed)
            part.node = [tree.nodes(part.columns.T, blank.depth) for tree in trees]
            total += part.sums(trees, open_nodes)
        yield total.tobytes()
    grids = blocks.mapPartitions(run).collect()  # one grid per task, at most MAX_TASKS
    return sum((np.frombuffer(g).reshape(shape) for g in grids), np.zeros(shape))


def _blocks(packed: DataFrame) -> RDD:
    return packed.rdd.map(lambda r: tuple(map(bytes, r)))


def _with_rounds(blocks: RDD, model: Boosted, since: int) -> RDD:
    """The blocks with the rounds from ``since`` on added to their scores."""
    recent = Boosted(model.features, [], model.classes, model.depth, model.rounds[since:])

    def add(line):
        (*_, bins, scores), = _arrays([line], recent)
        return (*line[:4], recent.add_scores(scores, bins, 0).tobytes())
    return blocks.map(add)


@dataclass(frozen=True)
class Settings:
    rounds: int
    rate: float
    share: float
    columns: float
    ridge: float
    least: float
    seed: int


def grow_round(model: Boosted, round_no: int, how: Settings, sums_of) -> list[Tree]:
    """One tree per class, level by level; ``sums_of(trees, open_nodes)`` gives the gradient sums."""
    trees = [Tree() for _ in range(model.classes)]
    chosen = [drawn_features(len(model.features), how.columns, round_no, c, how.seed) for c in range(model.classes)]
    open_nodes: list[list[int]] = [[1] for _ in trees]
    for level in range(model.depth):
        if not any(open_nodes):
            break
        sums = sums_of(trees, open_nodes)
        for c, tree in enumerate(trees):
            below = []
            for i, node in enumerate(open_nodes[c]):
                own = sums[c, i][chosen[c]]
                gains = split_gains(own, how.ridge, how.least)
                f, b = divmod(int(np.argmax(gains)), BINS)
                sides = {node: own[0].sum(0)}
                if gains[f, b] > 1e-12:
                    left = own[f, :b + 1].sum(0)
                    tree.splits[node] = (int(chosen[c][f]), b)
                    tree.values.pop(node, None)
                    sides = {2 * node: left, 2 * node + 1: sides[node] - left}
                    below += sides if level + 1 < model.depth else []
                tree.values |= {n: float(-how.rate * g / (h + how.ridge)) for n, (g, h) in sides.items()}
            open_nodes[c] = sorted(below)
    return trees


def _fit_block(packed: DataFrame, model: Boosted, how: Settings) -> list[list[Tree]]:
    """All rounds over one block, in one task: no sums have to meet."""
    def run(batches):
        own = Boosted(model.features, model.edges, model.classes, model.depth)
        for batch in batches:
            for *block, scores in _unpacked(batch, own):
                for r in range(how.rounds):
                    own.rounds.append(grow_round(own, r, how, Part(own, block, scores, r, how.share, how.seed).sums))
                    scores = own.add_scores(scores, block[3], r)
                plain = [[(t.splits, t.values) for t in trees] for trees in own.rounds]
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(plain)])], ["rounds"])
    found = packed.mapInArrow(run, "rounds binary").collect()  # the trees of one model
    plain = pickle.loads(found[0][0]) if found else [[({}, {})] * model.classes] * how.rounds
    return [[Tree(*t) for t in trees] for trees in plain]


def _fit_blocks(packed: DataFrame, model: Boosted, how: Settings) -> list[list[Tree]]:
    """Each level's sums are taken by all tasks over their blocks and added up. ``packed`` is read again every ``REFRESH`` rounds."""
    first = _blocks(packed)
    held, before = first.persist(StorageLevel.MEMORY_AND_DISK), None
    try:
        for r in range(how.rounds):
            model.rounds.append(grow_round(model, r, how, lambda t, n, r=r, b=held: gradient_sums(b, model, t, n, r, how.share, how.seed)))
            if before is not None:
                before.unpersist()
            anew = (r + 1) % REFRESH == 0
            before, held = held, _with_rounds(*((_blocks(packed), model, 0) if anew else (held, model, r))).persist(StorageLevel.MEMORY_AND_DISK)
    finally:
        held.unpersist()
        if before is not None:
            before.unpersist()
    return model.rounds


def fit_boosted(rows: DataFrame, features: list[str], classes: int = 3, label: str = "label", weight: str | None = None, rounds: int = 300,
                depth: int = 5, rate: float = 0.05, share: float = 0.8, columns: float = 0.8, ridge: float = 1.0, least: float = 1.0,
                seed: int = 42, key: str = KEY, block_rows: int = BLOCK_ROWS) -> Boosted:
    """Trees for the summed softmax loss. Each round sees a share of the rows and each tree a share of the features, by hash.

    ``least`` bounds the sum of second derivatives on either side of a split, ``ridge`` shrinks leaf values. Labels are
    0 .. classes - 1. Rows with a null are left out. Up to ``block_rows`` rows make one block, on which one task runs all
    rounds; more rows make more blocks, and the sums of all tasks are added up for each level.
    """
    cols = _columns(rows, features, label, weight, key)
    model, how = Boosted(list(features), feature_edges(cols, len(features)), classes, depth), Settings(rounds, rate, share, columns, ridge, least, seed)
    if cols.limit(block_rows + 1).count() <= block_rows:
        # A shuffle, not coalesce: that would pull the scan and filters above into the one task.
        model.rounds = _fit_block(_pack(cols.repartition(1).sortWithinPartitions("_id"), model, block_rows), model, how)
        return model
    tasks = min(MAX_TASKS, rows.sparkSession.sparkContext.defaultParallelism)
    model.rounds = _fit_blocks(_stored(_pack(cols.repartition(tasks), model, block_rows), tasks), model, how)
    return model


# --- use -------------------------------------------------------------------------------------

def _with_bins(model: Boosted, columns: DataFrame, make, ddl: str) -> DataFrame:
    width = len(model.features)
    shared = columns.sparkSession.sparkContext.broadcast(model)  # rounds x classes small trees

    def run(batches):
        for batch in batches:
            own, values = shared.value, np.column_stack([batch.column(f"_x{i}").to_numpy(zero_copy_only=False) for i in range(width)])
            whole = ~np.isnan(values).any(axis=1)  # a null arrives as NaN
            yield from make(own, batch.filter(pa.array(whole)), own.binned(list(values[whole].T)))
    return columns.mapInArrow(run, ddl)


def predict_boosted(model: Boosted, rows: DataFrame, label: str = "label", key: str = KEY) -> DataFrame:
    """(key, label, prediction); rows with a null feature have none. Of equal scores the lower class wins."""
    cols = rows.select(F.col(key).alias("_id"), F.col(label).cast("int").alias("_y"),
                       *[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(model.features)])

    def make(own, batch, bins):
        best = own.add_scores(np.zeros((len(bins), own.classes)), bins, 0).argmax(1).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_y"), pa.array(best)], ["_id", "label", "prediction"])
    kind = rows.schema[key].dataType.simpleString()
    return _with_bins(model, cols, make, f"_id {kind}, label int, prediction int").withColumnRenamed("_id", key)


def loss_curve(model: Boosted, rows: DataFrame, label: str = "label", weight: str | None = None, key: str = KEY) -> DataFrame:
    """(round, log_loss, accuracy) on the given rows after each round, in one pass."""
    def make(own, batch, bins):
        y, w = batch.column("_y").to_numpy(), batch.column("_w").to_numpy()
        scores, lines = np.zeros((len(bins), own.classes)), []
        for i in range(len(own.rounds)):
            scores = own.add_scores(scores, bins, i, i + 1)
            p = softmax(scores)[np.arange(len(y)), y]
            lines.append((i + 1, float(-(w * np.log(p)).sum()), float((w * (scores.argmax(1) == y)).sum()), float(w.sum())))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*lines, strict=True)] if lines else [[], [], [], []],
                                         schema=pa.schema([("round", pa.int64()), ("loss", pa.float64()), ("hits", pa.float64()), ("n", pa.float64())]))
    sums = _with_bins(model, _columns(rows, model.features, label, weight, key), make, "round long, loss double, hits double, n double")
    return sums.groupBy(F.col("round").cast("int").alias("round")).agg(
        (F.sum("loss") / F.sum("n")).alias("log_loss"), (F.sum("hits") / F.sum("n")).alias("accuracy"))


def first_gains(rows: DataFrame, features: list[str], classes: int = 3, label: str = "label", ridge: float = 1.0, least: float = 1.0,
                key: str = KEY) -> DataFrame:
    """(class, feature, upto, gain): what each cut of the first round's roots would gain, over all rows, unweighted."""
    spark, cols = rows.sparkSession, _columns(rows, features, label, None, key)
    model = Boosted(list(features), feature_edges(cols, len(features)), classes, 1)
    tasks = min(MAX_TASKS, spark.sparkContext.defaultParallelism)
    sums = gradient_sums(_blocks(_stored(_pack(cols, model, BLOCK_ROWS), tasks)), model, [Tree() for _ in range(classes)], [[1]] * classes)
    out = []
    for c in range(classes):
        gains = split_gains(sums[c, 0], ridge, least)
        out += [(c, name, float(edge), float(gains[f, b])) for f, name in enumerate(features) for b, edge in enumerate(model.edges[f])]
    return spark.createDataFrame(out, "class int, feature string, upto double, gain double")
