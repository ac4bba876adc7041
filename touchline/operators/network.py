"""A neural net of relu layers with batch normalisation and dropout, trained on blocks of rows side by side.

Rows are packed into blocks. An epoch is one job: each task starts from the shared state, goes through its own blocks in
mini-batches with Adam, and reports the state it reached; the driver takes the mean, weighted by rows (local steps with periodic
averaging). Weights, Adam's moments and running batch statistics are a few hundred kilobytes whatever the number of rows. One
block alone is plain mini-batch training. The job of an epoch first measures the state it was given on the validation rows, so
that no further pass is needed for the early stop.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.expressions import HASH_RANGE, key_hash
from touchline.operators.boosting import softmax
from touchline.schema import KEY
from touchline.session import scratch_path

BLOCK_ROWS, MAX_TASKS = 20_000, 64
NORM_EPS, NORM_KEEP = 1e-3, 0.99
ADAM_RATE, ADAM_FIRST, ADAM_SECOND, ADAM_EPS = 1e-3, 0.9, 0.999, 1e-7


@dataclass(frozen=True)
class Shape:
    """Layer sizes with the features first and the classes last; ``dropout`` has a share per hidden layer."""

    sizes: tuple[int, ...]
    dropout: tuple[float, ...]

    @property
    def hidden(self) -> int:
        return len(self.sizes) - 2

    def parts(self) -> list[tuple[str, tuple[int, ...]]]:
        """Names and shapes of all trained arrays, in the order of the flat vector."""
        out = []
        for i, (a, b) in enumerate(zip(self.sizes, self.sizes[1:], strict=False)):
            out += [(f"w{i}", (a, b)), (f"b{i}", (b,))]
            if i < self.hidden:
                out += [(f"scale{i}", (b,)), (f"shift{i}", (b,))]
        return out

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, shape in self.parts():
            size = int(np.prod(shape))
            out[name], at = flat[at:at + size].reshape(shape), at + size
        return out

    def start(self, seed: int) -> np.ndarray:
        """Uniform weights by fan-in and fan-out, scales of 1, everything else 0."""
        flat = np.zeros(sum(int(np.prod(s)) for _, s in self.parts()))
        draw = np.random.default_rng(seed)
        for name, x in self.views(flat).items():
            if name.startswith("w"):
                x[:] = draw.uniform(-1, 1, x.shape) * np.sqrt(6 / sum(x.shape))
            elif name.startswith("scale"):
                x[:] = 1
        return flat


@dataclass
class State:
    """Everything that training carries from step to step, as flat vectors."""

    weights: np.ndarray
    first: np.ndarray
    second: np.ndarray
    running: np.ndarray  # mean and variance of each hidden layer, one after the other
    steps: float = 0.0

    def flat(self) -> np.ndarray:
        return np.concatenate([self.weights, self.first, self.second, self.running, [self.steps]])

    def like(self, flat: np.ndarray) -> State:
        n = len(self.weights)
        return State(flat[:n].copy(), flat[n:2 * n].copy(), flat[2 * n:3 * n].copy(), flat[3 * n:-1].copy(), float(flat[-1]))


def start_state(shape: Shape, seed: int) -> State:
    weights = shape.start(seed)
    running = np.concatenate([np.concatenate([np.zeros(n), np.ones(n)]) for n in shape.sizes[1:-1]] or [np.zeros(0)])
    return State(weights, np.zeros_like(weights), np.zeros_like(weights), running)


def _running(shape: Shape, running: np.ndarray) -> list[np.ndarray]:
    """(2, n) views, mean above variance."""
    out, at = [], 0
    for n in shape.sizes[1:-1]:
        out.append(running[at:at + 2 * n].reshape(2, n))
        at += 2 * n
    return out


def scores(shape: Shape, state: State, x: np.ndarray) -> np.ndarray:
    """Class scores with the running statistics and without dropout."""
    p, stats = shape.views(state.weights), _running(shape, state.running)
    for i in range(shape.hidden):
        x = np.maximum(x @ p[f"w{i}"] + p[f"b{i}"], 0)
        x = (x - stats[i][0]) / np.sqrt(stats[i][1] + NORM_EPS) * p[f"scale{i}"] + p[f"shift{i}"]
    return x @ p[f"w{shape.hidden}"] + p[f"b{shape.hidden}"]


def loss_and_gradient(shape: Shape, weights: np.ndarray, x: np.ndarray, label: np.ndarray, weight: np.ndarray,
                      masks: list[np.ndarray]):
    """Weighted mean cross-entropy of a batch, its gradient, the class scores and each layer's (mean, variance).

    ``masks`` are the dropout factors of each hidden layer; batch statistics are those of the batch itself.
    """
    p, n, kept, stats = shape.views(weights), len(x), [], []
    for i in range(shape.hidden):
        z = x @ p[f"w{i}"] + p[f"b{i}"]
        a = np.maximum(z, 0)
        mean, var = a.mean(0), a.var(0)
        unit = (a - mean) / np.sqrt(var + NORM_EPS)
        kept.append((x, z, unit, var))
        stats.append((mean, var))
        x = (unit * p[f"scale{i}"] + p[f"shift{i}"]) * masks[i]
    out = x @ p[f"w{shape.hidden}"] + p[f"b{shape.hidden}"]
    prob, rows = softmax(out), np.arange(n)
    loss = float((weight * -np.log(np.maximum(prob[rows, label], 1e-300))).sum() / n)

    grad = np.zeros_like(weights)
    g = shape.views(grad)
    back = prob.copy()
    back[rows, label] -= 1
    back *= (weight / n)[:, None]
    g[f"w{shape.hidden}"][:], g[f"b{shape.hidden}"][:] = x.T @ back, back.sum(0)
    back = back @ p[f"w{shape.hidden}"].T
    for i in range(shape.hidden - 1, -1, -1):
        x, z, unit, var = kept[i]
        back = back * masks[i]
        g[f"scale{i}"][:], g[f"shift{i}"][:] = (back * unit).sum(0), back.sum(0)
        du = back * p[f"scale{i}"]
        back = (du - du.mean(0) - unit * (du * unit).mean(0)) / np.sqrt(var + NORM_EPS) * (z > 0)
        g[f"w{i}"][:], g[f"b{i}"][:] = x.T @ back, back.sum(0)
        back = back @ p[f"w{i}"].T
    return loss, grad, out, stats


def adam_step(state: State, grad: np.ndarray) -> None:
    state.steps += 1
    state.first += (1 - ADAM_FIRST) * (grad - state.first)
    state.second += (1 - ADAM_SECOND) * (grad * grad - state.second)
    rate = ADAM_RATE * np.sqrt(1 - ADAM_SECOND ** state.steps) / (1 - ADAM_FIRST ** state.steps)
    state.weights -= rate * state.first / (np.sqrt(state.second) + ADAM_EPS)


def train_block(shape: Shape, state: State, block, batch: int, draw: np.random.Generator) -> tuple[float, int]:
    """One pass over a block's train rows in random order; changes ``state``. Returns the sum of losses and the hits."""
    x, label, weight = block
    order, loss, hits = draw.permutation(len(x)), 0.0, 0
    stats = _running(shape, state.running)
    for at in range(0, len(x), batch):
        rows = order[at:at + batch]
        masks = [(draw.random((len(rows), n)) >= d) / (1 - d) for n, d in zip(shape.sizes[1:-1], shape.dropout, strict=True)]
        value, grad, out, seen = loss_and_gradient(shape, state.weights, x[rows], label[rows], weight[rows], masks)
        for own, (mean, var) in zip(stats, seen, strict=True):
            own *= NORM_KEEP
            own[0] += (1 - NORM_KEEP) * mean
            own[1] += (1 - NORM_KEEP) * var
        adam_step(state, grad)
        loss, hits = loss + value * len(rows), hits + int((out.argmax(1) == label[rows]).sum())
    return loss, hits


# --- blocks of rows --------------------------------------------------------------------------

_PACKED = "block long, label binary, weight binary, held binary, x binary"


def _pack(rows: DataFrame, features: list[str], label: str, weight: str | None, share: float, key: str, seed: int,
          block_rows: int) -> tuple[DataFrame, int]:
    """Blocks of about ``block_rows`` rows drawn by a hash of the key, and in the order of that hash within a block.

    A block is a group of its own that holds no more than a chance excess over ``block_rows``, whatever the keys are: a null key
    counts by its features.
    """
    whole = rows.select(F.coalesce(F.col(key).cast("string"), F.xxhash64(*features).cast("string")).alias("_id"),
                        F.col(label).cast("int").alias("_y"), (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("_w"),
                        *[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)]).dropna()
    blocks = max(1, -(-whole.count() // block_rows))
    tasks, width = min(MAX_TASKS, blocks), len(features)
    held = key_hash("_id", f"held{seed}") < int(share * HASH_RANGE)
    own = whole.select(F.pmod(F.xxhash64("_id", F.lit(seed)), F.lit(blocks)).alias("block"), "_id", held.alias("_held"), "_y", "_w",
                       *[f"_x{i}" for i in range(width)])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in table.column_names])
        x = np.column_stack([table.column(f"_x{i}").to_numpy() for i in range(width)])
        line = [table.column("_y").to_numpy().astype(np.int64), table.column("_w").to_numpy(), table.column("_held").to_numpy(), x]
        return pa.Table.from_arrays([table.column("block").slice(0, 1), *[
            pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in line]], ["block", "label", "weight", "held", "x"])
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "network")
    own.groupBy("block").applyInArrow(run, _PACKED).repartition(tasks, "block").write.parquet(path)
    return spark.read.schema(_PACKED).parquet(path).coalesce(tasks), blocks


def _blocks(batches, width: int):
    for batch in batches:
        for block, label, weight, held, x in zip(*[batch.column(c).to_pylist() for c in ("block", "label", "weight", "held", "x")], strict=True):
            yield block, (np.frombuffer(x).reshape(-1, width), np.frombuffer(label, np.int64), np.frombuffer(weight)), np.frombuffer(held, bool)


def _measure(shape: Shape, state: State, block) -> tuple[float, int]:
    x, label, _ = block
    if not len(x):
        return 0.0, 0
    out = scores(shape, state, x)
    prob = softmax(out)[np.arange(len(x)), label]
    return float(-np.log(np.maximum(prob, 1e-300)).sum()), int((out.argmax(1) == label).sum())


@dataclass(frozen=True)
class Epoch:
    epoch: int
    loss: float
    accuracy: float
    val_loss: float
    val_accuracy: float


@dataclass
class Network:
    features: list[str]
    shape: Shape
    state: State
    history: list[Epoch] = field(default_factory=list)
    best_epoch: int = 0


_SUMS = "state binary, rows long, loss double, hits long, val_rows long, val_loss double, val_hits long"


def _epoch(packed: DataFrame, shape: Shape, state: State, epoch: int, batch: int, seed: int):
    """Measure ``state`` on the validation rows, train from it on the others: the mean new state and the sums of both."""
    shared = packed.sparkSession.sparkContext.broadcast((shape, state))

    def run(batches):
        shape, state = shared.value
        total, sums, blank = None, [0, 0.0, 0, 0, 0.0, 0], state.flat()
        for number, (x, label, weight), held in _blocks(batches, shape.sizes[0]):
            val_loss, val_hits = _measure(shape, state, (x[held], label[held], weight[held]))
            train, own = tuple(v[~held] for v in (x, label, weight)), state.like(blank)
            loss, hits = train_block(shape, own, train, batch, np.random.default_rng([seed, epoch, number]))
            n = len(train[0])
            total = own.flat() * n if total is None else total + own.flat() * n
            sums = [a + b for a, b in zip(sums, [n, loss, hits, int(held.sum()), val_loss, val_hits], strict=True)]
        if total is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(("state", "rows", "loss", "hits", "val_rows", "val_loss", "val_hits"),
                                                       [total.tobytes(), *sums], strict=True))],
                                             schema=pa.schema([("state", pa.binary()), ("rows", pa.int64()), ("loss", pa.float64()),
                                                               ("hits", pa.int64()), ("val_rows", pa.int64()), ("val_loss", pa.float64()),
                                                               ("val_hits", pa.int64())]))
    try:
        found = packed.mapInArrow(run, _SUMS).collect()  # a state per task, at most MAX_TASKS of them
    finally:
        shared.unpersist()
    found.sort(key=lambda r: (r.rows, r.loss))  # sums of doubles in one order
    n = sum(r.rows for r in found)
    mean = state.like(sum(np.frombuffer(r.state) for r in found) / n) if n else state
    train = (sum(r.loss for r in found) / max(1, n), sum(r.hits for r in found) / max(1, n))
    m = sum(r.val_rows for r in found)
    return mean, train, (sum(r.val_loss for r in found) / m, sum(r.val_hits for r in found) / m) if m else train


def fit_network(rows: DataFrame, features: list[str], classes: int = 3, label: str = "label", weight: str | None = None,
                hidden: tuple[int, ...] = (256, 128, 64), dropout: tuple[float, ...] = (0.3, 0.3, 0.2), epochs: int = 100,
                batch: int = 256, patience: int = 10, validation: float = 0.1, seed: int = 42, key: str = KEY,
                block_rows: int = BLOCK_ROWS) -> Network:
    """Train until the validation loss has not fallen for ``patience`` epochs, and return the best epoch's net.

    ``validation`` is the share of rows, drawn by a hash of the key, that are measured and not trained on; without any, the
    train loss decides. ``weight`` multiplies a row's train loss. Labels are 0 .. classes - 1; rows with a null are left out.
    An empty table gives the untrained net. Block by block equal rows, settings and seed give equal nets.
    """
    packed, _ = _pack(rows, features, label, weight, validation, key, seed, block_rows)
    shape = Shape((len(features), *hidden, classes), tuple(dropout))
    state = start_state(shape, seed)
    net, waiting, least, train = Network(list(features), shape, state), None, np.inf, None
    for epoch in range(1, epochs + 2):  # the last job only measures
        after, sums, measured = _epoch(packed, shape, state, epoch, batch, seed)
        if waiting is not None:
            held = measured if validation else train
            net.history.append(Epoch(waiting, *train, *held))
            if held[0] < least:
                least, net.state, net.best_epoch = held[0], state, waiting
            elif waiting - net.best_epoch >= patience:
                break
        waiting, train, state = epoch, sums, after
    return net


# --- use -------------------------------------------------------------------------------------

def predict_network(net: Network, rows: DataFrame, label: str = "label", key: str = KEY) -> DataFrame:
    """(key, label, prediction); rows with a null feature have none. Of equal scores the lower class wins."""
    kind, width = rows.schema[key].dataType.simpleString(), len(net.features)
    cols = rows.select(F.col(key).alias("_id"), F.col(label).cast("int").alias("label"),
                       *[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(net.features)])
    shared = rows.sparkSession.sparkContext.broadcast((net.shape, net.state))  # weights only, no rows

    def run(batches):
        for b in batches:
            x = np.column_stack([b.column(f"_x{i}").to_numpy(zero_copy_only=False) for i in range(width)])
            whole = ~np.isnan(x).any(axis=1)  # a null arrives as NaN
            b, x = b.filter(pa.array(whole)), x[whole]
            best = scores(*shared.value, x).argmax(1).astype(np.int32) if len(x) else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("label"), pa.array(best)], ["_id", "label", "prediction"])
    return cols.mapInArrow(run, f"_id {kind}, label int, prediction int").withColumnRenamed("_id", key)


def network_history(net: Network, spark) -> DataFrame:
    """(epoch, loss, accuracy, val_loss, val_accuracy, best): a line per epoch."""
    return spark.createDataFrame([(e.epoch, e.loss, e.accuracy, e.val_loss, e.val_accuracy, e.epoch == net.best_epoch) for e in net.history],
                                 "epoch int, loss double, accuracy double, val_loss double, val_accuracy double, best boolean")
