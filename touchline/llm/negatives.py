"""Hard negatives: per anchor and positive, the nearest vectors of other labels that are not nearer than the positive.

Scores are inner products of integer vectors. Each vector is cut into segments, and each segment is summed up by its mean and
its deviation (the norm of what is left after the mean). With segments of n components,

    n * mean_x * mean_y - dev_x * dev_y  <=  inner product over the segment  <=  n * mean_x * mean_y + dev_x * dev_y,

so a few numbers bound a score from both sides. Segments are refined from level to level (``LEVELS``): pairs whose upper bound is
below what still counts, or whose lower bound is above it, are left out; what is left after the last level is scored exactly.

All rows are read against blocks of anchors of a bounded size (``BLOCK_BYTES``), which are broadcast one after the other. Rows
are never shuffled: a task reports per anchor only its best few, and these are merged by a window that starts before the shuffle.
First the positives of a block are found, then, within the score windows they set, the negatives.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.text import read, share, stored
from touchline.session import scratch_path

SCALE, POSITIVES, NEGATIVES = 256, 5, 5
NEAR = (80, 100)  # a negative scores at least 80/100 of the positive's score, and at most as much
LEVELS = (1, 4, 16)  # segments
BLOCK_BYTES = 16 << 20
_ROWS, _ANCHORS = 1024, 512  # a tile of scores inside a task


# --- vectors ---------------------------------------------------------------------------------

def usable_rows(embeddings: DataFrame) -> DataFrame:
    """id, label and vector (integer components) of the rows that take part.

    Rows with a null id, label or vector, or with a null, infinite or NaN component, do not.
    """
    x = F.col("embedding")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * SCALE))
    return embeddings.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & fine).select(
        F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), whole.alias("vector"))


def relabelled(rows: DataFrame) -> DataFrame:
    """Every seventh id gets the next label of ten: a tenth of the labels is wrong on purpose."""
    return rows.withColumn("label", F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of equal width as doubles, which hold integers up to 2^53; shorter vectors end in zeros."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(lists), width))
    row = np.repeat(np.arange(len(lists)), lengths)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    keep = at < width  # the other side has no such component: it adds nothing
    out[row[keep], at[keep]] = flat[keep]
    return out


def summaries(matrix: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Per segment: the mean times the root of the length, and the deviation."""
    width = matrix.shape[1]
    cuts = np.unique(np.arange(segments) * width // segments)
    lengths = np.diff([*cuts, width])
    means = np.add.reduceat(matrix, cuts, axis=1) / lengths
    left = matrix - np.repeat(means, lengths, axis=1)
    return means * np.sqrt(lengths), np.sqrt(np.add.reduceat(left * left, cuts, axis=1))


class Block:
    """Anchors with what each still looks for: several slots per anchor, each with a score window and the best so far."""

    def __init__(self, ids, labels, matrix, low, high, count: int, same: bool):
        self.ids, self.labels, self.matrix, self.same, self.count = ids, labels, matrix, same, count
        self.low, self.high = low, high  # anchors x slots; a slot that looks for nothing has low > high
        self.slots = low.shape[1]
        self.floor = low.astype(np.float64)  # what a score must reach: the window's lower end or the last of a full list
        self.levels = [summaries(matrix, n) for n in LEVELS if n < matrix.shape[1]] if matrix.shape[1] else []
        self.key = self.score = self.row = np.zeros(0, np.int64)

    def offer(self, ids: np.ndarray, labels: np.ndarray, lists: pa.Array) -> None:
        rows = _matrix(lists, self.matrix.shape[1])
        own = [summaries(rows, len(means[0])) if len(means) else None for means, _ in self.levels]
        for a in range(0, len(self.ids), _ANCHORS):
            tile = slice(a, a + _ANCHORS)
            wanted = (labels[:, None] == self.labels[None, tile]) == self.same
            r, c = self._refined(rows, own, tile, wanted)
            at = self.matrix[tile]
            if self.same:  # an anchor is not its own positive
                own_id = np.flatnonzero(ids[r] == self.ids[tile][c])
                itself = own_id[(rows[r[own_id]] == at[c[own_id]]).all(axis=1)]
                r, c = np.delete(r, itself), np.delete(c, itself)
            self._keep(c + a, inner(rows, at, r, c), ids[r])

    def _refined(self, rows, own, tile, wanted) -> tuple[np.ndarray, np.ndarray]:
        """(row, anchor in the tile) of the pairs that no level's bounds rule out."""
        least, most = self.floor[tile].min(axis=1), self.high[tile].max(axis=1)
        r, c = np.nonzero(wanted)
        for (x_mean, x_dev), (y_mean, y_dev) in zip(own, self.levels, strict=True):
            mid, reach = products(x_mean, y_mean[tile], r, c), products(x_dev, y_dev[tile], r, c)
            slack = 1e-9 * (np.abs(mid) + reach) + 1e-6  # of rounding
            left = (mid + reach + slack >= least[c]) & (mid - reach - slack <= most[c])
            r, c = r[left], c[left]
        return r, c

    def _keep(self, anchor: np.ndarray, score: np.ndarray, row: np.ndarray) -> None:
        """Put scored pairs into the slots whose window they fall in; each slot keeps its first ``count``."""
        keys, scores, ids = [self.key], [self.score], [self.row]
        for s in range(self.slots):
            fits = (score >= self.floor[anchor, s]) & (score <= self.high[anchor, s])
            keys.append(anchor[fits] * self.slots + s)
            scores.append(score[fits])
            ids.append(row[fits])
        key, score, row = np.concatenate(keys), np.concatenate(scores), np.concatenate(ids)
        if len(key) == len(self.key):
            return
        order = np.lexsort((row, -score, key))
        key, score, row = key[order], score[order], row[order]
        new = np.ones(len(key), bool)  # a repeated row counts once
        new[1:] = (key[1:] != key[:-1]) | (score[1:] != score[:-1]) | (row[1:] != row[:-1])
        key, score, row = key[new], score[new], row[new]
        first = np.searchsorted(key, key, "left")
        place = np.arange(len(key)) - first
        stay = place < self.count
        last = key[place == self.count - 1]
        self.floor.reshape(-1)[last] = score[place == self.count - 1]
        self.key, self.score, self.row = key[stay], score[stay], row[stay]

    def result(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(self.key // self.slots), pa.array(self.key % self.slots),
                                           pa.array(self.score), pa.array(self.row)], ["anchor", "slot", "score", "row"])


def products(x: np.ndarray, y: np.ndarray, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of the given pairs; of all pairs at once if an eighth of them is asked for."""
    if len(r) * 8 > len(x) * len(y):
        return (x @ y.T)[r, c]
    return np.einsum("ij,ij->i", x[r], y[c])


def inner(rows: np.ndarray, anchors: np.ndarray, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of the given pairs."""
    bound = np.abs(rows).max(initial=0) * np.abs(anchors).max(initial=0) * max(1, rows.shape[1])
    if bound < 2 ** 53:  # then doubles hold every partial sum
        return products(rows, anchors, r, c).astype(np.int64)
    exact = [sum(int(x) * int(y) for x, y in zip(rows[i], anchors[j], strict=True)) for i, j in zip(r, c, strict=True)]
    return np.array(exact, np.int64)


# --- search ----------------------------------------------------------------------------------

_FOUND = "anchor long, slot long, score long, row long"


def _best_of(rows: DataFrame, block: Block) -> DataFrame:
    """(anchor, slot, score, row, rank): over all rows, the first of each slot of each anchor."""
    spec = share(rows.sparkSession, (block.ids, block.labels, block.matrix, block.low, block.high, block.count, block.same))

    def run(batches):
        own = Block(*spec())
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                own.offer(part.column("id").to_numpy(), part.column("label").to_numpy(), part.column("vector"))
        yield own.result()
    place = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "row")
    found = rows.mapInArrow(run, _FOUND).distinct()
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= block.count)


def _low(score: np.ndarray) -> np.ndarray:
    """The least integer negative score for a positive's score."""
    return -((-NEAR[0] * score) // NEAR[1])


def hard_negatives(rows: DataFrame, is_anchor, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for all anchors.

    ``rows`` has id, label and vector (see ``usable_rows``); ``is_anchor`` says which rows are anchors. An anchor's positives are
    the first rows of its label but itself; negatives have another label and a score within the window of ``NEAR``. Higher scores
    come first, then smaller ids. A row that is repeated counts once; two rows of one id with different vectors are two
    rows. A shorter vector counts as ending in zeros. Anchors without positives, positives without negatives, and an empty
    table give no rows.
    """
    spark = rows.sparkSession
    rows = stored(rows, "vectors")
    anchors = stored(rows.filter(is_anchor).distinct(), "anchors")
    shape = anchors.agg(F.count("*"), F.max(F.size("vector"))).first()
    per_block = max(1, block_bytes // (8 * max(1, shape[1] or 1)))
    blocks = -(-shape[0] // per_block)
    path = scratch_path(spark, "negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], schema).write.parquet(path)
    # About equal blocks by a hash; a block is at most a few times per_block, whatever the ids are.
    slot_of = F.pmod(F.xxhash64("id", "label", "vector"), F.lit(max(1, blocks)))
    for b in range(blocks):
        own = anchors.filter(slot_of == b).toArrow().sort_by("id")
        if own.num_rows:
            _mine(rows, own, shape[1], positives, negatives).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def _mine(rows: DataFrame, own: pa.Table, width: int, positives: int, negatives: int) -> DataFrame:
    """The results of one block of anchors."""
    spark = rows.sparkSession
    ids, labels = own.column("id").to_numpy(), own.column("label").to_numpy()
    matrix = _matrix(own.column("vector"), width)
    n, wide = len(ids), np.iinfo(np.int64)
    everything = Block(ids, labels, matrix, np.full((n, 1), wide.min + 1), np.full((n, 1), wide.max), positives, True)
    near = _best_of(rows, everything).select("anchor", "rank", "score", "row").toArrow()  # a few rows per anchor of the block
    anchor, slot = near.column("anchor").to_numpy(), near.column("rank").to_numpy() - 1
    score = near.column("score").to_numpy()
    low, high = np.full((n, positives), 1), np.full((n, positives), 0)  # nothing, unless a positive is there
    low[anchor, slot], high[anchor, slot] = _low(score), score
    found = _best_of(rows, Block(ids, labels, matrix, low, high, negatives, False))
    table = pa.table({"anchor": anchor, "slot": slot.astype(np.int64), "anchor_id": ids[anchor],
                      "positive_id": near.column("row"), "positive_score": score})
    return found.join(F.broadcast(spark.createDataFrame(table)), ["anchor", "slot"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("row").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def op11_negatives(spark, sf_dir: str) -> DataFrame:
    rows = relabelled(usable_rows(read(spark, sf_dir, "embeddings")))
    return hard_negatives(rows, F.col("id") % 100 == 0)


OP11_SQL = """WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
      list_transform(embedding, lambda x: CAST(FLOOR(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (SELECT a.vec_id AS anchor_id, r.vec_id AS row_id, a.label = r.label AS same,
      CAST(list_sum(list_transform(list_zip(a.vec, r.vec), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v a JOIN v r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
  p AS (SELECT anchor_id, row_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY ROW_NUMBER() OVER (PARTITION BY anchor_id ORDER BY score DESC, row_id) <= 5)
  SELECT p.anchor_id, positive_id, CAST(ROW_NUMBER() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, row_id) AS INT) AS rank,
    row_id AS negative_id, positive_score, s.score AS negative_score
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
    AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
  QUALIFY ROW_NUMBER() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, row_id) <= 5"""
