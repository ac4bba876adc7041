"""Document quality learnt from trusted positives and unlabelled web text (non-negative PU learning)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchline.llm.text import counts_of, crc_mod, pieces, read, texts, word_hashes

MAX_FIT_ROWS = 10_000  # expected rows of each kind that a fit collects
_CLASS = np.full(256, 7, np.uint8)  # bytes beyond ASCII
for _value, _members in enumerate([b" ", b"\t\n\x0b\x0c\r", bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789",
                                   b".,;:!?'\"()-", bytes(x for x in range(128) if chr(x) in "#$%&*+/<=>@[\\]^_`{|}~")]):
    _CLASS[list(_members)] = _value
_CLASS[list(range(9)) + list(range(14, 32)) + [127]] = 8
KINDS = 9
_MARKS = np.array([x for x in range(33, 127) if not chr(x).isalnum()])
REST = 7
WIDTH = KINDS * KINDS + len(_MARKS) + REST


def features(batch: pa.RecordBatch) -> np.ndarray:
    """Shape of each whole text: pairs of character classes, marks, word lengths, repeated words and lines."""
    data, offsets = texts(batch.column("text"))
    n, length = batch.num_rows, np.diff(offsets)
    row = np.repeat(np.arange(n), length)
    kind = _CLASS[data].astype(np.int64)
    out = np.zeros((n, WIDTH), np.float32)
    per = np.maximum(length, 1)[:, None]
    if len(data) > 1:
        same = row[1:] == row[:-1]
        pair = (row[1:] * KINDS * KINDS + kind[:-1] * KINDS + kind[1:])[same]
        out[:, :KINDS * KINDS] = np.bincount(pair, minlength=n * KINDS * KINDS).reshape(n, -1) / per
    place = np.full(256, -1)
    place[_MARKS] = np.arange(len(_MARKS))
    where = place[data]
    hit = where >= 0
    marks = np.bincount(row[hit] * len(_MARKS) + where[hit], minlength=n * len(_MARKS)).reshape(n, -1)
    out[:, KINDS * KINDS:-REST] = marks / per
    words, wrow, start, end = word_hashes(data, offsets)
    k = np.maximum(counts_of(wrow, n), 1)
    order = np.lexsort((words, wrow))
    fresh = np.ones(len(words), bool)
    fresh[1:] = (words[order][1:] != words[order][:-1]) | (wrow[order][1:] != wrow[order][:-1])
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (wrow[1:] == wrow[:-1])
    out[:, -7] = np.sqrt(counts_of(wrow[again], n) / k)
    out[:, -6] = np.log1p(length) / 10
    out[:, -5] = np.bincount(wrow, weights=end - start, minlength=n) / k / 10
    out[:, -4] = counts_of(wrow[order][fresh], n) / k
    out[:, -3] = np.log1p(counts_of(wrow, n)) / 10
    out[:, -2] = np.bincount(wrow, weights=(end - start) > 20, minlength=n) / k
    out[:, -1] = np.bincount(row[data == 10], minlength=n) / k
    out[:, :-REST] = np.log1p(200 * out[:, :-REST])
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _descend(gradient, width: int, steps: int, rate: float) -> np.ndarray:
    w, m, v = np.zeros(width), np.zeros(width), np.zeros(width)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 300) -> float:
    """Share of positives among unlabelled rows.

    Half of each kind fits a classifier of positive against unlabelled; on the other half, the share is the least
    ratio, over score thresholds, of unlabelled to positive rows above them, with a margin for few rows.
    """
    fit_p, fit_u = positive[::2], unlabelled[::2]

    def gradient(w):
        return (-(fit_p.T @ _sigmoid(-fit_p @ w)) / len(fit_p) + fit_u.T @ _sigmoid(fit_u @ w) / len(fit_u)) / 2 + 1e-3 * w

    w = _descend(gradient, positive.shape[1], steps, 0.05)
    sp, su = np.sort(positive[1::2] @ w), np.sort(unlabelled[1::2] @ w)
    at = np.quantile(sp, np.linspace(0.02, 0.9, 45))
    above_p = 1 - np.searchsorted(sp, at) / len(sp)
    above_u = 1 - np.searchsorted(su, at) / len(su)
    margin = np.sqrt(np.log(20) / 2) * (1 / np.sqrt(len(su)) + 1 / np.sqrt(len(sp)))
    best = np.argmin((above_u + margin) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.05, 0.98))


def fit_nnpu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 800, rate: float = 0.03) -> np.ndarray:
    """Weights of a logistic scorer that minimise the non-negative unbiased risk."""
    def gradient(w):
        fp, fu = positive @ w, unlabelled @ w
        risk = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        rest = unlabelled.T @ _sigmoid(fu) / len(fu) - prior * (positive.T @ _sigmoid(fp)) / len(fp)
        if risk < 0:  # the negative part of the risk can't be below zero: step back
            return -rest
        return -prior * (positive.T @ _sigmoid(-fp)) / len(fp) + rest + 1e-4 * w

    return _descend(gradient, positive.shape[1], steps, rate)


def _collect_features(docs: DataFrame) -> np.ndarray:
    def run(batches):
        for batch in batches:
            for part in pieces(batch):
                yield pa.RecordBatch.from_arrays([pa.array(list(features(part)), pa.list_(pa.float32()))], ["x"])
    rows = docs.select("text").mapInArrow(run, "x array<float>").toArrow()
    x = rows.column("x").combine_chunks() if rows.num_rows else pa.array([], pa.list_(pa.float32()))
    return x.flatten().to_numpy().reshape(-1, WIDTH).astype(np.float64)


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_FIT_ROWS) -> tuple[np.ndarray, np.ndarray, float]:
    """Mean and scale of the features, and weights, learnt from ids whose crc32 mod 3 is not 1.

    ``max_rows`` bounds the expected number of rows of each kind that the fit collects (a hash of the id draws them);
    everything else reads all rows. Without any positive row the score is the constant 0.5.
    """
    train = docs.filter("doc_id IS NOT NULL").filter(crc_mod("doc_id", 3) != 1).select("doc_id", "text")
    trusted = labels.filter("quality = 1").select("doc_id").distinct().filter(crc_mod("doc_id", 3) != 1)
    n_all, n_trusted = train.count(), trusted.count()
    if not n_all or not n_trusted:
        return np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH + 1)
    draw = lambda name, n: F.pmod(F.xxhash64("doc_id", F.lit(name)), F.lit(1 << 30)) < int(min(1.0, max_rows / n) * (1 << 30))
    positive = _collect_features(train.join(trusted.filter(draw("p", n_trusted)), "doc_id", "left_semi"))
    unlabelled = _collect_features(train.filter(draw("u", n_all)))
    if not len(positive) or not len(unlabelled):
        return np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH + 1)
    mean, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 1e-3
    ready = lambda x: np.hstack([np.clip((x - mean) / scale, -8, 8), np.ones((len(x), 1))])
    p, u = ready(positive), ready(unlabelled)
    return mean, scale, fit_nnpu(p, u, estimate_prior(p, u))


def score_quality(docs: DataFrame, model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted``; such columns of the input are replaced.

    Null and empty texts have all-zero features and are scored like any other.
    """
    mean, scale, weights = model
    docs = docs.drop("score", "predicted")
    schema = StructType(list(docs.schema.fields)).add("score", "double").add("predicted", "integer")
    names = schema.names

    def run(batches):
        for batch in batches:
            for part in pieces(batch):
                x = np.clip((features(part) - mean) / scale, -8, 8)
                score = _sigmoid(x @ weights[:-1] + weights[-1])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names)
    return docs.mapInArrow(run, schema)


def op9_quality(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, fit_quality(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score", "predicted")
