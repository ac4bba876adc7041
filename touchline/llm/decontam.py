"""Benchmark decontamination: a BM25 index of test items, queried by every passage of the training texts.

Weights are divided by the score an item has with itself, so one threshold serves all items. Block-max WAND finds all
items of a passage at or above it. Passages whose rare terms can't lift an item to it, even if all the item's frequent terms
matched, are left out before (an exact bound, computed for many passages at once). What is found counts only if the
question and the answer of the item are in the passage.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.text import _LOWER, counts_of, pieces, read, share, span_hashes, texts

K1, B = 1.2, 0.75
THRESHOLD = 0.5
OVERLAP = 0.8
SHINGLE = 5
BLOCK = 64
MAX_INDEX_WORDS = 2_000_000  # words of items per index; more items go into further indexes

_WORDLIKE = np.zeros(256, bool)
_WORDLIKE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def plain_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each run of letters, digits and bytes beyond ASCII, lower-cased; marks don't count."""
    word = _WORDLIKE[data]
    if not len(word):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(word))]
    first[edge] = word[edge]
    last[edge - 1] = word[edge - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return span_hashes(_LOWER[data], start, end), np.searchsorted(offsets, start, "right") - 1


def _words_of(column: list[str | None]) -> list[np.ndarray]:
    data, offsets = texts(pa.array(column, pa.string()))
    words, row = plain_words(data, offsets)
    return np.split(words, np.cumsum(counts_of(row, len(column)))[:-1])


class Index:
    """Postings of one set of items: for each term the items with their weights, in blocks with their greatest weight."""

    def __init__(self, ids: list, questions: list[str | None], answers: list[str | None], threshold: float = THRESHOLD):
        asked, answered = _words_of(questions), _words_of(answers)
        kept = [i for i in range(len(ids)) if len(asked[i]) + len(answered[i])]
        self.ids = [ids[i] for i in kept]
        self.parts = [(asked[i], answered[i]) for i in kept]
        bags = [np.unique(np.concatenate(p), return_counts=True) for p in self.parts]
        sizes = [len(q) + len(a) for q, a in self.parts]
        self.longest, self.threshold = max(sizes, default=1), threshold
        self.terms, df = np.unique(np.concatenate([b[0] for b in bags]) if bags else np.zeros(0, np.uint64),
                                   return_counts=True)
        n, mean = len(kept), sum(sizes) / max(1, len(sizes))
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        postings: list[list[tuple[int, float]]] = [[] for _ in self.terms]
        self.common = np.zeros(n)
        weights = []
        for item, ((terms, tf), size) in enumerate(zip(bags, sizes, strict=True)):
            at = np.searchsorted(self.terms, terms)
            w = idf[at] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * size / mean))
            weights.append((at, w / w.sum()))
            for t, x in zip(at.tolist(), weights[-1][1].tolist(), strict=True):
                postings[t].append((item, x))
        # frequent terms first, as many as leave every item short of the threshold by two fifths
        self.rare = np.ones(len(self.terms), bool)
        for t in np.argsort(-df, kind="stable").tolist():
            items = [i for i, _ in postings[t]]
            add = np.array([x for _, x in postings[t]])
            if len(items) > 1 and (self.common[items] + add).max() <= 0.6 * threshold:
                self.common[items] += add
                self.rare[t] = False
        self.items = [[i for i, _ in p] for p in postings]
        self.weights = [[x for _, x in p] for p in postings]
        self.top = np.array([max(w) for w in self.weights]) if len(self.terms) else np.zeros(0)
        self.blocks = [[max(w[k:k + BLOCK]) for k in range(0, len(w), BLOCK)] for w in self.weights]
        self.degree = np.array([len(p) for p in postings], np.int64)
        self.first = np.cumsum(self.degree) - self.degree
        self.flat_items = np.array([i for p in postings for i, _ in p], np.int64)
        self.flat_weights = np.array([x for p in postings for _, x in p])

    def retrieve(self, terms: list[int]) -> list[tuple[int, float]]:
        """All items whose score with the distinct ``terms`` reaches the threshold (block-max WAND)."""
        theta, found = self.threshold - 1e-9, []
        cursors = [[self.items[t][0], 0, t] for t in terms]
        while cursors:
            cursors.sort()
            total, pivot = 0.0, -1
            for k, c in enumerate(cursors):
                total += self.top[c[2]]
                if total >= theta:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            bound, block_end = 0.0, math.inf
            for _, _, t in cursors[:pivot + 1]:
                block = self._block_at(t, item)
                if block is not None:
                    bound += self.blocks[t][block]
                    block_end = min(block_end, self.items[t][min(len(self.items[t]), (block + 1) * BLOCK) - 1])
            if bound >= theta:
                if cursors[0][0] == item:
                    score = sum(self.weights[c[2]][c[1]] for c in cursors[:pivot + 1])
                    if score >= theta:
                        found.append((item, score))
                    to = item + 1
                else:
                    to = item
            else:  # no item up to the end of these blocks can reach it
                to = block_end + 1 if block_end < math.inf else item + 1
                if pivot + 1 < len(cursors):
                    to = min(to, cursors[pivot + 1][0])
                to = max(to, item + 1)
            for c in cursors[:pivot + 1]:
                self._advance(c, to)
            cursors = [c for c in cursors if c[0] is not None]
        return found

    def _block_at(self, t: int, item: int) -> int | None:
        at = bisect_left(self.items[t], item)
        return at // BLOCK if at < len(self.items[t]) else None

    def _advance(self, cursor: list, to: float) -> None:
        items, at = self.items[cursor[2]], cursor[1]
        while at < len(items) and items[at] < to:
            at += 1
        cursor[0], cursor[1] = (items[at], at) if at < len(items) else (None, at)

    def overlap(self, item: int, passage: np.ndarray) -> tuple[float, float]:
        return tuple(_held(part, passage) for part in self.parts[item])

    def search(self, batch: pa.RecordBatch, overlap: float) -> Iterator[tuple[int, int, float, float, float]]:
        """Row, item, score, question and answer overlap of each verified hit."""
        if not self.ids:
            return
        words, row = plain_words(*texts(batch.column("text")))
        if not len(words):
            return
        half = max(32, self.longest)
        at = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        known = self.terms[at] == words
        first = np.searchsorted(row, np.arange(batch.num_rows))
        pos = np.arange(len(words)) - first[row]
        # passages of 2 * half words, one every half: a word is in the one that starts at its half and in the one before
        per_row = (counts_of(row, batch.num_rows) + half - 1) // half
        base = np.cumsum(per_row) - per_row
        own = base[row] + pos // half
        hit = np.flatnonzero(known & self.rare[at])
        order = hit[np.lexsort((pos[hit], at[hit], row[hit]))]
        before = np.full(len(words), -1)
        if len(order) > 1:
            same = (row[order][1:] == row[order][:-1]) & (at[order][1:] == at[order][:-1])
            before[order[1:][same]] = pos[order[:-1][same]]
        begin = pos[hit] // half * half
        here, earlier = before[hit] < begin, (begin > 0) & (before[hit] < begin - half)
        passage = np.concatenate([own[hit][here], own[hit][earlier] - 1])
        term = np.concatenate([at[hit][here], at[hit][earlier]])
        # what each item gets from the rare terms of each passage; a repeated word counts once
        degree = self.degree[term]
        posting = np.arange(int(degree.sum())) - np.repeat(np.cumsum(degree) - degree - self.first[term], degree)
        item = self.flat_items[posting]
        pair, inverse = np.unique(np.repeat(passage, degree) * len(self.ids) + item, return_inverse=True)
        reach = np.bincount(inverse, weights=self.flat_weights[posting], minlength=len(pair)) + self.common[pair % len(self.ids)]
        for p in np.unique(pair[reach >= self.threshold - 1e-9] // len(self.ids)).tolist():
            r = int(np.searchsorted(base, p, "right")) - 1
            while per_row[r] == 0:
                r -= 1
            a = int(first[r] + (p - base[r]) * half)
            b = min(a + 2 * half, int(first[r + 1]) if r + 1 < batch.num_rows else len(words))
            terms = np.unique(at[a:b][known[a:b]])
            for item, score in self.retrieve(terms.tolist()):
                q, ans = self.overlap(item, words[a:b])
                if q >= overlap and ans >= overlap:
                    yield r, item, score, q, ans


def _grams(words: np.ndarray, size: int) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(words, size)


def _held(part: np.ndarray, passage: np.ndarray) -> float:
    """Share of the part's five-word runs (or of its whole, if shorter) that the passage holds; 1 for no words."""
    size = min(SHINGLE, len(part))
    if not size:
        return 1.0
    if len(passage) < size:
        return 0.0
    have = {x.tobytes() for x in _grams(np.ascontiguousarray(passage), size)}
    runs = [x.tobytes() for x in _grams(np.ascontiguousarray(part), size)]
    return sum(x in have for x in runs) / len(runs)


def question_and_answer(items: DataFrame) -> DataFrame:
    """``item_id, question, answer`` from ``item_id, text``: the last sentence is the answer, if others come before it."""
    pattern = r"(?s)^(.*\S.*[.!?])\s+(\S.*)$"
    split = F.col("text").rlike(pattern)
    return items.select("item_id",
                        F.when(split, F.regexp_extract("text", pattern, 1)).otherwise(F.col("text")).alias("question"),
                        F.when(split, F.regexp_extract("text", pattern, 2)).otherwise(F.lit("")).alias("answer"))


def indexes(items: DataFrame, max_words: int = MAX_INDEX_WORDS) -> list[Index]:
    """Indexes of up to about ``max_words`` words each; an id's hash says which one an item is in."""
    words = F.size(F.split(F.concat_ws(" ", "question", "answer"), r"[^\p{L}\p{N}]+"))
    total = items.agg(F.sum(words)).first()[0] or 0
    shards = -(-total // max_words) if total else 0
    out = []
    for k in range(shards):
        own = items.filter(F.pmod(F.xxhash64("item_id", "question"), F.lit(shards)) == k) if shards > 1 else items
        rows = own.select("item_id", "question", "answer").orderBy("item_id").collect()
        out.append(Index([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows]))
    return out


def leaks(docs: DataFrame, items: DataFrame, overlap: float = OVERLAP, max_words: int = MAX_INDEX_WORDS) -> DataFrame:
    """``doc_id, item_id, score, question_overlap, answer_overlap`` for each document that holds an item.

    Every passage of every whole text is a query. Null and empty texts and items without words match nothing; a null
    ``doc_id`` counts as one document. If the items are too many for one index, the texts are read once per index.
    """
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"
    out = spark.createDataFrame([], schema)
    for index in indexes(items, max_words):
        model = share(spark, index)

        def run(batches, model=model):
            index = model()
            for batch in batches:
                for part in pieces(batch):
                    hits = list(index.search(part, overlap))
                    if hits:
                        ids = part.column("doc_id").to_pylist()
                        columns = [[ids[h[0]] for h in hits], [index.ids[h[1]] for h in hits],
                                   *([h[k] for h in hits] for k in (2, 3, 4))]
                        kinds = [pa.int64()] * 2 + [pa.float64()] * 3
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                                         ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])
        out = out.union(docs.select("doc_id", "text").mapInArrow(run, schema))
    return out.groupBy("doc_id", "item_id").agg(*(F.max(c).alias(c) for c in ("score", "question_overlap", "answer_overlap")))


def without_leaks(docs: DataFrame, items: DataFrame, overlap: float = OVERLAP) -> DataFrame:
    """``docs`` without the rows that hold an item."""
    for index in indexes(items):
        model = share(docs.sparkSession, index)

        def run(batches, model=model):
            index = model()
            for batch in batches:
                for part in pieces(batch):
                    keep = np.ones(part.num_rows, bool)
                    keep[[h[0] for h in index.search(part, overlap)]] = False
                    yield part.filter(pa.array(keep))
        docs = docs.mapInArrow(run, docs.schema)
    return docs


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    return leaks(read(spark, sf_dir, "documents"), question_and_answer(read(spark, sf_dir, "benchmark")))
