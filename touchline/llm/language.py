"""Language identification with interpolated Kneser-Ney character models.

One model per language over the letters of single words, with marks for their start and end. The n-grams of all languages
share one sorted hash array per order, with a column of log probabilities per language, so a position costs one search
if any language knows its n-gram, and one more per step of backing off. The language with the lowest cross-entropy per
character wins; a calibrated limit per language tells texts that fit none.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchline.llm.text import GOLD, crc_mod, mix, pieces, read, share

ORDER = 5
MAX_FIT_ROWS = 2_500  # expected documents per language that a fit reads; a fifth of them calibrates
REJECT_QUANTILE = 0.995
CACHE_WORDS = 400_000
UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")


def letters_of(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


class Grams:
    """Hashes of the n-grams that end at each character of marked words, shortest first."""

    def __init__(self, words: list[str]):
        codes = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
        length = np.fromiter(map(len, words), np.int64, len(words)) + 2
        start = np.cumsum(length) - length
        self.word = np.repeat(np.arange(len(words)), length)
        self.pos = np.arange(len(codes)) - start[self.word]
        one = mix(codes.astype(np.uint64) * GOLD + np.uint64(1))
        self.hash = [one]
        for k in range(1, ORDER):
            longer = np.zeros(len(codes), np.uint64)
            longer[k:] = mix(self.hash[-1][k:] * GOLD + one[:-k])
            self.hash.append(longer)

    def at(self, k: int) -> np.ndarray:
        """Positions where an n-gram of k characters predicts a character; the start mark is never predicted."""
        return np.flatnonzero((self.pos >= k - 1) & (self.pos >= 1))

    def context(self, k: int, at: np.ndarray) -> np.ndarray:
        """Hash of the k - 1 characters before; 0 for none."""
        return self.hash[k - 2][at - 1] if k > 1 else np.zeros(len(at), np.uint64)


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place in a sorted array, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def train(counts: dict[str, dict[str, int]]) -> dict:
    """One model from the word counts of each language."""
    languages = sorted(counts)
    grams = {lang: Grams(list(counts[lang])) for lang in languages}
    weight = {lang: np.fromiter(counts[lang].values(), np.float64, len(counts[lang])) for lang in languages}
    alphabet = np.unique(np.concatenate([grams[lang].hash[0][grams[lang].at(1)] for lang in languages]))
    floor = -np.log(len(alphabet) + 1)
    tables, lower = [], None
    for k in range(1, ORDER + 1):
        own = []
        for lang in languages:
            g = grams[lang]
            at = g.at(k)
            keys, first, inverse = np.unique(g.hash[k - 1][at], return_index=True, return_inverse=True)
            if k == ORDER:
                count = np.bincount(inverse, weights=weight[lang][g.word[at]], minlength=len(keys))
            else:
                # continuations: distinct characters before the n-gram; at a word's start the n-gram's own count
                longer = g.at(k + 1)
                _, one = np.unique(g.hash[k][longer], return_index=True)
                count = np.bincount(np.searchsorted(keys, g.hash[k - 1][longer[one]]), minlength=len(keys)).astype(float)
                begins = g.pos[at] == k - 1
                count += np.bincount(inverse[begins], weights=weight[lang][g.word[at[begins]]], minlength=len(keys))
            once, twice = (count == 1).sum(), (count == 2).sum()
            discount = once / (once + 2 * twice) if once and twice else 0.5
            context = g.context(k, at[first])
            groups, member = np.unique(context, return_inverse=True)
            total = np.bincount(member, weights=count)
            back = discount * np.bincount(member) / total
            suffix = g.hash[k - 2][at[first]] if k > 1 else None
            own.append((keys, context, suffix, (count - discount) / total[member], groups, back, member))
        keys, first = np.unique(np.concatenate([o[0] for o in own]), return_index=True)
        context = np.concatenate([o[1] for o in own])[first]
        groups = np.unique(np.concatenate([o[4] for o in own]))
        backoff = np.zeros((len(groups), len(languages)))
        logp = np.empty((len(keys), len(languages)))
        if k == 1:
            below = np.full((len(keys), len(languages)), floor)
        else:
            below = lower[1][np.searchsorted(lower[0], np.concatenate([o[2] for o in own])[first])]
        for j, (mine, _, _, part, held, back, _) in enumerate(own):
            backoff[np.searchsorted(groups, held), j] = np.log(back)
            share_ = np.zeros(len(keys))
            share_[np.searchsorted(keys, mine)] = part
            logp[:, j] = np.log(share_ + np.exp(backoff[np.searchsorted(groups, context), j] + below[:, j]))
        lower = (keys, logp)
        tables.append({"keys": keys, "logp": logp.astype(np.float32), "contexts": groups,
                       "backoff": backoff.astype(np.float32)})
    return {"languages": languages, "tables": tables, "floor": floor}


def word_scores(model: dict, words: list[str]) -> np.ndarray:
    """Log probability of each word in each language."""
    g = Grams(words)
    at = g.at(1)
    score = np.zeros((len(at), len(model["languages"])))
    open_ = np.arange(len(at))
    for k in range(ORDER, 0, -1):
        table = model["tables"][k - 1]
        able = g.pos[at[open_]] >= k - 1
        here = open_[able]
        place, known = _find(table["keys"], g.hash[k - 1][at[here]])
        score[here[known]] += table["logp"][place[known]]
        missing = here[~known]
        if len(missing):
            place, known = _find(table["contexts"], g.context(k, at[missing]))
            score[missing[known]] += table["backoff"][place[known]]
        open_ = np.concatenate([open_[~able], missing])
    score[open_] += model["floor"]
    out = np.zeros((len(words), score.shape[1]))
    for j in range(score.shape[1]):
        out[:, j] = np.bincount(g.word[at], weights=score[:, j], minlength=len(words))
    return out


class Scorer:
    """Cross-entropy per character of whole texts; scores of words are kept for as long as they fit the cache."""

    def __init__(self, model: dict):
        self.model, self.known, self.table = model, {}, np.zeros((0, len(model["languages"])))

    def entropy(self, texts_: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """One line per text and one column per language, and the number of letters."""
        found = [letters_of(t) for t in texts_]
        if len(self.known) > CACHE_WORDS:
            self.known, self.table = {}, self.table[:0]
        fresh = list({w for words in found for w in words if w not in self.known})
        if fresh:
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh)), strict=True))
            self.table = np.concatenate([self.table, word_scores(self.model, fresh)])
        row = np.repeat(np.arange(len(found)), [len(w) for w in found])
        ids = np.fromiter((self.known[w] for words in found for w in words), np.int64, len(row))
        size = np.fromiter((len(w) for words in found for w in words), np.int64, len(row))
        letters = np.bincount(row, weights=size, minlength=len(found))
        total = np.bincount(row, weights=size + 1, minlength=len(found))
        out = np.stack([np.bincount(row, weights=-self.table[ids, j], minlength=len(found))
                        for j in range(self.table.shape[1])], axis=1)
        return out / np.maximum(total, 1)[:, None], letters


def posterior(entropy: np.ndarray, sharpness: float) -> np.ndarray:
    x = -sharpness * (entropy - entropy.min(axis=1, keepdims=True))
    p = np.exp(x)
    return p / p.sum(axis=1, keepdims=True)


def _entropies(docs: DataFrame, model: dict) -> DataFrame:
    unpack = share(docs.sparkSession, model)

    def run(batches):
        scorer = Scorer(unpack())
        for batch in batches:
            for part in pieces(batch):
                h, letters = scorer.entropy(part.column("text").to_pylist())
                has = letters > 0
                yield pa.RecordBatch.from_arrays([part.column("lang").filter(pa.array(has)),
                                                  pa.array(list(h[has]), pa.list_(pa.float64()))], ["lang", "h"])
    return docs.select("lang", "text").mapInArrow(run, "lang string, h array<double>")


def fit_languages(docs: DataFrame, max_rows: int = MAX_FIT_ROWS) -> dict | None:
    """Models, sharpness of the score, and the entropy beyond which a text fits no language.

    Reads ids whose crc32 mod 3 is not 1 and whose language is known. ``max_rows`` bounds the expected rows per
    language; a hash of the id draws them. None if there is nothing to learn from.
    """
    train_ = docs.filter("lang IS NOT NULL AND text IS NOT NULL").filter(crc_mod("doc_id", 3) != 1)
    sizes = {r[0]: r[1] for r in train_.groupBy("lang").count().collect()}
    if not sizes:
        return None
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    edge = F.lit(0)
    for lang, n in sizes.items():
        edge = F.when(F.col("lang") == lang, F.lit(int(min(1.0, max_rows / n) * (1 << 30)))).otherwise(edge)
    sample = train_.filter(draw < edge).withColumn("_part", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(5)))

    def count(batches):
        totals: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
                totals.setdefault(lang, Counter()).update(letters_of(text))
        for lang, words in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), pa.array(list(words), pa.string()),
                                              pa.array(list(words.values()), pa.int64())], ["lang", "word", "n"])

    def counted(part: DataFrame) -> dict:
        found: dict[str, dict[str, int]] = {}
        rows = (part.select("lang", "text").mapInArrow(count, "lang string, word string, n long")
                .groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow())
        for lang, word, n in zip(*(rows.column(c).to_pylist() for c in ("lang", "word", "n")), strict=True):
            found.setdefault(lang, {})[word] = n
        return {lang: dict(sorted(words.items())) for lang, words in found.items()}

    counts = counted(sample.filter("_part > 0")) or counted(sample)
    if not counts:
        return None
    model = train(counts)
    checks = _entropies(sample.filter("_part = 0"), model).toArrow()
    h = (checks.column("h").combine_chunks().flatten().to_numpy() if checks.num_rows else np.zeros(0)).reshape(-1, len(counts))
    label = np.array([model["languages"].index(x) if x in counts else -1 for x in checks.column("lang").to_pylist()], int)
    h, label = h[label >= 0], label[label >= 0]
    model["sharpness"], model["limit"] = 10.0, np.full(len(counts), np.inf)
    if len(label):
        choices = np.geomspace(0.5, 50, 25)
        loss = [-np.log(posterior(h, s)[np.arange(len(label)), label] + 1e-6).mean() for s in choices]
        model["sharpness"] = float(choices[int(np.argmin(loss))])
        for j in range(len(counts)):
            own = h[label == j, j]
            if len(own) >= 50:
                model["limit"][j] = np.quantile(own, REJECT_QUANTILE)
    return model


def identify(docs: DataFrame, model: dict | None) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (probability of that language), ``entropy`` and ``rejected``.

    Null texts, texts without a letter, and all texts if there is no model, are ``und`` with score 0 and rejected. A
    text whose entropy is above its language's limit keeps its language but is rejected.
    """
    own = ["lang_pred", "score", "entropy", "rejected"]
    docs = docs.drop(*own)
    unpack = share(docs.sparkSession, model)
    schema = (StructType(list(docs.schema.fields)).add("lang_pred", "string").add("score", "double")
              .add("entropy", "double").add("rejected", "boolean"))
    names = schema.names

    def run(batches):
        model = unpack()
        scorer = Scorer(model) if model else None
        for batch in batches:
            for part in pieces(batch):
                n = part.num_rows
                lang, score, low, out = np.full(n, UNKNOWN, object), np.zeros(n), np.full(n, np.nan), np.ones(n, bool)
                if scorer:
                    h, letters = scorer.entropy(part.column("text").to_pylist())
                    best, has = h.argmin(axis=1), letters > 0
                    lang[has] = np.array(model["languages"], object)[best[has]]
                    score[has] = posterior(h, model["sharpness"]).max(axis=1)[has]
                    low[has] = h.min(axis=1)[has]
                    out[has] = low[has] > model["limit"][best[has]]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(lang, pa.string()), pa.array(score), pa.array(low, from_pandas=True), pa.array(out)],
                    names)
    return docs.mapInArrow(run, schema)


def op1_language(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), fit_languages(docs.select("doc_id", "text", "lang")))
    return found.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "rejected")
