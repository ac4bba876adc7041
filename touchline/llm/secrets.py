"""Secrets in texts, with DataFrame functions only.

Fixed patterns find assignments, access keys and long hexadecimal runs. Beyond them, two Markov models of characters - one of
random strings, one of ordinary identifiers - are compared by the log-likelihood ratio of each long token.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.text import read

# fixed patterns of the base spans
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")
LEAST_VALUE = 12

TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
IDENTIFIER = r"[A-Za-z0-9_]{4,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
SIZE = len(ALPHABET) + 1  # place 0: the start, and any other character
MAX_FIT_ROWS = 3_000  # expected documents of each kind that a fit reads
LEAST_RATIO = 0.5  # natural log per character
BACKING = 5.0  # weight of single characters in a context
_BLOCK = 256


def _let(values: dict[str, Column], body) -> Column:
    """Work out some values once per row and use them in a body; a column named twice may be worked out in every step."""
    return F.transform(F.array(F.struct(*[c.alias(n) for n, c in values.items()])), body)[0]


def _running(x: Column) -> Column:
    """Sums up to each place of a short array."""
    return F.aggregate(x, F.array().cast("array<long>"), lambda a, v: F.concat(a, F.array(F.coalesce(F.get(a, F.size(a) - 1), F.lit(0).cast("long")) + v)))


def _ends(gaps: Column, lengths: Column) -> Column:
    """End of each match: all gaps and matches up to it, summed within blocks, then over the blocks."""
    def summed(v):
        step = F.zip_with(F.slice(v["g"], F.lit(1), F.size(v["l"])), v["l"], lambda g, m: (g + m).cast("long"))
        return _let({"steps": step}, lambda w: _let({"blocks": F.transform(
            F.sequence(F.lit(0), F.floor((F.size(w["steps"]) - 1) / _BLOCK).cast("int")),
            lambda b: _running(F.slice(w["steps"], b * _BLOCK + 1, F.lit(_BLOCK))))}, shifted))

    def shifted(x):
        before = _running(F.concat(F.array(F.lit(0).cast("long")), F.transform(x["blocks"], lambda b: F.element_at(b, -1))))
        return _let({"before": before}, lambda y: F.flatten(F.transform(
            x["blocks"], lambda b, i: F.transform(b, lambda e: (e + F.get(y["before"], i)).cast("int")))))
    return _let({"g": gaps, "l": lengths}, summed)


_SPANS = "array<struct<start:int,order:int,end:int,value:string>>"


def _spans(pattern: str, order: int, value_group: int = 0) -> Column:
    """The pattern's matches in ``text``: start, order, end, value. Texts without any skip the rest."""
    take = lambda group: F.regexp_extract_all("text", F.lit(pattern), F.lit(group))
    matched = {"m": take(0)} | ({"v": take(value_group)} if value_group else {})

    def placed(found):
        lengths = F.transform(found["m"], F.char_length)
        return _let({"l": lengths, "e": _ends(F.transform(F.split("text", pattern, -1), F.char_length), lengths),
                     "v": found["v" if value_group else "m"]}, lambda x: F.transform(x["e"], lambda e, i: F.struct(
                         (e - F.get(x["l"], i)).alias("start"), F.lit(order).alias("order"), e.alias("end"), F.get(x["v"], i).alias("value"))))
    return F.when(F.col("text").rlike(pattern), _let(matched, placed).cast(_SPANS)).otherwise(F.array().cast(_SPANS))


def with_base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with ``assign``, ``access`` and ``hex``; matches that fail their check are gone."""
    assign = F.filter(_spans(ASSIGN, 0, value_group=2), lambda s: F.char_length(s["value"]) >= LEAST_VALUE)
    return docs.withColumn("assign", assign).withColumn("access", _spans(ACCESS, 1)).withColumn("hex", _spans(HEX, 2))


def _touches(span: Column, sorted_spans: Column) -> Column:
    """Whether a span overlaps one of the others, which are in order and do not overlap each other: by bisection."""
    step = lambda r, _: _let({"mid": F.floor((r["low"] + r["high"]) / 2).cast("int")}, lambda m: F.when(
        r["low"] >= r["high"], F.struct(r["low"].alias("low"), r["high"].alias("high"))).when(
        F.get(sorted_spans, m["mid"])["start"] < span["end"], F.struct((m["mid"] + 1).alias("low"), r["high"].alias("high"))).otherwise(
        F.struct(r["low"].alias("low"), m["mid"].alias("high"))))
    rounds = F.sequence(F.lit(1), F.ceil(F.log2(F.size(sorted_spans) + 2)).cast("int") + 1)
    before = F.aggregate(rounds, F.struct(F.lit(0).alias("low"), F.size(sorted_spans).alias("high")), step, lambda r: r["low"])
    return F.coalesce(F.get(sorted_spans, before - 1)["end"] > span["start"], F.lit(False))


def _pairs(token: Column) -> Column:
    """Codes of each character and the one before it."""
    at = lambda i: F.instr(F.lit(ALPHABET), F.substring(token, i, F.lit(1)))
    return F.transform(F.sequence(F.lit(1), F.char_length(token)),
                       lambda i: F.when(i > 1, at(i - 1)).otherwise(0) * SIZE + at(i))


def _pair_counts(tokens: DataFrame) -> dict[int, int]:
    """Counts of character pairs; ``tokens`` has ``token, n``. At most 69 x 69 rows come back."""
    codes = tokens.select(F.explode(_pairs(F.col("token"))).alias("code"), "n")
    return {r[0]: r[1] for r in codes.groupBy("code").agg(F.sum("n")).collect()}


def _some(docs: DataFrame, condition: Column, most: int) -> DataFrame:
    """About ``most`` of the documents that meet the condition, drawn by a hash of the text."""
    own = docs.filter(condition)
    n = own.count()
    return own.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(min(1.0, most / max(1, n)) * (1 << 30)))


def _log_probabilities(counts: dict[int, int]) -> list[float]:
    """Log probability of each pair's second character after its first; rare contexts lean on single characters."""
    before, single = [0] * SIZE, [0.5] * SIZE
    for code, n in counts.items():
        before[code // SIZE] += n
        single[code % SIZE] += n
    total = sum(single)
    return [math.log((counts.get(c, 0) + BACKING * single[c % SIZE] / total) / (before[c // SIZE] + BACKING))
            for c in range(SIZE * SIZE)]


def fit_ratios(docs: DataFrame, max_rows: int = MAX_FIT_ROWS) -> list[float]:
    """Log-likelihood ratio of random string against identifier for each pair of characters.

    Labelled samples: the values of base spans are random strings; the words that occur twice or more in texts without
    any are identifiers (a secret that the patterns miss hardly occurs twice). ``max_rows`` bounds the expected documents
    of each kind.
    """
    texts_ = docs.select("text").filter("text IS NOT NULL")
    any_base = F.col("text").rlike(ASSIGN) | F.col("text").rlike(ACCESS) | F.col("text").rlike(HEX)
    secret = with_base_spans(_some(texts_, any_base, max_rows))
    values = secret.select(F.explode(F.concat(*(F.transform(k, lambda s: s["value"]) for k in KINDS[:3]))).alias("token"))
    random = _pair_counts(values.groupBy("token").agg(F.count("*").alias("n")))
    plain = _some(texts_, ~any_base, max_rows)
    words = plain.select(F.explode(F.regexp_extract_all("text", F.lit(IDENTIFIER), F.lit(0))).alias("token"))
    ordinary = _pair_counts(words.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1"))
    return [r - o for r, o in zip(_log_probabilities(random), _log_probabilities(ordinary), strict=True)]


def find_secrets(docs: DataFrame, ratios: list[float] | None = None) -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of start, order, end, kind, by start, then kind.

    Places are code points, ends exclusive. ``spans`` has the base spans and the tokens that look random and don't touch
    one. A null or empty text has none. Columns of the input named like a kind, ``base`` or ``spans`` are replaced.
    """
    docs = docs.drop(*KINDS, "base", "spans")
    names = docs.columns
    table = F.split(F.lit(",".join(f"{x:.9g}" for x in (fit_ratios(docs) if ratios is None else ratios))), ",").cast("array<double>")
    kind = F.array(*map(F.lit, KINDS))
    named = lambda s: F.struct(s["start"].alias("start"), s["order"].alias("order"), s["end"].alias("end"),
                               F.get(kind, s["order"]).alias("kind"))
    ratio = lambda token: F.aggregate(_pairs(token), F.lit(0.0), lambda a, code: a + F.get(table, code))

    def put_together(v):
        random = lambda s: ratio(s["value"]) > LEAST_RATIO * F.char_length(s["value"])
        added = F.filter(v["markov"], lambda s: ~(_touches(s, v["assign"]) | _touches(s, v["access"]) | _touches(s, v["hex"])) & random(s))
        return F.struct(F.array_sort(F.transform(F.concat(*(v[k] for k in KINDS[:3])), named)).alias("base"),
                        F.array_sort(F.transform(F.concat(*(v[k] for k in KINDS[:3]), added), named)).alias("spans"))
    rows = with_base_spans(docs).withColumn("markov", _spans(TOKEN, 3))
    rows = rows.withColumn("_both", _let({k: F.col(k) for k in KINDS}, put_together))
    return rows.select(*names, F.col("_both.base").alias("base"), F.col("_both.spans").alias("spans"))


def joined(spans: str) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op7_secrets(spark, sf_dir: str) -> DataFrame:
    found = find_secrets(read(spark, sf_dir, "documents").select("doc_id", "text"))
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *(number(k).alias(f"n_{k}") for k in KINDS[:3]),
                        F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
