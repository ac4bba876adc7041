"""Personal data: fixed patterns, and a skip-chain conditional random field that finds what they miss.

The field's nodes are the words that hold a digit or an ``@``; all others are outside of any entity. Neighbouring nodes
are linked in a chain, and so are equal or similar nodes wherever they stand in a document: those skip links make one
label hold for all mentions. Loopy message passing gives each node its label probabilities.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from touchline.llm.text import pieces, read, share, texts, unused

KINDS = ("email", "ip", "card", "phone")
MAX_FIT_ROWS = 4_000  # expected documents that a fit collects
CERTAIN = 0.95
ROUNDS = 12

# fixed patterns of the base spans
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str):
    """Leftmost non-overlapping matches, found from each ``@``: the part before it is a run that holds no ``@``."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and LOCAL.match(text, start - 1):
            start -= 1
        domain = DOMAIN.match(text, at) if start < at else None
        free = domain.end() if domain else at + 1
        if domain:
            yield start, free
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Kind, start and end of each base span by kind, then start; a match that fails its check is dropped."""
    found = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m.groups()]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            found.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(DIGIT.findall(m.group())) <= 15:
                found.append((3, m.start(), m.end()))
    return found


# --- the field -------------------------------------------------------------------------------

SLOTS = (256, 24, 128, 50, 64, 64, 24)
WIDTH = sum(SLOTS)
_SHAPE = [(re.compile(r"[0-9]+"), "d"), (re.compile(r"[a-z\x80-\U0010ffff]+"), "a"), (re.compile(r"[A-Z]+"), "A")]
_STRIP = re.compile(r"[^0-9A-Za-z@]+")


def _bucket(text: str, n: int) -> int:
    return zlib.crc32(text.encode()) % n


def node_features(word: str, before: str, after: str) -> list[int]:
    """One active feature per slot: shape, digits, first character, marks, both neighbours, length."""
    shape = word
    for pattern, letter in _SHAPE:
        shape = pattern.sub(letter, shape)
    n = len(DIGIT.findall(word))
    marks = min(word.count("."), 4) * 10 + ("@" in word) * 5 + min(word.count("-"), 4)
    plain = lambda x: x.lower() if x and not DIGIT.search(x) else "0"
    values = (_bucket(shape[:200], 256), min(n, 23), ord(word[0]) % 128, marks, _bucket(plain(before), 64),
              _bucket(plain(after), 64), min(len(word), 23))
    out, base = [], 0
    for value, slot in zip(values, SLOTS, strict=True):
        out.append(base + value)
        base += slot
    return out


def nodes_of(words: list[tuple[int, int]], text: str, picked: list[int]):
    """Features of the picked words, chain links (next word only) and skip links of one document."""
    feats, chain, skip, last = [], [], [], {}
    for k, w in enumerate(picked):
        a, b = words[w]
        word = text[a:b]
        before = text[words[w - 1][0]:words[w - 1][1]] if w else ""
        after = text[words[w + 1][0]:words[w + 1][1]] if w + 1 < len(words) else ""
        feats.append(node_features(word, before[-40:], after[:40]))
        if k and picked[k - 1] == w - 1:
            chain.append((k - 1, k))
        plain = _STRIP.sub("", word).lower()
        digits = "".join(DIGIT.findall(word))
        for key in {plain, digits if len(digits) >= 4 else plain}:
            if key in last:
                skip.append((last[key], k))
            last[key] = k
    return feats, chain, skip


def marginals(unary: np.ndarray, chain: np.ndarray, skip: np.ndarray, step: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Label probabilities by loopy sum-product; ``step`` and ``same`` are log potentials of both kinds of links."""
    n, k = unary.shape
    edges = np.concatenate([chain, skip]).reshape(-1, 2).astype(np.int64)
    if not len(edges):
        p = np.exp(unary - unary.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)
    potential = np.concatenate([np.repeat(step[None], len(chain), 0), np.repeat(same[None], len(skip), 0)])
    source = np.concatenate([edges[:, 0], edges[:, 1]])
    target = np.concatenate([edges[:, 1], edges[:, 0]])
    both = np.concatenate([potential, potential.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
    message = np.zeros((len(source), k))
    for _ in range(ROUNDS):
        belief = unary.copy()
        np.add.at(belief, target, message)
        cavity = belief[source] - message[back]
        fresh = np.logaddexp.reduce(cavity[:, :, None] + both, axis=1)
        fresh -= np.logaddexp.reduce(fresh, axis=1, keepdims=True)
        done = np.abs(fresh - message).max() < 1e-3
        message = 0.5 * message + 0.5 * fresh
        if done:
            break
    belief = unary.copy()
    np.add.at(belief, target, message)
    belief -= np.logaddexp.reduce(belief, axis=1, keepdims=True)
    return np.exp(belief)


def fit_field(documents: list[str], steps: int = 250) -> dict:
    """Weights that maximise the pseudo-likelihood of the base spans' labels, with a small quadratic penalty."""
    k = len(KINDS) + 1
    feats, chain, skip, label = [], [], [], []
    for text in documents:
        words, picked = _words(text)
        f, c, s = nodes_of(words, text, picked)
        at = len(label)
        chain += [(a + at, b + at) for a, b in c]
        skip += [(a + at, b + at) for a, b in s]
        feats += f
        covers = base_spans(text)
        for w in picked:
            a, b = words[w]
            label.append(next((kind + 1 for kind, x, y in covers if x < b and a < y), 0))
    model = {"w": np.zeros((WIDTH, k)), "step": np.zeros((k, k)), "same": np.zeros((k, k))}
    if not label:
        model["w"][:, 0] = 1.0
        return model
    x, y = np.array(feats), np.array(label)
    own = np.eye(k)[y]
    pairs = {"step": np.array(chain, np.int64).reshape(-1, 2), "same": np.array(skip, np.int64).reshape(-1, 2)}
    moment = {n: (np.zeros_like(v), np.zeros_like(v)) for n, v in model.items()}
    for t in range(1, steps + 1):
        score = model["w"][x].sum(axis=1)
        for n, e in pairs.items():
            np.add.at(score, e[:, 1], model[n][y[e[:, 0]]])
            np.add.at(score, e[:, 0], model[n][:, y[e[:, 1]]].T)
        p = np.exp(score - np.logaddexp.reduce(score, axis=1, keepdims=True))
        delta = (own - p) / len(y)
        grad = {"w": np.zeros_like(model["w"])}
        for slot in range(x.shape[1]):
            np.add.at(grad["w"], x[:, slot], delta)
        for n, e in pairs.items():
            grad[n] = own[e[:, 0]].T @ delta[e[:, 1]] + delta[e[:, 0]].T @ own[e[:, 1]]
        for n in model:
            g = grad[n] - 1e-5 * model[n]
            m, v = moment[n]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            model[n] += 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return model


def _words(text: str) -> tuple[list[tuple[int, int]], list[int]]:
    """Spans of all words in code points, and which of them are nodes."""
    words = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    return words, [k for k, (a, b) in enumerate(words) if "@" in text[a:b] or DIGIT.search(text, a, b)]


_NODE = np.zeros(256, bool)
_NODE[[*range(48, 58), 64]] = True


def documents_with_nodes(batch: pa.RecordBatch) -> np.ndarray:
    """Rows whose text has a digit or an ``@``; no other can have a span of any kind."""
    data, offsets = texts(batch.column("text"))
    total = np.concatenate([[0], np.cumsum(_NODE[data])])
    return np.flatnonzero(total[offsets[1:]] > total[offsets[:-1]])


def added_spans(model: dict, documents: list[str], base: list[list[tuple[int, int, int]]], certain: float = CERTAIN):
    """Further spans of each document: certain nodes beside the base spans; touching words of a kind are one span."""
    k = len(KINDS) + 1
    feats, chain, skip, places = [], [], [], []
    for d, text in enumerate(documents):
        words, picked = _words(text)
        f, c, s = nodes_of(words, text, picked)
        at = len(places)
        chain += [(a + at, b + at) for a, b in c]
        skip += [(a + at, b + at) for a, b in s]
        feats += f
        places += [(d, w, *words[w]) for w in picked]
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    if not places:
        return out
    unary = model["w"][np.array(feats)].sum(axis=1)
    p = marginals(unary.reshape(-1, k), np.array(chain, np.int64).reshape(-1, 2), np.array(skip, np.int64).reshape(-1, 2),
                  model["step"], model["same"])
    best, sure = p[:, 1:].argmax(axis=1), p[:, 1:].max(axis=1)
    last = (-1, -1, -1)
    for i in np.flatnonzero(sure >= certain).tolist():
        d, w, a, b = places[i]
        kind = int(best[i])
        a, b = _trim(documents[d], a, b)
        if a >= b or any(x < b and a < y for _, x, y in base[d]):
            continue
        if last == (d, w - 1, kind):
            out[d][-1] = (kind, out[d][-1][1], b)
        else:
            out[d].append((kind, a, b))
        last = (d, w, kind)
    return out


def _trim(text: str, a: int, b: int) -> tuple[int, int]:
    """Without marks at either end."""
    while b > a and text[b - 1] in ".,;:!?\"'":
        b -= 1
    while a < b and text[a] in ",;:!?\"'":
        a += 1
    return a, b


def fit_pii(docs: DataFrame, max_rows: int = MAX_FIT_ROWS) -> dict:
    """Fit the field on about ``max_rows`` documents, drawn by a hash of the text among those with a digit or ``@``."""
    some = docs.select("text").filter(F.col("text").rlike("[0-9@]"))
    n = some.count()
    if not n:
        return fit_field([])
    edge = int(min(1.0, max_rows / n) * (1 << 30))
    rows = some.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < edge).collect()
    return fit_field([r[0] for r in sorted(rows)])


def find_pii(docs: DataFrame, model: dict | None = None, into: tuple[str, str] = ("base", "spans")) -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of kind, start, end (code points, end exclusive), by kind, then start.

    ``spans`` holds the base spans and what the field adds. A null or empty text has none; columns of the input with
    these two names (``into``) are replaced.
    """
    docs = docs.drop(*into)
    unpack = share(docs.sparkSession, fit_pii(docs) if model is None else model)
    span = StructType().add("kind", StringType()).add("start", "long").add("end", "long")
    schema = StructType(list(docs.schema.fields)).add(into[0], ArrayType(span)).add(into[1], ArrayType(span))
    names = schema.names
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        model = unpack()
        for batch in batches:
            for part in pieces(batch):
                base, every = [[] for _ in range(part.num_rows)], [[] for _ in range(part.num_rows)]
                at = documents_with_nodes(part).tolist()
                documents = part.column("text").take(pa.array(at, pa.int64())).to_pylist()
                first = [base_spans(text) for text in documents]
                for i, own, more in zip(at, first, added_spans(model, documents, first), strict=True):
                    base[i] = [(KINDS[k], a, b) for k, a, b in sorted(own)]
                    every[i] = [(KINDS[k], a, b) for k, a, b in sorted(own + more)]
                as_rows = lambda x: pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in r] for r in x], kind)
                yield pa.RecordBatch.from_arrays([*part.columns, as_rows(base), as_rows(every)], names)
    return docs.mapInArrow(run, schema)


def joined(spans: str):
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """``docs`` with each span of personal data replaced by its kind in brackets; ``n_chars`` follows if there is one."""
    base, every = unused(docs.columns, "_base_spans", "_all_spans")
    found = find_pii(docs, model, (base, every))
    names, schema = docs.columns, docs.schema

    def run(batches):
        for batch in batches:
            column, spans = batch.column("text"), batch.column(every)
            out = column.to_pylist()
            for i in np.flatnonzero(np.asarray(spans.value_lengths()) > 0).tolist():
                text, free, kept = out[i], 0, []
                for s in sorted(spans[i].as_py(), key=lambda s: (s["start"], -s["end"])):
                    if s["end"] > free:
                        if s["start"] >= free:
                            kept += [text[free:s["start"]], f"[{s['kind'].upper()}]"]
                        free = s["end"]
                out[i] = "".join([*kept, text[free:]])
            columns = dict(zip(batch.schema.names, batch.columns, strict=True)) | {"text": pa.array(out, pa.string())}
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)
    clean = found.drop(base).mapInArrow(run, schema)
    if "n_chars" in names:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        clean = clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))
    return clean


def op2_pii(spark, sf_dir: str) -> DataFrame:
    found = find_pii(read(spark, sf_dir, "documents").select("doc_id", "text"))
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *(number(k).alias(f"n_{k}") for k in KINDS),
                        F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
