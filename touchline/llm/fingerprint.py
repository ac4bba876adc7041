"""Order MinHash fingerprints: signatures that feel moved text as well as changed text.

Every 8-byte gram of a text is numbered by occurrence, and the numbered grams are put into a random order by a hash. From
each of 64 evenly spaced places in that order the next two grams are taken, put back into text order and hashed as a
tuple. Two texts agree in a component if they share the two grams in the same order.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from touchline.llm.text import GOLD, mix, partitions, read, stored

GRAM, COMPONENTS, TUPLE = 8, 64, 2
_LOW = np.uint64((1 << 24) - 1)
_BINS = np.arange(COMPONENTS, dtype=np.uint64) << np.uint64(64 - 6)


def _ordered(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The upper 40 bits of the values in order, and where each stood; ties in text order."""
    n = len(value)
    if n <= int(_LOW):
        packed = np.sort((value & ~_LOW) | np.arange(n, dtype=np.uint64))
        return packed & ~_LOW, (packed & _LOW).astype(np.int64)
    high = value & ~_LOW
    order = np.argsort(high, kind="stable")
    return high[order], order


def signature(data: bytes) -> np.ndarray:
    """64 components of 16 bits. A text shorter than a gram is one gram; an empty text has all zeros."""
    if not data:
        return np.zeros(COMPONENTS, np.uint16)
    raw = np.frombuffer(data.ljust(GRAM, b"\0"), np.uint8)
    gram = mix(np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(raw, GRAM)).view(np.uint64).ravel() + GOLD)
    value, place = _ordered(gram)
    fresh = np.ones(len(value), bool)
    fresh[1:] = value[1:] != value[:-1]
    first = np.flatnonzero(fresh)
    occurrence = np.arange(len(value)) - np.repeat(first, np.diff(np.append(first, len(value))))
    rank, order = _ordered(mix(value + occurrence.astype(np.uint64) * GOLD))
    at = (np.searchsorted(rank, _BINS)[:, None] + np.arange(TUPLE)) % len(rank)
    chosen = np.sort(place[order[at]], axis=1)  # text order
    out = np.zeros(COMPONENTS, np.uint64)
    for k in range(TUPLE):
        out = mix(out * GOLD + gram[chosen[:, k]])
    return (out >> np.uint64(48)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal components; an empty text is like another empty text only."""
    if a.any() != b.any():
        return 0.0
    return float((a == b).mean())


def _hex(s: np.ndarray) -> str:
    return s.astype(">u2").tobytes().hex()


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` with ``fingerprint``; null and empty texts have the fingerprint of the empty text."""
    docs = docs.drop("fingerprint")
    names = [*docs.columns, "fingerprint"]
    schema = StructType(list(docs.schema.fields)).add("fingerprint", "string")

    def run(batches):
        for batch in batches:
            marks = [_hex(signature((t or "").encode())) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(marks, pa.string())], names)
    return docs.mapInArrow(run, schema)


_FIELDS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_DDL = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")


def _compare(doc_id, text: str, own: np.ndarray, next_text: str, next_sig: np.ndarray) -> tuple:
    half = len(text) // 2
    edited = (text[:len(text) - half] + next_text[:half]).encode()
    changed = signature(edited)
    return (doc_id, len(text), hashlib.sha256(edited).hexdigest(), _hex(own), _hex(changed), likeness(own, changed),
            likeness(own, next_sig))


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprint each text, its edited text and the likeness of both, and of the next document.

    The next document is the one with the next lower id (null ids come last, equal ids by a hash of the text; after the
    last comes the first). In the edited text the last half of the code points gives way to the beginning of the next
    document. The texts move once, into ranges of ids; only the ends of the ranges are matched afterwards. A null text is
    empty; a single document is its own next; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    order = [F.col("doc_id").desc_nulls_last(), F.col("_h").asc()]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("_h", F.xxhash64("text"))
    ranged = rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).select("doc_id", "text")
    names = ["kind", "part", *_FIELDS, "text"]
    types = [pa.int32(), pa.int32(), *_TYPES, pa.string()]

    def block(lines):
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in lines], t) for k, t in enumerate(types)], names)

    def run(batches):
        part, held, out = TaskContext.get().partitionId(), None, []
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                own = signature(text.encode())
                if held is None:
                    out.append((1, part, doc_id, *[None] * 6, text))
                else:
                    out.append((0, part, *_compare(*held, text, own), None))
                held = (doc_id, text, own)
                if len(out) >= 500:
                    yield block(out)
                    out = []
        if held is not None:
            out.append((2, part, held[0], *[None] * 6, held[1]))
        if out:
            yield block(out)
    done = stored(ranged.mapInArrow(run, f"kind int, part int, {_DDL}, text string"), "fingerprints")
    parts = sorted(r[0] for r in done.filter("kind = 1").select("part").collect())  # one number per range
    follows = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1], strict=True)), "part int, next int")
    ends = (done.filter("kind = 2").select("part", "doc_id", "text").join(follows, "part")
            .join(done.filter("kind = 1").select(F.col("part").alias("next"), F.col("text").alias("next_text")), "next"))

    def match(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "text", "next_text")]
            lines = [_compare(d, a, signature(a.encode()), b, signature(b.encode())) for d, a, b in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in lines], t) for k, t in enumerate(_TYPES)], _FIELDS)
    return done.filter("kind = 0").select(*_FIELDS).union(ends.mapInArrow(match, _DDL))


def op5_fingerprints(spark, sf_dir: str) -> DataFrame:
    return compare_with_next(read(spark, sf_dir, "documents"))
