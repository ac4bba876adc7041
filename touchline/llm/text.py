"""Texts as byte arrays, their words and hashes; tables kept in the shared scratch folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it again: lineage ends here."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(columns: list[str], *names: str) -> tuple[str, ...]:
    """The names, each with underscores behind it until the table has no column of that name in any case."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return tuple(out)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_mod(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id as text, mod n; an id of null counts as empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.encode(F.coalesce(col.cast("string"), F.lit("")), "UTF-8")) % n


# --- byte arrays -----------------------------------------------------------------------------

def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows, and where each row starts (one more offset than rows); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string()).cast(pa.large_binary())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, column: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with up to ``most`` bytes of text each; a longer text is a slice of its own."""
    _, offsets = texts(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
        end = min(max(end, at + 1), n)
        yield batch.slice(at, end - at)
        at = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


GOLD = np.uint64(0x9E3779B97F4A7C15)
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * GOLD) | np.uint64(1)


_WEIGHTS: dict[int, np.ndarray] = {}


def _weights(power: int) -> np.ndarray:
    if power not in _WEIGHTS:
        _WEIGHTS[power] = mix(np.arange(1000, 1000 + (1 << power), dtype=np.uint64) * GOLD) | np.uint64(1)
    return _WEIGHTS[power]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each run of non-space bytes; no word crosses a row."""
    word = ~_SPACE[data]
    if not len(word):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(word))]
    first[edge] = word[edge]
    last[edge - 1] = word[edge - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; spans must not overlap and be in order."""
    if not len(start):
        return np.zeros(0, np.uint64)
    length = end - start
    first = np.cumsum(length) - length
    within = np.arange(int(length.sum())) - np.repeat(first, length)
    weights = _weights(max(8, int(length.max() - 1).bit_length()))
    value = _BYTE[data[within + np.repeat(start, length)]] * weights[within]
    return mix(np.add.reduceat(value, first) + length.astype(np.uint64))


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True):
    """Hash and row of every word, and the word spans; A-Z count as a-z if ``lower``."""
    start, end, row = word_spans(data, offsets)
    return span_hashes(_LOWER[data] if lower else data, start, end), row, start, end


def counts_of(row: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(row, minlength=n)[:n]


def share(spark: SparkSession, model: object) -> Callable[[], object]:
    """Broadcast a model of bounded size; the result gives it back inside a task, where it is unpacked once."""
    packed, kept = spark.sparkContext.broadcast(cloudpickle.dumps(model)), []

    def unpacked():
        if not kept:
            kept.append(cloudpickle.loads(packed.value))
        return kept[0]
    return unpacked


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
