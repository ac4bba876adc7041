"""SentencePiece encoding and decoding with a table of distinct chunks.

Where no piece of the vocabulary crosses a whitespace marker, a marked word (markers and what follows them up to the next
marker) is segmented alike wherever it stands. Each task keeps a table of the distinct marked words it has met: a word new to
the table is segmented once by the library, every other occurrence is looked up, and the ids are joined back by position. No
row leaves its task, so nothing is shuffled and a lost task is simply run again. A table that has grown to ``TABLE_BYTES``
is emptied; that changes no result.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.text import pieces, read, share

MARK = "▁"
MODEL = "piece_bpe_32k.model"
TABLE_BYTES = 128 << 20
# A longer word does not stay in the table.
LONGEST = 64
_ENTRY = 200  # bytes that an entry takes besides its key and value
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")


class Encoder:
    """A model with its table; ``encode`` gives what the library gives for each whole text."""

    def __init__(self, model: bytes, table_bytes: int = TABLE_BYTES):
        self.sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        crossing = [p for p in names if re.search(f"[^{MARK}]{MARK}", p)]
        probe = f"a  b{MARK}c\t　ﬁ "
        if crossing or MARK not in names or self.sp.normalize(probe) != (MARK + probe).replace(" ", MARK):
            raise ValueError("pieces cross whitespace markers, or the model changes texts before it segments them")
        self.lone = _packed([[self.sp.piece_to_id(MARK)]])[0]
        self.table_bytes, self.size, self.table = table_bytes, 0, {}

    def encode(self, rows: list[str]) -> list[bytes]:
        """Ids of each text as packed 32-bit numbers."""
        marked = [_CHUNK.findall((MARK + t).replace(" ", MARK)) if t else [] for t in rows]
        words = set(chain.from_iterable(marked))
        if self.size > self.table_bytes:
            self.table, self.size = {}, 0
        fresh = [w for w in words.difference(self.table) if w != MARK]
        found = dict(zip(fresh, _packed(self.sp.encode([w[1:] for w in fresh], num_threads=1)), strict=True))
        found[MARK] = self.lone  # the library has no text for a marker alone
        self.table.update(found)
        out = [b"".join(map(self.table.__getitem__, w)) for w in marked]
        for w in [w for w in found if len(w) > LONGEST]:
            del found[w], self.table[w]
        self.size += sum(len(w) + len(ids) + _ENTRY for w, ids in found.items())
        return out


def _packed(lists: list[list[int]]) -> list[bytes]:
    raw = np.fromiter(chain.from_iterable(lists), np.int32).tobytes()
    cuts = np.cumsum([0, *(4 * len(ids) for ids in lists)]).tolist()
    return [raw[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def _once(spark, path: str | None, make):
    """Make something of the model's bytes, once in each worker."""
    with open(path or public_tokenizers.path(MODEL), "rb") as f:
        packed = share(spark, f.read())
    kept = []

    def made():
        if not kept:
            kept.append(make(packed()))
        return kept[0]
    return made


def encode_texts(docs: DataFrame, path: str | None = None, column: str = "text", key: str = "doc_id") -> DataFrame:
    """``key`` and ``ids``, what the library's encode gives for each whole text, without begin or end ids.

    A null or empty text has no ids. Repeated rows and null keys each give a row of their own; an empty table gives an
    empty table; other columns are not read, whatever their names. ``path`` is the model's file on the driver.
    """
    encoder = _once(docs.sparkSession, path, Encoder)

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "_text"):
                rows = encoder().encode([t or "" for t in part.column("_text").to_pylist()])
                offsets = np.cumsum([0, *map(len, rows)]) // 4
                values = np.frombuffer(b"".join(rows), np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))
                yield pa.RecordBatch.from_arrays([part.column("_key"), ids], ["_key", "ids"])
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("_key"), F.col(column).alias("_text")).mapInArrow(run, f"_key {kind}, ids array<int>")
    return rows.select(F.col("_key").alias(key), "ids")


def decode_ids(encoded: DataFrame, path: str | None = None, key: str = "doc_id") -> DataFrame:
    """``key``, ``ids`` and ``decoded``, what the library's decode gives for each list of ids; null counts as no ids.

    Decoding is a plain look-up per id, so the library does it for about a million ids at a time.
    """
    processor = _once(encoded.sparkSession, path, lambda model: sentencepiece.SentencePieceProcessor(model_proto=model))

    def run(batches):
        for batch in batches:
            ends = np.cumsum(batch.column("ids").value_lengths().to_numpy(zero_copy_only=False))
            at, done = 0, 0
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(ends, done + (1 << 20), "right")))
                part, done = batch.slice(at, end - at), int(ends[end - 1])
                decoded = pa.array(processor().decode(part.column("ids").to_pylist()), pa.string())
                yield pa.RecordBatch.from_arrays([part.column("_key"), part.column("ids"), decoded], ["_key", "ids", "decoded"])
                at = end
    kind = encoded.schema[key].dataType.simpleString()
    rows = encoded.select(F.col(key).alias("_key"), F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
    return rows.mapInArrow(run, f"_key {kind}, ids array<int>, decoded string").select(F.col("_key").alias(key), "ids", "decoded")


def op12_sentencepiece(spark, sf_dir: str) -> DataFrame:
    done = decode_ids(encode_texts(read(spark, sf_dir, "documents")))
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
