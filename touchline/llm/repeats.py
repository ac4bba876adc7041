"""Repeated passages: bytes covered by a string of ``length`` bytes that also starts anywhere else.

Every window of ``length`` bytes has an anchor, the least of its 64-byte hashes; equal windows have equal anchors at equal
places. Stretches of windows with one anchor are counted by anchor and content, with sums before the shuffle, so groups of
copies vanish at once: what occurs twice is marked. Only where an anchor has different stretches do their bytes move. They
meet in run-length indexes: a run-compressed Burrows-Wheeler transform with the text positions of its run ends. Match lengths
with the neighbours in suffix order are computed at those positions only and streamed to all others, each one shorter than
the one before.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.text import GOLD, _BYTE, mix, pieces, read, signed, stored, texts

LENGTH = 400
GRAM = 64
MOST_STRETCHES = 1_500  # different stretches of one anchor that share an index; more are compared block by block
INDEX_BYTES = 1 << 19
SLICE = 4 << 20

_STEP = np.uint64(0xD6E8FEB86659FD93)
_PLACE_BITS = 21


def gram_hashes(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """Scrambled hash of the ``size`` (a power of two) bytes from each position."""
    h, width, factor = _BYTE[data], 1, int(_STEP)
    while width < size:
        h = h[:-width] * np.uint64(factor) + h[width:]
        factor = (factor * factor * int(GOLD) | 1) % (1 << 64)
        width *= 2
    return mix(h)


def prefix_sums(data: np.ndarray, factor: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Sums and inverse powers that give the hash of any substring."""
    n = len(data)
    power = np.ones(n + 1, np.uint64)
    power[1:] = factor
    np.multiply.accumulate(power, out=power)
    inverse = np.ones(n + 1, np.uint64)
    inverse[1:] = np.uint64(pow(int(factor), -1, 1 << 64))
    np.multiply.accumulate(inverse, out=inverse)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * power[:-1], out=sums[1:])
    return sums, inverse


def substring_hashes(sums: np.ndarray, inverse: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64) * GOLD)


def stretches(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH):
    """Stretches of window starts with one anchor: row, first start, last start (both in ``data``), anchor, content hash.

    The content is what the windows of the stretch cover, with the place of the anchor in it.
    """
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty, empty, empty, empty.view(np.uint64), empty.view(np.uint64)
    gram = min(GRAM, 1 << (length.bit_length() - 1))
    value = gram_hashes(data, gram)
    n = len(value)
    low = np.uint64((1 << 24) - 1)
    best = (value & ~low) | np.arange(n, dtype=np.uint64)  # ties go to the first
    width, span = 1, length - gram + 1
    while width * 2 <= span:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    if width < span:
        best = np.minimum(best[:len(best) - (span - width)], best[span - width:])
    starts = len(data) - length + 1
    place = (best[:starts] & low).astype(np.int64)
    row = np.searchsorted(offsets, np.arange(starts), "right") - 1
    valid = np.arange(starts) + length <= offsets[row + 1]
    new = np.ones(starts, bool)
    new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1]) | ~valid[:-1]
    begin = np.flatnonzero(new & valid)
    stop = np.ones(starts, bool)
    stop[:-1] = new[1:] | ~valid[1:]
    last = np.flatnonzero(stop & valid)
    sums, inverse = prefix_sums(data, _STEP)
    content = substring_hashes(sums, inverse, begin, last + length)
    at = place[begin]
    return row[begin], begin, last, value[at], mix(content + (at - begin).astype(np.uint64) * GOLD)


def slices(batch: pa.RecordBatch, length: int):
    """Bytes and offsets of whole rows; a row above ``SLICE`` bytes comes in parts that share length - 1 bytes.

    Yields bytes, offsets, the row of each part, and where the part starts in its row.
    """
    at = 0
    for part in pieces(batch):
        data, offsets = texts(part.column("text"))
        n = part.num_rows
        if n == 1 and len(data) > SLICE:
            for first in range(0, len(data) - length + 1, SLICE - length + 1):
                own = data[first:first + SLICE]
                yield own, np.array([0, len(own)]), np.array([at]), first
                if first + SLICE >= len(data):
                    break
        else:
            yield data, offsets, np.arange(at, at + n), 0
        at += n


def anchors(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``anchor, content, doc_id, h, lo, hi`` of each stretch; lo and hi are its first and last window start."""
    def run(batches):
        for batch in batches:
            ids, marks = batch.column("doc_id"), batch.column("h")
            for data, offsets, rows, first in slices(batch, length):
                row, begin, last, anchor, content = stretches(data, offsets, length)
                if not len(row):
                    continue
                own = pa.array(rows[row])
                start = begin - offsets[row] + first
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(anchor)), pa.array(signed(content)), ids.take(own), marks.take(own), pa.array(start),
                     pa.array(start + (last - begin))], ["anchor", "content", "doc_id", "h", "lo", "hi"])
    return docs.mapInArrow(run, "anchor long, content long, doc_id long, h int, lo long, hi long")


# --- the index -------------------------------------------------------------------------------

class RunLengthIndex:
    """Run-compressed Burrows-Wheeler transform of several strings, with text positions sampled at its run ends."""

    def __init__(self, bodies: list[bytes]):
        size = np.array([len(b) for b in bodies])
        self.text = np.frombuffer(b"".join(bodies), np.uint8)
        n = len(self.text)
        self.begin = np.cumsum(size) - size
        self.end = np.repeat(self.begin + size, size)
        self.ranks: list[tuple[int, np.ndarray]] = []
        order = self._sort(n, int(size.max()) if n else 0)
        # the transform: the byte before each suffix; where a string begins, a mark that never continues a run
        before = np.empty(n, np.int64)
        before[1:] = self.text[:-1]
        fresh = np.zeros(n, bool)
        fresh[self.begin[size > 0]] = True
        bwt, first = before[order], fresh[order]
        cut = np.ones(n, bool)
        cut[1:] = (bwt[1:] != bwt[:-1]) | first[1:] | first[:-1]
        head = np.flatnonzero(cut)
        tail = np.append(head[1:], n) - 1
        self.run_length, self.run_byte = tail - head + 1, bwt[head]
        self.head, self.tail = order[head], order[tail]  # sampled positions
        up, down = head[head > 0], tail[tail < n - 1]
        self.head_match, self.tail_match = np.zeros(len(head), np.int64), np.zeros(len(tail), np.int64)
        self.head_match[head > 0] = self._common(order[up], order[up - 1])
        self.tail_match[tail < n - 1] = self._common(order[down], order[down + 1])

    def _sort(self, n: int, longest: int) -> np.ndarray:
        """Suffix order by doubling; a suffix ends with its string, equal ones stay in text order."""
        position = np.arange(n)
        remaining = self.end - position

        def ahead(x: np.ndarray, k: int) -> np.ndarray:
            """x of the position k further on; 0 beyond the string."""
            out = np.zeros(n, np.int64)
            out[:max(0, n - k)] = x[k:]
            out[remaining <= k] = 0
            return out
        symbol = self.text.astype(np.int64) + 1
        key = np.zeros(n, np.int64)
        for k in range(4):
            key = key << 9 | ahead(symbol, k)
        width = 4
        while True:
            if n < 1 << _PLACE_BITS:  # key and position in one number: sorting numbers is much faster than sorting places
                packed = np.sort(key << _PLACE_BITS | position)
                order, ordered = packed & ((1 << _PLACE_BITS) - 1), packed >> _PLACE_BITS
            else:
                order = np.argsort(key, kind="stable")
                ordered = key[order]
            step = np.ones(n, np.int64)
            step[1:] = ordered[1:] != ordered[:-1]
            rank = np.empty(n, np.int32)
            rank[order] = np.cumsum(step)
            self.ranks.append((width, rank))
            if not n or step.sum() == n or width >= longest:
                return order
            key = rank.astype(np.int64) << (_PLACE_BITS if n < 1 << _PLACE_BITS else 31) | ahead(rank, width)
            width *= 2

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of pairs of suffixes."""
        a, b = a.copy(), b.copy()
        end_a, end_b, start = self.end[a], self.end[b], a.copy()
        n = len(self.text)
        for width, rank in reversed(self.ranks):
            while True:
                able = (a + width <= end_a) & (b + width <= end_b)
                same = np.zeros(len(a), bool)
                same[able] = rank[a[able]] == rank[b[able]]
                a[same] += width
                b[same] += width
                if width != self.ranks[-1][0] or not same.any():
                    break
        for _ in range(4):
            able = (a < end_a) & (b < end_b)
            same = np.zeros(len(a), bool)
            same[able] = self.text[np.minimum(a[able], n - 1)] == self.text[np.minimum(b[able], n - 1)]
            a[same] += 1
            b[same] += 1
        return a - start

    def matching_statistics(self) -> np.ndarray:
        """For each position, the longest match with any other position.

        It lies with a neighbour in suffix order. Inside a run of the transform that neighbour moves along with the
        position, so the length falls by one per step from the last sampled run end.
        """
        out = np.zeros(len(self.text), np.int64)
        for where, match in ((self.head, self.head_match), (self.tail, self.tail_match)):
            reach = np.full(len(self.text), -1)
            reach[where] = where
            np.maximum.accumulate(reach, out=reach)
            value = np.zeros(len(self.text), np.int64)
            value[where] = match
            out = np.maximum(out, value[reach] - (np.arange(len(self.text)) - reach))
        return out


def _true_runs(flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], flag.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def long_matches(bodies: list[bytes], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """Per string, the parts covered by ``length``-byte strings that also start elsewhere in any of them."""
    index = RunLengthIndex(bodies)
    start, stop = _true_runs(index.matching_statistics() >= length)
    out: list[list[tuple[int, int]]] = [[] for _ in bodies]
    which = np.searchsorted(index.begin, start, "right") - 1
    for k, a, b in zip(which.tolist(), start.tolist(), stop.tolist(), strict=True):
        base = int(index.begin[k])
        out[k].append((a - base, b - 1 - base + length))
    return out


def crowded_spans(bodies: DataFrame, length: int) -> DataFrame:
    """Repeated spans of stretches whose anchor has too many different ones for an index; no task meets the whole group.

    Windows are taken in blocks by their distance to the anchor. If what all windows of a block have in common occurs once
    in the group, none of them is repeated; if what they cover together occurs twice, all are. Only blocks between the two
    are cut into smaller ones, down to single windows.
    """
    kind = ("anchor long, doc_id long, h int, lo long, alone boolean, first int, block int, core long, whole long, "
            "n int, body binary")
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int64(), pa.int64(),
             pa.int32(), pa.binary())
    names = [x.split()[0] for x in kind.split(", ")]

    def split(width):
        def run(batches):
            for batch in batches:
                out = []
                for anchor, doc_id, h, lo, alone, first, body in zip(
                        *(batch.column(c).to_pylist() for c in ("anchor", "doc_id", "h", "lo", "alone", "first", "body")), strict=True):
                    data = np.frombuffer(body, np.uint8)
                    windows = len(body) - length + 1
                    if first is None:  # distance of the first window to the anchor: the first such gram in the last window
                        last = data[windows - 1:]
                        gram = signed(gram_hashes(last, min(GRAM, 1 << (length.bit_length() - 1))))
                        first = windows - 1 + int(np.flatnonzero(gram == anchor)[0])
                    sums, inverse = prefix_sums(data, _STEP)
                    for k in range((first - windows + 1) // width, first // width + 1):
                        low, high = max(k * width, first - windows + 1), min(k * width + width - 1, first)
                        ends = np.array([[first - k * width, first - (k + 1) * width + 1 + length],
                                         [first - high, first - low + length]])
                        core, whole = signed(substring_hashes(sums, inverse, ends[:, 0], ends[:, 1])).tolist()
                        out.append((anchor, doc_id, h, lo + first - high, alone, high, k, core,
                                    whole if high - low + 1 == width else None, high - low + 1,
                                    body[first - high:first - low + length]))
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)
        return run
    left = bodies.withColumn("first", F.lit(None).cast("int"))
    found = None
    for width in (w for w in (64, 16, 4, 1) if w == 1 or 2 * w <= length):
        blocks = stored(left.mapInArrow(split(width), kind), "blocks")
        shared = blocks.groupBy("anchor", "block", "core").agg(F.count("*").alias("m")).filter("m > 1").drop("m")
        twice = (blocks.filter("whole IS NOT NULL").groupBy("anchor", "block", "whole").agg(F.count("*").alias("m"))
                 .filter("m > 1"))
        open_ = blocks.join(shared, ["anchor", "block", "core"]).join(twice, ["anchor", "block", "whole"], "left")
        open_ = stored(open_, "open_blocks")
        done = open_.filter("m IS NOT NULL AND alone").select("doc_id", "h", "lo", (F.col("lo") + F.col("n") - 1 + length).alias("hi"))
        found = done if found is None else found.union(done)
        # one of each settled content stays as a partner for those that are cut smaller
        settled = open_.filter("m IS NOT NULL").dropDuplicates(["anchor", "block", "whole"]).withColumn("alone", F.lit(False))
        left = open_.filter("m IS NULL").unionByName(settled).select("anchor", "doc_id", "h", "lo", "alone", "first", "body")
    return found


def repeated_spans(docs: DataFrame, length: int = LENGTH, most: int = MOST_STRETCHES) -> DataFrame:
    """``doc_id, h, lo, hi``: byte spans covered by repeated windows (they may overlap)."""
    found = stored(anchors(docs, length), "anchors")
    groups = found.groupBy("anchor", "content").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "h", "lo")).alias("rep"))
    groups = stored(groups, "stretches")
    per_anchor = groups.groupBy("anchor").agg(F.sum("n").alias("all"), F.count("*").alias("kinds")).filter("all > 1")
    shared = stored(groups.join(per_anchor, "anchor"), "shared")
    placed = found.join(shared.select("anchor", "content", "n", "rep", "kinds"), ["anchor", "content"])
    placed = stored(placed.withColumn("lead", F.col("n").eqNullSafe(1) | (
        F.col("rep.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("rep.h") == F.col("h")) & (F.col("rep.lo") == F.col("lo"))))
        .drop("rep"), "placed")
    copies = placed.filter("n > 1").select("doc_id", "h", "lo", (F.col("hi") + length).alias("hi"))

    # stretches to compare: one of each content, with their bytes
    wanted = (placed.filter("lead AND kinds > 1").dropDuplicates(["anchor", "content"])
              .groupBy("doc_id", "h").agg(F.collect_list(F.struct("anchor", "lo", "hi", F.expr("n = 1").alias("alone"),
                                                                 (F.col("kinds") > most).alias("crowd"))).alias("parts")))
    wanted = wanted.select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"), "parts")
    held = docs.dropDuplicates(["doc_id", "h"]).join(
        wanted, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_h"))).drop("_d", "_h")

    def cut(batches):
        for batch in batches:
            for part in pieces(batch):
                data, offsets = texts(part.column("text"))
                lists = part.column("parts")
                parts = lists.flatten()
                owner = np.repeat(np.arange(part.num_rows), np.asarray(lists.value_lengths()))
                lo = offsets[owner] + parts.field("lo").to_numpy()
                hi = offsets[owner] + parts.field("hi").to_numpy() + length
                own = pa.array(owner)
                bodies = pa.array([data[a:b].tobytes() for a, b in zip(lo.tolist(), hi.tolist(), strict=True)], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [parts.field("anchor"), part.column("doc_id").take(own), part.column("h").take(own), parts.field("lo"),
                     parts.field("alone"), parts.field("crowd"), bodies],
                    ["anchor", "doc_id", "h", "lo", "alone", "crowd", "body"])
    kind = "anchor long, doc_id long, h int, lo long, alone boolean, crowd boolean, body binary"
    bodies = stored(held.mapInArrow(cut, kind), "bodies")

    def index(batches):
        waiting, size, anchor = [], 0, None

        def flush():
            spans = long_matches([r[4] for r in waiting], length)
            rows = [(r[0], r[1], r[2] + a, r[2] + b) for r, own in zip(waiting, spans, strict=True) if r[3] for a, b in own]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in
                                               enumerate((pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                                              ["doc_id", "h", "lo", "hi"])
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("anchor", "doc_id", "h", "lo", "alone", "body")]
            for a, *r in zip(*columns, strict=True):
                if size >= INDEX_BYTES and a != anchor:
                    yield flush()
                    waiting, size = [], 0
                anchor = a
                waiting.append(r)
                size += len(r[4])
        if waiting:
            yield flush()
    few = bodies.filter("NOT crowd").repartition("anchor").sortWithinPartitions("anchor")
    matched = few.drop("crowd").mapInArrow(index, "doc_id long, h int, lo long, hi long")

    return copies.union(matched).union(crowded_spans(bodies.filter("crowd").drop("crowd"), length))


def with_mark(docs: DataFrame) -> DataFrame:
    """``doc_id, text, h``: with ``h``, rows are told apart even if ids are null or repeated; equal rows are copies anyway."""
    return docs.select("doc_id", "text", F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("h"))


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row: ``doc_id, n_bytes, kept`` (the remaining bytes), ``spans`` (the maximal removed runs, byte positions).

    A null text is empty. Rows with equal id and text are each other's copies. A text shorter than ``length`` bytes loses
    nothing. An empty table gives an empty table.
    """
    marked = with_mark(docs)
    spans = (repeated_spans(marked, length).groupBy("doc_id", "h").agg(F.collect_set(F.struct("lo", "hi")).alias("found"))
             .select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"), "found"))
    both = marked.join(spans, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_h")), "left").drop("_d", "_h")
    span = "array<struct<lo:bigint,hi:bigint>>"
    kind = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))

    def run(batches):
        for batch in batches:
            for part in pieces(batch):
                data, offsets = texts(part.column("text"))
                found = part.column("found").to_pylist()
                kept, runs = [], []
                for i in range(part.num_rows):
                    own = data[offsets[i]:offsets[i + 1]]
                    keep = np.ones(len(own) + 1, np.int64)
                    if found[i]:
                        delta = np.zeros(len(own) + 1, np.int64)
                        np.add.at(delta, [s["lo"] for s in found[i]], 1)
                        np.add.at(delta, [s["hi"] for s in found[i]], -1)
                        keep = (np.cumsum(delta) == 0).astype(np.int64)
                    kept.append(own[keep[:-1] > 0].tobytes())
                    a, b = _true_runs(keep[:-1] == 0)
                    runs.append([{"lo": x, "hi": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(offsets)), pa.array(kept, pa.binary()), pa.array(runs, kind)],
                    ["doc_id", "n_bytes", "kept", "spans"])
    return both.mapInArrow(run, f"doc_id long, n_bytes long, kept binary, spans {span}")


def op3_repeats(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
