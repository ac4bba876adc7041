"""Near-duplicates: MinHash bands propose, odd sketches sift, full shingle sets decide.

Documents with equal shingle sets form a class with one representative. MinHash samples of the representatives give band
keys, and are folded into a parity bitmap (odd sketch): the population count of two bitmaps' XOR estimates how many samples
differ. Within a bucket every member is held against one pivot, never against all others; only where members stay in
different components are they compared further, block by block. What passes the sketch is confirmed on full sets.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.text import GOLD, counts_of, mix, pieces, read, signed, stored, texts, word_hashes

BANDS, ROWS = 32, 5
SKETCH_WORDS = 8
PERCENT = 80
BLOCK = 400_000  # shingles in one block of a family
BITS, MOST_BITS = 32, 1 << 28  # bits per wanted id of a bitmap, and in all

_KEYS = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * GOLD) | np.uint64(1)


def shingles(words: np.ndarray, row: np.ndarray, n_rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct ``size``-word shingles row by row, and their number per row.

    A row with fewer words has its whole sequence as the one shingle; a row without words has none.
    """
    per_row = counts_of(row, n_rows)
    start = np.cumsum(per_row) - per_row
    out, number = [], np.zeros(n_rows, np.int64)
    if len(words) >= size:
        acc = np.zeros(len(words) - size + 1, np.uint64)
        for j in range(size):
            acc = mix(acc * GOLD + words[j:len(words) - size + 1 + j])
    for i in np.flatnonzero(per_row):
        a, n = start[i], per_row[i]
        if n >= size:
            found = np.unique(acc[a:a + n - size + 1])
        else:
            found = np.full(1, n, np.uint64)
            for w in words[a:a + n]:
                found = mix(found * GOLD + w)
        number[i] = len(found)
        out.append(found)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), number


def min_samples(values: np.ndarray, number: np.ndarray) -> np.ndarray:
    """MinHash samples of the non-empty rows, one line per sample."""
    first = (np.cumsum(number) - number)[number > 0]
    out = np.empty((BANDS * ROWS, len(first)), np.uint64)
    for k in range(BANDS * ROWS):
        out[k] = np.minimum.reduceat((values ^ _KEYS[2 * k]) * _KEYS[2 * k + 1], first) if len(first) else 0
    return out


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """Parity of the samples that fall on each of 512 bits, as words of 64 bits; one line per row."""
    bits = 64 * SKETCH_WORDS
    place = (mix(samples + _KEYS[::2, None]) % np.uint64(bits)).astype(np.int64)
    n = samples.shape[1]
    parity = (np.bincount((place + np.arange(n) * bits).ravel(), minlength=n * bits) & 1).astype(np.uint8)
    return np.packbits(parity.reshape(n, bits), axis=1).view(np.uint64)


def sketch_limit(percent: int = PERCENT, sigmas: float = 6) -> int:
    """XOR bits up to which a pair may still be similar: six deviations above the mean of a pair at the limit."""
    k, j = BANDS * ROWS, percent / 100
    differ = k * (1 - j) + sigmas * (k * j * (1 - j)) ** 0.5
    bits = 64 * SKETCH_WORDS
    return int(bits / 2 * (1 - (1 - 2 / bits) ** (2 * differ)) + sigmas)


def _lists(values: np.ndarray, per_row: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(per_row) + 1, np.int32)
    np.cumsum(per_row, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed(np.ascontiguousarray(values).ravel())))


def marks(docs: DataFrame, size: int) -> DataFrame:
    """Per row: ``doc_id, n`` (set size), ``s1, s2`` (what identifies the set), ``bands``, ``sketch``."""
    def run(batches):
        for batch in batches:
            for part in pieces(batch):
                words, row, _, _ = word_hashes(*texts(part.column("text")))
                values, number = shingles(words, row, part.num_rows, size)
                full = number > 0
                sums = np.zeros((2, part.num_rows), np.uint64)
                keys = np.zeros((0, BANDS), np.uint64)
                sketch = np.zeros((0, SKETCH_WORDS), np.uint64)
                if full.any():
                    first = (np.cumsum(number) - number)[full]
                    sums[0, full] = np.add.reduceat(mix(values), first)
                    sums[1, full] = np.add.reduceat(mix(values ^ _KEYS[0]), first)
                    samples = min_samples(values, number)
                    acc = np.repeat(_KEYS[:BANDS, None], samples.shape[1], axis=1)
                    for r in range(ROWS):
                        acc = mix(acc * GOLD + samples[r::ROWS])
                    keys, sketch = acc.T, odd_sketch(samples)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array(number), pa.array(signed(sums[0])),
                     pa.array(signed(sums[1])), _lists(keys, full * BANDS), _lists(sketch, full * SKETCH_WORDS)],
                    ["doc_id", "n", "s1", "s2", "bands", "sketch"])
    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n long, s1 long, s2 long, bands array<long>, sketch array<long>")


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """``doc_id, shingles``: the full set of each row."""
    def run(batches):
        for batch in batches:
            for part in pieces(batch):
                words, row, _, _ = word_hashes(*texts(part.column("text")))
                values, number = shingles(words, row, part.num_rows, size)
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), _lists(values, number)],
                                                 ["doc_id", "shingles"])
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, shingles array<long>")


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for all linked nodes: the least node that each can reach.

    Every node hooks onto its least neighbour, edges are renamed, and what is left is done again. Nothing but a flag
    reaches the driver.
    """
    edges = stored(links.select(F.col("a").alias("u"), F.col("b").alias("v"))
                   .union(links.select(F.col("b").alias("u"), F.col("a").alias("v"))).distinct(), "edges")
    labels = None
    while True:
        hook = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        if labels is None:
            labels = stored(hook.select(F.col("u").alias("node"), F.col("m").alias("label")), "labels")
            hook = labels.select(F.col("node").alias("u"), F.col("label").alias("m"))
        else:
            hook = stored(hook, "hook")
            labels = stored(labels.join(hook, labels.label == hook.u, "left")
                            .select("node", F.coalesce("m", "label").alias("label")), "labels")
        other = hook.select(F.col("u").alias("v"), F.col("m").alias("mv"))
        edges = stored(edges.join(hook, "u").join(other, "v").filter("m <> mv")
                       .select(F.col("m").alias("u"), F.col("mv").alias("v")).distinct(), "edges")
        if not edges.take(1):
            return labels


def _xor_bits(a: str, b: str) -> Column:
    return reduce(lambda x, y: x + y, [F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(SKETCH_WORDS)])


def _similar_sizes(percent: int) -> Column:
    return F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent


def _sift(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` whose sizes and sketches leave the wanted similarity possible."""
    side = lambda x: classes.select(F.col("rep").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.filter(_similar_sizes(percent) & (_xor_bits("sa", "sb") <= sketch_limit(percent))).select("a", "b")


def rows_of(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """``doc_id, text`` of the rows whose id is in a pair, each text of an id once.

    A bitmap of hashed ids goes to all tasks first, so that texts which are in no pair do not move to the join, whatever
    the size of the input. It has at most ``MOST_BITS`` bits; a crowded one only lets more texts move.
    """
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    bits = min(MOST_BITS, 2 * BITS * max(pairs.count(), 1))
    place = F.pmod(F.xxhash64("doc_id"), F.lit(bits)) + 1
    part, at = F.bitmap_bucket_number(place), F.bitmap_bit_position(place)
    bitmap = ids.groupBy(part.alias("part")).agg(F.bitmap_construct_agg(at).alias("bits"))
    byte = F.conv(F.hex(F.substring("bits", F.expr("cast(at div 8 + 1 as int)"), F.lit(1))), 16, 10).cast("int")
    maybe = (docs.select("doc_id", "text", part.alias("part"), at.alias("at")).join(F.broadcast(bitmap), "part")
             .filter(F.getbit(byte, (F.col("at") % 8).cast("int")) == 1))
    # an inner join: a semi join would be pushed below the bitmap
    return maybe.select("doc_id", "text").join(ids, "doc_id").dropDuplicates(["doc_id", "text"])


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach ``percent``."""
    left = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("xb"))
    right = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("xa"))
    common = F.size(F.array_intersect("xa", "xb"))
    return (pairs.join(left, "b").join(right, "a").withColumn("i", common)
            .filter(F.col("i") * 100 >= (F.size("xa") + F.size("xb") - F.col("i")) * percent).select("a", "b"))


def family_names(tested: DataFrame) -> DataFrame:
    """``node, fam`` of all that is in a pair: the least pivot of a node, or the least pivot of that one.

    Families need not be complete: pairs across them are found through their buckets.
    """
    own = tested.groupBy("b").agg(F.min("a").alias("p")).select(F.col("b").alias("node"), "p")
    ends = tested.select(F.col("a").alias("node")).union(tested.select("b")).distinct()
    first = ends.join(own, "node", "left").select("node", F.coalesce("p", "node").alias("p"))
    above = own.select(F.col("node").alias("p"), F.col("p").alias("pp"))
    return first.join(above, "p", "left").select("node", F.coalesce("pp", "p").alias("fam"))


def family_blocks(members: DataFrame) -> DataFrame:
    """``members`` (``rep, fam, label, n, ...``), each once per pair of blocks it is needed in: ``fam, one, two``.

    A family whose members are in several components is cut into blocks of about ``BLOCK`` shingles. Its largest component
    has blocks of its own, which need not meet each other; every other pair of blocks meets in one task.
    """
    sizes = members.groupBy("fam", "label").agg(F.sum("n").alias("k"))
    most = F.max(F.struct("k", "label"))
    split = (sizes.groupBy("fam").agg(F.sum("k").alias("all"), most.alias("main"), F.count("*").alias("kinds"))
             .filter("kinds > 1").select("fam", F.col("main.label").alias("main"),
                                         F.ceil(F.col("main.k") / BLOCK).cast("int").alias("nd"),
                                         F.ceil((F.col("all") - F.col("main.k")) / BLOCK).cast("int").alias("nr")))
    rows = members.join(split, "fam").withColumn("in_main", F.col("label") == F.col("main"))
    draw = F.xxhash64("rep")
    rows = rows.withColumn("own", F.when(F.col("in_main"), F.pmod(draw, "nd") + F.col("nr"))
                           .otherwise(F.pmod(draw, "nr")).cast("int"))
    # blocks below nr hold the rest, the others the largest component
    others = F.when(F.col("in_main"), F.sequence(F.lit(0), F.col("nr") - 1)).otherwise(
        F.sequence(F.lit(0), F.col("nr") + F.col("nd") - 1))
    rows = rows.withColumn("other", F.explode(others))
    return rows.select(*members.columns, F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"))


def _block_links(percent: int):
    """Finds the links between components inside one pair of blocks; what is joined on the way is not compared again."""
    limit = sketch_limit(percent)

    def run(table: pa.Table) -> pa.Table:
        rep, label = table.column("rep").to_numpy(), table.column("label").to_numpy()
        sets = [x.values.to_numpy() for x in table.column("shingles")]
        sketch = table.column("sketch").combine_chunks().flatten().to_numpy().reshape(len(rep), -1).view(np.uint64)
        size = np.array([len(x) for x in sets])
        names, group = np.unique(label, return_inverse=True)
        root = np.arange(len(names))

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x
        found = []
        for i in range(len(rep)):
            bits = np.bitwise_count(sketch[i + 1:] ^ sketch[i]).sum(axis=1)
            near = (bits <= limit) & (group[i + 1:] != group[i])
            near &= np.minimum(size[i + 1:], size[i]) * 100 >= np.maximum(size[i + 1:], size[i]) * percent
            for j in (np.flatnonzero(near) + i + 1).tolist():
                a, b = find(group[i]), find(group[j])
                if a == b:
                    continue
                common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if common * 100 >= (size[i] + size[j] - common) * percent:
                    root[max(a, b)] = min(a, b)
                    found.append((rep[i], rep[j]))
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})
    return run


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = PERCENT) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    Words are lower-cased (A-Z) runs of non-space bytes. A document without words is linked with nothing. Rows that share
    an id count as one document. A row with a null id joins the class of its equal texts only: its component is the
    least id there, or null if there is none, and it is kept only then. Pairs at the limit are missed with a
    probability of (1 - 0.8^5)^32 = 3e-6; a pair below the limit is never linked. An empty table gives an empty table.

    Families are the sifted pairs' pivots with what belongs to them. Links between components of one family are looked for
    block by block, so each set moves once per block and no pair is written out; links between families come from the
    buckets that two of them share.
    """
    marked = stored(marks(docs, size), "marks")
    key = ["n", "s1", "s2"]
    # rows of a class have one set, and so the same bands and sketch
    classes = stored(marked.filter("n > 0 AND doc_id IS NOT NULL").groupBy(*key).agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "classes")
    banded = classes.select("rep", F.explode("bands").alias("band"))
    crowded = banded.groupBy("band").agg(F.min("rep").alias("pivot"), F.max("rep").alias("high")).filter("pivot <> high")
    buckets = stored(banded.join(crowded.select("band", "pivot"), "band"), "buckets")

    pairs = buckets.filter("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    tested = stored(_sift(pairs, classes, percent), "pairs")
    families = stored(family_names(tested), "families")
    member = buckets.join(families, buckets.rep == families.node, "left").select(
        "band", "rep", F.coalesce("fam", "rep").alias("fam"))
    mixed = member.groupBy("band").agg(F.min("fam").alias("low"), F.max("fam").alias("high")).filter("low <> high")
    near = member.join(mixed.select("band"), "band").join(classes.select("rep", "n", "sketch"), "rep")
    side = lambda x: near.select(F.col("band").alias(f"band{x}"), F.col("rep").alias(x), F.col("fam").alias(f"f{x}"),
                                 F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"))
    across = side("a").join(side("b"), (F.col("banda") == F.col("bandb")) & (F.col("a") < F.col("b"))
                            & (F.col("fa") != F.col("fb")) & _similar_sizes(percent)
                            & (_xor_bits("sa", "sb") <= sketch_limit(percent))).select("a", "b").distinct()
    pairs = stored(tested.union(across), "pairs")

    sets = stored(shingle_sets(rows_of(docs, pairs), size), "sets")
    links = stored(confirm(pairs, sets, percent), "links")
    labels = components(links)
    members = (families.join(labels, "node", "left")
               .select(F.col("node").alias("rep"), "fam", F.coalesce("label", "node").alias("label"))
               .join(classes.select("rep", "n", "sketch"), "rep"))
    blocks = family_blocks(members).join(sets.withColumnRenamed("doc_id", "rep"), "rep")
    more = stored(blocks.groupBy("fam", "one", "two").applyInArrow(_block_links(percent), "a long, b long"), "more")
    if more.take(1):  # components that such links hold together
        one = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
        two = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        joined = more.join(one, "a", "left").join(two, "b", "left").select(
            F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")).filter("a <> b").distinct()
        wider = components(joined).select(F.col("node").alias("label"), F.col("label").alias("wide"))
        named = families.select("node").union(labels.select("node")).distinct().join(labels, "node", "left").select(
            "node", F.coalesce("label", "node").alias("label"))
        labels = named.join(wider, "label", "left").select("node", F.coalesce("wide", "label").alias("label"))
    renamed = classes.select(*key, "rep").join(labels, F.col("rep") == F.col("node"), "left").select(
        *key, F.coalesce("label", "rep").alias("comp"))
    out = marked.select("doc_id", *key).join(renamed, key, "left")
    comp = F.coalesce("comp", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), comp.alias("component_id"),
                      F.coalesce(F.col("doc_id") == comp, comp.isNull()).alias("kept"))


def op8_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), size=2)
