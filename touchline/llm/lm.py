"""Language-model scores with backoff, by a weighted automaton.

All words of the training texts are counted, and all longer n-grams that occur ``LEAST`` times, whatever the size of the
input. The model stays in tables and no part of it is broadcast. Texts are kept in chunks of about ``CHUNK_TOKENS`` tokens. A
chunk asks for its distinct n-grams, so a common one is one entry per chunk and no hot key; what the model knows of them is
the chunk's own automaton (``ChunkAutomaton``): a state is a context, its failure arc leads to the context without its first
word, and one left-to-right traversal carries the state and adds up log probabilities. Word counts rest on add-one smoothing.

``learn`` gives the same model as a single automaton for a table whose n-grams fit a driver. With ``min_share`` only n-grams
of that share of the tokens become arcs; with 0, all that occur twice.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.text import GOLD, counts_of, crc_mod, mix, pieces, read, share, signed, stored, texts, word_hashes

ORDER = 3
MIN_SHARE = 1e-5
DISCOUNT = 0.75
COUNT_TOKENS = 2_000_000  # a task counts so many tokens before it hands on what it has
END = np.uint64(0x9E6C63D0876A9A47)
PIECE = 4 << 20
LEAST = 2  # longer n-grams of the whole model occur so often, whatever the size of the input
CHUNK_TOKENS = 600_000  # tokens of one chunk of whole texts
BUCKET_TOKENS = 1_500_000  # tokens of text per bucket of n-grams
MIN_BUCKETS = 16
TABLE_ROWS = 100_000
ROUNDS = 4  # n-grams move in so many parts, one after another; the disk holds the shuffle of one
CHUNK_ROUNDS = 5  # so do chunks and what they ask for
LANE = 256  # tokens of one stretch of a traversal
BATCH_BYTES = "8m"  # rows of packed arrays are large
READ_ROWS = "256"


def token_hashes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's end included, and how many each text has."""
    words, row, _, _ = word_hashes(*texts(batch.column("text")))
    n = batch.num_rows
    size = counts_of(row, n) + 1
    out = np.empty(len(words) + n, np.uint64)
    last = np.cumsum(size) - 1
    is_word = np.ones(len(out), bool)
    is_word[last] = False
    out[is_word], out[last] = words, END
    return out, size


def find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each value in a sorted array, -1 if it isn't there."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def counted(docs: DataFrame, keys_of) -> DataFrame:
    """``key, n``: the sum over all texts of what ``keys_of`` finds in a batch."""
    def run(batches):
        held, waiting = [], 0

        def flush():
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64))], ["key", "n"])
        for batch in batches:
            for part in pieces(batch):
                keys = keys_of(part)
                held.append(keys)
                waiting += len(keys)
                if waiting >= COUNT_TOKENS:
                    yield flush()
                    held, waiting = [], 0
        if waiting:
            yield flush()
    return docs.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


class Automaton:
    """States, arcs and failure arcs. ``grams[k]`` has the kept (k+1)-grams as word places, and their counts."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, total: int, distinct: int):
        self.words, self.counts = words, counts
        self.denominator = float(total + distinct + 1)
        self.base = np.log10((counts + 1) / self.denominator)
        self.grams: list[tuple[np.ndarray, np.ndarray]] = []

    def close(self) -> None:
        """Number the states and build all arcs."""
        w = len(self.words)
        context = {(): 0}
        for rows, _ in self.grams:
            for c in map(tuple, np.unique(rows[:, :-1], axis=0).tolist()):
                context[c] = len(context)
        self.fail = np.zeros(len(context), np.int64)
        self.fail_weight = np.zeros(len(context))

        def longest(c: tuple) -> int:
            while c not in context:
                c = c[1:]
            return context[c]
        for c, s in context.items():
            self.fail[s] = longest(c[1:]) if c else 0
        number = {(i,): n for i, n in enumerate(self.counts.tolist())}
        probability = {(i,): 10 ** x for i, x in enumerate(self.base.tolist())}
        arcs = [(i, self.base[i], longest((i,))) for i in range(w)]
        for rows, n in self.grams:
            left = {}
            grams = list(map(tuple, rows.tolist()))
            for g, k in zip(grams, n.tolist(), strict=True):
                number[g] = k
                left[g[:-1]] = left.get(g[:-1], 1.0) - max(k - DISCOUNT, 0) / number[g[:-1]]
            for c, rest in left.items():
                self.fail_weight[context[c]] = np.log10(max(rest, 1e-12))
            for g in grams:
                lower, factor = g[1:], left[g[:-1]]
                c = g[1:-1]
                while lower not in probability:  # back off until an arc has it
                    factor *= 10 ** self.fail_weight[context[c]] if c in context else 1.0
                    lower, c = lower[1:], c[1:]
                probability[g] = max(number[g] - DISCOUNT, 0) / number[g[:-1]] + factor * probability[lower]
                arcs.append((context[g[:-1]] * w + g[-1], np.log10(probability[g]), longest(g)))
        arcs.sort()
        self.arc_key = np.array([a[0] for a in arcs], np.int64)
        self.arc_weight = np.array([a[1] for a in arcs], np.float64)
        self.arc_to = np.array([a[2] for a in arcs], np.int64)

    def traverse(self, token: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Log probability of each text without what words of no arc (-1) have in the empty context.

        All texts take one step at a time, longest first.
        """
        order = np.argsort(-size, kind="stable")
        first = (np.cumsum(size) - size)[order]
        length = size[order]
        state, score, w = np.zeros(len(size), np.int64), np.zeros(len(size)), len(self.words)
        active = len(size)
        for step in range(int(length[0]) if len(size) else 0):
            while active and length[active - 1] <= step:
                active -= 1
            word = token[first[:active] + step]
            here = np.arange(active)
            while len(here):
                at_word, at = word[here], state[here]
                arc = find(self.arc_key, np.where(at_word >= 0, at * w + at_word, -1))
                taken = arc >= 0
                score[here[taken]] += self.arc_weight[arc[taken]]
                state[here[taken]] = self.arc_to[arc[taken]]
                here, at = here[~taken], at[~taken]
                score[here] += self.fail_weight[at]
                state[here] = self.fail[at]
                here = here[at > 0]
        out = np.empty(len(size))
        out[order] = score
        return out


def learn(train: DataFrame, order: int = ORDER, min_share: float = MIN_SHARE) -> tuple[Automaton, DataFrame, int]:
    """Automaton, the counts of all tokens (``key, n``), and the number of tokens."""
    spark = train.sparkSession
    unigrams = stored(counted(train, lambda batch: signed(token_hashes(batch)[0])), "unigrams")
    total, distinct = unigrams.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    least = max(2.0, min_share * total)
    top = unigrams.filter(F.col("n") >= least).toArrow()
    keys, n = top.column("key").to_numpy().view(np.uint64), top.column("n").to_numpy()
    by_key = np.argsort(keys)
    model = Automaton(keys[by_key], n[by_key], total, distinct)
    grams, codes = np.arange(len(keys))[:, None], []
    for _ in range(1, order):
        w, unpack = len(model.words), share(spark, (model.words, list(codes)))

        def candidates(batch, unpack=unpack):
            words, levels = unpack()
            tokens, size = token_hashes(batch)
            at = find(words, tokens)
            begins = np.cumsum(size) - size
            place = at
            for level in levels:
                place = find(level, extended(place, at, begins, len(words)))
            key = extended(place, at, begins, len(words))
            return key[(key >= 0) & (place >= 0)]
        table = counted(train, candidates).filter(F.col("n") >= least).toArrow()
        key, n = table.column("key").to_numpy(), table.column("n").to_numpy()
        if not len(key):
            break
        by_key = np.argsort(key)
        key, n = key[by_key], n[by_key]
        grams = np.concatenate([grams[key // w], (key % w)[:, None]], axis=1)
        codes.append(key)
        model.grams.append((grams, n))
    model.close()
    return model, unigrams, total


def extended(place: np.ndarray, at: np.ndarray, begins: np.ndarray, w: int) -> np.ndarray:
    """Code of the n-gram that ends at each token: the place of the kept one before it, and the word; -1 if either lacks."""
    before = np.empty_like(place)
    before[1:], before[:1] = place[:-1], -1
    before[begins] = -1
    return np.where((before >= 0) & (at >= 0), before * w + at, -1)


def score_texts(docs: DataFrame, model: Automaton, unigrams: DataFrame, total: int) -> DataFrame:
    """``docs`` without text, with ``n_tokens, n_known, train_tokens, base_score, score``.

    The traversal knows the arcs; counts of all other words come by a join of their hashes with the counts of all tokens.
    """
    others = [f for f in docs.schema.fields if f.name not in ("text", "n_tokens", "n_known", "train_tokens", "base_score", "score")]
    unpack = share(docs.sparkSession, model)
    schema = docs.select(*(f.name for f in others)).schema
    names = [f.name for f in others]
    extra = "_lm_row long, n_tokens long, _known long, _base double, _score double, _rare array<long>"

    def run(batches):
        model = unpack()
        number = TaskContext.get().partitionId() << 34
        for batch in batches:
            for part in pieces(batch, most=PIECE):
                n = part.num_rows
                tokens, size = token_hashes(part)
                at = find(model.words, tokens)
                row = np.repeat(np.arange(n), size)
                rare = at < 0
                base = np.bincount(row[~rare], weights=model.base[at[~rare]], minlength=n)
                per_row = np.bincount(row[rare], minlength=n)
                offsets = np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), pa.array(np.arange(number, number + n)), pa.array(size),
                     pa.array(size - per_row), pa.array(base), pa.array(model.traverse(at, size)),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed(tokens[rare])))],
                    [*names, "_lm_row", "n_tokens", "_known", "_base", "_score", "_rare"])
                number += n
    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields), extra])
    walked = stored(docs.mapInArrow(run, ddl), "walked")
    log = F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(model.denominator))
    rest = (walked.select("_lm_row", F.explode("_rare").alias("key")).join(unigrams, "key", "left")
            .groupBy("_lm_row").agg(F.sum(log).alias("_sum"), F.count("n").alias("_found")))
    known = F.when(F.lit(total) > 0, F.col("_known") + F.coalesce("_found", F.lit(0))).otherwise(0)
    return walked.join(rest, "_lm_row", "left").select(
        *names, "n_tokens", known.cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("_base") + F.coalesce("_sum", F.lit(0.0))).alias("base_score"),
        (F.col("_score") + F.coalesce("_sum", F.lit(0.0))).alias("score"))


# --- the whole model, as tables and chunk automata -------------------------------------------

def _bucketed(key: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each key; it rises with the key, so sorted keys have their buckets in order."""
    return ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def settled(df: DataFrame, name: str) -> DataFrame:
    """As ``stored``; what was shuffled for it is deleted once the table is written, and tasks get batches of bounded bytes."""
    conf = df.sparkSession.conf
    own = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES,
           "spark.sql.parquet.columnarReaderBatchSize": READ_ROWS}
    before = {key: conf.get(key) for key in own}
    for key, value in own.items():
        conf.set(key, value)
    try:
        return stored(df, name)
    finally:
        for key, value in before.items():
            conf.set(key, value)


def dropped(table: DataFrame) -> None:
    """Delete a stored table that nothing reads any more."""
    spark = table.sparkSession
    for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _between(key: np.ndarray, buckets: int, turn: int) -> np.ndarray:
    """Keys whose bucket has its turn in this round."""
    bucket = _bucketed(key, buckets)
    return (bucket >= buckets * turn // ROUNDS) & (bucket < buckets * (turn + 1) // ROUNDS)


def order_of(values: np.ndarray) -> np.ndarray:
    """As a stable ``argsort`` of numbers from 0 on, by a plain sort of the values with their places in the low bits.

    Values too wide for that are sorted by their high bits first; the few that share them are put in order afterwards.
    """
    n, values = len(values), values.view(np.uint64)
    bits = np.uint64(max(n - 1, 1).bit_length())
    mask = (np.uint64(1) << bits) - np.uint64(1)
    place = np.arange(n, dtype=np.uint64)
    if not n or int(values.max()) >> (64 - int(bits)) == 0:
        return (np.sort(values << bits | place) & mask).view(np.int64)
    at = (np.sort(values & ~mask | place) & mask).view(np.int64)
    found = values[at]
    wrong = np.flatnonzero(found[1:] < found[:-1])
    if len(wrong) > n >> 10:
        return np.argsort(values, kind="stable")
    high = found >> bits if len(wrong) else found
    for one in np.unique(high[wrong]):
        a, b = np.searchsorted(high, one, "left"), np.searchsorted(high, one, "right")
        at[a:b] = at[a:b][np.argsort(found[a:b], kind="stable")]
    return at


def joined_key(left: np.ndarray, right: np.ndarray, level: int) -> np.ndarray:
    """Hash of an n-gram from what it begins with and what it ends with, each one word shorter."""
    return right if level == 1 else mix(mix(left + np.uint64(level)) * GOLD + right)


def text_grams(tokens: np.ndarray, size: np.ndarray, order: int):
    """Per order: key and left part of the n-gram that ends at each token, and which tokens have one; none crosses a text."""
    depth = np.arange(len(tokens)) - np.repeat(np.cumsum(size) - size, size)
    key, left = tokens, np.zeros(len(tokens), np.uint64)
    yield key, left, np.ones(len(tokens), bool)
    for level in range(2, order + 1):
        left = np.empty_like(key)
        left[1:], left[:1] = key[:-1], 0
        key = joined_key(left, key, level)
        yield key, left, depth >= level - 1


def distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, a place of each, and how often each occurs."""
    at = order_of(key)
    key = key[at]
    begin = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[begin], at[begin], np.diff(np.append(begin, len(key)))


def numbered(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and the place of each key among them."""
    at = order_of(key)
    key = key[at]
    new = np.append(True, key[1:] != key[:-1])[:len(key)]
    ids = np.empty(len(key), np.uint32)
    ids[at] = np.cumsum(new) - 1
    return key[new], ids


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as the first one and the steps, in as many bytes as the widest step needs."""
    step = np.diff(keys)
    width = max(1, (int(step.max()).bit_length() + 7) // 8) if len(step) else 1
    return bytes([width]) + keys[:1].tobytes() + step.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack_keys(packed: bytes) -> np.ndarray:
    width, first = packed[0], np.frombuffer(packed, np.uint64, 1, 1)
    step = np.zeros(((len(packed) - 9) // width, 8), np.uint8)
    step[:, :width] = np.frombuffer(packed, np.uint8, -1, 9).reshape(-1, width)
    return np.cumsum(np.concatenate([first, step.view(np.uint64).ravel()]), dtype=np.uint64)


def _cut(columns: list[np.ndarray], bucket: np.ndarray, buckets: int):
    """Arrays in order of bucket, cut at its changes: bucket and parts."""
    edge = np.searchsorted(bucket, np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edge)).tolist():
        yield b, [c[edge[b]:edge[b + 1]] for c in columns]


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], list(kinds))


CHUNK = {"chunk": pa.int64(), "n_tokens": pa.int64(), "words": pa.binary(), "ids": pa.binary(), "size": pa.binary(),
         "train": pa.binary(), "other": pa.binary()}
CHUNK_DDL = "chunk long, n_tokens long, words binary, ids binary, size binary, train binary, other binary"


def chunks(docs: DataFrame, others: list[str]) -> DataFrame:
    """Whole texts in chunks of about ``CHUNK_TOKENS`` tokens, one row each; texts are cut into tokens here only.

    A chunk has its distinct word hashes, each token's place among them, the tokens per text, which texts train, and the
    texts' other columns as an Arrow stream.
    """
    def run(batches):
        number, held, waiting = TaskContext.get().partitionId() << 34, [], 0

        def flush():
            tokens, size, train = (np.concatenate([h[i] for h in held]) for i in range(3))
            words, ids = numbered(tokens)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0][3].schema) as writer:
                for h in held:
                    writer.write_batch(h[3])
            row = (number, len(tokens), words.tobytes(), ids.tobytes(), size.astype(np.int64).tobytes(),
                   train.tobytes(), sink.getvalue().to_pybytes())
            return _batch([row], CHUNK)
        for batch in batches:
            for part in pieces(batch):
                tokens, size = token_hashes(part)
                train = part.column("_train").fill_null(False).to_numpy(zero_copy_only=False).astype(bool)
                held.append((tokens, size, train, part.select([*others, "_train"])))
                waiting += len(tokens)
                if waiting >= CHUNK_TOKENS:
                    yield flush()
                    number, held, waiting = number + 1, [], 0
        if held:
            yield flush()
    return docs.select(*others, "_train", "text").mapInArrow(run, CHUNK_DDL)


def chunk_tokens(words: bytes, ids: bytes, size: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(words, np.uint64)[np.frombuffer(ids, np.uint32)], np.frombuffer(size, np.int64)


def bucket_count(packed: DataFrame) -> int:
    """Buckets of n-grams: in proportion to the text, so that a bucket fits a task whatever the size of the input."""
    return max(MIN_BUCKETS, -(-(packed.agg(F.sum("n_tokens")).first()[0] or 0) // BUCKET_TOKENS))


GRAMS = {"bucket": pa.int32(), "part": pa.int32(), "tokens": pa.int64(), "words": pa.int64(), "keys": pa.binary(), "n": pa.binary(),
         "kinds": pa.binary()}
GRAMS_DDL = "bucket int, part int, tokens long, words long, keys binary, n binary, kinds binary"
MEETING = {"bucket": pa.int32(), "part": pa.int32(), "chunk": pa.int64(), "keys": pa.binary(), "n": pa.binary(), "rest": pa.binary()}
MEETING_DDL = "bucket int, part int, chunk long, keys binary, n binary, rest binary"


def summed(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys, a place of each, and the sums of each of the values over its places."""
    at = order_of(key)
    key = key[at]
    begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[begin], at[begin], *(np.add.reduceat(v[at], begin) for v in values)


def gram_counts(packed: DataFrame, buckets: int, order: int = ORDER, least: int = LEAST) -> DataFrame:
    """All words of the training texts and all longer n-grams that occur ``least`` times, as sorted arrays by bucket.

    Each chunk sends sorted arrays, one row per bucket and order; each bucket adds them up. Rows of part 0 have keys and
    counts, and how many tokens and words these are. Rows of part 1 go to the bucket of a key with which kept n-grams
    begin, and have the sum of their counts and how many they are.
    """
    kinds = {"bucket": pa.int32(), "level": pa.int32(), "keys": pa.binary(), "left": pa.binary(), "n": pa.binary()}

    def count(batches, turn):
        for batch in batches:
            for words, ids, size, train in zip(*(batch.column(c) for c in ("words", "ids", "size", "train")), strict=True):
                tokens, size = chunk_tokens(words.as_py(), ids.as_py(), size.as_py())
                train = np.frombuffer(train.as_py(), bool)
                tokens, size = tokens[np.repeat(train, size)], size[train]
                for level, (key, left, there) in enumerate(text_grams(tokens, size, order), 1):
                    own = np.flatnonzero(there & _between(key, buckets, turn))
                    key, first, n = distinct(key[own])
                    left = left[own[first]] if level > 1 else np.zeros(len(key), np.uint64)
                    rows = [(b, level, pack_keys(k), x.tobytes() if level > 1 else b"", c.tobytes())
                            for b, (k, x, c) in _cut([key, left, n.astype(np.uint32)], _bucketed(key, buckets), buckets)]
                    if rows:
                        yield _batch(rows, kinds)

    def add(batches):
        group, held, begun = None, [], []

        def flush():
            key = np.concatenate([unpack_keys(h[0]) for h in held])
            left = np.frombuffer(b"".join(h[1] for h in held), np.uint64)
            key, at, n = summed(key, np.frombuffer(b"".join(h[2] for h in held), np.uint32).astype(np.int64))
            keep = n >= (1 if group[1] == 1 else least)
            key, n = key[keep], n[keep]
            if group[1] > 1:
                begun.append((left[at[keep]], n))
            for k in range(0, len(key), TABLE_ROWS):
                part = n[k:k + TABLE_ROWS]
                known = (int(part.sum()), len(part)) if group[1] == 1 else (0, 0)
                yield _batch([(group[0], 0, *known, pack_keys(key[k:k + TABLE_ROWS]), part.tobytes(), b"")], GRAMS)

        def pass_on():
            left, n = (np.concatenate(x) for x in zip(*begun, strict=True))
            key, _, n, many = summed(left, n, np.ones(len(n), np.int64))
            yield _batch([(b, 1, 0, 0, pack_keys(k), c.tobytes(), m.tobytes())
                          for b, (k, c, m) in _cut([key, n, many], _bucketed(key, buckets), buckets)], GRAMS)
        for batch in batches:
            for b, level, *arrays in zip(*(batch.column(c).to_pylist() for c in kinds), strict=True):
                if held and group != (b, level):
                    yield from flush()
                    held = []
                    if sum(len(x) for x, _ in begun) >= CHUNK_TOKENS:
                        yield from pass_on()
                        begun = []
                group = (b, level)
                held.append(arrays)
        if held:
            yield from flush()
        if any(len(x) for x, _ in begun):
            yield from pass_on()
    out = None
    for turn in range(ROUNDS):
        sent = packed.select("words", "ids", "size", "train").mapInArrow(
            lambda batches, turn=turn: count(batches, turn), "bucket int, level int, keys binary, left binary, n binary")
        met = sent.repartition("bucket", "level").sortWithinPartitions("bucket", "level")
        part = settled(met.mapInArrow(add, GRAMS_DDL), "grams")
        out = part if out is None else out.union(part)
    return out


def backoff_table(grams: DataFrame) -> DataFrame:
    """Keys, counts and rests of all n-grams, as sorted arrays by bucket.

    The rest is the share that an n-gram's kept followers leave to shorter contexts.
    """
    def rests(batches):
        bucket, held = None, ([], [])

        def flush():
            own, begun = held
            keys, n = (np.concatenate(x) for x in zip(*own, strict=True))
            at = order_of(keys)
            keys, n, rest = keys[at], n[at], np.ones(len(at))
            if begun:
                key, _, s, many = summed(*(np.concatenate(x) for x in zip(*begun, strict=True)))
                at = find(keys, key)
                there, at = at >= 0, at[at >= 0]
                rest[at] = 1 - (s[there] - DISCOUNT * many[there]) / n[at]
            rest = np.maximum(rest, 1e-12)
            for k in range(0, len(keys), TABLE_ROWS):
                part = slice(k, k + TABLE_ROWS)
                yield _batch([(bucket, 0, 0, pack_keys(keys[part]), n[part].tobytes(), rest[part].tobytes())], MEETING)
        for batch in batches:
            for b, part, keys, n, many in zip(*(batch.column(c).to_pylist() for c in ("bucket", "part", "keys", "n", "kinds")), strict=True):
                if b != bucket:
                    if held[0]:
                        yield from flush()
                    bucket, held = b, ([], [])
                arrays = (unpack_keys(keys), np.frombuffer(n, np.int64))
                held[part].append(arrays if part == 0 else (*arrays, np.frombuffer(many, np.int64)))
        if held[0]:
            yield from flush()
    met = grams.select("bucket", "part", "keys", "n", "kinds").repartition("bucket").sortWithinPartitions("bucket", "part")
    return met.mapInArrow(rests, MEETING_DDL)


class ChunkAutomaton:
    """The part of the model that a chunk's texts can reach, as states, arcs and failure arcs.

    A state is a kept n-gram below the full order, the empty context is state 0. An arc reads a word; a failure arc leads to
    the context without its first word and costs the backoff weight.
    """

    def __init__(self, tokens: np.ndarray, size: np.ndarray, keys: np.ndarray, n: np.ndarray, rest: np.ndarray,
                 denominator: float, order: int):
        """``keys`` are the sorted n-grams of the chunk that the model has, ``n`` and ``rest`` what it knows of them."""
        g, places, occurring = len(keys), [], []
        for key, _, there in text_grams(tokens, size, order):
            own = np.flatnonzero(there)
            at = own[order_of(key[own])]
            key = key[at]
            begin = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:len(key)])
            known, place = find(keys, key[begin]), np.full(len(there), -1)
            place[at] = np.repeat(known, np.diff(np.append(begin, len(key))))
            places.append(place)
            occurring.append((known[known >= 0], at[begin][known >= 0]))  # one occurrence of each n-gram tells its parts
        self.word, self.width = places[0], max(g, 1)
        self.base = np.log10(np.append(n + 1, 1) / denominator)
        source, read, target = (np.zeros(g, np.int64) for _ in range(3))
        p, self.fail = np.ones(g), np.zeros(g + 1, np.int64)
        for level, (at, one) in enumerate(occurring, 1):
            read[at], target[at] = places[0][one], at + 1
            if level == 1:
                p[at] = (n[at] + 1) / denominator
                continue
            left, right = places[level - 2][one - 1], places[level - 2][one]
            p[at] = (n[at] - DISCOUNT) / n[left] + rest[left] * p[right]
            source[at], self.fail[at + 1] = left + 1, right + 1
            if level == order:
                target[at] = right + 1
        target[keys[read] == END if g else slice(0)] = 0
        self.root_to = np.append(target, 0)  # arcs of the empty context by word; an unseen word stays there
        code = source * self.width + read
        arcs = np.flatnonzero(source)
        arcs = arcs[order_of(code[arcs])]
        self.arc_key, self.arc_weight, self.arc_to = code[arcs], np.log10(p)[arcs], target[arcs]
        self.fail_weight = np.append(0.0, np.log10(rest))
        self.warm = order - 1

    def traverse(self) -> np.ndarray:
        """Log probability of each token, left to right.

        Stretches of ``LANE`` tokens take one step together. Each starts in the empty context as many tokens early as a state
        can remember, so that it reaches its first own token in the state that a single traversal would have there. A text
        ends in the empty context.
        """
        n = len(self.word)
        out = np.empty(n)
        begin = np.arange(0, n, LANE)
        state = np.zeros(len(begin), np.int64)
        for step in range(-self.warm, LANE):
            token = begin + step
            here = np.flatnonzero((token >= 0) & (token < n))
            word, gained = self.word[np.clip(token, 0, n - 1)], np.zeros(len(begin))
            while len(here):
                empty = state[here] == 0
                last, here = here[empty], here[~empty]
                gained[last] += self.base[word[last]]
                state[last] = self.root_to[word[last]]
                at, read = state[here], word[here]
                arc = find(self.arc_key, np.where(read >= 0, at * self.width + read, -1))
                taken = arc >= 0
                gained[here[taken]] += self.arc_weight[arc[taken]]
                state[here[taken]] = self.arc_to[arc[taken]]
                here, at = here[~taken], at[~taken]
                gained[here] += self.fail_weight[at]
                state[here] = self.fail[at]
            if step >= 0:
                own = token < n
                out[token[own]] = gained[own]
        return out


def _sums(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sum of each text's values; every text has at least its end."""
    return np.add.reduceat(values, np.cumsum(size) - size)


def chunk_scores(packed: DataFrame, table: DataFrame, fields, results: list[str], total: int, denominator: float, buckets: int, order: int) -> DataFrame:
    """Every chunk asks for its distinct n-grams, gets those that the model has, and traverses its texts.

    Chunks go in ``CHUNK_ROUNDS`` parts, one after another; questions and the model's table meet in hash buckets, as sorted arrays.
    """
    names = [f.name for f in fields]

    def ask(batches):
        for batch in batches:
            for chunk, words, ids, size in zip(*(batch.column(c) for c in ("chunk", "words", "ids", "size")), strict=True):
                tokens, size = chunk_tokens(words.as_py(), ids.as_py(), size.as_py())
                key = np.sort(np.concatenate([distinct(key[there])[0] for key, _, there in text_grams(tokens, size, order)]))
                yield _batch([(b, 1, chunk.as_py(), pack_keys(k), b"", b"")
                              for b, (k,) in _cut([key], _bucketed(key, buckets), buckets)], MEETING)

    def answer(batches):
        bucket, held, keys, n, rest = None, [], np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0)
        for batch in batches:
            rows = []
            for b, part, chunk, packed_keys, a, r in zip(*(batch.column(c).to_pylist() for c in MEETING), strict=True):
                if b != bucket:
                    bucket, held, keys, n, rest = b, [], keys[:0], n[:0], rest[:0]
                if part == 0:
                    held.append((unpack_keys(packed_keys), np.frombuffer(a, np.int64), np.frombuffer(r)))
                    continue
                if held:  # the model's rows of a bucket come before its questions
                    keys, n, rest = (np.concatenate(x) for x in zip(*held, strict=True))
                    at, held = order_of(keys), []
                    keys, n, rest = keys[at], n[at], rest[at]
                at = find(keys, unpack_keys(packed_keys))
                at = at[at >= 0]
                if len(at):
                    rows.append((chunk, 0, pack_keys(keys[at]), n[at].tobytes(), rest[at].tobytes(), None))
            yield _batch(rows, answers)
    answers = {"chunk": pa.int64(), "part": pa.int32(), "a": pa.binary(), "b": pa.binary(), "c": pa.binary(), "d": pa.binary()}
    answers_ddl = "chunk long, part int, a binary, b binary, c binary, d binary"

    def walk(batches):
        chunk, held = None, []
        for batch in batches:
            for number, part, a, b, c, d in zip(*(batch.column(x).to_pylist() for x in answers), strict=True):
                if number != chunk:
                    chunk, held = number, []
                if part == 0:
                    held.append((unpack_keys(a), np.frombuffer(b, np.int64), np.frombuffer(c)))
                    continue
                keys, n, rest = (np.concatenate(x) for x in zip(*held, strict=True)) if held else (
                    np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0))
                at, held = order_of(keys), []
                tokens, size = chunk_tokens(a, b, c)
                model = ChunkAutomaton(tokens, size, keys[at], n[at], rest[at], denominator, order)
                scores = [size, _sums((model.word >= 0).astype(np.int64), size), np.full(len(size), total, np.int64),
                          _sums(model.base[model.word], size), _sums(model.traverse(), size)]
                other, row = pa.ipc.open_stream(d), 0
                for own in other:
                    yield pa.RecordBatch.from_arrays(
                        [*(own.column(x) for x in names), *(pa.array(s[row:row + own.num_rows]) for s in scores)], [*names, *results])
                    row += own.num_rows
    out_ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields),
                         *(f"{r} {k}" for r, k in zip(results, ("long", "long", "long", "double", "double"), strict=True))])
    turn_of, out = F.pmod(F.xxhash64("chunk"), F.lit(CHUNK_ROUNDS)), None
    for turn in range(CHUNK_ROUNDS):
        own = packed.filter(turn_of == turn)
        asked = own.select("chunk", "words", "ids", "size").mapInArrow(ask, MEETING_DDL)
        met = table.union(asked).repartition("bucket").sortWithinPartitions("bucket", "part")
        told = settled(met.mapInArrow(answer, answers_ddl), "answers")
        rows = own.select("chunk", F.lit(1).alias("part"), F.col("words").alias("a"), F.col("ids").alias("b"),
                          F.col("size").alias("c"), F.col("other").alias("d"))
        met = told.union(rows).repartition("chunk").sortWithinPartitions("chunk", "part")
        scored = settled(met.mapInArrow(walk, out_ddl), "scores")
        dropped(told)
        out = scored if out is None else out.union(scored)
    return out


def score_whole(docs: DataFrame, is_train, order: int = ORDER, least: int = LEAST) -> DataFrame:
    """As ``score_texts``, by a model of all n-grams that occur ``least`` times in the rows where ``is_train``.

    Every row has a result: a null or empty text is its end token alone, repeated rows are scored each and count each, an empty
    table gives none. Input columns named like a result are replaced; any other name is kept as it is.
    """
    results = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    names = [c for c in docs.columns if c not in ("text", *results)]
    others = [f"_in{i}" for i in range(len(names))]
    held = docs.select(*(F.col(f"`{c}`").alias(o) for c, o in zip(names, others, strict=True)), is_train.alias("_train"), "text")
    packed = settled(chunks(held, others), "chunks")
    buckets = bucket_count(packed)
    grams = gram_counts(packed, buckets, order, least)
    total, words = grams.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    table = settled(backoff_table(grams), "backoff")
    dropped(grams)
    fields = [f for f in held.schema.fields if f.name in others]
    scored = chunk_scores(packed, table, fields, results, total, float(total + words + 1), buckets, order)
    dropped(table)
    dropped(packed)
    return scored.select(*(F.col(o).alias(c) for c, o in zip(names, others, strict=True)), *results)


def op6_lm_score(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_mod("doc_id", 7) == 2
    scored = score_whole(docs, ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
