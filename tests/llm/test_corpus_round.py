"""Hard negatives, SentencePiece ids and repaired conversations against the library or brute force."""

import hashlib
import heapq
import itertools
import random
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from corpus_rows import CLASH, LONG, documents, edge, edge_rows, none  # noqa: F401
from touchline.llm import dialogue, negatives, repeats, secrets, sentencepieces

SF = "/root/testdata/sf0.001"


# --- hard negatives --------------------------------------------------------------------------

def _naive_negatives(rows):
    """rows: distinct (id, label, vector) with integer components."""
    out = set()
    dot = lambda x, y: sum(a * b for a, b in itertools.zip_longest(x, y, fillvalue=0))
    for a in [r for r in rows if r[0] % 100 == 0]:
        scored = sorted(((dot(a[2], r[2]), r) for r in rows if r != a), key=lambda s: (-s[0], s[1][0]))
        for ps, p in [s for s in scored if s[1][1] == a[1]][:5]:
            fits = [(ns, r) for ns, r in scored if r[1] != a[1] and 80 * ps <= 100 * ns <= 100 * ps]
            out |= {(a[0], p[0], k + 1, r[0], ps, ns) for k, (ns, r) in enumerate(fits[:5])}
    return out


@pytest.mark.parametrize("width", [1, 7, 24])
def test_hard_negatives(spark, width):
    """Few distinct scores, so that ties abound; blocks of a few anchors; vectors of several lengths."""
    rng = random.Random(width)
    rows = [(i, rng.randint(0, 2), [rng.randint(-3, 4) for _ in range(width if i % 5 else max(1, width - 2))]) for i in range(0, 700, 2)]
    df = spark.createDataFrame(rows + rows[:40], "id long, label long, vector array<long>").repartition(5)
    got = negatives.hard_negatives(df, F.col("id") % 100 == 0, block_bytes=8 * width * 3).collect()
    assert len(got) == len(set(got))
    assert {tuple(r) for r in got} == _naive_negatives([(a, b, tuple(v)) for a, b, v in rows])


def test_bounds_hold():
    rng = np.random.default_rng(1)
    x, y = rng.integers(-90, 90, (40, 13)).astype(float), rng.integers(-90, 90, (30, 13)).astype(float)
    true = x @ y.T
    for n in (1, 2, 5, 13):
        (xm, xd), (ym, yd) = negatives.summaries(x, n), negatives.summaries(y, n)
        mid, reach = xm @ ym.T, xd @ yd.T
        assert (mid - reach <= true + 1e-6).all() and (true <= mid + reach + 1e-6).all()
    assert np.abs(xd).max() < 1e-9  # segments of one component are exact


def test_levels_leave_out_pairs(monkeypatch):
    """Vectors with a clear direction: most pairs are settled by their bounds."""
    rng = np.random.default_rng(2)
    centre = rng.integers(-200, 200, (10, 1)).repeat(32, axis=1) * np.sign(np.sin(np.arange(320))).reshape(10, 32).repeat(1, axis=1)
    labels = np.arange(3000) % 10
    rows = (centre[labels] + rng.integers(-5, 5, (3000, 32))).astype(float)
    seen = []
    whole = negatives.inner
    monkeypatch.setattr(negatives, "inner", lambda a, b, r, c: seen.append(len(r)) or whole(a, b, r, c))
    ids = np.arange(3000)
    block = negatives.Block(ids[:50], labels[:50], rows[:50], np.full((50, 1), 1), np.full((50, 1), 2 ** 40), 5, False)
    import pyarrow as pa
    for at in range(0, 3000, 500):
        block.offer(ids[at:at + 500], labels[at:at + 500], pa.array(rows[at:at + 500].astype(int).tolist()))
    assert sum(seen) < 0.5 * 50 * 2700


def test_large_components_are_exact():
    big = np.array([[2.0 ** 30 + 1, 3.0]]), np.array([[2.0 ** 30 + 7, -5.0]])
    assert negatives.inner(*big, np.array([0]), np.array([0])).tolist() == [(2 ** 30 + 1) * (2 ** 30 + 7) - 15]


def test_hard_negatives_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [0.5, 0.5]), (1, 1, [0.5, 0.4]), (2, 2, [0.45, 0.45]), (3, None, [0.5, 0.5]), (None, 2, [0.5, 0.5]), (4, 2, None),
            (5, 2, [0.5, None]), (6, 2, [nan, 0.5]), (8, 2, [inf, 0.5]), (9, 3, []), (100, 4, [0.1, 0.1]), (2, 2, [0.45, 0.45])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    df = df.withColumns({c: F.lit("mine") for c in ["id", "vector", "score", "slot", "anchor", "row", "rank"]})
    used = negatives.usable_rows(df)
    got = negatives.hard_negatives(used, F.col("id") % 100 == 0).collect()
    # 0 has one positive (1) and one negative in its window (2, given twice); 100 has no other row of its label.
    assert [tuple(r) for r in got] == [(0, 1, 1, 2, 128 * 128 + 128 * 102, 128 * 115 * 2)]
    assert negatives.hard_negatives(used.limit(0), F.col("id") % 100 == 0).collect() == []
    assert negatives.hard_negatives(used, F.col("id") < 0).collect() == []


# --- secrets ---------------------------------------------------------------------------------

def test_a_long_text_full_of_secrets(spark):
    """Five megabytes with a hundred thousand matches: time follows their number, and every place is right."""
    line = "note password = {:012d}abc then {:032x} and Some_Name_Here_{:06d}; "
    text = "".join(line.format(i, i * 7919 + 16 ** 31, i) for i in range(50_000))
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    began = time.time()
    got = {r.doc_id: r for r in secrets.find_secrets(docs, [-1.0] * secrets.SIZE ** 2).collect()}
    assert time.time() - began < 60
    want = sorted([(m.start(), 0, m.end(), "assign") for m in re.finditer(r"password = [A-Za-z0-9+/_.=-]+", text)]
                  + [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]{16,}", text)])
    assert [tuple(s) for s in got[1].base] == want and len(want) == 100_000
    assert got[1].spans == got[1].base and got[2].spans == got[3].spans == []


def test_added_secrets_touch_no_base_span(spark, documents):  # noqa: F811
    """With a ratio that any token passes: all long tokens that overlap no base span, and no others."""
    rng = random.Random(3)
    parts = ["password=", "AKIA" + "Z" * 20, "0123456789abcdef" * 2, "x" * 18, "Q" * 16, " ", ": ", "token = ", "ok", "é", "\n", "-" * 20, "secret: abc"]
    rows = [(i, "".join(rng.choices(parts, k=rng.randint(0, 40)))) for i in range(300)]
    rows += [(1000 + r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()[:300]]
    found = secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string"), [1.0] * secrets.SIZE ** 2)
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in found.collect()}
    for doc_id, text in rows:
        base = [(m.start(), 0, m.end(), "assign") for m in re.finditer(secrets.ASSIGN, text or "") if len(m.group(2)) >= 12]
        base += [(m.start(), k, m.end(), name) for k, name, p in ((1, "access", secrets.ACCESS), (2, "hex", secrets.HEX)) for m in re.finditer(p, text or "")]
        tokens = [(m.start(), 3, m.end(), "markov") for m in re.finditer(secrets.TOKEN, text or "")]
        free = [t for t in tokens if not any(b[0] < t[2] and t[0] < b[2] for b in base)]
        assert got[doc_id] == sorted(base + free), text


# --- repeated passages -----------------------------------------------------------------------

def test_passages_of_over_fifty_words(spark):
    """What counts is 400 bytes, not the number of words: of passages in several documents the shorter ones stay."""
    rng = random.Random(8)
    word = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n))
    fill = lambda n: " ".join(word(5) for _ in range(n))
    passages = {f"{words} words, {size}": " ".join(word(size - 1) for _ in range(words)) for words in (50, 55, 65, 80) for size in (4, 6, 8, 9)}
    rows, of = [], {}
    for name, passage in passages.items():
        for _ in range(3):
            of[len(rows)] = name
            rows.append((len(rows), f"{fill(20)} {passage} {fill(rng.randint(5, 30))}"))
    got = {r.doc_id: r.n_bytes - len(r.kept) for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for doc_id, name in of.items():
        size = len(passages[name])  # a space stands before and after it in every copy
        assert size + 2 <= got[doc_id] <= size + 6 if size + 2 >= 400 else got[doc_id] == 0, name  # a next letter may agree by chance
    assert {len(p) + 2 >= 400 for p in passages.values()} == {True, False}


# --- SentencePiece ---------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


ODD = ["", " ", "a ", "  a\t b", "x▁y", "a\x00b", "�", "ﬁ①Ａ", "<s>hello</s><0x41>", "　x y", "日 本", "\U0001F600 x", "▁", "▁▁ ▁",
       "\x01\x02 \x03", "\U0010ffff\U0010fffe x", "a" * 300 + " b", LONG, "é" * 5000]


@pytest.mark.parametrize("table_bytes", [0, 3000, 1 << 24])
def test_encoder_equals_library(library, table_bytes):
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        encoder = sentencepieces.Encoder(f.read(), table_bytes)
    for part in (ODD, ODD[:7], ODD[::-1]):
        assert [np.frombuffer(x, np.int32).tolist() for x in encoder.encode(part)] == library.encode(part)
    assert max(map(len, encoder.table)) <= sentencepieces.LONGEST


def test_each_word_is_segmented_once(monkeypatch):
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        encoder = sentencepieces.Encoder(f.read())
    asked, library = [], encoder.sp

    class Spy:
        def encode(self, words, **more):
            asked.extend(words)
            return library.encode(words, **more)
    monkeypatch.setattr(encoder, "sp", Spy())
    for text in ["the cat sat on the mat", "the dog sat", "  the cat"]:
        encoder.encode([text, text])
    assert sorted(asked) == sorted(set(asked))


def test_sentencepiece_query(spark, library):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in sentencepieces.op12_sentencepiece(spark, SF).collect()}
    assert len(got) == len(rows)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in rows:
        ids = library.encode(r.text or "")
        assert tuple(got[r.doc_id]) == (r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))


def test_sentencepiece_edges(edge, none, edge_rows, library):  # noqa: F811
    got = sentencepieces.decode_ids(sentencepieces.encode_texts(edge)).collect()
    want = [(r[0], library.encode(r[1] or "")) for r in edge_rows]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.ids) for r in got), key=key) == sorted(want, key=key)
    assert all(r.decoded == library.decode(r.ids) for r in got)
    assert sentencepieces.decode_ids(sentencepieces.encode_texts(none)).collect() == []


# --- conversations ---------------------------------------------------------------------------

NEXT = {("0", "s"): "S", ("0", "u"): "U", ("S", "u"): "U", ("U", "a"): "P", ("P", "u"): "U"}


def _faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def _options(rows, faults, i, state):
    """(cost, edit, next i, next state, turn or None) from a point of the edit graph."""
    for symbol, name in (("u", "user"), ("a", "assistant")):
        if (state, symbol) in NEXT:
            yield 3, "I", i, NEXT[state, symbol], (name, "")
    if i < len(rows):
        _, role, text = rows[i]
        yield 4, "D", i + 1, state, None
        if faults[i] in ("", "truncated"):
            more = 3 if faults[i] else 0
            for symbol, edit, cost, turn in ((role[:1], "K", 0, (role, text)), ("u", "R", 3, ("user", text)), ("a", "R", 3, ("assistant", text))):
                if (state, symbol) in NEXT:
                    yield cost + more, edit, i + 1, NEXT[state, symbol], turn


def _shortest(rows, faults):
    heap, done = [(0, "", 0, "0", ())], set()
    while True:
        cost, audit, i, state, turns = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in "0P":
            return cost, audit, turns
        for more, edit, j, then, turn in _options(rows, faults, i, state):
            heapq.heappush(heap, (cost + more, audit + edit, j, then, turns + ((turn,) if turn else ())))


def _exhaustive(rows, faults, most):
    """Least (cost, audit) over every sequence of edits that costs up to ``most``, without merging anything."""
    found = []

    def go(cost, audit, i, state):
        if cost > most:
            return
        if i == len(rows) and state in "0P":
            found.append((cost, audit))
        for more, edit, j, then, _ in _options(rows, faults, i, state):
            go(cost + more, audit + edit, j, then)
    go(0, "", 0, "0")
    return min(found)


def _naive_conversations(rows):
    by = {}
    for conv, turn, role, text in rows:
        mine = by.setdefault(conv, [])
        what = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text
        mine += [(turn, "user" if what == 4 else role, text)] * (0 if what == 0 else 2 if what == 3 else 1)
    out = {}
    for conv, turns in by.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).hexdigest()))
        known = [t[0] for t in turns if t[0] is not None]
        faults = _faults(turns)
        cost, audit, fixed = _shortest(turns, faults)
        out[conv] = (max(known) - min(known) + 1 - len(set(known)) if known else 0, *map(faults.count, ("blank", "duplicate", "truncated")),
                     sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns)), cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest())
    return out


ROLES = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "User"]
TEXTS = ["Hi.", "ok", "yes!", "", " ", None, "a\nb?  ", "x.", "y", "é。", " "]


def _conversations(seed):
    rng, rows = random.Random(seed), []
    for conv in range(120):
        for turn in range(rng.randint(1, 9)):
            for _ in range(rng.choice([1, 1, 1, 2])):
                rows.append((None if conv == 7 else conv, None if rng.random() < .05 else turn, rng.choice(ROLES), rng.choice(TEXTS)))
    rows += [(1000, t // 3, rng.choice(ROLES[:5]), rng.choice([f"Hi {t}.", f"t{t}", "same.", "ok"])) for t in range(400)]
    rows += [(2000, 5, "user", "Again.")] * 300  # equal rows at one place
    return rows


def test_merging_loses_nothing():
    rng = random.Random(5)
    for _ in range(150):
        rows = [(t, rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["Hi.", "ok", "", "yes!"])) for t in range(rng.randint(0, 5))]
        faults = _faults(rows)
        parse = dialogue.Parse()
        for (_, role, _), what in zip(rows, faults, strict=True):
            parse.turn((role[0] if role[0] in "sua" else "?", what))
        cost, index, tail = dialogue.ending(parse.exits())
        assert (cost, parse.audit(index) + tail) == _exhaustive(rows, faults, cost)


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_conversations(spark, monkeypatch, ranges):
    """Conversations inside ranges, over borders of two ranges, and over many of them."""
    rows = _conversations(ranges)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumns({c: F.lit("mine") for c in [*CLASH, "digest", "fault", "seen", "audit", "edit", "pos", "_c"]})
    monkeypatch.setattr(dialogue, "read", lambda *a: df)
    monkeypatch.setattr(dialogue, "partitions", lambda s: ranges)
    got = dialogue.op13_conversations(spark, "").collect()
    assert len(got) == len({r.conv_id for r in got})
    assert {r.conv_id: tuple(r)[1:] for r in got} == _naive_conversations(rows)


def test_repaired_turns_read_as_the_grammar(spark):
    rows = _conversations(9)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    digests = {r.conv_id: r for r in dialogue.conversation_digests(turns).collect()}
    by = {}
    for r in sorted(dialogue.repair_turns(turns).collect(), key=lambda r: (r.part, r.pos)):
        by.setdefault(r.conv_id, []).append(r)
    assert by.keys() == digests.keys()
    for conv, edits in by.items():
        left = [r for r in edits if r.edit != "D"]
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in left))
        assert "".join(r.edit for r in edits) == digests[conv].audit
        text = "\n".join(f"{r.role}:{r.text}" for r in left)
        assert hashlib.sha256(text.encode()).hexdigest() == digests[conv].repaired_sha256


def test_no_conversations(spark, monkeypatch):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")  # noqa: F811
    assert dialogue.repair_turns(none).collect() == []
    dropped = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    gone = spark.createDataFrame([(1, dropped, "user", "Hi.")], none.schema)
    monkeypatch.setattr(dialogue, "read", lambda *a: gone)
    assert [tuple(r) for r in dialogue.op13_conversations(spark, "").collect()] == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_long_conversation():
    """A hundred thousand turns parse in seconds; the audit is put together at the end."""
    parse = dialogue.Parse()
    for i in range(100_000):
        parse.turn(("ua"[i % 2] if i % 7 else "?", "" if i % 5 else "truncated"))
    cost, index, tail = dialogue.ending(parse.exits())
    assert cost > 0 and len(parse.audit(index) + tail) >= 100_000


def test_conversations_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in dialogue.op13_conversations(spark, SF).collect()}
    assert got == _naive_conversations(rows)
