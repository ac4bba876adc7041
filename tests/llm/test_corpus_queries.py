"""Whole operators against brute force, SQL or held-out accuracy."""

import hashlib
import random
import re
import zlib
from collections import Counter
from math import log10

import pytest
from pyspark.sql import functions as F

from corpus_rows import documents  # noqa: F401
from oracle import connect, rows_of
from touchline.llm import decontam, fingerprint, language, lm, mixing, neardup, quality, repeats, secrets
from touchline.llm.queries import ORACLES, QUERIES

SF, SMALL = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def _table(spark, rows, names="doc_id long, text string"):
    return spark.createDataFrame(rows, names)


@pytest.mark.parametrize("name", ORACLES)
def test_oracle(name, spark):
    df = QUERIES[name](spark, SF)
    found = connect(SF).execute(ORACLES[name])
    columns = [d[0] for d in found.description]
    assert rows_of(df.columns, df.collect()) == rows_of(columns, found.fetchall())


def test_mix_meets_targets(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.randint(0, 30)), None, rng.choice(["a", "a", "a", "b", "c", None])) for i in range(3000)]
    out = mixing.mix_sources(_table(spark, rows, "doc_id long, text string, lang string, source string")).toPandas()
    assert (out.taken <= 3 * out["size"]).all()
    for _, g in out.groupby("source", dropna=False):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 30
    assert abs(out.drop_duplicates("source").target.sum() - out["size"].sum()) < 1e-6


def _naive_components(texts, size, percent=80):
    sets = {}
    for d, t in texts.items():
        words = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets[d] = {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set())
    root = {d: d for d in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            common = len(sets[a] & sets[b])
            if common and common * 100 >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(spark, monkeypatch, size):
    """Families with edits of all strengths, in small blocks, beside copies and short texts."""
    monkeypatch.setattr(neardup, "BLOCK", 300)
    rng = random.Random(7)
    texts = {}
    for family in range(6):
        words = [f"f{family}w{rng.randint(0, 500)}" for _ in range(80)]
        for k in range(25):
            own = list(words)
            for _ in range(rng.randint(0, 12)):
                own[rng.randrange(80)] = f"x{rng.random()}"
            texts[len(texts)] = " ".join(own)
        texts[len(texts)] = " ".join(words)
        texts[len(texts)] = " ".join(words).upper()
    for t in ("", None, "  ", "one", "ONE", "one two", "one two three four"):
        texts[len(texts)] = t
    got = neardup.near_duplicates(_table(spark, list(texts.items())).repartition(3), size=size).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == _naive_components(texts, size)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize("most", [1 << 28, 1000])
def test_texts_in_no_pair_do_not_move(spark, monkeypatch, most):
    """Where ids cannot be broadcast, a bitmap of them holds back other texts; a crowded one changes no result."""
    monkeypatch.setattr(neardup, "MOST_BITS", most)
    ids = [*range(-300, 300), 2**62, -2**62]
    wanted = set(ids[::7]) | {2**62}
    rows = [(i, f"t{i}") for i in ids] + [(ids[0], "t"), (ids[0], f"t{ids[0]}"), (ids[7], None), (None, "t"), (None, None)]
    docs = _table(spark, rows).repartition(3)
    pairs = _table(spark, [(ids[0], i) for i in wanted], "a long, b long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        chosen = neardup.rows_of(docs, pairs)
        plan = chosen._jdf.queryExecution().executedPlan().toString()
        got = [tuple(r) for r in chosen.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(got) == len(set(got)) and set(got) == {r for r in rows if r[0] in wanted}
    assert 0 < plan.find("SortMergeJoin") < plan.find("BroadcastHashJoin")  # the bitmap is met below the join that moves texts


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(40)]
    edges = [(a, b) for a, b in edges if a != b]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.label for r in neardup.components(_table(spark, edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}


@pytest.mark.parametrize("most", [1500, 2])
def test_repeats(spark, most):
    """Small windows over a tiny alphabet; with ``most`` of 2 nearly every anchor is a crowd."""
    rng = random.Random(5)
    passage = "".join(rng.choices("abcd", k=150))
    rows = []
    for i in range(60):
        t = "".join(rng.choices("abcd", k=rng.randint(0, 120)))
        if i % 2:
            t += passage[rng.randint(0, 60):rng.randint(80, 150)] + "".join(rng.choices("abcd", k=rng.randint(0, 60)))
        rows.append((i, t))
    rows += [(60, "é" * 40), (61, None), (62, ""), (63, "a" * 200), (5, rows[5][1]), (None, passage)]
    length = 40
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i:i + length] for b in data for i in range(len(b) - length + 1))
    want = []
    for (d, _), b in zip(rows, data):
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        want.append((-1 if d is None else d, len(b), bytes(x for x, g in zip(b, gone) if not g), runs))
    docs = _table(spark, rows).repartition(4)
    spans, repeats.MOST_STRETCHES = repeats.MOST_STRETCHES, most
    try:
        marked = repeats.with_mark(docs)
        crowd = repeats.repeated_spans(marked, length, most)
        assert crowd.columns == ["doc_id", "h", "lo", "hi"]
        plain = repeats.repeated_spans
        repeats.repeated_spans = lambda d, n: plain(d, n, most)
        got = repeats.remove_repeats(docs, length).collect()
    finally:
        repeats.repeated_spans, repeats.MOST_STRETCHES = plain, spans
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, bytes(r.kept), len(r.spans)) for r in got) == sorted(want)


@pytest.mark.parametrize("most", [1500, 2])
def test_repeats_of_texts_in_several_slices(spark, monkeypatch, most):
    """A window at the border of two slices is not its own copy; real copies are found whatever slices they lie in."""
    rng = random.Random(6)
    passage = "".join(rng.choices("abcd", k=90))
    fill = lambda n: "".join(rng.choices("abcdefgh", k=n))
    rows = [(0, fill(700)), (1, fill(150) + passage + fill(200)), (2, fill(333) + passage + fill(40)), (3, fill(128)), (4, None)]
    length = 40
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i:i + length] for b in data for i in range(len(b) - length + 1))
    want = []
    for (d, _), b in zip(rows, data):
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        want.append((d, bytes(x for x, g in zip(b, gone) if not g)))
    plain = repeats.repeated_spans
    monkeypatch.setattr(repeats, "SLICE", 128)
    monkeypatch.setattr(repeats, "repeated_spans", lambda d, n: plain(d, n, most))
    per_batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(per_batch)
    spark.conf.set(per_batch, "1")
    try:
        got = repeats.remove_repeats(_table(spark, rows).repartition(3), length).collect()
    finally:
        spark.conf.set(per_batch, before)
    assert sorted((r.doc_id, bytes(r.kept)) for r in got) == want


def test_fingerprints_of_neighbours(spark, documents):
    docs = documents.filter("doc_id < 120")
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), reverse=True)
    got = {r.doc_id: r for r in fingerprint.compare_with_next(docs.repartition(5)).collect()}
    for (d, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        assert got[d].n_chars == len(t) and got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[d].fingerprint == fingerprint._hex(fingerprint.signature(t.encode()))
        assert 0 <= got[d].near_next <= 1 and 0 <= got[d].near_edited <= 1
    assert len(got) == len(rows)


def test_lm_base_scores(spark, documents):
    docs = documents.filter("doc_id < 300").select("doc_id", "text")
    tokens = {r.doc_id: re.findall(rb"[^\x20\x09-\x0D]+", (r.text or "").encode().lower()) + [None] for r in docs.collect()}
    train = Counter(w for d, words in tokens.items() if d % 5 for w in words)
    total, distinct = sum(train.values()), len(train)
    model = lm.learn(docs.filter("doc_id % 5 <> 0"), min_share=1e-4)
    assert len(model[0].grams) == 2 and all(len(g[0]) for g in model[0].grams)
    gain = 0.0
    for r in lm.score_texts(docs, *model).collect():
        words = tokens[r.doc_id]
        base = sum(log10((train[w] + 1) / (total + distinct + 1)) for w in words)
        assert abs(r.base_score - base) < 1e-6 * len(words) and r.train_tokens == total
        assert (r.n_tokens, r.n_known) == (len(words), sum(train[w] > 0 for w in words))
        gain += r.score - r.base_score
    assert gain > 0


@pytest.mark.parametrize("filler", [0, 300_000])
def test_lm_keeps_pairs_seen_twice_at_any_size(spark, documents, filler, monkeypatch):
    """The tables score as the automaton of all n-grams seen twice; more text of other words takes no context away."""
    docs = documents.filter("doc_id < 120").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in docs] + [(1001, "alpha beta gamma"), (1002, "Alpha beta gamma"), (1005, "alpha beta gamma"),
                                                 (1003, ""), (None, None), (1004, "zz " * filler), (1010, "nowhere else")]
    table = _table(spark, rows)
    monkeypatch.setattr(lm, "read", lambda *_: table)
    monkeypatch.setattr(lm, "crc_mod", lambda *_: F.when(F.col("doc_id") % 5 == 0, 2).otherwise(0))
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 2000)
    got = {r.doc_id: r for r in lm.op6_lm_score(spark, "").collect()}
    train = table.filter("doc_id is null or doc_id % 5 <> 0")
    want = {r.doc_id: r for r in lm.score_texts(table, *lm.learn(train, min_share=0)).collect()}
    assert len(got) == len(rows) and set(got) == set(want)
    for d, r in got.items():
        assert (r.n_tokens, r.n_known, r.train_tokens) == (want[d].n_tokens, want[d].n_known, want[d].train_tokens)
        assert r.base_score == pytest.approx(want[d].base_score) and r.score == pytest.approx(want[d].score)
    assert got[1005].score > got[1005].base_score + 3


def test_secrets_against_plain_patterns(spark):
    rng = random.Random(2)
    bits = ["token", "=", ":", "'", " ", "Secret", "api_key", "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef", "f", "é", "\n",
            "password", '"', "x/+y.z", "apiKEY", "AKIAAKIA", "𝄞"]
    rows = [(i, "".join(rng.choices(bits, k=rng.randint(0, 16)))) for i in range(600)]
    rows += [(600, "token=abcdefghijkl " * 700), (601, None), (602, "")]
    got = {r.doc_id: r for r in secrets.find_secrets(_table(spark, rows), [0.0] * secrets.SIZE ** 2).collect()}
    assign = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for d, t in rows:
        want = [(m.start(), 0, m.end()) for m in assign.finditer(t or "") if len(m.group(2)) >= 12]
        want += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t or "") if len(m.group()) >= 18]
        want += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t or "") if len(m.group()) >= 16]
        assert [(s.start, s.order, s.end) for s in got[d].base] == sorted(want), t
        assert got[d].spans == got[d].base


def test_random_strings_are_found(spark):
    rng = random.Random(4)
    chars = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    key = lambda: "".join(rng.choices(chars, k=24))
    word = lambda: "".join(rng.choices(["ment", "tion", "inter", "able", "form", "ation", "con"], k=5))
    rows = [(i, f"{word()} token={key()} {word()}") for i in range(200)]
    rows += [(i, " ".join(word() for _ in range(9))) for i in range(200, 400)] + [(500, f"see {key()} here"), (501, f"see {word()} here")]
    got = {r.doc_id: [s.kind for s in r.spans] for r in secrets.find_secrets(_table(spark, rows)).collect()}
    assert got[500] == ["markov"] and got[501] == [] and all(got[i] == ["assign"] for i in range(200))


def test_held_out_languages(spark, documents):
    out = language.identify(documents, language.fit_languages(documents)).toPandas()
    held = out[[zlib.crc32(str(d).encode()) % 3 == 1 for d in out.doc_id]]
    assert (held.lang == held.lang_pred).mean() > 0.98 and held.score.between(0, 1).all()


def test_held_out_quality(spark, documents):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    out = quality.score_quality(documents, quality.fit_quality(documents, labels)).toPandas()
    out = out.merge(labels.toPandas(), on="doc_id")
    held = out[[zlib.crc32(str(d).encode()) % 3 == 1 for d in out.doc_id]]
    assert (held.quality == held.predicted).mean() > 0.97


def test_leaks_of_the_benchmark(spark, documents):
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    parts = decontam.question_and_answer(items)
    texts = {r.doc_id: r.text or "" for r in documents.collect()}
    want = {(d, r.item_id) for r in items.collect() for d, t in texts.items() if r.text in t}
    one = {(r.doc_id, r.item_id) for r in decontam.leaks(documents, parts).collect()}
    many = {(r.doc_id, r.item_id) for r in decontam.leaks(documents, parts, max_words=400).collect()}
    assert want and one == want and many == want


def test_pipeline(spark):
    import corpus_pipeline
    sf, columns = SF, ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    sizes = [docs.count()]
    from touchline.llm.text import stored
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, sf), "stage")
        sizes.append(docs.count())
        if name != "mixing":
            assert docs.columns == columns
            assert docs.join(before.select("doc_id"), "doc_id", "left_anti").isEmpty()
        if name == "near_duplicates":
            texts = {r.doc_id: r.text for r in before.collect()}
            kept = {r.doc_id for r in docs.collect()}
            assert kept == {root for _, root in _naive_components(texts, 5).values()}
        if name == "decontamination":
            gone = before.join(docs.select("doc_id"), "doc_id", "left_anti").collect()
            assert {r.doc_id for r in gone} == {r.doc_id for r in before.collect() if any(t in (r.text or "") for t in items)}
        if name == "pii":
            assert docs.filter(docs.text.rlike(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")).isEmpty()
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] == sizes[4] and sizes[5] > 0
