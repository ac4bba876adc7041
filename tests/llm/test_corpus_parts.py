"""The parts that run inside tasks, against brute force."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa

from touchline.llm import decontam, fingerprint, language, lm, neardup, pii, quality, repeats, text


def _texts(*rows):
    return text.texts(pa.array(rows, pa.string()))


def test_words_never_cross_rows():
    rows = ["ab c", "", None, "D\x0be", " x ", "c ab"]
    data, offsets = _texts(*rows)
    words, row, start, end = text.word_hashes(data, offsets)
    raw = data.tobytes()
    got = [(int(r), raw[a:b].decode()) for r, a, b in zip(row, start, end)]
    assert got == [(0, "ab"), (0, "c"), (3, "D"), (3, "e"), (4, "x"), (5, "c"), (5, "ab")]
    assert words[0] == words[-1] and words[1] == words[-2] and len(set(words.tolist())) == 5


def test_pieces_hold_whole_rows():
    batch = pa.record_batch({"text": ["a" * n for n in (5, 50, 3, 0, 7, 100)]})
    parts = list(text.pieces(batch, most=60))
    assert [p.column("text").to_pylist() for p in parts] == [["a" * 5, "a" * 50, "aaa", ""], ["a" * 7], ["a" * 100]]


def _match(bodies):
    places = [(i, j) for i, b in enumerate(bodies) for j in range(len(b))]

    def common(x, y):
        k = 0
        while k < min(len(x), len(y)) and x[k] == y[k]:
            k += 1
        return k
    return [max((common(bodies[i][j:], bodies[k][m:]) for k, m in places if (k, m) != (i, j)), default=0) for i, j in places]


def test_matching_statistics():
    rng = random.Random(1)
    for _ in range(40):
        base = bytes(rng.choice(b"ab") for _ in range(60))
        bodies = [bytearray(base[rng.randint(0, 20):rng.randint(30, 60)]) for _ in range(rng.randint(1, 6))]
        for b in bodies:
            b[rng.randrange(len(b))] = ord("c")
        bodies = [*map(bytes, bodies), b"aaaaaaaa"]
        index = repeats.RunLengthIndex(bodies)
        assert index.matching_statistics().tolist() == _match(bodies)
        assert index.run_length.sum() == sum(map(len, bodies))


def test_stretches_cover_each_window_once():
    rng = np.random.default_rng(3)
    rows = ["".join(rng.choice(list("ab"), n)) for n in (0, 10, 49, 50, 51, 700)] + ["a" * 300]
    data, offsets = _texts(*rows)
    row, begin, last, anchor, content = repeats.stretches(data, offsets, 50)
    seen = [(r, s - offsets[r]) for r, a, b in zip(row, begin, last) for s in range(a, b + 1)]
    assert sorted(seen) == [(r, s) for r, t in enumerate(rows) for s in range(len(t) - 49)]


def test_slices_of_a_long_text_hold_each_window_once(monkeypatch):
    monkeypatch.setattr(repeats, "SLICE", 64)
    rng = random.Random(8)
    for n in (0, 19, 64, 65, 108, 109, 110, 300):
        body = "".join(rng.choices("abcd", k=n))
        starts = []
        for data, offsets, rows, first in repeats.slices(pa.record_batch({"text": [body]}), 20):
            assert data.tobytes().decode() == body[first:first + len(data)] and rows.tolist() == [0]
            starts += range(first, first + len(data) - 19)
        assert starts == list(range(n - 19))


def test_odd_sketch_keeps_similar_pairs():
    rng = np.random.default_rng(5)
    limit = neardup.sketch_limit()
    for size in (5, 40, 800):
        for _ in range(30):
            shared = rng.integers(1, 1 << 62, size, dtype=np.uint64)
            gone = max(0, int(size * 0.11))
            a = np.concatenate([shared[gone:], rng.integers(1, 1 << 62, gone, dtype=np.uint64)])
            s = neardup.odd_sketch(neardup.min_samples(np.concatenate([shared, a]), np.array([size, size])))
            assert np.bitwise_count(s[0] ^ s[1]).sum() <= limit
    far = neardup.odd_sketch(neardup.min_samples(rng.integers(1, 1 << 62, 400, dtype=np.uint64), np.array([200, 200])))
    assert np.bitwise_count(far[0] ^ far[1]).sum() > limit


def test_wand_finds_all_above_threshold():
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    items = [" ".join(rng.choices(vocabulary, weights, k=rng.randint(3, 25))) for _ in range(150)]
    index = decontam.Index(list(range(150)), items, [""] * 150)
    hits = 0
    for _ in range(150):
        passage = " ".join(rng.choices(vocabulary, weights, k=rng.randint(5, 40)))
        words, _ = decontam.plain_words(*_texts(passage))
        at = np.searchsorted(index.terms, words)
        terms = sorted({int(t) for t, w in zip(at, words) if t < len(index.terms) and index.terms[t] == w})
        scores = {}
        for t in terms:
            for i, w in zip(index.items[t], index.weights[t]):
                scores[i] = scores.get(i, 0) + w
        want = {i for i, s in scores.items() if s >= index.threshold - 1e-9}
        got = dict(index.retrieve(terms))
        assert set(got) == want and all(abs(got[i] - scores[i]) < 1e-9 for i in got)
        hits += len(want)
    assert hits > 100


def test_search_equals_every_passage_in_full():
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(400)]
    items = [[rng.choice(vocabulary) for _ in range(rng.randint(8, 30))] for _ in range(40)]
    index = decontam.Index(list(range(40)), [" ".join(x) for x in items], [""] * 40)
    rows = []
    for k in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(0, 300))]
        if k % 3 == 0:
            cut = rng.randint(0, len(words))
            words[cut:cut] = [w.upper() + "," for w in items[k % 40]]
        rows.append(" ".join(words))
    hits = {(r, i) for r, i, *_ in index.search(pa.record_batch({"text": rows}), 0.8)}
    plain = [re.findall(r"\w+", t.lower()) for t in rows]
    want = {(r, i) for r, words in enumerate(plain) for i, item in enumerate(items)
            if any(words[a:a + len(item)] == item for a in range(len(words)))}
    assert want and want <= hits


def test_marginals_on_a_tree():
    rng = np.random.default_rng(0)
    unary, step, same = rng.normal(size=(4, 3)), rng.normal(size=(3, 3)), rng.normal(size=(3, 3))
    chain, skip = np.array([[0, 1], [1, 2]]), np.array([[1, 3]])
    want = np.zeros((4, 3))
    for y in itertools.product(range(3), repeat=4):
        p = np.exp(sum(unary[i, y[i]] for i in range(4)) + step[y[0], y[1]] + step[y[1], y[2]] + same[y[1], y[3]])
        for i in range(4):
            want[i, y[i]] += p
    want /= want.sum(axis=1, keepdims=True)
    assert np.allclose(pii.marginals(unary, chain, skip, step, same), want, atol=5e-3)


def test_skip_links_carry_a_label():
    same = np.eye(2) * 3
    unary = np.array([[0.0, 4.0], [0.2, 0.0]])
    alone = pii.marginals(unary, np.zeros((0, 2)), np.zeros((0, 2)), np.zeros((2, 2)), same)
    linked = pii.marginals(unary, np.zeros((0, 2)), np.array([[0, 1]]), np.zeros((2, 2)), same)
    assert alone[1, 1] < 0.5 < 0.85 < linked[1, 1]


def _plain_pii(t):
    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
    out = []
    for k, p in enumerate(patterns):
        for m in re.finditer(p, t):
            digits = re.sub(r"[^0-9]", "", m.group())
            if (k == 0 or k == 1 and all(int(x) <= 255 for x in m.group().split("."))
                    or k == 2 and 13 <= len(digits) <= 19 and pii.luhn(digits) or k == 3 and 9 <= len(digits) <= 15):
                out.append((k, m.start(), m.end()))
    return out


def test_base_spans_of_personal_data():
    rng = random.Random(6)
    bits = ["a", "b.c", "@", ".", "-", "+1", "7", "255", "256", "4111 1111 1111 1111", "10.0.0.1", " ", "(555)", "é", "x@y.z", "_%"]
    for _ in range(3000):
        t = "".join(rng.choices(bits, k=rng.randint(1, 14)))
        assert pii.base_spans(t) == _plain_pii(t), t
    assert pii.base_spans("1" * 6000 + ".1.1.1") == []


def test_order_minhash():
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(300)]
    t = " ".join(words)
    own = fingerprint.signature(t.encode())
    like = lambda x: fingerprint.likeness(own, fingerprint.signature(x.encode()))
    assert like(t) == 1 and like("") == 0 and fingerprint.likeness(*[fingerprint.signature(b"")] * 2) == 1
    little, much = " ".join(words[:290] + ["zz"] * 10), " ".join(words[:150] + words[:150][::-1])
    swapped = " ".join(w for k in range(0, 300, 10) for w in reversed(words[k:k + 10]))
    assert like(little) > 0.8 > like(much) and like(swapped) < like(little)
    assert fingerprint.signature(b"ab").any()


def test_order_minhash_of_texts_beyond_packing(monkeypatch):
    data = (b"abcdefgh" * 40 + b"xyzxyz") * 3
    want = fingerprint.signature(data)
    monkeypatch.setattr(fingerprint, "_LOW", np.uint64((1 << 24) - 1))
    high = np.frombuffer(b"\x01\x02\x03\x04\x05\x06\x07\x08" * 20, np.uint64)
    low = np.uint64((1 << 24) - 1)
    order = np.argsort(high & ~low, kind="stable")
    got = fingerprint._ordered(high)
    assert got[1].tolist() == order.tolist() and want.any()


def _automaton():
    rng = random.Random(9)
    docs = [[rng.choice("aabbbcde") for _ in range(rng.randint(0, 30))] for _ in range(60)]
    names = sorted({w for d in docs for w in d}) + ["</s>"]
    place = {w: i for i, w in enumerate(names)}
    rows = [[place[w] for w in d] + [place["</s>"]] for d in docs]
    count = lambda n: {g: sum(tuple(r[i:i + n]) == g for r in rows for i in range(len(r)))
                       for g in {tuple(r[i:i + n]) for r in rows for i in range(len(r) - n + 1)}}
    one, two, three = count(1), count(2), count(3)
    counts = np.array([one[(i,)] for i in range(len(names))])
    total = int(counts.sum())
    model = lm.Automaton(np.arange(len(names), dtype=np.uint64), counts, total, len(names))
    two = {g: n for g, n in two.items() if n >= 4}
    three = {g: n for g, n in three.items() if n >= 4 and g[:2] in two and g[1:] in two}
    for kept in (two, three):
        grams = sorted(kept)
        model.grams.append((np.array(grams), np.array([kept[g] for g in grams])))
    model.close()
    return model, rows


def test_automaton_is_a_distribution():
    model, rows = _automaton()
    w = len(model.words)
    unseen = 1 / model.denominator
    for row in rows[:20]:
        for stop in range(min(4, len(row))):
            prefix = np.array(row[:stop], np.int64)
            base = model.traverse(prefix, np.array([len(prefix)]))[0] if stop else 0.0
            mass = 0.0
            for word in [*range(w), -1]:
                whole = np.append(prefix, word)
                p = 10 ** (model.traverse(whole, np.array([len(whole)]))[0] - base)
                mass += p * unseen if word < 0 else p
            assert abs(mass - 1) < 1e-9


def test_automaton_walks_texts_together_as_alone():
    model, rows = _automaton()
    size = np.array([len(r) for r in rows])
    both = model.traverse(np.concatenate(rows), size)
    alone = [model.traverse(np.array(r), np.array([len(r)]))[0] for r in rows]
    assert np.allclose(both, alone)


def test_kneser_ney_is_a_distribution():
    model = language.train({"x": {"abba": 3, "ab": 2, "b": 1, "cab": 1}, "y": {"ccc": 4, "ac": 1}})
    letters = "abc\x03"
    for k in range(language.ORDER):
        for context in map("".join, itertools.product("abc", repeat=k)):
            # differences of whole-word scores hold the next character's probability for every continuation
            mass = np.zeros(2)
            for c in letters:
                codes = "\x02" + context + c
                mass += np.exp(_next(model, codes))
            mass += np.exp(_next(model, "\x02" + context + "?"))
            assert np.allclose(mass, 1, atol=1e-5)


def _next(model, codes):
    """Log probability of the last character, by plain backing off."""
    score = np.zeros(2)
    for k in range(min(language.ORDER, len(codes)), 0, -1):
        table = model["tables"][k - 1]
        hashed, before = _hash(codes[-k:]), _hash(codes[-k:-1])
        at, known = language._find(table["keys"], np.array([hashed], np.uint64))
        if known[0]:
            return score + table["logp"][at[0]]
        at, known = language._find(table["contexts"], np.array([before], np.uint64))
        if known[0]:
            score = score + table["backoff"][at[0]]
    return score + model["floor"]


def _hash(gram):
    if not gram:
        return np.uint64(0)
    one = [text.mix(np.array([ord(c)], np.uint64) * text.GOLD + np.uint64(1))[0] for c in gram]
    h = one[-1]
    for older in reversed(one[:-1]):
        h = text.mix(np.array([h]) * text.GOLD + older)[0]
    return h


def test_prior_and_risk():
    rng = np.random.default_rng(1)
    one = lambda x: np.hstack([x, np.ones((len(x), 1))])
    positive = one(rng.normal(2, 1, (2000, 2)))
    mixed = one(np.concatenate([rng.normal(2, 1, (1400, 2)), rng.normal(-2, 1, (600, 2))])[rng.permutation(2000)])
    prior = quality.estimate_prior(positive, mixed)
    assert 0.6 < prior < 0.8
    w = quality.fit_nnpu(positive, mixed, prior)
    fresh = one(np.concatenate([rng.normal(2, 1, (500, 2)), rng.normal(-2, 1, (500, 2))]))
    assert ((fresh @ w > 0) == (np.arange(1000) < 500)).mean() > 0.97


def test_order_of_is_a_stable_argsort():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3000):
        for most in (0, 5, 1 << 40, (1 << 64) - 1):
            values = rng.integers(0, most, n, dtype=np.uint64, endpoint=True)
            values[n // 2:] = values[rng.integers(0, n, n - n // 2)] if n else values
            assert np.array_equal(lm.order_of(values), np.argsort(values, kind="stable"))
    values = np.arange(3000, dtype=np.uint64)[::-1] + np.uint64(1 << 63)  # high bits are shared by many, or by a few
    assert np.array_equal(lm.order_of(values), np.argsort(values, kind="stable"))
    values = np.append(rng.integers(0, 1 << 63, 5000, dtype=np.uint64), np.array([(1 << 63) + 1, 1 << 63], np.uint64))
    assert np.array_equal(lm.order_of(values), np.argsort(values, kind="stable"))


def test_backoff_is_settled_in_arrays(spark, monkeypatch):
    """Counts and rests of all n-grams equal plain counting; no n-gram is a row of its own in a join."""
    monkeypatch.setattr(lm, "TABLE_ROWS", 3)
    monkeypatch.setattr(lm, "CHUNK_TOKENS", 8)
    told = ["a b a b c", "a b c d", "b c a b", "", "d"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(told * 2)], "doc_id long, text string").selectExpr("doc_id", "true AS _train", "text")
    grams = lm.gram_counts(lm.chunks(docs.repartition(2), ["doc_id"]).cache(), 4)
    table = lm.backoff_table(grams)
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
    tokens, size = lm.token_hashes(docs.select("text").toArrow().combine_chunks().to_batches()[0])
    counts, after = {}, {}
    for level, (key, left, there) in enumerate(lm.text_grams(tokens, size, 3), 1):
        keys, first, n = lm.distinct(key[there])
        for k, x, c in zip(keys.tolist(), left[there][first].tolist(), n.tolist(), strict=True):
            if level == 1 or c >= 2:
                counts[k] = c
                if level > 1:
                    after.setdefault(x, []).append(c)
    rest = {k: 1 - (sum(after[k]) - lm.DISCOUNT * len(after[k])) / c if k in after else 1.0 for k, c in counts.items()}
    got = {}
    for r in table.collect():
        for k, c, x in zip(lm.unpack_keys(bytes(r.keys)).tolist(), np.frombuffer(r.n, np.int64), np.frombuffer(r.rest), strict=True):
            assert k not in got
            got[k] = (c, x)
    assert {k: c for k, (c, _) in got.items()} == counts and all(abs(x - max(rest[k], 1e-12)) < 1e-12 for k, (_, x) in got.items())
    assert grams.agg({"tokens": "sum"}).first()[0] == len(tokens)
