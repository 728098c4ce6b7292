"""Whitening against a plain eigensolver, resampling against a plain walk, personal data against the patterns and all labellings."""

import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gazette.llm import pii, resampling, whitening

# Whitening


def _spectrum(*values):
    q = np.linalg.qr(np.random.default_rng(len(values)).standard_normal((len(values), len(values))))[0]
    m = q @ np.diag(np.array(values, float)) @ q.T
    return (m + m.T) / 2


@pytest.mark.parametrize("matrix", [
    _spectrum(*range(1, 65)), _spectrum(*[5] * 3, 4.0000001, 4, *[1] * 15), _spectrum(*[2] * 12), np.eye(10), np.diag([3.0, 2, 1, 0, 0, 0]), np.eye(1) * 4,
    _spectrum(*10.0 ** np.arange(14, -16, -1)), _spectrum(38534, *np.linspace(19423, 17431, 30), *[100] * 20), _spectrum(9, 8, 7, 6, 5, 4, 3, 2, 2, 2, 1),
])
def test_contours_find_the_components_of_a_plain_solver(matrix):
    e, u = whitening.leading(matrix, 8)
    wanted = np.linalg.eigvalsh(matrix)[::-1]
    assert len(e) == min(8, int((wanted > wanted[0] * len(matrix) * 1e-14).sum()))
    assert np.abs(e - wanted[: len(e)]).max() < 1e-13 * wanted[0]
    assert np.abs(u.T @ u - np.eye(len(e))).max() < 1e-13
    assert np.abs(matrix @ u - u * e).max() < 1e-12 * wanted[0]


def test_inertia_counts_without_eigenvalues_near_a_zero_pivot():
    m = np.array([[0.0, 1, 0], [1, 0, 0], [0, 0, -3]])
    assert [whitening.above(m, x) for x in (-4, -2, 0, 2)] == [3, 2, 1, 0]
    draw = np.random.default_rng(3)
    for _ in range(50):
        a = draw.integers(-2, 3, (7, 7)).astype(float)
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        for at in (values[:-1] + values[1:])[np.diff(values) > 1e-6] / 2:
            assert whitening.above(a, at) == int((values > at).sum())
    assert whitening.leading(np.zeros((3, 3)), 8)[0].shape == (0,) and whitening.leading(np.zeros((0, 0)), 8)[0].shape == (0,)


KIND = "vec_id long, embedding array<float>, label int, n long, i int, x string, component int"


def test_whitened_rows_equal_numpy_and_unfit_vectors_are_left_out(spark):
    draw = np.random.default_rng(4)
    good = [(k, [float(np.float32(v)) for v in draw.standard_normal(12) * np.arange(1, 13)]) for k in range(300)]
    good += [(7, good[7][1]), (7, good[9][1]), (None, good[3][1])]  # repeated rows, ids and a null id
    bad = [(900, None), (901, [1.0, None] + [0.0] * 10), (902, [float("nan")] * 12), (903, [float("inf")] + [0.0] * 11)]
    df = spark.createDataFrame([(i, v, 1, 2, 3, "x", 4) for i, v in good + bad], KIND).repartition(7)
    got = whitening.whiten(df, 5).collect()
    x = np.floor(np.array([v for _, v in good]).astype(np.float32).astype(float) * 1024).astype(int) + 100_000
    n, s = len(x), x.sum(0)
    v = np.cov(x.T, bias=True)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:5], u[:, ::-1][:, :5]
    white = (x - s / n) @ u / np.sqrt(e)
    assert len(got) == 5 * n and {r.n for r in got} == {n} and not {r.vec_id for r in got} & {900, 901, 902, 903}
    assert Counter((r.vec_id, int(r.deviation)) for r in got if r.component == 1) == Counter((i, int(((n * y - s) ** 2).sum())) for (i, _), y in zip(good, x, strict=True))
    mine = {(r.vec_id, r.component): r.whitened for r in got if r.vec_id in range(10, 290)}
    for c in range(5):
        column = np.array([mine[k, c + 1] for k in range(10, 290)])
        assert min(np.abs(column - white[10:290, c]).max(), np.abs(column + white[10:290, c]).max()) < 1e-9
    assert all(abs(r.explained - e[r.component - 1] / np.trace(v)) < 1e-12 and r.identity_error < 1e-9 for r in got)
    again = whitening.whiten(df.repartition(3), 5).collect()
    key = lambda r: (r.vec_id or -1, r.component, r.deviation, r.whitened)
    assert all((a.vec_id, a.component, a.deviation, a.explained) == (b.vec_id, b.component, b.deviation, b.explained) and abs(a.whitened - b.whitened) < 1e-12 for a, b in zip(sorted(got, key=key), sorted(again, key=key), strict=True))


def test_whitening_of_few_equal_short_and_large_vectors(spark):
    make = lambda rows: spark.createDataFrame([(k, v, 0, 0, 0, "", 0) for k, v in enumerate(rows)], KIND)
    assert whitening.whiten(make([[1.0]]).limit(0)).count() == 0
    assert whitening.whiten(make([[1.0, 2.0]] * 5)).count() == 0  # nothing varies
    assert whitening.whiten(make([[], []])).count() == 0
    two = whitening.whiten(make([[0.0, 1.0], [2.0, 1.0]])).collect()
    assert sorted((r.component, round(abs(r.whitened), 9), round(r.explained, 9)) for r in two) == [(1, 1.0, 1.0)] * 2
    short = whitening.whiten(make([[1.0], [0.0, 0.0], [3.0, 1.0], [0.5, 2.0]])).collect()
    filled = whitening.whiten(make([[1.0, 0.0], [0.0, 0.0], [3.0, 1.0], [0.5, 2.0]])).collect()
    assert sorted((r.vec_id, r.component, r.whitened) for r in short) == sorted((r.vec_id, r.component, r.whitened) for r in filled) and len(short) == 8
    far = whitening.whiten(make([[1e9, 1.0], [-1e9, 2.0], [3e8, 0.5]])).collect()
    x = [[1024 * 10**9 + 100_000, 101_024], [-1024 * 10**9 + 100_000, 102_048], [int(np.floor(float(np.float32(3e8)) * 1024)) + 100_000, 100_512]]
    s = [sum(c) for c in zip(*x, strict=True)]
    assert {r.vec_id: int(r.deviation) for r in far} == {k: sum((3 * a - b) ** 2 for a, b in zip(row, s, strict=True)) for k, row in enumerate(x)}


# Resampling

_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_SMALL = {c: c + 32 for c in range(65, 91)}


def _features(text):
    words = _WORD.findall((text or "").translate(_SMALL))
    return words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)], len(words)


def _plain(docs, target, percent=25, least=20, buckets=10_000):
    def tally(texts):
        out = [0] * buckets
        for t in texts:
            for f in _features(t)[0]:
                out[zlib.crc32(f.encode()) % buckets] += 1
        return out

    s, t = tally([d[1] for d in docs]), tally(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t, strict=True)]
    rows = []
    for i, text in docs:
        f, n = _features(text)
        weight = math.floor(sum(gain[zlib.crc32(x.encode()) % buckets] for x in f) / len(f)) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= least))
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = percent * len(order) // 100
    places = Counter()
    for k, r in enumerate(order):
        places[(*r[:4], k + 1 if k < drawn else None)] += 1
    for r in rows:
        if not r[4]:
            places[(*r[:4], None)] += 1
    return places


def test_resampling_equals_a_plain_walk(spark, monkeypatch):
    draw = random.Random(5)
    words = "The RIVER and über house, of l1ght Éa small-town paper ß 北京".split()
    docs = [(k, " ".join(draw.choice(words) for _ in range(draw.choice((3, 19, 20, 21, 90))))) for k in range(200)]
    docs += [(300, None), (301, ""), (302, " ., "), (303, "word " * 50_000), (5, docs[5][1]), (5, docs[5][1]), (None, docs[8][1])]
    target = ["the river and the house", None, "", "paper of light"]
    df = spark.createDataFrame([(i, t, 1, 2, 3, 4, 5) for i, t in docs], "doc_id long, text string, score int, rank int, weight int, bucket int, n int").repartition(5)
    goal = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    for slice_, runs in ((1 << 20, 384), (16, 3)):
        monkeypatch.setattr(resampling, "SLICE", slice_)
        assert Counter(tuple(r) for r in resampling.resample(df, goal).collect()) == _plain(docs, target)
    assert resampling.resample(df.limit(0), goal).count() == 0
    assert Counter(tuple(r) for r in resampling.resample(df, goal.limit(0), 100, 1).collect()) == _plain(docs, [], 100, 1)


def test_runs_of_words_are_whole_across_slices(monkeypatch):
    text = "Ab é c12 d-e f " * 40
    words = _WORD.findall(text.translate(_SMALL))
    wanted = sorted(zlib.crc32(" ".join(words[a : a + k]).encode()) for k in (1, 2, 3) for a in range(len(words) - k + 1))
    for size in (1 << 20, 200, 7, 1):
        monkeypatch.setattr(resampling, "SLICE", size)
        assert sorted(c for x in resampling.codes(text.encode(), 3) for c in x.tolist()) == wanted
    assert list(resampling.codes(None)) == [] and list(resampling.codes(b" . ")) == []


def test_sorted_ranks_split_ties_and_repeated_rows(spark):
    draw = random.Random(6)
    rows = [(draw.choice((1, 1, 1, 2, -5)), draw.choice((1, 1, 2, None))) for _ in range(4_000)]
    df = spark.createDataFrame(rows, "score long, doc_id long").repartition(9)
    ranked = resampling.sorted_ranks(df, runs=6)
    got = sorted((r["rank"], r.score, r.doc_id) for r in ranked.collect())
    assert [g[0] for g in got] == list(range(1, 4_001))
    assert [g[1:] for g in got] == sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0))
    assert resampling.sorted_ranks(df.limit(0)).count() == 0
    assert [r["rank"] for r in resampling.sorted_ranks(df.limit(1)).collect()] == [1]


# Personal data

_PATTERNS = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
CARD, OTHER = "4845168114407329", "7536784127813054"


def _base(text):
    out = []
    for kind, pattern in enumerate(_PATTERNS, 1):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
            check = sum(v - 9 * (v > 9) for v in doubled) % 10 == 0
            if kind == 1 or (kind == 2 and all(int(p) <= 255 for p in m[0].split("."))) or (kind == 3 and 16 <= len(digits) <= 19 and check) or (kind == 4 and 8 <= len(digits) <= 15):
                out.append((kind, m.start(), m.end()))
    return out


def test_patterns_equal_plain_matching():
    draw = random.Random(7)
    bits = ["1", "23", "456", "+", "@", ".", "a", "b.c", " ", "-", "(", ")", CARD, "x@y.zz", "é", "255", "%", "\n", "0097"]
    for _ in range(8_000):
        text = "".join(draw.choice(bits) for _ in range(draw.randint(0, 30)))
        assert pii.base_spans(text) == _base(text), text


def test_patterns_and_tokens_are_linear_on_long_runs():
    for text in ("9" * 1_000_000, "a" * 1_000_000, "1." * 300_000, "+1" + "2 " * 100_000, "@" * 500_000, "a@b." * 100_000, "1 " * 100_000):
        began = time.time()
        found = pii.tokens(text, pii.base_spans(text))
        assert time.time() - began < 15 and 2 * len(found) >= len(found.pairs)


def test_messages_on_a_tree_are_sums_over_all_labellings():
    draw = np.random.default_rng(8)
    node, potentials = draw.standard_normal((5, 3)), draw.standard_normal((2, 3, 3))
    edges, kind = np.array([(0, 1), (1, 2), (1, 3), (3, 4)]), np.array([0, 1, 0, 1])
    wanted = np.zeros((5, 3))
    for labels in itertools.product(range(3), repeat=5):
        p = math.exp(sum(node[t, x] for t, x in enumerate(labels)) + sum(potentials[k][labels[a], labels[b]] for (a, b), k in zip(edges, kind, strict=True)))
        for t, x in enumerate(labels):
            wanted[t, x] += p
    got = pii.marginals(node, edges, kind, potentials)
    assert np.abs(got - wanted / wanted.sum(1, keepdims=True)).max() < 1e-9
    alone = pii.marginals(node, np.zeros((0, 2), int), np.zeros(0, int), potentials)
    assert np.abs(alone - np.exp(node) / np.exp(node).sum(1, keepdims=True)).max() < 1e-9


def test_chain_weights_follow_the_slope_of_the_likelihood():
    features = ((0, 11), (0, 13), (0, 20))
    patterns = [(features, (4, 6, 6), 3), (features[:1], (0,), 5), (((0, 8),), (3,), 2)]
    weights, follows = pii.fit_chain(patterns, rounds=150)
    score = lambda f, y: sum(weights[list(x)].sum(0)[k] for x, k in zip(f, y, strict=True)) + sum((follows + pii.allowed())[a, b] for a, b in zip(y, y[1:], strict=False)) + pii._START[y[0]]
    for f, y, _ in patterns:
        total = sum(math.exp(score(f, z)) for z in itertools.product(range(7), repeat=len(f)))
        assert math.exp(score(f, y)) / total > 0.8


@pytest.fixture(scope="module")
def people(spark):
    draw = random.Random(9)
    words = "the river and house of light over small town with paper".split()
    prose = lambda n: " ".join(draw.choice(words) for _ in range(n))

    def card():
        head = "".join(draw.choice("0123456789") for _ in range(15))
        return next(head + str(c) for c in range(10) if pii.luhn(head + str(c)))

    rows = []
    for k in range(400):
        thing = (f"a.{k}@mail{k % 9}.example.com", f"{draw.randint(1, 255)}.{draw.randint(0, 255)}.{k % 256}.7", card(), f"+1 ({draw.randint(100, 999)}) 555-{draw.randint(1000, 9999)}", f"in {1900 + k % 120}, no {k}", "".join(draw.choice("0123456789") for _ in range(12)), f'"{k}af{k}b0{k}"')[k % 7]
        rows.append((k, f"{prose(8)} {thing} {prose(6)}."))
    rows += [(1000, f"{prose(5)} {CARD} {prose(5)} {CARD} 4550997810720808 {prose(3)}"), (1001, f"{prose(4)} +1 (826) 555-4081 190.137.223.204 {prose(3)}")]
    rows += [(1002, f"{prose(9)} in 1990 12 34 and 5. 6. 7 of {prose(5)} 2020-11-12 {prose(4)} 123456789012 {OTHER}."), (1003, None), (1004, ""), (None, f"x {CARD}"), (7, rows[7][1]), (7, rows[7][1])]
    rows += [(1005, "word " * 30_000 + CARD + " word" * 1_000)]
    return spark.createDataFrame([(i, t, "e", "s", 1) for i, t in rows], "doc_id long, text string, spans string, label string, features int")


def test_field_adds_what_patterns_lose_and_leaves_the_rest(people):
    got = pii.personal_data(people).collect()
    texts = people.collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in texts)
    by = {r.doc_id: r for r in texts}
    for r in got:
        text = by[r.doc_id].text or ""
        base = _base(text)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b[0] == k for b in base) for k in range(1, 5)]
        assert r.base_sha256 == hashlib.sha256(pii.written(base).encode()).hexdigest()
        assert set(filter(None, pii.written(base).split(","))) <= set(r.spans.split(","))
        if r.doc_id not in (1000, 1001):
            assert r.n_added == 0, (text, r.spans)
    rows = {r.doc_id: r for r in got}
    second = by[1000].text.rindex(CARD)
    assert f"card:{second}:{second + 16}" in rows[1000].spans.split(",")  # two cards side by side are no match of the pattern
    start = by[1001].text.index("+1")
    assert f"phone:{start}:{start + len('+1 (826) 555-4081')}" in rows[1001].spans.split(",")


def test_alike_tokens_share_their_label():
    weights = np.zeros((pii.WIDTH, len(pii.LABELS)))
    weights[:, 0] = 0.1  # by itself any open token is rather none
    model = pii.Model(weights, np.zeros((7, 7)), pii.fit_alike({(0, 0): 10.0, (3, 3): 50.0}))
    broken = CARD[:-1] + "0"  # one digit is wrong: the pattern drops it
    far = " and on" * 3_000
    text = f"pay {CARD}{far} pay {broken}"
    found = pii.tokens(text, pii.base_spans(text))
    assert list(found.label) == [3, -1] and list(found.pairs) == [0, 1]
    assert pii.added_spans([text], [found], model, 0.5) == [[(3, len(text) - 16, len(text))]]
    alone = f"pay {broken}"
    assert pii.added_spans([alone], [pii.tokens(alone, [])], model, 0.5) == [[]]


def test_no_documents_and_no_personal_data(spark, people):
    assert pii.personal_data(people.limit(0)).count() == 0
    plain = people.select("doc_id", F.lit("only words stand here").alias("text")).limit(3)
    assert {(r.spans, r.base_sha256) for r in pii.personal_data(plain).collect()} == {("", hashlib.sha256(b"").hexdigest())}
