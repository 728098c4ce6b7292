"""What SQL cannot express, against plain loops that follow the definition."""

import itertools
import math
import random
from collections import Counter, defaultdict
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from gazette.llm import fingerprint, html_extract, language, license_scan, neardup, packing, quality, toxicity


@pytest.fixture(scope="module")
def content_model():
    counts = defaultdict(float)
    for html in html_extract.labelled_pages():
        for key, n in html_extract.taught(html, True).items():
            counts[(*key[:2], str(key[2]), key[3])] += n
    return html_extract.Model(dict(counts))


@pytest.mark.parametrize("html", [
    "<div><p>One text.</p><a href=x>Two</a></div>", "<article><h1>Head</h1><p>Some longer text is here.</p></article>", "<nav><a>Menu</a></nav><p>Text.</p>",
    "<body><div class=ad>Buy</div><p>A</p>b</body>", "a<b>c</b>", "<form><p>Name</p></form><main>It was.</main>",
])
def test_marginals_equal_the_sum_over_all_labellings(content_model, html):
    tree = html_extract.Tree(html)
    found, silent, size = html_extract.observed(tree)
    live = [k for k in range(1, len(tree.tag)) if size[k] and not silent[k]]
    assert len(live) <= 8
    total, with_text = np.zeros(len(tree.tag)), 0.0
    everything = 0.0
    for labels in itertools.product(range(3), repeat=len(live) + 1):
        label = dict(zip([0, *live], labels, strict=True))
        weight = html_extract.ROOT[label[0]]
        for k in live:
            tag = tree.tag[k]
            weight *= content_model.pair.get(tag, content_model.pair[""])[label[tree.parent[k]]][label[k]]
            if tag == "#":
                weight *= label[k] != 2
            else:
                odds = [content_model.unary.get(("" if f.startswith("name") else tag, f), (0.0, 0.0)) for f in found[k]]
                weight *= math.exp(max(-12, min(12, sum(o[label[k] - 1] for o in odds)))) if label[k] else 1.0
        everything += weight
        if any(label[k] == 1 and tree.tag[k] == "#" for k in live):
            with_text += weight
        for k in live:
            total[k] += weight * (label[k] == 1)
    expected = total / everything
    best = max(expected[k] for k in live if tree.tag[k] == "#")
    if 0.02 < best < 0.5:
        expected = total / with_text
    got = content_model.marginals(tree)
    for k in live:
        if tree.tag[k] == "#":
            assert got[k] == pytest.approx(expected[k], abs=1e-6)


@pytest.mark.parametrize(("html", "text"), [
    ("<article>First part.<hr>Second part.", "First part. Second part."), ("<article>First.<p></p>Second.</article>", "First. Second."),
    ("<article><h1>T</h1><p>Before</p><![foo<p>After</p></article>", "T Before After"), ("<article><p>Text.</p><!-- never closed <p>tail", "Text."),
    ("<div>First part of it.<aside>Read this.</aside>Second part of it.</div>", "First part of it. Second part of it."),
    ("<article><p>Main text is here for you.</p></article><form>" + "Please fill in this very long form. " * 20 + "</form>", "Main text is here for you."),
    ("<form><nav><a href=x>Menu</a></nav><article><h1>Head</h1><p>Article text that is here.</p></article><input></form>", "Head Article text that is here."),
    ("<article><p>x < y &amp; z > w</p><p style='display:none'>no</p><p title='a>b'>c</p></article>", "x < y & z > w c"), ("plain &lt; text", "plain < text"),
    ("<article><p>Cut off <b>here", "Cut off here"), ("<article><p>One</p></p>two<br/>three</article>", "One two three"), ("<script>var a = '<p>no</p>'", ""),
])
def test_blocks_and_broken_markup(content_model, html, text):
    assert content_model.text(html) == text


def test_trees_take_time_in_proportion_to_the_page():
    import time

    for html in ("<b>" * 100_000 + "</i>" * 100_000, "<li>x" * 50_000, "<div>" * 20_000 + "<li>" * 20_000, '<a b="c ' * 50_000, "<!--" * 100_000, "<p>a</q>" * 50_000):
        began = time.process_time()
        html_extract.Tree(html)
        assert time.process_time() - began < 2


def test_license_scores_equal_plain_sums_and_nothing_is_lost_by_needed_words(spark):
    fill = random.Random(3)
    sentences = [" ".join(fill.choice("river house light paper small town north the of and that water for to in was".split()) for _ in range(12)) + "." for _ in range(60)]
    texts = [(k, s) for k, s in enumerate(sentences)]
    texts += [(100 + k, x) for k, (_, x) in enumerate(license_scan.notices()[:90])] + [(300, sentences[0] + " " + license_scan.TEMPLATES["isc"][0]), (301, None), (302, ""), (None, "Released under the MIT License."), (100, texts[0][1])]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    made = license_scan.learn(df)
    got = license_scan.scan(df, made=made)
    every = spark.createDataFrame([(t,) for _, t in texts if t], "t string").select(F.explode(license_scan.words(F.col("t"))).alias("w")).distinct()
    free = license_scan.scan(df, made=replace(made, needed=sorted(r[0] for r in every.collect())))
    columns = ["doc_id", "paragraph", "family", "probability", "similarity", "confirmed"]
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, free.select(columns).collect()))
    assert len(made.needed) < 1000
    known, w, b = set(made.weights), made.weights, np.array(made.base)
    rows = {(r.doc_id, r.paragraph): r for r in got.collect()}
    for i, t in [x for x in texts if x[1] and x[0] is not None and x[0] >= 100][:40]:
        tokens = spark.createDataFrame([(t,)], "t string").select(license_scan.words(F.col("t"))).first()[0] if i % 13 == 0 else None
        if tokens is None or (i, 0) not in rows or rows[i, 0].paragraph:
            continue
        grams = {" ".join(tokens[k : k + n]) for n in (1, 2, 3) for k in range(len(tokens) - n + 1)} & known
        raw = b + sum((np.array(w[g]) for g in grams), np.zeros(len(b)))
        share = np.exp((raw - raw.max()) / made.heat)
        share /= share.sum()
        r = rows[i, 0]
        assert r.probability == pytest.approx(share[made.names.index(r.family)], abs=1e-6)
    assert not [i for i, _ in rows if i is not None and i < 60]


def test_license_names_and_bounded_needs(spark):
    texts = ["Licensed under the GPLv3.", "Distributed under the terms of the LGPL.", "SPDX-License-Identifier: MPL-2.0", "This work is licensed under CC BY-SA 4.0.", "Released under the BSD-3-Clause.", "License: Apache-2.0"]
    clean = ["The town is north of the river.", "Students at MIT built a house by the water.", "He has a licence to drive in the town.", "The version 3.0 was small."]
    fill = random.Random(14)
    clean += [" ".join(fill.choice("river house light paper small town north the of and that water for to in was".split()) for _ in range(fill.randint(5, 60))) + "." for _ in range(200)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts + clean)], "doc_id long, text string")
    got = {r.doc_id: r.family for r in license_scan.scan(docs).collect()}
    assert got == dict(enumerate(["gpl", "lgpl", "mpl", "cc-by-sa", "bsd", "apache"]))


def test_histogram_packing_equals_packing_one_by_one():
    draw = random.Random(4)
    lengths = sorted((draw.choice((draw.randint(1, 2048), draw.randint(1, 300), 7)) for _ in range(700)), reverse=True)
    packs: list[int] = []
    fresh = None  # the length of which each further piece opens a pack
    for length in lengths:
        shortest = min(range(len(packs)), key=lambda k: packs[k], default=None)
        if length != fresh and shortest is not None and packs[shortest] + length <= 2048:
            packs[shortest] += length
        else:
            packs.append(length)
            fresh = length
    placed, sequences, padding = packing.pack_histogram(Counter(lengths))
    used = defaultdict(int)
    for length, _, n, first, offset in sorted(placed, key=lambda x: x[4]):
        for k in range(first, first + n):
            assert used[k] == offset
            used[k] += length
    assert sequences == len(packs) and sorted(used.values()) == sorted(packs)
    assert padding == sum(2048 - x for x in packs if x & (x - 1))


def test_ids_are_those_of_the_tokenizer_with_its_added_tokens():
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    draw = random.Random(5)
    texts = ["a<|endoftext|>b", "<|endoftext|>", "", "<|endoftext", "ä ö​\U0001f600  x\t\n\r y", "a" * 3000, "  \n\n  "]
    texts += ["".join(draw.choice("ab zäß日\n\t 1.,'s<|>_") for _ in range(draw.randint(1, 80))) for _ in range(500)]
    for text in texts:
        assert packing.token_ids(text).tolist() == [*plain.encode(text, add_special_tokens=False).ids, 1]


def test_language_distance_equals_a_plain_one():
    draw = random.Random(6)
    text = " ".join("".join(draw.choice("abcdeéü") for _ in range(draw.randint(1, 7))) for _ in range(300)) + " 12 x_y, Zz"

    def plain(text):
        count = Counter()
        for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
            padded = f" {word} "
            for n in (1, 2, 3):
                count.update(g for k in range(len(padded) - n + 1) if (g := padded[k : k + n]) != " ")
        code = lambda g: sum(ord(c) << 21 * (len(g) - 1 - k) for k, c in enumerate(g))
        return [code(g) for g, _ in sorted(count.items(), key=lambda x: (-x[1], code(x[0])))]

    assert language.ranked(text, 300).tolist() == plain(text)[:300]
    made = {"a": plain(text)[:300], "b": plain(text[::-1])[:300]}
    model = language.Identifier(made)
    own = plain("bade cab eé " * 9)[:300]
    for k, lang in enumerate(model.langs):
        far = sum(abs(made[lang].index(g) - n) if g in made[lang] else 300 for n, g in enumerate(own))
        assert model.distances("bade cab eé " * 9)[k] == pytest.approx(far / (300 * len(own)))


def test_grams_of_long_texts_are_those_of_their_parts(monkeypatch):
    draw = random.Random(7)
    text = " ".join("".join(draw.choice("abcdé") for _ in range(draw.randint(1, 9))) for _ in range(3000))
    whole = [x.tolist() for x in language.counted([text])]
    monkeypatch.setattr(language, "PIECE", 100)
    monkeypatch.setattr(language, "AT_ONCE", 500)
    assert [x.tolist() for x in language.counted([text])] == whole


def test_viterbi_equals_the_cheapest_way_through_the_lattice():
    counts = defaultdict(int)
    for code in toxicity.trigram_codes("you are a moron and an idiot in the house of light on the river " * 20).tolist():
        counts[code] += 1
    channel = toxicity.Channel(dict(counts))

    def cost(word):
        a = b = 0
        total = 0.0
        for c in [*word, None]:
            z = 0 if c is None or c == " " else toxicity.symbol(c)
            total += float(channel.costs[(a * toxicity.SYMBOLS + b) * toxicity.SYMBOLS + z]) if z or b or c is None else 0.0
            a, b = (b, z) if z else (0, 0)
        return total

    for token in ("m0r0n", "1d!0t", "mooron", "h0u5e", "l!ght", "r1v3r", "i.d.i.o.t", "m o r o n", "m@@n"):
        ways = itertools.product(*channel.lattice(token))
        best = min((sum(p for _, p in way) + cost("".join(x for x, _ in way)), "".join(x for x, _ in way)) for way in ways)
        got = channel.decode(token)
        assert best[0] == pytest.approx(min(sum(p for _, p in w) + cost(got) for w in itertools.product(*channel.lattice(token)) if "".join(x for x, _ in w) == got), abs=1e-4), token


def test_network_equals_a_plain_convolution_and_numeric_gradients():
    net = quality.Network(3)
    net.out += 0.3
    text = "Some bytes é and more of them, " * 30
    data = text.encode()
    rows = quality.chunks(text)
    assert bytes(rows[0]) == data[: quality.CHUNK] and bytes(rows[1])[: quality.CHUNK - quality.STEP] == data[quality.STEP : quality.CHUNK]
    pooled = []
    for row in rows:
        best = np.full(quality.FILTERS, -np.inf)
        for start in range(0, len(row) - quality.WIDTH + 1, quality.STRIDE):
            seen = np.concatenate([net.byte[x] for x in row[start : start + quality.WIDTH]])
            best = np.maximum(best, seen @ net.filter)
        pooled.append(np.maximum(best + net.bias, 0))
    pooled = np.array(pooled)
    logit = float(np.concatenate([pooled.mean(0), pooled.max(0)]) @ net.out + net.base[0])
    assert net.logit(text) == pytest.approx(logit, abs=1e-4)
    assert net.logits([text, "", None, text * 300]) == pytest.approx([net.logit(x) for x in (text, "", None, text * 300)], abs=1e-4)
    for w in net.weights():  # numbers of double length for differences
        assert w.dtype == np.float32
    net.byte, net.filter, net.bias, net.out, net.base = (w.astype(np.float64) for w in net.weights())
    loss = lambda: math.log1p(math.exp(net.logit(text)))  # noqa: E731  the label is 0
    for w, g in zip(net.weights(), net.gradients(text, 0, 1.0), strict=True):
        flat, slope = w.reshape(-1), g.reshape(-1)
        for k in np.argsort(-np.abs(slope))[:3]:
            was = flat[k]
            flat[k] = was + 1e-5
            up = loss()
            flat[k] = was - 1e-5
            down = loss()
            flat[k] = was
            assert (up - down) / 2e-5 == pytest.approx(slope[k], rel=2e-2, abs=1e-6)


def plain_phrases(names):
    """One level of locally consistent parsing, one name after the other."""
    mask = (1 << 64) - 1

    def mix(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & mask
        x = (x ^ x >> 27) * 0x94D049BB133111EB & mask
        return x ^ x >> 31

    a = 0x9E3779B97F4A7C15
    single = []
    for name, group in itertools.groupby(names):
        n = len(list(group))
        single.append(mix(name + n * a & mask) if n > 1 else name)
    label = single
    for _ in range(3):
        new = []
        for k, x in enumerate(label):
            left = label[k - 1] if k else x ^ 1
            low = (x ^ left) & -(x ^ left)
            place = low.bit_length() - 1
            new.append(2 * place + (x >> place & 1))
        label = new
    starts = [k for k in range(len(single)) if k == 0 or (label[k] > label[k - 1] and label[k] > (label[k + 1] if k + 1 < len(label) else 0))]
    out = []
    for s, e in zip(starts, [*starts[1:], len(single)], strict=True):
        out.append(mix(sum(mix(single[k] + (k - s + 1) * a & mask) for k in range(s, e)) & mask))
    return out


def test_phrases_equal_a_plain_parse():
    draw = random.Random(9)
    texts = ["".join(draw.choice("abcd ") for _ in range(n)) for n in (1, 2, 7, 300, 3000)] + ["a" * 50, "abab" * 40]
    for text in texts:
        names = [int(x) for x in fingerprint._mix(np.array([ord(c) for c in text], np.uint64) + fingerprint._A)]
        mine, doc = np.array(names, np.uint64), np.zeros(len(names), np.int64)
        for _ in range(3):
            mine, doc = fingerprint.phrases(mine, doc)
            names = plain_phrases(names)
            assert [int(x) for x in mine] == names


def test_links_at_the_threshold_are_found(spark):
    """2,400 documents in pairs whose similarity is 0.80 to 0.85, under words that all documents share."""
    draw = random.Random(12)
    texts, wanted = [], 0
    common = [f"c{k}" for k in range(20)]
    for family in range(1200):
        one = common + [f"w{family}x{k}" for k in range(draw.randint(60, 160))]
        two = list(one)
        n = len(one) - 1
        changes = int(n * draw.uniform(0.075, 0.12) / 2)
        for p in draw.sample(range(25, len(two) - 1), changes):
            two[p] = f"v{family}x{p}"
        texts += [one, two]
    sets = [frozenset(zip(t, t[1:], strict=False)) for t in texts]
    close = [(k, k + 1) for k in range(0, len(sets), 2) if 80 * len(sets[k] | sets[k + 1]) <= 100 * len(sets[k] & sets[k + 1]) <= 85 * len(sets[k] | sets[k + 1])]
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, 2).collect()}
    assert len(close) >= 300
    assert sum(got[a] == got[b] for a, b in close) >= 0.999 * len(close)
    far = [k for k in range(0, len(sets), 2) if 100 * len(sets[k] & sets[k + 1]) < 80 * len(sets[k] | sets[k + 1])]
    assert all(got[k] == k and got[k + 1] == k + 1 for k in far)


def test_linked_rows_equal_all_pairs():
    draw = random.Random(13)
    base = [draw.sample(range(400), 60) for _ in range(4)]
    items = []
    for k in range(120):
        one = set(base[k % 4])
        for _ in range(draw.randint(0, 9)):
            one.discard(draw.choice(sorted(one)))
            one.add(draw.randint(0, 2000))
        items.append(np.array(sorted(one), np.uint64))
    comp = np.array([k if k % 5 else 0 for k in range(120)])
    similar = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))

    def classes(links):
        over = {}
        for a, b in links:
            neardup._joined(over, int(comp[a]), int(comp[b]))
        return [neardup._root(over, int(c)) for c in comp]

    every = [(a, b) for a in range(120) for b in range(a) if similar(items[a], items[b])]
    assert classes(neardup.linked_rows(items, comp, None, 80)) == classes(every)
    side = np.arange(120) % 2
    assert classes(neardup.linked_rows(items, comp, side, 80)) == classes([(a, b) for a, b in every if side[a] != side[b]])
