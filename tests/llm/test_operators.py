"""Each operator on small tables with nulls, empty and long texts, ties, repeated rows, no rows and clashing names."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gazette.llm import fingerprint, html_extract, language, license_scan, mixing, neardup, packing, quality, topk, toxicity

KIND = "doc_id long, text string, lang string, source string, n_chars long, score string, size string, node string, p string"
LABELS = "doc_id long, quality int, toxic int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, l, s, len(t or ""), "x", "y", "z", "w") for i, t, l, s in rows], KIND)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(1)
    words = {"en": "the river and house of light over small town with paper".split(), "de": "der fluss und das haus mit licht über kleine stadt".split()}
    out = [(k, " ".join(draw.choice(words[("en", "de")[k % 2]]) for _ in range(draw.choice((1, 8, 60, 300)))), ("en", "de")[k % 2], f"s{k % 4}") for k in range(80)]
    out += [(100, None, "en", None), (101, "", None, "s1"), (102, "12 !!", "en", "s0"), (103, out[0][1], "en", "s0"), (0, out[0][1], "en", "s0"), (104, "word " * 30_000, None, "s2"), (105, out[9][1] + " extra", "de", "s3")]
    return out


def test_top_k_equals_brute_force_with_ties(spark):
    draw = np.random.default_rng(2)
    vectors = [(k, [float(x) for x in draw.integers(-2, 3, 6) / 8]) for k in range(150)] + [(500, None), (501, [1.0, None] + [0.0] * 4), (502, [float("nan")] * 6), (100, [0.25] * 6)]
    vectors = [v for v in vectors if v != vectors[100]]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    q = topk.quantize(df)
    got = sorted(tuple(r) for r in topk.top_k(q, q.filter("id % 50 = 0"), 10, 40, 2).collect())
    ints = {i: np.floor(1024 * np.array(v)).astype(int) for i, v in vectors if v and None not in v and not np.isnan(v).any()}
    wanted = []
    for i in ints:
        if i % 50 == 0:
            best = sorted((-int(ints[i] @ v), j) for j, v in ints.items() if j != i)[:10]
            wanted += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    assert got == sorted(wanted)
    none = topk.quantize(df.limit(0))
    assert topk.top_k(none, none).count() == 0


def test_html_main_text(spark):
    pages = [
        (1, "u", "<html><body><nav><ul><li><a href=x>Menu</a></li></ul></nav><article><h1>Head</h1><p>One &amp; two.<br>Three<p>F<b>ou</b>r.</p></article><div class='ad'>Buy it now.</div><footer>Foot</footer></body></html>"),
        (2, "u", None), (3, "u", ""), (4, "u", "<script>x</script><style>y</style>"), (5, "u", "<article><p>" + "Long text here. " * 5000 + "</p></article>"),
        (6, "u", "<div id='main'><h2>T</h2><p>Text.</p></div><div id='comments'><p>I like this a lot, thanks.</p></div><aside>More</aside>"),
    ]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert got == {1: "Head One & two. Three Four.", 2: "", 3: "", 4: "", 5: ("Long text here. " * 5000).strip(), 6: "T Text."}
    assert html_extract.extract(df.limit(0)).count() == 0


def test_html_model_on_pages_it_has_not_seen():
    counts = defaultdict(float)
    for html in html_extract.labelled_pages():
        for key, n in html_extract.taught(html, True).items():
            counts[(*key[:2], str(key[2]), key[3])] += n
    model = html_extract.Model(dict(counts))
    wrong = total = 0
    for html in html_extract.labelled_pages(100, seed=99):
        tree = html_extract.Tree(html)
        chance, (_, silent, size) = model.marginals(tree), html_extract.observed(tree)
        inside = [0] * len(tree.tag)
        for k in range(1, len(tree.tag)):
            inside[k] = {"main": 1, "other": 0}.get(tree.marks[k], inside[tree.parent[k]])
            if tree.tag[k] == "#" and size[k] and not silent[k]:
                total += 1
                wrong += (chance[k] >= 0.5) != inside[k]
    assert wrong < 0.01 * total


def test_license_scan(spark):
    texts = [(1, "Some words here.\nLicensed under the Apache License, Version 2.0."), (2, "Released under the MIT License."), (3, "She has a driving licence and a dog."), (4, None), (5, ""), (6, "nothing at all\n" * 50)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = {(r.doc_id, r.paragraph, r.family) for r in license_scan.scan(df).filter("confirmed").collect()}
    assert got == {(1, 1, "apache"), (2, 0, "mit")}
    assert all(spark.createDataFrame([(x,)], "t string").filter(F.col("t").rlike(license_scan.GATE)).count() for x in ("\n".join(t) for t in license_scan.TEMPLATES.values()))


def test_packing_is_a_partition_of_the_ids(spark, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: np.array([*plain.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for i, t, _, _ in rows}
    got = packing.pack(table(spark, rows)).collect()
    of, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        of[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for i, t, _, _ in rows:
        assert sum(n for _, n in of[i]) == len(ids[i]) * sum(x[0] == i for x in rows)
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(table(spark, rows).limit(0)).count() == 0


def test_histogram_packing_leaves_little_padding():
    draw = random.Random(5)
    histogram = defaultdict(int)
    for _ in range(20_000):
        histogram[draw.randint(1, 2048)] += 1
    _, sequences, padding = packing.pack_histogram(histogram)
    assert padding < 0.01 * sequences * 2048


def test_mixing(spark, rows):
    got = mixing.mix(table(spark, rows)).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    sizes = defaultdict(int)
    for i, t, _, s in rows:
        sizes[s] += len((t or "").split())
    total, names = sum(sizes.values()), sorted(sizes, key=lambda s: (s is None, s))
    target, weight = {}, {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, free = 1.5 * total, set(names)
    while True:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if share[s] >= 2 * sizes[s]}
        target |= {s: 2.0 * sizes[s] for s in full}
        if not full:
            target |= share
            break
        free -= full
        left -= sum(2 * sizes[s] for s in full)
        if not free:
            break
    for s in names:
        own = [r for r in got if r.source == s]
        assert all(r.target == pytest.approx(target[s]) and r.source_size == sizes[s] and r.taken <= 2 * r.size for r in own)
        assert abs(sum(r.taken for r in own) - target[s]) <= max(r.size for r in own)
    again = mixing.mix(table(spark, rows).repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.mix(table(spark, rows).limit(0)).count() == 0
    assert mixing.mix_documents(table(spark, rows)).count() == sum(r.copies for r in got)


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates_equal_brute_force(spark, rows, words):
    def shingles(t):
        w = (t or "").lower().split()
        return frozenset([tuple(w)]) if 0 < len(w) < words else frozenset(zip(*(w[k:] for k in range(words)), strict=False))

    sets = {i: shingles(t) for i, t, _, _ in rows}
    least = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    least[a] = least[b] = min(least[a], least[b])
    got = neardup.near_duplicates(table(spark, rows), words).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got} == {(i, len(sets[i]), least[i], least[i] == i) for i in sets}
    assert neardup.near_duplicates(table(spark, rows).limit(0), words).count() == 0


def test_toxicity_restores_and_scores(spark):
    draw = random.Random(6)
    fill = "river house light paper small town north water green stone".split()
    rows, labels = [], []
    for k in range(400):
        toxic = k % 4 == 0
        words = [draw.choice(fill) for _ in range(30)]
        if toxic:
            words[draw.randrange(30)] = "moron" if k % 3 != 1 or k % 8 else draw.choice(("m0ron", "moroooon", "m o r o n"))
        rows.append((k, " ".join(words), "en", "s"))
        labels.append((k, 1, int(toxic)))
    rows += [(900, None, "en", "s"), (901, "", "en", "s"), (902, "stone " * 20_000, "en", "s"), (0, rows[0][1], "en", "s")]
    got = toxicity.toxicity(table(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(rows)
    truth = {i: t for i, _, t in labels}
    assert sum(r.predicted != truth.get(r.doc_id, 0) for r in got) <= 4
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    assert toxicity.toxicity(table(spark, rows).limit(0), spark.createDataFrame([], LABELS)).count() == 0


def test_language(spark, rows):
    docs = table(spark, rows)
    got = language.identify(docs, language.learn(docs)).collect()
    assert len(got) == len(rows)
    found = {r.doc_id: r.lang_pred for r in got}
    assert found[100] == found[101] == found[102] == "und"
    assert sum(found[i] == l for i, t, l, _ in rows if t and l and len(t) > 30) >= 0.95 * sum(1 for _, t, l, _ in rows if t and l and len(t) > 30)
    none = docs.limit(0)
    assert language.identify(none, language.learn(none)).count() == 0


def test_quality(spark):
    draw = random.Random(8)
    rows, labels = [], []
    for k in range(300):
        good = k % 3 != 0
        words = [draw.choice("river house light paper small town".split()) + ("" if good else draw.choice(("###", "$$$", "%%%"))) for _ in range(60)]
        rows.append((k, " ".join(words), "en", "s"))
        labels.append((k, int(good), 0))
    rows += [(900, None, "en", "s"), (901, "", "en", "s"), (902, "stone " * 30_000, "en", "s")]
    got = quality.quality(table(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    truth = {i: q for i, q, _ in labels}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert sum(r.predicted != truth[r.doc_id] for r in got if r.doc_id in truth) <= 6
    assert quality.quality(table(spark, rows).limit(0), spark.createDataFrame([], LABELS)).count() == 0


def test_fingerprint(spark, rows):
    rows = [r for r in rows if r[0] != 0]
    got = {r.doc_id: r for r in fingerprint.fingerprint(table(spark, rows), 10).collect()}
    order = sorted((r[0] for r in rows), reverse=True)
    texts = {i: t or "" for i, t, _, _ in rows}
    for k, i in enumerate(order):
        t, n = texts[i], texts[order[(k + 1) % len(order)]]
        changed = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        assert got[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest() and got[i].n_chars == len(t)
    assert got[100].fingerprint == got[101].fingerprint
    assert fingerprint.fingerprint(table(spark, rows).limit(0)).count() == 0
    draw = random.Random(7)
    a, b = ("".join(draw.choice("abcdefgh ") for _ in range(5000)) for _ in range(2))
    one, _ = fingerprint.fingerprints([a, "xyz" + a, b])
    assert fingerprint.likeness(one[:1], one[1:2])[0] > 0.85 and fingerprint.likeness(one[:1], one[2:])[0] < 0.1


def test_near_duplicates_linked_only_through_members_of_the_hubs_group(spark):
    """600 variants of one text differ in a word; of each one more text is made, 0.8 like this variant and no other text."""
    draw = random.Random(11)
    hub = [f"h{k}" for k in range(200)]
    texts = [hub]
    for k in range(600):
        places = draw.sample(range(1, 199, 2), 12)
        near, far = list(hub), None
        near[places[0]] = f"n{k}"
        far = list(near)
        for p in places[1:]:
            far[p] = f"f{k}-{p}"
        texts += [near, far]
    draw.shuffle(texts)
    sets = [frozenset(zip(t, t[1:], strict=False)) for t in texts]
    least = list(range(len(sets)))
    for a, x in enumerate(sets):
        for b in range(a):
            same = len(x & sets[b])
            if 100 * same >= 80 * (len(x) + len(sets[b]) - same) and least[a] != least[b]:
                lo, hi = sorted((least[a], least[b]))
                least = [lo if c == hi else c for c in least]
    rows = [(k, " ".join(t), "en", "s") for k, t in enumerate(texts)]
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(table(spark, rows), 2).collect()}
    assert len(set(least)) == 1
    assert sum(got[k] != c for k, c in enumerate(least)) == 0


def test_toxicity_decodes_long_and_spaced_disguises():
    text = "you are a moron and an idiot or an asshole as the river by the house of light is a small town with paper " * 50
    counts = defaultdict(int)
    for code in toxicity.trigram_codes(text).tolist():
        counts[code] += 1
    channel = toxicity.Channel(dict(counts))
    wanted = {
        "a m o r o n": "moron", "y o u i d i o t": "idiot", " ".join("youareamoronandanidiotorthehouseofthelightriver"): "moron",
        "a  m o r o n": "moron", "m  o  r  o  n": "moron", "m o r o n": "moron", "mor" + "o" * 60 + "n": "moron", "@$$h0l3": "asshole", "m-.-o-.-r-.-o-.-n": "moron",
        "the.river.by.the.house.of.light.m0r0n.is.a.small.town": "moron",
    }
    assert {t: w for t, w in wanted.items() if w not in channel.words(t)} == {}
    assert channel.words("12 345 2,000 10.5%") == set()


def test_license_scan_finds_notices_without_gate_words_and_inside_long_paragraphs(spark):
    filler = " ".join(f"{a} {b}" for a in "river house light paper stone".split() for b in "small town north water green".split()) + " "
    notice = license_scan.TEMPLATES["bsd"][0].rstrip(".")
    texts = [(1, "This Source Code Form is subject to the terms of the Mozilla Public, v. 2.0."), (4, filler * 40 + notice + " " + filler * 40), (5, filler * 40)]
    got = {(r.doc_id, r.family) for r in license_scan.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert {(1, "mpl"), (4, "bsd")} <= got
    assert 5 not in {i for i, _ in got}
