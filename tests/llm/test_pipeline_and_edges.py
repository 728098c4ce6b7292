"""Pipeline stages, and every operator on null ids, repeated rows, conflicting labels, clashing names and no rows; definite columns against SQL."""

import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gazette.llm import common, fingerprint, html_extract, language, license_scan, mixing, neardup, packing, quality, topk, toxicity

DATA = "/root/testdata/sf0.001"
#: The columns of documents, and others with names that operators use themselves.
KIND = "doc_id long, text string, lang string, source string, n_chars long, node long, size long, key long, row long, score double, p double, y int, label string, tokens string"
LABELS = "doc_id long, quality int, toxic int"
EXTRA = (1, 2, 3, 4, 0.5, 0.5, 1, "l", "t")


@pytest.fixture(scope="module")
def docs(spark):
    draw = random.Random(21)
    words = {"en": "the river and house of light over small town with paper".split(), "de": "der fluss und das haus mit licht über kleine stadt".split()}
    rows = [(k, " ".join(draw.choice(words[("en", "de")[k % 2]]) for _ in range(draw.choice((8, 60, 200)))), ("en", "de")[k % 2], f"s{k % 3}") for k in range(60)]
    rows += [(100, None, "en", None), (101, "", None, "s1"), (102, "12 !!", "en", "s0"), (103, rows[0][1], "en", "s0"), (104, "word " * 20_000, "en", "s2")]
    rows += [(None, rows[5][1], "de", "s0"), (None, rows[5][1] + " mit licht", "de", "s1"), (None, None, None, None), (7, rows[7][1], "de", "s1"), (7, rows[7][1], "de", "s1"), (7, "another text under the same number as before", "en", "s1")]
    return spark.createDataFrame([(i, t, l, s, len(t or ""), *EXTRA) for i, t, l, s in rows], KIND)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(k, int(k % 4 != 0), int(k % 5 == 0)) for k in range(60)] + [(1, 0, 1), (1, 1, 0), (None, 1, 1), (2, None, None)], LABELS)


def test_smallest_label_counts(labels):
    assert {r.doc_id: r.y for r in common.one_label(labels, "quality").collect()}[1] == 0
    assert {r.doc_id: r.y for r in common.one_label(labels, "toxic").collect()}[1] == 0


def test_operators_on_null_ids_repeated_rows_and_clashing_names(spark, docs, labels):
    n, none = docs.count(), docs.limit(0)
    rows = docs.collect()
    assert packing.pack(docs).filter("start = 0").count() == n
    assert mixing.mix(docs).count() == n
    assert neardup.near_duplicates(docs).count() == n
    got = toxicity.toxicity(docs, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in rows) and not any(r.held_out for r in got if r.doc_id is None)
    got = quality.quality(docs, labels).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in rows) and all(0 <= r.score <= 1 for r in got)
    assert quality.quality(docs, labels).select("doc_id", F.round("score", 12)).collect() == quality.quality(docs, labels).select("doc_id", F.round("score", 12)).collect()
    got = language.identify(docs, language.learn(docs)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in rows)
    got = fingerprint.fingerprint(docs, 10).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in rows)
    by_text = defaultdict(set)
    texts = Counter((r.doc_id, len(r.text or "")) for r in rows)
    assert Counter((r.doc_id, r.n_chars) for r in got) == texts
    for r in got:
        if r.doc_id in (0, 103):
            by_text[0].add(r.fingerprint)
    assert len(by_text[0]) == 1
    for empty in (packing.pack(none), mixing.mix(none), neardup.near_duplicates(none), neardup.representatives(none), fingerprint.fingerprint(none), mixing.mix_documents(none), license_scan.scan(none)):
        assert empty.count() == 0


def test_html_repeated_rows_null_ids_and_clashing_names(spark):
    page = "<article><h1>Head</h1><p>One text of it.</p></article><nav><a href=x>Menu</a></nav>"
    rows = [(1, "u", page, "t", 1, 2), (1, "u", page, "t", 1, 2), (None, None, page, "t", 1, 2), (2, "v", None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long, marked int")
    got = Counter(tuple(r) for r in html_extract.extract(df).collect())
    assert got == Counter([(1, "u", "Head One text of it.", 20)] * 2 + [(None, None, "Head One text of it.", 20), (2, "v", "", 0)])


def test_top_k_takes_every_row(spark):
    vectors = [(0, [0.5, 0.5]), (1, [0.5, 0.5]), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (None, [9.0, 9.0]), (0, [1.0, -1.0]), (3, [0.25]), (4, []), (5, [float("inf"), 0.0])]
    vectors += [(10 + k, [0.0] * 2) for k in range(20)]
    df = spark.createDataFrame([(i, v, 1, "s", [0]) for i, v in vectors], "vec_id long, embedding array<double>, row int, id string, q array<int>")
    q = topk.quantize(df)
    got = Counter(tuple(r) for r in topk.top_k(q, q.filter("id % 100 = 0"), 4, 3, 1).collect())
    ints = [(i, [int(np.floor(1024 * x)) for x in v]) for i, v in vectors if i is not None and all(np.isfinite(v))]
    wanted = Counter()
    for i, v in ints:
        if i % 100 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j) for j, w in ints if j != i)[:4]
            wanted.update((i, n + 1, j, -s) for n, (s, j) in enumerate(best))
    assert got == wanted
    with_sql = duckdb.connect()
    with_sql.register("embeddings", df.select("vec_id", "embedding").filter("vec_id IS NOT NULL AND size(embedding) > 0").toArrow())
    sql = Counter(with_sql.execute(topk.ORACLE_SQL.replace("<= 10", "<= 4")).fetchall())
    assert sum((Counter({k: n for k, n in sql.items() if k[3] > 0}) - got).values()) == 0


def test_license_scan_repeats_rows_and_keeps_null_ids(spark):
    notice = "Licensed under the Apache License, Version 2.0."
    rows = [(1, notice, "f", 1.0, 3), (1, notice, "f", 1.0, 3), (None, notice, "f", 1.0, 3), (2, "ein haus. " * 30_000 + notice, "f", 1.0, 3), (3, "", "f", 1.0, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, family string, share double, window int")
    assert Counter((r.doc_id, r.family) for r in license_scan.scan(df).collect()) == Counter({(1, "apache"): 2, (None, "apache"): 1, (2, "apache"): 1})


@pytest.fixture(scope="module")
def sf(spark, labels, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    labels.write.parquet(f"{folder}/labels.parquet")
    return folder


def test_language_stage(spark, docs, sf):
    got = corpus_pipeline.language_id(spark, docs, sf)
    assert got.columns == docs.columns
    found = Counter((r.doc_id, r.text) for r in got.collect())
    every = Counter((r.doc_id, r.text) for r in docs.collect())
    assert not found - every
    assert not {i for i, _ in found} & {100, 101, 102}
    assert all(found[k] == n for k, n in every.items() if k[0] is not None and k[0] < 60 and len(k[1] or "") > 100)
    assert corpus_pipeline.language_id(spark, docs.limit(0), sf).count() == 0


def test_quality_stage(spark, docs, sf):
    got = corpus_pipeline.quality_classifier(spark, docs, sf)
    assert got.columns == docs.columns
    assert not Counter((r.doc_id, r.text) for r in got.collect()) - Counter((r.doc_id, r.text) for r in docs.collect())
    assert corpus_pipeline.quality_classifier(spark, docs.limit(0), sf).count() == 0


def test_near_duplicate_stage_keeps_one_row_of_each_group(spark, docs, sf):
    got = corpus_pipeline.near_duplicates(spark, docs, sf)
    assert got.columns == docs.columns
    found = [(r.doc_id, r.text) for r in got.collect()]
    assert max(Counter(found).values()) == 1
    kept = {t for _, t in found if t}

    def shingles(t):
        w = t.lower().split()
        return frozenset([tuple(w)]) if 0 < len(w) < 5 else frozenset(zip(*(w[k:] for k in range(5)), strict=False))

    sets = {t: shingles(t) for t in {r.text for r in docs.collect() if r.text}}
    alike = lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    for a in kept:
        assert not [b for b in kept if b != a and alike(a, b)]
    for t in sets:
        assert t in kept or any(alike(t, b) for b in kept)
    rows = docs.collect()
    assert (0, rows[0].text) in found and (103, rows[0].text) not in found and (5, rows[5].text) in found
    assert {(100, None), (None, None)} <= set(found)
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), sf).count() == 0


def test_mixing_stage(spark, docs, sf):
    got = corpus_pipeline.source_mixing(spark, docs, sf)
    assert got.columns == docs.columns
    copies = Counter((r.doc_id, r.text) for r in got.collect())
    every = Counter((r.doc_id, r.text) for r in docs.collect())
    assert all(n <= 2 * every[k] for k, n in copies.items())
    decided = Counter()
    for r in mixing.mix(docs).collect():
        decided[r.doc_id, r.size] += r.copies
    sizes = Counter()
    for (i, t), n in copies.items():
        sizes[i, len((t or "").split())] += n
    assert sizes == +decided
    assert corpus_pipeline.source_mixing(spark, docs.limit(0), sf).count() == 0


def test_packing_stage(spark, docs, sf):
    got = corpus_pipeline.sequence_packing(spark, docs, sf).collect()
    ends = defaultdict(int)
    for r in got:
        ends[r.sequence_id] += r.length
    assert max(ends.values()) <= 2048
    total = sum(len(packing.token_ids(r.text)) for r in docs.collect())
    assert sum(ends.values()) == total
    assert corpus_pipeline.sequence_packing(spark, docs.limit(0), sf).count() == 0


def test_stages_in_a_row_over_a_stored_table(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language ID", "quality classifier", "MinHash near-dedup", "source mixing", "packing"]
    got = corpus_pipeline.run(spark, DATA)
    assert got.count() > 0 and "sequence_id" in got.columns


WORD = r"'[^\x20\x09-\x0D]+'"
DEFINITE = {
    "size": (lambda s: mixing.op5_source_mixing(s, DATA).select("doc_id", "size", "source_size"), f"SELECT doc_id, size, sum(size) OVER (PARTITION BY source) FROM (SELECT *, len(regexp_extract_all(coalesce(text, ''), {WORD})) AS size FROM documents)"),
    "fingerprint": (
        lambda s: fingerprint.op10_fingerprint(s, DATA).select("doc_id", "n_chars", "edited_sha256"),
        """WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), n AS (SELECT doc_id, t, coalesce(lead(t) OVER (ORDER BY doc_id DESC), first_value(t) OVER (ORDER BY doc_id DESC)) AS nx FROM d)
           SELECT doc_id, length(t), sha256(substr(t, 1, length(t) - length(t) // 2) || substr(nx, 1, length(t) // 2)) FROM n""",
    ),
    "shingles": (
        lambda s: neardup.op6_minhash_neardup(s, DATA).select("doc_id", "n_shingles"),
        f"""WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {WORD}) AS w FROM documents)
            SELECT doc_id, CASE WHEN len(w) < 2 THEN len(w) ELSE len(list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) END FROM w""",
    ),
}


@pytest.mark.parametrize("name", sorted(DEFINITE))
def test_definite_columns_equal_sql(spark, name):
    query, sql = DEFINITE[name]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    assert sorted(map(tuple, query(spark).collect())) == sorted(tuple(int(x) if not isinstance(x, str) else x for x in r) for r in con.execute(sql).fetchall())


@pytest.mark.parametrize(("query", "folds", "fold"), [(toxicity.op7_toxicity, 3, 1), (language.op8_language_id, 3, 1), (quality.op9_quality, 5, 0)])
def test_held_out_rows(spark, query, folds, fold):
    import zlib

    got = query(spark, DATA).select("doc_id", "held_out").collect()
    assert len(got) == 200 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == fold) for r in got)
