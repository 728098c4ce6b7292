"""Audits of a valid edition, and of that edition with one change for each rule."""

import pytest
from pyspark.sql import functions as F

from gazette.operators import audits

SOURCES = audits.Sources(sections=2, stories=6, items=3, least_domains=2, most_share=0.67, most_wire=0.34, wire=("wire.example",), discovery=("relay.example",), generic=("/news", "/"), research_items=2, research_domains=2)
STORIES = [("A", "a1", "https://one.example/1"), ("A", "a2", "https://two.example/1"), ("A", "a3", "https://www.one.example/2"), ("B", "b1", "https://one.example/3"), ("B", "b2", "https://wire.example/1"), ("B", "b3", "http://three.example/1")]
STUDIES = [("s1", "https://press.example/1"), ("s2", "https://other.example/1")]


def story_faults(spark, stories=STORIES, studies=STUDIES, strict=False):
    s = spark.createDataFrame([("e", *x) for x in stories], "edition string, section string, title string, url string")
    r = spark.createDataFrame([("e", *x) for x in studies], "edition string, title string, url string")
    return {(f.rule, f.severity) for f in audits.source_faults(s, r, SOURCES, strict).collect()}


def test_sources(spark):
    assert story_faults(spark) == set()
    but = lambda k, url: [x if n != k else (*x[:2], url) for n, x in enumerate(STORIES)]
    assert story_faults(spark, STORIES[:5]) == {("story_count", "error"), ("section_items", "error"), ("wire_share", "warning")}
    assert story_faults(spark, [("A", *x[1:]) for x in STORIES]) == {("section_count", "error"), ("section_items", "error")}
    assert story_faults(spark, but(0, "https://two.example/1")) == {("duplicate_url", "error")}
    assert story_faults(spark, but(1, "https://one.example/9")) == {("few_domains", "warning"), ("domain_share", "warning")} and ("few_domains", "error") in story_faults(spark, but(1, "https://one.example/9"), strict=True)
    assert story_faults(spark, but(5, "http://wire.example/2")) == {("wire_share", "warning")}
    assert story_faults(spark, but(2, None)) == {("missing_url", "error")} and story_faults(spark, but(2, "words")) == {("missing_url", "error")}
    assert ("non_http", "error") in story_faults(spark, but(2, "ftp://one.example/1"))
    assert story_faults(spark, but(2, "https://relay.example/1")) == {("discovery_only", "warning")} and story_faults(spark, but(2, "https://one.example/news")) == {("generic_url", "warning")} == story_faults(spark, but(2, "https://one.example"))
    assert story_faults(spark, studies=STUDIES[:1]) == {("research_items", "error"), ("research_domains", "error")}
    assert story_faults(spark, studies=[STUDIES[0], ("s2", "")]) == {("research_url", "error"), ("research_domains", "error")} and story_faults(spark, studies=[STUDIES[0], ("s2", "https://relay.example/x")]) == {("research_discovery", "error")}


CONTRACT = audits.Snapshot(schema="v2", status="AUDITED", algorithm="lines", chapters=("a", "b"), target=2, discovery=("relay.example",), generic=("/news", "/"))
ITEMS = [{"edition": "e", "pos": k, "chapter": c, "source": "s", "title": f"t{k}", "published": "2024", "domain": d, "url": f"https://{d}/{k}", "canonical_url": None} for k, (c, d) in enumerate((("a", "x.example"), ("a", "y.example"), ("b", "x.example"), ("b", "z.example")))]
KIND = "edition string, pos long, chapter string, source string, title string, published string, domain string, url string, canonical_url string"


def report(*domains):
    return {"selected_count": len(domains), "unique_domains": len(set(domains)), "domain_counts": {d: domains.count(d) for d in domains}, "status": "PASS"}


@pytest.fixture(scope="module")
def digest(spark):
    return audits.fingerprints(spark.createDataFrame(ITEMS, KIND)).first().fingerprint


def snapshot_faults(spark, digest, items=ITEMS, **change):
    m = {
        "edition": "e", "schema_version": "v2", "snapshot_status": "AUDITED", "selected_files": ["a", "b"], "selected_count": 4, "target_per_chapter": 2, "minimum_unique_domains": 2, "max_per_domain": 1, "cross_chapter_duplicate_urls": None,
        "fingerprint_algorithm": "lines", "selection_fingerprint_sha256": digest, "chapter_report": {"a": report("x.example", "y.example"), "b": report("x.example", "z.example")},
    } | change
    return {f.rule for f in audits.snapshot_faults(spark.createDataFrame([m], audits.MANIFEST), spark.createDataFrame(items, KIND), CONTRACT).collect()}


def test_snapshots(spark, digest):
    import hashlib

    assert digest == hashlib.sha256("\n".join(f"{x['chapter']}|{x['url']}" for x in ITEMS).encode()).hexdigest()
    assert snapshot_faults(spark, digest) == set()
    for change, rules in (
        ({"schema_version": "v1"}, {"schema_version"}), ({"snapshot_status": None}, {"snapshot_status"}), ({"selected_files": ["a", "a"]}, {"selected_files"}), ({"selected_count": 5}, {"selected_count"}), ({"fingerprint_algorithm": "x"}, {"fingerprint_algorithm"}),
        ({"selection_fingerprint_sha256": "0"}, {"fingerprint"}), ({"cross_chapter_duplicate_urls": ["u"]}, {"cross_chapter_duplicates"}), ({"target_per_chapter": 3}, {"target_per_chapter", "chapter_rows"}), ({"minimum_unique_domains": 3}, {"few_domains"}), ({"max_per_domain": 0}, {"domain_cap"}),
    ):
        assert snapshot_faults(spark, digest, **change) == rules, change
    reports = {"a": report("x.example", "y.example"), "b": report("x.example", "z.example")}
    for wrong, rule in (({"selected_count": 3}, "report_count"), ({"unique_domains": 1}, "report_domains"), ({"domain_counts": {"x.example": 2}}, "report_domain_counts"), ({"status": "FAIL"}, "report_status")):
        assert snapshot_faults(spark, digest, chapter_report=reports | {"b": reports["b"] | wrong}) == {rule}
    but = lambda **x: [ITEMS[0] | x, *ITEMS[1:]]
    for change, rules in (
        ({"title": ""}, {"missing_title"}), ({"published": None}, {"missing_published"}), ({"url": "words"}, {"fingerprint", "not_absolute"}), ({"url": ITEMS[1]["url"]}, {"fingerprint", "duplicate_url"}), ({"url": "https://relay.example/1"}, {"fingerprint", "discovery_only"}),
        ({"url": "https://x.example/news/"}, {"fingerprint", "generic_url"}), ({"canonical_url": "https://x.example/0"}, set()), ({"chapter": "q"}, {"fingerprint", "unknown_chapter", "chapter_rows"}),
    ):
        assert snapshot_faults(spark, digest, but(**change)) == rules, change
    assert snapshot_faults(spark, digest, ITEMS[1:]) == {"selected_count", "fingerprint", "chapter_rows"}


DESK = audits.Staging(schema="v1", chapters=("a", "b"), fields=("head", "note"), local=("head",), statuses=("CONFIRMED",), target=1)
RECORDS = [{"edition": "e", "chapter": c, "staging_id": f"p{c}", "final_url": f"https://x.example/{c}", "canonical_url": "", "source_url": None, "verification_status": "VERIFIED", "image_review_required": False, "factcheck_status": "CONFIRMED", "editorial": {"head": "제목", "note": "n"}} for c in "ab"]
RECORD = "edition string, chapter string, staging_id string, final_url string, canonical_url string, source_url string, verification_status string, image_review_required boolean, factcheck_status string, editorial map<string,string>"


def staging_faults(spark, records=RECORDS, schema="v1", live=False, ready=True, scope=None):
    h = spark.createDataFrame([("e", schema, live)], "edition string, schema_version string, production_ready boolean")
    return {(f.rule, f.severity) for f in audits.staging_faults(spark.createDataFrame(records, RECORD), h, DESK, ready, scope).collect()}


def test_staging(spark):
    assert staging_faults(spark) == set()
    but = lambda **x: [RECORDS[0] | x, RECORDS[1]]
    late = {("not_ready", "error"), ("ready_count", "error")}
    for change, rules in (
        ({"final_url": "x"}, {("invalid_url", "error")}), ({"final_url": RECORDS[1]["final_url"]}, {("duplicate_url", "error")}), ({"verification_status": "HTTP_404"}, {("not_verified", "warning"), *late}), ({"factcheck_status": "SURE"}, {("factcheck_status", "error"), *late}),
        ({"editorial": {"head": "Title", "note": "n"}}, {("foreign_text", "error"), *late}), ({"editorial": {"head": "제목", "note": " "}}, late), ({"image_review_required": True}, late), ({"image_review_required": None}, late), ({"factcheck_status": None}, late), ({"editorial": None}, late),
        ({"chapter": "b"}, {("chapter_records", "error")}),
    ):
        assert staging_faults(spark, but(**change)) == rules, change
    assert staging_faults(spark, but(editorial=None), ready=False) == set()
    assert staging_faults(spark, schema="v0") == {("schema_version", "error")} and staging_faults(spark, live=True) == {("production_ready", "error")} == staging_faults(spark, live=None)
    assert staging_faults(spark, but(editorial=None), scope="b") == set() and staging_faults(spark, scope="q") == {("scope", "error")}
    assert staging_faults(spark, RECORDS[:1]) == {("record_count", "error"), ("chapter_records", "error")}
    assert audits.staging_faults(spark.createDataFrame([], RECORD), spark.createDataFrame([], "edition string, schema_version string, production_ready boolean"), DESK, True).filter(F.lit(True)).count() == 0
