"""A valid edition passes every gate; each change to it is told."""

import copy
import hashlib

import pytest
from pyspark.sql import functions as F

from gazette.operators import gates

CONTRACT = gates.Contract(chapters=3, articles=2, bundles=2, bundle_size=3, top5=2, research_domains=2, videos=2, channels=2)


def article(k, research=False):
    return {
        "id": f"i{k}", "link": f"https://s{k}.example/a/{k}", "title": f"Title {k}", "editorial": {"fact": "A fact that is told.", "background": "A background told.", "why_it_matters": "A meaning that is told.", "checkpoints": ["a", "b"]},
        "fact_check": {"status": "PARTIAL", "body_status": "VALIDATED"}, "image": {"status": "VERIFIED_PROVENANCE", "url": "https://x/i.jpg", "content_hash": f"h{k}", "declaration_method": "og", "source_domain": "x", "article_domain": "y"},
        "research": {"evidence_type": "RCT", "study_design": "d", "clinical_meaning": "m", "limitations": "l", "exact_source_url": f"https://r{k}.example/"} if research else None,
    }


def edition():
    chapters = [{"id": f"c{c}", "name": f"C{c}", "articles": [article(2 * c + k) for k in range(2)]} for c in range(3)] + [{"id": CONTRACT.research, "name": "R", "articles": [article(6, True), article(7, True)]}]
    return {
        "edition": "e", "version": "1.1.0", "date": "2026-09-04", "trends_source": CONTRACT.trends_withheld, "story_files": ["stories-1.json", "stories-2.json"], "chapters": chapters,
        "top5": [{"id": "i0", "link": "https://s0.example/a/0", "title": "Title 0", "chapter_id": "c0"}, {"id": "i2", "link": "https://s2.example/a/2", "title": "Title 2", "chapter_id": "c1"}],
        "weather": {"location": "인천 서구 검단", "temp_current": 20.0, "temp_min": 10.0, "temp_max": 25.0, "condition": "clear", "precipitation_prob": 0.0, "source": "s"}, "market": {"kospi": "1", "usd_krw": "2"}, "next_signals": ["a", "b", "c"], "trends": [],
        "lines": ["a", "b", "c"], "videos": [{"url": "https://v.example/1", "channel": "a"}, {"url": "https://v.example/2", "channel": "b"}], "integrity_hash": hashlib.sha256(b"").hexdigest(), "manifest_fingerprint": "",
    }


def stories(e):
    rows = [a for c in e["chapters"] if c["id"] != CONTRACT.research for a in c["articles"]]
    return [("e", k // 3, a["link"], a["title"], "today") for k, a in enumerate(rows)]


def change(path, value):
    def do(e):
        x = e
        for p in path[:-1]:
            x = x[p]
        x[path[-1]] = value

    return do


A0 = ("chapters", 0, "articles", 0)
CHANGES = [
    (change((*A0, "id"), ""), {"missing_id", "top5_foreign_id"}), (change((*A0, "title"), "Title 1"), {"duplicate_title"}), (change((*A0, "link"), "https://news.google.com/x"), {"relay_url", "top5_foreign_link"}), (change((*A0, "editorial", "fact"), "short"), {"fact_incomplete"}),
    (change((*A0, "editorial", "checkpoints"), ["a"]), {"checkpoints_incomplete"}), (change((*A0, "fact_check"), None), {"fact_check_missing"}), (change((*A0, "fact_check", "status"), "SURE"), {"fact_check_status"}), (change((*A0, "fact_check", "body_status"), "HTTP_500"), {"body_status"}),
    (change((*A0, "image"), None), {"image_missing"}), (change((*A0, "image", "status"), "EXPLICIT_NULL"), {"image_null_with_url"}), (change((*A0, "image", "content_hash"), "h1"), {"duplicate_image_hash"}), (change((*A0, "image", "content_hash"), None), {"image_without_hash"}),
    (change((*A0, "image", "source_domain"), ""), {"image_without_domains"}), (change(("chapters", 3, "articles", 0, "research", "limitations"), ""), {"research_limitations"}), (change(("chapters", 3, "articles", 0, "research", "exact_source_url"), "https://r7.example/z"), {"research_domains"}),
    (change(("weather", "source"), None), {"weather_source"}), (change(("weather", "location"), "Seoul"), {"weather"}), (change(("top5", 1), {"id": "i1", "link": "https://s1.example/a/1", "title": "[사설] x", "chapter_id": "c0"}), {"top5_opinion", "top5_chapters"}),
    (change(("top5",), []), {"top5_count"}), (change(("market",), {"kospi": "1"}), {"market"}), (change(("next_signals",), ["a"]), {"signals"}), (change(("trends",), ["a"]), {"trends_count"}), (change(("trends_source",), "x"), {"trends_withheld"}), (change(("lines",), []), {"summary_lines"}),
    (change(("videos", 1, "channel"), "a"), {"video_channels"}), (change(("integrity_hash",), "x"), {"integrity_hash"}), (change(("chapters", 0, "articles"), [article(0)]), {"chapter_articles", "general_articles"}), (change(("version",), "1.0.0"), set()),
]


@pytest.fixture(scope="module")
def told(spark):
    """All changed editions go through the gate together, each under its own name."""
    rows = [edition()]
    for do, _ in CHANGES:
        e = edition()
        do(e)
        rows.append(e)
    for k, e in enumerate(rows):
        e["edition"] = f"e{k}"
    out = {f"e{k}": set() for k in range(len(rows))}
    for r in gates.edition_faults(spark.createDataFrame(rows, gates.EDITION), CONTRACT).collect():
        out[r.edition].add(r.rule)
    return out


def test_a_valid_edition_passes(told):
    assert told["e0"] == set()


@pytest.mark.parametrize("k", range(len(CHANGES)))
def test_each_change_is_told(told, k):
    assert told[f"e{k + 1}"] == CHANGES[k][1]


def test_bundles_manifests_contract_and_leaves(spark):
    e = edition()
    df = spark.createDataFrame([e], gates.EDITION)
    st = spark.createDataFrame(stories(e), gates.STORY)
    counts = {"total_chapters": 4, "total_articles": 8, "vision_research_watch": 2, "top5": 2, "summary_lines": 3, "youtube": 2, "trends": 0, "story_bundles": 2}
    body = ("e", "2026-09-04", "Asia/Seoul", "a" * 40, "CANONICAL_PASS", gates.production_fingerprint(df).first().fingerprint, counts)
    own = gates.manifest_fingerprint(spark.createDataFrame([(*body, "")], gates.MANIFEST)).first().fingerprint
    m = spark.createDataFrame([(*body, own)], gates.MANIFEST)
    df = df.withColumn("manifest_fingerprint", F.lit(own))
    assert gates.contract_faults(df, st, m, CONTRACT).collect() == []
    other = copy.deepcopy(e)
    other["lines"][0] = "TBD: write this"
    other["chapters"][1]["articles"][0]["editorial"]["fact"] = "A todo is left here."
    other["manifest_fingerprint"] = own
    changed = spark.createDataFrame([other], gates.EDITION)
    assert {r.rule for r in gates.manifest_faults(changed, m, CONTRACT).collect()} == {"production_fingerprint"}
    assert {(r.rule, r.detail) for r in gates.leaf_faults(changed).collect()} == {("placeholder.lines[]", "TBD: write this"), ("placeholder.chapters[].articles[].editorial.fact", "A todo is left here.")}
    bad = [*stories(e)[:-1], ("e", 1, "ftp://x", "t", "")]
    assert {r.rule for r in gates.bundle_faults(df, spark.createDataFrame(bad, gates.STORY), CONTRACT).collect()} == {"story_without_article", "article_without_story", "story_url", "freshness_note"}
    tampered = spark.createDataFrame([(*body[:6], counts | {"top5": 4}, own)], gates.MANIFEST)
    assert {r.rule for r in gates.manifest_faults(df, tampered, CONTRACT).collect()} == {"manifest_fingerprint", "count_top5"}


def test_registry(spark):
    rows = [("r", "a", "A", ["a.example"], 0, ["api"], ["x"], ["t"]), ("r", "b", "B", ["www.a.example"], 7, ["ftp"], ["x"], []), ("r", "b", "", ["nodot"], 1, ["rss"], ["x"], ["t"])]
    got = {(r.rule, r.detail) for r in gates.registry_faults(spark.createDataFrame(rows, gates.SOURCE), {0: 1, 1: 2}, {"api": 1, "rss": 3}, ["a", "z"]).collect()}
    assert got == {("tier", "b"), ("access_mode", "b"), ("missing_topics", "b"), ("missing_name", "b"), ("domain", "b"), ("duplicate_id", "b"), ("domain_owned_twice", "a.example"), ("few_of_tier", "1"), ("few_of_access", "rss"), ("missing_critical", "z")}
