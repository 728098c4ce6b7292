"""Stored pages: what they declare, where they link to, what they prove."""

import json

import duckdb
from pyspark.sql import functions as F

from gazette.functions import urls
from gazette.operators import pages
from gazette.plans import catalogue

HEAD = """<html><head><title>The &amp; title</title><meta property="og:title" content="Shown title"><link rel='alternate' href='/no'><link rel="canonical" href="/real">
<meta name="description" content="Second"><meta property='og:description' content='First  said'><meta itemprop="datePublished" content="2026-09-04T01:00:00Z"><time datetime="2020-01-01"></time>
<meta property="og:image" content="/img/logo.png"><meta name="twitter:image" content="//cdn.example.com/p.jpg"></head>{}</html>"""
SAID = '<script type="application/ld+json">' + json.dumps({"@graph": [{"datePublished": "2026-01-01", "image": ["https://x.example/a.jpg"]}]}) + "</script>"


def test_declarations_and_links(spark):
    rows = [("https://a.example/news/x.html", HEAD.format("")), ("https://a.example/y", SAID), ("https://a.example/z", "<time class=t datetime='2021-02-03'>"), ("https://a.example/n", None)]
    got = {r.url: r for r in pages.declared(spark.createDataFrame(rows, "url string, html string")).collect()}
    r = got[rows[0][0]]
    assert (r.title, r.og_title, r.canonical, r.published, r.description, r.image) == ("The & title", "Shown title", "https://a.example/real", "2026-09-04T01:00:00Z", "Second", "https://cdn.example.com/p.jpg")
    assert (got[rows[1][0]].published, got[rows[1][0]].image, got[rows[2][0]].published) == ("2026-01-01", "https://x.example/a.jpg", "2021-02-03")
    assert got[rows[3][0]].title is None and got[rows[3][0]].published is None
    anchors = "".join(f"<a class=x href='{h}'>{t}</a>" for h, t in (
        ("/news/1#c", "A long enough label"), ("https://sub.a.example/news/2", "Another <b>long</b> label"), ("../news/3", "One more long label"), ("/news/1", "Again the first label"), ("/about", "A page that is no news"),
        ("https://b.example/news/4", "Of another site, long"), ("/news/5", "short"), ("mailto:news@a.example", "Write to the desk now"), ("/list/", "This listing page itself"), ("./news/6", "Label number six is here"),
    ))
    df = spark.createDataFrame([(1, "https://a.example/list/", anchors)], "k int, url string, html string")
    assert [(r.link, r.rank) for r in pages.discover_links(df, "k", ["/news/"], 3).orderBy("rank").collect()] == [("https://a.example/news/1", 1), ("https://sub.a.example/news/2", 2), ("https://a.example/news/3", 3)]
    assert pages.discover_links(df, "k", ["/news/"], 9).count() == 4


def test_resolved_addresses(spark):
    page = "https://a.example/x/y/z.html?q#f"
    wanted = {"https://b.example/": "https://b.example/", "//c.example/d": "https://c.example/d", "/e": "https://a.example/e", "f": "https://a.example/x/y/f", "./g": "https://a.example/x/y/g", "../h": "https://a.example/x/h", "../../i/j": "https://a.example/i/j", "../../../k": "https://a.example/k", "?p=1": "https://a.example/x/y/z.html?p=1", "javascript:x()": None, "": None}
    got = spark.createDataFrame([(k,) for k in wanted], "k string").select("k", urls.resolved(F.col("k"), F.lit(page)).alias("u")).collect()
    assert {r.k: r.u for r in got} == wanted


def test_verification_and_enrichment(spark):
    title = "Council opens the river bridge"
    log = [
        ("https://a.example/1", None, 200, None, "<title>Council opens river bridge today</title><meta property='og:image' content='/p.jpg'>"), ("https://a.example/2", "https://b.example/2", 200, None, f"<title>{title}</title>"),
        ("https://a.example/3", None, 200, None, "<title>xyz</title>"), ("https://a.example/4", None, 503, None, ""), ("https://a.example/5", None, None, "TIMEOUT", None), ("https://a.example/6", "https://www.a.example/6", 200, None, "<link rel=canonical href='https://c.example/'>"),
    ]
    f = spark.createDataFrame(log, "url string, final_url string, http_status int, error_class string, html string")
    arts = spark.createDataFrame([(k, title, f"https://a.example/{k}") for k in range(1, 8)] + [(9, title, "ftp://x")], "id int, title string, link string")
    got = {r.id: r for r in pages.verify_articles(arts, f).collect()}
    assert {k: r.verification_status for k, r in got.items()} == {1: "VERIFIED", 2: "REDIRECTED_DOMAIN_REVIEW", 3: "TITLE_MISMATCH_REVIEW", 4: "HTTP_503", 5: "FETCH_ERROR", 6: "VERIFIED", 7: "FETCH_ERROR", 9: "INVALID_URL"}
    assert (got[1].image_url, got[1].image_status, got[2].image_status) == ("https://a.example/p.jpg", "FOUND_UNREVIEWED", "MISSING") and got[1].title_similarity > 0.8
    e = {r.url: r for r in pages.enrich(spark.createDataFrame([(u[0],) for u in log] + [("https://none.example/",)], "url string"), f).collect()}
    assert e["https://a.example/6"].canonical_url == "https://a.example/6" and e["https://a.example/1"].article_metadata_status == "VERIFIED_DATE_MISSING"
    assert e["https://a.example/4"].article_metadata_status == e["https://none.example/"].article_metadata_status == "FETCH_ERROR"


def test_title_similarity_is_that_of_matching_blocks(spark):
    import difflib
    import re

    titles = ["Council opens the river bridge", "River-bridge: council opens!", "한글 제목 하나", "한글 제목 둘", "", "A &amp; B", None]
    pairs = [(a, b) for a in titles for b in titles]
    norm = lambda x: re.sub(r"[^a-z0-9가-힣]+", " ", (x or "").replace("&amp;", "&").lower()).strip()
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", pages.title_similarity(F.col("a"), F.col("b")).alias("s")).collect()
    for r in got:
        a, b = norm(r.a), norm(r.b)
        assert abs(r.s - (difflib.SequenceMatcher(None, a, b).ratio() if a and b else 0.0)) < 1e-9


def test_fact_check(spark):
    trust = pages.Trust(official=("bok.or.kr",), primary=("nature.com",), wire=("reuters.com",), relay=("v.daum.net",), agencies=("AP",), major=("한국경제",))
    rows = [
        ("major", "https://www.hankyung.com/article/1", "한국경제", []), ("multi", "https://www.khan.co.kr/article/1", "경향신문", ["https://www.hani.co.kr/arti/1", "https://v.daum.net/v/1", "https://khan.co.kr/2"]),
        ("relay", "https://www.khan.co.kr/article/1", "경향신문", ["https://v.daum.net/v/1"]), ("official", "https://www.bok.or.kr/view", "한국은행", None), ("primary", "https://www.nature.com/a", "x", None), ("agency", "https://x.example/a", "AP", []),
        ("wire", "https://uk.reuters.com/a", "y", []), ("none", None, None, None), ("blocked", "https://z.example/a", "q", ["https://w.example/b"]),
    ]
    df = spark.createDataFrame(rows, "k string, link string, source string, evidence array<string>")
    log = spark.createDataFrame([("https://z.example/a", 403), ("https://x.example/a", 200)], "url string, http_status int")
    got = {r.k: r for r in pages.fact_check(df, "k", trust, log).collect()}
    assert {k: (r.status, r.evidence_type) for k, r in got.items()} == {
        "major": ("PARTIAL", "major_media"), "multi": ("VERIFIED_MULTI_SOURCE", "multi_source"), "relay": ("PARTIAL", "single_source_media"), "official": ("VERIFIED_OFFICIAL", "official"), "primary": ("VERIFIED_PRIMARY", "primary"),
        "agency": ("VERIFIED_PRIMARY", "wire_service"), "wire": ("VERIFIED_PRIMARY", "wire_service"), "none": ("UNVERIFIED", "unverified"), "blocked": ("ACCESS_BLOCKED", "network_blocked"),
    }
    assert got["multi"].verified_sources == ["khan.co.kr", "hani.co.kr"] and len(got["multi"].evidence_urls) == 2 and got["none"].evidence_urls == []


def test_pages_that_share_an_address_have_their_own_fetches(spark, tmp_path):
    """11 is not found, 13 fails, 17 is no HTML: none says anything of the others at the same address."""
    told = "".join(f"<p>River bridge council opens again, paragraph {k} of a longer report on the bridge.</p>" for k in range(6))
    rows = [(k, "https://a.example.com/news/1", f"<title>River bridge council opens</title>{told}{k}") for k in (1, 2, 11, 13, 17, 19)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    spark.createDataFrame([(k, "River bridge council opens\nx", "en", "src1", 9) for k, _, _ in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    for name in ("e1_fact_status", "e1_status_counts", "s6_body_extraction"):
        got = catalogue.queries()[name](spark, str(tmp_path))
        assert sorted(map(tuple, got.collect())) == sorted(duck.execute(f"SELECT {', '.join(got.columns)} FROM ({catalogue.oracle_sql()[name]})").fetchall()), name
    got = {r.page_id: r.verification_status for r in catalogue.queries()["s5_title_likeness"](spark, str(tmp_path)).collect()}
    assert got == {1: "VERIFIED", 2: "VERIFIED", 11: "HTTP_404", 13: "HTTP_500", 17: "VERIFIED", 19: "VERIFIED"}
