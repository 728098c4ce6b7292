"""Stored feed items and headlines."""

from pyspark.sql import functions as F

from gazette.sources import feeds

RSS = "<item><title>{}</title><link>https://a.example/{}</link><pubDate>Fri, 04 Sep 2026 01:02:03 GMT</pubDate><description>&lt;p&gt;Some &amp;amp; text&lt;/p&gt;</description></item>"


def test_items_and_entries(spark):
    rows = [
        ("rss", 0, RSS.format("River bridge opens", 1)), ("rss", 1, RSS.format("", 2)), ("rss", 2, RSS.format("Third headline", 3)), ("rss", 3, RSS.format("Fourth headline", 4)),
        ("atom", 0, '<entry xmlns="x"><title type="html"><![CDATA[Atom <b>title</b> here]]></title><link rel="alternate" href="https://www.b.example/x?a=1&amp;b=2"/><updated>2026-09-04T01:02:03Z</updated><content type="html">Long <i>text</i></content></entry>'),
        ("dc", 0, "<rdf:item><rss:title>With prefix</rss:title><rss:link>http://c.example/</rss:link><dc:date>2026-09-04</dc:date><content:encoded><![CDATA[<p>Body</p>]]></content:encoded></rdf:item>"),
        ("bad", 0, "no xml"), ("bad", 1, None), ("bad", 2, "<item><title>t</title><link>ftp://x</link></item>"),
    ]
    df = spark.createDataFrame(rows, "source string, seq long, xml string")
    got = {(r.source, r.seq): r for r in feeds.entries(df, 3).collect()}
    assert set(got) == {("rss", 0), ("rss", 2), ("atom", 0), ("dc", 0)}
    a, d, r = got["atom", 0], got["dc", 0], got["rss", 0]
    assert (a.title, a.url, a.domain, str(a.published_at), a.summary) == ("Atom title here", "https://www.b.example/x?a=1&b=2", "b.example", "2026-09-04 01:02:03", "Long text")
    assert (d.title, d.summary, str(d.published_at)) == ("With prefix", "Body", "2026-09-04 00:00:00")
    assert (r.summary, str(r.published_at)) == ("Some & text", "2026-09-04 01:02:03")


def test_headlines(spark):
    rules = feeds.Headlines()
    wanted = {"짧다": "short", "가" * 121: "long", "[포토] 오늘의 현장 사진 모음": "blacklist", "정말…이럴…수가…있나…싶은 일": "…", "이럴 수가! 정말! 놀랍다! 합니다": "!", "왜? 왜? 왜? 그럴까요 정말": "?", "충격 소식이 전해진 오늘 아침": "clickbait", "7월 경상수지 흑자 규모 최대": None}
    got = spark.createDataFrame([(t,) for t in wanted], "t string").select("t", feeds.headline_reason(F.col("t"), rules).alias("r")).collect()
    assert {r.t: r.r for r in got} == wanted
    split = {"A headline - Paper": ("A headline", "Paper"), "A - b - Paper": ("A - b", "Paper"), "A headline - " + "x" * 21: ("A headline - " + "x" * 21, None), "Plain": ("Plain", None)}
    got = spark.createDataFrame([(t,) for t in split], "t string").select("t", feeds.split_publisher(F.col("t")).alias("s")).collect()
    assert {r.t: (r.s.headline, r.s.publisher) for r in got} == split
    df = spark.createDataFrame([("wire", 0, RSS.format("A headline of some length - Paper", 1)), ("wire", 1, RSS.format("Short - Paper", 2)), ("wire", 2, RSS.format("A headline without one", 3))], "source string, seq long, xml string")
    assert [(r.title, r.publisher) for r in feeds.news_entries(df, rules).orderBy("seq").collect()] == [("A headline of some length", "Paper"), ("A headline without one", "wire")]


REFERENCES = "It&#8217;s &ndash; caf&eacute; &amp; &#x1F600; 5 &gt; 4 &nbsp; end"
DECODED = "It’s – café & 😀 5 > 4 end"


def test_all_references_are_decoded_in_every_reader(spark):
    import html
    import json

    from gazette.functions import text
    from gazette.operators import pages
    from gazette.sources import research

    one = spark.range(1)
    got = one.select(text.clean_html(F.lit(f"<p>{REFERENCES}</p>")).alias("a"), text.clean_html(F.lit("x &lt;i&gt;y&lt;/i&gt;  z")).alias("b"), text.clean_html(F.lit(None).cast("string")).alias("c"), text.unescape(F.lit("&amp;lt;")).alias("d")).first()
    assert tuple(got) == (DECODED, "x y z", None, "&lt;")
    item = f"<item><title>{html.escape(REFERENCES)}</title><link>https://a.example/x?a=1&amp;b=2</link><description>{html.escape('<b>' + REFERENCES + '</b>')}</description></item>"
    row = feeds.entries(spark.createDataFrame([("s", 1, item)], "source string, seq long, xml string")).first()
    assert (row.title, row.summary, row.url) == (DECODED, DECODED, "https://a.example/x?a=1&b=2")
    work = json.dumps({"DOI": "10.1/X", "title": [REFERENCES], "container-title": ["Caf&eacute;"], "author": [{"given": "Ren&eacute;", "family": "M&uuml;ller"}, {"given": " ", "family": ""}]})
    row = research.works_json(spark.createDataFrame([(1, "t", work)], "seq long, topic string, json string")).first()
    assert (row.title, row.journal, row.authors) == (DECODED, "Café", ["René Müller"])
    page = f'<a href="/news/1">{REFERENCES}</a>'
    row = pages.discover_links(spark.createDataFrame([(1, "https://a.example/", page)], "k int, url string, html string"), "k", ["/news"], 5).first()
    assert row.label == DECODED
    assert one.select(research.query_terms(F.lit("a &amp; b OR caf&eacute; or  d"))).first()[0] == ["a & b", "café", "d"]
