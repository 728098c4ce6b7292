"""Feeds as candidates: items of RSS and entries of Atom, whatever the prefix of their elements, and the tests on headlines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazette.functions import lineage, text, times, urls


@dataclass(frozen=True)
class Headlines:
    """What makes a headline unfit. The lists are fixed values of a Korean desk; each can be replaced."""

    least: int = 10
    most: int = 120
    blacklist: tuple[str, ...] = (
        "[인사]", "[부고]", "[동정]", "[포토]", "[화보]", "오늘의 운세", "띠별 운세", "포토뉴스", "이벤트", "할인 혜택", "특가 판매", "선착순 증정", "체험단 모집", "경품", "로또", "당첨번호", "비아그라", "카지노", "바카라", "토토",
    )
    bait: tuple[str, ...] = ("경악", "충격", "알고보니 헉", "발칵", r"숨진 채 발견\.\.\.충격")
    #: Marks, and how often each may stand in a headline.
    marks: tuple[tuple[str, int], ...] = (("…", 3), ("!", 2), ("?", 2))


def headline_reason(title: Column, rules: Headlines) -> Column:
    """Why a headline is unfit: short, long, blacklist, the mark that it has too often, clickbait; null if it is fit."""
    count = lambda mark: F.length(title) - F.length(F.replace(title, F.lit(mark), F.lit("")))
    listed = F.lit(False)
    for word in rules.blacklist:
        listed = listed | title.contains(word)
    reason = F.when(F.length(title) < rules.least, "short").when(F.length(title) > rules.most, "long").when(listed, "blacklist")
    for mark, most in rules.marks:
        reason = reason.when(count(mark) > most, mark)
    return reason.when(title.rlike("|".join(rules.bait)), "clickbait") if rules.bait else reason


def split_publisher(title: Column, most: int = 20) -> Column:
    """struct(headline, publisher): what follows the last `` - `` of a headline, if it is short, is its publisher; else null."""
    pattern = rf"(?s)^(.*) - ((?:(?! - ).){{0,{most}}})$"
    parts = lambda t: F.struct(F.when(t.rlike(pattern), F.trim(F.regexp_extract(t, pattern, 1))).otherwise(t).alias("headline"), F.when(t.rlike(pattern), F.trim(F.regexp_extract(t, pattern, 2))).alias("publisher"))
    return text.let(title, parts)


def _inner(xml: Column, names: str) -> Column:
    """The content of the first element with one of the names; '' without one. Character data sections are opened."""
    found = F.regexp_extract(xml, rf"(?is)<(?:{names})(?:\s[^>]*)?(?<!/)>(.*?)</(?:{names})\s*>", 1)
    return F.regexp_replace(found, r"(?s)<!\[CDATA\[(.*?)\]\]>", "$1")


def entries(items: DataFrame, limit: int | None = None, most: int = 700) -> DataFrame:
    """source, seq, title, url, domain, published (as written), published_at, summary: items with a title and an http address, the first ``limit`` of each source.

    ``items`` has source, seq (place in the feed) and xml, one item or entry to a row. The first element of a kind
    counts: title; link (its ``href``, else its text); pubDate, published, updated, date or issued; description,
    summary, content or encoded. Tags and references are taken out of texts. The limit counts items before the tests, as
    a feed is read no further. Rows that are no item have no title and are dropped.
    """
    if limit is not None:
        items = items.withColumn("__r", F.row_number().over(Window.partitionBy("source").orderBy("seq"))).filter(F.col("__r") <= limit)
    x = lineage.once(items.select("source", "seq", "xml"), {"xml": F.regexp_replace("xml", r"<(/?)[A-Za-z][\w.-]*:(?=[A-Za-z])", "<$1")})
    xml = F.col("xml")
    tag = F.regexp_extract(xml, r"(?is)<link(?:\s[^>]*)?>", 0)
    href = F.regexp_extract(tag, r"""(?is)\shref\s*=\s*["']([^"']*)["']""", 1)
    # What the tests need is computed once a row, step by step: references of XML, then those of its text, which may hide tags. The rest only where it is asked for.
    x = lineage.once(x, {"title": _inner(xml, "title"), "url": F.when(href != "", href).otherwise(_inner(xml, "link"))})
    x = lineage.once(x, {"title": text.unescape(F.col("title")), "url": text.one_line(text.unescape(F.col("url")))})
    x = lineage.once(x, {"title": text.clean_html(F.col("title"))})
    x = x.filter((F.col("title") != "") & F.col("url").startswith("http"))
    plain = lambda c: text.clean_html(text.unescape(c))
    summary = F.substring(plain(_inner(xml, "description|summary|content|encoded")), 1, most)
    x = x.select("source", "seq", "title", "url", text.one_line(_inner(xml, "pubdate|published|updated|date|issued")).alias("published"), summary.alias("summary"))
    return x.select("source", "seq", "title", "url", urls.domain(F.col("url")).alias("domain"), "published", times.published(F.col("published")).alias("published_at"), "summary")


def news_entries(items: DataFrame, rules: Headlines, limit: int | None = None) -> DataFrame:
    """:func:`entries` with the publisher split out of the headline (else the source), and only fit headlines."""
    x = lineage.once(entries(items, limit), {"__t": split_publisher(F.col("title"))})
    x = x.withColumns({"title": F.col("__t.headline"), "publisher": F.coalesce(F.nullif(F.col("__t.publisher"), F.lit("")), F.col("source"))}).drop("__t")
    return x.filter(text.let(F.col("title"), lambda t: headline_reason(t, rules)).isNull())
