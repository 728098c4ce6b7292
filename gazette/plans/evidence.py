"""Evidence of pages and articles: resolution, corroboration, status ladders, images, and the joins between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette.functions import text, urls
from gazette.operators import pages, similar
from gazette.plans.catalogue import CAND, EVENT_PAIRS, HOST, KEY, LOG, event_sides, query
from gazette.sources.tables import candidates, fetch_log, table

#: Relays pass on what others publish; they are no evidence of their own.
RELAYS = [("relay.example.net",), ("news.example.net",)]
#: A page's evidence: its own address, and what its links say. The driver's pages link within one site, so that ids add other sites.
LINKS = f"""{LOG}, e AS (SELECT page_id, url AS link, 0 AS pos FROM pages WHERE url IS NOT NULL UNION ALL SELECT page_id, 'https://' || CASE (page_id + k) % 5 WHEN 0 THEN 'relay' WHEN 1 THEN 'wire' WHEN 2 THEN 'www.paper' ELSE 'site' || (page_id % 4) END || '.example.net/' || page_id || '/' || k, CAST(k AS INTEGER) FROM pages, range(1, 4) v(k) WHERE page_id % 3 <> 0),
d AS (SELECT page_id, link, pos, nullif(regexp_replace(regexp_extract(lower(link), '^https?://([^/?#:]+)', 1), '^www\\.', ''), '') AS domain FROM e),
ev AS (SELECT page_id, domain, arg_min(link, pos) AS link, min(pos) AS pos FROM d WHERE domain IS NOT NULL AND domain NOT IN ('relay.example.net', 'news.example.net') GROUP BY page_id, domain)"""


def evidence(spark: SparkSession, sf: str) -> DataFrame:
    """page_id, domain, link, pos: the first address of each domain that speaks for a page, without relays."""
    p = table(spark, sf, "pages")
    own = p.select("page_id", F.col("url").alias("link"), F.lit(0).alias("pos")).filter("link IS NOT NULL")
    k, n = F.col("pos"), (F.col("page_id") + F.col("pos")) % 5
    site = F.when(n == 0, "relay").when(n == 1, "wire").when(n == 2, "www.paper").otherwise(F.concat(F.lit("site"), (F.col("page_id") % 4).cast("string")))
    more = p.filter("page_id % 3 <> 0").select("page_id", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("pos"))
    more = more.select("page_id", F.concat(F.lit("https://"), site, F.lit(".example.net/"), F.col("page_id").cast("string"), F.lit("/"), k.cast("string")).alias("link"), "pos")
    d = own.unionByName(more).withColumn("domain", urls.domain(F.col("link"))).filter("domain IS NOT NULL")
    d = d.join(F.broadcast(spark.createDataFrame(RELAYS, "domain string")), "domain", "left_anti")
    return d.groupBy("page_id", "domain").agg(F.min_by("link", "pos").alias("link"), F.min("pos").alias("pos"))


@query(f"WITH {LINKS} SELECT page_id, domain, link FROM ev")
def e2_independent_evidence(spark: SparkSession, sf: str) -> DataFrame:
    return evidence(spark, sf).select("page_id", "domain", "link")


@query(f"WITH {LINKS}, g AS (SELECT page_id, list(domain ORDER BY pos) AS ds FROM ev GROUP BY page_id) SELECT page_id, array_to_string(ds[1:3], ', ') AS shown FROM g WHERE len(ds) >= 2")
def e3_evidence_domains(spark: SparkSession, sf: str) -> DataFrame:
    g = evidence(spark, sf).groupBy("page_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "domain"))), lambda x: x.domain).alias("ds"))
    return g.filter(F.size("ds") >= 2).select("page_id", F.array_join(F.slice("ds", 1, 3), ", ").alias("shown"))


STATUS_SQL = f"""{LINKS}, n AS (SELECT page_id, count(*) AS n FROM ev GROUP BY page_id), st AS (SELECT f.page_id, CASE WHEN http_status <> 200 THEN 'ACCESS_BLOCKED' WHEN f.domain LIKE '%.example.org' OR f.domain = 'example.org' THEN 'VERIFIED_OFFICIAL' WHEN f.page_id % 19 = 0 THEN 'VERIFIED_PRIMARY'
WHEN coalesce(n.n, 0) >= 2 THEN 'VERIFIED_MULTI_SOURCE' WHEN f.domain IS NOT NULL THEN 'PARTIAL' ELSE 'UNVERIFIED' END AS status, coalesce(n.n, 0) AS domains FROM f LEFT JOIN n USING (page_id))"""


TRUST = pages.Trust(official=("example.org",), relay=tuple(d for d, in RELAYS), agencies=("agency",), major=("src1",))


def fact_status(spark: SparkSession, sf: str) -> DataFrame:
    """page_id, status, domains: what the fetch, the domain, the source and independent evidence say of each page. Every nineteenth page is an agency's."""
    k = F.col("page_id")
    said = evidence(spark, sf).groupBy("page_id").agg(F.sort_array(F.collect_list(F.struct("pos", "link"))).alias("x"))
    f = fetch_log(spark, sf).join(said, "page_id", "left")
    arts = f.select("page_id", F.col("url").alias("link"), F.when(k % 19 == 0, "agency").otherwise("src1").alias("source"), F.transform("x", lambda x: x.link).alias("evidence"))
    n = pages.independent_evidence(arts, "page_id", TRUST).groupBy("page_id").agg(F.count(F.lit(1)).alias("domains"))
    return pages.fact_check(arts, "page_id", TRUST, fetch_log(spark, sf).select("page_id", "http_status")).join(n, "page_id", "left").select("page_id", "status", F.coalesce("domains", F.lit(0)).alias("domains"), "evidence_type")


@query(f"WITH {STATUS_SQL} SELECT page_id, status, domains FROM st")
def e1_fact_status(spark: SparkSession, sf: str) -> DataFrame:
    return fact_status(spark, sf).select("page_id", "status", "domains")


@query(f"WITH {STATUS_SQL} SELECT status, count(*) AS n, CAST(sum(domains) AS BIGINT) AS domains FROM st GROUP BY status")
def e1_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return fact_status(spark, sf).groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("domains").alias("domains"))


IMG = f"{LOG}, i AS (SELECT page_id, url, http_status, CASE page_id % 4 WHEN 0 THEN 'image/png' WHEN 1 THEN 'image/jpeg' WHEN 2 THEN 'image/svg+xml' ELSE 'text/html' END AS kind, html FROM f)"


def _kind() -> Column:
    k = F.col("page_id") % 4
    return F.when(k == 0, "image/png").when(k == 1, "image/jpeg").when(k == 2, "image/svg+xml").otherwise("text/html")


@query(f"""WITH {IMG}, m AS (SELECT *, CASE WHEN page_id % 5 = 0 THEN 'guess' WHEN page_id % 5 = 1 THEN 'twitter:image' ELSE 'og:image' END AS method, CASE WHEN page_id % 7 = 0 THEN '' ELSE sha256(html) END AS hash, CASE WHEN page_id % 23 = 0 THEN url || '#x' ELSE url END AS page_url FROM i)
SELECT page_id, CASE WHEN http_status <> 200 THEN 'NO_CANDIDATE' WHEN url IS NULL OR page_url <> url THEN 'PAGE_URL_MISMATCH' WHEN method = 'guess' THEN 'UNSUPPORTED_DECLARATION' WHEN kind NOT LIKE 'image/%' OR kind = 'image/svg+xml' THEN 'INVALID_IMAGE_CONTENT_TYPE'
WHEN length(hash) <> 64 THEN 'MISSING_CONTENT_HASH' ELSE 'VERIFIED_PROVENANCE' END AS decision FROM m""")
def p18_image_provenance(spark: SparkSession, sf: str) -> DataFrame:
    k, url, kind = F.col("page_id"), F.col("url"), _kind()
    hash_ = F.when(k % 7 == 0, "").otherwise(F.sha2("html", 256))
    page_url = F.when(k % 23 == 0, F.concat(url, F.lit("#x"))).otherwise(url)
    decision = (
        F.when(F.col("http_status") != 200, "NO_CANDIDATE").when(url.isNull() | (page_url != url), "PAGE_URL_MISMATCH").when(k % 5 == 0, "UNSUPPORTED_DECLARATION")
        .when(~kind.startswith("image/") | (kind == "image/svg+xml"), "INVALID_IMAGE_CONTENT_TYPE").when(F.length(hash_) != 64, "MISSING_CONTENT_HASH").otherwise("VERIFIED_PROVENANCE")
    )
    return fetch_log(spark, sf).select("page_id", decision.alias("decision"))


#: The driver's pages carry no declarations of an image, a date or an address of their own, so that ids add them.
HEAD_SQL = """h AS (SELECT page_id, url, CASE page_id % 4 WHEN 0 THEN '<meta property="og:image" content="/img/' || page_id || '.jpg">' WHEN 1 THEN '<meta name="twitter:image" content="https://cdn.example.com/' || page_id || '.png">' WHEN 2 THEN '<meta property="og:image" content="/logo.png">' ELSE '' END
|| CASE page_id % 3 WHEN 0 THEN '<meta property="article:published_time" content="2024-01-' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') || '">' WHEN 1 THEN '<time datetime="2024-02-01">' ELSE '' END || CASE WHEN page_id % 2 = 0 THEN '<link rel="canonical" href="' || url || '">' ELSE '' END || html AS html, regexp_extract(url, '^https?://[^/]+', 0) AS base FROM pages)"""


def declared(spark: SparkSession, sf: str) -> DataFrame:
    k, u = F.col("page_id"), F.col("url")
    text_ = k.cast("string")
    image = F.when(k % 4 == 0, F.concat(F.lit('<meta property="og:image" content="/img/'), text_, F.lit('.jpg">'))).when(k % 4 == 1, F.concat(F.lit('<meta name="twitter:image" content="https://cdn.example.com/'), text_, F.lit('.png">')))
    image = image.when(k % 4 == 2, '<meta property="og:image" content="/logo.png">').otherwise("")
    date = F.when(k % 3 == 0, F.concat(F.lit('<meta property="article:published_time" content="2024-01-'), F.lpad((k % 28 + 1).cast("string"), 2, "0"), F.lit('">'))).when(k % 3 == 1, '<time datetime="2024-02-01">').otherwise("")
    own = F.when(k % 2 == 0, F.concat(F.lit('<link rel="canonical" href="'), u, F.lit('">'))).otherwise("")
    return table(spark, sf, "pages").select("page_id", "url", F.concat(image, date, own, F.col("html")).alias("html"), F.regexp_extract("url", "^https?://[^/]+", 0).alias("base"))


@query(f"""WITH {HEAD_SQL}, i AS (SELECT page_id, base, coalesce(nullif(regexp_extract(html, '<meta property="og:image" content="([^"]*)"', 1), ''), nullif(regexp_extract(html, '<meta name="twitter:image" content="([^"]*)"', 1), '')) AS raw FROM h), a AS (SELECT page_id, CASE WHEN raw LIKE 'http%' THEN raw WHEN raw LIKE '/%' THEN base || raw END AS image FROM i)
SELECT page_id, image FROM a WHERE image IS NOT NULL AND regexp_matches(image, '^https?://') AND NOT regexp_matches(image, '{pages.NO_PICTURE}')""")
def s7_declared_images(spark: SparkSession, sf: str) -> DataFrame:
    heads = declared(spark, sf).select("page_id", "url", "html")
    return pages.declared(heads).filter("image IS NOT NULL").select("page_id", "image")


@query(f"""WITH {HEAD_SQL}, m AS (SELECT page_id, url, nullif(regexp_extract(html, '<link rel="canonical" href="([^"]*)"', 1), '') AS canonical, coalesce(nullif(regexp_extract(html, '<meta property="article:published_time" content="([^"]*)"', 1), ''), nullif(regexp_extract(html, '<time datetime="([^"]*)"', 1), '')) AS published FROM h)
SELECT page_id, coalesce(canonical, url) AS canonical_url, published, CASE WHEN published IS NULL THEN 'VERIFIED_DATE_MISSING' ELSE 'VERIFIED' END AS status FROM m""")
def s4_page_metadata(spark: SparkSession, sf: str) -> DataFrame:
    heads = pages.declared(declared(spark, sf).select("page_id", "url", "html"))
    own = urls.same_site(urls.domain(F.col("canonical")), urls.domain(F.col("url")))
    return heads.select("page_id", F.when(own, F.col("canonical")).otherwise(F.col("url")).alias("canonical_url"), "published", F.when(F.col("published").isNull(), "VERIFIED_DATE_MISSING").otherwise("VERIFIED").alias("status"))


@query()
def s5_title_likeness(spark: SparkSession, sf: str) -> DataFrame:
    """Documents against the pages of their numbers, as staging does; the tests hold the likeness against a plain one."""
    log = fetch_log(spark, sf).select("page_id", "url", F.lit(None).cast("string").alias("final_url"), "http_status", F.lit(None).cast("string").alias("error_class"), "html")
    arts = log.select("page_id", F.col("url").alias("link")).join(candidates(spark, sf).select(F.col("seq").alias("page_id"), "title"), "page_id")
    return pages.verify_articles(arts, log, "page_id").select("page_id", "title_similarity", "verification_status", "image_status")


@query(f"""WITH {EVENT_PAIRS}, x AS (SELECT l, r, rank, 'd' || r % 7 || '.example.org' AS domain FROM jk WHERE rank <= 3 AND r % 11 <> 0 AND 'd' || r % 7 || '.example.org' <> 'd' || l % 7 || '.example.org'),
f AS (SELECT l, domain, arg_min(r, rank) AS r, min(rank) AS rank FROM x GROUP BY l, domain), z AS (SELECT *, row_number() OVER (PARTITION BY l ORDER BY rank) AS place FROM f)
SELECT l AS seq, domain, 'https://' || domain || '/' || r AS url, CAST(place AS INTEGER) AS place FROM z WHERE place <= 2""")
def j4_corroborating_urls(spark: SparkSession, sf: str) -> DataFrame:
    """Of the corroborating passages those whose address could be resolved (here: ids that 11 does not divide), one for each domain but the article's own."""
    left, right = event_sides(spark, sf)
    host = lambda k: F.concat(F.lit("d"), (k % 7).cast("string"), F.lit(".example.org"))
    k = F.col("id")
    resolved = right.filter(k % 11 != 0).select(k.alias("r"), F.concat(F.lit("https://"), host(k), F.lit("/"), k.cast("string")).alias("url"), host(k).alias("domain"))
    own = left.select(k.alias("l"), host(k).alias("domain"))
    return similar.attached(similar.corroborating(left, right), resolved, own).select(F.col("l").alias("seq"), "domain", "url", "place")


@query(f"""WITH p AS (SELECT {KEY} AS key, min(page_id) AS page_id, count(*) - 1 AS duplicates FROM pages WHERE url IS NOT NULL AND page_id % 3 <> 0 GROUP BY 1), o AS (SELECT page_id AS id, {KEY} AS key, CASE page_id % 5 WHEN 0 THEN 'b' ELSE 'a' END AS chapter FROM pages)
SELECT id, CASE WHEN p.key IS NULL THEN 'missing' WHEN chapter <> CASE p.page_id % 4 WHEN 0 THEN 'b' ELSE 'a' END THEN 'chapter_mismatch' ELSE 'applied' END AS overlay, coalesce(duplicates, 0) AS duplicates FROM o LEFT JOIN p USING (key)""")
def j5_editorial_overlay(spark: SparkSession, sf: str) -> DataFrame:
    """Overlays (pages that three does not divide, the first of each address) on records with the same address and chapter."""
    p = table(spark, sf, "pages").select("page_id", urls.canonical_key(F.col("url")).alias("key"))
    packs = p.filter("key IS NOT NULL AND page_id % 3 <> 0").groupBy("key").agg(F.min("page_id").alias("pack"), (F.count(F.lit(1)) - 1).alias("duplicates"))
    chapter = lambda c, n: F.when(F.col(c) % n == 0, "b").otherwise("a")
    met = p.join(packs, "key", "left")
    state = F.when(F.col("pack").isNull(), "missing").when(chapter("page_id", 5) != chapter("pack", 4), "chapter_mismatch").otherwise("applied")
    return met.select(F.col("page_id").alias("id"), state.alias("overlay"), F.coalesce("duplicates", F.lit(0)).alias("duplicates"))


@query(f"""WITH p AS (SELECT DISTINCT {HOST} AS domain FROM pages), q AS (SELECT domain FROM p WHERE domain IS NOT NULL), g AS (SELECT DISTINCT 'src' || s_suppkey % 20 || '.example.com' AS domain FROM supplier)
SELECT count(*) AS preferred, count(*) FILTER (domain IN (SELECT domain FROM g)) AS registered, round(count(*) FILTER (domain IN (SELECT domain FROM g)) / count(*), 6) AS coverage FROM q""")
def j7_registry_coverage(spark: SparkSession, sf: str) -> DataFrame:
    q = table(spark, sf, "pages").select(urls.domain(F.col("url")).alias("domain")).filter("domain IS NOT NULL").distinct()
    g = table(spark, sf, "supplier").select(F.concat(F.lit("src"), (F.col("s_suppkey") % 20).cast("string"), F.lit(".example.com")).alias("domain")).distinct().withColumn("known", F.lit(1))
    n, known = F.count(F.lit(1)), F.count("known")
    return q.join(g, "domain", "left").agg(n.alias("preferred"), known.alias("registered"), F.round(known / n, 6).alias("coverage"))


@query(f"""WITH {CAND}, b AS (SELECT chapter, count(*) AS n, count(DISTINCT source) AS d FROM c WHERE seq % 2 = 0 GROUP BY chapter), a AS (SELECT chapter, count(*) AS n, count(DISTINCT source) AS d FROM c WHERE seq % 3 <> 0 GROUP BY chapter)
SELECT coalesce(a.chapter, b.chapter) AS chapter, coalesce(a.n, 0) - coalesce(b.n, 0) AS articles_delta, coalesce(a.d, 0) - coalesce(b.d, 0) AS domains_delta, coalesce(a.d, 0) >= coalesce(b.d, 0) AS gate FROM a FULL JOIN b USING (chapter)""")
def j9_before_after(spark: SparkSession, sf: str) -> DataFrame:
    """Both editions in one aggregate over one scan: the rows of each are told by a condition."""
    c = candidates(spark, sf).select("chapter", "source", (F.col("seq") % 2 == 0).alias("before"), (F.col("seq") % 3 != 0).alias("after"))
    n = lambda side: F.count_if(F.col(side))
    d = lambda side: F.count_distinct(F.when(F.col(side), F.col("source")))
    return c.filter("before OR after").groupBy("chapter").agg((n("after") - n("before")).alias("articles_delta"), (d("after") - d("before")).alias("domains_delta"), (d("after") >= d("before")).alias("gate"))
