"""Gates, reports, digests and set operations: a gate is a union of rules, each giving the rows that break it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette.functions import urls
from gazette.operators import audits
from gazette.plans.catalogue import CAND, HOST, IMPORTANCE, KEY, _scored, first_stories, query
from gazette.sources.tables import candidates, table


def broken(rows: DataFrame, edition: Column, rule: str, detail: Column) -> DataFrame:
    return rows.select(edition.alias("edition"), F.lit(rule).alias("rule"), detail.cast("string").alias("detail"))


def gate(*rules: DataFrame) -> DataFrame:
    """edition, rule, detail; no rows: passed."""
    return reduce(DataFrame.unionByName, rules)


SOURCES = audits.Sources(most_share=0.3, most_wire=0.25, wire=("src1.example.com", "src3.example.com"), discovery=("src7.example.com",), generic=("/news",))
STORY_SQL = f"""{CAND}, st AS (SELECT *, {HOST} AS domain FROM (SELECT chapter AS edition, 's' || seq % 15 AS section, seq % 16 = 1 AS studied, title, seq, row_number() OVER (PARTITION BY chapter, seq % 15 ORDER BY seq) AS r, row_number() OVER (PARTITION BY chapter, seq % 16 ORDER BY seq) AS q,
CASE WHEN seq % 29 = 5 THEN NULL WHEN seq % 29 = 3 THEN 'ftp://' || source || '.example.com/x' WHEN seq % 31 = 6 THEN 'https://' || source || '.example.com/news' WHEN seq % 23 = 4 THEN 'https://www.' || source || '.example.com/same' ELSE link END AS url FROM c)),
s AS (SELECT * FROM st WHERE r <= 10), rs AS (SELECT * FROM st WHERE studied AND q <= 10),
b AS (SELECT edition, section, domain, count(*) AS n FROM s GROUP BY ALL), sec AS (SELECT edition, section, CAST(sum(n) AS BIGINT) AS items, count(domain) AS domains, coalesce(max(n) FILTER (domain IS NOT NULL), 0) AS most, CAST(coalesce(sum(n) FILTER (domain IN ('src1.example.com', 'src3.example.com')), 0) AS BIGINT) AS wire FROM b GROUP BY ALL),
ed AS (SELECT edition, CAST(sum(items) AS BIGINT) AS stories, count(*) AS sections FROM sec GROUP BY edition), ro AS (SELECT edition, count(*) AS n, count(DISTINCT domain) AS domains FROM rs GROUP BY edition)"""


def _told(rows: str, rule: str, key: str, detail: str = "NULL", severity: str = "error") -> str:
    return f"SELECT edition, '{severity}' AS severity, '{rule}' AS rule, CAST({key} AS VARCHAR) AS key, CAST({detail} AS VARCHAR) AS detail FROM {rows}"


@query(f"WITH {STORY_SQL} " + " UNION ALL ".join([
    _told("ed WHERE stories <> 150", "story_count", "'stories'", "stories"), _told("ed WHERE sections <> 15", "section_count", "'sections'", "sections"), _told("(SELECT edition, url, count(*) AS n FROM s WHERE url IS NOT NULL GROUP BY ALL) WHERE n > 1", "duplicate_url", "url", "n"),
    _told("sec WHERE items <> 10", "section_items", "section", "items"), _told("sec WHERE domains < 5", "few_domains", "section", "domains", "warning"), _told("sec WHERE most / items > 0.3", "domain_share", "section", "most", "warning"), _told("sec WHERE wire / items > 0.25", "wire_share", "section", "wire", "warning"),
    _told("s WHERE url IS NULL", "missing_url", "title"), _told("s WHERE url LIKE 'ftp:%'", "non_http", "url", "title"), _told("s WHERE domain = 'src7.example.com'", "discovery_only", "url", "title", "warning"), _told("s WHERE url LIKE 'https://%/news'", "generic_url", "url", "title", "warning"),
    _told("ro WHERE n <> 10", "research_items", "'research'", "n"), _told("ro WHERE domains < 5", "research_domains", "'research'", "domains"), _told("rs WHERE domain IS NULL", "research_url", "title"), _told("rs WHERE domain = 'src7.example.com'", "research_discovery", "url", "title"),
]))
def g2_source_audit(spark: SparkSession, sf: str) -> DataFrame:
    """An edition for each language: fifteen sections of its first ten documents, and ten records of research; some addresses are missing, of sections, or doubled."""
    k = F.col("seq")
    url = F.when(k % 29 == 5, None).when(k % 29 == 3, F.concat(F.lit("ftp://"), "source", F.lit(".example.com/x"))).when(k % 31 == 6, F.concat(F.lit("https://"), "source", F.lit(".example.com/news"))).when(k % 23 == 4, F.concat(F.lit("https://www."), "source", F.lit(".example.com/same"))).otherwise(F.col("link"))
    c = candidates(spark, sf).select(F.col("chapter").alias("edition"), "seq", "title", F.concat(F.lit("s"), (k % 15).cast("string")).alias("section"), url.alias("url"))
    first = lambda by: F.row_number().over(Window.partitionBy("edition", by).orderBy("seq"))
    stories = c.withColumn("r", first("section")).filter("r <= 10").select("edition", "section", "title", "url")
    research = c.filter(k % 16 == 1).withColumn("r", F.row_number().over(Window.partitionBy("edition").orderBy("seq"))).filter("r <= 10").select("edition", "title", "url")
    return audits.source_faults(stories, research, SOURCES)


SNAPSHOT = audits.Snapshot(schema="v2", status="AUDITED", algorithm="sha256", chapters=("a", "b", "c", "d"), discovery=("src7.example.com",), generic=("/news",))
SNAP_SQL = f"""{CAND}, si AS (SELECT * FROM (SELECT chapter AS edition, ['a', 'b', 'c', 'd'][CAST(seq % 4 AS INTEGER) + 1] AS chapter, seq AS pos, source, title, CASE WHEN seq % 31 = 6 THEN 'https://' || source || '.example.com/news/' WHEN seq % 29 = 3 THEN '' ELSE link END AS address, source || '.example.com' AS domain,
row_number() OVER (PARTITION BY chapter, seq % 4 ORDER BY seq) AS r FROM c) WHERE r <= 10), n AS (SELECT edition, count(*) AS there FROM si GROUP BY edition),
bd AS (SELECT edition, chapter, domain, count(*) AS n FROM si GROUP BY ALL), ct AS (SELECT edition, chapter, CAST(sum(n) AS BIGINT) AS rows_, count(*) AS domains, max(n) AS most FROM bd GROUP BY ALL), wh AS (SELECT * FROM ct WHERE rows_ = 10)"""


@query(f"WITH {SNAP_SQL} " + " UNION ALL ".join([
    _told("n WHERE edition = 'fr'", "schema_version", "edition", "'v1'"), _told("n WHERE edition = 'fr'", "selected_files", "edition", "3"), _told("n WHERE there <> 40", "selected_count", "edition", "there"), _told("n WHERE edition = 'es'", "fingerprint", "edition"),
    _told("si WHERE address = ''", "not_absolute", "pos", "address"), _told("(SELECT edition, address, count(*) AS n FROM si WHERE address <> '' GROUP BY ALL) WHERE n > 1", "duplicate_url", "address", "n"), _told("si WHERE title = ''", "missing_title", "pos"),
    _told("(SELECT DISTINCT n.edition, v.chapter, coalesce(rows_, 0) AS k FROM n CROSS JOIN (VALUES ('a'), ('b'), ('c'), ('d')) v(chapter) LEFT JOIN ct ON ct.edition = n.edition AND ct.chapter = v.chapter) WHERE k <> 10", "chapter_rows", "chapter", "k"),
    _told("wh WHERE domains < 5", "few_domains", "chapter", "domains"), _told("wh WHERE most > 2", "domain_cap", "chapter", "most"), _told("wh WHERE edition = 'de'", "report_domains", "chapter", "domains + 1"),
    _told("si JOIN wh USING (edition, chapter) WHERE address LIKE '%/src7.example.com/%'", "discovery_only", "pos", "address"), _told("si JOIN wh USING (edition, chapter) WHERE address LIKE '%/news/'", "generic_url", "pos", "address"),
]))
def g3_snapshot_audit(spark: SparkSession, sf: str) -> DataFrame:
    """A snapshot for each language: four chapters of ten; the manifests of three of them differ in a file, the digest, and a count."""
    k = F.col("seq")
    address = F.when(k % 31 == 6, F.concat(F.lit("https://"), "source", F.lit(".example.com/news/"))).when(k % 29 == 3, "").otherwise(F.col("link"))
    c = candidates(spark, sf).select(F.col("chapter").alias("edition"), F.element_at(F.array(*[F.lit(x) for x in "abcd"]), (k % 4 + 1).cast("int")).alias("chapter"), k.alias("pos"), "source", "title", F.lit("2024-01-08").alias("published"), F.concat("source", F.lit(".example.com")).alias("domain"), F.lit(None).cast("string").alias("canonical_url"), address.alias("url"))
    items = c.withColumn("r", F.row_number().over(Window.partitionBy("edition", "chapter").orderBy("pos"))).filter("r <= 10").drop("r")
    counts = items.groupBy("edition", "chapter", "domain").agg(F.count(F.lit(1)).alias("n")).groupBy("edition", "chapter").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("domains"), F.map_from_entries(F.collect_list(F.struct("domain", "n"))).alias("counts"))
    report = F.struct(F.col("rows").alias("selected_count"), (F.col("domains") + F.when(F.col("edition") == "de", 1).otherwise(0)).alias("unique_domains"), F.col("counts").alias("domain_counts"), F.lit("PASS").alias("status"))
    made = counts.groupBy("edition").agg(F.map_from_entries(F.collect_list(F.struct("chapter", report.alias("r")))).alias("chapter_report")).join(audits.fingerprints(items), "edition")
    e = F.col("edition")
    files = F.slice(F.array(*[F.lit(f"{x}.json") for x in "abcd"]), F.lit(1), F.when(e == "fr", 3).otherwise(4))
    manifest = made.select(
        e, F.when(e == "fr", "v1").otherwise("v2").alias("schema_version"), F.lit("AUDITED").alias("snapshot_status"), files.alias("selected_files"), F.lit(40).cast("long").alias("selected_count"), F.lit(10).cast("long").alias("target_per_chapter"), F.lit(5).cast("long").alias("minimum_unique_domains"),
        F.lit(2).cast("long").alias("max_per_domain"), F.array().cast("array<string>").alias("cross_chapter_duplicate_urls"), F.lit("sha256").alias("fingerprint_algorithm"), F.when(e == "es", "0").otherwise(F.col("fingerprint")).alias("selection_fingerprint_sha256"), "chapter_report",
    )
    return audits.snapshot_faults(manifest, items, SNAPSHOT)


STAGING = audits.Staging(schema="v1", chapters=("a", "b", "c", "d"), fields=("title", "summary"), local=("title",), statuses=("CONFIRMED", "UNVERIFIED"), script="[th]")
STAGE_SQL = f"""{CAND}, sg AS (SELECT * FROM (SELECT chapter AS edition, ['a', 'b', 'c', 'd'][CAST(seq % 4 AS INTEGER) + 1] AS chapter, 'priority-' || lpad(CAST(seq AS VARCHAR), 6, '0') AS id, trim(title) AS title, trim(summary) AS summary, seq % 3 <> 0 AS verified, CASE WHEN seq % 29 = 3 THEN 'x' WHEN seq % 19 = 2 THEN 'https://same.example/' ELSE link END AS address,
CASE seq % 5 WHEN 0 THEN '' WHEN 1 THEN 'SURE' ELSE 'CONFIRMED' END AS fact, seq % 7 = 0 AS review, row_number() OVER (PARTITION BY chapter, seq % 4 ORDER BY seq) AS r FROM c) WHERE r <= 10),
rd AS (SELECT *, title <> '' AND summary <> '' AND regexp_matches(title, '[th]') AND fact = 'CONFIRMED' AND verified AND NOT review AS ready, concat_ws(',', CASE WHEN title = '' THEN 'title' END, CASE WHEN summary = '' THEN 'summary' END, CASE WHEN fact = '' THEN 'factcheck_status' END) AS missing FROM sg),
hd AS (SELECT edition, count(*) AS n FROM sg GROUP BY edition), gc AS (SELECT edition, chapter, count(*) AS n FROM sg GROUP BY ALL)"""


@query(f"WITH {STAGE_SQL} " + " UNION ALL ".join([
    _told("hd WHERE edition = 'fr'", "schema_version", "edition", "'v0'"), _told("hd WHERE n <> 40", "record_count", "edition", "n"), _told("hd WHERE edition = 'de'", "production_ready", "edition"),
    _told("(SELECT hd.edition, v.chapter, coalesce(gc.n, 0) AS k FROM hd CROSS JOIN (VALUES ('a'), ('b'), ('c'), ('d')) v(chapter) LEFT JOIN gc ON gc.edition = hd.edition AND gc.chapter = v.chapter) WHERE k <> 10", "chapter_records", "chapter", "k"),
    _told("rd WHERE address = 'x'", "invalid_url", "id", "address"), _told("(SELECT edition, address, count(*) AS n FROM rd GROUP BY ALL) WHERE n > 1", "duplicate_url", "address", "n"), _told("rd WHERE NOT verified", "not_verified", "id", "'UNVERIFIED'", "warning"),
    _told("rd WHERE fact = 'SURE'", "factcheck_status", "id", "fact"), _told("rd WHERE title <> '' AND NOT regexp_matches(title, '[th]')", "foreign_text", "id", "'title'"), _told("rd WHERE NOT ready", "not_ready", "id", "missing"),
    _told("(SELECT edition, count(*) AS n, count(*) FILTER (ready) AS ready FROM rd GROUP BY edition) WHERE n <> ready", "ready_count", "'ALL'", "ready"),
]))
def g4_staging_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Staging records of four chapters of ten for each language, all of which have to be ready."""
    k = F.col("seq")
    c = candidates(spark, sf).select(
        F.col("chapter").alias("edition"), F.element_at(F.array(*[F.lit(x) for x in "abcd"]), (k % 4 + 1).cast("int")).alias("chapter"), k.alias("seq"), F.concat(F.lit("priority-"), F.lpad(k.cast("string"), 6, "0")).alias("staging_id"), F.lit(None).cast("string").alias("final_url"), F.lit("").alias("canonical_url"),
        F.when(k % 29 == 3, "x").when(k % 19 == 2, "https://same.example/").otherwise(F.col("link")).alias("source_url"), F.when(k % 3 != 0, "VERIFIED").otherwise("UNVERIFIED").alias("verification_status"), (k % 7 == 0).alias("image_review_required"),
        F.when(k % 5 == 0, "").when(k % 5 == 1, "SURE").otherwise("CONFIRMED").alias("factcheck_status"), F.create_map(F.lit("title"), "title", F.lit("summary"), "summary").alias("editorial"),
    )
    records = c.withColumn("r", F.row_number().over(Window.partitionBy("edition", "chapter").orderBy("seq"))).filter("r <= 10").drop("r", "seq")
    e = F.col("edition")
    headers = records.select("edition").distinct().select(e, F.when(e == "fr", "v0").otherwise("v1").alias("schema_version"), (e == "de").alias("production_ready"))
    return audits.staging_faults(records, headers, STAGING, require_ready=True)


@query(f"""WITH o AS (SELECT o_orderstatus AS edition, o_orderkey, o_totalprice, o_custkey FROM orders) SELECT edition, 'no_customer' AS rule, CAST(o_orderkey AS VARCHAR) AS detail FROM o WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT edition, 'too_dear', CAST(o_orderkey AS VARCHAR) FROM o WHERE o_totalprice > 400000
UNION ALL SELECT edition, 'few_orders', CAST(count(*) AS VARCHAR) FROM o GROUP BY edition HAVING count(*) < 1000""")
def g5_release_contract(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("edition"), "o_orderkey", "o_totalprice", "o_custkey")
    known = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"))
    e, k = F.col("edition"), F.col("o_orderkey")
    return gate(broken(o.join(known, "o_custkey", "left_anti"), e, "no_customer", k), broken(o.filter("o_totalprice > 400000"), e, "too_dear", k), broken(o.groupBy("edition").count().filter("count < 1000"), e, "few_orders", F.col("count")))


@query("""WITH l AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1), j AS (SELECT o_orderstatus AS edition, o_orderkey AS k, coalesce(n, 0) AS n FROM orders LEFT JOIN l ON o_orderkey = k)
SELECT edition, 'content_count' AS rule, CAST(k AS VARCHAR) AS detail FROM j WHERE n > 6 UNION ALL SELECT edition, 'empty', CAST(k AS VARCHAR) FROM j WHERE n = 0""")
def g6_manifest_audit(spark: SparkSession, sf: str) -> DataFrame:
    counted = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    j = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("edition")).join(counted, "o_orderkey", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return gate(broken(j.filter("n > 6"), F.col("edition"), "content_count", F.col("o_orderkey")), broken(j.filter("n = 0"), F.col("edition"), "empty", F.col("o_orderkey")))


@query("""WITH s AS (SELECT n_name AS edition, s_suppkey, s_name, s_acctbal FROM supplier JOIN nation ON s_nationkey = n_nationkey) SELECT edition, 'negative' AS rule, CAST(s_suppkey AS VARCHAR) AS detail FROM s WHERE s_acctbal < 0
UNION ALL SELECT edition, 'few_sources', CAST(count(*) AS VARCHAR) FROM s GROUP BY edition HAVING count(*) < 4 UNION ALL SELECT edition, 'no_name', CAST(s_suppkey AS VARCHAR) FROM s WHERE s_name IS NULL OR s_name = ''""")
def g7_registry_audit(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").join(table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("edition")), "s_nationkey")
    e, k = F.col("edition"), F.col("s_suppkey")
    return gate(broken(s.filter("s_acctbal < 0"), e, "negative", k), broken(s.groupBy("edition").count().filter("count < 4"), e, "few_sources", F.col("count")), broken(s.filter("s_name IS NULL OR s_name = ''"), e, "no_name", k))


@query("""WITH r AS (SELECT doc_id, lang, source, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS k FROM documents), b AS MATERIALIZED (SELECT *, k // 30 AS bundle FROM r WHERE k < 150)
SELECT lang AS edition, 'bundle_size' AS rule, CAST(bundle AS VARCHAR) AS detail FROM b GROUP BY lang, bundle HAVING count(*) <> 30 UNION ALL SELECT lang, 'publisher_share', bundle || ':' || source FROM b GROUP BY lang, bundle, source HAVING count(*) > 3""")
def g8_bundle_audit(spark: SparkSession, sf: str) -> DataFrame:
    b = first_stories(spark, sf).withColumn("bundle", F.floor((F.col("k") - 1) / 30).cast("string"))
    return gate(broken(b.groupBy("lang", "bundle").count().filter("count <> 30"), F.col("lang"), "bundle_size", F.col("bundle")), broken(b.groupBy("lang", "bundle", "source").count().filter("count > 3"), F.col("lang"), "publisher_share", F.concat_ws(":", "bundle", "source")))


TEXT_RULES = {"ellipsis": "(\\.\\.\\.|…)$", "placeholder": "(?i)lorem|todo", "repeated_mark": "!!|\\?\\?|###", "relay": "(?i)news\\.example"}


@query("SELECT * FROM (" + " UNION ALL ".join(f"SELECT lang AS edition, '{name}' AS rule, CAST(doc_id AS VARCHAR) AS detail FROM documents WHERE regexp_matches(text, '{pattern}')" for name, pattern in TEXT_RULES.items()) + ")")
def g9_text_gates(spark: SparkSession, sf: str) -> DataFrame:
    """All patterns in one pass over the texts."""
    names = F.array(*[F.when(F.col("text").rlike(p), F.lit(n)) for n, p in TEXT_RULES.items()])
    d = table(spark, sf, "documents").select("doc_id", "lang", F.explode(F.array_compact(names)).alias("rule"))
    return d.select(F.col("lang").alias("edition"), "rule", F.col("doc_id").cast("string").alias("detail"))


@query("SELECT 'source' AS kind, source AS key, count(*) AS n FROM documents GROUP BY source UNION ALL SELECT 'lang', lang, count(*) FROM documents GROUP BY lang")
def a7_selection_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Two grouping sets of one scan."""
    each = F.explode(F.array(F.struct(F.lit("source").alias("kind"), F.col("source").alias("key")), F.struct(F.lit("lang").alias("kind"), F.col("lang").alias("key"))))
    return table(spark, sf, "documents").select(each.alias("x")).groupBy("x.kind", "x.key").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {CAND} SELECT count(*) AS articles, count(DISTINCT chapter) AS chapters, count(DISTINCT source) AS sources, count(*) FILTER (length(summary) = 0) AS without_summary FROM c")
def a9_content_counts(spark: SparkSession, sf: str) -> DataFrame:
    return candidates(spark, sf).agg(F.count(F.lit(1)).alias("articles"), F.count_distinct("chapter").alias("chapters"), F.count_distinct("source").alias("sources"), F.count_if(F.length("summary") == 0).alias("without_summary"))


def ordered_digest(df: DataFrame, edition: str, pos: str, line: Column) -> DataFrame:
    """edition, fingerprint: sha-256 of the lines in order, one to a row. For an edition's selection, which is bounded."""
    rows = df.select(edition, F.struct(F.col(pos).alias("pos"), line.alias("line")).alias("x")).groupBy(edition).agg(F.sort_array(F.collect_list("x")).alias("xs"))
    return rows.select(edition, F.sha2(F.array_join(F.transform("xs", lambda x: x.line), "\n"), 256).alias("fingerprint"))


TOP = f"{CAND}, s AS (SELECT chapter AS edition, seq, title, source, row_number() OVER (PARTITION BY chapter ORDER BY CAST({IMPORTANCE} AS DOUBLE) DESC, seq) AS k FROM c), top AS (SELECT * FROM s WHERE k <= 10)"


def _top(spark: SparkSession, sf: str) -> DataFrame:
    s = _scored(spark, sf).select(F.col("chapter").alias("edition"), "seq", "title", "source", "score")
    return s.withColumn("k", F.row_number().over(Window.partitionBy("edition").orderBy(F.desc("score"), "seq"))).filter("k <= 10")


@query(f"WITH {TOP} SELECT edition, sha256(string_agg(seq || '|' || substr(title, 1, 40) || '|' || source, chr(10) ORDER BY k)) AS fingerprint FROM top GROUP BY edition")
def h2_editorial_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return ordered_digest(_top(spark, sf), "edition", "k", F.concat_ws("|", F.col("seq").cast("string"), F.substring("title", 1, 40), "source"))


@query(f"""WITH {TOP} SELECT edition, sha256('{{"articles":[' || string_agg('{{"id":' || seq || ',"rank":' || k || ',"source":"' || source || '"}}', ',' ORDER BY k) || ']}}') AS digest FROM top GROUP BY edition""")
def h3_document_digest(spark: SparkSession, sf: str) -> DataFrame:
    """Of the canonical JSON: fields in the order of their names, no white space."""
    article = F.struct(F.col("k").alias("pos"), F.struct(F.col("seq").alias("id"), F.col("k").alias("rank"), "source").alias("x"))
    rows = _top(spark, sf).groupBy("edition").agg(F.transform(F.sort_array(F.collect_list(article)), lambda a: a.x).alias("articles"))
    return rows.select("edition", F.sha2(F.to_json(F.struct("articles")), 256).alias("digest"))


@query(f"WITH {TOP} SELECT edition, sha256('2024-01-30::' || count(*) || '::' || string_agg(seq, ',' ORDER BY k)) AS integrity FROM top GROUP BY edition")
def h4_integrity_hash(spark: SparkSession, sf: str) -> DataFrame:
    rows = _top(spark, sf).groupBy("edition").agg(F.count(F.lit(1)).cast("string").alias("n"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "seq"))), lambda x: x.seq.cast("string")), ",").alias("ids"))
    return rows.select("edition", F.sha2(F.concat_ws("::", F.lit("2024-01-30"), "n", "ids"), 256).alias("integrity"))


@query(f"WITH {CAND} SELECT 'documents' AS provider, seq AS id, title, NULL::VARCHAR AS url FROM c UNION ALL SELECT 'pages', page_id, regexp_extract(html, '<title>([^<]*)</title>', 1), url FROM pages")
def u1_provider_union(spark: SparkSession, sf: str) -> DataFrame:
    d = candidates(spark, sf).select(F.lit("documents").alias("provider"), F.col("seq").alias("id"), "title")
    p = table(spark, sf, "pages").select(F.lit("pages").alias("provider"), F.col("page_id").alias("id"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), "url")
    return d.unionByName(p, allowMissingColumns=True)


@query("SELECT 'only_labels' AS side, doc_id FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents WHERE lang = 'en') UNION ALL SELECT 'both', doc_id FROM (SELECT doc_id FROM labels INTERSECT SELECT doc_id FROM documents WHERE lang = 'en')")
def u2_difference_intersection(spark: SparkSession, sf: str) -> DataFrame:
    a, b = table(spark, sf, "labels").select("doc_id"), table(spark, sf, "documents").filter("lang = 'en'").select("doc_id")
    return a.subtract(b).select(F.lit("only_labels").alias("side"), "doc_id").unionByName(a.intersect(b).select(F.lit("both").alias("side"), "doc_id"))


@query(f"WITH p AS (SELECT page_id, {KEY} AS key, {HOST} AS domain, row_number() OVER (PARTITION BY {HOST} ORDER BY page_id) AS n FROM pages) SELECT page_id, domain, 'priority-' || lpad(CAST(n AS VARCHAR), 4, '0') AS staging_id, 'PENDING' AS editorial_status, key FROM p")
def p17_staging_records(spark: SparkSession, sf: str) -> DataFrame:
    from gazette.plans.editions import placed

    p = table(spark, sf, "pages").select("page_id", urls.canonical_key(F.col("url")).alias("key"), urls.domain(F.col("url")).alias("domain"))
    p = placed(p, "domain", [F.col("page_id")], "n")
    return p.select("page_id", "domain", F.concat(F.lit("priority-"), F.lpad(F.col("n").cast("string"), 4, "0")).alias("staging_id"), F.lit("PENDING").alias("editorial_status"), "key")
