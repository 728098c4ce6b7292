"""Whole editions made of the driver's documents, and the gates on them. The tests change a valid edition in each way that a rule names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette.operators import gates
from gazette.plans.catalogue import CAND, query
from gazette.sources.tables import candidates, table


def seq() -> Column:
    return F.col("seq")


CONTRACT = gates.Contract(chapters=20, place="town")


def editions(spark: SparkSession, sf: str) -> DataFrame:
    """An edition for each language, a chapter for each publisher, its first ten documents; what an article lacks follows from its id."""
    c = candidates(spark, sf).select(F.col("chapter").alias("edition"), "source", "seq", "link", "title")
    c = c.withColumn("k", F.row_number().over(Window.partitionBy("edition", "source").orderBy("seq"))).filter("k <= 10")
    none = lambda kind: F.lit(None).cast(kind)
    nth = lambda names: F.element_at(F.array(*[F.lit(n) for n in names]), (seq() % len(names) + 1).cast("int"))
    texts = F.struct(F.col("title").alias("fact"), F.concat(F.lit("Reported by "), "source").alias("background"), F.col("title").alias("why_it_matters"), F.array(F.lit("a"), F.lit("b")).alias("checkpoints"))
    check = F.struct(nth([*CONTRACT.statuses, "SURE"]).alias("status"), nth([*CONTRACT.bodies, "HTTP_500"]).alias("body_status"))
    image = F.struct(F.when(seq() % 2 == 0, "EXPLICIT_NULL").otherwise("VERIFIED_PROVENANCE").alias("status"), F.when(seq() % 2 == 1, "link").alias("url"), F.when(seq() % 2 == 1, (seq() % 97).cast("string")).alias("content_hash"), F.lit("og").alias("declaration_method"), F.lit("x").alias("source_domain"), F.lit("y").alias("article_domain"))
    fields = gates.ARTICLE
    article = F.struct(seq().cast("string").alias("id"), "link", "title", texts.alias("editorial"), check.alias("fact_check"), image.alias("image"), none(fields[fields.rindex("research:") + 9 : -1]).alias("research"))
    chapters = c.groupBy("edition", "source").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", article.alias("a")))), lambda x: x.a).alias("articles"))
    chapter = F.struct(F.col("source").alias("id"), F.col("source").alias("name"), "articles")
    e = chapters.groupBy("edition").agg(F.sort_array(F.collect_list(chapter)).alias("chapters"))
    top = F.slice(F.transform("chapters", lambda c: F.struct(c.articles[0].id.alias("id"), c.articles[0].link.alias("link"), c.articles[0].title.alias("title"), c.id.alias("chapter_id"))), 1, 5)
    weather = F.struct(F.lit("town").alias("location"), *[F.lit(1.0).alias(n) for n in ("temp_current", "temp_min", "temp_max")], F.lit("clear").alias("condition"), F.lit(0.0).alias("precipitation_prob"), F.lit("s").alias("source"))
    words = F.array(F.lit("a"), F.lit("b"), F.lit("c"))
    return e.select(
        "edition", F.lit("1.1.0").alias("version"), F.lit("2024-01-30").alias("date"), F.lit(CONTRACT.trends_withheld).alias("trends_source"), F.array().cast("array<string>").alias("story_files"), "chapters", top.alias("top5"), weather.alias("weather"),
        F.create_map(F.lit("kospi"), F.lit("1"), F.lit("usd_krw"), F.lit("2")).alias("market"), words.alias("next_signals"), F.array().cast("array<string>").alias("trends"), words.alias("lines"),
        F.transform(F.sequence(F.lit(1), F.lit(12)), lambda n: F.struct(F.concat(F.lit("https://v.example/"), n.cast("string")).alias("url"), (n % 5).cast("string").alias("channel"))).alias("videos"),
        F.sha2("edition", 256).alias("integrity_hash"), F.lit("").alias("manifest_fingerprint"),
    )


def stories(spark: SparkSession, sf: str) -> DataFrame:
    a = gates.articles_of(editions(spark, sf), CONTRACT).select("edition", F.col("a.id").cast("long").alias("id"), F.col("a.link").alias("url"), F.col("a.title").alias("title"))
    k = F.row_number().over(Window.partitionBy("edition").orderBy("id")) - 1  # an edition has 200 articles at most
    return a.withColumn("k", k).filter("k < 150").select("edition", F.floor(F.col("k") / 30).cast("int").alias("bundle"), "url", "title", F.when(F.col("id") % 9 != 0, "today").alias("freshness_note"))


@query()
def g1_edition_rules(spark: SparkSession, sf: str) -> DataFrame:
    return gates.edition_faults(editions(spark, sf), CONTRACT)


@query()
def f12_nested_placeholders(spark: SparkSession, sf: str) -> DataFrame:
    """Every text of every edition; the word looked for is a common one of the driver's prose."""
    return gates.leaf_faults(editions(spark, sf), r"(^|[^\p{L}])the([^\p{L}]|$)")


@query()
def g5_release_rules(spark: SparkSession, sf: str) -> DataFrame:
    e = editions(spark, sf)
    counts = F.create_map(F.lit("total_chapters"), F.size("chapters"), F.lit("total_articles"), F.lit(200), F.lit("top5"), F.lit(5), F.lit("summary_lines"), F.lit(3), F.lit("youtube"), F.size("videos"), F.lit("trends"), F.lit(0))
    m = e.join(gates.production_fingerprint(e), "edition").select("edition", F.col("date").alias("edition_date"), F.lit("Asia/Seoul").alias("timezone"), F.repeat(F.lit("a"), F.lit(40)).alias("source_sha"), F.lit("CANONICAL_PASS").alias("canonical_status"), F.col("fingerprint").alias("production_fingerprint"), counts.alias("counts"), F.lit("").alias("manifest_sha256"))
    return gates.contract_faults(e, stories(spark, sf), m, CONTRACT)


def _rows(rows: str, rule: str, detail: str) -> str:
    return f"SELECT edition, '{rule}' AS rule, CAST({detail} AS VARCHAR) AS detail FROM {rows}"


BUNDLES = f"""{CAND}, a AS (SELECT * FROM (SELECT chapter AS edition, seq AS id, link AS url, title, row_number() OVER (PARTITION BY chapter, source ORDER BY seq) AS r FROM c) WHERE r <= 10),
s AS (SELECT *, k // 30 AS bundle FROM (SELECT *, row_number() OVER (PARTITION BY edition ORDER BY id) - 1 AS k FROM a) WHERE k < 150), z AS (SELECT edition, bundle, count(*) AS n FROM s GROUP BY ALL)"""


@query(f"WITH {BUNDLES} " + " UNION ALL ".join([
    _rows("z WHERE n <> 30", "bundle_size", "bundle || ':' || n"), _rows("(SELECT edition, count(*) AS n FROM z GROUP BY edition) WHERE n <> 5", "bundles", "n"), _rows("(SELECT edition, url FROM s GROUP BY ALL HAVING count(*) > 1)", "duplicate_story_url", "url"),
    _rows("(SELECT edition, url FROM a GROUP BY ALL HAVING count(*) > 1)", "duplicate_article_url", "url"), _rows("(SELECT DISTINCT edition, url FROM a EXCEPT SELECT edition, url FROM s)", "article_without_story", "url"),
    _rows("s WHERE NOT regexp_matches(url, '^https?://[^/?#]+')", "story_url", "url"), _rows("s WHERE id % 9 = 0", "freshness_note", "title"),
]))
def g8_bundle_rules(spark: SparkSession, sf: str) -> DataFrame:
    return gates.bundle_faults(editions(spark, sf), stories(spark, sf), CONTRACT)


REGISTRY = """s AS (SELECT n_name AS edition, CAST(s_suppkey AS VARCHAR) AS id, s_suppkey AS k, s_name AS name, 's' || s_suppkey % 400 || '.example.com' AS domain, s_suppkey % 6 AS tier, CASE s_suppkey % 3 WHEN 0 THEN ['api'] WHEN 1 THEN ['rss', 'web'] ELSE ['ftp'] END AS access FROM supplier JOIN nation ON s_nationkey = n_nationkey),
g AS (SELECT DISTINCT edition FROM s), ac AS (SELECT edition, unnest(access) AS v FROM s)"""


@query(f"WITH {REGISTRY} " + " UNION ALL ".join([
    _rows("s WHERE tier > 4", "tier", "id"), _rows("s WHERE k % 7 = 0", "missing_topics", "id"), _rows("s WHERE list_contains(access, 'ftp')", "access_mode", "id"), _rows("s WHERE coalesce(name, '') = ''", "missing_name", "id"), _rows("(SELECT edition, id FROM s GROUP BY ALL HAVING count(*) > 1)", "duplicate_id", "id"),
    _rows("(SELECT edition, domain FROM s GROUP BY ALL HAVING count(DISTINCT id) > 1)", "domain_owned_twice", "domain"), _rows("(SELECT edition, v, (SELECT count(*) FROM s WHERE s.edition = g.edition AND s.tier = v) AS n FROM g, (VALUES (0), (1), (2)) w(v)) WHERE n < 1", "few_of_tier", "v"),
    _rows("(SELECT edition, v, least_, (SELECT count(*) FROM ac WHERE ac.edition = g.edition AND ac.v = w.v) AS n FROM g, (VALUES ('api', 1), ('rss', 2)) w(v, least_)) WHERE n < least_", "few_of_access", "v"),
    _rows("(SELECT edition, v FROM g, (VALUES ('1'), ('2')) w(v) WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.edition = g.edition AND s.id = v))", "missing_critical", "v"),
]))
def g7_registry_rules(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("registry"))
    s, k = table(spark, sf, "supplier").join(n, "s_nationkey"), F.col("s_suppkey")
    words = lambda *xs: F.array(*[F.lit(x) for x in xs])
    rows = s.select(
        "registry", k.cast("string").alias("id"), F.col("s_name").alias("name"), F.array(F.concat(F.lit("s"), (k % 400).cast("string"), F.lit(".example.com"))).alias("domains"), (k % 6).cast("int").alias("tier"),
        F.when(k % 3 == 0, words("api")).when(k % 3 == 1, words("rss", "web")).otherwise(words("ftp")).alias("access"), words("news").alias("roles"), F.when(k % 7 != 0, words("all")).otherwise(F.array().cast("array<string>")).alias("topics"),
    )
    return gates.registry_faults(rows, {0: 1, 1: 1, 2: 1}, {"api": 1, "rss": 2}, ["1", "2"])


def placed(df: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """``df`` with each row's place (from 1) in its group: ranges of the whole order, a rank in each, and the rows of the group in the ranges before. No group is one task."""
    from gazette.functions.lineage import settle

    parts = settle(df.repartitionByRange(F.col(group), *order).withColumn("__part", F.spark_partition_id()))  # ranges may be drawn anew when they are computed again
    sizes = parts.groupBy(group, "__part").count()
    before = F.coalesce(F.sum("count").over(Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(F.col(group).alias("__g"), F.col("__part").alias("__p"), before.alias("__before"))  # a row for each group and range
    rank = F.row_number().over(Window.partitionBy("__part", group).orderBy(*order))
    met = parts.withColumn("__rank", rank).join(sizes, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__part") == F.col("__p")))
    return met.withColumn(name, (F.col("__rank") + F.col("__before")).cast("int")).drop("__part", "__rank", "__g", "__p", "__before")
