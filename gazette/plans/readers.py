"""Readers of feeds and provider records, sinks, and streaming intake. The records are rendered from the given tables by Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette.plans.catalogue import CAND, _clean_sql, query
from gazette.sources import feeds
from gazette.sources.tables import candidates, table
from gazette.streaming import intake


def xml_text(c: Column) -> Column:
    """A text as character data of XML."""
    out = F.regexp_replace(c, "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]", "")
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


def feed(spark: SparkSession, sf: str) -> DataFrame:
    """source, seq, xml: each document as an item of its source's feed."""
    c = candidates(spark, sf).withColumn("head", F.concat("title", F.lit(" - "), "source"))
    tag = lambda name, value: F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))
    body = F.col("summary")
    return c.select("source", "seq", tag("item", F.concat(tag("title", xml_text(F.col("head"))), tag("link", F.col("link")), tag("pubDate", F.lit("Mon, 08 Jan 2024 10:00:00 GMT")), tag("description", xml_text(body)))).alias("xml"))


@query(f"WITH {CAND}, r AS (SELECT seq, source, link, row_number() OVER (PARTITION BY source ORDER BY seq) AS k FROM c) SELECT source, seq, link, TIMESTAMP '2024-01-08 10:00:00' AS published FROM r WHERE k <= 20")
def s1_feed_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.entries(feed(spark, sf), 20).select("source", "seq", F.col("url").alias("link"), F.col("published_at").alias("published"))


RULES = feeds.Headlines(blacklist=("###", "$$$"), bait=("[xX]{3}",), marks=(("!", 2), ("?", 2)))


@query(f"""WITH {CAND}, r AS (SELECT seq, source, {_clean_sql(_clean_sql("title"))} AS head FROM c WHERE source NOT LIKE '% - %') SELECT seq, source AS publisher FROM r WHERE length(head) BETWEEN 10 AND 120 AND NOT contains(head, '###') AND NOT contains(head, '$$$') AND NOT regexp_matches(head, '[xX]{{3}}')
AND length(head) - length(replace(head, '!', '')) <= 2 AND length(head) - length(replace(head, '?', '')) <= 2""")
def s2_rss_entries(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.news_entries(feed(spark, sf), RULES).select("seq", "publisher")


PROVIDER = "pmid string, doi string, title string, authorString string, date array<int>"


def provider_records(spark: SparkSession, sf: str) -> DataFrame:
    """seq, json: documents as records of a research provider."""
    s = F.col("seq")
    people = F.array_join(F.transform(F.sequence(F.lit(0), (s % 15).cast("int")), lambda k: F.concat(F.lit("Author "), k.cast("string"))), ", ")
    record = F.struct(F.when(s % 2 == 0, s.cast("string")).alias("pmid"), F.when(s % 3 == 0, F.concat(F.lit("https://doi.org/10.1000/X"), s.cast("string"))).alias("doi"), "title", people.alias("authorString"), F.array(F.lit(2024), (s % 12 + 1).cast("int")).alias("date"))
    return candidates(spark, sf).select("seq", F.to_json(record).alias("json"))


@query(f"""WITH {CAND} SELECT seq, CASE WHEN seq % 2 = 0 THEN 'https://pubmed.example.org/' || seq WHEN seq % 3 = 0 THEN 'https://doi.org/10.1000/x' || seq ELSE 'https://provider.example.org/' END AS url, CASE WHEN seq % 3 = 0 THEN '10.1000/x' || seq END AS doi,
CAST(least(seq % 15 + 1, 12) AS INTEGER) AS authors, '2024-' || lpad(CAST(seq % 12 + 1 AS VARCHAR), 2, '0') AS publication_date FROM c""")
def s8_provider_records(spark: SparkSession, sf: str) -> DataFrame:
    r = provider_records(spark, sf).select("seq", F.from_json("json", PROVIDER).alias("r"))
    doi = F.regexp_replace(F.lower("r.doi"), r"^(https?://(dx\.)?doi\.org/|doi:\s*)", "")
    url = F.coalesce(F.concat(F.lit("https://pubmed.example.org/"), F.col("r.pmid")), F.concat(F.lit("https://doi.org/"), doi), F.lit("https://provider.example.org/"))
    date = F.array_join(F.transform("r.date", lambda p: F.when(p < 10, F.concat(F.lit("0"), p.cast("string"))).otherwise(p.cast("string"))), "-")
    return r.select("seq", url.alias("url"), doi.alias("doi"), F.size(F.slice(F.split("r.authorString", ", "), 1, 12)).alias("authors"), date.alias("publication_date"))


@query("""WITH v AS (SELECT event_id, event_type AS channel, ts, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id) AS k FROM events WHERE event_id % 13 <> 0)
SELECT event_id, channel, 'https://img.example.com/' || event_id || CASE event_id % 3 WHEN 0 THEN '/high.jpg' WHEN 1 THEN '/medium.jpg' ELSE '/default.jpg' END AS thumbnail FROM v WHERE k <= 15""")
def s9_video_records(spark: SparkSession, sf: str) -> DataFrame:
    """Playlist items as JSON; private ones (here: ids that 13 divides) and those without an id are dropped; 15 of each channel and user."""
    k = F.col("event_id")
    thumb = lambda name, cond: F.when(cond, F.concat(F.lit("https://img.example.com/"), k.cast("string"), F.lit(f"/{name}.jpg"))).alias(name)
    record = F.struct(k.alias("id"), F.when(k % 13 == 0, "Private video").otherwise("clip").alias("title"), F.struct(thumb("high", k % 3 == 0), thumb("medium", k % 3 != 2), thumb("default", F.lit(True))).alias("thumbnails"))
    raw = table(spark, sf, "events").select("event_type", "user_id", "ts", F.to_json(record).alias("json"))
    r = raw.select("event_type", "user_id", "ts", F.from_json("json", "id long, title string, thumbnails struct<high:string,medium:string,default:string>").alias("r")).filter("r.id IS NOT NULL AND r.title NOT IN ('Private video', 'Deleted video')")
    r = r.withColumn("k", F.row_number().over(Window.partitionBy("event_type", "user_id").orderBy(F.desc("ts"), "r.id"))).filter("k <= 15")
    return r.select(F.col("r.id").alias("event_id"), F.col("event_type").alias("channel"), F.coalesce("r.thumbnails.high", "r.thumbnails.medium", "r.thumbnails.default").alias("thumbnail"))


@query("""WITH g AS (SELECT event_type AS edition, 'User ' || user_id % 60 AS term, event_id FROM events), k AS (SELECT edition, lower(term) AS key, min(event_id) AS first FROM g GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY edition ORDER BY first) AS rank, count(*) OVER (PARTITION BY edition) AS n FROM k)
SELECT edition, key, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 20 AND n >= 20""")
def s10_trends_top20(spark: SparkSession, sf: str) -> DataFrame:
    """The first 20 terms of each edition, or none."""
    g = table(spark, sf, "events").select(F.col("event_type").alias("edition"), F.lower(F.concat(F.lit("User "), (F.col("user_id") % 60).cast("string"))).alias("key"), "event_id")
    k = g.groupBy("edition", "key").agg(F.min("event_id").alias("first"))
    r = k.withColumn("rank", F.row_number().over(Window.partitionBy("edition").orderBy("first"))).filter("rank <= 20")
    full = r.filter("rank = 20").select("edition")
    return r.join(full, "edition", "left_semi").select("edition", "key", "rank")


@query("""WITH w AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type, count(*) AS attempts, count(*) FILTER (value >= 10) AS good FROM events WHERE ts IS NOT NULL GROUP BY ALL)
SELECT *, CASE WHEN good = attempts THEN 'HEALTHY' WHEN good > 0 THEN 'DEGRADED' ELSE 'UNAVAILABLE' END AS health FROM w WHERE window_start < (SELECT time_bucket(INTERVAL 1 DAY, max(ts)) FROM events)""")
def st2_rolling_health(spark: SparkSession, sf: str) -> DataFrame:
    """Closed days only: the last day of the stream is still open."""
    e = intake.arrivals(spark, sf, "events").filter("ts IS NOT NULL").withColumn("ts", F.col("ts").cast("timestamp"))
    return intake.drained(intake.health(e, "event_type", "ts", "value >= 10", "1 day", "0 seconds"))
