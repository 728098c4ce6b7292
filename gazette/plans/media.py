"""Pictures by their bytes, cached videos, trending words: queries over the driver's tables and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.operators import trends
from gazette.plans.catalogue import CAND, TOKENS, query
from gazette.sources import pictures, videos
from gazette.sources.tables import candidates, fetch_log, table
from gazette.streaming import intake

_STATUS = "CASE WHEN page_id % 11 = 0 THEN 404 WHEN page_id % 13 = 0 THEN 500 WHEN page_id % 7 = 2 THEN 206 ELSE 200 END"
_TYPE = "CASE page_id % 6 WHEN 0 THEN 'image/png' WHEN 1 THEN 'Image/JPEG; q=1' WHEN 2 THEN 'image/svg+xml' WHEN 3 THEN 'text/html' ELSE 'image/webp' END"


@query(f"""WITH p AS (SELECT page_id, {_STATUS} AS http_status, lower(split_part({_TYPE}, ';', 1)) AS said, page_id % 19 = 5 AS failed,
CASE page_id % 6 WHEN 0 THEN '89504E470D0A1A0A' WHEN 1 THEN 'FFD8FFE0' WHEN 4 THEN hex('<svg xmlns="x">') ELSE hex('GIF') END || CASE WHEN page_id % 17 = 3 THEN '' ELSE hex(coalesce(html, '')) END AS bytes FROM pages),
s AS (SELECT *, CASE WHEN failed THEN 'TIMEOUT' WHEN http_status NOT IN (200, 206) THEN 'HTTP_' || http_status WHEN said NOT LIKE 'image/%' OR said = 'image/svg+xml' THEN 'NON_RASTER_IMAGE' WHEN page_id % 6 = 4 THEN 'NON_RASTER_IMAGE'
WHEN length(bytes) // 2 < 1024 THEN 'TOO_SMALL' WHEN page_id % 6 NOT IN (0, 1) THEN 'TYPE_MISMATCH' ELSE 'VERIFIED' END AS status FROM p)
SELECT page_id, status, CASE WHEN status = 'VERIFIED' THEN CASE page_id % 6 WHEN 0 THEN 'image/png' ELSE 'image/jpeg' END END AS image_type, CASE WHEN status = 'VERIFIED' THEN sha256(from_hex(left(bytes, 192000))) END AS content_hash FROM s""")
def e6_raster_images(spark: SparkSession, sf: str) -> DataFrame:
    """Pictures rendered from pages: first bytes of a kind, then the page's own; some fetches failed, some kinds are not what was declared."""
    k = F.col("page_id")
    head = F.unhex(F.when(k % 6 == 0, "89504E470D0A1A0A").when(k % 6 == 1, "FFD8FFE0").when(k % 6 == 4, F.hex(F.lit('<svg xmlns="x">'))).otherwise(F.hex(F.lit("GIF"))))
    body = F.when(k % 17 == 3, "").otherwise(F.coalesce("html", F.lit("")))
    status = F.when(k % 11 == 0, 404).when(k % 13 == 0, 500).when(k % 7 == 2, 206).otherwise(200)
    said = F.when(k % 6 == 0, "image/png").when(k % 6 == 1, "Image/JPEG; q=1").when(k % 6 == 2, "image/svg+xml").when(k % 6 == 3, "text/html").otherwise("image/webp")
    log = fetch_log(spark, sf).select("page_id", "url", F.col("url").alias("final_url"), status.alias("http_status"), said.alias("content_type"), F.when(k % 19 == 5, "TIMEOUT").alias("error_class"), F.concat(head, F.encode(body, "UTF-8")).alias("head"))
    return pictures.verified(log).select("page_id", F.col("image_status").alias("status"), "image_type", F.col("image_hash").alias("content_hash"))


@query("""WITH v AS (SELECT event_id, 'ch' || user_id % 40 AS source_id, 'Channel ' || CASE WHEN event_id % 9 = 4 THEN (user_id + 1) % 40 ELSE user_id % 40 END AS channel, event_type || '_' || event_id AS id, event_id % 8 = 3 AS moved,
CASE WHEN event_id % 23 = 6 THEN NULL WHEN event_id % 7 = 3 THEN date_trunc('day', ts) ELSE date_trunc('second', ts) END AS moment FROM events),
c AS (SELECT *, (epoch(TIMESTAMP '2024-01-25 00:00:00') - epoch(moment)) / 86400.0 AS age FROM v), p AS (SELECT 'ch' || n_nationkey AS source_id, 'Channel ' || n_nationkey AS channel, n_regionkey AS tier FROM nation WHERE n_nationkey < 10)
SELECT event_id, p.tier AS source_tier, round(age, 6) AS age, 'cached_verified' AS retrieval_mode FROM c JOIN p USING (source_id, channel) WHERE regexp_full_match(id, '[A-Za-z0-9_-]{6,}') AND NOT moved AND age BETWEEN -0.25 AND 7""")
def s11_cached_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Events as an earlier edition's videos, stored by channel; a policy of ten channels decides at run time which folders are read."""
    folder, k, u = intake.shared_folder(spark), F.col("event_id"), F.col("user_id")
    id_ = F.concat_ws("_", "event_type", "event_id")
    ts = F.col("ts").cast("timestamp")
    said = F.when(k % 23 == 6, None).when(k % 7 == 3, F.date_format(ts, "yyyy-MM-dd")).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    name = lambda n: F.concat(F.lit("Channel "), n.cast("string"))
    e = table(spark, sf, "events").select(
        "event_id", F.concat(F.lit("ch"), (u % 40).cast("string")).alias("source_id"), name(F.when(k % 9 == 4, (u + 1) % 40).otherwise(u % 40)).alias("channel"), id_.alias("id"),
        F.concat(F.when(k % 8 == 3, "https://moved.example/").otherwise(videos.WATCH % ""), id_).alias("video_url"), said.alias("published_at"),
    )
    e.write.partitionBy("source_id").parquet(folder)
    n = F.col("n_nationkey")
    policy = table(spark, sf, "nation").filter(n < 10).select(F.concat(F.lit("ch"), n.cast("string")).alias("id"), name(n).alias("name"), F.col("n_regionkey").alias("tier"))
    got = videos.cached(spark.read.parquet(folder), policy, F.lit("2024-01-25 00:00:00 UTC").cast("timestamp"), 7)
    return got.select("event_id", "source_tier", F.round("age", 6).alias("age"), "retrieval_mode")


_RAW = TOKENS.removeprefix("list_distinct(").removesuffix(")")


@query(f"""WITH {CAND}, r AS (SELECT seq, chapter, {_RAW.format('title')} AS raw FROM c), t AS (SELECT seq, chapter, raw, unnest(list_distinct(raw)) AS token FROM r), w AS (SELECT *, list_position(raw, token) AS pos FROM t),
f AS (SELECT token, count(*) AS n, min((seq, pos)) AS first, arg_max(chapter, seq) AS category FROM w GROUP BY token), g AS (SELECT *, row_number() OVER (ORDER BY n DESC, first) AS rank FROM f)
SELECT token AS word, n, category, CAST(rank AS INTEGER) AS rank FROM g WHERE rank <= 20""")
def a5_trending(spark: SparkSession, sf: str) -> DataFrame:
    words = F.array_distinct(F.regexp_extract_all(F.lower("title"), F.lit("([가-힣a-z0-9]{2,})"), F.lit(1)))
    rows = candidates(spark, sf).select("seq", F.col("chapter").alias("category"), F.posexplode(words).alias("pos", "word"))
    return trends.trending(rows).select("word", "n", "category", "rank")
