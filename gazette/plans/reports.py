"""Reports and choices with more than one kind of row: provider health by mode, registry gaps, live and cached videos, weather in words, late news."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette.functions import urls
from gazette.plans.catalogue import HOST, query
from gazette.sources.tables import table


def provider_health(attempts: DataFrame) -> DataFrame:
    """source, attempts, api_ok, fallback_ok, failures, health: of attempts (source, mode api or fallback, error, null if it went well).

    HEALTHY if all went well by the api, UNAVAILABLE if none did in any way, else DEGRADED. failures are the classes met.
    """
    ok = F.col("error").isNull()
    g = attempts.groupBy("source").agg(
        F.count(F.lit(1)).alias("attempts"), F.count_if(ok & (F.col("mode") == "api")).alias("api_ok"), F.count_if(ok & (F.col("mode") == "fallback")).alias("fallback_ok"), F.array_join(F.sort_array(F.collect_set("error")), ",").alias("failures"),
    )
    return g.withColumn("health", F.when(F.col("api_ok") == F.col("attempts"), "HEALTHY").when(F.col("api_ok") + F.col("fallback_ok") == 0, "UNAVAILABLE").otherwise("DEGRADED"))


@query("""WITH a AS (SELECT 'p' || user_id % 200 AS source, CASE WHEN event_id % 3 = 0 THEN 'fallback' ELSE 'api' END AS mode, CASE WHEN value < 10 OR user_id % 200 = 7 THEN CASE event_id % 2 WHEN 0 THEN 'TIMEOUT' ELSE 'HTTP_503' END END AS error FROM events),
g AS (SELECT source, count(*) AS attempts, count(*) FILTER (error IS NULL AND mode = 'api') AS api_ok, count(*) FILTER (error IS NULL AND mode = 'fallback') AS fallback_ok, coalesce(string_agg(DISTINCT error, ',' ORDER BY error), '') AS failures FROM a GROUP BY source)
SELECT *, CASE WHEN api_ok = attempts THEN 'HEALTHY' WHEN api_ok + fallback_ok = 0 THEN 'UNAVAILABLE' ELSE 'DEGRADED' END AS health FROM g""")
def e5_provider_health(spark: SparkSession, sf: str) -> DataFrame:
    e, who = table(spark, sf, "events"), F.col("user_id") % 200
    error = F.when((F.col("value") < 10) | (who == 7), F.when(F.col("event_id") % 2 == 0, "TIMEOUT").otherwise("HTTP_503"))
    return provider_health(e.select(F.concat(F.lit("p"), who.cast("string")).alias("source"), F.when(F.col("event_id") % 3 == 0, "fallback").otherwise("api").alias("mode"), error.alias("error")))


def registry_gaps(preferred: DataFrame, discovery: DataFrame, registered: DataFrame) -> DataFrame:
    """side, domain: preferred domains that are not registered (missing), and discovery domains that are not (unregistered_discovery)."""
    gap = lambda df, side: df.select("domain").distinct().join(registered.select("domain"), "domain", "left_anti").select(F.lit(side).alias("side"), "domain")
    return gap(preferred, "missing").unionByName(gap(discovery, "unregistered_discovery"))


@query(f"""WITH p AS (SELECT DISTINCT {HOST} AS domain FROM pages WHERE {HOST} IS NOT NULL), g AS (SELECT DISTINCT 'src' || s_suppkey % 20 || '.example.com' AS domain FROM supplier), d AS (SELECT DISTINCT 'src' || doc_id % 30 || '.example.com' AS domain FROM documents)
SELECT 'missing' AS side, domain FROM p WHERE domain NOT IN (SELECT domain FROM g) UNION ALL SELECT 'unregistered_discovery', domain FROM d WHERE domain NOT IN (SELECT domain FROM g)""")
def j7_registry_gaps(spark: SparkSession, sf: str) -> DataFrame:
    site = lambda k, n: F.concat(F.lit("src"), (F.col(k) % n).cast("string"), F.lit(".example.com")).alias("domain")
    preferred = table(spark, sf, "pages").select(urls.domain(F.col("url")).alias("domain")).filter("domain IS NOT NULL")
    return registry_gaps(preferred, table(spark, sf, "documents").select(site("doc_id", 30)), table(spark, sf, "supplier").select(site("s_suppkey", 20)).distinct())


def live_then_cached(videos: DataFrame, group: list[str], channel: str, video: str, cap: int, target: int, order: list[Column]) -> DataFrame:
    """``target`` videos of each group, ``cap`` of a channel, live ones (``live``) first, cached ones only for the places left; ``rank`` is their turn. Of a video that is both, the live row counts."""
    first = [F.col("live").desc(), *order]
    one = videos.withColumn("__n", F.row_number().over(Window.partitionBy(*group, video).orderBy(*first))).filter("__n = 1").drop("__n")
    few = one.withColumn("__r", F.row_number().over(Window.partitionBy(*group, channel).orderBy(*first))).filter(F.col("__r") <= cap).drop("__r")
    return few.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*first))).filter(F.col("rank") <= target)


@query("""WITH v AS (SELECT user_id, event_type, event_id % 500 AS video, event_id, ts, event_id % 3 <> 0 AS live FROM events), a AS (SELECT *, row_number() OVER (PARTITION BY user_id, video ORDER BY live DESC, ts DESC, event_id) AS n FROM v),
b AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY live DESC, ts DESC, event_id) AS r FROM a WHERE n = 1), c AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY live DESC, ts DESC, event_id) AS rank FROM b WHERE r <= 3)
SELECT user_id, event_id, live, CAST(rank AS INTEGER) AS rank FROM c WHERE rank <= 10""")
def w8_live_then_cached(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    v = table(spark, sf, "events").select("user_id", "event_type", (k % 500).alias("video"), "event_id", "ts", (k % 3 != 0).alias("live"))
    return live_then_cached(v, ["user_id"], "event_type", "video", 3, 10, [F.desc("ts"), F.asc("event_id")]).select("user_id", "event_id", "live", "rank")


#: Weather codes of observations, and what they are called; unknown ones are clear.
WEATHER = {
    0: "clear", 1: "mostly clear", 2: "some clouds", 3: "overcast", 45: "fog", 48: "rime fog", 51: "drizzle", 53: "light rain", 55: "rain", 61: "weak rain", 63: "rain", 65: "heavy rain", 71: "light snow", 73: "snow", 75: "heavy snow",
    80: "weak showers", 81: "showers", 82: "heavy showers", 95: "thunderstorm",
}


def weather_label(code: Column, labels: dict[int, str] | None = None) -> Column:
    """What a weather code is called; unknown and null ones as code 0."""
    labels = labels or WEATHER
    names = F.create_map(*[F.lit(x) for p in labels.items() for x in p])
    return F.coalesce(names[code.cast("int")], F.lit(labels[0]))


@query("SELECT event_id, CASE event_id % 100 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in WEATHER.items()) + " ELSE 'clear' END AS label FROM events")
def p13_weather_labels(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", weather_label(F.col("event_id") % 100).alias("label"))
