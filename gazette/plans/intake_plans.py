"""Intake, archives, redirects, assertions, fallback and widening windows: queries over the driver's tables and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette.functions import checks
from gazette.operators import gather, redirects, select
from gazette.plans.catalogue import CAND, HOST, IMPORTANCE, KEY, _scored, query
from gazette.plans.rules import RESEARCH, research
from gazette.sources import archive, snapshots
from gazette.sources.tables import candidates, table
from gazette.streaming import intake

# --- streaming intake with late rows ---

#: Days that events of a kind stay news, if not three.
LONG = {"purchase": 7}


@query("""WITH RECURSIVE e AS (SELECT event_id AS id, event_type AS chapter, user_id, CASE WHEN event_id % 50 <> 21 THEN epoch_us(ts) END AS published,
epoch_us(ts) + CASE WHEN event_id % 50 = 7 THEN 216 WHEN event_id % 50 = 13 THEN -12 ELSE (event_id % 5) * 20 END * 3600000000 AS arrived, CASE WHEN event_type = 'purchase' THEN 7 ELSE 3 END * 86400000000 AS most FROM events),
t AS (SELECT *, CASE WHEN published IS NULL THEN 'missing_date' WHEN arrived - published < -0.25 * 86400000000 THEN 'future' WHEN arrived - published > most THEN 'stale' END AS told FROM e),
o AS (SELECT *, published + most AS over, row_number() OVER (PARTITION BY chapter, user_id ORDER BY arrived, id) AS rk FROM t WHERE told IS NULL),
r AS (SELECT chapter, user_id, rk, id, 'kept' AS outcome, over AS until FROM o WHERE rk = 1
UNION ALL SELECT o.chapter, o.user_id, o.rk, o.id, CASE WHEN o.arrived >= r.until THEN 'kept' ELSE 'duplicate' END, CASE WHEN o.arrived >= r.until THEN o.over ELSE r.until END FROM r JOIN o ON o.chapter = r.chapter AND o.user_id = r.user_id AND o.rk = r.rk + 1)
SELECT id, outcome FROM r UNION ALL SELECT id, told FROM t WHERE told IS NOT NULL""")
def st1_streaming_intake(spark: SparkSession, sf: str) -> DataFrame:
    """Each event's outcome. Arrival follows publication by up to 80 hours, nine days, or is before it; some have no date."""
    k, ts = F.col("event_id"), F.col("ts").cast("timestamp")
    late = F.when(k % 50 == 7, 216).when(k % 50 == 13, -12).otherwise((k % 5) * 20)
    e = intake.arrivals(spark, sf, "events").select(k.alias("id"), F.col("event_type").alias("chapter"), "user_id", F.when(k % 50 != 21, ts).alias("published"), (ts + F.make_dt_interval(hours=late.cast("int"))).alias("arrived"))
    most = F.lit(3)
    for chapter, days in LONG.items():
        most = F.when(F.col("chapter") == chapter, days).otherwise(most)
    return intake.drained(intake.admitted(e, ["chapter", "user_id"], "published", "arrived", most), by="outcome").select("id", "outcome")


# --- archives ---

PICKS = f"""{CAND}, pk AS (SELECT seq, chapter, source, CAST('2024-01-0' || (8 + seq % 2) AS VARCHAR) AS edition, CAST({IMPORTANCE} AS DOUBLE) AS score FROM c),
pl AS (SELECT *, CAST(row_number() OVER (PARTITION BY edition, chapter ORDER BY score DESC, seq) AS INTEGER) AS place FROM pk)"""


def picks(spark: SparkSession, sf: str, most: int = 10) -> DataFrame:
    """edition, chapter, place, seq, source: the best of each chapter for two days."""
    s = _scored(spark, sf).select("seq", "chapter", "source", "score", F.concat(F.lit("2024-01-0"), (8 + F.col("seq") % 2).cast("string")).alias("edition"))
    best = Window.partitionBy("edition", "chapter").orderBy(F.desc("score"), "seq")
    return s.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= most).select("edition", "chapter", "place", "seq", "source")


EDITION = "chapters array<struct<chapter:string,count:long,articles:array<struct<place:int,seq:long,source:string>>>>, articles long"


@query(f"WITH {PICKS} SELECT edition, chapter, place, seq, source FROM pl WHERE place <= CASE WHEN edition = '2024-01-08' THEN 5 ELSE 10 END")
def s15_edition_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Two editions stored as nested documents; then the first one again, with five articles a chapter, beside the other that stays; all read back and unfolded."""
    folder, p = intake.shared_folder(spark), picks(spark, sf)
    archive.store(archive.fold(p), folder)
    archive.store(archive.fold(p.filter("edition = '2024-01-08' AND place <= 5")), folder)
    return _unfolded(archive.load(spark, folder, EDITION))


@query(f"WITH {PICKS} SELECT edition, chapter, place, seq, source FROM pl WHERE place <= 10 AND edition = (SELECT max(edition) FROM pl)")
def s15_latest_edition(spark: SparkSession, sf: str) -> DataFrame:
    """The latest of the stored editions, known by the names of folders; only its files are read."""
    folder = intake.shared_folder(spark)
    archive.store(archive.fold(picks(spark, sf)), folder)
    return _unfolded(archive.latest(spark, folder, EDITION))


def _unfolded(e: DataFrame) -> DataFrame:
    return e.select("edition", F.explode("chapters").alias("c")).select("edition", "c.chapter", F.explode("c.articles").alias("a")).select("edition", "chapter", "a.place", "a.seq", "a.source")


@query(f"""WITH {RESEARCH}, w AS (SELECT '2024-01-0' || (8 + seq % 2) AS edition, chapter, source, kind, age FROM rs)
SELECT edition, chapter, count(*) AS candidates, count(*) FILTER (age <= 14) AS eligible, count(DISTINCT source) FILTER (age <= 14) AS topics, count(*) FILTER (age > 14) AS stale FROM w WHERE edition = (SELECT max(edition) FROM w) GROUP BY edition, chapter""")
def s17_research_report_sink(spark: SparkSession, sf: str) -> DataFrame:
    """Research reports of two days in a dated archive, each with its counts as a nested array; the latest is read back."""
    folder, fresh = intake.shared_folder(spark), F.col("age") <= 14
    r = research(spark, sf).withColumn("edition", F.concat(F.lit("2024-01-0"), (8 + F.col("seq") % 2).cast("string")))
    counts = r.groupBy("edition", "chapter").agg(
        F.count(F.lit(1)).alias("candidates"), F.count_if(fresh).alias("eligible"), F.count_distinct(F.when(fresh, F.col("source"))).alias("topics"), F.count_if(~fresh).alias("stale"),
    )
    archive.store(counts.groupBy("edition").agg(F.sort_array(F.collect_list(F.struct("chapter", "candidates", "eligible", "topics", "stale"))).alias("chapters")), folder)
    report = archive.latest(spark, folder, "chapters array<struct<chapter:string,candidates:long,eligible:long,topics:long,stale:long>>")
    return report.select("edition", F.inline("chapters"))


# --- readers that stop at bad input ---


@query("SELECT doc_id AS id, CASE WHEN quality = 1 THEN 'keep' ELSE 'drop' END AS expected FROM labels WHERE doc_id % 10 <> 3 AND quality IS NOT NULL")
def s12_gold_corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Gold rows written as JSON lines, with blank lines for ids that end in 3, and read; a row without a required key would stop the query."""
    folder = intake.shared_folder(spark)
    row = F.struct(F.col("doc_id").cast("string").alias("id"), F.lit("label").alias("kind"), F.when(F.col("quality") == 1, "keep").otherwise("drop").alias("expected"))
    lines = table(spark, sf, "labels").filter("quality IS NOT NULL").select(F.when(F.col("doc_id") % 10 == 3, "").otherwise(F.to_json(row)).alias("value"))
    lines.write.text(folder)
    return snapshots.gold(spark, folder).select(F.col("id").cast("long").alias("id"), "expected")


@query(f"WITH {PICKS} SELECT chapter, CAST(row_number() OVER (ORDER BY chapter, place) AS INTEGER) AS pos, seq FROM pl WHERE place <= 10 AND edition = '2024-01-09'")
def s13_snapshot_materialise(spark: SparkSession, sf: str) -> DataFrame:
    """An edition's picks frozen as chunk files and a manifest file, and put together again in the manifest's order; chunks that differ from it stop the query."""
    folder = intake.shared_folder(spark)
    frozen = picks(spark, sf).filter("edition = '2024-01-09'")
    snapshots.freeze(frozen.select("edition", "chapter", "place", F.struct("seq", "source").alias("row")), folder)
    return snapshots.materialise(spark, folder, "struct<seq:long,source:string>").select("chapter", "pos", "row.seq")


# --- redirects ---

RESOLVERS, BLOCKED = ["doi.example.org"], ["login", ".org"]
MOVES = """mv AS (SELECT 'https://doi.example.org/' || page_id AS url, CASE page_id % 8 WHEN 3 THEN url WHEN 6 THEN 'https://doi.example.org/' || (page_id - 2) ELSE 'https://doi.example.org/' || (page_id + 1) END AS target FROM pages WHERE page_id % 8 <> 7),
mm AS (SELECT url, min(target) AS target FROM mv WHERE url IS NOT NULL AND target IS NOT NULL AND url <> target GROUP BY url),
wk AS (SELECT url, target AS loc, 1::BIGINT AS hops, [url] AS seen FROM mm UNION ALL SELECT wk.url, mm.target, hops + 1, list_append(seen, wk.loc) FROM wk JOIN mm ON wk.loc = mm.url WHERE NOT list_contains(seen, wk.loc)),
we AS (SELECT url, arg_max(loc, hops) AS loc, max(hops) AS hops, arg_max(seen, hops) AS seen FROM wk GROUP BY url),
rd AS (SELECT url, CASE WHEN list_contains(seen, loc) THEN NULL ELSE loc END AS final_url, CASE WHEN list_contains(seen, loc) THEN NULL ELSE hops END AS hops, CASE WHEN list_contains(seen, loc) THEN list_min(list_slice(seen, list_position(seen, loc), len(seen))) END AS cycle FROM we)"""


def moves(spark: SparkSession, sf: str) -> DataFrame:
    """url, target: identifiers of pages lead from one to the next; in each eight some end at a page, some run in a loop."""
    k = F.col("page_id")
    doi = lambda n: F.concat(F.lit("https://doi.example.org/"), n.cast("string"))
    return table(spark, sf, "pages").filter(k % 8 != 7).select(doi(k).alias("url"), F.when(k % 8 == 3, F.col("url")).when(k % 8 == 6, doi(k - 2)).otherwise(doi(k + 1)).alias("target"))


@query(f"WITH RECURSIVE {MOVES} SELECT url, final_url, hops, cycle FROM rd")
def p16_redirect_chains(spark: SparkSession, sf: str) -> DataFrame:
    return redirects.resolve(moves(spark, sf))


def _publisher_sql(c: str) -> str:
    host = HOST.replace("url", c)
    return f"CASE WHEN regexp_matches({c}, '^https?://[^/?#]+') AND {host} IS NOT NULL AND {host} <> 'doi.example.org' AND NOT contains({host}, 'login') AND NOT contains({host}, '.org') THEN {c} END"


@query(f"""WITH RECURSIVE {MOVES}, it AS (SELECT page_id, CASE WHEN page_id % 3 <> 0 THEN CAST(page_id AS VARCHAR) END AS doi, nullif(trim(url), '') AS own FROM pages),
f AS (SELECT page_id, own, coalesce('https://doi.example.org/' || doi, own) AS first FROM it), x AS (SELECT f.*, final_url AS over FROM f LEFT JOIN rd ON f.first = rd.url),
w AS (SELECT page_id, own, CASE WHEN {HOST.replace('url', 'first')} = 'doi.example.org' THEN coalesce({_publisher_sql('over')}, first) ELSE first END AS walked FROM x),
b AS (SELECT page_id, walked, {_publisher_sql('walked')} AS good, {_publisher_sql('own')} AS scholarly FROM w)
SELECT page_id, coalesce(good, scholarly, walked, '') AS best_url, CASE WHEN good IS NOT NULL THEN 'publisher' WHEN scholarly IS NOT NULL THEN 'scholarly' ELSE 'unresolved' END AS state FROM b""")
def p16_best_source_url(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("page_id")
    items = table(spark, sf, "pages").select("page_id", F.when(k % 3 != 0, k.cast("string")).alias("doi"), "url")
    found = redirects.best_source(items, redirects.resolve(moves(spark, sf)), RESOLVERS, BLOCKED, "https://doi.example.org/")
    return found.select("page_id", "best_url", "state")


@query(f"""WITH RECURSIVE {MOVES}, {CAND}, e AS (SELECT {KEY} AS key, arg_min(final_url, url) AS exact_url FROM rd WHERE final_url IS NOT NULL GROUP BY 1) SELECT seq, exact_url FROM c LEFT JOIN e ON e.key = 'https://doi.example.org/' || seq""")
def j3_exact_url(spark: SparkSession, sf: str) -> DataFrame:
    """Discovery addresses, written with a query and a slash, against the resolved ones; what is not found stays without."""
    rows = candidates(spark, sf).select("seq", F.concat(F.lit("https://doi.example.org/"), F.col("seq").cast("string"), F.lit("/?from=feed")).alias("link"))
    return redirects.exact(rows, redirects.resolve(moves(spark, sf))).select("seq", "exact_url")


# --- fallback, rescue, widening ---

NUMBER = "CAST(substr(source, 4) AS INTEGER)"
GATHER = f"""{CAND}, gr AS (SELECT 'c' || CAST(floor(sqrt(seq % 400)) AS INTEGER) AS grp, seq, source || '/' || (seq // 3) % 40 AS link, age_h <= 72 AS fresh, {NUMBER} AS k FROM c WHERE source IS NOT NULL),
gt AS (SELECT *, CASE WHEN k < 2 THEN 'topic' WHEN k < 12 THEN 'query' WHEN k < 17 THEN 'fallback' ELSE 'rescue' END AS tier, CASE WHEN k < 2 THEN k WHEN k < 12 THEN k - 2 WHEN k < 17 THEN k - 12 ELSE k - 17 END AS step FROM gr),
g1 AS (SELECT *, row_number() OVER (PARTITION BY grp, link ORDER BY CASE tier WHEN 'topic' THEN -1 ELSE step END, seq) AS r FROM gt WHERE tier IN ('topic', 'query')),
q1 AS (SELECT grp, CASE tier WHEN 'topic' THEN -1 ELSE step END AS s, count(*) AS n FROM g1 WHERE r = 1 GROUP BY ALL), q2 AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY grp ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sofar FROM q1),
b1 AS (SELECT g1.* FROM g1 JOIN q2 ON g1.grp = q2.grp AND CASE g1.tier WHEN 'topic' THEN -1 ELSE g1.step END = q2.s WHERE r = 1 AND (s <= 0 OR sofar < 30)),
ga AS (SELECT g.grp, count(b1.link) AS held FROM (SELECT DISTINCT grp FROM gt) g LEFT JOIN b1 USING (grp) GROUP BY g.grp),
f1 AS (SELECT gt.*, held, row_number() OVER (PARTITION BY gt.grp, gt.link ORDER BY step, seq) AS r FROM gt JOIN ga USING (grp) WHERE tier = 'fallback' AND held < 15 AND NOT EXISTS (SELECT 1 FROM b1 WHERE b1.grp = gt.grp AND b1.link = gt.link)),
f2 AS (SELECT grp, step, held + coalesce(sum(count(*)) OVER (PARTITION BY grp ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sofar FROM f1 WHERE r = 1 GROUP BY grp, step, held),
gg AS (SELECT grp, link, tier, step, seq, fresh FROM b1 UNION ALL SELECT f1.grp, link, tier, f1.step, seq, fresh FROM f1 JOIN f2 USING (grp, step) WHERE r = 1 AND (f1.step = 0 OR sofar < 20)),
lo AS (SELECT g.grp FROM (SELECT DISTINCT grp FROM gt) g LEFT JOIN gg USING (grp) GROUP BY g.grp HAVING count(*) FILTER (fresh) < 10),
rs1 AS (SELECT *, row_number() OVER (PARTITION BY grp, link ORDER BY step, seq) AS r FROM gt WHERE tier = 'rescue' AND grp IN (SELECT grp FROM lo))"""


def asked(spark: SparkSession, sf: str) -> DataFrame:
    """grp, link, tier, step, seq, fresh: documents as answers to queries, one for each publisher; chapters of many sizes, links that several queries find."""
    k, s = F.substring("source", 4, 9).cast("int"), F.col("seq")
    tier = F.when(k < 2, gather.TOPIC).when(k < 12, gather.QUERY).when(k < 17, gather.FALLBACK).otherwise(gather.RESCUE)
    step = F.when(k < 2, k).when(k < 12, k - 2).when(k < 17, k - 12).otherwise(k - 17)
    link = F.concat("source", F.lit("/"), (F.floor(s / 3) % 40).cast("string"))
    return candidates(spark, sf).filter("source IS NOT NULL").select(F.concat(F.lit("c"), F.floor(F.sqrt(s % 400)).cast("string")).alias("grp"), link.alias("link"), tier.alias("tier"), step.alias("step"), "seq", (F.col("age_h") <= 72).alias("fresh"))


@query(f"WITH {GATHER} SELECT grp, link, tier, seq FROM gg UNION ALL SELECT grp, link, tier, seq FROM rs1 WHERE r = 1")
def w10_candidate_caps(spark: SparkSession, sf: str) -> DataFrame:
    return gather.gathered(asked(spark, sf), "grp", "link").select("grp", "link", "tier", "seq")


@query(f"""WITH RECURSIVE {RESEARCH}, s AS (SELECT chapter || '-' || CAST(floor(sqrt(seq % 16)) AS INTEGER) AS desk, d, seq, score, source AS topic, 'd' || seq % 9 AS domain FROM rs, (VALUES (7), (14), (30)) w(d) WHERE age <= d), o AS (SELECT *, pass, row_number() OVER (PARTITION BY desk, d ORDER BY pass, score DESC, seq) AS rk FROM s, (VALUES (1), (2), (3)) v(pass)),
r AS (SELECT desk, d, 0::BIGINT AS rk, []::STRUCT(seq BIGINT, topic VARCHAR, domain VARCHAR)[] AS got FROM (SELECT DISTINCT desk, d FROM o)
UNION ALL SELECT r.desk, r.d, o.rk, CASE WHEN len(got) < 12 AND len(list_filter(got, lambda g: g.seq = o.seq)) = 0 AND len(list_filter(got, lambda g: g.topic = o.topic)) < 2
AND (pass = 3 OR (pass = 2 AND len(list_filter(got, lambda g: g.topic = o.topic)) = 0) OR (pass = 1 AND len(got) < 5 AND len(list_filter(got, lambda g: g.domain = o.domain)) = 0))
THEN list_append(got, {{'seq': o.seq, 'topic': o.topic, 'domain': o.domain}}) ELSE got END FROM r JOIN o ON r.desk = o.desk AND r.d = o.d AND o.rk = r.rk + 1),
l AS (SELECT desk, d, arg_max(got, rk) AS got FROM r GROUP BY desk, d), kk AS (SELECT * FROM l WHERE len(got) = 12 AND len(list_distinct(list_transform(got, lambda g: g.domain))) >= 5),
nn AS (SELECT desk, min(d) AS d FROM kk GROUP BY desk), u AS (SELECT kk.desk, kk.d, unnest(got) AS g, generate_subscripts(got, 1) AS pick FROM kk JOIN nn USING (desk, d))
SELECT desk, CAST(d AS INTEGER) AS window_days, CAST(pick AS INTEGER) AS pick, g.seq AS seq, g.topic AS topic, g.domain AS domain FROM u""")
def w9_widening_window(spark: SparkSession, sf: str) -> DataFrame:
    """Each desk's twelve records of five domains, in the narrowest of three windows in which there are as many."""
    s = F.col("seq")
    r = research(spark, sf).select(F.concat("chapter", F.lit("-"), F.floor(F.sqrt(s % 16)).cast("string")).alias("desk"), "age", "seq", "score", F.col("source").alias("topic"), F.concat(F.lit("d"), (s % 9).cast("string")).alias("domain"), (-s).alias("turn"))
    choose = lambda rows, group: select.domain_diverse(rows, group, "domain", "topic", ["score", "turn"], 12, 5, 2)
    return gather.widening(r, ["desk"], "age", (7, 14, 30), choose, 12).select("desk", "window_days", "pick", "seq", "topic", "domain")
