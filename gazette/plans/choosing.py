"""Selections that take turns: caps, likeness and arbitration between chapters, with recursive SQL that walks the same order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette.functions import text
from gazette.functions.lineage import settle
from gazette.operators import select, similar
from gazette.plans.catalogue import ALIKE_SQL, CAND, IMPORTANCE, NORM, RELEVANT, _scored, alike, eligible, query, title_tokens_sql
from gazette.plans.rules import ACTIONS, ENTITIES, EVENT, PRIORITY, RESEARCH, event_words, priority, research, same_action_sql
from gazette.sources.tables import candidates, table


@query(f"""WITH RECURSIVE {PRIORITY}, s AS (SELECT seq, chapter, source, score, age, {EVENT.format('title')} AS tokens FROM pr WHERE reason IS NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY chapter ORDER BY score DESC, age, seq) AS rk FROM s),
r AS (SELECT chapter, 0::BIGINT AS rk, []::STRUCT(seq BIGINT, source VARCHAR, score DOUBLE, tokens VARCHAR[])[] AS got FROM (SELECT DISTINCT chapter FROM o)
UNION ALL SELECT r.chapter, o.rk, CASE WHEN len(got) < 10 AND len(list_filter(got, lambda g: g.source = o.source)) < 2 AND len(list_filter(got, lambda g: {same_action_sql('g.tokens', 'o.tokens')})) = 0
THEN list_append(got, {{'seq': o.seq, 'source': o.source, 'score': o.score, 'tokens': o.tokens}}) ELSE got END FROM r JOIN o ON r.chapter = o.chapter AND o.rk = r.rk + 1),
l AS (SELECT chapter, arg_max(got, rk) AS got FROM r GROUP BY chapter), u AS (SELECT chapter, unnest(got) AS g, generate_subscripts(got, 1) AS pick FROM l)
SELECT chapter, CAST(pick AS INTEGER) AS pick, g.seq AS seq, g.source AS source, round(g.score, 2) AS score FROM u""")
def w2_priority_select(spark: SparkSession, sf: str) -> DataFrame:
    return _priority_picks(spark, sf)[1].select("chapter", "pick", "seq", "source", F.round("score", 2).alias("score"))


def _same_action(a: Column, b: Column) -> Column:
    return similar.same_action(a, b, ACTIONS, ENTITIES)


def _priority_picks(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    p = priority(spark, sf).filter("reason IS NULL").select("seq", "chapter", "source", "score", (-F.col("age")).alias("late"), (-F.col("seq")).alias("turn"), event_words(F.col("title")).alias("tokens"))
    p = settle(p)
    return p, select.greedy_select(p, ["chapter"], ["score", "late", "turn"], 10, {"source": 2}, likeness=_same_action)


@query(f"""WITH RECURSIVE {PRIORITY}, s AS (SELECT seq, chapter, source, score, age, {EVENT.format('title')} AS tokens FROM pr WHERE reason IS NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY chapter ORDER BY score DESC, age, seq) AS rk FROM s),
r AS (SELECT chapter, 0::BIGINT AS rk, []::STRUCT(source VARCHAR, tokens VARCHAR[])[] AS got, 0::BIGINT AS skipped FROM (SELECT DISTINCT chapter FROM o)
UNION ALL SELECT r.chapter, o.rk, CASE WHEN len(got) < 10 AND len(list_filter(got, lambda g: g.source = o.source)) < 2 AND len(list_filter(got, lambda g: {same_action_sql('g.tokens', 'o.tokens')})) = 0
THEN list_append(got, {{'source': o.source, 'tokens': o.tokens}}) ELSE got END,
skipped + CASE WHEN len(got) < 10 AND len(list_filter(got, lambda g: g.source = o.source)) < 2 AND len(list_filter(got, lambda g: {same_action_sql('g.tokens', 'o.tokens')})) > 0 THEN 1 ELSE 0 END FROM r JOIN o ON r.chapter = o.chapter AND o.rk = r.rk + 1),
l AS (SELECT chapter, arg_max(got, rk) AS got, max(skipped) AS skipped FROM r GROUP BY chapter), e AS (SELECT chapter, count(*) AS eligible FROM s GROUP BY chapter)
SELECT chapter, eligible, CAST(len(got) AS BIGINT) AS selected, CAST(len(list_distinct(list_transform(got, lambda g: g.source))) AS BIGINT) AS domains, CAST(skipped AS BIGINT) AS event_duplicates_skipped,
CASE WHEN len(got) >= 10 AND len(list_distinct(list_transform(got, lambda g: g.source))) >= 5 THEN 'PASS' ELSE 'FAIL' END AS status FROM l JOIN e USING (chapter)""")
def w2_priority_report(spark: SparkSession, sf: str) -> DataFrame:
    """What the selection of each chapter found: eligible and chosen rows, domains, rows passed over as the same event, PASS or FAIL."""
    p, got = _priority_picks(spark, sf)
    got = settle(got.withColumn("mode", F.lit("picked")))
    passed = select.passed_over(p.withColumn("key", F.col("seq")), got.withColumn("key", F.col("seq")), got.limit(0).withColumn("key", F.col("seq")), "chapter", "key", ["score", "late", "turn"], {"source": 2}, _same_action, 10, "")
    skipped = passed.filter("reason = 'same_event'").select("chapter", F.col("n").alias("event_duplicates_skipped"))
    counts = got.groupBy("chapter").agg(F.count(F.lit(1)).alias("selected"), F.count_distinct("source").alias("domains"))
    r = p.groupBy("chapter").agg(F.count(F.lit(1)).alias("eligible")).join(counts, "chapter").join(skipped, "chapter", "left")
    status = F.when((F.col("selected") >= 10) & (F.col("domains") >= 5), "PASS").otherwise("FAIL")
    return r.select("chapter", "eligible", "selected", "domains", F.coalesce("event_duplicates_skipped", F.lit(0)).cast("long").alias("event_duplicates_skipped"), status.alias("status"))


@query(f"""WITH {RESEARCH}, a AS (SELECT *, row_number() OVER (PARTITION BY chapter, source ORDER BY score DESC, age, seq) AS r FROM rs), b AS (SELECT *, row_number() OVER (PARTITION BY chapter ORDER BY (r > 1), score DESC, age, seq) AS rank FROM a WHERE r <= 3)
SELECT chapter, seq, source, score, CAST(rank AS INTEGER) AS rank FROM b WHERE rank <= 20""")
def w3_research_select(spark: SparkSession, sf: str) -> DataFrame:
    order = [F.desc("score"), F.asc("age"), F.asc("seq")]
    r = research(spark, sf).select("chapter", "seq", "source", "score", "age")
    capped = r.withColumn("__k", F.row_number().over(Window.partitionBy("chapter", "source").orderBy(*order))).filter("__k <= 3").drop("__k")
    return select.one_each_then_fill(capped, ["chapter"], "source", 20, order).select("chapter", "seq", "source", "score", "rank")


@query(f"""WITH RECURSIVE {RESEARCH}, s AS (SELECT chapter, seq, score, source AS topic, 'd' || seq % 9 AS domain FROM rs), o AS (SELECT *, pass, row_number() OVER (PARTITION BY chapter ORDER BY pass, score DESC, seq) AS rk FROM s, (VALUES (1), (2), (3)) v(pass)),
r AS (SELECT chapter, 0::BIGINT AS rk, []::STRUCT(seq BIGINT, topic VARCHAR, domain VARCHAR)[] AS got FROM (SELECT DISTINCT chapter FROM o)
UNION ALL SELECT r.chapter, o.rk, CASE WHEN len(got) < 12 AND len(list_filter(got, lambda g: g.seq = o.seq)) = 0 AND len(list_filter(got, lambda g: g.topic = o.topic)) < 2
AND (pass = 3 OR (pass = 2 AND len(list_filter(got, lambda g: g.topic = o.topic)) = 0) OR (pass = 1 AND len(got) < 5 AND len(list_filter(got, lambda g: g.domain = o.domain)) = 0))
THEN list_append(got, {{'seq': o.seq, 'topic': o.topic, 'domain': o.domain}}) ELSE got END FROM r JOIN o ON r.chapter = o.chapter AND o.rk = r.rk + 1),
l AS (SELECT chapter, arg_max(got, rk) AS got FROM r GROUP BY chapter), u AS (SELECT chapter, unnest(got) AS g, generate_subscripts(got, 1) AS pick FROM l WHERE len(got) = 12 AND len(list_distinct(list_transform(got, lambda g: g.domain))) >= 5)
SELECT chapter, CAST(pick AS INTEGER) AS pick, g.seq AS seq, g.topic AS topic, g.domain AS domain FROM u""")
def w4_domain_diverse(spark: SparkSession, sf: str) -> DataFrame:
    r = research(spark, sf).select("chapter", "seq", "score", F.col("source").alias("topic"), F.concat(F.lit("d"), (F.col("seq") % 9).cast("string")).alias("domain"), (-F.col("seq")).alias("turn"))
    return select.domain_diverse(r, ["chapter"], "domain", "topic", ["score", "turn"], 12, 5, 2).select("chapter", "pick", "seq", "topic", "domain")


@query(f"""WITH RECURSIVE {RELEVANT}, s AS (SELECT seq, CAST(seq % 2 AS INTEGER) AS edition, chapter, source, score, title AS key, {title_tokens_sql('title')} AS tokens FROM fit),
n AS (SELECT edition, chapter, row_number() OVER (PARTITION BY edition ORDER BY count(DISTINCT key), chapter) AS turn FROM s GROUP BY edition, chapter),
o AS (SELECT s.*, turn, row_number() OVER (PARTITION BY edition ORDER BY turn, score DESC, seq) AS rk FROM s JOIN n USING (edition, chapter)),
r AS (SELECT edition, 0::BIGINT AS rk, []::STRUCT(seq BIGINT, chapter VARCHAR, source VARCHAR, key VARCHAR, tokens VARCHAR[])[] AS got FROM (SELECT DISTINCT edition FROM o)
UNION ALL SELECT r.edition, o.rk, CASE WHEN len(list_filter(got, lambda g: g.chapter = o.chapter)) < 10 AND len(list_filter(got, lambda g: g.chapter = o.chapter AND g.source = o.source)) < 2 AND len(list_filter(got, lambda g: g.key = o.key AND g.chapter <> o.chapter)) = 0
AND len(list_filter(got, lambda g: g.chapter = o.chapter AND {ALIKE_SQL})) = 0
THEN list_append(got, {{'seq': o.seq, 'chapter': o.chapter, 'source': o.source, 'key': o.key, 'tokens': o.tokens}}) ELSE got END FROM r JOIN o ON r.edition = o.edition AND o.rk = r.rk + 1),
l AS (SELECT edition, arg_max(got, rk) AS got FROM r GROUP BY edition), u AS (SELECT edition, unnest(got) AS g FROM l), d AS (SELECT edition, g.chapter AS chapter FROM u GROUP BY ALL HAVING count(DISTINCT g.source) >= 5)
SELECT edition, g.chapter AS chapter, g.seq AS seq, g.source AS source FROM u WHERE (edition, g.chapter) IN (SELECT (edition, chapter) FROM d)""")
def w6_scarcity_first(spark: SparkSession, sf: str) -> DataFrame:
    """Two editions (of odd and even ids): fresh and relevant candidates, scarce chapters first, each as :func:`w1_diverse_top_k`; titles are given out once."""
    c = eligible(spark, sf).select("seq", (F.col("seq") % 2).cast("int").alias("edition"), "chapter", "source", "score", "turn", F.col("title").alias("key"), text.title_tokens(F.col("title")).alias("tokens"))
    return select.allocate(c, "edition", "chapter", "key", ["score", "turn"], 10, {"source": 2}, alike, ("source", 5)).select("edition", "chapter", "seq", "source")


@query(f"""WITH {CAND}, s AS (SELECT seq, chapter, {NORM.format('title')} AS key, CASE chapter WHEN 'en' THEN 1 WHEN 'fr' THEN 2 WHEN 'de' THEN 3 ELSE 4 END AS place FROM c), f AS (SELECT key, min(place) AS place FROM s WHERE key <> '' GROUP BY key)
SELECT seq, chapter FROM s JOIN f USING (key, place)""")
def j10_reserved_titles(spark: SparkSession, sf: str) -> DataFrame:
    """Titles go to the first chapter that has them; later chapters lose them. One aggregate does for all turns."""
    ch = F.col("chapter")
    s = candidates(spark, sf).select("seq", "chapter", text.norm_title(F.col("title")).alias("key"), F.when(ch == "en", 1).when(ch == "fr", 2).when(ch == "de", 3).otherwise(4).alias("place"))
    first = s.filter("key <> ''").groupBy("key").agg(F.min("place").alias("place"))
    return s.join(first, ["key", "place"], "left_semi").select("seq", "chapter")


@query(f"""WITH RECURSIVE {CAND}, s AS (SELECT seq, chapter, source, CAST({IMPORTANCE} AS DOUBLE) AS score, {title_tokens_sql('title')} AS tokens FROM c),
b AS (SELECT *, row_number() OVER (PARTITION BY chapter ORDER BY score DESC, seq) AS rk, row_number() OVER (PARTITION BY chapter, source ORDER BY score DESC, seq) AS one FROM s),
k AS (SELECT *, row_number() OVER (PARTITION BY chapter ORDER BY score DESC, seq) AS place FROM b WHERE one = 1), kept AS (SELECT * FROM k WHERE place <= 4 AND seq % 3 <> 0),
seed AS (SELECT chapter, list({{'seq': seq, 'source': source, 'tokens': tokens}} ORDER BY score DESC, seq) AS got FROM kept GROUP BY chapter),
r AS (SELECT d.chapter, 0::BIGINT AS rk, coalesce(seed.got, []::STRUCT(seq BIGINT, source VARCHAR, tokens VARCHAR[])[]) AS got FROM (SELECT DISTINCT chapter FROM b) d LEFT JOIN seed USING (chapter)
UNION ALL SELECT r.chapter, o.rk, CASE WHEN len(got) < 6 AND len(list_filter(got, lambda g: g.seq = o.seq)) = 0 AND len(list_filter(got, lambda g: g.source = o.source)) < 2 AND len(list_filter(got, lambda g: {ALIKE_SQL})) = 0
THEN list_append(got, {{'seq': o.seq, 'source': o.source, 'tokens': o.tokens}}) ELSE got END FROM r JOIN b o ON r.chapter = o.chapter AND o.rk = r.rk + 1),
l AS (SELECT chapter, arg_max(got, rk) AS got FROM r GROUP BY chapter), u AS (SELECT chapter, unnest(got) AS g, generate_subscripts(got, 1) AS pick FROM l) SELECT chapter, CAST(pick AS INTEGER) AS pick, g.seq AS seq, g.source AS source FROM u""")
def w7_refill(spark: SparkSession, sf: str) -> DataFrame:
    """Survivors of an arbitration (here: of the four best of different sources those whose id three does not divide), filled up to six."""
    pool = _scored(spark, sf)
    order = [F.desc("score"), F.asc("seq")]
    kept = select.capped_top(pool, ["chapter"], "source", 1, 4, order).filter("seq % 3 <> 0").select(pool.columns)
    return select.greedy_select(pool, ["chapter"], ["score", "turn"], 6, {"source": 2}, seed=kept, likeness=alike).select("chapter", "pick", "seq", "source")


@query("SELECT user_id, event_id, CAST(r AS INTEGER) AS rank FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS r FROM events) WHERE r <= 15")
def w11_per_source_limit(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("user_id", "event_id", "ts")
    return e.withColumn("rank", F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("ts"), "event_id"))).filter("rank <= 15").select("user_id", "event_id", "rank")


@query(f"""WITH {CAND}, s AS (SELECT seq, chapter, CAST({IMPORTANCE} AS DOUBLE) AS score FROM c), r AS (SELECT *, row_number() OVER (PARTITION BY chapter ORDER BY score DESC, seq) AS k FROM s),
f AS (SELECT chapter, count(*) AS n, string_agg(seq, ',' ORDER BY k) AS ids FROM r WHERE k <= 10 GROUP BY chapter)
SELECT CAST(sum(n) AS BIGINT) AS articles, count(*) AS chapters, string_agg(chapter || ':' || ids, ';' ORDER BY chapter) AS folded FROM f""")
def a8_edition_folding(spark: SparkSession, sf: str) -> DataFrame:
    s = _scored(spark, sf).select("seq", "chapter", "score")
    r = s.withColumn("k", F.row_number().over(Window.partitionBy("chapter").orderBy(F.desc("score"), "seq"))).filter("k <= 10")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "seq"))), lambda x: x.seq.cast("string")), ",")
    f = r.groupBy("chapter").agg(F.count(F.lit(1)).alias("n"), ids.alias("ids"))
    lines = F.transform(F.sort_array(F.collect_list(F.struct("chapter", "ids"))), lambda x: F.concat(x.chapter, F.lit(":"), x.ids))
    return f.agg(F.sum("n").alias("articles"), F.count(F.lit(1)).alias("chapters"), F.array_join(lines, ";").alias("folded"))
