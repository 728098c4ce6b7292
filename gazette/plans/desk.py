"""Bodies and editorial texts over the driver's tables, with an English desk, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.functions import text
from gazette.operators import bodies, editorial
from gazette.plans.catalogue import CAND, HOST, INFORMATIVE, LOG, STOP, _clean_sql, query
from gazette.sources.tables import candidates, fetch_log, table

NOISE = ["copyright", "subscribe", "log in", "all rights reserved", "😊", "✨"]
DESK = editorial.Desk(
    stopwords=tuple(STOP), relays=("news.example",), relay_labels=("news.example", "src0"), names={"src1": "Source One", "src3": "Source Three"}, publishers=("src4", "src5", "licensed", "src11"), labels=("news", "update"),
    press="the press", original="the original", from_body="%s writes: %s", from_summary="%s reports: %s", from_headline="%s reports ‘%s’.", background="On ‘%s’. %s See also %s.", why="‘%s’: %s", official="‘%s’: official word",
    agreeing="agreement of %s", second="a second source", ends="[a-z.!?]$", forbidden=("[[", "lorem"), plain_words=tuple(STOP), fillers=("outlook", "trend", "policy"), particles=("ing", "ly"), no_keyword="follow-up", word="([a-zA-Z가-힣]{3,})",
)
LINE = "trim(regexp_replace({}, '[ \\t\\r\\n]+', ' ', 'g'))"
SQUEEZED = "trim(" + LINE + ", ' -·|,')"
LABELLESS = "trim(trim(regexp_replace(regexp_replace({}, '^\\s*(?:\\[[^\\]]{{1,30}}\\]\\s*)+', ''), '[ \\t\\r\\n]+', ' ', 'g')), ' -·|,')"
SENTENCES = "string_split(regexp_replace(" + LINE + ", '([.!?]) ', '\\1' || chr(1), 'g'), chr(1))"
TITLE = "trim(regexp_extract(html, '<title>([^<]*)</title>', 1))"


# --- bodies --------------------------------------------------------------------------------------------------------

_PARTS = f"""string_split_regex(CASE WHEN regexp_matches(html, '(?i)<article[^a-z]') THEN regexp_extract(html, '(?is)<article(?:\\s[^>]*)?>(.*?)(?:</article|\\z)', 1) ELSE html END, '(?i)<p(?:\\s[^>]*)?>')"""
BODY = f"""{LOG}, bp AS (SELECT page_id, domain, http_status, content_type, {TITLE} AS title, CASE WHEN http_status = 200 AND content_type = 'text/html' THEN {_PARTS}[2:] END AS raw FROM f),
bq AS (SELECT *, list_transform(raw, lambda p: {_clean_sql("regexp_replace(p, '(?is)</p\\s*>.*$', '')")}) AS ps FROM bp),
bg AS (SELECT *, list_filter(ps, lambda p, i: length(p) >= 30 AND NOT contains(lower(p), 'copyright') AND list_position(ps, p) = i) AS good FROM bq),
bt AS (SELECT *, list_filter(good, lambda p, i: coalesce(list_sum(list_transform(good[1:i - 1], lambda q: length(q))), 0) < 6000) AS taken FROM bg),
bb AS (SELECT *, CASE WHEN length(array_to_string(taken, ' ')) >= 220 THEN array_to_string(taken, ' ') END AS body FROM bt),
bk AS (SELECT *, {INFORMATIVE.format('title')} AS a, {INFORMATIVE.format('substr(body, 1, 6000)')} AS b FROM bb), bs AS (SELECT *, len(list_intersect(a, b)) AS k, CASE WHEN len(a) > 0 THEN len(list_intersect(a, b)) / len(a) ELSE 0 END AS share FROM bk)"""


@query(f"""WITH {BODY} SELECT page_id, CASE WHEN domain IS NULL THEN 'UNAVAILABLE' WHEN http_status <> 200 THEN 'HTTP_' || http_status WHEN content_type <> 'text/html' THEN 'NON_HTML' WHEN body IS NULL THEN 'NO_QUALIFIED_BODY' WHEN k >= 2 AND share >= 0.4 THEN 'VALIDATED' ELSE 'EVENT_MISMATCH' END AS body_status,
CASE WHEN body IS NOT NULL THEN 'paragraphs' END AS method, coalesce(length(body), 0) AS body_chars, CASE WHEN body IS NOT NULL THEN round_even(share, 3) ELSE 0 END AS title_overlap FROM bs""")
def s6_body_extraction(spark: SparkSession, sf: str) -> DataFrame:
    """The driver's pages declare no bodies, so that all come from paragraphs; declared ones are in the tests."""
    log = fetch_log(spark, sf)
    articles = log.select("page_id", F.col("url").alias("link"), F.trim(F.regexp_extract("html", "<title>([^<]*)</title>", 1)).alias("title"))
    return bodies.validate_bodies(articles, log, STOP, "page_id").select("page_id", "body_status", "method", "body_chars", "title_overlap")


SAFE = f"""{CAND}, x AS (SELECT seq, title, {LABELLESS.format('title')} AS head, unnest({SENTENCES.format('summary')}) AS sentence, generate_subscripts({SENTENCES.format('summary')}, 1) - 1 AS pos FROM c),
y AS (SELECT *, {LABELLESS.format('sentence')} AS clean, {INFORMATIVE.format('head')} AS a, {INFORMATIVE.format(LABELLESS.format('sentence'))} AS b, {INFORMATIVE.format('title')} AS t, {INFORMATIVE.format('sentence')} AS s FROM x
WHERE length(sentence) BETWEEN 30 AND 240 AND regexp_matches(sentence, '[.!?]$') AND {" AND ".join(f"NOT contains(lower(sentence), '{n}')" for n in NOISE)} AND NOT regexp_matches(sentence, '(?i)\\[[^\\]]*(?:사진|이미지|자료|기자)[^\\]]*\\]')),
safe AS (SELECT *, len(list_intersect(t, s)) AS shared FROM y WHERE NOT (length(head) > 0 AND starts_with(clean, head) AND length({LINE.format('substr(clean, length(head) + 1)')}) < 60)
AND NOT (len(a) > 0 AND len(b) > 0 AND len(list_intersect(a, b)) >= 0.9 * len(a) AND len(b) - len(list_intersect(a, b)) < 3))"""


@query(f"WITH {SAFE} SELECT seq, count(*) AS safe, CAST(min(pos) AS INTEGER) AS first FROM safe GROUP BY seq")
def f16_safe_sentences(spark: SparkSession, sf: str) -> DataFrame:
    safe = bodies.safe_sentences(candidates(spark, sf), "seq", "summary", STOP, NOISE)
    return safe.groupBy("seq").agg(F.count(F.lit(1)).alias("safe"), F.min("pos").alias("first"))


@query(f"WITH {SAFE} SELECT seq, arg_min(sentence, (-shared, length(sentence), pos)) AS sentence FROM safe WHERE shared >= 2 AND shared >= 0.4 * len(t) GROUP BY seq")
def p8_best_evidence_sentence(spark: SparkSession, sf: str) -> DataFrame:
    return bodies.evidence_sentences(candidates(spark, sf), "seq", "summary", STOP, NOISE).select("seq", F.col("evidence_span").alias("sentence"))


# --- editorial texts -----------------------------------------------------------------------------------------------


def articles(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as articles: the evidence sentence of the summary stands for a validated body's; two of three have addresses of evidence."""
    c, k = candidates(spark, sf), F.col("seq")
    more = F.concat(F.lit("https://site"), (k % 4).cast("string"), F.lit(".example.net/"), k.cast("string"))
    rows = c.join(bodies.evidence_sentences(c, "seq", "summary", STOP, NOISE), "seq", "left").withColumn("body_status", F.when(F.col("evidence_span").isNotNull(), "VALIDATED").otherwise("NO_QUALIFIED_BODY"))
    return rows.select("seq", "chapter", "source", "title", "summary", "body_status", "evidence_span", F.when(k % 3 != 0, F.array("link", more)).otherwise(F.array("link")).alias("evidence_urls"))


def contexts(spark: SparkSession) -> DataFrame:
    rows = [(None, "Facts are to be checked.", "Effects are open.", "official word"), ("en", "Follow the talks.", "Trade may change.", "the next round"), ("de", "Follow the vote.", "Law may change.", "the committee")]
    return spark.createDataFrame(rows, "chapter string, context string, effect string, watch string")


@query()
def p7_editorial(spark: SparkSession, sf: str) -> DataFrame:
    """The tests hold the texts against stored samples."""
    made = editorial.polished(editorial.editorial(articles(spark, sf), contexts(spark), DESK), DESK)
    return made.select("seq", "basis", "fact", "background", "why_it_matters", F.array_join("checkpoints", " | ").alias("checkpoints"), "rejected")


_NAME = "CASE WHEN contains(low, 'news.example') OR contains(low, 'src0') THEN 'the original' WHEN low = 'src1' THEN 'Source One' WHEN low = 'src3' THEN 'Source Three' WHEN regexp_matches(low, '^[a-z0-9.-]+\\.(?:com|co\\.kr|kr|net|org)$') THEN 'the original' ELSE s END"
NAMED = f"""{CAND}, n0 AS (SELECT seq, CASE WHEN seq % 3 = 0 THEN title || ' - ' || source WHEN seq % 7 = 0 THEN '[update] ' || title ELSE title END AS title, CASE WHEN seq % 11 = 0 THEN 'www.' || source || '.com' ELSE source END AS source FROM c),
n1 AS (SELECT *, coalesce(nullif({SQUEEZED.format('source')}, ''), 'the press') AS s FROM n0), n2 AS (SELECT *, regexp_replace(lower(s), '^www\\.', '') AS low FROM n1), n3 AS (SELECT *, {_NAME} AS shown, {LABELLESS.format('title')} AS t0 FROM n2),
n4 AS (SELECT *, CASE WHEN s IN ('', 'the original', 'the press') THEN '' ELSE s END AS fa, CASE WHEN shown IN ('', 'the original', 'the press') THEN '' ELSE shown END AS fb FROM n3),
n5 AS (SELECT *, CASE WHEN length(fa) >= length(fb) THEN fa ELSE fb END AS f1, CASE WHEN fa = fb THEN '' WHEN length(fa) >= length(fb) THEN fb ELSE fa END AS f2 FROM n4),"""
_TAIL = "CASE WHEN {f} <> '' AND ends_with(lower({t}), lower({f})) AND regexp_matches(left({t}, length({t}) - length({f})), '[-–—|:]\\s*$') THEN rtrim(regexp_replace(left({t}, length({t}) - length({f})), '\\s*[-–—|:]\\s*$', '')) ELSE rtrim({t}) END"


@query(f"WITH {NAMED} n6 AS (SELECT *, {_TAIL.format(t='t0', f='f1')} AS t1 FROM n5), n7 AS (SELECT *, {_TAIL.format(t='t1', f='f2')} AS t2 FROM n6) SELECT seq, shown AS publisher, coalesce(nullif({SQUEEZED.format('t2')}, ''), {SQUEEZED.format('title')}) AS clean_title FROM n7")
def p10_publisher_and_title(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("seq")
    title = F.when(k % 3 == 0, F.concat("title", F.lit(" - "), "source")).when(k % 7 == 0, F.concat(F.lit("[update] "), "title")).otherwise(F.col("title"))
    source = F.when(k % 11 == 0, F.concat(F.lit("www."), "source", F.lit(".com"))).otherwise(F.col("source"))
    rows = candidates(spark, sf).select("seq", title.alias("title"), source.alias("source"))
    return rows.select("seq", editorial.publisher_name(F.col("source"), DESK).alias("publisher"), editorial.display_title(F.col("title"), F.col("source"), DESK).alias("clean_title"))


@query(f"""WITH {CAND}, p0 AS (SELECT seq, title, source, {SQUEEZED.format('summary')} AS piece FROM c), p1 AS (SELECT *, source AS s, regexp_replace(lower(source), '^www\\.', '') AS low FROM p0), p2 AS (SELECT *, lower({_NAME}) AS own, lower(piece) AS lp, {INFORMATIVE.format('title')} AS a, {INFORMATIVE.format('piece')} AS b FROM p1),
p3 AS (SELECT *, len(list_intersect(a, b)) AS k, least(len(a), len(b)) AS m, len(list_distinct(list_concat(a, b))) AS u FROM p2)
SELECT seq, CASE WHEN length(piece) < 12 THEN 'short' WHEN contains(lp, 'news.example') THEN 'relay' WHEN piece = title OR piece = source OR regexp_matches(lp, '(?:^|[^\\pL\\pN_])(?:https?://|www\\.)|(?:^|[^\\pL\\pN_])[a-z0-9.-]+\\.(?:com|co\\.kr|kr|net|org)(?:$|[^\\pL\\pN_])') OR regexp_full_match(lp, 'news|update') THEN 'noise'
WHEN {" OR ".join(f"(contains(lp, '{m}') AND NOT contains(own, '{m}'))" for m in DESK.publishers)} THEN 'publisher' WHEN NOT coalesce(k >= 2 AND k / m >= 0.5 AND k / u >= 0.25, false) THEN 'other_event' END AS reason FROM p3""")
def f14_relay_noise(spark: SparkSession, sf: str) -> DataFrame:
    """Each summary as one piece."""
    return candidates(spark, sf).select("seq", editorial.reject_reason(text.squeezed(F.col("summary")), F.col("title"), F.col("source"), editorial.publisher_name(F.col("source"), DESK), text.informative_tokens(F.col("title"), STOP), DESK).alias("reason"))


def _words_sql(c: str, name: str) -> str:
    w = f"list_filter(regexp_extract_all({c}, '([a-zA-Z가-힣]{{3,}})', 1), lambda w: NOT list_contains({list(STOP)}, w))"
    return f"""{name}u AS (SELECT seq, unnest({w}) AS w, generate_subscripts({w}, 1) AS i FROM c), {name}g AS (SELECT seq, w, count(*) AS n, min(i) AS i FROM {name}u GROUP BY seq, w), {name}r AS (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY n DESC, i) AS k FROM {name}g),
{name} AS (SELECT c.seq, coalesce(ws, []) AS ws FROM c LEFT JOIN (SELECT seq, list(w ORDER BY k) AS ws FROM {name}r WHERE k <= 4 GROUP BY seq) z ON c.seq = z.seq), {name}f AS (SELECT seq, list_concat(ws, ['outlook', 'trend', 'policy'][1:greatest(3 - len(ws), 0)])[1:4] AS ws FROM {name})"""


_BASE = "CASE WHEN w LIKE '%ing' THEN CASE WHEN length(w) >= 5 THEN left(w, length(w) - 3) ELSE w END WHEN w LIKE '%ly' THEN CASE WHEN length(w) >= 4 THEN left(w, length(w) - 2) ELSE w END ELSE w END"


@query(f"""WITH {CAND}, {_words_sql('title', 'ka')}, {_words_sql("title || ' ' || summary", 'kb')}, m AS (SELECT kaf.seq, list_transform(list_concat(kaf.ws, kbf.ws), lambda w: {_BASE}) AS ws FROM kaf JOIN kbf USING (seq)),
d AS (SELECT seq, list_filter(ws, lambda w, i: length(w) >= 2 AND NOT list_contains(['outlook', 'trend', 'policy'], w) AND list_position(ws, w) = i) AS ws FROM m) SELECT seq, CASE WHEN len(ws) > 0 THEN array_to_string(ws[1:4], ',') ELSE 'follow-up' END AS keywords FROM d""")
def p9_keywords(spark: SparkSession, sf: str) -> DataFrame:
    """Counted within each row: no shuffle."""
    return candidates(spark, sf).select("seq", F.array_join(editorial.clean_keywords(F.col("title"), F.col("summary"), DESK), ",").alias("keywords"))


@query(f"""WITH {CAND}, t AS (SELECT chapter AS edition, seq AS id, 'fact' AS kind, 'src reports: ' || title AS text FROM c UNION ALL SELECT chapter, seq, 'background', summary FROM c)
SELECT edition, rule, id || ':' || kind AS detail FROM (SELECT *, unnest(list_filter([CASE WHEN kind = 'fact' AND regexp_matches(text, '(?:\\.{{2,}}|…+)\\s*$') AND NOT contains(text, ' writes: ') THEN 'incomplete_fact' END, CASE WHEN contains(text, '[[') OR contains(text, 'lorem') THEN 'forbidden_pattern' END,
CASE WHEN contains(lower(text), 'news.example') THEN 'relay_domain' END], lambda r: r IS NOT NULL)) AS rule FROM t)""")
def g9_editorial_texts(spark: SparkSession, sf: str) -> DataFrame:
    c = candidates(spark, sf).select(F.col("chapter").alias("edition"), F.col("seq").alias("id"), "title", "summary")
    fact = c.select("edition", "id", F.lit("fact").alias("kind"), F.concat(F.lit("src reports: "), "title").alias("text"))
    return editorial.text_faults(fact.unionByName(c.select("edition", "id", F.lit("background").alias("kind"), F.col("summary").alias("text"))), DESK)


FIRST = editorial.FirstDesk(
    told="%s on %s: %s", no_sentence="%s on %s.", no_summary="%s tells of %s.", ending=" it is said.", ends=(".", "!", "a"), background="%s See %s.", why="%s It lasts.", first_point="%s: official word", focus="([a-zA-Z]{4,})", no_focus="the matter", source="the press",
)


@query(f"""WITH {CAND}, f0 AS (SELECT seq, chapter, trim(title) AS t, trim(summary) AS s, source AS p FROM c), f1 AS (SELECT *, trim(replace(CASE WHEN t <> '' THEN trim(replace(s, t, '')) ELSE s END, p, '')) AS clean FROM f0),
f2 AS (SELECT *, list_filter(list_transform(string_split_regex(clean, '[.!?]\\s+|\\[.*?\\]'), lambda x: trim(x)), lambda x: length(x) >= 10)[1] AS core FROM f1)
SELECT seq, CASE WHEN length(s) >= 20 AND NOT starts_with(s, 'http') AND core IS NOT NULL THEN p || ' on ' || t || ': ' || core || CASE WHEN right(core, 1) IN ('.', '!', 'a') THEN '' ELSE ' it is said.' END WHEN length(s) >= 20 AND NOT starts_with(s, 'http') THEN p || ' on ' || t || '.' ELSE p || ' tells of ' || t || '.' END AS fact,
CASE WHEN chapter = 'en' THEN 'Talks go on.' ELSE 'Much is open.' END || ' See ' || p || '.' AS background, coalesce(nullif(regexp_extract(t, '([a-zA-Z]{{4,}})', 1), ''), 'the matter') || ': official word | ' || CASE WHEN chapter = 'en' THEN 'a | b' ELSE 'c | d' END AS checkpoints FROM f2""")
def p7b_first_editorial(spark: SparkSession, sf: str) -> DataFrame:
    """The superseded first form."""
    insights = spark.createDataFrame([(None, "Much is open.", "It matters.", ["c", "d", "e"]), ("en", "Talks go on.", "It counts.", ["a", "b", "z"])], "chapter string, bg string, why string, points array<string>")
    made = editorial.first_editorial(candidates(spark, sf).select("seq", "chapter", "title", "source", "summary"), insights, FIRST)
    return made.select("seq", "fact", "background", F.array_join("checkpoints", " | ").alias("checkpoints"))
