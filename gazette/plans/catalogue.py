"""All queries over the reference operators, bound to the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette.functions import lineage, text, urls
from gazette.operators import pages, select, similar
from gazette.sources import feeds, research
from gazette.sources.tables import candidates, fetch_log, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Policy terms for the driver's invented prose: frequent words of its languages stand in for topic words.
POSITIVE, NEGATIVE = ["tion", "ing", "ent", "ver", "que"], ["thing", "eine"]
TRUSTED = ["src1", "src3", "src5", "src7"]
CAND = """c AS (SELECT doc_id AS seq, lang AS chapter, source, split_part(text, chr(10), 1) AS title,
  substr(text, length(split_part(text, chr(10), 1)) + 2) AS summary, 'https://' || source || '.example.com/' || lang || '/' || doc_id AS link,
  CAST(doc_id % 240 AS INTEGER) AS age_h, text, n_chars FROM documents)"""
HOST = "nullif(regexp_replace(regexp_extract(lower(url), '^https?://([^/?#:]+)', 1), '^www\\.', ''), '')"
KEY = "regexp_replace(regexp_replace(trim(url), '[?#].*$', ''), '/+$', '')"
NORM = "trim(regexp_replace(lower({}), '[^a-z0-9가-힣]+', ' ', 'g'))"
LISTED = "[" + ", ".join(f"'{t}'" for t in POSITIVE) + "]"
LISTED_NO = "[" + ", ".join(f"'{t}'" for t in NEGATIVE) + "]"
TOKENS = "list_distinct(regexp_extract_all(lower({}), '([가-힣a-z0-9]{{2,}})', 1))"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with the SQL that gives the same rows."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- projections ---------------------------------------------------------------------------------------------------


@query(f"WITH {CAND} SELECT seq, CASE WHEN regexp_matches(title, '^.* - .{{0,20}}$') THEN regexp_extract(title, '^(.*) - (.{{0,20}})$', 1) ELSE title END AS headline, "
       "CASE WHEN regexp_matches(title, '^.* - .{0,20}$') THEN regexp_extract(title, '^(.*) - (.{0,20})$', 2) ELSE source END AS publisher FROM c")
def p1_headline_publisher(spark: SparkSession, sf: str) -> DataFrame:
    c = candidates(spark, sf)
    has = F.col("title").rlike("^.* - .{0,20}$")
    part = lambda k: F.regexp_extract("title", "^(.*) - (.{0,20})$", k)
    return c.select("seq", F.when(has, part(1)).otherwise(F.col("title")).alias("headline"), F.when(has, part(2)).otherwise(F.col("source")).alias("publisher"))


def _unescape_sql(c: str) -> str:
    """The references that occur in the driver's tables, decoded once; ``&amp`` needs no semicolon."""
    out = c
    for entity, char in (("&nbsp;?", " "), ("&lt;?", "<"), ("&gt;?", ">"), ("&quot;?", '"'), ("&#39;", "''"), ("&middot;?", "·"), ("&copy;?", "©"), ("&amp;?", "&")):
        out = f"regexp_replace({out}, '{entity}', '{char}', 'g')"
    return out


def _clean_sql(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace({_unescape_sql(c)}, '<[^>]+>', ' ', 'g'), '[ \\t\\r\\n]+', ' ', 'g'))"


@query(f"SELECT page_id, {_clean_sql('html')} AS cleaned FROM pages")
def p2_text_cleanup(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", text.clean_html(F.col("html")).alias("cleaned"))


@query(f"WITH {CAND} SELECT seq, substr(sha256(chapter || '::' || title || '::' || link), 1, 16) AS article_id FROM c")
def p3_article_identity(spark: SparkSession, sf: str) -> DataFrame:
    c = candidates(spark, sf)
    return c.select("seq", F.substring(F.sha2(F.concat_ws("::", "chapter", "title", "link"), 256), 1, 16).alias("article_id"))


@query(f"WITH {CAND} SELECT seq, chapter AS section, title, CASE WHEN age_h <= 24 THEN 'today' WHEN age_h <= 72 THEN 'three days' WHEN age_h <= 168 THEN 'this week' ELSE 'older' END AS freshness_note, "
       "CASE WHEN length(summary) > 0 THEN summary ELSE title END AS summary, CASE seq % 4 WHEN 0 THEN 'CONFIRMED' WHEN 1 THEN 'PARTIALLY CONFIRMED' WHEN 2 THEN 'DISPUTED' ELSE 'UNVERIFIED' END AS status FROM c")
def p4_story_flattening(spark: SparkSession, sf: str) -> DataFrame:
    age, k = F.col("age_h"), F.col("seq") % 4
    fresh = F.when(age <= 24, "today").when(age <= 72, "three days").when(age <= 168, "this week").otherwise("older")
    status = F.when(k == 0, "CONFIRMED").when(k == 1, "PARTIALLY CONFIRMED").when(k == 2, "DISPUTED").otherwise("UNVERIFIED")
    short = F.when(F.length("summary") > 0, F.col("summary")).otherwise(F.col("title"))
    return candidates(spark, sf).select("seq", F.col("chapter").alias("section"), "title", fresh.alias("freshness_note"), short.alias("summary"), status.alias("status"))


STUDY = (("licensed", "GUIDELINE"), ("entin", "RCT"), ("verein", "META-ANALYSIS"), ("ation", "REVIEW"))


@query("SELECT doc_id, CASE " + " ".join(f"WHEN contains(lower(text), '{w}') THEN '{k}'" for w, k in STUDY) + " ELSE 'OTHER' END AS study_type FROM documents")
def p6_study_type(spark: SparkSession, sf: str) -> DataFrame:
    low, kind = F.lower("text"), None
    for word, name in STUDY:
        kind = F.when(low.contains(word), name) if kind is None else kind.when(low.contains(word), name)
    return table(spark, sf, "documents").select("doc_id", kind.otherwise("OTHER").alias("study_type"))


KINDS_SQL = "CASE " + " ".join("WHEN " + " OR ".join(f"contains(t, '{w}')" for w in words) + f" THEN '{kind}'" for kind, words in research.KINDS) + f" ELSE '{research.OTHER_KIND}' END"


@query(f"""WITH d AS (SELECT doc_id, CASE doc_id % 10 WHEN 0 THEN 'A Randomised study. ' WHEN 1 THEN 'Meta-analysis of ' WHEN 2 THEN 'A systematic review. ' WHEN 3 THEN 'A review. ' WHEN 4 THEN 'Practice pattern. ' WHEN 5 THEN 'Preprint: ' WHEN 6 THEN 'A cohort. ' WHEN 7 THEN 'Interventional. ' ELSE '' END || text AS raw FROM documents),
k AS (SELECT doc_id, lower(raw) AS t FROM d) SELECT doc_id, {KINDS_SQL} AS kind FROM k""")
def p6_evidence_kinds(spark: SparkSession, sf: str) -> DataFrame:
    """All nine kinds: the driver's prose names none, so that beginnings by id do."""
    k = F.col("doc_id") % 10
    words = ("A Randomised study. ", "Meta-analysis of ", "A systematic review. ", "A review. ", "Practice pattern. ", "Preprint: ", "A cohort. ", "Interventional. ")
    start = F.lit("")
    for n, word in enumerate(words):
        start = F.when(k == n, word).otherwise(start)
    return table(spark, sf, "documents").select("doc_id", research.kind_of(F.concat(start, "text")).alias("kind"))


@query("""WITH w AS (SELECT chr(CAST(44032 + doc_id % 11172 AS INTEGER)) AS word, doc_id FROM documents)
SELECT doc_id, word || CASE WHEN doc_id % 11172 % 28 > 0 THEN '을' ELSE '를' END AS with_particle FROM w""")
def p11_particle(spark: SparkSession, sf: str) -> DataFrame:
    word = F.decode(F.unhex(F.format_string("%04X", (44032 + F.col("doc_id") % 11172).cast("int"))), "UTF-16BE")
    return table(spark, sf, "documents").select("doc_id", text.object_particle(word).alias("with_particle"))


@query("""SELECT event_id, CASE WHEN value >= 28 THEN 'linen' WHEN value >= 23 THEN 'short sleeves' WHEN value >= 17 THEN 'long sleeves' WHEN value >= 10 THEN 'jacket' WHEN value >= 5 THEN 'coat' ELSE 'padded coat' END
|| CASE WHEN event_id % 100 >= 50 THEN ', umbrella' ELSE '' END AS clothing FROM events WHERE value IS NOT NULL""")
def p13_weather_bands(spark: SparkSession, sf: str) -> DataFrame:
    v = F.col("value")
    band = F.when(v >= 28, "linen").when(v >= 23, "short sleeves").when(v >= 17, "long sleeves").when(v >= 10, "jacket").when(v >= 5, "coat").otherwise("padded coat")
    return table(spark, sf, "events").filter(v.isNotNull()).select("event_id", F.concat(band, F.when(F.col("event_id") % 100 >= 50, ", umbrella").otherwise("")).alias("clothing"))


# --- filters with reasons ------------------------------------------------------------------------------------------

#: The test on headlines for the driver's prose.
HEADLINES = feeds.Headlines(blacklist=("###", "|", "$$$"), bait=("[xX]{3}", "!!"), marks=(("…", 3), ("!", 2), ("?", 2)))


@query(f"""WITH {CAND} SELECT seq, CASE WHEN length(title) < 10 THEN 'short' WHEN length(title) > 120 THEN 'long' WHEN contains(title, '###') OR contains(title, '|') OR contains(title, '$$$') THEN 'blacklist' WHEN length(title) - length(replace(title, '…', '')) > 3 THEN '…'
WHEN length(title) - length(replace(title, '!', '')) > 2 THEN '!' WHEN length(title) - length(replace(title, '?', '')) > 2 THEN '?' WHEN regexp_matches(title, '[xX]{{3}}|!!') THEN 'clickbait' END AS reason FROM c""")
def f1_headline_quality(spark: SparkSession, sf: str) -> DataFrame:
    return candidates(spark, sf).select("seq", feeds.headline_reason(F.col("title"), HEADLINES).alias("reason"))


@query("""WITH e AS (SELECT event_id, (epoch(TIMESTAMP '2024-01-20 00:00:00') - epoch(ts)) / 86400.0 AS age, CASE WHEN event_type = 'purchase' THEN 7 ELSE 3 END AS most FROM events)
SELECT event_id, CASE WHEN age IS NULL THEN 'missing_date' WHEN age < -0.25 THEN 'future_date' WHEN age > most THEN 'stale' ELSE 'fresh' END AS reason FROM e""")
def f2_freshness(spark: SparkSession, sf: str) -> DataFrame:
    age = (F.unix_micros(F.lit("2024-01-20 00:00:00 UTC").cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))) / 86_400_000_000
    most = F.when(F.col("event_type") == "purchase", 7).otherwise(3)
    reason = F.when(age.isNull(), "missing_date").when(age < -0.25, "future_date").when(age > most, "stale").otherwise("fresh")
    return table(spark, sf, "events").select("event_id", reason.alias("reason"))


@query(f"""WITH {CAND}, h AS (SELECT seq, chapter, list_filter({LISTED}, lambda k: contains(lower(title), k)) AS th, list_filter({LISTED}, lambda k: contains(lower(summary), k)) AS sh,
len(list_filter({LISTED_NO}, lambda k: contains(lower(title), k))) AS neg FROM c)
SELECT seq, CASE WHEN chapter = 'en' THEN 'broad' WHEN neg > 0 AND len(th) = 0 THEN 'negative_title' WHEN len(th) >= 1 THEN 'title' WHEN len(sh) >= 2 THEN 'summary' ELSE 'no_match' END AS reason,
round(CASE WHEN chapter = 'en' THEN 1.0 WHEN neg > 0 AND len(th) = 0 THEN -1.0 WHEN len(th) >= 1 THEN least(1.0, 0.65 + 0.1 * (len(th) - 1) + 0.05 * least(len(sh), 3)) WHEN len(sh) >= 2 THEN least(0.6, 0.25 + 0.1 * len(sh)) ELSE 0.0 END, 4) AS relevance,
len(th) AS title_hits, len(sh) AS summary_hits FROM h""")
def f3_chapter_relevance(spark: SparkSession, sf: str) -> DataFrame:
    return relevance(candidates(spark, sf), "seq").select("seq", "reason", F.round("relevance", 4).alias("relevance"), F.col("title_hits").cast("long").alias("title_hits"), F.col("summary_hits").cast("long").alias("summary_hits"))


def relevance(c: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` with reason, relevance, title_hits, summary_hits: how candidates belong to their chapter. Terms are looked for once, in lower-case texts."""
    hits = lambda terms, low: sum((F.contains(low, F.lit(k)).cast("int") for k in terms), F.lit(0))
    low = c.withColumns({"__t": F.lower("title"), "__s": F.lower("summary")})
    h = low.select(*c.columns, hits(POSITIVE, F.col("__t")).alias("t"), hits(POSITIVE, F.col("__s")).alias("s"), hits(NEGATIVE, F.col("__t")).alias("neg"))
    broad, no, title, summary = F.col("chapter") == "en", (F.col("neg") > 0) & (F.col("t") == 0), F.col("t") >= 1, F.col("s") >= 2
    reason = F.when(broad, "broad").when(no, "negative_title").when(title, "title").when(summary, "summary").otherwise("no_match")
    score = F.when(broad, 1.0).when(no, -1.0).when(title, F.least(F.lit(1.0), 0.65 + 0.1 * (F.col("t") - 1) + 0.05 * F.least("s", F.lit(3)))).when(summary, F.least(F.lit(0.6), 0.25 + 0.1 * F.col("s"))).otherwise(0.0)
    return h.select(*keep, reason.alias("reason"), score.alias("relevance"), F.col("t").alias("title_hits"), F.col("s").alias("summary_hits"))


URL_REASON = """CASE WHEN url IS NULL OR NOT regexp_matches(url, '^https?://[^/?#]+') THEN 'bad_url'
WHEN regexp_replace(regexp_extract(url, '^https?://[^/?#]+(/[^?#]*)', 1), '/+$', '') IN ('', '/news', '/world', '/business', '/technology', '/research-highlights') THEN 'generic_url'
WHEN regexp_matches(url, '\\?$') OR regexp_matches(url, '[?&](id|article|story)=?$') THEN 'incomplete_url' END"""


@query(f"""SELECT page_id, {HOST} AS domain, {KEY} AS canonical_key, coalesce({URL_REASON}, CASE WHEN regexp_matches(lower(url), '^https?://[^/?#]*example\\.net([/?#]|$)') AND regexp_matches(url, '^https?://[^/?#]+/[^?#]*/([?#]|$)') AND NOT regexp_matches(url, '[?&]page=[^&#]') THEN 'incomplete_url' END) AS reason FROM pages""")
def f5_url_validity(spark: SparkSession, sf: str) -> DataFrame:
    u = F.col("url")
    return table(spark, sf, "pages").select("page_id", urls.domain(u).alias("domain"), urls.canonical_key(u).alias("canonical_key"), urls.reject_reason(u, sites=(("example.net", "/", "page"),)).alias("reason"))


@query(f"WITH {CAND}, n AS (SELECT seq, ' ' || {NORM.format('text')} || ' ' AS padded FROM c), h AS (SELECT seq, list_filter(['and', 'der', 'que', 'entin'], lambda t: contains(padded, ' ' || t || ' ')) AS hits FROM n) SELECT seq, array_to_string(hits, ',') AS topics FROM h WHERE len(hits) > 0")
def f7_topic_relevance(spark: SparkSession, sf: str) -> DataFrame:
    n = lineage.once(candidates(spark, sf).select("seq", "text"), {"text": text.norm_title(F.col("text"))})
    h = lineage.once(n, {"hits": text.term_hits(F.col("text"), ["and", "der", "que", "entin"])})
    return h.filter(F.size("hits") > 0).select("seq", F.array_join("hits", ",").alias("topics"))


@query("""SELECT doc_id, CASE WHEN regexp_matches(lower(text), 'lorem|placeholder|todo') THEN 'placeholder' END AS reason, regexp_matches(text, '[가-힣]') AS has_hangul, regexp_matches(text, '!!|###') AS noisy FROM documents""")
def f12_placeholder_and_script(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("text")
    return table(spark, sf, "documents").select("doc_id", F.when(F.lower(t).rlike("lorem|placeholder|todo"), "placeholder").alias("reason"), t.rlike("[가-힣]").alias("has_hangul"), t.rlike("!!|###").alias("noisy"))


# --- scores --------------------------------------------------------------------------------------------------------

IMPORTANCE = """5.0 + CASE WHEN source IN ('src1', 'src3', 'src5', 'src7') THEN 2 ELSE 0 END + CASE WHEN length(title) BETWEEN 25 AND 70 THEN 1.5 WHEN length(title) < 20 THEN -1 ELSE 0 END
+ CASE WHEN length(summary) >= 60 THEN 1 ELSE 0 END + CASE WHEN regexp_matches(title, '[%0-9]') THEN 1 ELSE 0 END + CASE WHEN age_h <= 24 THEN 2 WHEN age_h <= 48 THEN 1 WHEN age_h <= 72 THEN 0.25 ELSE 0 END"""


def importance() -> F.Column:
    size = F.length("title")
    return (
        F.lit(5.0) + F.when(F.col("source").isin(TRUSTED), 2).otherwise(0) + F.when(size.between(25, 70), 1.5).when(size < 20, -1).otherwise(0) + F.when(F.length("summary") >= 60, 1).otherwise(0)
        + F.when(F.col("title").rlike("[%0-9]"), 1).otherwise(0) + F.when(F.col("age_h") <= 24, 2).when(F.col("age_h") <= 48, 1).when(F.col("age_h") <= 72, 0.25).otherwise(0)
    ).cast("double")


@query(f"WITH {CAND} SELECT seq, CAST({IMPORTANCE} AS DOUBLE) AS importance FROM c")
def c1_importance(spark: SparkSession, sf: str) -> DataFrame:
    return candidates(spark, sf).select("seq", importance().alias("importance"))


@query("""SELECT event_id, round(10 * greatest(0, 1 - (epoch(TIMESTAMP '2024-01-30 00:00:00') - epoch(ts)) / 864000.0) + greatest(0, 4 - user_id % 5), 6) AS score FROM events WHERE ts IS NOT NULL""")
def c5_video_score(spark: SparkSession, sf: str) -> DataFrame:
    age = (F.unix_micros(F.lit("2024-01-30 00:00:00 UTC").cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))) / 1_000_000
    score = 10 * F.greatest(F.lit(0), 1 - age / 864000) + F.greatest(F.lit(0), 4 - F.col("user_id") % 5)
    return table(spark, sf, "events").filter("ts IS NOT NULL").select("event_id", F.round(score, 6).alias("score"))


# --- dedupe, aggregation -------------------------------------------------------------------------------------------


@query("""WITH RECURSIVE c AS (SELECT lang AS chapter, doc_id AS seq, n_chars // 40 AS url, split_part(text, chr(10), 1) AS title, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rk FROM documents),
r AS (SELECT chapter, 0::BIGINT AS rk, []::BIGINT[] AS urls, []::VARCHAR[] AS titles, NULL::BIGINT AS kept FROM (SELECT DISTINCT chapter FROM c)
UNION ALL SELECT r.chapter, c.rk, CASE WHEN list_contains(urls, c.url) OR list_contains(titles, c.title) THEN urls ELSE list_append(urls, c.url) END,
CASE WHEN list_contains(urls, c.url) OR list_contains(titles, c.title) THEN titles ELSE list_append(titles, c.title) END,
CASE WHEN list_contains(urls, c.url) OR list_contains(titles, c.title) THEN NULL ELSE c.seq END FROM r JOIN c ON r.chapter = c.chapter AND c.rk = r.rk + 1)
SELECT chapter, kept AS seq FROM r WHERE kept IS NOT NULL""")
def d2_keep_first_either(spark: SparkSession, sf: str) -> DataFrame:
    c = candidates(spark, sf).select("chapter", "seq", F.floor(F.col("n_chars") / 40).alias("url"), "title")
    return select.keep_first_either(c, "chapter", "url", "title", "seq").select("chapter", "seq")


@query("SELECT user_id, arg_min(event_id, (CASE WHEN event_type = 'purchase' THEN 0 ELSE 1 END, event_id)) AS event_id FROM events GROUP BY user_id")
def d3_live_first(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("user_id", "event_id", F.when(F.col("event_type") == "purchase", 0).otherwise(1).alias("late"))
    return e.groupBy("user_id").agg(F.min_by("event_id", F.struct("late", "event_id")).alias("event_id"))


@query(f"WITH {CAND} SELECT chapter, count(*) AS candidates, count(*) FILTER (age_h <= 72) AS dated, count(DISTINCT source) AS publishers, count(*) >= 30 AS target_met FROM c GROUP BY chapter")
def a1_chapter_report(spark: SparkSession, sf: str) -> DataFrame:
    g = candidates(spark, sf).groupBy("chapter")
    return g.agg(F.count(F.lit(1)).alias("candidates"), F.count_if(F.col("age_h") <= 72).alias("dated"), F.count_distinct("source").alias("publishers"), (F.count(F.lit(1)) >= 30).alias("target_met"))


@query(f"""WITH {CAND}, q AS (SELECT chapter, CASE WHEN length(title) < 10 THEN 'short' WHEN length(title) > 120 THEN 'long' WHEN age_h > 72 THEN 'stale' ELSE 'kept' END AS reason FROM c)
SELECT chapter, reason, count(*) AS n FROM q GROUP BY ALL""")
def a2_reject_counts(spark: SparkSession, sf: str) -> DataFrame:
    reason = F.when(F.length("title") < 10, "short").when(F.length("title") > 120, "long").when(F.col("age_h") > 72, "stale").otherwise("kept")
    return candidates(spark, sf).groupBy("chapter", reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {CAND}, d AS (SELECT chapter, source, count(*) AS n FROM c GROUP BY ALL)
SELECT chapter, CAST(sum(n) AS BIGINT) AS articles, count(*) AS domains, round(max(n) / sum(n), 6) AS top_share, round(coalesce(sum(n) FILTER (source IN ('src1', 'src3', 'src5', 'src7')), 0) / sum(n), 6) AS wire_share FROM d GROUP BY chapter""")
def a3_domain_share(spark: SparkSession, sf: str) -> DataFrame:
    d = candidates(spark, sf).groupBy("chapter", "source").agg(F.count(F.lit(1)).alias("n"))
    wire = F.coalesce(F.sum(F.when(F.col("source").isin(TRUSTED), F.col("n"))), F.lit(0))
    return d.groupBy("chapter").agg(F.sum("n").alias("articles"), F.count(F.lit(1)).alias("domains"), F.round(F.max("n") / F.sum("n"), 6).alias("top_share"), F.round(wire / F.sum("n"), 6).alias("wire_share"))


@query("""WITH p AS (SELECT lang AS chapter, toxic = 1 AS truth, (length(text) % 7 = 0) AS said FROM documents JOIN labels USING (doc_id)),
m AS (SELECT chapter, count(*) FILTER (truth AND said) AS tp, count(*) FILTER (NOT truth AND said) AS fp, count(*) FILTER (truth AND NOT said) AS fn FROM p GROUP BY chapter)
SELECT chapter, tp, fp, fn, round(CASE WHEN tp + fp = 0 THEN 1.0 ELSE tp / (tp + fp) END, 6) AS precision, round(CASE WHEN tp + fn = 0 THEN 1.0 ELSE tp / (tp + fn) END, 6) AS recall FROM m""")
def a4_gold_metrics(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(F.col("lang").alias("chapter"), (F.col("toxic") == 1).alias("truth"), (F.length("text") % 7 == 0).alias("said"))
    t, s = F.col("truth"), F.col("said")
    m = p.groupBy("chapter").agg(F.count_if(t & s).alias("tp"), F.count_if(~t & s).alias("fp"), F.count_if(t & ~s).alias("fn"))
    rate = lambda a, b: F.round(F.when(a + b == 0, 1.0).otherwise(a / (a + b)), 6)
    return m.select("*", rate(F.col("tp"), F.col("fp")).alias("precision"), rate(F.col("tp"), F.col("fn")).alias("recall"))


@query("SELECT n_name AS registry, count(*) AS sources, count(DISTINCT s_name) AS names, count(*) - count(DISTINCT s_suppkey) AS duplicate_ids FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name")
def a6_registry_counts(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    n = F.count(F.lit(1))
    return s.groupBy(F.col("n_name").alias("registry")).agg(n.alias("sources"), F.count_distinct("s_name").alias("names"), (n - F.count_distinct("s_suppkey")).alias("duplicate_ids"))


# --- selection -----------------------------------------------------------------------------------------------------


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    c = candidates(spark, sf).select("seq", "chapter", "source", "title", importance().alias("score"), text.title_tokens(F.col("title")).alias("tokens"))
    return c.withColumn("turn", -F.col("seq"))


#: Days that news of a chapter stays fresh, if not three.
LONG_FRESH = {"es": 7}
TITLE_WORDS = "regexp_extract_all({}, '([가-힣a-zA-Z0-9]{{2,}})', 1)"


def title_tokens_sql(c: str) -> str:
    return f"list_transform([{TITLE_WORDS.format(c)}], lambda w: list_distinct(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || '_' || w[i + 1]))))[1]"


RELEVANT = f"""{CAND}, rh AS (SELECT seq, list_filter({LISTED}, lambda k: contains(lower(title), k)) AS th, list_filter({LISTED}, lambda k: contains(lower(summary), k)) AS sh, len(list_filter({LISTED_NO}, lambda k: contains(lower(title), k))) AS neg, chapter FROM c),
rel AS (SELECT seq, CASE WHEN chapter = 'en' THEN 1.0 WHEN neg > 0 AND len(th) = 0 THEN NULL WHEN len(th) >= 1 THEN round(least(1.0, 0.65 + 0.1 * (len(th) - 1) + 0.05 * least(len(sh), 3)), 3) WHEN len(sh) >= 2 THEN round(least(0.6, 0.25 + 0.1 * len(sh)), 3) END AS relevance FROM rh),
fit AS (SELECT c.seq, chapter, source, title, CAST(round(CAST({IMPORTANCE} AS DOUBLE), 2) + relevance AS DOUBLE) AS score FROM c JOIN rel USING (seq) WHERE relevance IS NOT NULL AND age_h / 24.0 BETWEEN -0.25 AND CASE WHEN chapter = 'es' THEN 7 ELSE 3 END)"""


def eligible(spark: SparkSession, sf: str) -> DataFrame:
    """seq, chapter, source, title, score, turn: fresh candidates that belong to their chapter; the score is importance with relevance."""
    most = F.lit(3)
    for chapter, days in LONG_FRESH.items():
        most = F.when(F.col("chapter") == chapter, days).otherwise(most)
    c = candidates(spark, sf).filter((F.col("age_h") / 24).between(-0.25, most)).select("seq", "chapter", "source", "title", "summary", importance().alias("importance"))
    fit = relevance(c, "seq", "chapter", "source", "title", "importance").filter("reason IN ('broad', 'title', 'summary')")
    return fit.select("seq", "chapter", "source", "title", (F.round("importance", 2) + F.round("relevance", 3)).alias("score"), (-F.col("seq")).alias("turn"))


def alike(a: Column, b: Column) -> Column:
    """Token sets of two titles too near each other to stand in one chapter."""
    return text.jaccard(a, b) >= 0.45


ALIKE_SQL = "len(list_distinct(list_concat(g.tokens, o.tokens))) > 0 AND len(list_intersect(g.tokens, o.tokens)) / len(list_distinct(list_concat(g.tokens, o.tokens))) >= 0.45"


@query(f"""WITH RECURSIVE {RELEVANT}, s AS (SELECT seq, chapter, source, score, {title_tokens_sql('title')} AS tokens FROM fit),
o AS (SELECT *, row_number() OVER (PARTITION BY chapter ORDER BY score DESC, seq) AS rk FROM s),
r AS (SELECT chapter, 0::BIGINT AS rk, []::STRUCT(seq BIGINT, source VARCHAR, score DOUBLE, tokens VARCHAR[])[] AS got FROM (SELECT DISTINCT chapter FROM o)
UNION ALL SELECT r.chapter, o.rk, CASE WHEN len(got) < 10 AND len(list_filter(got, lambda g: g.source = o.source)) < 2 AND len(list_filter(got, lambda g: {ALIKE_SQL})) = 0
THEN list_append(got, {{'seq': o.seq, 'source': o.source, 'score': o.score, 'tokens': o.tokens}}) ELSE got END FROM r JOIN o ON r.chapter = o.chapter AND o.rk = r.rk + 1),
l AS (SELECT chapter, arg_max(got, rk) AS got FROM r GROUP BY chapter), u AS (SELECT chapter, unnest(got) AS g, generate_subscripts(got, 1) AS pick FROM l)
SELECT chapter, CAST(pick AS INTEGER) AS pick, g.seq AS seq, g.source AS source, round(g.score, 3) AS score FROM u WHERE chapter IN (SELECT chapter FROM l WHERE len(got) < 10 OR len(list_distinct(list_transform(got, lambda g: g.source))) >= 5)""")
def w1_diverse_top_k(spark: SparkSession, sf: str) -> DataFrame:
    """Fresh and relevant candidates of each chapter, best first: two of a publisher, no two alike, ten; ten of fewer than five publishers are none."""
    pool = eligible(spark, sf).withColumn("tokens", text.title_tokens(F.col("title"))).drop("title")
    got = select.greedy_select(pool, ["chapter"], ["score", "turn"], 10, {"source": 2}, likeness=alike, hashed=True)
    full = got.groupBy("chapter").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("source").alias("publishers")).filter("n < 10 OR publishers >= 5").select("chapter")
    return got.join(full, "chapter", "left_semi").select("chapter", "pick", "seq", "source", F.round("score", 3).alias("score"))


@query(f"""WITH {CAND}, s AS (SELECT seq, chapter, source, CAST({IMPORTANCE} AS DOUBLE) AS score FROM c), a AS (SELECT *, row_number() OVER (PARTITION BY chapter ORDER BY score DESC, seq) AS r FROM s),
b AS (SELECT *, row_number() OVER (ORDER BY (r > 1), score DESC, seq) AS rank FROM a) SELECT seq, chapter, score, CAST(rank AS INTEGER) AS rank FROM b WHERE rank <= 5""")
def w5_top5(spark: SparkSession, sf: str) -> DataFrame:
    return select.one_each_then_fill(_scored(spark, sf).select("seq", "chapter", "score"), [], "chapter", 5, [F.desc("score"), F.asc("seq")])


@query("""WITH a AS (SELECT event_id, event_type, user_id, ts, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id) AS r FROM events),
b AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) AS rank FROM a WHERE r <= 3) SELECT event_type, event_id, user_id, CAST(rank AS INTEGER) AS rank FROM b WHERE rank <= 10""")
def w8_video_select(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", "event_type", "user_id", "ts")
    return select.capped_top(e, ["event_type"], "user_id", 3, 10, [F.desc("ts"), F.asc("event_id")]).select("event_type", "event_id", "user_id", "rank")


# --- joins ---------------------------------------------------------------------------------------------------------

STOP = ["the", "and", "of", "to", "in", "der", "die", "la", "le", "de", "que"]
STOPPED = "[" + ", ".join(f"'{w}'" for w in STOP) + "]"
INFORMATIVE = f"list_distinct(list_filter(regexp_extract_all(lower({{}}), '([가-힣a-z0-9]{{{{2,}}}})', 1), lambda w: NOT list_contains({STOPPED}, w) AND NOT regexp_matches(w, '^[0-9]+$')))"


EVENT_PAIRS = f"""{CAND}, jl AS (SELECT seq AS id, source, {INFORMATIVE.format('title')} AS t FROM c), jr AS (SELECT item_id AS id, 'src' || item_id % 20 AS source, {INFORMATIVE.format('text')} AS t FROM benchmark),
jp AS (SELECT jl.id AS l, jr.id AS r, len(list_intersect(jl.t, jr.t)) AS k, len(jl.t) AS a, len(jr.t) AS b FROM jl JOIN jr ON jl.source <> jr.source),
je AS (SELECT l, r, round_even(2 * round_even(k / (a + b - k), 3) + round_even(k / least(a, b), 3) + 0.05 * k, 4) AS score FROM jp WHERE k >= 2 AND (k / (a + b - k) >= 0.25 OR k / least(a, b) >= 0.5)),
jk AS (SELECT *, row_number() OVER (PARTITION BY l ORDER BY score DESC, r) AS rank FROM je)"""


def event_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Documents by their headlines, and the passages of the benchmark as a pool of other publishers: id, link, source, tokens."""
    left = candidates(spark, sf).select(F.col("seq").alias("id"), "link", "source", text.informative_tokens(F.col("title"), STOP).alias("tokens"))
    b, k = table(spark, sf, "benchmark"), F.col("item_id")
    right = b.select(k.alias("id"), F.concat(F.lit("https://bench.example.org/"), k.cast("string")).alias("link"), F.concat(F.lit("src"), (k % 20).cast("string")).alias("source"), text.informative_tokens(F.col("text"), STOP).alias("tokens"))
    return left, right


@query(f"WITH {EVENT_PAIRS} SELECT l AS doc_id, r AS item_id, score, CAST(rank AS INTEGER) AS rank FROM jk WHERE rank <= 3")
def j1_same_event(spark: SparkSession, sf: str) -> DataFrame:
    return similar.corroborating(*event_sides(spark, sf)).select(F.col("l").alias("doc_id"), F.col("r").alias("item_id"), "score", "rank")


@query(f"""WITH p AS (SELECT page_id, {HOST} AS domain FROM pages) SELECT page_id, domain, CASE WHEN domain IS NULL THEN 'none' WHEN domain = 'example.org' OR domain LIKE '%.example.org' THEN 'official' WHEN domain = 'example.com' OR domain LIKE '%.example.com' THEN 'primary' ELSE 'other' END AS kind FROM p""")
def j8_domain_suffix(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "pages").select("page_id", urls.domain(F.col("url")).alias("domain"))
    lists = spark.createDataFrame([("example.org", 0, "official"), ("example.com", 1, "primary")], "suffix string, turn int, kind string")
    met = p.select("page_id", F.explode(urls.suffixes(F.col("domain"))).alias("suffix")).join(F.broadcast(lists), "suffix").groupBy("page_id").agg(F.min_by("kind", "turn").alias("kind"))
    return p.join(met, "page_id", "left").select("page_id", "domain", F.when(F.col("domain").isNull(), "none").otherwise(F.coalesce("kind", F.lit("other"))).alias("kind"))


@query("SELECT o_orderkey AS key, 'no lines' AS problem FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) UNION ALL SELECT DISTINCT l_orderkey, 'no order' FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def j6_set_equality(spark: SparkSession, sf: str) -> DataFrame:
    """Both sides in one grouping by key: no sort of either side, and one hash table of keys in a task."""
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("key"), F.lit(1).alias("o"), F.lit(0).alias("l"))
    sides = o.unionByName(table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("key"), F.lit(0).alias("o"), F.lit(1).alias("l")))
    n = sides.groupBy("key").agg(F.sum("o").alias("orders"), F.max("l").alias("l")).filter("key IS NOT NULL AND (orders = 0 OR l = 0)")
    told = F.when(F.col("orders") > 0, F.array_repeat(F.lit("no lines"), F.col("orders").cast("int"))).otherwise(F.array(F.lit("no order")))
    return n.select("key", F.explode(told).alias("problem"))


SITE_CHAPTER = "CASE page_id % 3 WHEN 0 THEN 'company' WHEN 1 THEN 'economy' ELSE 'international' END"


@query(f"""WITH p AS (SELECT page_id, regexp_extract({KEY}, '^https?://[^/]+', 0) AS grp, {SITE_CHAPTER} AS chapter, ' ' || {NORM.format("regexp_extract(html, '<title>([^<]*)</title>', 1)")} || ' ' AS title FROM pages),
g AS (SELECT grp, count(DISTINCT chapter) AS n, count(*) AS rows_in, bool_or(chapter = 'company') AS co, bool_or(chapter = 'economy') AS ec, bool_or(chapter = 'international') AS world, bool_or(contains(title, ' tionth ') OR contains(title, ' onth ')) AS coterm, bool_or(contains(title, ' er ') OR contains(title, ' of ')) AS ecterm, arg_min(chapter, page_id) AS first FROM p GROUP BY grp),
w AS (SELECT *, CASE WHEN co AND coterm THEN 'company' WHEN world AND ec THEN CASE WHEN ecterm THEN 'economy' ELSE 'international' END ELSE first END AS winner FROM g),
k AS (SELECT p.grp, min(page_id) AS keeper FROM p JOIN w ON p.grp = w.grp AND p.chapter = w.winner GROUP BY p.grp)
SELECT p.page_id, p.grp, p.chapter, n AS chapters, CASE WHEN n > 1 THEN winner END AS winner, n = 1 OR page_id = keeper AS kept FROM p JOIN w USING (grp) JOIN k USING (grp)""")
def j11_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """Sites stand for addresses, so that there are conflicts."""
    k = F.col("page_id") % 3
    chapter = F.when(k == 0, "company").when(k == 1, "economy").otherwise("international")
    q = table(spark, sf, "pages").select("page_id", F.regexp_extract(urls.canonical_key(F.col("url")), "^https?://[^/]+", 0).alias("grp"), chapter.alias("chapter"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"))
    return select.arbitrate(q, "grp", "chapter", "title", "page_id", {"company": ["tionth", "onth"], "economy": ["er", "of"]}).select("page_id", "grp", "chapter", "chapters", "winner", "kept")


# --- evidence, pages -----------------------------------------------------------------------------------------------

LOG = f"f AS (SELECT page_id, url, {HOST} AS domain, html, CASE WHEN page_id % 11 = 0 THEN 404 WHEN page_id % 13 = 0 THEN 500 ELSE 200 END AS http_status, CASE WHEN page_id % 17 = 0 THEN 'application/pdf' ELSE 'text/html' END AS content_type FROM pages)"


@query(f"""WITH {LOG} SELECT page_id, CASE WHEN domain IS NULL THEN 'INVALID_URL' WHEN http_status <> 200 THEN 'HTTP_' || http_status WHEN content_type <> 'text/html' THEN 'NON_HTML' WHEN regexp_extract(html, '<title>([^<]*)</title>', 1) = '' THEN 'TITLE_MISSING' ELSE 'VERIFIED' END AS status,
regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM f""")
def s5_article_verification(spark: SparkSession, sf: str) -> DataFrame:
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    status = F.when(F.col("domain").isNull(), "INVALID_URL").when(F.col("http_status") != 200, F.concat(F.lit("HTTP_"), F.col("http_status").cast("string"))).when(F.col("content_type") != "text/html", "NON_HTML").when(title == "", "TITLE_MISSING").otherwise("VERIFIED")
    return fetch_log(spark, sf).select("page_id", status.alias("status"), title.alias("title"))


@query(f"""WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)">[^<]*</a', 1)) AS href, unnest(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a', 1)) AS label, generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)">[^<]*</a', 1), 1) AS pos, regexp_extract(url, '^https?://[^/]+', 0) AS base FROM pages),
k AS (SELECT page_id, base || href AS link, min(pos) AS pos FROM a WHERE length({_clean_sql('label')}) >= 4 AND href LIKE '/%' AND base || href <> url GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS rank FROM k)
SELECT page_id, link, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 15""")
def s3_link_discovery(spark: SparkSession, sf: str) -> DataFrame:
    """Labels of four characters count here: the driver's links are short."""
    return pages.discover_links(table(spark, sf, "pages"), "page_id", ["/"], 15, 4).select("page_id", "link", "rank")


@query("""WITH h AS (SELECT doc_id, sha256(text) AS hash FROM documents) SELECT doc_id, hash, CASE WHEN row_number() OVER (PARTITION BY hash ORDER BY doc_id) = 1 THEN 'VERIFIED' ELSE 'DUPLICATE_IMAGE' END AS status FROM h""")
def e4_duplicate_images(spark: SparkSession, sf: str) -> DataFrame:
    h = table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("hash"))
    first = h.groupBy("hash").agg(F.min("doc_id").alias("first"))  # aggregated before the shuffle: one image may be most rows
    return h.join(first, "hash").select("doc_id", "hash", F.when(F.col("doc_id") == F.col("first"), "VERIFIED").otherwise("DUPLICATE_IMAGE").alias("status"))


@query("""SELECT event_type AS provider, count(*) AS attempts, count(*) FILTER (value >= 10) AS good, CASE WHEN count(*) FILTER (value >= 10) = count(*) THEN 'HEALTHY' WHEN count(*) FILTER (value >= 10) > 0 THEN 'DEGRADED' ELSE 'UNAVAILABLE' END AS health FROM events GROUP BY event_type""")
def e5_source_health(spark: SparkSession, sf: str) -> DataFrame:
    n, good = F.count(F.lit(1)), F.count_if(F.col("value") >= 10)
    return table(spark, sf, "events").groupBy(F.col("event_type").alias("provider")).agg(n.alias("attempts"), good.alias("good"), F.when(good == n, "HEALTHY").when(good > 0, "DEGRADED").otherwise("UNAVAILABLE").alias("health"))


# --- gates, fingerprints, sinks ------------------------------------------------------------------------------------


@query(f"""WITH {CAND} SELECT chapter AS edition, 'min_articles' AS rule, CAST(count(*) AS VARCHAR) AS detail FROM c GROUP BY chapter HAVING count(*) < 150
UNION ALL SELECT chapter, 'unique_title', title FROM c GROUP BY chapter, title HAVING count(*) > 1 UNION ALL SELECT chapter, 'short_body', CAST(seq AS VARCHAR) FROM c WHERE length(text) < 10""")
def g1_edition_gate(spark: SparkSession, sf: str) -> DataFrame:
    c = candidates(spark, sf).select(F.col("chapter").alias("edition"), "title", "seq", F.length("text").alias("n"))
    few = c.groupBy("edition").count().filter("count < 150").select("edition", F.lit("min_articles").alias("rule"), F.col("count").cast("string").alias("detail"))
    same = c.groupBy("edition", "title").count().filter("count > 1").select("edition", F.lit("unique_title").alias("rule"), F.col("title").alias("detail"))
    short = c.filter("n < 10").select("edition", F.lit("short_body").alias("rule"), F.col("seq").cast("string").alias("detail"))
    return few.unionByName(same).unionByName(short)


@query("""WITH l AS (SELECT o_orderstatus AS edition, o_orderkey // 1000 AS run, o_orderkey AS pos, o_orderkey || '|' || o_custkey AS line FROM orders), r AS (SELECT edition, run, sha256(string_agg(line, chr(10) ORDER BY pos)) AS d FROM l GROUP BY ALL),
g AS (SELECT edition, run // 1000 AS run, sha256(string_agg(d, chr(10) ORDER BY run)) AS d FROM r GROUP BY edition, run // 1000) SELECT edition, sha256(string_agg(d, chr(10) ORDER BY run)) AS fingerprint FROM g GROUP BY edition""")
def h1_ordered_fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    """Orders are no bounded selection, so that lines are digested in runs of 1,000 keys, these in runs of 1,000, and those together: no group holds more."""
    o = table(spark, sf, "orders").select(F.col("o_orderstatus").alias("edition"), F.col("o_orderkey").alias("pos"), F.concat_ws("|", "o_orderkey", "o_custkey").alias("line"))
    digest = lambda df, by, line: df.groupBy(*by).agg(F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", F.col(line).alias("line")))), lambda x: x.line), "\n"), 256).alias("d"))
    runs = digest(o.withColumn("run", F.floor(F.col("pos") / 1000)), ["edition", "run"], "line")
    runs = digest(runs.select("edition", F.floor(F.col("run") / 1000).alias("up"), F.col("run").alias("pos"), "d"), ["edition", "up"], "d")
    return digest(runs.select("edition", F.col("up").alias("pos"), "d"), ["edition"], "d").select("edition", F.col("d").alias("fingerprint"))


@query("""WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS k FROM documents) SELECT lang AS edition, CAST(k // 30 AS BIGINT) AS bundle, count(*) AS stories, min(doc_id) AS first, max(doc_id) AS last FROM r WHERE k < 150 GROUP BY ALL""")
def s16_story_bundles(spark: SparkSession, sf: str) -> DataFrame:
    r = first_stories(spark, sf)
    return r.groupBy(F.col("lang").alias("edition"), F.floor((F.col("k") - 1) / 30).alias("bundle")).agg(F.count(F.lit(1)).alias("stories"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))


def first_stories(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, lang, source, k: the first 150 documents of each language. The limit stands on the rank itself, so that partitions cut to it before the shuffle."""
    return table(spark, sf, "documents").select("doc_id", "lang", "source", F.row_number().over(Window.partitionBy("lang").orderBy("doc_id")).alias("k")).filter("k <= 150")


@query("SELECT user_id, event_type, min(ts) AS first_seen, count(*) AS seen FROM events GROUP BY ALL")
def u3_distinct_in_order(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.min("ts").alias("first_seen"), F.count(F.lit(1)).alias("seen"))


def _all() -> None:
    from gazette.plans import audits, choosing, desk, editions, evidence, intake_plans, media, providers, readers, reports, rules  # noqa: F401  (each registers its queries)


def queries() -> dict[str, Query]:
    _all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _all()
    return dict(ORACLES)
