"""Filters with reasons, scores, and the row-level derivations that need more than one source."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette.functions import lineage, text, urls
from gazette.operators import ladder, similar
from gazette.plans.catalogue import CAND, EVENT_PAIRS, HOST, INFORMATIVE, NORM, STOP, STUDY, URL_REASON, event_sides, query
from gazette.sources.tables import candidates, table

#: Policy of the driver's chapters: days that news stays fresh, topic words.
POLICY = [("en", 3, ["the", "that", "for", "was"]), ("fr", 7, ["les", "que", "pour", "dans"]), ("de", 7, ["der", "und", "nicht", "ein"]), ("es", 7, ["los", "que", "para", "con"])]
POLICY_SCHEMA = "chapter string, most int, keywords array<string>"


def _rule(place: int, reason: str, chapter: str | None, *tests: tuple[str, str, list[str], bool], least: int | None = None, most: int | None = None) -> dict:
    return {"place": place, "reason": reason, "chapter": chapter, "least_tier": least, "most_tier": most, "tests": [{"field": f, "how": h, "terms": t, "present": p} for f, h, t, p in tests]}


#: Of each chapter excluded topics and relevance; then the rules that only one chapter has (en stands for foreign affairs, fr for the economy, de for companies).
REJECTS = [
    _rule(1, "excluded_topic", "en", ("text", "words", ["thanea", "sports news"], True)), _rule(1, "excluded_topic", "fr", ("text", "words", ["eauoué", "enmentai"], True)), _rule(1, "excluded_topic", "es", ("text", "words", ["lo"], True)),
    *[_rule(2, "low_relevance", chapter, ("text", "words", words, False)) for chapter, _, words in POLICY],
    _rule(3, "macro_wrong_chapter", "en", ("title", "words", ["of", "by"], True), ("title", "words", ["and", "that"], False)),
    _rule(4, "public_safety_wrong_chapter", "en", ("title", "words", ["in", "with"], True), ("title", "words", ["and", "is", "to"], False)),
    _rule(5, "low_impact_feature", "en", ("title", "words", ["was", "as"], True), ("title", "words", ["and", "that"], False)),
    _rule(6, "weak_macro_signal", "fr", ("title", "words", ["la", "le", "et"], False), least=2), _rule(7, "low_impact_primary_update", "fr", ("title", "words", ["du", "une"], True), most=1),
    _rule(8, "weak_company_signal", "de", ("title", "words", ["der", "die", "und"], False), least=2), _rule(9, "low_impact_primary_update", "de", ("title", "words", ["in", "von"], True), most=1),
]
PADDED = "' ' || " + NORM + " || ' '"


def _list(xs: list[str]) -> str:
    return "[" + ", ".join(f"'{x}'" for x in xs) + "]"


def _test_sql(t: dict, columns: dict[str, str]) -> str:
    seen = columns[f"{t['how']}_{t['field']}"]
    if t["how"] == "words":
        found = " OR ".join(f"contains({seen}, ' ' || {NORM.format(repr(x))} || ' ')" for x in t["terms"])
    elif t["how"] == "segments":
        found = f"len(list_intersect({seen}, {_list(t['terms'])})) > 0"
    elif t["how"] == "years_before":
        found = f"coalesce(list_min({seen}) <= list_max({columns['published']}) - {t['terms'][0]}, false)"
    else:
        found = " OR ".join(f"{'starts_with' if t['how'] == 'starts' else 'contains'}({seen}, '{x}')" for x in t["terms"])
    return f"({found})" if t["present"] else f"NOT ({found})"


def ladder_sql(rules: list[dict], columns: dict[str, str]) -> str:
    """The rules as branches of a CASE, over columns named by way and field."""
    rows = []
    for r in rules:
        cond = [f"chapter = '{r['chapter']}'"] if r["chapter"] else []
        cond += [f"tier >= {r['least_tier']}"] if r["least_tier"] is not None else []
        cond += [f"tier <= {r['most_tier']}"] if r["most_tier"] is not None else []
        rows.append(f"WHEN {' AND '.join(cond + [_test_sql(t, columns) for t in r['tests']])} THEN '{r['reason']}'")
    return " ".join(rows)


POLICY_SQL = "pol AS (SELECT * FROM (VALUES " + ", ".join(f"('{c}', {m}, {_list(k)})" for c, m, k in POLICY) + ") v(chapter, most, keywords))"
LINK_SQL = "CASE WHEN seq % 31 = 5 THEN link || '?id=' WHEN seq % 31 = 6 THEN 'https://' || source || '.example.com/news/' WHEN seq % 31 = 7 THEN 'ftp://' || source ELSE link END"
PRIORITY = f"""{CAND}, {POLICY_SQL}, n AS (SELECT seq, chapter, source, title, most, keywords, {LINK_SQL} AS url, {PADDED.format("title || ' ' || summary")} AS body, {PADDED.format('title')} AS head, seq % 5 AS tier,
CASE WHEN seq % 50 = 7 THEN NULL WHEN seq % 40 = 3 THEN -2.0 ELSE age_h / 24.0 END AS age FROM c JOIN pol USING (chapter)),
h AS (SELECT *, len(list_filter(keywords, lambda k: contains(body, ' ' || k || ' '))) AS hits FROM n),
pr AS (SELECT seq, chapter, source, title, age, CASE {ladder_sql(REJECTS, {"words_text": "body", "words_title": "head"})}
WHEN age IS NULL THEN 'missing_date' WHEN age < -1 THEN 'future_date' WHEN age > most THEN 'stale' ELSE {URL_REASON} END AS reason, round(hits * 10 + 2 * greatest(0, most - greatest(0, age)) + greatest(0, 4 - tier), 6) AS score FROM h)"""


def priority(spark: SparkSession, sf: str) -> DataFrame:
    """seq, chapter, source, title, age (days), reason (null: kept), score. Policy and rules are tables of a few rows."""
    pol = F.broadcast(spark.createDataFrame(POLICY, POLICY_SCHEMA))
    s = F.col("seq")
    age = F.when(s % 50 == 7, None).when(s % 40 == 3, -2.0).otherwise(F.col("age_h") / 24)
    url = F.when(s % 31 == 5, F.concat("link", F.lit("?id="))).when(s % 31 == 6, F.concat(F.lit("https://"), "source", F.lit(".example.com/news/"))).when(s % 31 == 7, F.concat(F.lit("ftp://"), "source")).otherwise(F.col("link"))
    n = candidates(spark, sf).join(pol, "chapter").select("seq", "chapter", "source", "title", F.concat("title", F.lit(" "), "summary").alias("body"), "most", "keywords", (s % 5).alias("tier"), age.alias("age"), url.alias("url"))
    n = lineage.once(n, {"body": text.norm_title(F.col("body"))})
    told = ladder.rejected(n, ladder.parse(spark, json.dumps(REJECTS)), {"title": F.col("title"), "text": F.col("body")}, F.col("most"), normal=("text",))
    hits = text.let(F.concat(F.lit(" "), "body", F.lit(" ")), lambda body: F.size(F.filter("keywords", lambda k: F.contains(body, F.concat(F.lit(" "), k, F.lit(" "))))))
    fresh = F.greatest(F.lit(0.0), F.col("most") - F.greatest(F.lit(0.0), F.col("age")))
    score = F.round(hits * 10 + 2 * fresh + F.greatest(F.lit(0), 4 - F.col("tier")), 6)
    return told.select("seq", "chapter", "source", "title", "age", "reason", score.alias("score"))


@query(f"WITH {PRIORITY} SELECT seq, chapter, reason FROM pr")
def f4_priority_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return priority(spark, sf).select("seq", "chapter", "reason")


@query(f"WITH {PRIORITY} SELECT seq, chapter, score FROM pr WHERE reason IS NULL")
def c2_priority_score(spark: SparkSession, sf: str) -> DataFrame:
    return priority(spark, sf).filter("reason IS NULL").select("seq", "chapter", "score")


@query(f"""WITH {PRIORITY}, g AS (SELECT chapter, reason, count(*) AS n FROM pr GROUP BY ALL) SELECT chapter, CAST(coalesce(sum(n) FILTER (reason IS NULL), 0) AS BIGINT) AS kept, CAST(coalesce(sum(n) FILTER (reason IS NOT NULL), 0) AS BIGINT) AS rejected,
string_agg(reason || ':' || n, ',' ORDER BY reason) FILTER (reason IS NOT NULL) AS reasons FROM g GROUP BY chapter""")
def f4_reject_report(spark: SparkSession, sf: str) -> DataFrame:
    """How many rows of each chapter the ladder keeps, and how often it gave each reason."""
    r = ladder.report(priority(spark, sf))
    written = F.array_join(F.transform(F.array_sort(F.map_entries("reasons")), lambda e: F.concat(e.key, F.lit(":"), e.value.cast("string"))), ",")
    return r.select("chapter", "kept", "rejected", F.nullif(written, F.lit("")).alias("reasons"))


OPINION = ["opinion", "comment", "editorial", "columns", "analysis", "de"]
#: Rules before selection: paths of opinion everywhere, then those of a chapter (a: foreign affairs, b: science, c: economy).
FACTUAL = [
    _rule(1, "non_factual_path", None, ("url", "segments", OPINION, True)),
    _rule(2, "public_safety_incident", "a", ("text", "contains", ["the thnd"], True), ("text", "contains", ["blast", "erhes", "ntha"], True)),
    _rule(3, "industrial_expansion_wrong_chapter", "a", ("title", "contains", ["hea", "ing"], True), ("title", "contains", ["and", "that"], False)),
    _rule(4, "science_briefing", "b", ("title", "contains", ["briefing", "erth"], True)), _rule(5, "science_content_filler", "b", ("title", "contains", ["podcast", "ouhe"], True)),
    _rule(6, "prefer_primary_source", "b", ("source", "starts", ["agency"], True), ("title", "contains", ["th"], True), ("title", "contains", ["launch", "an"], True)),
    _rule(7, "historical_reference_data", "c", ("source", "contains", ["office for"], True), ("text", "contains", ["the", "de"], True), ("text", "years_before", ["3"], True)),
]
YEARS = "list_transform(regexp_extract_all({}, '\\b((?:19|20)[0-9]{{2}})\\b', 1), lambda y: CAST(y AS INTEGER))"
FACTS = f"""fp AS (SELECT page_id, {_list(["a", "b", "c", "d"])}[CAST(page_id % 4 AS INTEGER) + 1] AS chapter, CASE page_id % 3 WHEN 0 THEN 'Agency of space' WHEN 1 THEN 'Office for numbers' ELSE 'Paper' END AS source, CAST(2023 + page_id % 5 AS VARCHAR) || '-01-08' AS published, 0 AS tier,
string_split(lower(regexp_extract(url, '^https?://[^/?#]+(/[^?#]*)', 1)), '/') AS segments, lower(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title, lower(html) AS body FROM pages),
fr AS (SELECT page_id, chapter, CASE {ladder_sql(FACTUAL, {"segments_url": "segments", "contains_text": "body", "contains_title": "title", "starts_source": "lower(source)", "contains_source": "lower(source)", "years_before_text": YEARS.format("body"), "published": YEARS.format("published")})} END AS reason FROM fp)"""


def facts(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("page_id")
    p = table(spark, sf, "pages").select(
        "page_id", F.element_at(F.array(*[F.lit(x) for x in "abcd"]), (k % 4 + 1).cast("int")).alias("chapter"), F.when(k % 3 == 0, "Agency of space").when(k % 3 == 1, "Office for numbers").otherwise("Paper").alias("source"),
        F.concat((2023 + k % 5).cast("string"), F.lit("-01-08")).alias("published"), "url", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), "html",
    )
    fields = {"url": F.col("url"), "title": F.col("title"), "text": F.col("html"), "source": F.col("source"), "published": F.col("published")}
    return ladder.reasons(p, ladder.parse(spark, json.dumps(FACTUAL)), fields)


@query(f"WITH {FACTS} SELECT page_id, chapter, reason FROM fr")
def f6_factual_prefilter(spark: SparkSession, sf: str) -> DataFrame:
    return facts(spark, sf).select("page_id", "chapter", "reason")


@query(f"""WITH {FACTS}, g AS (SELECT chapter, reason, count(*) AS n FROM fr GROUP BY ALL) SELECT chapter, CAST(coalesce(sum(n) FILTER (reason IS NULL), 0) AS BIGINT) AS kept, CAST(coalesce(sum(n) FILTER (reason IS NOT NULL), 0) AS BIGINT) AS rejected,
string_agg(reason || ':' || n, ',' ORDER BY reason) FILTER (reason IS NOT NULL) AS reasons FROM g GROUP BY chapter""")
def f6_prefilter_report(spark: SparkSession, sf: str) -> DataFrame:
    r = ladder.report(facts(spark, sf))
    written = F.array_join(F.transform(F.array_sort(F.map_entries("reasons")), lambda e: F.concat(e.key, F.lit(":"), e.value.cast("string"))), ",")
    return r.select("chapter", "kept", "rejected", F.nullif(written, F.lit("")).alias("reasons"))


@query("SELECT doc_id, CASE WHEN doc_id % 40 = 3 THEN 'future_publication' WHEN lang NOT IN ('en', 'fr') THEN 'evidence_kind' END AS reason FROM documents")
def f8_evidence_kinds(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.when(F.col("doc_id") % 40 == 3, "future_publication").when(~F.col("lang").isin("en", "fr"), "evidence_kind").alias("reason"))


@query(f"WITH {CAND} SELECT seq, NOT regexp_matches(title, '^\\[(opinion|column)\\]|!!') AND seq % 9 <> 0 AND length(trim(title)) > 0 AS eligible FROM c")
def f9_top5_eligibility(spark: SparkSession, sf: str) -> DataFrame:
    ok = ~F.col("title").rlike(r"^\[(opinion|column)\]|!!") & (F.col("seq") % 9 != 0) & (F.length(F.trim("title")) > 0)
    return candidates(spark, sf).select("seq", ok.alias("eligible"))


@query("""WITH e AS (SELECT event_id, event_type || '_' || event_id AS video, (epoch(TIMESTAMP '2024-01-25 00:00:00') - epoch(ts)) / 86400.0 AS age FROM events)
SELECT event_id, regexp_full_match(video, '[A-Za-z0-9_-]{6,}') AS valid_id, CASE WHEN age IS NULL THEN 'missing_date' WHEN age < -1 THEN 'future_date' WHEN age > 14 THEN 'stale' END AS reason FROM e""")
def f10_video_validity(spark: SparkSession, sf: str) -> DataFrame:
    age = (F.unix_micros(F.lit("2024-01-25 00:00:00 UTC").cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))) / 86_400_000_000
    reason = F.when(age.isNull(), "missing_date").when(age < -1, "future_date").when(age > 14, "stale")
    return table(spark, sf, "events").select("event_id", F.concat_ws("_", "event_type", "event_id").rlike("^[A-Za-z0-9_-]{6,}$").alias("valid_id"), reason.alias("reason"))


@query(f"""WITH p AS (SELECT page_id, {HOST} AS domain, regexp_replace(lower(regexp_extract(url, '^https?://[^/?#]+(/[^?#]*)', 1)), '/+$', '') AS path FROM pages)
SELECT page_id, path IN ('', '/news', '/world', '/business') AS generic_path, coalesce(domain LIKE '%.example.com', false) AS discovery_only, coalesce(domain LIKE '%.example.org', false) AS wire FROM p""")
def f11_source_flags(spark: SparkSession, sf: str) -> DataFrame:
    lists = F.broadcast(spark.createDataFrame([("example.com", "discovery"), ("example.org", "wire")], "suffix string, kind string"))
    p = table(spark, sf, "pages").select("page_id", F.coalesce(urls.domain(F.col("url")), F.lit("")).alias("domain"), F.regexp_replace(F.lower(urls.path(F.col("url"))), "/+$", "").alias("path"))
    below = F.slice(urls.suffixes(F.col("domain")), 2, 100)  # domains above the host
    met = p.select("page_id", F.explode(below).alias("suffix")).join(lists, "suffix").groupBy("page_id").agg(F.collect_set("kind").alias("kinds"))
    flag = lambda kind: F.coalesce(F.array_contains("kinds", kind), F.lit(False))
    return p.join(met, "page_id", "left").select("page_id", F.col("path").isin("", "/news", "/world", "/business").alias("generic_path"), flag("discovery").alias("discovery_only"), flag("wire").alias("wire"))


@query(f"""WITH {CAND}, t AS (SELECT seq, {INFORMATIVE.format('title')} AS a, {INFORMATIVE.format('summary')} AS b FROM c), k AS (SELECT seq, len(list_intersect(a, b)) AS n, len(list_distinct(list_concat(a, b))) AS u, least(len(a), len(b)) AS m FROM t)
SELECT seq, coalesce(n >= 2 AND n / m >= 0.5 AND n / u >= 0.25, false) AS same_event FROM k""")
def f15_same_event_clause(spark: SparkSession, sf: str) -> DataFrame:
    t = candidates(spark, sf).select("seq", text.informative_tokens(F.col("title"), STOP).alias("a"), text.informative_tokens(F.col("summary"), STOP).alias("b"))
    a, b = F.col("a"), F.col("b")
    return t.select("seq", ((F.size(F.array_intersect(a, b)) >= 2) & (text.overlap(a, b) >= 0.5) & (text.jaccard(a, b) >= 0.25)).alias("same_event"))


BAD_IMAGE = r"(?i)logo|icon|sprite|avatar|banner|\.(svg|ico)($|\?)"


@query("""WITH i AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN url || '/logo.png' WHEN 1 THEN '/photo.jpg' WHEN 2 THEN url || '/chart.svg' ELSE url || '/photo.jpg' END AS image FROM pages)
SELECT page_id, CASE WHEN NOT regexp_matches(image, '^https?://') THEN 'non_http' WHEN regexp_matches(image, '(?i)logo|icon|sprite|avatar|banner|\\.(svg|ico)($|\\?)') THEN 'bad_image' END AS reason FROM i""")
def f17_image_urls(spark: SparkSession, sf: str) -> DataFrame:
    k, u = F.col("page_id") % 5, F.col("url")
    image = F.when(k == 0, F.concat(u, F.lit("/logo.png"))).when(k == 1, "/photo.jpg").when(k == 2, F.concat(u, F.lit("/chart.svg"))).otherwise(F.concat(u, F.lit("/photo.jpg")))
    return table(spark, sf, "pages").select("page_id", F.when(~image.rlike("^https?://"), "non_http").when(image.rlike(BAD_IMAGE), "bad_image").alias("reason"))


@query("SELECT page_id, coalesce(regexp_matches(url, '^https?://[^/?#]+'), false) AS valid FROM pages")
def f18_http_urls(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", urls.is_http(F.col("url")).alias("valid"))


#: Points of the kinds of study.
EVIDENCE = {"META-ANALYSIS": 24, "SYSTEMATIC REVIEW": 22, "RCT": 20, "GUIDELINE": 18, "OBSERVATIONAL": 13, "CLINICAL TRIAL": 12, "REVIEW": 10, "PREPRINT": 7, "RESEARCH / ISSUE": 5}
KIND_SQL = "CASE " + " ".join(f"WHEN contains(lower(text), '{w}') THEN '{k}'" for w, k in STUDY) + " ELSE 'RESEARCH / ISSUE' END"
RESEARCH = f"""{CAND}, k AS (SELECT seq, chapter, source, title, age_h // 8 AS age, {KIND_SQL} AS kind, length(summary) AS size FROM c),
rs AS (SELECT *, CAST(CASE kind {" ".join(f"WHEN '{k}' THEN {v}" for k, v in EVIDENCE.items())} ELSE 5 END + CASE WHEN age <= 3 THEN 20 WHEN age <= 7 THEN 16 WHEN age <= 14 THEN 10 WHEN age <= 30 THEN 5 ELSE 0 END
+ CASE WHEN seq % 3 = 0 THEN 8 ELSE 0 END + CASE WHEN seq % 5 = 0 THEN 7 ELSE 0 END + CASE WHEN seq % 7 = 0 THEN 5 ELSE 0 END + CASE WHEN size > 0 THEN 7 ELSE 0 END + 5 + CASE WHEN seq % 2 = 0 THEN 3 ELSE 0 END + 4 + CASE WHEN seq % 4 < 3 THEN 3 ELSE 0 END AS INTEGER) AS score FROM k)"""


def study_kind(body: Column) -> Column:
    low, kind = F.lower(body), None
    for word, name in STUDY:
        kind = F.when(low.contains(word), name) if kind is None else kind.when(low.contains(word), name)
    return kind.otherwise("RESEARCH / ISSUE")


def research(spark: SparkSession, sf: str) -> DataFrame:
    """seq, chapter, source (topic), title, age (days), kind, score: documents as research records; which fields one has follows from its id."""
    k = candidates(spark, sf).select("seq", "chapter", "source", "title", F.floor(F.col("age_h") / 8).alias("age"), study_kind(F.col("text")).alias("kind"), F.length("summary").alias("size"))
    points = F.create_map(*[F.lit(x) for pair in EVIDENCE.items() for x in pair])
    has = lambda cond, n: F.when(cond, n).otherwise(0)
    s, age = F.col("seq"), F.col("age")
    fresh = F.when(age <= 3, 20).when(age <= 7, 16).when(age <= 14, 10).when(age <= 30, 5).otherwise(0)
    score = F.coalesce(points[F.col("kind")], F.lit(5)) + fresh + has(s % 3 == 0, 8) + has(s % 5 == 0, 7) + has(s % 7 == 0, 5) + has(F.col("size") > 0, 7) + 5 + has(s % 2 == 0, 3) + 4 + has(s % 4 < 3, 3)
    return k.withColumn("score", score)


@query(f"WITH {RESEARCH} SELECT seq, kind, score FROM rs")
def c3_research_quality(spark: SparkSession, sf: str) -> DataFrame:
    return research(spark, sf).select("seq", "kind", "score")


#: Weights of evidence and body status, impact where a chapter has no own.
EVIDENCE_WEIGHT = {"VERIFIED_OFFICIAL": 2.0, "VERIFIED_PRIMARY": 1.8, "VERIFIED_MULTI_SOURCE": 1.6, "PARTIAL": -0.8, "UNVERIFIED": -2.5, "ACCESS_BLOCKED": -1.5, "CONFLICT": -3.0}
BODY_WEIGHT = {"VALIDATED": 0.8, "EVENT_MISMATCH": -0.5, "NO_QUALIFIED_BODY": 0.0, "HTTP_403": 0.0, "HTTP_404": -0.2, "TIMEOUT": 0.0}
IMPACT = {"en": 1.4, "fr": 1.2, "de": 0.9}
STATUSES, BODIES = [*EVIDENCE_WEIGHT, "OTHER"], [*BODY_WEIGHT, "OTHER"]


def _case(column: str, weights: dict[str, float], default: float) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items()) + f" ELSE {default} END"


@query(f"""WITH {CAND}, k AS (SELECT seq, chapter, age_h, {_list(STATUSES)}[CAST(seq % {len(STATUSES)} AS INTEGER) + 1] AS status, {_list(BODIES)}[CAST(seq % {len(BODIES)} AS INTEGER) + 1] AS body FROM c)
SELECT seq, status, body, round(CAST(5.0 + {_case('chapter', IMPACT, 0.5)} + {_case('status', EVIDENCE_WEIGHT, -1.0)} + {_case('body', BODY_WEIGHT, 0.0)} + CASE WHEN age_h <= 6 THEN 1.0 WHEN age_h <= 12 THEN 0.7 WHEN age_h <= 24 THEN 0.4 WHEN age_h <= 48 THEN 0.1 ELSE -0.4 END AS DOUBLE), 4) AS score FROM k""")
def c4_top5_score(spark: SparkSession, sf: str) -> DataFrame:
    nth = lambda names: F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("seq") % len(names) + 1).cast("int"))
    k = candidates(spark, sf).select("seq", "chapter", "age_h", nth(STATUSES).alias("status"), nth(BODIES).alias("body"))
    weigh = lambda column, weights, default: F.coalesce(F.create_map(*[F.lit(x) for p in weights.items() for x in p])[F.col(column)], F.lit(default))
    age = F.col("age_h")
    recent = F.when(age <= 6, 1.0).when(age <= 12, 0.7).when(age <= 24, 0.4).when(age <= 48, 0.1).otherwise(-0.4)
    total = F.lit(5.0) + weigh("chapter", IMPACT, 0.5) + weigh("status", EVIDENCE_WEIGHT, -1.0) + weigh("body", BODY_WEIGHT, 0.0) + recent
    return k.select("seq", "status", "body", F.round(total, 4).alias("score"))


ALIASES, ACTIONS, ENTITIES = {"thes": "the", "whes": "whe", "hers": "her", "ther": "the"}, ["her", "the", "est", "der"], ["tion", "and", "und"]
ALIASED = "CASE w " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ALIASES.items()) + " ELSE w END"
NO_EVENT = ["are", "was", "for"]
EVENT = f"list_distinct(list_filter(list_transform(string_split({NORM}, ' '), lambda w: {ALIASED}), lambda w: length(w) >= 3 AND NOT list_contains({_list(NO_EVENT)}, w) AND NOT regexp_matches(w, '^[0-9]+$')))"


def same_action_sql(a: str, b: str) -> str:
    k = f"list_intersect({a}, {b})"
    act, ent = f"len(list_intersect({k}, {_list(ACTIONS)})) > 0", f"len(list_intersect({k}, {_list(ENTITIES)})) > 0"
    inside = f"len({k}) / least(len({a}), len({b}))"
    return f"(len({k}) >= 3 AND (({act} AND {inside} >= 0.34) OR len({k}) / len(list_distinct(list_concat({a}, {b}))) >= 0.45 OR ({act} AND {ent} AND {inside} >= 0.30)))"


def event_words(c: Column) -> Column:
    return text.event_tokens(c, ALIASES, NO_EVENT)


@query(f"""WITH {CAND}, l AS (SELECT seq AS doc_id, {EVENT.format('title')} AS a FROM c), r AS (SELECT item_id, {EVENT.format('text')} AS b FROM benchmark)
SELECT doc_id, item_id, len(list_intersect(a, b)) AS shared FROM l JOIN r ON {same_action_sql('a', 'b')}""")
def j2_same_event_english(spark: SparkSession, sf: str) -> DataFrame:
    left = candidates(spark, sf).select(F.col("seq").alias("id"), event_words(F.col("title")).alias("tokens"))
    right = table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), event_words(F.col("text")).alias("tokens"))
    p = similar.shared_token_pairs(left, right, 3, share=0.3).filter(similar.same_action(F.col("lt"), F.col("rt"), ACTIONS, ENTITIES))
    return p.select(F.col("l").alias("doc_id"), F.col("r").alias("item_id"), F.size(F.array_intersect("lt", "rt")).cast("long").alias("shared"))


@query(f"""WITH {RESEARCH}, t AS (SELECT * FROM (VALUES ('src0', 'screening'), ('src1', 'therapy'), ('src2', 'devices')) v(source, meaning))
SELECT seq, substr(sha256('vision|' || CASE WHEN seq % 3 = 0 THEN '10.1000/' || seq WHEN seq % 5 = 0 THEN 'pm' || seq ELSE title END), 1, 16) AS article_id, coalesce(meaning, 'research') AS meaning, kind,
CASE WHEN seq % 4 = 0 THEN 'Journal of ' || source WHEN seq % 4 = 1 THEN source ELSE 'unknown' END AS source_name FROM rs LEFT JOIN t USING (source)""")
def p5_research_articles(spark: SparkSession, sf: str) -> DataFrame:
    meaning = F.broadcast(spark.createDataFrame([("src0", "screening"), ("src1", "therapy"), ("src2", "devices")], "source string, meaning string"))
    s = F.col("seq")
    identity = F.when(s % 3 == 0, F.concat(F.lit("10.1000/"), s.cast("string"))).when(s % 5 == 0, F.concat(F.lit("pm"), s.cast("string"))).otherwise(F.col("title"))
    name = F.when(s % 4 == 0, F.concat(F.lit("Journal of "), "source")).when(s % 4 == 1, F.col("source")).otherwise("unknown")
    return research(spark, sf).join(meaning, "source", "left").select("seq", F.substring(F.sha2(F.concat(F.lit("vision|"), identity), 256), 1, 16).alias("article_id"), F.coalesce("meaning", F.lit("research")).alias("meaning"), "kind", name.alias("source_name"))


@query(f"""WITH {CAND}, r AS (SELECT chapter, title, row_number() OVER (PARTITION BY chapter ORDER BY n_chars DESC, seq) AS k FROM c), w AS (SELECT max(value) AS high FROM events)
SELECT chapter, max(title) FILTER (k = 1) AS first, max(title) FILTER (k = 2) AS second, 'High of ' || CAST(CAST(floor(any_value(high)) AS BIGINT) AS VARCHAR) || ' degrees' AS third FROM r, w WHERE k <= 2 GROUP BY chapter""")
def p12_three_lines(spark: SparkSession, sf: str) -> DataFrame:
    best = candidates(spark, sf).select("chapter", "title", "seq", "n_chars")
    r = best.withColumn("k", F.row_number().over(Window.partitionBy("chapter").orderBy(F.desc("n_chars"), "seq"))).filter("k <= 2")
    high = table(spark, sf, "events").agg(F.max("value").alias("high"))  # one row
    nth = lambda k: F.max(F.when(F.col("k") == k, F.col("title")))
    lines = r.groupBy("chapter").agg(nth(1).alias("first"), nth(2).alias("second"))
    return lines.join(F.broadcast(high)).select("chapter", "first", "second", F.format_string("High of %d degrees", F.floor("high")).alias("third"))


@query(f"WITH {EVENT_PAIRS} SELECT l AS seq, r AS item_id, score AS corroboration FROM je")
def c6_corroboration(spark: SparkSession, sf: str) -> DataFrame:
    left, right = event_sides(spark, sf)
    p = similar.event_pairs(left.select("id", "tokens"), right.select("id", "tokens")).join(left.select(F.col("id").alias("l"), F.col("source").alias("ls")), "l").join(right.select(F.col("id").alias("r"), F.col("source").alias("rs")), "r")
    return p.filter("ls <> rs").select(F.col("l").alias("seq"), F.col("r").alias("item_id"), similar.corroboration(F.col("lt"), F.col("rt")).alias("corroboration"))
