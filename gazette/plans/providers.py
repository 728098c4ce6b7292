"""Research providers over the driver's documents, rendered as each provider writes them, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.functions import times
from gazette.plans.catalogue import CAND, NORM, _clean_sql, query
from gazette.plans.readers import xml_text
from gazette.sources import research
from gazette.sources.tables import candidates


def seq() -> Column:
    return F.col("seq")


CONTROL = "regexp_replace({}, '[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]', '', 'g')"


def _tag(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))


def articles_raw(spark: SparkSession, sf: str) -> DataFrame:
    number = seq().cast("string")
    people = F.array_join(F.transform(F.sequence(F.lit(0), (seq() % 15).cast("int")), lambda n: F.concat(F.lit("<Author><LastName>L"), n.cast("string"), F.lit("</LastName><ForeName>F</ForeName></Author>"))), "")
    date = F.concat(_tag("Year", F.lit("2024")), F.when(seq() % 2 == 0, _tag("Month", (seq() % 12 + 1).cast("string"))).otherwise(""))
    article = F.concat(_tag("Journal", F.concat(_tag("JournalIssue", _tag("PubDate", date)), _tag("Title", F.col("source")))), _tag("ArticleTitle", xml_text(F.col("title"))), _tag("AuthorList", people))
    ids = F.when(seq() % 3 == 0, F.concat(F.lit('<ArticleId IdType="doi">10.1000/X'), number, F.lit("</ArticleId>"))).otherwise("")
    xml = _tag("PubmedArticle", F.concat(_tag("MedlineCitation", F.concat(_tag("PMID", number), _tag("Article", article))), ids))
    return candidates(spark, sf).select("seq", F.lit("all").alias("topic"), xml.alias("xml"))


@query(f"""WITH {CAND} SELECT seq, {_clean_sql(CONTROL.format('title'))} AS title, source AS journal, CASE WHEN seq % 2 = 0 THEN '2024-' || (seq % 12 + 1) ELSE '2024' END AS publication_date, CASE WHEN seq % 3 = 0 THEN '10.1000/x' || seq ELSE '' END AS doi,
'https://pubmed.ncbi.nlm.nih.gov/' || seq || '/' AS url, CAST(least(seq % 15 + 1, 12) AS INTEGER) AS authors, make_date(2024, CASE WHEN seq % 2 = 0 THEN CAST(seq % 12 + 1 AS INTEGER) ELSE 1 END, 1) AS published_on FROM c""")
def s8a_articles_xml(spark: SparkSession, sf: str) -> DataFrame:
    r = research.articles_xml(articles_raw(spark, sf))
    return r.select("seq", "title", "journal", "publication_date", "doi", "url", F.size("authors").alias("authors"), "published_on")


def works_raw(spark: SparkSession, sf: str) -> DataFrame:
    person = F.struct(F.lit("A").alias("given"), F.col("source").alias("family"))
    date = F.struct(F.array(F.array(F.lit(2024), (seq() % 12 + 1).cast("int"), (seq() % 28 + 1).cast("int"))).alias("date-parts"))
    work = F.struct(F.when(seq() % 2 == 0, F.concat(F.lit("10.2000/Y"), seq().cast("string"))).alias("DOI"), F.array("title").alias("title"), F.array("source").alias("container-title"), F.when(seq() % 5 != 0, date).alias("published-online"), F.array(person).alias("author"), F.lit("journal-article").alias("type"), F.col("link").alias("URL"))
    return candidates(spark, sf).select("seq", F.lit("all").alias("topic"), F.to_json(work).alias("json"))


@query(f"""WITH {CAND} SELECT seq, {_clean_sql('title')} AS title, CASE WHEN seq % 5 <> 0 THEN '2024-' || lpad(CAST(seq % 12 + 1 AS VARCHAR), 2, '0') || '-' || lpad(CAST(seq % 28 + 1 AS VARCHAR), 2, '0') ELSE '' END AS publication_date,
CASE WHEN seq % 2 = 0 THEN 'https://doi.org/10.2000/y' || seq ELSE link END AS url, 'A ' || source AS first_author FROM c""")
def s8c_works_json(spark: SparkSession, sf: str) -> DataFrame:
    return research.works_json(works_raw(spark, sf)).select("seq", "title", "publication_date", "url", F.get("authors", F.lit(0)).alias("first_author"))


def trials_raw(spark: SparkSession, sf: str) -> DataFrame:
    day = F.date_add(F.lit("2024-01-31").cast("date"), -(F.col("age_h") / 24).cast("int")).cast("string")
    when = lambda c: F.struct(c.alias("date"))
    status = F.struct(F.lit("RECRUITING").alias("overallStatus"), when(F.when(seq() % 3 == 0, day)).alias("lastUpdatePostDateStruct"), when(F.when(seq() % 7 == 0, "soon").otherwise(day)).alias("studyFirstPostDateStruct"))
    trial = F.struct(F.struct(
        F.struct(F.concat(F.lit("NCT"), F.lpad(seq().cast("string"), 8, "0")).alias("nctId"), F.col("title").alias("briefTitle")).alias("identificationModule"), status.alias("statusModule"),
        F.struct(F.lit("INTERVENTIONAL").alias("studyType"), F.struct(seq().alias("count")).alias("enrollmentInfo")).alias("designModule"),
    ).alias("protocolSection"))
    return candidates(spark, sf).select("seq", F.lit("all").alias("topic"), F.to_json(trial).alias("json"))


@query(f"""WITH {CAND}, d AS (SELECT seq, CASE WHEN seq % 3 <> 0 AND seq % 7 = 0 THEN 'soon' ELSE CAST(DATE '2024-01-31' - CAST(age_h // 24 AS INTEGER) AS VARCHAR) END AS day FROM c)
SELECT seq, 'NCT' || lpad(CAST(seq AS VARCHAR), 8, '0') AS nct_id, day AS publication_date, seq AS enrollment FROM d WHERE day = 'soon' OR day >= '2024-01-26'""")
def s8d_trials_json(spark: SparkSession, sf: str) -> DataFrame:
    r = research.trials_json(trials_raw(spark, sf), F.lit("2024-01-26").cast("date"))
    return r.select("seq", "nct_id", "publication_date", "enrollment")


@query(f"""WITH {CAND}, r AS (SELECT seq, CASE WHEN seq % 3 = 0 THEN '10.1/' || seq % 40 ELSE '' END AS doi, CASE WHEN seq % 5 = 0 THEN CAST(seq % 60 AS VARCHAR) ELSE '' END AS pmid, CASE WHEN seq % 7 = 0 THEN 'N' || seq % 30 ELSE '' END AS nct, {NORM.format('title')} AS t FROM c),
k AS (SELECT seq, CASE WHEN doi <> '' THEN 'doi:' || doi WHEN pmid <> '' THEN 'pmid:' || pmid WHEN nct <> '' THEN 'nct:' || nct WHEN t <> '' THEN 'title:' || t END AS key FROM r) SELECT min(seq) AS seq, key FROM k WHERE key IS NOT NULL GROUP BY key""")
def d1_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    some = lambda cond, c: F.when(cond, c).otherwise("")
    n = lambda m: (seq() % m).cast("string")
    r = candidates(spark, sf).select("seq", some(seq() % 3 == 0, F.concat(F.lit("10.1/"), n(40))).alias("doi"), some(seq() % 5 == 0, n(60)).alias("pmid"), some(seq() % 7 == 0, F.concat(F.lit("N"), n(30))).alias("nct_id"), "title", F.lit("all").alias("collector_source"))
    return research.deduped(r).select("seq", research.identity(F.col("doi"), F.col("pmid"), F.col("nct_id"), F.col("title")).alias("key"))


FORMS = ["'2024-01-' || lpad(d, 2, '0')", "'2024-01-' || lpad(d, 2, '0') || 'T10:20:30Z'", "'Mon, ' || lpad(d, 2, '0') || ' Jan 2024 10:20:30 GMT'", "d || ' January 2024'", "'Jan ' || d || ', 2024'", "'someday'"]


@query(f"""WITH e AS (SELECT event_id, CAST(event_id % 28 + 1 AS VARCHAR) AS d FROM events), w AS (SELECT event_id, CASE event_id % 6 {" ".join(f"WHEN {k} THEN {f}" for k, f in enumerate(FORMS))} END AS written, CAST(d AS INTEGER) AS day FROM e)
SELECT event_id, CASE event_id % 6 WHEN 5 THEN NULL WHEN 1 THEN make_timestamp(2024, 1, day, 10, 20, 30) WHEN 2 THEN make_timestamp(2024, 1, day, 10, 20, 30) ELSE make_timestamp(2024, 1, day, 0, 0, 0) END AS published, length(written) AS size FROM w""")
def t6_published_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Dates of events, written in turn in each form that feeds use."""
    d = F.col("d")
    two, k = F.lpad(d, 2, "0"), F.col("event_id") % 6
    lit = F.lit
    written = (
        F.when(k == 0, F.concat(lit("2024-01-"), two)).when(k == 1, F.concat(lit("2024-01-"), two, lit("T10:20:30Z"))).when(k == 2, F.concat(lit("Mon, "), two, lit(" Jan 2024 10:20:30 GMT"))).when(k == 3, F.concat(d, lit(" January 2024")))
        .when(k == 4, F.concat(lit("Jan "), d, lit(", 2024"))).otherwise("someday")
    )
    e = spark.read.parquet(f"{sf}/events.parquet").select("event_id", (F.col("event_id") % 28 + 1).cast("string").alias("d"))
    return e.select("event_id", times.published(written).alias("published"), F.length(written).cast("long").alias("size"))


@query("""WITH e AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'HTTPError:503' WHEN 1 THEN 'TimeoutError' WHEN 2 THEN 'URLError' WHEN 3 THEN 'ParseError' WHEN 4 THEN 'JSONDecodeError' ELSE 'ValueError' END AS error, CASE WHEN event_id % 2 = 0 THEN 'UC' ELSE 'XX' END || user_id AS channel FROM events)
SELECT event_id, CASE WHEN error LIKE 'HTTPError:%' THEN 'HTTP_' || substr(error, 11) WHEN error = 'TimeoutError' THEN 'TIMEOUT' WHEN error = 'URLError' THEN 'NETWORK' WHEN error = 'ParseError' THEN 'XML_PARSE' WHEN error = 'JSONDecodeError' THEN 'JSON_PARSE' ELSE upper(error) END AS class,
CASE WHEN channel LIKE 'UC%' THEN 'UU' || substr(channel, 3) ELSE channel END AS uploads FROM e""")
def t14_fetch_ladders(spark: SparkSession, sf: str) -> DataFrame:
    """Errors by their class, and a channel's list of uploads."""
    k = F.col("event_id") % 6
    error = F.when(k == 0, "HTTPError:503").when(k == 1, "TimeoutError").when(k == 2, "URLError").when(k == 3, "ParseError").when(k == 4, "JSONDecodeError").otherwise("ValueError")
    channel = F.concat(F.when(F.col("event_id") % 2 == 0, "UC").otherwise("XX"), F.col("user_id").cast("string"))
    return spark.read.parquet(f"{sf}/events.parquet").select("event_id", error_class(error).alias("class"), uploads_list(channel).alias("uploads"))


def error_class(error: Column) -> Column:
    """The class of a fetch error: HTTP_n, TIMEOUT, NETWORK, XML_PARSE, JSON_PARSE, else its name in capitals."""
    known = F.create_map(*[F.lit(x) for p in (("TimeoutError", "TIMEOUT"), ("timeout", "TIMEOUT"), ("URLError", "NETWORK"), ("ParseError", "XML_PARSE"), ("JSONDecodeError", "JSON_PARSE")) for x in p])
    return F.when(error.startswith("HTTPError:"), F.concat(F.lit("HTTP_"), F.substring(error, 11, 9))).otherwise(F.coalesce(known[error], F.upper(error)))


def uploads_list(channel: Column) -> Column:
    return F.when(channel.startswith("UC"), F.concat(F.lit("UU"), F.substring(channel, 3, 99))).otherwise(channel)
