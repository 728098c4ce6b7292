"""Records of research providers as one schema: XML of articles, JSON of indexes, works and trials; and their dedupe."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazette.functions import text, times

#: Words that tell the kind of a study; the first kind with one of its words counts.
KINDS = (
    ("RCT", ("randomized", "randomised")), ("META-ANALYSIS", ("meta-analysis", "meta analysis")), ("SYSTEMATIC REVIEW", ("systematic review",)), ("REVIEW", ("review",)), ("GUIDELINE", ("guideline", "practice pattern")),
    ("PREPRINT", ("preprint",)), ("OBSERVATIONAL", ("observational", "cohort", "case-control", "cross-sectional")), ("CLINICAL TRIAL", ("clinical trial", "interventional")),
)
OTHER_KIND = "RESEARCH / ISSUE"
AUTHORS = 12
ARTICLE = """MedlineCitation struct<PMID:string,Article:struct<ArticleTitle:string,Abstract:struct<AbstractText:array<string>>,Journal:struct<Title:string,JournalIssue:struct<PubDate:struct<Year:string,Month:string,Day:string>>>,
AuthorList:struct<Author:array<struct<ForeName:string,LastName:string>>>>>"""
INDEX = "id string, pmid string, doi string, title string, abstractText string, journalTitle string, firstPublicationDate string, firstIndexDate string, authorString string, pubType string"
WORK = """DOI string, title array<string>, abstract string, `container-title` array<string>, `published-online` struct<`date-parts`:array<array<int>>>, `published-print` struct<`date-parts`:array<array<int>>>, author array<struct<given:string,family:string>>, type string, URL string"""
TRIAL = """protocolSection struct<identificationModule:struct<nctId:string,briefTitle:string>,statusModule:struct<overallStatus:string,lastUpdatePostDateStruct:struct<date:string>,studyFirstPostDateStruct:struct<date:string>>,
designModule:struct<studyType:string,enrollmentInfo:struct<count:long>>,descriptionModule:struct<briefSummary:string>>"""


def plain(c: Column) -> Column:
    """A text without tags, all references decoded, on one line; a null one is empty."""
    return text.clean_html(F.coalesce(c.cast("string"), F.lit("")))


def norm_doi(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(plain(c)), r"^(https?://(dx\.)?doi\.org/)?(doi:)?", ""))


def kind_of(body: Column) -> Column:
    low, out = F.lower(body), None
    for kind, words in KINDS:
        has = low.contains(words[0])
        for word in words[1:]:
            has = has | low.contains(word)
        out = F.when(has, kind) if out is None else out.when(has, kind)
    return out.otherwise(OTHER_KIND)


def _names(people: Column, first: str, last: str) -> Column:
    """The names of the first twelve people, empty ones left out."""
    written = F.transform(F.slice(F.coalesce(people, F.array().cast("array<struct<" + first + ":string," + last + ":string>>")), 1, AUTHORS), lambda p: F.concat_ws(" ", p[first], p[last]))
    decoded = F.split(text.unescape(F.array_join(written, "\u0001")), "\u0001")  # all names of a row at once
    return F.filter(F.transform(decoded, text.untagged), lambda n: n != "")


def _records(rows: DataFrame, source: str, **fields: Column) -> DataFrame:
    """The common schema; fields that a provider has not are empty. Kept: seq and topic of the raw row."""
    blank = F.lit("")
    get = lambda name: plain(fields[name]) if name in fields else blank
    out = rows.select(
        "seq", "topic", F.lit(source).alias("collector_source"), get("title").alias("title"), get("abstract").alias("abstract"), get("journal").alias("journal"), get("publication_date").alias("publication_date"), fields["url"].alias("url"),
        norm_doi(fields["doi"]).alias("doi") if "doi" in fields else blank.alias("doi"), get("pmid").alias("pmid"), get("nct_id").alias("nct_id"), fields.get("authors", F.array().cast("array<string>")).alias("authors"),
        get("study_type").alias("study_type"), get("recruitment_status").alias("recruitment_status"), fields.get("enrollment", F.lit(None).cast("long")).cast("long").alias("enrollment"),
    )
    return out.withColumn("evidence_type", kind_of(F.concat_ws(" ", "title", "abstract", "study_type"))).withColumn("published_on", times.loose_date(F.col("publication_date")))


def flat(xml: Column, tag: str) -> Column:
    """The tags inside elements ``tag`` taken out, so that their text stays whole."""
    inner = rf"(?is)(<{tag}(?:\s[^>]*)?>(?:(?!</{tag}>|<).)*)<(?!/{tag}>)[^>]*>"
    for _ in range(6):  # each pass takes one tag out of each element
        xml = F.regexp_replace(xml, inner, "$1")
    return xml


def articles_xml(raw: DataFrame) -> DataFrame:
    """Records of ``raw`` (seq, topic, xml: one article element to a row). Rows without an article are dropped; the first doi among its ids counts."""
    a = raw.select("seq", "topic", "xml", F.from_xml(flat(flat(F.col("xml"), "ArticleTitle"), "AbstractText"), ARTICLE).alias("r")).filter("r.MedlineCitation.Article IS NOT NULL")
    m = F.col("r.MedlineCitation")
    date = m["Article"]["Journal"]["JournalIssue"]["PubDate"]
    doi = F.regexp_extract("xml", r"(?is)<ArticleId[^>]*IdType\s*=\s*[\"']doi[\"'][^>]*>(.*?)</ArticleId", 1)
    pmid = plain(m["PMID"])
    return _records(
        a, "pubmed", title=m["Article"]["ArticleTitle"], abstract=F.array_join(m["Article"]["Abstract"]["AbstractText"], " "), journal=m["Article"]["Journal"]["Title"], publication_date=F.concat_ws("-", date["Year"], date["Month"], date["Day"]),
        doi=doi, pmid=pmid, url=F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), pmid, F.lit("/")), authors=_names(m["Article"]["AuthorList"]["Author"], "ForeName", "LastName"),
    )


def index_json(raw: DataFrame) -> DataFrame:
    """Records of ``raw`` (seq, topic, json: one result of an index to a row): the address is that of the pmid, else the doi, else the site."""
    a = raw.select("seq", "topic", F.from_json("json", INDEX).alias("r")).filter("r IS NOT NULL")
    pmid, doi = plain(F.col("r.pmid")), norm_doi(F.col("r.doi"))
    url = F.when(pmid != "", F.concat(F.lit("https://europepmc.org/article/MED/"), pmid)).when(doi != "", F.concat(F.lit("https://doi.org/"), doi)).otherwise("https://europepmc.org/")
    people = plain(F.col("r.authorString"))
    return _records(
        a, "europe-pmc", title=F.col("r.title"), abstract=F.col("r.abstractText"), journal=F.col("r.journalTitle"), publication_date=F.coalesce(F.nullif("r.firstPublicationDate", F.lit("")), "r.firstIndexDate"), doi=F.col("r.doi"), pmid=F.col("r.pmid"), url=url,
        authors=F.when(people != "", F.split(people, ", ")).otherwise(F.array().cast("array<string>")), study_type=F.col("r.pubType"),
    )


def works_json(raw: DataFrame) -> DataFrame:
    """Records of ``raw`` (seq, topic, json: one work to a row): first title and container, date parts of two digits, the doi's address."""
    a = raw.select("seq", "topic", F.from_json("json", WORK).alias("r")).filter("r IS NOT NULL")
    dates = F.get(F.coalesce(F.col("r.published-online.date-parts"), F.col("r.published-print.date-parts")), F.lit(0))
    date = F.array_join(F.transform(dates, lambda p, k: F.when(k == 0, p.cast("string")).otherwise(F.lpad(p.cast("string"), 2, "0"))), "-")
    doi = norm_doi(F.col("r.DOI"))
    return _records(
        a, "crossref", title=F.get("r.title", F.lit(0)), abstract=F.col("r.abstract"), journal=F.get(F.col("r.container-title"), F.lit(0)), publication_date=date, doi=F.col("r.DOI"),
        url=F.when(doi != "", F.concat(F.lit("https://doi.org/"), doi)).otherwise(F.coalesce("r.URL", F.lit(""))), authors=_names(F.col("r.author"), "given", "family"), study_type=F.col("r.type"),
    )


def trials_json(raw: DataFrame, cutoff: Column | None = None) -> DataFrame:
    """Records of ``raw`` (seq, topic, json: one trial to a row): the date of the last update, else of the first posting; older than ``cutoff`` are dropped, dates that cannot be read stay."""
    a = raw.select("seq", "topic", F.from_json("json", TRIAL).alias("j")).filter("j IS NOT NULL").select("seq", "topic", F.col("j.protocolSection").alias("r"))
    date = F.coalesce(F.nullif("r.statusModule.lastUpdatePostDateStruct.date", F.lit("")), "r.statusModule.studyFirstPostDateStruct.date", F.lit(""))
    if cutoff is not None:
        a = a.filter(F.coalesce(F.try_to_date(F.substring(date, 1, 10), "yyyy-MM-dd") >= cutoff, F.lit(True)))
    nct = plain(F.col("r.identificationModule.nctId"))
    return _records(
        a, "clinicaltrials", title=F.col("r.identificationModule.briefTitle"), abstract=F.col("r.descriptionModule.briefSummary"), publication_date=date, nct_id=nct, url=F.concat(F.lit("https://clinicaltrials.gov/study/"), nct),
        study_type=F.col("r.designModule.studyType"), recruitment_status=F.col("r.statusModule.overallStatus"), enrollment=F.col("r.designModule.enrollmentInfo.count"),
    )


def query_terms(c: Column) -> Column:
    """The first six terms of a query of alternatives, for providers that do not read OR."""
    terms = F.filter(F.transform(F.split(text.unescape(c), r"(?i)\s+OR\s+"), text.untagged), lambda t: t != "")
    return F.when(F.size(terms) > 0, F.slice(terms, 1, 6)).otherwise(F.array(plain(c)))


def identity(doi: Column, pmid: Column, nct_id: Column, title: Column) -> Column:
    """What tells a record apart: doi, else pmid, else trial id, else the normalised title, with its kind; null if it has none of them."""
    some = lambda kind, c: F.when(c != "", F.concat(F.lit(f"{kind}:"), c))
    return F.coalesce(some("doi", doi), some("pmid", pmid), some("nct", nct_id), some("title", text.norm_title(title)))


def deduped(records: DataFrame) -> DataFrame:
    """The first record by ``seq`` of each identity; records without one are dropped."""
    keyed = records.withColumn("__key", identity(F.col("doi"), F.col("pmid"), F.col("nct_id"), F.col("title"))).filter("__key IS NOT NULL")
    first = keyed.groupBy("__key").agg(F.min("seq").alias("__first"))  # aggregated before the shuffle
    met = keyed.join(first, "__key").filter(F.col("seq") == F.col("__first"))
    return met.withColumn("__n", F.row_number().over(Window.partitionBy("__key", "seq").orderBy("collector_source"))).filter("__n = 1").select(records.columns)
