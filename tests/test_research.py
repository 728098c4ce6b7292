"""Stored records of each provider, dates in each form, identities."""

import datetime as dt
import json

from pyspark.sql import functions as F

from gazette.functions import times
from gazette.sources import research

XML = """<PubmedArticle><MedlineCitation><PMID Version="1">123</PMID><Article><Journal><JournalIssue><PubDate><Year>2026</Year><Month>Sep</Month><Day>04</Day></PubDate></JournalIssue><Title>Eye &amp; Lens</Title></Journal>
<ArticleTitle>A <i>randomized</i> trial of <b>atropine</b>.</ArticleTitle><Abstract><AbstractText Label="AIM">Aim <sub>one</sub>.</AbstractText><AbstractText>Result.</AbstractText></Abstract>
<AuthorList><Author><LastName>Kim</LastName><ForeName>Ana</ForeName></Author><Author><CollectiveName>Group</CollectiveName></Author>{more}</AuthorList></Article></MedlineCitation>
<PubmedData><ArticleIdList><ArticleId IdType="pubmed">123</ArticleId><ArticleId IdType="doi">10.1000/ABC</ArticleId><ArticleId IdType="doi">10.1000/no</ArticleId></ArticleIdList></PubmedData></PubmedArticle>"""


def raw(spark, column, *values):
    return spark.createDataFrame([(k, "topic", v) for k, v in enumerate(values)], f"seq long, topic string, {column} string")


def test_articles(spark):
    more = "".join(f"<Author><LastName>L{k}</LastName><ForeName>F{k}</ForeName></Author>" for k in range(20))
    got = research.articles_xml(raw(spark, "xml", XML.format(more=more), "<PubmedArticle></PubmedArticle>", "no xml", None)).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.title, r.abstract, r.journal, r.publication_date, r.doi, r.pmid, r.url) == ("A randomized trial of atropine.", "Aim one. Result.", "Eye & Lens", "2026-Sep-04", "10.1000/abc", "123", "https://pubmed.ncbi.nlm.nih.gov/123/")
    assert r.authors[0] == "Ana Kim" and len(r.authors) == 11 and r.evidence_type == "RCT" and r.published_on == dt.date(2026, 9, 4)


def test_index_works_and_trials(spark):
    index = [{"pmid": "7", "doi": "10.1/X", "title": "Old <b>cohort</b> study", "authorString": "A B, C D", "firstIndexDate": "2026-01-02"}, {"doi": "https://doi.org/10.1/Y", "title": "t"}, {"title": "only a title"}]
    a = research.index_json(raw(spark, "json", *map(json.dumps, index))).orderBy("seq").collect()
    assert [r.url for r in a] == ["https://europepmc.org/article/MED/7", "https://doi.org/10.1/y", "https://europepmc.org/"]
    assert (a[0].title, a[0].authors, a[0].publication_date, a[0].evidence_type) == ("Old cohort study", ["A B", "C D"], "2026-01-02", "OBSERVATIONAL") and a[1].authors == []
    works = [{"DOI": "10.2/Z", "title": ["First", "Second"], "container-title": ["J"], "published-online": {"date-parts": [[2026, 3, 4]]}, "author": [{"given": "A", "family": "B"}, {"family": "C"}, {}]}, {"title": [], "URL": "http://x", "published-print": {"date-parts": [[2025]]}}]
    w = research.works_json(raw(spark, "json", *map(json.dumps, works))).orderBy("seq").collect()
    assert (w[0].title, w[0].journal, w[0].publication_date, w[0].url, w[0].authors) == ("First", "J", "2026-03-04", "https://doi.org/10.2/z", ["A B", "C"])
    assert (w[1].title, w[1].url, w[1].publication_date) == ("", "http://x", "2025")
    trial = lambda n, date, first=None: {"protocolSection": {"identificationModule": {"nctId": n, "briefTitle": "T"}, "statusModule": {"overallStatus": "RECRUITING", "lastUpdatePostDateStruct": {"date": date}, "studyFirstPostDateStruct": {"date": first}}, "designModule": {"studyType": "INTERVENTIONAL", "enrollmentInfo": {"count": 40}}, "descriptionModule": {"briefSummary": "s"}}}
    t = research.trials_json(raw(spark, "json", *[json.dumps(trial(*x)) for x in (("N1", "2026-09-01"), ("N2", "2020-01-01"), ("N3", "2026-99"), ("N4", "", "2026-08-30"))]), F.lit("2026-08-01").cast("date")).orderBy("seq").collect()
    assert [(r.nct_id, r.publication_date) for r in t] == [("N1", "2026-09-01"), ("N3", "2026-99"), ("N4", "2026-08-30")]
    assert (t[0].url, t[0].recruitment_status, t[0].enrollment, t[0].evidence_type) == ("https://clinicaltrials.gov/study/N1", "RECRUITING", 40, "CLINICAL TRIAL")


def test_dedupe_by_the_first_key_that_there_is(spark):
    rows = [(0, "10.1/a", "", "", "Same paper"), (1, "10.1/a", "9", "", "Other"), (2, "", "9", "", "Third"), (3, "", "9", "N1", "Fourth"), (4, "", "", "N1", "Fifth"), (5, "", "", "", "Same-Paper!"), (6, "", "", "", "same paper"), (7, "", "", "", "!!"), (0, "10.1/a", "", "", "Same paper")]
    df = spark.createDataFrame([(*r, "p") for r in rows], "seq long, doi string, pmid string, nct_id string, title string, collector_source string")
    assert sorted(r.seq for r in research.deduped(df).collect()) == [0, 2, 4, 5]


def test_dates(spark):
    wanted = {
        "Fri, 04 Sep 2026 01:02:03 GMT": "2026-09-04 01:02:03", "4 Sep 2026 01:02:03 +0900": "2026-09-03 16:02:03", "2026-09-04": "2026-09-04 00:00:00", "2026-09-04T01:02:03Z": "2026-09-04 01:02:03", "2026-09-04T01:02:03+09:00": "2026-09-03 16:02:03",
        "2026-09-04T01:02:03": "2026-09-04 01:02:03", "4 September 2026": "2026-09-04 00:00:00", "September 4, 2026": "2026-09-04 00:00:00", "Sep 4, 2026": "2026-09-04 00:00:00", "14 Sep 2026": "2026-09-14 00:00:00", "yesterday": None, "": None, "2026-13-40": None,
    }
    got = spark.createDataFrame([(k,) for k in wanted], "s string").select("s", times.published(F.col("s")).cast("string").alias("t")).collect()
    assert {r.s: r.t for r in got} == wanted
    loose = {"2026": (2026, 1, 1), "2026-9": (2026, 9, 1), "2026-09-04": (2026, 9, 4), "2026-Sep": (2026, 9, 1), "2026-Sep-14": (2026, 9, 14), "2026-02-31": None, "n.d.": None, "2026/10/05": (2026, 10, 5)}
    got = spark.createDataFrame([(k,) for k in loose], "s string").select("s", times.loose_date(F.col("s")).alias("d")).collect()
    assert {r.s: r.d and (r.d.year, r.d.month, r.d.day) for r in got} == loose


def test_query_terms(spark):
    got = [r[0] for r in spark.createDataFrame([("myopia OR axial length or atropine",), ("one",), ("a OR b OR c OR d OR e OR f OR g",)], "q string").select(research.query_terms(F.col("q"))).collect()]
    assert got == [["myopia", "axial length", "atropine"], ["one"], ["a", "b", "c", "d", "e", "f"]]
