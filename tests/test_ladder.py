"""Reject rules as tables: for each rule a row that only it rejects, broken tables, ties, nulls, and the report."""

import json

import pytest
from pyspark.sql import functions as F

from gazette.functions import urls
from gazette.operators import ladder


def rule(place, reason, chapter, *tests, least=None, most=None):
    return {"place": place, "reason": reason, "chapter": chapter, "least_tier": least, "most_tier": most, "tests": [{"field": f, "how": h, "terms": t, "present": p} for f, h, t, p in tests]}


SELECT = [
    rule(1, "excluded_topic", "world", ("text", "words", ["handball"], True)), rule(2, "low_relevance", "world", ("text", "words", ["treaty", "harbour talks"], False)),
    rule(3, "macro_wrong_chapter", "world", ("title", "words", ["prices"], True), ("title", "words", ["treaty"], False)),
    rule(4, "public_safety_wrong_chapter", "world", ("title", "words", ["thieves"], True), ("title", "words", ["border"], False)),
    rule(5, "low_impact_feature", "world", ("title", "words", ["school opens"], True), ("title", "words", ["treaty"], False)),
    rule(6, "weak_macro_signal", "money", ("title", "words", ["prices", "rates"], False), least=2), rule(7, "low_impact_primary_update", "money", ("title", "words", ["former clerk"], True), most=1),
    rule(8, "weak_company_signal", "firms", ("title", "words", ["profit"], False), least=2), rule(9, "low_impact_primary_update", "firms", ("title", "words", ["now available"], True), most=1),
]
ROWS = [
    ("world", 0, "Treaty signed", "handball", 0.5, "https://a.example/1", "excluded_topic"), ("world", 0, "Ships in port", "", 0.5, "https://a.example/1", "low_relevance"), ("world", 0, "Harbour-talks go on", "", 0.5, "https://a.example/1", None),
    ("world", 0, "Prices rise", "treaty", 0.5, "https://a.example/1", "macro_wrong_chapter"), ("world", 0, "Prices in the treaty", "", 0.5, "https://a.example/1", None), ("money", 0, "Prices rise", "", 0.5, "https://a.example/1", None),
    ("world", 0, "Thieves caught", "treaty", 0.5, "https://a.example/1", "public_safety_wrong_chapter"), ("world", 0, "Thieves at the border", "treaty", 0.5, "https://a.example/1", None),
    ("world", 0, "School opens", "treaty", 0.5, "https://a.example/1", "low_impact_feature"), ("world", 0, "Schools opens", "treaty", 0.5, "https://a.example/1", None),
    ("money", 2, "A quiet day", "", 0.5, "https://a.example/1", "weak_macro_signal"), ("money", 1, "A quiet day", "", 0.5, "https://a.example/1", None), ("money", None, "A quiet day", "", 0.5, "https://a.example/1", None),
    ("money", 1, "Former clerk fined", "", 0.5, "https://a.example/1", "low_impact_primary_update"), ("money", 2, "Former clerk on rates", "", 0.5, "https://a.example/1", None),
    ("firms", 4, "Shop moves", "", 0.5, "https://a.example/1", "weak_company_signal"), ("firms", 0, "Tool now available", "", 0.5, "https://a.example/1", "low_impact_primary_update"), ("firms", 2, "Profit up, now available", "", 0.5, "https://a.example/1", None),
    ("money", 0, "Rates", "", None, "https://a.example/1", "missing_date"), ("money", 0, "Rates", "", -1.5, "https://a.example/1", "future_date"), ("money", 0, "Rates", "", -0.5, "https://a.example/1", None), ("money", 0, "Rates", "", 7.5, "https://a.example/1", "stale"),
    ("money", 0, "Rates", "", 0.5, "ftp://a.example/1", "bad_url"), ("money", 0, "Rates", "", 0.5, "https://a.example/news/", "generic_url"), ("money", 0, "Rates", "", 0.5, "https://a.example/x?id=", "incomplete_url"), ("money", 0, "Rates", "", 0.5, "https://a.example/x?id=5", None),
    ("other", 0, "Handball", "handball", 0.5, "https://a.example/1", None), (None, 9, None, None, 0.5, "https://a.example/1", None),
]


def test_each_rule_rejects_a_row_that_no_other_does(spark):
    df = spark.createDataFrame(ROWS, "chapter string, tier int, title string, summary string, age double, url string, wanted string")
    rules = ladder.parse(spark, json.dumps(SELECT))
    fields = {"title": F.col("title"), "text": F.concat("title", F.lit(" "), "summary")}
    got = ladder.rejected(df, rules, fields, F.when(F.col("chapter") == "world", 3).otherwise(7)).collect()
    assert [(r.title, r.reason) for r in got] == [(r.title, r.wanted) for r in got]
    assert {r["reason"] for r in SELECT} <= {r.reason for r in got}
    for left_out in SELECT:  # without its rule a row is kept
        fewer = ladder.parse(spark, json.dumps([r for r in SELECT if r is not left_out]))
        again = ladder.rejected(df, fewer, fields, F.lit(7)).filter((F.col("wanted") == left_out["reason"]) & (F.col("chapter") == left_out["chapter"])).collect()
        assert again and all(r.reason is None for r in again)


FACTS = [
    rule(1, "non_factual_path", None, ("url", "segments", ["opinion", "press-review"], True)), rule(2, "public_safety_incident", "world", ("text", "contains", ["fire station"], True), ("text", "contains", ["blast"], True)),
    rule(3, "industrial_expansion_wrong_chapter", "world", ("title", "contains", ["smelter"], True), ("title", "contains", ["border"], False)), rule(4, "science_briefing", "science", ("title", "contains", ["briefing"], True)),
    rule(5, "science_content_filler", "science", ("title", "contains", ["podcast"], True)), rule(6, "prefer_primary_source", "science", ("source", "starts", ["agency"], True), ("title", "contains", ["probe"], True), ("title", "contains", ["launch", "lift off"], True)),
    rule(7, "historical_reference_data", "money", ("source", "contains", ["statistics"], True), ("text", "contains", ["census day"], True), ("text", "years_before", ["3"], True)),
]


def test_rules_before_selection(spark):
    rows = [
        ("any", "S", "T", "", "2024", "https://a.example/Opinion/1", "non_factual_path"), ("any", "S", "T", "", "2024", "https://a.example/opinions/1", None), ("world", "S", "Blast", "at a Fire station", "2024", "https://a.example/x", "public_safety_incident"),
        ("world", "S", "Blast", "at a mill", "2024", "https://a.example/x", None), ("world", "S", "Smelters grow", "", "2024", "https://a.example/x", "industrial_expansion_wrong_chapter"), ("world", "S", "Smelter on the border", "", "2024", "https://a.example/x", None),
        ("science", "S", "Media briefing", "", "2024", "https://a.example/x", "science_briefing"), ("science", "S", "A Podcast", "", "2024", "https://a.example/x", "science_content_filler"), ("science", "Agency of space", "Probe: launch day", "", "2024", "https://a.example/x", "prefer_primary_source"),
        ("science", "The Agency", "Probe launch", "", "2024", "https://a.example/x", None), ("science", "Agency", "Probe seen", "", "2024", "https://a.example/x", None), ("money", "Office of Statistics", "Census day 2021", "", "8 May 2024", "https://a.example/x", "historical_reference_data"),
        ("money", "Office of Statistics", "Census day 2022", "", "8 May 2024", "https://a.example/x", None), ("money", "Office of Statistics", "Census day 2021", "", None, "https://a.example/x", None), ("money", "Office of Statistics", "Census day 120215", "", "2024", "https://a.example/x", None),
        (None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, "chapter string, source string, title string, summary string, published string, url string, wanted string")
    fields = {"url": F.col("url"), "title": F.col("title"), "text": F.concat("title", F.lit(" "), "summary"), "source": F.col("source"), "published": F.col("published")}
    got = ladder.reasons(df, ladder.parse(spark, json.dumps(FACTS)), fields)
    assert [(r.title, r.reason) for r in got.collect()] == [(r[2], r[6]) for r in rows]
    report = {r.chapter: (r.kept, r.rejected, r.reasons) for r in ladder.report(got).collect()}
    assert report["science"] == (2, 3, {"prefer_primary_source": 1, "science_briefing": 1, "science_content_filler": 1}) and report[None] == (1, 0, {})
    assert ladder.report(got.limit(0)).count() == 0
    assert ladder.reasons(df, [], fields).filter("reason IS NOT NULL").count() == 0


def test_tables_that_cannot_be_read_stop(spark, tmp_path):
    (tmp_path / "rules.json").write_text(json.dumps(SELECT))
    assert [r.reason for r in ladder.read(spark, str(tmp_path / "rules.json"))] == [r["reason"] for r in SELECT]
    for bad, said in (([SELECT[0] | {"reason": None}], "not a rule"), ([SELECT[0] | {"tests": []}], "not a rule"), ([rule(1, "x", None, ("title", "guess", ["a"], True))], "not a rule")):
        with pytest.raises(Exception, match=said):
            ladder.parse(spark, json.dumps(bad))
    (tmp_path / "broken.json").write_text('[{"place": "first"')
    with pytest.raises(Exception):  # noqa: B017  the reader's own error
        ladder.read(spark, str(tmp_path / "broken.json"))
    with pytest.raises(ValueError, match="not given"):
        ladder.reasons(spark.createDataFrame([("a",)], "chapter string"), ladder.parse(spark, json.dumps(FACTS)), {"title": F.col("chapter")})


def test_addresses_of_sites_need_their_parameter(spark):
    sites = (("stat.example", "/detail.php", "id"),)
    rows = ["https://www.stat.example/today/detail.php", "https://stat.example/today/detail.php?id=", "https://stat.example/today/detail.php?x=1&id=7", "https://other.example/detail.php", "https://a.example/b?", "https://a.example/b?story", "https://a.example/world", None]
    df = spark.createDataFrame([(r,) for r in rows], "url string")
    assert [r[0] for r in df.select(urls.reject_reason(F.col("url"), sites=sites)).collect()] == ["incomplete_url", "incomplete_url", None, None, "incomplete_url", "incomplete_url", "generic_url", "bad_url"]
