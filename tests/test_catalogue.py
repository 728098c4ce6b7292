"""Queries against their SQL on the smallest tables, and operators against plain Python."""

import datetime
import decimal
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from gazette.functions import lineage, text, urls
from gazette.operators import select, similar
from gazette.plans import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 5)
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = catalogue.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    cur = duck.execute(catalogue.oracle_sql()[name])
    at = [[d[0] for d in cur.description].index(c) for c in cols]
    assert got == sorted((tuple(plain(r[k]) for k in at) for r in cur.fetchall()), key=str)


def test_greedy_select_equals_a_plain_loop(spark):
    draw = random.Random(3)
    rows = [(g, k, draw.randint(0, 5), draw.choice("abc"), draw.sample("pqrstuv", 3)) for g in range(6) for k in range(25)]
    df = spark.createDataFrame(rows, "g int, k int, score int, source string, tokens array<string>").withColumn("turn", -F.col("k"))
    got = select.greedy_select(df, ["g"], ["score", "turn"], 5, {"source": 2}, lambda a, b: text.jaccard(F.col(f"{a}.tokens"), F.col(f"{b}.tokens")) >= 0.45)
    wanted = set()
    for g in range(6):
        chosen = []
        for r in sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1])):
            clash = any(len({*r[4]} & {*c[4]}) / len({*r[4]} | {*c[4]}) >= 0.45 for c in chosen)
            if len(chosen) < 5 and sum(c[3] == r[3] for c in chosen) < 2 and not clash:
                chosen.append(r)
                wanted.add((g, len(chosen), r[1]))
    assert {(r.g, r.pick, r.k) for r in got.collect()} == wanted


def test_keep_first_either_counts_kept_rows_only(spark):
    df = spark.createDataFrame([("c", 1, "u1", "t1"), ("c", 2, "u2", "t1"), ("c", 3, "u2", "t3")], "chapter string, seq int, url string, title string")
    assert [r.seq for r in select.keep_first_either(df, "chapter", "url", "title", "seq").orderBy("seq").collect()] == [1, 3]


def test_shared_token_pairs_equal_brute_force(spark):
    draw = random.Random(4)
    sets = [sorted(draw.sample("abcdefghij", draw.randint(0, 6))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(sets)), "id int, tokens array<string>")
    got = {(r.l, r.r) for r in similar.shared_token_pairs(df, df, 2).collect()}
    assert got == {(a, b) for a, x in enumerate(sets) for b, y in enumerate(sets) if len({*x} & {*y}) >= 2}


def test_expressions(spark):
    row = spark.range(1).select(
        urls.domain(F.lit("https://WWW.A.example:8080/x?y")).alias("d"), urls.canonical_key(F.lit("http://a.b/c/?q#f")).alias("k"), urls.reject_reason(F.lit("ftp://x")).alias("r"),
        text.object_particle(F.lit("신문")).alias("p"), text.norm_title(F.lit("  A-b, 한글! ")).alias("n"), text.tokens(F.lit("Aa bb cc")).alias("t"), urls.suffixes(F.lit("a.b.c")).alias("s"),
    ).first()
    assert (row.d, row.k, row.r, row.p, row.n) == ("a.example", "http://a.b/c", "bad_url", "신문을", "a b 한글")
    assert row.t == ["aa", "bb", "cc", "aa_bb", "bb_cc"] and row.s == ["a.b.c", "b.c", "c"]


def test_a_filter_does_not_compute_columns_again(spark):
    """Neither does a column that names another several times; conditions of a filter would stand in the plan once more."""
    df = spark.createDataFrame([(1, "A-b c"), (2, None)], "id int, x string")
    t = lineage.once(df, {"x": text.norm_title(F.col("x"))})
    t = t.filter((F.length("x") > 2) & F.contains("x", F.lit("b"))).select("id", F.concat("x", "x").alias("y"))
    assert t._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1
    assert [(r.id, r.y) for r in t.collect()] == [(1, "a b ca b c")]


@pytest.mark.parametrize("name", ["f7_topic_relevance", "c2_priority_score", "s2_rss_entries"])
def test_texts_are_normalised_once(spark, name):
    """f7 has one pattern; c2 those of body and headline, and of addresses; s2 those of prefixes, fields and texts."""
    most = {"f7_topic_relevance": 1, "c2_priority_score": 4, "s2_rss_entries": 10}[name]
    plan = catalogue.queries()[name](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count("regexp_replace") <= most, plan.count("regexp_replace")


def test_set_equality_is_one_grouping(spark, duck):
    got = catalogue.queries()["j6_set_equality"](spark, DATA)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, got.collect())) == sorted(duck.execute(catalogue.oracle_sql()["j6_set_equality"]).fetchall())
