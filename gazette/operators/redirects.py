"""Redirects: chains of addresses resolved in a table, best source addresses, and discovery links made exact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.functions import checks, urls
from gazette.functions.lineage import settle


def resolve(moves: DataFrame, url: str = "url", target: str = "target") -> DataFrame:
    """url, final_url, hops, cycle: where each moved address ends.

    Pointers double: each round joins the table with itself, so that 2^k hops are taken after k rounds, however many
    rows there are. Each address on a chain is a row of its own, so that in every round some unfinished row ends unless
    only loops are left; a loop is named by its least address (final_url is null then, as for all that lead into it). Of
    several targets of one address the least counts; rows without an address or target, or that lead to themselves, are
    no moves. Only unfinished rows are joined, so that a common final address is no hot key.
    """
    m = moves.select(F.col(url).alias("url"), F.col(target).alias("at")).filter("url IS NOT NULL AND at IS NOT NULL AND url <> at")
    m = m.groupBy("url").agg(F.min("at").alias("at"))
    known = m.select(F.col("url").alias("at"), F.lit(True).alias("on"))
    step = m.join(known, "at", "left").select("url", "at", F.lit(1).cast("long").alias("hops"), F.coalesce("on", F.lit(False)).alias("on"), F.col("url").alias("least"))
    step, before = settle(step), None
    while True:
        now = step.agg(F.count_if("on"), F.sum(F.when(F.col("on"), F.xxhash64("url", "least")).cast("decimal(38,0)"))).first()
        if not now[0] or now == before:
            break
        before = now
        go, ended = step.filter("on"), step.filter("NOT on")
        nxt = step.select(F.col("url").alias("at"), F.col("at").alias("to"), F.col("hops").alias("more"), F.col("on").alias("still"), F.col("least").alias("other"))
        went = go.join(nxt, "at").select("url", F.col("to").alias("at"), (F.col("hops") + F.col("more")).alias("hops"), F.col("still").alias("on"), F.least("least", "other").alias("least"))
        step = settle(ended.unionByName(went))
    # What is still on its way is in a loop or leads into one; the loop's name is that of where it stands now.
    loops = step.filter("on").select(F.col("url").alias("at"), F.col("least").alias("cycle"))
    named = step.filter("on").join(loops, "at", "left").select("url", F.lit(None).cast("string").alias("final_url"), F.lit(None).cast("long").alias("hops"), "cycle")
    return step.filter("NOT on").select("url", F.col("at").alias("final_url"), "hops", F.lit(None).cast("string").alias("cycle")).unionByName(named)


def publisher_url(url: Column, resolvers: list[str], blocked: list[str]) -> Column:
    """``url`` if it is an http address of no resolver and of no host with one of the ``blocked`` marks; else null."""
    host = urls.domain(url)
    bad = host.isin(resolvers)
    for mark in blocked:
        bad = bad | host.contains(mark)
    return F.when(urls.is_http(url) & host.isNotNull() & ~bad, url)


def best_source(items: DataFrame, moved: DataFrame, resolvers: list[str], blocked: list[str], doi_base: str) -> DataFrame:
    """``items`` (doi, url) with best_url and state: publisher, scholarly or unresolved.

    An identifier comes first, as an address under ``doi_base``; it is followed through ``moved`` (url, final_url) only if
    its host is a resolver. The publisher's address it ends at counts, else the record's own address if that is one, else
    what the walk ended at. Empty and null values are no addresses.
    """
    doi, own = F.nullif(F.trim("doi"), F.lit("")), F.nullif(F.trim("url"), F.lit(""))
    x = items.withColumn("__first", F.coalesce(F.concat(F.lit(doi_base), doi), own))
    ends = moved.select(F.col("url").alias("__u"), F.col("final_url").alias("__end"))
    x = x.join(ends, F.col("__first") == F.col("__u"), "left")
    first = F.col("__first")
    walked = F.when(urls.domain(first).isin(resolvers), F.coalesce(publisher_url(F.col("__end"), resolvers, blocked), first)).otherwise(first)
    good, scholarly = publisher_url(walked, resolvers, blocked), publisher_url(own, resolvers, blocked)
    state = F.when(good.isNotNull(), "publisher").when(scholarly.isNotNull(), "scholarly").otherwise("unresolved")
    return x.select(*[F.col(f"`{c}`") for c in items.columns], F.coalesce(good, scholarly, walked, F.lit("")).alias("best_url"), state.alias("state"))


def exact(rows: DataFrame, found: DataFrame, link: str = "link", strict: bool = False) -> DataFrame:
    """``rows`` with exact_url: that of ``found`` (url, final_url) for the same address, whatever its query, fragment or last slash.

    Without ``strict``, an address that is not found or did not end has a null exact_url; with it, it stops the query and
    is named. Of several found addresses with one key the first by address counts.
    """
    ends = found.filter("final_url IS NOT NULL").groupBy(urls.canonical_key(F.col("url")).alias("__key")).agg(F.min(F.struct("url", "final_url")).alias("__x"))
    met = rows.withColumn("__own", urls.canonical_key(F.col(link))).join(ends, F.col("__own") == F.col("__key"), "left")
    met = met.select(*[F.col(f"`{c}`") for c in rows.columns], F.col("__x.final_url").alias("exact_url"))
    if not strict:
        return met
    return checks.must(met, F.col("exact_url").isNotNull(), F.concat(F.lit("no exact address for "), F.coalesce(F.col(link), F.lit("null"))))
