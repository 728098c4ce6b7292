"""How far candidates are gathered: queries up to a number, fallback queries where that is short, rescue where little is fresh, windows that widen."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gazette.functions.lineage import settle

#: Tiers in the order in which they are asked.
TOPIC, QUERY, FALLBACK, RESCUE = "topic", "query", "fallback", "rescue"


def _firsts(rows: DataFrame, group: str, key: str) -> DataFrame:
    """Of the rows of each group with one key the first by step and seq."""
    least = rows.groupBy(group, key).agg(F.min(F.struct("step", "seq")).alias("__x")).select(group, key, F.col("__x.step").alias("step"), F.col("__x.seq").alias("seq"))
    return rows.join(least, [group, key, "step", "seq"], "left_semi")


def _asked(rows: DataFrame, group: str, before: DataFrame | None, most: int) -> DataFrame:
    """group, step: the steps that run, one after the other until ``most`` are there; step 0 always does.

    Only counts of steps are brought together: a group has as many as it has queries. Steps without a row change no sum.
    """
    n = rows.groupBy(group, "step").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy(group).orderBy("step")
    sofar = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    n = n.withColumn("sofar", sofar)
    if before is not None:
        n = n.join(before, group, "left").withColumn("sofar", F.col("sofar") + F.coalesce("held", F.lit(0)))
    return n.filter((F.col("step") == 0) | (F.col("sofar") < most)).select(group, "step")


def gathered(rows: DataFrame, group: str, key: str, enough: int = 30, least: int = 15, filled: int = 20, fresh_target: int = 10) -> DataFrame:
    """``rows`` that a walk through the tiers gathers: group, key, tier, step (the query's number in its tier, from 0), seq, fresh, ...

    Topic feeds are all read, then queries in turn until ``enough`` different keys are there. Where fewer than ``least``
    are, fallback queries follow until ``filled`` are. Where fewer than ``fresh_target`` of all these are fresh, the whole
    rescue tier is added, its keys once, even those that are there already. The count after a query decides whether the
    next one is asked, so that the first one of a tier always is. A key counts in the group's first row that has it, by
    tier, step and seq; rows without a key are left out. No group is brought together: first rows are aggregates by key,
    counts of queries are what windows run over.
    """
    known = rows.filter(F.col(key).isNotNull())
    first = settle(_firsts(known.filter(F.col("tier").isin(TOPIC, QUERY)).withColumn("step", F.when(F.col("tier") == TOPIC, -1).otherwise(F.col("step"))), group, key))
    held = first.filter("step = -1").groupBy(group).agg(F.count(F.lit(1)).alias("held"))
    queries = _asked(first.filter("step >= 0"), group, held, enough)
    base = settle(first.filter("step = -1").unionByName(first.filter("step >= 0").join(queries, [group, "step"], "left_semi").select(first.columns)))
    groups = known.select(group).distinct()
    sizes = groups.join(base.groupBy(group).agg(F.count(F.lit(1)).alias("held")), group, "left").select(group, F.coalesce("held", F.lit(0)).alias("held"))
    short = sizes.filter(F.col("held") < least)
    more = known.filter(F.col("tier") == FALLBACK).join(short.select(group), group, "left_semi").join(base.select(group, key), [group, key], "left_anti").select(rows.columns)
    more = _firsts(more, group, key)
    steps = _asked(more, group, short, filled)
    got = settle(base.unionByName(more.join(steps, [group, "step"], "left_semi").select(base.columns)))
    fresh = groups.join(got.groupBy(group).agg(F.count_if("fresh").alias("n")), group, "left").filter(F.coalesce("n", F.lit(0)) < fresh_target).select(group)
    rescue = _firsts(known.filter(F.col("tier") == RESCUE).join(fresh, group, "left_semi").select(rows.columns), group, key)
    return got.withColumn("step", F.greatest("step", F.lit(0))).unionByName(rescue.select(got.columns))


def widening(df: DataFrame, group: list[str], age: str, windows: tuple[int, ...], choose: Callable[[DataFrame, list[str]], DataFrame], target: int) -> DataFrame:
    """The choice of each group in the narrowest of nested ``windows`` (days) in which it has ``target`` rows, with ``window_days``.

    A row is tagged with the narrowest window that holds it and stands in all wider ones, so that ``choose`` (of rows and
    the columns that part them) makes the choices of all windows in one pass over one scan. Groups that no window fills
    have no rows. Rows without an age are in no window.
    """
    held = F.filter(F.array(*[F.lit(w) for w in sorted(windows)]), lambda w: F.col(age) <= w)
    wide = df.select("*", F.explode(held).alias("window_days"))
    chosen = settle(choose(wide, [*group, "window_days"]))
    full = chosen.groupBy(*group, "window_days").count().filter(F.col("count") == target)
    first = full.groupBy(*group).agg(F.min("window_days").alias("window_days"))
    return chosen.join(first, [*group, "window_days"], "left_semi")
