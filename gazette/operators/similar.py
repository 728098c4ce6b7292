"""Joins on similarity of token sets, by an equality join on rare tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shared_token_pairs(left: DataFrame, right: DataFrame, least: int, key: str = "id", tokens: str = "tokens", share: float = 0.0) -> DataFrame:
    """l, r, lt, rt: all pairs whose sets of tokens have ``least`` or more in common, and ``share`` of the smaller set.

    A set of m tokens that has t of them in common with a larger one has one of these among any m - t + 1 of its tokens.
    So the rarest m - t + 1 tokens of the smaller set of a pair are looked up among all tokens of the larger one: common
    tokens, of which a set with rarer ones needs none, bring few pairs together. The order is counted over both sides;
    ties go by the token. Tokens with very many sets are a skewed join, which Spark splits.
    """
    both = left.select(F.explode(tokens).alias("token")).union(right.select(F.explode(tokens).alias("token")))
    rarity = both.groupBy("token").count()
    n = F.size(tokens)
    needed = F.greatest(F.lit(least), F.ceil(n * share - 1e-9).cast("int"))

    def every(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col(key).alias(name), F.explode(tokens).alias("token"), n.alias(f"{name}n"), needed.alias("needed"))

    def rarest(df: DataFrame, name: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(name).orderBy("count", "token"))
        return every(df, name).join(rarity, "token").withColumn("place", place).filter(F.col("place") <= F.col(f"{name}n") - F.col("needed") + 1).select(name, f"{name}n", "token")

    smaller = rarest(left, "l").join(every(right, "r").drop("needed"), "token").filter("ln <= rn").select("l", "r")
    larger = rarest(right, "r").join(every(left, "l").drop("needed"), "token").filter("rn < ln").select("l", "r")
    met = smaller.union(larger).distinct()
    met = met.join(left.select(F.col(key).alias("l"), F.col(tokens).alias("lt")), "l").join(right.select(F.col(key).alias("r"), F.col(tokens).alias("rt")), "r")
    common = F.size(F.array_intersect("lt", "rt"))
    return met.filter((common >= least) & (common >= share * F.least(F.size("lt"), F.size("rt")) - 1e-9))


def event_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """l, r, lt, rt: pairs of the same event by :func:`same_event`, of which both branches ask for .4 of the smaller set."""
    return shared_token_pairs(left, right, 2, share=0.4).filter(same_event(F.col("lt"), F.col("rt")))


def corroborating(articles: DataFrame, pool: DataFrame, most: int = 3) -> DataFrame:
    """l (article), r (of the pool), score, rank: the ``most`` best rows of the pool that tell of an article's event.

    Both have id, tokens, link, source. A row with the article's own link, or of its publisher (if it has one), is no
    corroboration. Ties go to the smaller id of the pool.
    """
    plain = lambda df, a: df.select(F.col("id").alias(a), F.col("link").alias(f"{a}_link"), F.coalesce(F.trim("source"), F.lit("")).alias(f"{a}_source"))
    met = event_pairs(articles.select("id", "tokens"), pool.select("id", "tokens")).join(plain(articles, "l"), "l").join(plain(pool, "r"), "r")
    met = met.filter(~F.col("l_link").eqNullSafe(F.col("r_link")) & ((F.col("l_source") == "") | (F.col("l_source") != F.col("r_source"))))
    scored = met.select("l", "r", corroboration(F.col("lt"), F.col("rt")).alias("score"))
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy("l").orderBy(F.desc("score"), "r"))).filter(F.col("rank") <= most)


def attached(ranked: DataFrame, urls: DataFrame, primary: DataFrame, most: int = 2) -> DataFrame:
    """l, domain, url, place: the addresses that corroborate an article: resolved, one for each domain but its own, in order of rank.

    ``ranked`` is from :func:`corroborating`; ``urls`` has r, url, domain of what could be resolved; ``primary`` has l and
    its domain.
    """
    r = ranked.join(urls.filter("url IS NOT NULL AND domain IS NOT NULL"), "r").join(primary.select("l", F.col("domain").alias("__own")), "l", "left")
    r = r.filter(~F.col("domain").eqNullSafe(F.col("__own")))
    f = r.groupBy("l", "domain").agg(F.min_by("url", "rank").alias("url"), F.min("rank").alias("rank"))
    return f.withColumn("place", F.row_number().over(Window.partitionBy("l").orderBy("rank"))).filter(F.col("place") <= most).select("l", "domain", "url", "place")


def same_event(lt: Column, rt: Column) -> Column:
    """Two or more tokens in common, and Jaccard .25 or overlap .50."""
    both = F.size(F.array_intersect(lt, rt))
    return (both >= 2) & ((both / F.greatest(F.size(F.array_union(lt, rt)), F.lit(1)) >= 0.25) | (both / F.greatest(F.least(F.size(lt), F.size(rt)), F.lit(1)) >= 0.5))


def corroboration(lt: Column, rt: Column) -> Column:
    """2 * Jaccard + overlap + .05 * common tokens, of similarities rounded (half to even) to 3 places."""
    both = F.size(F.array_intersect(lt, rt))
    near = F.bround(both / F.greatest(F.size(F.array_union(lt, rt)), F.lit(1)), 3)
    over = F.bround(both / F.greatest(F.least(F.size(lt), F.size(rt)), F.lit(1)), 3)
    return F.bround(2 * near + over + 0.05 * both, 4)


def same_action(lt: Column, rt: Column, actions: list[str], entities: list[str]) -> Column:
    """Three or more tokens in common, and: an action with containment .34, or Jaccard .45, or an action and an entity with containment .30."""
    common = F.array_intersect(lt, rt)
    has = lambda terms: F.arrays_overlap(common, F.array(*[F.lit(t) for t in terms]))
    contained, near = F.size(common) / F.greatest(F.least(F.size(lt), F.size(rt)), F.lit(1)), F.size(common) / F.greatest(F.size(F.array_union(lt, rt)), F.lit(1))
    return (F.size(common) >= 3) & ((has(actions) & (contained >= 0.34)) | (near >= 0.45) | (has(actions) & has(entities) & (contained >= 0.30)))
