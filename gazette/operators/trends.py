"""Trending words: mergeable sketches find the candidates, an exact count decides, a pool fills what is missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Items that a sketch keeps. An item that it has lost occurs at most LOST times the sum of all counts (the sketch's own bound, 3.5 by its map of twice the size, doubled).
TRACKED = 4_096
LOST = 7.0 / (2 * TRACKED)


def sketches(words: DataFrame, by: list[str], word: str = "word") -> DataFrame:
    """by, sketch, n: of each part (a day, say) a sketch of its frequent words and how many words it has. Sketches of parts can be kept and merged."""
    return words.groupBy(*by).agg(F.expr(f"approx_top_k_accumulate({word}, {TRACKED})").alias("sketch"), F.count(F.lit(1)).alias("n"))


def candidates(parts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """by, word, n: the words that merged sketches track, and the sum of all counts."""
    merged = parts.groupBy(*(by or [])).agg(F.expr(f"approx_top_k_combine(sketch, {TRACKED})").alias("sketch"), F.sum("n").alias("n"))
    return merged.select(*(by or []), F.explode(F.expr(f"approx_top_k_estimate(sketch, {TRACKED})")).alias("x"), "n").select(*(by or []), F.col("x.item").alias("word"), "n")


def trending(words: DataFrame, target: int = 20, pool: list[tuple[str, str]] | None = None, least: int = 2) -> DataFrame:
    """word, n, category, rank: the ``target`` most frequent of the ``words`` (seq, pos, word, category); ties by first place.

    category is that of the last article with the word (then of the last place in it). Words under ``least`` characters
    do not count. One pass sketches all words; the few that the sketch tracks are counted exactly in a second one. If the
    last place's count is not above what a lost word can have, the answer is not proven and all words are counted.
    Where fewer words are there, those of ``pool`` (word, category) follow in order, without a count.
    """
    rows = words.filter(F.length("word") >= least)
    best = [F.desc("n"), "first.seq", "first.pos", "word"]

    def counted(df: DataFrame) -> DataFrame:
        at = F.struct("seq", "pos")
        return df.groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("first"), F.max_by("category", at).alias("category"))

    few = candidates(sketches(rows.select("word").withColumn("__all", F.lit(1)), ["__all"]), ["__all"]).cache()  # no words: no sketch
    total = (few.agg(F.max("n")).first()[0] or 0) * LOST
    some = counted(rows.join(F.broadcast(few.select("word")), "word")).orderBy(*best).limit(target).collect()  # `target` rows
    if len(some) < target or some[-1].n <= total:
        some = counted(rows).orderBy(*best).limit(target).collect()
    few.unpersist()
    spark = words.sparkSession
    out = [(r.word, r.n, r.category, k + 1) for k, r in enumerate(some)]
    known = {r.word for r in some}
    for word, category in pool or []:
        if len(out) < target and word not in known:
            known.add(word)
            out.append((word, None, category, len(out) + 1))
    return spark.createDataFrame(out, "word string, n long, category string, rank int")
