"""Assertions inside a plan: a row that breaks one stops the query and is named, nothing vanishes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def must(df: DataFrame, holds: Column, said: Column | str) -> DataFrame:
    """``df``; the query stops with the message ``said`` (a text, or a column that names the row) at a row where ``holds`` is not true. A null is not true."""
    message = F.lit(said) if isinstance(said, str) else said
    return df.filter(F.when(F.coalesce(holds, F.lit(False)), F.lit(True)).otherwise(F.raise_error(message)))


def must_all(df: DataFrame, *rules: tuple[Column, Column | str]) -> DataFrame:
    """``df``; the query stops at a row where one of the ``rules`` (condition, message) is not true, with the message of the first one. One filter, so that the order of rules holds."""
    said = F.lit(None).cast("string")
    for holds, message in reversed(rules):
        said = F.when(F.coalesce(holds, F.lit(False)), said).otherwise(F.coalesce(F.lit(message) if isinstance(message, str) else message, F.lit("a row breaks a rule")))
    return df.filter(F.when(said.isNull(), F.lit(True)).otherwise(F.raise_error(said)))


def must_match(df: DataFrame, other: DataFrame, key: list[str], said: str) -> DataFrame:
    """``df`` joined to ``other`` by ``key``; a row without a match on either side stops the query, with ``said`` and its key.

    ``other`` has one row for each key. Keys are compared so that nulls are equal.
    """
    mine = df.select([F.col(f"`{c}`") for c in df.columns]).withColumn("__l", F.lit(True))
    theirs = other.withColumn("__r", F.lit(True))
    on = [mine[k].eqNullSafe(theirs[k]) for k in key]
    named = F.concat_ws(" ", F.lit(said), *[F.coalesce(mine[k].cast("string"), theirs[k].cast("string"), F.lit("null")) for k in key])
    both = must(mine.join(theirs, on, "full"), F.col("__l").isNotNull() & F.col("__r").isNotNull(), named)
    return both.select(*[mine[c] for c in df.columns], *[theirs[c] for c in other.columns if c not in key])
