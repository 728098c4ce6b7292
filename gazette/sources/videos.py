"""Videos of an earlier edition, taken again only under the policy of today."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.functions import times

#: How a video's address is written; %s is its id.
WATCH = "https://www.youtube.com/watch?v=%s"


def cached_date(c: Column) -> Column:
    """A stored date: a moment, else the day that its first ten characters name."""
    return F.coalesce(times.published(c), F.try_to_timestamp(F.concat(F.substring(F.trim(c), 1, 10), F.lit("T00:00:00Z"))))


def cached(earlier: DataFrame, policy: DataFrame, as_of: Column, most: float, watch: str = WATCH) -> DataFrame:
    """The rows of ``earlier`` (source_id, channel, id, video_url, published_at, ...) that may stand in for missing videos, with source_tier, age and retrieval_mode.

    Their channel is one of ``policy`` (id, name, tier: a short table) by id and name, the id is a video's, the address is
    the one that the id makes, and the age at ``as_of`` is between -0.25 and ``most`` days. Where ``earlier`` is stored by
    source_id, the join lets Spark read only the folders of channels that the policy has.
    """
    channels = F.broadcast(policy.filter("id IS NOT NULL AND name IS NOT NULL").select(F.col("id").alias("__id"), F.col("name").alias("__name"), F.col("tier").alias("__tier")))
    x = earlier.join(channels, earlier["source_id"] == channels["__id"]).filter(F.col("channel") == F.col("__name"))
    age = (F.unix_micros(as_of) - F.unix_micros(cached_date(F.col("published_at")))) / 86_400_000_000
    x = x.filter(F.col("id").rlike("^[A-Za-z0-9_-]{6,}$") & (F.col("video_url") == F.format_string(watch, "id"))).withColumn("age", age)
    kept = [F.col(f"`{c}`") for c in earlier.columns if c not in ("source_tier", "retrieval_mode", "age")]
    return x.filter(F.col("age").between(-0.25, most)).select(*kept, F.col("__tier").alias("source_tier"), "age", F.lit("cached_verified").alias("retrieval_mode"))
