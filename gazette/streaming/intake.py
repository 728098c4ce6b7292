"""Structured Streaming jobs over stored tables: keep-first intake under a watermark, and health in windows."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gazette.functions import lineage


def shared_folder(spark: SparkSession) -> str:
    """A new folder under the shared checkpoint folder."""
    return f"{lineage.folder(spark)}/stream-{uuid.uuid4().hex}"


def arrivals(spark: SparkSession, sf_dir: str, name: str, files: int | None = None) -> DataFrame:
    """The files of a table as a stream, ``files`` to a batch. A pattern as path lets the table be one file as well as a folder."""
    reader = spark.readStream if files is None else spark.readStream.option("maxFilesPerTrigger", files)
    return reader.schema(spark.read.parquet(f"{sf_dir}/{name}.parquet").schema).parquet(f"{sf_dir}/{name}.parque[t]")


def drained(stream: DataFrame, mode: str = "append", by: str | None = None) -> DataFrame:
    """All that ``stream`` gives for what is there now, written to the shared folder with exactly one row each, and read back.

    With ``by``, rows of each of its values are an output of their own, a folder that is read without the others.
    """
    spark = stream.sparkSession
    folder = shared_folder(spark)
    writer = stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", f"{folder}/state").option("path", f"{folder}/rows")
    query = (writer.partitionBy(by) if by else writer).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


def keep_first(events: DataFrame, key: list[str], time: str, most_age: str) -> DataFrame:
    """The first row of each key that arrives within ``most_age``; a key's state is dropped when the watermark has passed it."""
    return events.withWatermark(time, most_age).dropDuplicatesWithinWatermark(key)


#: Groups over which rows that need no state are spread, and groups that keys share: each is one call of Python for a batch.
SPREAD, SHARED = 128, 1024


def admitted(events: DataFrame, key: list[str], published: str, arrived: str, horizon: Column, ahead: float = 0.25, skew: str = "3 days") -> DataFrame:
    """id, outcome of each row of a stream: kept, duplicate, stale, future or missing_date.

    ``events`` has id (long), the ``key`` columns, when a row was ``published`` and when it ``arrived``; ``horizon`` is the
    days for which a row of its chapter stays news. Older rows are stale, rows more than ``ahead`` days from the future
    are future; nothing is dropped unseen. Of the others the first of each key by arrival (then id) is kept, and those
    that arrive before its horizon has passed are duplicates; after that the key is free again.

    The horizon's end is a key's only state; the keys of a group are in one. Event time is the time of arrival: a key is dropped
    when the watermark, ``skew`` behind the latest arrival, has passed its end, with a timer for groups without rows, so that
    state does not grow with the stream. Arrivals must be at
    most ``skew`` behind those of earlier batches. Rows that need no state are spread over SPREAD groups, so that a hot
    key's stale rows are no single task; of a group's fresh rows of one batch the key and three numbers each are in memory.
    """
    day = 86_400_000_000
    at = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    x = events.withColumn(arrived, F.col(arrived).cast("timestamp")).withWatermark(arrived, skew)
    most = (horizon * day).cast("long")
    age = at(arrived) - at(published)
    told = F.when(age.isNull(), "missing_date").when(age < -ahead * day, "future").when(age > most, "stale")
    x = x.select("id", *key, arrived, at(arrived).alias("__at"), (at(published) + most).alias("__end"), told.alias("__told"))
    names = F.to_json(F.array(*[F.col(k).cast("string") for k in key]))
    fresh = F.col("__told").isNull()
    x = x.withColumn("__key", F.when(fresh, names))
    x = x.withColumn("__group", F.when(fresh, -1 - F.pmod(F.xxhash64("__key"), F.lit(SHARED))).otherwise(F.pmod(F.xxhash64("id"), F.lit(SPREAD))).cast("int"))

    def walk(group: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if not state.hasTimedOut and group[0] >= 0:  # told by the row alone
            for part in rows:
                yield pd.DataFrame({"id": part["id"].to_numpy(), "outcome": part["__told"].to_numpy()})
            return
        ends = dict(zip(*state.get, strict=True)) if state.exists else {}
        if not state.hasTimedOut:
            ids, at, over, keys = (np.concatenate(x) for x in zip(*((p["id"].to_numpy(), p["__at"].to_numpy(), p["__end"].to_numpy(), p["__key"].to_numpy()) for p in rows), strict=True))
            order = np.lexsort((ids, at))
            outcomes = []
            for k, arrival, until in zip(keys[order].tolist(), at[order].tolist(), over[order].tolist(), strict=True):
                kept = k not in ends or arrival >= ends[k]
                if kept:
                    ends[k] = until
                outcomes.append("kept" if kept else "duplicate")
            yield pd.DataFrame({"id": ids[order], "outcome": outcomes})
        passed = state.getCurrentWatermarkMs()
        ends = {k: end for k, end in ends.items() if end // 1_000 + 1 > passed}
        if ends:
            state.update((list(ends), list(ends.values())))
            state.setTimeoutTimestamp(min(ends.values()) // 1_000 + 1)
        elif state.exists:
            state.remove()

    return x.groupBy("__group").applyInPandasWithState(walk, "id long, outcome string", "keys array<string>, ends array<long>", "append", GroupStateTimeout.EventTimeTimeout)


def health(events: DataFrame, source: str, time: str, good: str, window: str, late: str) -> DataFrame:
    """Attempts and successes of each source in tumbling windows. A window is given out when it is closed."""
    n, ok = F.count(F.lit(1)), F.count_if(F.expr(good))
    g = events.withWatermark(time, late).groupBy(F.window(time, window).alias("w"), source)
    state = F.when(ok == n, "HEALTHY").when(ok > 0, "DEGRADED").otherwise("UNAVAILABLE")
    return g.agg(n.alias("attempts"), ok.alias("good"), state.alias("health")).select(F.col("w.start").alias("window_start"), source, "attempts", "good", "health")
