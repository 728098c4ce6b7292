"""Target-distribution importance resampling: hashed n-gram weights, Gumbel scores, and a parallel sort by regular sampling."""

from __future__ import annotations

import math
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette.llm.common import cut, read, small_batches

#: Bytes of a text whose words are in memory at once, about.
SLICE = 1 << 20
#: Sorted runs, samples of each run, and segments of the exchange, at most. RUNS * RUNS samples go to the driver (under 10 MB).
RUNS = 384

#: Bytes of words (digits, a to z, all of other characters' UTF-8) stay, capitals become small, all else is a blank.
_FOLD = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def codes(text: bytes | None, runs: int = 2) -> Iterator[np.ndarray]:
    """crc32 of every run of 1 to ``runs`` words in turn joined by a blank, repeats included, in slices of a text.

    A checksum goes on from that of the run's first words, so that no run is put together.
    """
    folded = (text or b"").translate(_FOLD)
    start, carry = 0, [[] for _ in range(runs)]  # carry: of each number of words, the run that ends with the last word so far
    while start < len(folded):
        end = folded.find(b" ", min(len(folded), start + SLICE))
        end = len(folded) if end < 0 else end
        words, start = folded[start:end].split(), end
        if not words:
            continue
        blanks = [b" " + w for w in words]
        levels = [list(map(zlib.crc32, words))]
        for shorter in carry[: runs - 1]:
            begun = shorter + levels[-1][:-1]  # each goes on with the word after it
            levels.append(list(map(zlib.crc32, blanks[len(words) - len(begun) :], begun)))
        carry = [x[-1:] for x in levels]
        yield np.fromiter((c for x in levels for c in x), np.uint32, sum(map(len, levels)))


def bucket_counts(df: DataFrame, text: str = "text", buckets: int = 10_000, runs: int = 2) -> np.ndarray:
    """How often the features of all texts fall into each bucket: one array of fixed size a partition, summed on Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for x in batch.column(0):
                for found in codes(x.as_py(), runs):
                    total += np.bincount(found % buckets, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], ["bucket", "n"])

    rows = small_batches(df).select(F.col(text).cast("binary")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)  # `buckets` rows at most, however many texts
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray, scale: int = 1000) -> np.ndarray:
    """floor(scale * ln) of how much likelier each bucket is in the target than in the source, each count plus one."""
    all_s, all_t, k = int(source.sum()), int(target.sum()), len(source)
    ratio = [(t + 1) * (all_s + k) / ((s + 1) * (all_t + k)) for s, t in zip(source.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(scale * math.log(r)) for r in ratio], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, least_words: int, runs: int = 2) -> DataFrame:
    """doc_id, n_features, weight, enough: features of each document, the floored mean of their gains, and whether it has ``least_words`` words.

    Gains stand in one array; a document's buckets index it.
    """
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, weights, enough = [], [], []
            for x in batch.column(1):
                n = total = 0
                for found in codes(x.as_py(), runs):
                    n += len(found)
                    total += int(gain[found % buckets].sum())
                sizes.append(n)
                weights.append(total // n if n else 0)
                # n words make n + (n - 1) + .. features, as far as runs go
                enough.append(n >= sum(max(0, least_words - k) for k in range(runs)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(weights, pa.int64()), pa.array(enough, pa.bool_())], ["doc_id", "n_features", "weight", "enough"])

    kind = "doc_id long, n_features long, weight long, enough boolean"
    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary")).mapInArrow(run, kind)


def sorted_ranks(df: DataFrame, score: str = "score", key: str = "doc_id", runs: int = RUNS, name: str = "rank") -> DataFrame:
    """``df`` with each row's place (from 1) by falling ``score``, then rising ``key`` (null last): a parallel sort by regular sampling.

    Each partition is a run that is sorted where it lies. Samples at regular places of all runs, sorted, give regular
    splitters. Runs send each row to the segment between two splitters, a segment is merged by itself, and the sizes of
    the segments before it make a row's place in it its rank. With as many samples a run as segments no segment has
    more than about twice its share, and rows are told apart by their place in the table at last, so that ties and
    repeated rows are split as well. The table is written first: runs and places stay what they are if executors are lost.
    No rows give no rows.
    """
    row = "__row"
    kept = cut(df.withColumn(row, F.monotonically_increasing_id()))
    few = kept.coalesce(min(runs, max(1, kept.rdd.getNumPartitions()))).withColumn("__run", F.spark_partition_id())
    order = [F.col(score).desc(), F.col(key).asc_nulls_last(), F.col(row).asc()]
    sizes = {r[0]: r[1] for r in few.groupBy("__run").count().collect()}  # `runs` rows at most
    parts = max(1, len(sizes))

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            n = sizes[batch.column(3)[0].as_py()]
            wanted = np.unique(np.arange(1, parts) * n // parts)
            here = wanted[(wanted >= at) & (wanted < at + batch.num_rows)] - at
            at += batch.num_rows
            if len(here):
                yield pa.RecordBatch.from_arrays([batch.column(k).take(pa.array(here)) for k in range(3)], ["s", "k", "r"])

    picked = few.select(F.col(score).cast("long"), F.col(key).cast("long"), row, "__run").sortWithinPartitions(*order)
    place = lambda s, k, r: (-s, k is None, k or 0, r)
    samples = sorted(place(*r) for r in picked.mapInArrow(sample, "s long, k long, r long").collect()) if parts > 1 else []
    splitters = sorted({samples[k * len(samples) // parts] for k in range(1, parts)}) if samples else []  # `runs` at most

    @F.pandas_udf("int")
    def segment(falling: pd.Series, unknown: pd.Series, k: pd.Series, r: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(splitters, x) for x in zip(falling, unknown, k, r, strict=True)], dtype="int32")

    key_ = F.col(key).cast("long")
    dealt = cut(kept.withColumn("__segment", segment(-F.col(score).cast("long"), key_.isNull(), F.coalesce(key_, F.lit(0)), F.col(row))))
    counts = sorted((r[0], r[1]) for r in dealt.groupBy("__segment").count().collect())  # RUNS + 1 rows at most
    before = df.sparkSession.createDataFrame([(s, sum(n for t, n in counts if t < s)) for s, _ in counts], "__segment int, __before long")
    merged = dealt.withColumn("__place", F.row_number().over(Window.partitionBy("__segment").orderBy(*order)))
    ranked = merged.join(F.broadcast(before), "__segment").withColumn(name, F.col("__before") + F.col("__place"))
    return ranked.drop("__segment", "__before", "__place", row)


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, buckets: int = 10_000, seed: int = 7, runs: int = 2) -> DataFrame:
    """doc_id, n_features, weight, score, rank: documents drawn without replacement in proportion to their likeness to ``target``.

    Features are all runs of 1 to ``runs`` words; their counts over all of ``docs`` and of ``target`` make each bucket's
    gain. A score is the weight plus Gumbel noise of the doc_id, so that the highest floor(percent * N / 100) of the N
    documents with ``least_words`` words are the draw; rank is their order, null for others. A null text has no features
    and the weight 0; a null doc_id draws as an empty one. Repeated rows are rows of their own. Without documents there
    are no rows, without a target text all gains follow from the counts of ``docs``. Other columns are not looked at.
    """
    gain = gains(bucket_counts(docs, buckets=buckets, runs=runs), bucket_counts(target, buckets=buckets, runs=runs))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    rows = cut(weighed(docs, gain, least_words, runs).withColumn("score", F.col("weight") + noise))
    all_enough = rows.filter("enough")
    drawn = percent * all_enough.count() // 100
    ranked = sorted_ranks(all_enough.drop("enough")).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = rows.filter("not enough").drop("enough").withColumn("rank", F.lit(None).cast("long"))
    return ranked.select("doc_id", "n_features", "weight", "score", "rank").unionByName(rest)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
