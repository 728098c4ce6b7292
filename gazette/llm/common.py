"""What several operators share: lineage cuts, bounded samples, ranks over a whole table."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word of a text, wherever a contract counts words.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows and bytes of one Arrow batch that a Python worker gets, at most (but for a single longer row).
BATCH_ROWS, BATCH_BYTES = 5_000, 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return small_batches(spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def small_batches(df: DataFrame) -> DataFrame:
    """``df``; its session hands Python workers batches of bounded rows and bytes from now on, so that memory does not follow the length of texts.

    Smaller bounds that the session has already stay.
    """
    conf = df.sparkSession.conf
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = re.sub(r"\D", "", str(conf.get(key)))
        if not now or int(now) <= 0 or int(now) > most:
            conf.set(key, str(most))
    return df


def cut(df: DataFrame) -> DataFrame:
    """``df``, written to the shared checkpoint folder, so that lost executors cost no earlier work.

    The folder is that of ``spark.checkpoint.dir``. Without one, a session on a single machine (tests) gets a folder there;
    on a cluster that would lose rows with a machine, and is refused.
    """
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        shared = context.getConf().get("spark.checkpoint.dir")
        if not shared and not re.match(r"local($|\[)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="spark-checkpoints-"))
    return df.checkpoint()


def one_label(labels: DataFrame, column: str) -> DataFrame:
    """doc_id, y: the label of each document that has one. Where rows of a document disagree, the smallest label counts."""
    known = labels.select("doc_id", F.col(column).cast("int").alias("y")).dropna()
    return known.groupBy("doc_id").agg(F.min("y").alias("y"))


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """crc32(doc_id as text) mod ``folds`` = ``fold``; a null doc_id is in no fold."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def unit(*cols: Column) -> Column:
    """A number in [0, 1) that depends on the values of ``cols`` alone."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


def bounded_sample(df: DataFrame, label: str, keys: list[str], bound: int) -> DataFrame:
    """About ``bound`` rows for each value of ``label`` at most, chosen by a hash of ``keys``; all rows of smaller classes."""
    counts = {row[0]: row[1] for row in df.groupBy(label).count().collect()}
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col(label).eqNullSafe(F.lit(value)), F.lit(min(1.0, bound / n))).otherwise(share)
    return df.filter(unit(F.lit(17), *[F.col(k) for k in keys]) < share)


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with its rows' place (from 0) in ``order``: range partitions, a rank in each, and the sizes of those before it.

    The range partitions are written before use, as Spark may draw other bounds when it computes them again.
    """
    parts = cut(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    sizes = parts.groupBy("__part").count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("__part", before.alias("__before"))  # one row for each partition
    ranked = parts.withColumn("__place", F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1)
    return ranked.join(F.broadcast(sizes), "__part").withColumn(name, F.col("__place") + F.col("__before")).drop("__part", "__place", "__before")
