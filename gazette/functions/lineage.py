"""Lineage cuts for iterative jobs, and columns that a plan computes once."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def settle(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder of :func:`folder`."""
    context = df.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(folder(df.sparkSession))
    return df.checkpoint()


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with ``columns``, computed once a row. Filters and columns that name plain columns compute these again for each place that names them.

    All of them are computed, needed or not, as a generated row is not pruned.
    """
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in columns], F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()])))) if columns else df


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; without one, a new folder of a session on a single machine. A cluster has to name one."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared and not re.match(r"local($|\[)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return shared or tempfile.mkdtemp(prefix="spark-checkpoints-")
