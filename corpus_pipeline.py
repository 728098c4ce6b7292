"""A corpus in five stages: language, quality, near duplicates, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm import language, mixing, neardup, packing, quality
from gazette.llm.common import cut, read

#: Least probability of the nearest language, and least quality, of documents that stay.
LANGUAGE, QUALITY = 0.3, 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the stage has learned from those of known language; without a letter, or between all languages, they go."""
    made = language.learn(docs)
    found = docs.withColumn("__found", language.predicted(F.col("text"), made))
    return found.filter((F.col("__found.lang_pred") != "und") & (F.col("__found.score") >= LANGUAGE)).select(*[F.col(f"`{c}`") for c in docs.columns])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is QUALITY or more."""
    net = quality.learn(docs, read(spark, sf_dir, "labels"))
    found = docs.withColumn("__score", quality.scored(F.col("text"), net))
    return found.filter(F.col("__score") >= QUALITY).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, 80 %) the document with the least doc_id, once."""
    return neardup.representatives(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix_documents(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in training sequences."""
    return packing.pack(docs)


STAGES = [
    ("language ID", language_id),
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_duplicates),
    ("source mixing", source_mixing),
    ("packing", sequence_packing),
]
#: Several stages are trained models or draw at random, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over documents; each stage's rows are written before the next one reads them."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
