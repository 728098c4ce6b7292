"""Editions on disk: nested documents in a folder for each edition, rewritten one by one, and the latest by folder names alone."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def fold(articles: DataFrame, edition: str = "edition", chapter: str = "chapter", place: str = "place") -> DataFrame:
    """edition, chapters (array of chapter, count and articles), articles: each edition as one document.

    Chapters stand in the order of their names, articles in that of ``place``. An edition is what a desk has chosen, some
    hundred articles; candidates are not folded.
    """
    kept = [c for c in articles.columns if c not in (edition, chapter)]
    row = F.struct(place, *[F.col(f"`{c}`") for c in kept if c != place])
    by = articles.groupBy(edition, chapter).agg(F.sort_array(F.collect_list(row)).alias("articles"), F.count(F.lit(1)).alias("count"))
    item = F.struct(F.col(chapter).alias("chapter"), "count", "articles")
    return by.groupBy(edition).agg(F.sort_array(F.collect_list(item)).alias("chapters"), F.sum("count").alias("articles"))


def store(df: DataFrame, folder: str, edition: str = "edition") -> None:
    """Writes the rows of each edition to its own folder below ``folder``. Editions that ``df`` has are replaced whole, others are not touched; a rerun gives the same."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(edition).json(folder)


def editions(spark: SparkSession, folder: str, edition: str = "edition") -> dict[str, str]:
    """The editions below ``folder`` and their folders: from the names of one listing, no file is opened. There is one for each edition."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return {}
    names = [f.getPath() for f in files.listStatus(path) if f.isDirectory()]
    return {unquote(p.getName().split("=", 1)[1]): p.toString() for p in names if p.getName().startswith(f"{edition}=")}


def load(spark: SparkSession, folder: str, schema: str, only: str | None = None, edition: str = "edition") -> DataFrame:
    """The stored editions; with ``only``, that one, of whose folder alone files are listed and read. Broken files stop the query."""
    reader = spark.read.schema(f"{schema}, {edition} string").option("mode", "FAILFAST").option("basePath", folder)
    found = editions(spark, folder, edition)
    if only is None:
        return reader.json(folder)
    if only not in found:
        raise ValueError(f"there is no edition {only} in {folder}")
    return reader.json(found[only])


def latest(spark: SparkSession, folder: str, schema: str, edition: str = "edition") -> DataFrame:
    """The rows of the edition with the largest name."""
    found = editions(spark, folder, edition)
    if not found:
        raise ValueError(f"there is no edition in {folder}")
    return load(spark, folder, schema, max(found), edition)
