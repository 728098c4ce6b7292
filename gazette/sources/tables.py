"""The stored tables as candidates, pages and fetch logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.functions import urls


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, chapter, source, title, summary, link, age_h, text: a document is a candidate whose first line is the headline."""
    d = table(spark, sf_dir, "documents")
    title = F.split_part(F.col("text"), F.lit("\n"), F.lit(1))
    link = F.format_string("https://%s.example.com/%s/%d", "source", "lang", "doc_id")
    return d.select(
        F.col("doc_id").alias("seq"), F.col("lang").alias("chapter"), "source", title.alias("title"), F.expr("substring(text, length(split_part(text, '\\n', 1)) + 2)").alias("summary"),
        link.alias("link"), (F.col("doc_id") % 240).cast("int").alias("age_h"), "text", "n_chars",
    )


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, domain, html, http_status, content_type: what a fetch of each page has found; statuses follow from ids."""
    p = table(spark, sf_dir, "pages")
    status = F.when(F.col("page_id") % 11 == 0, 404).when(F.col("page_id") % 13 == 0, 500).otherwise(200)
    kind = F.when(F.col("page_id") % 17 == 0, "application/pdf").otherwise("text/html")
    return p.select("page_id", "url", urls.domain(F.col("url")).alias("domain"), "html", status.alias("http_status"), kind.alias("content_type"))
