"""Fetched pictures: their bytes as a binary column, kind by first bytes, and what a fetch has shown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that are hashed, and the fewest that make a picture.
HASHED, SMALLEST = 96_000, 1_024
#: First bytes of kinds of pictures, as hex digits.
MAGIC = (("image/png", "^89504E470D0A1A0A"), ("image/jpeg", "^FFD8FF"), ("image/gif", "^47494638(37|39)61"), ("image/webp", "^52494646.{8}57454250"), ("image/bmp", "^424D"), ("image/x-icon", "^00000100"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """path, head, size: the first bytes of each stored file, as many as are hashed, and its whole size. Files without a byte are not listed."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", F.substring("content", 1, HASHED).alias("head"), F.col("length").alias("size"))


def kind(head: Column) -> Column:
    """The kind of a picture by its first bytes; svg by its markup; null for what is none."""
    first, out = F.hex(F.substring(head, 1, 16)), F.lit(None).cast("string")
    for name, pattern in reversed(MAGIC):
        out = F.when(first.rlike(pattern), name).otherwise(out)
    text = F.lower(F.decode(F.substring(head, 1, 512), "ISO-8859-1"))
    return F.coalesce(out, F.when(text.rlike(r"(?s)^[\s\xEF\xBB\xBF]*(<\?xml.*)?(<!--.*-->\s*)?(<!doctype svg.*)?<svg[\s>]"), "image/svg+xml"))


def verified(log: DataFrame) -> DataFrame:
    """``log`` with image_status, image_type, image_hash: whether each fetch brought a raster picture.

    log has url, final_url, http_status, content_type, error_class (of a failed fetch), head (binary). Statuses: the error's
    class, UNAVAILABLE without an answer, HTTP_n but for 200 and 206, NON_RASTER_IMAGE by the declared type or, where that
    is an image, by first bytes that are an svg's or icon's, TOO_SMALL, TYPE_MISMATCH where the first bytes are no
    picture's at all, VERIFIED. The hash is that of the first HASHED bytes, of verified pictures only.
    """
    said, head = F.trim(F.lower(F.split_part(F.coalesce("content_type", F.lit("")), F.lit(";"), F.lit(1)))), F.substring("head", 1, HASHED)
    found = kind(F.col("head"))
    none = F.lit(None).cast("string")
    status = (
        F.when(F.col("error_class").isNotNull(), F.col("error_class")).when(F.col("http_status").isNull(), "UNAVAILABLE").when(~F.col("http_status").isin(200, 206), F.concat(F.lit("HTTP_"), F.col("http_status").cast("string")))
        .when(~said.startswith("image/") | said.isin("image/svg+xml", "image/x-icon"), "NON_RASTER_IMAGE").when(F.col("__kind").isin("image/svg+xml", "image/x-icon"), "NON_RASTER_IMAGE")
        .when(F.coalesce(F.octet_length(head), F.lit(0)) < SMALLEST, "TOO_SMALL").when(F.col("__kind").isNull(), "TYPE_MISMATCH").otherwise("VERIFIED")
    )
    x = log.withColumn("__kind", found).withColumn("image_status", status)
    good = F.col("image_status") == "VERIFIED"
    return x.select(*[F.col(f"`{c}`") for c in log.columns], "image_status", F.when(good, F.col("__kind")).otherwise(none).alias("image_type"), F.when(good, F.sha2(head, 256)).alias("image_hash"))
