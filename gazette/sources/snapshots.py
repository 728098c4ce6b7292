"""Gold corpora and frozen snapshots read from files; bad input stops the query at the row that is bad."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette.functions import checks


def gold(spark: SparkSession, path: str, extra: str = "") -> DataFrame:
    """id, kind, expected and the ``extra`` fields of JSON lines. Blank lines are left out; a broken line, or one without a required key, stops the query."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    rows = lines.select("value", F.from_json("value", "id string, kind string, expected string" + (f", {extra}" if extra else ""), {"mode": "FAILFAST"}).alias("g"))
    full = F.col("g.id").isNotNull() & F.col("g.kind").isNotNull() & F.col("g.expected").isNotNull()
    return checks.must(rows, full, F.concat(F.lit("gold row without id, kind or expected: "), "value")).select("g.*")


def freeze(rows: DataFrame, folder: str) -> None:
    """Writes the rows (edition, chapter, place, row) of one edition as a chunk file for each chapter, and a manifest of them.

    A snapshot is what a desk has chosen, so that a chapter is one small document.
    """
    item = F.struct("place", "row")
    chunk = rows.groupBy("chapter").agg(F.first("edition").alias("edition"), F.count(F.lit(1)).alias("selected_count"), F.transform(F.sort_array(F.collect_list(item)), lambda x: x.row).alias("selected"))
    chunk.select("chapter", F.col("chapter").alias("of"), "edition", "selected_count", "selected").write.partitionBy("chapter").json(f"{folder}/chunks")
    files = rows.groupBy("edition", "chapter").agg(F.count(F.lit(1)).alias("n"))
    listed = files.groupBy("edition").agg(F.sum("n").alias("selected_count"), F.sort_array(F.collect_list(F.struct("chapter", "n"))).alias("files"))
    listed.write.json(f"{folder}/manifest")


def materialise(spark: SparkSession, folder: str, row: str) -> DataFrame:
    """chapter, pos (from 1), row: the rows of all chunks in the manifest's order, then as they stand in the chunk.

    The query stops if a chunk is not listed or a listed one is missing, and where a chunk's edition, its own or its
    listed count, or the manifest's sum is not what is there.
    """
    manifest = spark.read.schema("edition string, selected_count long, files array<struct<chapter:string,n:long>>").option("mode", "FAILFAST").json(f"{folder}/manifest")
    listed = manifest.select(F.col("edition").alias("of_edition"), F.col("selected_count").alias("sum"), F.posexplode("files").alias("at", "f")).select("of_edition", "sum", "at", F.col("f.chapter").alias("chapter"), F.col("f.n").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("of_edition").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    all_ = F.sum("n").over(Window.partitionBy("of_edition"))
    listed = listed.withColumns({"before": before, "all": all_})  # a row for each chapter
    chunks = spark.read.schema(f"of string, edition string, selected_count long, selected array<{row}>, chapter string").option("mode", "FAILFAST").json(f"{folder}/chunks")
    theirs = listed.withColumnRenamed("chapter", "listed")
    met = chunks.join(theirs, F.col("chapter") == F.col("listed"), "full")
    named = lambda said: F.concat(F.lit(f"{said} of chunk "), F.coalesce("chapter", "listed", F.lit("null")))
    both = checks.must_all(
        met, (F.col("chapter").isNotNull() & F.col("listed").isNotNull(), F.concat(F.lit("chunk and manifest differ at "), F.coalesce("chapter", "listed", F.lit("null")))),
        (F.col("edition") == F.col("of_edition"), named("wrong edition")), (F.col("of") == F.col("chapter"), named("wrong chapter")),
        ((F.col("selected_count") == F.size("selected")) & (F.col("n") == F.size("selected")), named("wrong count")), (F.col("sum") == F.col("all"), F.concat(F.lit("the manifest's sum is not "), F.col("all").cast("string"))),
    )
    return both.select("chapter", "before", F.posexplode("selected").alias("at", "row")).select("chapter", (F.col("before") + F.col("at") + 1).cast("int").alias("pos"), "row")
