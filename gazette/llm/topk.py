"""Exact top-k search by inner product: Fagin's threshold algorithm over sorted per-dimension lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette.llm.common import cut, read

#: Rows of a shard of the index and of a block of queries, about.
SHARD_ROWS, QUERY_ROWS = 16_384, 8_192


def quantize(df: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """id (the key), row and ``q``: floor(scale * x) of every component, x as double.

    Vectors that are null or hold null or non-finite components are left out, as are null keys. Repeated rows stay, each
    with a ``row`` of its own. The table is written once, so that rows keep their numbers when executors are lost.
    """
    x = F.col(vector)
    sound = ~F.coalesce(F.exists(x, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf"))), F.lit(True))
    ints = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long"))
    found = cut(df.filter(F.col(key).isNotNull() & sound).select(F.col(key).cast("long").alias("id"), ints.alias("q")))
    return found.select("id", F.monotonically_increasing_id().alias("row"), "q")


def _matrix(lists: pd.Series, width: int) -> np.ndarray:
    """The lists as rows; missing components of shorter ones are 0."""
    if all(len(x) == width for x in lists):
        return np.array(lists.tolist(), dtype=np.int64).reshape(len(lists), width)
    out = np.zeros((len(lists), width), np.int64)
    for row, x in zip(out, lists, strict=True):
        row[: len(x)] = x
    return out


def threshold_search(ids: np.ndarray, rows: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query the ids and scores of its k best rows, but for rows with its own id; ties go to smaller ids.

    A sorted list for each dimension is read from the end that helps the query. Each newly met row is scored at once.
    The sum of the query's products with the values last read bounds what unmet rows can score; reading stops when
    that bound is below the k-th score, so that not even a tie is missed.
    """
    lists = np.argsort(rows, axis=0, kind="stable").astype(np.int32)
    n = len(ids)
    top = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, rows.shape[1])
    scored = rows.astype(np.float64) if top < 2**52 else rows  # exact in either type
    for query, self_id in zip(queries, own, strict=True):
        dims = np.flatnonzero(query)
        up = query[dims] < 0
        vector = query.astype(scored.dtype)
        met = np.zeros(n, bool)
        best_ids, best = np.empty(0, np.int64), np.empty(0, np.int64)
        depth, step = 0, 32
        while depth < n:
            end = min(n, depth + step)
            if len(dims):
                seen = met.copy()
                seen[lists[depth:end, dims[up]]] = True  # from the low end
                seen[lists[n - end : n - depth, dims[~up]]] = True  # from the high end
                fresh = np.flatnonzero(seen & ~met)
                met = seen
            else:  # every row scores 0
                fresh = np.arange(depth, end)
            fresh = fresh[ids[fresh] != self_id]
            score = (scored[fresh] @ vector).astype(np.int64)
            if len(best) == k:  # what is below the k-th score is out
                fresh, score = fresh[score >= best[-1]], score[score >= best[-1]]
            best_ids, best = np.concatenate([best_ids, ids[fresh]]), np.concatenate([best, score])
            first = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[first], best[first]
            if met.all():
                break
            if len(best) == k and len(dims):
                last = np.where(up, lists[end - 1, dims], lists[n - end, dims])
                if int((query[dims] * rows[last, dims]).sum()) < best[-1]:
                    break
            depth, step = end, step * 2
        yield best_ids, best


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows of ``vectors`` with the highest inner product with each row of ``queries``.

    Both tables have ``id``, ``row`` (its own number) and ``q`` (whole numbers; shorter vectors count as filled up with
    0). Rows with a query's own id are no answers to it. Every row is a candidate and every query row a query: rows that
    share an id are ranked and answered each by itself. Rows are spread over shards and queries over blocks by a hash;
    each shard meets each block once, holds its own sorted lists, and gives k rows a query at most, which are then
    ranked for each query. No tables, no queries or fewer than k rows give as many rows as there are.
    """
    shards = max(1, -(-vectors.count() // shard_rows))
    blocks = max(1, -(-queries.count() // query_rows))
    place = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    index = vectors.select(place(shards).alias("shard"), every(blocks).alias("block"), "id", "row", "q")
    asked = queries.select(every(shards).alias("shard"), place(blocks).alias("block"), "id", "row", "q")

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "row": [], "vec_id": [], "score": []}).astype("int64")
        width = max(max(map(len, left.q)), max(map(len, right.q)))
        own = right.id.to_numpy()
        found = list(threshold_search(left.id.to_numpy(), _matrix(left.q, width), _matrix(right.q, width), own, k))
        many = [len(i) for i, _ in found]
        return pd.DataFrame({
            "query_id": np.repeat(own, many),
            "row": np.repeat(right.row.to_numpy(), many),
            "vec_id": np.concatenate([i for i, _ in found]),
            "score": np.concatenate([s for _, s in found]),
        })

    by = ["block", "shard"]
    found = index.groupBy(*by).cogroup(asked.groupBy(*by)).applyInPandas(search, "query_id long, row long, vec_id long, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantize(read(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.filter(F.col("id") % 100 == 0))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS n, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, a.n, b.vec_id AS vec_id,
    CAST(coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))), 0) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
