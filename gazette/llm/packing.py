"""Packing tokenized documents into training sequences: shortest-pack-first over the length histogram."""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gazette.llm.common import cut, read

#: Rests of documents may be cut at multiples of this, if whole rests pack with more than PADDING of their length as padding.
GRAIN, PADDING = 512, 0.01
#: Pieces of one length that get their ranks in one task, about; pieces that a Python worker holds, about.
RANK_ROWS, OUT_ROWS = 100_000, 500


@lru_cache
def _tokenizer(vocabulary: str):
    """The tokenizer of the contract: byte-level BPE with added tokens."""
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))


@lru_cache
def _added(vocabulary: str) -> tuple[str, ...]:
    """The strings that the tokenizer takes as one token wherever they stand."""
    import public_tokenizers

    with open(public_tokenizers.path(f"{vocabulary}.json"), encoding="utf-8") as file:
        return tuple(x["content"] for x in json.load(file)["added_tokens"])


@lru_cache
def _ranks(vocabulary: str):
    """The same vocabulary from its file of ranks. It knows no added tokens; texts without one get the same ids four times as fast."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_ids(text: str | None, end_id: int = 1, vocabulary: str = "byte_bpe_50k") -> np.ndarray:
    """The tokenizer's ids of a text as little-endian unsigned 32-bit numbers, then ``end_id``. A null text is empty."""
    text = text or ""
    ids = None
    if not any(x in text for x in _added(vocabulary)):
        try:
            ids = _ranks(vocabulary).encode_to_numpy(text)
        except ValueError:  # its pattern has no room for a run of very many blanks
            ids = None
    if ids is None:
        ids = _tokenizer(vocabulary).encode(text, add_special_tokens=False).ids
    return np.append(np.asarray(ids, "<u4"), np.array([end_id], "<u4"))


def pieces(docs: DataFrame, size: int = 2048, end_id: int = 1, grain: int = GRAIN) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, parts: every document, cut after each ``size`` ids.

    parts has (start, length, ids_crc32) of the two parts of a rest that is cut at a multiple of ``grain``, else null.
    """
    part = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]))
    out = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("parts", part)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if len(rows) >= OUT_ROWS:
                    yield pa.RecordBatch.from_pylist(rows, schema=out)
                    rows = []
                ids = token_ids(text.as_py(), end_id)
                for start in range(0, len(ids), size):
                    piece = ids[start : start + size]
                    main = len(piece) - len(piece) % grain
                    parts = None
                    if len(piece) < size and 0 < main < len(piece):
                        spans = ((start, piece[:main]), (start + main, piece[main:]))
                        parts = [{"start": s, "length": len(x), "ids_crc32": zlib.crc32(x)} for s, x in spans]
                    rows.append({"doc_id": doc_id, "start": start, "length": len(piece), "ids_crc32": zlib.crc32(piece), "doc_tokens": len(ids), "parts": parts})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=out)

    kind = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, parts array<struct<start:long,length:long,ids_crc32:long>>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, kind)


def pack_histogram(histogram: dict[int, int], size: int = 2048) -> tuple[list[tuple[int, int, int, int, int]], int, int]:
    """Placements (length, first rank, count, first sequence, offset), number of sequences, padding.

    Lengths come longest first. Each goes to the shortest pack, if it fits there, else to a new one. Packs with one
    pattern are a run of sequences and are handled as one count, so that the work depends on the lengths, not on the
    number of pieces: pieces with ranks first..first+count-1 of their length go to as many sequences in turn.
    """
    runs: list[tuple[int, int, int]] = []  # (-room, first sequence, count)
    placed, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            if runs and -runs[0][0] >= length:
                room, first, count = heapq.heappop(runs)
                room = -room
            else:
                room, first, count = size, sequences, left
                sequences += left
            n = min(left, count)
            placed.append((length, rank, n, first, size - room))
            if count > n:
                heapq.heappush(runs, (-room, first + n, count - n))
            if room > length:
                heapq.heappush(runs, (length - room, first, n))
            left, rank = left - n, rank + n
    # A sequence whose length is a power of two is not padded.
    padding = sum(-room * n for room, _, n in runs if (used := size + room) & (used - 1))
    return placed, sequences, padding


def pack(docs: DataFrame, size: int = 2048, end_id: int = 1, grain: int = GRAIN, most_padding: float = PADDING) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: every piece of every document and its place.

    Documents are cut into pieces of ``size`` ids and a rest. The histogram of lengths (``size`` numbers at most) is
    packed on the driver; pieces of a length are ranked in salted groups, so that a common length is no single task,
    and find their sequence by length and rank. Should whole rests leave more than the share ``most_padding`` as padding,
    they are packed cut at multiples of ``grain`` as well, and the better packing is taken. A null text is an empty one:
    its only id is ``end_id``. A null doc_id and repeated rows are packed like others. An empty table gives no rows.
    Other columns are not looked at.
    """
    spark = docs.sparkSession
    whole = cut(pieces(docs, size, end_id, grain))
    histogram = lambda df: {r[0]: r[1] for r in df.groupBy("length").count().collect()}  # noqa: E731  at most `size` rows
    counts = histogram(whole)
    placed, sequences, padding = pack_histogram(counts, size)
    if sequences and padding > most_padding * sequences * size:
        own = F.array(F.struct("start", "length", "ids_crc32"))
        finer = whole.select("doc_id", "doc_tokens", F.explode(F.coalesce("parts", own)).alias("p")).select("doc_id", "p.start", "p.length", "p.ids_crc32", "doc_tokens")
        other = histogram(finer)
        packed = pack_histogram(other, size)
        if packed[2] < padding:
            whole, counts, (placed, sequences, padding) = finer, other, packed
    salts = max(1, -(-max(counts.values(), default=0) // RANK_ROWS), min(64, max(counts.values(), default=0) // 500))
    salted = whole.drop("parts").withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(salts)))
    group = Window.partitionBy("length", "salt")
    ranked = salted.withColumn("nth", F.row_number().over(group.orderBy("doc_id", "start", "ids_crc32")) - 1)
    sizes = salted.groupBy("length", "salt").count()
    before = F.coalesce(F.sum("count").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select("length", "salt", before.alias("before"))
    ranked = ranked.join(sizes, ["length", "salt"]).withColumn("nth", F.col("nth") + F.col("before"))
    # At most one placement for each length and run of equal packs; bounded by `size`, not by the input.
    places = spark.createDataFrame(placed, "length long, first long, n long, sequence long, offset long")
    inside = (F.col("nth") >= F.col("first")) & (F.col("nth") < F.col("first") + F.col("n"))
    found = ranked.alias("r").join(F.broadcast(places).alias("p"), (F.col("r.length") == F.col("p.length")) & inside)
    sequence = (F.col("sequence") + F.col("nth") - F.col("first")).alias("sequence_id")
    return found.select("doc_id", "start", F.col("r.length").alias("length"), "ids_crc32", "doc_tokens", sequence, "offset")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"))
