"""Document fingerprints by locally consistent parsing."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm.common import read

#: Fixed odd constants of the hash that names phrases.
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Slots of a fingerprint, bits of a slot, levels of phrases that it samples, code points parsed at once (about).
SLOTS, BITS, LEVELS, AT_ONCE = 64, 16, (2, 3), 1 << 20
#: Documents in one sorted run, at least about; and runs for each shuffle partition, at most.
RUN_ROWS, RUNS = 200, 4


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _coin(names: np.ndarray, left: np.ndarray) -> np.ndarray:
    """One toss: twice the lowest bit in which a name differs from its left neighbour, plus that bit of its own.

    Neighbours that differ get labels that differ; labels of b bits come down to about log2(b) + 1 bits.
    """
    apart = names ^ left
    low = apart & (~apart + np.uint64(1))
    place = np.round(np.log2(np.maximum(low, np.uint64(1)).astype(np.float64))).astype(np.uint64)
    return place * np.uint64(2) + ((names >> place) & np.uint64(1))


def phrases(names: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and documents of the next level: neighbours joined into phrases.

    Runs of one name are first joined to one; then no neighbours are equal. Three tosses bring names down to a few
    small labels, and a phrase begins at each label that is larger than both beside it (or at the start of a document).
    Where a phrase begins depends on a few names around it alone, so that equal substrings fall into equal phrases but
    for their ends, wherever they stand. A phrase's name is a hash of its parts in order.
    """
    n = len(names)
    if not n:
        return names, doc
    begins = np.empty(n, bool)
    begins[0] = True
    begins[1:] = (names[1:] != names[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(begins)
    run = np.diff(np.append(at, n)).astype(np.uint64)
    single, doc = names[at], doc[at]
    single = np.where(run > 1, _mix(single + run * _A), single)
    n = len(single)
    first = np.empty(n, bool)
    first[0] = True
    first[1:] = doc[1:] != doc[:-1]
    label = single
    for _ in range(3):
        left = np.roll(label, 1)
        left[first] = label[first] ^ np.uint64(1)
        label = _coin(label, left)
    last = np.roll(first, -1)
    higher_left = label > np.where(first, np.uint64(0), np.roll(label, 1))
    higher_right = label > np.where(last, np.uint64(0), np.roll(label, -1))
    begins = first | (higher_left & higher_right)
    at = np.flatnonzero(begins)
    place = np.arange(n) - np.repeat(at, np.diff(np.append(at, n)))
    parts = _mix(single + (place.astype(np.uint64) + np.uint64(1)) * _A)
    return _mix(np.add.reduceat(parts, at)), doc[at]


def sketches(texts: list[str], slots: int = SLOTS, bits: int = BITS, levels: tuple[int, ...] = LEVELS) -> np.ndarray:
    """A row of ``slots`` numbers of ``bits`` bits for each text: per slot the least name among the phrases that fall into it.

    The phrases are those of ``levels`` of the hierarchy (about 3^level code points each) and, for a short text, its
    last name. An empty slot takes the number of the next filled one, mixed with the way to it; an empty text has 0s.
    """
    lengths = np.array([len(x) for x in texts])
    names = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    doc = np.repeat(np.arange(len(texts)), lengths)
    names = _mix(names + _A)
    all_names, all_docs = [], []
    for level in range(1, max(levels) + 1):
        names, doc = phrases(names, doc)
        if level in levels:
            all_names.append(names)
            all_docs.append(doc)
    names, doc = np.concatenate(all_names), np.concatenate(all_docs)
    least = np.full((len(texts), slots), np.iinfo(np.uint64).max, np.uint64)
    values = _mix(names + _C)
    np.minimum.at(least.reshape(-1), doc * slots + (values % np.uint64(slots)).astype(np.int64), values >> np.uint64(8))
    empty = least == np.iinfo(np.uint64).max
    out = least.copy()
    some = ~empty.all(1)
    for way in range(1, slots):  # filled from the right, as far as needed
        if not empty[some].any():
            break
        near = np.roll(least, -way, axis=1)
        take = empty & (near != np.iinfo(np.uint64).max)
        out = np.where(take, _mix(near + np.uint64(way)), out)
        empty = empty & ~take
    return np.where(some[:, None], _mix(out) & np.uint64((1 << bits) - 1), np.uint64(0))


def likeness(a: np.ndarray, b: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The share of equal slots, less what chance gives: near the share of phrases that two texts have in common."""
    same = (a == b).mean(1)
    chance = 2.0**-bits
    return np.clip((same - chance) / (1 - chance), 0, 1)


def fingerprints(texts: list[str]) -> tuple[np.ndarray, list[str]]:
    """Sketches of all texts, parsed about ``AT_ONCE`` code points at a time, and as text: 4 hexadecimal digits a slot."""
    parts, start, size = [np.empty((0, SLOTS), np.uint64)], 0, 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= AT_ONCE or k == len(texts) - 1:
            parts.append(sketches(texts[start : k + 1]))
            start, size = k + 1, 0
    out = np.concatenate(parts)
    return out, [row.astype(">u2").tobytes().hex() for row in out]


def edited(text: str, following: str) -> str:
    """``text`` with its last floor(n/2) code points replaced by the first as many of ``following`` (or all of it)."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def in_turn(docs: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """``run``, ``doc_id``, ``text``, ``guest``: runs of documents with neighbouring ids, each with a guest, the next run's first.

    Runs are bounded by quantiles of the ids (numbers collected: one a run), so that texts are dealt out once.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    ids = docs.select("doc_id")
    most = RUNS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = max(1, min(most, -(-ids.count() // run_rows)))
    if runs > 1:
        bounds = sorted({int(x) for x in ids.approxQuantile("doc_id", [k / runs for k in range(1, runs)], 0.1 / runs)})
    else:
        bounds = []
    # Ids descend: run 0 has the highest, null ids come last.
    higher = F.size(F.filter(F.lit(bounds).cast("array<long>"), lambda b: b >= F.col("doc_id"))) if bounds else F.lit(0)
    run = F.when(F.col("doc_id").isNull(), F.lit(len(bounds))).otherwise(higher).cast("int")
    placed = docs.withColumn("run", run)
    firsts = {r[0]: r[1] for r in placed.groupBy("run").agg(F.max("doc_id")).collect()}
    order = sorted(firsts)
    before = {firsts[b]: a for a, b in zip(order, order[1:] + order[:1], strict=True)} if order else {}
    # The first document of each run is a guest at the end of the run before; the very first one after the last.
    if before and None not in before:
        pairs = docs.sparkSession.createDataFrame(list(before.items()), "head long, host int")
        heads = docs.join(F.broadcast(pairs), F.col("doc_id") == F.col("head"))  # one row for each run
        heads = heads.groupBy("host", "doc_id").agg(F.min("text").alias("text"))
    else:  # ids are all null in some run, and so in the only one
        heads = placed.groupBy(F.lit(0).alias("host")).agg(F.max("doc_id").alias("doc_id"), F.min("text").alias("text")).filter(F.lit(bool(before)))
    both = placed.select("run", "doc_id", "text", F.lit(0).alias("guest")).unionByName(heads.select(F.col("host").alias("run"), "doc_id", "text", F.lit(1).alias("guest")))
    return both


def fingerprint(docs: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next: one row for each row.

    The next document is the one with the next smaller id; after the last comes the first. A single document is its own
    next one. Null texts are empty, and two empty texts are alike (1). Rows with one id are in order of their texts;
    null ids come last.
    """
    out = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int | None, str, int]] = []  # rows whose next one is not yet known

        def chunks() -> Iterator[list[tuple[int, int | None, str, int]]]:
            rows, size = [], 0
            for batch in batches:
                for row in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                    rows.append(row)
                    size += len(row[2])
                    if size >= AT_ONCE and len(rows) > 1:
                        yield rows
                        rows, size = [], 0
            yield rows

        for rows in chunks():
            rows = held + rows
            if not rows:
                continue
            texts = [r[2] for r in rows]
            own, names = fingerprints(texts)
            have = [k for k in range(len(rows) - 1) if not rows[k][3]]
            changed = [edited(texts[k], texts[k + 1]) for k in have]
            other, other_names = fingerprints(changed)
            held = rows[-1:]
            if have:
                at = np.array(have)
                yield pa.RecordBatch.from_arrays([
                    pa.array([rows[k][1] for k in have], pa.int64()), pa.array([len(texts[k]) for k in have], pa.int64()),
                    pa.array([hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in changed]), pa.array([names[k] for k in have]), pa.array(other_names),
                    pa.array(likeness(own[at], other)), pa.array(likeness(own[at], own[at + 1])),
                ], schema=out)

    placed = in_turn(docs, run_rows)
    sorted_runs = placed.repartition(F.col("run")).sortWithinPartitions("run", "guest", F.desc_nulls_last("doc_id"), "text")
    kind = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return sorted_runs.mapInArrow(parse, kind)


def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint(read(spark, sf_dir, "documents"))
