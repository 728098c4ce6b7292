"""Quality: a byte-level convolutional network in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm.common import bounded_sample, cut, held_out, one_label, read, unit

#: Labelled rows of each class to learn from, at most about, and the bytes of their texts.
TRAIN_ROWS, TRAIN_BYTES = 1_500, 32 << 20
#: Bytes of a chunk, bytes from one chunk to the next, bytes that a filter sees, bytes from one place to the next; filters, numbers for a byte.
CHUNK, STEP, WIDTH, STRIDE, FILTERS, DIMS = 512, 448, 8, 2, 24, 6


def chunks(text: str | None) -> np.ndarray:
    """The bytes of a whole text, as rows of CHUNK bytes that overlap by CHUNK - STEP; the last is filled with 0 bytes."""
    data = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    n = max(1, -(-max(0, len(data) - (CHUNK - STEP)) // STEP))
    if len(data) <= CHUNK and n == 1:  # a short text is a shorter row
        width = max(WIDTH, len(data) + (-len(data)) % STRIDE)
        return np.pad(data, (0, width - len(data)))[None, :]
    padded = np.pad(data, (0, (n - 1) * STEP + CHUNK - len(data)))
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STEP]


class Network:
    """Bytes to numbers, filters over them, their largest value in each chunk, then mean and largest of a text's chunks to one logit."""

    def __init__(self, seed: int = 9) -> None:
        draw = np.random.default_rng(seed)
        self.byte = draw.normal(0, 0.5, (256, DIMS)).astype(np.float32)
        self.filter = draw.normal(0, (2 / (WIDTH * DIMS)) ** 0.5, (WIDTH * DIMS, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.out = draw.normal(0, 0.1, 2 * FILTERS).astype(np.float32)
        self.base = np.zeros(1, np.float32)

    def weights(self) -> list[np.ndarray]:
        return [self.byte, self.filter, self.bias, self.out, self.base]

    def look(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest value of each filter in each chunk, and where it is."""
        seen = self.byte[rows].reshape(len(rows), -1)
        windows = np.lib.stride_tricks.sliding_window_view(seen, WIDTH * DIMS, axis=1)[:, :: STRIDE * DIMS]
        values = windows.reshape(-1, WIDTH * DIMS) @ self.filter
        values = values.reshape(len(rows), -1, FILTERS)
        at = values.argmax(1)
        return np.maximum(np.take_along_axis(values, at[:, None, :], 1)[:, 0] + self.bias, 0), at

    def look_over(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`look` over the chunks of a very long text, in bounded memory."""
        parts = [self.look(rows[start : start + 256]) for start in range(0, len(rows), 256)]
        return np.concatenate([x for x, _ in parts]), np.concatenate([x for _, x in parts])

    def logit(self, text: str | None) -> float:
        rows = chunks(text)
        total, most = np.zeros(FILTERS), np.zeros(FILTERS)
        for start in range(0, len(rows), 256):
            pooled, _ = self.look(rows[start : start + 256])
            total += pooled.sum(0)
            most = np.maximum(most, pooled.max(0))
        return float(np.concatenate([total / len(rows), most]) @ self.out + self.base[0])

    def logits(self, texts: list[str | None]) -> list[float]:
        """Like :meth:`logit` for each text; whole chunks of several texts go through the filters together."""
        out = np.empty(len(texts))
        held: list[tuple[int, np.ndarray]] = []
        size = 0

        def flush() -> None:
            pooled, _ = self.look(np.concatenate([r for _, r in held]))
            edge = np.cumsum([0, *[len(r) for _, r in held]])
            total, most = np.add.reduceat(pooled, edge[:-1]), np.maximum.reduceat(pooled, edge[:-1])
            value = np.concatenate([total / np.diff(edge)[:, None], most], 1) @ self.out + self.base[0]
            out[[k for k, _ in held]] = value

        for k, text in enumerate(texts):
            rows = chunks(text)
            if rows.shape[1] != CHUNK or len(rows) > 256:
                out[k] = self.logit(text)
                continue
            held.append((k, rows))
            size += len(rows)
            if size >= 64:
                flush()
                held, size = [], 0
        if held:
            flush()
        return out.tolist()

    def gradients(self, text: str | None, truth: int, weight: float) -> list[np.ndarray]:
        rows = chunks(text)
        pooled, at = self.look_over(rows)
        top = pooled.argmax(0)
        seen = np.concatenate([pooled.mean(0), pooled.max(0)])
        miss = weight * (1 / (1 + np.exp(-np.clip(seen @ self.out + self.base[0], -30, 30))) - truth)
        back = np.repeat(miss * self.out[None, :FILTERS] / len(rows), len(rows), 0)
        back[top, np.arange(FILTERS)] += miss * self.out[FILTERS:]
        back *= pooled > 0
        to_byte, to_filter = np.zeros_like(self.byte), np.zeros_like(self.filter)
        every_which, every_column = np.nonzero(back)
        for start in range(0, len(every_which), 16_384):
            which, column = every_which[start : start + 16_384], every_column[start : start + 16_384]
            starts = at[which, column] * STRIDE
            held = rows[which[:, None], starts[:, None] + np.arange(WIDTH)]
            grad = back[which, column]
            inputs = self.byte[held].reshape(len(held), -1)
            np.add.at(to_filter.T, column, grad[:, None] * inputs)
            np.add.at(to_byte, held.reshape(-1), (grad[:, None] * self.filter.T[column]).reshape(-1, DIMS))
        return [to_byte, to_filter, back.sum(0), miss * seen, np.array([miss])]


def fit(rows: list[tuple[str | None, int]], epochs: int = 5, batch: int = 16, rate: float = 0.004, seed: int = 9) -> Network:
    """A network trained by Adam on whole texts. The classes count as in the rows."""
    net = Network(seed)
    draw = np.random.default_rng(seed)
    first, second = [np.zeros_like(w) for w in net.weights()], [np.zeros_like(w) for w in net.weights()]
    step, steps = 0, max(1, epochs * -(-len(rows) // batch))
    for _ in range(epochs):
        order = draw.permutation(len(rows))
        for start in range(0, len(rows), batch):
            picked = order[start : start + batch]
            total = [np.zeros_like(w) for w in net.weights()]
            for k in picked:
                for t, g in zip(total, net.gradients(*rows[k], 1 / len(picked)), strict=True):
                    t += g
            step += 1
            speed = rate * (1 - 0.9 * step / steps)
            for w, m, v, g in zip(net.weights(), first, second, total, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= speed * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def learn(docs: DataFrame, labels: DataFrame, bound: int = TRAIN_ROWS, column: str = "quality", most_bytes: int = TRAIN_BYTES) -> Network:
    """A network from the labelled documents outside the held-out fifth.

    About ``bound`` rows of each class at most, whose texts have ``most_bytes`` bytes a class at most (in the order of a
    hash; a text that would go beyond is left out). Of several labels of a document the smallest counts; of repeated
    rows of a document, the least text. The logit is shifted so that classes count as often as in all labelled rows, not
    as in the sample.
    """
    known = one_label(labels, column).filter(~held_out(F.col("doc_id"), 5, 0))
    counts = {r[0]: r[1] for r in known.groupBy("y").count().collect()}
    chosen = bounded_sample(known, "y", ["doc_id"], bound)  # bounded, so it is broadcast
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    found = cut(found)
    taken_bytes, wanted = {}, []
    for row in sorted(found.select("y", unit(F.lit(9), "doc_id").alias("h"), "doc_id", F.octet_length("text").alias("n")).collect()):  # `bound` rows a class
        if taken_bytes.get(row.y, 0) + row.n <= most_bytes:
            taken_bytes[row.y] = taken_bytes.get(row.y, 0) + row.n
            wanted.append(row.doc_id)
    sample = found.filter(F.col("doc_id").isin(wanted)).select("text", "y").collect() if wanted else []
    sample = sorted(((r[0], r[1]) for r in sample), key=lambda r: (r[1], r[0]))
    net = fit(sample)
    taken = {y: max(1, sum(s[1] == y for s in sample)) for y in (0, 1)}
    shift = np.log(max(1, counts.get(1, 0)) / taken[1]) - np.log(max(1, counts.get(0, 0)) / taken[0])
    net.base += np.float32(shift)
    return net


def scored(text: Column, net: Network) -> Column:
    """A score of 0 to 1 for a text. A null text is an empty one."""

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(1 / (1 + np.exp(-np.clip(net.logits(list(texts)), -500, 500))), dtype=float)

    return run(text)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted: one row for each row of ``docs``, repeated rows included.

    A null doc_id is not held out. Texts of any length are looked at to their ends. Without labels every text gets the
    score of the untrained network; no rows give no rows. Other columns are not looked at.
    """
    net = learn(docs, labels)
    rows = docs.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), scored(F.col("text"), net).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
