"""Embedding whitening: leading eigenvectors of an exact covariance by FEAST contour integration, checked by inertia counts."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.llm.common import read, small_batches

#: A vector with an entry whose scaled value is beyond this counts as one with an infinite entry; sums of the others are exact.
LARGEST = 1 << 50
#: What is added to each scaled entry.
SHIFT = 100_000
#: Quadrature points on the half circle, and refinements of a subspace, at most.
NODES, REFINEMENTS = 16, 40


def whole_numbers(df: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 1024) -> DataFrame:
    """The key as vec_id, and x: floor(scale * c) + SHIFT of each entry c, as double.

    Vectors that are null or hold null or non-finite entries are left out. A null key and repeated rows stay.
    """
    c = F.col(vector)
    big = lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) * scale > LARGEST)
    sound = ~F.coalesce(F.exists(c, big), F.lit(True))
    x = F.transform(c, lambda v: F.floor(v.cast("double") * scale).cast("long") + F.lit(SHIFT))
    return small_batches(df).filter(sound).select(F.col(key).cast("long").alias("vec_id"), x.alias("x"))


def _matrix(column: pa.Array, width: int, missing: int = SHIFT) -> np.ndarray:
    """The lists as rows of whole numbers; missing entries of shorter vectors stand for the entry 0."""
    counts = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy()
    if (counts == width).all():
        return flat.reshape(len(counts), width)
    out = np.full((len(counts), width), missing, np.int64)
    out[np.arange(width) < counts[:, None]] = flat
    return out


def _products(y: np.ndarray) -> np.ndarray:
    """Sums of the products of the columns of ``y``, exact."""
    d = y.shape[1]
    largest = int(np.abs(y).max(initial=0))
    if largest >= 1 << 25:  # beyond what sums of doubles hold
        return y.astype(object).T @ y.astype(object)
    step = max(1, (1 << 52) // max(1, largest * largest))
    out = np.zeros((d, d), object)
    for start in range(0, len(y), step):
        part = y[start : start + step].astype(float)
        out += (part.T @ part).astype(np.int64).astype(object)
    return out


def moments(vectors: DataFrame) -> tuple[int, list[int], list[list[int]]]:
    """n, the sums S of x by dimension, and n^2 times the covariance: the sums of (n x - S)(n x - S) / n, all exact.

    Vectors are centred at the whole number next to their mean before they are multiplied. Sums are of whole numbers, made
    in each partition and added up on Spark, so that neither order nor lost executors change a bit.
    """
    first = pa.schema([("i", pa.int32()), ("v", pa.decimal128(38, 0)), ("k", pa.int64())])

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, counts = 0, np.zeros(0, object), np.zeros(0, np.int64)
        for batch in batches:
            if batch.num_rows:
                lengths = np.diff(batch.column(0).offsets.to_numpy())
                n, longest = n + batch.num_rows, int(lengths.max())
                sums.resize(max(len(sums), longest), refcheck=False)
                counts.resize(len(sums), refcheck=False)
                counts[:longest] += (lengths[:, None] > np.arange(longest)).sum(0)
                sums[:longest] += _matrix(batch.column(0), longest, 0).sum(0).astype(object)  # below 2^63: a batch has some thousand rows
        values = [Decimal(int(v)) for v in [0, *sums]]
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(sums)), pa.int32()), pa.array(values, pa.decimal128(38, 0)), pa.array([n, *counts], pa.int64())], schema=first)

    found = vectors.select("x").mapInArrow(totals, "i int, v decimal(38,0), k long").groupBy("i").agg(F.sum("v").alias("s"), F.sum("k").alias("k"))
    by = {r.i: (int(r.s), r.k) for r in found.collect()}  # one row a dimension
    n = by.pop(-1, (0, 0))[1]
    d = len(by)
    sums = [by[i][0] + SHIFT * (n - by[i][1]) for i in range(d)]
    if not n or not d:
        return n, sums, []
    centre = np.array([round(Fraction(s, n)) for s in sums], np.int64)
    kind = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("v", pa.decimal128(38, 0))])

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), object)
        for batch in batches:
            if batch.num_rows:
                total += _products(_matrix(batch.column(0), d) - centre)
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([Decimal(int(v)) for v in total[i, j]], pa.decimal128(38, 0))], schema=kind)

    summed = vectors.select("x").mapInArrow(products, "i int, j int, v decimal(38,0)").groupBy("i", "j").agg(F.sum("v").alias("v"))
    off = [s - n * int(c) for s, c in zip(sums, centre, strict=True)]  # sums of what is centred
    out = [[0] * d for _ in range(d)]
    for r in summed.collect():  # one row a pair of dimensions
        out[r.i][r.j] = out[r.j][r.i] = n * int(r.v) - off[r.i] * off[r.j]
    return n, sums, out


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues of a symmetric matrix are above ``shift``: the signs of the pivots of matrix - shift (Sylvester).

    Pivots are single entries or pairs, whichever grows the rest less (Bunch and Parlett), so that a zero entry does no harm.
    """
    a = matrix - shift * np.eye(len(matrix))
    least = np.finfo(float).eps * max(1.0, float(np.abs(a).max(initial=0)))
    count = 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        k = int(diagonal.argmax())
        off = np.abs(a - np.diag(np.diag(a)))
        i, j = divmod(int(off.argmax()), len(a))
        if diagonal[k] >= 0.6404 * off[i, j] or len(a) == 1:
            pivot, rest = a[k, k], np.delete(np.arange(len(a)), k)
            count += pivot > 0
            if abs(pivot) > least:
                a = a[np.ix_(rest, rest)] - np.outer(a[rest, k], a[rest, k]) / pivot
            else:
                a = a[np.ix_(rest, rest)]
        else:
            rest = np.delete(np.arange(len(a)), [i, j])
            block, sides = a[np.ix_([i, j], [i, j])], a[np.ix_(rest, [i, j])]
            count += 1  # such a block has a negative determinant: one eigenvalue of each sign
            a = a[np.ix_(rest, rest)] - sides @ np.linalg.solve(block, sides.T)
        a = (a + a.T) / 2
    return int(count)


def feast(matrix: np.ndarray, low: float, high: float, size: int, nodes: int = NODES, rounds: int = REFINEMENTS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in (low, high), falling, and their unit eigenvectors as columns.

    Gauss-Legendre points on the half circle over the interval give complex shifts z. The sum of the weighted solutions of
    (z - matrix) Q = Y projects Y onto the interval's eigenvectors, and Rayleigh-Ritz takes them out of that subspace; both
    are repeated from the Ritz vectors until residuals are at rounding. ``size`` columns have to be more than the values.
    """
    d, norm = len(matrix), max(float(np.abs(matrix).sum(1).max(initial=0)), np.finfo(float).tiny)
    middle, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(nodes)
    turn = np.exp(1j * np.pi * (points + 1) / 2)  # the upper half; the lower one has the conjugates
    basis = np.random.default_rng(11).standard_normal((d, min(size, d)))
    for _ in range(rounds):
        image = np.zeros_like(basis)
        for w, t in zip(weights, turn, strict=True):
            image += (w * radius / 2 * t * np.linalg.solve((middle + radius * t) * np.eye(d) - matrix, basis.astype(complex))).real
        q = np.linalg.qr(image)[0]
        values, inner = np.linalg.eigh(q.T @ matrix @ q)
        basis = q @ inner
        inside = (values > low) & (values < high)
        left = np.linalg.norm(matrix @ basis - basis * values, axis=0)[inside]
        if (left <= 4e-15 * d * norm).all():
            break
    order = np.flatnonzero(inside)[::-1]
    return values[order], basis[:, order]


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest positive eigenvalues, falling, and unit eigenvectors as columns; fewer if fewer are positive to rounding.

    Bisection by inertia finds intervals with few eigenvalues each, from the top; a contour around each gives its
    components. As many have to come out as the inertia counts at its ends say, else the subspace is widened and, at last,
    an error raised. The sign of a component makes its largest entry positive.
    """
    d = len(matrix)
    norm = float(np.abs(matrix).sum(1).max(initial=0))
    if not d or not norm > 0:
        return np.zeros(0), np.zeros((d, 0))
    floor, top = norm * d * 1e-15, norm * 1.001
    k = min(k, above(matrix, floor))
    values, vectors, high = [], [], top
    while sum(map(len, values)) < k:
        missing = k - sum(map(len, values))
        passed = above(matrix, high)
        low, left, right = floor, floor, high  # an end with `missing` values above it, or all that lie too close to part
        while right - left > 1e-9 * high and above(matrix, left) - passed > missing:
            low = (left + right) / 2
            if above(matrix, low) - passed >= missing:
                left = low
            else:
                right = low
        low = left
        wanted = above(matrix, low) - passed
        if low > floor and wanted > 1:  # from the largest gap on, if the upper values are far away
            cut = (low + high) / 2
            if high - low > 0.5 * high and 0 < above(matrix, cut) - passed < wanted:
                low, wanted = cut, above(matrix, cut) - passed
        size = min(d, wanted + max(8, wanted))
        while True:
            e, u = feast(matrix, low, high, size)
            if len(e) == wanted:
                break
            if size == d:
                raise ArithmeticError(f"{len(e)} of {wanted} components between {low} and {high} found")
            size = min(d, 2 * size)
        values.append(e)
        vectors.append(u)
        high = low
    e, u = np.concatenate(values)[:k], np.linalg.qr(np.concatenate(vectors, axis=1))[0][:, :k]
    u = u * np.sign(u[np.abs(u).argmax(axis=0), np.arange(k)])
    return e, u


def whiten(df: DataFrame, components: int = 8, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: the first components of each vector, in unit variance.

    x are the vectors' entries as whole numbers, S their sums over all n vectors. The covariance of x (divisor n) is
    exact before it is rounded once; its eigenvectors come from :func:`leading`. deviation is the sum of (n x - S)^2, a
    decimal. whitened is (x - S/n) on the component over the root of its eigenvalue, explained its share of the trace,
    identity_error the largest entry of the covariance of all whitened values less the identity.

    Vectors that are null or hold null or non-finite entries are left out; shorter ones count as filled up with 0. There
    are fewer components if fewer eigenvalues are positive to rounding (vectors that do not vary have none, and no rows).
    Repeated rows count as often as they stand. Without vectors there are no rows. Other columns are not looked at. A
    matrix of dimensions by dimensions is all that the driver holds.
    """
    spark = df.sparkSession
    vectors = whole_numbers(df, key, vector)
    kind = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    n, sums, scaled = moments(vectors)
    d = len(sums)
    covariance = np.array([[float(Fraction(v, n * n)) for v in row] for row in scaled]).reshape(d, d)
    e, u = leading(covariance, components)
    k = len(e)
    if not k:
        return spark.createDataFrame([], kind)
    trace = float(sum(Fraction(scaled[i][i], n * n) for i in range(d)))
    base = np.array([s // n for s in sums], np.int64)
    part = np.array([float(Fraction(s % n, n)) for s in sums])  # the mean is base + part
    project = u / np.sqrt(e)

    def values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        y = _matrix(column, d) - base
        return y, (y - part) @ project

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            if batch.num_rows:
                w = values(batch.column(0))[1]
                total[:k] += w.T @ w
                total[k] += w.sum(0)
        i, j = np.indices((k + 1, k)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.reshape(-1))], ["i", "j", "v"])

    held = np.zeros((k + 1, k))
    for r in vectors.select("x").mapInArrow(second, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        held[r.i, r.j] = r.v / n
    error = float(np.abs(held[:k] - np.outer(held[k], held[k]) - np.eye(k)).max())
    rest = np.array([s % n for s in sums], object)  # n x - S = n (x - base) - rest

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            y, w = values(batch.column(1))
            far = int(np.abs(y).max(initial=0)) + 1
            exact = y.astype(np.int64) if (n * far) ** 2 * d < 1 << 62 else y.astype(object)
            deviation = ((exact * n - rest.astype(exact.dtype)) ** 2).sum(1)
            m = len(w)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                pa.array(np.full(m * k, n), pa.int64()),
                pa.array([Decimal(int(v)) for v in deviation], pa.decimal128(38, 0)).take(pa.array(np.repeat(np.arange(m), k))),
                pa.array(w.reshape(-1)),
                pa.array(np.tile(e / trace, m)),
                pa.array(np.full(m * k, error)),
            ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(rows, kind)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))
