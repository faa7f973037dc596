"""Whitening of embeddings by the leading components of their covariance, found by contour integration.

Every entry c becomes the whole number x = floor(256 c). The fit list holds each distinct x-vector
once, so copies have no weight. Spark sums it exactly (n, S), then the centred products x - S/n give
the covariance V, which is D x D and goes to the driver; vectors never do.

Components come from V by FEAST: on circles around intervals of the spectrum, Gauss-Legendre
quadrature of the complex shifted solves (zI - V) X = Y projects a block of vectors onto the
eigenvectors inside; a Rayleigh-Ritz step extracts them, and both repeat until the residuals are at
rounding level. The inertia of V - tI, from a symmetric indefinite factorisation, counts the
eigenvalues above t: it places the intervals and verifies that none inside was missed.

``identity_error`` is measured, not assumed: a pass over the fit list sums the products of its
whitened vectors, and the largest absolute entry of their covariance minus the identity is kept.

Results for edge cases: a vector that is null, holds a null or non-finite entry, or one whose x does
not fit a 64-bit integer is dropped. So is an empty one, and one of another length than most distinct
vectors have (of several most frequent lengths the longest), as no covariance with them exists. A
component needs an eigenvalue above rounding level: few or equal vectors have fewer components, one
distinct vector has none. A deviation beyond a 64-bit integer is null. Long vectors are limited by
V alone: D x D doubles on the driver. Repeated rows get equal results, no rows give none. Added
columns replace input columns of the same name; no others are touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.staging import stage

SCALE = 256
COMPONENTS = 4
# Quadrature points on a half circle, and eigenvalues an interval may hold before it is halved.
POINTS = 8
INTERVAL_VALUES = 8
ROUNDS = 40


class Whitening(NamedTuple):
    """A fitted whitening; ``vectors`` has one column a component, ``values`` falls."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    @property
    def explained(self) -> list[float]:
        return [float(value / self.trace) for value in self.values]

    def project(self, x: np.ndarray) -> np.ndarray:
        mean = np.array([s / self.n for s in self.sums])
        return (x - mean) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact; None beyond a 64-bit integer."""
        widest = max([abs(s) for s in self.sums], default=0) + self.n * (int(np.abs(x).max(initial=0)) + 1)
        exact = len(self.sums) * widest * widest < 1 << 63
        kind = np.int64 if exact else object
        away = self.n * x.astype(kind) - np.array(self.sums, kind)
        found = [int(value) for value in (away * away).sum(axis=1)]
        return [value if value < 1 << 63 else None for value in found]


# --- vectors as whole numbers -----------------------------------------------------------


def coded(vectors: pa.Array) -> list[np.ndarray | None]:
    """floor(256 c) of every vector as 64-bit integers, None for those that are dropped."""
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    flat = pc.cast(vectors.flatten(), pa.float64()).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        scaled = np.floor(SCALE * flat)
    fits = np.abs(scaled) < 2.0**63  # also false for what is null or not finite
    whole = np.where(fits, scaled, 0).astype(np.int64)
    bad = np.concatenate([[0], np.cumsum(~fits)])
    ends = np.cumsum(lengths)
    return [
        whole[end - length : end] if length and bad[end] == bad[end - length] else None
        for end, length in zip(ends, lengths)
    ]


def _packed(x: np.ndarray) -> bytes:
    """A form equal for equal vectors, 16 bits an entry where they do."""
    small = np.abs(x).max() < 1 << 15
    return b"s" + x.astype("<i2").tobytes() if small else b"l" + x.astype("<i8").tobytes()


def _unpacked(packed: list[bytes]) -> np.ndarray:
    return np.array([np.frombuffer(one, "<i2" if one[:1] == b"s" else "<i8", offset=1) for one in packed], np.int64)


def _code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [x for x in coded(batch.column(0)) if x is not None]
        arrays = [pa.array([_packed(x) for x in found], pa.binary()), pa.array([len(x) for x in found], pa.int32())]
        yield pa.RecordBatch.from_arrays(arrays, names=["x", "length"])


def fit_list(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """Staged column ``x``: each distinct packed vector of the most frequent length once."""
    codes = df.select(F.col(f"`{vector}`").alias("v")).mapInArrow(_code, "x binary, length int")
    distinct = stage(codes.distinct(), "distinct")
    sizes = distinct.groupBy("length").agg(F.count("*").alias("n"))
    usual = sizes.orderBy(F.col("n").desc(), F.col("length").desc()).head()
    return distinct.filter(F.col("length") == (usual["length"] if usual else 0)).select("x")


# --- exact sums and centred products ----------------------------------------------------


def _sums(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and exact sum of each dimension, in halves that no 64-bit sum overflows."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, 0, 0
        for batch in batches:
            x = _unpacked(batch.column(0).to_pylist())
            if len(x):
                n, high, low = n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
        if n:
            arrays = [pa.array(np.arange(len(high), dtype=np.int32)), pa.array(np.full(len(high), n)), pa.array(high), pa.array(low)]
            yield pa.RecordBatch.from_arrays(arrays, names=["d", "n", "high", "low"])

    parts = fit.mapInArrow(add, "d int, n long, high long, low long")
    wide = [F.sum(F.col(name).cast("decimal(38,0)")).alias(name) for name in ("n", "high", "low")]
    # One row a dimension.
    rows = parts.groupBy("d").agg(*wide).orderBy("d").collect()
    return (int(rows[0]["n"]) if rows else 0), [(int(r["high"]) << 32) + int(r["low"]) for r in rows]


def _products(fit: DataFrame, of, width: int) -> np.ndarray:
    """Sum of the outer products of ``of(x)``, added up by Spark; width x width on the driver."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = _unpacked(batch.column(0).to_pylist())
            if len(x):
                y = of(x)
                total += y.T @ y
        places = pa.array(np.arange(width, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([places, pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])

    parts = fit.mapInArrow(multiply, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "value"))
    table = parts.groupBy("i", "j").agg(F.sum("value").alias("value")).toPandas()
    total = np.zeros((width, width))
    total[table["i"], table["j"]] = table["value"]
    return (total + total.T) / 2


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Fit on the distinct vectors of ``df``; None without a vector."""
    listed = fit_list(df, vector)
    n, sums = _sums(listed)
    if not n:
        return None
    mean = np.array([s / n for s in sums])
    covariance = _products(listed, lambda x: x - mean, len(sums)) / n
    values, vectors = leading(covariance, components)
    model = Whitening(n, tuple(sums), values, vectors, float(np.trace(covariance)), 0.0)
    if not len(values):
        return model
    # The mean of whitened vectors is zero but for rounding, so they are centred already.
    measured = _products(listed, model.project, len(values)) / n
    return model._replace(identity_error=float(np.abs(measured - np.eye(len(values))).max()))


# --- eigenpairs by contour integration --------------------------------------------------


def count_below(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues below ``shift``: negative pivots of a factorisation of ``matrix - shift I``.

    Pivots are single or blocks of two, the largest left; a block has one of each sign.
    """
    rest = matrix - shift * np.eye(len(matrix))
    least = (1 + 17**0.5) / 8
    negative = 0
    while len(rest):
        diagonal = np.abs(np.diag(rest))
        p = int(diagonal.argmax())
        off = np.abs(rest - np.diag(np.diag(rest)))
        i, j = divmod(int(off.argmax()), len(rest))
        if diagonal[p] >= least * off[i, j]:
            if diagonal[p] == 0:
                break
            pivot, gone = rest[p, p], [p]
            negative += pivot < 0
            others = np.delete(np.arange(len(rest)), gone)
            column = rest[others, p]
            change = np.outer(column, column) / pivot
        else:
            gone = [i, j]
            negative += 1
            others = np.delete(np.arange(len(rest)), gone)
            columns = rest[np.ix_(others, gone)]
            change = columns @ np.linalg.solve(rest[np.ix_(gone, gone)], columns.T)
        rest = rest[np.ix_(others, others)] - change
    return int(negative)


def projected(matrix: np.ndarray, low: float, high: float, block: np.ndarray) -> np.ndarray:
    """``block`` projected onto the eigenvectors with eigenvalues in (low, high), approximately."""
    centre, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    total = np.zeros_like(block)
    for node, weight in zip(nodes, weights):
        turn = radius * np.exp(0.5j * np.pi * (1 + node))
        solved = np.linalg.solve((centre + turn) * np.eye(len(matrix)) - matrix, block.astype(complex))
        total += weight / 2 * (turn * solved).real
    return total


def _ritz(matrix: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rayleigh-Ritz pairs of the space that ``block`` spans."""
    basis, sizes, _ = np.linalg.svd(block, full_matrices=False)
    basis = basis[:, sizes > 1e-13 * sizes[0]]
    values, turns = np.linalg.eigh(basis.T @ matrix @ basis)
    return values, basis @ turns


def in_interval(matrix: np.ndarray, low: float, high: float, expected: int) -> np.ndarray:
    """The ``expected`` eigenvectors with eigenvalues in (low, high)."""
    size = len(matrix)
    draw = np.random.default_rng(0)
    width = min(size, max(2 * expected, expected + 4))
    block = draw.standard_normal((size, width))
    scale = np.abs(matrix).sum(axis=1).max()
    found, worst, stalled = np.zeros((size, 0)), np.inf, 0
    for _ in range(ROUNDS):
        values, vectors = _ritz(matrix, projected(matrix, low, high, block))
        errors = np.linalg.norm(matrix @ vectors - vectors * values, axis=0)
        inside = np.flatnonzero((values > low) & (values < high) & (errors < 1e-9 * scale))
        if len(inside) == expected:
            now = errors[inside].max()
            stalled = 0 if now < worst / 2 else stalled + 1
            if now < worst:
                found, worst = vectors[:, inside], now
            if worst < 1e-15 * scale or stalled >= 2:
                return found
        block = np.hstack([vectors, draw.standard_normal((size, width - vectors.shape[1]))])
    raise ArithmeticError(f"{found.shape[1]} of {expected} eigenvalues between {low} and {high} converged")


def _intervals(matrix: np.ndarray, low: float, high: float, below_low: int, below_high: int):
    """Intervals between ``low`` and ``high`` with the number of eigenvalues in each, from the top."""
    held = below_high - below_low
    middle = (low + high) / 2
    if held <= INTERVAL_VALUES or high - low < 1e-9 * max(abs(low), abs(high)):
        return [(low, high, held)] if held else []
    below = count_below(matrix, middle)
    upper = _intervals(matrix, middle, high, below, below_high)
    return upper + _intervals(matrix, low, middle, below_low, below)


def leading(matrix: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a covariance, falling, with unit eigenvectors as columns."""
    size, top = len(matrix), float(np.abs(matrix).sum(axis=1).max(initial=0)) * 1.01
    floor = size * np.finfo(float).eps * float(np.trace(matrix))
    wanted = min(components, size - count_below(matrix, floor)) if top > 0 else 0
    if not wanted:
        return np.zeros(0), np.zeros((size, 0))
    low, beyond, high = floor, top, top
    # The interval's lower end: at least the wanted number above it, and few more if they separate.
    while size - count_below(matrix, low) > wanted and beyond - low > 1e-6 * beyond:
        middle = (low + beyond) / 2
        low, beyond = (middle, beyond) if size - count_below(matrix, middle) >= wanted else (low, middle)
    # A little less than that, so that no eigenvalue lies on the edge.
    low -= (beyond - low) / 2 if beyond - low < low else low / 2
    for _ in range(6):
        middle = (low + high) / 2
        high = middle if count_below(matrix, middle) == size else high
    parts = _intervals(matrix, low, high, count_below(matrix, low), size)
    block = np.hstack([in_interval(matrix, *part) for part in parts])
    values, vectors = _ritz(matrix, block)
    order = np.argsort(-values)[:wanted]
    vectors = vectors[:, order]
    return values[order], vectors / np.linalg.norm(vectors, axis=0)


# --- applying ---------------------------------------------------------------------------


def with_whitened(df: DataFrame, model: Whitening | None, vector: str = "embedding") -> DataFrame:
    """``df`` with ``whitening``: struct of ``deviation`` and ``whitened``, null for dropped rows."""
    kind = "struct<deviation: long, whitened: array<double>>"
    if model is None:
        return df.withColumn("whitening", F.lit(None).cast(kind))
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(kind)
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fitted = shared.value
        for batch in batches:
            vectors = coded(batch)
            good = [i for i, x in enumerate(vectors) if x is not None and len(x) == len(fitted.sums)]
            rows: list[dict | None] = [None] * len(vectors)
            if good:
                x = np.array([vectors[i] for i in good])
                for i, away, scores in zip(good, fitted.deviations(x), fitted.project(x).tolist()):
                    rows[i] = {"deviation": away, "whitened": scores}
            yield pa.array(rows, pa.struct([("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))]))

    return df.withColumn("whitening", apply(F.col(f"`{vector}`")))
