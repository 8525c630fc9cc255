"""Whitening of embeddings from an exact integer scatter (operator 12).

Every entry ``c`` becomes the integer ``floor(SCALE * c) + OFFSET``, and each distinct vector of integers counts once: the fit list. A shift,
the integers' midranges, is subtracted; then sums and cross-products are added up exactly. A task adds those of its rows, in 64-bit
integers as far as their sizes allow and in Python's integers beyond, and hands on each sum in limbs of ``LIMB`` bits,
which Spark adds up by place; the driver puts the limbs together and forms ``n * XtX - S * St``. Only that is turned into floating point, divided by n
squared, and decomposed by ``eigh``. What comes to the driver is the square of the dimension, whatever the number of rows.

Scores take the exact ``n * x - S`` of each row, so nothing is lost by a large mean. The covariance of the whitened fit list is measured
over its rows, not derived.

Defined results: a vector that is null or empty or holds a null or non-finite entry, or one whose integer needs more than 62 bits, takes no part. Vectors of each
length are fitted and whitened on their own. A component whose eigenvalue is zero, or not above ``TINY`` times the largest, can't be
whitened and is left out. Rows that repeat an id or a vector are each answered, but a vector counts once in the fit; a null
id stays. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import drop_path, in_arrow, written
from .vectors import finite

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
#: Least eigenvalue of a component, as a share of the largest.
TINY = 1e-10
#: Bits of a limb: sums of 2**23 tasks' limbs fit into 64 bits.
LIMB = 40
#: Rows that are handled at once.
ROWS = 4_096


def integers(v: Column) -> Column:
    """The integers of a vector's entries, or null where the vector takes no part."""
    big = float(2**62)
    scaled = F.transform(v, lambda c: F.floor(c.cast("double") * SCALE) + OFFSET)
    fits = F.forall(v, lambda c: F.abs(c.cast("double") * SCALE) < big - OFFSET)
    return F.when(finite(v) & fits, scaled)


def _matrices(b: pa.RecordBatch, at: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places of the rows of one length, their integers), some rows at a time."""
    lists = b.column(at)
    n = np.diff(lists.offsets.to_numpy())
    for dim in np.unique(n).tolist():
        rows = np.flatnonzero(n == dim)
        for k in range(0, len(rows), ROWS):
            own = rows[k : k + ROWS]
            yield own, lists.take(pa.array(own)).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(own), dim)


def cross_products(x: np.ndarray) -> tuple[list, list]:
    """Exact sums and cross-products of integer rows, as Python's integers."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    if most * most * max(1, len(x)) < 2**53:
        f = x.astype(float)  # products and sums of them are whole numbers that a double holds exactly
        return f.sum(0).astype(np.int64).tolist(), (f.T @ f).astype(np.int64).tolist()
    if most * most * max(1, len(x)) >= 2**63:
        x = x.astype(object)
    return x.sum(0).tolist(), (x.T @ x).tolist()


@dataclass
class Moments:
    """Exact sums of shifted rows."""

    n: int
    sums: list
    products: list  # upper triangle by rows

    @staticmethod
    def none(dim: int) -> Moments:
        return Moments(0, [0] * dim, [0] * (dim * (dim + 1) // 2))

    def add(self, x: np.ndarray) -> None:
        dim = x.shape[1]
        s, c = cross_products(x)
        self.n += len(x)
        self.sums = [a + b for a, b in zip(self.sums, s)]
        self.products = [a + b for a, b in zip(self.products, (c[i][j] for i in range(dim) for j in range(i, dim)))]

    def limbs(self) -> tuple[list, list, list]:
        """(place, limb, value) of every number; the last limb has the sign."""
        at, nth, value = [], [], []
        for k, v in enumerate([self.n, *self.sums, *self.products]):
            i = 0
            while True:
                last = -(1 << LIMB) <= v < 1 << LIMB
                at.append(k)
                nth.append(i)
                value.append(v if last else v & ((1 << LIMB) - 1))
                if last:
                    break
                v >>= LIMB
                i += 1
        return at, nth, value


def moments(fit: DataFrame, shifts: dict[int, np.ndarray]) -> dict[int, Moments]:
    """By length of vectors, the exact sums over ``x`` less the shift."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, Moments] = {}
        for b in batches:
            for _, x in _matrices(b, 0):
                dim = x.shape[1]
                own.setdefault(dim, Moments.none(dim)).add(x - shifts[dim])
        for dim, m in own.items():
            at, nth, value = m.limbs()
            yield pa.record_batch({"dim": pa.array([dim] * len(at), pa.int32()), "at": pa.array(at, pa.int64()), "limb": pa.array(nth, pa.int32()), "value": pa.array(value, pa.int64())})

    sums = in_arrow(fit.select("x"), run, "dim int, at bigint, limb int, value bigint").groupBy("dim", "at", "limb").agg(F.sum("value").alias("value"))
    whole: dict[int, dict[int, int]] = {}
    for r in sums.collect():  # as many rows as a triangle of the dimension has, times the limbs of a number
        numbers = whole.setdefault(r["dim"], {})
        numbers[r["at"]] = numbers.get(r["at"], 0) + (r["value"] << LIMB * r["limb"])
    return {dim: Moments(v[0], [v[1 + i] for i in range(dim)], [v[1 + dim + i] for i in range(dim * (dim + 1) // 2)]) for dim, v in whole.items()}


@dataclass
class Model:
    """One length's whitening: n and the exact sums of the fit list, unit eigenvectors as columns, their eigenvalues, and shares of the trace."""

    n: int
    sums: list
    vectors: np.ndarray
    values: np.ndarray
    shares: np.ndarray

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, exact; 64-bit integers where they hold it."""
        most = self.n * max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) + max(map(abs, self.sums), default=0)
        if most >= 2**63:
            return x.astype(object) * self.n - np.array(self.sums, object)
        return x * self.n - np.array(self.sums, np.int64)

    def whitened(self, deviations: np.ndarray) -> np.ndarray:
        return (deviations.astype(float) / self.n) @ (self.vectors / np.sqrt(self.values))


def decompose(m: Moments, shift: np.ndarray, components: int) -> Model:
    """From exact sums to eigenvectors; floating point starts with the finished scatter."""
    dim, n = len(m.sums), m.n
    scatter, k = np.zeros((dim, dim)), 0
    for i in range(dim):
        for j in range(i, dim):
            scatter[i, j] = scatter[j, i] = float(Fraction(n * m.products[k] - m.sums[i] * m.sums[j], n * n))
            k += 1
    trace = float(Fraction(sum(n * m.products[i * dim - i * (i - 1) // 2] - m.sums[i] ** 2 for i in range(dim)), n * n))
    # A power of two as the unit keeps the bits and lets no square overflow.
    unit = 2.0 ** np.floor(np.log2(trace)) if trace > 0 else 1.0
    values, vectors = np.linalg.eigh(scatter / unit)
    values, vectors = values[::-1], vectors[:, ::-1]
    take = np.flatnonzero(values > max(0.0, TINY * values[0]))[:components] if trace > 0 else np.zeros(0, int)
    return Model(n, [s + n * int(h) for s, h in zip(m.sums, shift)], vectors[:, take], values[take] * unit, values[take] * unit / trace if trace > 0 else np.zeros(0))


def identity_errors(fit: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """By length, the largest entry by which the covariance of the whitened fit list differs from the identity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for b in batches:
            for _, x in _matrices(b, 0):
                m = models[x.shape[1]]
                w = m.whitened(m.deviations(x))
                own[x.shape[1]] = own.get(x.shape[1], 0) + w.T @ w
        for dim, c in own.items():
            yield pa.record_batch({"dim": pa.array([dim] * c.size, pa.int32()), "at": pa.array(range(c.size), pa.int32()), "value": pa.array(c.ravel())})

    sums = in_arrow(fit.select("x"), run, "dim int, at int, value double").groupBy("dim", "at").agg(F.sum("value").alias("value"))
    out: dict[int, float] = {}
    for r in sums.collect():  # components squared for each length
        m = models[r["dim"]]
        want = float(r["at"] % (len(m.values) + 1) == 0)
        out[r["dim"]] = max(out.get(r["dim"], 0.0), abs(r["value"] / m.n - want))
    return out


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``id_col, component, n, deviation, whitened, explained, identity_error``: a row for each vector and component, numbered from 1.

    deviation: decimal, the sum over dimensions of ``(n * x - S)**2``; explained: the share of the variance.
    """
    if components < 1:
        raise ValueError("at least one component is wanted")
    rows = vectors.select(F.col(id_col).alias("id"), integers(F.col(vec_col)).alias("x")).filter(F.col("x").isNotNull())
    fit, path = written(rows.select("x").distinct(), "whitening_fit")
    ends = fit.select(F.size("x").alias("dim"), F.posexplode("x").alias("at", "x")).groupBy("dim", "at").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    shifts: dict[int, np.ndarray] = {}
    for r in ends.collect():  # a row for each dimension
        shifts.setdefault(r["dim"], np.zeros(r["dim"], np.int64))[r["at"]] = (r["low"] + r["high"]) // 2
    models = {dim: decompose(m, shifts[dim], components) for dim, m in moments(fit, shifts).items()}
    errors = identity_errors(fit, models)
    drop_path(vectors.sparkSession, path)
    kind = dict(vectors.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, x in _matrices(b, 1):
                m = models[x.shape[1]]
                c = len(m.values)
                d = m.deviations(x)
                most = max(abs(int(d.max(initial=0))), abs(int(d.min(initial=0))))
                exact = d if most * most * d.shape[1] < 2**63 else d.astype(object)
                total = pa.array(np.repeat((exact * exact).sum(1), c).tolist(), pa.decimal128(38, 0))
                k = len(at) * c
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).take(pa.array(np.repeat(at, c))), pa.array(np.tile(np.arange(1, c + 1), len(at)), pa.int32()), pa.array(np.full(k, m.n), pa.int64()), total,
                        pa.array(m.whitened(d).ravel()), pa.array(np.tile(m.shares, len(at))), pa.array(np.full(k, errors.get(x.shape[1], 0.0))),
                    ],
                    names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    schema = f"`{id_col}` {kind}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    return in_arrow(rows, run, schema)
