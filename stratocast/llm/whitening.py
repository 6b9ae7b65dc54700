"""Embedding whitening by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance V of all vectors are found without
forming V. A pass over the vectors gives V Q for a block Q of a few columns:
each task centres its vectors, multiplies, and returns one sum of (dimensions x
columns) numbers. A cycle is

1. the filter: a Chebyshev polynomial in V, by its three-term recurrence with a
   pass for each degree. On [0, cut] the polynomial stays within -1 and 1 and
   above it grows fast, so what is below ``cut``, the block's smallest Ritz
   value, is damped;
2. QR, one more pass, and Rayleigh-Ritz: the eigenvalues and vectors of Q'VQ;
3. the certificate: |V q - e q| for each wanted column, which bounds the distance
   from e to an eigenvalue of V. The cycles end when it is at the rounding error.

A block that gets on slowly, as with many close eigenvalues, is doubled; with as
many columns as dimensions Rayleigh-Ritz alone is exact, so this ends.

The vectors, made whole numbers, are written once as packed matrices to the
shared folder, and all passes read these. Only block-sized sums (dimensions x
columns) come to the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed, columns, ship

SCALE, SHIFT = 1024, 100_000
GUARD = 24  # columns of the block beyond the wanted ones
DEGREE = 12  # of the filter, at most
GROWTH = 1e6  # of the first column over the last wanted one in a filter, at most
TOLERANCE = 2e-14  # of the residual, in parts of the largest eigenvalue
PATIENCE = 6  # cycles before the block is doubled
FLOOR = 1e-12  # an eigenvalue of a smaller part of the largest counts as none
PACK = 4096  # vectors of a packed matrix
FAN = 64  # sums that the driver adds up itself
LARGEST = float(1 << 52)  # of 1024 * entry, which is a whole number up to there


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """floor(1024 * c) + 100000 of each entry, as int64."""
    scaled = np.floor(values.astype(np.float64) * SCALE)
    if scaled.size and np.abs(scaled).max() > LARGEST:
        raise ValueError("an entry is too large for an exact whole number of 1024ths")
    return scaled.astype(np.int64) + SHIFT


def _matrix(column: pa.ListArray) -> np.ndarray:
    rows = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return whole_numbers(flat).reshape(rows, -1)


def _pack(vector: str):
    """Vectors to packed matrices of up to PACK rows, in the narrowest type."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PACK):
                x = _matrix(columns(batch.slice(at, PACK), vector)[0])
                narrow = x.astype(np.int32) if np.abs(x).max() < 1 << 31 else x
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(x)], pa.int64()), pa.array([narrow.itemsize], pa.int32()), pa.array([narrow.tobytes()], pa.binary())],
                    names=["rows", "itemsize", "cells"],
                )

    return run


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        for rows, size, cells in zip(*(c.to_pylist() for c in columns(batch, "rows", "itemsize", "cells")), strict=True):
            yield np.frombuffer(cells, np.int32 if size == 4 else np.int64).reshape(rows, -1)


def _added(rows: pa.Table) -> pa.Table:
    parts = [np.frombuffer(c, np.float64) for c in rows["sums"].to_pylist()]
    return pa.table({"part": rows["part"][:1], "sums": pa.array([np.sum(parts, axis=0).tobytes()], pa.binary())})


class Packed:
    """Packed whole-number vectors: counts, sums and passes over them."""

    def __init__(self, vectors: DataFrame, vector: str, dimensions: int):
        self.blocks = checkpointed(vectors.select(vector).mapInArrow(_pack(vector), "rows long, itemsize int, cells binary"))
        self.parts = self.blocks.rdd.getNumPartitions()
        self.dimensions = dimensions

        def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, sums = 0, [0] * dimensions
            for x in _unpacked(batches):
                n += len(x)
                sums = [a + b for a, b in zip(sums, map(int, x.astype(object).sum(0) if np.abs(x).max() > 1 << 48 else x.sum(0, dtype=np.int64)), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([n, *sums], pa.decimal128(38, 0)), pa.array(range(dimensions + 1), pa.int32())], names=["total", "at"])

        # exact: whole numbers, one row for each dimension
        found = self.blocks.mapInArrow(totals, "total decimal(38,0), at int").groupBy("at").agg(F.sum("total").alias("total")).collect()
        total = {r.at: int(r.total) for r in found}
        self.n, self.sums = total[0], [total[i + 1] for i in range(dimensions)]
        self.mean = np.array([s / self.n for s in self.sums])

    def total(self, of: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
        """The sum of ``of(centred matrix)`` over all matrices, added up per
        task, then in groups of tasks, and last in the driver."""
        mean = self.mean
        fan = max(1, math.isqrt(self.parts)) if self.parts > FAN else 1

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            part = TaskContext.get().partitionId()
            out = np.zeros(size)
            for x in _unpacked(batches):
                out += of(x - mean).ravel()
            yield pa.RecordBatch.from_arrays([pa.array([part % fan if fan > 1 else part], pa.int32()), pa.array([out.tobytes()], pa.binary())], names=["part", "sums"])

        sums = self.blocks.mapInArrow(partial, "part int, sums binary")
        if fan > 1:
            sums = sums.groupBy("part").applyInArrow(_added, "part int, sums binary")
        rows = sorted((r.part, bytes(r.sums)) for r in sums.collect())
        return np.sum([np.frombuffer(s, np.float64) for _, s in rows], axis=0)

    def times(self, q: np.ndarray) -> np.ndarray:
        """V q: centred, multiplied, divided by n."""
        return self.total(lambda c: c.T @ (c @ q), q.size).reshape(q.shape) / self.n

    def trace(self) -> float:
        return float(self.total(lambda c: np.einsum("ij,ij->j", c, c), self.dimensions).sum() / self.n)


def chebyshev(times: Callable[[np.ndarray], np.ndarray], q: np.ndarray, cut: float, top: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of this degree, in the operator ``times`` mapped
    so that [0, cut] becomes [-1, 1], applied to q and scaled by its value at
    ``top``."""
    half = cut / 2
    first = half / (top - half)
    scale, before, now = first, q, (times(q) - half * q) * (first / half)
    for _ in range(degree - 1):
        new = 1 / (2 / first - scale)
        before, now = now, (times(now) - half * now) * (2 * new / half) - scale * new * before
        scale = new
    return now


def leading_eigenpairs(times: Callable[[np.ndarray], np.ndarray], dimensions: int, wanted: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, their unit vectors as columns
    and the certificate |V q - e q| of each."""
    rng = np.random.default_rng(seed)
    size = min(dimensions, wanted + GUARD)
    q = np.linalg.qr(rng.normal(size=(dimensions, size)))[0]
    least, cycle = math.inf, 0
    while True:
        v = times(q)
        values, turn = np.linalg.eigh((q.T @ v + v.T @ q) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, v = q @ turn, v @ turn
        residual = np.linalg.norm(v - q * values, axis=0)[:wanted]
        top, worst = values[0], float(residual.max(initial=0))
        if top <= 0 or worst <= TOLERANCE * top or size == dimensions:
            return values[:wanted], q[:, :wanted], residual
        if worst <= 1e-12 * top and worst > least / 2:  # down to rounding: no cycle betters it
            return values[:wanted], q[:, :wanted], residual
        least, cycle = min(least, worst), cycle + 1
        if cycle % PATIENCE == 0:
            more = rng.normal(size=(dimensions, min(size, dimensions - size)))
            q = np.linalg.qr(np.hstack([q, more]))[0]
            size = q.shape[1]
            continue
        cut = max(float(values[-1]), 1e-6 * top)
        grown = [math.acosh(max(1.0, 2 * e / cut - 1)) for e in (top, max(cut, values[min(wanted, size) - 1]))]
        spread = grown[0] - grown[1]
        degree = DEGREE if spread <= 0 else int(min(DEGREE, max(2, math.log(GROWTH) / spread)))
        q = np.linalg.qr(chebyshev(times, q, cut, float(top), degree))[0]


@dataclass
class Whitening:
    """n vectors with per-dimension ``sums``; unit ``components`` as columns with
    their eigenvalues, falling, the parts ``explained`` of the trace, and the
    ``residuals`` that certify them."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    residuals: np.ndarray
    identity_error: float


def _proper(df: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """Rows with vectors of finite entries, all as long as the commonest length
    (the greater of equally common ones), and this length."""
    fine = F.forall(vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    rows = df.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & fine)
    common = rows.groupBy(F.size(vector).alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return (rows, 0) if common is None else (rows.where(F.size(vector) == common.d), common.d)


def fit(df: DataFrame, vector: str = "embedding", wanted: int = 8) -> Whitening | None:
    """The whitening of all proper vectors (see ``whiten``); None without any."""
    ship(df.sparkSession)
    rows, dimensions = _proper(df, vector)
    if not dimensions:
        return None
    packed = Packed(rows, vector, dimensions)
    trace = packed.trace()
    if trace <= 0:
        none = np.empty(0)
        return Whitening(packed.n, packed.sums, np.empty((dimensions, 0)), none, none, none, 0.0)
    values, q, residual = leading_eigenpairs(packed.times, dimensions, min(wanted, dimensions))
    kept = values > FLOOR * values[0]
    values, q, residual = values[kept], q[:, kept], residual[kept]
    map_ = q / np.sqrt(values)

    def moments(c: np.ndarray) -> np.ndarray:
        z = c @ map_
        return np.vstack([z.sum(0), z.T @ z])

    k = len(values)
    found = packed.total(moments, (k + 1) * k).reshape(k + 1, k) / packed.n
    error = float(np.abs(found[1:] - np.outer(found[0], found[0]) - np.eye(k)).max())
    return Whitening(packed.n, packed.sums, q, values, values / trace, residual, error)


def _project(kept: list[str], vector: str, model: Whitening):
    mean = np.array([s / model.n for s in model.sums])
    map_ = model.components / np.sqrt(model.eigenvalues)

    def deviations(x: np.ndarray) -> list[int | None]:
        room = math.isqrt((1 << 63) // x.shape[1]) - 1
        if int(np.abs(x).max()) * model.n + max(map(abs, model.sums)) < 1 << 62:
            off = x * model.n - np.array(model.sums, np.int64)
            if np.abs(off).max() <= room:
                return (off * off).sum(1).tolist()
        off = x.astype(object) * model.n - np.array(model.sums, object)
        return [s if s < 1 << 63 else None for s in (off * off).sum(1).tolist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(columns(batch, vector)[0])
            z = (x - mean) @ map_
            ends = np.arange(0, z.size + 1, z.shape[1]) if z.shape[1] else np.zeros(len(z) + 1, int)
            whitened = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(z.ravel(), pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [*columns(batch, *kept), pa.array(deviations(x), pa.int64()), whitened], names=[*kept, "deviation", "whitened"]
            )

    return run


def whiten(df: DataFrame, vector: str = "embedding", wanted: int = 8) -> tuple[DataFrame, Whitening | None]:
    """The rows of ``df`` with a proper vector, all their columns, deviation long
    and whitened array<double> (the first ``wanted`` components, by falling
    eigenvalue); and the whitening. Columns of these two names are replaced.

    A vector is proper if it is not null or empty, holds no null and no
    non-finite entry, and is as long as the commonest of such vectors (the
    longer of two equally common lengths). All proper rows are fitted, repeated
    ones each time. An entry c counts as floor(1024 * c) + 100000; an entry of
    2**42 and more stops the job. deviation is the exact sum of (n * x - sum)**2,
    null where that is beyond a long. Directions without variance (an
    eigenvalue of 1e-12 of the largest or less) are no components, so equal
    vectors, or a single one, have none. Without proper rows the result is
    empty and the whitening None.
    """
    df = df.drop(*(c for c in ("deviation", "whitened") if c != vector))
    model = fit(df, vector, wanted)
    schema = T.StructType([*df.schema.fields, T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    if model is None:
        return df.sparkSession.createDataFrame([], schema), None
    rows = _proper(df, vector)[0].where(F.size(vector) == len(model.sums))
    return rows.mapInArrow(_project(df.columns, vector, model), schema), model
