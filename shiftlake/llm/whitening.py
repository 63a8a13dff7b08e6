"""Embedding whitening by polarisation covariance.

Method: components are put on an integer grid, x = floor(scale * c) + offset.
The fit list holds each distinct x vector once. One pass gives its length n
and the sums S; a second adds up, exactly and over centred values n*x - S, the
squares of every dimension and of every sum of two dimensions. As
Var(a + b) = Var(a) + Var(b) + 2 Cov(a, b), differences of these variances are
all cross-covariances; eigh takes the assembled matrix. Two more passes measure
the covariance of the whitened fit list itself.

Scale: the rows are written once on the grid; the fit list is a distinct with
partial aggregation, so a vector that a third of all rows share is one row per
task. Tasks send one row per dimension pair; the driver gets D * (D + 1) / 2
sums for D dimensions, whatever the number of rows. Whole sums are kept: squares are taken in
20-bit limbs, a task's totals are Python integers, and Spark adds their high
and low parts as decimals.

Defined cases: rows whose vector is null or holds null, NaN or infinite
components are dropped; a null id stays; repeated rows are returned each but
fitted once; shorter vectors count as zero-filled; a component whose variance
is zero (by 1e-12 of the trace) can't be whitened and is left out, so fewer than
two distinct vectors, and empty tables, give no rows; equal eigenvalues may
come in any order; other columns of the input are left out. Components beyond
2**62 / scale fail the cast to a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlake.llm.common import Scratch

LIMB = 20
#: Parts of an exact sum: value = high << PART | low.
PART = 60


def square_sums(y: np.ndarray) -> list[int]:
    """Exact sum of squares of each column (integers of any size)."""
    if y.dtype == object:
        return [int(v) for v in (y * y).sum(axis=0)]
    y = np.abs(y)
    limbs = [(y >> (LIMB * k)) & ((1 << LIMB) - 1) for k in range(max(1, -(-int(y.max(initial=0)).bit_length() // LIMB)))]
    total = [0] * y.shape[1]
    for i, a in enumerate(limbs):
        for j in range(i, len(limbs)):
            found = np.einsum("rc,rc->c", a, limbs[j]).tolist()
            weight = (1 << LIMB * (i + j)) * (1 if i == j else 2)
            total = [t + weight * f for t, f in zip(total, found, strict=True)]
    return total


def _matrices(batches, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            yield batch, batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


@dataclass
class Centre:
    """The fit list's length and sums, and whether n*x - S fits 64 bits."""

    n: int
    sums: list[int]
    wide: bool

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n*x - S, exactly; taken about a whole number near the mean, so that only the spread counts."""
        near = [s // self.n for s in self.sums]
        rest = [s - self.n * o for s, o in zip(self.sums, near, strict=True)]
        if self.wide:
            return (x - np.array(near, np.int64)).astype(object) * self.n - np.array(rest, object)
        return (x - np.array(near, np.int64)) * self.n - np.array(rest, np.int64)

    def deviations(self, z: np.ndarray) -> pa.Array:
        """Exact sum of squares of each row, as decimals."""
        if z.dtype != object and z.shape[1] * int(np.abs(z).max(initial=0)) ** 2 < 1 << 63:
            return pa.array((z * z).sum(axis=1)).cast(pa.decimal128(38, 0))
        return pa.array([Decimal(v) for v in square_sums(z.T)], pa.decimal128(38, 0))


def _centre(fit: DataFrame, dims: int) -> Centre:
    def run(batches):
        rows, total, low, high = 0, [0] * dims, None, None
        for _, x in _matrices(batches, dims):
            rows += len(x)
            total = [t + s for t, s in zip(total, np.add.reduce(x.astype(object), axis=0) if np.abs(x).max() >> 48 else x.sum(axis=0).tolist(), strict=True)]
            low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
            high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
        if rows:
            yield pa.RecordBatch.from_pydict({
                "d": pa.array(range(dims), pa.int32()), "n": pa.array([rows] * dims, pa.int64()),
                "s": pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0)), "low": pa.array(low), "high": pa.array(high),
            })

    parts = fit.mapInArrow(run, "d int, n long, s decimal(38,0), low long, high long")
    found = parts.groupBy("d").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.min("low").alias("low"), F.max("high").alias("high")).orderBy("d").collect()
    n = found[0].n
    spread = max(r.high - r.low for r in found)
    return Centre(n, [int(r.s) for r in found], 2 * n * (spread + 2) >= 1 << 62)


def _polarised(fit: DataFrame, dims: int, centre: Centre) -> np.ndarray:
    """The covariance matrix: exact integers until one rounded division each."""
    pairs = [(i, j) for i in range(dims) for j in range(i, dims)]

    def run(batches):
        total = [0] * len(pairs)
        for _, x in _matrices(batches, dims):
            z, found = centre.centred(x), []
            for i in range(dims):
                # the dimension itself, then its sums with all later ones
                found += square_sums(np.concatenate((z[:, i : i + 1], z[:, i + 1 :] + z[:, i : i + 1]), axis=1))
            total = [t + f for t, f in zip(total, found, strict=True)]
        if any(total):
            yield pa.RecordBatch.from_pydict({
                "i": pa.array([i for i, _ in pairs], pa.int32()), "j": pa.array([j for _, j in pairs], pa.int32()),
                "high": pa.array([Decimal(t >> PART) for t in total], pa.decimal128(38, 0)),
                "low": pa.array([t & ((1 << PART) - 1) for t in total], pa.int64()),
            })

    parts = fit.mapInArrow(run, "i int, j int, high decimal(38,0), low long")
    sums = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low")).collect()
    square = {(r.i, r.j): (int(r.high) << PART) + int(r.low) for r in sums}
    out, divisor = np.zeros((dims, dims)), centre.n**3
    for i, j in pairs:
        whole = square.get((i, j), 0)
        # twice the covariance off the diagonal
        out[i, j] = out[j, i] = whole / divisor if i == j else (whole - square.get((i, i), 0) - square.get((j, j), 0)) / (2 * divisor)
    return out


def _axes(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns; the largest entry positive) of what can be whitened."""
    e, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-e, kind="stable")[:components]
    order = order[e[order] > 1e-12 * max(np.trace(covariance), 0.0)]
    vectors = vectors[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    return e[order], vectors * signs


def _identity_error(fit: DataFrame, dims: int, centre: Centre, axes: np.ndarray) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, by two passes."""
    k = axes.shape[1]

    def totals(values, width: int) -> np.ndarray:
        def run(batches):
            total = np.zeros(width)
            for _, x in _matrices(batches, dims):
                total += values(centre.centred(x).astype(float) / centre.n @ axes)
            yield pa.RecordBatch.from_pydict({"i": pa.array(range(width), pa.int32()), "s": total})

        out = np.zeros(width)
        for r in fit.mapInArrow(run, "i int, s double").groupBy("i").agg(F.sum("s").alias("s")).collect():
            out[r.i] = r.s
        return out / centre.n

    mean = totals(lambda w: w.sum(axis=0), k)
    covariance = totals(lambda w: ((w - mean).T @ (w - mean)).ravel(), k * k).reshape(k, k)
    return float(np.abs(covariance - np.eye(k)).max())


def on_grid(vectors: DataFrame, id_col: str, vector_col: str, scale: int, offset: int) -> tuple[DataFrame, int]:
    """(vec_id, x) of the rows that take part, x zero-filled to the longest vector, and that length."""
    c = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).alias("vec_id"), c.alias("c"))
    rows = rows.where(F.col("c").isNotNull() & F.forall("c", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    dims = rows.agg(F.max(F.size("c"))).first()[0] or 0
    x = F.transform("c", lambda v: F.floor(v * scale).cast("long") + offset)
    return rows.select("vec_id", F.concat(x, F.array_repeat(F.lit(offset).cast("long"), F.lit(dims) - F.size("c"))).alias("x")), dims


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 16, scale: int = 64, offset: int = 1_000_000
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every row that takes part and every component.

    ``deviation`` is a decimal(38, 0): the exact sum of (n*x - S)**2.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "whitening")
    id_type = vectors.schema[id_col].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    rows, dims = on_grid(vectors, id_col, vector_col, scale, offset)
    if not dims:
        return spark.createDataFrame([], schema)
    rows = scratch.save(rows, "rows")
    fit = scratch.save(rows.select("x").distinct(), "fit")
    centre = _centre(fit, dims)
    covariance = _polarised(fit, dims, centre)
    e, axes = _axes(covariance, components)
    k = len(e)
    if not k:
        return spark.createDataFrame([], schema)
    explained, axes = e / np.trace(covariance), axes / np.sqrt(e)
    error = _identity_error(fit, dims, centre, axes)
    scratch.drop("fit")

    def run(batches):
        for batch, x in _matrices(batches, dims):
            z, many = centre.centred(x), len(x)
            at = pa.array(np.repeat(np.arange(many), k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), many)),
                    pa.array(np.full(many * k, centre.n)), centre.deviations(z).take(at),
                    pa.array((z.astype(float) / centre.n @ axes).ravel()), pa.array(np.tile(explained, many)), pa.array(np.full(many * k, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, schema)
