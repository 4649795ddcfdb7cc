"""Whitening of embeddings along principal components found by contour integration, FEAST (operator 12).

Rows are reduced to sums and one covariance matrix, whose size is that of a vector squared and doesn't depend on the number of rows. Its
largest eigenvalues are then found in steps, each a Spark job over independent small tasks:

1. Inertia counts (how many eigenvalues lie over a shift, from the signs of pivots) at many shifts at once cut the upper end of
   the spectrum into intervals of a few eigenvalues each.
2. Every interval has a circle around it. At each quadrature node z of its upper half one task solves (zI - V) Y = Q; the sum
   of the nodes projects Q on the eigenvectors inside.
3. Per interval, a Rayleigh-Ritz step takes eigenpairs out of the projected space. Steps 2 and 3 are repeated until residuals are down
   at rounding, and until each interval has as many pairs as the inertia counts say. So none is missed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from changewatch.llm.common import mapped, scratch, written

MOST_DIMENSIONS = 2048  # of a vector; its square, 32 MB, is what a task holds
LARGEST = 2.0**55  # entries from here on count as not finite
NODES = 8  # of a half circle
IN_INTERVAL = 6  # eigenvalues, more only where they can't be told apart
SPARE = 8  # columns of a subspace besides the eigenvalues of its interval
ROUNDS = 30
NEGLIGIBLE = 1e-12  # eigenvalues up to this part of the trace count as zero
SALTS = 64


class Components(NamedTuple):
    """n and the sums of the fit list, the eigenvalues by falling size, unit eigenvectors as columns, the trace, and the largest
    deviation of the whitened fit list's covariance from the identity."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


def whole_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """key and x, the entries as floor(scale * c) + shift. Rows whose vector is null, empty or holds null, non-finite or huge
    (``LARGEST``) entries are left out, as are vectors that don't have the length that most have (of equally many, the larger)."""
    entries = F.col(vector).cast("array<double>")
    fine = F.forall(entries, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c * scale) < LARGEST), F.lit(False)))
    found = rows.where(F.col(vector).isNotNull() & (F.size(vector) > 0)).where(fine).select(
        F.col(key).alias("key"), F.transform(entries, lambda c: F.floor(c * scale) + F.lit(shift).cast("long")).alias("x"))
    usual = found.groupBy(F.size("x").alias("k")).agg(F.count(F.lit(1)).alias("n")).agg(
        F.max_by("k", F.struct("n", "k")).alias("k")).head()[0]
    return found.where(F.size("x") == F.lit(usual))


def matrix(column: pa.Array, kind: type = np.int64) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), kind).reshape(len(column), -1)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n, the whole part taken off exactly."""
    whole, rest = zip(*(divmod(s, n) for s in sums))
    return (x - np.array(whole, np.int64)) - np.array(rest, float) / n


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The sum of (n x - S)^2 over the dimensions, exactly; None where it's too large for a long."""
    whole, rest = (np.array(part, object) for part in zip(*(divmod(s, n) for s in sums)))
    shifted = x - whole.astype(np.int64)
    if math.sqrt(x.shape[1]) * (float(np.abs(shifted).max(initial=0)) + 1) * n < 2.0**31:
        own = shifted * n - rest.astype(np.int64)
        return (own * own).sum(axis=1).tolist()
    own = ((shifted.astype(object) * n - rest) ** 2).sum(axis=1)
    return [int(d) if d < 1 << 63 else None for d in own]


def summed_products(rows: DataFrame, of: object) -> np.ndarray:
    """The sum of the products of ``of(x)`` with itself over all rows: each task adds up its own, the sums are added by rows of the
    matrix, in two steps so that no task gets those of all."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = of(matrix(batch.column("x")))
                total = own.T @ own if total is None else total + own.T @ own
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total)), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "products"])

    def add(own: pa.Table) -> pa.Table:
        total = matrix(own.column("products").combine_chunks(), float).sum(axis=0)
        return pa.table([own.column("i").slice(0, 1), own.column("salt").slice(0, 1), pa.array([total], pa.list_(pa.float64()))],
                        ["i", "salt", "products"])

    schema = "i int, salt int, products array<double>"
    parts = mapped(rows, multiply, "i int, products array<double>").withColumn("salt", F.spark_partition_id() % SALTS)
    parts = parts.groupBy("i", "salt").applyInArrow(add, schema).withColumn("salt", F.lit(0)).groupBy("i", "salt").applyInArrow(add, schema)
    return np.array([row.products for row in sorted(parts.collect(), key=lambda row: row.i)])  # as many rows as a vector has entries


def count_below(symmetric: np.ndarray, shift: float) -> int:
    """How many eigenvalues are smaller than ``shift``: the negative pivots of a factorisation with symmetric pivoting, single or
    in pairs (Sylvester's law of inertia)."""
    a = symmetric - shift * np.eye(len(symmetric))
    found = 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        i = int(diagonal.argmax())
        off = np.abs(a) - np.diag(diagonal)
        p, q = divmod(int(off.argmax()), len(a))
        if not max(diagonal[i], off[p, q]):
            break
        chosen = [i] if diagonal[i] >= 0.64 * off[p, q] else [p, q]
        rest = np.delete(np.arange(len(a)), chosen)
        block, side = a[np.ix_(chosen, chosen)], a[np.ix_(rest, chosen)]
        found += int((np.linalg.eigvalsh(block) < 0).sum())
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(block, side.T)
    return found


def counts_above(spark: SparkSession, covariance: object, shifts: list[float]) -> list[int]:
    """For each shift how many eigenvalues lie over it; a task each."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [len(covariance.value) - count_below(covariance.value, shift) for shift in batch.column("shift").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("i"), pa.array(own, pa.int64())], ["i", "n"])

    rows = spark.createDataFrame(list(enumerate(shifts)), "i int, shift double").repartition(len(shifts), "i")
    return [row.n for row in sorted(mapped(rows, count, "i int, n long").collect())]


def intervals(spark: SparkSession, covariance: object, wanted: int) -> list[tuple[float, float, int]]:
    """(low, high, count), from the largest eigenvalues down, of intervals that hold the ``wanted`` largest eigenvalues at least, as far as
    they aren't negligible. Gaps between shifts that hold too many are cut in eight, all in one job, until none does."""
    trace = float(np.trace(covariance.value))
    known = {trace * (1 + 1e-9): 0}
    fresh = [trace * NEGLIGIBLE, *(trace * 2.0**-i for i in range(14))]
    while fresh:
        known.update(zip(fresh, counts_above(spark, covariance, fresh)))
        shifts = sorted(known, reverse=True)
        fresh = [low + (high - low) * i / 8 for high, low in zip(shifts, shifts[1:]) if known[high] < wanted
                 and known[low] - known[high] > IN_INTERVAL and high - low > 1e-9 * trace for i in range(1, 8)]
    return [(low, high, known[low] - known[high]) for high, low in zip(shifts, shifts[1:])
            if known[high] < wanted and known[low] > known[high]]


def projected(spark: SparkSession, told: object) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """One FEAST step for the intervals in ``told`` = (covariance, {number: (low, high, subspace)}): Ritz values and vectors of each."""
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        covariance, spaces = told.value
        for batch in batches:
            for number, node in zip(*(batch.column(c).to_pylist() for c in ("number", "node"))):
                low, high, space = spaces[number]
                turn = np.exp(1j * np.pi * (node + 0.5) / NODES)
                z = (low + high) / 2 + (high - low) / 2 * turn
                y = np.linalg.solve(z * np.eye(len(covariance)) - covariance, space.astype(complex))
                part = ((high - low) / 2 * turn * y).real / NODES
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([part.ravel()], pa.list_(pa.float64()))],
                                                 ["number", "part"])

    def ritz(own: pa.Table) -> pa.Table:
        covariance, spaces = told.value
        number = own.column("number")[0].as_py()
        y = matrix(own.column("part").combine_chunks(), float).sum(axis=0).reshape(spaces[number][2].shape)
        q, _ = np.linalg.qr(y)
        values, turn = np.linalg.eigh(q.T @ covariance @ q)
        return pa.table([pa.array([number], pa.int32()), pa.array([values], pa.list_(pa.float64())),
                         pa.array([(q @ turn).ravel()], pa.list_(pa.float64()))], ["number", "values", "vectors"])

    nodes = [(number, node) for number in told.value[1] for node in range(NODES)]
    rows = spark.createDataFrame(nodes, "number int, node int").repartition(len(nodes), "number", "node")
    parts = mapped(rows, solve, "number int, part array<double>")
    found = parts.groupBy("number").applyInArrow(ritz, "number int, values array<double>, vectors array<double>")
    return {row.number: (np.array(row["values"]), np.array(row["vectors"]).reshape(-1, len(row["values"]))) for row in found.collect()}


def largest_eigenpairs(spark: SparkSession, covariance: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues that aren't negligible, by falling size, and unit eigenvectors as columns."""
    size, trace = len(covariance), float(np.trace(covariance))
    if not trace > 0:
        return np.zeros(0), np.zeros((size, 0))
    shared = spark.sparkContext.broadcast(covariance)
    cuts = dict(enumerate(intervals(spark, shared, wanted)))
    start = np.random.default_rng(12)
    spaces = {i: start.standard_normal((size, min(size, count + SPARE))) for i, (_, _, count) in cuts.items()}
    done: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    before = dict.fromkeys(cuts, math.inf)
    for turn in range(ROUNDS):
        told = spark.sparkContext.broadcast((covariance, {i: (*cuts[i][:2], spaces[i]) for i in cuts if i not in done}))
        for i, (values, vectors) in projected(spark, told).items():
            low, high, count = cuts[i]
            residuals = np.linalg.norm(covariance @ vectors - vectors * values, axis=0) / trace
            pairs = (values > low) & (values <= high) & (residuals < 1e-8)
            worst = residuals[pairs].max(initial=0)
            settled = worst < 1e-15 or worst < 1e-13 and worst > before[i] / 4  # it is down at rounding
            spaces[i], before[i] = vectors, worst
            if pairs.sum() == count and settled:
                done[i] = values[pairs], vectors[:, pairs]
            elif turn % 5 == 4 and vectors.shape[1] < size:  # slow: more columns
                more = start.standard_normal((size, min(size - vectors.shape[1], vectors.shape[1])))
                spaces[i], before[i] = np.hstack([vectors, more]), math.inf
        told.unpersist()
        if len(done) == len(cuts):
            break
    else:
        raise RuntimeError("inertia counts and eigenpairs found differ")
    basis, _ = np.linalg.qr(np.hstack([vectors for _, vectors in done.values()] or [np.zeros((size, 0))]))
    values, turn = np.linalg.eigh(basis.T @ covariance @ basis)  # across intervals, of a few columns
    vectors = (basis @ turn)[:, ::-1][:, :wanted]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])]) if vectors.size else 1
    return values[::-1][:wanted], vectors * signs


def fitted(vectors: DataFrame, most: int = 16) -> Components | None:
    """Components of the distinct vectors x of ``whole_vectors``; None if there are no vectors."""
    spark = vectors.sparkSession
    with scratch(spark):
        fit = written(vectors.select("x").distinct(), "fit")
        sums = fit.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(
            F.sum(F.col("v").cast("decimal(20,0)")).alias("s"), F.count(F.lit(1)).alias("n")).collect()  # a row for each dimension
        if not sums:
            return None
        if len(sums) > MOST_DIMENSIONS:
            raise ValueError(f"vectors have {len(sums)} entries; {MOST_DIMENSIONS} is the most")
        n, sums = sums[0].n, [int(row.s) for row in sorted(sums)]
        covariance = summed_products(fit, lambda x: centred(x, n, sums)) / n
        covariance = (covariance + covariance.T) / 2
        values, axes = largest_eigenpairs(spark, covariance, most)
        error = 0.0
        if len(values):
            turned = axes / np.sqrt(values)
            after = summed_products(fit, lambda x: centred(x, n, sums) @ turned) / n
            error = float(np.abs(after - np.eye(len(values))).max())
    return Components(n, sums, values, axes, float(np.trace(covariance)), error)


def whitened(vectors: DataFrame, found: Components | None, key: str = "vec_id") -> DataFrame:
    """key, component, n, deviation, whitened, explained and identity_error for each row of ``whole_vectors`` and component.

    Equal vectors are fitted once and each row of them is returned, null keys and repeated rows included. Components with an eigenvalue of
    zero, up to rounding, are left out, so there are no rows if all vectors are equal or there is none. A deviation that no long
    can hold is null. Other columns are not looked at."""
    kind = vectors.schema["key"].dataType.simpleString()
    schema = f"key {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if found is None or not len(found.values):
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("key", key)
    count = len(found.values)
    turned, share = found.vectors / np.sqrt(found.values), found.values / found.trace

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            x = matrix(batch.column("x"))
            at = pa.array(np.repeat(np.arange(rows), count))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(at), pa.array(np.tile(np.arange(1, count + 1), rows), pa.int32()),
                 pa.array(np.full(rows * count, found.n), pa.int64()),
                 pa.array(deviations(x, found.n, found.sums), pa.int64()).take(at),
                 pa.array((centred(x, found.n, found.sums) @ turned).ravel()), pa.array(np.tile(share, rows)),
                 pa.array(np.full(rows * count, found.identity_error))],
                ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return mapped(vectors, project, schema).withColumnRenamed("key", key)


def whiten(rows: DataFrame, most: int = 16, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``whitened`` by the ``most`` first components of the rows themselves. What becomes of odd vectors: ``whole_vectors``."""
    vectors = whole_vectors(rows, key, vector)
    return whitened(vectors, fitted(vectors, most), key)
