"""Whitening of embeddings with a bidiagonal qd solver.

1. Every usable vector becomes integers, ``x = floor(64 c) + 1000000``; the fit
   list holds each distinct ``x`` once (a hash aggregate with map-side combine,
   so a vector that a third of the rows share costs one row per task).
2. The count ``n`` and the sums ``S`` per dimension are exact integers.
3. Blockwise QR: every task folds its centred rows ``(n x - S) / n`` into one
   upper triangle, block after block; triangles are merged ``FAN`` at a time
   until one is left. No covariance is formed, so small directions keep their
   accuracy, and no task or driver holds more than ``FAN`` triangles.
4. The last triangle (its size is that of the dimension) is bidiagonalised,
   dqds gives its singular values and twisted factorisations the directions
   (:mod:`marginlens.llm.bidiagonal`).
5. All rows are projected in one pass; the covariance of the whitened fit list
   is measured in another.

The model is fixed before it is applied, so a lost executor recomputes the
same rows.

Defined cases: a null vector, or one with null or non-finite entries, is
dropped; so is one with an entry whose ``x`` is beyond 2^53, and one whose
length is not the most common (the larger of equally common ones). A null
``vec_id`` stays. Rows repeating an id or a vector are rows of their own.
A direction without variance (square under ``bidiagonal.RANK`` of the largest)
is no component; so one distinct vector, empty vectors and an empty table give
an empty result. A deviation beyond 64 bits is null.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginlens.llm.bidiagonal import right_singular_vectors
from marginlens.llm.common import driver_table, ship_package, staged

COMPONENTS = 16
#: Triangles merged by one task.
FAN = 32
#: Rows of a block of the QR, as a multiple of the dimension.
BLOCK = 16
SAFE = 1 << 62
EXACT = float(1 << 53)


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: tuple[int, ...]
    directions: np.ndarray  # dimension by components
    variances: np.ndarray  # of the components
    trace: float


def _matrix(column: pa.Array, d: int, dtype) -> np.ndarray:
    """Lists of ``d`` entries without nulls as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(column), d)


def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """``vec_id, x`` of the usable rows, and their dimension."""
    def usable(v):
        fits = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * 64.0 < EXACT))
        return v.isNotNull() & F.coalesce(fits, F.lit(False))

    vector = F.col("v")
    sound = (rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
             .filter(usable(vector)))
    common = (sound.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
              .agg(F.max(F.struct("n", "d")).alias("most")).first().most)
    d = common.d if common else 0

    def whole(batches):
        for batch in batches:
            c = _matrix(batch.column("v"), d, np.float64)
            x = np.floor(64.0 * c).astype(np.int64) + 1_000_000
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * d, pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), lists], ["vec_id", "x"])

    id_type = sound.schema["vec_id"].dataType.simpleString()
    return staged(sound.filter(F.size("v") == d).mapInArrow(whole, f"vec_id {id_type}, x array<bigint>"), "vectors"), d


def fit_list(vectors: DataFrame) -> DataFrame:
    return staged(vectors.groupBy("x").agg(F.first(F.lit(0)).alias("_")).select("x"), "fit_list")


def exact_sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """``n`` and the sums per dimension."""
    def add(batches):
        n, total = 0, np.zeros(d, object)
        for batch in batches:
            x = _matrix(batch.column("x"), d, np.int64)
            safe = len(x) == 0 or int(np.abs(x).max(initial=0)) * len(x) < SAFE
            total = total + (x.sum(axis=0) if safe else x.astype(object).sum(axis=0)).astype(object)
            n += len(x)
        numbers = [Decimal(n), *(Decimal(int(t)) for t in total)]
        yield pa.RecordBatch.from_pydict({"k": pa.array(range(-1, d), pa.int32()), "s": pa.array(numbers, pa.decimal128(38, 0))})

    got = {r.k: int(r.s) for r in fit.mapInArrow(add, "k int, s decimal(38,0)")
           .groupBy("k").agg(F.sum("s").alias("s")).collect()}  # one row per dimension
    return got.get(-1, 0), [got.get(k, 0) for k in range(d)]


def _numerators(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """``n x - S``, exact; Python integers where 64 bits do not hold it."""
    if int(np.abs(x).max(initial=0)) * n + max(map(abs, sums), default=0) < SAFE:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    return (_numerators(x, n, sums) / n).astype(float)


def _fold(blocks: Iterator[np.ndarray], d: int) -> np.ndarray:
    """The triangle of all blocks, one after another."""
    r = np.zeros((0, d))
    for block in blocks:
        for at in range(0, len(block), BLOCK * d):
            r = np.linalg.qr(np.vstack((r, block[at:at + BLOCK * d])), mode="r")
    return np.vstack((r, np.zeros((d - len(r), d))))[:d]


def blockwise_qr(fit: DataFrame, d: int, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """The triangle ``R`` of the centred fit list."""
    def one(r):
        lists = pa.ListArray.from_arrays(np.array([0, r.size], np.int32), pa.array(r.ravel()))
        return pa.RecordBatch.from_arrays([lists], ["r"])

    def rows(batches):
        yield one(_fold((_centred(_matrix(b.column("x"), d, np.int64), n, sums) for b in batches if len(b)), d))

    def triangles(batches):
        yield one(_fold((_matrix(b.column("r"), d * d, float).reshape(-1, d) for b in batches if len(b)), d))

    level = staged(fit.mapInArrow(rows, "r array<double>"), "triangles")
    count = level.count()
    while count > 1:
        groups = -(-count // FAN)
        level = staged(level.repartition(groups).mapInArrow(triangles, "r array<double>"), "triangles")
        count = level.count() if groups > 1 else 1
    return np.array(level.first().r).reshape(d, d)


def fit_whitening(fit: DataFrame, d: int, components: int = COMPONENTS) -> Whitening | None:
    """The model of the fit list; None when there is nothing to fit."""
    n, sums = exact_sums(fit, d) if d else (0, [])
    if n == 0:
        return None
    r = blockwise_qr(fit, d, n, tuple(sums))
    squares, directions = right_singular_vectors(r, components)
    k = directions.shape[1]
    return Whitening(n, tuple(sums), directions, squares[:k] / n, float(squares.sum()) / n)


def _whitened(x: np.ndarray, model: Whitening) -> np.ndarray:
    return _centred(x, model.n, model.sums) @ model.directions / np.sqrt(model.variances)


def identity_error(fit: DataFrame, model: Whitening, d: int) -> float:
    """Largest absolute entry of (covariance of the whitened fit list - identity)."""
    k = len(model.variances)

    def products(batches):
        total, cross = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            z = _whitened(_matrix(batch.column("x"), d, np.int64), model)
            total += z.sum(axis=0)
            cross += z.T @ z
        i, j = np.divmod(np.arange(k * k), k)
        yield pa.RecordBatch.from_pydict({
            "i": pa.array([*i, *range(k)], pa.int32()), "j": pa.array([*j, *[-1] * k], pa.int32()),
            "s": pa.array([*cross.ravel(), *total], pa.float64())})

    cov, mean = np.zeros((k, k)), np.zeros(k)
    for row in fit.mapInArrow(products, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        if row.j < 0:
            mean[row.i] = row.s / model.n
        else:
            cov[row.i, row.j] = row.s / model.n
    return float(np.abs(cov - np.outer(mean, mean) - np.eye(k)).max())


def _deviation(x: np.ndarray, model: Whitening) -> list:
    y = _numerators(x, model.n, model.sums)
    biggest = max((int(np.abs(y).max(initial=0)), 0))
    if biggest ** 2 * max(1, y.shape[1]) >= SAFE:
        y = y.astype(object)
    return [int(s) if s < 1 << 63 else None for s in (y * y).sum(axis=1).tolist()]


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """One row per usable row and component: ``vec_id, component, n, deviation,
    whitened, explained, identity_error``."""
    spark = rows.sparkSession
    ship_package(spark)
    vectors, d = integer_vectors(rows, id_col, vector_col)
    fit = fit_list(vectors)
    model = fit_whitening(fit, d, components)
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    schema = (f"vec_id {id_type}, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    if model is None or not len(model.variances):
        return spark.createDataFrame([], schema)
    error = identity_error(fit, model, d)
    k = len(model.variances)

    def project(batches):
        for batch in batches:
            x = _matrix(batch.column("x"), d, np.int64)
            z = _whitened(x, model)
            each = np.repeat(np.arange(len(x)), k)
            share = np.tile(model.variances / model.trace, len(x))
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                pa.array(np.full(len(each), model.n), pa.int64()), pa.array(_deviation(x, model), pa.int64()).take(pa.array(each)),
                pa.array(z.ravel()), pa.array(share), pa.array(np.full(len(each), error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(project, schema)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(driver_table(spark, sf_dir, "embeddings"))
