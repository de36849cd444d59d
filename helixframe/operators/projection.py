"""Principal components of tall tables of vectors by a randomised block method.

The rows stay on executors. A pass over them multiplies their covariance with a block of some 60 columns, and what comes
back to the driver is that block: dimensions x columns numbers, never a row and never a matrix of dimensions x dimensions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.operators.scratch import kept_table

#: Columns beside the wanted ones, blocks held before they are contracted, passes before an error, and the residual wanted of a component.
EXTRA, BLOCKS, PASSES, RESIDUAL = 10, 6, 200, 1e-7


@dataclass
class Projection:
    """mean (d), components (d x k, orthonormal columns), explained (k shares of the variance), passes over the rows."""

    mean: np.ndarray
    components: np.ndarray
    explained: np.ndarray
    passes: int


def _orthonormal(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """An orthonormal base of what the block adds to the basis; columns that add nothing are left out."""
    for _ in range(2):
        block = block - basis @ (basis.T @ block)
    size = np.linalg.norm(block, axis=0)
    block = block[:, size > 1e-13 * max(1.0, size.max(initial=0.0))]
    u, s, _ = np.linalg.svd(block / np.linalg.norm(block, axis=0), full_matrices=False)
    u = u[:, s > 1e-8]
    u = u - basis @ (basis.T @ u)
    return np.linalg.qr(u)[0] if u.shape[1] else u


def _times_covariance(rows: DataFrame, mean: np.ndarray, block: np.ndarray, n: int) -> np.ndarray:
    """The covariance of the rows times the block: each task adds up its own rows, a sum by cell adds up the tasks."""
    d, width = block.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, width))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d) - mean
            total += x.T @ (x @ block)
        yield pa.record_batch([pa.array(np.arange(d * width)), pa.array(total.ravel())], names=["cell", "v"])

    cells = rows.mapInArrow(add, "cell long, v double").groupBy("cell").agg(F.sum("v").alias("v")).toPandas()
    found = np.zeros(d * width)
    found[cells["cell"].to_numpy()] = cells["v"].to_numpy()
    return found.reshape(d, width) / (n - 1)


def fit(train: DataFrame, k: int, column: str = "vec", seed: int = 0, tolerance: float = RESIDUAL) -> Projection:
    """The first k components of the rows, centred; fewer where the vectors have fewer dimensions.

    A random block is multiplied with the covariance; the part of the product that the basis does not hold yet becomes the next
    block, until |C v - lambda v| is at most tolerance x the largest eigenvalue for each component. Beyond BLOCKS blocks
    the basis is contracted to its best vectors. Rows whose vector is null take no part. An error are vectors of different
    lengths or with null components, fewer than two rows, and PASSES passes without an end.
    Signs are fixed: a component's largest entry is positive.
    """
    rows = kept_table(train.where(F.col(column).isNotNull()).select(F.transform(column, lambda x: x.cast("double")).alias("vec")), "train")
    least, most, n, holes = rows.agg(F.min(F.size("vec")), F.max(F.size("vec")), F.count("*"), F.count_if(F.exists("vec", lambda x: x.isNull()))).first()
    if n < 2:
        raise ValueError("a projection needs two rows or more")
    if least != most or holes:
        raise ValueError("vectors of one length without null components are needed")
    axis = rows.select(F.posexplode("vec").alias("d", "x")).groupBy("d").agg(F.avg("x").alias("m"), F.var_samp("x").alias("v")).orderBy("d").toPandas()
    mean, variance, d = axis["m"].to_numpy(), float(axis["v"].sum()), int(most)
    k, width = min(k, d), min(k + EXTRA, d)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, width)))[0]
    moved = _times_covariance(rows, mean, basis, n)
    for passes in range(1, PASSES + 1):
        small = basis.T @ moved
        values, vectors = np.linalg.eigh((small + small.T) / 2)
        best = vectors[:, ::-1][:, :width]
        values = np.maximum(values[::-1][:width], 0.0)
        left = moved @ best - (basis @ best) * values
        found = basis @ best[:, :k]
        if basis.shape[1] == d or np.linalg.norm(left[:, :k], axis=0).max() <= tolerance * max(values[0], 1e-300):
            sign = np.sign(found[np.abs(found).argmax(axis=0), np.arange(k)])
            return Projection(mean, found * np.where(sign == 0, 1.0, sign), values[:k] / variance if variance > 0 else np.zeros(k), passes)
        if basis.shape[1] + width > BLOCKS * width:
            basis, moved = basis @ best, moved @ best
        block = _orthonormal(left, basis)[:, : d - basis.shape[1]]
        if not block.shape[1]:  # the rows span less than the wanted components: any direction beside them has no variance
            block = _orthonormal(np.random.default_rng(seed + passes).standard_normal((d, width)), basis)[:, : d - basis.shape[1]]
        basis, moved = np.hstack([basis, block]), np.hstack([moved, _times_covariance(rows, mean, block, n)])
    raise RuntimeError(f"no {k} components after {PASSES} passes")


def project(model: Projection, vectors: DataFrame, column: str = "vec", out: str = "pcs") -> DataFrame:
    """Adds the coordinates of each row; null for a null vector."""
    mean, components = model.mean, model.components

    @F.pandas_udf("array<double>")
    def onto(vecs: pd.Series) -> pd.Series:
        some = vecs.notna().to_numpy()
        result = pd.Series([None] * len(vecs), dtype=object)
        if some.any():
            x = np.stack(vecs[some].to_list()).astype("float64")
            result.loc[np.flatnonzero(some)] = list((x - mean) @ components)
        return result

    return vectors.withColumn(out, onto(F.col(column)))
