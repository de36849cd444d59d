"""User functions over columns and groups: metrics of two vectors, fits of a gene, batch models."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf


def vector_metric(f: Callable[[np.ndarray, np.ndarray], np.ndarray]):
    """A column function of two array columns of one length from a function of two matrices, whose rows are the vectors of an Arrow batch."""

    @pandas_udf(T.DoubleType())
    def apply(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(f(np.stack(a).astype(float), np.stack(b).astype(float))) if len(a) else pd.Series([], dtype=float)

    return apply


@dataclass(frozen=True)
class Fit:
    """A model whose fit needs only sums over rows: what a row adds, the coefficients from the sums, and the residuals."""

    adds: Callable[[np.ndarray, np.ndarray], np.ndarray]  # (n x d, n) -> sums of the rows' parts
    solve: Callable[[np.ndarray], np.ndarray]  # sums -> coefficients
    residual: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]  # (n x d, n, n x coefficients) -> n


def per_gene_fit(full: DataFrame, fit: Fit, regressors: list[str]) -> DataFrame:
    """(cell_id, gene_id, value): the residuals of a model of each gene on (1, regressors).

    Tasks add up their own rows of a gene, Spark adds up the tasks' sums; no gene's cells ever come together.
    """

    def design(frame: pd.DataFrame) -> np.ndarray:
        return np.column_stack([np.ones(len(frame)), frame[regressors].to_numpy(float)])

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for frame in frames:
            for gene, part in frame.groupby("gene_id"):
                own = fit.adds(design(part), part["value"].to_numpy(float))
                sums[gene] = sums[gene] + own if gene in sums else own
        rows = [(g, i, float(x)) for g, v in sums.items() for i, x in enumerate(v)]
        yield pd.DataFrame(rows, columns=["gene_id", "i", "x"])

    @pandas_udf(T.ArrayType(T.DoubleType()))
    def solved(sums: pd.Series) -> pd.Series:
        return pd.Series([fit.solve(np.asarray(s, float)) for s in sums], dtype=object)

    def rest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield frame[["cell_id", "gene_id"]].assign(value=fit.residual(design(frame), frame["value"].to_numpy(float), np.stack(frame["coefficients"])))

    columns = ["cell_id", "gene_id", "value", *regressors]
    parts = full.select(*columns).mapInPandas(add, "gene_id long, i int, x double").groupBy("gene_id", "i").agg(F.sum("x").alias("x"))
    sums = parts.groupBy("gene_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda p: p["x"]).alias("s"))
    fitted = full.select(*columns).join(sums.select("gene_id", solved("s").alias("coefficients")), "gene_id")
    return fitted.mapInPandas(rest, "cell_id long, gene_id long, value double")


def _normal_sums(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.concatenate([(x.T @ x).reshape(-1), x.T @ y])


def _normal_solve(sums: np.ndarray) -> np.ndarray:
    d = int((np.sqrt(4 * len(sums) + 1) - 1) / 2)
    return np.linalg.lstsq(sums[: d * d].reshape(d, d), sums[d * d :], rcond=None)[0]


#: Least squares by the normal equations.
LEAST_SQUARES = Fit(_normal_sums, _normal_solve, lambda x, y, b: y - (x * b).sum(axis=1))


def score_in_batches(rows: DataFrame, factory: Callable[[], Callable[[list[str]], np.ndarray]], id_col: str = "seq_id", seq_col: str = "seq") -> DataFrame:
    """(id, score) from a model that the factory loads once in each task; batches are sorted by length before they are scored."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = factory()
        for frame in frames:
            ordered = frame.iloc[np.argsort(frame[seq_col].str.len().to_numpy(), kind="stable")]
            yield pd.DataFrame({id_col: ordered[id_col].to_numpy(), "score": np.asarray(model(ordered[seq_col].tolist()), float)})

    return rows.select(id_col, seq_col).mapInPandas(run, f"{id_col} long, score double")


def kmer_hash_scorer(k: int = 3, buckets: int = 97) -> Callable[[], Callable[[list[str]], np.ndarray]]:
    """A stand-in model: the mean bucket number of a sequence's k-mers under a fixed polynomial."""

    def load():
        def score(seqs: list[str]) -> np.ndarray:
            out = []
            for s in seqs:
                codes = np.frombuffer(s.encode(), np.uint8).astype(np.int64)
                n = len(codes) - k + 1
                value = sum(codes[i : i + n] * 31 ** (k - 1 - i) for i in range(k)) % buckets if n > 0 else np.zeros(0)
                out.append(value.mean() if n > 0 else 0.0)
            return np.array(out)

        return score

    return load
