"""Generalised linear models of every gene at once, fitted by reweighted least squares."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.operators.scratch import kept_table

#: Rounds before an error, the relative change of the deviance at which a gene is settled, and the range of the linear predictor.
ROUNDS, SETTLED, ETA = 60, 1e-11, 30.0


@dataclass(frozen=True)
class Family:
    """mean of the linear predictor, its slope, the variance of a mean, a row's deviance, the first mean, least value allowed."""

    mean: Callable[[np.ndarray], np.ndarray]
    slope: Callable[[np.ndarray], np.ndarray]
    variance: Callable[[np.ndarray], np.ndarray]
    deviance: Callable[[np.ndarray, np.ndarray], np.ndarray]
    link: Callable[[np.ndarray], np.ndarray]
    least: float


def _log(y: np.ndarray) -> np.ndarray:
    return np.log(np.maximum(y, 1e-300))


def _exp(eta: np.ndarray) -> np.ndarray:
    return np.exp(np.clip(eta, -ETA, ETA))


GAUSSIAN = Family(lambda e: e, np.ones_like, np.ones_like, lambda y, m: (y - m) ** 2, lambda y: y, -np.inf)
POISSON = Family(_exp, _exp, lambda m: m, lambda y, m: 2 * (np.where(y > 0, y * (_log(y) - _log(m)), 0.0) - (y - m)), lambda y: np.log(y + 0.5), 0.0)


def negative_binomial(theta: float) -> Family:
    """Log link and variance m + m^2 / theta, theta given."""

    def deviance(y: np.ndarray, m: np.ndarray) -> np.ndarray:
        return 2 * (np.where(y > 0, y * (_log(y) - _log(m)), 0.0) - (y + theta) * (np.log(y + theta) - np.log(m + theta)))

    return Family(_exp, _exp, lambda m: m + m * m / theta, deviance, lambda y: np.log(y + 0.5), 0.0)


def _design(frame: pd.DataFrame) -> np.ndarray:
    return np.column_stack([np.ones(len(frame)), np.stack(frame["x"].to_list()).astype(float)])


def _rows(full: DataFrame, regressors: list[str]) -> DataFrame:
    """(cell_id, gene_id, value, x): regressors less their mean over their deviation, so that sums of products stay well scaled."""
    known = full.where(" and ".join(f"`{c}` is not null" for c in ("value", *regressors)))
    moments = known.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in regressors]).select(F.struct("*").alias("z")).select("z").scalar()
    scaled = [(F.col(c) - F.col("__z")[c]["m"]) / F.when(F.col("__z")[c]["s"] > 0, F.col("__z")[c]["s"]).otherwise(1.0) for c in regressors]
    return known.withColumn("__z", moments).select("cell_id", "gene_id", F.col("value").cast("double").alias("value"), F.array(*scaled).alias("x"))


def fit_genes(rows: DataFrame, family: Family, width: int) -> DataFrame:
    """(gene_id, beta, deviance, round): coefficients on (1, x) of rows (cell_id, gene_id, value, x), x of width - 1 numbers.

    In a round tasks add up the weighted products of their own rows of a gene, Spark adds up the tasks, and a gene's system
    of width equations is solved; no gene's cells come together. Where a step has raised the deviance, half of it is taken back.
    Settled genes leave the rounds. An error are values below the family's least one and genes that ROUNDS rounds don't settle.
    """
    cells = width * width + width + 1

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for frame in frames:
            if (frame["value"] < family.least).any():
                raise ValueError(f"values below {family.least} don't fit the family")
            for gene, part in frame.groupby("gene_id"):
                x, y, beta = _design(part), part["value"].to_numpy(float), part["beta"].iloc[0]
                eta = family.link(y) if beta is None else x @ np.asarray(beta, float)
                mean, slope = family.mean(eta), family.slope(eta)
                weight = slope * slope / family.variance(mean)
                own = np.concatenate([((x * weight[:, None]).T @ x).ravel(), x.T @ (weight * (eta + (y - mean) / slope)), [family.deviance(y, mean).sum()]])
                sums[gene] = sums[gene] + own if gene in sums else own
        yield pd.DataFrame([(g, i, v) for g, s in sums.items() for i, v in enumerate(s.tolist())], columns=["gene_id", "i", "v"])

    def step(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for gene, s, beta, before, best, number in frame[["gene_id", "s", "beta", "before", "deviance", "round"]].itertuples(index=False):
                s = np.asarray(s, float)
                now = s[-1] if beta is not None else np.inf
                if beta is not None and abs(now - best) <= SETTLED * (abs(now) + 0.1):
                    out.append((gene, beta, beta, now, number + 1, True))
                elif beta is not None and before is not None and now > best:
                    out.append((gene, (np.asarray(beta) + np.asarray(before)) / 2, before, best, number + 1, False))
                else:
                    solved = np.linalg.lstsq(s[: width * width].reshape(width, width), s[width * width : -1], rcond=None)[0]
                    out.append((gene, solved, beta, now, number + 1, False))
            yield pd.DataFrame(out, columns=["gene_id", "beta", "before", "deviance", "round", "settled"])

    state = "gene_id long, beta array<double>, before array<double>, deviance double, round int, settled boolean"
    genes = rows.select("gene_id").distinct().selectExpr("gene_id", "cast(null as array<double>) beta", "cast(null as array<double>) before", "double('inf') deviance", "0 round", "false settled")
    genes = kept_table(genes, "genes")
    done = genes.where("settled")
    for _ in range(ROUNDS):
        sums = rows.join(genes.select("gene_id", "beta"), "gene_id").mapInPandas(add, "gene_id long, i int, v double").groupBy("gene_id", "i").agg(F.sum("v").alias("v"))
        lists = sums.groupBy("gene_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "v"))), lambda p: p["v"]).alias("s")).where(F.size("s") == cells)
        moved = kept_table(lists.join(genes.drop("settled"), "gene_id").mapInPandas(step, state), "glm")
        done, genes = done.union(moved.where("settled")), moved.where("not settled")
        if genes.isEmpty():
            return done.select("gene_id", "beta", "deviance", "round")
    raise RuntimeError(f"{genes.count()} genes have not settled after {ROUNDS} rounds")


def residuals(full: DataFrame, family: Family, regressors: list[str], kind: str = "pearson") -> DataFrame:
    """(cell_id, gene_id, value): residuals of a model of each gene on (1, regressors), of kind response, pearson or deviance.

    full: (cell_id, gene_id, value, regressors). Rows with a null among value and regressors have no residual and take no part.
    """
    if kind not in ("response", "pearson", "deviance"):
        raise ValueError("kind is response, pearson or deviance")
    rows = kept_table(_rows(full, regressors), "rows")
    fitted = rows.join(fit_genes(rows, family, len(regressors) + 1).select("gene_id", "beta"), "gene_id")

    def rest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                y, mean = frame["value"].to_numpy(float), family.mean((_design(frame) * np.stack(frame["beta"].to_list())).sum(axis=1))
                left = y - mean
                if kind == "pearson":
                    left = left / np.sqrt(family.variance(mean))
                elif kind == "deviance":
                    left = np.sign(left) * np.sqrt(np.maximum(family.deviance(y, mean), 0.0))
                yield frame[["cell_id", "gene_id"]].assign(value=left)

    return fitted.select("cell_id", "gene_id", "value", "x", "beta").mapInPandas(rest, "cell_id long, gene_id long, value double")
