"""Models of all genes at once against plain fits of one gene."""

import numpy as np
import pytest

from helixframe.functions import glm
from helixframe.plans import registry

SCHEMA = "cell_id long, gene_id long, value double, a double, b double"


def plain_fit(x, y, theta=None):
    """Fisher scoring of a log-linear model until the score is zero; theta: of the negative binomial."""
    beta = np.zeros(x.shape[1])
    beta[0] = np.log(y.mean())
    for _ in range(200):
        mean = np.exp(x @ beta)
        w = mean if theta is None else mean / (1 + mean / theta)
        move = np.linalg.solve((x * w[:, None]).T @ x, x.T @ ((y - mean) * w / mean))
        beta = beta + move
        if np.abs(move).max() < 1e-13:
            break
    return np.exp(x @ beta)


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(0)
    a, b = rng.normal(2000, 400, 150), rng.uniform(0, 5, 150)
    x = np.column_stack([np.ones(150), a, b])
    genes = {g: rng.poisson(np.exp(0.2 * g - 1 + 0.0006 * (a - 2000) * (g % 3 - 1) + 0.2 * b)).astype(float) for g in range(1, 7)}
    z = np.column_stack([np.ones(150), (a - a.mean()) / a.std(), (b - b.mean()) / b.std()])
    return a, b, x, z, genes


def frame_of(spark, a, b, genes):
    rows = [(c, g, float(y[c]), float(a[c]), float(b[c])) for g, y in genes.items() for c in range(len(a))]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.mark.parametrize("theta", [None, 2.0])
def test_log_linear_models_equal_plain_fits(spark, data, theta):
    a, b, _, z, genes = data
    family = glm.POISSON if theta is None else glm.negative_binomial(theta)
    rows = glm.residuals(frame_of(spark, a, b, genes), family, ["a", "b"]).collect()
    got = {(r["gene_id"], r["cell_id"]): r["value"] for r in rows}
    assert len(rows) == len(got) == 900
    for g, y in genes.items():
        mean = plain_fit(z, y, theta)
        want = (y - mean) / np.sqrt(mean if theta is None else mean + mean**2 / theta)
        assert [got[g, c] for c in range(150)] == pytest.approx(want.tolist(), abs=1e-5)


def test_gaussian_equals_least_squares(spark, data):
    a, b, x, _, genes = data
    got = {(r["gene_id"], r["cell_id"]): r["value"] for r in glm.residuals(frame_of(spark, a, b, genes), glm.GAUSSIAN, ["a", "b"], "response").collect()}
    for g, y in genes.items():
        want = y - x @ np.linalg.lstsq(x, y, rcond=None)[0]
        assert [got[g, c] for c in range(150)] == pytest.approx(want.tolist(), abs=1e-8)


def test_empty_genes_nulls_flat_regressors_and_errors(spark, data):
    a, b, _, _, genes = data
    frame = frame_of(spark, a, np.ones(150), {1: np.zeros(150), 2: genes[2]})
    rows = glm.residuals(frame, glm.POISSON, ["a", "b"], "deviance").collect()
    assert len(rows) == 300 and all(abs(r["value"]) < 1e-4 for r in rows if r["gene_id"] == 1)
    holes = frame.unionByName(spark.createDataFrame([(500, 2, None, 1.0, 1.0), (501, 2, 3.0, None, 1.0)], SCHEMA))
    again = sorted(map(tuple, glm.residuals(holes, glm.POISSON, ["a", "b"], "deviance").collect()))
    assert np.array(again) == pytest.approx(np.array(sorted(map(tuple, rows))), abs=1e-6)
    assert glm.residuals(frame.limit(0), glm.POISSON, ["a", "b"]).count() == 0
    with pytest.raises(ValueError):
        glm.residuals(frame, glm.POISSON, ["a"], "raw")
    with pytest.raises(Exception, match="don't fit the family"):
        glm.residuals(spark.createDataFrame([(1, 1, -1.0, 0.0, 0.0), (2, 1, 1.0, 1.0, 0.0)], SCHEMA), glm.POISSON, ["a", "b"]).count()


def test_query_covers_the_grid(spark):
    q, sf = registry.queries(), "/root/testdata/sf0.001"
    rows = q["per_gene_glm"](spark, sf).collect()
    grid = {(r["cell_id"], r["gene_id"]) for r in q["regress_out"](spark, sf).collect()}
    assert {(r["cell_id"], r["gene_id"]) for r in rows} == grid and len(rows) == len(grid)
    sums = {}
    for r in rows:
        sums[r["gene_id"]] = sums.get(r["gene_id"], 0.0) + r["value"]
    assert all(np.isfinite(s) for s in sums.values())
