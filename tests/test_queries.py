"""Every query with SQL against DuckDB on the smallest tables; the others against what must hold of their rows."""

import math

import duckdb
import numpy as np
import pytest

from helixframe.plans import registry
from helixframe.plans.views import TABLES

SF = "/root/testdata/sf0.001"


def text(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(round(x, 9) + 0.0)
    return "[" + ",".join(map(text, x)) + "]" if isinstance(x, (list, tuple)) else str(x)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, db, name):
    frame = registry.queries()[name](spark, SF)
    columns = sorted(frame.columns)
    got = sorted(tuple(text(r[c]) for c in columns) for r in frame.collect())
    found = db.sql(registry.oracle_sql()[name])
    at = [list(found.columns).index(c) for c in columns]
    assert sorted(found.columns) == columns
    assert got == sorted(tuple(text(r[i]) for i in at) for r in found.fetchall())
    spark.catalog.clearCache()


def test_queries_without_sql_are_few():
    assert set(registry.queries()) - set(registry.oracle_sql()) == {
        "knn_approx", "diffusion_eigen", "dpt_distance_row", "pseudotime", "louvain", "leiden", "pca_fit", "pca_project", "kmeans", "reanalysis", "embedding_classifier", "per_gene_glm",
    }


@pytest.fixture(scope="module")
def graph(spark):
    """Edges of the neighbour graph by their own query, as a dense matrix."""
    rows = registry.queries()["fuzzy_connectivities"](spark, SF).collect()
    n = 1 + max(r["src"] for r in rows)
    w = np.zeros((n, n))
    for r in rows:
        w[r["src"], r["dst"]] = r["w"]
    return w


def modularity(w, labels):
    m = w.sum()
    return sum(w[np.ix_(labels == c, labels == c)].sum() / m - (w[labels == c].sum() / m) ** 2 for c in set(labels.tolist()))


def plain_louvain(w):
    """Nodes in order, one after the other, until nothing moves; then the same with communities as nodes."""
    final = np.arange(len(w))
    while True:
        label, k, m = np.arange(len(w)), w.sum(axis=1), w.sum()
        tot, moved = k.copy(), True
        while moved:
            moved = False
            for i in range(len(w)):
                into = np.bincount(label, weights=np.where(np.arange(len(w)) == i, 0, w[i]), minlength=len(w))
                tot[label[i]] -= k[i]
                gain = into - k[i] * tot / m
                best = int(np.argmax(gain))
                if gain[best] > gain[label[i]] + 1e-12:
                    label[i], moved = best, True
                tot[label[i]] += k[i]
        names, label = np.unique(label, return_inverse=True)
        if len(names) == len(w):
            return final
        final = label[final]
        w = np.array([[w[np.ix_(label == a, label == b)].sum() for b in range(len(names))] for a in range(len(names))])


@pytest.mark.parametrize("name", ["louvain", "leiden"])
def test_communities_are_as_good_as_plain_ones(spark, graph, name):
    rows = registry.queries()[name](spark, SF).collect()
    labels = np.zeros(len(graph), int)
    for r in rows:
        labels[r["node"]] = r["community"]
    assert len(rows) == len(graph) and modularity(graph, labels) > 0.98 * modularity(graph, plain_louvain(graph)) > 0.3
    if name == "leiden":
        for c in set(labels.tolist()):
            inside = set(np.flatnonzero(labels == c).tolist())
            seen, todo = set(), [min(inside)]
            while todo:
                x = todo.pop()
                if x not in seen:
                    seen.add(x)
                    todo += [y for y in np.flatnonzero(graph[x]).tolist() if y in inside]
            assert seen == inside and min(inside) == c


def test_reanalysis_covers_the_chosen_rows(spark):
    rows = registry.queries()["reanalysis"](spark, SF).collect()
    chosen = spark.read.parquet(f"{SF}/embeddings.parquet").where("embedding[0] > 0").count()
    assert len({r["node"] for r in rows}) == len(rows) == chosen and 1 < len({r["community"] for r in rows}) < chosen / 5


def test_eigenpairs_distances_and_pseudotime_equal_dense_ones(spark):
    q = registry.queries()
    from helixframe.plans import vectors as plans
    from helixframe.plans.views import Views

    t = plans.transitions(Views(spark, SF)).collect()
    n = 1 + max(r["src"] for r in t)
    dense = np.zeros((n, n))
    for r in t:
        dense[r["src"], r["dst"]] = r["t"]
    values, vectors = np.linalg.eigh(dense)
    top = np.argsort(-np.abs(values))[:15]
    top = top[np.argsort(-values[top])]
    rows = sorted(q["diffusion_eigen"](spark, SF).collect(), key=lambda r: r["node"])
    got, v = np.array(rows[0]["eigenvalues"]), np.array([r["vec"] for r in rows])
    assert got == pytest.approx(values[top], abs=1e-9) and np.abs(dense @ v - v * got).max() < 1e-6 and np.abs(v.T @ v - np.eye(15)).max() < 1e-9
    weight = np.where(values[top] >= 0.9994, 1, values[top] / (1 - np.minimum(values[top], 0.9999)))
    want = np.sqrt((((vectors[:, top] - vectors[0, top]) * weight) ** 2).sum(axis=1))
    reached = {0}
    while len(more := reached | set(np.flatnonzero(dense[sorted(reached)].any(axis=0)).tolist())) > len(reached):
        reached = more
    want[[i for i in range(n) if i not in reached]] = math.inf
    d = {r["node"]: r["d"] for r in q["dpt_distance_row"](spark, SF).collect()}
    assert [d[i] for i in range(n)] == pytest.approx(want.tolist(), abs=1e-5)
    p = {r["node"]: r["pseudotime"] for r in q["pseudotime"](spark, SF).collect()}
    assert [p[i] for i in range(n)] == pytest.approx((want / want[np.isfinite(want)].max()).tolist(), abs=1e-5)


def test_projection_kmeans_and_classifier(spark):
    q = registry.queries()
    vecs = {r["vec_id"]: np.array(r["embedding"], float) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    x = np.array([vecs[i] for i in sorted(vecs)])
    train = x[: math.ceil(0.35 * len(x))]
    _, s, vt = np.linalg.svd(train - train.mean(axis=0), full_matrices=False)
    explained = [r["explained"] for r in q["pca_fit"](spark, SF).orderBy("component").collect()]
    assert explained == pytest.approx((s**2 / (s**2).sum())[:50].tolist(), abs=1e-9)
    pcs = np.array([r["pcs"] for r in q["pca_project"](spark, SF).orderBy("id").collect()])
    assert np.abs(pcs) == pytest.approx(np.abs((x - train.mean(axis=0)) @ vt[:50].T), abs=1e-6)
    rows = q["kmeans"](spark, SF).collect()
    at, mine = np.array([r["pcs"] for r in rows]), np.array([int(r["cluster"]) for r in rows])
    centres = np.array([at[mine == c].mean(axis=0) for c in range(35)])
    square = ((at[:, None] - centres[None]) ** 2).sum(axis=2)
    assert len(set(mine.tolist())) == 35 and (square[np.arange(len(at)), mine] <= square.min(axis=1) + 1e-6).all()
    rows = q["embedding_classifier"](spark, SF).collect()  # labels of these tables don't follow from the vectors
    held = spark.read.parquet(f"{SF}/embeddings.parquet").where("pmod(xxhash64(vec_id), 5) = 0").select("vec_id", "label").collect()
    assert sorted((r["id"], r["label"]) for r in rows) == sorted(map(tuple, held)) and {r["predicted"] for r in rows} <= set(range(10))


def test_approximate_neighbours_of_the_query(spark):
    q = registry.queries()
    exact = {(r["src"], r["dst"]) for r in q["knn_exact"](spark, SF).collect()}
    found = {(r["src"], r["dst"]) for r in q["knn_approx"](spark, SF).collect()}
    assert len(exact & found) / len(exact) >= 0.9
