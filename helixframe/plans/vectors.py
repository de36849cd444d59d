"""Queries over vectors and neighbour graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixframe.operators import graph as g
from helixframe.operators import neighbours as nb
from helixframe.operators import projection as p
from helixframe.operators import vectors as x
from helixframe.operators.components import connected_components
from helixframe.operators.matrix import train_prefix
from helixframe.plans.views import query

K = 15
D2 = "list_sum(list_transform(list_zip(a.vec, b.vec), lambda p: (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)) * (CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE))))"
KNN = f"""pairs AS (SELECT a.id AS src, b.id AS dst, round({D2}, 9) AS d2 FROM vectors a, vectors b),
knn AS (SELECT src, dst, sqrt(d2) AS d, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY src ORDER BY CASE WHEN src = dst THEN 0 ELSE 1 END, d2, dst) AS INT) AS rank FROM pairs) r WHERE rank <= {K})"""
GAUSS = KNN + """,
e AS (SELECT src, dst, d * d AS d2 FROM knn WHERE src <> dst), s AS (SELECT src, median(d2) AS s FROM e GROUP BY src),
gw AS (SELECT e.src, e.dst, sqrt(2 * sqrt(i.s * j.s) / (i.s + j.s)) * exp(-d2 / (i.s + j.s)) AS w FROM e JOIN s i ON i.src = e.src JOIN s j ON j.src = e.dst),
gauss AS (SELECT * FROM gw UNION ALL SELECT dst, src, w FROM gw a WHERE NOT EXISTS (SELECT 1 FROM gw b WHERE b.src = a.dst AND b.dst = a.src))"""
TRANS = GAUSS + """,
q AS (SELECT dst, sum(w) AS q FROM gauss GROUP BY dst), kk AS (SELECT g.src, g.dst, w / (a.q * b.q) AS w FROM gauss g JOIN q a ON a.dst = g.src JOIN q b ON b.dst = g.dst),
z AS (SELECT src, sqrt(sum(w)) AS z FROM kk GROUP BY src), tm AS (SELECT kk.src, kk.dst, w / (a.z * b.z) AS t, a.z AS zi, b.z AS zj FROM kk JOIN z a ON a.src = kk.src JOIN z b ON b.src = kk.dst)"""


def r6(df, *cols):
    return df.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in cols})


def neighbours(v) -> DataFrame:
    return v.kept("knn", lambda: x.knn(v.vectors, K))


def gauss(v) -> DataFrame:
    return v.kept("gauss", lambda: x.gauss_weights(neighbours(v)))


def fuzzy(v) -> DataFrame:
    return v.kept("fuzzy", lambda: x.fuzzy_union(x.fuzzy_memberships(neighbours(v), K)))


@query("knn_exact", f"WITH {KNN} SELECT src, dst, round(d, 6) AS d, rank FROM knn")
def q_knn(v):
    return r6(neighbours(v), "d")


@query("knn_self_join", f"WITH {KNN} SELECT src, count(*) AS n, round(max(d), 6) AS radius FROM knn GROUP BY src")
def q_knn_radius(v):
    return r6(neighbours(v).groupBy("src").agg(F.count("*").alias("n"), F.max("d").alias("radius")), "radius")


@query("knn_approx")
def q_knn_approx(v):
    return nb.knn_approx(v.vectors, K)


@query("knn_params", f"SELECT count(*) AS n, CAST(CASE WHEN {K} > count(*) THEN 1 + floor(count(*) / 2) ELSE {K} END AS INT) AS k FROM vectors")
def q_knn_params(v):
    return v.vectors.agg(F.count("*").alias("n")).withColumn("k", F.lit(x.knn_params(v.vectors.count(), K)).cast("int"))


METRICS = {
    "manhattan": "list_sum(list_transform(z, lambda p: abs(p[1] - p[2])))", "chebyshev": "list_max(list_transform(z, lambda p: abs(p[1] - p[2])))", "euclidean": "sqrt(list_sum(list_transform(z, lambda p: (p[1] - p[2]) * (p[1] - p[2]))))",
    "minkowski": "pow(list_sum(list_transform(z, lambda p: pow(abs(p[1] - p[2]), 3))), 1 / 3.0e0)", "canberra": "list_sum(list_transform(z, lambda p: coalesce(abs(p[1] - p[2]) / nullif(abs(p[1]) + abs(p[2]), 0), 0)))",
    "braycurtis": "list_sum(list_transform(z, lambda p: abs(p[1] - p[2]))) / list_sum(list_transform(z, lambda p: abs(p[1] + p[2])))",
    "cosine": "1 - list_sum(list_transform(z, lambda p: p[1] * p[2])) / sqrt(list_sum(list_transform(z, lambda p: p[1] * p[1])) * list_sum(list_transform(z, lambda p: p[2] * p[2])))",
    "hamming": "len(list_filter(z, lambda p: p[1] <> p[2])) / len(z)", "jaccard": "(tf + ft) / nullif(tt + tf + ft, 0)", "dice": "(tf + ft) / nullif(2 * tt + tf + ft, 0)", "russelrao": "(n - tt) / n",
    "kulsinski": "(tf + ft - tt + n) / (tf + ft + n)", "rogerstanimoto": "2 * (tf + ft) / (tt + ff + 2 * (tf + ft))", "sokalmichener": "2 * (tf + ft) / (tt + ff + 2 * (tf + ft))",
    "sokalsneath": "(tf + ft) / nullif(0.5 * tt + tf + ft, 0)", "yule": "2 * tf * ft / nullif(tt * ff + tf * ft, 0)",
    "seuclidean": "sqrt(list_sum(list_transform(z, lambda p: (p[1] - p[2]) * (p[1] - p[2]) / 2)))", "wminkowski": "pow(list_sum(list_transform(z, lambda p: pow(2 * abs(p[1] - p[2]), 3))), 1 / 3.0e0)",
    "correlation": "1 - (list_sum(list_transform(z, lambda p: p[1] * p[2])) - sx * sy / n) / sqrt((list_sum(list_transform(z, lambda p: p[1] * p[1])) - sx * sx / n) * (list_sum(list_transform(z, lambda p: p[2] * p[2])) - sy * sy / n))",
    "haversine": "2 * asin(sqrt(pow(sin((z[1][2] - z[1][1]) / 2), 2) + cos(z[1][1]) * cos(z[1][2]) * pow(sin((z[2][2] - z[2][1]) / 2), 2)))",
}
#: A band matrix in place of an inverse covariance: 2 on the diagonal, 0.5 beside it.
INVERSE = [[2.0 if i == j else 0.5 if abs(i - j) == 1 else 0.0 for j in range(64)] for i in range(64)]
MAHALANOBIS = "sqrt(2 * list_sum(list_transform(z, lambda p: (p[1] - p[2]) * (p[1] - p[2]))) + list_sum(list_transform(range(1, len(z)), lambda i: (z[i][1] - z[i][2]) * (z[i + 1][1] - z[i + 1][2]))))"
EXTRA = {"seuclidean": {"weights": [2.0] * 64}, "wminkowski": {"weights": [2.0] * 64}}


@query("pairwise_metric", f"""WITH p AS (SELECT a.id AS src, b.id AS dst, list_transform(list_zip(a.vec, b.vec), lambda p: [CAST(p[1] AS DOUBLE), CAST(p[2] AS DOUBLE)]) AS z FROM vectors a JOIN vectors b ON b.id = a.id + 1),
c AS (SELECT *, CAST(len(z) AS DOUBLE) AS n, CAST(len(list_filter(z, lambda p: p[1] > 0 AND p[2] > 0)) AS DOUBLE) AS tt, CAST(len(list_filter(z, lambda p: p[1] > 0 AND p[2] <= 0)) AS DOUBLE) AS tf, CAST(len(list_filter(z, lambda p: p[1] <= 0 AND p[2] > 0)) AS DOUBLE) AS ft, CAST(len(list_filter(z, lambda p: p[1] <= 0 AND p[2] <= 0)) AS DOUBLE) AS ff,
  list_sum(list_transform(z, lambda p: p[1])) AS sx, list_sum(list_transform(z, lambda p: p[2])) AS sy FROM p)
SELECT src, dst, {", ".join(f"round({sql}, 6) AS {name}" for name, sql in METRICS.items())}, round({MAHALANOBIS}, 6) AS mahalanobis FROM c""")  # fmt: skip
def q_metrics(v):
    a = v.vectors.select(F.col("id").alias("src"), F.col("vec").alias("a"), (F.col("id") + 1).alias("dst"))
    joined = a.join(v.vectors.select(F.col("id").alias("dst"), F.col("vec").alias("b")), "dst")
    return joined.select("src", "dst", *[F.round(x.metric(n, F.col("a"), F.col("b"), **EXTRA.get(n, {})), 6).alias(n) for n in METRICS], F.round(x.mahalanobis(F.col("a"), F.col("b"), INVERSE), 6).alias("mahalanobis"))


@query("knn_distance_graph", f"WITH {KNN} SELECT src, dst, round(d, 6) AS w FROM knn WHERE src <> dst AND d > 0")
def q_distance_graph(v):
    return r6(g.distance_edges(neighbours(v)), "w")


@query("drop_zero_edges", f"WITH {KNN} SELECT count(*) AS edges, count(*) FILTER (d = 0 AND src <> dst) AS dropped FROM knn")
def q_zero_edges(v):
    return neighbours(v).agg(F.count("*").alias("edges"), F.count_if(F.expr("d = 0 and src <> dst")).alias("dropped"))


@query("graph_to_knn", f"WITH {KNN}, e AS (SELECT src, dst, d AS w FROM knn WHERE src <> dst AND d > 0), r AS (SELECT src, dst, w AS d, CAST(row_number() OVER (PARTITION BY src ORDER BY round(w, 9), dst) + 1 AS INT) AS rank FROM e) SELECT src, dst, round(d, 6) AS d, rank FROM r WHERE rank <= 10 UNION ALL SELECT id, id, 0.0, 1 FROM vectors")
def q_to_knn(v):
    return r6(g.graph_to_knn(g.distance_edges(neighbours(v)), 10), "d")


@query("edge_symmetrise_missing", f"WITH {KNN}, e AS (SELECT src, dst, d AS w FROM knn WHERE src <> dst AND d > 0) SELECT src, dst, round(w, 6) AS w FROM e UNION ALL SELECT dst, src, round(w, 6) FROM e a WHERE NOT EXISTS (SELECT 1 FROM e b WHERE b.src = a.dst AND b.dst = a.src)")
def q_symmetrise(v):
    return r6(x.symmetrise_missing(g.distance_edges(neighbours(v))), "w")


@query("gauss_connectivities", f"WITH {GAUSS} SELECT src, dst, round(w, 6) AS w FROM gauss")
def q_gauss(v):
    return r6(x.gauss_weights(neighbours(v)), "w")


@query("gauss_kernel_dense", f"""WITH p AS (SELECT a.id AS src, b.id AS dst, round({D2}, 9) AS d2 FROM vectors a, vectors b),
s AS (SELECT src, d2 / 4 AS s FROM (SELECT src, d2, row_number() OVER (PARTITION BY src ORDER BY d2, dst) AS n FROM p WHERE src <> dst) r WHERE n = {K})
SELECT src, count(*) AS n, round(sum(w), 6) AS total FROM (SELECT p.src, sqrt(2 * sqrt(i.s * j.s) / (i.s + j.s)) * exp(-d2 / (i.s + j.s)) AS w FROM p JOIN s i ON i.src = p.src JOIN s j ON j.src = p.dst WHERE p.src <> p.dst) w WHERE w > 1e-14 GROUP BY src""")  # fmt: skip
def q_gauss_dense(v):
    return r6(x.gauss_kernel_sums(v.vectors, K), "total")


LISTS = KNN + """,
lists AS (SELECT src, list(struct_pack(d := d, dst := dst) ORDER BY d, dst) AS n FROM knn WHERE src <> dst GROUP BY src)"""
FUZZY = f"""WITH RECURSIVE {LISTS},
rhos AS (SELECT src, n, coalesce(list_min(list_filter(list_transform(n, lambda p: p.d), lambda d: d > 0)), 0) AS rho FROM lists),
b AS (SELECT src, 0.0e0 AS lo, 1.5e300 AS hi, 1.0e0 AS mid, 0 AS step FROM rhos
  UNION ALL SELECT src, CASE WHEN t > log2({K}) THEN lo ELSE mid END, CASE WHEN t > log2({K}) THEN mid ELSE hi END, CASE WHEN t > log2({K}) THEN (lo + mid) / 2 WHEN hi > 1e300 THEN mid * 2 ELSE (mid + hi) / 2 END, step + 1
  FROM (SELECT b.*, list_sum(list_transform(n, lambda p: CASE WHEN p.d - rho > 0 THEN exp(-(p.d - rho) / mid) ELSE 1 END)) AS t FROM b JOIN rhos USING (src) WHERE step < 64) s),
m AS (SELECT src, p.dst AS dst, CASE WHEN p.d <= rho THEN 1 ELSE exp(-(p.d - rho) / mid) END AS w FROM (SELECT src, rho, mid, unnest(n) AS p FROM rhos JOIN (SELECT src, mid FROM b WHERE step = 64) e USING (src)) u)
SELECT src, dst, round(w, 6) AS w FROM (SELECT coalesce(a.src, c.dst) AS src, coalesce(a.dst, c.src) AS dst, coalesce(a.w, 0) + coalesce(c.w, 0) - coalesce(a.w, 0) * coalesce(c.w, 0) AS w FROM m a FULL JOIN m c ON a.src = c.dst AND a.dst = c.src) f WHERE w > 0"""
PERPLEXITY = 4.0
AFFINITIES = f"""WITH RECURSIVE {KNN.replace("rank <= " + str(K), "rank <= 1 + least((SELECT count(*) FROM vectors) - 1, CAST(floor(3 * " + str(PERPLEXITY) + " + 1) AS BIGINT))")},
lists AS (SELECT src, list(struct_pack(d2 := d * d, dst := dst) ORDER BY d, dst) AS n FROM knn WHERE src <> dst GROUP BY src),
b AS (SELECT src, -1.5e300 AS lo, 1.5e300 AS hi, 1.0e0 AS b, 0 AS step FROM lists
  UNION ALL SELECT src, CASE WHEN done THEN lo WHEN e > ln({PERPLEXITY}) THEN b ELSE lo END, CASE WHEN done OR e > ln({PERPLEXITY}) THEN hi ELSE b END,
    CASE WHEN done THEN b WHEN e > ln({PERPLEXITY}) THEN CASE WHEN hi > 1e300 THEN b * 2 ELSE (b + hi) / 2 END ELSE CASE WHEN lo < -1e300 THEN b / 2 ELSE (b + lo) / 2 END END, step + 1
  FROM (SELECT *, abs(e - ln({PERPLEXITY})) <= 1e-5 AS done FROM (SELECT src, n, lo, hi, b, step, ln(z) + b * list_sum(list_transform(n, lambda p: p.d2 * exp(-p.d2 * b))) / z AS e
    FROM (SELECT b.*, n, 1e-300 + list_sum(list_transform(n, lambda p: exp(-p.d2 * b.b))) AS z FROM b JOIN lists USING (src) WHERE step < 100) q) w) s),
p AS (SELECT src, p.dst AS dst, exp(-p.d2 * b) / (1e-300 + list_sum(list_transform(n, lambda y: exp(-y.d2 * b)))) AS p FROM (SELECT src, b, n, unnest(n) AS p FROM lists JOIN (SELECT src, b FROM b WHERE step = 100) e USING (src)) u)"""


def affinities(v):
    k = x.perplexity_neighbours(v.vectors.count(), PERPLEXITY)
    return x.perplexity_affinities(x.knn(v.vectors, k + 1), PERPLEXITY)


@query("fuzzy_connectivities", FUZZY)
def q_fuzzy(v):
    return r6(fuzzy(v), "w")


@query("perplexity_affinities", AFFINITIES + " SELECT src, dst, round(p, 6) AS p FROM p")
def q_perplexity(v):
    return r6(affinities(v), "p")


@query("joint_probabilities", AFFINITIES + """, both_ways AS (SELECT src, dst, p FROM p UNION ALL SELECT dst, src, p FROM p), s AS (SELECT src, dst, sum(p) AS p FROM both_ways GROUP BY 1, 2)
SELECT src, dst, round(p / (SELECT sum(p) FROM s), 9) AS p FROM s""")  # fmt: skip
def q_joint(v):
    return x.joint_probabilities(v.kept("affinities", lambda: affinities(v))).withColumn("p", F.round("p", 9))


@query("connected_components", f"""WITH RECURSIVE {KNN}, e AS (SELECT src, dst FROM knn WHERE rank <= 2 AND src <> dst UNION SELECT dst, src FROM knn WHERE rank <= 2 AND src <> dst),
reach AS (SELECT id AS node, id AS other FROM vectors UNION SELECT r.node, e.dst FROM reach r JOIN e ON e.src = r.other)
SELECT node, min(other) AS component FROM reach GROUP BY node""")  # fmt: skip
def q_components(v):
    return connected_components(neighbours(v).where("rank <= 2").select("src", "dst"))


@query("graph_degree_estimate", f"WITH {GAUSS} SELECT CAST(floor(count(*) / (SELECT count(*) FROM vectors) / 2) AS BIGINT) AS k FROM gauss")
def q_degree(v):
    n = v.vectors.agg(F.count("*").alias("n")).select("n").scalar()
    return x.gauss_weights(neighbours(v)).agg(F.floor(F.count("*") / n / 2).cast("long").alias("k"))


@query("transition_matrix", f"WITH {TRANS} SELECT src, dst, round(t, 6) AS t FROM tm")
def q_transition(v):
    return r6(g.transition_matrix(gauss(v)).select("src", "dst", "t"), "t")


@query("transition_asymmetric", f"WITH {TRANS} SELECT src, dst, round(zi * t / zj, 6) AS t FROM tm")
def q_transition_asym(v):
    return r6(g.transition_asymmetric(g.transition_matrix(gauss(v))), "t")


PAIRS = 15


def transitions(v):
    return v.kept("transitions", lambda: g.transition_matrix(gauss(v)).select("src", "dst", "t"))


@query("diffusion_eigen")
def q_eigen(v):
    values, vectors = g.diffusion_eigen(transitions(v), PAIRS)
    return vectors.withColumn("eigenvalues", F.array(*map(F.lit, values)))


def dpt(v):
    values, vectors = g.diffusion_eigen(transitions(v), PAIRS)
    return g.dpt_row(vectors, values, 0, connected_components(transitions(v).select("src", "dst")))


@query("dpt_distance_row")
def q_dpt(v):
    return dpt(v)


@query("pseudotime")
def q_pseudotime(v):
    return g.pseudotime(v.kept("dpt", lambda: dpt(v)))


@query("nearest_root", f"SELECT b.id AS root FROM vectors a, vectors b WHERE a.id = 7 AND b.id <> 7 ORDER BY round({D2}, 9), b.id LIMIT 1")
def q_root(v):
    target = v.vectors.where("id = 7").select("vec").scalar()
    away = v.vectors.where("id <> 7").withColumn("t", target).select("id", F.round(x.square_distance(F.col("vec"), F.col("t")), 9).alias("d"))
    return away.agg(F.min_by("id", F.struct("d", "id")).alias("root"))


@query("adjacency_edges", f"WITH {GAUSS} SELECT src, dst, round(w, 6) AS weight FROM gauss WHERE w <> 0")
def q_adjacency(v):
    return x.gauss_weights(neighbours(v)).where("w <> 0").select("src", "dst", F.round("w", 6).alias("weight"))


@query("louvain")
def q_louvain(v):
    return g.louvain(fuzzy(v))


@query("leiden")
def q_leiden(v):
    return g.leiden(fuzzy(v))


MOD = f"""WITH {GAUSS}, c AS (SELECT id, CAST(label AS BIGINT) AS community FROM vectors), p AS (SELECT a.community, sum(CASE WHEN a.community = b.community THEN w ELSE 0 END) AS inside, sum(w) AS total FROM gauss JOIN c a ON a.id = src JOIN c b ON b.id = dst GROUP BY 1),
n AS (SELECT community, count(*) AS nodes FROM c GROUP BY 1), m AS (SELECT sum(w) AS m FROM gauss)"""


@query("cluster_statistics", MOD + " SELECT community, nodes, round(inside, 4) AS inside, round(total, 4) AS total, round(inside / m - (total / m) * (total / m), 6) AS q FROM n JOIN p USING (community), m")
def q_cluster_stats(v):
    labels = v.vectors.select(F.col("id").alias("node"), F.col("label").cast("long").alias("community"))
    return g.modularity(gauss(v), labels).select("community", "nodes", F.round("inside", 4).alias("inside"), F.round("total", 4).alias("total"), F.round("q", 6).alias("q"))


@query("cluster_marker_summary", "SELECT label AS cluster, count(*) AS n, round(avg(m), 6) AS mean, round(avg(CASE WHEN m > 0 THEN 1.0 ELSE 0.0 END), 6) AS positive, round(avg(greatest(-0.05, least(1.0, m))), 6) AS clipped FROM (SELECT label, CAST(vec[1] AS DOUBLE) AS m FROM vectors) x GROUP BY label")
def q_markers(v):
    m = F.get("vec", 0).cast("double")
    return r6(v.vectors.groupBy(F.col("label").alias("cluster")).agg(F.count("*").alias("n"), F.avg(m).alias("mean"), F.avg((m > 0).cast("double")).alias("positive"), F.avg(F.greatest(F.lit(-0.05), F.least(F.lit(1.0), m))).alias("clipped")), "mean", "positive", "clipped")


@query("natural_label_order", "SELECT label, CAST(row_number() OVER (ORDER BY CAST(label AS INT)) AS INT) AS place FROM (SELECT DISTINCT CAST(label AS STRING) AS label FROM vectors) x")
def q_labels(v):
    labels = v.vectors.select(F.col("label").cast("string").alias("label")).distinct()
    return labels.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.col("label").cast("int"))))


COMPONENTS = 50


def projected(vectors):
    """A projection that is fitted on the first rows of the table, and all its rows with their coordinates, as pcs."""
    model = p.fit(train_prefix(vectors.withColumnRenamed("id", "ordinal")).withColumnRenamed("ordinal", "id").drop("row"), COMPONENTS)
    return model, p.project(model, vectors)


@query("pca_fit")
def q_pca_fit(v):
    model, _ = projected(v.vectors)
    return v.spark.range(1).select(F.posexplode(F.array(*[F.lit(float(e)) for e in model.explained])).alias("component", "explained"))


@query("pca_project")
def q_pca(v):
    return projected(v.vectors)[1].select("id", "pcs")


CLUSTERS = 35
LLOYD = f"""WITH v AS (SELECT id, list_transform(vec, lambda x: CAST(x AS DOUBLE)) AS vec FROM vectors), c0 AS (SELECT CAST(id AS INT) AS c, vec AS m FROM v WHERE id < {CLUSTERS}),"""
for _r in range(3):
    LLOYD += f"""
a{_r} AS (SELECT id, arg_min(c, struct_pack(d := d, c := c)) AS cluster FROM (SELECT v.id, c, round(list_sum(list_transform(list_zip(v.vec, m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 9) AS d FROM v, c{_r}) x GROUP BY id),
d{_r} AS (SELECT cluster, i, avg(x) AS m FROM (SELECT cluster, unnest(range(len(vec))) AS i, unnest(vec) AS x FROM a{_r} JOIN v USING (id)) u GROUP BY 1, 2),
c{_r + 1} AS (SELECT cluster AS c, list(m ORDER BY i) AS m FROM d{_r} GROUP BY cluster),"""


@query("kmeans_fixed_rounds", LLOYD + " a3 AS (SELECT id, arg_min(c, struct_pack(d := d, c := c)) AS cluster FROM (SELECT v.id, c, round(list_sum(list_transform(list_zip(v.vec, m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 9) AS d FROM v, c3) x GROUP BY id) SELECT id, cluster FROM a3")
def q_kmeans_rounds(v):
    return x.lloyd(v.vectors, CLUSTERS, 3).select("id", "cluster")


@query("kmeans")
def q_kmeans(v):
    return x.kmeans(v.kept("pcs", lambda: projected(v.vectors)[1]), CLUSTERS, column="pcs").select("id", "cluster", "pcs")


@query("reanalysis")
def q_reanalysis(v):
    some = v.kept("chosen", lambda: v.vectors.where(F.get("vec", 0) > 0))
    pcs = v.kept("pcs", lambda: projected(some)[1].select("id", F.col("pcs").alias("vec")))
    return g.leiden(v.kept("fuzzy", lambda: x.fuzzy_union(x.fuzzy_memberships(x.knn(pcs, K), K))))


@query("embedding_classifier")
def q_classifier(v):
    held_out = F.pmod(F.xxhash64("id"), F.lit(5)) == 0
    return x.classify(v.vectors.where(~held_out), v.vectors.where(held_out))
