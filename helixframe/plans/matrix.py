"""Queries of the count-matrix operators. Results are rounded to 6 decimals: engines add up in different orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.functions import glm, udfs
from helixframe.operators import matrix as m
from helixframe.plans.views import Views, query
from helixframe.sources import text as src

MIN_GENES, MAX_GENES, MIN_CELLS, N_TOP = 20, 60, 25, 200
MARKERS = ["mt-spring green part", "no such gene"]

KEPT_CELLS = f"SELECT cell_id FROM counts GROUP BY cell_id HAVING count(*) BETWEEN {MIN_GENES} AND {MAX_GENES}"
KEPT = f"""kept AS (SELECT * FROM counts WHERE cell_id IN ({KEPT_CELLS})),
filtered AS (SELECT * FROM kept WHERE gene_id IN (SELECT gene_id FROM kept GROUP BY gene_id HAVING count(*) FILTER (value <> 0) >= {MIN_CELLS})),
axis AS (SELECT count(DISTINCT cell_id) AS n FROM kept)"""
NORM = KEPT + """,
norm AS (SELECT cell_id, gene_id, ln(1 + value * 10000.0 / (sum(value) OVER (PARTITION BY cell_id) + 1e-12)) AS value FROM filtered)"""
STATS = NORM + """,
stats AS (
  SELECT gene_id, CASE WHEN s = 0 THEN 1e-12 ELSE s / n END AS mean, (ss - s * s / n) / nullif(n - 1, 0) AS var,
         (ss - s * s / n) / nullif(n - 1, 0) / CASE WHEN s = 0 THEN 1e-12 ELSE s / n END AS dispersion
  FROM (SELECT gene_id, sum(value) AS s, sum(value * value) AS ss FROM norm GROUP BY gene_id) g, (SELECT CAST(n AS DOUBLE) AS n FROM axis) a)"""
BINS = STATS + """,
edges AS (SELECT DISTINCT unnest(quantile_cont(mean, [0.1,0.15,0.2,0.25,0.3,0.35,0.4,0.45,0.5,0.55,0.6,0.65,0.7,0.75,0.8,0.85,0.9,0.95,1.0])) AS edge FROM stats),
binned AS (SELECT s.*, (SELECT count(*) FROM edges WHERE edge < s.mean) AS bin FROM stats s),
medians AS (SELECT bin, median(dispersion) AS med FROM binned GROUP BY bin),
mads AS (SELECT b.bin, any_value(med) AS med, median(abs(dispersion - med)) / 0.6744897501960817 AS mad FROM binned b JOIN medians USING (bin) GROUP BY b.bin),
normed AS (SELECT b.*, med, mad, CASE WHEN mad = 0 THEN CASE WHEN dispersion > med THEN CAST('inf' AS DOUBLE) WHEN dispersion < med THEN CAST('-inf' AS DOUBLE) END ELSE (dispersion - med) / mad END AS dispersion_norm FROM binned b JOIN mads USING (bin))"""
HVG = BINS + f""",
cutoff AS (SELECT min(v) AS least FROM (SELECT round(dispersion_norm, 6) AS v FROM normed WHERE dispersion_norm IS NOT NULL ORDER BY v DESC LIMIT {N_TOP}) t),
hvg AS (SELECT gene_id FROM normed, cutoff WHERE coalesce(round(dispersion_norm, 6), 0) >= least)"""
GRID = HVG + """,
hnorm AS (SELECT * FROM norm WHERE gene_id IN (SELECT gene_id FROM hvg)),
percell AS (SELECT cell_id, sum(value) AS n_counts, sum(CASE WHEN starts_with(gene_name, 'mt-') THEN value ELSE 0 END) / nullif(sum(value), 0) AS percent FROM hnorm JOIN genes USING (gene_id) GROUP BY cell_id HAVING sum(value) > 0),
grid AS (SELECT p.cell_id, f.gene_id, p.n_counts, p.percent, coalesce(h.value, 0) AS value FROM percell p CROSS JOIN hvg f LEFT JOIN hnorm h ON h.cell_id = p.cell_id AND h.gene_id = f.gene_id)"""


def counts(v: Views) -> DataFrame:
    # A join and an aggregate that several later steps read.
    return v.kept("counts", lambda: v.counts)


def kept_cells(v: Views) -> DataFrame:
    return m.filter_cells(counts(v), MIN_GENES, MAX_GENES)


def filtered(v: Views) -> DataFrame:
    return m.filter_genes(kept_cells(v), MIN_CELLS)


def n_cells(v: Views) -> DataFrame:
    return m.genes_per_cell(counts(v)).where(F.col("n_genes").between(MIN_GENES, MAX_GENES)).agg(F.count("*").alias("n"))


def norm(v: Views) -> DataFrame:
    return v.kept("norm", lambda: m.normalise_log1p(filtered(v)))


def stats(v: Views) -> DataFrame:
    return v.kept("stats", lambda: m.gene_dispersion(norm(v), n_cells(v)))


def binned(v: Views) -> DataFrame:
    return v.kept("binned", lambda: m.with_mean_bin(stats(v), m.mean_bin_edges(stats(v))))


def hvg(v: Views) -> DataFrame:
    return v.kept("hvg", lambda: m.select_hvg(m.dispersion_norm(binned(v)), N_TOP).where("highly_variable").select("gene_id"))


def hvg_norm(v: Views) -> DataFrame:
    return v.kept("hvg-norm", lambda: m.subset_genes(norm(v), hvg(v)))


def per_cell(v: Views) -> DataFrame:
    return v.kept("per-cell", lambda: m.percent_prefix(hvg_norm(v), v.genes).where("n_counts > 0"))


def grid(v: Views) -> DataFrame:
    return m.dense_grid(hvg_norm(v), per_cell(v), hvg(v))


def grid_stats(v: Views) -> DataFrame:
    """Means and deviations of the grid's genes from the stored values: cells without any of these genes aren't in the grid."""
    return m.sparse_axis_stats(hvg_norm(v).join(per_cell(v).select("cell_id"), "cell_id", "left_semi"), per_cell(v).agg(F.count("*").alias("n")))


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in columns})


@query("filter_cells", f"SELECT cell_id, count(*) AS n_genes FROM counts GROUP BY cell_id HAVING count(*) BETWEEN {MIN_GENES} AND {MAX_GENES}")
def q_filter_cells(v):
    return m.genes_per_cell(m.filter_cells(v.counts, MIN_GENES, MAX_GENES))


@query("filter_genes", f"WITH {KEPT} SELECT gene_id, CAST(count(*) FILTER (value <> 0) AS BIGINT) AS n_cells FROM filtered GROUP BY gene_id")
def q_filter_genes(v):
    return m.cells_per_gene(filtered(v))


@query("first_n_cells", "SELECT cell_id, ordinal, category FROM cells ORDER BY ordinal LIMIT 100")
def q_first_n(v):
    return m.first_n_cells(v.cells, 100).select("cell_id", "ordinal", "category")


@query("unique_names", "SELECT gene_id, CASE WHEN n = 1 THEN gene_name ELSE concat(gene_name, '-', n - 1) END AS unique_name FROM (SELECT *, row_number() OVER (PARTITION BY gene_name ORDER BY ordinal) AS n FROM genes) g")
def q_unique_names(v):
    return m.unique_names(v.genes).select("gene_id", "unique_name")


@query("hvg_subset", f"WITH {HVG} SELECT cell_id, gene_id, round(value, 6) AS value FROM norm WHERE gene_id IN (SELECT gene_id FROM hvg)")
def q_hvg_subset(v):
    return rounded(hvg_norm(v), "value")


@query("matrix_subset", 'WITH kg AS (SELECT gene_id, row_number() OVER (ORDER BY gene_id) - 1 AS "column" FROM genes WHERE gene_id % 3 = 0) SELECT cell_id, CAST("column" AS INT) AS "column", value FROM counts JOIN kg USING (gene_id) WHERE cell_id % 2 = 0')
def q_matrix_subset(v):
    return m.matrix_subset(v.counts, v.cells.where("cell_id % 2 = 0"), v.genes.where("gene_id % 3 = 0"))


NAMED = "named AS (SELECT gene_id, CASE WHEN n = 1 THEN gene_name ELSE concat(gene_name, '-', n - 1) END AS unique_name FROM (SELECT *, row_number() OVER (PARTITION BY gene_name ORDER BY ordinal) AS n FROM genes) g)"
MARKED = f"""{NORM}, {NAMED}, first_gene AS (SELECT min(unique_name) AS marker FROM named WHERE gene_id = 40),
marker_values AS (SELECT cell_id, max(value) AS x FROM norm JOIN named USING (gene_id) WHERE unique_name = (SELECT marker FROM first_gene) GROUP BY cell_id)"""


def marker_table(v):
    names = m.unique_names(v.genes)
    marker = names.where("gene_id = 40").first()["unique_name"]  # one name
    wide = m.marker_columns(norm(v), v.cells, names, [marker, "no such gene"])
    return wide.toDF("cell_id", "marker_raw", "missing_raw")


@query("marker_columns", f"WITH {MARKED} SELECT cell_id, round(coalesce(x, 0), 6) AS marker_raw, CAST(NULL AS DOUBLE) AS missing_raw FROM cells LEFT JOIN marker_values USING (cell_id)")
def q_markers(v):
    return rounded(marker_table(v), "marker_raw")


@query("prefix_genes", "SELECT gene_id, gene_name FROM genes WHERE starts_with(gene_name, 'mt-')")
def q_prefix(v):
    return v.genes.where(F.col("gene_name").startswith("mt-")).select("gene_id", "gene_name")


@query("marker_positive_subset", f"WITH {MARKED} SELECT cell_id, category FROM cells WHERE cell_id IN (SELECT cell_id FROM marker_values WHERE x > 0)")
def q_marker_positive(v):
    return v.cells.join(marker_table(v).where("marker_raw > 0"), "cell_id", "left_semi").select("cell_id", "category")


@query("clip_upper", "SELECT cell_id, gene_id, least(value, 10.0) AS value FROM counts")
def q_clip(v):
    return v.counts.withColumn("value", m.clip_upper(F.col("value")))


@query("gene_stats_join", f"WITH {STATS} SELECT cell_id, n.gene_id, round(value - mean, 6) AS centred, round(sqrt(var), 6) AS std FROM norm n JOIN stats USING (gene_id)")
def q_gene_stats(v):
    return rounded(norm(v).join(stats(v), "gene_id").select("cell_id", "gene_id", (F.col("value") - F.col("mean")).alias("centred"), F.sqrt("var").alias("std")), "centred", "std")


@query("bin_stats_join", f"WITH {BINS} SELECT gene_id, CAST(bin AS INT) AS bin, round(med, 6) AS median, round(mad, 6) AS mad FROM normed")
def q_bin_stats(v):
    b = binned(v)
    return rounded(b.join(m.bin_median_mad(b), "bin").select("gene_id", "bin", "median", "mad"), "median", "mad")


@query("matrix_sum", "SELECT 'all' AS axis, CAST(NULL AS BIGINT) AS id, sum(value) AS total FROM counts UNION ALL SELECT 'gene', gene_id, sum(value) FROM counts GROUP BY gene_id UNION ALL SELECT 'cell', cell_id, sum(value) FROM counts GROUP BY cell_id")
def q_sum(v):
    whole = m.matrix_sum(v.counts).select(F.lit("all").alias("axis"), F.lit(None).cast("long").alias("id"), "total")
    return whole.unionAll(m.matrix_sum(v.counts, "gene_id").select(F.lit("gene"), "gene_id", "total")).unionAll(m.matrix_sum(v.counts, "cell_id").select(F.lit("cell"), "cell_id", "total"))


@query("normalise_log1p", f"WITH {NORM} SELECT cell_id, gene_id, round(value, 6) AS value FROM norm")
def q_norm(v):
    return rounded(norm(v), "value")


@query("gene_mean_var_dispersion", f"WITH {STATS} SELECT gene_id, round(mean, 6) AS mean, round(var, 6) AS var, round(dispersion, 6) AS dispersion FROM stats")
def q_stats(v):
    return rounded(stats(v), "mean", "var", "dispersion")


@query("mean_bin_edges", f"WITH {BINS} SELECT round(edge, 6) AS edge FROM edges")
def q_edges(v):
    return rounded(m.mean_bin_edges(stats(v)), "edge")


@query("bin_median_mad", f"WITH {BINS} SELECT CAST(bin AS INT) AS bin, round(med, 6) AS median, round(mad, 6) AS mad FROM mads")
def q_mad(v):
    return rounded(m.bin_median_mad(binned(v)), "median", "mad")


@query("dispersion_norm", f"WITH {BINS} SELECT gene_id, CASE WHEN isinf(dispersion_norm) THEN sign(dispersion_norm) * 1e300 ELSE round(dispersion_norm, 6) END AS dispersion_norm FROM normed")
def q_dnorm(v):
    d = F.col("dispersion_norm")
    return m.dispersion_norm(binned(v)).select("gene_id", F.when(F.abs(d) == m.INF, F.signum(d) * 1e300).otherwise(F.round(d, 6)).alias("dispersion_norm"))


@query("hvg_select", f"WITH {HVG} SELECT gene_id FROM hvg")
def q_hvg(v):
    return hvg(v)


@query("percent_prefix", f"WITH {GRID} SELECT cell_id, round(n_counts, 6) AS n_counts, round(percent, 6) AS percent FROM percell")
def q_percent(v):
    return rounded(per_cell(v), "n_counts", "percent")


@query("gram_matrix", f"""WITH {GRID} SELECT gene_id, (SELECT CAST(count(*) AS DOUBLE) FROM percell) AS n, round((SELECT sum(n_counts * percent) FROM percell), 4) AS xy,
  round(sum(value), 4) AS t, round(sum(value * n_counts), 4) AS tx, round(sum(value * percent), 4) AS ty FROM hnorm JOIN percell USING (cell_id) GROUP BY gene_id""")  # fmt: skip
def q_gram(v):
    h, cells = hvg_norm(v), per_cell(v)
    both = m.gram_with_genes(h, cells).crossJoin(m.gram(cells).select("n", "xy"))  # one row
    return both.select("gene_id", "n", *[F.round(c, 4).alias(c) for c in ("xy", "t", "tx", "ty")])


OLS = GRID + """,
g AS (SELECT CAST(count(*) AS DOUBLE) AS n, sum(n_counts) AS x, sum(percent) AS y, sum(n_counts * n_counts) AS xx, sum(n_counts * percent) AS xy, sum(percent * percent) AS yy FROM percell),
ts AS (SELECT gene_id, sum(value) AS t, sum(value * n_counts) AS tx, sum(value * percent) AS ty FROM grid GROUP BY gene_id),
fit AS (SELECT gene_id, (t*(xx*yy-xy*xy) - x*(tx*yy-xy*ty) + y*(tx*xy-xx*ty)) / nullif(n*(xx*yy-xy*xy) - x*(x*yy-xy*y) + y*(x*xy-xx*y), 0) AS b0,
  (n*(tx*yy-xy*ty) - t*(x*yy-xy*y) + y*(x*ty-tx*y)) / nullif(n*(xx*yy-xy*xy) - x*(x*yy-xy*y) + y*(x*xy-xx*y), 0) AS b1,
  (n*(xx*ty-tx*xy) - x*(x*ty-tx*y) + t*(x*xy-xx*y)) / nullif(n*(xx*yy-xy*xy) - x*(x*yy-xy*y) + y*(x*xy-xx*y), 0) AS b2 FROM ts, g),
resid AS (SELECT cell_id, gene_id, value - coalesce(b0 + b1 * n_counts + b2 * percent, 0) AS value FROM grid JOIN fit USING (gene_id))"""


def regressed(v):
    return m.regress_out(hvg_norm(v), per_cell(v), hvg(v))


def r4(df):
    return df.withColumn("value", F.round("value", 4) + F.lit(0.0))


@query("regress_out", f"WITH {OLS} SELECT cell_id, gene_id, round(value, 4) AS value FROM resid")
def q_regress(v):
    return r4(regressed(v))


@query("regress_out_glm", f"""WITH {OLS}, rules AS (SELECT g.gene_id, max(g.value) = min(g.value) AS flat, max(abs(r.value)) <= 1e-8 AS met FROM grid g JOIN resid r ON r.cell_id = g.cell_id AND r.gene_id = g.gene_id GROUP BY g.gene_id)
SELECT r.cell_id, r.gene_id, round(CASE WHEN flat THEN g.value WHEN met THEN 0 ELSE r.value END, 4) AS value FROM resid r JOIN grid g ON r.cell_id = g.cell_id AND r.gene_id = g.gene_id JOIN rules u ON u.gene_id = r.gene_id""")  # fmt: skip
def q_regress_glm(v):
    return r4(m.regress_out_glm(grid(v).select("cell_id", "gene_id", "value"), v.kept("residuals", lambda: regressed(v))))


@query("per_gene_fit", f"WITH {OLS} SELECT cell_id, gene_id, round(value, 4) AS value FROM resid")
def q_gene_fit(v):
    return r4(udfs.per_gene_fit(v.kept("grid", lambda: grid(v)), udfs.LEAST_SQUARES, ["n_counts", "percent"]))


@query("per_gene_glm")
def q_gene_glm(v):
    counted = m.dense_grid(m.subset_genes(filtered(v), hvg(v)), per_cell(v), hvg(v))
    return glm.residuals(counted, glm.POISSON, ["n_counts", "percent"])


@query("regress_out_category", f"""WITH {GRID}, x AS (SELECT grid.*, category, avg(value) OVER (PARTITION BY gene_id, category) AS x FROM grid JOIN cells USING (cell_id)),
s AS (SELECT gene_id, CAST(count(*) AS DOUBLE) AS n, sum(x) AS sx, sum(value) AS sy, sum(x * x) AS sxx, sum(x * value) AS sxy FROM x GROUP BY gene_id),
f AS (SELECT gene_id, coalesce((n * sxy - sx * sy) / nullif(round(n * sxx - sx * sx, 9), 0), 0) AS slope, sx, sy, n FROM s)
SELECT cell_id, x.gene_id, round(value - (sy - slope * sx) / n - slope * x, 4) AS value FROM x JOIN f USING (gene_id)""")  # fmt: skip
def q_regress_category(v):
    full = grid(v).join(v.cells.select("cell_id", "category"), "cell_id")
    return r4(m.regress_out_category(full))


@query("mean_centre", f"WITH {GRID} SELECT cell_id, gene_id, round(value - avg(value) OVER (PARTITION BY gene_id), 6) AS value FROM grid")
def q_centre(v):
    return rounded(m.centre(grid(v), grid_stats(v)), "value")


_STD = "CASE WHEN coalesce(stddev_samp(value) OVER (PARTITION BY gene_id), 0) = 0 THEN 1 ELSE stddev_samp(value) OVER (PARTITION BY gene_id) END"


@query("scale", f"WITH {GRID} SELECT cell_id, gene_id, round(least((value - avg(value) OVER (PARTITION BY gene_id)) / {_STD}, 10), 6) AS value FROM grid")
def q_scale(v):
    return rounded(m.scale(grid(v), stats=grid_stats(v)), "value")


@query("scale_no_centre", f"WITH {GRID} SELECT cell_id, gene_id, round(least(value / {_STD}, 10), 6) AS value FROM grid")
def q_scale_no_centre(v):
    return rounded(m.scale(grid(v), zero_center=False, stats=grid_stats(v)), "value")


@query("train_prefix_split", "SELECT cell_id FROM (SELECT cell_id, row_number() OVER (ORDER BY ordinal) AS rn, ceil(0.35 * count(*) OVER ()) AS k FROM cells) c WHERE rn <= k")
def q_train(v):
    return m.train_prefix(v.cells).select("cell_id")


@query("batch_ranges", """SELECT cell_id, CAST(CASE WHEN n - greatest(1, floor(n / 7.0)) * 7 < greatest(1, floor(n / 7.0)) THEN least(floor((rn - 1) / greatest(1, floor(n / 7.0))), 6) ELSE floor((rn - 1) / greatest(1, floor(n / 7.0))) END AS BIGINT) AS batch
FROM (SELECT cell_id, row_number() OVER (ORDER BY ordinal) AS rn, count(*) OVER () AS n FROM cells) c""")  # fmt: skip
def q_batches(v):
    return m.batch_ranges(m.numbered_rows(v.cells, "ordinal"), 7).select("cell_id", F.col("batch").cast("long").alias("batch"))


@query("scale_vectors", """WITH x AS (SELECT vec_id AS id, unnest(range(len(embedding))) AS d, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)
SELECT id, d, round(least((x - avg(x) OVER (PARTITION BY d)) / CASE WHEN stddev_samp(x) OVER (PARTITION BY d) = 0 THEN 1 ELSE stddev_samp(x) OVER (PARTITION BY d) END, 10), 6) AS x FROM x""")  # fmt: skip
def q_scale_vectors(v):
    return rounded(m.scale(v.vectors.select("id", "vec")).select("id", F.posexplode("vec").alias("d", "x")).withColumn("d", F.col("d").cast("long")), "x")


@query("matrix_ingest", "SELECT cell_id, gene_id, value, category AS cell_label, gene_name AS gene_label FROM counts JOIN cells USING (cell_id) JOIN genes USING (gene_id)")
def q_matrix_ingest(v):
    folder = src.write_matrix_market(counts(v), v.cells.select("cell_id", F.col("category").alias("label")), v.genes.select("gene_id", F.col("gene_name").alias("label")))
    return src.read_annotated_matrix(v.spark, folder)
