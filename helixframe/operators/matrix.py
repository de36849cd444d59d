"""Cell x gene counts in long form (cell_id, gene_id, value): filtering, normalising, variable genes, regression, scaling.

Zeros are not stored, apart from explicit ones; means, variances and regressions count them through the number of cells,
never by densifying. Where all zeros matter in the result (residuals, scaled values), the grid is cells x selected genes.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.operators.scratch import kept_table

INF = float("inf")
#: The normal distribution's median absolute deviation, target total of a cell, upper clip.
MAD_SCALE, TARGET_TOTAL, CLIP = 0.6744897501960817, 1e4, 10.0


def genes_per_cell(counts: DataFrame) -> DataFrame:
    """Stored entries of each cell; explicit zeros count."""
    return counts.groupBy("cell_id").agg(F.count("*").alias("n_genes"))


def filter_cells(counts: DataFrame, min_genes: int, max_genes: int) -> DataFrame:
    kept = genes_per_cell(counts).where(F.col("n_genes").between(min_genes, max_genes))
    return counts.join(kept, "cell_id", "left_semi")


def cells_per_gene(counts: DataFrame) -> DataFrame:
    """Cells with a value that isn't zero."""
    return counts.groupBy("gene_id").agg(F.count_if(F.col("value") != 0).alias("n_cells"))


def filter_genes(counts: DataFrame, min_cells: int) -> DataFrame:
    return counts.join(cells_per_gene(counts).where(F.col("n_cells") >= min_cells), "gene_id", "left_semi").select("cell_id", "gene_id", "value")


def first_n_cells(cells: DataFrame, n: int) -> DataFrame:
    """The first n rows by ordinal; all of them for -1."""
    return cells if n == -1 else cells.orderBy("ordinal").limit(n)


def unique_names(genes: DataFrame, name: str = "gene_name", out: str = "unique_name") -> DataFrame:
    """Later occurrences of a name get -1, -2 and so on; a suffix that makes an existing name moves on to the next free number."""
    order = Window.partitionBy(name).orderBy("ordinal")
    numbered = genes.withColumn("__n", F.row_number().over(order) - 1)
    # Numbers that are taken by genuine names of the form <name>-<number> are skipped.
    taken = (
        genes.select(F.regexp_extract(name, r"^(.*)-(\d+)$", 1).alias("__stem"), F.expr(f"try_cast(regexp_extract({name}, '^(.*)-([1-9][0-9]*)$', 2) as int)").alias("__k"))
        .where("__k is not null").distinct().groupBy("__stem").agg(F.sort_array(F.collect_list("__k")).alias("__used"))
    )
    joined = numbered.join(taken, numbered[name] == taken["__stem"], "left")
    number = F.aggregate(F.coalesce("__used", F.array().cast("array<int>")), F.col("__n"), lambda n, k: F.when(k <= n, n + 1).otherwise(n))
    return joined.withColumn(out, F.when(F.col("__n") == 0, F.col(name)).otherwise(F.concat(name, F.lit("-"), number))).drop("__n", "__stem", "__used")


def normalise_log1p(counts: DataFrame, target: float = TARGET_TOTAL) -> DataFrame:
    total = F.sum("value").over(Window.partitionBy("cell_id")) + F.lit(1e-12)
    return counts.withColumn("value", F.log1p(F.col("value") * target / total))


def gene_dispersion(norm: DataFrame, n_cells: DataFrame) -> DataFrame:
    """(gene_id, mean, var, dispersion) over all cells, zeros included; n_cells: one row, one column n."""
    n = n_cells.select("n").scalar()
    sums = norm.groupBy("gene_id").agg(F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("ss"))
    stats = sums.withColumn("n", n.cast("double")).withColumn("mean", F.col("s") / F.col("n"))
    stats = stats.withColumn("var", (F.col("ss") - F.col("s") * F.col("s") / F.col("n")) / F.expr("nullif(n - 1, 0)"))
    safe = F.when(F.col("mean") == 0, F.lit(1e-12)).otherwise(F.col("mean"))
    return stats.select("gene_id", safe.alias("mean"), "var", (F.col("var") / safe).alias("dispersion"))


def mean_bin_edges(stats: DataFrame) -> DataFrame:
    """Distinct percentiles 10, 15, ..., 100 of the gene means; bins are right-closed and open at both ends."""
    points = F.array(*[F.lit(p / 100) for p in range(10, 101, 5)])
    return stats.agg(F.percentile("mean", points).alias("e")).select(F.explode(F.array_distinct("e")).alias("edge"))


def with_mean_bin(stats: DataFrame, edges: DataFrame) -> DataFrame:
    """Adds bin, the number of edges below the mean. edges: at most 19 rows, held as one array."""
    array = edges.agg(F.sort_array(F.collect_list("edge")).alias("e")).select("e").scalar()
    counted = stats.withColumn("__e", array)
    return counted.withColumn("bin", F.size(F.filter("__e", lambda e: e < F.col("mean")))).drop("__e")


def bin_median_mad(binned: DataFrame) -> DataFrame:
    med = binned.groupBy("bin").agg(F.median("dispersion").alias("median"))
    away = binned.join(med, "bin").withColumn("away", F.abs(F.col("dispersion") - F.col("median")))
    return away.groupBy("bin").agg(F.first("median").alias("median"), (F.median("away") / MAD_SCALE).alias("mad"))


def dispersion_norm(binned: DataFrame) -> DataFrame:
    """(d - median) / MAD; with a MAD of zero +inf above the median, -inf below, null at it."""
    joined = binned.join(bin_median_mad(binned), "bin")
    flat = F.when(F.col("dispersion") > F.col("median"), F.lit(INF)).when(F.col("dispersion") < F.col("median"), F.lit(-INF))
    return joined.withColumn("dispersion_norm", F.when(F.col("mad") == 0, flat).otherwise((F.col("dispersion") - F.col("median")) / F.expr("nullif(mad, 0)")))


def select_hvg(normed: DataFrame, n_top: int) -> DataFrame:
    """Adds highly_variable: a normalised dispersion of at least the n_top-th largest (of all, if there are fewer).

    Values are compared to 6 decimals; nulls don't take part in the cutoff and then count as 0; ties are kept.
    """
    value = F.round("dispersion_norm", 6)
    # The top of the gene axis: a sort with a limit, one number for each gene at most.
    cutoff = normed.where("dispersion_norm is not null").select(value.alias("v")).orderBy(F.desc("v")).limit(n_top).agg(F.min("v").alias("c")).select("c").scalar()
    return normed.withColumn("__c", cutoff).withColumn("highly_variable", F.coalesce(F.coalesce(value, F.lit(0.0)) >= F.col("__c"), F.lit(False))).drop("__c")


def subset_genes(counts: DataFrame, genes: DataFrame) -> DataFrame:
    return counts.join(genes.select("gene_id"), "gene_id", "left_semi").select("cell_id", "gene_id", "value")


def matrix_subset(counts: DataFrame, cells: DataFrame, genes: DataFrame) -> DataFrame:
    """Rows and columns of both masks; columns are numbered densely over the kept genes."""
    numbered = genes.select("gene_id").distinct().withColumn("column", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy("gene_id")) - 1)
    return counts.join(cells.select("cell_id"), "cell_id", "left_semi").join(numbered, "gene_id").select("cell_id", "column", "value")


def marker_columns(norm: DataFrame, cells: DataFrame, genes: DataFrame, markers: list[str]) -> DataFrame:
    """(cell_id, <marker>_raw): the cell's value, 0 when absent; null for a marker that no gene has."""
    named = genes.where(F.col("unique_name").isin(markers)).select("gene_id", "unique_name")
    have = named.agg(F.collect_set("unique_name").alias("have")).select("have").scalar()
    found = norm.join(F.broadcast(named), "gene_id")  # as many rows as markers
    wide = found.groupBy("cell_id").agg(*[F.max(F.when(F.col("unique_name") == m, F.col("value"))).alias(m) for m in markers])
    out = cells.select("cell_id").join(wide, "cell_id", "left").withColumn("__have", have)
    return out.select("cell_id", *[F.when(F.array_contains("__have", m), F.coalesce(F.col(f"`{m}`"), F.lit(0.0))).alias(f"{m}_raw") for m in markers])


def percent_prefix(norm: DataFrame, genes: DataFrame, prefix: str = "mt-") -> DataFrame:
    """(cell_id, n_counts, percent): total of a cell and the part that genes with the prefix have in it."""
    flagged = norm.join(genes.select("gene_id", F.col("gene_name").startswith(prefix).alias("hit")), "gene_id")
    sums = flagged.groupBy("cell_id").agg(F.sum("value").alias("n_counts"), F.sum(F.when(F.col("hit"), F.col("value")).otherwise(0.0)).alias("part"))
    return sums.select("cell_id", "n_counts", F.try_divide("part", "n_counts").alias("percent"))


def matrix_sum(counts: DataFrame, axis: str | None = None) -> DataFrame:
    """Sum over everything, or by gene_id, or by cell_id."""
    total = F.sum("value").alias("total")
    return counts.groupBy(axis).agg(total) if axis else counts.agg(total)


def gram(cells: DataFrame) -> DataFrame:
    """One row with the sums of products of (1, x, y) over all cells."""
    x, y = F.col("n_counts"), F.col("percent")
    return cells.agg(F.count("*").cast("double").alias("n"), F.sum(x).alias("x"), F.sum(y).alias("y"), F.sum(x * x).alias("xx"), F.sum(x * y).alias("xy"), F.sum(y * y).alias("yy"))


def gram_with_genes(norm: DataFrame, cells: DataFrame) -> DataFrame:
    """(gene_id, t, tx, ty): sums of (1, x, y) times the gene's values."""
    v = F.col("value")
    return norm.join(cells, "cell_id").groupBy("gene_id").agg(F.sum(v).alias("t"), F.sum(v * F.col("n_counts")).alias("tx"), F.sum(v * F.col("percent")).alias("ty"))


def regression_coefficients(norm: DataFrame, cells: DataFrame) -> DataFrame:
    """(gene_id, b0, b1, b2): least squares of each gene on (1, n_counts, percent), zeros included, by the 3 x 3 inverse."""
    g = gram(cells).select(F.struct("*").alias("g")).select("g").scalar()
    d = "(g.n * (g.xx * g.yy - g.xy * g.xy) - g.x * (g.x * g.yy - g.xy * g.y) + g.y * (g.x * g.xy - g.xx * g.y))"
    b0 = f"(t * (g.xx * g.yy - g.xy * g.xy) - g.x * (tx * g.yy - g.xy * ty) + g.y * (tx * g.xy - g.xx * ty)) / nullif({d}, 0)"
    b1 = f"(g.n * (tx * g.yy - g.xy * ty) - t * (g.x * g.yy - g.xy * g.y) + g.y * (g.x * ty - tx * g.y)) / nullif({d}, 0)"
    b2 = f"(g.n * (g.xx * ty - tx * g.xy) - g.x * (g.x * ty - tx * g.y) + t * (g.x * g.xy - g.xx * g.y)) / nullif({d}, 0)"
    return gram_with_genes(norm, cells).withColumn("g", g).select("gene_id", F.expr(b0).alias("b0"), F.expr(b1).alias("b1"), F.expr(b2).alias("b2"))


def dense_grid(norm: DataFrame, cells: DataFrame, genes: DataFrame) -> DataFrame:
    """All cells x the selected genes with 0 for what isn't stored. The gene side is the bounded list of selected genes."""
    names = genes.agg(F.collect_list("gene_id").alias("all")).select("all").scalar()
    grid = cells.withColumn("gene_id", F.explode(names))
    return grid.join(norm, ["cell_id", "gene_id"], "left").withColumn("value", F.coalesce("value", F.lit(0.0)))


def regress_out(norm: DataFrame, cells: DataFrame, genes: DataFrame) -> DataFrame:
    """Residuals of each selected gene."""
    fitted = dense_grid(norm, cells, genes).join(regression_coefficients(norm, cells), "gene_id", "left")
    line = F.col("b0") + F.col("b1") * F.col("n_counts") + F.col("b2") * F.col("percent")
    return fitted.select("cell_id", "gene_id", (F.col("value") - F.coalesce(line, F.lit(0.0))).alias("value"))


SEPARATED = 1e-8


def regress_out_glm(full: DataFrame, residuals: DataFrame) -> DataFrame:
    """Response residuals of a Gaussian model, as the model family has them.

    full: the grid that was fitted, residuals: those of least squares, by which such a model is fitted. A gene with one value
    in all cells is returned unchanged; where the fit meets every value (perfect separation), residuals are 0.
    """
    flat = full.groupBy("gene_id").agg((F.max("value") == F.min("value")).alias("constant"))
    met = residuals.groupBy("gene_id").agg((F.max(F.abs("value")) <= SEPARATED).alias("met"))
    rules = flat.join(met, "gene_id")
    joined = full.withColumnRenamed("value", "own").join(residuals, ["cell_id", "gene_id"]).join(rules, "gene_id")
    return joined.select("cell_id", "gene_id", F.when(F.col("constant"), F.col("own")).when(F.col("met"), 0.0).otherwise(F.col("value")).alias("value"))


def regress_out_category(full: DataFrame) -> DataFrame:
    """Residuals of a full grid (cell_id, gene_id, category, value) on each gene's mean in the category."""
    mean = F.avg("value").over(Window.partitionBy("gene_id", "category"))
    x = full.withColumn("x", mean)
    sums = x.groupBy("gene_id").agg(F.count("*").cast("double").alias("n"), F.sum("x").alias("sx"), F.sum("value").alias("sy"), F.sum(F.col("x") * F.col("x")).alias("sxx"), F.sum(F.col("x") * F.col("value")).alias("sxy"))
    slope = "coalesce((n * sxy - sx * sy) / nullif(round(n * sxx - sx * sx, 9), 0), 0)"
    fit = sums.select("gene_id", F.expr(slope).alias("slope"), F.expr(f"(sy - {slope} * sx) / n").alias("base"))
    return x.join(fit, "gene_id").select("cell_id", "gene_id", (F.col("value") - F.col("base") - F.col("slope") * F.col("x")).alias("value"))


def gene_axis_stats(full: DataFrame) -> DataFrame:
    return full.groupBy("gene_id").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))


def sparse_axis_stats(norm: DataFrame, n_cells: DataFrame) -> DataFrame:
    """gene_axis_stats() of the grid of n_cells (one row, column n) and the genes that norm holds, from what is stored."""
    return gene_dispersion(norm, n_cells).join(norm.groupBy("gene_id").agg(F.sum("value").alias("s")), "gene_id").select("gene_id", F.when(F.col("s") == 0, 0.0).otherwise(F.col("mean")).alias("mean"), F.sqrt(F.greatest("var", F.lit(0.0))).alias("std"))


def clip_upper(value: Column, most: float = CLIP) -> Column:
    """Values above the limit become the limit; the lower side is left alone."""
    return F.least(value, F.lit(most))


def centre(full: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    return full.join(gene_axis_stats(full) if stats is None else stats, "gene_id").select("cell_id", "gene_id", (F.col("value") - F.col("mean")).alias("value"))


def scale(full: DataFrame, zero_center: bool = True, most: float | None = CLIP, stats: DataFrame | None = None) -> DataFrame:
    """(value - mean) / std per gene, a std of 0 counting as 1; without centring what is stored stays sparse.

    A table with a column `vec` is scaled along each dimension of its vectors instead.
    """
    if "vec" in full.columns:
        return _scaled_vectors(full, zero_center, most)
    joined = full.join(gene_axis_stats(full) if stats is None else stats, "gene_id")
    std = F.when(F.coalesce("std", F.lit(0.0)) == 0, F.lit(1.0)).otherwise(F.col("std"))
    value = (F.col("value") - (F.col("mean") if zero_center else F.lit(0.0))) / std
    return joined.select("cell_id", "gene_id", (clip_upper(value, most) if most is not None else value).alias("value"))


def _scaled_vectors(rows: DataFrame, zero_center: bool, most: float | None) -> DataFrame:
    dims = rows.select(F.posexplode("vec").alias("d", "x")).groupBy("d").agg(F.avg(F.col("x").cast("double")).alias("m"), F.stddev_samp(F.col("x").cast("double")).alias("s"))
    axis = dims.agg(F.sort_array(F.collect_list(F.struct("d", "m", "s"))).alias("a")).select("a").scalar()  # one entry a dimension

    def one(x, a):
        std = F.when(F.coalesce(a["s"], F.lit(0.0)) == 0, F.lit(1.0)).otherwise(a["s"])
        value = (x.cast("double") - (a["m"] if zero_center else F.lit(0.0))) / std
        return value if most is None else clip_upper(value, most)

    return rows.withColumn("__a", axis).withColumn("vec", F.zip_with("vec", "__a", one)).drop("__a")


def train_prefix(cells: DataFrame, share: float = 0.35) -> DataFrame:
    """The first ceil(share * n) rows by ordinal."""
    n = cells.agg(F.ceil(F.count("*") * F.lit(share)).alias("n")).select("n").scalar()
    return numbered_rows(cells, "ordinal").withColumn("__n", n).where(F.col("row") < F.col("__n")).drop("__n")


def numbered_rows(df: DataFrame, *by: str | Column, out: str = "row", size: str | None = None) -> DataFrame:
    """Adds each row's place (from 0) in the order of the columns; rows that tie are in any order. size: a column whose sum
    over all rows before is added too, as `before`.

    Rows go to range partitions, whose bounds Spark takes from the data, and are written there in order. What comes before a partition is a sum
    over the partitions: the only window is over a table of as many rows as partitions.
    """
    ordered = df.repartitionByRange(*by).sortWithinPartitions(*by)
    if size is not None:
        ordered = _running(ordered, size)
    kept = kept_table(ordered.withColumn("__p", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id()), "numbered")
    total = F.sum(size) if size is not None else F.lit(0)
    parts = kept.groupBy("__p").agg(F.count("*").alias("__n"), F.min("__i").alias("__first"), total.alias("__s"))
    earlier = Window.partitionBy(F.lit(1)).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("__p", (F.coalesce(F.sum("__n").over(earlier), F.lit(0)) - F.col("__first")).alias("__base"), F.coalesce(F.sum("__s").over(earlier), F.lit(0)).alias("__sum"))
    found = kept.join(bases, "__p").withColumn(out, F.col("__base") + F.col("__i"))
    if size is not None:
        found = found.withColumn("before", F.col("__sum") + F.col("__run")).drop("__run")
    return found.drop("__p", "__i", "__base", "__sum")


def _running(ordered: DataFrame, size: str) -> DataFrame:
    """Adds __run, the sum of size over the rows before in the partition."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        so_far = 0
        for frame in frames:
            sums = frame[size].astype("int64").cumsum() + so_far
            yield frame.assign(__run=sums - frame[size].astype("int64"))
            so_far = int(sums.iloc[-1]) if len(sums) else so_far

    return ordered.mapInPandas(run, f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in ordered.schema)}, __run long")


def batch_ranges(rows: DataFrame, batches: int) -> DataFrame:
    """Adds batch: size floor(n / batches); the last batch takes the remainder when it is smaller than a batch."""
    n = rows.agg(F.count("*").alias("n")).select("n").scalar()
    size = F.greatest(F.lit(1), F.floor(F.col("__n") / batches))
    most = F.when(F.col("__n") - size * batches < size, F.lit(batches - 1)).otherwise(F.lit(2**31 - 1))
    return rows.withColumn("__n", n).withColumn("batch", F.least(F.floor(F.col("row") / size), most)).drop("__n")
