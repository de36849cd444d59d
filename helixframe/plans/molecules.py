"""Queries over molecules, docking poses and genomic intervals."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.operators import molecules as m
from helixframe.plans.views import query
from helixframe.sources import text as src

TILE = 86400


def r6(df, *cols):
    return df.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in cols})


def rounded(vec: str):
    """Components to six places; zero keeps the sign of what it was rounded from, as in SQL."""
    return F.transform(vec, lambda x: F.round(F.abs(x), 6) * F.signum(x))


QUALITY = """WITH d AS (SELECT DISTINCT run_id, mol FROM molecules WHERE valid), n AS (SELECT run_id, count(*) AS n, count(*) FILTER (valid) AS nv FROM molecules GROUP BY 1),
k AS (SELECT run_id, count(*) AS d, count(*) FILTER (mol NOT IN (SELECT mol FROM train_molecules)) AS w FROM d GROUP BY 1),
q AS (SELECT n.run_id, nv / n AS validity, d / nullif(nv, 0) AS uniqueness, coalesce(d, 0) / n AS abs_uniqueness, w / nullif(d, 0) AS novelty, coalesce(w, 0) / n AS abs_novelty FROM n LEFT JOIN k USING (run_id))"""
RATIOS = ("validity", "uniqueness", "abs_uniqueness", "novelty", "abs_novelty")


@query("generation_quality", QUALITY + " SELECT run_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in RATIOS) + " FROM q")
def q_quality(v):
    return r6(m.generation_quality(v.molecules, v.train_molecules), *RATIOS)


@query("run_mean_sd", QUALITY + " SELECT round(avg(uniqueness), 6) AS mean, round(stddev_pop(uniqueness), 6) AS sd FROM q")
def q_run_mean(v):
    return r6(m.generation_quality(v.molecules, v.train_molecules).agg(F.avg("uniqueness").alias("mean"), F.stddev_pop("uniqueness").alias("sd")), "mean", "sd")


@query("reconstruction_rate", "SELECT round(avg(r), 6) AS rate FROM (SELECT avg(CASE WHEN valid THEN 1.0 ELSE 0.0 END) AS r FROM molecules GROUP BY floor(ordinal / 256)) b")
def q_reconstruction(v):
    return r6(m.reconstruction_rate(v.molecules.select("ordinal", F.col("valid").alias("match")), 256), "rate")


PAIRS = """WITH p AS (SELECT a.ordinal AS start_id, b.ordinal AS target, len(list_intersect(a.fp, b.fp)) / nullif(len(list_distinct(list_concat(a.fp, b.fp))), 0) AS similarity, b.plogp - a.plogp AS gain
FROM molecules a JOIN molecules b ON b.ordinal = a.ordinal + 5)"""


def pairs(v):
    a = v.molecules.select(F.col("ordinal").alias("start_id"), F.col("fp").alias("f"), F.col("plogp").alias("p"), (F.col("ordinal") + 5).alias("target"))
    b = v.molecules.select(F.col("ordinal").alias("target"), F.col("fp").alias("g"), F.col("plogp").alias("q"))
    return a.join(b, "target").select("start_id", "target", m.tanimoto(F.col("f"), F.col("g")).alias("similarity"), (F.col("q") - F.col("p")).alias("gain"))


@query("tanimoto", PAIRS + " SELECT start_id, target, round(similarity, 6) AS similarity FROM p WHERE similarity >= 0")
def q_tanimoto(v):
    return r6(pairs(v).where("similarity >= 0").select("start_id", "target", "similarity"), "similarity")


SETS = """WITH s AS (SELECT ordinal, fp, min(ordinal) OVER (PARTITION BY fp) AS rep FROM molecules WHERE len(fp) > 0), r AS (SELECT ordinal, fp, len(fp) AS n FROM s WHERE ordinal = rep),
p AS (SELECT a.ordinal AS a, b.ordinal AS b, len(list_intersect(a.fp, b.fp)) AS i, a.n + b.n AS n FROM r a JOIN r b ON a.ordinal < b.ordinal AND least(a.n, b.n) >= 0.4 * greatest(a.n, b.n))
SELECT a, b, round(CAST(i AS DOUBLE) / (n - i), 6) AS similarity FROM p WHERE CAST(i AS DOUBLE) / (n - i) >= 0.4e0 UNION ALL SELECT DISTINCT rep, ordinal, 1.0e0 FROM s WHERE rep <> ordinal"""


@query("tanimoto_search", SETS)
def q_tanimoto_search(v):
    return r6(m.similar_sets(v.molecules.select(F.col("ordinal").alias("id"), F.col("fp").alias("items")), 0.4), "similarity")


@query("constrained_opt_summary", PAIRS + """, h AS (SELECT c AS cutoff, p.* FROM p, (VALUES (0.0), (0.2), (0.4), (0.6)) x(c) WHERE similarity >= c AND gain > 0),
b AS (SELECT cutoff, start_id, similarity, gain, row_number() OVER (PARTITION BY cutoff, start_id ORDER BY gain DESC, similarity DESC) AS n FROM h)
SELECT CAST(cutoff AS DOUBLE) AS cutoff, count(*) AS n, round(avg(similarity), 6) AS mean_similarity, round(stddev_pop(similarity), 6) AS sd_similarity, round(avg(gain), 6) AS mean_gain, round(stddev_pop(gain), 6) AS sd_gain,
round(count(*) / (SELECT count(DISTINCT start_id) FROM p), 6) AS success FROM b WHERE n = 1 GROUP BY cutoff""")  # fmt: skip
def q_constrained(v):
    return r6(m.constrained_summary(pairs(v), [0.0, 0.2, 0.4, 0.6]), "mean_similarity", "sd_similarity", "mean_gain", "sd_gain", "success")


@query("drop_duplicate_neighbours", "SELECT ordinal, mol FROM (SELECT ordinal, mol, row_number() OVER (PARTITION BY mol ORDER BY ordinal) AS n FROM molecules) m WHERE n = 1")
def q_duplicates(v):
    return m.first_of_each(v.molecules.select("ordinal", "mol"), "mol", "ordinal")


@query("holdout_anti_join", "SELECT ordinal FROM molecules WHERE ordinal NOT IN (SELECT item_id FROM benchmark)")
def q_holdout(v):
    return v.molecules.select("ordinal").join(v.benchmark.select(F.col("item_id").alias("ordinal")), "ordinal", "left_anti")


@query("worst_topk", "SELECT ordinal, plogp FROM molecules ORDER BY plogp, ordinal LIMIT 20")
def q_worst(v):
    return v.molecules.select("ordinal", "plogp").orderBy("plogp", "ordinal").limit(20)


@query("ranked_score_export", "SELECT run_id, ordinal, 'qed' AS score, CAST(row_number() OVER (PARTITION BY run_id ORDER BY qed DESC, ordinal) AS INT) AS place FROM molecules UNION ALL SELECT run_id, ordinal, 'plogp', CAST(row_number() OVER (PARTITION BY run_id ORDER BY plogp DESC, ordinal) AS INT) FROM molecules")
def q_ranked(v):
    rank = lambda c: v.molecules.select("run_id", "ordinal", F.lit(c).alias("score"), F.row_number().over(m.Window.partitionBy("run_id").orderBy(F.desc(c), "ordinal")).alias("place"))
    path = src.scratch_path(v.spark, "ranked")
    rank("qed").unionByName(rank("plogp")).write.partitionBy("score", "run_id").parquet(path)
    return v.spark.read.parquet(path).select(F.col("run_id").cast("long").alias("run_id"), "ordinal", "score", "place")


@query("vector_lerp", """WITH p AS (SELECT a.id, a.vec AS z0, b.vec AS z1 FROM vectors a JOIN vectors b ON b.id = a.id + 1)
SELECT id, CAST(i AS INT) AS i, list_transform(list_zip(z0, z1), lambda x: round(CAST(x[1] AS DOUBLE) + i / 4.0 * (CAST(x[2] AS DOUBLE) - CAST(x[1] AS DOUBLE)), 6)) AS vec FROM p, range(5) t(i)""")  # fmt: skip
def q_lerp(v):
    pair = v.vectors.select("id", F.col("vec").alias("z0"), (F.col("id") + 1).alias("next")).join(v.vectors.select(F.col("id").alias("next"), F.col("vec").alias("z1")), "next")
    return m.lerp(pair, 3).select("id", "i", rounded("vec").alias("vec"))


@query("vector_grid", "SELECT id, CAST(i AS INT) AS i, CAST(j AS INT) AS j, list_transform(vec, lambda x, k: round(CAST(x AS DOUBLE) + CASE k WHEN 1 THEN 0.5 * i WHEN 2 THEN 0.5 * j ELSE 0 END, 6)) AS vec FROM vectors, range(-2, 3) t(i), range(-2, 3) u(j)")
def q_grid(v):
    unit = lambda k: F.transform("vec", lambda _, n: F.when(n == k, 1.0).otherwise(0.0))
    points = v.vectors.select("id", "vec", unit(0).alias("x"), unit(1).alias("y"))
    return m.grid_around(points, 0.5, 2).select("id", "i", "j", rounded("vec").alias("vec"))


@query("best_pose", "SELECT ligand, receptor, run, round(energy, 6) AS energy FROM (SELECT *, row_number() OVER (PARTITION BY ligand ORDER BY energy, receptor, run) AS n FROM poses) p WHERE n = 1")
def q_best_pose(v):
    return r6(m.best_pose(v.poses), "energy")


@query("pose_clusters", """WITH RECURSIVE o AS (SELECT ligand, energy, x, y, z, row_number() OVER (PARTITION BY ligand ORDER BY energy, x, y, z) AS rn FROM poses),
r AS (SELECT ligand, rn, energy, x, y, z, [[x, y, z]] AS leaders, 0 AS cluster FROM o WHERE rn = 1
  UNION ALL SELECT ligand, rn, energy, x, y, z, CASE WHEN hit IS NULL OR hit = 0 THEN list_append(leaders, [x, y, z]) ELSE leaders END, CASE WHEN hit IS NULL OR hit = 0 THEN len(leaders) ELSE hit - 1 END
  FROM (SELECT o.*, leaders, list_position(list_transform(leaders, lambda l: sqrt((l[1] - o.x) * (l[1] - o.x) + (l[2] - o.y) * (l[2] - o.y) + (l[3] - o.z) * (l[3] - o.z)) <= 2), true) AS hit FROM r JOIN o ON o.ligand = r.ligand AND o.rn = r.rn + 1) t)
SELECT ligand, energy, x, y, z, CAST(cluster AS INT) AS cluster FROM r""")  # fmt: skip
def q_pose_clusters(v):
    return m.pose_clusters(v.poses)


@query("screening_cross_join", "SELECT l_partkey AS ligand, s_suppkey AS receptor FROM (SELECT DISTINCT l_partkey FROM lineitem) l, supplier s")
def q_screening(v):
    return m.screening(v.poses.select("ligand").distinct(), v.supplier.select(F.col("s_suppkey").alias("receptor")))


@query("contact_theta_join", """WITH t AS (SELECT receptor AS id, CASE receptor % 3 WHEN 0 THEN 'R' WHEN 1 THEN 'H' ELSE 'V' END AS kind, 10 * avg(x) AS x, 10 * avg(y) AS y, 10 * avg(z) AS z FROM poses GROUP BY receptor),
p AS (SELECT ligand AS id, 10 * avg(x) AS x, 10 * avg(y) AS y, 10 * avg(z) AS z FROM poses GROUP BY ligand)
SELECT p.id AS pose, t.id AS target, kind FROM p, t WHERE (p.x - t.x) * (p.x - t.x) + (p.y - t.y) * (p.y - t.y) + (p.z - t.z) * (p.z - t.z) <= CASE kind WHEN 'R' THEN 2.1 * 2.1 WHEN 'H' THEN 3.7 * 3.7 ELSE 4.0 * 4.0 END""")  # fmt: skip
def q_contacts(v):
    kind = F.when(F.col("receptor") % 3 == 0, "R").when(F.col("receptor") % 3 == 1, "H").otherwise("V")
    targets = v.poses.groupBy("receptor").agg(*[(10 * F.avg(c)).alias(c) for c in "xyz"]).select(F.col("receptor").alias("id"), kind.alias("kind"), "x", "y", "z")
    atoms = v.poses.groupBy("ligand").agg(*[(10 * F.avg(c)).alias(c) for c in "xyz"]).select(F.col("ligand").alias("id"), F.lit("").alias("kind"), "x", "y", "z")
    return m.contacts(atoms, targets)


@query("design_filter", "SELECT ligand, run, round(energy, 6) AS pae_interaction FROM poses WHERE -energy < 2")
def q_design(v):
    return r6(v.poses.where("-energy < 2").select("ligand", "run", F.col("energy").alias("pae_interaction")), "pae_interaction")


@query("dock_batch_manifest", "SELECT concat('rec', s_suppkey) AS receptor, concat('lig', s_suppkey) AS ligand, s_name AS name FROM supplier")
def q_jobs(v):
    path = src.write_text(v.supplier.select(F.concat_ws("\n", F.concat(F.lit("rec"), "s_suppkey"), F.concat(F.lit("lig"), "s_suppkey"), "s_name")), "jobs")
    return src.read_manifest(v.spark, path).select("receptor", "ligand", "name")


LENGTHS = "lengths AS (SELECT contig, max(end_pos) AS length FROM signal GROUP BY contig)"
TILES = f"WITH {LENGTHS}, tiles AS (SELECT contig, CAST(i AS BIGINT) AS tile, CAST(i * {TILE} AS BIGINT) AS lo, CAST(least((i + 1) * {TILE}, length) AS BIGINT) AS hi FROM lengths, range(0, 4000) t(i) WHERE i * {TILE} < length)"


def all_tiles(v):
    return m.tiles(v.signal.groupBy("contig").agg(F.max("end_pos").alias("length")), TILE)


@query("tile_intervals", TILES + " SELECT contig, tile, lo AS start_pos, hi AS end_pos FROM tiles")
def q_tiles(v):
    return all_tiles(v)


@query("interval_overlap_join", TILES + " SELECT s.contig, tile, start_pos AS s, end_pos AS e, value FROM signal s JOIN tiles t ON s.contig = t.contig AND start_pos < hi + 600 AND end_pos > lo - 600 AND end_pos > start_pos")
def q_overlaps(v):
    return m.overlaps(v.signal, all_tiles(v), TILE, 600)


@query("nonzero_tiles", TILES + " SELECT s.contig, tile, round(sum(value), 4) AS total FROM signal s JOIN tiles t ON s.contig = t.contig AND start_pos < hi AND end_pos > lo AND end_pos > start_pos GROUP BY 1, 2 HAVING sum(value) > 0")
def q_nonzero(v):
    sums = m.overlaps(v.signal, all_tiles(v), TILE, 0).groupBy("contig", "tile").agg(F.sum("value").alias("total"))
    return sums.where("total > 0").withColumn("total", F.round("total", 4))


@query("chrom_holdout_split", TILES + " SELECT contig, tile, CASE contig WHEN 'u3' THEN 'val' WHEN 'u5' THEN 'holdout' ELSE 'train' END AS split FROM tiles")
def q_holdout_split(v):
    return m.holdout_split(all_tiles(v), "u3", "u5").select("contig", "tile", "split")


@query("interval_ingest", "SELECT contig, start_pos, end_pos, value FROM signal")
def q_intervals(v):
    rows = v.signal.select(F.concat_ws("\t", "contig", "start_pos", "end_pos", F.lit("peak"), F.lit("0"), F.lit("."), F.col("value").cast("string"), F.lit("-1"), F.lit("-1"), F.lit("-1")))
    return src.read_intervals(v.spark, src.write_text(rows, "peaks"))

