"""Queries over sequences, residue scores, annotations and molecules' text formats."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.operators import sequences as s
from helixframe.operators.matrix import numbered_rows
from helixframe.plans.views import query
from helixframe.sources import text as src

FASTA_TEXT = "concat('>', header, '\n', regexp_replace(seq, '(.{60})', '$1\n'))"
RES = "residue_logp"


def r6(df, *cols):
    return df.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in cols})


@query("fasta_ingest", "SELECT header, seq FROM sequences")
def q_fasta(v):
    path = src.write_text(v.sequences.select(F.expr(FASTA_TEXT)), "fasta")
    return src.read_fasta(v.spark, path).select("header", "seq")


@query("proteome_ingest", "SELECT header, seq FROM sequences")
def q_proteome(v):
    path = src.write_text(v.sequences.select(F.expr(FASTA_TEXT)), "proteome")
    return src.read_fasta(v.spark, path, marker=">sp|").select("header", "seq")


@query("contig_lengths_from_fasta", "SELECT header AS contig, length FROM sequences")
def q_fasta_lengths(v):
    path = src.write_text(v.sequences.select(F.expr(FASTA_TEXT)), "fasta")
    return src.fasta_lengths(v.spark, path).select(F.col("header").alias("contig"), "length")


@query("fasta_export", "SELECT concat('>sampled_seq_', row_number() OVER (ORDER BY seq_id)) AS header, seq FROM sequences")
def q_fasta_export(v):
    named = numbered_rows(v.sequences, "seq_id").select(F.concat(F.lit(">sampled_seq_"), F.col("row") + 1).alias("header"), "seq")
    path = src.write_text(named.select(F.concat("header", F.lit("\n"), "seq")), "export")
    return src.read_fasta(v.spark, path).select(F.concat(F.lit(">"), "header").alias("header"), "seq")


@query("seq_normalise", "SELECT seq_id, upper(regexp_replace(replace(concat(lower(substr(seq, 1, 5)), '-', substr(seq, 6)), '-', ''), '[a-z]', '', 'g')) AS seq FROM sequences")
def q_seq_normalise(v):
    return v.sequences.select("seq_id", s.normalise_seq(F.expr("concat(lower(substring(seq, 1, 5)), '-', substring(seq, 6))")).alias("seq"))


@query("chain_id_extract", "SELECT seq_id, CASE WHEN seq_id % 2 = 0 THEN CAST(seq_id AS STRING) ELSE 'A' END AS chain FROM sequences")
def q_chain(v):
    header = F.expr("if(seq_id % 2 = 0, concat('sp|chain ', seq_id, '|x'), concat('plain ', seq_id))")
    return v.sequences.select("seq_id", s.chain_id(header).alias("chain"))


@query("truncate_sequence", "SELECT seq_id, substr(seq, 1, 100) AS seq FROM sequences")
def q_truncate(v):
    return v.sequences.select("seq_id", F.substring("seq", 1, 100).alias("seq"))


@query("output_stem", "SELECT page_id, regexp_replace(regexp_extract(split_part(split_part(url, '?', 1), '#', 1), '([^/]*)$', 1), '(.)[.][^.]*$', '\\1') AS stem FROM pages")
def q_stem(v):
    return v.pages.select("page_id", s.output_stem(F.substring_index(F.substring_index("url", "?", 1), "#", 1)).alias("stem"))


@query("length_order", "SELECT seq_id, length, row_number() OVER (ORDER BY length, seq_id) - 1 AS place FROM sequences")
def q_length_order(v):
    return s.length_order(v.sequences).select("seq_id", "length", F.col("place").cast("long").alias("place"))


@query("token_batches", """WITH RECURSIVE o AS (SELECT seq_id, length, row_number() OVER (ORDER BY length, seq_id) AS rn FROM sequences),
b AS (SELECT rn, seq_id, length, CAST(0 AS BIGINT) AS batch, 1 AS c FROM o WHERE rn = 1
  UNION ALL SELECT o.rn, o.seq_id, o.length, CASE WHEN (b.c + 1) * o.length > 16384 THEN b.batch + 1 ELSE b.batch END, CASE WHEN (b.c + 1) * o.length > 16384 THEN 1 ELSE b.c + 1 END FROM b JOIN o ON o.rn = b.rn + 1)
SELECT seq_id, batch FROM b""")  # fmt: skip
def q_token_batches(v):
    return s.token_batches(v.sequences.select("seq_id", "length"), 16384).select("seq_id", "batch")


@query("mean_pool", """WITH x AS (SELECT seq_id, token_pos, vec, min(token_pos) OVER (PARTITION BY seq_id) AS lo, max(token_pos) OVER (PARTITION BY seq_id) AS hi FROM token_vectors),
d AS (SELECT seq_id, unnest(range(len(vec))) AS i, unnest(vec) AS v FROM x WHERE token_pos > lo AND token_pos < hi)
SELECT seq_id, i, round(avg(CAST(v AS DOUBLE)), 6) AS v FROM d GROUP BY 1, 2""")  # fmt: skip
def q_mean_pool(v):
    return r6(s.mean_pool(v.token_vectors).select("seq_id", F.posexplode("vec").alias("i", "v")).withColumn("i", F.col("i").cast("long")), "v")


@query("avg_log_likelihood", f"SELECT seq_id, round(avg(logp), 6) AS avg_log_likelihood, round(avg(-logp) FILTER (designed), 6) AS score, round(avg(-logp), 6) AS global_score FROM {RES} GROUP BY seq_id")
def q_likelihood(v):
    return r6(s.likelihoods(v.residue_logp), "avg_log_likelihood", "score", "global_score")


@query("score_csv_export", f"SELECT seq_id, round(avg(logp), 6) AS avg_log_likelihood FROM {RES} GROUP BY seq_id")
def q_score_csv(v):
    path = src.scratch_path(v.spark, "scores")
    r6(s.likelihoods(v.residue_logp), "avg_log_likelihood").select("seq_id", "avg_log_likelihood").write.option("header", True).csv(path)
    return v.spark.read.schema("seq_id long, avg_log_likelihood double").option("header", True).csv(path)


@query("seq_recovery", f"SELECT a.seq_id, round(avg(CASE WHEN a.residue = b.residue THEN 1.0 ELSE 0.0 END), 6) AS recovery FROM {RES} a JOIN {RES} b ON b.seq_id = a.seq_id + 1 AND a.pos = b.pos WHERE a.designed GROUP BY a.seq_id")
def q_recovery(v):
    native = v.residue_logp.select((F.col("seq_id") - 1).alias("seq_id"), "pos", F.col("residue").alias("native"))
    return r6(s.recovery(v.residue_logp, native), "recovery")


@query("mean_confidence", f"SELECT seq_id, round(avg(100 * exp(logp)), 6) AS plddt FROM {RES} GROUP BY seq_id")
def q_confidence(v):
    return r6(v.residue_logp.groupBy("seq_id").agg(F.avg(100 * F.exp("logp")).alias("plddt")), "plddt")


@query("position_profile", f"""WITH c AS (SELECT pos, residue, count(*) AS n FROM {RES} GROUP BY 1, 2), b AS (SELECT residue, count(*) AS m FROM {RES} GROUP BY 1), t AS (SELECT count(*) AS t FROM {RES})
SELECT pos, c.residue, round(n / sum(n) OVER (PARTITION BY pos), 6) AS freq, round(ln(n / sum(n) OVER (PARTITION BY pos) / (m / t)), 6) AS log_odds, round(0.8 * n / sum(n) OVER (PARTITION BY pos) + 0.2 * m / t, 6) AS blended FROM c JOIN b USING (residue), t""")  # fmt: skip
def q_profile(v):
    return r6(s.position_profile(v.residue_logp, 0.2), "freq", "log_odds", "blended")


@query("residue_bias", f"""WITH m AS (SELECT residue, avg(logp) + CASE WHEN residue = 'click' THEN 0.5 ELSE 0 END AS l FROM {RES} WHERE residue <> 'view' GROUP BY residue)
SELECT residue, round(exp(l) / sum(exp(l)) OVER (), 6) AS p FROM m""")  # fmt: skip
def q_bias(v):
    return r6(s.biased(v.residue_logp, {"click": 0.5}, ("view",)), "p")


@query("length_stats", "SELECT count(*) AS n, CAST(sum(length) AS BIGINT) AS total, round(avg(length), 6) AS mean FROM sequences")
def q_length_stats(v):
    return r6(v.sequences.agg(F.count("*").alias("n"), F.sum("length").alias("total"), F.avg("length").alias("mean")), "mean")


@query("complex_assembly", "SELECT grp, row_number() OVER (PARTITION BY grp ORDER BY seq_id) - 1 AS chain_no, seq_id, CAST(0 AS BIGINT) AS first_residue, length - 1 AS last_residue, count(*) OVER (PARTITION BY grp) AS n_chains, CAST(sum(length) OVER (PARTITION BY grp) AS BIGINT) AS n_residues FROM sequences")
def q_complex(v):
    return s.complexes(v.sequences)


@query("variant_effect_score", f"""WITH x AS (SELECT a.seq_id, a.pos, a.residue AS wild, b.residue AS mutant FROM {RES} a JOIN {RES} b ON b.seq_id = a.seq_id + 1 AND a.pos = b.pos WHERE a.residue <> b.residue)
SELECT x.seq_id, round(sum(m.logp - w.logp), 6) + 0.0 AS effect FROM x JOIN residue_table m ON m.seq_id = x.seq_id AND m.pos = x.pos AND m.residue = mutant JOIN residue_table w ON w.seq_id = x.seq_id AND w.pos = x.pos AND w.residue = wild GROUP BY x.seq_id""")  # fmt: skip
def q_variant_effect(v):
    other = v.residue_logp.select((F.col("seq_id") - 1).alias("seq_id"), "pos", F.col("residue").alias("mutant"))
    variants = v.residue_logp.select("seq_id", "pos", F.col("residue").alias("wild")).join(other, ["seq_id", "pos"]).where("wild <> mutant")
    return r6(s.variant_effect(v.residue_table, variants), "effect")


@query("position_mask_join", f"SELECT seq_id, chain, pos, pos % 5 = 0 AS fixed FROM {RES}")
def q_mask(v):
    listed = v.residue_logp.where("pos % 5 = 0").select("seq_id", "chain", "pos")
    rows = v.residue_logp.select("seq_id", "chain", "pos")
    return s.fixed_positions(rows, listed).withColumn("fixed", F.lit(True)).unionByName(s.fixed_positions(rows, listed, True).withColumn("fixed", F.lit(False)))


@query("tied_position_join", f"WITH x AS (SELECT seq_id, chain, pos, CAST(row_number() OVER (PARTITION BY seq_id, chain ORDER BY pos) AS INT) AS tie FROM {RES}) SELECT seq_id, tie, string_agg(concat(chain, pos), ',' ORDER BY chain, pos) AS members FROM x GROUP BY 1, 2")
def q_tied(v):
    return s.tied_positions(v.residue_logp)


WORD = 12


@query("sequence_db_search", f"""WITH a AS (SELECT seq_id, seq, unnest(range(0, greatest(0, length - {WORD - 1}))) AS a FROM sequences), k AS (SELECT DISTINCT seq_id, substr(seq, a + 1, {WORD}) AS k FROM a),
n AS (SELECT seq_id, count(*) AS n FROM k GROUP BY 1),
h AS (SELECT q.seq_id AS query, d.seq_id AS target, count(*) AS shared FROM k q JOIN k d USING (k) WHERE q.seq_id % 100 = 0 AND q.seq_id <> d.seq_id GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY shared DESC, target) AS INT) AS rank FROM h)
SELECT query, target, shared, round(shared / a.n, 6) AS containment, round(shared / (a.n + b.n - shared), 6) AS jaccard, rank FROM r JOIN n a ON a.seq_id = query JOIN n b ON b.seq_id = target WHERE rank <= 3""")  # fmt: skip
def q_search(v):
    sequences = v.sequences.select(F.col("seq_id").alias("id"), "seq")
    return r6(s.search_database(sequences.where("id % 100 = 0"), sequences, WORD), "containment", "jaccard")


@query("keep_list_semi_join", "SELECT seq_id FROM (SELECT seq_id, row_number() OVER (ORDER BY length, seq_id) - 1 AS place FROM sequences) s WHERE place IN (SELECT item_id FROM benchmark)")
def q_keep_list(v):
    return s.length_order(v.sequences).join(v.benchmark.select(F.col("item_id").alias("place")), "place", "left_semi").select("seq_id")


@query("grouped_kfold", "SELECT seq_id, grp, CAST((dense_rank() OVER (ORDER BY grp) - 1) % 5 AS INT) AS fold FROM sequences")
def q_kfold(v):
    return s.grouped_folds(v.sequences, "grp").select("seq_id", "grp", "fold")


@query("annotation_tsv_ingest", "SELECT seq_id, label, start_pos, end_pos FROM annotations")
def q_tsv_in(v):
    path = src.scratch_path(v.spark, "annotations")
    v.annotations.write.option("sep", "\t").option("header", True).csv(path)
    return src.read_tsv(v.spark, path, "seq_id long, label string, start_pos int, end_pos int", ("label", "start_pos", "end_pos"))


@query("annotation_tsv_export", "SELECT concat(label, chr(9), start_pos, chr(9), end_pos) AS line FROM annotations")
def q_tsv_out(v):
    path = src.scratch_path(v.spark, "annotations")
    v.annotations.select("label", "start_pos", "end_pos").write.option("sep", "\t").csv(path)
    return src.read_lines(v.spark, path).select("line")


@query("first_sequence_length", "SELECT p.seq_id, CAST(coalesce(max(end_pos), 100) AS INT) AS length FROM (SELECT DISTINCT user_id + 1 AS seq_id FROM events) p LEFT JOIN annotations a ON a.seq_id = p.seq_id GROUP BY p.seq_id")
def q_first_length(v):
    wanted = v.events.select((F.col("user_id") + 1).alias("seq_id")).distinct()
    return wanted.join(v.annotations, "seq_id", "left").groupBy("seq_id").agg(F.coalesce(F.max("end_pos"), F.lit(100)).alias("length"))


@query("fold_step_count", "SELECT seq_id, CAST(greatest(1, floor(length / 16)) AS BIGINT) AS steps FROM sequences")
def q_steps(v):
    return v.sequences.select("seq_id", F.greatest(F.lit(1), F.floor(F.col("length") / 16)).cast("long").alias("steps"))


@query("replicate_inputs", "SELECT seq_id, CAST(i AS INT) AS copy FROM sequences, range(1, 9) t(i)")
def q_replicate(v):
    good = s.fail_on_errors(v.sequences.withColumn("error", F.expr("if(length < 0, 'bad', null)")), "error", "seq_id")
    return s.replicate(good, 8).select("seq_id", "copy")


@query("text_line_exclude", "SELECT doc_id, length(text) - length(replace(text, chr(10), '')) + 1 AS n_lines, CAST(len(list_filter(string_split(text, chr(10)), lambda x: NOT contains(x, 'the'))) AS BIGINT) AS kept FROM documents")
def q_exclude(v):
    lines = v.documents.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_if(~F.col("line").contains("the")).alias("kept"))


@query("constraint_ingest", f"SELECT concat('s', seq_id) AS name, chain, pos FROM {RES} WHERE pos % 5 = 0")
def q_constraints(v):
    chains = v.residue_logp.where("pos % 5 = 0").groupBy("seq_id", "chain").agg(F.sort_array(F.collect_list("pos")).alias("places"))  # a design's positions are one line
    maps = chains.groupBy("seq_id").agg(F.map_from_entries(F.collect_list(F.struct("chain", "places"))).alias("m"))
    path = src.write_text(maps.select(F.to_json(F.create_map(F.concat(F.lit("s"), "seq_id"), "m"))), "constraints")
    return src.read_constraints(v.spark, path)
