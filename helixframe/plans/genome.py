"""Queries over reads, alignments, contigs, bins and variants."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.operators import genome as g
from helixframe.operators.matrix import numbered_rows
from helixframe.plans.views import query
from helixframe.sources import fastq
from helixframe.sources import text as src

PRIMARY = 20
STARTS = """starts AS (SELECT ord, contig, length, coalesce(sum(length) OVER (ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s0 FROM contigs),
all_starts AS (SELECT ord, contig, length, CAST(s0 AS BIGINT) AS start_at FROM starts UNION ALL SELECT max(ord) + 1, '*', 0, CAST(sum(length) AS BIGINT) FROM contigs)"""
BINS = STARTS + """,
tot AS (SELECT sum(length) AS t FROM contigs),
aims AS (SELECT i, CAST(floor((i + 1) * t / 8) AS BIGINT) AS aim FROM range(8) r(i), tot),
near AS (SELECT i, aim, arg_min(s0, s0 + length) AS c0, min(s0 + length) AS c1 FROM aims JOIN starts ON s0 + length >= aim - 1000 GROUP BY i, aim),
ends AS (SELECT CAST(i AS INT) AS bin, CAST(CASE WHEN abs(aim - c1) <= 1000 THEN c1 ELSE c0 + floor((aim - c0 + 500) / 1000) * 1000 END AS BIGINT) AS end_pos FROM near),
gbins AS (SELECT bin, CAST(coalesce(lag(end_pos) OVER (ORDER BY bin), 0) AS BIGINT) AS start_pos, end_pos FROM ends)"""
PLACED = BINS + """,
placed AS (SELECT a.*, start_at + pos AS key FROM alignments a JOIN all_starts USING (contig)),
binned AS (SELECT p.*, (SELECT CAST(count(*) - 1 AS INT) FROM gbins WHERE start_pos <= p.key) AS bin FROM placed p)"""


def starts(v, primary=None, keep=True):
    return g.contig_starts(v.contigs, primary, keep)


def bins(v):
    return v.kept("bins", lambda: g.range_bins(v.kept("starts", lambda: starts(v))))


def binned(v):
    return g.with_bin(g.global_positions(v.alignments, starts(v)), bins(v))


@query("contig_table", "SELECT CAST(row_number() OVER (ORDER BY ord) - 1 AS INT) AS ord, contig, length FROM contigs")
def q_contig_table(v):
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("ord", "contig", "length"))), lambda c: F.concat(F.lit("@SQ\tSN:"), c["contig"], F.lit("\tLN:"), c["length"]))
    header = v.contigs.agg(F.array_join(ordered, "\n").alias("t"))  # a dictionary is one small header
    lines, _ = src.read_sam(v.spark, src.write_text(header, "header"))
    return src.contig_table(lines)


@query("sam_ingest", "SELECT name, contig, pos, mapq FROM alignments")
def q_sam(v):
    rows = v.alignments.select(F.concat_ws("\t", "name", F.when(F.col("contig") == "*", 4).otherwise(0), "contig", "pos", "mapq", F.lit("1M"), F.lit("*"), F.lit(0), F.lit(0), "base", F.lit("I")))
    _, found = src.read_sam(v.spark, src.write_text(rows, "sam"))
    return found.select("name", "contig", "pos", "mapq")


@query("fai_primary_contigs", f"SELECT contig, length, row_number() OVER (ORDER BY ord) <= {PRIMARY} AS is_primary FROM contigs")
def q_fai(v):
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("ord", "contig", "length"))), lambda c: F.concat_ws("\t", c["contig"], c["length"], F.lit("0\t60\t61")))
    path = src.write_text(v.contigs.agg(F.array_join(ordered, "\n").alias("t")), "fai")
    return src.read_fai(v.spark, path, PRIMARY).select("contig", "length", "is_primary")


READS_TEXT = "concat_ws('\n', concat('@', sample, ':', ordinal, ':', mate), seq, '+', qual)"


@query("fastq_ingest", "SELECT concat(sample, ':', ordinal, ':', mate) AS name, seq, qual FROM reads WHERE mate = 1")
def q_fastq(v):
    path = src.write_text(v.reads.where("mate = 1").select(F.expr(READS_TEXT)), "fastq")
    return fastq.read_fastq(v.spark, path, 1).select("name", "seq", "qual")


@query("barcode_sequence_lines", "SELECT seq AS line FROM reads WHERE mate = 2")
def q_barcode_lines(v):
    path = src.write_text(v.reads.where("mate = 2").select(F.expr(READS_TEXT)), "fastq")
    return src.read_lines(v.spark, path).where("ordinal % 4 = 1").select("line")


@query("read_list_check", "SELECT mate, count(*) AS n, count(*) % 8 AS remainder FROM reads GROUP BY mate")
def q_read_list(v):
    lists = [src.write_text(v.reads.where(F.col("mate") == m).select(F.concat(F.lit("sample_"), "sample", F.lit("_"), "ordinal", F.lit(f"_R{m}.fastq.gz"))), f"list{m}") for m in (1, 2)]
    return src.check_read_lists(*[src.read_lines(v.spark, p) for p in lists], 8).select(F.col("list").alias("mate"), "n", "remainder")


@query("shard_manifest_check", "SELECT i AS sample, m AS mate FROM range((SELECT max(sample) + 1 FROM reads)) r(i), (VALUES (1), (2)) x(m) WHERE NOT EXISTS (SELECT 1 FROM reads WHERE sample = i AND mate = m)")
def q_manifest(v):
    named = lambda sample, mate: F.concat(F.lit("shard_"), sample, F.lit("_R"), mate)
    path = src.scratch_path(v.spark, "shards")
    v.reads.select(named("sample", "mate").alias("shard"), "seq").repartition("shard").write.partitionBy("shard").text(path)
    last = v.reads.agg(F.max("sample").alias("m")).first()["m"]
    wanted = v.spark.range(last + 1).select(F.col("id").alias("sample"), F.explode(F.array(F.lit(1), F.lit(2))).alias("mate"))
    expected = wanted.withColumn("name", F.concat(F.lit("shard="), named("sample", "mate")))
    return src.missing_shards(v.spark, expected, src.list_files(v.spark, path)).select("sample", "mate")


@query("contig_cumulative_start", f"WITH {STARTS} SELECT ord, contig, length, start_at AS start FROM all_starts")
def q_starts(v):
    return starts(v)


@query("range_bins", f"WITH {BINS} SELECT bin, start_pos, end_pos FROM gbins")
def q_bins(v):
    return bins(v)


@query("bin_region_strings", f"""WITH {BINS}, pieces AS (SELECT bin, ord, contig, CAST(greatest(0, start_pos - s0) AS BIGINT) AS lo, CAST(least(length, end_pos - s0) AS BIGINT) AS hi FROM gbins JOIN starts ON s0 < end_pos AND s0 + length > start_pos)
SELECT bin, string_agg(concat(contig, ':', lo, '-', hi), ' ' ORDER BY ord) AS regions FROM pieces WHERE hi > lo GROUP BY bin""")  # fmt: skip
def q_regions(v):
    return g.bin_regions(bins(v), starts(v))


@query("contig_offset_join", f"WITH {STARTS} SELECT name, contig, pos, start_at + pos AS key FROM alignments JOIN all_starts USING (contig)")
def q_offsets(v):
    return g.global_positions(v.alignments, starts(v)).select("name", "contig", "pos", "key")


@query("bin_range_join", f"WITH {PLACED} SELECT name, key, bin FROM binned")
def q_bin_join(v):
    return binned(v).select("name", "key", "bin")


@query("drop_unmapped", f"SELECT name, contig, pos FROM alignments WHERE contig <> '*' AND contig IN (SELECT contig FROM contigs WHERE ord < {PRIMARY})")
def q_drop(v):
    return g.drop_unmapped(v.alignments, starts(v, PRIMARY, False)).select("name", "contig", "pos")


@query("read_group_tag", "SELECT name, 'RG1' AS rg, 'RGSN1' AS rg_sample FROM alignments")
def q_rg(v):
    return v.alignments.select("name", F.lit("RG1").alias("rg"), F.lit("RGSN1").alias("rg_sample"))


@query("coordinate_sort", f"WITH {PLACED} SELECT name, key, row_number() OVER (ORDER BY key, name) - 1 AS place FROM placed")
def q_sort(v):
    rows = g.global_positions(v.alignments, starts(v)).select("name", "key")
    return numbered_rows(rows, F.col("key").asc_nulls_last(), F.col("name").asc(), out="place")


def sorted_shards(v) -> str:
    rows = binned(v).select(F.col("bin").alias("shard"), "key", "name", F.concat_ws("\t", "name", "key").alias("line"))
    return src.write_shards(rows, ["key", "name"], "shards")


def shard_rows(lines, *columns):
    f = F.split("line", "\t")
    return lines.select(*columns, f[0].alias("name"), f[1].cast("long").alias("key"))


@query("sorted_shard_export", f"WITH {PLACED} SELECT bin, row_number() OVER (PARTITION BY bin ORDER BY key, name) - 1 AS place, name, key FROM binned")
def q_shard_export(v):
    lines = src.ordered_lines(v.spark, sorted_shards(v))
    first = lines.groupBy("shard").agg(F.min("place").alias("first"))
    return shard_rows(lines.join(first, "shard"), F.col("shard").alias("bin"), (F.col("place") - F.col("first")).alias("place"))


@query("sorted_shard_concat", f"WITH {PLACED} SELECT row_number() OVER (ORDER BY bin, key, name) - 1 AS place, name, key FROM binned")
def q_shard_concat(v):
    return shard_rows(src.ordered_lines(v.spark, src.concat_shards(v.spark, sorted_shards(v), "concat")), "place")


@query("flat_export", "SELECT name, contig, pos FROM alignments")
def q_flat(v):
    path = src.scratch_path(v.spark, "flat")
    v.alignments.withColumn("worker", F.spark_partition_id()).write.partitionBy("worker").parquet(path)
    return v.spark.read.parquet(path).select("name", "contig", "pos")


VARIANTS = """variants AS (SELECT bin AS shard, contig, pos, min(base) AS ref, max(base) AS alt FROM binned WHERE contig <> '*' GROUP BY bin, contig, pos)"""


VCF_HEADER = "#CONTIG\tPOS\tREF\tALT"


@query("vcf_shard_concat", f"""WITH {PLACED}, {VARIANTS} SELECT 0 AS place, '{VCF_HEADER}' AS line
UNION ALL SELECT row_number() OVER (ORDER BY shard, contig, pos), concat(contig, chr(9), pos, chr(9), ref, chr(9), alt) FROM variants""")  # fmt: skip
def q_vcf(v):
    rows = binned(v).where("contig <> '*'").groupBy(F.col("bin").alias("shard"), "contig", "pos").agg(F.min("base").alias("ref"), F.max("base").alias("alt"))
    path = src.write_shards(rows.withColumn("line", F.concat_ws("\t", "contig", "pos", "ref", "alt")), ["contig", "pos"], "variants", VCF_HEADER)
    return src.ordered_lines(v.spark, src.concat_shards(v.spark, path, "vcf", "#")).select("place", "line")


@query("mate_pair_join", "SELECT a.sample, a.ordinal, a.seq AS seq1, b.seq AS seq2 FROM (SELECT * FROM reads WHERE mate = 1) a JOIN (SELECT * FROM reads WHERE mate = 2) b ON a.sample = b.sample AND a.ordinal = b.ordinal")
def q_mates(v):
    return g.mate_pairs(v.reads.where("mate = 1"), v.reads.where("mate = 2"))


@query("barcode_whitelist_join", """WITH b AS (SELECT substr(seq, 1, 4) AS b FROM reads WHERE mate = 1), w AS (SELECT DISTINCT substr(seq, 1, 4) AS b FROM reads WHERE mate = 2),
x AS (SELECT 'FIRST_BP' AS orientation, b FROM b UNION ALL SELECT 'FIRST_BP_RC', reverse(translate(b, 'ACGT', 'TGCA')) FROM b)
SELECT o.orientation, CAST(count(w.b) AS BIGINT) AS hits FROM (VALUES ('FIRST_BP'), ('FIRST_BP_RC')) o(orientation) LEFT JOIN x ON x.orientation = o.orientation LEFT JOIN w ON x.b = w.b GROUP BY o.orientation""")  # fmt: skip
def q_barcodes(v):
    return g.barcode_orientation(v.reads.where("mate = 1").select(F.substring("seq", 1, 4).alias("barcode")), v.reads.where("mate = 2").select(F.substring("seq", 1, 4).alias("barcode")))


#: Letters of a seed, and more reads than a sample has, so that a sample and an ordinal make one number.
SEED, READS = 15, 1 << 32


@query("kmer_seed_join", f"""WITH k AS (SELECT sample * {READS} + ordinal AS id, mate, seq, unnest(range(0, greatest(0, length(seq) - {SEED - 1}))) AS a FROM reads), s AS (SELECT id, mate, a, substr(seq, a + 1, {SEED}) AS k FROM k),
votes AS (SELECT r.id AS read, c.id AS contig, CAST(c.a - r.a AS INT) AS diagonal, count(*) AS votes FROM s r JOIN s c ON r.k = c.k AND r.mate = 1 AND c.mate = 2 GROUP BY 1, 2, 3)
SELECT read, contig, diagonal, votes FROM (SELECT *, row_number() OVER (PARTITION BY read ORDER BY votes DESC, contig, diagonal) AS n FROM votes) v WHERE n = 1""")  # fmt: skip
def q_seeds(v):
    ids = v.reads.withColumn("id", F.col("sample") * READS + F.col("ordinal"))
    return g.seed_votes(ids.where("mate = 1").select("id", "seq"), ids.where("mate = 2").select("id", "seq"), SEED)


@query("pileup_counts", f"""WITH {BINS}, pieces AS (SELECT bin, contig, greatest(0, start_pos - s0) AS lo, least(length, end_pos - s0) AS hi FROM gbins JOIN starts ON s0 < end_pos AND s0 + length > start_pos),
x AS (SELECT contig, pos + i AS pos, substr(seq, CAST(i + 1 AS BIGINT), 1) AS base FROM alignments, range(3) t(i) WHERE contig <> '*'), c AS (SELECT contig, pos, base, count(*) AS n FROM x GROUP BY 1, 2, 3)
SELECT bin, c.contig, pos, CAST(sum(n) AS BIGINT) AS depth, CAST(sum(n) - max(n) AS BIGINT) AS n_alt, round((sum(n) - max(n)) / sum(n), 6) AS alt_fraction, string_agg(concat(base, ':', n), ',' ORDER BY base) AS alleles
FROM c JOIN pieces p ON p.contig = c.contig AND pos >= lo AND pos < hi GROUP BY 1, 2, 3""")  # fmt: skip
def q_pileup(v):
    return g.pileup(v.alignments, g.bin_pieces(bins(v), starts(v))).withColumn("alt_fraction", F.round("alt_fraction", 6))


@query("size_split", "SELECT seq_id, CAST(floor(coalesce(sum(length) OVER (ORDER BY seq_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) / 5000) AS BIGINT) AS file FROM sequences")
def q_size_split(v):
    return g.size_split(v.sequences.select("seq_id", "length"), "seq_id", F.col("length"), 5000).select("seq_id", "file")


@query("sample_n", "SELECT seq_id FROM sequences ORDER BY md5(concat('0:', seq_id)), seq_id LIMIT 50")
def q_sample(v):
    return g.sample_n(v.sequences.select("seq_id"), "seq_id", 50)
