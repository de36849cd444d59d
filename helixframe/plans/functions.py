"""Queries of scalar functions, user functions and streams."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from helixframe.functions import scalars as sc
from helixframe.functions import udfs
from helixframe.operators.genome import reverse_complement
from helixframe.plans import genome
from helixframe.plans.views import query
from helixframe.streaming import routes


@query("scalar_functions", """SELECT seq_id, CAST(floor((length + 500) / 1000) * 1000 AS BIGINT) AS rounded, lpad(CAST(seq_id AS STRING), 5, '0') AS padded, substr(seq, 1, 16) AS barcode, substr(seq, 17, 10) AS umi,
reverse(translate(seq, 'ACGT', 'TGCA')) AS rc, repeat('_', CAST(length % 7 AS INT)) AS mask, round(ln(1 + length), 6) AS l1p, CAST(len(string_split(concat(substr(seq, 1, 4), '/', substr(seq, 5, 4)), '/')) AS INT) AS chains, CASE WHEN seq_id % 3 = 0 THEN 0.0 ELSE sqrt(length) END AS finite FROM sequences""")  # fmt: skip
def q_scalars(v):
    barcode, umi = sc.read_structure(F.col("seq"), "16C10M")
    return v.sequences.select(
        "seq_id", sc.bin_round(F.col("length"), 1000).alias("rounded"), sc.zero_padded(F.col("seq_id")).alias("padded"), barcode.alias("barcode"), umi.alias("umi"), reverse_complement(F.col("seq")).alias("rc"),
        sc.mask_run((F.col("length") % 7).cast("int")).alias("mask"), F.round(F.log1p("length"), 6).alias("l1p"), F.size(sc.split_chains(F.concat(F.substring("seq", 1, 4), F.lit("/"), F.substring("seq", 5, 4)))).alias("chains"),
        sc.nan_to_num(F.when(F.col("seq_id") % 3 == 0, F.lit(float("nan"))).otherwise(F.sqrt("length"))).alias("finite"),
    )


@query("residue_ranges", "SELECT seq_id, 'A' AS chain, CAST(p AS INT) AS pos FROM sequences, range(0, 1000) t(p) WHERE p BETWEEN seq_id % 50 AND seq_id % 50 + 4 UNION ALL SELECT seq_id, 'B', 7 FROM sequences")
def q_ranges(v):
    text = F.concat(F.lit("A"), F.col("seq_id") % 50, F.lit("-"), F.col("seq_id") % 50 + 4, F.lit("/0 B7-7"))
    return v.sequences.select("seq_id", F.explode(sc.expand_ranges(text)).alias("r")).select("seq_id", "r.chain", "r.pos")


@query("user_metric", "SELECT a.id AS src, round(list_sum(list_transform(list_zip(a.vec, b.vec), lambda p: abs(CAST(p[1] AS DOUBLE) - CAST(p[2] AS DOUBLE)))), 6) AS d FROM vectors a JOIN vectors b ON b.id = a.id + 1")
def q_user_metric(v):
    manhattan = udfs.vector_metric(lambda a, b: np.abs(a - b).sum(axis=1))
    pairs = v.vectors.select(F.col("id").alias("src"), F.col("vec").alias("a"), (F.col("id") + 1).alias("dst")).join(v.vectors.select(F.col("id").alias("dst"), F.col("vec").alias("b")), "dst")
    return pairs.select("src", F.round(manhattan("a", "b"), 6).alias("d"))


@query("batch_model_scoring", """WITH k AS (SELECT seq_id, seq, unnest(range(0, greatest(0, length - 2))) AS a FROM sequences),
b AS (SELECT seq_id, (ascii(substr(seq, a + 1, 1)) * 961 + ascii(substr(seq, a + 2, 1)) * 31 + ascii(substr(seq, a + 3, 1))) % 97 AS b FROM k)
SELECT s.seq_id, round(coalesce(avg(b), 0), 6) AS score FROM sequences s LEFT JOIN b USING (seq_id) GROUP BY s.seq_id""")  # fmt: skip
def q_model(v):
    return udfs.score_in_batches(v.sequences, udfs.kmer_hash_scorer()).withColumn("score", F.round("score", 6))


KEYED = f"WITH {genome.PLACED}"


def keyed(v):
    return genome.g.global_positions(v.alignments, genome.starts(v)).select("name", "pos", "key")


@query("stream_bin_router", KEYED + " SELECT name, key, bin FROM binned")
def q_router(v):
    return routes.route_to_bins(routes.as_stream(keyed(v)), genome.bins(v)).select("name", "key", "bin")


CONSUMERS = 16


@query("stream_end_of_input", "SELECT mate AS producer, count(*) AS rows FROM reads GROUP BY mate")
def q_end(v):
    sent = v.reads.select("mate", F.pmod(F.xxhash64("sample", "ordinal"), F.lit(CONSUMERS)).alias("consumer"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("ordinal")).alias("at"))
    producers = [str(r[0]) for r in sent.select("mate").distinct().orderBy("mate").collect()]
    ended = routes.await_producers(routes.as_stream(routes.with_end_marks(sent, "consumer", "mate", "at")), producers, patience_s=10**9)
    return ended.where("ended").groupBy(F.col("producer").cast("int").alias("producer")).agg(F.sum("rows").alias("rows"))


@query("stream_mate_join", "SELECT a.sample, a.ordinal, a.seq AS seq1, b.seq AS seq2 FROM (SELECT * FROM reads WHERE mate = 1) a JOIN (SELECT * FROM reads WHERE mate = 2) b ON a.sample = b.sample AND a.ordinal = b.ordinal")
def q_stream_mates(v):
    arrived = v.reads.withColumn("arrived", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("ordinal")))
    return routes.join_mates(routes.as_stream(arrived.where("mate = 1")), routes.as_stream(arrived.where("mate = 2")))


@query("stream_bin_sort", KEYED + " SELECT name, key, bin FROM binned")
def q_stream_sort(v):
    return routes.sort_bins(routes.as_stream(keyed(v)), genome.bins(v)).select("name", "key", "bin")


@query("stream_counts", KEYED + " SELECT bin, count(*) AS n FROM binned GROUP BY bin")
def q_stream_counts(v):
    return routes.running_counts(routes.as_stream(keyed(v)), genome.bins(v))
