"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

Each source's documents share one expected number of copies, target / source size. Its whole part is taken of every
document; the fractions are rounded together: two fractional documents move mass (words) from one to the other, in a random
direction that keeps both expectations, until one of them is whole. A group of documents folds to one residual at most;
the residuals of the groups are grouped and folded again, up a reduction tree, until a source has a single residual,
which is rounded alone. The words taken of a source so differ from its target by less than one document.

All randomness is a hash of ids, so that reruns agree whatever the partitioning. Documents are dealt to groups by
hash within their source: a source of any size is spread evenly. Rows that repeat id and source are one document, whose rows
get the same number of copies. Null sources are a source (the last one), null ids are allowed, null texts have size 0
and empty tables give no rows. The words of whole texts count, however long. Further columns are carried, whatever their names, or ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.llm.common import materialise, read_table, word_count

#: The weights of the sources in order of their names, and how often a document may be taken.
WEIGHTS, MOST_COPIES = (5, 2, 1), 3
#: Documents folded in one group, on average; what counts as whole.
GROUP, TINY = 64, 1e-9


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, target): all words shared by weight, no source above `most` times its size.

    Sources in order of the share at which they hit their bound are bounded first; what the bounded ones leave is shared by
    the others. One row per source, so that windows over all rows stay small.
    """
    everything = Window.partitionBy(F.lit(1))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    # Weight and rank are taken from a table of sources, after the words have been summed on all executors.
    rows = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rows = rows.withColumn("weight", F.get(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))).cast("double"))
    rows = rows.withColumn("bound", F.col("source_size") * F.lit(float(most)))
    by_bound = everything.orderBy(F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = by_bound.rowsBetween(Window.unboundedPreceding, -1), by_bound.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("bound").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / F.sum("weight").over(after))
    bounded = F.col("bound") / F.col("weight") <= F.col("level")
    rows = rows.withColumn("level", F.max(F.when(~bounded, F.col("level"))).over(everything)).withColumn("target", F.when(F.col("bound") / F.col("weight") <= F.coalesce("level", F.lit(float("inf"))), F.col("bound")).otherwise(F.col("level") * F.col("weight")))
    return rows.select("source", "source_size", "target")


_DOC = "struct<h:bigint,doc_id:bigint,size:bigint,p:double>"
_DONE = "array<struct<doc_id:bigint,copies:int>>"


def _fold(column: str) -> str:
    """SQL: folds an array of fractional documents to (carry, done); done: the documents that became 0 or 1 copy."""
    u = "(shiftrightunsigned(xxhash64(s.carry.h, x.h), 11) / 9007199254740992D)"
    up = "least(1D - s.carry.p, x.p * x.size / s.carry.size)"
    down = "least(s.carry.p, (1D - x.p) * x.size / s.carry.size)"
    # d: the change of the carry's fraction; its mass goes to or comes from x.
    step = f"transform(array(if({u} * ({up} + {down}) < {down}, {up}, -{down})), d -> struct(s.carry.p + d as p, x.p - d * s.carry.size / x.size as q))[0]"
    whole = lambda v: f"({v} < {TINY} or {v} > 1D - {TINY})"
    rounded = lambda doc, v: f"named_struct('doc_id', {doc}.doc_id, 'copies', cast(round({v}) as int))"
    keep = lambda doc, v: f"named_struct('h', {doc}.h, 'doc_id', {doc}.doc_id, 'size', {doc}.size, 'p', {v})"
    moved = (
        f"transform(array({step}), t -> named_struct("
        f"'carry', cast(case when not {whole('t.p')} then {keep('s.carry', 't.p')} when not {whole('t.q')} then {keep('x', 't.q')} end as {_DOC}),"
        f"'done', cast(concat(s.done, if({whole('t.p')}, array({rounded('s.carry', 't.p')}), array()), if({whole('t.q')}, array({rounded('x', 't.q')}), array())) as {_DONE})))[0]"
    )
    state = f"struct<carry:{_DOC},done:{_DONE}>"
    start = f"cast(named_struct('carry', cast(null as {_DOC}), 'done', cast(array() as {_DONE})) as {state})"
    return f"aggregate({column}, {start}, (s, x) -> cast(if(s.carry is null, named_struct('carry', cast(x as {_DOC}), 'done', s.done), {moved}) as {state}))"


def round_fractions(documents: DataFrame, group: int = GROUP) -> DataFrame:
    """(doc_id, source, copies): 0 or 1 for each fractional document of (doc_id, source, size, p), with 0 < p < 1 and size > 0."""
    work, done, level = documents, None, 0
    while True:
        counts = work.groupBy("source").agg(F.count("*").alias("n"))
        largest = counts.agg(F.max("n")).first()[0] or 0
        # The hash carries on from level to level in each document, so that residuals meet in new groups.
        h = F.xxhash64("doc_id", "source", F.lit(level))
        bucket = F.pmod(h, F.greatest(F.lit(1), F.ceil(F.col("n") / group)).cast("long"))
        dealt = work.withColumn("h", h).join(counts.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).withColumn("bucket", bucket)
        gathered = dealt.groupBy("source", "bucket").agg(F.sort_array(F.collect_list(F.struct("h", "doc_id", "size", "p"))).alias("docs"))
        folded = materialise(gathered.select("source", F.expr(_fold("docs")).alias("f")).select("source", "f.carry", "f.done"), "mixing-level")
        ready = folded.select("source", F.explode("done").alias("d")).select("d.doc_id", "source", "d.copies")
        done = ready if done is None else done.unionByName(ready)
        work = folded.where("carry is not null").select("carry.doc_id", "source", "carry.size", "carry.p")
        level += 1
        if largest <= group:
            break
    chance = F.shiftrightunsigned(F.xxhash64("doc_id", "source", F.lit(-1)), 11) / F.lit(float(1 << 53))
    return done.unionByName(work.select("doc_id", "source", (chance < F.col("p")).cast("int").alias("copies")))


def mix(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(doc_id, source, source_size, target, copies) for each document (id and source) of a table (doc_id, source, size)."""
    targets = materialise(source_targets(sizes, weights, most), "mixing-targets")
    documents = sizes.groupBy("doc_id", "source").agg(F.sum("size").alias("size"))
    rate = F.when(F.col("source_size") > 0, F.least(F.lit(float(most)), F.col("target") / F.col("source_size"))).otherwise(F.lit(0.0))
    joined = documents.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    rated = materialise(joined.withColumn("rate", rate).withColumn("whole", F.floor(F.col("rate") + TINY).cast("int")), "mixing-documents")
    p = F.col("rate") - F.col("whole")
    fractional = rated.where((p > TINY) & (F.col("size") > 0)).select("doc_id", "source", "size", p.alias("p"))
    rounded = round_fractions(fractional).toDF("__id", "__source", "extra")
    match = F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__source"))
    return rated.join(rounded, match, "left").select("doc_id", "source", "source_size", "target", (F.col("whole") + F.coalesce("extra", F.lit(0))).alias("copies"))


def sizes_of(docs: DataFrame) -> DataFrame:
    return materialise(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "mixing-sizes")


def mix_documents(docs: DataFrame) -> DataFrame:
    """The documents as often as the mix takes them; columns stay as they are."""
    copies = mix(sizes_of(docs)).where("copies > 0").select(F.col("doc_id").alias("id"), F.col("source").alias("of"), "copies")
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    column = dict(zip(docs.columns, numbered.columns))
    joined = numbered.join(copies, F.col(column["doc_id"]).eqNullSafe(F.col("id")) & F.col(column["source"]).eqNullSafe(F.col("of")))
    return joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*numbered.columns).toDF(*docs.columns)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = sizes_of(read_table(spark, sf_dir, "documents"))
    decisions = mix(sizes).toDF("__id", "__source", "source_size", "target", "copies")
    rows = sizes.join(decisions, F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__source")))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


QUERIES = {"op6_mixing": op6_mixing}
ORACLES: dict[str, str] = {}
