"""Exact top-k inner products by distributed histogram selection.

Every query is scored against every row: blocks of queries meet blocks of rows on executors. Each pass counts scores in bins of
each query's current range; adding up the bins from the top shows the bin that holds the kth value, which becomes the next range, until
a bin is one integer wide. All queries are refined in the same passes, and their ranges stay a table. The last pass keeps what lies
at or above the kth value and breaks ties at it by the smaller id.

A pair of blocks reports only its topmost bins up to k scores: the kth value of all rows can't lie below the kth of some. The last
pass likewise sends at most k rows of a pair for a query. Both bounds hold whatever repeats, and neither drops a result.

Vectors that are null or hold null or non-finite components take no part. Rows are rows: a repeated candidate is
listed as often as it occurs (ties by id), but a row never answers a query of its own id, and a repeated query asks once.
Vectors of different lengths are compared as if the shorter one went on with zeros; of any length, they are read whole. Rows without id
take no part, an empty table gives no rows, further columns are ignored whatever their names. Where a score could pass 64 bits, there is an
OverflowError before any is computed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.llm.common import materialise, read_table

K, QUERY_MODULUS, SCALE = 5, 50, 256
#: Queries and rows of a block and bytes of their components, bins of a range in one pass, queries and rows scored at once.
BLOCK, ROW_BLOCK, BLOCK_BYTES, BINS, PIECE = 8192, 65536, 32 << 20, 1024, 1024
OWN = np.iinfo(np.int64).min


def quantised(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, v): components as floor(scale * x); only vectors that are whole and finite."""
    numbers = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    whole = F.col(vector_col).isNotNull() & F.forall(F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(F.col(id_col).isNotNull() & whole).select(F.col(id_col).cast("long").alias("id"), numbers.alias("v"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, cut or filled with zeros to the width."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), width), np.int64)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    fits = at < width
    out[np.repeat(np.arange(len(sizes)), sizes)[fits], at[fits]] = flat[fits]
    return out


def _pieces(asked: pa.Table, rows: pa.Table, width: int, exact: bool) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Pieces of queries, the ids of some rows, and their scores (query by row), OWN where query and row are one. exact: floats hold the sums."""
    kind = np.float64 if exact else np.int64
    ids, vectors = asked.column("id").to_numpy(), matrix(asked.column("v"), width).astype(kind)
    names = rows.column("row_id").to_numpy()
    for at in range(0, rows.num_rows, PIECE):
        part = matrix(rows.column("row_v").slice(at, PIECE), width).astype(kind).T
        for q in range(0, len(ids), PIECE):
            some = slice(q, min(q + PIECE, len(ids)))
            scores = (vectors[some] @ part).astype(np.int64)
            scores[ids[some, None] == names[None, at : at + PIECE]] = OWN
            yield some, names[at : at + PIECE], scores


def _meet(asked: DataFrame, rows: DataFrame, query_blocks: int, row_blocks: int, f, schema: str) -> DataFrame:
    """f(queries, rows) of each block of queries and each block of rows."""
    left = asked.withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))
    right = rows.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    return left.groupBy("qb", "rb").cogroup(right.groupBy("qb", "rb")).applyInArrow(f, schema)


def top_k(rows: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best rows of each query; both tables: (id, v) as from quantised()."""
    largest = lambda df: df.agg(F.max(F.coalesce(F.array_max(F.transform("v", lambda x: F.abs(x))), F.lit(0))), F.max(F.size("v")), F.count("*"), F.sum(F.size("v"))).first()
    kept = materialise(rows.select(F.col("id").alias("row_id"), F.col("v").alias("row_v"), F.monotonically_increasing_id().alias("at")), "topk-rows")
    asked = materialise(queries.groupBy("id").agg(F.min("v").alias("v")), "topk-queries")
    (most_row, width_r, n_rows, size_r), (most_query, width_q, n_queries, size_q) = largest(kept.withColumnRenamed("row_v", "v")), largest(asked)
    width = max(1, min(width_r or 0, width_q or 0))
    limit = int(most_row or 0) * int(most_query or 0) * width
    if limit >= 1 << 62:
        raise OverflowError("scores may pass 64 bits")
    exact = limit < 1 << 53
    blocks_of = lambda n, most, numbers: max(1, -(-n // most), -(-8 * (numbers or 0) // BLOCK_BYTES))
    row_blocks, query_blocks = blocks_of(n_rows, ROW_BLOCK, size_r), blocks_of(n_queries, BLOCK, size_q)
    blocks = kept.select("row_id", "row_v", F.pmod(F.xxhash64("at"), F.lit(row_blocks)).cast("int").alias("rb"))  # whatever repeats
    start = (F.lit(x).cast("long").alias(n) for n, x in (("low", -limit), ("top", limit + 1), ("above", 0)))
    state = materialise(asked.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int").alias("qb"), *start), "topk-ranges")

    def count(a: pa.Table, b: pa.Table) -> pa.Table:
        low, top = a.column("low").to_numpy(), a.column("top").to_numpy()
        step = np.maximum(1, -(-(top - low) // BINS))
        best = np.full((len(low), k), -1, np.int64)
        for q, _, scores in _pieces(a, b, width, exact) if len(low) else ():
            bins = np.where((scores >= low[q, None]) & (scores < top[q, None]), (scores - low[q, None]) // step[q, None], -1)
            both = np.concatenate([best[q], bins], axis=1)
            best[q] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
        pairs, held = np.unique(np.nonzero(best >= 0)[0] * BINS + best[best >= 0], return_counts=True)
        return pa.table({"of": pa.array(a.column("id").to_numpy()[pairs // BINS], pa.int64()), "bin": pa.array(pairs % BINS, pa.int64()), "n": pa.array(held, pa.int64())})

    wide = "top - low > 1"
    while not state.where(wide).isEmpty():
        asking = state.where(wide)
        sums = _meet(asking, blocks, query_blocks, row_blocks, count, "of long, bin long, n long").groupBy("of", "bin").agg(F.sum("n").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("of").orderBy(F.desc("bin")))
        ranges = state.select(F.col("id").alias("of"), F.col("above").alias("so_far"))
        kth = sums.withColumn("upto", upto).join(ranges, "of").where(f"upto + so_far >= {k} and upto - n + so_far < {k}").select("of", "bin", (F.col("upto") - F.col("n") + F.col("so_far")).alias("beyond"))
        step = F.greatest(F.lit(1), F.expr(f"(top - low) div {BINS} + if((top - low) % {BINS} > 0, 1, 0)"))
        moved = asking.join(kth, F.col("id") == F.col("of"), "left").withColumn("step", step.cast("long")).withColumn("begin", F.col("low") + F.col("bin") * F.col("step"))
        # Without a kth value there are fewer than k scores in all: everything is kept.
        none = F.col("bin").isNull()
        low = F.when(none, F.lit(-limit)).otherwise(F.col("begin"))
        top = F.when(none, F.lit(-limit + 1)).otherwise(F.least("top", F.col("begin") + F.col("step")))
        refined = moved.select("id", "v", "qb", low.cast("long").alias("low"), top.cast("long").alias("top"), F.coalesce("beyond", F.lit(0)).cast("long").alias("above"))
        state = materialise(state.where(f"not ({wide})").unionByName(refined), "topk-ranges")

    def select(a: pa.Table, b: pa.Table) -> pa.Table:
        ids, low = a.column("id").to_numpy(), a.column("low").to_numpy()
        held = [np.zeros(0, np.int64)] * 3
        for q, names, scores in _pieces(a, b, width, exact) if len(ids) else ():
            i, j = np.nonzero((scores >= low[q, None]) & (scores != OWN))
            held = [np.concatenate(x) for x in zip(held, (i + q.start, names[j], scores[i, j]))]
            order = np.lexsort((held[1], -held[2], held[0]))
            held = [x[order] for x in held]
            place = np.arange(len(order)) - np.searchsorted(held[0], held[0])
            held = [x[place < k] for x in held]
        return pa.table({"query_id": pa.array(ids[held[0]], pa.int64()), "vec_id": pa.array(held[1], pa.int64()), "score": pa.array(held[2], pa.int64())})

    found = _meet(state, blocks, query_blocks, row_blocks, select, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quantised(read_table(spark, sf_dir, "embeddings"))
    return top_k(rows, rows.where(F.col("id") % QUERY_MODULUS == 0))


ORACLE = f"""
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id % {QUERY_MODULUS} = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {K}
"""

QUERIES = {"op9_topk": op9_topk}
ORACLES = {"op9_topk": ORACLE}
