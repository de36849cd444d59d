"""Approximate neighbours: a graph of neighbours that is refined by neighbours of neighbours.

Rows start with the nearest of small groups that lie on one side of random hyperplanes. In each round the members of a row's list and
of those that list it meet each other, if one of the two is new there, and every row keeps the nearest it has met. What is
compared and shuffled grows with rows x list length squared, not with pairs of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.accumulators import Accumulator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.operators.scratch import kept_table
from helixframe.operators.vectors import knn, knn_params

#: Rows of a starting group, trees of groups, rounds at most, and the share of new list entries below which it ends.
GROUP, TREES, ROUNDS, SETTLED = 48, 3, 20, 0.001
#: Rows up to which choose_neighbours() compares all pairs.
EXACT_ROWS = 200_000


def _meet(rows: DataFrame, tally: Accumulator | None) -> DataFrame:
    """(src, dst, d2) of members that meet and are nearer than the source's radius. rows: (members) of (id, fresh, radius, vec)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            all_ids, fresh, radius, vecs = (lists.flatten().field(n) for n in ("id", "fresh", "radius", "vec"))
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            all_ids, radius, fresh = all_ids.to_numpy(), radius.to_numpy(), fresh.to_numpy(zero_copy_only=False)
            x = vecs.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(all_ids), -1) if len(all_ids) else np.zeros((0, 1))
            norms, out, seen = (x * x).sum(axis=1), [], 0
            for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
                ids, part, new = all_ids[a:b], x[a:b], fresh[a:b]
                asked = (new[:, None] | new[None, :]) & (ids[:, None] != ids[None, :])
                seen += int(asked.sum()) // 2
                square = np.round(np.maximum(norms[a:b, None] + norms[None, a:b] - 2 * part @ part.T, 0), 9)
                q, r = np.nonzero(asked & (square <= radius[a:b, None]))
                out.append((ids[q], ids[r], square[q, r]))
            if tally is not None:
                tally.add(seen)
            if out:
                yield pa.record_batch([np.concatenate(c) for c in zip(*out)], names=["src", "dst", "d2"])

    return rows.mapInArrow(compare, "src long, dst long, d2 double")


def _nearest(found: DataFrame, most: int) -> DataFrame:
    """The first `most` of each source; an entry that was there before is not new."""
    once = found.groupBy("src", "dst").agg(F.min("d2").alias("d2"), F.min("fresh").alias("fresh"))
    rank = F.row_number().over(Window.partitionBy("src").orderBy("d2", "dst"))
    return once.withColumn("rank", rank).where(F.col("rank") <= most)


def _starting_groups(rows: DataFrame, n: int, seed: int) -> DataFrame:
    """(code, id, vec): rows by the sides of random hyperplanes they lie on; groups that are too large are dealt by hash."""
    d = rows.select(F.max(F.size("vec"))).first()[0]
    mean = rows.select(F.posexplode("vec").alias("d", "x")).groupBy("d").agg(F.avg("x").alias("m")).orderBy("d").toPandas()["m"].to_numpy()
    bits = max(0, int(np.ceil(np.log2(max(1, n) / GROUP))))
    planes = np.random.default_rng(seed).standard_normal((TREES, bits, d))

    @F.pandas_udf("array<long>")
    def sides(vecs: pd.Series) -> pd.Series:
        x = np.stack(vecs.to_list()) - mean
        codes = [(((x @ p.T) > 0) << np.arange(bits)).sum(axis=1).astype("int64") * TREES + t for t, p in enumerate(planes)]
        return pd.Series(list(np.stack(codes, axis=1)))

    coded = kept_table(rows.select("id", "vec", F.explode(sides("vec")).alias("code")), "codes")
    sizes = coded.groupBy("code").agg(F.ceil(F.count("*") / (2 * GROUP)).alias("parts"))
    return coded.join(sizes, "code").select("code", F.pmod(F.xxhash64("id", "code"), "parts").alias("part"), "id", "vec")


def knn_approx(vectors: DataFrame, k: int, width: int | None = None, seed: int = 7, tally: Accumulator | None = None) -> DataFrame:
    """(src, dst, d, rank) of k near rows by Euclidean distance, the row itself first; ties by id.

    Lists are `width` long while they are refined (k + 5 if not given): a longer one finds more and compares more. Rows whose vector is
    null take no part; ids are distinct. Copies of one vector may fill each other's lists, as they do in the exact result.
    tally, if given, counts the comparisons. A row lists itself and fewer than k others only where the table is that small.
    """
    rows = kept_table(vectors.where("vec is not null").select("id", "vec"), "rows")  # in their own type: each round sends them
    n = rows.count()
    width = min(width or k + 5, max(n - 1, 1))

    def member(fresh: Column, radius: Column) -> Column:
        return F.collect_list(F.struct("id", fresh.alias("fresh"), radius.alias("radius"), "vec")).alias("members")

    itself = rows.select(F.col("id").alias("src"), F.col("id").alias("dst"), F.lit(0.0).alias("d"), F.lit(1).alias("rank"))
    if n < 2:
        return itself
    met = _meet(_starting_groups(rows, n, seed).groupBy("code", "part").agg(member(F.lit(True), F.lit(float("inf")))).select("members"), tally)
    near = kept_table(_nearest(met.withColumn("fresh", F.lit(True)), width), "near")
    for _ in range(ROUNDS):
        forward = near.select(F.col("src").alias("pivot"), F.col("dst").alias("id"), "fresh")
        # A row that many list meets the new ones first, and of the others some by hash; the rest it may still meet elsewhere.
        order = F.row_number().over(Window.partitionBy("pivot").orderBy(F.desc("fresh"), F.xxhash64("id", "pivot"), "id"))
        back = near.select(F.col("dst").alias("pivot"), F.col("src").alias("id"), "fresh").withColumn("o", order).where(F.col("o") <= width).drop("o")
        both = forward.union(back).groupBy("pivot", "id").agg(F.max("fresh").alias("fresh"))
        radius = near.groupBy("src").agg(F.when(F.count("*") >= width, F.max("d2")).otherwise(float("inf")).alias("radius"))
        known = rows.join(radius, rows["id"] == radius["src"], "left").select("id", "vec", F.coalesce("radius", F.lit(float("inf"))).alias("radius"))
        met = _meet(both.join(known, "id").groupBy("pivot").agg(member(F.col("fresh"), F.col("radius"))).select("members"), tally)
        near = kept_table(_nearest(near.select("src", "dst", "d2", F.lit(False).alias("fresh")).union(met.withColumn("fresh", F.lit(True))), width), "near")
        if near.where("fresh").count() <= SETTLED * n * width:
            break
    return itself.union(near.where(F.col("rank") < k).select("src", "dst", F.sqrt("d2").alias("d"), F.col("rank") + 1))


def choose_neighbours(vectors: DataFrame, k: int, method: str = "umap", exact_rows: int = EXACT_ROWS) -> DataFrame:
    """(src, dst, d, rank): k as knn_params() has it, all pairs up to exact_rows rows and the refined graph beyond."""
    n = vectors.count()
    k = knn_params(n, k, method)
    return knn(vectors, k) if n <= exact_rows else knn_approx(vectors, k)
