"""SimHash near-duplicates: fingerprints, exact Hamming links by a vantage-point tree, and their components.

The tree's upper levels are built on a bounded sample of distinct fingerprints and decide which shard owns a
fingerprint. Every level measures Hamming distance to its vantage point on bits of its own, so that the triangle
bounds of the levels add up: a search with radius 3 may cross to the far side of a node only by spending the gap to the
threshold, and all gaps on its way together stay within 3. That keeps the number of shards that a fingerprint visits
polynomial in the depth. The sample shapes the shards, never the result: all pairs within the radius meet.

Exact copies are one fingerprint from the start. Shards return a spanning forest of their links, not the pairs.

Null, empty and blank texts have fingerprint zero, which links like any other. Null ids are allowed: they share in
links and never name a component unless all its ids are null. Repeated rows each get a row. Texts of any length are read whole, in
slices of shingles; an empty table gives no rows; further columns are carried or ignored whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from helixframe.llm import minhash
from helixframe.llm.common import give_back, materialise, read_table, slices, small_batches, split_words
from helixframe.operators.components import connected_components

RADIUS, SHINGLE, SEED = 3, 3, 42
#: Fingerprints per shard that the tree aims at, its depth at most, sampled fingerprints per shard.
SHARD_ROWS, MOST_LEVELS, SAMPLE_PER_SHARD = 2048, 16, 24
#: A shard with more fingerprints of its own is split into parts, each of which sees all visitors.
PART_ROWS = 16384
#: Rows of one fingerprint that one task joins; in very large tables as many as keep fewer than MOST_HOT fingerprints above that.
HOT_ROWS, MOST_HOT = 512, 1 << 20


def fingerprints(texts: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """The 64-bit fingerprint of each text."""
    words, counts = split_words(texts, lower=True)
    out = np.zeros(len(texts), np.uint64)
    lengths = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    joined = b" ".join(words.cast(pa.large_binary()).to_pylist())
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    ends = starts + lengths
    first = np.cumsum(counts) - counts
    digest = xxhash.xxh64_intdigest
    for i in np.flatnonzero(counts):
        a, n = int(first[i]), int(counts[i])
        width = min(n, shingle)
        ones, total = np.zeros(64, np.int64), n - width + 1
        for at in range(a, a + total, 1 << 16):
            to = min(at + (1 << 16), a + total)
            hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[at:to].tolist(), ends[at + width - 1 : to + width - 1].tolist())], np.uint64)
            ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        out[i] = np.packbits(2 * ones > total, bitorder="little").view(np.uint64)[0]
    return out


@pandas_udf(T.LongType())
def simhash(texts: pd.Series) -> pd.Series:
    column = pa.array(texts, pa.large_string(), from_pandas=True)
    batch = pa.record_batch([column], ["text"])
    found = [fingerprints(b.column(0)) for b in slices(batch, "text", 1 << 20)]
    give_back()
    return pd.Series(np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64))


def slice_masks(levels: int) -> np.ndarray:
    """For each level the bits that it measures on; disjoint, as equal as can be."""
    edges = np.linspace(0, 64, levels + 1).astype(int)
    return np.array([sum(1 << b for b in range(a, z)) for a, z in zip(edges, edges[1:])], np.uint64)


def build_tree(sample: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Vantage points and thresholds of a full binary tree in heap order; at most the threshold goes left."""
    points, limits = np.zeros(1 << levels, np.uint64), np.zeros(1 << levels, np.int8)
    masks = slice_masks(levels) if levels else []
    here = {1: sample}
    for level in range(levels):
        below = {}
        for node, rows in here.items():
            best = (9.0, np.uint64(0), 0)
            for v in rows[:: max(1, len(rows) // 6)][:6] if len(rows) else ():
                counts = np.bincount(np.bitwise_count((rows ^ v) & masks[level]), minlength=65) / len(rows)
                left = np.cumsum(counts)[:-1]
                cost = np.abs(left - 0.5) + 0.3 * (counts[:-1] + counts[1:])
                t = int(np.argmin(cost))
                best = min(best, (float(cost[t]), v, t))
            points[node], limits[node] = best[1], best[2]
            far = np.bitwise_count((rows ^ best[1]) & masks[level]) > best[2]
            below[2 * node], below[2 * node + 1] = rows[~far], rows[far]
        here = below
    return points, limits


def visits(values: np.ndarray, points: np.ndarray, limits: np.ndarray, levels: int, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shard, is home) of each shard that may hold something within the radius; the home shard has no gap."""
    masks = slice_masks(levels) if levels else []
    row, node, slack = np.arange(len(values)), np.ones(len(values), np.int64), np.full(len(values), radius)
    home = np.ones(len(values), bool)
    for level in range(levels):
        d = np.bitwise_count((values[row] ^ points[node]) & masks[level]).astype(np.int64)
        far = d > limits[node]
        gap = np.where(far, d - limits[node], limits[node] + 1 - d)
        cross = gap <= slack
        row, node, slack, home = (
            np.concatenate([row, row[cross]]),
            np.concatenate([2 * node + far, 2 * node[cross] + ~far[cross]]),
            np.concatenate([slack, slack[cross] - gap[cross]]),
            np.concatenate([home, np.zeros(int(cross.sum()), bool)]),
        )
    return row, node - (1 << levels), home


def forest(own: np.ndarray, others: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest, as (member, root), of the links among own and between own and others.

    One vantage point orders own by distance; a fingerprint is compared with the rings within the radius of its own ring.
    """
    everything = np.concatenate([own, others])
    label = np.arange(len(everything))
    if not len(own):
        return everything[:0], everything[:0]
    ring = np.bitwise_count(own ^ own[0]).astype(np.int64)
    order = np.argsort(ring, kind="stable")
    edges = np.searchsorted(ring[order], np.arange(66))
    asks = np.bitwise_count(everything ^ own[0]).astype(np.int64)
    for r in np.unique(asks):
        mine = order[edges[max(0, r - radius)] : edges[min(65, r + radius + 1)]]
        rows = np.flatnonzero(asks == r)
        step = max(1, (1 << 21) // max(1, len(mine)))
        for at in range(0, len(rows) if len(mine) else 0, step):
            part = rows[at : at + step]
            i, j = np.nonzero(np.bitwise_count(everything[part][:, None] ^ own[mine][None, :]) <= radius)
            a, b = part[i], mine[j]
            real = a != b
            _hook(label, a[real], b[real])
    member = np.flatnonzero(label != np.arange(len(label)))
    return everything[member], everything[label[member]]


def _hook(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the trees of a[i] and b[i]; labels stay roots."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(label, up := label[label]):
            label[:] = up


def shard_links(distinct: DataFrame, count: int, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Edges (src, dst) whose components are those of all pairs within the radius. distinct: one row per value of `fp`."""
    levels = min(MOST_LEVELS, max(0, ceil(log2(max(1, count) / shard_rows))))
    want = SAMPLE_PER_SHARD << levels
    thin = distinct.where(F.pmod(F.xxhash64("fp"), F.lit(max(1, count // want))) == 0).limit(2 * want) if levels else distinct.limit(0)
    sample = np.array([r[0] for r in thin.select("fp").collect()], np.int64).view(np.uint64)
    points, limits = build_tree(sample, levels)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                values = whole.column(0).slice(at, 4096).to_numpy(zero_copy_only=False).view(np.uint64)
                row, shard, home = visits(values, points, limits, levels, radius)
                own = np.empty(len(values), np.int64)
                own[row[home]] = shard[home]
                stay = home | (shard < own[row])  # a pair meets once: the other one of the two comes here
                yield pa.record_batch([pa.array(shard[stay]), pa.array(values[row[stay]].view(np.int64)), pa.array(home[stay])], ["shard", "fp", "home"])

    placed = distinct.select("fp").mapInArrow(assign, "shard long, fp long, home boolean")
    # A crowded shard is cut into parts by its own fingerprints; all its fingerprints visit each part.
    crowded = placed.where("home").groupBy("shard").count().where(F.col("count") > PART_ROWS).select("shard", F.ceil(F.col("count") / PART_ROWS).alias("parts"))
    parts = F.coalesce("parts", F.lit(1))
    dealt = (
        placed.join(crowded, "shard", "left")
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
        .select("shard", "part", "fp", (F.col("home") & (F.pmod(F.xxhash64("fp"), parts) == F.col("part"))).alias("home"))
    )

    def links(table: pa.Table) -> pa.Table:
        values = table.column("fp").to_numpy().view(np.uint64)
        home = table.column("home").to_numpy(zero_copy_only=False)
        member, root = forest(values[home], values[~home], radius)
        return pa.table({"src": member.view(np.int64), "dst": root.view(np.int64)})

    return dealt.groupBy("shard", "part").applyInArrow(links, "src long, dst long")


def near_duplicates(prints: DataFrame, id_col: str = "doc_id", fp_col: str = "fp", radius: int = RADIUS) -> DataFrame:
    """(fp, component, component_id, n) for each distinct fingerprint.

    component is the smallest fingerprint that can be reached over links, component_id the smallest id; n: rows of the fingerprint.
    """
    groups = materialise(prints.groupBy(F.col(fp_col).alias("fp")).agg(F.min(id_col).alias("least"), F.count("*").alias("n")), "simhash-groups")
    edges = materialise(shard_links(groups, groups.count(), radius), "simhash-links")
    joined = connected_components(edges).withColumnRenamed("node", "fp").join(groups, "fp")
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    linked = joined.join(least, "component").select("fp", "component", "component_id")
    return groups.join(linked, "fp", "left").select(
        "fp",
        F.coalesce("component", "fp").alias("component"),
        F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"),
        "n",
    )


def join_groups(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """rows with the columns of their fingerprint's group. The rows of a common fingerprint are dealt to several tasks by their hash,
    and its group is sent to each of them."""
    total = groups.agg(F.sum("n")).first()[0] or 0
    most = max(HOT_ROWS, total // MOST_HOT)
    hot = F.broadcast(groups.where(F.col("n") > most).select(F.col("fp").alias("hot_fp"), F.ceil(F.col("n") / most).alias("parts")))  # fewer than MOST_HOT rows
    parts = F.coalesce("parts", F.lit(1).cast("long"))
    dealt = rows.join(hot, F.col("fp") == F.col("hot_fp"), "left").withColumn("part", F.pmod(F.xxhash64(*rows.columns), parts)).drop("hot_fp", "parts")
    sent = groups.join(hot, F.col("fp") == F.col("hot_fp"), "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("hot_fp", "parts", "n")
    return dealt.join(sent, ["fp", "part"]).drop("part")


def deduplicate(docs: DataFrame, similarity: float | None = None, **how) -> DataFrame:
    """Keeps one row of each component: one of its smallest id (without ids: of its smallest fingerprint).

    similarity: texts whose five-word shingles have at least this Jaccard similarity are linked as well; how: reach and part of minhash.join_similar().
    Columns stay as they are, whatever their names. Of rows with the component's id, the one of the smallest fingerprint and then of
    the least hash of all columns stays; of rows that are the same in every column, one. Texts are fingerprinted once: rows
    are found again by the hash of their columns.
    """
    small_batches(docs.sparkSession)
    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    column = dict(zip(docs.columns, numbered.columns))
    row, doc_id, text = F.xxhash64(*numbered.columns), F.col(column["doc_id"]), F.col(column["text"])
    more = [] if similarity is None else [F.xxhash64(text).alias("variant"), minhash.signature(text).alias("signature")]
    prints = materialise(numbered.select(doc_id.alias("doc_id"), simhash(text).alias("fp"), row.alias("row"), *more), "simhash-prints")
    groups = near_duplicates(prints)
    if similarity is not None:
        groups = minhash.join_similar(numbered.select(text.alias("text")), prints, materialise(groups, "simhash-components"), similarity, **how)
    mine = join_groups(prints.select("doc_id", "fp", "row"), groups).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    owners = mine.groupBy("component").agg(F.min(F.struct("fp", "row", "doc_id")).alias("o")).select(F.col("o.row").alias("row"), F.coalesce("o.doc_id", F.lit(-1)).alias("id"))
    marked = numbered.withColumns({"row": row, "id": F.coalesce(doc_id, F.lit(-1))})
    rank = F.row_number().over(Window.partitionBy("row", "id").orderBy("row"))
    kept = marked.join(owners, ["row", "id"], "left_semi").withColumn("rank", rank).where("rank = 1")
    return kept.select(*numbered.columns).toDF(*docs.columns)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = read_table(spark, sf_dir, "documents")
    prints = materialise(docs.select("doc_id", simhash("text").alias("fp")), "simhash-prints")
    found = join_groups(prints, materialise(near_duplicates(prints), "simhash-components"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


QUERIES = {"op8_simhash": op8_simhash}
ORACLES: dict[str, str] = {}
