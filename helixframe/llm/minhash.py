"""Links between texts by the Jaccard similarity of their sets of five-word shingles: MinHash proposes, the sets confirm.

Each text has BANDS hashes of ROWS minima each; texts that share one are candidates. A pair of similarity 0.8 shares none
with a probability of 0.0002, a pair below 0.3 rarely shares one. No pair links unless the whole sets, compared exactly,
reach the similarity. Texts of fewer than five words are one shingle; null and blank texts have none and never link here.

A band's texts stand in an order of their own, and a text first meets the next ones of other groups within a reach: this joins
most of a large group by few comparisons, and what links have joined isn't compared again. Bands that hold more texts than the reach covers
and still several groups are then compared in full: every pair of texts of different groups that share a band is decided. Texts that hold too few shingles of other
groups to link to any are left out, and parts of bounded size meet in tasks that report links only. Blocks of equal texts enter as one text.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from helixframe.llm.common import give_back, materialise, slices, word_codes
from helixframe.operators.components import connected_components

SHINGLE, BANDS, ROWS, SEED = 5, 16, 4, 42
#: Rounds of links: (bands that are read, neighbours that a text meets in each). The first joins most of large groups cheaply.
REACH = ((4, 1), (BANDS, 6))

#: Shingles of a part of a band that is compared in full; shingles that make over 1/HOT_SHARE of all rows are broadcast.
PART, HOT_SHARE = 1 << 18, 1000
#: Bits of the map of wanted texts at most: 4 MB.
MAP_BITS = 1 << 25

_RNG = np.random.default_rng(SEED)
_FLIP = _RNG.integers(0, 1 << 64, BANDS * ROWS, np.uint64)
_TIMES = _RNG.integers(0, 1 << 64, BANDS * ROWS, np.uint64) | np.uint64(1)
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX
    return h ^ (h >> np.uint64(31))


def shingles(texts: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    codes, counts, words = word_codes(texts, lower=True)
    of_word = np.array([xxhash.xxh64_intdigest(w, SEED) for w in words.cast(pa.large_binary()).to_pylist()], np.uint64)
    hashes = of_word[codes] if len(codes) else np.zeros(0, np.uint64)
    rolled = np.zeros(max(0, len(hashes) - SHINGLE + 1), np.uint64)
    for k in range(SHINGLE if len(rolled) else 0):
        rolled = _mixed(rolled * _STEP + hashes[k : k + len(rolled)])
    out, first = [], np.cumsum(counts) - counts
    for a, n in zip(first.tolist(), counts.tolist()):
        if n >= SHINGLE:
            out.append(np.unique(rolled[a : a + n - SHINGLE + 1]))
        else:
            one = np.zeros(min(n, 1), np.uint64)
            for k in range(n):
                one = _mixed(one * _STEP + hashes[a + k])
            out.append(one)
    return out


def band_hashes(sets: list[np.ndarray]) -> np.ndarray:
    """A row of BANDS hashes for each set; the sets aren't empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), BANDS), np.uint64)
    for band in range(BANDS):
        h = np.full(len(sets), band + 1, np.uint64)
        for k in range(band * ROWS, (band + 1) * ROWS):
            h = _mixed(h * _STEP + np.minimum.reduceat((flat ^ _FLIP[k]) * _TIMES[k], starts))
        out[:, band] = h
    return out


def _pieces(texts: pd.Series):
    batch = pa.record_batch([pa.array(texts, pa.large_string(), from_pandas=True)], ["text"])
    for piece in slices(batch, "text", 1 << 20):
        yield shingles(piece.column(0))
    give_back()


@pandas_udf(T.ArrayType(T.LongType()))
def signature(texts: pd.Series) -> pd.Series:
    """The number of distinct shingles and then the band hashes of each text; null for a text without words."""
    out: list = []
    for sets in _pieces(texts):
        full = [s for s in sets if len(s)]
        rows = iter(band_hashes(full).view(np.int64) if full else ())
        out += [np.concatenate([[len(s)], next(rows)]) if len(s) else None for s in sets]
    return pd.Series(out, dtype=object)


@pandas_udf(T.ArrayType(T.LongType()))
def shingle_set(texts: pd.Series) -> pd.Series:
    return pd.Series([s.view(np.int64) for sets in _pieces(texts) for s in sets], dtype=object)


def _texts_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(variant, text) of the wanted variants, each once.

    A map of at most MAP_BITS bits, in which each wanted variant sets one, keeps most other texts out of the shuffle, and copies of a
    text are put together before it. A full map lets all texts pass, which the join then sorts out.
    """
    bits = min(MAP_BITS, 64 * (wanted.count() // 4 + 1))
    place = F.pmod(F.col("variant"), F.lit(bits))
    filled = wanted.select(place.alias("p")).groupBy(F.shiftright("p", 6).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("word"))
    dense = filled.unionByName(wanted.sparkSession.range(bits // 64).select(F.col("id").alias("at"), F.lit(0).cast("long").alias("word"))).groupBy("at").agg(F.bit_or("word").alias("word"))
    words = materialise(dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]).alias("words")), "minhash-map")
    mapped = texts.withColumn("__words", words.select("words").scalar())
    hit = F.getbit(F.get("__words", F.shiftright(place, 6).cast("int")), place.bitwiseAND(F.lit(63)).cast("int")) == 1
    return mapped.where(hit).select("variant", "text").dropDuplicates(["variant"]).join(wanted, "variant", "left_semi")


def _candidates(labelled: DataFrame, bands: int, reach: int, similarity: float) -> DataFrame:
    """Distinct pairs (a, la, b, lb) of texts and their groups' labels that share a band hash and have other labels."""
    rows = labelled.select("variant", "label", "n", F.explode(F.slice("bands", 1, bands)).alias("band"))
    here = Window.partitionBy("band").orderBy(F.xxhash64("variant", "band"), "variant")
    near = F.array(*[F.lead(F.struct("variant", "label", "n"), k).over(here) for k in range(1, reach + 1)])
    fits = lambda o: o.isNotNull() & (o["label"] != F.col("label")) & (F.least(o["n"], "n") >= similarity * F.greatest(o["n"], "n") - 1e-9)
    met = rows.withColumn("o", near).select("variant", "label", F.explode(F.filter("o", fits)).alias("o"))
    swap = F.col("variant") > F.col("o.variant")
    mine, other = F.struct("variant", "label"), F.struct("o.variant", "o.label")
    ordered = met.select(F.when(swap, other).otherwise(mine).alias("x"), F.when(swap, mine).otherwise(other).alias("y"))
    return ordered.select(F.col("x.variant").alias("a"), F.col("x.label").alias("la"), F.col("y.variant").alias("b"), F.col("y.label").alias("lb")).distinct()


def _confirmed(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Edges (src, dst) of labels whose texts reach the similarity."""
    wanted = materialise(pairs.select(F.explode(F.array("a", "b")).alias("variant")).distinct(), "minhash-wanted")
    sets = materialise(_texts_of(texts, wanted).select("variant", shingle_set("text").alias("set")), "minhash-sets")
    both = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    counted = both.select("la", "lb", shared.alias("i"), (F.size("sa") + F.size("sb")).alias("total"))
    return counted.where(F.col("i") >= similarity * (F.col("total") - F.col("i")) - 1e-9).select(F.col("la").alias("src"), F.col("lb").alias("dst")).distinct()


def _linked(sets: list[np.ndarray], labels: np.ndarray, sides: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Links (label, label), without repeats, of texts of other labels that reach the similarity; with two sides, across them only."""
    sizes = np.array([len(x) for x in sets])
    codes = np.unique(np.concatenate(sets), return_inverse=True)[1]
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(codes, kind="stable")
    holders, first = owner[order], np.searchsorted(codes[order], np.arange(codes.max() + 2))
    begin, root, found, two = np.cumsum(sizes) - sizes, {}, [], len(np.unique(sides)) > 1

    def top(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        mine = codes[begin[a] : begin[a] + sizes[a]]
        lengths = first[mine + 1] - first[mine]
        at = np.repeat(first[mine] - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
        shared = np.bincount(holders[at], minlength=len(sets))
        near = (shared >= similarity * (sizes + sizes[a] - shared) - 1e-9) & (labels != labels[a]) & (np.arange(len(sets)) > a)
        for b in np.flatnonzero(near & (sides != sides[a]) if two else near):
            x, y = top(int(labels[a])), top(int(labels[b]))
            if x != y:
                root[max(x, y)] = min(x, y)
                found.append((x, y))
    return found


def _ambiguous(members: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Those of members (variant, label, n) that may reach the similarity with a member of another label, as (variant).

    Such a pair shares at least similarity x n shingles of either text, each of which two labels hold. Texts with fewer of those
    go, and with them their shingles, as long as that removes a tenth of the texts. Common shingles are broadcast: those that make
    over a thousandth of all rows are fewer than HOT_SHARE.
    """
    members = materialise(members, "minhash-members")
    tokens = materialise(members.join(_texts_of(texts, members.select("variant")), "variant").select("variant", "label", "n", F.explode(shingle_set("text")).alias("token")), "minhash-tokens")
    before = members.count()
    while True:
        held = tokens.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("rows")).where("low < high")
        held = materialise(held.select("token", "rows"), "minhash-held")
        hot = F.broadcast(held.where(F.col("rows") > tokens.count() / HOT_SHARE).select("token"))
        shared = tokens.join(hot, "token", "left_semi").unionByName(tokens.join(hot, "token", "left_anti").join(held.select("token"), "token", "left_semi"))
        left = shared.groupBy("variant", "n").agg(F.count("*").alias("c")).where(F.col("c") >= similarity * F.col("n") - 1e-9)
        left = materialise(left.select("variant"), "minhash-left")
        after = left.count()
        if not after or after > 0.9 * before:
            return left
        tokens, before = materialise(tokens.join(left, "variant", "left_semi"), "minhash-tokens"), after


def _rest(labelled: DataFrame, texts: DataFrame, reach: int, similarity: float, part: int = PART) -> DataFrame:
    """Links (src, dst) of labels over all pairs of the bands that hold more texts than the reach covers, and several labels.

    Texts without a chance of a link to another label are left out first. A band is then cut into parts of about `part` shingles: a
    label with many of them in it has parts of its own, the others share parts. Each two parts meet in
    a task, but for those of one label, which are linked already. So nothing of a band is gathered beyond two parts.
    """

    def crowded_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        sizes = rows.groupBy("band", "label").agg(F.sum("n").alias("own"), F.count("*").alias("texts"))
        small = F.sum(F.when(F.col("own") < part, F.col("own")).otherwise(0)).alias("small")
        crowded = sizes.groupBy("band").agg(F.sum("texts").alias("all"), F.count("*").alias("labels"), small).where("labels > 1")
        return sizes, crowded

    rows = labelled.select("variant", "label", "n", F.explode("bands").alias("band"))
    crowded = crowded_rows(rows)[1].where(F.col("all") > reach + 1).select("band")
    rows = materialise(rows.join(crowded, "band", "left_semi"), "minhash-crowded")
    left = _ambiguous(rows.select("variant", "label", "n").distinct(), texts, similarity)
    rows = materialise(rows.join(left, "variant", "left_semi"), "minhash-crowded")
    sizes, crowded = crowded_rows(rows)
    placed = rows.join(sizes.join(crowded, "band").select("band", "label", "own", "small"), ["band", "label"])
    big = F.col("own") >= part
    placed = placed.select("band", "variant", "label", F.when(big, F.col("label")).alias("of"), F.pmod(F.xxhash64("variant"), F.ceil(F.when(big, F.col("own")).otherwise(F.col("small")) / part).cast("long")).alias("k"))
    placed = materialise(placed, "minhash-placed")
    parts = placed.select("band", "of", "k").distinct()
    a, b = parts.toDF("band", "of_a", "k_a"), parts.toDF("band", "of_b", "k_b")
    later = F.struct(F.coalesce("of_a", F.lit(0)), F.col("of_a").isNull(), "k_a") <= F.struct(F.coalesce("of_b", F.lit(0)), F.col("of_b").isNull(), "k_b")
    apart = ~F.coalesce(F.col("of_a") == F.col("of_b"), F.lit(False))
    pairs = a.join(b, "band").where(later & apart).withColumn("pair", F.xxhash64("band", "of_a", "k_a", "of_b", "k_b"))
    ends = pairs.select("band", "pair", F.explode(F.array(F.struct(F.col("of_a").alias("of"), F.col("k_a").alias("k")), F.struct(F.col("of_b").alias("of"), F.col("k_b").alias("k")))).alias("e")).select("band", "pair", "e.of", "e.k").distinct()
    sets = materialise(_texts_of(texts, left).select("variant", shingle_set("text").alias("set")), "minhash-rest")
    same = (placed["band"] == ends["band"]) & placed["of"].eqNullSafe(ends["of"]) & (placed["k"] == ends["k"])
    sent = placed.join(ends, same).select("pair", "variant", "label", F.xxhash64(placed["of"], placed["k"]).alias("side")).join(sets, "variant").select("pair", "label", "side", "set")

    def compare(table: pa.Table) -> pa.Table:
        found = _linked([np.asarray(x, np.int64) for x in table.column("set").to_numpy()], table.column("label").to_numpy(), table.column("side").to_numpy(), similarity)
        src, dst = zip(*found) if found else ((), ())
        return pa.table({"src": pa.array(src, pa.int64()), "dst": pa.array(dst, pa.int64())})

    return sent.groupBy("pair").applyInArrow(compare, "src long, dst long").distinct()


def join_similar(docs: DataFrame, prints: DataFrame, groups: DataFrame, similarity: float, reach: tuple = REACH, part: int = PART) -> DataFrame:
    """groups (fp, component, component_id, n) with those joined that hold texts of at least the similarity.

    prints: (fp, variant, signature) of each row of docs, variant the xxhash64 of its text.
    """
    first = prints.where("signature is not null").groupBy("variant").agg(F.first("fp").alias("fp"), F.first("signature").alias("s"))
    variants = materialise(first.select("variant", "fp", F.get("s", 0).alias("n"), F.slice("s", 2, BANDS).alias("bands")), "minhash-variants")
    texts = docs.select(F.xxhash64("text").alias("variant"), "text")

    def labelled() -> DataFrame:
        return variants.join(groups.select("fp", F.col("component").alias("label")), "fp")

    def joined(edges: DataFrame) -> DataFrame:
        if edges.isEmpty():
            return groups
        moved = groups.join(connected_components(edges).toDF("component", "root"), "component", "left").withColumn("component", F.coalesce("root", "component"))
        least = moved.groupBy("component").agg(F.min("component_id").alias("least"))
        return materialise(moved.join(least, "component").select("fp", "component", F.col("least").alias("component_id"), "n"), "minhash-groups")

    for bands, near in reach:
        pairs = materialise(_candidates(labelled(), bands, near, similarity), "minhash-pairs")
        groups = joined(materialise(_confirmed(pairs, texts, similarity), "minhash-links"))
    return joined(materialise(_rest(labelled(), texts, reach[-1][1], similarity, part), "minhash-links"))
