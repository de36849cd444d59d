"""Generated molecules, docking poses and genomic intervals."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.operators.scratch import kept_table


def generation_quality(molecules: DataFrame, train: DataFrame) -> DataFrame:
    """(run_id, validity, uniqueness, abs_uniqueness, novelty, abs_novelty); ratios of nothing are null."""
    n = molecules.groupBy("run_id").agg(F.count("*").alias("n"), F.count_if("valid").alias("n_valid"))
    distinct = molecules.where("valid").select("run_id", "mol").distinct()
    known = train.select("mol").distinct().withColumn("known", F.lit(True))
    kinds = distinct.join(known, "mol", "left").groupBy("run_id").agg(F.count("*").alias("d"), F.count_if(F.col("known").isNull()).alias("new"))
    joined = n.join(kinds, "run_id", "left").fillna(0, ["d", "new"])
    ratio = lambda a, b: F.try_divide(F.col(a), F.col(b))
    return joined.select(
        "run_id", ratio("n_valid", "n").alias("validity"), ratio("d", "n_valid").alias("uniqueness"), ratio("d", "n").alias("abs_uniqueness"),
        ratio("new", "d").alias("novelty"), ratio("new", "n").alias("abs_novelty"),
    )


def reconstruction_rate(rows: DataFrame, batch: int) -> DataFrame:
    """One row: the mean over batches of each batch's share of matches (not weighted by size). rows: (ordinal, match)."""
    each = rows.groupBy(F.floor(F.col("ordinal") / batch).alias("b")).agg(F.avg(F.col("match").cast("double")).alias("rate"))
    return each.agg(F.avg("rate").alias("rate"))


def tanimoto(a: Column, b: Column) -> Column:
    """Shared share of two fingerprints given as sets; null for two empty ones."""
    return F.try_divide(F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b)))


#: Items and sets of a block at most, on average, and items at least; pairs of sets that a task counts at a time; blocks that meet another one in a task; equal sets that are left out before they are dealt.
SET_ITEMS, SET_ROWS, LEAST_ITEMS, SET_CELLS, MET, MANY_EQUAL = 1 << 23, 1 << 15, 1 << 19, 1 << 23, 8, 1000
_PACKED = "block int, ids binary, sizes binary, used binary, codes binary"


def similar_sets(rows: DataFrame, least: float) -> DataFrame:
    """(a, b, similarity): all pairs of different sets whose tanimoto() is at least `least` (above zero), a below b; rows: (id, items).

    Equal sets stand for each other: the smallest id meets the other sets, and each further id is a row (smallest, id, 1.0).
    Empty and null sets and null items are in no pair. Sets go as hashes of their items, whose distinctness is checked. They are dealt to levels of
    size, so that only sets of one level or of adjacent ones can be similar enough, and to blocks within, which are packed once: an item is then a
    step of a byte or two between numbers. A task holds a block and a few that it meets, one after the other, counts what
    their sets share, and reports only pairs that are similar. What is sent grows with packed sets x blocks, never with pairs.
    """
    sets = rows.select("id", F.array_sort(F.array_compact(F.array_distinct("items"))).alias("items")).where(F.size("items") > 0)
    clash = sets.select(F.explode("items").alias("item")).distinct().groupBy(F.xxhash64("item")).agg(F.count("*").alias("n")).where("n > 1")
    if not clash.isEmpty():
        raise ValueError("two items have one hash")
    level = F.floor(F.ln(F.size("items").cast("double")) / max(math.log(2), -math.log(least) * (1 + 1e-6))).cast("int")
    named = kept_table(sets.select(F.col("id").cast("long").alias("id"), F.unhex(F.sha2(F.to_json("items"), 256)).alias("digest"), level.alias("level"), F.transform("items", lambda x: F.xxhash64(x)).alias("items")))
    first = named.groupBy("digest").agg(F.min("id").alias("a"), F.count("*").alias("n"))
    copies = named.select("digest", F.col("id").alias("b")).join(first.select("digest", "a"), "digest").where("a <> b").select("a", "b", F.lit(1.0).alias("similarity"))
    held = named.groupBy("level").agg(F.count("*").alias("n"), F.sum(F.size("items")).alias("s")).collect()
    items = min(SET_ITEMS, max(LEAST_ITEMS, sum(r["s"] for r in held) // 8))
    sizes = {r["level"]: max(1, -(-r["s"] // items), -(-r["n"] // SET_ROWS)) for r in held}
    place, total = {}, 0  # level: its first block and the one after its last
    for at in sorted(sizes):
        place[at] = (total, total := total + sizes[at])
    if not place:
        return copies
    span = F.create_map(*[x for at, (lo, hi) in place.items() for x in (F.lit(at), F.array(F.lit(lo), F.lit(hi - lo)))])
    block = (F.element_at(span, F.col("level"))[0] + F.pmod(F.xxhash64("digest"), F.element_at(span, F.col("level"))[1])).cast("int")
    # Equal sets come to one block, where the smallest id is kept; where they are many, the others stay behind.
    many = F.broadcast(first.where(F.col("n") > MANY_EQUAL).select("digest", "a"))
    dealt = named.join(many, "digest", "left").where("a is null or a = id").select(block.alias("block"), "id", "digest", "items")
    packed = kept_table(dealt.repartition(total, "block").groupBy("block").applyInArrow(_packed_sets, _PACKED))
    # A block meets itself and those after it, up to the end of the next level.
    last = {x: place.get(at + 1, (0, hi))[1] - 1 for at, (lo, hi) in place.items() for x in range(lo, hi)}
    met = max(1, min(MET, sum(y - x + 1 for x, y in last.items()) // 64))
    meetings = [(x, n, y) for x, end in last.items() for n, lo in enumerate(range(x, end + 1, met)) for y in {x, *range(lo, min(lo + met, end + 1))}]
    wanted = F.broadcast(rows.sparkSession.createDataFrame(meetings, "x int, n int, block int"))

    def meet(key: tuple, table: pa.Table) -> pa.Table:
        row = {b: i for i, b in enumerate(table.column("block").to_pylist())}
        own = _unpacked_sets(table, row[x := key[0].as_py()])
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        for y in sorted(row):
            if y > x or key[1].as_py() == 0:
                out += _similar(own, own if y == x else _unpacked_sets(table, row[y]), y == x, least)
        return pa.table([np.concatenate(c) for c in zip(*out)], names=["a", "b", "similarity"])

    groups = len({m[:2] for m in meetings})
    pairs = packed.join(wanted, "block").repartition(min(groups, 4096), "x", "n").groupBy("x", "n").applyInArrow(meet, "a long, b long, similarity double")
    return pairs.unionByName(copies)


def _packed_sets(table: pa.Table) -> pa.Table:
    """A block's sets in one row: ids, sizes, the items by how many sets have them, and the numbers of each set's items as steps from one to the next. Of equal sets the smallest id stays."""
    same = table.column("digest").combine_chunks().dictionary_encode().indices.to_numpy()
    order = np.lexsort((table.column("id").to_numpy(), same))
    kept = table.select(["id", "items"]).take(pa.array(np.sort(order[np.flatnonzero(np.diff(same[order], prepend=-1))])))
    lists = kept.column("items").combine_chunks()
    sizes = pc.list_value_length(lists).to_numpy().astype(np.int32)
    used, code = np.unique(lists.flatten().to_numpy(), return_inverse=True)
    often = np.argsort(-np.bincount(code), kind="stable")
    rank = np.empty(len(used), np.int64)
    rank[often] = np.arange(len(used))
    cells = np.sort(np.repeat(np.arange(len(sizes)), sizes) * len(used) + rank[code]) % len(used)
    steps = np.diff(cells, prepend=0).astype("<i4").view(np.uint8).reshape(-1, 4)  # high bytes apart, which are nearly all equal
    parts = kept.column("id").to_numpy().tobytes(), sizes.tobytes(), used[often].tobytes(), pa.compress(np.ascontiguousarray(steps.T).tobytes(), codec="zstd", asbytes=True)
    return pa.table([pa.array([table.column("block")[0].as_py()], pa.int32()), *(pa.array([x], pa.binary()) for x in parts)], names=[x.split()[0] for x in _PACKED.split(", ")])


def _unpacked_sets(table: pa.Table, row: int) -> tuple[np.ndarray, ...]:
    part = lambda c, kind: np.frombuffer(table.column(c)[row].as_buffer(), kind)
    ids, sizes, used = part("ids", np.int64), part("sizes", np.int32).astype(np.int64), part("used", np.int64)
    steps = np.frombuffer(pa.decompress(table.column("codes")[row].as_buffer(), decompressed_size=4 * int(sizes.sum()), codec="zstd"), np.uint8)
    return ids, sizes, used, np.cumsum(np.ascontiguousarray(steps.reshape(4, -1).T).view("<i4").ravel(), dtype=np.int32)


def _similar(own: tuple, other: tuple, same: bool, least: float) -> list[tuple]:
    """(a, b, similarity) of the similar pairs of two blocks of sets, or of one with itself."""
    (ids, sizes, items, codes), (names, others, used, those) = own, other
    order = np.argsort(used)
    at = order[np.minimum(np.searchsorted(used, items, sorter=order), len(used) - 1)]
    number = np.where(used[at] == items, at, -1).astype(np.int32)  # of our items among theirs
    counts = np.bincount(those, minlength=len(used))
    owners, starts = np.repeat(np.arange(len(names), dtype=np.int32), others)[np.argsort(those, kind="stable")], np.cumsum(counts) - counts
    ends, step, out = np.concatenate([[0], np.cumsum(sizes)]), max(1, SET_CELLS // len(names)), []
    for at in range(0, len(ids), step):
        n = min(step, len(ids) - at)
        row, code = np.repeat(np.arange(n), sizes[at : at + n]), number[codes[ends[at] : ends[at + n]]]
        row, code = row[code >= 0], code[code >= 0]
        shared = _shared(row, code, n, owners, starts, counts, len(names))
        q, r = np.divmod(np.flatnonzero(shared >= (least / (1 + least) - 1e-6) * (sizes[at : at + n, None] + others[None, :])), len(names))
        both = shared[q, r].astype(np.float64)
        similarity, i, j = both / (sizes[at + q] + others[r] - both), ids[at + q], names[r]
        kept = (similarity >= least) & ((i < j) | (not same))
        out.append((np.minimum(i, j)[kept], np.maximum(i, j)[kept], similarity[kept]))
    return out


def _shared(row: np.ndarray, code: np.ndarray, n: int, owners: np.ndarray, starts: np.ndarray, counts: np.ndarray, others: int) -> np.ndarray:
    """How many items each of n sets (row, code) shares with each other one; owners: the other sets by item, from starts on.

    Items that many sets have on both sides are multiplied as columns, the rest are counted pair by pair.
    """
    shared = np.zeros((n, others), np.float32)
    dense = np.bincount(code, minlength=len(counts)) * counts > n * others // 100
    columns = np.flatnonzero(dense)
    for at in range(0, len(columns), 256):
        some = columns[at : at + 256]
        number = np.full(len(counts), -1)
        number[some] = np.arange(len(some))
        a, b = np.zeros((n, len(some)), np.float32), np.zeros((others, len(some)), np.float32)
        mine = number[code] >= 0
        a[row[mine], number[code[mine]]] = 1
        for k, c in enumerate(some):
            b[owners[starts[c] : starts[c] + counts[c]], k] = 1
        shared += a @ b.T
    row, code = row[~dense[code]], code[~dense[code]]
    ends = np.cumsum(counts[code])
    edges = [0, *(np.flatnonzero(np.diff(ends // (1 << 21))) + 1).tolist(), len(code)]
    for lo, hi in zip(edges, edges[1:]):
        times = counts[code[lo:hi]]
        within = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        np.add.at(shared.reshape(-1), np.repeat(row[lo:hi], times) * others + owners[np.repeat(starts[code[lo:hi]], times) + within], np.float32(1))
    return shared


def constrained_summary(pairs: DataFrame, cutoffs: list[float]) -> DataFrame:
    """(cutoff, n, success, mean_similarity, sd_similarity, mean_gain, sd_gain): each start's best gain among pairs similar enough.

    pairs: (start_id, target, similarity, gain); success is the share of starts with a hit.
    """
    starts = pairs.agg(F.count_distinct("start_id").alias("s")).select("s").scalar()
    hits = pairs.withColumn("cutoff", F.explode(F.array(*map(F.lit, cutoffs)))).where("similarity >= cutoff and gain > 0")
    best = hits.groupBy("cutoff", "start_id").agg(F.max_by(F.struct("similarity", "gain"), F.struct("gain", "similarity")).alias("b"))
    table = best.groupBy("cutoff").agg(F.count("*").alias("n"), F.avg("b.similarity").alias("mean_similarity"), F.stddev_pop("b.similarity").alias("sd_similarity"), F.avg("b.gain").alias("mean_gain"), F.stddev_pop("b.gain").alias("sd_gain"))
    return table.withColumn("success", F.col("n") / starts)


def first_of_each(rows: DataFrame, key: str, by: str) -> DataFrame:
    """One row for each key: the one that comes first. A key's rows are reduced before they are shuffled."""
    first = rows.groupBy(key).agg(F.min_by(F.struct(*rows.columns), by).alias("__first"))
    return first.select("__first.*")


def lerp(pairs: DataFrame, n: int) -> DataFrame:
    """(id, i, vec): z0 + i / (n + 1) * (z1 - z0) for i = 0 to n + 1; pairs: (id, z0, z1)."""
    steps = pairs.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n + 1))))
    return steps.select("id", "i", F.zip_with("z0", "z1", lambda a, b: a.cast("double") + F.col("i") / (n + 1) * (b.cast("double") - a.cast("double"))).alias("vec"))


def grid_around(points: DataFrame, delta: float, size: int) -> DataFrame:
    """(id, i, j, vec): vec + delta * (i * x + j * y) for i and j from -size to size; points: (id, vec, x, y)."""
    axis = F.sequence(F.lit(-size), F.lit(size))
    cells = points.withColumn("i", F.explode(axis)).withColumn("j", F.explode(axis))
    moved = F.zip_with(F.zip_with("vec", F.col("x"), lambda p, a: p.cast("double") + (F.col("i") * delta * a + F.lit(0.0))), F.col("y"), lambda p, b: p + (F.col("j") * delta * b + F.lit(0.0)))
    return cells.select("id", "i", "j", moved.alias("vec"))


def best_pose(poses: DataFrame) -> DataFrame:
    """(ligand, receptor, run, energy): the lowest energy over all runs; ties by receptor and run."""
    return poses.groupBy("ligand").agg(F.min_by(F.struct("receptor", "run", "energy"), F.struct("energy", "receptor", "run")).alias("p")).select("ligand", "p.*")


POSE_CLUSTER = T.StructType([T.StructField("ligand", T.LongType()), T.StructField("energy", T.DoubleType()), T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType()), T.StructField("z", T.DoubleType()), T.StructField("cluster", T.IntegerType())])


#: Poses that a task groups at a time, on average.
POSES = 1 << 17


def pose_clusters(poses: DataFrame, tolerance: float = 2.0) -> DataFrame:
    """(ligand, energy, x, y, z, cluster): a pose joins the first leader within the tolerance, else it leads a new cluster.

    Poses go by energy. Ligands are dealt to parts, whose number grows with the poses; in a round the first pose of each ligand that has no
    cluster leads the next one and takes the poses near it, for all ligands of a part at once.
    """

    def lead(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([(c, "ascending") for c in POSE_CLUSTER.names[:-1]])
        ligand = table.column("ligand").combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        xyz = [table.column(c).to_numpy() for c in "xyz"]
        cluster, left, at = np.zeros(len(ligand), np.int32), np.arange(len(ligand)), 0
        while len(left):
            firsts = np.flatnonzero(np.diff(ligand[left], prepend=ligand[left[0]] - 1))
            leader = left[np.repeat(firsts, np.diff(firsts, append=len(left)))]
            near = np.sqrt(sum((c[leader] - c[left]) ** 2 for c in xyz)) <= tolerance
            near[firsts] = True
            cluster[left[near]] = at
            left, at = left[~near], at + 1
        return table.append_column("cluster", pa.array(cluster))

    rows = poses.select(*[F.col(f.name).cast(f.dataType) for f in POSE_CLUSTER.fields[:-1]])
    parts = max(1, -(-rows.count() // POSES))
    return rows.groupBy(F.pmod(F.xxhash64("ligand"), F.lit(parts)).alias("part")).applyInArrow(lead, POSE_CLUSTER)


#: Receptors and ligands of a panel at most, on average; receptors that a ligand meets in one run of rows; pairs of panels that share a task.
PANEL, LIGANDS, RUN, SHARED = 1024, 4096, 256, 8


def screening(ligands: DataFrame, receptors: DataFrame) -> DataFrame:
    """(ligand, receptor): every ligand against every receptor, as docking asks for.

    Both sides are dealt to panels, which are lists of bounded length; what is sent is a panel of ligands once for each panel of receptors, and
    pairs of panels are dealt to tasks that write out their rows. A ligand meets a short run of receptors at a time and a task sees few of
    either side, so that a Parquet file of the result holds short dictionaries and patterns that repeat.
    """

    def panels(rows: DataFrame, name: str, length: int) -> tuple[int, DataFrame]:
        number = max(1, -(-rows.count() // length))
        held = F.transform(F.collect_list(F.struct(name)), lambda x: x[name])  # a list of bare values would lose the null
        return number, rows.groupBy(F.pmod(F.xxhash64(name), F.lit(number)).cast("int").alias(f"{name}s")).agg(held.alias(name))

    (m, asked), (n, met) = panels(ligands, "ligand", LIGANDS), panels(receptors, "receptor", PANEL)
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size("receptor") - 1) / RUN)), lambda i: F.slice("receptor", (i * RUN + 1).cast("int"), RUN))
    pairs = asked.withColumn("receptors", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).join(met, "receptors")
    dealt = pairs.repartition(max(min(m * n, 256), m * n // SHARED), "ligands", "receptors")
    each = dealt.select("ligand", F.explode(runs).alias("run")).select(F.explode("ligand").alias("ligand"), "run")
    return each.select("ligand", F.explode("run").alias("receptor"))


#: The cutoffs of the kinds of target atoms.
CONTACT_CUTOFFS = {"R": 2.1, "H": 3.7, "V": 4.0}


def contacts(poses: DataFrame, targets: DataFrame, cutoffs: dict[str, float] = CONTACT_CUTOFFS) -> DataFrame:
    """Pairs within the cutoff of the target's kind, by a grid of cells half as wide as the largest one.

    A target goes to the cells that its own cutoff reaches, at most 216, and a pose to the one that it lies in. Few rows have many
    pairs, so that cells are dealt to a set number of tasks, which Spark doesn't put together by the size of their rows.
    Both sides: (id, kind, x, y, z). Targets of other kinds have no contacts.
    """
    size = max(cutoffs.values()) / 2
    cutoff = F.try_element_at(F.create_map(*[F.lit(x) for kv in cutoffs.items() for x in kv]), F.col("kind"))
    # A little further than the cutoff, for what rounding does to the exact test below.
    reach = cutoff + 1e-9 * (1 + F.greatest(*[F.abs(F.col(c)) for c in "xyz"]))
    placed = targets.select(F.col("id").alias("target"), "kind", *[F.col(c).alias(f"t{c}") for c in "xyz"], reach.alias("reach"))
    for c in "xyz":
        low, high = (F.floor((F.col(f"t{c}") + way * F.col("reach")) / size) for way in (-1, 1))
        placed = placed.withColumn(f"c{c}", F.explode(F.sequence(low, high)))
    # From a target to the nearest point of a cell.
    gaps = [F.greatest(F.lit(0.0), F.col(f"c{c}") * size - F.col(f"t{c}"), F.col(f"t{c}") - (F.col(f"c{c}") + 1) * size) for c in "xyz"]
    placed = placed.where(sum((x * x for x in gaps[1:]), gaps[0] * gaps[0]) <= F.col("reach") * F.col("reach")).drop("reach")
    asked = poses.select(F.col("id").alias("pose"), "x", "y", "z", *[F.floor(F.col(c) / size).alias(f"c{c}") for c in "xyz"])
    square = sum(((F.col(c) - F.col(f"t{c}")) * (F.col(c) - F.col(f"t{c}")) for c in "yz"), (F.col("x") - F.col("tx")) * (F.col("x") - F.col("tx")))
    cells, tasks = ["cx", "cy", "cz"], int(poses.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = asked.repartition(tasks, *cells).join(placed.repartition(tasks, *cells), cells)
    return met.where(square <= cutoff * cutoff).select("pose", "target", "kind")


def tiles(contigs: DataFrame, size: int) -> DataFrame:
    """(contig, tile, start_pos, end_pos): fixed windows over each contig, the last one shorter."""
    rows = contigs.where("length > 0").withColumn("start_pos", F.explode(F.expr(f"sequence(0L, cast(length as bigint) - 1, {size}L)")))
    return rows.select("contig", F.floor(F.col("start_pos") / size).cast("long").alias("tile"), "start_pos", F.least(F.col("start_pos") + size, F.col("length")).cast("long").alias("end_pos"))


#: Tiles go eight to a block, eight blocks to a block of the next level, and so on.
BLOCK_BITS = 3


def overlaps(signal: DataFrame, windows: DataFrame, size: int, pad: int) -> DataFrame:
    """Signal x tile with `pad` added to both ends of a tile: an equi join on blocks of tiles, then the exact test.

    windows as made by tiles(). A signal is sent to the blocks that its padded span touches, on the level where these are at most
    nine, whatever its length; a tile is sent to its block of each level that some signal is on. A pair meets once.
    """
    first, last = (F.greatest(F.lit(0), F.floor(c / size)).cast("long") for c in (F.col("start_pos") - pad, F.col("end_pos") - 1 + pad))
    spans = signal.where("end_pos > start_pos").select("contig", F.col("start_pos").alias("s"), F.col("end_pos").alias("e"), "value", first.alias("first"), last.alias("last"))
    # bin() writes a number in base two, so that its length gives the level exactly.
    levelled = spans.withColumn("level", F.expr(f"cast(floor((length(bin(last - first)) - 1) / {BLOCK_BITS}) as int)"))
    block = lambda c: F.expr(f"shiftright({c}, {BLOCK_BITS} * level)")
    sent = levelled.withColumn("block", F.explode(F.sequence(block("first"), block("last"))))
    used = levelled.agg(F.collect_set("level").alias("levels")).select("levels").scalar()  # at most 22 levels
    placed = windows.withColumn("levels", used).withColumn("level", F.explode("levels")).withColumn("block", block("tile"))
    joined = sent.drop("first", "last").join(placed.select("contig", "tile", "start_pos", "end_pos", "level", "block"), ["contig", "level", "block"])
    return joined.where((F.col("s") < F.col("end_pos") + pad) & (F.col("e") > F.col("start_pos") - pad)).select("contig", "tile", "s", "e", "value")


def holdout_split(rows: DataFrame, val: str, holdout: str) -> DataFrame:
    return rows.withColumn("split", F.when(F.col("contig") == val, "val").when(F.col("contig") == holdout, "holdout").otherwise("train"))
