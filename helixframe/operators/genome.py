"""Reads and alignments: contig offsets, balanced bins, binning and coordinate sort, pairing, orientation, seeds, pileups."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.operators.matrix import numbered_rows

N_BINS, ROUNDING = 8, 1000
UNMAPPED = "*"


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGT", "TGCA"))


def contig_starts(contigs: DataFrame, primary: int | None = None, keep: bool = True) -> DataFrame:
    """(ord, contig, length, start): running total of lengths in dictionary order.

    Contigs outside the first `primary` ones start at -1. `*` starts at the total if unmapped rows are kept, else at -1.
    The dictionary has as many rows as contigs, so that one window over it is small.
    """
    inside = F.col("ord") < primary if primary is not None else F.lit(True)
    w = Window.partitionBy(F.lit(1)).orderBy("ord")
    rows = contigs.withColumn("inside", inside).withColumn("used", F.when(F.col("inside"), F.col("length")).otherwise(0))
    before = F.coalesce(F.sum("used").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    started = rows.select("ord", "contig", "length", F.when(F.col("inside"), before).otherwise(F.lit(-1).cast("long")).alias("start"))
    total = rows.agg(F.max("ord").alias("ord"), F.sum("used").alias("total"))
    star = total.select((F.col("ord") + 1).alias("ord"), F.lit(UNMAPPED).alias("contig"), F.lit(0).cast("long").alias("length"), (F.col("total") if keep else F.lit(-1).cast("long")).alias("start"))
    return started.unionByName(star)


def range_bins(starts: DataFrame, n: int = N_BINS, rounding: int = ROUNDING) -> DataFrame:
    """(bin, start_pos, end_pos): n ranges of about equal length.

    A bin aims at (i + 1) * total / n. The first contig that ends at most `rounding` before that decides: its end if that is
    within `rounding`, else the multiple of `rounding` inside the contig that is nearest.
    """
    inside = starts.where((F.col("start") >= 0) & (F.col("contig") != UNMAPPED)).withColumn("stop", F.col("start") + F.col("length"))
    total = inside.agg(F.max("stop").alias("t")).select("t").scalar()
    spark = starts.sparkSession
    aims = F.broadcast(spark.range(n).withColumn("aim", F.floor((F.col("id") + 1) * total / n).cast("long")))  # n rows, whatever the dictionary
    near = inside.join(aims, F.col("stop") >= F.col("aim") - rounding).groupBy("id", "aim").agg(F.min_by(F.struct("start", "stop"), "stop").alias("c"))
    snapped = F.when(F.abs(F.col("aim") - F.col("c.stop")) <= rounding, F.col("c.stop")).otherwise(F.col("c.start") + F.floor((F.col("aim") - F.col("c.start") + rounding // 2) / rounding) * rounding)
    ends = near.select(F.col("id").cast("int").alias("bin"), snapped.cast("long").alias("end_pos"))
    return ends.withColumn("start_pos", F.coalesce(F.lag("end_pos").over(Window.partitionBy(F.lit(1)).orderBy("bin")), F.lit(0)).cast("long")).select("bin", "start_pos", "end_pos")


def bin_pieces(bins: DataFrame, starts: DataFrame) -> DataFrame:
    """(bin, ord, contig, lo, hi): the part of each contig that lies in a bin, from lo up to before hi; empty pieces are left out."""
    inside = starts.where((F.col("start") >= 0) & (F.col("contig") != UNMAPPED))
    lo = F.greatest(F.lit(0), F.col("start_pos") - F.col("start"))
    hi = F.least(F.col("length"), F.col("end_pos") - F.col("start"))
    # Bins are as many as were asked for; the contigs of a draft assembly may be millions.
    met = inside.join(F.broadcast(bins), (F.col("start") < F.col("end_pos")) & (F.col("start") + F.col("length") > F.col("start_pos")))
    return met.where(hi > lo).select("bin", "ord", "contig", lo.cast("long").alias("lo"), hi.cast("long").alias("hi"))


def bin_regions(bins: DataFrame, starts: DataFrame) -> DataFrame:
    """(bin, regions): `contig:lo-hi` pieces of a bin in order, joined by spaces."""
    text = F.concat("contig", F.lit(":"), "lo", F.lit("-"), "hi")
    return bin_pieces(bins, starts).groupBy("bin").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", text.alias("t")))), lambda p: p["t"]), " ").alias("regions"))


def global_positions(alignments: DataFrame, starts: DataFrame) -> DataFrame:
    """Adds key, the position along all contigs; rows of excluded contigs get null. starts: one row per contig."""
    named = starts.select("contig", F.col("start").alias("__start"))
    key = F.when(F.col("__start") >= 0, F.col("__start") + F.col("pos"))
    return alignments.join(named, "contig", "left").withColumn("key", key).drop("__start")


def drop_unmapped(alignments: DataFrame, starts: DataFrame) -> DataFrame:
    """Rows on contigs that have a start; with starts made for keep=False, unmapped rows and other contigs go."""
    return alignments.join(starts.where("start >= 0").select("contig"), "contig", "left_semi")


def with_bin(positioned: DataFrame, bins: DataFrame) -> DataFrame:
    """Adds bin: the last one that starts at or before the key. The bins' starts are one small sorted array."""
    edges = bins.agg(F.sort_array(F.collect_list("start_pos")).alias("e")).select("e").scalar()
    counted = positioned.withColumn("__e", edges)
    return counted.withColumn("bin", (F.size(F.filter("__e", lambda e: e <= F.col("key"))) - 1).cast("int")).drop("__e")


def coordinate_sort(binned: DataFrame) -> DataFrame:
    """Rows in range partitions by key, sorted inside each; unmapped rows (null keys) last, ties by name."""
    order = [F.col("key").asc_nulls_last(), F.col("name").asc()]
    return binned.repartitionByRange(*order).sortWithinPartitions(*order)


def mate_pairs(first: DataFrame, second: DataFrame, how: str = "inner") -> DataFrame:
    """Mates by sample and ordinal; `full_outer` also shows reads without a mate."""
    a = first.select("sample", "ordinal", F.col("seq").alias("seq1"))
    b = second.select("sample", "ordinal", F.col("seq").alias("seq2"))
    return a.join(b, ["sample", "ordinal"], how)


def barcode_orientation(barcodes: DataFrame, whitelist: DataFrame) -> DataFrame:
    """(orientation, hits): how many barcodes the whitelist has as they are and reverse-complemented."""
    both = barcodes.select(F.explode(F.array(F.struct(F.lit("FIRST_BP").alias("orientation"), F.col("barcode").alias("b")), F.struct(F.lit("FIRST_BP_RC").alias("orientation"), reverse_complement(F.col("barcode")).alias("b")))).alias("x")).select("x.*")
    found = both.join(whitelist.select(F.col("barcode").alias("b")).distinct(), "b", "left_semi").groupBy("orientation").agg(F.count("*").alias("hits"))
    names = barcodes.sparkSession.sql("select explode(array('FIRST_BP', 'FIRST_BP_RC')) as orientation")
    return names.join(found, "orientation", "left").select("orientation", F.coalesce("hits", F.lit(0)).alias("hits"))


def kmers(df: DataFrame, id_col: str, seq_col: str, k: int) -> DataFrame:
    """(id, at, kmer) for each window of k letters, at from 0."""
    at = F.explode(F.when(F.length(seq_col) >= k, F.sequence(F.lit(0), F.length(seq_col) - k)).otherwise(F.array().cast("array<int>")))
    return df.select(F.col(id_col).alias("id"), F.col(seq_col).alias("__s"), at.alias("at")).select("id", "at", F.col("__s").substr(F.col("at") + 1, F.lit(k)).alias("kmer"))


#: Rows of a k-mer on one side that meet in one task.
MOST_OF_A_KEY = 4096


def split_join(left: DataFrame, right: DataFrame, key: str, most: int | None = None) -> DataFrame:
    """left and right joined on the key, whose common values are cut into parts on both sides: each part meets each part.

    Sides are often exploded from rows whose size says nothing of theirs, so that Spark would take them for small: only the common keys,
    which are few, are left for it to broadcast.
    """
    most = most or MOST_OF_A_KEY
    counts = left.groupBy(key).agg(F.count("*").alias("nl")).hint("merge").join(right.groupBy(key).agg(F.count("*").alias("nr")), key)
    hot = counts.where((F.col("nl") > most) | (F.col("nr") > most)).select(key, F.ceil(F.col("nl") / most).alias("__lp"), F.ceil(F.col("nr") / most).alias("__rp"))

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        joined = rows.join(hot, key, "left").withColumns({c: F.coalesce(c, F.lit(1)) for c in ("__lp", "__rp")})
        mine = joined.withColumn("__mine", F.pmod(F.xxhash64(*rows.columns), F.col(own)))
        return mine.withColumn("__their", F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))).select(*rows.columns, F.col("__mine").alias(own), F.col("__their").alias(other))

    return dealt(left, "__lp", "__rp").hint("merge").join(dealt(right, "__rp", "__lp"), [key, "__lp", "__rp"]).drop("__lp", "__rp")


#: Letters of a block of reads at most, of a block of contigs at least and at most, on average, and of contigs that a task looks up at a time; shared seeds that it lists at a time.
READ_LETTERS, CONTIG_LETTERS, PIECE_LETTERS, SEED_PAIRS = 1 << 23, (1 << 21, 1 << 25), 1 << 20, 1 << 22


def seed_votes(reads: DataFrame, contigs: DataFrame, k: int) -> DataFrame:
    """(read, contig, diagonal, votes): the diagonal of shared k-mers with most votes; ties to the smaller contig and diagonal.

    Both sides: (id, seq), sequences of the letters A to Z; rows of one id vote together. Reads and contigs are dealt to blocks by their ids and a
    pair of blocks meets in a task, which finds its shared k-mers, counts the votes and reports one diagonal a read at most: what is sent are
    sequences x blocks and reads x blocks, never k-mers or what they share. A block grows with its side up to a set size.
    """
    if not 1 <= k <= 24:
        raise ValueError("k is 1 to 24: a k-mer is two numbers of 60 bits")
    letters = lambda rows: rows.agg(F.sum(F.length("seq"))).first()[0] or 0
    m, total = max(1, -(-letters(reads) // READ_LETTERS)), letters(contigs)
    n = max(1, -(-total // min(CONTIG_LETTERS[1], max(CONTIG_LETTERS[0], total // 32))))
    asked, met = (rows.where(F.length("seq") >= k).select(F.coalesce(F.col("id").cast("long"), F.lit(NO_ID)).alias("id"), "seq") for rows in (reads, contigs))
    block = lambda count: F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    rows = asked.select(block(m).alias("a"), every(n).alias("b"), F.lit(True).alias("asks"), "id", "seq").unionByName(met.select(every(m).alias("a"), block(n).alias("b"), F.lit(False).alias("asks"), "id", "seq"))

    def meet(table: pa.Table) -> pa.Table:
        best = _best_diagonals(*(table.filter(table.column("asks") if asks else pc.invert(table.column("asks"))).sort_by("id") for asks in (True, False)), k)
        return pa.table(best, names=["read", "contig", "diagonal", "votes"])

    found = rows.repartition(m * n, "a", "b").groupBy("a", "b").applyInArrow(meet, "read long, contig long, diagonal int, votes long")
    best = found.groupBy("read").agg(F.min_by(F.struct("contig", "diagonal", "votes"), F.struct(-F.col("votes"), "contig", "diagonal")).alias("m")).select("read", "m.*")
    return best.withColumns({c: F.nullif(F.col(c), F.lit(NO_ID)) for c in ("read", "contig")})


#: Stands for a null id, after all others.
NO_ID = (1 << 63) - 1


def _seeds(rows: pa.Table, k: int) -> tuple[np.ndarray, ...]:
    """(row, place, first letters, other letters) of each k-mer of the rows' sequences; letters as numbers of five bits each."""
    seq = rows.column("seq").combine_chunks().cast(pa.large_string())
    offsets = np.frombuffer(seq.buffers()[1], np.int64)[seq.offset : seq.offset + len(seq) + 1]
    data = np.frombuffer(seq.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    if ((data < 65) | (data > 90)).any():
        raise ValueError("a sequence has other letters than A to Z")
    number = lambda lo, hi: _folded(data, lo, hi, len(data) - k + 1)
    ends = offsets[1:] - offsets[0]
    row = np.repeat(np.arange(len(seq), dtype=np.int32), np.diff(offsets))[: len(data) - k + 1]
    at = np.arange(len(row))
    whole = at + k <= ends[row]
    place = (at - (offsets[:-1] - offsets[0])[row])[whole].astype(np.int32)
    return row[whole], place, number(0, min(k, 12))[whole], number(min(k, 12), k)[whole]


def _folded(data: np.ndarray, lo: int, hi: int, n: int) -> np.ndarray:
    codes = np.zeros(n, np.int64 if hi - lo > 6 else np.int32)
    for i in range(lo, hi):
        codes = (codes << 5) | (data[i : i + n] & 31)
    return codes


def _best_diagonals(reads: pa.Table, contigs: pa.Table, k: int) -> list[np.ndarray]:
    """(read, contig, diagonal, votes) of the best diagonal of each read that shares a k-mer with a contig; both sides in the order of their ids."""
    if not reads.num_rows or not contigs.num_rows:
        return [np.zeros(0, t) for t in (np.int64, np.int64, np.int32, np.int64)]
    names, owner = np.unique(reads.column("id").to_numpy(), return_inverse=True)
    row, place, first, rest = _seeds(reads, k)
    order = np.argsort(first, kind="stable")
    read, place, rest = owner[row[order]], place[order], rest[order]
    used, starts = np.unique(first[order], return_index=True)
    starts = np.append(starts, len(first))
    del row, first, order
    most, target, diagonal = np.zeros(len(names), np.int64), np.full(len(names), NO_ID), np.zeros(len(names), np.int64)
    ids = contigs.column("id").to_numpy()
    length = pc.binary_length(contigs.column("seq")).to_numpy().astype(np.int64)
    # Pieces of whole contigs; one that is longer stands alone.
    piece = (np.cumsum(length) - length) // PIECE_LETTERS
    heads = np.flatnonzero(np.diff(ids, prepend=ids[0])).tolist()
    cuts = [0]
    for at in heads:
        if piece[at] > piece[cuts[-1]]:
            cuts.append(at)
    for lo, hi in zip(cuts, [*cuts[1:], len(ids)]):
        some, number = np.unique(ids[lo:hi], return_inverse=True)
        row, at, code, tail = _seeds(contigs.slice(lo, hi - lo), k)
        order = np.argsort(code)
        found = np.minimum(np.searchsorted(used, code[order]), len(used) - 1)
        order, found = order[used[found] == code[order]], found[used[found] == code[order]]
        counts = starts[found + 1] - starts[found]
        ends, held = np.cumsum(counts), []
        edges = [0, *(np.flatnonzero(np.diff(ends // SEED_PAIRS)) + 1).tolist(), len(counts)]
        for x, y in zip(edges, edges[1:]):
            own = np.repeat(order[x:y], counts[x:y])
            other = np.arange(len(own)) + np.repeat(starts[found[x:y]] - (ends[x:y] - counts[x:y] - (ends[x - 1] if x else 0)), counts[x:y])
            same = tail[own] == rest[other]
            own, other = own[same], other[same]
            held.append(_counted([read[other], number[row[own]], at[own].astype(np.int64) - place[other]], np.ones(len(own), np.int64)))
        who, what, where, votes = held[0] if len(held) == 1 else _counted([np.concatenate(c) for c in list(zip(*held))[:3]], np.concatenate([x[3] for x in held]))
        best = np.lexsort((where, what, -votes, who))
        best = best[np.flatnonzero(np.diff(who[best], prepend=-1))]
        who, what, where, votes = who[best], some[what[best]], where[best], votes[best]
        # Contigs come in the order of their ids: an equal number of votes is no better.
        better = votes > most[who]
        who = who[better]
        most[who], target[who], diagonal[who] = votes[better], what[better], where[better]
    hit = np.flatnonzero(most)
    return [names[hit], target[hit], diagonal[hit].astype(np.int32), most[hit]]


def _counted(columns: list[np.ndarray], n: np.ndarray) -> tuple[np.ndarray, ...]:
    """The different rows of three columns, and the sums of n over each."""
    if not len(n):
        return *columns, n
    least = [int(c.min()) for c in columns]
    spans = [int(c.max()) - x + 1 for c, x in zip(columns, least)]
    if spans[0] * spans[1] * spans[2] < 1 << 62:
        key = ((columns[0] - least[0]) * spans[1] + (columns[1] - least[1])) * spans[2] + (columns[2] - least[2])
        order = np.argsort(key)
        new = np.diff(key[order], prepend=-1) != 0
    else:
        order = np.lexsort(columns)
        new = np.any([np.diff(c[order], prepend=x - 1) != 0 for c, x in zip(columns, least)], axis=0)
    heads = np.flatnonzero(new)
    return *(c[order[heads]] for c in columns), np.add.reduceat(n[order], heads)


def pileup(alignments: DataFrame, pieces: DataFrame) -> DataFrame:
    """(bin, contig, pos, depth, n_alt, alt_fraction, alleles) of the positions in the regions that reads lie over.

    alignments: (contig, pos, seq), a read's letters from pos on; pieces: regions as of bin_pieces(). The most frequent letter
    is the reference; alleles: `letter:count` in the order of letters.
    """
    spread = alignments.where(F.col("contig") != UNMAPPED).select("contig", F.col("pos").alias("__at"), F.posexplode(F.split("seq", "")).alias("__i", "base")).where("base <> ''")
    covered = spread.select("contig", (F.col("__at") + F.col("__i")).alias("pos"), "base").groupBy("contig", "pos", "base").agg(F.count("*").alias("n"))
    inside = covered.join(pieces.select("bin", F.col("contig"), "lo", "hi"), "contig").where("pos >= lo and pos < hi")
    alleles = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("base", "n"))), lambda a: F.concat_ws(":", a["base"], a["n"])), ",")
    depth = inside.groupBy("bin", "contig", "pos").agg(F.sum("n").alias("depth"), F.max("n").alias("top"), alleles.alias("alleles"))
    return depth.select("bin", "contig", "pos", "depth", (F.col("depth") - F.col("top")).alias("n_alt"), ((F.col("depth") - F.col("top")) / F.col("depth")).alias("alt_fraction"), "alleles")


def size_split(rows: DataFrame, by: str, size: Column, threshold: int) -> DataFrame:
    """Adds file: running bytes before a row, in the order of `by`, divided by the threshold."""
    summed = numbered_rows(rows.withColumn("__size", size.cast("long")), by, size="__size")
    return summed.withColumn("file", F.floor(F.col("before") / threshold)).drop("__size", "before", "row")


def sample_n(rows: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows in the order of a hash of their key: the same ones in any partitioning."""
    return rows.withColumn("__h", F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))).orderBy("__h", key).limit(n).drop("__h")
