"""Small tables on which the rules of the operators show."""

import itertools
import collections
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helixframe.functions import scalars, udfs
from helixframe.operators import genome, graph, matrix, molecules, neighbours, projection, sequences, vectors
from helixframe.operators.components import connected_components
from helixframe.sources import fastq
from helixframe.sources import text as src


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def written(spark, tmp_path, name, content):
    (tmp_path / name).write_text(content)
    return str(tmp_path / name)


def test_fastq_quality_line_may_begin_with_at(spark, tmp_path):
    path = written(spark, tmp_path, "tiny.fastq", "@r1 x\nACGT\n+\n@@@@\n@r2\nAC\n+\n@I\n@r3\nA\n+\n@")
    got = sorted(map(tuple, fastq.read_fastq(spark, path, 1).collect()))
    assert got == [(0, "r1 x", "ACGT", "@@@@", 1), (1, "r2", "AC", "@I", 1), (2, "r3", "A", "@", 1)]


def test_lines_are_numbered_over_blocks(spark, tmp_path):
    path = written(spark, tmp_path, "long.txt", "\n".join(f"line {i}" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = src.read_lines(spark, path).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r["ordinal"], r["line"]) for r in rows) == [(i, f"line {i}") for i in range(5000)]


def test_fasta_records_and_errors(spark, tmp_path):
    path = written(spark, tmp_path, "a.fasta", ">a|b c|x\nAC-gT\nGG\n>empty\n>p\nTT\n")
    got = {r["header"]: r["seq"] for r in src.read_fasta(spark, path).collect()}
    assert got == {"a|b c|x": "AC-gTGG", "empty": "", "p": "TT"}
    with pytest.raises(Exception, match="before any header"):
        src.read_fasta(spark, written(spark, tmp_path, "bad.fasta", "ACGT\n>x\nA\n")).collect()
    prot = src.read_fasta(spark, written(spark, tmp_path, "p.fasta", ">sp|1|A\nMK\n>tr|2|B\nLL\n>sp|3|C\nGG\n"), marker=">sp|").collect()
    assert sorted((r["header"], r["seq"]) for r in prot) == [("sp|1|A", "MK>tr|2|BLL"), ("sp|3|C", "GG")]


def test_sam_fai_matrix_manifest_tsv(spark, tmp_path):
    sam = "@SQ\tSN:chr:1\tLN:100\n@SQ\tSN:c2\tLN:50\nr1\t0\tchr:1\t7\t60\t1M\t*\t0\t0\tA\tI\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tC\tI\n"
    head, rows = src.read_sam(spark, written(spark, tmp_path, "t.sam", sam))
    assert sorted(map(tuple, src.contig_table(head).collect())) == [(0, "chr:1", 100), (1, "c2", 50)]
    assert sorted((r["name"], r["contig"], r["pos"]) for r in rows.collect()) == [("r1", "chr:1", 7), ("r2", "*", 0)]
    fai = src.read_fai(spark, written(spark, tmp_path, "t.fai", "c1\t9\t0\t60\t61\nc2\t5\t0\t60\t61\n"), 1).orderBy("ord").collect()
    assert [(r["contig"], r["is_primary"]) for r in fai] == [("c1", True), ("c2", False)]
    mtx = src.read_matrix_market(spark, written(spark, tmp_path, "t.mtx", "%%MatrixMarket\n%\n4 5 2\n1 2 0\n3 4 1.5\n")).collect()
    assert sorted(map(tuple, mtx)) == [(1, 2, 0.0), (3, 4, 1.5)]
    jobs = src.read_manifest(spark, written(spark, tmp_path, "jobs.txt", "r1\nl1\nn1\nr2\nl2\n")).collect()
    assert [tuple(j)[2:] for j in jobs] == [("r1", "l1", "n1")]
    with pytest.raises(ValueError, match="missing"):
        src.read_tsv(spark, written(spark, tmp_path, "f.csv", "Label\tStart\nx\t1\n"), "Label string, Start int", ("Label", "Start", "End"))


def test_explicit_zeros_count_for_cells_not_for_genes(spark):
    counts = table(spark, [(1, 1, 0.0), (1, 2, 3.0), (2, 1, 2.0), (3, 1, 1.0), (3, 2, 0.0)], "cell_id long, gene_id long, value double")
    assert {tuple(r) for r in matrix.genes_per_cell(counts).collect()} == {(1, 2), (2, 1), (3, 2)}
    assert {tuple(r) for r in matrix.cells_per_gene(counts).collect()} == {(1, 2), (2, 1)}
    assert matrix.filter_genes(matrix.filter_cells(counts, 2, 9), 1).count() == 4


def test_dispersion_with_flat_bins_and_ties(spark):
    binned = table(spark, [(1, 1.0, 0), (2, 1.0, 0), (3, 2.0, 0), (4, 1.0, 0), (5, 0.5, 0), (6, 3.0, 1), (7, 5.0, 1)], "gene_id long, dispersion double, bin int")
    got = {r["gene_id"]: r["dispersion_norm"] for r in matrix.dispersion_norm(binned).collect()}
    assert got[1] is None and got[3] == math.inf and got[5] == -math.inf and got[6] == pytest.approx(-0.6744897)
    chosen = matrix.select_hvg(matrix.dispersion_norm(binned), 3).where("highly_variable").collect()
    assert {r["gene_id"] for r in chosen} == {3, 7, 6, 1, 2, 4}
    assert {r["gene_id"] for r in matrix.select_hvg(matrix.dispersion_norm(binned), 2).where("highly_variable").collect()} == {3, 7}


def test_unique_names_skip_taken_numbers(spark):
    genes = table(spark, [(0, "a"), (1, "a"), (2, "a-1"), (3, "a"), (4, "b")], "ordinal long, gene_name string")
    assert [r["unique_name"] for r in matrix.unique_names(genes).orderBy("ordinal").collect()] == ["a", "a-2", "a-1", "a-3", "b"]


def test_scaling_clips_above_only_and_guards_flat_genes(spark):
    full = table(spark, [(i, 1, v) for i, v in enumerate([-500.0, *[0.0] * 200, 500.0])] + [(i, 2, 7.0) for i in range(202)], "cell_id long, gene_id long, value double")
    got = {(r["cell_id"], r["gene_id"]): r["value"] for r in matrix.scale(full, most=5.0).collect()}
    assert got[0, 1] < -5 and got[201, 1] == 5.0 and got[3, 2] == 0.0


def test_bins_snap_to_contig_ends(spark):
    contigs = table(spark, [(0, "a", 5100), (1, "b", 20000), (2, "c", 15)], "ord int, contig string, length long")
    starts = genome.contig_starts(contigs)
    ends = [r["end_pos"] for r in genome.range_bins(starts, 5, 1000).orderBy("bin").collect()]
    assert ends[0] == 5100 and ends[-1] == 25100 and all((e - 5100) % 1000 == 0 for e in ends[1:4])
    regions = [r["regions"] for r in genome.bin_regions(genome.range_bins(starts, 5, 1000), starts).orderBy("bin").collect()]
    assert regions[0] == "a:0-5100" and regions[-1].startswith("b:") and regions[-1].endswith("-20000")
    assert {r["contig"]: r["start"] for r in genome.contig_starts(contigs, 2, False).collect()} == {"a": 0, "b": 5100, "c": -1, "*": -1}


@pytest.mark.parametrize("budget", [0, 30, 100, 1000])
def test_token_batches_equal_the_greedy_scan(spark, budget):
    rng = random.Random(budget)
    rows = [(i, rng.randint(0, 40)) for i in range(300)]
    want, batch, count = {}, -1, 0
    for i, n in sorted(rows, key=lambda r: (r[1], r[0])):
        if batch < 0 or not budget or (count + 1) * n > budget:
            batch, count = batch + 1, 0
        count += 1
        want[i] = batch
    got = sequences.token_batches(table(spark, rows, "seq_id long, length long"), budget).collect()
    assert {r["seq_id"]: r["batch"] for r in got} == want


def test_failed_items_fail_the_batch(spark):
    rows = table(spark, [(1, None), (2, "no model"), (3, "x")], "i long, error string")
    with pytest.raises(Exception, match="failed items: 2, 3"):
        sequences.fail_on_errors(rows, "error", "i").collect()
    assert sequences.fail_on_errors(rows.where("i = 1"), "error", "i").count() == 1


def test_quality_of_runs_without_valid_molecules(spark):
    mols = table(spark, [(0, "a", True), (0, "a", True), (0, "b", False), (1, "a", False)], "run_id long, mol string, valid boolean")
    got = {r["run_id"]: tuple(r)[1:] for r in molecules.generation_quality(mols, table(spark, [("a",)], "mol string")).collect()}
    assert got[0] == pytest.approx((2 / 3, 0.5, 1 / 3, 0.0, 0.0)) and got[1] == (0.0, None, 0.0, None, 0.0)


def test_contacts_equal_brute_force(spark):
    rng = random.Random(1)
    points = lambda n: [(i, rng.choice("RHV"), *(rng.uniform(-9, 9) for _ in range(3))) for i in range(n)]
    a, b = points(60), points(70)
    reach = {"R": 2.1, "H": 3.7, "V": 4.0}
    schema = "id long, kind string, x double, y double, z double"
    for scale in (1.0, 2.5):
        want = {(p[0], q[0]) for p in a for q in b if math.dist(p[2:], q[2:]) <= scale * reach[q[1]]}
        got = molecules.contacts(table(spark, a, schema), table(spark, b, schema), {k: scale * c for k, c in reach.items()}).collect()
        assert {(r["pose"], r["target"]) for r in got} == want and len(got) == len(want)


def test_overlaps_at_tile_edges(spark):
    windows = molecules.tiles(table(spark, [("a", 250)], "contig string, length long"), 100)
    assert [(r["start_pos"], r["end_pos"]) for r in windows.orderBy("tile").collect()] == [(0, 100), (100, 200), (200, 250)]
    signal = table(spark, [("a", 95, 105, 1.0), ("a", 200, 201, 2.0), ("b", 0, 9, 3.0)], "contig string, start_pos long, end_pos long, value double")
    got = molecules.overlaps(signal, windows, 100, 0).collect()
    assert sorted((r["s"], r["tile"]) for r in got) == [(95, 0), (95, 1), (200, 2)]
    assert molecules.overlaps(signal, windows, 100, 5).where("s = 200").count() == 2


def test_overlaps_of_long_and_short_signals(spark):
    rng = random.Random(4)
    rows = [("a", s, s + n, float(i)) for i, (s, n) in enumerate((rng.randrange(0, 29000), rng.choice([1, 9, 80, 700, 6000, 30000])) for _ in range(60))]
    rows += [("a", 500, 500, 0.0), ("b", 0, 1 << 40, 1.0), ("c", 5, 6, 2.0)]
    signal = table(spark, rows, "contig string, start_pos long, end_pos long, value double")
    windows = molecules.tiles(table(spark, [("a", 30007), ("b", 95)], "contig string, length long"), 10).persist()
    for pad in (0, 7, 25):
        want = sorted((v, t["tile"]) for t in windows.collect() for c, s, e, v in rows if c == t["contig"] and s < e and s < t["end_pos"] + pad and e > t["start_pos"] - pad)
        assert sorted((r["value"], r["tile"]) for r in molecules.overlaps(signal, windows, 10, pad).collect()) == want


def test_a_signal_over_a_million_tiles(spark):
    windows = molecules.tiles(table(spark, [("a", 1_000_000)], "contig string, length long"), 1)
    signal = table(spark, [("a", 3, 1 << 50, 1.0), ("a", 999_999, 1_000_000, 2.0)], "contig string, start_pos long, end_pos long, value double")
    got = molecules.overlaps(signal, windows, 1, 0)
    assert [tuple(r) for r in got.groupBy("value").agg(F.count("*"), F.count_distinct("tile"), F.min("tile")).orderBy("value").collect()] == [(1.0, 999_997, 999_997, 3), (2.0, 1, 1, 999_999)]


def plain_similar_sets(rows, least):
    reps, want = {}, set()
    for i, items in sorted(rows, key=lambda r: r[0]):
        group = frozenset(x for x in items or () if x is not None)
        if group and reps.setdefault(group, i) != i:
            want.add((reps[group], i, 1.0))
    for (f, a), (g, b) in itertools.combinations(reps.items(), 2):
        if len(f & g) / len(f | g) >= least:
            want.add((min(a, b), max(a, b), len(f & g) / len(f | g)))
    return want


@pytest.mark.parametrize("least", [0.07, 0.4, 0.8, 1.0])
def test_similar_sets_against_all_pairs(spark, least):
    rng = random.Random(8)
    rows = [(i, [f"w{int(rng.paretovariate(0.7)) % 60}" for _ in range(rng.choice([1, 2, 5, 15, 40]))]) for i in range(150)]
    rows += [(200 + i, list(rows[i % 3][1]) + [None]) for i in range(9)] + [(300, []), (301, None), (302, [None]), (303, ["hot"]), (304, ["hot", "hot"])]
    rows += [(400 + i, [f"t{j}" for j in range(20) if j != i]) for i in range(12)]
    frame = table(spark, [(i, x, "clash") for i, x in rows], "id long, items array<string>, n string")
    got = [(r["a"], r["b"], r["similarity"]) for r in molecules.similar_sets(frame, least).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_similar_sets(rows, least)
    assert molecules.similar_sets(frame.limit(0), least).count() == 0


def test_similar_sets_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(molecules, "SET_ITEMS", 150)
    monkeypatch.setattr(molecules, "SET_CELLS", 64)
    rng = random.Random(9)
    rows = [(i, [f"w{j}" for j in rng.sample(range(30), rng.choice([2, 5, 6, 14, 28]))]) for i in range(90)]
    got = [(r["a"], r["b"], r["similarity"]) for r in molecules.similar_sets(table(spark, rows, "id long, items array<string>"), 0.4).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_similar_sets(rows, 0.4)


def test_knn_with_duplicates_and_few_rows(spark, monkeypatch):
    rows = [(i, [float(i // 2), 0.0]) for i in range(7)]
    frame = table(spark, rows, "id long, vec array<float>")
    for block in (4096, 3):
        monkeypatch.setattr(vectors, "BLOCK", block)
        got = {(r["src"], r["rank"]): (r["dst"], r["d"]) for r in vectors.knn(frame, 3).collect()}
        assert len(got) == 21 and got[1, 1] == (1, 0.0) and got[1, 2] == (0, 0.0) and got[1, 3] == (2, 1.0)
    assert vectors.knn(frame, 20).count() == 49
    assert vectors.knn_params(5, 15) == 3 and vectors.knn_params(50, 15) == 15
    with pytest.raises(ValueError):
        vectors.knn_params(50, 15, "umap", use_knn=False)


def test_rows_meet_few_blocks(spark):
    rows = spark.range(40_000).select("id", F.array(F.col("id").cast("float")).alias("vec"))
    met = vectors.block_pairs(rows, lambda ids, a, names, b: [[len(ids)], [len(names)]], "mine long, others long")
    assert met.agg(F.sum("mine"), F.sum("others")).first() == (8 * 40_000, 8 * 40_000)  # ten blocks of 4,096 before


@pytest.mark.parametrize("block", [1 << 16, 7])
def test_kernel_sums_equal_the_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rng = random.Random(5)
    frame = table(spark, [(3 * i, [rng.gauss(i % 4 * 5, 1) for _ in range(3)]) for i in range(60)], "id long, vec array<double>")
    pairs = vectors.gauss_kernel_dense(frame, 5).groupBy("src").agg(F.count("*").alias("n"), F.sum("w").alias("total")).collect()
    sums = vectors.gauss_kernel_sums(frame, 5).collect()
    assert {(r["src"], r["n"], round(r["total"], 9)) for r in sums} == {(r["src"], r["n"], round(r["total"], 9)) for r in pairs} and len(sums) == 60


def test_memberships_and_affinities_reach_their_targets(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(120)]
    near = vectors.knn(table(spark, rows, "id long, vec array<double>"), 15).persist()
    sums = vectors.fuzzy_memberships(near, 15).groupBy("src").agg(F.sum("w").alias("s")).collect()
    assert all(r["s"] == pytest.approx(math.log2(15), abs=1e-4) for r in sums)
    entropy = vectors.perplexity_affinities(near, 4.0).groupBy("src").agg(F.sum(-F.col("p") * F.ln("p")).alias("h"), F.sum("p").alias("s")).collect()
    assert all(r["h"] == pytest.approx(math.log(4), abs=1e-4) and r["s"] == pytest.approx(1) for r in entropy)


def pairs_of(rows):
    return {(r["src"], r["dst"]) for r in rows.collect()}


def test_approximate_neighbours_recall(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(i % 5 * 4, 0.3) for _ in range(6)]) for i in range(200)]
    frame = table(spark, rows, "id long, vec array<double>")
    exact, found = pairs_of(vectors.knn(frame, 8)), pairs_of(neighbours.knn_approx(frame, 8))
    assert len(exact & found) / len(exact) > 0.9


def test_approximate_neighbours_compare_few_pairs(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((6000, 5)) @ rng.standard_normal((5, 32)) + 0.05 * rng.standard_normal((6000, 32))
    frame = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id long, vec array<double>").repartition(8)
    tally = spark.sparkContext.accumulator(0)
    rows = neighbours.knn_approx(frame, 8, width=9, tally=tally).collect()
    exact = pairs_of(vectors.knn(frame, 8))
    found = {(r["src"], r["dst"]) for r in rows}
    assert len(found) == len(rows) == 8 * 6000 and {r["rank"] for r in rows if r["src"] == r["dst"]} == {1}
    assert len(exact & found) / len(exact) >= 0.9
    assert 2 * tally.value / 6000**2 < 0.1  # of all ordered pairs, those that several lists compare again counted again


def test_approximate_neighbours_of_copies_hubs_and_few_rows(spark):
    schema = "id long, vec array<double>"
    copies = table(spark, [(i, [1.0, 2.0]) for i in range(300)] + [(300 + i, [float(i), -5.0]) for i in range(100)] + [(999, None)], schema)
    rows = neighbours.knn_approx(copies, 5).collect()
    assert len(rows) == 400 * 5 and 999 not in {r["src"] for r in rows}
    assert all(r["d"] == 0 and r["dst"] < 300 for r in rows if r["src"] < 300)
    rng = random.Random(3)
    hub = table(spark, [(0, [0.0] * 8)] + [(i, [rng.gauss(0, 1) * 3 for _ in range(8)]) for i in range(1, 500)], schema)  # all list the middle
    exact, found = pairs_of(vectors.knn(hub, 5)), pairs_of(neighbours.knn_approx(hub, 5))
    assert len(exact & found) / len(exact) >= 0.9
    few = table(spark, [(1, [0.0]), (2, [3.0])], schema)
    assert [(r["src"], r["dst"], r["d"], r["rank"]) for r in neighbours.knn_approx(few, 5).orderBy("src", "rank").collect()] == [(1, 1, 0.0, 1), (1, 2, 3.0, 2), (2, 2, 0.0, 1), (2, 1, 3.0, 2)]
    assert neighbours.knn_approx(few.limit(1), 5).count() == 1 and neighbours.knn_approx(few.limit(0), 5).count() == 0
    assert pairs_of(neighbours.choose_neighbours(hub, 5)) == exact
    assert neighbours.choose_neighbours(hub, 5, exact_rows=10).count() == 2500 and neighbours.choose_neighbours(few, 5).count() == 4


@pytest.mark.parametrize("blocks", [6, 2])
def test_projection_of_wide_vectors_equals_the_dense_one(spark, monkeypatch, blocks):
    monkeypatch.setattr(projection, "BLOCKS", blocks)
    rng = np.random.default_rng(5)
    x = rng.standard_normal((400, 60)) * np.linspace(3, 0.5, 60) @ rng.standard_normal((60, 240)) + rng.standard_normal(240) + 0.2 * rng.standard_normal((400, 240))
    frame = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)] + [(400, None)], "id long, vec array<double>").repartition(5)
    model = projection.fit(frame, 20)
    _, s, vt = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)
    assert model.explained == pytest.approx((s**2 / (s**2).sum())[:20].tolist(), abs=1e-9)
    assert np.abs((model.components * vt[:20].T).sum(axis=0)) == pytest.approx(np.ones(20), abs=1e-6)
    assert model.passes < 12
    got = {r["id"]: r["pcs"] for r in projection.project(model, frame).collect()}
    assert got[400] is None and np.array([got[i] for i in range(400)]) == pytest.approx((x - x.mean(axis=0)) @ model.components, abs=1e-9)


def test_projection_of_few_dimensions_equal_rows_and_errors(spark):
    few = table(spark, [(i, [float(i), 2.0 * i, 7.0]) for i in range(9)], "id long, vec array<float>")
    model = projection.fit(few, 50)
    assert model.components.shape == (3, 3) and model.explained == pytest.approx([1, 0, 0], abs=1e-12)
    same = projection.fit(table(spark, [(i, [1.0] * 30) for i in range(5)], "id long, vec array<double>"), 4)
    assert same.explained.tolist() == [0.0] * 4 and same.components.shape == (30, 4)
    line = projection.fit(table(spark, [(i, [float(i * j) for j in range(40)]) for i in range(8)], "id long, vec array<double>"), 5)
    assert line.explained == pytest.approx([1, 0, 0, 0, 0], abs=1e-9)
    for rows in ([(1, [1.0])], [(1, [1.0]), (2, [1.0, 2.0])], [(1, [1.0, None]), (2, [1.0, 2.0])]):
        with pytest.raises(ValueError):
            projection.fit(table(spark, rows, "id long, vec array<double>"), 2)


def test_geodesic_and_mahalanobis(spark):
    row = table(spark, [([0.0, 0.0], [0.0, math.pi / 2])], "a array<double>, b array<double>")
    got = row.select(vectors.metric("haversine", F.col("a"), F.col("b")), vectors.mahalanobis(F.col("a"), F.col("b"), [[1.0, 0.0], [0.0, 4.0]])).first()
    assert got[0] == pytest.approx(math.pi / 2) and got[1] == pytest.approx(math.pi)


def test_classifier_beats_the_majority_class(spark):
    rng = random.Random(6)
    rows = [(i, [rng.gauss(3 * (i % 3 == d), 1.0) for d in range(4)], i % 3) for i in range(300)]
    frame = table(spark, rows, "id long, vec array<double>, label int")
    got = vectors.classify(frame.where("id < 200"), frame.where("id >= 200")).collect()
    assert len(got) == 100 and sum(r["label"] == r["predicted"] for r in got) > 80


def cliques(spark, sizes, bridges=()):
    edges, at = [], 0
    for n in sizes:
        edges += list(itertools.permutations(range(at, at + n), 2))
        at += n
    edges += [e for a, b in bridges for e in ((a, b), (b, a))]
    return table(spark, [(a, b, 1.0) for a, b in edges], "src long, dst long, w double")


def test_communities_of_cliques(spark):
    edges = cliques(spark, [6, 5, 7], [(0, 6), (7, 12)]).persist()
    for found in (graph.louvain(edges), graph.leiden(edges), graph.leiden(edges, refine=True)):
        groups = {}
        for r in found.collect():
            groups.setdefault(r["community"], set()).add(r["node"])
        assert sorted(map(sorted, groups.values())) == [list(range(6)), list(range(6, 11)), list(range(11, 18))]
        assert graph.modularity(edges, found).agg(F.sum("q")).first()[0] > 0.5


@pytest.mark.parametrize("size", [1 << 20, 60])
def test_rounds_find_their_modularity(spark, monkeypatch, size):
    """F3, F4, F8: edges are packed once a level, and a round scores the labels that it begins with; blocks of 60 edges are several."""
    edges = cliques(spark, [6, 5, 7, 9, 4, 8], [(0, 6), (7, 12), (14, 18), (20, 28), (30, 31)]).persist()
    singles = edges.select(F.col("src").alias("node")).distinct().withColumn("community", F.col("node"))
    m2, score = float(edges.agg(F.sum("w")).first()[0]), graph._score
    monkeypatch.setattr(graph, "BLOCK_EDGES", size)
    with monkeypatch.context() as inner:
        inner.setattr(graph, "_score", None)
        labels, found = graph._settled(edges, singles, m2, 1.0, 1e-4)
    assert labels.count() == 39 and found == pytest.approx(score(edges, labels, m2, 1.0)) and found > 0.6
    if size == 60:
        return
    groups = {}
    for r in graph.leiden(edges).collect():
        groups.setdefault(r["community"], set()).add(r["node"])
    assert sorted(map(sorted, groups.values())) == [list(range(a, b)) for a, b in itertools.pairwise([0, 6, 11, 18, 27, 31, 39])]


def test_components_by_parts(spark):
    """forests of parts give the same components, whether one part holds all edges or none does."""
    path = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (700, 700), (None, 3), (-4, 900)]
    edges = table(spark, path, "src long, dst long").persist()
    want = set(map(tuple, connected_components(edges).collect()))
    for size in (1000, 150, 20):
        assert set(map(tuple, connected_components(edges, part_edges=size).collect())) == want


def plain_gains(w, labels, parts, resolution):
    """What single, well connected nodes could still gain by joining a well connected part of their community."""
    n, k, m, out = len(w), w.sum(axis=1), w.sum(), []
    members = {p: [i for i in range(n) if parts[i] == p] for p in set(parts)}

    def firm(some):
        rest = [i for i in range(n) if labels[i] == labels[some[0]] and i not in some]
        return sum(w[i, j] for i in some for j in rest) >= resolution * sum(k[i] for i in some) * sum(k[j] for j in rest) / m

    for p, mine in members.items():
        if len(mine) == 1 and firm(mine):
            i = mine[0]
            out += [w[i, to].sum() - resolution * k[i] * k[to].sum() / m for q, to in members.items() if q != p and labels[to[0]] == labels[i] and w[i, to].sum() > 0 and firm(to)]
    return out


@pytest.mark.parametrize("resolution", [1.0, 0.3, 4.0])
def test_refined_parts_are_connected_and_complete(spark, resolution):
    import numpy as np

    rng, n = random.Random(12), 60
    w = np.zeros((n, n))
    for i, j in itertools.combinations(range(n), 2):
        if rng.random() < (0.5 if i // 6 == j // 6 else 0.04):
            w[i, j] = w[j, i] = rng.choice([1.0, 2.0, 0.5])
    for i in range(n - 1):  # no node without an edge
        w[i, i + 1] = w[i + 1, i] = max(w[i, i + 1], 0.25)
    w[7, 7] = 3.0
    edges = table(spark, [(i, j, float(w[i, j])) for i in range(n) for j in range(n) if w[i, j]], "src long, dst long, w double").persist()
    labels = [i % 12 // 6 * 100 + i // 30 for i in range(n)]
    found = dict(map(tuple, graph.refined(edges, table(spark, list(enumerate(labels)), "node long, community long"), float(w.sum()), resolution).collect()))
    parts = [found[i] for i in range(n)]
    groups = {p: {i for i in range(n) if parts[i] == p} for p in parts}
    assert sorted(found) == list(range(n)) and 2 < len(groups) < n
    for mine in groups.values():
        assert len({labels[i] for i in mine}) == 1
        seen, todo = set(), [min(mine)]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += [y for y in mine if w[x, y]]
        assert seen == mine
    assert all(g <= 1e-9 for g in plain_gains(w, labels, parts, resolution))


def test_refinement_parts_weakly_joined_cliques(spark):
    edges = cliques(spark, [6, 5, 7], [(0, 6), (7, 12)])
    light = F.least("src", "dst").isin(0, 7) & F.greatest("src", "dst").isin(6, 12)  # the two bridges
    edges = edges.withColumn("w", F.when(light, 0.1).otherwise(F.col("w")))
    together = edges.select(F.col("src").alias("node")).distinct().withColumn("community", F.lit(0).cast("long"))
    m2 = edges.agg(F.sum("w")).first()[0]
    found = dict(map(tuple, graph.refined(edges, together, m2).collect()))
    kinds = [{found[i] for i in block} for block in (range(6), range(6, 11), range(11, 18))]
    assert not (kinds[0] & kinds[1] or kinds[1] & kinds[2] or kinds[0] & kinds[2])
    assert graph.refined(edges.limit(0), together.limit(0), 1.0).count() == 0


def test_components_of_paths_and_loops(spark):
    path = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 500), (700, 700), (None, 3)]
    got = {r["node"]: r["component"] for r in connected_components(table(spark, path, "src long, dst long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500, 700: 700}
    assert connected_components(table(spark, [], "src long, dst long")).count() == 0


def test_eigenvectors_and_pseudotime(spark):
    edges = cliques(spark, [6, 5], [(0, 6)])
    t = graph.transition_matrix(edges).select("src", "dst", "t").persist()
    values, vecs = graph.diffusion_eigen(t, 3)
    assert values[0] == pytest.approx(1.0, abs=1e-6) and 0.5 < values[1] < 1
    v = {r["node"]: r["vec"][1] for r in vecs.collect()}
    moved = {}
    for r in t.collect():
        moved[r["src"]] = moved.get(r["src"], 0) + r["t"] * v[r["dst"]]
    assert all(moved[n] == pytest.approx(values[1] * v[n], abs=1e-5) for n in v)
    parts = table(spark, [(n, 0 if n < 10 else 9) for n in range(11)], "node long, component long")
    row = graph.pseudotime(graph.dpt_row(vecs, values, 0, parts)).collect()
    times = {r["node"]: r["pseudotime"] for r in row}
    assert times[0] == 0 and times[10] == math.inf and max(x for n, x in times.items() if n != 10) == 1.0


def test_functions(spark):
    row = table(spark, [(float("nan"), "A10-12/0 B5-5")], "x double, r string")
    got = row.select(scalars.nan_to_num(F.col("x")), scalars.expand_ranges(F.col("r"))).first()
    assert got[0] == 0.0 and [tuple(p) for p in got[1]] == [("A", 10), ("A", 11), ("A", 12), ("B", 5)]
    full = table(spark, [(i, 1, 2.0 + 3 * i, float(i)) for i in range(6)], "cell_id long, gene_id long, value double, n_counts double")
    assert all(abs(r["value"]) < 1e-9 for r in udfs.per_gene_fit(full, udfs.LEAST_SQUARES, ["n_counts"]).collect())
    seqs = table(spark, [(1, "ABCD"), (2, "A")], "seq_id long, seq string")
    assert {r["seq_id"]: r["score"] for r in udfs.score_in_batches(seqs, udfs.kmer_hash_scorer()).collect()}[2] == 0.0


@pytest.mark.parametrize("partitions", [1, 7])
def test_results_do_not_depend_on_partitions(spark, partitions):
    rows = table(spark, [(i * 7 % 1009, i % 5) for i in range(1009)], "id long, x int").repartition(partitions)
    got = {r["id"]: r["row"] for r in matrix.numbered_rows(rows, "id").collect()}
    assert got == {i: i for i in range(1009)}


def test_common_keys_are_split_without_loss(spark):
    rng = random.Random(5)
    a = [(i, rng.choice("xxxxyz")) for i in range(90)]
    b = [(i, rng.choice("xxyyw")) for i in range(70)]
    want = sorted((i, j, k) for i, k in a for j, m in b if k == m)
    for most in (7, 1000):
        got = genome.split_join(table(spark, a, "i long, k string"), table(spark, b, "j long, k string"), "k", most)
        assert sorted((r["i"], r["j"], r["k"]) for r in got.collect()) == want


def test_numbers_and_running_sums_of_repeated_rows(spark):
    rows = table(spark, [(i % 7, 3) for i in range(500)] + [(-5, 2)], "x int, size int").repartition(6)
    got = sorted((r["row"], r["x"], r["before"]) for r in matrix.numbered_rows(rows, "x", size="size").collect())
    assert [g[0] for g in got] == list(range(501)) and [g[1] for g in got] == sorted(g[1] for g in got)
    assert [g[2] for g in got] == [0, *(2 + 3 * i for i in range(500))]


def test_shards_keep_their_order_and_one_header(spark):
    rows = table(spark, [(i % 3, i, f"row {i}") for i in range(400)], "shard int, pos int, line string").repartition(4)
    path = src.write_shards(rows, ["pos"], "t", "#head")
    lines = [r["line"] for r in src.ordered_lines(spark, src.concat_shards(spark, path, "u", "#")).orderBy("place").collect()]
    assert lines == ["#head", *(f"row {i}" for s in range(3) for i in range(s, 400, 3))]


def test_fasta_runs_lists_and_manifests(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(src, "RUN_LINES", 4)
    path = written(spark, tmp_path, "r.fasta", "".join(f">h{i}\n" + "AC\n" * (i % 5) for i in range(60)))
    assert {r["header"]: r["seq"] for r in src.read_fasta(spark, path).collect()} == {f"h{i}": "AC" * (i % 5) for i in range(60)}
    assert {r["header"]: r["length"] for r in src.fasta_lengths(spark, path).collect()} == {f"h{i}": 2 * (i % 5) for i in range(60)}
    names = table(spark, [("a",), ("b",)], "name string")
    (tmp_path / "s" / "a").mkdir(parents=True)
    written(spark, tmp_path / "s" / "a", "x.txt", "x")
    files = src.list_files(spark, str(tmp_path / "s"))
    assert [r["name"] for r in src.missing_shards(spark, names, files).collect()] == ["b"]
    with pytest.raises(FileNotFoundError, match="b"):
        src.require_shards(spark, names, files)
    lines = written(spark, tmp_path, "c.jsonl", '{"d1": {"A": [1, 2], "B": []}}\n\n{"d2": {"A": [7]}}\n')
    assert sorted(map(tuple, src.read_constraints(spark, lines).collect())) == [("d1", "A", 1), ("d1", "A", 2), ("d2", "A", 7)]


def test_glm_rules_and_repeated_poses(spark):
    full = table(spark, [(c, 1, 5.0) for c in range(4)] + [(c, 2, 2.0 * c) for c in range(4)] + [(c, 3, float(c * c)) for c in range(4)], "cell_id long, gene_id long, value double")
    left = table(spark, [(c, g, 1e-12 if g < 3 else c - 1.0) for g in (1, 2, 3) for c in range(4)], "cell_id long, gene_id long, value double")
    got = {(r["gene_id"], r["cell_id"]): r["value"] for r in matrix.regress_out_glm(full, left).collect()}
    assert got[1, 3] == 5.0 and got[2, 3] == 0.0 and got[3, 3] == 2.0
    poses = table(spark, [(1, -2.0, 0.0, 0.0, 0.0)] * 2 + [(1, -1.0, 9.0, 0.0, 0.0)], "ligand long, energy double, x double, y double, z double")
    assert sorted(r["cluster"] for r in molecules.pose_clusters(poses).collect()) == [0, 0, 1]


def test_pose_clusters_against_one_pose_after_another(spark, monkeypatch):
    monkeypatch.setattr(molecules, "POSES", 100)
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 2, 2, 2, 9]), *(float(rng.randrange(m)) for m in (5, 6, 4, 3))) for _ in range(400)]
    want = []
    for ligand in {r[0] for r in rows}:
        leaders = []
        for r in sorted(r for r in rows if r[0] == ligand):
            near = [i for i, p in enumerate(leaders) if math.dist(p, r[2:]) <= 2]
            leaders += [] if near else [r[2:]]
            want.append((*r, near[0] if near else len(leaders) - 1))
    frame = molecules.pose_clusters(table(spark, rows, "ligand long, energy double, x double, y double, z double"))
    assert sorted(map(str, map(tuple, frame.collect()))) == sorted(map(str, want))
    assert "FlatMapGroupsInArrow" in frame._jdf.queryExecution().toString()  # many ligands a call, not one


def test_rounded_components_keep_their_sign(spark):
    from helixframe.plans.molecules import rounded

    row = table(spark, [(1, [-1e-7, 1e-7, -0.0, -0.25, 0.1234565])], "id long, vec array<double>").select(rounded("vec").alias("v")).first()
    assert list(map(repr, row["v"])) == ["-0.0", "0.0", "-0.0", "-0.25", "0.123457"]
    grid = molecules.grid_around(table(spark, [(1, [-0.0], [0.0], [0.0])], "id long, vec array<float>, x array<double>, y array<double>"), 0.5, 1)
    assert {repr(r["vec"][0]) for r in grid.collect()} == {"0.0"}


def test_exploded_kmers_are_not_broadcast(spark):
    from helixframe.operators import scratch

    rows = table(spark, [(i, "ACGTTGCA" * 3) for i in range(4)], "id long, seq string")
    rows = scratch.kept_table(rows.withColumn("seq", F.repeat("seq", 2)))
    cut = genome.kmers(rows, "id", "seq", 5)
    joined = genome.split_join(cut.select("id", "kmer"), cut.select(F.col("id").alias("of"), "kmer"), "kmer")
    plan = joined._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("SortMergeJoin") == 3 and plan.count("BroadcastHashJoin") == 2  # broadcast: the common keys, once a side
    assert joined.count() == sum(n * n for (n,) in cut.groupBy("kmer").count().select("count").collect())


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from helixframe.operators import scratch

    class Session:
        conf = type("C", (), {"get": staticmethod(lambda *_: None)})
        sparkContext = type("X", (), {"master": "spark://host:7077"})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_folder(Session())


def test_sequence_search_equals_all_pairs(spark):
    """Repeats, short, empty and null sequences, a motif that all share, ties, and a map of few bits that lets more through."""
    rng = random.Random(8)
    motif = "HOTHOTHOT"
    seqs = {i: "".join(rng.choice("ACDE") for _ in range(rng.randint(0, 60))) + motif for i in range(60)}
    seqs |= {100: seqs[0], 101: seqs[0], 102: "", 103: None, 104: "ACD", 105: "Z" * 5000}
    table = spark.createDataFrame(list(seqs.items()), "id long, seq string").repartition(3)
    asked = [i for i in seqs if i % 10 == 0]
    sets = {i: {t[a : a + 5] for a in range(len(t or "") - 4)} if t else set() for i, t in seqs.items()}
    want = []
    for q in asked:
        found = sorted((-len(sets[q] & sets[d]), d) for d in seqs if d != q and sets[q] & sets[d])[:3]
        want += [(q, d, -n, -n / len(sets[q]), -n / len(sets[q] | sets[d]), i + 1) for i, (n, d) in enumerate(found)]
    got = sequences.search_database(table.where("id % 10 = 0"), table, 5).collect()
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert sequences.search_database(table.limit(0), table, 5).count() == 0 == sequences.search_database(table, table.limit(0), 5).count()
    with pytest.raises(ValueError, match="64 bits"):
        sequences.kmer_sets(pa.array(["A"]), 13)
    with pytest.raises(ValueError, match="A to Z"):
        sequences.kmer_sets(pa.array(["a-B"]), 3)


def test_sequence_search_counts_in_tasks_whatever_the_blocks(spark, monkeypatch):
    """One row a query and task leaves a task at most k_top times, though pairs of a shared motif are many; several blocks give the same rows."""
    rng = random.Random(5)
    seqs = [(i, "".join(rng.choice("ACDE") for _ in range(rng.randint(3, 50))) + "HOTHOTHOT") for i in range(90)]
    table = spark.createDataFrame(seqs, "id long, seq string").repartition(2)
    whole = sorted(map(tuple, sequences.search_database(table, table, 6).collect()))
    assert len(whole) == 270
    monkeypatch.setattr(sequences, "QUERY_KMERS", 400)
    assert sorted(map(tuple, sequences.search_database(table, table, 6).collect())) == whole
    block = sequences._QueryBlock(pa.table({"query": [1, 2], "nq": [3, 2], "kmers": pa.array([[1, 5, 9], [5, 9]], pa.list_(pa.int64()))}))
    assert block.shared(np.array([5, 7, 9])).tolist() == [2, 2] and block.shared(np.array([1, 10])).tolist() == [1, 0]


def test_contacts_of_crowded_cells_spread_over_tasks(spark):
    """All pairs by brute force, on borders of cells and of cutoffs too; the work isn't put into one task because its rows are few."""
    rng = random.Random(6)
    point = lambda: tuple(rng.choice([rng.uniform(-6, 6), float(rng.randint(-6, 6)), rng.randint(-6, 6) + 0.1]) for _ in "xyz")
    poses = [(i, "", *point()) for i in range(300)] + [(900, "", math.nan, 0.0, 0.0), (901, "", None, 0.0, 0.0)]
    targets = [(i, "RHVX"[i % 4], *point()) for i in range(80)] + [(90, "V", math.nan, 0.0, 0.0), (91, "V", 0.0, None, 0.0)]
    table = lambda rows: spark.createDataFrame(rows, "id long, kind string, x double, y double, z double").repartition(3, "id")
    out = molecules.contacts(table(poses), table(targets))
    cut = molecules.CONTACT_CUTOFFS
    square = lambda p, t: (p[2] - t[2]) * (p[2] - t[2]) + (p[3] - t[3]) * (p[3] - t[3]) + (p[4] - t[4]) * (p[4] - t[4])
    want = [(p[0], t[0], t[1]) for p in poses[:300] for t in targets[:80] if t[1] in cut and square(p, t) <= cut[t[1]] * cut[t[1]]]
    assert want and sorted(map(tuple, out.collect())) == sorted(want)
    assert out.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_screening_keeps_nulls_and_spreads_few_receptors_over_tasks(spark):
    ligands, receptors = table(spark, [(i,) for i in range(9000)] + [(None,)], "ligand long"), table(spark, [(i,) for i in range(600)] + [(None,), (5,)], "receptor long")
    found = molecules.screening(ligands, receptors)
    sums = found.agg(F.count("*"), F.countDistinct("ligand", "receptor"), F.sum("ligand"), F.sum("receptor"), F.count_if(F.col("ligand").isNull()), F.count_if(F.col("receptor").isNull())).first()
    assert tuple(sums) == (9001 * 602, 9000 * 600, 602 * sum(range(9000)), 9001 * (5 + sum(range(600))), 602, 9001)
    assert found.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    assert molecules.screening(ligands.limit(0), receptors).count() == molecules.screening(ligands, receptors.limit(0)).count() == 0


def test_eigenvectors_over_many_buckets_need_few_products(spark, monkeypatch):
    rng, n, sent = np.random.default_rng(5), 240, []
    x = rng.standard_normal((n, 3))
    near = np.argsort(((x[:, None] - x) ** 2).sum(axis=2), axis=1)[:, 1:6]
    pairs = {(min(a, b), max(a, b)) for a, row in enumerate(near.tolist()) for b in row}
    edges = table(spark, [e for a, b in sorted(pairs) for e in ((a, b, 1.0), (b, a, 1.0))], "src long, dst long, w double")
    t = graph.transition_matrix(edges).select("src", "dst", "t").localCheckpoint()
    product = graph._product
    monkeypatch.setattr(graph, "BUCKET_EDGES", 500)
    monkeypatch.setattr(graph, "LINK_EDGES", 100, raising=False)
    monkeypatch.setattr(graph, "_product", lambda *a: sent.append(len(a[1].first()["now"]) // 8) or product(*a))
    values, vecs = graph.diffusion_eigen(t, 8)
    dense, v = np.zeros((n, n)), np.array([r["vec"] for r in vecs.orderBy("node").collect()])
    for r in t.collect():
        dense[r["src"], r["dst"]] = r["t"]
    want = np.linalg.eigvalsh(dense)
    assert values == pytest.approx(sorted(want[np.argsort(-np.abs(want))[:8]], reverse=True), abs=1e-9)
    assert np.abs(dense @ v - v * values).max() < 1e-6 and np.abs(v.T @ v - np.eye(8)).max() < 1e-9
    assert len(sent) <= 41 and sum(sent) < 750, (len(sent), sum(sent))  # columns that products are made of


def test_columns_side_by_side_take_one_shuffle(spark, monkeypatch):
    monkeypatch.setattr(graph, "PART_BYTES", 1 << 12)
    rng, n = np.random.default_rng(6), 300
    held = [rng.standard_normal((n, 3 + i)) for i in range(12)]
    state = lambda x, i: spark.createDataFrame([(j, [0, j], x[j].tobytes()) for j in rng.permutation(n).tolist()], "node long, to array<int>, now binary")
    beside = graph._beside([state(x, i) for i, x in enumerate(held)], sum(x.size for x in held))
    rows = {r["node"]: (r["to"], np.frombuffer(r["now"])) for r in beside.collect()}
    assert len(rows) == n and all(rows[j][0] == [0, j] and (rows[j][1] == np.hstack([x[j] for x in held])).all() for j in range(n))
    plan = beside._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FlatMapGroupsInArrow") == 1 and "Join" not in plan


def test_kernel_sums_work_out_a_weight_once(spark, monkeypatch):
    monkeypatch.setattr(vectors, "TILE", (4, 8), raising=False)
    monkeypatch.setattr(vectors, "BLOCK", 20)
    rng, worked = random.Random(9), spark.sparkContext.accumulator(0)
    rows = [(7 * i, [rng.gauss(0, 1) for _ in range(3)]) for i in range(70)] + [(1000 + i, [50.0, 0.0, 0.0]) for i in range(8)]  # copies have no scale
    frame = table(spark, rows, "id long, vec array<double>").persist()
    pairs = vectors.gauss_kernel_dense(frame, 5).where("w > 0").groupBy("src").agg(F.count("*").alias("n"), F.sum("w").alias("total")).collect()
    pair = vectors.block_pairs

    def counted(rows, f, schema, **how):
        def g(ids, a, names, b):
            worked.add(len(ids) * len(names))
            return f(ids, a, names, b)

        return pair(rows, g, schema, **how)

    monkeypatch.setattr(vectors, "_scaled", lambda *a, own=vectors._scaled(frame, 5).persist(): own)
    monkeypatch.setattr(vectors, "block_pairs", counted)
    sums = vectors.gauss_kernel_sums(frame, 5).collect()
    assert {(r["src"], r["n"], round(r["total"], 7)) for r in sums} == {(r["src"], r["n"], round(r["total"], 7)) for r in pairs} and len(sums) == 70
    assert worked.value < 0.75 * 78 * 78  # all ordered pairs before


@pytest.mark.parametrize("kind", ["far", "copies", "plain"])
def test_neighbours_far_from_zero_and_among_copies(spark, monkeypatch, kind):
    monkeypatch.setattr(vectors, "STRIP", 5000)
    rng = np.random.default_rng(10)
    x = rng.standard_normal((700, 4)) * (1e-2 if kind == "far" else 1) + (3e4 if kind == "far" else 0)
    if kind == "copies":
        x[100:400] = x[7]
    frame = spark.createDataFrame([(i, row) for i, row in enumerate(x.tolist())], "id long, vec array<double>")
    square = np.round(((x[:, None] - x) ** 2).sum(axis=2), 9)
    np.fill_diagonal(square, -1)
    want = {i: sorted(range(700), key=lambda j, i=i: (square[i, j], j))[:6] for i in range(700)}
    got = {}
    for row in vectors.knn(frame, 6).orderBy("src", "rank").collect():
        got.setdefault(row["src"], []).append(row["dst"])
    assert got == want


@pytest.mark.parametrize("k", [3, 15])
def test_seed_votes_equal_all_windows(spark, monkeypatch, k):
    """Repeats, copies, ties, rows of one id, empty and null sequences and a null id; many blocks, pieces and lists of seeds."""
    monkeypatch.setattr(genome, "READ_LETTERS", 400, raising=False)
    monkeypatch.setattr(genome, "CONTIG_LETTERS", (300, 300), raising=False)
    monkeypatch.setattr(genome, "PIECE_LETTERS", 100, raising=False)
    monkeypatch.setattr(genome, "SEED_PAIRS", 50, raising=False)
    rng = random.Random(11)
    word = [("".join(rng.choice("ACGT") for _ in range(20))) for _ in range(12)]
    make = lambda: "".join(rng.choice(word)[rng.randint(0, 3) :] for _ in range(rng.randint(0, 5)))
    sides = [[(i * 7, make()) for i in range(60)] + [(1, None), (2, ""), (5, "ZZZZ" * 9), (None, make() + word[0]), (7, make() + word[1])] for _ in range(2)]
    windows = [[(i, a, s[a : a + k]) for i, s in rows if s for a in range(len(s) - k + 1)] for rows in sides]
    votes = collections.Counter()
    at = collections.defaultdict(list)
    for i, a, seed in windows[1]:
        at[seed].append((i, a))
    for i, a, seed in windows[0]:
        votes.update((i, j, b - a) for j, b in at[seed])
    want = {}
    for (i, j, d), n in votes.items():
        want[i] = min(want.get(i, (0, 0, 0, 0)), (-n, math.inf if j is None else j, d, j))
    frames = [table(spark, rows, "id long, seq string") for rows in sides]
    got = genome.seed_votes(*frames, k)
    rows = got.collect()
    assert {r["read"]: (r["contig"], r["diagonal"], r["votes"]) for r in rows} == {i: (j, d, -n) for i, (n, _, d, j) in want.items()} and len(rows) == len(want) > 40
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in plan and plan.count("FlatMapGroupsInArrow") == 1
    assert genome.seed_votes(frames[0].limit(0), frames[1], k).count() == 0


def test_sequence_search_looks_a_piece_up_at_once(spark, monkeypatch):
    rng = random.Random(12)
    seqs = [(i, "".join(rng.choice("ACDE") for _ in range(rng.randint(3, 80)))) for i in range(120)]
    frame = spark.createDataFrame(seqs, "id long, seq string").coalesce(1)
    whole = sorted(map(tuple, sequences.search_database(frame.where("id % 3 = 0"), frame, 4).collect()))
    block = sequences._QueryBlock(pa.table({"query": [i for i, _ in seqs], "nq": [len({*s}) for _, s in seqs], "kmers": pa.array([sorted({ord(c) & 31 for c in s}) for _, s in seqs], pa.list_(pa.int64()))}))
    asked, held = [], sequences._QueryBlock.held
    monkeypatch.setattr(sequences._QueryBlock, "held", lambda self, kmers: asked.append(len(kmers)) or held(self, kmers), raising=False)
    monkeypatch.setattr(sequences, "COUNTS", 500, raising=False)
    batch = pa.record_batch([pa.array([i for i, _ in seqs], pa.int64()), pa.array([s for _, s in seqs])], ["id", "seq"])
    (best,) = sequences._best_targets(iter([batch]), block, 1, 3)
    assert len(asked) == 1 and asked[0] == sum(len(s) for _, s in seqs) and best.num_rows == 360  # a sequence at a time before
    few = spark.createDataFrame([*seqs, (None, "ACDEACDE")], "id long, seq string").repartition(5)
    assert sorted(map(tuple, sequences.search_database(few.where("id % 3 = 0"), few, 4).collect())) == whole


def test_blocks_of_sets_are_packed(spark):
    rng = random.Random(13)
    sets = [sorted({int(rng.paretovariate(0.6)) % 3000 for _ in range(120)}) for _ in range(400)] + [[5, 6], [5, 6]]
    items = [[hash((9, x)) for x in s] for s in sets]
    block = pa.table({"block": pa.array([3] * len(sets), pa.int32()), "id": pa.array(range(len(sets))), "digest": [repr(s).encode() for s in sets], "items": pa.array(items, pa.list_(pa.int64()))})
    packed = molecules._packed_sets(block)
    ids, sizes, used, codes = molecules._unpacked_sets(packed, 0)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    assert ids.tolist() == [i for i in range(401) if sets.index(sets[i]) == i]
    assert all(set(used[codes[a:b]].tolist()) == set(items[i]) for i, a, b in zip(ids.tolist(), ends, ends[1:]))
    assert packed.nbytes - 8 * len(used) < 3 * len(codes)  # eight bytes an item before


def test_cycles_of_eigenvectors_leave_no_tables(spark, monkeypatch):
    from pathlib import Path

    made, keep = [], graph.cut_lineage
    monkeypatch.setattr(graph, "cut_lineage", lambda df: made.append(keep(df)) or made[-1])
    edges = cliques(spark, [6, 5], [(0, 6)])
    t = graph.transition_matrix(edges).select("src", "dst", "t").persist()
    monkeypatch.setattr(graph, "SPARE", 0)
    values, vecs = graph.diffusion_eigen(t, 2)
    there = [Path(table._jdf.queryExecution().analyzed().relation().location().rootPaths().head().toUri().getPath()).exists() for table in made]
    assert len(made) >= 8 and sum(there) == 1 and vecs.count() == 11  # all stayed before
