import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from helixframe.llm import simhash


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = lowered.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius=3):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def near(rng, value, bits):
    for b in rng.sample(range(64), bits):
        value ^= 1 << b
    return value


@pytest.fixture(scope="module")
def clustered():
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(60)]
    out = [rng.getrandbits(64) for _ in range(1500)]
    for c in centres:
        out += [near(rng, c, rng.randint(0, 4)) for _ in range(rng.randint(1, 30))]
    return sorted(set(out))


def test_fingerprints_equal_plain_ones():
    rng = random.Random(1)
    texts = [None, "", " \n", "One", "one TWO", "É x\x1cy É\x0bz", *(" ".join(rng.choice("ab Cd É ef the").strip() + " \t" for _ in range(rng.randint(0, 400))) for _ in range(60))]
    assert simhash.fingerprints(pa.array(texts)).tolist() == [plain_fingerprint(t) for t in texts]


@pytest.mark.parametrize("levels", [0, 1, 3, 7])
def test_tree_lets_all_pairs_meet(clustered, levels):
    values = np.array(clustered, np.uint64)
    points, limits = simhash.build_tree(values[::7], levels)
    row, shard, home = simhash.visits(values, points, limits, levels)
    own = np.empty(len(values), np.int64)
    assert home.sum() == len(values)
    own[row[home]] = shard[home]
    seen = set(zip(row.tolist(), shard.tolist()))
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= 3).tolist():
            assert (i, own[j]) in seen


@pytest.mark.parametrize("shard_rows,part_rows", [(64, 16384), (64, 20), (1 << 20, 16384)])
def test_components_equal_plain_ones(spark, clustered, monkeypatch, shard_rows, part_rows):
    monkeypatch.setattr(simhash, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(simhash, "PART_ROWS", part_rows)
    monkeypatch.setattr(simhash.shard_links, "__defaults__", (3, shard_rows))
    rows = [(i, v - (1 << 64) if v >> 63 else v) for i, v in enumerate(clustered)]
    rows += [(i + 10_000, v) for i, v in rows[::5]] + [(None, rows[3][1])]
    got = {r["fp"]: r["component_id"] for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, fp long")).collect()}
    roots = plain_components(clustered)
    least = {}
    for i, r in enumerate(roots):
        least.setdefault(r, i)
    assert got == {rows[i][1]: least[r] for i, r in enumerate(roots)}


def test_query_and_deduplication(spark, tmp_path):
    rng = random.Random(9)
    vocabulary = ["w%d" % i for i in range(500)]
    base = [" ".join(rng.choice(vocabulary) for _ in range(400)) for _ in range(8)]
    rows = [(i, t, "s", 1) for i, t in enumerate(base)] + [(100 + i, t, "s", 1) for i, t in enumerate(base[:4])] + [(200, base[5].replace(" ", "  ", 3), "s", 1), (3, base[3], "s", 1)]
    rows += [(300, None, "s", 1), (301, "", None, 1), (302, " \n ", "s", 1), (None, base[1], "s", 1), (None, "only words without id here", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, fp int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(simhash.op8_simhash(spark, str(tmp_path)).collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0))
    prints = [plain_fingerprint(r[1]) for r in rows]
    roots = plain_components(prints)
    want = []
    for (doc_id, *_), p, r in zip(rows, prints, roots):
        ids = [x[0] for x, y in zip(rows, roots) if y == r and x[0] is not None]
        want.append((doc_id, f"{p:016x}", min(ids, default=None)))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [(False, i) for i in [*range(8), 300]] + [(True, 0)]
    assert simhash.deduplicate(docs.limit(0)).count() == 0
