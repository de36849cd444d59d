import random

import pytest

from helixframe.llm import mixing


def plain_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    target, left, free = {}, float(sum(sizes.values())), set(names)
    while free:
        share = {s: left * weight[s] / sum(weight[t] for t in free) for s in free}
        over = {s for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return target | share
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= over
    return target


@pytest.mark.parametrize("seed", range(4))
def test_query(spark, tmp_path, seed):
    rng = random.Random(seed)
    names = [None, "a", "B", "é", "z", "", "src10", "src9"][: 3 + 2 * seed]
    rows = [(i, " ".join("w" for _ in range(int(rng.expovariate(0.02)))), names[min(len(names) - 1, int(rng.expovariate(0.9)))], 1, "x") for i in range(3000)]
    rows += [(50_000, None, "a", 1, "x"), (50_001, "", "only empty", 1, "x"), (None, "one two", "a", 1, "x"), (7, "again here", rows[7][2], 1, "x"), (50_002, "w " * 5000, "a", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int, copies string")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = mixing.op6_mixing(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.op6_mixing(spark, str(tmp_path)).collect()), key=str)
    sizes = {}
    for r in rows:
        sizes[r[2]] = sizes.get(r[2], 0) + len((r[1] or "").split())
    want = plain_targets(sizes)
    source = {r[0]: r[2] for r in rows}
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        s = source[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(want[s])
        assert 0 <= r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[s] += r["taken"]
    for s in sizes:
        most = max(r["size"] for r in got if source[r["doc_id"]] == s)
        assert abs(taken[s] - want[s]) <= most + 1e-6
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    assert sum(len((r["text"] or "").split()) for r in mixed.collect()) == sum(taken.values())


def test_expectations_are_kept(spark):
    frame = spark.createDataFrame([(i, str(i // 40), 1 + i % 7, 0.3) for i in range(24000)], "doc_id long, source string, size long, p double")
    rows = mixing.round_fractions(frame, 8).groupBy((mixing.F.col("doc_id") % 40).alias("place")).agg(mixing.F.avg("copies").alias("m"), mixing.F.count("*").alias("n")).collect()
    assert all(r["n"] == 600 and abs(r["m"] - 0.3) < 0.1 for r in rows)


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    assert mixing.op6_mixing(spark, str(tmp_path)).count() == 0
