import math
import random

import pytest

from helixframe.llm import topk


def plain(rows, k=5):
    vectors = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for qi in sorted({i for i, _ in vectors if i % 50 == 0}):
        q = min(v for i, v in vectors if i == qi)
        scored = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in vectors if i != qi)
        out += [(qi, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return out


@pytest.mark.parametrize("block,bins,n,most", [(2048, 1024, 400, 1 << 20), (2048, 1024, 400, 6000), (16, 4, 1300, 1 << 20), (16, 64, 4, 1 << 20), (16, 64, 0, 1 << 20)])
def test_equals_brute_force(spark, tmp_path, monkeypatch, block, bins, n, most):
    monkeypatch.setattr(topk, "BLOCK_BYTES", most)
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "BINS", bins)
    monkeypatch.setattr(topk, "ROW_BLOCK", block * 20)
    monkeypatch.setattr(topk, "PIECE", max(5, block // 3))
    rng = random.Random(n)
    rows = [(i, [round(rng.gauss(0, 0.2), 3) for _ in range(6)]) for i in range(n)]
    if n > 10:
        rows += [(5000 + i, rows[50][1]) for i in range(40)] + [(7000, None), (7050, [None] * 6), (7100, [float("nan")] * 6), (7150, [float("inf")] + [0.0] * 5), (None, [0.1] * 6), (7200, []), (7250, [0.5, 0.5]), (50, rows[50][1]), (3, rows[3][1])]
    spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, id string").repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    floats = [tuple(r) for r in spark.read.parquet(f"{tmp_path}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = topk.op9_topk(spark, str(tmp_path))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == plain(floats)


def test_scores_beyond_64_bits_are_an_error(spark):
    rows = spark.createDataFrame([(0, [1 << 40]), (1, [1 << 40])], "id long, v array<long>")
    with pytest.raises(OverflowError):
        topk.top_k(rows, rows)
    fits = spark.createDataFrame([(0, [1 << 30, 3]), (1, [(1 << 30) + 1, -7]), (2, [-(1 << 30), 1])], "id long, v array<long>")
    got = sorted(map(tuple, topk.top_k(fits, fits.where("id = 0")).collect()))
    assert got == [(0, 1, 1, (1 << 30) * ((1 << 30) + 1) - 21), (0, 2, 2, 3 - (1 << 60))]
