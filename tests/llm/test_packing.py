import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from helixframe.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.vocabulary_path())


def test_ids_equal_the_tokenizers(tokenizer, monkeypatch):
    rng = random.Random(2)
    texts = [None, "", " ", "Hello  WORLD\n\tit's <|endoftext|> x<|startoftext|>y é ́a", "a\x1cb c d \x85 Σας ΑΣ İ"]
    texts += ["".join(rng.choice("aB'sé<|é \n1.,! \x1cü的 ") for _ in range(rng.randint(0, 80))) for _ in range(500)]
    texts += [r[0] for r in duckdb.sql("select text from '/root/testdata/sf0.001/documents.parquet'").fetchall()]
    encoder = packing.Encoder(packing.vocabulary_path())
    for most in (400_000, 10):
        monkeypatch.setattr(packing, "MOST_WORDS", most)
        for at in range(0, len(texts), 100):
            ids, counts = encoder(pa.array(texts[at : at + 100]))
            want = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in texts[at : at + 100]]
            assert counts.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])


@pytest.mark.parametrize("shares", [None, [5.0, 1.0, 2.0, 0.001]])
def test_plan_is_deficit_round_robin(shares):
    totals = [70_000, 333, 21_111, 1]
    plan = packing.plan_of(totals, shares)
    want, sent, deficit = [], [0] * 4, [0.0] * 4
    for k in range(1, 200_000):
        for s in range(4):
            while sent[s] < totals[s] and np.floor(k * plan.rate[s]) > sent[s] // packing.GRAIN:
                n = min(packing.GRAIN, totals[s] - sent[s])
                want.append((s, sent[s] // packing.GRAIN, n))
                sent[s] += n
        if sent == totals:
            break
    assert sent == totals
    at = plan.place(np.array([w[0] for w in want]), np.array([w[1] for w in want]))
    assert at.tolist() == np.cumsum([0, *(w[2] for w in want)])[:-1].tolist()
    del deficit


def checked(rows, got, tokenizer):
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append(r)
    for pieces in by.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048
    full = [sum(r["length"] for r in p) for _, p in sorted(by.items())]
    assert all(n == 2048 for n in full[:-1]) and sorted(by) == list(range(len(by)))
    ids = {}
    for r in rows:
        ids.setdefault(r[0], []).append(np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4"))
    assert sum(full) == sum(len(x) for v in ids.values() for x in v)
    for doc_id, texts in ids.items():
        if len(texts) > 1:
            continue
        mine = sorted((r for r in got if r["doc_id"] == doc_id), key=lambda r: r["start"])
        at = 0
        for r in mine:
            assert r["start"] == at and r["doc_tokens"] == len(texts[0]) and r["ids_crc32"] == zlib.crc32(texts[0][at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(texts[0])
    return by


@pytest.mark.parametrize("queues", [4096, 2])
def test_query(spark, tmp_path, tokenizer, monkeypatch, queues):
    monkeypatch.setattr(packing, "MOST_QUEUES", queues)
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice(["the", "house", "Rain!", "xqzv"]) for _ in range(rng.randint(0, 900))), rng.choice(["a", "a", "a", "b", None])) for i in range(120)]
    rows += [(1000, None, "a"), (1001, "", None), (None, "no id", "b"), (5, "twice", "b"), (1002, "w " * 9000, "c")]
    spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, source string, offset int").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = packing.op1_packing(spark, str(tmp_path)).collect()
    by = checked(rows, got, tokenizer)
    if queues > 2:
        totals, sent, windows = {}, dict.fromkeys(["a", "b", "c", None], 0), 0
        for r in got:
            totals[r["source"]] = totals.get(r["source"], 0) + r["length"]
        for k in range(len(by) - 1):
            for r in by[k]:
                sent[r["source"]] += r["length"]
            if any(sent[x] == totals[x] for x in sent):
                break  # the queues that are left share its place
            windows += 1
            for x, weight in zip(sent, (5, 2, 1, 5)):
                assert abs(sent[x] - weight / 13 * 2048 * (k + 1)) <= 6 * packing.GRAIN
        assert windows > 3


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    assert packing.op1_packing(spark, str(tmp_path)).count() == 0
