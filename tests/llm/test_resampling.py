import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from tokenizers import Regex, pre_tokenizers

from helixframe.llm import resampling

SPLIT = pre_tokenizers.Split(Regex(resampling.WORD), behavior="removed", invert=True)


def plain_features(text, longest):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def plain(rows, target, longest=1, buckets=10_000, least=20, percent=10, seed=2024):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, plain_features(text, longest)[1]))
    for text in target:
        t.update(map(bucket, plain_features(text, longest)[1]))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1.0) * (all_s + buckets) / ((s[b] + 1.0) * (all_t + buckets)))) for b in set(s)}
    out = []
    for doc_id, text in rows:
        words, found = plain_features(text, longest)
        weight = sum(gain[bucket(f)] for f in found)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(words)])
    enters = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, row in enumerate(enters[: percent * len(enters) // 100], 1):
        row[4] = rank
    return sorted(map(str, (tuple(r[:5]) for r in out)))


@pytest.mark.parametrize(("longest", "buckets", "percent"), [(1, 10_000, 10), (2, 97, 45)])
def test_draw_equals_plain_one(spark, longest, buckets, percent):
    rng = random.Random(11)
    words = ["Rain", "fell", "ÉTÉ", "été", "x1", "b\xa0c", "漢字", "a-b", "{z}", "q\x00r", "\x7f", "İ"] + [f"w{i}" for i in range(40)]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "  "]) for _ in range(n))
    rows = [(i, text(rng.choice([0, 3, 19, 20, 60]))) for i in range(200)]
    rows += [(1000 + i, rows[5][1]) for i in range(100)] + [(5, rows[5][1])] * 3 + [(None, text(40)), (None, None), (300, None), (301, ""), (302, " .. "), (303, text(40_000))]
    target = [text(15) + " rain rain ete été" for _ in range(20)] + [None, ""]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, score int, rank int").repartition(4)
    wanted = spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id int, text string")
    got = resampling.resample(docs, wanted, longest=longest, buckets=buckets, percent=percent)
    assert sorted(str(tuple(r)) for r in got.collect()) == plain(rows, target, longest, buckets, percent=percent)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b " * 40), (2, None)], "doc_id long, text string")
    nothing = docs.limit(0)
    assert resampling.resample(nothing, docs).count() == 0
    assert sorted(str(tuple(r)) for r in resampling.resample(docs, nothing).collect()) == plain([(1, "a b " * 40), (2, None)], [])


def test_pieces_change_nothing():
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choice("ab é.\n") for _ in range(rng.randint(0, 60)))
        assert "".join(resampling.pieces(text, 7)) == text
        for longest in (1, 2, 3):
            whole = resampling.bucket_counts(text, SPLIT, {}, longest, 50)
            cut = resampling.bucket_counts(text, SPLIT, {}, longest, 50, most=7)
            assert whole[:2] == cut[:2] and whole[2].tolist() == cut[2].tolist() and whole[3].tolist() == cut[3].tolist()
            words, found = plain_features(text, longest)
            assert whole[:2] == (len(words), len(found)) and sum(whole[3]) == len(found)
