import binascii
import math
import random

import duckdb
import pytest

from helixframe.llm import langid

WORDS = {"en": "the house by river was sold and nobody knew who had bought with money".split(), "de": "das haus am fluss wurde verkauft und niemand wusste wer es gekauft hatte".split(), "fr": "la maison près de rivière était vendue et personne ne savait qui avait".split()}


def documents(n):
    rng = random.Random(8)
    return [(i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(5, 60))), lang if i % 11 else None, "s", 1) for i in range(n) for lang in [rng.choice(list(WORDS))]]


def test_counts_equal_plain_ones(monkeypatch):
    text = "Ab é,  x1y Ж\n" * 9
    kept = [32, *[b if 97 <= b < 123 or b >= 128 else 32 for b in text.lower().encode()], 32]
    want = [0] * langid.DIMENSIONS
    for i in range(len(kept) - 1):
        a, b = kept[i : i + 2]
        if (a, b) != (32, 32):
            want[(a << 8 | b) * 2654435761 % 2**32 >> 20] += 1
        if i + 2 < len(kept) and (a, b) != (32, 32) and (b, kept[i + 2]) != (32, 32):
            want[(1 << 24 | a << 16 | b << 8 | kept[i + 2]) * 2654435761 % 2**32 >> 20] += 1
    for step in (1 << 20, 7):
        monkeypatch.setattr(langid, "STEP", step)
        assert langid.gram_counts(text).tolist() == want


def test_held_out_accuracy_and_cases(spark, tmp_path):
    rows = documents(900) + [(5001, None, "en", "s", 1), (5002, "", "en", "s", 1), (5003, "12 34 --", "en", "s", 1), (None, "the house was sold", None, "s", 1), (7, "la maison était vendue", "fr", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = langid.op7_langid(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["held_out"] == (binascii.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 3 == 1) for r in got)
    by_id = {r["doc_id"]: r for r in got}
    assert all(by_id[i]["lang_pred"] == "und" and by_id[i]["score"] == 0 for i in (5001, 5002, 5003))
    true = {r[0]: r[2] for r in rows[:900]}
    held = [r for r in got if r["held_out"] and true.get(r["doc_id"])]
    assert sum(r["lang_pred"] == true[r["doc_id"]] for r in held) / len(held) > 0.95
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} >= set(range(900)) and kept.count() == len(rows) - 3


def test_all_of_many_languages_are_learned(spark):
    rng = random.Random(4)
    rows = []
    for n in range(300):
        words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(6)]
        rows += [(n * 10 + i, " ".join(rng.sample(words, 5)), f"l{n:03}") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert model.langs == [f"l{n:03}" for n in range(300)]
    lang, _, rejected = model.predict([r[1] for r in rows])
    assert lang == [r[2] for r in rows] and not rejected.any()


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert langid.identify(docs, langid.train_on(docs), ["doc_id"]).collect()[0][1:] == ("und", 0.0, True)
    assert langid.keep_identified(docs.limit(0)).count() == 0


@pytest.mark.parametrize("path", ["/root/testdata/sf0.01"])
def test_accuracy_on_given_documents(spark, path):
    got = langid.op7_langid(spark, path).where("held_out").collect()
    true = dict(duckdb.sql(f"select doc_id, lang from '{path}/documents.parquet' where lang is not null").fetchall())
    right = [r["lang_pred"] == true[r["doc_id"]] for r in got if r["doc_id"] in true]
    print(sum(right) / len(right), sum(r["rejected"] for r in got), math.fsum(r["score"] for r in got) / len(got))
    assert sum(right) / len(right) > 0.95
