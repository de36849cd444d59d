import random


import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from helixframe.llm import packing, pii
from tests.llm.test_langid import WORDS
from tests.llm.test_mixing import plain_targets
from tests.llm.test_packing import checked
from tests.llm.test_simhash import plain_components, plain_fingerprint


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    rng = random.Random(12)
    text = lambda lang: " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(20, 200)))
    rows = [(i, text(lang), lang, f"s{i % 4}" if i % 9 else None) for i in range(400) for lang in [rng.choice(list(WORDS))]]
    rows += [(1000 + i, rows[i * 3][1], rows[i * 3][2], "s1") for i in range(60)] + [(2000, None, "en", "s0"), (2001, "12 -- 34", "en", "s0"), (2002, "", "en", "s2")]
    rows += [(2003, text("en") + " write to a.b@mail.example.com or +1 (988) 555-2485 " + text("en"), "en", "s0")]
    path = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    found = [docs]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, found[-1], str(path)).write.parquet(f"{path}/{n}")
        found.append(spark.read.parquet(f"{path}/{n}"))
    return str(path), [f.collect() for f in found], [f.columns for f in found]


def test_stages(stages):
    _, rows, columns = stages
    assert len(corpus_pipeline.STAGES) == 5 and all(c == columns[0] for c in columns[:-1])
    start, language, unique, clean, mixed, packed = rows
    assert {r["doc_id"] for r in start} - {r["doc_id"] for r in language} == {2000, 2001, 2002}
    ordered = sorted(language, key=lambda r: r["doc_id"])
    roots = plain_components([plain_fingerprint(r["text"]) for r in ordered])
    first = {}
    for r, root in zip(ordered, roots):
        first.setdefault(root, r["doc_id"])
    assert sorted(r["doc_id"] for r in unique) == sorted(first.values())
    assert sorted(clean) == sorted(r.__class__(**(d := r.asDict()) | {"text": (t := pii.redact_text(d["text"])), "n_chars": len(t)}) for r in unique)
    assert "[EMAIL] or [PHONE]" in next(r["text"] for r in clean if r["doc_id"] == 2003)
    count = lambda docs, s: sum(len(r["text"].split()) for r in docs if r["source"] == s)
    sizes = {s: count(clean, s) for s in {r["source"] for r in clean}}
    for s, target in plain_targets(sizes).items():
        assert abs(count(mixed, s) - target) <= max(len(r["text"].split()) for r in clean)
    checked([(r["doc_id"], r["text"]) for r in mixed], packed, Tokenizer.from_file(packing.vocabulary_path()))


def test_run_equals_stages(spark, stages):
    path, rows, _ = stages
    got = corpus_pipeline.run(spark, path).collect()
    content = lambda found: sorted((r["doc_id"], r["start"], r["ids_crc32"], r["length"], r["doc_tokens"]) for r in found)
    places = lambda found: sorted((r["sequence_id"], r["offset"], r["length"]) for r in found)
    whole = lambda found: sorted((i, sum(n for j, _, _, n, _ in content(found) if j == i)) for i in {r["doc_id"] for r in found})
    assert whole(got) == whole(rows[-1]) and sum(n for _, _, n in places(got)) == sum(n for _, _, n in places(rows[-1]))


def test_stages_at_the_edges(spark):
    """Empty tables, repeated rows, null and empty texts and sources, a very long text, and columns named like those inside."""
    rng = random.Random(31)
    text = lambda n: " ".join(rng.choice(WORDS["en"]) for _ in range(n))
    schema = "doc_id long, text string, lang string, source string, n_chars long, fp long, component string, row string, id string, size long, label string"
    rows = [(i, text(40), "en", f"s{i % 3}" if i % 5 else None) for i in range(60)]
    rows += [rows[0], rows[0], (1, rows[1][1], "en", "s1"), (70, None, None, None), (71, "", "en", "s0"), (72, " \n", "en", "s0"), (73, text(60_000), "en", "s2"), (74, text(3), "en", "s1")]
    docs = spark.createDataFrame([(*r, len(r[1] or ""), 7, "c", "r", "i", 9, "l") for r in rows], schema).repartition(4)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == [c.split()[0] for c in schema.split(", ")]
        docs = corpus_pipeline.materialise(docs, "edges")
        found = docs.collect()
        assert found and all((r["fp"], r["component"], r["row"], r["id"], r["size"], r["label"]) == (7, "c", "r", "i", 9, "l") for r in found)
        assert all(r["text"] for r in found)
    assert corpus_pipeline.pack_sequences(spark, docs, "").count() >= docs.count()
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        empty = corpus_pipeline.materialise(stage(spark, empty, ""), "edges")
        assert empty.count() == 0 and empty.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert corpus_pipeline.pack_sequences(spark, empty, "").count() == 0
