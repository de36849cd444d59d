import random

import numpy as np
import pytest

import corpus_pipeline
from helixframe.llm import minhash, simhash
from tests.llm.test_simhash import plain_components, plain_fingerprint


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def plain_kept(texts):
    """The first text of each class, over all pairs: equal fingerprints by links of op8, and five-word shingles."""
    sets, parent = [shingles(t) for t in texts], list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    linked = 0
    roots = plain_components([plain_fingerprint(t) for t in texts])
    for i in range(len(texts)):
        for j in range(i):
            similar = len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
            linked += similar and roots[i] != roots[j]
            if similar or roots[i] == roots[j]:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [i for i in range(len(texts)) if find(i) == i], linked


def stage(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect())


def changed(rng, words, n):
    near = list(words)
    for at in rng.sample(range(len(near)), n):
        near[at] = f"n{rng.randint(0, 10**9)}"
    return near


def test_stage_decides_all_pairs_of_a_template(spark):
    """Texts of one template share bands with hundreds of others; those that are changed once more link by pairs."""
    rng = random.Random(5)
    template = [f"w{i}" for i in range(200)]
    first = [changed(rng, template, 3) for _ in range(500)]
    texts = [" ".join(w) for w in first + [changed(rng, w, 4) for w in first[:250]]]
    want, linked = plain_kept(texts)
    assert linked > 500 and stage(spark, texts) == want


def test_texts_without_a_chance_are_left_out(spark):
    """Half of the words of a template changed: no pair can reach the similarity, and no set is sent to be compared."""
    rng = random.Random(6)
    template = [f"w{i}" for i in range(120)]
    texts = [" ".join(changed(rng, template, 12)) for _ in range(40)] + [" ".join(template), " ".join(changed(rng, template, 1))]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "variant long, text string")
    members = table.selectExpr("variant", "variant as label", "116L as n")
    assert [r["variant"] for r in minhash._ambiguous(members, table, 0.8).collect()] in ([40, 41], [41, 40])


def test_rows_at_the_edges(spark):
    """Null, blank, short, long and repeated texts, repeated ids, null ids and clashing names."""
    rng = random.Random(9)
    long = " ".join(f"v{rng.randint(0, 5000)}" for _ in range(60_000))
    rows = [(1, None), (2, None), (3, ""), (4, " \n"), (5, "one two"), (6, "One TWO"), (7, long), (8, long + " end"), (9, long), (7, long), (None, long), (None, "alone in this table of texts"), (20, "one two three")]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, fp int, component int").repartition(3)
    kept = simhash.deduplicate(docs, 0.8)
    got = sorted((str(r["doc_id"]), (r["text"] or "")[:30]) for r in kept.collect())
    assert got == sorted([("1", ""), ("5", "one two"), ("7", long[:30]), ("20", "one two three"), ("None", "alone in this table of texts")])
    assert kept.columns == docs.columns and simhash.deduplicate(docs.limit(0), 0.8).count() == 0


@pytest.mark.parametrize("narrow", [False, True])
def test_stage_links_near_copies(spark, narrow):
    rng = random.Random(21)
    vocabulary = [f"w{i}" for i in range(900)]
    texts = []
    for _ in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randint(60, 300))]
        texts.append(" ".join(words))
        for _ in range(rng.randint(0, 3)):  # near copies, of which some fall below the similarity
            near = list(words)
            for at in rng.sample(range(len(near)), max(1, len(near) // rng.choice([25, 40, 60, 90]))):
                near[at] = "other"
            texts.append(" ".join(near))
    texts += ["one two", "one two three", "one two"]
    want, linked = plain_kept(texts)
    assert linked > 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = simhash.deduplicate(docs, 0.8, reach=((2, 1), (minhash.BANDS, 1)), part=900) if narrow else simhash.deduplicate(docs, 0.8)
    assert sorted(r["doc_id"] for r in kept.collect()) == want
    assert len(want) < simhash.deduplicate(docs).count()


def test_links_of_parts_equal_all_pairs():
    rng = np.random.default_rng(3)
    base = [rng.choice(400, 60, replace=False) for _ in range(6)]
    sets = [np.unique(np.where(rng.random(60) < 0.04, rng.integers(400, 900, 60), base[i % 6])) for i in range(60)]
    labels, sides = np.arange(60) // 2, np.arange(60) // 6 % 2
    for s in (sides, np.zeros(60, int)):
        want = set()
        for a in range(60):
            for b in range(a):
                shared = len(np.intersect1d(sets[a], sets[b]))
                if labels[a] != labels[b] and (s[a] != s[b] or not s.any()) and shared >= 0.8 * (len(sets[a]) + len(sets[b]) - shared):
                    want.add((min(labels[a], labels[b]), max(labels[a], labels[b])))

        def classes(edges):
            root = list(range(30))
            for _ in range(30):
                for x, y in edges:
                    root[x] = root[y] = min(root[x], root[y])
            return root

        assert want and classes(minhash._linked(sets, labels, s, 0.8)) == classes(want)
