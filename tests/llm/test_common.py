import random

import numpy as np
import pyarrow as pa

from helixframe.llm import chat, common, packing, simhash
from tests.llm.test_simhash import plain_fingerprint


def texts_of(n):
    rng = random.Random(n)
    return [rng.choice([None, "", "".join(rng.choice("aB \n\té.\x0b") for _ in range(rng.randint(0, 90)))]) for _ in range(n)]


def test_slices_of_batches_give_the_words_of_their_texts():
    batch = pa.record_batch([pa.array(texts_of(3000))], ["text"])
    for most in (100, 5000, 1 << 30):
        pieces = common.slices(batch, "text", most)
        assert sum(p.num_rows for p in pieces) == 3000
        for piece in pieces:
            for lower in (False, True):
                codes, counts, words = common.word_codes(piece.column(0), lower)
                words.validate(full=True)
                want = [((t or "").encode().lower() if lower else (t or "").encode()).split() for t in piece.column(0).to_pylist()]
                spelled = [w.encode() for w in words.to_pylist()]
                assert counts.tolist() == list(map(len, want)) and [spelled[c] for c in codes.tolist()] == sum(want, [])


def test_operators_on_slices():
    column = pa.array(texts_of(400))
    encoder = packing.Encoder(packing.vocabulary_path())
    for at, n in ((0, 400), (3, 50), (250, 150)):
        part = column.slice(at, n)
        assert simhash.fingerprints(part).tolist() == [plain_fingerprint(t) for t in part.to_pylist()]
        ids, counts = encoder(part)
        again, sizes = encoder(pa.array(part.to_pylist()))
        assert np.array_equal(ids, again) and np.array_equal(counts, sizes)
        assert [chat.unescape(t) for t in chat.escape(part).to_pylist()] == [t or "" for t in part.to_pylist()]
