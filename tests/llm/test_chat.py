import random

import duckdb

from helixframe.llm import chat


def compared(spark, rows, path):
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string").repartition(3).write.parquet(f"{path}/conversations.parquet")
    db = duckdb.connect()
    db.execute(f"create view conversations as select * from '{path}/conversations.parquet/*.parquet'")
    got = chat.op3_chat(spark, str(path))
    assert got.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    found = sorted(map(tuple, got.collect()), key=str)
    assert found == sorted(db.sql(chat.ORACLE).fetchall(), key=str)
    return found


def test_query_equals_sql(spark, tmp_path, monkeypatch):
    rng = random.Random(6)
    bits = ["\\", "###", "### ", "</turn>", "</turn", "\n", ": ", "é", "a b", "<", "#", "\U0001f600", "assistant"]
    text = lambda: rng.choice([None, "", "".join(rng.choice(bits) for _ in range(rng.randint(0, 30)))])
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "", "a:b\\"]), text(), "x") for c in range(40) for t in range(rng.randint(1, 9))]
    rows += [(99, t, "assistant" if t % 2 else "user", text(), None) for t in range(600)] + [(5, 1, "user", "same", "x")] * 2 + [(5, None, "assistant", "no turn", "x"), (None, 0, "assistant", "no id", "x"), (0, 3, "user", "w" * 9000, "x")]
    found = compared(spark, rows, tmp_path)
    assert {r[0] for r in found} == {*range(40), 99, None, -7}


def test_long_texts_and_small_parts(spark, tmp_path, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(chat, "PIECE_BYTES", 50)
    monkeypatch.setattr(chat, "PART_TURNS", 2)
    roles, texts = pa.array(["user", "assistant", "assistant", "user", "assistant"]), pa.array(["x" * 200, "\\###é", None, "</turn>", "q" * 51])
    first, formatted, loss, turns = chat.assemble(chat.np.array([1, 1, 1, 2, 2]), roles, texts)
    assert first.tolist() == [0, 2, 3] and turns.tolist() == [2, 1, 2]
    back = [t for f in formatted.to_pylist() for t in chat.read_turns(f)]
    assert back == list(zip(roles.to_pylist(), [t or "" for t in texts.to_pylist()]))
    masked = [chat.unescape(f[s["start"] : s["end"]]) for f, spans in zip(formatted.to_pylist(), loss.to_pylist()) for s in spans]
    assert masked == ["\\###é", "", "q" * 51]


def test_empty_table(spark, tmp_path):
    assert [r[0] for r in compared(spark, [], tmp_path)] == [-7]
