"""Chat formatting by columnar byte assembly.

A turn becomes `### role: text</turn>` and a line feed. Inside roles and texts a backslash is put before backslashes, `###`
and `</turn>`, in roles before colons too; taking away each backslash and keeping what follows it gives the text back.

Rows are range-partitioned and sorted by (conv_id, turn), so that a conversation of any length may lie over many tasks.
For a run of rows the segment lengths, their cumulative offsets and the scatter indices are computed in numpy, and
headers, contents and footers are copied into one preallocated buffer. Each row of the result is a part of one conversation
(all of it, unless it is long or crosses tasks): its text, and the spans under the loss mask in code points.

Null roles and texts count as empty, null turns come first, rows with equal turns go by role and text; a null conv_id is a
conversation of its own. Repeated rows are turns of their own. An empty table gives no rows; texts of any length are copied whole, and
further columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import read_table, slices, small_batches, whole_texts

#: Fixed values of the template.
OPENING, AFTER_ROLE, CLOSING = "### ", ": ", "</turn>\n"
LOSS_ROLE = "assistant"
#: Bytes of text assembled at once; a longer text is copied by itself. Turns of a part at most.
PIECE_BYTES, PART_TURNS = 4 << 20, 4096

_TURN = re.compile(r"### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)

PART_SCHEMA = "conv_id long, part long, n_turns long, formatted string, loss array<struct<start:long,end:long>>"
_LOSS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def escape(texts: pa.Array, role: bool = False) -> pa.Array:
    texts = whole_texts(texts)
    for control in ("\\", "###", "</turn>", *([":"] if role else [])):
        texts = pc.replace_substring(texts, control, "\\" + control)
    return texts


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all strings of a column without nulls, and the length of each."""
    lengths = pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data[int(offsets[0]) : int(offsets[0] + lengths.sum())], lengths


def _scatter(out: np.ndarray, data: np.ndarray, lengths: np.ndarray, to: np.ndarray) -> None:
    """Copies segment i of data to out[to[i]:]."""
    at = np.cumsum(lengths) - lengths
    long = lengths > PIECE_BYTES
    for i in np.flatnonzero(long):
        out[to[i] : to[i] + lengths[i]] = data[at[i] : at[i] + lengths[i]]
    short = np.where(long, 0, lengths)
    inside = np.arange(short.sum()) - np.repeat(np.cumsum(short) - short, short)
    out[np.repeat(to, short) + inside] = data[np.repeat(at, short) + inside]


def assemble(conv: np.ndarray, roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array, np.ndarray]:
    """For each run of equal conv (cut at PART_TURNS): its first row, its text, its loss spans and its number of turns."""
    n = len(conv)
    opening = pa.scalar(OPENING, pa.large_string())
    headers = pc.binary_join_element_wise(opening, escape(roles, role=True), pa.scalar(AFTER_ROLE, pa.large_string()), pa.scalar("", pa.large_string()))
    contents = escape(texts)
    head, head_n = _bytes(headers)
    body, body_n = _bytes(contents)
    foot = np.frombuffer(CLOSING.encode(), np.uint8)
    ends = np.cumsum(head_n + body_n + len(foot))
    starts = ends - head_n - body_n - len(foot)
    out = np.empty(int(ends[-1]), np.uint8)
    _scatter(out, head, head_n, starts)
    _scatter(out, body, body_n, starts + head_n)
    out[(ends[:, None] - len(foot)) + np.arange(len(foot))] = foot

    changes = np.concatenate([[True], conv[1:] != conv[:-1]])
    run = np.flatnonzero(changes)
    within = np.arange(n) - run[np.cumsum(changes) - 1]
    first = np.flatnonzero(changes | (within % PART_TURNS == 0))
    offsets = np.concatenate([starts[first], ends[-1:]])
    formatted = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(out)])

    chars = [pc.utf8_length(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (headers, contents)]
    char_ends = np.cumsum(chars[0] + chars[1] + len(CLOSING))
    char_starts = char_ends - chars[0] - chars[1] - len(CLOSING)
    part = np.searchsorted(first, np.arange(n), side="right") - 1
    masked = np.flatnonzero(pc.fill_null(pc.equal(roles, LOSS_ROLE), False).to_numpy(zero_copy_only=False))
    begin = char_starts[masked] + chars[0][masked] - char_starts[first][part[masked]]
    spans = pa.StructArray.from_arrays([pa.array(begin), pa.array(begin + chars[1][masked])], ["start", "end"])
    loss = pa.ListArray.from_arrays(pa.array(np.searchsorted(part[masked], np.arange(len(first) + 1)), pa.int32()), spans)
    return first, formatted, loss, np.diff(np.append(first, n))


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for piece in slices(batch, "text", PIECE_BYTES):
            ids = piece.column(0)
            # A null id and zero are told apart by the second number.
            conv = np.stack([pc.fill_null(ids, 0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)], axis=1)
            _, conv = np.unique(conv, axis=0, return_inverse=True)
            first, formatted, loss, turns = assemble(conv.reshape(-1), piece.column(1), piece.column(2))
            numbers = number + np.arange(len(first))
            number += len(first)
            yield pa.record_batch([ids.take(pa.array(first)), pa.array(numbers), pa.array(turns), formatted.cast(pa.string()), loss.cast(_LOSS)], ["conv_id", "part", "n_turns", "formatted", "loss"])


def format_chats(turns: DataFrame) -> DataFrame:
    """Parts of conversations from a table (conv_id, turn, role, text); parts of a conversation are in order by `part`."""
    small_batches(turns.sparkSession)
    key = ("conv_id", "turn", "role", "text")
    ordered = turns.select(*key).repartitionByRange(*key).sortWithinPartitions(*key)
    return ordered.select("conv_id", "role", "text").mapInArrow(_format, PART_SCHEMA)


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted part."""
    at = 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if not m:
            raise ValueError(f"not a formatted part, at {at}")
        yield unescape(m[1]), unescape(m[2])
        at = m.end()


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads parts, sorted by conversation and part, and keeps no more than hash states between them."""
    conv, state, rows = None, None, []

    def done():
        return (conv[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

    for batch in batches:
        for row in batch.to_pylist():
            if conv != (row["conv_id"],):
                if conv is not None:
                    rows.append(done())
                conv, state = (row["conv_id"],), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in read_turns(row["formatted"]):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
            for span in row["loss"]:
                text = unescape(row["formatted"][span["start"] : span["end"]])
                state[2] += len(text)
                state[3].update(text.encode())
            state[4] += len(row["formatted"])
        if rows:
            yield _table(rows)
            rows = []
    if conv is not None:
        yield _table([done()])


DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def _table(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), DIGEST)], schema=DIGEST)


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.range(2).selectExpr("-7L as conv_id", "id as turn", "if(id = 0, 'user', 'assistant') as role", r"'\\### Assistant: </turn> ok' as text")
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    parts = format_chats(turns).repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return parts.mapInArrow(_digest, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _escaped_sql(column: str, role: bool = False) -> str:
    sql = f"coalesce({column}, '')"
    for control in ("\\", "###", "</turn>", *([":"] if role else [])):
        sql = f"replace({sql}, '{control}', '\\{control}')"
    return sql


_ORDER = "ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST"
ORACLE = f"""
WITH turns AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(coalesce(role, '') || chr(10) || coalesce(text, '') || chr(10), '' {_ORDER})) AS turns_sha256,
  CAST(coalesce(sum(length(coalesce(text, ''))) FILTER (role = '{LOSS_ROLE}'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(coalesce(text, ''), '' {_ORDER}) FILTER (role = '{LOSS_ROLE}'), '')) AS loss_sha256,
  CAST(sum(length({_escaped_sql("role", True)}) + length({_escaped_sql("text")}) + {len(OPENING) + len(AFTER_ROLE) + len(CLOSING)}) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

QUERIES = {"op3_chat": op3_chat}
ORACLES = {"op3_chat": ORACLE}
