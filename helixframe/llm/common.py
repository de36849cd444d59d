"""What the operators of this subpackage share: table access, shared scratch tables, word splitting in Arrow."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.operators.scratch import kept_table

#: A word is a longest run of characters other than these six.
SPACE_CLASS = r"\x20\x09-\x0D"
A_TO_Z, A_TO_Z_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Lets Spark hand texts to Python a few megabytes at a time, so that a worker's memory doesn't follow long texts.

    Session settings that are smaller already stay.
    """
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", 1000), ("spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20)):
        now = int(re.sub(r"\D", "", spark.conf.get(key)) or 0)
        if not 0 < now <= most:
            spark.conf.set(key, str(most))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder, as reread: the lineage ends there, and a lost executor costs the tasks
    that it ran, not the stages before. The table goes when the driver's process ends."""
    return kept_table(df, name)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, A_TO_Z, A_TO_Z_LOWER)


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def word_count(text: Column) -> Column:
    """Number of words as a long; 0 for null. One pass over the text: a word begins where a word character follows none."""
    return F.coalesce(F.regexp_count(text, F.lit(rf"[^{SPACE_CLASS}]+")), F.lit(0)).cast("long")


def whole_texts(texts: pa.Array) -> pa.Array:
    """The texts without nulls, in buffers of their own.

    A slice shares its buffers with what surrounds it, and some string kernels (ascii_lower on large strings) then read
    beyond it; so a slice is copied first.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if len(texts) and (texts.offset or np.frombuffer(texts.buffers()[1], np.int64)[0]):
        texts = texts.take(pa.array(np.arange(len(texts))))
    return texts


def split_words(texts: pa.Array, lower: bool = False) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, one after the other, and the number of words of each text; null has none."""
    texts = whole_texts(texts)
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    sums = np.zeros(len(flat) + 1, np.int64)
    np.cumsum(full.to_numpy(zero_copy_only=False), out=sums[1:])
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    return flat.filter(full), np.diff(sums[offsets - offsets[0]])


def word_codes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Codes of all words, the number of words of each text, and the words that the codes stand for."""
    words, counts = split_words(texts, lower)
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), counts, coded.dictionary


def give_back() -> None:
    """Returns what Arrow and the C library keep of freed memory, since Spark's Python workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> list[pa.RecordBatch]:
    """The batch cut so that the column's texts have about `most` bytes in each piece; a longer text stands alone."""
    if not batch.num_rows:
        return []
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cut = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // most)) + 1
    edges = [0, *cut.tolist(), batch.num_rows]
    return [batch.slice(a, b - a) for a, b in zip(edges, edges[1:]) if b > a]


def gathered(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of the batches again, in pieces that hold at least `most` bytes of the column's texts, but for the last."""
    held, size = [], 0
    for batch in batches:
        for piece in slices(batch, column, most):
            held.append(piece)
            size += pc.sum(pc.binary_length(piece.column(piece.schema.get_field_index(column)))).as_py() or 0
            if size >= most:
                yield pa.concat_batches(held)
                held, size = [], 0
    if held:
        yield pa.concat_batches(held)
