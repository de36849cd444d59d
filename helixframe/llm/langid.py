"""Language identification by nearest centroids.

A text becomes counts of byte 2- and 3-grams of its lower-cased letters, hashed to DIMENSIONS, where every character beyond ASCII counts as a
letter; logarithms of the counts
are weighted by inverse document frequency and brought to length 1. Spherical k-means gives each language several
centroids. A text gets the language of the centroid with the largest cosine; where that lies below the centroid's own
threshold, the text is rejected as too far from everything (`rejected`), and still names its nearest language.

The model is fitted on a sample of labelled rows: about SAMPLE_ROWS in all, shared equally by the languages but at least
LEAST_ROWS of each, whole texts, chosen by a hash of the id; executors count their grams, and only the counts (DIMENSIONS numbers a row) come to the driver. All languages are learned; where they are more than
SAMPLE_ROWS / LEAST_ROWS, sample and model grow with their number. Everything that is predicted is predicted from whole texts.

A null text and one without a letter give `und`, score 0 and rejection; so does any text where nothing can be learned.
Ties go to the language that comes first by code point. Repeated rows are predicted one by one, null ids included. Texts of any
length are counted in steps; an empty table gives no rows; further columns are carried, whatever their names, or ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixframe.llm.common import crc_of_id, give_back, read_table, small_batches

DIMENSIONS, CENTROIDS, ROUNDS = 4096, 4, 12
#: Rows of the sample that the model is fitted on, and the least share of a language.
SAMPLE_ROWS, LEAST_ROWS = 2048, 8
#: A centroid rejects what is farther than this share of the cosine that all but the farthest percent of its texts reach.
REJECT_SHARE, REJECT_PERCENT = 0.4, 1.0
#: Bytes of a text counted at once.
STEP = 1 << 20

_LETTER = re.compile(r"[^\W\d_]")
_KEEP = np.full(256, 32, np.uint8)
_KEEP[97:123] = np.arange(97, 123)
_KEEP[128:] = np.arange(128, 256)


def gram_counts(text: str) -> np.ndarray:
    """Counts of hashed 2- and 3-grams of letters; ASCII that is no letter is a space, and grams of two spaces don't count."""
    data = np.concatenate([[np.uint8(32)], _KEEP[np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)], [np.uint8(32)]])
    counts = np.zeros(DIMENSIONS, np.int64)
    for at in range(0, len(data) - 1, STEP):
        b = data[at : at + STEP + 2].astype(np.uint32)
        two = (b[:-1] << 8 | b[1:])[: STEP if len(b) == STEP + 2 else None]
        three = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) | np.uint32(1 << 24)
        two = two[two != 0x2020]
        three = three[(three & 0xFFFF != 0x2020) & (three >> 8 & 0xFFFF != 0x2020)]
        grams = np.concatenate([two, three]) * np.uint32(2654435761)
        counts += np.bincount(grams >> np.uint32(20), minlength=DIMENSIONS)
    return counts


def vectors(texts: list[str], idf: np.ndarray | None = None) -> np.ndarray:
    """A row of weighted counts for each text, of length 1 if idf is given."""
    out = np.empty((len(texts), DIMENSIONS), np.float32)
    for i, text in enumerate(texts):
        out[i] = np.log1p(gram_counts(text))
    return out if idf is None else normalised(out * idf)


def normalised(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


@dataclass(frozen=True)
class Model:
    langs: list[str]
    of: np.ndarray  # the language of each centroid
    centroids: np.ndarray
    limits: np.ndarray
    idf: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score from 0 to 1 and rejection of each text."""
        known = [i for i, t in enumerate(texts) if self.langs and t and _LETTER.search(t)]
        lang, score, rejected = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        if known:
            cosine = vectors([texts[i] for i in known], self.idf) @ self.centroids.T
            best = cosine.argmax(axis=1)
            value = np.clip(cosine.max(axis=1), 0, 1)
            for i, b in zip(known, best):
                lang[i] = self.langs[self.of[b]]
            score[known], rejected[known] = value, value < self.limits[best]
        return lang, score, rejected


def cluster(rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of length 1 and the cluster of each row; starts from the mean and then from the farthest rows."""
    centroids = normalised(rows.mean(axis=0, keepdims=True))
    while len(centroids) < min(k, len(rows)):
        far = int((rows @ centroids.T).max(axis=1).argmin())
        centroids = np.concatenate([centroids, rows[far : far + 1]])
    for _ in range(ROUNDS):
        mine = (rows @ centroids.T).argmax(axis=1)
        filled = np.unique(mine)
        moved = normalised(np.stack([rows[mine == c].mean(axis=0) for c in filled]))
        if moved.shape == centroids.shape and np.allclose(moved, centroids):
            break
        centroids = moved
    return centroids, (rows @ centroids.T).argmax(axis=1)


def fit(raw: np.ndarray, labels: list[str]) -> Model:
    """A model from the vectors() of texts and their languages."""
    idf = (np.log((1 + len(raw)) / (1 + (raw > 0).sum(axis=0))) + 1).astype(np.float32)
    rows, labels = normalised(raw * idf), np.array(labels, object)
    langs, of, centroids, limits = sorted(set(labels)), [], [], []
    for n, lang in enumerate(langs):
        own = rows[labels == lang]
        found, mine = cluster(own, CENTROIDS)
        near = (own * found[mine]).sum(axis=1)
        # A cluster of few texts says little about distance: its language's texts decide.
        floor = np.percentile(near, REJECT_PERCENT)
        limits += [REJECT_SHARE * min(floor, np.percentile(near[mine == c], REJECT_PERCENT)) if (mine == c).any() else REJECT_SHARE * floor for c in range(len(found))]
        centroids.append(found)
        of += [n] * len(found)
    return Model(langs, np.array(of, int), np.concatenate(centroids) if centroids else np.zeros((0, DIMENSIONS), np.float32), np.array(limits), idf)


def train(labelled: DataFrame) -> Model:
    """A model from a table (doc_id, text, lang) of labelled rows, fitted on a sample of each language."""
    usable = labelled.where("lang is not null and text is not null")
    # Counts come first and read no texts; then about twice the share of each language, cut to it by the hash's order.
    totals = usable.groupBy("lang").agg(F.count("*").alias("total"))
    each = F.greatest(F.lit(LEAST_ROWS), F.floor(F.lit(SAMPLE_ROWS) / F.count("*").over(Window.partitionBy(F.lit(1)))))
    shares = totals.withColumn("each", each)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    thin = usable.withColumn("place", place).join(F.broadcast(shares), "lang").where(F.col("place") * F.col("total") < F.lit(float(2 << 30)) * F.col("each"))
    order = F.row_number().over(Window.partitionBy("lang").orderBy("place", "doc_id", "text"))
    small_batches(labelled.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                yield pa.record_batch([part.column(0), part.column(1), pa.array([v.tobytes() for v in vectors(part.column(2).to_pylist())], pa.binary())], ["lang", "n", "grams"])

    chosen = thin.withColumn("n", order).where("n <= each").select("lang", "n", "text").mapInArrow(count, "lang string, n int, grams binary")
    rows = chosen.orderBy("lang", "n").toArrow()
    raw = np.frombuffer(b"".join(rows.column("grams").to_pylist()), np.float32).reshape(-1, DIMENSIONS)
    return fit(raw, rows.column("lang").to_pylist())


def identify(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns named in keep, then lang_pred, score and rejected; predictions see the text alone.

    A kept column may have one of these names too: the result then has both, in this order.
    """
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)  # CENTROIDS centroids of each language
    numbered = docs.select(F.col("text"), *keep).toDF("__text", *[f"k{i}" for i in range(len(keep))])
    found = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
    schema = T.StructType([*numbered.schema.fields[1:], *found])
    names = schema.names

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            give_back()
            for at in range(0, whole.num_rows, 128):
                part = whole.slice(at, 128)
                lang, score, rejected = held.value.predict(part.column(0).to_pylist())
                yield pa.record_batch([*part.columns[1:], pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)], names=names)

    return numbered.mapInArrow(predict, schema).toDF(*keep, *[f.name for f in found])


def learns(doc_id: Column) -> Column:
    return crc_of_id(doc_id) % 3 != 1


def train_on(docs: DataFrame) -> Model:
    return train(docs.where(learns(F.col("doc_id"))).select("doc_id", "text", "lang"))


def keep_identified(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """The rows that aren't rejected, with their columns as they are."""
    out = identify(docs, train_on(docs if labelled is None else labelled), docs.columns)
    renamed = out.toDF(*[f"c{i}" for i in range(len(out.columns))])
    kept = renamed.where(f"not c{len(out.columns) - 1}")
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs.select("doc_id", "text"), train_on(docs), ["doc_id"])
    return found.select("doc_id", (~learns(F.col("doc_id"))).alias("held_out"), "lang_pred", "score", "rejected")


QUERIES = {"op7_langid": op7_langid}
ORACLES: dict[str, str] = {}
