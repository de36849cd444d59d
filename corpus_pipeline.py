"""A corpus pipeline: five stages over `documents`, each of which works on all that the one before kept.

1. language identification: documents that are too far from every language go;
2. near-duplicates by SimHash and by shingles of five words: one document of each group stays;
3. personal data: spans in the texts are replaced by their kinds;
4. mixing: documents are taken as often as their source's target asks;
5. packing: what is left becomes pieces of token sequences.

Stages before the last return the columns of `documents`, further ones as they are, whatever their names. A stage's result is written as Parquet and
read again. Null texts go in the first stage. Rows that repeat are judged alike by the first and third stage; the second keeps one of them. Whole texts are
read at any length, and an empty table gives empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm import langid, mixing, packing, pii, simhash
from helixframe.llm.common import materialise, read_table

#: Jaccard similarity of five-word shingles from which documents are near-duplicates.
SIMILARITY = 0.8


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the model rejects: null texts, texts without a letter and texts far from all centroids."""
    return langid.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of linked fingerprints and of similar five-word shingles.

    Every pair of texts of different groups that shares a band is decided. Of rows that repeat the smallest id one stays; see deduplicate()."""
    return simhash.deduplicate(docs, SIMILARITY)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts; n_chars follows the text."""
    redacted = pii.redact(docs)
    return redacted.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else redacted


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and drops documents so that each source's words come to its target. Documents without a word are taken as their rounding says;
    a null source is a source. Rows of one id and source are one document."""
    return mixing.mix_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences; a document that the mix took twice is packed twice."""
    return packing.digest(packing.pack(docs, packing.vocabulary_path()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Fingerprints, centroids and token ids are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
