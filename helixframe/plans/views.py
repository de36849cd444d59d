"""Canonical biological tables over the given star-schema tables, as SQL that both engines run.

A view's text may differ between the engines only where `SPARK_ONLY` or `DUCKDB_ONLY` says so.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from helixframe.operators.scratch import kept_table

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

VIEWS = {
    "counts": """
        SELECT o_custkey AS cell_id, l_partkey AS gene_id,
               CAST(CASE WHEN (o_custkey * 7 + l_partkey) % 23 = 0 THEN 0 ELSE sum(l_quantity) END AS DOUBLE) AS value
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey, l_partkey""",
    "genes": """
        SELECT p_partkey AS gene_id, p_partkey AS ordinal, CASE WHEN p_partkey % 40 = 0 THEN concat('mt-', p_name) ELSE p_name END AS gene_name FROM part""",
    "cells": "SELECT c_custkey AS cell_id, c_custkey AS ordinal, c_mktsegment AS category FROM customer",
    "contigs": """
        SELECT CAST(l_suppkey % 25 AS INT) AS ord, concat('c', lpad(CAST(l_suppkey % 25 AS STRING), 2, '0')) AS contig, max(l_orderkey) + 1 AS length
        FROM lineitem GROUP BY 1, 2""",
    "alignments": """
        SELECT concat(l_orderkey, ':', l_linenumber, ':', l_partkey, ':', l_suppkey) AS name,
               CASE WHEN l_linenumber = 7 THEN '*' ELSE concat('c', lpad(CAST(l_suppkey % 25 AS STRING), 2, '0')) END AS contig,
               l_orderkey AS pos, CAST(l_quantity AS INT) AS mapq, l_returnflag AS base, concat(l_returnflag, l_linestatus, l_returnflag) AS seq
        FROM lineitem""",
    "reads": """
        SELECT conv_id AS sample, CASE WHEN role = 'user' THEN 1 ELSE 2 END AS mate, CAST(floor(turn / 2) AS BIGINT) AS ordinal,
               upper(regexp_replace(text, '[^a-zA-Z]', '')) AS seq, repeat('@', CAST(length(regexp_replace(text, '[^a-zA-Z]', '')) AS INT)) AS qual
        FROM conversations WHERE role IN ('user', 'assistant')""",
    "sequences": """
        SELECT doc_id AS seq_id, concat('sp|', doc_id, '|', lang, ' ', source) AS header, upper(regexp_replace(text, '[^a-zA-Z]', '')) AS seq,
               CAST(length(regexp_replace(text, '[^a-zA-Z]', '')) AS BIGINT) AS length, source AS grp
        FROM documents""",
    "native_pairs": "SELECT seq_id, lead(seq_id) OVER (ORDER BY seq_id) AS native_id FROM sequences",
    "residue_logp": """
        SELECT user_id AS seq_id, CASE WHEN pos % 2 = 0 THEN 'A' ELSE 'B' END AS chain, pos, event_type AS residue, -value / 100 AS logp, pos % 3 <> 0 AS designed
        FROM (SELECT user_id, event_type, value, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INT) AS pos FROM events) e""",
    "residue_table": """
        SELECT seq_id, pos, k.residue AS residue, CASE WHEN r.residue = k.residue THEN logp ELSE logp - 0.5e0 - (pos % 7) / 10.0e0 END AS logp
        FROM residue_logp r CROSS JOIN (SELECT DISTINCT event_type AS residue FROM events) k""",
    "token_vectors": "SELECT CAST(floor(vec_id / 10) AS BIGINT) AS seq_id, label AS layer, vec_id % 10 AS token_pos, embedding AS vec FROM embeddings",
    "vectors": "SELECT vec_id AS id, embedding AS vec, label FROM embeddings",
    "annotations": """
        SELECT user_id AS seq_id, event_type AS label, CAST(floor(seconds / 60) AS INT) AS start_pos, CAST(floor(seconds / 60) + ceil(value) AS INT) AS end_pos
        FROM (SELECT user_id, event_type, value, ({seconds}) AS seconds FROM events) e""",
    "signal": """
        SELECT concat('u', user_id) AS contig, seconds AS start_pos, seconds + CAST(ceil(value * 60) AS BIGINT) AS end_pos, value
        FROM (SELECT user_id, value, ({seconds}) AS seconds FROM events) e""",
    "molecules": """
        SELECT doc_id % 5 AS run_id, doc_id AS ordinal, lower(text) AS mol, coalesce(quality, 0) = 1 AS valid,
               {words} AS fp, n_chars / 20000.0e0 AS qed, (doc_id % 97) / 10.0e0 AS plogp
        FROM documents LEFT JOIN (SELECT doc_id AS label_id, quality FROM labels) l ON doc_id = label_id""",
    "train_molecules": "SELECT lower(text) AS mol FROM documents WHERE doc_id % 3 = 0",
    "poses": """
        SELECT l_suppkey AS receptor, l_partkey AS ligand, l_linenumber AS run, -l_extendedprice / 10000 AS energy, l_quantity AS x, l_discount * 100 AS y, l_tax * 100 AS z
        FROM lineitem""",
    "bins": """
        SELECT * FROM (VALUES (0, 0, 8), (1, 0, 8), (2, 0, 8), (3, 0, 8), (4, 0, 8), (5, 0, 8), (6, 0, 8), (7, 0, 8)) b(bin, unused, n)""",
}
SPARK_ONLY = {"seconds": "CAST(floor((unix_micros(CAST(ts AS TIMESTAMP)) - 1704067200000000) / 1000000) AS BIGINT)", "words": "array_sort(array_distinct(filter(split(text, ' '), x -> x <> '')))"}
DUCKDB_ONLY = {"seconds": "CAST(floor((epoch_us(ts) - 1704067200000000) / 1000000) AS BIGINT)", "words": "list_sort(list_distinct(list_filter(string_split(text, ' '), lambda x: x <> '')))"}


def _fill(sql: str, parts: dict[str, str]) -> str:
    for name, text in parts.items():
        sql = sql.replace("{" + name + "}", text)
    return sql


def _names(sql: str, names) -> list[str]:
    return [n for n in names if re.search(rf"\b(?:FROM|JOIN)\s+{n}\b", sql)]


class Views:
    """Given tables and canonical views of one folder as DataFrames, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._kept = spark, sf_dir, {}

    def kept(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """What build() gives, as a table that is written once for all steps of a query that read it."""
        if name not in self._kept:
            self._kept[name] = kept_table(build(), name)
        return self._kept[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name in TABLES:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name not in VIEWS:
            raise AttributeError(name)
        sql = _fill(VIEWS[name], SPARK_ONLY)
        used = _names(sql, [*TABLES, *VIEWS])
        for n in used:
            sql = re.sub(rf"\b(FROM|JOIN)\s+{n}\b", rf"\1 {{{n}}}", sql)
        return self.spark.sql(sql, **{n: getattr(self, n) for n in used})


def with_views(sql: str) -> str:
    """DuckDB SQL with the definitions of the views that it reads put before it."""
    ordered: list[str] = []

    def add(text: str) -> None:
        for n in _names(text, VIEWS):
            add(VIEWS[n])
            if n not in ordered:
                ordered.append(n)

    add(sql)

    def duck(text: str) -> str:
        text = _fill(text, DUCKDB_ONLY)
        return re.sub(r"regexp_replace\((.*?), '(\[.*?\])', ''\)", r"regexp_replace(\1, '\2', '', 'g')", text)

    heads = [f"{n} AS ({duck(VIEWS[n])})" for n in ordered]
    body = sql.strip()
    if not heads:
        return body
    if body.upper().startswith("WITH RECURSIVE"):
        return "WITH RECURSIVE " + ",\n".join(heads) + ",\n" + body[len("WITH RECURSIVE") :]
    if body.upper().startswith("WITH"):
        return "WITH " + ",\n".join(heads) + ",\n" + body[len("WITH") :]
    return "WITH " + ",\n".join(heads) + "\n" + body


QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Registers fn(views) under a name, with the DuckDB SQL for its rows."""

    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Views(spark, sf_dir))
        if oracle:
            ORACLES[name] = with_views(oracle)
        return fn

    return register
