"""All queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from helixframe.llm import audit, chat, htmltext, langid, mixing, packing, pii, quality, resampling, scoring, simhash, topk, urlfilter

MODULES = (audit, chat, htmltext, langid, mixing, packing, pii, quality, resampling, scoring, simhash, topk, urlfilter)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
