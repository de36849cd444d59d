"""All queries of the biological operators, and their SQL."""

from __future__ import annotations

from helixframe.plans import functions, genome, matrix, molecules, sequences, vectors
from helixframe.plans.views import ORACLES, QUERIES

MODULES = (functions, genome, matrix, molecules, sequences, vectors)


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
