"""Query catalogue: importing the modules fills the registry."""

from __future__ import annotations

from tidemark.plans import core, datequeries, ingest, quality, records, search, textqueries  # noqa: F401
from tidemark.plans.registry import ORACLE, QUERIES


def queries() -> dict:
    """Every reference-shaped query by name."""
    return QUERIES


def oracle_sql() -> dict:
    """The DuckDB statement of each query that SQL can express."""
    return ORACLE
