"""Named queries over the given tables, each with its DuckDB oracle SQL.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLES[name] -> str``.
Every query reads whole tables (or whole derivations of them). Column names
match between a query and its oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from siltlake.plans import (  # noqa: F401
        q_catalog, q_changes, q_graph, q_history, q_layout, q_normalize, q_quality, q_relational, q_sql, q_stream, q_synth,
    )
