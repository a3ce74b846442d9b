"""Query registry: every registered operator query and its DuckDB oracle."""

from __future__ import annotations

from roadpulse.registry import (  # noqa: F401  (register on import)
    analytics_queries,
    clean_queries,
    cluster_queries,
    feature_queries,
    io_queries,
    model_queries,
    plan_queries,
    stream_queries,
)
from roadpulse.registry.common import ORACLE, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)
