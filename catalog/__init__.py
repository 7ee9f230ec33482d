"""Registered queries over the given tables, each with the SQL that checks it."""

from catalog.registry import QUERIES, checks
from catalog import (  # noqa: F401  (importing registers)
    q_ingest,
    q_join_split,
    q_metrics,
    q_models,
    q_protocols,
    q_roc,
    q_signal,
)

__all__ = ["QUERIES", "checks"]
