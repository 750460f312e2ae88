"""All registered queries."""

from __future__ import annotations

from marketflow.plans import (  # noqa: F401
    job_queries,
    load_queries,
    lookup_queries,
    period_queries,
    schema_queries,
    source_queries,
    stream_queries,
)
from marketflow.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
