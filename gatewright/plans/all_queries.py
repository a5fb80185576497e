"""Imports every module that registers queries."""

from gatewright.plans import (  # noqa: F401
    catalog_queries,
    alert_queries,
    dataset_queries,
    governance_queries,
    metric_queries,
    quality_queries,
    source_queries,
    stream_queries,
)
from gatewright.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
