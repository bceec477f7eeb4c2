"""Registered queries, each with the SQL that must give the same rows where SQL can express it."""

from catalogue import aggregates, joins, plans, projections, quality, reports, scans, streams, windows  # noqa: F401
from catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
