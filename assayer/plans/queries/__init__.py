"""Registered queries, each with the plain SQL its result is checked against."""

from assayer.plans.queries import chain, gold, publishing, quality, rows, scans
from assayer.plans.queries.registry import QUERIES, TWINS

__all__ = ["QUERIES", "TWINS", "chain", "gold", "publishing", "quality", "rows", "scans"]
