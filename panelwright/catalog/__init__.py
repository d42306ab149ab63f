"""Checked queries over the given tables, with their SQL twins."""

from panelwright.catalog import filed, forecasts, ingest, scores, series
from panelwright.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "filed", "forecasts", "ingest", "scores", "series"]
