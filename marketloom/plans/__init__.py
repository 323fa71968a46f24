"""Registered queries and their oracles."""

from . import backtests, daily, drawn, further, ingest, more, reads, streams, surfaces  # noqa: F401  registers its queries
from .market import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
