"""Versioned time series on Spark: ingest, clean, reconcile, snapshot, catalogue, validate."""

from .session import build_session

__all__ = ["build_session"]
