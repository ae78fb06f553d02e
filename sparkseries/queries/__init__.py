from . import catalogue, guards, ingest, rounds, scalars, series, versions
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "catalogue", "guards", "ingest", "rounds", "scalars", "series", "versions"]
