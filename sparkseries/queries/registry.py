"""Registered queries: a Spark function and, where SQL can say the same, its SQL over the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The input tables of one folder, read lazily by name: `tables.orders`."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(function: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(Tables(ensure_utc(spark), folder))

        run.__name__ = name
        run.__doc__ = function.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def sql_round(value: str, places: int = 6, levels: int = 9) -> str:
    """Adaptive rounding in SQL."""
    branches = "".join(
        f" WHEN abs({value}) > 1e-{places + 3 * n} THEN round({value}, {places + 3 * n})" for n in range(levels)
    )
    return f"(CASE WHEN {value} IS NULL OR {value} = 0 THEN {value}{branches} ELSE {value} END)"
