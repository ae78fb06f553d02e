"""A stored table of intervals of validity that appends keep up; see `operators.intervals`.

Intervals that have ended lie in parts by the month of their end and are seldom opened again: an append reads what is still open and the
months that ended after its first arrival.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.intervals import FROM, KEYS, TO, append_versions, snapshots_at
from .runs import Manifest, month_of, read_runs, write_runs

OPEN = "open"


def _like(spark: SparkSession, versions: DataFrame) -> DataFrame:
    none = F.lit(None).cast("timestamp_ntz")
    return versions.select("*", none.alias(FROM), none.alias(TO)).limit(0)


def append_to_store(spark: SparkSession, path: str, fresh: DataFrame, keys: tuple[str, ...] = KEYS) -> Manifest:
    """Adds versions to the store in one commit. A repeated append changes nothing."""
    manifest = Manifest.read(spark, path)
    low = fresh.agg(F.min(F.col("created_at").cast("timestamp_ntz")).cast("string")).first()[0]
    if low is None:
        return manifest
    affected = [r for r in manifest.runs if r.part == OPEN or r.high is None or r.high > low]
    known = read_runs(spark, path, affected, _like(spark, fresh))
    part = F.when(F.col(FROM).isNull() | F.col(TO).isNull(), F.lit(OPEN)).otherwise(month_of(TO))
    return manifest.commit(spark, path, write_runs(append_versions(known, fresh, keys), path, part, high=TO), affected)


def stored_intervals(spark: SparkSession, path: str, versions: DataFrame) -> DataFrame:
    """All intervals of the store; `versions` gives the columns."""
    return read_runs(spark, path, Manifest.read(spark, path).runs, _like(spark, versions))


def stored_snapshots(spark: SparkSession, path: str, moments: DataFrame, versions: DataFrame, moment: str = "moment") -> DataFrame:
    """What each of the moments knew, from the store. Months that ended before the first moment are not opened."""
    first = moments.agg(F.min(F.col(moment).cast("timestamp_ntz")).cast("string")).first()[0]
    runs = [r for r in Manifest.read(spark, path).runs if first is not None and (r.part == OPEN or r.high is None or r.high > first)]
    return snapshots_at(read_runs(spark, path, runs, _like(spark, versions)), moments, moment)
