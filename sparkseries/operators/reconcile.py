"""Change detection and set operations on series frames."""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import round_value
from . import project

ARRIVAL = "created_at"


def _rounded(df: DataFrame, columns: list[str], places: int) -> list[Column]:
    kinds = dict(df.dtypes)
    return [
        (round_value(F.col(c), places) if kinds[c] in ("double", "float") else F.col(c)).alias(c) for c in columns
    ]


def round_frame(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*_rounded(df, df.columns, places))


def within_incoming_bounds(base: DataFrame, incoming: DataFrame, columns: list[str], places: int = 6) -> DataFrame:
    """Base rows that can equal an incoming row, judged by the ranges of some columns.

    One aggregation over the incoming rows finds all bounds; as literals they reach the scan of the base, which skips partitions and
    row groups. Fractional numbers are compared as `reconcile` compares them, after rounding.
    """
    kinds = dict(incoming.dtypes)
    rounded = dict(zip(columns, _rounded(incoming, columns, places), strict=True))
    bounds = [f(rounded[c]).cast("string").alias(f"{name}_{c}") for c in columns for name, f in (("least", F.min), ("most", F.max))]
    found = incoming.agg(*bounds).first()
    for column in columns:
        value = _rounded(base, [column], places)[0] if kinds[column] in ("double", "float") else F.col(column)
        least, most = (F.lit(found[f"{name}_{column}"]).cast(kinds[column]) for name in ("least", "most"))
        within = (value >= least) & (value <= most)
        if kinds[column] in ("double", "float") and math.isfinite(float(found[f"least_{column}"] or "nan")) and math.isfinite(float(found[f"most_{column}"])):
            # Rounding hides a column from the scan; bounds of the raw values, wider by more than a rounding step, reach it.
            low, high = _widened(float(found[f"least_{column}"]), float(found[f"most_{column}"]), places)
            within = (F.col(column) >= F.lit(low)) & (F.col(column) <= F.lit(high)) & within
        base = base.where(F.col(column).isNull() | within) if found[f"least_{column}"] is not None else base.where(F.col(column).isNull())
    return base


def _widened(least: float, most: float, places: int) -> tuple[float, float]:
    """Bounds that hold every value that is rounded into the given ones."""
    return least - max(10.0**-places, abs(least) * 1e-6), most + max(10.0**-places, abs(most) * 1e-6)


def reconcile(
    base: DataFrame, incoming: DataFrame, places: int = 6, prune: bool = True, prune_by: tuple[str, ...] = ()
) -> DataFrame:
    """Incoming rows that the base does not hold yet, with the base's columns.

    Rows are the same when all columns but `created_at` agree after rounding, nulls counting as equal. Of equal
    incoming rows the earliest `created_at` stays. Both sides go through one hash aggregation over those columns:
    copies collapse before the shuffle, each row is shuffled at most once, and no key can make a task large.

    With `prune` a job over the incoming rows finds the range of `date` and of the columns `prune_by`, so that the base is not read beyond
    it; the result is the same without.
    """
    identity = [c for c in base.columns if c != ARRIVAL]
    wanted = project.like_target(incoming, [c for c in base.columns if c != ARRIVAL or ARRIVAL in incoming.columns])
    kinds = dict(base.dtypes)
    wanted = wanted.select(*[F.col(c).cast(kinds[c]).alias(c) for c in wanted.columns])
    bounded = [c for c in dict.fromkeys(("date", *prune_by)) if c in identity]
    if prune and bounded:
        base = within_incoming_bounds(base, wanted, bounded, places)
    arrival = F.col(ARRIVAL) if ARRIVAL in wanted.columns else F.lit(None).cast(kinds.get(ARRIVAL, "timestamp_ntz"))
    known = base.select(
        *_rounded(base, identity, places), F.lit(True).alias("_known"), F.lit(None).cast(
            kinds.get(ARRIVAL, "timestamp_ntz")).alias("_arrival"),
    )
    fresh = wanted.select(*_rounded(wanted, identity, places), F.lit(False).alias("_known"), arrival.alias("_arrival"))
    merged = known.unionAll(fresh).groupBy(*identity).agg(
        F.max("_known").alias("_known"), F.min("_arrival").alias(ARRIVAL)
    )
    return merged.where(~F.col("_known")).select(*base.columns)


def keep_first(df: DataFrame) -> DataFrame:
    """Of rows equal in all other columns keep the earliest `created_at`, null only when no row has one."""
    others = [c for c in df.columns if c != ARRIVAL]
    return df.groupBy(*others).agg(F.min(ARRIVAL).alias(ARRIVAL)).select(*df.columns)


def add_series(left: DataFrame, right: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Values added key by key; a key on one side only gives null. Each side holds one row per key."""
    a = left.select(*keys, F.col(value).alias("_a"))
    b = right.select(*keys, F.col(value).alias("_b"))
    return a.join(b, keys, "full").select(*keys, (F.col("_a") + F.col("_b")).alias(value))


def delete_by_key(df: DataFrame, doomed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are not listed; copies in the list collapse before the shuffle."""
    return df.join(doomed.select(*keys).distinct(), keys, "left_anti")


def insert_unique(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows whose keys are not taken yet; of new rows with equal keys the smallest row stays."""
    rest = [c for c in new.columns if c not in keys]
    one_per_key = new.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row")).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}") for c in new.columns]
    ) if rest else new.distinct()
    return one_per_key.join(existing.select(*keys).distinct(), keys, "left_anti")


def map_differences(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """Keys that are missing on one side or hold different values; no rows means the maps are equal."""
    a = left.select(key, F.col(value).alias("left_value"), F.lit(True).alias("_left"))
    b = right.select(key, F.col(value).alias("right_value"), F.lit(True).alias("_right"))
    both = a.join(b, key, "full")
    return both.where(
        F.col("_left").isNull() | F.col("_right").isNull() | ~F.col("left_value").eqNullSafe(F.col("right_value"))
    ).select(key, "left_value", "right_value")


def maps_equal(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """One row: number of differing keys and whether the maps are equal."""
    return map_differences(left, right, key, value).agg(F.count(F.lit(1)).alias("differences")).select(
        "differences", (F.col("differences") == 0).alias("equal")
    )


def union_tagged(frames: dict[str, DataFrame], tag_column: str = "table") -> DataFrame:
    """All frames below each other, each row marked with its frame's name."""
    tagged = [project.tag(frame, name, tag_column) for name, frame in frames.items()]
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def overlay(frames: dict[str, DataFrame], update: dict[str, DataFrame] | None) -> dict[str, DataFrame]:
    """Named frames with later ones taking the place of earlier ones."""
    return {**frames, **(update or {})}
