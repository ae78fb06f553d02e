"""Point-in-time and newest-k views of append-only versioned rows.

Every "first row per group" is a ranking window with a small bound, so Spark cuts each group to that bound
before the shuffle; a group with a third of all rows sends a few rows per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import times


def first_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int = 1) -> DataFrame:
    """The first `k` rows of every group. Spark cuts groups before the shuffle up to the `k` that the setting
    spark.sql.optimizer.windowGroupLimitThreshold names; `build_session` raises it, so that a hot group is never ranked whole in one task."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") <= k).drop("_rank")


def _tie_break(df: DataFrame, used: list[str]) -> list[Column]:
    return [F.desc_nulls_last(c) for c in df.columns if c not in used]


def latest_version(df: DataFrame, keys: list[str] = ("series", "date")) -> DataFrame:
    """The version of each key that arrived last; equal arrivals are decided by the other columns."""
    keys = list(keys)
    order = [F.desc_nulls_last("created_at"), *_tie_break(df, [*keys, "created_at"])]
    return first_per_group(df, keys, order)


def frozen_snapshot(df: DataFrame, as_of, keys: list[str] = ("series", "date")) -> DataFrame:
    """What was known at `as_of`: one row per key.

    Dates up to `as_of` count versions that had arrived by then; later dates count versions that arrived by the
    end of that date. Each rule is a filter of its own, so the scan can skip row groups by the first.
    """
    moment = times.as_timestamp(as_of)
    today = times.as_date(as_of)
    date = F.to_date("date")
    arrived = F.col("created_at").cast("timestamp_ntz")
    visible = df.where((date > today) | (arrived <= moment)).where((date <= today) | (arrived <= times.end_of_day(date)))
    return latest_version(visible, keys)


def last_write_wins(stored: DataFrame, incoming: DataFrame, key: str = "id", stamp: str = "timestamp") -> DataFrame:
    """One row per id: the greatest timestamp. A stored row yields only to a greater one, or when it has none."""
    both = stored.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    preference = F.when(F.col(stamp).isNull(), -F.col("_new")).otherwise(F.col("_new"))
    order = [F.desc_nulls_last(stamp), preference.asc(), *_tie_break(stored, [key, stamp])]
    return first_per_group(both, [key], order).drop("_new")


def history(
    df: DataFrame, symbol: str, start: int | None = None, end: int | None = None, countback: int = 5
) -> DataFrame:
    """Newest `countback` rows of one `category:column` within epoch-ms bounds, oldest first."""
    from .project import between_millis

    category, column = symbol.split(":")
    if column not in df.columns:
        raise ValueError(f"no column {column!r} in {df.columns}")
    rows = between_millis(df.where(F.col("category") == category), start, end).select("date", column)
    return rows.orderBy(F.desc("date"), F.desc(column)).limit(countback).orderBy("date", column)


def history_all(df: DataFrame, value: str = "value", countback: int = 5, series: str = "series") -> DataFrame:
    """Newest `countback` rows of every series."""
    rows = df.select(series, "date", value)
    return first_per_group(rows, [series], [F.desc("date"), F.desc(value)], countback)


def history_arrays(df: DataFrame, value: str = "value", countback: int = 5, series: str = "series") -> DataFrame:
    """Newest `countback` rows of every series as status, epoch-ms times and values, oldest first.

    The arrays hold at most `countback` elements, whatever the length of the series.
    """
    points = F.array_sort(F.collect_list(F.struct(times.to_epoch_millis(F.col("date")).alias("t"), F.col(value).alias("c"))))
    return (
        history_all(df, value, countback, series)
        .groupBy(series)
        .agg(points.alias("_points"))
        .select(series, F.lit("ok").alias("s"), F.col("_points.t").alias("t"), F.col("_points.c").alias("c"))
    )


def history_answer(
    df: DataFrame, symbol: str, start: int | None = None, end: int | None = None, countback: int = 5
) -> DataFrame:
    """One row that answers for one `category:column` within epoch-ms bounds: status, times and values, oldest first.

    The status is `ok`, or `no_data` with empty arrays. The arrays hold at most `countback` elements.
    """
    column = symbol.split(":")[1]
    rows = history(df, symbol, start, end, countback)
    points = F.array_sort(F.collect_list(F.struct(times.to_epoch_millis(F.col("date")).alias("t"), F.col(column).alias("c"))))
    return rows.agg(points.alias("_points")).select(
        F.when(F.size("_points") > 0, "ok").otherwise("no_data").alias("s"), F.col("_points.t").alias("t"), F.col("_points.c").alias("c")
    )


def latest_facts(df: DataFrame, series: str = "series") -> DataFrame:
    """Per series the newest date and the arrival of that row; among equal dates the latest arrival."""
    newest = df.groupBy(series).agg(F.max(F.struct("date", "created_at")).alias("_newest"))
    return newest.select(
        series, F.col("_newest.date").alias("latest_date"), F.col("_newest.created_at").alias("last_update")
    )
