"""Row and column shaping of series frames."""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import times
from ..session import ensure_checkpoint_dir

# Tables with these prefixes hold no series.
RESERVED_PREFIXES = ["__metadata__", "_metadata", "categories", "normalized"]
HELPER_COLUMNS = ["index", "id", "endOfDayDatetime"]


def rename_date(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("Date", "date")


def rename_by_position(df: DataFrame, names: tuple[str, ...] = ("date", "value")) -> DataFrame:
    """The first columns get the given names, the others keep theirs."""
    return df.toDF(*names, *df.columns[len(names):])


def adjusted_close(df: DataFrame, as_of) -> DataFrame:
    """Daily quotes as a series: two decimals, nothing later than the day before `as_of`."""
    return cut_after_yesterday(
        df.select(F.col("Date").alias("date"), F.round(F.col("Adj Close"), 2).alias("value")), as_of
    )


def cut_after_yesterday(df: DataFrame, as_of, column: str = "date") -> DataFrame:
    """Rows dated before `as_of`; written as a plain range so it reaches the scan."""
    if dict(df.dtypes)[column] == "date":
        return df.where(F.col(column) < times.as_date(as_of))
    return df.where(F.col(column) < times.as_date(as_of).cast("timestamp_ntz"))


def between_millis(
    df: DataFrame, start: int | None = None, end: int | None = None, column: str = "date"
) -> DataFrame:
    """Inclusive range given in epoch milliseconds; an open bound is None."""
    kind = dict(df.dtypes)[column]

    def bound(millis: int) -> Column:
        return times.from_epoch_millis(F.lit(int(millis))).cast("timestamp_ntz")

    value = F.col(column) if kind == "timestamp_ntz" else F.col(column).cast("timestamp_ntz")
    if start is not None:
        df = df.where(value >= bound(start))
    if end is not None:
        df = df.where(value <= bound(end))
    return df


def parse_date_columns(
    df: DataFrame, columns: Iterable[str] = ("date", "createdAt"), formats: Iterable[str] | None = None, strict: bool = True
) -> DataFrame:
    """Text in the known date columns becomes a timestamp; columns that are absent are skipped.

    ISO text and the formats of `times.DATE_FORMATS`, or the given ones, are read. Other text is an error, or null without `strict`.
    """
    kinds = dict(df.dtypes)
    parsed = {}
    for column in columns:
        if kinds.get(column) == "string":
            text = F.nullif(F.trim(F.col(column)), F.lit(""))
            value = times.parse_text(text, formats)
            if strict:
                refused = F.raise_error(F.concat(F.lit(f"unreadable date in column {column}: "), text))
                value = F.when(text.isNull() | value.isNotNull(), value).otherwise(refused)
            parsed[column] = value
    return df.withColumns(parsed) if parsed else df


def keep_where(df: DataFrame, column: str, predicate: Callable) -> DataFrame:
    """Rows whose value passes. A predicate over Columns is compiled; one over plain values runs in Arrow batches.

    A plain predicate that raises counts as false, and so does a null result.
    """
    try:
        condition = predicate(F.col(column))
    except Exception:
        condition = None
    if isinstance(condition, Column):
        return df.where(condition)

    @F.pandas_udf("boolean")
    def passes(values: pd.Series) -> pd.Series:
        def attempt(value):
            try:
                return bool(predicate(value))
            except Exception:
                return False

        return values.map(attempt).astype(bool)

    return df.where(passes(F.col(column)))


def drop_missing(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop rows with a null or NaN in the columns (all columns by default)."""
    return df.dropna(subset=subset or df.columns)


def tag(df: DataFrame, name: str, column: str = "table") -> DataFrame:
    return df.withColumn(column, F.lit(name))


def exclude_prefixes(df: DataFrame, column: str, prefixes: Iterable[str] = tuple(RESERVED_PREFIXES)) -> DataFrame:
    starts = functools.reduce(operator.or_, [F.col(column).startswith(p) for p in prefixes])
    return df.where(~starts)


def keep_listed(df: DataFrame, column: str, allowed: Iterable) -> DataFrame:
    return df.where(F.col(column).isin(list(allowed)))


def stamp_created(df: DataFrame, as_of) -> DataFrame:
    """Give every row an arrival time: `as_of` when there is none, never later than `as_of`."""
    if "created_at" not in df.columns:
        return df.withColumn("created_at", times.as_timestamp(as_of))
    return df.withColumn("created_at", times.clamp_future(F.col("created_at"), as_of))


def like_target(df: DataFrame, columns: list[str]) -> DataFrame:
    """The target's columns in its order; extra columns go, a missing one is an error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"incoming rows lack target columns: {missing}")
    return df.select(*columns)


def drop_helpers(df: DataFrame, names: Iterable[str] = tuple(HELPER_COLUMNS)) -> DataFrame:
    return df.drop(*names)


def nan_as_null(df: DataFrame) -> DataFrame:
    floating = [name for name, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating}) if floating else df


def date_first(df: DataFrame) -> DataFrame:
    return df.select("date", *[c for c in df.columns if c != "date"])


def sort_rows(df: DataFrame, *order: str | Column, scanned: bool = False) -> DataFrame:
    """Globally sorted rows.

    Rows straight from a file scan (`scanned`) that agree in the order keep their place. Others are ordered by a hash of all their columns,
    and rows that are equal throughout collapse to a count before the shuffle, so no value makes a range partition large and no copy of
    the data is written.
    """
    if scanned:
        return df.withColumn("_place", F.monotonically_increasing_id()).orderBy(*order, "_place").drop("_place")
    if any(kind.startswith("map") for kind in dict(df.dtypes).values()):
        ensure_checkpoint_dir(df.sparkSession)  # maps can neither be grouped nor hashed
        return sort_rows(df.checkpoint(), *order, scanned=True)
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    ordered = counted.orderBy(*order, F.xxhash64(*[F.col(c) for c in df.columns]), *df.columns)
    return ordered.select(*df.columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy")).drop("_copy")


def sort_numeric_text(df: DataFrame, column: str, scanned: bool = False) -> DataFrame:
    return sort_rows(df, F.col(column).try_cast("bigint"), column, scanned=scanned)


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
