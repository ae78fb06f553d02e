"""Column cleaning: coerce to a kind, null what does not fit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import times
from . import project

KINDS = ["number", "string", "boolean", "datetime", "category", "integer", "float"]


def to_number(value: Column) -> Column:
    return value.try_cast("double")


def to_text(value: Column) -> Column:
    """Text with empty as null; null stays null."""
    return F.nullif(value.cast("string"), F.lit(""))


def to_truth(value: Column, kind: str) -> Column:
    """Non-empty text and non-zero numbers are true; null is false."""
    if kind == "boolean":
        return F.coalesce(value, F.lit(False))
    if kind == "string":
        return F.coalesce(value != "", F.lit(False))
    return F.coalesce(value != 0, F.lit(False))


def to_datetime(value: Column, formats: list[str] | None = None) -> Column:
    """Parse or null; with several formats the first that fits wins. Without any, ISO text and the usual formats are read."""
    if not formats:
        return times.parse_text(value.cast("string"))
    return F.coalesce(*[F.try_to_timestamp(value, F.lit(f)).cast("timestamp_ntz") for f in formats])


def unreadable(df: DataFrame, column: str, formats: list[str] | None = None) -> DataFrame:
    """The texts that `to_datetime` would lose, with how often each occurs."""
    lost = F.col(column).isNotNull() & to_datetime(F.col(column), formats).isNull()
    return df.where(lost).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def to_float32(value: Column) -> Column:
    return value.try_cast("double").cast("float")


def whole_numbers_only(df: DataFrame, column: str) -> bool:
    """Whether every number in the column is whole; one column-pruned aggregate."""
    number = to_number(F.col(column))
    fraction = F.max(F.when(number.isNotNull(), (F.isnan(number) | (F.abs(number) == float("inf")) | (number % 1 != 0))))
    return not df.agg(fraction.alias("fraction")).first()["fraction"]


def to_integer_or_number(df: DataFrame, column: str) -> DataFrame:
    """Numbers, narrowed to BIGINT when all of them are whole."""
    number = to_number(F.col(column))
    return df.withColumn(column, number.try_cast("bigint") if whole_numbers_only(df, column) else number)


def to_integer_strict(value: Column) -> Column:
    """Row by row: whole numbers as BIGINT, anything else null."""
    number = to_number(value)
    return F.when(number % 1 == 0, number.try_cast("bigint"))


def clean_column(
    df: DataFrame,
    column: str,
    kind: str,
    restriction: Callable | None = None,
    formats: list[str] | None = None,
) -> DataFrame:
    value = F.col(column)
    if kind == "number":
        df = df.withColumn(column, to_number(value))
    elif kind in ("string", "category"):
        df = df.withColumn(column, to_text(value))
    elif kind == "boolean":
        df = df.withColumn(column, to_truth(value, dict(df.dtypes)[column]))
    elif kind == "datetime":
        df = df.withColumn(column, to_datetime(value, formats))
    elif kind == "integer":
        df = to_integer_or_number(df, column)
    elif kind == "float":
        df = df.withColumn(column, to_float32(value))
    else:
        raise ValueError(f"unknown kind {kind!r}, expected one of {KINDS}")
    return project.keep_where(df, column, restriction) if restriction else df


def category_codes(df: DataFrame, column: str, code: str = "code") -> DataFrame:
    """Dense codes in the order of the category names.

    Only the distinct names are ranked, so the ordering never sees the rows themselves.
    """
    from .numbering import number_rows

    names = number_rows(df.select(column).where(F.col(column).isNotNull()).distinct(), [column], code)
    return df.join(names, column, "left")


def clean_date_value(
    df: DataFrame,
    kind: str = "number",
    restriction: Callable | None = None,
    column: str = "value",
    formats: list[str] | None = None,
) -> DataFrame:
    """Clean `date` and the value column, drop rows where either is missing, put `date` first."""
    df = clean_column(df, "date", "datetime", formats=formats)
    df = clean_column(df, column, kind, restriction)
    return project.date_first(project.drop_missing(df, ["date", column]))
