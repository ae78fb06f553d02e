"""Which series are late for their publishing frequency, and the report on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text, times
from .catalog import wide_catalogue
from .numbering import number_rows

# Column titles and widths of the report.
REPORT_COLUMNS = [
    ("Index Name", 60),
    ("Frequency", 12),
    ("Expect_Date", 12),
    ("Last_Update", 25),
    ("Other Info", 10),
]
PAGE_ROWS = 10


def on_time(as_of, latest_date: Column, last_update: Column, frequency: Column, other: Column) -> Column:
    """Whether a series meets its frequency on the day `as_of`; an unknown frequency never does.

    A rule that lacks its day number or weekday name can still be met by the period test alone.
    """
    now = times.as_date(as_of)
    day = other.try_cast("int")
    within_a_day = F.abs(F.date_diff(now, last_update)) <= 1
    by_day = F.coalesce(F.dayofmonth(now) <= day, F.lit(False))
    weekly = times.same_iso_week(now, last_update) | F.coalesce(
        F.weekday(now) <= times.weekday_index(other), F.lit(False)
    )
    monthly = times.same_month(now, last_update) | (times.within_one_month(last_update, now) & by_day)
    quarterly = times.same_quarter(now, last_update) | (F.month(now) % 3 != 0) | by_day
    half_yearly = times.same_half_year(now, last_update) | (F.month(now) % 6 != 0) | by_day
    return F.coalesce(
        F.when((frequency == "Daily") & (other == "Yes"), within_a_day)
        .when((frequency == "Daily") & (other == "No"), latest_date >= times.last_weekday(now))
        .when(frequency == "Weekly", weekly)
        .when(frequency == "Monthly", monthly)
        .when(frequency == "Quarterly", quarterly)
        .when(frequency == "Bi-annually", half_yearly),
        F.lit(False),
    )


def freshness_flags(catalogue: DataFrame, as_of) -> DataFrame:
    """Every table with a frequency and a last update: recently updated, and failed. A table can be both."""
    wide = wide_catalogue(catalogue).where(F.col("frequency").isNotNull() & F.col("last_update").isNotNull())
    last_update = F.to_date("last_update")
    latest_date = F.to_date("latest_date")
    return wide.select(
        *wide.columns,
        (F.abs(F.date_diff(times.as_date(as_of), last_update)) <= 1).alias("recently_updated"),
        (~on_time(as_of, latest_date, last_update, F.col("frequency"), F.col("other"))).alias("failed"),
    )


def report(flags: DataFrame, column: str) -> DataFrame:
    """Report lines of the flagged tables in pages of ten, in table order."""
    listed = flags.where(F.col(column)).select(
        "table_name", "category", "name", "frequency", "other", "last_update", "latest_date"
    )
    line = text.report_line(
        *zip(
            [
                F.concat_ws("_", "category", "name"),
                F.col("frequency"),
                F.col("other"),
                F.col("last_update"),
                F.col("latest_date"),
            ],
            [width for _title, width in REPORT_COLUMNS],
        )
    )
    numbered = number_rows(listed, ["table_name"], "number")
    return numbered.select(
        F.lit(column).alias("section"),
        F.floor(F.col("number") / PAGE_ROWS).alias("page"),
        (F.col("number") % PAGE_ROWS).alias("line_number"),
        "table_name",
        line.alias("line"),
    )


def report_header() -> str:
    return "| " + " | ".join(title.ljust(width) for title, width in REPORT_COLUMNS) + " |"
