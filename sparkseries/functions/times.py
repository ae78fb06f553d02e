"""Date and time expressions. Timestamps are naive UTC; "now" is always passed in."""

from __future__ import annotations

import datetime as dt

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday names in index order, Monday = 0.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def as_timestamp(moment: dt.datetime | str | Column) -> Column:
    """A literal or column as TIMESTAMP_NTZ."""
    if isinstance(moment, Column):
        return moment.cast("timestamp_ntz")
    if isinstance(moment, dt.datetime):
        moment = moment.isoformat(sep=" ")
    return F.lit(moment).cast("timestamp_ntz")


def as_date(moment: dt.date | str | Column) -> Column:
    if isinstance(moment, Column):
        return moment.cast("date")
    if isinstance(moment, dt.datetime):
        moment = moment.date()
    return F.lit(str(moment)[:10]).cast("date")


def epoch_micros(moment: Column) -> Column:
    return F.unix_micros(moment.cast("timestamp"))


# How publishers write dates, in the order in which the formats are tried; months come before days.
DATE_FORMATS = [
    "MMM d, yyyy", "MMMM d, yyyy", "d MMM yyyy", "d MMMM yyyy", "M/d/yyyy", "M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "yyyy/M/d", "yyyyMMdd",
    "d.M.yyyy", "MMM yyyy", "MMMM yyyy",
]


def parse_text(value: Column, formats: Iterable[str] | None = None) -> Column:
    """Date text as a timestamp, null when nothing fits: ISO text first, then the given formats or the usual ones."""
    tried = [F.try_to_timestamp(value, F.lit(f)).cast("timestamp_ntz") for f in (formats or DATE_FORMATS)]
    compact = value.rlike("^[0-9]{5,}$")  # a bare number is a year only up to four digits
    iso = F.when(~compact, value.try_cast("timestamp_ntz"))
    return F.coalesce(iso, *tried)


def from_epoch_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis).cast("timestamp_ntz")


def to_epoch_millis(moment: Column) -> Column:
    return F.unix_millis(moment.cast("timestamp"))


def to_epoch_nanos(moment: Column) -> Column:
    return epoch_micros(moment) * F.lit(1000)


def from_epoch_nanos(nanos: Column) -> Column:
    return F.timestamp_micros(_floor_div(nanos, 1000)).cast("timestamp_ntz")


def _floor_div(number: Column, by: int) -> Column:
    """Whole-number division rounded down, without a detour through doubles."""
    return F.call_function("div", number - F.pmod(number, F.lit(by)), F.lit(by))


def clamp_future(created_at: Column, as_of) -> Column:
    """An arrival time after `as_of` becomes `as_of`; null stays null."""
    now = as_timestamp(as_of)
    return F.when(created_at.cast("timestamp_ntz") > now, now).otherwise(created_at.cast("timestamp_ntz"))


def end_of_day(date: Column) -> Column:
    """One second before the next day starts."""
    return F.to_date(date).cast("timestamp_ntz") + F.expr("INTERVAL '23:59:59' HOUR TO SECOND")


def partial_date(text: Column) -> Column:
    """`YYYY`, `YYYY-MM` or `YYYY-MM-DD` as the first day it names."""
    return text.try_cast("date")


def date_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd")


def datetime_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def human_time(millis: Column) -> Column:
    return datetime_text(from_epoch_millis(millis))


def next_boundary(moment: Column, seconds: int = 600) -> Column:
    """The next whole multiple of `seconds`, strictly after `moment`."""
    step = _floor_div(epoch_micros(moment), seconds * 1_000_000) + 1
    return F.timestamp_seconds(step * seconds).cast("timestamp_ntz")


def duration_text(seconds: Column) -> Column:
    """`N days, N hours, N minutes, S seconds`; parts that are zero are left out."""
    days = F.floor(seconds / 86400)
    hours = F.floor((seconds - days * 86400) / 3600)
    minutes = F.floor((seconds - days * 86400 - hours * 3600) / 60)
    rest = seconds - days * 86400 - hours * 3600 - minutes * 60
    rest_text = F.regexp_replace(F.format_string("%.2f", rest.cast("double")), r"\.?0+$", "")
    parts = [F.when(n > 0, F.format_string(f"%d {unit}", n)) for n, unit in
             ((days, "days"), (hours, "hours"), (minutes, "minutes"))]
    parts.append(F.when(F.round(rest, 2) > 0, F.concat(rest_text, F.lit(" seconds"))))
    return F.when(seconds.isNotNull(), F.concat_ws(", ", *parts))


def weekday_index(name: Column) -> Column:
    """Monday = 0 … Sunday = 6; null for anything else."""
    position = F.array_position(F.array(*[F.lit(day) for day in WEEKDAYS]), name)
    return F.when(position > 0, (position - 1).cast("int"))


def last_weekday(now: Column) -> Column:
    """The latest Monday-to-Friday day that is at least two days before `now`."""
    candidate = F.date_sub(now, 2)
    return F.date_sub(candidate, F.greatest(F.weekday(candidate) - 4, F.lit(0)))


def same_iso_week(left: Column, right: Column) -> Column:
    return F.date_trunc("week", left) == F.date_trunc("week", right)


def same_month(left: Column, right: Column) -> Column:
    return F.trunc(left, "month") == F.trunc(right, "month")


def same_quarter(left: Column, right: Column) -> Column:
    return F.trunc(left, "quarter") == F.trunc(right, "quarter")


def same_half_year(left: Column, right: Column) -> Column:
    return (F.year(left) == F.year(right)) & (F.ceil(F.month(left) / 6) == F.ceil(F.month(right) / 6))


def within_one_month(earlier: Column, later: Column) -> Column:
    """Neighbouring months of one year, in either order, or December followed by January."""
    in_year = (F.year(earlier) == F.year(later)) & (F.abs(F.month(earlier) - F.month(later)) == 1)
    over_year = (F.abs(F.year(later) - F.year(earlier)) == 1) & (F.month(earlier) == 12) & (F.month(later) == 1)
    return in_year | over_year
