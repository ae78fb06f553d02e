"""Plug-in sources of dated rows as Spark data sources: read in as many tasks as wanted, pruned by date filters, and as a stream by day.

A plug-in says which days it has and gives the rows of a day; the rest is here.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual,
)

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
ONE = dt.timedelta(days=1)


class Days(InputPartition):
    """The days from `first` to `last`, both included."""

    def __init__(self, first: dt.date, last: dt.date):
        self.first, self.last = first, last

    def __iter__(self) -> Iterator[dt.date]:
        return iter(self.first + n * ONE for n in range((self.last - self.first).days + 1))


def dealt(first: dt.date, last: dt.date, number: int) -> list[Days]:
    """The days in at most `number` runs of about the same length."""
    total = (last - first).days + 1
    if total <= 0:
        return []
    number = min(max(1, number), total)
    bounds = [first + (total * n // number) * ONE for n in range(number + 1)]
    return [Days(a, b - ONE) for a, b in zip(bounds, bounds[1:], strict=False)]


def narrowed(first: dt.date, last: dt.date, test: Filter, column: str) -> tuple[dt.date, dt.date] | None:
    """The days that a filter on the date leaves; None if it is another filter."""
    day = getattr(test, "value", None)
    if getattr(test, "attribute", None) != (column,) or not isinstance(day, dt.date) or isinstance(day, dt.datetime):
        return None
    if isinstance(test, EqualTo):
        return max(first, day), min(last, day)
    if isinstance(test, GreaterThanOrEqual):
        return max(first, day), last
    if isinstance(test, GreaterThan):
        return max(first, day + ONE), last
    if isinstance(test, LessThanOrEqual):
        return first, min(last, day)
    if isinstance(test, LessThan):
        return first, min(last, day - ONE)
    return None


def dated_source(
    name: str, schema: str, days: Callable[[dict], tuple[dt.date, dt.date]], rows: Callable[[dt.date, dict], Iterable], date: str = "date"
) -> type[DataSource]:
    """A data source class. `days(options)` gives the first and the last day there is, `rows(day, options)` the rows of a day as tuples or Arrow batches,
    each of which has that day in the column `date`; both get the options of the read.

    The option `tasks` (default 8) says in how many tasks the days are read, or those of a micro-batch. Filters on the date choose days before anything is
    read. A stream takes all new days at each trigger; its offset is the last day taken, so a day must be complete when `days` names it.
    """

    class Reader(DataSourceReader):
        def __init__(self, options: dict):
            self.options = dict(options)
            self.first, self.last = days(self.options)

        def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
            for test in filters:
                left = narrowed(self.first, self.last, test, date)
                if left is None:
                    yield test
                else:
                    self.first, self.last = left

        def partitions(self) -> list[Days]:
            return dealt(self.first, self.last, int(self.options.get("tasks", 8))) or [Days(dt.date(1970, 1, 2), dt.date(1970, 1, 1))]

        def read(self, partition: Days) -> Iterator:
            for day in partition:
                yield from rows(day, self.options)

    class StreamReader(DataSourceStreamReader):
        def __init__(self, options: dict):
            self.options = dict(options)

        def initialOffset(self) -> dict:  # noqa: N802
            return {"day": (days(self.options)[0] - ONE).isoformat()}

        def latestOffset(self) -> dict:  # noqa: N802
            return {"day": days(self.options)[1].isoformat()}

        def partitions(self, start: dict, end: dict) -> list[Days]:
            first, last = (dt.date.fromisoformat(o["day"]) for o in (start, end))
            return dealt(first + ONE, last, int(self.options.get("tasks", 8)))

        def read(self, partition: Days) -> Iterator:
            for day in partition:
                yield from rows(day, self.options)

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def reader(self, schema) -> Reader:  # noqa: ARG002
            return Reader(self.options)

        def streamReader(self, schema) -> StreamReader:  # noqa: ARG002, N802
            return StreamReader(self.options)

    return Source


def register_dated_source(spark: SparkSession, source: type[DataSource]) -> None:
    """Makes a source known to a session, with its filters pushed down."""
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(source)
