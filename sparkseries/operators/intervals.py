"""Versions as intervals of validity, and snapshots at any number of moments from them.

A snapshot at one moment ranks all versions. When many moments are asked for, the versions are turned into intervals once: each row says
from when until when it is what a snapshot shows. A snapshot is then an as-of range join, whose work follows its result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import times

FROM, TO = "valid_from", "valid_to"
KEYS = ("series", "date")
#: So many rows of moments and their blocks are sent to every executor, some MB; the intervals then stay where they are.
FEW_POINTS = 200_000


def version_intervals(df: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """The rows that some snapshot shows, with `valid_from` and `valid_to`; a null bound is open, the end is not included.

    A version is shown from its arrival, or the start of its date if that is later, until the next version of its key arrives. Before its date
    starts, a key shows the last version that arrived by the end of that date. Of versions with equal arrivals the one that
    `latest_version` takes counts. Rows without date or arrival are in no snapshot. Copies collapse before the shuffle, and a key with very
    many versions is cut by the month of their arrival, so it does not make one task long.
    """
    return _intervals(df.withColumn("_past", F.lit(False)), list(keys))


def _intervals(df: DataFrame, keys: list[str]) -> DataFrame:
    """Versions that are `_past` have an end already, which is not looked for again; they only tell what is shown before their date."""
    own = [c for c in df.columns if c != "_past"]
    rest = [c for c in own if c not in (*keys, "created_at")]
    known = df.where(F.col("date").isNotNull() & F.col("created_at").isNotNull())
    chosen = [F.max(F.struct(*rest)).alias("_rest")] if rest else []
    one = known.groupBy(*keys, "created_at").agg(F.min("_past").alias("_past"), *chosen)
    arrived = F.col("created_at").cast("timestamp_ntz")
    one = one.withColumns({"_at": arrived, "_month": F.date_trunc("month", arrived)})
    month = Window.partitionBy(*keys, "_month")
    whole = Window.unboundedPreceding, Window.unboundedFollowing
    linked = one.withColumns({
        "_next": F.lead("_at").over(month.orderBy("_at")), "_first": F.min("_at").over(month.orderBy("_at").rowsBetween(*whole)),
    })
    # The last version of a month is followed by the first of the next month that has any; a key has one such row a month.
    ends = linked.where(F.col("_next").isNull()).withColumn("_next", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_month")))
    linked = linked.where(F.col("_next").isNotNull()).unionByName(ends)
    begins = F.to_date("date").cast("timestamp_ntz")
    closes = times.end_of_day(F.col("date"))
    none = F.lit(None).cast("timestamp_ntz")
    shown = F.greatest("_at", begins)
    after = F.when(~F.col("_past") & (F.col("_next").isNull() | (F.col("_next") > shown)), F.struct(shown.alias(FROM), F.col("_next").alias(TO)))
    last_of_date = (F.col("_at") <= closes) & (F.col("_next").isNull() | (F.col("_next") > closes))
    before = F.when(last_of_date, F.struct(none.alias(FROM), begins.alias(TO)))
    spans = F.explode(F.filter(F.array(before, after), lambda s: s.isNotNull())).alias("_span")
    columns = [F.col("_rest")[c].alias(c) if c in rest else F.col(c) for c in own]
    return linked.select(*columns, spans).select(*own, f"_span.{FROM}", f"_span.{TO}")


def append_versions(intervals: DataFrame, fresh: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """The intervals after some versions have arrived, early or late: those of other keys as they are, those of these keys anew.

    Of a table of intervals, those with an open bound and those that end after the first of the fresh arrivals are enough. Versions
    that no snapshot shows are not in it; no later arrival could bring them back.
    """
    columns = [c for c in intervals.columns if c not in (FROM, TO)]
    same = [F.col(f"i.{k}").eqNullSafe(F.col(f"k.{k}")) for k in keys]
    touched = fresh.select(*keys).distinct().alias("k")
    others = intervals.alias("i").join(touched, same, "left_anti")
    own = intervals.alias("i").join(touched, same, "left_semi")
    # A version of which only the row before its date is here has ended before.
    held = own.groupBy(*columns).agg(F.min(F.col(FROM).isNull()).alias("_past"))
    every = held.unionByName(fresh.select(*columns, F.lit(False).alias("_past")))
    return others.unionByName(_intervals(every, list(keys)))


def _micros(moment: Column) -> Column:
    return times.epoch_micros(moment)


def snapshots_at(intervals: DataFrame, moments: DataFrame, moment: str = "moment") -> DataFrame:
    """(moment, the columns of the versions): what every one of the moments knew, one row for each moment and key that had a version by then.

    Time is cut into buckets, about one for each moment. An interval is taken apart into few blocks of buckets, each twice as long as one of the level
    below (at most two a level, as in a segment tree), and its two ends; a moment stands in one block of each level. Both sides meet in an
    equi-join on the blocks, exactly once for each pair, so there is neither a product nor a copy of an interval for each of its days.

    A large block has a good part of all intervals. So few moments are broadcast whatever the session's limit is, and no block is sent to one task;
    the blocks of many moments are shuffled, where adaptive execution splits the large ones.
    """
    asked = moments.select(F.col(moment).cast("timestamp_ntz").alias("_moment")).where(F.col("_moment").isNotNull()).distinct()
    low, high, number = asked.agg(F.min(_micros(F.col("_moment"))), F.max(_micros(F.col("_moment"))), F.count(F.lit(1))).first()
    rows = intervals.drop(FROM, TO)
    if not number:
        return rows.select(F.lit(None).cast("timestamp_ntz").alias(moment), *rows.columns).limit(0)
    width = max(1, -(-(high - low + 1) // number))
    buckets = (high - low) // width + 1
    levels = max(1, math.ceil(math.log2(buckets + 1)))

    def bucket(at: Column) -> Column:
        """The bucket of a time, also outside the range of the moments."""
        return F.call_function("div", at - F.pmod(at, F.lit(width)), F.lit(width).cast("bigint"))

    shifted = _micros(F.col("_moment")) - low
    stands = F.transform(F.sequence(F.lit(0), F.lit(levels)), lambda k: F.struct(k.alias("level"), _right(bucket(shifted), k).alias("block")))
    points = asked.select("_moment", F.explode(F.array_append(stands, F.struct(F.lit(-1).alias("level"), bucket(shifted).alias("block")))).alias("_at"))

    start = F.greatest(F.coalesce(_micros(F.col(FROM)) - low, F.lit(0)), F.lit(0))
    end = F.least(F.coalesce(_micros(F.col(TO)) - low, F.lit(high - low + 1)), F.lit(high - low + 1))
    spans = intervals.withColumns({"_start": start, "_end": end}).where(F.col("_start") < F.col("_end"))
    first = bucket(F.col("_start") + (width - 1))
    last = bucket(F.col("_end")) - 1
    spans = spans.withColumns({"_first": first, "_last": last})

    def blocks(k: Column) -> Column:
        # The blocks of this level that lie inside, and of these the ones whose block of the next level does not.
        size = F.call_function("shiftleft", F.lit(1).cast("bigint"), k)
        left, right = _right(F.col("_first") + size - 1, k), _right(F.col("_last") + 1, k) - 1
        return F.array(
            F.when((left <= right) & (left % 2 == 1), F.struct(k.alias("level"), left.alias("block"))),
            F.when((left <= right) & (right % 2 == 0), F.struct(k.alias("level"), right.alias("block"))),
        )

    inner = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), blocks))
    # Ends inside a bucket: what they share with a moment's bucket is compared exactly.
    opening, closing = bucket(F.col("_start")), bucket(F.col("_end"))
    edge_a = F.when(opening < F.col("_first"), F.struct(F.lit(-1).alias("level"), opening.alias("block")))
    edge_b = F.when((closing > F.col("_last")) & (closing * width < F.col("_end")) & ((opening >= F.col("_first")) | (closing != opening)),
                    F.struct(F.lit(-1).alias("level"), closing.alias("block")))
    parts = F.filter(F.concat(inner, F.array(edge_a, edge_b)), lambda p: p.isNotNull())
    spread = spans.select(*rows.columns, FROM, TO, F.explode(parts).alias("_at"))
    if number * (levels + 2) <= FEW_POINTS:
        points = F.broadcast(points)
    met = spread.join(points, "_at").where(
        (F.col(FROM).isNull() | (F.col(FROM) <= F.col("_moment"))) & (F.col(TO).isNull() | (F.col("_moment") < F.col(TO)))
    )
    return met.select(F.col("_moment").alias(moment), *rows.columns)


def _right(value: Column, by: Column) -> Column:
    return F.call_function("shiftright", value, by)
