"""Queries over versions and streams that are kept up as rows arrive: snapshots at many moments, compacted stores, state."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import intervals
from ..session import scratch_path
from ..sources import plugin, runs, version_store
from ..streaming import jobs, state
from .ingest import before_and_after, streamed
from .registry import query

VERSIONS = "SELECT event_type AS series, CAST(ts AS DATE) + CAST(user_id % 3 AS INTEGER) AS date, user_id, value, ts AS created_at FROM events"
DAYS = "SELECT DISTINCT CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 12 HOUR AS moment FROM events"
EVERY_DAY = f"""
WITH v AS ({VERSIONS}), d AS ({DAYS})
SELECT moment, series, date, user_id, value, created_at FROM d JOIN v ON
  CASE WHEN date <= CAST(moment AS DATE) THEN created_at <= moment ELSE created_at <= CAST(date AS TIMESTAMP) + INTERVAL 86399 SECOND END
QUALIFY row_number() OVER (PARTITION BY moment, series, date, user_id ORDER BY created_at DESC, value DESC) = 1"""
KEYS = ("series", "date", "user_id")


def versions(t):
    """Versions of a value of a user, some of them for dates to come."""
    date = F.date_add(F.to_date("ts"), (F.col("user_id") % 3).cast("int"))
    return t.events.select(F.col("event_type").alias("series"), date.alias("date"), "user_id", "value", F.col("ts").alias("created_at"))


def days(t):
    return t.events.select((F.to_date("ts").cast("timestamp_ntz") + F.expr("INTERVAL 12 HOURS")).alias("moment")).distinct()


@query("snapshots_every_day", EVERY_DAY)
def snapshots_every_day(t):
    """What was known at noon of every day there is, in one job over intervals of validity."""
    return intervals.snapshots_at(intervals.version_intervals(versions(t), KEYS), days(t))


@query("snapshots_kept_up", EVERY_DAY)
def snapshots_kept_up(t):
    """The same from a store that three appends have kept up, the last of them with arrivals from before the others."""
    path, rows = scratch_path(t.spark, "intervals"), versions(t)
    for low, high in (("2024-01-08", "2024-01-16"), ("2024-01-16", "2999-01-01"), ("1970-01-01", "2024-01-08")):
        arrived = (F.col("created_at") >= F.lit(low).cast("timestamp_ntz")) & (F.col("created_at") < F.lit(high).cast("timestamp_ntz"))
        version_store.append_to_store(t.spark, path, rows.where(arrived), KEYS)
    return version_store.stored_snapshots(t.spark, path, days(t), rows)


@query("stream_compacted", "SELECT event_type AS series, CAST(ts AS DATE) AS date, user_id, value, min(ts) AS created_at FROM events GROUP BY ALL")
def stream_compacted(t):
    """New rows of a stream in a store by month, whose runs are merged; each part arrives twice and only its first rows count."""
    rows = t.events.select(
        F.col("event_type").alias("series"), F.to_date("ts").alias("date"), "user_id", "value", F.col("ts").alias("created_at")
    )
    path, checkpoint = scratch_path(t.spark, "compacted"), scratch_path(t.spark, "state")
    early, late = before_and_after(rows, "created_at")
    streamed(t, [early, late.unionAll(early), late], lambda stream: jobs.stream_reconcile_compacted(stream, path, checkpoint))
    return runs.read_store(t.spark, path, rows)


BY_ID = "SELECT user_id || '-' || event_type AS id, ts AS timestamp, value FROM events"


def by_id(t):
    return t.events.select(F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("id"), F.col("ts").alias("timestamp"), "value")


@query("stream_state_last_write", f"SELECT id, timestamp, value FROM ({BY_ID}) QUALIFY row_number() OVER (PARTITION BY id ORDER BY timestamp DESC, value DESC) = 1")
def stream_state_last_write(t):
    """Last write wins as state, over a stop and a restart; the read takes one stored row per id."""
    path, checkpoint, rows = scratch_path(t.spark, "settled"), scratch_path(t.spark, "state"), by_id(t)
    streamed(t, before_and_after(rows, "timestamp"), lambda stream: state.keep_last_write(stream, path, checkpoint))
    return state.live_rows(t.spark, checkpoint, rows)


@query("stream_state_idle", f"""
WITH e AS ({BY_ID}), cut AS (SELECT TIMESTAMP '2024-01-20' AS c),
m AS (SELECT max(timestamp) FILTER (WHERE timestamp < c) - INTERVAL 1 DAY AS w1, max(timestamp) - INTERVAL 1 DAY AS w2 FROM e, cut),
one AS (SELECT e.* FROM e, cut WHERE timestamp < c QUALIFY row_number() OVER (PARTITION BY id ORDER BY timestamp DESC, value DESC) = 1),
gone AS (SELECT one.* FROM one, m WHERE timestamp + INTERVAL 2 DAY <= w1),
two AS (SELECT * FROM (SELECT * FROM one ANTI JOIN gone USING (id) UNION ALL SELECT e.* FROM e, cut WHERE timestamp >= c)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY timestamp DESC, value DESC) = 1)
SELECT 'settled' AS kept, * FROM gone
UNION ALL SELECT CASE WHEN timestamp + INTERVAL 2 DAY <= w2 THEN 'settled' ELSE 'live' END, two.* FROM two, m""")
def stream_state_idle(t):
    """Ids without a row for two days, as far as the watermark tells, are settled and leave the state; the others are live."""
    path, checkpoint, rows = scratch_path(t.spark, "settled"), scratch_path(t.spark, "state"), by_id(t)
    streamed(t, before_and_after(rows, "timestamp"), lambda stream: state.keep_last_write(
        stream, path, checkpoint, idle="2 DAYS", late="1 day"))
    live, settled = state.live_rows(t.spark, checkpoint, rows), state.settled_rows(t.spark, path, rows)
    return live.select(F.lit("live").alias("kept"), "*").unionAll(settled.select(F.lit("settled"), "*"))


def daily_events(name: str):
    """A plug-in over the table of events: a day's rows are looked up in the file by that day."""

    def table(options):
        import pyarrow.dataset as ds

        return ds.dataset(options["table"])

    def days(options):
        import pyarrow.compute as pc

        ends = pc.min_max(table(options).to_table(columns=["ts"])["ts"])
        return ends["min"].as_py().date(), ends["max"].as_py().date()

    def rows(day, options):
        import datetime as dt

        import pyarrow.compute as pc

        begin = dt.datetime.combine(day, dt.time())
        found = table(options).to_table(columns=["event_id", "value"], filter=(pc.field("ts") >= begin) & (pc.field("ts") < begin + dt.timedelta(days=1)))
        for event_id, value in zip(found["event_id"].to_pylist(), found["value"].to_pylist(), strict=True):
            yield day, event_id, value

    return plugin.dated_source(name, "date DATE, event_id BIGINT, value DOUBLE", days, rows)


@query("plugin_by_day", """
SELECT 'batch' AS way, CAST(ts AS DATE) AS date, CAST(event_id AS BIGINT) AS event_id, value FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-19'
UNION ALL SELECT 'stream', CAST(ts AS DATE), CAST(event_id AS BIGINT), value FROM events""")
def plugin_by_day(t):
    """A plug-in source read in tasks with a pushed date filter, and the same source as a stream."""
    plugin.register_dated_source(t.spark, daily_events("daily_events"))
    options = {"table": f"{t.folder}/events.parquet", "tasks": 4}
    some = t.spark.read.format("daily_events").options(**options).load().where("date >= DATE'2024-01-10' AND date < DATE'2024-01-20'")
    path = scratch_path(t.spark, "days")
    stream = t.spark.readStream.format("daily_events").options(**options).load()
    writer = stream.writeStream.option("checkpointLocation", scratch_path(t.spark, "state")).trigger(availableNow=True)
    writer.start(path, format="parquet").awaitTermination()
    landed = t.spark.read.schema(some.schema).parquet(path)
    return some.select(F.lit("batch").alias("way"), "*").unionAll(landed.select(F.lit("stream"), "*"))
