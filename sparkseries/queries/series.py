"""Scans, projections, cleaning, change detection, snapshots and history."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import numeric, text
from ..operators import clean, project, snapshot
from ..operators import reconcile as rec
from ..operators.numbering import number_rows
from .registry import Tables, query, sql_round

SERIES = "SELECT event_type AS series, CAST(ts AS DATE) AS date, value, ts AS created_at FROM events"
# Arrival lags the event by the number of hours in `props`, so rows come late and out of order.
LATE = (
    "SELECT event_type AS series, CAST(ts AS DATE) AS date, value, user_id, "
    "ts + CAST(regexp_extract(props, '[0-9]+') AS INTEGER) * INTERVAL 1 HOUR AS created_at FROM events"
)
RAW_NUMBER = (
    "CASE event_type WHEN 'error' THEN 'x' || value WHEN 'view' THEN ' ' || value || ' ' "
    "WHEN 'signup' THEN '' WHEN 'purchase' THEN NULL ELSE CAST(value AS VARCHAR) END"
)
RAW_DATE = (
    "CASE event_type WHEN 'click' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 'view' THEN strftime(ts, '%d/%m/%Y') "
    "WHEN 'error' THEN 'not a date' WHEN 'signup' THEN '' ELSE NULL END"
)
DATE_FORMATS = ["yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy"]


def series_frame(t: Tables):
    return t.events.select(
        F.col("event_type").alias("series"), F.to_date("ts").alias("date"), "value", F.col("ts").alias("created_at")
    )


def late_frame(t: Tables):
    hours = F.regexp_extract("props", "[0-9]+", 0).cast("int")
    return t.events.select(
        F.col("event_type").alias("series"), F.to_date("ts").alias("date"), "value", "user_id",
        (F.col("ts") + F.make_dt_interval(hours=hours)).alias("created_at"),
    )


def raw_number():
    value, kind = F.col("value").cast("string"), F.col("event_type")
    return (
        F.when(kind == "error", F.concat(F.lit("x"), value))
        .when(kind == "view", F.concat(F.lit(" "), value, F.lit(" ")))
        .when(kind == "signup", "")
        .when(kind == "purchase", F.lit(None))
        .otherwise(value)
    )


def raw_date():
    kind = F.col("event_type")
    return (
        F.when(kind == "click", F.date_format("ts", DATE_FORMATS[0]))
        .when(kind == "view", F.date_format("ts", DATE_FORMATS[1]))
        .when(kind == "error", "not a date")
        .when(kind == "signup", "")
    )


@query("series_scan", "SELECT CAST(ts AS DATE) AS date, round(value, 2) AS value FROM events "
       "WHERE CAST(ts AS DATE) < DATE '2024-01-25'")
def series_scan(t):
    quotes = t.events.select(F.to_date("ts").alias("Date"), F.col("value").alias("Adj Close"))
    return project.adjusted_close(quotes, "2024-01-25")


@query("clean_number", f"SELECT event_id, TRY_CAST(trim({RAW_NUMBER}) AS DOUBLE) AS value FROM events")
def clean_number(t):
    return clean.clean_column(t.events.select("event_id", raw_number().alias("value")), "value", "number")


@query("clean_string", f"SELECT event_id, nullif({RAW_NUMBER}, '') AS value FROM events")
def clean_string(t):
    return clean.clean_column(t.events.select("event_id", raw_number().alias("value")), "value", "string")


@query("clean_boolean", f"SELECT event_id, coalesce({RAW_NUMBER} <> '', false) AS value FROM events")
def clean_boolean(t):
    return clean.clean_column(t.events.select("event_id", raw_number().alias("value")), "value", "boolean")


@query("clean_datetime", f"SELECT event_id, coalesce(try_strptime({RAW_DATE}, '%Y-%m-%d %H:%M:%S'), "
       f"try_strptime({RAW_DATE}, '%d/%m/%Y')) AS date FROM events")
def clean_datetime(t):
    return clean.clean_column(
        t.events.select("event_id", raw_date().alias("date")), "date", "datetime", formats=DATE_FORMATS
    )


@query("clean_integer", "SELECT event_id, CASE WHEN event_type = 'signup' THEN NULL ELSE user_id END AS value FROM events")
def clean_integer(t):
    raw = F.when(F.col("event_type") == "signup", "").otherwise(F.concat(F.col("user_id").cast("string"), F.lit(".0")))
    return clean.clean_column(t.events.select("event_id", raw.alias("value")), "value", "integer")


@query("clean_float", f"SELECT event_id, CAST(TRY_CAST(trim({RAW_NUMBER}) AS DOUBLE) AS FLOAT) AS value FROM events")
def clean_float(t):
    return clean.clean_column(t.events.select("event_id", raw_number().alias("value")), "value", "float")


@query("clean_category", "SELECT p_partkey, p_name, CAST(dense_rank() OVER (ORDER BY p_name) - 1 AS BIGINT) AS code FROM part")
def clean_category(t):
    cleaned = clean.clean_column(t.part.select("p_partkey", "p_name"), "p_name", "category")
    return clean.category_codes(cleaned, "p_name").select("p_partkey", "p_name", "code")


@query("clean_date_value", f"""
WITH raw AS (SELECT {RAW_DATE} AS d, CASE WHEN user_id >= 100 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS v,
                    event_id FROM events)
SELECT coalesce(try_strptime(d, '%Y-%m-%d %H:%M:%S'), try_strptime(d, '%d/%m/%Y')) AS date,
       TRY_CAST(v AS DOUBLE) AS value, event_id FROM raw
WHERE coalesce(try_strptime(d, '%Y-%m-%d %H:%M:%S'), try_strptime(d, '%d/%m/%Y')) IS NOT NULL
  AND TRY_CAST(v AS DOUBLE) > 5""")
def clean_date_value(t):
    spoiled = F.when(F.col("user_id") >= 100, "n/a").otherwise(F.col("value").cast("string"))
    raw = t.events.select(raw_date().alias("date"), spoiled.alias("value"), "event_id")
    return clean.clean_date_value(raw, restriction=lambda v: v > 5, formats=DATE_FORMATS)


@query("row_predicate", "SELECT event_id, value FROM events WHERE value > 10 AND sqrt(value - 10) < 5")
def row_predicate(t):
    """A predicate over plain values: it raises for some of them, which counts as false."""

    def predicate(value: float) -> bool:
        return 0 < math.sqrt(value - 10) < 5

    return project.keep_where(t.events.select("event_id", "value"), "value", predicate)


@query("cutoff_yesterday", "SELECT o_orderkey, o_orderdate AS date FROM orders WHERE o_orderdate < TIMESTAMP '1998-06-15'")
def cutoff_yesterday(t):
    return project.cut_after_yesterday(t.orders.select("o_orderkey", F.col("o_orderdate").alias("date")), "1998-06-15")


@query("date_range", "SELECT o_orderkey, o_orderdate AS date FROM orders WHERE o_orderpriority = '2-HIGH' "
       "AND o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-12-31'")
def date_range(t):
    high = t.orders.where(F.col("o_orderpriority") == "2-HIGH").select("o_orderkey", F.col("o_orderdate").alias("date"))
    return project.between_millis(high, 820454400000, 883526400000)


@query("allow_list", "SELECT p_partkey, p_type FROM part WHERE p_type IN ('ECONOMY', 'SMALL')")
def allow_list(t):
    return project.keep_listed(t.part.select("p_partkey", "p_type"), "p_type", ["ECONOMY", "SMALL"])


@query("exclude_prefix", "SELECT p_partkey, p_name FROM part WHERE NOT (p_name LIKE 'small%' OR p_name LIKE 'red%')")
def exclude_prefix(t):
    return project.exclude_prefixes(t.part.select("p_partkey", "p_name"), "p_name", ["small", "red"])


@query("positional_rename", "SELECT o_orderdate AS date, o_totalprice AS value, o_orderkey FROM orders")
def positional_rename(t):
    return project.rename_by_position(t.orders.select("o_orderdate", "o_totalprice", "o_orderkey"))


FILE_NAME = ("replace(p_name, ' ', CASE WHEN p_size < 40 THEN '_' ELSE ' ' END) || "
             "CASE WHEN p_size < 17 THEN '.csv' WHEN p_size < 34 THEN '.json' ELSE '' END")


@query("file_type", f"""
SELECT p_partkey, {FILE_NAME} AS name, regexp_matches({FILE_NAME}, '^[A-Za-z][A-Za-z0-9_.]*$') AS valid,
       CASE WHEN {FILE_NAME} LIKE '%.csv' THEN 'csv' WHEN {FILE_NAME} LIKE '%.json' THEN 'json' ELSE 'unknown' END AS type
FROM part""")
def file_type(t):
    size = F.col("p_size")
    gap = F.when(size < 40, "_").otherwise(" ")
    suffix = F.when(size < 17, ".csv").when(size < 34, ".json").otherwise("")
    named = t.part.select("p_partkey", F.concat(F.replace("p_name", F.lit(" "), gap), suffix).alias("name"))
    return named.select(
        "p_partkey", "name", text.valid_file_name(F.col("name")).alias("valid"), text.file_type(F.col("name")).alias("type")
    )


BASE = """SELECT event_type AS series, CAST(ts AS DATE) AS date, user_id,
  CASE WHEN event_type = 'signup' AND value > 20 THEN NULL ELSE value END AS value, ts AS created_at
  FROM events WHERE ts < TIMESTAMP '2024-01-20'"""
INCOMING = """SELECT event_type AS series, CAST(ts AS DATE) AS date, user_id,
  CASE WHEN event_type = 'signup' AND value > 20 THEN NULL WHEN event_type = 'error' THEN value + 0.5
       WHEN event_type = 'purchase' THEN value + 1e-9 ELSE value END AS value, ts AS created_at FROM events"""
ROUNDED = f"""base AS (SELECT series, date, user_id, {sql_round('value')} AS value FROM ({BASE})),
incoming AS (SELECT series, date, user_id, {sql_round('value')} AS value, created_at FROM ({INCOMING})),
fresh AS (SELECT series, date, user_id, value, min(created_at) AS created_at FROM incoming i
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.series = i.series AND b.date = i.date AND b.user_id = i.user_id
                    AND b.value IS NOT DISTINCT FROM i.value) GROUP BY ALL)"""


def base_and_incoming(t: Tables):
    """A target that holds what arrived before a day, and a full download with corrections and rounding noise."""
    kind = F.col("event_type")
    gap = (kind == "signup") & (F.col("value") > 20)
    corrected = (
        F.when(gap, F.lit(None)).when(kind == "error", F.col("value") + 0.5)
        .when(kind == "purchase", F.col("value") + 1e-9).otherwise(F.col("value"))
    )

    def shape(df, value):
        return df.select(
            kind.alias("series"), F.to_date("ts").alias("date"), "user_id", value.alias("value"), F.col("ts").alias("created_at")
        )

    known = t.events.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    return shape(known, F.when(~gap, F.col("value"))), shape(t.events, corrected)


@query("reconcile_new_rows", f"WITH {ROUNDED} SELECT * FROM fresh")
def reconcile_new_rows(t):
    base, incoming = base_and_incoming(t)
    return rec.reconcile(base, incoming)


@query("reconcile_idempotent", f"""WITH {ROUNDED}, merged AS (SELECT * FROM base UNION ALL
  SELECT series, date, user_id, value FROM fresh)
SELECT (SELECT count(*) FROM fresh) AS appended, (SELECT count(*) FROM incoming i WHERE NOT EXISTS (
  SELECT 1 FROM merged b WHERE b.series = i.series AND b.date = i.date AND b.user_id = i.user_id
  AND b.value IS NOT DISTINCT FROM i.value)) AS appended_again""")
def reconcile_idempotent(t):
    base, incoming = base_and_incoming(t)
    fresh = rec.reconcile(base, incoming)
    again = rec.reconcile(base.unionByName(fresh), incoming)
    return again.agg(F.count(F.lit(1)).alias("appended_again")).select(
        fresh.agg(F.count(F.lit(1))).scalar().alias("appended"), "appended_again"
    )


@query("except_ignoring_arrival", """
SELECT DISTINCT o_custkey AS series, o_orderdate AS date, o_orderstatus AS value, o_orderdate AS created_at FROM orders a
WHERE o_orderpriority <> '1-URGENT' AND NOT EXISTS (SELECT 1 FROM orders b WHERE b.o_orderpriority = '1-URGENT'
  AND a.o_custkey = b.o_custkey AND a.o_orderdate = b.o_orderdate AND a.o_orderstatus = b.o_orderstatus)""")
def except_ignoring_arrival(t):
    def shape(df):
        return df.select(
            F.col("o_custkey").alias("series"), F.col("o_orderdate").alias("date"),
            F.col("o_orderstatus").alias("value"), F.col("o_orderdate").alias("created_at"),
        )

    urgent = F.col("o_orderpriority") == "1-URGENT"
    return rec.reconcile(shape(t.orders.where(urgent)), shape(t.orders.where(~urgent)))


@query("custom_reconcile", """
SELECT event_type AS series, CAST(ts AS DATE) AS date, value, ts AS created_at FROM events e
WHERE NOT EXISTS (SELECT 1 FROM events b WHERE b.ts < TIMESTAMP '2024-01-20' AND b.event_type = e.event_type
                  AND CAST(b.ts AS DATE) = CAST(e.ts AS DATE))""")
def custom_reconcile(t):
    """A user's own change rule: whole days that the target does not have yet."""

    def new_days(base, incoming):
        return rec.delete_by_key(incoming, base, ["series", "date"]).select(*base.columns)

    frame = series_frame(t)
    return new_days(frame.where(F.col("created_at") < F.lit("2024-01-20").cast("timestamp_ntz")), frame)


@query("series_add", """
WITH totals AS (SELECT event_type, CAST(ts AS DATE) AS date, user_id,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS value FROM events GROUP BY ALL)
SELECT coalesce(a.date, b.date) AS date, coalesce(a.user_id, b.user_id) AS user_id, a.value + b.value AS value
FROM (SELECT * FROM totals WHERE event_type = 'click') a
FULL JOIN (SELECT * FROM totals WHERE event_type = 'purchase') b ON a.date = b.date AND a.user_id = b.user_id""")
def series_add(t):
    totals = t.events.groupBy("event_type", F.to_date("ts").alias("date"), "user_id").agg(
        numeric.exact_sum(F.col("value"), 2).alias("value")
    )
    return rec.add_series(
        totals.where("event_type = 'click'"), totals.where("event_type = 'purchase'"), ["date", "user_id"]
    )


@query("delete_by_key", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN "
       "(SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def delete_by_key(t):
    doomed = t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return rec.delete_by_key(t.orders.select("o_orderkey", "o_totalprice"), doomed, ["o_orderkey"])


@query("insert_unique", "SELECT o_custkey AS id, min('W' || o_orderkey) AS wallet FROM orders WHERE o_custkey NOT IN "
       "(SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY o_custkey")
def insert_unique(t):
    existing = t.customer.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("id"))
    new = t.orders.select(
        F.col("o_custkey").alias("id"), F.concat(F.lit("W"), F.col("o_orderkey").cast("string")).alias("wallet")
    )
    return rec.insert_unique(existing, new, ["id"])


MAPS = """WITH a AS (SELECT o_custkey AS k, count(*) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
b AS (SELECT c_custkey AS k, count(o_orderkey) AS v FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1),
d AS (SELECT coalesce(a.k, b.k) AS k, a.v AS left_value, b.v AS right_value FROM a FULL JOIN b ON a.k = b.k
      WHERE a.v IS DISTINCT FROM b.v)"""


def two_maps(t: Tables):
    ordered = t.orders.where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("v"))
    every = t.customer.join(t.orders, F.col("c_custkey") == F.col("o_custkey"), "left").groupBy(
        F.col("c_custkey").alias("k")
    ).agg(F.count("o_orderkey").alias("v"))
    return ordered, every


@query("maps_equal", f"{MAPS} SELECT count(*) AS differences, count(*) = 0 AS equal FROM d")
def maps_equal(t):
    return rec.maps_equal(*two_maps(t), "k", "v")


@query("map_differences", f"{MAPS} SELECT k, left_value, right_value FROM d")
def map_differences(t):
    return rec.map_differences(*two_maps(t), "k", "v")


@query("union_tagged", """
SELECT 'orders' AS "table", CAST(o_orderdate AS DATE) AS date, o_totalprice AS value, CAST(NULL AS VARCHAR) AS flag FROM orders
UNION ALL SELECT 'lineitem', CAST(l_shipdate AS DATE), l_extendedprice, l_returnflag FROM lineitem""")
def union_tagged(t):
    frames = {
        "orders": t.orders.select(F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("value")),
        "lineitem": t.lineitem.select(
            F.to_date("l_shipdate").alias("date"), F.col("l_extendedprice").alias("value"), F.col("l_returnflag").alias("flag")
        ),
    }
    return project.sort_rows(rec.union_tagged(frames), "table", "date", scanned=True)


@query("overlay_frames", """SELECT 'a' AS name, count(*) AS n FROM lineitem UNION ALL SELECT 'b', count(*) FROM orders""")
def overlay_frames(t):
    frames = rec.overlay({"a": t.orders, "b": t.orders}, {"a": t.lineitem})
    counts = {name: frame.agg(F.count(F.lit(1)).alias("n")) for name, frame in frames.items()}
    return rec.union_tagged(counts, "name").select("name", "n")


@query("sort_numeric_text", "SELECT CAST(o_orderkey AS VARCHAR) AS round, o_totalprice AS value FROM orders")
def sort_numeric_text(t):
    rounds = t.orders.select(F.col("o_orderkey").cast("string").alias("round"), F.col("o_totalprice").alias("value"))
    return project.sort_numeric_text(rounds, "round", scanned=True)


@query("frozen_snapshot", f"""
SELECT series, user_id, date, value, created_at FROM ({LATE}) WHERE (date <= DATE '2024-01-15' AND created_at <= TIMESTAMP '2024-01-15 12:00:00')
   OR (date > DATE '2024-01-15' AND created_at <= date + INTERVAL 1 DAY - INTERVAL 1 SECOND)
QUALIFY row_number() OVER (PARTITION BY series, user_id, date ORDER BY created_at DESC, value DESC) = 1""")
def frozen_snapshot(t):
    frozen = snapshot.frozen_snapshot(late_frame(t), "2024-01-15 12:00:00", ["series", "user_id", "date"])
    return frozen.select("series", "user_id", "date", "value", "created_at")


@query("latest_version", f"""SELECT series, date, value, user_id, created_at FROM ({LATE})
QUALIFY row_number() OVER (PARTITION BY series, date ORDER BY created_at DESC, value DESC, user_id DESC) = 1""")
def latest_version(t):
    return snapshot.latest_version(late_frame(t))


@query("keep_first", f"SELECT series, date, user_id, min(created_at) AS created_at FROM ({LATE}) GROUP BY ALL")
def keep_first(t):
    return rec.keep_first(late_frame(t).select("series", "date", "user_id", "created_at"))


@query("last_write_wins", """
WITH rows_ AS (SELECT user_id AS id, CASE WHEN event_type = 'signup' THEN NULL ELSE date_trunc('day', ts) END AS timestamp,
                      value, ts >= TIMESTAMP '2024-01-15' AS is_new FROM events)
SELECT id, timestamp, value FROM rows_ QUALIFY row_number() OVER (PARTITION BY id ORDER BY timestamp DESC NULLS LAST,
  CASE WHEN timestamp IS NULL THEN -CAST(is_new AS INTEGER) ELSE CAST(is_new AS INTEGER) END, value DESC NULLS LAST) = 1""")
def last_write_wins(t):
    rows = t.events.select(
        F.col("user_id").alias("id"),
        F.when(F.col("event_type") != "signup", F.to_date("ts").cast("timestamp_ntz")).alias("timestamp"), "value", "ts",
    )
    cut = F.lit("2024-01-15").cast("timestamp_ntz")
    return snapshot.last_write_wins(rows.where(F.col("ts") < cut).drop("ts"), rows.where(F.col("ts") >= cut).drop("ts"))


@query("history_topk", """
SELECT ts AS date, value FROM (SELECT ts, value FROM events WHERE event_type = 'click'
  AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' ORDER BY ts DESC, value DESC LIMIT 5)""")
def history_topk(t):
    index = t.events.select(F.col("event_type").alias("category"), F.col("ts").alias("date"), "value")
    return snapshot.history(index, "click:value", 1704412800000, 1705708800000, 5)


PER_USER = "SELECT event_type || '_' || user_id AS series, ts AS date, value FROM events"


def per_user(t: Tables):
    return t.events.select(
        F.concat_ws("_", "event_type", F.col("user_id").cast("string")).alias("series"), F.col("ts").alias("date"), "value"
    )


@query("history_all_series", f"""SELECT series, date, value FROM ({PER_USER})
QUALIFY row_number() OVER (PARTITION BY series ORDER BY date DESC, value DESC) <= 5""")
def history_all_series(t):
    return snapshot.history_all(per_user(t))


@query("history_arrays", f"""
WITH newest AS (SELECT series, date, value FROM ({PER_USER})
  QUALIFY row_number() OVER (PARTITION BY series ORDER BY date DESC, value DESC) <= 5)
SELECT series, 'ok' AS s, string_agg(CAST(epoch_us(date) // 1000 AS VARCHAR), ',' ORDER BY epoch_us(date) // 1000, value) AS t,
       string_agg(CAST(value AS VARCHAR), ',' ORDER BY epoch_us(date) // 1000, value) AS c FROM newest GROUP BY series""")
def history_arrays(t):
    def joined(name):
        return F.array_join(F.transform(name, lambda x: x.cast("string")), ",").alias(name)

    return snapshot.history_arrays(per_user(t)).select("series", "s", joined("t"), joined("c"))


@query("report_pages", """
SELECT c_name, CAST(floor(n / 10) AS BIGINT) AS page, n % 10 AS line_number, '| ' || rpad(c_name, 25, ' ') || ' | ' ||
  rpad(c_mktsegment, CAST(greatest(length(c_mktsegment), 8) AS INTEGER), ' ') || ' |' AS line
FROM (SELECT *, row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1 AS n FROM customer)""")
def report_pages(t):
    numbered = number_rows(t.customer.select("c_acctbal", "c_custkey", "c_name", "c_mktsegment"), ["c_acctbal", "c_custkey"])
    return numbered.select(
        "c_name", F.floor(F.col("number") / 10).alias("page"), (F.col("number") % 10).alias("line_number"),
        text.report_line((F.col("c_name"), 25), (F.col("c_mktsegment"), 8)).alias("line"),
    )


@query("clamp_arrival", f"""SELECT series, date, value, user_id, least(created_at, TIMESTAMP '2024-01-20 00:00:00') AS created_at
FROM ({LATE})""")
def clamp_arrival(t):
    return project.stamp_created(late_frame(t), "2024-01-20 00:00:00")


@query("target_columns", "SELECT event_type AS series, ts AS date, value, TIMESTAMP '2024-02-01' AS created_at FROM events")
def target_columns(t):
    """Incoming rows stamped, stripped of helper columns and put in the target's column order."""
    incoming = t.events.select("value", F.col("event_id").alias("id"), F.col("ts").alias("date"), F.col("event_type").alias("series"))
    stamped = project.stamp_created(project.drop_helpers(incoming), "2024-02-01")
    return project.like_target(project.date_first(stamped), ["series", "date", "value", "created_at"])
