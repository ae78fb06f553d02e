"""Scalar functions, one query each."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numeric, payload, text, times
from ..operators.constraints import writer_gate
from .registry import query, sql_round


@query("round_value", f"SELECT event_id, {sql_round('x')} AS rounded FROM "
       "(SELECT event_id, value * CASE event_type WHEN 'click' THEN 1.2345678e-7 WHEN 'view' THEN -1.2345678e-10 "
       "WHEN 'error' THEN CAST(0.12345678912 AS DOUBLE) ELSE 0 END AS x FROM events)")
def round_value(t):
    """Magnitudes of every level. The factors keep values off exact halves, where engines may round either way."""
    kind = F.col("event_type")
    factor = (
        F.when(kind == "click", 1.2345678e-7).when(kind == "view", -1.2345678e-10)
        .when(kind == "error", 0.12345678912).otherwise(0.0)
    )
    return t.events.select("event_id", numeric.round_value(F.col("value") * factor).alias("rounded"))


@query("fixed_point", "SELECT o_orderkey, CAST(round(o_totalprice * 1000000) AS BIGINT) AS units, "
       "round(CAST(round(o_totalprice * 1000000) AS BIGINT) / 1000000, 6) AS decoded FROM orders")
def fixed_point(t):
    units = numeric.fixed_point_encode(F.col("o_totalprice"))
    return t.orders.select("o_orderkey", units.alias("units"), numeric.fixed_point_decode(units).alias("decoded"))


@query("wei_scale", "SELECT o_orderkey, CAST(CAST(trunc(o_totalprice * 1e18) AS HUGEINT) AS VARCHAR) AS wei FROM orders")
def wei_scale(t):
    return t.orders.select("o_orderkey", numeric.wei_scale(F.col("o_totalprice")).cast("string").alias("wei"))


@query("wei_scale_nested", """
SELECT o_orderkey, CAST(CAST(trunc(o_totalprice * 1e18) AS HUGEINT) AS VARCHAR) AS first,
  CAST(CAST(trunc(o_totalprice / 4 * 1e18) AS HUGEINT) AS VARCHAR) AS second FROM orders""")
def wei_scale_nested(t):
    price = F.col("o_totalprice")
    scaled = t.orders.select(
        "o_orderkey",
        numeric.wei_scale_array(F.array(price)).alias("c"),
        numeric.wei_scale_map(F.create_map(F.lit("x"), price / 4)).alias("m"),
    )
    return scaled.select(
        "o_orderkey", F.col("c")[0].cast("string").alias("first"), F.col("m")["x"].cast("string").alias("second")
    )


@query("hash32", "SELECT c_custkey, CAST('0x' || substr(sha256(c_name), 1, 8) AS BIGINT) AS h FROM customer")
def hash32(t):
    return t.customer.select("c_custkey", numeric.hash32(F.col("c_name")).alias("h"))


@query("stream_id", "SELECT c_custkey, 'kw' || substr(sha256(c_name), 1, 30) AS id FROM customer")
def stream_id(t):
    return t.customer.select("c_custkey", numeric.stream_id(F.col("c_name")).alias("id"))


@query("key_uuid", """
SELECT c_custkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-'
  || substr(h, 21, 12) AS id FROM (SELECT c_custkey, sha256(c_custkey || chr(31) || c_name) AS h FROM customer)""")
def key_uuid(t):
    return t.customer.select("c_custkey", numeric.key_uuid(F.col("c_custkey"), F.col("c_name")).alias("id"))


@query("row_uuid", "SELECT count(*) AS rows, count(*) AS shaped, count(*) AS different FROM customer")
def row_uuid(t):
    """Random ids: all of the right shape, no two alike."""
    ids = t.customer.select("c_custkey", F.uuid().alias("id"))
    shape = F.col("id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
    return ids.agg(F.count(F.lit(1)).alias("rows"), F.count_if(shape).alias("shaped"), F.count_distinct("id").alias("different"))


@query("epoch_nanos", "SELECT event_id, epoch_us(ts) * 1000 AS nanos, ts AS back FROM events")
def epoch_nanos(t):
    nanos = times.to_epoch_nanos(F.col("ts"))
    return t.events.select("event_id", nanos.alias("nanos"), times.from_epoch_nanos(nanos).alias("back"))


@query("epoch_millis", "SELECT event_id, epoch_us(ts) // 1000 AS millis, make_timestamp((epoch_us(ts) // 1000) * 1000) AS back FROM events")
def epoch_millis(t):
    millis = times.to_epoch_millis(F.col("ts"))
    return t.events.select("event_id", millis.alias("millis"), times.from_epoch_millis(millis).alias("back"))


@query("end_of_day", "SELECT event_id, date_trunc('day', ts) + INTERVAL 1 DAY - INTERVAL 1 SECOND AS eod FROM events")
def end_of_day(t):
    return t.events.select("event_id", times.end_of_day(F.to_date("ts")).alias("eod"))


@query("clamp_future", "SELECT event_id, least(ts, TIMESTAMP '2024-01-20 10:00:00') AS created_at FROM events")
def clamp_future(t):
    return t.events.select("event_id", times.clamp_future(F.col("ts"), "2024-01-20 10:00:00").alias("created_at"))


@query("name_split", """
SELECT c_custkey, split_part(n, '_', 1) || '_' || split_part(n, '_', 2) AS category, array_to_string(string_split(n, '_')[3:], '_') AS name
FROM (SELECT c_custkey, lower(c_mktsegment) || '_index_' || replace(c_name, '#', '_') AS n FROM customer)""")
def name_split(t):
    name = F.concat(F.lower("c_mktsegment"), F.lit("_index_"), F.replace("c_name", F.lit("#"), F.lit("_")))
    return t.customer.select("c_custkey", text.category_of(name).alias("category"), text.name_of(name).alias("name"))


@query("date_text", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS d, strftime(ts, '%Y-%m-%d %H:%M:%S') AS s FROM events")
def date_text(t):
    return t.events.select("event_id", times.date_text(F.col("ts")).alias("d"), times.datetime_text(F.col("ts")).alias("s"))


@query("duration_text", """
SELECT o_orderkey, concat_ws(', ', CASE WHEN s >= 86400 THEN (s // 86400) || ' days' END,
  CASE WHEN s % 86400 >= 3600 THEN (s % 86400 // 3600) || ' hours' END,
  CASE WHEN s % 3600 >= 60 THEN (s % 3600 // 60) || ' minutes' END,
  CASE WHEN s % 60 + f > 0 THEN regexp_replace(printf('%.2f', s % 60 + f / 100.0), '\\.?0+$', '') || ' seconds' END) AS text
FROM (SELECT o_orderkey, cents // 100 AS s, cents % 100 AS f FROM
  (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders))""")
def duration_text(t):
    return t.orders.select("o_orderkey", times.duration_text(F.col("o_totalprice")).alias("text"))


@query("partial_date", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN CAST(date_trunc('year', o_orderdate) AS DATE)
  WHEN 'O' THEN CAST(date_trunc('month', o_orderdate) AS DATE) ELSE CAST(o_orderdate AS DATE) END AS date FROM orders""")
def partial_date(t):
    status = F.col("o_orderstatus")
    shape = F.when(status == "F", F.date_format("o_orderdate", "yyyy")).when(
        status == "O", F.date_format("o_orderdate", "yyyy-MM")
    ).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t.orders.select("o_orderkey", times.partial_date(shape).alias("date"))


@query("price_text", "SELECT o_orderkey, o_totalprice AS price, CAST(NULL AS DOUBLE) AS none FROM orders")
def price_text(t):
    written = F.concat(F.lit("$"), F.col("o_totalprice").cast("string"), F.lit(" per day"))
    return t.orders.select(
        "o_orderkey", numeric.price_number(written).alias("price"), numeric.price_number(F.lit("n/a")).alias("none")
    )


@query("decimal_comma", "SELECT o_orderkey, o_totalprice AS price FROM orders")
def decimal_comma(t):
    written = F.replace(F.col("o_totalprice").cast("string"), F.lit("."), F.lit(","))
    return t.orders.select("o_orderkey", numeric.decimal_comma(written).alias("price"))


@query("round_slot", "SELECT o_orderkey, o_orderkey % 10 AS slot, o_custkey % 10 AS slot_of_text FROM orders")
def round_slot(t):
    return t.orders.select(
        "o_orderkey",
        numeric.round_slot(F.col("o_orderkey")).alias("slot"),
        numeric.round_slot(F.concat(F.lit("-"), F.col("o_custkey").cast("string"), F.lit(".5"))).alias("slot_of_text"),
    )


@query("nul_text", "SELECT event_id, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events")
def nul_text(t):
    """Account bytes: JSON in a JSON string, ended by a NUL and followed by left-over bytes."""
    quoted = F.concat(F.lit('"'), F.replace("props", F.lit('"'), F.lit('\\"')), F.lit('"'))
    data = F.encode(F.concat(quoted, F.lit("\x00left over")), "UTF-8")
    parsed = payload.twice_encoded(text.text_before_nul(data), "k BIGINT")
    return t.events.select("event_id", parsed["k"].alias("k"))


@query("composite_split", "SELECT o_orderkey, o_orderpriority AS category, 'c' || o_custkey AS col, o_orderstatus AS owner, 'db' AS db FROM orders")
def composite_split(t):
    symbol = F.concat_ws(":", "o_orderpriority", F.concat(F.lit("c"), F.col("o_custkey").cast("string")))
    parts = text.composite_split(symbol)
    owned = text.owner_and_db(F.concat("o_orderstatus", F.lit("@db")))
    return t.orders.select(
        "o_orderkey", parts[0].alias("category"), parts[1].alias("col"), owned["owner"].alias("owner"), owned["db"].alias("db")
    )


@query("calendar_flags", """
SELECT o_orderkey, CAST(CASE isodow(d - 2) WHEN 6 THEN d - 3 WHEN 7 THEN d - 4 ELSE d - 2 END AS DATE) AS last_weekday,
  isoyear(d) = isoyear(r) AND week(d) = week(r) AS same_week, year(d) = year(r) AND month(d) = month(r) AS same_month,
  year(d) = year(r) AND quarter(d) = quarter(r) AS same_quarter,
  year(d) = year(r) AND (month(d) <= 6) = (month(r) <= 6) AS same_half,
  (year(d) = year(r) AND abs(month(d) - month(r)) = 1) OR (abs(year(d) - year(r)) = 1 AND month(d) = 12 AND month(r) = 1) AS near_month,
  CAST(isodow(d) - 1 AS INTEGER) AS weekday
FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, CAST(o_orderdate AS DATE) + CAST(o_custkey % 120 AS INTEGER) AS r FROM orders)""")
def calendar_flags(t):
    d = F.to_date("o_orderdate")
    r = F.date_add(d, (F.col("o_custkey") % 120).cast("int"))
    return t.orders.select(
        "o_orderkey",
        times.last_weekday(d).alias("last_weekday"),
        times.same_iso_week(d, r).alias("same_week"),
        times.same_month(d, r).alias("same_month"),
        times.same_quarter(d, r).alias("same_quarter"),
        times.same_half_year(d, r).alias("same_half"),
        times.within_one_month(d, r).alias("near_month"),
        times.weekday_index(F.date_format(d, "EEEE")).alias("weekday"),
    )


@query("key_value_lines", "SELECT c_custkey, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation, c_mktsegment AS segment FROM customer")
def key_value_lines(t):
    lines = F.concat(
        F.lit("Name: "), F.col("c_name"), F.lit("\r\nno pair here\nNation:   "), F.col("c_nationkey").cast("string"),
        F.lit("\nMarket segment: first\nMarket segment: "), F.col("c_mktsegment"),
    )
    pairs = text.key_value_lines(lines)
    return t.customer.select(
        "c_custkey", pairs["Name"].alias("name"), pairs["Nation"].alias("nation"), pairs["Market segment"].alias("segment")
    )


@query("human_time", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events")
def human_time(t):
    return t.events.select("event_id", times.human_time(times.to_epoch_millis(F.col("ts"))).alias("at"))


@query("next_boundary", "SELECT event_id, time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE AS at FROM events")
def next_boundary(t):
    return t.events.select("event_id", times.next_boundary(F.col("ts")).alias("at"))


@query("record_id", "SELECT event_id, 'scrape:' || dayofmonth(ts) || ':' || (epoch_us(ts) // 1000) AS id FROM events")
def record_id(t):
    return t.events.select(
        "event_id", text.record_id("scrape", F.dayofmonth("ts"), times.to_epoch_millis(F.col("ts"))).alias("id")
    )


@query("report_line", "SELECT c_custkey, '| ' || rpad(c_name, 20, ' ') || ' | ' || "
       "rpad(c_mktsegment, CAST(greatest(length(c_mktsegment), 6) AS INTEGER), ' ') || ' |' AS line FROM customer")
def report_line(t):
    return t.customer.select("c_custkey", text.report_line((F.col("c_name"), 20), (F.col("c_mktsegment"), 6)).alias("line"))


@query("json_path", "SELECT event_id, CAST(date_trunc('month', ts) AS DATE) AS date, value FROM events")
def json_path(t):
    body = F.format_string(
        '{"CompactData":{"DataSet":{"Series":{"@FREQ":"M","Obs":[{"@TIME_PERIOD":"%s","@OBS_VALUE":"%s"}]}}}}',
        F.date_format("ts", "yyyy-MM"), F.col("value").cast("string"),
    )
    return payload.unnest(t.events, ["event_id"], payload.observation_points(body))


@query("json_points", "SELECT event_id, make_timestamp((epoch_us(ts) // 1000) * 1000) AS ts, value FROM events")
def json_points(t):
    body = F.format_string(
        '{"data":[[%d,1.0,2.0,0.5,%s,9]]}', times.to_epoch_millis(F.col("ts")), F.col("value").cast("string")
    )
    return payload.unnest(t.events, ["event_id"], payload.chart_points(body))


@query("json_rows", "SELECT event_id, CAST(date_trunc('year', ts) AS DATE) AS date, "
       "CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value FROM events")
def json_rows(t):
    shown = F.when(F.col("event_type") == "error", "null").otherwise(F.col("value").cast("string"))
    body = F.format_string('[{"page":1},[{"date":"%s","value":%s}]]', F.date_format("ts", "yyyy"), shown)
    return payload.unnest(t.events, ["event_id"], payload.indicator_points(body))


@query("json_records", "SELECT event_id, event_type AS kind, value FROM events")
def json_records(t):
    """Records given as a list of objects for some rows and as an object of lists for the others."""
    value, kind = F.col("value").cast("string"), F.col("event_type")
    listed = F.format_string('[{"kind":"%s","value":%s}]', kind, value)
    columnar = F.format_string('{"kind":["%s"],"value":[%s]}', kind, value)
    rows = F.when(F.col("user_id") < 75, payload.records(listed, "kind: STRING, value: DOUBLE")).otherwise(
        payload.columns_to_records(columnar, {"kind": "STRING", "value": "DOUBLE"})
    )
    return payload.unnest(t.events, ["event_id"], rows)


@query("nested_rounds", "SELECT event_id, strftime(ts, '%d') AS round, 'u' || user_id AS city, event_type AS category, value AS price FROM events")
def nested_rounds(t):
    body = F.format_string(
        '{"%s":{"u%d":{"%s":%s}},"x":{"u0":{"other":1.0}}}',
        F.date_format("ts", "dd"), F.col("user_id"), F.col("event_type"), F.col("value").cast("string"),
    )
    return payload.explode_rounds(t.events.select("event_id", body.alias("payload")), "payload")


@query("html_rows", """
SELECT page_id, regexp_extract(row_, 'href="([^"]*)"', 1) AS href, trim(regexp_extract(row_, '>([^<>]*)</a>', 1)) AS label
FROM (SELECT page_id, unnest(regexp_extract_all(html, '<li><a href="[^"]*">[^<>]*</a>')) AS row_ FROM pages)""")
def html_rows(t):
    rows = payload.table_rows(
        F.col("html"), r'<li><a href="[^"]*">[^<>]*</a>', {"href": r'href="([^"]*)"', "label": r">([^<>]*)</a>"}
    )
    return payload.unnest(t.pages, ["page_id"], rows)


@query("writer_gate", """SELECT o_orderkey, o_custkey AS writer FROM orders WHERE o_custkey NOT IN
  (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def gate(t):
    batch = t.orders.select("o_orderkey", F.col("o_custkey").alias("writer"))
    return writer_gate(batch, t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("wallet")))
