"""Queries about what must not get lost on the way: pruned comparison, the catalogue after odd runs, failed requests, dates and quotes."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from ..functions import numeric, variants
from ..operators import catalog, constraints, profiles, project, snapshot
from ..operators import reconcile as rec
from ..plans import runner, together
from ..session import scratch_path
from ..sources import files, payloads, targets
from ..sources.registry import Source, read_source
from ..sources.targets import Target
from .ingest import PAYLOAD_ROWS, dated, order_csv
from . import catalogue  # noqa: F401 - its SQL is used again below
from .registry import ORACLE, query, sql_round
from .series import series_frame

DAY = "2024-01-20"
NOW = "2024-03-01 00:00:00"


@query("reconcile_pruned", f"""
SELECT count(*) AS appended, CAST(0 AS BIGINT) AS appended_again FROM (
  SELECT DISTINCT event_type, CAST(ts AS DATE), {sql_round('value / 7')} FROM events)""")
def reconcile_pruned(t):
    """Fractional values through a target that is read only in the range of the incoming values; a second run appends nothing."""
    rows = series_frame(t).withColumn("value", F.col("value") / 7)
    target = Target("prices", "parquet", scratch_path(t.spark, "pruned"), few_values_of="value")
    counts = [runner.export(t.spark, target, rows, NOW)[1] for _time in range(2)]
    return t.spark.createDataFrame([tuple(counts)], "appended BIGINT, appended_again BIGINT")


def _catalogue(t, path):
    return targets.read_version(t.spark, path).select("table_name", "_key", "value")


def _ingest(target, rows):
    return runner.Ingest(target.name, [Source("rows", read=lambda _spark: rows)], [target], lambda frames: {target.name: frames["rows"]})


FACTS = """SELECT '{name}' AS table_name, k AS _key, v AS value FROM (SELECT 'category' AS k, '{category}' AS v UNION ALL SELECT 'name', '{rest}'
  UNION ALL SELECT 'latest_date', (SELECT strftime(max(CAST(ts AS DATE)), '%Y-%m-%d') FROM {rows})
  UNION ALL SELECT 'last_update', (SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') FROM {rows} ORDER BY CAST(ts AS DATE) DESC, ts DESC LIMIT 1))"""


@query("catalogue_after_replace", f"WITH early AS (SELECT * FROM events WHERE ts < TIMESTAMP '{DAY}') "
       + FACTS.format(name="shop_prices_all", category="shop_prices", rest="all", rows="early")
       + " UNION ALL SELECT event_type, k, v FROM (SELECT event_type, unnest(['category', 'name', 'latest_date', 'last_update']) AS k, "
       "unnest([event_type, '', strftime(max(CAST(ts AS DATE)), '%Y-%m-%d'), strftime(arg_max(ts, (CAST(ts AS DATE), ts)), '%Y-%m-%d %H:%M:%S')]) AS v "
       "FROM early WHERE event_type <> 'click' GROUP BY event_type)")
def catalogue_after_replace(t):
    """Replaced targets, one table and one with many series: the catalogue tells what they hold now, and series that are gone are gone."""
    path = scratch_path(t.spark, "catalogue")
    early = series_frame(t).where(F.col("created_at") < F.lit(DAY).cast("timestamp_ntz"))
    one = Target("shop_prices_all", "parquet", scratch_path(t.spark, "one"), replace=True)
    many = Target("kinds", "parquet", scratch_path(t.spark, "many"), replace=True, series="series")
    for first, second in ((series_frame(t), series_frame(t)), (early, early.where("series <> 'click'"))):
        runner.run(t.spark, _ingest(one, first), NOW, catalogue_path=path)
        runner.run(t.spark, _ingest(many, second), NOW, catalogue_path=path)
    return _catalogue(t, path)


@query("catalogue_after_failure", FACTS.format(name="shop_prices_all", category="shop_prices", rest="all", rows="events")
       + " UNION ALL SELECT 'manifest', 'shop_prices_all', CAST(count(*) AS VARCHAR) FROM (SELECT DISTINCT event_type, CAST(ts AS DATE), value FROM events)")
def catalogue_after_failure(t):
    """The second of two targets fails; manifest and catalogue know the first one all the same."""
    path, manifest = scratch_path(t.spark, "catalogue"), scratch_path(t.spark, "manifest")

    def fail(_target, _rows):
        raise OSError("no space")

    plan = runner.Ingest(
        "two", [Source("rows", read=lambda _spark: series_frame(t))],
        [Target("shop_prices_all", "parquet", scratch_path(t.spark, "first")), Target("second", "parquet", "unused", create_table=fail)],
        lambda frames: {"shop_prices_all": frames["rows"], "second": frames["rows"]},
    )
    runner.run(t.spark, plan, NOW, on_error="continue", catalogue_path=path, manifest_path=manifest)
    written = targets.read_manifest(t.spark, manifest)
    return _catalogue(t, path).unionAll(written.select(F.lit("manifest"), "target", F.col("rows").cast("string")))


@query("catalogue_rebuild", FACTS.format(name="shop_prices_all", category="shop_prices", rest="all", rows="events"))
def catalogue_rebuild(t):
    """A catalogue with a table that is gone, built anew from the stored rows of the targets that remain."""
    path = scratch_path(t.spark, "catalogue")
    target = Target("shop_prices_all", "parquet", scratch_path(t.spark, "kept"))
    rules = catalog.load_rules(t.spark, None)
    targets.write_version(catalog.catalogue_rows(series_frame(t).withColumn("series", F.lit("gone")), rules, NOW), path)
    runner.export(t.spark, target, series_frame(t), NOW)
    runner.rebuild_catalogue(t.spark, [(target, series_frame(t))], rules, path, NOW)
    return _catalogue(t, path)


@query("catalogue_empty", "SELECT 0 AS rows_left, count(DISTINCT event_type) AS tables_before FROM events")
def catalogue_empty(t):
    """Rebuilding from no targets leaves no rows."""
    path = scratch_path(t.spark, "catalogue")
    rules = catalog.load_rules(t.spark, None)
    targets.write_version(catalog.catalogue_rows(series_frame(t), rules, NOW), path)
    before = targets.read_version(t.spark, path).select("table_name").distinct().count()
    runner.rebuild_catalogue(t.spark, [], rules, path, NOW)
    left = targets.read_version(t.spark, path).count()
    return t.spark.createDataFrame([(left, before)], "rows_left INT, tables_before BIGINT")


def _answer(url: str):
    """What a made-up server says: status, kind and body are in the URL itself."""
    from urllib.parse import unquote

    status, kind, body = url.removeprefix("http://made.up/").split("/", 2)
    return (int(status), unquote(kind), unquote(body).encode()) if status == "200" else (int(status), None, None)


def _made_url(status, kind: str, body):
    return F.concat(F.lit("http://made.up/"), status, F.lit(f"/{kind.replace('/', '%2F')}/"), F.replace(F.url_encode(body), F.lit("+"), F.lit("%20")))


@query("payload_failures", """SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 503 WHEN 'P' THEN 404 ELSE 200 END AS status,
  CASE o_orderstatus WHEN 'O' THEN 'status 503' WHEN 'P' THEN 'status 404' END AS error FROM orders""")
def payload_failures(t):
    """Every URL leaves a row, with what went wrong when it failed."""
    status = F.when(F.col("o_orderstatus") == "O", "503").when(F.col("o_orderstatus") == "P", "404").otherwise("200")
    urls = t.orders.select("o_orderkey", _made_url(status, "text/csv", order_csv()).alias("url"))
    return payloads.fetch_answers(urls, fetch=_answer, wait=0).select("o_orderkey", "status", "error")


@query("csv_url_source", PAYLOAD_ROWS.replace("o_orderkey, ", ""))
def csv_url_source(t):
    """CSV sources that are URLs, by both type strings; those that fail are kept apart."""
    status = F.when(F.col("o_orderstatus") == "O", "404").otherwise("200")
    rows = []
    for form, chosen in (("csv", "F"), ("csv+http", "P")):
        mine = t.orders.where(F.col("o_orderstatus").isin(chosen, "O"))
        urls = mine.select(_made_url(status, "text/csv", order_csv()).alias("url"))
        options = {"fetch": _answer, "wait": 0, "on_failure": "continue"}
        rows.append(read_source(t.spark, Source(form, form, urls, "date DATE, value DOUBLE", options), {}))
    return rows[0].unionAll(rows[1])


@query("payload_multiline_csv", """SELECT o_orderkey, o_orderpriority || chr(10) || '"' || o_orderstatus || '", ' || chr(13) || chr(10) || o_clerk AS note, o_totalprice AS value
FROM (SELECT *, 'clerk ' || o_custkey AS o_clerk FROM orders)""")
def payload_multiline_csv(t):
    """Quoted fields with line breaks, commas and doubled quotes."""
    clerk = F.concat(F.lit("clerk "), F.col("o_custkey").cast("string"))
    body = F.concat(
        F.lit('note,value\r\n"'), F.col("o_orderpriority"), F.lit('\n""'), F.col("o_orderstatus"), F.lit('"", \r\n'), clerk, F.lit('",'),
        F.col("o_totalprice").cast("string"), F.lit("\r\n"),
    )
    bodies = t.orders.select("o_orderkey", F.lit("text/csv").alias("content_type"), body.alias("body"))
    return payloads.decode_payloads(bodies, "note STRING, value DOUBLE")


WAYS = {
    "ISO": "yyyy-MM-dd", "month name": "MMM d, yyyy", "full month": "MMMM d, yyyy", "day first": "d MMM yyyy", "slashes": "M/d/yyyy",
    "compact": "yyyyMMdd",
}


@query("date_texts", f"""SELECT o_orderkey, way, date_trunc('day', o_orderdate)::TIMESTAMP AS date FROM orders,
  (SELECT unnest({list(WAYS)}) AS way) w""")
def date_texts(t):
    """The ways publishers write a date, all read by default."""
    written = F.array(*[
        F.struct(F.lit(way).alias("way"), F.date_format("o_orderdate", pattern).alias("date")) for way, pattern in WAYS.items()
    ])
    return project.parse_date_columns(t.orders.select("o_orderkey", F.inline(written)))


@query("unreadable_dates", "SELECT 'around ' || o_orderpriority AS date, count(*) AS rows FROM orders GROUP BY 1")
def unreadable_dates(t):
    """The texts that cleaning a date column would lose, with their counts."""
    from ..operators.clean import unreadable

    odd = t.orders.select(F.explode(F.array(F.concat(F.lit("around "), "o_orderpriority"), F.date_format("o_orderdate", "MMM d, yyyy"))).alias("date"))
    return unreadable(odd, "date")


@query("history_answer", """
SELECT 'ok' AS s, list(epoch_us(ts) // 1000 ORDER BY ts, value) AS t, list(value ORDER BY ts, value) AS c FROM (
  SELECT ts, value FROM events WHERE event_type = 'click' AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20' ORDER BY ts DESC, value DESC LIMIT 7)""")
def history_answer(t):
    index = t.events.select(F.col("event_type").alias("category"), F.col("ts").alias("date"), "value")
    return snapshot.history_answer(index, "click:value", 1704412800000, 1705708800000, 7)


@query("round_tiny", """SELECT event_id, CASE WHEN x = 0 THEN x WHEN abs(x) > 1e-33 THEN CAST(format('{:.33f}', x) AS DOUBLE)
  WHEN abs(x) > 1e-36 THEN CAST(format('{:.36f}', x) AS DOUBLE) ELSE CAST(format('{:.39f}', x) AS DOUBLE) END AS rounded
FROM (SELECT event_id, value * 1.2345678e-35 AS x FROM events)""")
def round_tiny(t):
    """Magnitudes far below the compiled levels are rounded like any other."""
    return t.events.select("event_id", numeric.round_value(F.col("value") * 1.2345678e-35).alias("rounded"))


@query("wei_scale_large", "SELECT o_orderkey, CAST(CAST(trunc(o_totalprice * 1e14 * 1e18) AS HUGEINT) AS VARCHAR) AS wei FROM orders")
def wei_scale_large(t):
    return t.orders.select("o_orderkey", numeric.wei_scale(F.col("o_totalprice") * F.lit(1e14)).cast("string").alias("wei"))


@query("target_runs", """
SELECT form, dated, CAST(count(*) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS first, CAST(0 AS BIGINT) AS again, CAST(0 AS BIGINT) AS third
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE), o_totalprice, o_orderstatus FROM orders),
  (SELECT unnest(['csv', 'gsheet', 'json', 'parquet']) AS form) f, (SELECT unnest([true, false]) AS dated) d GROUP BY form, dated""")
def target_runs(t):
    """Three runs of one download per format, with and without a date column: the second and third append nothing and write no file."""
    found = []
    for form in ("csv", "gsheet", "json", "parquet"):
        for with_date in (True, False):
            rows = dated(t) if with_date else dated(t).withColumnRenamed("date", "day")
            target = Target("orders", form, scratch_path(t.spark, f"runs-{form}"))
            written, names = [], []
            for _time in range(3):
                written.append(runner.export(t.spark, target, rows, "2002-01-01 00:00:00")[1])
                names.append(sorted(n for n in files.child_names(t.spark, target.location) if n.startswith("part-")))
            if names[0] != names[2]:
                raise AssertionError(f"{form}: idle runs left files")
            stored = targets.read_target(t.spark, target, rows)
            found.append((form, with_date, stored.count(), *written))
    return t.spark.createDataFrame(found, "form STRING, dated BOOLEAN, rows BIGINT, first BIGINT, again BIGINT, third BIGINT")


@query("own_reconcile_target", """
SELECT event_type AS series, CAST(ts AS DATE) AS date, value, ts AS created_at FROM events WHERE ts < TIMESTAMP '2024-01-20'
UNION ALL SELECT event_type, CAST(ts AS DATE), value, ts FROM events e
WHERE NOT EXISTS (SELECT 1 FROM events b WHERE b.ts < TIMESTAMP '2024-01-20' AND b.event_type = e.event_type AND CAST(b.ts AS DATE) = CAST(e.ts AS DATE))""")
def own_reconcile_target(t):
    """A target with a change rule of its own: whole days that it does not have yet."""

    def new_days(base, incoming):
        return rec.delete_by_key(incoming, base, ["series", "date"]).select(*base.columns)

    frame = series_frame(t)
    target = Target("days", "parquet", scratch_path(t.spark, "days"), reconcile=new_days)
    targets.write_target(frame.where(F.col("created_at") < F.lit(DAY).cast("timestamp_ntz")), target)
    runner.export(t.spark, target, frame, NOW)
    return targets.read_target(t.spark, target, frame).select("series", "date", "value", "created_at")


@query("own_steps", "SELECT event_type AS series, count(*) AS n, CAST(1 AS INTEGER) AS befores, CAST(1 AS INTEGER) AS afters FROM events GROUP BY 1")
def own_steps(t):
    """A source with its own parsing, an ingest with steps before and after it, a target with its own way to be created."""
    calls = {"before": 0, "after": 0}
    path = scratch_path(t.spark, "own")

    def count_call(name):
        def step():
            calls[name] += 1

        return step

    plan = runner.Ingest(
        "own", [Source("raw", read=lambda _spark: t.events.select(F.to_json(F.struct("event_type")).alias("body")),
                       parse=lambda df: df.select(F.get_json_object("body", "$.event_type").alias("series")))],
        [Target("kinds", "parquet", path, create_table=lambda target, rows: rows.write.parquet(target.location))],
        lambda frames: {"kinds": frames["raw"].groupBy("series").agg(F.count(F.lit(1)).alias("n"))},
        before=count_call("before"), after=count_call("after"),
    )
    runner.run(t.spark, plan, NOW)
    stored = t.spark.read.parquet(path)
    return stored.select("series", "n", F.lit(calls["before"]).alias("befores"), F.lit(calls["after"]).alias("afters"))


@query("run_all_reports", """SELECT 'good' AS ingest, 'good' AS target, 'written' AS status, count(DISTINCT event_type) AS rows FROM events
UNION ALL SELECT 'bad', 'bad', 'failed', NULL""")
def run_all_reports(t):
    """Several ingests of one declaration; one fails and is reported, the other is written."""
    def make(column):
        rows = t.events.select(F.col(column).alias("kind")).distinct()
        return [
            _ingest(Target("bad", "no-such-format", "nowhere"), rows), _ingest(Target("good", "parquet", scratch_path(t.spark, "good")), rows),
        ]

    runs = runner.run_all(t.spark, make, NOW, {"column": "event_type"}, on_error="continue")
    entries = [entry for run in runs for entry in run.entries]
    return t.spark.createDataFrame(entries, runner.REPORT_SCHEMA).select("ingest", "target", "status", "rows")


@query("published_frames", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def published_frames(t):
    """Frames that SQL reaches by name."""
    runner.publish({"published_events": t.events})
    return t.spark.sql("SELECT event_type, count(*) AS n FROM published_events GROUP BY 1")


@query("rules_from_file", "SELECT DISTINCT 'user_' || user_id AS table_name, 'Daily' AS frequency, 'No' AS other FROM events")
def rules_from_file(t):
    """Frequency rules of a JSON file; the first that fits counts."""
    path = scratch_path(t.spark, "rules")
    targets.write_document(t.spark, [
        {"index": "user_", "frequency": "Daily", "other": "No", "exact": 0}, {"index": "", "frequency": "Weekly", "other": "Yes", "exact": 0},
    ], path)
    names = t.events.select(F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("table_name"))
    return catalog.first_rule(names, catalog.load_rules(t.spark, path))


@query("stored_constraints", "SELECT 'found' AS run, true AS passed UNION ALL SELECT 'stored', true UNION ALL SELECT 'other rows', false")
def stored_constraints(t):
    """Constraints are found and stored by the first check and used by the next ones."""
    path = scratch_path(t.spark, "constraints")
    rows = []
    for name, frame in (("found", t.customer), ("stored", t.customer), ("other rows", t.customer.withColumn("c_acctbal", F.col("c_acctbal") * 2))):
        broken = constraints.verify_stored(frame, path).where(~F.col("passed")).count()
        rows.append((name, broken == 0))
    return t.spark.createDataFrame(rows, "run STRING, passed BOOLEAN")


@query("date_bounds_match", "SELECT count(*) AS rows FROM events WHERE CAST(ts AS DATE) BETWEEN (SELECT min(CAST(ts AS DATE)) FROM events "
       f"WHERE ts < TIMESTAMP '{DAY}') AND (SELECT max(CAST(ts AS DATE)) FROM events WHERE ts < TIMESTAMP '{DAY}')")
def date_bounds_match(t):
    """Rows of a target that a smaller download can equal by date."""
    frame = series_frame(t)
    early = frame.where(F.col("created_at") < F.lit(DAY).cast("timestamp_ntz"))
    return rec.within_incoming_bounds(frame, early, ["date"]).agg(F.count(F.lit(1)).alias("rows"))


@query("constraint_incremental", ORACLE["constraint_profile"])
def constraint_incremental(t):
    """Constraints of three appends, each profiled by itself; only columns that may have lost their uniqueness are looked up in the rows before."""
    path, rows = scratch_path(t.spark, "profiles"), t.customer
    part = F.col("c_nationkey") % 3
    found = None
    for number in range(3):
        found = profiles.append_profile(t.spark, path, f"batch {number}", rows.where(part == number), rows.where(part < number))
    return found


@query("schema_check_hot", """
SELECT key, o_orderkey, CASE WHEN key IS NULL THEN 'null key' WHEN count(*) OVER (PARTITION BY key) > 1 THEN 'repeated key' END AS reason
FROM (SELECT CASE WHEN o_orderkey % 3 = 0 THEN 0 WHEN o_orderkey % 7 = 1 THEN NULL WHEN o_orderkey % 50 = 2 THEN o_custkey + 100000000 ELSE o_orderkey + 1 END AS key, o_orderkey FROM orders)""")
def schema_check_hot(t):
    """A third of the rows share one key, some have none, a few repeat another and the rest have one of their own."""
    o = F.col("o_orderkey")
    key = F.when(o % 3 == 0, 0).when(o % 7 == 1, None).when(o % 50 == 2, F.col("o_custkey") + 100000000).otherwise(o + 1)
    return constraints.schema_check(t.orders.select(key.cast("bigint").alias("key"), "o_orderkey"), ["key"])


@query("payload_control_characters", """SELECT o_orderkey, 'a' || chr(1) || o_orderpriority || chr(2) || chr(3) || '1' || chr(10) || 'b' AS note, chr(3) || o_orderstatus AS plain FROM orders""")
def payload_control_characters(t):
    """Texts that hold the characters that stand in for line ends inside quotes, beside real line ends."""
    note = F.concat(F.lit('"a\u0001'), F.col("o_orderpriority"), F.lit('\u0002\u00031\nb",\u0003'), F.col("o_orderstatus"))
    bodies = t.orders.select("o_orderkey", F.lit("text/csv").alias("content_type"), F.concat(F.lit("note,plain\n"), note, F.lit("\n")).alias("body"))
    return payloads.decode_payloads(bodies, "note STRING, plain STRING")


@query("catalogue_new_series", """SELECT event_type AS table_name, k AS _key, v AS value FROM (
  SELECT event_type, unnest(['category', 'name', 'latest_date', 'last_update']) AS k,
    unnest([event_type, '', strftime(max(CAST(ts AS DATE)), '%Y-%m-%d'), strftime(arg_max(ts, (CAST(ts AS DATE), ts)), '%Y-%m-%d %H:%M:%S')]) AS v
  FROM events GROUP BY event_type)""")
def catalogue_new_series(t):
    """Each run brings one series more beside rows of those before; what is stored of the others is not read for the facts."""
    path, rows = scratch_path(t.spark, "catalogue"), series_frame(t)
    target = Target("kinds", "parquet", scratch_path(t.spark, "many"), series="series")
    names = sorted(r["series"] for r in rows.select("series").distinct().collect())
    early = F.col("created_at") < F.lit(DAY).cast("timestamp_ntz")
    for number in range(len(names)):
        runner.run(t.spark, _ingest(target, rows.where(F.col("series").isin(names[: number + 1]) & early)), NOW, catalogue_path=path)
    runner.run(t.spark, _ingest(target, rows), NOW, catalogue_path=path)
    return _catalogue(t, path)


@query("two_targets_commit", """
SELECT 'after the kill' AS seen, 'none' AS target, CAST(NULL AS DATE) AS date, CAST(NULL AS BIGINT) AS key, CAST(NULL AS DOUBLE) AS value
UNION ALL SELECT 'after the rerun', 'orders', CAST(o_orderdate AS DATE), CAST(o_custkey AS BIGINT), o_totalprice FROM orders GROUP BY ALL
UNION ALL SELECT 'after the rerun', 'events', CAST(ts AS DATE), CAST(user_id AS BIGINT), value FROM events GROUP BY ALL""")
def two_targets_commit(t):
    """A run that is killed between its two targets leaves nothing to see; its rerun, and one more, leave one copy of both."""
    path = scratch_path(t.spark, "together")
    orders = t.orders.select(F.to_date("o_orderdate").alias("date"), F.col("o_custkey").cast("bigint").alias("key"), F.col("o_totalprice").alias("value"))
    events = t.events.select(F.to_date("ts").alias("date"), F.col("user_id").cast("bigint").alias("key"), "value")
    killed = events.withColumn("key", F.raise_error(F.lit("killed")).cast("bigint"))
    seen = []
    for attempt in ({"orders": orders, "events": killed}, {"orders": orders, "events": events}, {"orders": orders, "events": events}):
        try:
            together.export_together(t.spark, path, attempt, NOW, "two", 1)
        except Exception as error:
            if "killed" not in str(error):
                raise
            left = together.read_together(t.spark, path, ["orders", "events"], {"orders": orders, "events": events})
            if any(not frame.isEmpty() for frame in left.values()):
                raise AssertionError("a target can be seen without the other") from error
            seen.append(orders.limit(1).select(
                F.lit("after the kill").alias("seen"), F.lit("none").alias("target"), *[F.lit(None).cast(k).alias(c) for c, k in orders.dtypes]))
    found = together.read_together(t.spark, path, ["orders", "events"], {"orders": orders, "events": events})
    for name, frame in found.items():
        seen.append(frame.select(F.lit("after the rerun").alias("seen"), F.lit(name).alias("target"), "date", "key", "value"))
    return seen[0].unionAll(seen[1]).unionAll(seen[2])


@query("payload_any_shape", """
SELECT o_orderkey, CAST(o_custkey AS BIGINT) AS customer, CASE WHEN n = 2 THEN o_orderstatus ELSE o_orderpriority END AS note, n = 1 AS first, CAST(n AS BIGINT) AS number
FROM orders, (SELECT unnest([1, 2]) AS n) x WHERE o_orderkey % 3 < 2 OR n = 1""")
def payload_any_shape(t):
    """Lists of records, objects of lists and single records, read without a schema; one column for each field of any of them."""
    o = F.col("o_orderkey")
    fields = [F.col("o_custkey").alias("customer"), F.col("o_orderpriority").alias("note"), F.lit(True).alias("first"), F.lit(1).alias("number")]
    more = [F.col("o_custkey").alias("customer"), F.col("o_orderstatus").alias("note"), F.lit(False).alias("first"), F.lit(2).alias("number")]
    lists = [F.array(F.col("o_custkey"), F.col("o_custkey")).alias("customer"), F.array("o_orderpriority", "o_orderstatus").alias("note"),
             F.array(F.lit(True), F.lit(False)).alias("first"), F.array(F.lit(1), F.lit(2)).alias("number")]
    body = F.when(o % 3 == 0, F.to_json(F.array(F.struct(*fields), F.struct(*more)))).when(o % 3 == 1, F.to_json(F.struct(*lists))).otherwise(
        F.to_json(F.struct(*fields)))
    return variants.typed_records(variants.variant_records(t.orders.select("o_orderkey", body.alias("body"))))


@query("ingests_together", "SELECT 'kind ' || event_type AS ingest, event_type AS target, 'written' AS status, count(*) AS rows FROM (SELECT DISTINCT event_type, CAST(ts AS DATE), value FROM events) GROUP BY 2 "
       "UNION ALL SELECT 'bad', 'bad', 'failed', NULL")
def ingests_together(t):
    """Ingests of all series and one that fails, up to four at once: the report is that of running them in turn."""
    rows = series_frame(t)
    names = sorted(r["series"] for r in rows.select("series").distinct().collect())
    catalogue_path = scratch_path(t.spark, "catalogue")

    def make():
        good = [dataclasses.replace(_ingest(Target(n, "parquet", scratch_path(t.spark, "kind")), rows.where(F.col("series") == n)), name=f"kind {n}") for n in names]
        return [*good[:1], _ingest(Target("bad", "no-such-format", "nowhere"), rows), *good[1:]]

    runs = runner.run_all(t.spark, make, NOW, together=4, on_error="continue", catalogue_path=catalogue_path)
    known = _catalogue(t, catalogue_path).where("_key = 'latest_date'").count()
    if known != len(names):
        raise AssertionError(f"the catalogue knows {known} of {len(names)} series")
    entries = [entry for run in runs for entry in run.entries]
    return t.spark.createDataFrame(entries, runner.REPORT_SCHEMA).select("ingest", "target", "status", "rows")
