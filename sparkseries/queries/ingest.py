"""Sources, sinks, declared ingests and streams, each run over whole tables.

Files go to a fresh folder below the cluster's shared folder.
"""

from __future__ import annotations

import io
import zipfile
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import exact_sum
from ..operators import catalog
from ..operators import reconcile as rec
from ..plans import ready, runner
from ..session import scratch_path
from ..sources import files, ledger, payloads, targets, workbooks
from ..sources.registry import Source, read_source, register_source
from ..sources.targets import Target
from ..streaming import jobs
from .registry import Tables, query
from .series import ROUNDED, base_and_incoming, series_frame

DATED = "SELECT CAST(o_orderdate AS DATE) AS date, o_totalprice AS value, o_orderstatus AS flag FROM orders"


def dated(t: Tables) -> DataFrame:
    return t.orders.select(
        F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("value"), F.col("o_orderstatus").alias("flag")
    )


@query("csv_roundtrip", f"{DATED} UNION ALL {DATED}")
def csv_roundtrip(t):
    path = scratch_path(t.spark, "csv")
    targets.write_csv(dated(t), path)
    targets.write_csv(dated(t), path, if_exists="append")
    return files.read_csv(t.spark, path, "date DATE, value DOUBLE, flag STRING")


@query("json_roundtrip", DATED)
def json_roundtrip(t):
    path = scratch_path(t.spark, "json")
    targets.write_json(dated(t), path)
    return files.read_json(t.spark, path, "date DATE, value DOUBLE, flag STRING", multi_line=False)


@query("table_roundtrip", DATED)
def table_roundtrip(t):
    """Create, replace, append to and read a catalogue table kept below the shared folder."""
    name = scratch_path(t.spark, "table").rsplit("/", 1)[1].replace("-", "_")
    targets.execute(t.spark, [
        f"CREATE TABLE {name} (date DATE, value DOUBLE, flag STRING) USING parquet LOCATION '{scratch_path(t.spark, 'table')}'"
    ])
    targets.write_target(dated(t).where("flag = 'F'"), Target(name, "table"))
    targets.write_target(dated(t).where("flag <> 'F'"), Target(name, "table"))
    return t.spark.table(name)


TARGET_SQL = """SELECT step, n FROM (SELECT 1 AS step, count(*) AS n FROM customer UNION ALL SELECT 2, 2 * count(*) FROM customer
  UNION ALL SELECT 3, count(*) FILTER (c_acctbal > 0) FROM customer UNION ALL SELECT 4, count(*) FILTER (c_acctbal > 0) FROM customer)"""


@query("target_modes", TARGET_SQL)
def target_modes(t):
    """Rows of a target after a create, an append, a replace and a missing frame."""
    target = Target("customers", "parquet", scratch_path(t.spark, "modes"))
    steps = [
        lambda: targets.write_target(t.customer, target),
        lambda: targets.write_target(t.customer, target),
        lambda: targets.dump(t.customer.where("c_acctbal > 0"), target),
        lambda: targets.write_target(None, target),
    ]
    counts = []
    for number, step in enumerate(steps, start=1):
        step()
        counts.append((number, targets.read_target(t.spark, target, t.customer).count()))
    return t.spark.createDataFrame(counts, "step INT, n BIGINT")


@query("text_sheet", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_totalprice AS VARCHAR) AS o_totalprice, o_orderstatus FROM orders")
def text_sheet(t):
    target = Target("sheet", "gsheet", scratch_path(t.spark, "sheet"), replace=True)
    targets.write_target(t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), target)
    return files.read_csv(t.spark, target.location, "o_orderkey STRING, o_totalprice STRING, o_orderstatus STRING")


@query("manifest", "SELECT 'series' AS target, count(*) AS rows FROM orders UNION ALL SELECT 'days', count(DISTINCT o_orderdate) FROM orders")
def manifest(t):
    """Row counts of written targets, counted by the writing jobs themselves."""
    orders = t.orders.select("o_orderkey", "o_orderdate")
    path = scratch_path(t.spark, "manifest")
    plan = runner.Ingest(
        "orders", [Source("orders", read=lambda _spark: orders)],
        [Target("series", "parquet", scratch_path(t.spark, "series")), Target("days", "parquet", scratch_path(t.spark, "days"))],
        lambda frames: {"series": frames["orders"], "days": frames["orders"].select("o_orderdate").distinct()},
    )
    runner.run(t.spark, plan, "2024-02-01", manifest_path=path)
    return targets.read_manifest(t.spark, path).select("target", "rows")


@query("ledger_roundtrip", "SELECT CAST(ts AS DATE) AS date, round(value, 6) AS value, ts AS created_at, event_id FROM events")
def ledger_roundtrip(t):
    root = scratch_path(t.spark, "ledger")
    rows = t.events.select(F.to_date("ts").alias("date"), "value", F.col("ts").alias("created_at"), "event_id")
    ledger.append_ledger(rows, "me@db:prices", root, keys=["event_id"])
    return ledger.read_ledger(t.spark, "me@db:prices", root)


@query("series_ingest", """
SELECT form, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events,
  (SELECT unnest(['cache', 'csv', 'json', 'object', 'override', 'parquet', 'plugin', 'table']) AS form) f GROUP BY form""")
def series_ingest(t):
    """The same series through every form of source."""
    frame = series_frame(t).withColumn("created_at", F.col("created_at").cast("string"))
    schema = "series STRING, date DATE, value DOUBLE, created_at STRING"
    root = scratch_path(t.spark, "forms")
    targets.write_csv(frame, f"{root}/csv")
    targets.write_json(frame, f"{root}/json")
    frame.write.parquet(f"{root}/parquet")
    frame.createOrReplaceTempView("series_rows")
    register_source("plugin", lambda spark, source: spark.read.parquet(source.path))
    sources = [
        Source("csv", f"csv:{root}", "csv", schema),
        Source("json", f"json:{root}", "json", schema, {"multi_line": False}),
        Source("parquet", "parquet", f"{root}/parquet"),
        Source("table", "table", "series_rows"),
        Source("object", "object", frame, options={"data_type": DataFrame}),
        Source("override", read=lambda spark: spark.read.parquet(f"{root}/parquet")),
        Source("plugin", "plugin", f"{root}/parquet"),
        Source("cache", "cache", "parquet"),
    ]
    frames: dict[str, DataFrame] = {}
    for source in sources:
        frames[source.name] = runner.load(t.spark, source, frames)
    return rec.union_tagged(frames, "form").groupBy("form").agg(
        F.count(F.lit(1)).alias("n"), exact_sum(F.col("value"), 2).alias("total")
    )


def _workbook(rows: pd.DataFrame) -> bytes:
    def cell(value) -> str:
        if isinstance(value, str):
            return f'<c t="inlineStr"><is><t>{escape(value)}</t></is></c>'
        return f"<c><v>{value}</v></c>"

    lines = [list(rows.columns)] + rows.values.tolist()
    sheet = "".join(f"<row>{''.join(cell(v) for v in line)}</row>" for line in lines)
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    links = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as book:
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{links}"><sheets>'
                      '<sheet name="data" sheetId="1" r:id="rId1"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/'
                      'relationships"><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{sheet}</sheetData></worksheet>')
    return data.getvalue()


def as_workbooks(df: DataFrame) -> DataFrame:
    """One workbook per Arrow batch, as (path, content)."""

    def build(batches):
        for batch in batches:
            yield pd.DataFrame({"path": ["book.xlsx"], "content": [_workbook(batch)]})

    return df.mapInPandas(build, "path STRING, content BINARY")


@query("workbook_scan", "SELECT CAST(o_orderdate AS DATE) AS date, o_totalprice AS value, o_orderpriority AS note, "
       "CAST(o_orderdate AS DATE) AS due FROM orders")
def workbook_scan(t):
    day_number = F.date_diff(F.to_date("o_orderdate"), F.lit("1899-12-30").cast("date"))
    rows = t.orders.select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("Date"), F.col("o_totalprice").alias("Price"),
        F.col("o_orderpriority").alias("note"), day_number.alias("due"),
    )
    books = workbooks.parse_workbooks(as_workbooks(rows), "`Date` DATE, `Price` DOUBLE, note STRING, due DATE")
    return files.spreadsheet_frame(books)


def data_url(kind: str, body):
    return F.concat(F.lit(f"data:{kind},"), F.replace(F.url_encode(body), F.lit("+"), F.lit("%20")))


def order_json():
    day, price = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_totalprice").cast("string")
    return F.concat(F.lit('[{"date":"'), day, F.lit('","value":'), price, F.lit("}]"))


def order_csv():
    return F.concat(F.lit("date,value\n"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(","), F.col("o_totalprice").cast("string"), F.lit("\n"))


PAYLOAD_ROWS = "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, o_totalprice AS value FROM orders WHERE o_orderstatus <> 'O'"


@query("payload_fetch", PAYLOAD_ROWS)
def payload_fetch(t):
    """One request per order; `data:` URLs carry their content, and requests that fail leave no row."""
    status = F.col("o_orderstatus")
    url = F.when(status == "F", data_url("text/csv", order_csv())).when(
        status == "P", data_url("application/json", order_json())
    ).otherwise("no-such-scheme:x")
    fetched = payloads.fetch_payloads(t.orders.select("o_orderkey", url.alias("url")), tries=1)
    return payloads.decode_payloads(fetched.drop("url", "status"), "date DATE, value DOUBLE")


@query("payload_decode", PAYLOAD_ROWS)
def payload_decode(t):
    status = F.col("o_orderstatus")
    bodies = t.orders.select(
        "o_orderkey",
        F.when(status == "F", "text/csv; charset=utf-8").when(status == "P", "application/json").otherwise("image/png").alias("content_type"),
        F.encode(F.when(status == "F", order_csv()).otherwise(order_json()), "UTF-8").alias("body"),
    )
    return payloads.decode_payloads(bodies, "date DATE, value DOUBLE")


@query("source_by_type", "SELECT CAST(o_orderdate AS DATE) AS date, o_totalprice AS value FROM orders")
def source_by_type(t):
    """`rest+http` over a frame of URLs."""
    urls = t.orders.select(data_url("application/json", order_json()).alias("url"))
    return read_source(t.spark, Source("prices", "rest+http", urls, "date DATE, value DOUBLE"))


@query("metadata_fan_out", """
SELECT c_name AS series, CAST(o_orderdate AS DATE) AS date, o_totalprice AS value FROM orders JOIN customer ON c_custkey = o_custkey""")
def metadata_fan_out(t):
    """Every customer is a table whose metadata names its source; all payloads become one frame."""
    metadata = t.customer.select(
        F.col("c_name").alias("table"), F.lit("source_id").alias("key"), F.col("c_custkey").alias("valuei"),
        F.lit(None).cast("timestamp_ntz").alias("valued"), F.lit(None).cast("double").alias("valuef"), F.lit(None).cast("string").alias("values"),
    )
    bodies = t.orders.select(
        F.concat(F.lit("mem://"), F.col("o_custkey").cast("string")).alias("url"),
        F.lit("application/json").alias("content_type"), order_json().alias("body"),
    )
    fanned = payloads.fan_out(metadata, "source_id", bodies, lambda value: F.concat(F.lit("mem://"), value))
    return payloads.decode_payloads(fanned.drop("url"), "date DATE, value DOUBLE")


def event_ingest(t: Tables, path: str) -> runner.Ingest:
    _base, incoming = base_and_incoming(t)
    return runner.Ingest(
        "events", [Source("download", read=lambda _spark: incoming)], [Target("series", "parquet", path)],
        lambda frames: {"series": frames["download"]},
    )


def first_load(t: Tables, path: str) -> None:
    base, _incoming = base_and_incoming(t)
    runner.export(t.spark, Target("series", "parquet", path), base, "2024-03-01")


MERGED = f"""WITH {ROUNDED}, first_load AS (SELECT series, date, user_id, value, min(created_at) AS created_at FROM
  (SELECT event_type AS series, CAST(ts AS DATE) AS date, user_id,
     CASE WHEN event_type = 'signup' AND value > 20 THEN NULL ELSE value END AS value, ts AS created_at
   FROM events WHERE ts < TIMESTAMP '2024-01-20') GROUP BY ALL)"""


@query("ingest_run", f"{MERGED} SELECT * FROM first_load UNION ALL SELECT * FROM fresh")
def ingest_run(t):
    """The target after a first load, a download with corrections, and the same download once more."""
    path = scratch_path(t.spark, "run")
    first_load(t, path)
    for _time in range(2):
        runner.run(t.spark, event_ingest(t, path), "2024-03-01")
    return t.spark.read.parquet(path)


@query("ingest_report", f"WITH {ROUNDED} SELECT 1 AS run, 'written' AS status, count(*) AS rows FROM fresh UNION ALL SELECT 2, 'written', 0")
def ingest_report(t):
    path = scratch_path(t.spark, "report")
    first_load(t, path)
    entries = []
    for number in (1, 2):
        report = runner.run(t.spark, event_ingest(t, path), "2024-03-01").report(t.spark)
        entries.append(report.select(F.lit(number).alias("run"), "status", "rows"))
    return entries[0].unionAll(entries[1])


@query("ingest_dry_run", f"WITH {ROUNDED} SELECT * FROM fresh")
def ingest_dry_run(t):
    path = scratch_path(t.spark, "dry")
    first_load(t, path)
    return runner.run(t.spark, event_ingest(t, path), "2024-03-01", dry_run=True).new_rows["series"]


@query("ingest_catalogue", """
SELECT 'prices' AS table_name, k AS _key, v AS value FROM (SELECT 'category' AS k, 'prices' AS v UNION ALL SELECT 'name', ''
  UNION ALL SELECT 'latest_date', strftime(max(o_orderdate), '%Y-%m-%d') FROM orders
  UNION ALL SELECT 'last_update', '2002-01-01 00:00:00' UNION ALL SELECT 'frequency', 'Daily' UNION ALL SELECT 'other', 'No')""")
def ingest_catalogue(t):
    """The catalogue an ingest leaves behind after a run with new rows and one without."""
    path = scratch_path(t.spark, "catalogue")
    rules = t.spark.createDataFrame([("prices", "Daily", "No", 1, 0)], catalog.RULE_SCHEMA + ", position INT")
    plan = runner.Ingest(
        "prices", [Source("prices", read=lambda _spark: dated(t))], [Target("prices", "parquet", scratch_path(t.spark, "prices"))],
    )
    for _time in range(2):
        runner.run(t.spark, plan, "2002-01-01 00:00:00", catalogue_path=path, rules=rules)
    return targets.read_version(t.spark, path).select("table_name", "_key", "value")


@query("ingest_output", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def ingest_output(t):
    plan = runner.Ingest(
        "orders", [Source("orders", read=lambda _spark: t.orders)], [],
        [lambda frames: {"orders": frames["orders"].groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))}],
    )
    return runner.output(t.spark, [plan], "orders", "2024-01-01")


@query("ingest_copy", DATED)
def ingest_copy(t):
    target = Target("copy", "parquet", scratch_path(t.spark, "copy"))
    runner.copy(t.spark, Source("orders", "object", dated(t), options={"data_type": DataFrame}), target)
    return t.spark.read.parquet(target.location)


@query("ingest_yearly", "SELECT year(l_shipdate) AS year, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM lineitem GROUP BY 1")
def ingest_yearly(t):
    source, output = scratch_path(t.spark, "yearly"), scratch_path(t.spark, "sums")
    written = F.replace(F.col("l_extendedprice").cast("string"), F.lit("."), F.lit(","))
    targets.write_csv(t.lineitem.select(F.year("l_shipdate").alias("year"), written.alias("total")), source)
    runner.run(t.spark, ready.yearly_ingest("years", source, output, "total", scale=2), "2024-01-01")
    return files.read_csv(t.spark, output, "year BIGINT, total DOUBLE")


@query("ingest_economic", """
SELECT CAST(o_orderdate AS DATE) AS date, o_totalprice AS value, TIMESTAMP '2024-01-01' AS created_at FROM orders WHERE o_orderstatus <> 'F' GROUP BY ALL""")
def ingest_economic(t):
    """A CSV of `Date, Value` with gaps; rows with a gap are dropped and equal rows are stored once."""
    path, output = scratch_path(t.spark, "economic"), scratch_path(t.spark, "economic-target")
    gaps = F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice"))
    targets.write_csv(t.orders.select(F.to_date("o_orderdate").alias("Date"), gaps.alias("Value")), path)
    target = Target("prices", "parquet", output)
    runner.run(t.spark, ready.economic_ingest("prices", path, [target]), "2024-01-01")
    return t.spark.read.parquet(output)


#: Bytes of a stream's files that one micro-batch takes.
BATCH_BYTES = 64 * 1024 * 1024


def streamed(t: Tables, parts: list[DataFrame], start) -> None:
    """Runs a stream over one folder as often as there are parts; each part arrives before a run."""
    path = scratch_path(t.spark, "in")
    for part in parts:
        part.write.mode("append").parquet(path)
        start(t.spark.readStream.schema(part.schema).option("maxBytesPerTrigger", BATCH_BYTES).parquet(path)).awaitTermination()


def before_and_after(rows: DataFrame, column: str) -> list[DataFrame]:
    day = F.lit("2024-01-20").cast("timestamp_ntz")
    return [rows.where(F.col(column) < day), rows.where(F.col(column) >= day)]


@query("stream_reconcile", "SELECT event_type AS series, CAST(ts AS DATE) AS date, user_id, value, min(ts) AS created_at FROM events GROUP BY ALL")
def stream_reconcile(t):
    rows = t.events.select(
        F.col("event_type").alias("series"), F.to_date("ts").alias("date"), "user_id", "value", F.col("ts").alias("created_at")
    )
    path, state = scratch_path(t.spark, "stream"), scratch_path(t.spark, "state")
    # Each part arrives twice; only its first rows count.
    early, late = before_and_after(rows, "created_at")
    streamed(t, [early, late.unionAll(early)], lambda stream: jobs.stream_reconcile(stream, path, state))
    return jobs.read_batches(t.spark, path, rows)


@query("stream_last_write", """
SELECT id, timestamp, value FROM (SELECT user_id || '-' || event_type AS id, ts AS timestamp, value FROM events)
QUALIFY row_number() OVER (PARTITION BY id ORDER BY timestamp DESC, value DESC) = 1""")
def stream_last_write(t):
    rows = t.events.select(F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("id"), F.col("ts").alias("timestamp"), "value")
    path, state = scratch_path(t.spark, "stream"), scratch_path(t.spark, "state")
    streamed(t, before_and_after(rows, "timestamp"), lambda stream: jobs.stream_last_write(stream, path, state))
    return jobs.last_writes(t.spark, path, rows)


@query("stream_round_average", """
SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS round_start, event_type AS location, 'u' || user_id AS type,
  round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*), 6) AS price, count(*) AS scrapes FROM events GROUP BY ALL""")
def stream_round_average(t):
    """Tumbling averages of a stream in append mode: a window is written once, when the watermark has passed it.

    The files of a table arrive in no order, so rows may be as late as the table is long. A row far behind the others closes their windows;
    its own window stays open.
    """
    rows = t.events.select("ts", F.col("event_type").alias("location"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("type"), F.col("value").alias("price"))
    path, state = scratch_path(t.spark, "windows"), scratch_path(t.spark, "state")
    closing = t.events.agg((F.max("ts") + F.expr("INTERVAL 90 DAY")).alias("ts")).select(
        "ts", F.lit("end").alias("location"), F.lit("end").alias("type"), F.lit(0.0).alias("price")
    )
    streamed(t, [rows, closing], lambda stream: jobs.write_averages(jobs.round_average_stream(stream, late="60 days"), path, state))
    return t.spark.read.parquet(path).select("round_start", "location", "type", F.round("price", 6).alias("price"), "scrapes")
