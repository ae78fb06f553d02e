"""Catalogues, freshness and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog, constraints, freshness
from .registry import Tables, query

AS_OF = "2024-02-05"

# Frequency rules (index, frequency, other, exact) in list order.
RULES = [
    ("click_user_7", "Bi-annually", "10", 1),
    ("click_user_1", "Daily", "No", 0),
    ("click_", "Daily", "Yes", 0),
    ("view_user_1", "Weekly", "Friday", 0),
    ("view_", "Weekly", "Monday", 0),
    ("signup_user_2", "Monthly", "3", 0),
    ("signup_", "Monthly", "10", 0),
    ("purchase_user_12", "Yearly", "1", 1),
    ("purchase_user_1", "Quarterly", "20", 0),
]
RULE_VALUES = ", ".join(f"('{i}', '{f}', '{o}', {e}, {p})" for p, (i, f, o, e) in enumerate(RULES))
RULE_SQL = f"""rules(index_, frequency, other, exact, position) AS (VALUES {RULE_VALUES}),
named AS (SELECT event_type || '_user_' || user_id AS table_name, CAST(ts AS DATE) AS date,
  ts + CAST(user_id % 5 AS INTEGER) * INTERVAL 1 DAY AS created_at FROM events)"""
FACT_SQL = f"""{RULE_SQL},
facts AS (SELECT table_name, max(date) AS latest_date, arg_max(created_at, (date, created_at)) AS last_update FROM named GROUP BY 1),
matched AS (SELECT table_name, arg_min(r.frequency, r.position) AS frequency, arg_min(r.other, r.position) AS other FROM facts f JOIN rules r
  ON (r.exact = 1 AND r.index_ = table_name) OR (r.exact = 0 AND starts_with(table_name, r.index_)) GROUP BY 1),
wide AS (SELECT f.table_name, split_part(f.table_name, '_', 1) || '_user' AS category, split_part(f.table_name, '_', 3) AS name,
  strftime(latest_date, '%Y-%m-%d') AS latest_date, strftime(last_update, '%Y-%m-%d %H:%M:%S') AS last_update, frequency, other
  FROM facts f LEFT JOIN matched m ON m.table_name = f.table_name),
catalogue AS (
  SELECT table_name, 'category' AS _key, category AS value, 'string' AS value_type FROM wide
  UNION ALL SELECT table_name, 'name', name, 'string' FROM wide
  UNION ALL SELECT table_name, 'latest_date', latest_date, 'date' FROM wide
  UNION ALL SELECT table_name, 'last_update', last_update, 'datetime' FROM wide
  UNION ALL SELECT table_name, 'frequency', frequency, 'string' FROM wide WHERE frequency IS NOT NULL
  UNION ALL SELECT table_name, 'other', other, 'string' FROM wide WHERE other IS NOT NULL)"""


def rules(t: Tables):
    rows = [(*rule, position) for position, rule in enumerate(RULES)]
    return t.spark.createDataFrame(rows, catalog.RULE_SCHEMA + ", position INT")


def named(t: Tables):
    table = F.concat_ws("_", "event_type", F.lit("user"), F.col("user_id").cast("string"))
    lag = F.make_dt_interval((F.col("user_id") % 5).cast("int"))
    return t.events.select(table.alias("series"), F.to_date("ts").alias("date"), (F.col("ts") + lag).alias("created_at"))


def catalogue(t: Tables):
    return catalog.catalogue_rows(named(t), rules(t), AS_OF)


METADATA = """
SELECT c_name AS "table", 'nation' AS key, CAST(c_nationkey AS BIGINT) AS valuei, CAST(NULL AS DOUBLE) AS valuef, CAST(NULL AS VARCHAR) AS "values" FROM customer
UNION ALL SELECT c_name, 'balance', NULL, c_acctbal, NULL FROM customer
UNION ALL SELECT c_name, 'segment', NULL, NULL, c_mktsegment FROM customer"""
UPSERTED = f"""old AS ({METADATA}),
new AS (SELECT c_name AS "table", 'balance' AS key, CAST(NULL AS BIGINT) AS valuei, CAST(NULL AS DOUBLE) AS valuef, 'closed' AS "values"
  FROM customer WHERE c_acctbal < 500),
merged AS (SELECT * FROM new UNION ALL SELECT * FROM old o WHERE NOT EXISTS
  (SELECT 1 FROM new n WHERE n."table" = o."table" AND n.key = o.key))"""


def typed(df, key, valuei=None, valuef=None, values=None):
    return df.select(
        F.col("c_name").alias("table"), F.lit(key).alias("key"), F.lit(valuei).cast("bigint").alias("valuei"),
        F.lit(None).cast("timestamp_ntz").alias("valued"), F.lit(valuef).cast("double").alias("valuef"),
        F.lit(values).cast("string").alias("values"), F.lit(AS_OF).cast("timestamp_ntz").alias("created_at"),
    )


def metadata(t: Tables):
    old = typed(t.customer, "nation", valuei=F.col("c_nationkey")).unionAll(
        typed(t.customer, "balance", valuef=F.col("c_acctbal"))
    ).unionAll(typed(t.customer, "segment", values=F.col("c_mktsegment")))
    return catalog.upsert_metadata(old, typed(t.customer.where("c_acctbal < 500"), "balance", values="closed"))


@query("typed_metadata", f'WITH {UPSERTED} SELECT * FROM merged')
def typed_metadata(t):
    return metadata(t).select("table", "key", "valuei", "valuef", "values")


@query("metadata_by_key", f"""WITH {UPSERTED} SELECT "table", coalesce(CAST(valuei AS VARCHAR), CAST(valuef AS VARCHAR), "values") AS value
FROM merged WHERE key = 'balance'""")
def metadata_by_key(t):
    return catalog.metadata_by_key(metadata(t), "balance")


@query("metadata_of_table", f"""WITH {UPSERTED} SELECT key, coalesce(CAST(valuei AS VARCHAR), CAST(valuef AS VARCHAR), "values") AS value
FROM merged WHERE "table" = 'Customer#000000007'""")
def metadata_of_table(t):
    return catalog.metadata_of_table(metadata(t), "Customer#000000007")


@query("rule_first_match", f"""WITH {RULE_SQL}, names AS (SELECT DISTINCT table_name FROM named)
SELECT n.table_name, arg_min(r.frequency, r.position) AS frequency, arg_min(r.other, r.position) AS other FROM names n LEFT JOIN rules r
  ON (r.exact = 1 AND r.index_ = table_name) OR (r.exact = 0 AND starts_with(table_name, r.index_)) GROUP BY 1""")
def rule_first_match(t):
    return catalog.first_rule(named(t).select(F.col("series").alias("table_name")), rules(t))


@query("latest_facts", f"WITH {FACT_SQL} SELECT table_name AS series, latest_date, last_update FROM facts")
def latest_facts(t):
    from ..operators.snapshot import latest_facts as facts

    return facts(named(t))


@query("catalogue_rows", f"WITH {FACT_SQL} SELECT *, TIMESTAMP '{AS_OF}' AS created_at, TIMESTAMP '{AS_OF}' AS updated_at FROM catalogue")
def catalogue_rows(t):
    return catalogue(t)


OLD_DAY = "2024-01-20"


@query("catalogue_upsert", f"""WITH {FACT_SQL},
known AS (SELECT DISTINCT table_name FROM named WHERE created_at < TIMESTAMP '{OLD_DAY}'),
gone AS (SELECT DISTINCT 'gone_user_' || user_id AS table_name FROM events)
SELECT c.table_name, c._key, c.value, c.value_type, CASE WHEN k.table_name IS NULL THEN TIMESTAMP '{AS_OF}' ELSE TIMESTAMP '{OLD_DAY}' END AS created_at,
  TIMESTAMP '{AS_OF}' AS updated_at FROM catalogue c LEFT JOIN known k ON k.table_name = c.table_name
UNION ALL SELECT table_name, 'name', 'kept', 'string', TIMESTAMP '{OLD_DAY}', TIMESTAMP '{OLD_DAY}' FROM gone""")
def catalogue_upsert(t):
    then = F.lit(OLD_DAY).cast("timestamp_ntz")
    old = catalog.catalogue_rows(named(t).where(F.col("created_at") < then), rules(t), OLD_DAY)
    gone = t.events.select(
        F.concat(F.lit("gone_user_"), F.col("user_id").cast("string")).alias("table_name"), F.lit("name").alias("_key"),
        F.lit("kept").alias("value"), F.lit("string").alias("value_type"), then.alias("created_at"), then.alias("updated_at"),
    ).distinct()
    return catalog.upsert_catalogue(old.unionByName(gone), catalogue(t))


def flag_sql(now: str) -> str:
    day = f"DATE '{now}'"
    due = f"dayofmonth({day}) <= CAST(other AS INTEGER)"
    last = "CAST(CAST(last_update AS TIMESTAMP) AS DATE)"
    weekdays = "['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday']"
    return f"""flags AS (SELECT *, abs({day} - {last}) <= 1 AS recently_updated, NOT coalesce(CASE
  WHEN frequency = 'Daily' AND other = 'Yes' THEN abs({day} - {last}) <= 1
  WHEN frequency = 'Daily' AND other = 'No' THEN CAST(latest_date AS DATE) >= CASE isodow({day} - 2) WHEN 6 THEN {day} - 3 WHEN 7 THEN {day} - 4 ELSE {day} - 2 END
  WHEN frequency = 'Weekly' THEN date_trunc('week', {day}) = date_trunc('week', {last}) OR isodow({day}) <= list_position({weekdays}, other)
  WHEN frequency = 'Monthly' THEN date_trunc('month', {day}) = date_trunc('month', {last})
    OR (((year({day}) = year({last}) AND abs(month({day}) - month({last})) = 1)
      OR (abs(year({day}) - year({last})) = 1 AND month({last}) = 12 AND month({day}) = 1)) AND {due})
  WHEN frequency = 'Quarterly' THEN date_trunc('quarter', {day}) = date_trunc('quarter', {last}) OR month({day}) % 3 <> 0 OR {due}
  WHEN frequency = 'Bi-annually' THEN (year({day}) = year({last}) AND (month({day}) <= 6) = (month({last}) <= 6)) OR month({day}) % 6 <> 0 OR {due}
  END, false) AS failed FROM wide WHERE frequency IS NOT NULL)"""


@query("freshness_flags", f"WITH {FACT_SQL}, {flag_sql('2024-02-02')} SELECT * FROM flags")
def freshness_flags(t):
    return freshness.freshness_flags(catalogue(t), "2024-02-02")


@query("freshness_flags_period_end", f"WITH {FACT_SQL}, {flag_sql('2024-06-12')} SELECT * FROM flags")
def freshness_flags_period_end(t):
    return freshness.freshness_flags(catalogue(t), "2024-06-12")


@query("freshness_report", f"""WITH {FACT_SQL}, {flag_sql('2024-02-02')},
numbered AS (SELECT *, row_number() OVER (ORDER BY table_name) - 1 AS n FROM flags WHERE failed)
SELECT 'failed' AS section, CAST(floor(n / 10) AS BIGINT) AS page, n % 10 AS line_number, table_name,
  '| ' || rpad(category || '_' || name, 60, ' ') || ' | ' || rpad(frequency, 12, ' ') || ' | ' || rpad(other, 12, ' ') || ' | ' ||
  rpad(last_update, 25, ' ') || ' | ' || rpad(latest_date, 10, ' ') || ' |' AS line FROM numbered""")
def freshness_report(t):
    return freshness.report(freshness.freshness_flags(catalogue(t), "2024-02-02"), "failed")


@query("constraint_profile", """
WITH c AS (SELECT * FROM customer),
b AS (SELECT * FROM (
  SELECT 'c_custkey' AS col, 'type' AS kind, 'int' AS value UNION ALL SELECT 'c_name', 'type', 'string' UNION ALL SELECT 'c_nationkey', 'type', 'int'
  UNION ALL SELECT 'c_acctbal', 'type', 'real' UNION ALL SELECT 'c_mktsegment', 'type', 'string'
  UNION ALL SELECT 'c_custkey', 'min', CAST(min(c_custkey) AS VARCHAR) FROM c UNION ALL SELECT 'c_custkey', 'max', CAST(max(c_custkey) AS VARCHAR) FROM c
  UNION ALL SELECT 'c_nationkey', 'min', CAST(min(c_nationkey) AS VARCHAR) FROM c UNION ALL SELECT 'c_nationkey', 'max', CAST(max(c_nationkey) AS VARCHAR) FROM c
  UNION ALL SELECT 'c_acctbal', 'min', CAST(min(c_acctbal) AS VARCHAR) FROM c UNION ALL SELECT 'c_acctbal', 'max', CAST(max(c_acctbal) AS VARCHAR) FROM c
  UNION ALL SELECT 'c_name', 'min_length', CAST(min(length(c_name)) AS VARCHAR) FROM c UNION ALL SELECT 'c_name', 'max_length', CAST(max(length(c_name)) AS VARCHAR) FROM c
  UNION ALL SELECT 'c_mktsegment', 'min_length', CAST(min(length(c_mktsegment)) AS VARCHAR) FROM c UNION ALL SELECT 'c_mktsegment', 'max_length', CAST(max(length(c_mktsegment)) AS VARCHAR) FROM c
  UNION ALL SELECT col, 'sign', CASE WHEN lo = 0 AND hi = 0 THEN 'zero' WHEN lo > 0 THEN 'positive' WHEN lo = 0 THEN 'non-negative' WHEN hi < 0 THEN 'negative' WHEN hi = 0 THEN 'non-positive' END
    FROM (SELECT 'c_custkey' AS col, CAST(min(c_custkey) AS DOUBLE) AS lo, CAST(max(c_custkey) AS DOUBLE) AS hi FROM c
          UNION ALL SELECT 'c_nationkey', min(c_nationkey), max(c_nationkey) FROM c UNION ALL SELECT 'c_acctbal', min(c_acctbal), max(c_acctbal) FROM c)
  UNION ALL SELECT col, 'max_nulls', CASE WHEN n <= 1 THEN CAST(n AS VARCHAR) END FROM (
    SELECT 'c_custkey' AS col, count(*) - count(c_custkey) AS n FROM c UNION ALL SELECT 'c_name', count(*) - count(c_name) FROM c
    UNION ALL SELECT 'c_nationkey', count(*) - count(c_nationkey) FROM c UNION ALL SELECT 'c_acctbal', count(*) - count(c_acctbal) FROM c
    UNION ALL SELECT 'c_mktsegment', count(*) - count(c_mktsegment) FROM c)
  UNION ALL SELECT col, 'no_duplicates', CASE WHEN d = n AND d > 1 THEN 'true' END FROM (
    SELECT 'c_custkey' AS col, count(DISTINCT c_custkey) AS d, count(c_custkey) AS n FROM c UNION ALL SELECT 'c_name', count(DISTINCT c_name), count(c_name) FROM c
    UNION ALL SELECT 'c_nationkey', count(DISTINCT c_nationkey), count(c_nationkey) FROM c UNION ALL SELECT 'c_mktsegment', count(DISTINCT c_mktsegment), count(c_mktsegment) FROM c)
  UNION ALL SELECT 'c_mktsegment', 'allowed_values', '["' || string_agg(DISTINCT c_mktsegment, '","' ORDER BY c_mktsegment) || '"]' FROM c)
WHERE value IS NOT NULL)
SELECT col AS "column", kind, value FROM b""")
def constraint_profile(t):
    return constraints.discover(t.customer)


def _verify_sql(column: str, kind: str) -> str:
    """What verifying the constraints of the early orders gives for one column of all orders."""
    c = f"length({column})" if kind == "string" else column
    suffix = "_length" if kind == "string" else ""
    parts = {
        "type": "count(*) * 0", "max_nulls": "count(*) * 0",
        f"min{suffix}": f"count(*) FILTER ({c} < (SELECT min({c}) FROM early))", f"max{suffix}": f"count(*) FILTER ({c} > (SELECT max({c}) FROM early))",
    }
    if kind in ("int", "real"):
        lowest = f"(SELECT min({c}) FROM early)"
        parts["sign"] = f"CASE WHEN any_value({lowest}) > 0 THEN count(*) FILTER ({c} <= 0) ELSE count(*) FILTER ({c} < 0) END"
    if kind == "string":
        parts["allowed_values"] = f"count(*) FILTER ({column} NOT IN (SELECT {column} FROM early))"
    if column == "o_orderkey":
        parts["no_duplicates"] = f"count({column}) - count(DISTINCT {column})"
    return " UNION ALL ".join(f"SELECT '{column}' AS col, '{name}' AS kind, {sql} AS violations FROM orders" for name, sql in parts.items())


ORDER_KINDS = {
    "o_orderkey": "int", "o_custkey": "int", "o_orderstatus": "string", "o_totalprice": "real", "o_orderdate": "date", "o_orderpriority": "string",
}


@query("constraint_verify", f"""
WITH early AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
r AS ({' UNION ALL '.join(_verify_sql(*c) for c in ORDER_KINDS.items())})
SELECT col AS "column", kind, violations, violations = 0 AS passed FROM r""")
def constraint_verify(t):
    """All constraints of the orders before 1998, checked on all orders."""
    early = t.orders.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return constraints.verify(t.orders, constraints.discover(early)).select("column", "kind", "violations", "passed")


@query("schema_check", """
SELECT o_custkey, o_totalprice, o_orderpriority, coalesce(CASE WHEN length(o_orderpriority) <> 8 THEN 'length of o_orderpriority' END,
  CASE WHEN count(*) OVER (PARTITION BY o_custkey) > 1 THEN 'repeated key' END) AS reason FROM orders""")
def schema_check(t):
    return constraints.schema_check(
        t.orders.select("o_custkey", "o_totalprice", "o_orderpriority"), ["o_custkey"], ["o_totalprice"], {"o_orderpriority": 8}
    )
