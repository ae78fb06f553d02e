"""Crowd-sourced price rounds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text, times
from ..operators import rounds
from .registry import Tables, query

VOTES = """votes AS (SELECT CAST(ts AS DATE) AS round, user_id AS key, event_type = 'click' AS is_valid FROM events
  WHERE event_type IN ('click', 'error', 'purchase'))"""


def votes(t: Tables):
    cast = t.events.where(F.col("event_type").isin("click", "error", "purchase"))
    return cast.select(
        F.to_date("ts").alias("round"), F.col("user_id").alias("key"), (F.col("event_type") == "click").alias("is_valid")
    )


@query("vote_tally", f"WITH {VOTES} SELECT round, key, CAST(sum(CASE WHEN is_valid THEN 1 ELSE -1 END) AS BIGINT) AS net, "
       "count(*) AS votes FROM votes GROUP BY ALL")
def vote_tally(t):
    return rounds.vote_tally(votes(t))


@query("round_settlement", f"""
WITH {VOTES},
submissions AS (SELECT DISTINCT CAST(ts AS DATE) AS round, user_id AS key FROM events),
triggers AS (SELECT DISTINCT CAST(ts AS DATE) AS round, user_id AS key FROM events WHERE event_type IN ('error', 'view')),
tally AS (SELECT round, key, sum(CASE WHEN is_valid THEN 1 ELSE -1 END) AS net, count(*) AS n FROM votes GROUP BY ALL),
judged AS (SELECT s.round, s.key, CASE WHEN tr.key IS NULL OR t.net > 0 THEN 'reward'
    WHEN coalesce(t.n, 0) = 0 OR t.net < 0 THEN 'slash' END AS outcome
  FROM submissions s LEFT JOIN triggers tr ON tr.round = s.round AND tr.key = s.key
  LEFT JOIN tally t ON t.round = s.round AND t.key = s.key)
SELECT round, key, outcome, CASE outcome
    WHEN 'reward' THEN CAST(floor((dayofmonth(round) * 1000000) / count(*) FILTER (outcome = 'reward') OVER (PARTITION BY round)) AS DOUBLE)
    ELSE -(c_acctbal * CAST(0.7 AS DOUBLE)) END AS amount
FROM judged LEFT JOIN customer ON c_custkey = key WHERE outcome IS NOT NULL""")
def round_settlement(t):
    cast = t.events.select(F.to_date("ts").alias("round"), F.col("user_id").alias("key"), "event_type")
    stakes = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("stake"))
    return rounds.settlement(
        cast, cast.where(F.col("event_type").isin("error", "view")), votes(t), stakes, F.dayofmonth("round") * 1_000_000
    )


RECORDS = """records AS (SELECT CAST(year(o_orderdate) * 12 + month(o_orderdate) AS INTEGER) AS round,
  CASE WHEN o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '1998-01-01' THEN 'PayoutSuccessful'
       WHEN o_orderstatus = 'F' THEN 'PayoutFailed' ELSE 'Uninitialized' END AS status FROM orders)"""


def records(t: Tables):
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    status = F.when((F.col("o_orderstatus") == "P") & early, rounds.PAID).when(
        F.col("o_orderstatus") == "F", rounds.FAILED
    ).otherwise(rounds.UNINITIALIZED)
    return t.orders.select((F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("round"), status.alias("status"))


@query("latest_success", f"""WITH {RECORDS} SELECT max(round) FILTER (status = 'PayoutSuccessful') AS latest_paid,
  coalesce(max(round) FILTER (status <> 'PayoutFailed'), 0) AS latest_not_failed FROM records""")
def latest_success(t):
    return rounds.latest_success(records(t))


@query("status_lists", f"""WITH {RECORDS} SELECT round, status FROM records
  WHERE round > (SELECT max(round) FROM records WHERE status = 'PayoutSuccessful') AND status <> 'PayoutSuccessful'""")
def status_lists(t):
    return rounds.open_rounds(records(t))


@query("latest_submission", """SELECT o_custkey AS round, o_orderkey AS key, o_orderdate AS slot FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""")
def latest_submission(t):
    return rounds.latest_submission(
        t.orders.select(F.col("o_custkey").alias("round"), F.col("o_orderkey").alias("key"), F.col("o_orderdate").alias("slot"))
    )


@query("zero_key", "SELECT o_custkey AS round, min(o_orderkey) FILTER (o_orderstatus = 'P') AS key FROM orders GROUP BY 1")
def zero_key(t):
    amounts = t.orders.select(
        F.col("o_custkey").alias("round"), F.col("o_orderkey").alias("key"),
        F.when(F.col("o_orderstatus") == "P", 0).otherwise(F.col("o_totalprice")).alias("value"),
    )
    return rounds.zero_key(amounts, group="round")


@query("yearly_sum", """SELECT CAST(year(l_shipdate) AS INTEGER) AS year,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM lineitem GROUP BY ALL""")
def yearly_sum(t):
    written = F.replace(F.col("l_extendedprice").cast("string"), F.lit("."), F.lit(","))
    return rounds.yearly_sum(t.lineitem.select(F.year("l_shipdate").alias("year"), written.alias("total")), "total", scale=2)


@query("round_average", """SELECT CAST(ts AS DATE) AS round, 'user ' || user_id AS location, event_type AS type,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS price FROM events GROUP BY ALL""")
def round_average(t):
    """Averages from scrapes as they are stored: JSON text with a summary per location."""
    body = F.concat(
        F.lit('{"timestamp":'), times.to_epoch_millis(F.col("ts")).cast("string"),
        F.lit(',"locationSummary":[{"location":"user '), F.col("user_id").cast("string"),
        F.lit('","data":{"'), F.col("event_type"), F.lit('":'), F.col("value").cast("string"), F.lit("}}]}"),
    )
    schema = "timestamp BIGINT, locationSummary ARRAY<STRUCT<location: STRING, data: MAP<STRING, DOUBLE>>>"
    scrapes = t.events.select(F.to_date("ts").alias("round"), F.from_json(body, schema).alias("s"))
    prices = rounds.scrape_prices(scrapes.select("round", "s.locationSummary"))
    return rounds.round_average(prices, scale=2)


KINDS = ["click", "error", "purchase", "signup", "view"]


def _pivot_sql(kind: str) -> str:
    return f"""max(price) FILTER (city = '{kind}' AND category = 'low') AS "{kind}-low",
  max(price) FILTER (city = '{kind}' AND category = 'high') AS "{kind}-high",
  strftime(max(seen) FILTER (city = '{kind}'), '%Y-%m-%d %H:%M:%S') AS "{kind}-timestamp\""""


@query("wide_pivot", f"""
WITH p AS (SELECT CAST(ts AS DATE) AS round, user_id, event_type AS city, CASE WHEN value < 10 THEN 'low' ELSE 'high' END AS category,
  max(value) AS price, max(ts) AS seen FROM events GROUP BY ALL)
SELECT round, user_id, {', '.join(map(_pivot_sql, KINDS))} FROM p GROUP BY round, user_id""")
def wide_pivot(t):
    prices = t.events.select(
        F.struct(F.to_date("ts").alias("round"), "user_id").alias("round"), F.col("event_type").alias("city"),
        F.when(F.col("value") < 10, "low").otherwise("high").alias("category"), F.col("value").alias("price"), "ts",
    )
    wide = rounds.wide_rounds(prices, KINDS, ["low", "high"], timestamp="ts")
    return wide.select("round.*", *[c for c in wide.columns if c != "round"])


@query("fill_unfinished", """
WITH paid AS (SELECT DISTINCT o_custkey AS round FROM orders WHERE o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED') AND o_custkey IN
  (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')))
SELECT o_custkey AS round, o_totalprice AS price FROM orders WHERE o_orderpriority = '1-URGENT'
UNION ALL SELECT o_custkey, o_totalprice FROM orders WHERE o_orderpriority IN ('2-HIGH', '3-MEDIUM') AND o_custkey IN (SELECT round FROM paid)
  AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def fill_unfinished(t):
    """Every order has a part: current data, unfinished rounds, or data that came later."""
    def of(*priorities):
        rows = t.orders.where(F.col("o_orderpriority").isin(*priorities))
        return rows.select(F.col("o_custkey").alias("round"), F.col("o_totalprice").alias("price"))

    paid = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    audits = t.customer.select(
        F.col("c_custkey").alias("round"), F.when(paid, rounds.PAID).otherwise(rounds.UNINITIALIZED).alias("status")
    )
    return rounds.fill_unfinished(of("1-URGENT"), of("5-LOW", "4-NOT SPECIFIED"), audits, of("2-HIGH", "3-MEDIUM"))


@query("chain_walk", """
WITH RECURSIVE links AS (SELECT DISTINCT o_orderkey AS cid, CASE WHEN o_orderkey >= 3 THEN o_orderkey // 3 END AS prev_cid FROM orders),
walk AS (SELECT o_orderkey AS start, CAST(year(o_orderdate) - 1993 AS INTEGER) AS round, o_orderkey AS cid FROM orders WHERE year(o_orderdate) >= 1993
  UNION ALL SELECT start, round - 1, prev_cid FROM walk JOIN links USING (cid) WHERE prev_cid IS NOT NULL AND round > 0)
SELECT start, round, cid FROM walk JOIN links USING (cid) WHERE prev_cid IS NOT NULL""")
def chain_walk(t):
    """A walk from every order over links that fork and meet, each link stored twice; a walk ends at the root or at round 0."""
    once = t.orders.select(
        F.col("o_orderkey").alias("cid"), F.when(F.col("o_orderkey") >= 3, F.expr("o_orderkey DIV 3")).alias("prev_cid")
    )
    starts = t.orders.select(F.col("o_orderkey").alias("cid"), (F.year("o_orderdate") - 1993).alias("round"))
    return rounds.walk_chains(once.unionAll(once), starts)


@query("chain_walk_long", """
WITH top AS (SELECT max(o_orderkey) AS m FROM orders),
start AS (SELECT o_orderkey, o_orderkey + 7 * ((m - o_orderkey) // 7) AS start FROM orders, top)
SELECT start, start - (start - o_orderkey) // 7 AS round, o_orderkey AS cid FROM start WHERE o_orderkey >= 7""")
def chain_walk_long(t):
    """Seven walks that together pass every order; the distance doubles per step."""
    key = F.col("o_orderkey")
    links = t.orders.select(key.alias("cid"), F.when(key >= 7, key - 7).alias("prev_cid"))
    newest = t.orders.agg(F.max("o_orderkey")).scalar()
    return rounds.walk_chains(links, t.orders.where(key > newest - 7).select(key.alias("cid"), key.alias("round")))


MONTH = "CAST(year(o_orderdate) * 12 + month(o_orderdate) AS INTEGER)"


@query("audit_sample", f"""SELECT round, key FROM (SELECT DISTINCT {MONTH} AS round, o_custkey AS key FROM orders)
  QUALIFY row_number() OVER (PARTITION BY round ORDER BY md5(key || 'seed'), key) <= 5""")
def audit_sample(t):
    submissions = t.orders.select((F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("round"), F.col("o_custkey").alias("key"))
    return rounds.audit_sample(submissions, "seed")


@query("proof_draws", f"""
SELECT round, CAST(draw AS INTEGER) AS draw, key FROM (SELECT {MONTH} AS round, o_orderkey AS key FROM orders), range(4) r(draw)
  QUALIFY row_number() OVER (PARTITION BY round, draw ORDER BY md5(key || 'seed' || draw), key) = 1""")
def proof_draws(t):
    proofs = t.orders.select((F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("round"), F.col("o_orderkey").alias("key"))
    return rounds.proof_draws(proofs, "seed")


@query("round_prefix", "SELECT 'scrape:' || year(o_orderdate) || ':' || o_orderkey AS id, o_totalprice FROM orders WHERE year(o_orderdate) = 1997")
def round_prefix(t):
    stored = t.orders.select(text.record_id("scrape", F.year("o_orderdate"), F.col("o_orderkey")).alias("id"), "o_totalprice")
    return rounds.records_of_round(stored, "scrape", 1997)


@query("recent_rounds", f"""WITH s AS (SELECT {MONTH} AS round, o_orderkey AS key FROM orders)
SELECT round, key FROM s WHERE round >= (SELECT max(round) - 7 FROM s)""")
def recent_rounds(t):
    return rounds.recent_rounds(
        t.orders.select((F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("round"), F.col("o_orderkey").alias("key"))
    )
