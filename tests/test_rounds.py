from conftest import rows_of
from pyspark.sql import functions as F

from sparkseries.operators import rounds


def settle(spark, submissions, triggers, votes, stakes, bounty=1_000_000_000):
    return rows_of(rounds.settlement(
        spark.createDataFrame(submissions, "round INT, key STRING"),
        spark.createDataFrame(triggers, "round INT, key STRING"),
        spark.createDataFrame(votes, "round INT, key STRING, is_valid BOOLEAN"),
        spark.createDataFrame(stakes, "key STRING, stake BIGINT"),
        F.lit(bounty),
    ), "round", "key", "amount")


def test_settlement_of_the_example_state(spark):
    paid = settle(spark, [(1, "a"), (1, "b")], [(1, "a"), (1, "b")], [(1, "a", False), (1, "b", True)], [("a", 20_000_000_000), ("b", 20_000_000_000)])
    assert paid == [(1, "a", -14_000_000_000.0), (1, "b", 1_000_000_000.0)]


def test_settlement_branches(spark):
    keys = ["free", "no votes", "tie", "bad", "good"]
    submissions = [(1, k) for k in keys] + [(2, "free")]
    triggers = [(1, k) for k in keys[1:]]
    votes = [(1, "tie", True), (1, "tie", False), (1, "bad", False), (1, "bad", False), (1, "bad", True), (1, "good", True)]
    paid = settle(spark, submissions, triggers, votes, [(k, 100) for k in keys], 101)
    assert paid == [(1, "bad", -70.0), (1, "free", 50.0), (1, "good", 50.0), (1, "no votes", -70.0), (2, "free", 101.0)]


def test_settlement_without_submissions_or_eligible(spark):
    assert settle(spark, [], [], [], []) == []
    assert settle(spark, [(1, "a")], [(1, "a")], [], [("a", 10)]) == [(1, "a", -7.0)]


def test_status_walk(spark):
    schema = "round INT, status STRING"
    records = spark.createDataFrame(
        [(5, rounds.UNINITIALIZED), (4, rounds.FAILED), (3, rounds.PAID), (2, rounds.FAILED), (6, rounds.FAILED)], schema
    )
    assert tuple(rounds.latest_success(records).first()) == (3, 5)
    assert rows_of(rounds.open_rounds(records)) == [(4, rounds.FAILED), (5, rounds.UNINITIALIZED), (6, rounds.FAILED)]
    none = spark.createDataFrame([(2, rounds.FAILED)], schema)
    assert tuple(rounds.latest_success(none).first()) == (None, 0)
    assert rows_of(rounds.open_rounds(none)) == [(2, rounds.FAILED)]


def test_latest_submission_and_zero_key(spark):
    df = spark.createDataFrame([(1, "b", 9), (1, "a", 9), (1, "c", 3)], "round INT, key STRING, slot INT")
    assert rows_of(rounds.latest_submission(df)) == [(1, "a", 9)]
    amounts = spark.createDataFrame([("x", 5), ("z", 0), ("y", 0)], "key STRING, value INT")
    assert rounds.zero_key(amounts).first()["key"] == "y"


LINKS = "cid STRING, prev_cid STRING"


def walk(spark, links, starts, **kwargs):
    walked = rounds.walk_chains(spark.createDataFrame(links, LINKS), spark.createDataFrame(starts, "cid STRING, round INT"), **kwargs)
    return rows_of(walked, "start", "round", "cid")


def test_chain_ends_at_the_missing_link(spark):
    links = [("c", "b"), ("b", "a"), ("a", None)]
    assert walk(spark, links, [("c", 9)]) == [("c", 8, "b"), ("c", 9, "c")]
    assert walk(spark, links, [("c", 9)], include_root=True) == [("c", 7, "a"), ("c", 8, "b"), ("c", 9, "c")]


def test_chain_ends_at_unknown_payload_and_bound(spark):
    assert walk(spark, [("c", "lost")], [("c", 9)]) == [("c", 9, "c")]
    links = [(f"p{n:03d}", f"p{n - 1:03d}" if n else None) for n in range(200)]
    walked = walk(spark, links, [("p199", 199)], bound=120)
    assert [r for _s, r, _c in walked] == list(range(120, 200))


def test_cycle_stops_at_the_bound(spark):
    assert walk(spark, [("a", "b"), ("b", "a")], [("a", 4)]) == [
        ("a", 0, "a"), ("a", 1, "b"), ("a", 2, "a"), ("a", 3, "b"), ("a", 4, "a"),
    ]


def test_walks_may_share_payloads(spark):
    links = [("x", "root"), ("y", "root"), ("root", "base"), ("base", None)]
    assert walk(spark, links, [("x", 3), ("y", 7)]) == [("x", 2, "root"), ("x", 3, "x"), ("y", 6, "root"), ("y", 7, "y")]


def test_averages(spark):
    schema = "round INT, locationSummary ARRAY<STRUCT<location: STRING, data: MAP<STRING, DOUBLE>>>"
    scrapes = spark.createDataFrame(
        [(1, [("Denver", {"Economy": 10.0, "Compact": 20.0}), ("Boston", {})]), (1, [("Denver", {"Economy": 20.0})])], schema
    )
    assert rows_of(rounds.round_average(rounds.scrape_prices(scrapes))) == [(1, "Denver", "Compact", 20.0), (1, "Denver", "Economy", 15.0)]


def test_wide_table(spark, tmp_path):
    prices = spark.createDataFrame([(1, "Denver", "Economy", 10.0), (2, "Washington, D.C.", "Standard SUV", 5.0)],
                                   "round INT, city STRING, category STRING, price DOUBLE")
    wide = rounds.wide_rounds(prices)
    assert len(wide.columns) == 41
    row = wide.where("round = 2").first()
    assert row["Washington, D.C.-Standard SUV"] == 5.0 and row["Denver-Economy"] is None
    wide.coalesce(1).write.option("header", True).csv(str(tmp_path / "wide"))
    assert spark.read.option("header", True).csv(str(tmp_path / "wide")).columns == wide.columns


def test_fill_unfinished(spark):
    current = spark.createDataFrame([(5, 1.0)], "round INT, price DOUBLE")
    data = spark.createDataFrame([(3, 3.0), (4, 4.0), (5, 9.0)], "round INT, price DOUBLE")
    audits = spark.createDataFrame([(3, rounds.PAID), (4, rounds.FAILED), (5, rounds.PAID)], "round INT, status STRING")
    unfinished = spark.createDataFrame([(3,), (4,), (5,)], "round INT")
    assert rows_of(rounds.fill_unfinished(current, unfinished, audits, data)) == [(3, 3.0), (5, 1.0)]


def test_samples_repeat(spark):
    df = spark.range(300).select((F.col("id") % 3).alias("round"), F.col("id").alias("key"))
    sample = rounds.audit_sample(df, "s")
    assert rows_of(sample) == rows_of(rounds.audit_sample(df.unionAll(df), "s"))
    assert rows_of(sample.groupBy("round").count(), "count") == [(5,), (5,), (5,)]
    assert rounds.proof_draws(df, "s").count() == 12


def test_recent_rounds(spark):
    df = spark.range(12, 31).select(F.col("id").cast("int").alias("round"))
    assert [r[0] for r in rounds.recent_rounds(df).orderBy("round").collect()] == list(range(23, 31))
    assert [r[0] for r in rounds.recent_rounds(df.where("round < 17")).orderBy("round").collect()] == [14, 15, 16]


def test_round_prefix(spark):
    df = spark.createDataFrame([("scrape:1:5",), ("scrape:11:5",), ("scrapeCid:1:5",)], "id STRING")
    assert rows_of(rounds.records_of_round(df, "scrape", 1)) == [("scrape:1:5",)]
    assert rows_of(rounds.records_of_round(df, "scrapeCid", 1)) == [("scrapeCid:1:5",)]


def test_scraped_prices(spark):
    row = '<tr><td class="name"> {} </td><td class="price">{}</td></tr>'
    html = "<table>" + row.format("Economy", "$10") + row.format("Van", "$99") + row.format("Economy", "$12.5/day") + row.format("Compact", "n/a") + "</table>"
    pages = spark.createDataFrame([(1, "Denver", html), (2, "Boston", "no table")], "round INT, location STRING, html STRING")
    prices = rounds.scraped_prices(pages, ["round", "location"], "html", r"(?s)<tr>.*?</tr>", r'class="name">([^<]*)<', r'class="price">([^<]*)<')
    assert rows_of(prices) == [(1, "Denver", "Compact", None), (1, "Denver", "Economy", 12.5)]


def test_first_zero_key(spark):
    from sparkseries.functions.payload import first_zero_key

    maps = spark.createDataFrame([({"a": 1, "b": 0},), ({"a": 1},)], "m MAP<STRING, INT>")
    assert [r[0] for r in maps.select(first_zero_key(F.col("m"))).collect()] == ["b", None]
