"""Profiles per append, the schema check of suspects, commits of several targets, payloads without a schema, and plug-in sources."""

import datetime as dt
import random
from collections import Counter

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual

from sparkseries.functions import variants
from sparkseries.operators import constraints, profiles
from sparkseries.plans import runner, together
from sparkseries.sources import plugin
from sparkseries.sources.registry import Source
from sparkseries.sources.targets import Target

SCHEMA = "id LONG, code STRING, kind STRING, amount DOUBLE, day DATE, flag BOOLEAN"


def rows(rng, ids):
    return [(i, f"c{i:04d}" if i % 9 else None, rng.choice(["x", "y", None]), rng.choice([0.0, 1.5, float("nan"), 7.25]), dt.date(2024, 1, 1 + i % 28), i % 2 == 0)
            for i in ids]


def told(df):
    return rows_of(df, "column", "kind", "value")


def test_profiles_tell_what_discovery_tells(spark, tmp_path):
    """Appends with new values, with values between the old ones, with a repeated one, with none; a batch that comes twice counts once."""
    rng, path, every = random.Random(1), str(tmp_path / "profiles"), []
    for number, ids in enumerate((range(0, 40, 2), range(1, 41, 2), range(50, 60), [], [52, 70])):
        batch = rows(rng, ids)
        before = spark.createDataFrame(every, SCHEMA)
        every += batch
        for _time in range(2 if number == 1 else 1):
            found = profiles.append_profile(spark, path, f"b{number}", spark.createDataFrame(batch, SCHEMA), before)
        assert told(found) == told(constraints.discover(spark.createDataFrame(every, SCHEMA))), number


def test_an_append_with_new_values_reads_its_own_rows_only(spark, tmp_path):
    path, rng = str(tmp_path / "profiles"), random.Random(2)
    for number in range(3):
        batch = spark.createDataFrame(rows(rng, range(100 * number, 100 * number + 30)), SCHEMA)
        # Rows stored before are not even given.
        found = profiles.append_profile(spark, path, f"b{number}", batch)
    assert ("id", "no_duplicates", "true") in told(found) and ("code", "no_duplicates", "true") in told(found)


@pytest.mark.parametrize("bits", [6, 24])
def test_schema_check_by_hand(spark, bits):
    rng = random.Random(bits)
    data = [(rng.choice([None, rng.randrange(60), 1000]) if rng.random() < 0.6 else 5000 + n, rng.choice(["a", "b"]), n) for n in range(300)]
    df = spark.createDataFrame(data, "k LONG, l STRING, n LONG")
    copies = Counter((k, letter) for k, letter, _n in data if k is not None)
    expected = sorted((n, "null k" if k is None else "repeated key" if copies[k, letter] > 1 else None) for k, letter, n in data)
    found = constraints.schema_check(df, ["k", "l"], bits=bits)
    assert sorted((r["n"], r["reason"]) for r in found.collect()) == expected


def test_schema_check_of_single_keys_shuffles_no_rows(spark):
    df = spark.range(1000).withColumn("text", F.lit("x" * 50))
    found = constraints.schema_check(df, ["id"])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert found.where(F.col("reason").isNotNull()).count() == 0
        plan = found.where(~F.col("text").isNull())._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert constraints.schema_check(df.limit(0), ["id"]).count() == 0
    assert "BroadcastHashJoin" in plan


def test_a_hot_key_is_not_joined_by_shuffle(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    found = constraints.schema_check(df, ["k"])
    assert found.where("reason = 'repeated key'").count() == 1000 and found.where("reason IS NULL").count() == 2000


def test_together_with_merges(spark, tmp_path):
    path = str(tmp_path / "store")
    schema = "date DATE, value DOUBLE, created_at TIMESTAMP_NTZ"
    like = {"a": spark.createDataFrame([], schema), "b": spark.createDataFrame([], schema)}
    for n in range(5):
        frame = spark.createDataFrame([(dt.date(2024, 1, 1 + m), float(m), None) for m in range(n + 1)], schema)
        together.export_together(spark, path, {"a": frame, "b": frame.where("value > 1")}, "2024-02-01 00:00:00", "r", n)
        together.merge_together(spark, path, like)
    found = together.read_together(spark, path, ["a", "b"], like)
    assert rows_of(found["a"], "value") == [(float(n),) for n in range(5)] and rows_of(found["b"], "value") == [(2.0,), (3.0,), (4.0,)]


def test_first_error_of_ingests_together(spark, tmp_path):
    frame = spark.range(3)
    good = runner.Ingest("good", [Source("rows", read=lambda _s: frame)], [Target("good", "parquet", str(tmp_path / "good"))], lambda f: {"good": f["rows"]})
    bad = runner.Ingest("bad", [Source("rows", read=lambda _s: frame)], [Target("bad", "no-such-format", "x")], lambda f: {"bad": f["rows"]})
    with pytest.raises(ValueError):
        runner.run_all(spark, lambda: [good, bad], "2024-01-01", together=2)
    runs = runner.run_all(spark, lambda: [bad, good], "2024-01-01", together=2, on_error="continue")
    assert [r.name for r in runs] == ["bad", "good"] and [r.entries[0][2] for r in runs] == ["failed", "written"]


@pytest.mark.parametrize("body, records", [
    ('[{"a": 1}, {"a": 2.5, "b": "x"}]', [(1.0, None), (2.5, "x")]), ('{"a": [1, 2], "b": ["x"]}', [(1.0, "x"), (2.0, None)]), ('{"a": 3, "b": null}', [(3.0, None)]),
    ('{"a": [], "b": []}', []), ("[]", []), ("no json", []), (None, []), ('[1, "x", null]', []), ('{"a": 4, "b": ["not", "lists", "only"]}', [(4.0, None)]),
])
def test_shapes_of_payloads(spark, body, records):
    found = variants.variant_records(spark.createDataFrame([(body, 7)], "body STRING, n INT"))
    typed = variants.typed_records(found, fields={"a": "DOUBLE", "b": "STRING"})
    assert [r["n"] for r in typed.collect()] == [7] * len(records)
    got = [(r["a"], None if r["b"] and r["b"].startswith("[") else r["b"]) for r in typed.collect()]
    assert got == records


def test_fields_in_common(spark):
    bodies = [('{"a": 1, "b": true, "c": "x"}',), ('[{"a": 2, "c": 5}, {"d": {"e": [1]}}]',), ('{"data": [{"z": 1}]}',)]
    found = variants.variant_records(spark.createDataFrame(bodies[:2], "body STRING"))
    kinds = variants.fields_in_common(found)
    assert kinds["a"] == "BIGINT" and kinds["b"] == "BOOLEAN" and kinds["c"] == "VARIANT" and kinds["d"] == "VARIANT"
    inner = variants.variant_records(spark.createDataFrame(bodies[2:], "body STRING"), under="data")
    assert [r["z"] for r in variants.typed_records(inner).collect()] == [1]


D = dt.date(2024, 1, 10)


def test_days_of_a_plugin():
    first, last = D, D + 9 * plugin.ONE
    runs = plugin.dealt(first, last, 4)
    assert [d for r in runs for d in r] == [first + n * plugin.ONE for n in range(10)] and len(runs) == 4
    assert plugin.dealt(last, first, 4) == [] and len(plugin.dealt(first, first, 4)) == 1
    day = D + 3 * plugin.ONE
    cases = {EqualTo: (day, day), GreaterThan: (day + plugin.ONE, last), GreaterThanOrEqual: (day, last), LessThan: (first, day - plugin.ONE), LessThanOrEqual: (first, day)}
    for kind, expected in cases.items():
        assert plugin.narrowed(first, last, kind(("date",), day), "date") == expected
        assert plugin.narrowed(first, last, kind(("other",), day), "date") is None
    assert plugin.narrowed(first, last, EqualTo(("date",), "text"), "date") is None


def test_plugin_reads_the_days_asked_for(spark, tmp_path):
    """As many tasks as wanted, a date filter that chooses the days, other filters left to Spark, and a stream that goes on where it stopped."""
    seen = tmp_path / "seen"
    seen.mkdir()
    last = tmp_path / "last"
    last.write_text("2024-01-12")

    def days(_options):
        return D, dt.date.fromisoformat(last.read_text())

    def of_day(day, _options):
        (seen / day.isoformat()).touch()
        for n in range(3):
            yield day, n

    plugin.register_dated_source(spark, plugin.dated_source("three_a_day", "date DATE, n INT", days, of_day))
    frame = spark.read.format("three_a_day").option("tasks", 2).load()
    assert frame.rdd.getNumPartitions() == 2 and frame.count() == 9
    for file in seen.iterdir():
        file.unlink()
    some = frame.where("date >= DATE'2024-01-11' AND date < DATE'2024-01-12' AND n > 0")
    assert rows_of(some) == [(dt.date(2024, 1, 11), 1), (dt.date(2024, 1, 11), 2)]
    assert [f.name for f in seen.iterdir()] == ["2024-01-11"]
    assert frame.where("date > DATE'2030-01-01'").count() == 0
    for day in ("2024-01-12", "2024-01-13"):
        last.write_text(day)
        stream = spark.readStream.format("three_a_day").load().writeStream.option("checkpointLocation", str(tmp_path / "state"))
        stream.trigger(availableNow=True).start(str(tmp_path / "out"), format="parquet").awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("date").count().where("count <> 3").count() == 0
    assert spark.read.parquet(str(tmp_path / "out")).count() == 12
