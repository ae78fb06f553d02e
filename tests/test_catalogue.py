import datetime as dt

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from sparkseries.operators import catalog, constraints, freshness

NOW = "2024-04-02 00:00:00"
RULES = catalog.RULE_SCHEMA + ", position INT"


def test_typed_metadata(spark):
    first = catalog.metadata_rows(spark, "table", {"foo": "3434", "bar": 232, "pow": 1.55, "skip": [1], "flag": True}, NOW)
    second = catalog.metadata_rows(spark, "table2", {"foo": "3434", "bar": 234, "pow": 1.55}, NOW)
    stored = catalog.upsert_metadata(first, second)
    assert dict(rows_of(catalog.metadata_of_table(stored, "table"))) == {"foo": "3434", "bar": "232", "pow": "1.55", "flag": "1"}
    assert dict(rows_of(catalog.metadata_by_key(stored, "bar"))) == {"table": "232", "table2": "234"}


def test_a_write_replaces_the_whole_row(spark):
    old = catalog.metadata_rows(spark, "t", {"k": 1, "other": 2}, NOW)
    stored = catalog.upsert_metadata(old, catalog.metadata_rows(spark, "t", {"k": "text"}, NOW))
    assert rows_of(stored, "key", "valuei", "values") == [("k", None, "text"), ("other", 2, None)]


def test_catalogue_of_one_index(spark, tmp_path):
    (tmp_path / "rules.json").write_text('[{"index": "mock_category_mock_name", "frequency": "Daily", "other": "No", "exact": 1}]')
    rules = catalog.load_rules(spark, str(tmp_path / "rules.json"))
    index = spark.createDataFrame(
        [("mock_category_mock_name", dt.date(2024, 3, 31), dt.datetime(2024, 4, 1, 23, 2, 9)), ("_metadata", dt.date(2024, 3, 31), None)],
        "series STRING, date DATE, created_at TIMESTAMP_NTZ",
    )
    rows = catalog.catalogue_rows(index, rules, NOW)
    assert dict(rows_of(rows, "_key", "value")) == {
        "category": "mock_category", "name": "mock_name", "latest_date": "2024-03-31", "last_update": "2024-04-01 23:02:09",
        "frequency": "Daily", "other": "No",
    }
    changed = rows.where("_key = 'latest_date'").withColumns(
        {"value": F.lit("2000-1-1"), "updated_at": F.lit("2024-05-01").cast("timestamp_ntz"), "created_at": F.lit("2024-05-01").cast("timestamp_ntz")}
    )
    updated = catalog.upsert_catalogue(rows, changed)
    assert updated.count() == 6
    assert rows_of(updated.where("_key = 'latest_date'"), "value", "created_at", "updated_at") == [
        ("2000-1-1", dt.datetime(2024, 4, 2), dt.datetime(2024, 5, 1))
    ]
    assert catalog.empty_catalogue(spark).count() == 0
    assert catalog.load_rules(spark, str(tmp_path / "absent.json")).count() == 0


def test_rule_order_decides(spark):
    rules = spark.createDataFrame(
        [("ab", "prefix", "x", 0, 0), ("abc", "exact", "x", 1, 1), ("b", "exact only", "x", 1, 2), ("", "any", "x", 0, 3)], RULES
    )
    names = spark.createDataFrame([("abc",), ("abd",), ("b",), ("bc",)], "table_name STRING")
    assert rows_of(catalog.first_rule(names, rules), "table_name", "frequency") == [
        ("abc", "prefix"), ("abd", "prefix"), ("b", "exact only"), ("bc", "any"),
    ]


@pytest.mark.parametrize(
    "now, latest, updated, frequency, other, expected",
    [
        ("2024-03-06", "2024-01-01", "2024-03-05", "Daily", "Yes", True),
        ("2024-03-06", "2024-01-01", "2024-03-04", "Daily", "Yes", False),
        ("2024-03-04", "2024-03-01", "2024-01-01", "Daily", "No", True),     # Monday: Friday will do
        ("2024-03-04", "2024-02-29", "2024-01-01", "Daily", "No", False),
        ("2024-03-06", "2024-03-06", "2024-03-06", "Daily", "Maybe", False),
        ("2025-01-02", "2024-01-01", "2024-12-30", "Weekly", "Monday", True),  # one ISO week over the year end
        ("2024-03-06", "2024-01-01", "2024-02-01", "Weekly", "Wednesday", True),
        ("2024-03-07", "2024-01-01", "2024-02-01", "Weekly", "Wednesday", False),
        ("2024-03-31", "2024-01-01", "2024-03-01", "Monthly", "5", True),
        ("2025-01-05", "2024-01-01", "2024-12-01", "Monthly", "5", True),
        ("2025-01-06", "2024-01-01", "2024-12-01", "Monthly", "5", False),
        ("2024-03-05", "2024-01-01", "2024-01-31", "Monthly", "5", False),
        ("2024-03-31", "2024-01-01", "2024-01-01", "Quarterly", "5", True),
        ("2024-05-31", "2024-01-01", "2024-01-01", "Quarterly", "5", True),
        ("2024-06-05", "2024-01-01", "2024-01-01", "Quarterly", "5", True),
        ("2024-06-06", "2024-01-01", "2024-01-01", "Quarterly", "5", False),
        ("2024-06-06", "2024-01-01", "2024-01-01", "Bi-annually", "5", True),
        ("2024-11-30", "2024-01-01", "2024-01-01", "Bi-annually", "5", True),
        ("2024-12-06", "2024-01-01", "2024-01-01", "Bi-annually", "5", False),
        ("2024-12-05", "2024-01-01", "2024-01-01", "Bi-annually", "5", True),
        ("2024-12-05", "2024-12-05", "2024-12-05", "Yearly", "5", False),
    ],
)
def test_freshness_rules(spark, now, latest, updated, frequency, other, expected):
    row = spark.createDataFrame([(dt.date.fromisoformat(latest), dt.date.fromisoformat(updated), frequency, other)],
                                "l DATE, u DATE, f STRING, o STRING")
    met = row.select(freshness.on_time(now, F.col("l"), F.col("u"), F.col("f"), F.col("o")))
    assert met.first()[0] is expected


def test_report_pages(spark):
    rows = [(f"cat_x_{i:02d}", key, value) for i in range(23) for key, value in (
        ("category", "cat_x"), ("name", f"{i:02d}"), ("latest_date", "2020-01-01"), ("last_update", "2020-01-01 00:00:00"),
        ("frequency", "Daily"), ("other", "Yes"))]
    flags = freshness.freshness_flags(spark.createDataFrame(rows, "table_name STRING, _key STRING, value STRING"), "2024-01-01")
    lines = freshness.report(flags, "failed")
    assert [tuple(r) for r in lines.groupBy("page").count().orderBy("page").collect()] == [(0, 10), (1, 10), (2, 3)]
    first = lines.where("table_name = 'cat_x_00'").first()["line"]
    assert len(first) == len(freshness.report_header()) and first.startswith("| cat_x_00 ")


def customers(spark, rows):
    return spark.createDataFrame(rows, "id BIGINT, kind STRING, amount DOUBLE, seen DATE")


def test_discover(spark):
    df = customers(spark, [(1, "a", 0.0, dt.date(2024, 1, 1)), (2, "b", 2.5, None), (3, "a", float("nan"), None)])
    found = {(r["column"], r["kind"]): r["value"] for r in constraints.discover(df).collect()}
    assert found == {
        ("id", "type"): "int", ("id", "min"): "1", ("id", "max"): "3", ("id", "sign"): "positive", ("id", "max_nulls"): "0",
        ("id", "no_duplicates"): "true",
        ("kind", "type"): "string", ("kind", "min_length"): "1", ("kind", "max_length"): "1", ("kind", "max_nulls"): "0",
        ("kind", "allowed_values"): '["a","b"]',
        ("amount", "type"): "real", ("amount", "min"): "0.0", ("amount", "max"): "2.5", ("amount", "sign"): "non-negative",
        ("amount", "max_nulls"): "1",
        ("seen", "type"): "date", ("seen", "min"): "2024-01-01", ("seen", "max"): "2024-01-01",
    }


def test_many_values_are_not_listed(spark):
    df = spark.range(50).select(F.concat(F.lit("v"), F.col("id")).alias("s"))
    kinds = {r["kind"] for r in constraints.discover(df).collect()}
    assert "allowed_values" not in kinds and "no_duplicates" in kinds


def test_verify_counts_every_kind(spark):
    found = constraints.discover(customers(spark, [(1, "a", 1.0, dt.date(2024, 1, 1)), (2, "b", 2.5, dt.date(2024, 1, 2))]))
    bad = customers(spark, [(0, "abc", -1.0, dt.date(2023, 1, 1)), (2, None, 9.0, None), (2, "a", 1.0, dt.date(2025, 1, 1))])
    report = {(r["column"], r["kind"]): r["violations"] for r in constraints.verify(bad, found).collect()}
    assert {key: n for key, n in report.items() if n} == {
        ("id", "min"): 1, ("id", "sign"): 1, ("id", "no_duplicates"): 1, ("kind", "max_length"): 1, ("kind", "allowed_values"): 1,
        ("kind", "max_nulls"): 1, ("amount", "min"): 1, ("amount", "max"): 1, ("amount", "sign"): 1,
        ("seen", "min"): 1, ("seen", "max"): 1, ("seen", "max_nulls"): 1,
    }
    with pytest.raises(constraints.ConstraintViolation):
        constraints.assert_verified(constraints.verify(bad, found))
    typed = constraints.verify(bad.withColumn("id", F.col("id").cast("string")), found.where("kind = 'type'"))
    assert rows_of(typed.where("NOT passed"), "column") == [("id",)]


def test_stored_constraints_are_found_first(spark, tmp_path):
    path = str(tmp_path / "constraints")
    good = customers(spark, [(1, "a", 1.0, dt.date(2024, 1, 1)), (2, "b", 2.5, dt.date(2024, 1, 2))])
    constraints.assert_verified(constraints.verify_stored(good, path))
    later = good.withColumn("amount", F.lit(100.0))
    assert constraints.verify_stored(later, path).where("NOT passed").count() == 1


def test_schema_check(spark):
    good, long = "x" * 36, "2024-01-01"
    df = spark.createDataFrame(
        [(good, long, 1), ("1", long, 1), ("y" * 36, long, None), ("z" * 36, long, 1), ("z" * 36, long, 2), (None, long, 1)],
        "id STRING, date_value STRING, value BIGINT",
    )
    reasons = constraints.schema_check(df, ["id"], ["value"], {"id": 36, "date_value": 10}).select("reason")
    assert sorted(r[0] or "" for r in reasons.collect()) == ["", "length of id", "null id", "null value", "repeated key", "repeated key"]


def test_writers(spark):
    admins = spark.createDataFrame([("w1",), (None,)], "wallet STRING")
    batch = spark.createDataFrame([("w1", 1), ("w2", 2), (None, 3)], "writer STRING, v INT")
    assert rows_of(constraints.writer_gate(batch, admins), "v") == [(2,), (3,)]
    with pytest.raises(PermissionError, match="w2"):
        constraints.require_writer(batch.where("v = 2"), admins)
    assert constraints.require_writer(batch.where("v = 1"), admins).count() == 1
