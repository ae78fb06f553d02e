import datetime as dt
import math

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from sparkseries.operators import clean, project, rounds, snapshot
from sparkseries.operators import reconcile as rec
from sparkseries.operators.numbering import number_rows

T0, T1, T2 = "2024-01-01 10:00:00", "2024-01-02 10:00:00", "2024-01-03 10:00:00"


def day(text):
    return dt.date.fromisoformat(text)


def test_reconcile_cases(series):
    base = series([("a", "2024-01-01", 1.0, T0), ("a", "2024-01-02", 2.0, T0), ("a", "2024-01-03", None, T0)])
    incoming = series([
        ("a", "2024-01-01", 1.0, T2),         # unchanged
        ("a", "2024-01-02", 2.0000001, T2),   # equal after rounding
        ("a", "2024-01-03", None, T2),        # null on both sides
        ("a", "2024-01-02", 3.0, T2),         # corrected
        ("a", "2024-01-04", 4.0, T2),         # new, twice, the earlier arrival stays
        ("a", "2024-01-04", 4.0, T1),
        ("b", "2024-01-01", 1.0, None),       # other series, no arrival time
    ])
    assert rows_of(rec.reconcile(base, incoming), "series", "date", "value", "created_at") == sorted([
        ("a", day("2024-01-02"), 3.0, dt.datetime.fromisoformat(T2)),
        ("a", day("2024-01-04"), 4.0, dt.datetime.fromisoformat(T1)),
        ("b", day("2024-01-01"), 1.0, None),
    ], key=repr)


def test_reconcile_rounds_both_sides(series):
    base = series([("a", "2024-01-01", 1.00000049, T0)])
    assert rec.reconcile(base, series([("a", "2024-01-01", 1.0, T1)])).count() == 0


def test_reconcile_empty_target_and_second_run(series):
    incoming = series([("a", "2024-01-01", 1.23456789, T0), ("a", "2024-01-01", 1.23456789, T1), ("a", None, math.nan, T0)])
    empty = incoming.limit(0)
    first = rec.reconcile(empty, incoming, prune=False)
    assert first.count() == 2
    assert rec.reconcile(first, incoming).count() == 0


def test_reconcile_is_idempotent_on_more_data(series):
    rows = [("s%d" % (i % 3), "2024-01-%02d" % (1 + i % 28), i * 0.37, T0) for i in range(200)]
    base, incoming = series(rows[:90]), series(rows)
    fresh = rec.reconcile(base, incoming)
    assert rec.reconcile(base.unionByName(fresh), incoming).count() == 0


def test_reconcile_extra_and_missing_columns(series):
    base = series([("a", "2024-01-01", 1.0, T0)])
    extra = base.withColumn("note", F.lit("x"))
    assert rec.reconcile(base, extra).columns == base.columns
    with pytest.raises(ValueError, match="lack target columns"):
        rec.reconcile(base, base.drop("value"))


def test_reconcile_shuffles_once_and_prunes_the_base(series, spark, tmp_path, capsys):
    frame = series([("a", "2024-01-01", 1.0, T0)])
    frame.write.parquet(f"{tmp_path}/base")
    rec.reconcile(spark.read.parquet(f"{tmp_path}/base"), frame).explain("formatted")
    plan = capsys.readouterr().out
    tree, details = plan.split("(1) ", 1)[0], plan.split("===== Subqueries")[0]
    assert tree.count("Exchange") == 1 and "Join" not in plan
    assert "GreaterThanOrEqual(date,2024-01-01)" in details and "LessThanOrEqual(date,2024-01-01)" in details


def test_few_values_prune_exactly(series):
    base = series([("a", "2024-01-01", 1.0, T0), ("b", "2024-01-01", 1.0, T0), (None, "2024-01-01", 1.0, T0)])
    incoming = base.where("series = 'a' OR series IS NULL")
    assert rows_of(rec.within_incoming_bounds(base, incoming, ["series"]), "series") == [("a",), (None,)]
    assert rec.within_incoming_bounds(base, incoming.where("series IS NULL"), ["series"]).count() == 1
    unrounded = series([("a", "2024-01-01", 0.1234567, T0)])
    stored = series([("a", "2024-01-01", 0.123457, T0), ("a", "2024-01-01", 0.5, T0)])
    assert rec.within_incoming_bounds(stored, unrounded, ["date", "value"]).count() == 1
    assert rec.reconcile(stored, unrounded, prune_by=("value",)).count() == 0


def test_frozen_snapshot(series):
    rows = series([
        ("a", "2024-01-01", 1.0, "2024-01-01 10:00:00"),
        ("a", "2024-01-01", 2.0, "2024-01-04 10:00:00"),   # corrected before T
        ("a", "2024-01-01", 3.0, "2024-01-09 10:00:00"),   # corrected after T
        ("a", "2024-01-08", 4.0, "2024-01-02 10:00:00"),   # future date, known early
        ("a", "2024-01-08", 5.0, "2024-01-08 23:59:59"),   # future date, last second of the day
        ("a", "2024-01-08", 6.0, "2024-01-09 00:00:00"),   # too late for its date
        ("b", "2024-01-03", 7.0, "2024-01-05 12:00:00"),   # equal arrivals: the greater value
        ("b", "2024-01-03", 8.0, "2024-01-05 12:00:00"),
    ])
    frozen = snapshot.frozen_snapshot(rows, dt.datetime(2024, 1, 5, 12))
    assert rows_of(frozen, "series", "date", "value") == [
        ("a", day("2024-01-01"), 2.0), ("a", day("2024-01-08"), 5.0), ("b", day("2024-01-03"), 8.0),
    ]


def test_later_snapshot_keeps_the_keys_of_an_earlier_one(series):
    rows = series([("s%d" % (i % 4), "2024-01-%02d" % (1 + i % 20), float(i), "2024-01-%02d 08:00:00" % (1 + i * 7 % 28)) for i in range(120)])
    early = set(rows_of(snapshot.frozen_snapshot(rows, "2024-01-08 00:00:00").where("date <= '2024-01-08'"), "series", "date"))
    late = set(rows_of(snapshot.frozen_snapshot(rows, "2024-01-20 00:00:00"), "series", "date"))
    assert early and early <= late


def test_last_write_wins(spark):
    schema = "id STRING, timestamp BIGINT, value STRING"
    stored = spark.createDataFrame([("a", 5, "old"), ("b", None, "old"), ("c", 5, "old"), ("d", 5, "old")], schema)
    incoming = spark.createDataFrame([("a", 5, "new"), ("b", None, "new"), ("c", 6, "new"), ("d", None, "new"), ("e", None, "new")], schema)
    assert rows_of(snapshot.last_write_wins(stored, incoming), "id", "value") == [
        ("a", "old"), ("b", "new"), ("c", "new"), ("d", "old"), ("e", "new"),
    ]


def test_history(spark):
    rows = [("idx", dt.datetime(2024, 1, d), float(d), "x") for d in range(1, 11)]
    df = spark.createDataFrame(rows, "category STRING, date TIMESTAMP_NTZ, price DOUBLE, other STRING")
    newest = snapshot.history(df, "idx:price")
    assert [r["price"] for r in newest.collect()] == [6.0, 7.0, 8.0, 9.0, 10.0]
    start, end = 1704153600000, 1704326400000  # 2 and 4 January, both included
    assert [r["price"] for r in snapshot.history(df, "idx:price", start, end, 2).collect()] == [3.0, 4.0]
    with pytest.raises(ValueError):
        snapshot.history(df, "idx:nothing")


def test_history_arrays_are_bounded(spark):
    rows = [("s", dt.datetime(2024, 1, d), float(d)) for d in range(1, 21)]
    arrays = snapshot.history_arrays(spark.createDataFrame(rows, "series STRING, date TIMESTAMP_NTZ, value DOUBLE"), countback=3).first()
    assert arrays["s"] == "ok" and arrays["c"] == [18.0, 19.0, 20.0] and len(arrays["t"]) == 3


def test_large_history_is_cut_before_the_shuffle(spark, tmp_path, capsys):
    rows = spark.range(100).select((F.col("id") % 2).alias("series"), F.col("id").alias("date"), F.col("id").alias("value"))
    rows.write.parquet(f"{tmp_path}/rows")
    wide = snapshot.history_all(spark.read.parquet(f"{tmp_path}/rows"), countback=50_000)
    wide.explain()
    assert capsys.readouterr().out.count("WindowGroupLimit") == 2
    assert wide.count() == 100


def test_latest_facts(series):
    facts = snapshot.latest_facts(series([("a", "2024-01-02", 1.0, T0), ("a", "2024-01-02", 2.0, T1), ("a", "2024-01-01", 1.0, T2)]))
    assert rows_of(facts) == [("a", day("2024-01-02"), dt.datetime.fromisoformat(T1))]


def cleaned(spark, values, kind, **kwargs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, value STRING")
    return [r["value"] for r in clean.clean_column(df, "value", kind, **kwargs).orderBy("i").collect()]


def test_clean_number(spark):
    assert cleaned(spark, ["", "x", "1,000", "0x1A", "True", " 3 ", "1e3", "inf", None], "number") == [
        None, None, None, None, None, 3.0, 1000.0, math.inf, None,
    ]


def test_clean_other_kinds(spark):
    assert cleaned(spark, ["a", "", None], "string") == ["a", None, None]
    assert cleaned(spark, ["False", "0", "", None], "boolean") == [True, True, False, False]
    assert cleaned(spark, ["1", "2.0", "x"], "integer") == [1, 2, None]
    assert cleaned(spark, ["1", "2.5", "x"], "integer") == [1.0, 2.5, None]
    assert cleaned(spark, ["2024-01-02", "03.01.2024", "x"], "datetime", formats=["yyyy-MM-dd", "dd.MM.yyyy"]) == [
        dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3), None,
    ]
    with pytest.raises(ValueError):
        cleaned(spark, ["1"], "colour")


def test_predicates(spark):
    assert cleaned(spark, ["1", "5", "x"], "number", restriction=lambda v: v > 2) == [5.0]

    def fails_on_small(value):
        if value < 3:
            raise RuntimeError
        return value == value

    assert cleaned(spark, ["1", "5", "x"], "number", restriction=fails_on_small) == [5.0]


def test_clean_date_value(spark):
    df = spark.createDataFrame([("1", "2024-01-01"), ("x", "2024-01-02"), ("3", "no"), (None, "2024-01-03")], "value STRING, date STRING")
    out = clean.clean_date_value(df)
    assert out.columns == ["date", "value"]
    assert rows_of(out) == [(dt.datetime(2024, 1, 1), 1.0)]


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([(math.nan, 1), (2.0, None), (3.0, 3)], "a DOUBLE, b INT")
    assert rows_of(project.drop_missing(df)) == [(3.0, 3)]
    assert rows_of(project.nan_as_null(df), "a") == [(2.0,), (3.0,), (None,)]


def test_exclude_prefixes(spark):
    df = spark.createDataFrame([("mock_category_mock_name",), ("__metadata__",), ("_metadata_x",), ("normalized_a",)], "n STRING")
    assert rows_of(project.exclude_prefixes(df, "n")) == [("mock_category_mock_name",)]


def test_dates_are_cut_before_as_of(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 59),), (dt.datetime(2024, 1, 2),)], "date TIMESTAMP_NTZ")
    assert project.cut_after_yesterday(df, "2024-01-02").count() == 1


def test_add_series(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "date INT, value DOUBLE")
    b = spark.createDataFrame([(2, 5.0), (3, 1.0)], "date INT, value DOUBLE")
    assert rows_of(rec.add_series(a, b, ["date"])) == [(1, None), (2, 7.0), (3, None)]


def test_maps(spark):
    a = spark.createDataFrame([("x", 1), ("y", None)], "k STRING, v INT")
    b = spark.createDataFrame([("x", 1), ("y", None)], "k STRING, v INT")
    assert rec.maps_equal(a, b, "k", "v").first()["equal"]
    assert not rec.maps_equal(a, b.where("k = 'x'"), "k", "v").first()["equal"]


def test_number_rows_is_a_gapless_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"))
    numbered = number_rows(df, ["k"])
    assert numbered.where(F.col("k") != F.col("number")).count() == 0
    assert numbered.count() == 5000


def test_yearly_sum(spark):
    df = spark.createDataFrame([("foo", "2000", "1"), ("bar", "2000", "1"), ("foo", "2024", "2"), ("bar", "2024", "2")],
                               "country STRING, year STRING, `Life Ladder` STRING")
    assert rows_of(rounds.yearly_sum(df, "Life Ladder")) == [("2000", 2.0), ("2024", 4.0)]


def test_sorted_rows(spark):
    df = spark.range(2000).select((F.col("id") % 3).alias("k"), F.lit(1).alias("same"))
    assert [r["k"] for r in project.sort_rows(df, "k").collect()] == sorted(i % 3 for i in range(2000))
    texts = spark.createDataFrame([("10",), ("9",), ("x",)], "round STRING")
    assert [r[0] for r in project.sort_numeric_text(texts, "round").collect()] == ["x", "9", "10"]
