import datetime as dt

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from sparkseries.operators import catalog
from sparkseries.plans import command, ready, runner
from sparkseries.plans.runner import Ingest
from sparkseries.sources import targets
from sparkseries.sources.registry import Source
from sparkseries.sources.targets import Target
from sparkseries.streaming import jobs

AS_OF = "2024-06-01 00:00:00"
FIRST = "date,value,created_at\n" + "".join(f"2023-05-{d},{d},2023-05-{d} 00:00:00\n" for d in range(20, 24))
SECOND = FIRST.replace("2023-05-21,21,2023-05-21", "2023-05-21,11,2024-05-21")


def sources(tmp_path, text):
    (tmp_path / "example.csv").write_text(text)
    return [Source("example", f"csv:{tmp_path}", "example.csv", "date STRING, value DOUBLE, created_at TIMESTAMP_NTZ")]


def ingest(tmp_path, text, **kwargs):
    return Ingest("hello", sources(tmp_path, text), [Target("example", "parquet", str(tmp_path / "target"), **kwargs)])


def written(run):
    return [(target, status, rows) for _i, target, status, rows, _s, _e in run.entries]


def test_append_correct_and_repeat(spark, tmp_path):
    assert written(runner.run(spark, ingest(tmp_path, FIRST), AS_OF)) == [("example", "written", 4)]
    assert written(runner.run(spark, ingest(tmp_path, FIRST), AS_OF)) == [("example", "written", 0)]
    dry = runner.run(spark, ingest(tmp_path, SECOND), AS_OF, dry_run=True)
    assert rows_of(dry.new_rows["example"], "value") == [(11.0,)] and written(dry) == [("example", "dry run", None)]
    assert written(runner.run(spark, ingest(tmp_path, SECOND), AS_OF)) == [("example", "written", 1)]
    assert spark.read.parquet(str(tmp_path / "target")).count() == 5
    assert written(runner.run(spark, ingest(tmp_path, SECOND, few_values_of="value"), AS_OF)) == [("example", "written", 0)]


def test_arrival_is_stamped_and_clamped(spark, tmp_path):
    runner.run(spark, ingest(tmp_path, "date,value,created_at\n2024-01-01,1,2030-01-01 00:00:00\n"), AS_OF)
    assert spark.read.parquet(str(tmp_path / "target")).first()["created_at"] == dt.datetime(2024, 6, 1)


def test_replace_and_custom_steps(spark, tmp_path):
    for _time in range(2):
        runner.run(spark, ingest(tmp_path, FIRST, replace=True), AS_OF)
    assert spark.read.parquet(str(tmp_path / "target")).count() == 4
    calls = []

    def keep_all(base, incoming):
        calls.append(base.count())
        return incoming.select(*base.columns)

    runner.run(spark, ingest(tmp_path, FIRST, reconcile=keep_all), AS_OF)
    assert calls == [4] and spark.read.parquet(str(tmp_path / "target")).count() == 8


def test_hooks_transforms_and_missing_frames(spark, tmp_path):
    order = []
    plan = Ingest(
        "steps", sources(tmp_path, FIRST), [Target("sum", "parquet", str(tmp_path / "sum")), Target("absent", "parquet", str(tmp_path / "absent"))],
        [lambda frames: {"doubled": frames["example"].withColumn("value", F.col("value") * 2)},
         lambda frames: {"sum": frames["doubled"].groupBy("date").agg(F.sum("value").alias("value"))}],
        before=lambda: order.append("before"), after=lambda: order.append("after"),
    )
    run = runner.run(spark, plan, AS_OF)
    assert order == ["before", "after"]
    assert [(t, s) for t, s, _n in written(run)] == [("sum", "written"), ("absent", "no frame")]
    assert run.report(spark).where("status = 'written'").first()["rows"] == 4


def test_errors(spark, tmp_path):
    def fail(_frames):
        raise RuntimeError("broken step")

    plan = Ingest("bad", sources(tmp_path, FIRST), [], fail)
    with pytest.raises(RuntimeError):
        runner.run(spark, plan, AS_OF)
    run = runner.run(spark, plan, AS_OF, on_error="continue")
    assert run.entries[-1][2] == "failed" and "broken step" in run.entries[-1][5]


def test_catalogue_and_manifest(spark, tmp_path):
    rules = spark.createDataFrame([("example", "Daily", "No", 1, 0)], catalog.RULE_SCHEMA + ", position INT")
    for _time in range(2):
        runner.run(spark, ingest(tmp_path, FIRST), AS_OF, catalogue_path=str(tmp_path / "cat"), rules=rules, manifest_path=str(tmp_path / "manifest"))
    stored = targets.read_version(spark, str(tmp_path / "cat"))
    assert dict(rows_of(stored, "_key", "value"))["latest_date"] == "2023-05-23" and stored.count() == 6
    assert sorted(r["rows"] for r in targets.read_manifest(spark, str(tmp_path / "manifest")).collect()) == [0, 4]


def test_many_from_config(spark, tmp_path):
    def make(prefix="x"):
        return [Ingest(f"{prefix}{n}", sources(tmp_path, FIRST), [Target("example", "parquet", str(tmp_path / f"{prefix}{n}"))]) for n in (1, 2)]

    config = runner.config_of(["details.py", "prefix=run"])
    assert [run.name for run in runner.run_all(spark, make, AS_OF, config)] == ["run1", "run2"]
    assert runner.output(spark, make(), "example", AS_OF).count() == 4


def test_ready_made_ingests(spark, tmp_path):
    (tmp_path / "economy.csv").write_text("Date,Value\n2021-01-01,100\n2021-02-01,200\n2021-03-01,\n")
    target = Target("db", "parquet", str(tmp_path / "economy"))
    runner.run(spark, ready.economic_ingest("economy", str(tmp_path / "economy.csv"), [target]), AS_OF)
    assert rows_of(spark.read.parquet(target.location), "value") == [(100.0,), (200.0,)]
    (tmp_path / "happy.csv").write_text('country,year,Life Ladder\nfoo,2000,"1,5"\nbar,2000,"0,5"\nfoo,2024,4\n')
    runner.run(spark, ready.yearly_ingest("happy", str(tmp_path / "happy.csv"), str(tmp_path / "sums")), AS_OF)
    assert rows_of(spark.read.option("header", True).csv(str(tmp_path / "sums"))) == [("2000", "2.0"), ("2024", "4.0")]


def as_stream(spark, df, path):
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_appends_only_new_rows(spark, series, tmp_path):
    rows = series([("a", f"2024-01-{1 + i % 9:02d}", float(i % 5), f"2024-02-{1 + i % 20:02d} 00:00:00") for i in range(60)]).repartition(3)
    target, state = str(tmp_path / "out"), str(tmp_path / "state")
    stream = as_stream(spark, rows, str(tmp_path / "in"))
    jobs.stream_reconcile(stream, target, state).awaitTermination()
    stored = jobs.read_batches(spark, target, rows)
    expected = rows.select("series", "date", "value").distinct()
    assert rows_of(stored, "series", "date", "value") == rows_of(expected)
    jobs.stream_reconcile(stream, target, state).awaitTermination()
    assert jobs.read_batches(spark, target, rows).count() == expected.count()


def test_lost_checkpoint_appends_nothing_twice(spark, series, tmp_path):
    rows = series([("a", f"2024-01-0{n}", 1.0, "2024-02-01 00:00:00") for n in range(1, 8)]).repartition(3)
    target = str(tmp_path / "out")
    jobs.stream_reconcile(as_stream(spark, rows, str(tmp_path / "in")), target, str(tmp_path / "one")).awaitTermination()
    again = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    jobs.stream_reconcile(again, target, str(tmp_path / "two")).awaitTermination()
    assert jobs.read_batches(spark, target, rows).count() == 7


def test_stream_last_write_equals_batch(spark, tmp_path):
    rows = spark.range(300).select(
        (F.col("id") % 40).cast("string").alias("id"), F.expr("timestamp_ntz'2024-01-01' + make_interval(0,0,0,0,0,id * 7 % 50)").alias("timestamp"),
        F.col("id").cast("double").alias("value"),
    ).repartition(4)
    target = str(tmp_path / "out")
    jobs.stream_last_write(as_stream(spark, rows, str(tmp_path / "in")), target, str(tmp_path / "state")).awaitTermination()
    stored = jobs.last_writes(spark, target, rows)
    newest = rows.groupBy("id").agg(F.max("timestamp").alias("timestamp"))
    assert rows_of(stored, "id", "timestamp") == rows_of(newest)


def test_stream_drops_repeats(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1.0, dt.datetime(2024, 1, 1)), ("a", 1.0, dt.datetime(2024, 1, 1)), ("a", 2.0, dt.datetime(2024, 1, 1))],
                                 "k STRING, value DOUBLE, ts TIMESTAMP_NTZ")
    unique = jobs.drop_repeats(as_stream(spark, rows, str(tmp_path / "in")), ["k", "value"], "ts")
    out = str(tmp_path / "out")
    unique.writeStream.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(out, format="parquet").awaitTermination()
    assert spark.read.parquet(out).count() == 2


DECLARATION = '''
from sparkseries.plans.runner import Ingest
from sparkseries.sources.registry import Source
from sparkseries.sources.targets import Target


def get_ingest(folder, name="out"):
    source = Source("example", f"csv:{folder}", "example.csv", "date STRING, value DOUBLE, created_at TIMESTAMP_NTZ")
    return Ingest("declared", [source], [Target("example", "parquet", f"{folder}/{name}")])
'''


def test_declaration_files(spark, tmp_path):
    (tmp_path / "example.csv").write_text(FIRST)
    (tmp_path / "details.py").write_text(DECLARATION)
    (tmp_path / "empty.py").write_text("")
    runs = command.run_files(spark, [str(tmp_path / "details.py"), f"folder={tmp_path}", "name=made"], AS_OF)
    assert written(runs[0]) == [("example", "written", 4)]
    assert spark.read.parquet(str(tmp_path / "made")).count() == 4
    with pytest.raises(ValueError, match="neither"):
        command.run_files(spark, [str(tmp_path / "empty.py")], AS_OF)


def test_catalogue_follows_appends_without_reading_targets(spark, series, tmp_path):
    def ingest_of(rows):
        return Ingest("many", [Source("t", read=lambda _s: series(rows))], [Target("t", "parquet", str(tmp_path / "t"), series="series")])

    rules = spark.createDataFrame([], catalog.RULE_SCHEMA + ", position INT")
    path = str(tmp_path / "cat")
    first = [("a_b_c", "2024-01-01", 1.0, "2024-01-01 00:00:00"), ("d_e_f", "2024-01-05", 1.0, "2024-01-05 00:00:00")]
    later = [("a_b_c", "2024-01-02", 2.0, "2024-01-02 00:00:00"), ("d_e_f", "2024-01-03", 2.0, "2024-01-09 00:00:00")]
    for rows in (first, later):
        runner.run(spark, ingest_of(rows), AS_OF, catalogue_path=path, rules=rules)
    facts = catalog.wide_catalogue(targets.read_version(spark, path))
    expected = [("a_b_c", "2024-01-02", "2024-01-02 00:00:00"), ("d_e_f", "2024-01-05", "2024-01-05 00:00:00")]
    assert rows_of(facts, "table_name", "latest_date", "last_update") == expected
    target = Target("t", "parquet", str(tmp_path / "t"), series="series")
    runner.rebuild_catalogue(spark, [(target, series(first))], rules, path, AS_OF)
    assert rows_of(catalog.wide_catalogue(targets.read_version(spark, path)), "table_name", "latest_date", "last_update") == expected


def test_named_frames(spark):
    frames = {"numbers": spark.range(3)}
    runner.publish(frames)
    assert spark.sql("SELECT count(*) FROM numbers").first()[0] == 3
    runner.clear(spark, frames)
    assert not frames and not spark.catalog.tableExists("numbers")
