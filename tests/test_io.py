import datetime as dt
import os

import pandas as pd
import pytest
from conftest import rows_of
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader

from sparkseries.queries.ingest import as_workbooks
from sparkseries.sources import files, jdbc, ledger, payloads, registry, targets, workbooks
from sparkseries.sources.registry import Source, read_source, register_source, resolve
from sparkseries.sources.targets import Target

NUMBERS = "a INT, b STRING"


def test_csv_modes(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, "x"), (2, "y,z")], NUMBERS)
    targets.write_csv(df, path)
    with pytest.raises(ValueError):
        targets.write_csv(df, path)
    targets.write_csv(df, path, "append")
    assert files.read_csv(spark, path, NUMBERS).count() == 4
    targets.write_csv(df, path, "replace")
    assert rows_of(files.read_csv(spark, path)) == [(1, "x"), (2, "y,z")]


def test_json_documents(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"a": 1,\n "b": "x"}')
    assert rows_of(files.read_json(spark, str(tmp_path / "one.json"), NUMBERS)) == [(1, "x")]
    assert files.read_json_document(spark, str(tmp_path / "one.json")).first()["body"].startswith('{"a": 1')


def test_economic_csv(spark, tmp_path):
    good = tmp_path / "good.csv"
    good.write_text("Date,Value\n2021-01-01,100\n2021-02-01,200\n2021-03-01,\n")
    df = files.read_economic_csv(spark, str(good))
    assert df.columns == ["Date", "Value"] and df.count() == 3
    assert df.dropna().count() == 2
    with pytest.raises(files.SourceError, match="nonexistent_file.csv was not found"):
        files.read_economic_csv(spark, "nonexistent_file.csv")
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(files.SourceError, match="No data found in the file"):
        files.read_economic_csv(spark, str(tmp_path / "empty.csv"))
    (tmp_path / "bad.csv").write_text("Date;Value\n2021-01-01;100")
    with pytest.raises(files.SourceError, match="An error occurred while reading the file"):
        files.read_economic_csv(spark, str(tmp_path / "bad.csv"))


def test_file_listing(spark, tmp_path):
    for name in ("one.csv", "two.json", "three", "bad-name.csv"):
        (tmp_path / name).write_text("x")
    assert rows_of(files.list_files(spark, str(tmp_path)), "name", "type") == [
        ("one.csv", "csv"), ("three", "unknown"), ("two.json", "json"),
    ]


def test_type_strings():
    assert resolve("csv:/data") == (registry.READERS["csv"], "/data")
    assert resolve("csv+http")[0] is registry.READERS["csv+http"]
    assert resolve("rest+http")[0] is registry.READERS["rest+http"]
    assert resolve("http")[0] is registry.READERS["http"]
    for unknown in ("CSV", "nothing", "mysql"):
        with pytest.raises(ValueError, match="unknown source type"):
            resolve(unknown)
    assert callable(resolve("mariadb+pymysql://u:p@h:3306/db")[0])


def test_sources_given_as_objects(spark):
    df = spark.createDataFrame([(1, "x")], NUMBERS)
    assert read_source(spark, Source("s", read=lambda _s: df)) is df
    assert read_source(spark, Source("s", lambda _s, source: df)) is df
    assert read_source(spark, Source("s", "object", df, options={"data_type": DataFrame})) is df
    listed = Source("s", "object", {"a": [1], "b": ["x"]}, NUMBERS, {"data_type": dict})
    assert rows_of(read_source(spark, listed)) == [(1, "x")]
    with pytest.raises(files.SourceError):
        read_source(spark, Source("s", "object", [1], options={"data_type": dict}))


def test_data_source_plugin(spark):
    class CountReader(DataSourceReader):
        def __init__(self, options):
            self.number = int(options["number"])

        def read(self, _partition):
            for n in range(self.number):
                yield (n,)

    class CountSource(DataSource):
        @classmethod
        def name(cls):
            return "counting"

        def schema(self):
            return "n INT"

        def reader(self, schema):
            return CountReader(self.options)

    register_source("counted", CountSource, spark)
    assert read_source(spark, Source("s", "counted", options={"number": "3"})).count() == 3


def test_database_options():
    env = {"DB_USER": "u", "DB_PASSWORD": "p@ss", "DB_HOST": "h", "DB_PORT": "3306", "DB_NAME": "d"}
    assert jdbc.database_url(env=env) == "mariadb+pymysql://u:p@ss@h:3306/d"
    assert jdbc.jdbc_options("mariadb+pymysql://u:p%40ss@h:3306/d") == {"url": "jdbc:mariadb://h:3306/d", "user": "u", "password": "p@ss"}
    options = jdbc.read_options("postgresql://h/d", "SELECT * FROM t", {"column": "id", "lower": 0, "upper": 10, "number": 4})
    assert options["dbtable"] == "(SELECT * FROM t) AS q" and options["numPartitions"] == "4" and "query" not in options
    assert jdbc.read_options("postgresql://h/d", "prices")["dbtable"] == "prices"
    assert jdbc.read_options("postgresql://h/d", "select 1")["query"] == "select 1"
    written = jdbc.write_options("postgresql://h/d", "prices", ["date", "value", "created_at"])
    assert written["batchsize"] == "1000" and written["createTableColumnTypes"] == "date DATE, created_at TIMESTAMP"


def test_fetch_with_failures(spark):
    def fetch(url):
        if url == "down":
            return None, None, None
        return (200 if url == "good" else 404), "text/csv", b"date,value\n2024-01-01,1.5\n2024-01-02,x\n"

    urls = spark.createDataFrame([(1, "good"), (2, "missing"), (3, "down")], "k INT, url STRING")
    rows = payloads.decode_payloads(payloads.fetch_payloads(urls, fetch=fetch).drop("url", "status"), "date DATE, value DOUBLE")
    assert rows_of(rows) == [(1, dt.date(2024, 1, 1), 1.5), (1, dt.date(2024, 1, 2), None)]


def test_csv_header_must_fit(spark):
    df = spark.createDataFrame([("text/csv", '\ufeff"a", b\r\n1,"x,y"\r\n'), ("text/csv", "")], "content_type STRING, body STRING")
    assert rows_of(payloads.decode_payloads(df, NUMBERS)) == [(1, "x,y")]
    with pytest.raises(Exception, match="unexpected CSV header: b,a"):
        payloads.decode_payloads(df.withColumn("body", F.lit("b,a\nx,1")), NUMBERS).collect()


def test_forced_payload_kind(spark):
    df = spark.createDataFrame([("text/html", '[{"a":1,"b":"x"}]')], "content_type STRING, body STRING")
    assert payloads.decode_payloads(df, NUMBERS).count() == 0
    assert rows_of(payloads.decode_payloads(df, NUMBERS, force="json")) == [(1, "x")]


def test_workbooks(spark, tmp_path):
    book = as_workbooks(spark.createDataFrame([("2024-01-01", 1.5, "a&b"), ("x", 2.0, "c")], "Date STRING, Price DOUBLE, note STRING").coalesce(1)).first()
    (tmp_path / "book.xlsx").write_bytes(bytes(book["content"]))
    df = workbooks.read_spreadsheet_export(spark, str(tmp_path / "book.xlsx"), "`Date` DATE, `Price` DOUBLE, note STRING")
    assert df.columns == ["date", "value", "note"]
    assert rows_of(df) == [(None, 2.0, "c"), (dt.date(2024, 1, 1), 1.5, "a&b")]
    assert workbooks.read_workbooks(spark, str(tmp_path / "book.xlsx"), "absent STRING", "data").first()[0] is None
    with pytest.raises(Exception, match="no sheet"):
        workbooks.read_workbooks(spark, str(tmp_path / "book.xlsx"), "note STRING", "other").collect()


def test_target_read_and_write(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], NUMBERS)
    for kind in ("csv", "json", "parquet"):
        target = Target("t", f"{kind}:{tmp_path}", kind)
        assert targets.read_target(spark, target, df) is None
        targets.write_target(df, target)
        targets.write_target(df, target)
        assert rows_of(targets.read_target(spark, target, df)) == [(1, "x")] * 2
        assert targets.read_target(spark, Target("t", f"{kind}:{tmp_path}", kind, replace=True), df) is None
        targets.dump(df, target)
        assert targets.read_target(spark, target, df).count() == 1
    with pytest.raises(ValueError):
        targets.write_target(df, Target("t", "excel", str(tmp_path / "x")))
    seen = []
    targets.write_target(df, Target("t", "parquet", "nowhere", create_table=lambda target, rows: seen.append((target.name, rows.count()))))
    assert seen == [("t", 1)] and not os.path.exists("nowhere")


def test_tables(spark):
    targets.create_table(spark, "made", "a INT, b STRING")
    target = Target("made", "table")
    targets.write_target(spark.createDataFrame([(1, "x")], NUMBERS), target)
    assert targets.read_target(spark, target, None).count() == 1
    targets.drop_table(spark, "made")
    targets.drop_table(spark, "made")
    with pytest.raises(Exception):
        targets.drop_table(spark, "made", ignore_missing=False)


def test_versions(spark, tmp_path):
    path = str(tmp_path / "versions")
    assert targets.read_version(spark, path) is None
    targets.write_version(spark.createDataFrame([(1, "x")], NUMBERS), path)
    targets.write_version(targets.read_version(spark, path).unionAll(spark.createDataFrame([(2, "y")], NUMBERS)), path)
    assert rows_of(targets.read_version(spark, path)) == [(1, "x"), (2, "y")]
    targets.write_version(spark.createDataFrame([], NUMBERS), path)
    assert targets.read_version(spark, path).count() == 0
    os.makedirs(f"{path}/version=9")  # a version whose write broke off
    assert targets.read_version(spark, path).count() == 0
    assert sorted(n for n in os.listdir(path) if n.startswith("version")) == ["version=2", "version=3", "version=9"]


@pytest.mark.parametrize(
    "url, jdbc_url",
    [
        ("mssql+pyodbc://u:p@h:1433/d?encrypt=true", "jdbc:sqlserver://h:1433;databaseName=d;encrypt=true"),
        ("oracle://h:1521/service", "jdbc:oracle:thin:@//h:1521/service"), ("sqlite:///x.db", "jdbc:sqlite:x.db"),
        ("sqlite:////data/x.db", "jdbc:sqlite:/data/x.db"), ("postgresql://h/d?ssl=true&a=b", "jdbc:postgresql://h/d?ssl=true&a=b"),
    ],
)
def test_jdbc_urls(url, jdbc_url):
    assert jdbc.jdbc_options(url)["url"] == jdbc_url


def test_schemes_without_a_driver_are_refused():
    with pytest.raises(ValueError, match="no JDBC driver"):
        jdbc.jdbc_options("pybigquery://project/data")


def test_partitioned_target_reads():
    options = jdbc.read_options("mysql://h/d", "t", {"column": "id", "lower": 0, "upper": 9, "number": 3})
    assert options["numPartitions"] == "3" and options["partitionColumn"] == "id"


def test_fetches_are_tried_again():
    answers = iter([(503, None, None), (None, None, None), (200, "text/csv", b"x")])
    assert payloads.fetch_again(lambda _url: next(answers), "u", 3, 0) == (200, "text/csv", b"x", None)
    calls = []
    assert payloads.fetch_again(lambda url: calls.append(url) or (404, None, None), "u", 3, 0) == (404, None, None, "status 404")
    assert len(calls) == 1

    def broken(_url):
        raise OSError("down")

    assert payloads.fetch_again(broken, "u", 2, 0) == (None, None, None, "OSError: down")


def test_failed_urls_end_an_ingest(spark):
    urls = spark.createDataFrame([("u:1",), ("u:2",)], "url STRING")
    fetch = lambda url: (200, "text/csv", b"a,b\n1,x\n") if url == "u:1" else (404, None, None)
    with pytest.raises(files.SourceError, match="u:2"):
        read_source(spark, Source("s", "csv+http", urls, NUMBERS, {"fetch": fetch, "wait": 0}))
    frames = {}
    kept = Source("s", "csv+http", urls, NUMBERS, {"fetch": fetch, "wait": 0, "on_failure": "continue"})
    assert rows_of(read_source(spark, kept, frames)) == [(1, "x")]
    assert rows_of(frames[registry.failed_name("s")]) == [("u:2", 404, "status 404")]


def test_csv_quotes(spark):
    def rows(body):
        frame = spark.createDataFrame([("text/csv", body)], "content_type STRING, body STRING")
        return [tuple(r) for r in payloads.decode_payloads(frame, NUMBERS).collect()]

    assert rows('a,b\n1,"x\r\ny, ""z"""\n2,\n') == [(1, 'x\r\ny, "z"'), (2, None)]
    with pytest.raises(Exception, match="never closed"):
        rows('a,b\n1,"x\n')


def test_unreadable_dates_are_errors(spark):
    from sparkseries.operators import project

    df = spark.createDataFrame([("Jan 5, 2024",), (None,), ("",), ("02/03/2024",)], "date STRING")
    found = sorted(str(r[0]) for r in project.parse_date_columns(df).collect())
    assert found == ["2024-01-05 00:00:00", "2024-02-03 00:00:00", "None", "None"]
    odd = spark.createDataFrame([("soon",)], "date STRING")
    with pytest.raises(Exception, match="unreadable date"):
        project.parse_date_columns(odd).collect()
    assert project.parse_date_columns(odd, strict=False).first()[0] is None
    assert project.parse_date_columns(spark.createDataFrame([("3.2.2024",)], "date STRING"), formats=["d.M.yyyy"]).first()[0] == dt.datetime(2024, 2, 3)


def test_ledger(spark, tmp_path):
    assert ledger.split_address("me@db:prices") == ("me", "db", "prices")
    assert ledger.split_address("db:prices") == (None, "db", "prices")
    with pytest.raises(ValueError):
        ledger.split_address("db")
    root = str(tmp_path)
    assert ledger.read_ledger(spark, "db:prices", root) is None
    rows = spark.createDataFrame([(dt.date(2024, 1, 1), 1.2345678, dt.datetime(2024, 1, 2, 3))], "date DATE, value DOUBLE, created_at TIMESTAMP_NTZ")
    admins = spark.createDataFrame([("me",)], "wallet STRING")
    ledger.append_ledger(rows.withColumn("writer", F.lit("me")), "db:prices", root, admins=admins)
    assert rows_of(ledger.read_ledger(spark, "db:prices", root)) == [(dt.date(2024, 1, 1), 1.234568, dt.datetime(2024, 1, 2, 3))]
    assert len(ledger.read_ledger(spark, "db:prices", root, raw=True).first()["id"]) == 36
    with pytest.raises(PermissionError):
        ledger.append_ledger(rows.withColumn("writer", F.lit("you")), "db:prices", root, admins=admins)
    with pytest.raises(Exception, match="refused: null value"):
        ledger.append_ledger(rows.withColumn("value", F.lit(None).cast("double")), "db:prices", root)
    assert ledger.read_ledger(spark, "db:prices", root).count() == 1


def test_object_source_from_pandas(spark):
    frame = pd.DataFrame({"a": [1], "b": ["x"]})
    assert rows_of(read_source(spark, Source("s", "object", frame, NUMBERS, {"data_type": pd.DataFrame}))) == [(1, "x")]


def test_ledger_ids_make_a_run_repeatable(spark, tmp_path):
    rows = spark.createDataFrame([(dt.date(2024, 1, 1), 1.0, dt.datetime(2024, 1, 2))], "date DATE, value DOUBLE, created_at TIMESTAMP_NTZ")
    for _time in range(2):
        ledger.append_ledger(rows, "db:prices", str(tmp_path), keys=["date", "value"])
    assert ledger.read_ledger(spark, "db:prices", str(tmp_path)).count() == 1


def test_json_object_of_lists(spark):
    df = spark.createDataFrame([("application/json", '{"a":[1,2],"b":["x","y"]}'), ("application/json", ' [{"a":3,"b":"z"}]')],
                               "content_type STRING, body STRING")
    assert rows_of(payloads.decode_payloads(df, NUMBERS)) == [(1, "x"), (2, "y"), (3, "z")]


def test_workbook_payloads(spark):
    books = as_workbooks(spark.createDataFrame([(1, "x")], NUMBERS).coalesce(1))
    fetched = books.select(F.col("path").alias("url"), F.lit(payloads.EXCEL_TYPES[1]).alias("content_type"), F.col("content").alias("body"))
    assert rows_of(workbooks.payload_workbooks(fetched, NUMBERS)) == [(1, "x")]


def test_documents(spark, tmp_path):
    for document in ({"a": 1, "b": "x"}, '{"a": 1, "b": "x"}'):
        targets.write_document(spark, document, str(tmp_path / "doc"))
        assert rows_of(files.read_json(spark, str(tmp_path / "doc"), NUMBERS)) == [(1, "x")]
