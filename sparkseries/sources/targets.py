"""Targets: reading back what is there, appending or replacing, manifests, versioned small tables."""

from __future__ import annotations

import dataclasses
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.project import as_text
from . import files, jdbc, ledger

MANIFEST_SCHEMA = "run_id STRING, target STRING, path STRING, rows BIGINT"


@dataclasses.dataclass(frozen=True)
class Target:
    """Where a named frame goes. `path` is a folder, a table name or a `db:table` address, by `format`.

    `replace` writes over what is there, otherwise only new rows are appended. `reconcile(base, incoming)` and
    `create_table(target, rows)` replace the built-in steps. `partition_by` keeps scans of a large target short, and
    so does `few_values_of`: a column, such as the series, whose values in a run lie in a small range; the target is read in that range
    only. `series` names the column that tells apart the series of a target; without it the target is one series. `partition` gives
    column, lower, upper and number for parallel reads of a database table.
    """

    name: str
    format: str = "parquet"
    path: str | None = None
    replace: bool = False
    reconcile: Callable[[DataFrame, DataFrame], DataFrame] | None = None
    create_table: Callable[["Target", DataFrame], None] | None = None
    partition_by: tuple[str, ...] = ()
    few_values_of: str | None = None
    series: str | None = None
    partition: dict | None = None
    options: dict = dataclasses.field(default_factory=dict)

    @property
    def kind(self) -> str:
        return self.format.partition(":")[0]

    @property
    def location(self) -> str:
        return files.join_path(self.format.partition(":")[2] or None, self.path or self.name)


def read_target(spark: SparkSession, target: Target, like: DataFrame) -> DataFrame | None:
    """The rows a target holds, None when it is replaced or does not exist. `like` gives the column types."""
    if target.replace:
        return None
    kind, location = target.kind, target.location
    if kind == "table":
        return spark.table(location) if spark.catalog.tableExists(location) else None
    if kind == "ledger":
        return ledger.read_ledger(spark, target.path, target.format.partition(":")[2] or None)
    if kind in jdbc.SQL_SCHEMES:
        return jdbc.read_jdbc(spark, target.format, target.path or target.name, partition=target.partition)
    if not files.path_exists(spark, location):
        return None
    types = dict(like.dtypes)
    if kind in ("csv", "gsheet"):
        header = spark.read.option("header", True).csv(location).columns
        return files.read_csv(spark, location, ", ".join(f"`{c}` {types.get(c, 'string')}" for c in header))
    if kind == "json":
        return files.read_json(spark, location, ", ".join(f"`{c}` {t}" for c, t in types.items()), multi_line=False)
    return spark.read.parquet(location)


def write_target(df: DataFrame | None, target: Target) -> None:
    """Append, or overwrite when the target is replaced; nothing happens without a frame."""
    if df is None:
        return
    if target.create_table is not None:
        target.create_table(target, df)
        return
    kind, location = target.kind, target.location
    if kind == "ledger":
        ledger.append_ledger(df, target.path, target.format.partition(":")[2] or None, **target.options)
        return
    if kind in jdbc.SQL_SCHEMES:
        jdbc.write_jdbc(df, target.format, target.path or target.name, target.replace)
        return
    if kind == "gsheet":
        df, kind = as_text(df), "csv"
    writer = df.write.mode("overwrite" if target.replace else "append").options(**target.options)
    if target.partition_by:
        writer = writer.partitionBy(*target.partition_by)
    if kind == "table":
        writer.format("parquet").saveAsTable(location)
    elif kind == "csv":
        writer.option("header", True).csv(location)
    elif kind in ("json", "parquet"):
        writer.format(kind).save(location)
    else:
        raise ValueError(f"unknown target type {target.format!r}")


def write_csv(df: DataFrame, path: str, if_exists: str = "none") -> None:
    """A new folder is created; an existing one is appended to, replaced, or refused."""
    modes = {"append": "append", "replace": "overwrite"}
    if if_exists not in modes and files.path_exists(df.sparkSession, path):
        raise ValueError(f"{path} exists")
    df.write.mode(modes.get(if_exists, "errorifexists")).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, if_exists: str = "replace") -> None:
    df.write.mode("append" if if_exists == "append" else "overwrite").json(path)


def write_document(spark: SparkSession, document, path: str) -> None:
    """One JSON document, given as an object or as text."""
    body = document if isinstance(document, str) else json.dumps(document)
    spark.createDataFrame([(body,)], "body STRING").coalesce(1).write.mode("overwrite").text(path)


def dump(df: DataFrame, target: Target) -> None:
    """Write the whole frame over the target."""
    write_target(df, dataclasses.replace(target, replace=True))


def create_table(spark: SparkSession, name: str, columns: str) -> None:
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet")


def drop_table(spark: SparkSession, name: str, ignore_missing: bool = True) -> None:
    spark.sql(f"DROP TABLE {'IF EXISTS ' if ignore_missing else ''}{name}")


def execute(spark: SparkSession, statements: list[str], **params) -> None:
    for statement in statements:
        spark.sql(statement, args=params or None)


def append_manifest(spark: SparkSession, path: str, run_id: str, entries: list[tuple[str, str, int]]) -> None:
    """One row per written target: run, target, path and number of rows."""
    rows = [(run_id, *entry) for entry in entries]
    spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.mode("append").json(path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).json(path)


#: Versions that stay readable; a plan may still read the one before the newest.
VERSIONS_KEPT = 2


def _versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the complete versions in a folder; a version is complete when its commit mark is there."""
    names = files.child_names(spark, path) if files.path_exists(spark, path) else []
    numbers = sorted(int(name.removeprefix("version=")) for name in names if name.startswith("version="))
    return [n for n in numbers if files.path_exists(spark, f"{path.rstrip('/')}/version={n}/_SUCCESS")]


def read_version(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest version of a table written by `write_version`, also when it has no rows; None when there is none."""
    numbers = _versions(spark, path)
    return spark.read.parquet(f"{path.rstrip('/')}/version={numbers[-1]}") if numbers else None


def write_version(df: DataFrame, path: str) -> None:
    """Write a whole small table as a new version, so it can be computed from the version before; old versions go."""
    spark = df.sparkSession
    numbers = _versions(spark, path)
    number = numbers[-1] + 1 if numbers else 1
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/version={number}")
    for old in numbers[: max(0, len(numbers) + 1 - VERSIONS_KEPT)]:
        files.delete_folder(spark, f"{path.rstrip('/')}/version={old}")
