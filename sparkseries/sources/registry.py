"""Sources by type string, and plug-ins for new ones."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource

from ..session import ensure_checkpoint_dir
from . import files, jdbc, ledger, payloads, workbooks


@dataclasses.dataclass(frozen=True)
class Source:
    """Where a named frame comes from.

    `format` is a type string such as `csv:/data`, `rest+http` or a database URL, or a callable
    `(spark, source) -> DataFrame`. `read` overrides everything. `parse` and `transform` shape the frame. Text in date columns is read
    by `date_formats`, or the usual ones; unreadable text is an error unless `strict_dates` is off. Of a source of URLs the option
    `on_failure="continue"` keeps the failed ones in a frame of their own instead of raising an error.
    """

    name: str
    format: str | Callable = "parquet"
    path: Any = None
    schema: str | None = None
    options: dict = dataclasses.field(default_factory=dict)
    read: Callable[[SparkSession], DataFrame] | None = None
    parse: Callable[[DataFrame], DataFrame] | None = None
    transform: Callable[..., DataFrame] | None = None
    transform_args: dict = dataclasses.field(default_factory=dict)
    date_formats: tuple[str, ...] | None = None
    strict_dates: bool = True


def failed_name(source: str) -> str:
    """The name of the frame that holds a source's failed URLs."""
    return f"{source}__failed"


def _payload(force):
    def read(spark, source, _root, frames):
        urls = source.path if isinstance(source.path, DataFrame) else spark.createDataFrame([(source.path,)], "url STRING")
        # Landed once: a second request could give other rows to the second use of the frame.
        ensure_checkpoint_dir(spark)
        options = dict(source.options)
        on_failure = options.pop("on_failure", "raise")
        answers = payloads.fetch_answers(urls, **options).checkpoint()
        failed = payloads.failed_answers(answers)
        if on_failure != "continue":
            shown = failed.limit(3).collect()
            if shown:
                raise files.SourceError(f"source {source.name}: failed URLs, such as {[(r['url'], r['error']) for r in shown]}")
        elif frames is not None:
            frames[failed_name(source.name)] = failed
        fetched = payloads.good_answers(answers)
        if source.schema is None:
            return fetched
        return payloads.decode_payloads(fetched, source.schema, force=force).drop("url", "status")

    return read


def _csv(spark, source, root, frames):
    if isinstance(source.path, DataFrame) or source.path.startswith(("http:", "https:")):
        return _payload("csv")(spark, source, root, frames)
    return files.read_csv(spark, files.join_path(root, source.path), source.schema, **source.options)


def _json(spark, source, root, _frames):
    return files.read_json(spark, files.join_path(root, source.path), source.schema, **source.options)


def _parquet(spark, source, root, _frames):
    return files.read_parquet(spark, files.join_path(root, source.path), source.schema, **source.options)


def _excel(spark, source, root, _frames):
    return workbooks.read_workbooks(spark, files.join_path(root, source.path), source.schema, **source.options)


def _spreadsheet(spark, source, root, _frames):
    return workbooks.read_spreadsheet_export(spark, files.join_path(root, source.path), source.schema, **source.options)


def _frame(_spark, source, _root, frames):
    return (frames or {})[source.path or source.name]


def _object(spark, source, _root, _frames):
    data, kind = source.path, source.options.get("data_type")
    if kind is None or data is None or not isinstance(data, kind):
        raise files.SourceError(f"data does not match data_type {kind}")
    if isinstance(data, DataFrame):
        return data
    if isinstance(data, dict):
        data = pd.DataFrame(data)
    return spark.createDataFrame(data, source.schema)


def _table(spark, source, _root, _frames):
    return spark.table(source.path)


def _ledger(spark, source, root, _frames):
    return ledger.read_ledger(spark, source.path, root, **source.options)


READERS: dict[str, Callable] = {
    "csv": _csv,
    "json": _json,
    "parquet": _parquet,
    "excel": _excel,
    "gsheet": _spreadsheet,
    "http": _payload(None),
    "rest+http": _payload("json"),
    "playwright+http": _payload("json"),
    "csv+http": _payload("csv"),
    "cache": _frame,
    "object": _object,
    "table": _table,
    "ledger": _ledger,
}
_PLUGINS: dict[str, Callable] = {}


def register_source(name: str, reader: Callable | type[DataSource], spark: SparkSession | None = None) -> None:
    """Add a source type: a `(spark, source) -> DataFrame` callable, or a Python data source class."""
    if isinstance(reader, type) and issubclass(reader, DataSource):
        (spark or SparkSession.active()).dataSource.register(reader)
        format_name = reader.name()

        def load(session, source):
            scan = session.read.format(format_name).options(**source.options)
            scan = scan.schema(source.schema) if source.schema else scan
            return scan.load(source.path) if source.path else scan.load()

        _PLUGINS[name] = load
    else:
        _PLUGINS[name] = reader


def resolve(type_string: str) -> tuple[Callable, str | None]:
    """Reader and root folder of a type string; the longest known name wins, an unknown one is an error."""
    if type_string in _PLUGINS:
        plugin = _PLUGINS[type_string]
        return (lambda spark, source, _root, _frames: plugin(spark, source)), None
    head, _, root = type_string.partition(":")
    scheme = head.split("+")[0]
    if scheme in jdbc.SQL_SCHEMES and root:
        return (lambda spark, source, _r, _f: jdbc.read_jdbc(spark, type_string, source.path, **source.options)), None
    matches = [name for name in READERS if head == name or head.startswith(name)]
    if not matches:
        raise ValueError(f"unknown source type {type_string!r}, expected one of {sorted([*READERS, *_PLUGINS])}")
    return READERS[max(matches, key=len)], root or None


def read_source(spark: SparkSession, source: Source, frames: dict[str, DataFrame] | None = None) -> DataFrame | None:
    if source.read is not None:
        return source.read(spark)
    if callable(source.format):
        return source.format(spark, source)
    reader, root = resolve(source.format)
    return reader(spark, source, root, frames)
