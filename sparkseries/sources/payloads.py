"""Payload tables: fetching many URLs in parallel, and decoding bodies by content type."""

from __future__ import annotations

import functools
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.payload import columns_to_records, records, unnest

# Content types of the supported payloads.
CSV_TYPE = "text/csv"
JSON_TYPE = "application/json"
EXCEL_TYPES = [
    "application/vnd.ms-excel",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
]
OK = 200

# Bodies held in memory at a time by one task.
FETCH_ROWS = 64


# Tries of one URL and the seconds between them.
TRIES = 3
WAIT = 2.0


def fetch_url(url: str, timeout: float = 60.0) -> tuple[int | None, str | None, bytes | None]:
    """(status, content type, body) of one URL; a failed request has no body."""
    try:
        with urllib.request.urlopen(url, timeout=timeout) as response:
            return getattr(response, "status", None) or OK, response.headers.get("content-type"), response.read()
    except urllib.error.HTTPError as error:
        return error.code, None, None
    except (OSError, ValueError):
        return None, None, None


def fetch_again(fetch: Callable, url: str, tries: int, wait: float) -> tuple:
    """(status, content type, body, error): the first good answer of some tries.

    No answer, a server's error and too many requests may pass, so these are tried again; other answers are final. What `fetch`
    raises counts as no answer.
    """
    status, error = None, None
    for attempt in range(tries):
        if attempt:
            time.sleep(wait)
        try:
            status, kind, body = fetch(url)
            error = None if status == OK else f"status {status}"
        except Exception as problem:
            status, error = None, f"{type(problem).__name__}: {problem}"
        if status == OK:
            return status, kind, body, None
        if status is not None and status < 500 and status != 429:
            break
    return status, None, None, error


def fetch_answers(
    urls: DataFrame, column: str = "url", fetch: Callable = fetch_url, partitions: int | None = None, tries: int = TRIES, wait: float = WAIT
) -> DataFrame:
    """One row per URL with status, content type, body and error next to the row's columns; failed URLs are rows too.

    Requests run inside the tasks, spread by row over `partitions` (by default one per core or shuffle partition, whichever
    are more). A lost task fetches its URLs again, so land the result (checkpoint or table) before it is used twice.
    """
    spark = urls.sparkSession
    number = partitions or max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spread = urls.repartition(number)
    answer = T.StructType.fromDDL("status INT, content_type STRING, body BINARY, error STRING")
    schema = T.StructType([*spread.schema.fields, *answer.fields])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), FETCH_ROWS):
                part = batch.iloc[start:start + FETCH_ROWS]
                answers = [fetch_again(fetch, url, tries, wait) for url in part[column]]
                yield part.assign(
                    status=pd.array([a[0] for a in answers], dtype="Int32"),
                    content_type=[a[1] for a in answers],
                    body=[a[2] for a in answers],
                    error=[a[3] for a in answers],
                )

    return spread.mapInPandas(run, schema)


def good_answers(answers: DataFrame) -> DataFrame:
    return answers.where(F.col("status") == OK).drop("error")


def failed_answers(answers: DataFrame) -> DataFrame:
    return answers.where(~F.col("status").eqNullSafe(F.lit(OK))).drop("content_type", "body")


def fetch_payloads(urls: DataFrame, column: str = "url", fetch: Callable = fetch_url, **options) -> DataFrame:
    """The good answers of `fetch_answers` alone."""
    return good_answers(fetch_answers(urls, column, fetch, **options))


def payload_kind(content_type: Column, force: str | None = None) -> Column:
    """csv, json, excel or bytes; `force` overrides the content type."""
    if force:
        return F.lit(force)
    return (
        F.when(content_type.startswith(CSV_TYPE), "csv")
        .when(content_type.startswith(JSON_TYPE), "json")
        .when(content_type.isin(EXCEL_TYPES), "excel")
        .otherwise("bytes")
    )


def body_text(body: Column) -> Column:
    return F.decode(body, "UTF-8")


# Stand in for line ends inside quotes while lines are told apart; texts that hold these characters themselves are escaped before.
_QUOTED_ENDS = {"\n": "\u0001", "\r": "\u0002"}
_ESCAPE = "\u0003"
_ESCAPED = {_ESCAPE: _ESCAPE + "3", "\u0001": _ESCAPE + "1", "\u0002": _ESCAPE + "2"}


def _escaped(body: Column) -> Column:
    held = functools.reduce(lambda text, pair: F.replace(text, F.lit(pair[0]), F.lit(pair[1])), _ESCAPED.items(), body)
    return F.when(body.rlike("[\u0001-\u0003]"), held).otherwise(body)


def _unescaped(text: Column) -> Column:
    """The escape itself is turned back last, so that what follows it is not taken for another."""
    pairs = reversed(_ESCAPED.items())
    plain = functools.reduce(lambda value, pair: F.replace(value, F.lit(pair[1]), F.lit(pair[0])), pairs, text)
    return F.when(F.contains(text, F.lit(_ESCAPE)), plain).otherwise(text)


def csv_records(body: Column, schema: str) -> Column:
    """CSV text as an array of structs. Its header line must name the fields of `schema`, in order; another header
    is an error, and so is a quote that is never closed. Quoted fields may hold commas, line breaks and doubled quotes."""
    fields = T.StructType.fromDDL(schema).fields
    body = _escaped(body)
    # Every second part between quotes is inside them.
    parts = F.split(body, '"', -1)
    ends, marks = "".join(_QUOTED_ENDS), "".join(_QUOTED_ENDS.values())
    marked = F.array_join(F.transform(parts, lambda part, at: F.when(at % 2 == 1, F.translate(part, ends, marks)).otherwise(part)), '"')
    quoted = F.contains(body, F.lit('"'))
    marked = F.when(quoted, marked).otherwise(body)
    lines = F.filter(F.split(marked, r"\r?\n"), lambda line: line != "")
    names = F.transform(F.split(F.get(lines, F.lit(0)), ","), lambda name: F.btrim(name, F.lit(' "\ufeff')))
    expected = F.array(*[F.lit(field.name) for field in fields])

    def record(line: Column) -> Column:
        row = F.from_csv(line, schema, {"escape": '"'})
        texts = (T.StringType, T.VarcharType, T.CharType)
        return F.struct(*[
            (_unescaped(F.translate(row[f.name], marks, ends)) if isinstance(f.dataType, texts) else row[f.name]).alias(f.name) for f in fields
        ])

    rows = F.transform(F.slice(lines, 2, F.greatest(F.size(lines), F.lit(1))), record)
    refused = F.raise_error(F.concat(F.lit("unexpected CSV header: "), F.get(lines, F.lit(0))))
    unclosed = F.raise_error(F.lit("a quote in a CSV payload is never closed"))
    return (
        F.when(quoted & (F.size(parts) % 2 == 0), unclosed).when((F.size(lines) == 0) | (names == expected), rows).otherwise(refused)
    )


def decode_payloads(
    payloads: DataFrame, schema: str, content_type: str = "content_type", body: str = "body", force: str | None = None
) -> DataFrame:
    """Rows of every CSV and JSON payload with the fields of `schema`; other kinds are left out.

    JSON bodies are a list of records or an object of lists. Each payload is decoded on its own, inside the JVM.
    """
    other = [c for c in payloads.columns if c not in (content_type, body)]
    text = F.col(body) if dict(payloads.dtypes)[body] == "string" else body_text(F.col(body))
    kind = payload_kind(F.col(content_type), force)
    fields = {f.name: f.dataType.simpleString() for f in T.StructType.fromDDL(schema).fields}
    listed = records(text, ", ".join(f"`{name}`: {type_}" for name, type_ in fields.items()))
    # columns_to_records gives the same struct type, so both shapes fit one column.
    json_rows = F.when(F.trim(text).startswith("{"), columns_to_records(text, fields)).otherwise(listed)
    rows = F.when(kind == "csv", csv_records(text, schema)).when(kind == "json", json_rows)
    return unnest(payloads, other, rows)


def fan_out(metadata: DataFrame, key: str, payloads: DataFrame, url: Callable[[Column], Column]) -> DataFrame:
    """Payloads of every table that has metadata `key`, marked with the table as `series`.

    The URL is built from the metadata value; all sources are rows of one frame instead of a loop.
    """
    from ..operators.catalog import metadata_by_key

    wanted = metadata_by_key(metadata, key).select(F.col("table").alias("series"), url(F.col("value")).alias("url"))
    return wanted.join(payloads, "url")
