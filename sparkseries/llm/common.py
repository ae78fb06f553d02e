"""What several operators of this folder share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: Bytes of text that a task takes into numpy arrays at once.
SLICE_BYTES = 4_000_000


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator works on, a null text as an empty one; other columns cannot get in its way."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def kept(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder, so that neither lost executors nor later steps redo them."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def worker_state(key: tuple, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps from one task to the next of the same kind, made at first use.

    Task functions travel by value, so their own globals last for a task only; a module of this process lasts longer. The first task of
    another kind that reads texts drops it again, so that stages which follow each other do not add up in memory.
    """
    held = sys.modules.setdefault("sparkseries_worker_state", types.ModuleType("sparkseries_worker_state")).__dict__
    state = held.setdefault("state", {})
    if key not in state:
        state.clear()
        state[key] = make()
    return state[key]


def drop_worker_state(holding: tuple | None) -> None:
    held = sys.modules.get("sparkseries_worker_state")
    if held is not None and holding not in held.__dict__.get("state", {}):
        held.__dict__["state"] = {}


def text_slices(
    batches: Iterator[pa.RecordBatch], at_most: int = SLICE_BYTES, holding: tuple | None = None
) -> Iterator[pa.RecordBatch]:
    """Parts of batches with about `at_most` bytes of their column `text`; a longer text stands alone.

    `holding` is the key of the worker's state that the task uses.
    """
    drop_worker_state(holding)
    for batch in batches:
        sizes = pc.binary_length(batch.column("text")).to_pylist()
        start = taken = 0
        for row, size in enumerate(sizes):
            size = size or 0
            if row > start and taken + size > at_most:
                yield batch.slice(start, row - start)
                start, taken = row, 0
            taken += size
        if start < len(sizes):
            yield batch.slice(start)


def join_sums(rows: DataFrame, counted: DataFrame, key: str) -> DataFrame:
    """The rows joined with sums of theirs by a key that may be very frequent.

    Both sides are shuffled for the join alone, by the key with a bit flipped: a side that still lay as its aggregation left it would keep
    adaptive execution from splitting a frequent key.
    """
    flipped = F.col(key).bitwiseXOR(F.lit(1).cast("long")).alias("_met")
    left = rows.select(*rows.columns, flipped)
    right = counted.select(flipped, *[c for c in counted.columns if c != key])
    return left.join(right, "_met").drop("_met")


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column."""
    return column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()


def crc_remainder(id_column: Column, parts: int) -> Column:
    """crc32 of an id written as text, modulo `parts`."""
    return F.crc32(id_column.cast("string")) % parts


def signature(df: DataFrame) -> tuple:
    """A value that differs when the rows of a table differ."""
    seen = df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*df.columns))).first()
    return tuple(seen)


def session_of(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
