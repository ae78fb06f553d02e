"""Last write wins as the state of a stream: one value per id, timers for ids that fall idle, reads without any ranking.

The state store of the checkpoint is the table: it holds the winning row of every live id, whatever the number of batches. An id without
rows for a while is settled: its row is appended to a folder and its state is dropped, so the state follows the ids that are alive.

Where no id is settled, the state is that of a streaming maximum, which Spark keeps without Python. Timers need a processor, called for each id.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ..sources.files import path_exists

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = "winner"
#: The stamp of a row without one.
NO_STAMP = -(1 << 63)
#: The operator that holds the state of a processor, by the metadata of a checkpoint.
PROCESSOR = "transformWithState"


class Winner(StatefulProcessor):
    """Holds (stamp in microseconds, row) of an id; a stored row yields only to a greater stamp, or when it has none."""

    def __init__(self, row: T.StructType, idle_ms: int | None):
        self.row, self.idle_ms = row, idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        schema = T.StructType([T.StructField("stamp", T.LongType()), T.StructField("row", self.row)])
        self.state = handle.getValueState(STATE, schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        best = None
        for part in rows:
            top = int(part["stamp"].max())
            if best is not None and top < best[0]:
                continue
            tied = part.loc[part["stamp"] == top, "row"]
            # Rows of the same stamp in one batch are decided by their other columns, the greatest wins and null is least.
            row = max(tied, key=_order) if len(tied) > 1 else tied.iloc[0]
            if best is None or top > best[0] or _order(row) > _order(best[1]):
                best = (top, row)
        if best is not None:
            held = self.state.get()
            if held is None or held[0] == NO_STAMP or best[0] > held[0]:
                self._set_timer(held, best[0])
                self.state.update((best[0], best[1]))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        held = self.state.get()
        if held is not None and self._expiry(held[0]) <= expiredTimerInfo.getExpiryTimeInMs():
            self.state.clear()
            yield pd.DataFrame({"row": [_plain(held[1])]})

    def _expiry(self, stamp: int) -> int:
        return stamp // 1000 + self.idle_ms

    def _set_timer(self, held, stamp: int) -> None:
        if self.idle_ms is None:
            return
        if held is not None and held[0] != NO_STAMP:
            self.handle.deleteTimer(self._expiry(held[0]))
        if stamp != NO_STAMP:
            self.handle.registerTimer(self._expiry(stamp))


def _plain(row):
    """A row as nested dictionaries."""
    return row.asDict(recursive=True) if hasattr(row, "asDict") else row


def _order(row) -> tuple:
    values = row.values() if isinstance(row, dict) else row
    return tuple((v is not None, 0 if v is None else v) for v in values)


def _ordered(kind: T.DataType) -> bool:
    """Whether Spark can tell which of two values is greater."""
    if isinstance(kind, T.StructType):
        return all(_ordered(field.dataType) for field in kind)
    return _ordered(kind.elementType) if isinstance(kind, T.ArrayType) else not isinstance(kind, (T.MapType, T.VariantType))


def _of_processor(spark: SparkSession, checkpoint: str) -> bool:
    """Whether the state in a checkpoint is held by a processor; a new one has none."""
    if not path_exists(spark, f"{checkpoint.rstrip('/')}/state"):
        return False
    held = spark.read.format("state-metadata").load(checkpoint).select("operatorName").distinct().collect()  # one line
    return any(line[0].startswith(PROCESSOR) for line in held)


def _winners(packed: DataFrame) -> DataFrame:
    """The winner of each id as a maximum: by stamp, for equal ones the earlier batch, in a batch the other columns, of which null is least.

    Of rows without a stamp the later batch wins. A batch is told by its time, which its log keeps, so a batch that is repeated has the same.
    """
    batch = F.unix_micros(F.current_timestamp())
    arrived = packed.withColumn("arrival", F.when(F.col("stamp") == NO_STAMP, batch).otherwise(-batch))
    return arrived.groupBy("key").agg(F.max(F.struct("stamp", "arrival", "row")).alias(STATE))


def _timed(packed: DataFrame, columns: list[str], idle: str | None, late: str) -> DataFrame:
    """The rows that a processor settles."""
    spark = packed.sparkSession
    if idle is not None:
        packed = packed.withWatermark("event_time", late)
    idle_ms = None if idle is None else spark.range(1).select(
        F.unix_millis(F.lit(0).cast("timestamp") + F.expr(f"INTERVAL {idle}"))
    ).first()[0]
    row = packed.schema["row"].dataType
    settled = packed.groupBy("key").transformWithStateInPandas(
        Winner(row, idle_ms), T.StructType([T.StructField("row", row)]), "Append", "None" if idle is None else "EventTime",
    )
    return settled.select(*[F.col("row")[c].alias(c) for c in columns])


def keep_last_write(
    stream: DataFrame, path: str, checkpoint: str, key: str = "id", stamp: str = "timestamp", idle: str | None = None, late: str = "1 hour",
    once: bool = True,
) -> StreamingQuery:
    """Keeps the winning row of each id as state: the greatest `stamp`, for equal ones the first to arrive.

    With `idle`, an id is settled when the watermark, `late` behind the newest row, has passed its last row by that long: its row is
    appended to `path` once, and a later row of it starts anew. Rows behind the watermark are dropped then. Without `idle` all ids stay. A query that is
    started again with the same checkpoint goes on where it stopped.
    """
    spark = stream.sparkSession
    columns = stream.columns
    micros = F.unix_micros(F.col(stamp).cast("timestamp"))
    rest = [c for c in columns if c not in (key, stamp)]
    packed = stream.select(
        F.col(key).alias("key"), F.coalesce(micros, F.lit(NO_STAMP)).alias("stamp"), F.col(stamp).cast("timestamp").alias("event_time"),
        F.struct(*[F.col(c) for c in (*rest, key, stamp)]).alias("row"),
    )
    if idle is None and _ordered(packed.schema["row"].dataType) and not _of_processor(spark, checkpoint):
        if not path_exists(spark, path):  # No row is ever settled.
            spark.range(0).select(*[F.lit(None).cast(stream.schema[c].dataType).alias(c) for c in columns]).write.parquet(path)
        writer = _winners(packed).writeStream.format("noop").outputMode("update")
    else:
        writer = _timed(packed, columns, idle, late).writeStream.format("parquet").outputMode("append").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
    # Value state needs this store, and it holds more ids than fit in memory. A stream notes it in its checkpoint, so the session keeps what it had for others.
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return writer.start()
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def live_rows(spark: SparkSession, checkpoint: str, like: DataFrame) -> DataFrame:
    """The winning row of every live id, read from the state as it is after the last batch; one row per id is stored, so none is ranked."""
    stored = spark.read.format("statestore").option("path", checkpoint)
    if _of_processor(spark, checkpoint):
        row = F.col("value.row")
        held = stored.option("stateVarName", STATE).load()
    else:
        held = stored.load()
        # The only value beside the key is the maximum.
        row = F.col("value")[held.schema["value"].dataType.fieldNames()[-1]]["row"]
    return held.select(*[row[c].alias(c) for c in like.columns])


def settled_rows(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The last rows of ids that fell idle, one each time they did."""
    return spark.read.schema(like.schema).parquet(path)
