"""The same operators over streams.

Every micro-batch writes a folder of its own, named after the stream's checkpoint and the batch. A batch that runs
again after a failure replaces exactly what it wrote, and leaves its own folder out when it reads the target.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import snapshot
from ..operators.reconcile import reconcile
from ..sources import runs
from ..sources.files import path_exists

FOLDERS = [T.StructField("stream", T.StringType()), T.StructField("batch_id", T.LongType())]


def stream_tag(checkpoint: str) -> str:
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:12]


def _stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    schema = T.StructType([*like.schema.fields, *FOLDERS])
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def read_batches(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """Rows of all batches, with the columns of `like`."""
    return _stored(spark, path, like).select(*like.columns)


def _start(
    stream: DataFrame, step: Callable[[DataFrame, str, int], DataFrame], path: str, checkpoint: str, once: bool
) -> StreamingQuery:
    tag = stream_tag(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        step(batch, tag, batch_id).write.mode("overwrite").parquet(f"{path}/stream={tag}/batch_id={batch_id}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()


def stream_reconcile(stream: DataFrame, path: str, checkpoint: str, places: int = 6, once: bool = True) -> StreamingQuery:
    """Append only rows the target does not hold yet."""

    def step(batch: DataFrame, tag: str, batch_id: int) -> DataFrame:
        stored = _stored(batch.sparkSession, path, batch)
        others = stored.where((F.col("stream") != tag) | (F.col("batch_id") != batch_id))
        return reconcile(others.select(*batch.columns), batch, places)

    return _start(stream, step, path, checkpoint, once)


def stream_reconcile_compacted(
    stream: DataFrame, path: str, checkpoint: str, places: int = 6, date: str = "date", merge: bool = True, once: bool = True
) -> StreamingQuery:
    """`stream_reconcile` into a store of runs by month: a batch opens only the months it has rows of.

    With `merge` runs that are due are merged after each batch; without it `runs.merge_runs` can be run by another job between batches. A batch
    that runs again after a failure finds itself in the manifest, or adds what the crash has left out.
    """
    tag = stream_tag(checkpoint)
    part = runs.month_of(date)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        months = [r["part"] for r in batch.select(part.alias("part")).distinct().collect()]
        stored = runs.read_store(spark, path, batch, months)
        runs.append_runs(spark, path, reconcile(stored, batch, places), part, tag, batch_id)
        if merge:
            runs.merge_runs(spark, path, batch, part)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()


def stream_last_write(
    stream: DataFrame, path: str, checkpoint: str, key: str = "id", stamp: str = "timestamp", once: bool = True
) -> StreamingQuery:
    """Store the winning row of each id per batch; `last_writes` resolves the batches when reading."""

    def step(batch: DataFrame, _tag: str, _batch_id: int) -> DataFrame:
        nothing = batch.sparkSession.createDataFrame([], batch.schema)
        return snapshot.last_write_wins(nothing, batch, key, stamp)

    return _start(stream, step, path, checkpoint, once)


def last_writes(spark: SparkSession, path: str, like: DataFrame, key: str = "id", stamp: str = "timestamp") -> DataFrame:
    """The winning row of each id over all batches.

    Among equal times the earliest batch stays; among rows without a time the latest batch does.
    """
    batch = F.col("batch_id")
    arrival = F.when(F.col(stamp).isNull(), -batch).otherwise(batch)
    rest = [F.desc_nulls_last(c) for c in like.columns if c not in (key, stamp)]
    order = [F.desc_nulls_last(stamp), arrival.asc(), F.asc("stream"), *rest]
    return snapshot.first_per_group(_stored(spark, path, like), [key], order).select(*like.columns)


def round_average_stream(
    prices: DataFrame, time: str = "ts", every: str = "10 minutes", late: str = "1 hour"
) -> DataFrame:
    """Average price per tumbling window, location and type; state is dropped `late` after a window ends."""
    return (
        prices.withColumn(time, F.col(time).cast("timestamp"))
        .withWatermark(time, late)
        .groupBy(F.window(time, every).alias("window"), "location", "type")
        .agg(F.avg("price").alias("price"), F.count(F.lit(1)).alias("scrapes"))
        .select(F.col("window.start").cast("timestamp_ntz").alias("round_start"), "location", "type", "price", "scrapes")
    )


def write_averages(averages: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Each closed window is appended once, in folders by month; what was written is never read again."""
    dated = averages.withColumn("month", F.date_format("round_start", "yyyy-MM"))
    writer = dated.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.partitionBy("month")
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()


def drop_repeats(stream: DataFrame, keys: list[str], time: str, late: str = "1 hour") -> DataFrame:
    """Repeated deliveries of a row within the watermark; corrections differ in a key and stay."""
    marked = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return marked.dropDuplicatesWithinWatermark(keys)
