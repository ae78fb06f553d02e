"""Global row numbers without a single-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def number_rows(df: DataFrame, order: list[str], number: str = "number") -> DataFrame:
    """Number rows 0, 1, … in the given total order.

    Rows are range-partitioned and sorted; the checkpoint fixes that placement, so a lost executor cannot
    change it between the two reads below. Only one count per partition is added up in one place.
    """
    ensure_checkpoint_dir(df.sparkSession)
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_part", F.shiftright("_id", 33))
        .withColumn("_place", F.col("_id").bitwiseAND((1 << 33) - 1))
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    # One row per partition, so the broadcast side is bounded by the partition count.
    return placed.join(F.broadcast(offsets), "_part").withColumn(number, F.col("_offset") + F.col("_place")).select(
        *df.columns, number
    )
