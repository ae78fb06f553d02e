"""Ready-made ingests."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.project import drop_missing
from ..operators.rounds import yearly_sum
from ..sources.files import read_economic_csv
from ..sources.registry import Source
from ..sources.targets import Target
from .runner import Ingest


def economic_ingest(name: str, path: str, targets: list[Target], schedule: dict | None = None) -> Ingest:
    """A CSV of `Date` and `Value`: rows with a gap are dropped, new rows go to the targets."""

    def read(spark: SparkSession):
        clean = drop_missing(read_economic_csv(spark, path))
        return clean.select(F.col("Date").alias("date"), F.col("Value").alias("value"))

    def hand_over(frames):
        return {target.name: frames[name] for target in targets}

    return Ingest(name, [Source(name, read=read)], targets, hand_over, schedule=schedule or {"hour": "1"})


def yearly_ingest(
    name: str, path: str, output: str, value: str = "Life Ladder", format: str = "csv", scale: int | None = None
) -> Ingest:
    """Yearly sums of a column with decimal commas, written as CSV."""
    source = Source(
        f"{name}-source", format, path, options={"inferSchema": False} if format == "csv" else {},
        transform=lambda df: yearly_sum(df, value, scale=scale),
    )
    target = Target(f"{name}-export", "csv", output, replace=True)
    return Ingest(name, [source], [target], lambda frames: {target.name: frames[source.name]})
