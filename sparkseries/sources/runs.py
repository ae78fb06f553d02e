"""A store of runs: immutable folders by part (such as a month), merged by levels, listed by one manifest.

Writers add a run to each part they touch. Two runs of one level become one of the next, as digits carry in a binary counter, so after n
writes a part has at most log2(n) + 1 runs and a row has been written again as often. The newest complete version of the manifest is the
only pointer: what it does not name is not part of the table, so a crash at any point leaves the table as it was before or after.
One writer at a time may commit; readers need no lock, because folders stay until two versions later.
"""

from __future__ import annotations

import dataclasses
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files
from .targets import read_version, write_version

MANIFEST = "part STRING, level INT, folder STRING, high STRING, state STRING, writer STRING, batch BIGINT"
NO_PART = "none"
#: What a line of the manifest says: a run of the table, a folder that goes with the next commit, the last batch of a writer.
RUN, RETIRED, WRITER = "run", "retired", "writer"


@dataclasses.dataclass(frozen=True)
class Run:
    part: str
    level: int
    folder: str
    high: str | None = None


@dataclasses.dataclass
class Manifest:
    """What the table consists of: its runs, folders that are no longer in it, and the last batch each writer has committed."""

    runs: list[Run] = dataclasses.field(default_factory=list)
    retired: list[str] = dataclasses.field(default_factory=list)
    batches: dict[str, int] = dataclasses.field(default_factory=dict)

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Manifest:
        stored = read_version(spark, _manifest_path(path))
        found = cls()
        for line in [] if stored is None else stored.collect():  # parts times levels, and one line a writer
            if line["state"] == RUN:
                found.runs.append(Run(line["part"], line["level"], line["folder"], line["high"]))
            elif line["state"] == RETIRED:
                found.retired.append(line["folder"])
            else:
                found.batches[line["writer"]] = line["batch"]
        return found

    def commit(self, spark: SparkSession, path: str, added: Iterable[Run], removed: Iterable[Run], writer: str | None = None, batch: int | None = None) -> Manifest:
        """The next manifest, written as one version. Folders retired by the version before are deleted after it."""
        gone = {run.folder for run in removed}
        batches = self.batches | ({writer: batch} if writer is not None else {})
        following = Manifest([r for r in self.runs if r.folder not in gone] + list(added), sorted(gone), batches)
        lines = [(r.part, r.level, r.folder, r.high, RUN, None, None) for r in following.runs]
        lines += [(None, None, folder, None, RETIRED, None, None) for folder in following.retired]
        lines += [(None, None, None, None, WRITER, w, b) for w, b in batches.items()]
        write_version(spark.createDataFrame(lines, MANIFEST).coalesce(1), _manifest_path(path))
        for folder in self.retired:
            files.delete_folder(spark, f"{path.rstrip('/')}/{folder}")
        return following


def _manifest_path(path: str) -> str:
    return f"{path.rstrip('/')}/manifest"


def month_of(column: str) -> Column:
    """The part of a row by the month of a date or timestamp."""
    return F.coalesce(F.date_format(column, "yyyy-MM"), F.lit(NO_PART))


def read_runs(spark: SparkSession, path: str, runs: Iterable[Run], like: DataFrame) -> DataFrame:
    """The rows of some runs, with the columns of `like`."""
    folders = [f"{path.rstrip('/')}/{run.folder}" for run in runs]
    return spark.read.schema(like.schema).parquet(*folders) if folders else spark.createDataFrame([], like.schema)


def read_store(spark: SparkSession, path: str, like: DataFrame, parts: Iterable[str] | None = None) -> DataFrame:
    """The rows of the table, or of some of its parts; folders of other parts are not opened."""
    wanted = None if parts is None else set(parts)
    runs = [r for r in Manifest.read(spark, path).runs if wanted is None or r.part in wanted]
    return read_runs(spark, path, runs, like)


def write_runs(rows: DataFrame, path: str, part: Column, level_of: Callable[[str], int] = lambda _part: 0, high: str | None = None) -> list[Run]:
    """Writes the rows as one run for each part, not yet part of the table. `high` names a column whose greatest value each run notes.

    Adaptive execution gives each part few files and splits large ones, whatever their share of the rows.
    """
    spark, name = rows.sparkSession, uuid.uuid4().hex
    folder = f"{path.rstrip('/')}/data/{name}"
    rows.withColumn("_part", part).hint("rebalance", "_part").write.partitionBy("_part").parquet(folder)
    parts = [n.removeprefix("_part=") for n in files.child_names(spark, folder) if n.startswith("_part=")]
    highs: dict[str, str] = {}
    if high is not None and parts:
        # The greatest value comes from the footers of what has just been written.
        stored = spark.read.schema(f"`{high}` {rows.schema[high].dataType.simpleString()}, _part STRING").parquet(folder)
        highs = {r["_part"]: r["high"] for r in stored.groupBy("_part").agg(F.max(high).cast("string").alias("high")).collect()}
    return [Run(p, level_of(p), f"data/{name}/_part={p}", highs.get(p)) for p in parts]


def append_runs(
    spark: SparkSession, path: str, rows: DataFrame, part: Column, writer: str | None = None, batch: int | None = None, high: str | None = None
) -> Manifest:
    """Adds the rows to the parts they belong to. A writer's batch that is committed already is left out, so a repeated one adds nothing."""
    manifest = Manifest.read(spark, path)
    if writer is not None and manifest.batches.get(writer, -1) >= batch:
        return manifest
    return manifest.commit(spark, path, write_runs(rows, path, part, high=high), [], writer, batch)


def due(runs: Iterable[Run]) -> dict[str, list[Run]]:
    """The runs of each part that are to become one: the lowest ones, as far as carrying goes, as in a binary counter."""
    by_part: dict[str, list[Run]] = defaultdict(list)
    for run in runs:
        by_part[run.part].append(run)
    found = {}
    for part, own in by_part.items():
        merged, level = [], 0
        for number in range(max(r.level for r in own) + 1):
            here = [r for r in own if r.level == number]
            if here and len(here) + (bool(merged) and level == number) > 1:
                merged += here
                level = number + 1
        if merged:
            found[part] = merged
    return found


def merge_runs(
    spark: SparkSession, path: str, like: DataFrame, part: Column, high: str | None = None, parts: Iterable[str] | None = None
) -> Manifest:
    """Merges the runs that are due, of all parts or some, in one job and one commit; the rows of the table stay the same.

    It may be left out, run after every batch or by another job while no batch is written.
    """
    manifest = Manifest.read(spark, path)
    chosen = None if parts is None else set(parts)
    wanted = due([r for r in manifest.runs if chosen is None or r.part in chosen])
    if not wanted:
        return manifest
    old = [run for runs in wanted.values() for run in runs]
    levels = {p: max(r.level for r in runs) + 1 for p, runs in wanted.items()}
    fresh = write_runs(read_runs(spark, path, old, like), path, part, levels.__getitem__, high)
    return manifest.commit(spark, path, fresh, old)
