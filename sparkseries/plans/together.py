"""Several targets of one run that become visible with one commit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import project
from ..operators.reconcile import reconcile
from ..sources.runs import Manifest, Run, merge_runs, read_runs, read_store, write_runs


def export_together(
    spark: SparkSession, path: str, frames: dict[str, DataFrame], as_of, run: str, number: int, places: int = 6
) -> dict[str, int]:
    """Appends the new rows of each frame to the target of its name in one store; returns the number of runs added per target.

    Rows of all targets are written first. They are no part of the targets until the manifest names them, which is one write for all of
    them: a kill at any point leaves all or nothing to see. The `number` of a run of that name is committed once, so a run that is repeated
    after a kill gives one copy of the rows, and one that is repeated after it ended adds nothing.
    """
    manifest = Manifest.read(spark, path)
    if manifest.batches.get(run, -1) >= number:
        return dict.fromkeys(frames, 0)
    added: dict[str, list[Run]] = {}
    for name, incoming in frames.items():
        clean = project.nan_as_null(incoming)
        stamped = project.stamp_created(clean, as_of) if "date" in clean.columns else clean
        added[name] = write_runs(reconcile(read_store(spark, path, stamped, [name]), stamped, places), path, F.lit(name))
    manifest.commit(spark, path, [r for runs in added.values() for r in runs], [], run, number)
    return {name: len(runs) for name, runs in added.items()}


def read_together(spark: SparkSession, path: str, names: list[str], like: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Some targets as they were after one and the same commit; `like` gives their columns."""
    manifest = Manifest.read(spark, path)
    return {name: read_runs(spark, path, [r for r in manifest.runs if r.part == name], like[name]) for name in names}


def merge_together(spark: SparkSession, path: str, like: dict[str, DataFrame]) -> None:
    """Merges the runs of the targets that are due, one commit for each target."""
    for name, frame in like.items():
        merge_runs(spark, path, frame, F.lit(name), parts=[name])
