"""Declared ingests: read sources, transform, append new rows to targets, refresh the catalogue."""

from __future__ import annotations

import dataclasses
import functools
import logging
import threading
import time
import traceback
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import catalog, project
from ..operators.reconcile import overlay, reconcile, round_frame
from ..operators.snapshot import latest_facts
from ..session import ensure_checkpoint_dir
from ..sources.registry import Source, failed_name, read_source
from ..sources.targets import Target, append_manifest, read_target, read_version, write_target, write_version

log = logging.getLogger(__name__)

REPORT_SCHEMA = "ingest STRING, target STRING, status STRING, rows BIGINT, seconds DOUBLE, error STRING"
#: One catalogue refresh at a time.
CATALOGUE = threading.Lock()
Transform = Callable[[dict[str, DataFrame]], dict[str, DataFrame]]


@dataclasses.dataclass(frozen=True)
class Ingest:
    name: str
    sources: tuple[Source, ...] | list[Source]
    targets: tuple[Target, ...] | list[Target]
    transform: Transform | Iterable[Transform] | None = None
    before: Callable[[], None] | None = None
    after: Callable[[], None] | None = None
    schedule: dict | None = None


@dataclasses.dataclass
class Run:
    """Frames by name, the new rows per target, and one report entry per target."""

    name: str
    frames: dict[str, DataFrame] = dataclasses.field(default_factory=dict)
    new_rows: dict[str, DataFrame] = dataclasses.field(default_factory=dict)
    entries: list[tuple] = dataclasses.field(default_factory=list)
    failed_urls: dict[str, int] = dataclasses.field(default_factory=dict)

    def report(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.entries, REPORT_SCHEMA)


def load(spark: SparkSession, source: Source, frames: dict[str, DataFrame] | None = None) -> DataFrame | None:
    """One source as a frame: read, parse, transform, dates parsed. None when the source has nothing."""
    df = read_source(spark, source, frames)
    if df is not None and source.parse is not None:
        df = source.parse(df)
    if df is not None and source.transform is not None:
        df = source.transform(df, **source.transform_args)
    return None if df is None else project.parse_date_columns(df, formats=source.date_formats, strict=source.strict_dates)


def new_rows(spark: SparkSession, target: Target, incoming: DataFrame, as_of) -> DataFrame:
    """What an export would append to its target; frames without a date are compared by all their columns too."""
    stamped = project.stamp_created(project.nan_as_null(incoming), as_of) if "date" in incoming.columns else project.nan_as_null(incoming)
    base = read_target(spark, target, stamped)
    if base is None:
        if target.replace:
            return round_frame(stamped)
        base = spark.createDataFrame([], stamped.schema)
        return reconcile(base, stamped, prune=False)
    if "created_at" in base.columns and "created_at" in stamped.columns:
        base = project.stamp_created(base, as_of)
    if target.reconcile is not None:
        return stamped if base.isEmpty() else target.reconcile(base, stamped)
    return reconcile(base, stamped, prune_by=(target.few_values_of,) if target.few_values_of else ())


def export(spark: SparkSession, target: Target, incoming: DataFrame, as_of, dry_run: bool = False, keep: bool = False):
    """(new rows, number written). Nothing is written when an appended target gets no new rows.

    The rows are computed once: they are held while they are tested and written. With `keep` they are checkpointed, so they can be
    read again once the target holds them.
    """
    rows = new_rows(spark, target, incoming, as_of)
    if dry_run:
        return rows, None
    if keep:
        ensure_checkpoint_dir(spark)
        rows = rows.checkpoint()
    else:
        rows = rows.persist()
    try:
        if not target.replace and target.create_table is None and rows.isEmpty():
            return rows, 0
        seen = Observation()
        write_target(rows.observe(seen, F.count(F.lit(1)).alias("rows")), target)
        return rows, seen.get["rows"]
    finally:
        if not keep:
            rows.unpersist()


def _dated_rows(target: Target, rows: DataFrame) -> DataFrame:
    series = F.col(target.series) if target.series else F.lit(target.name)
    return rows.select(series.cast("string").alias("table_name"), F.col("date").cast("date").alias("date"), "created_at")


def _has_facts(rows: DataFrame | None) -> bool:
    return rows is not None and {"date", "created_at"} <= set(rows.columns)


def refresh_catalogue(
    spark: SparkSession, appended: list[tuple[Target, DataFrame]], rules: DataFrame, path: str, as_of, gone: DataFrame | None = None
) -> None:
    """A new version of the catalogue after writes; it always agrees with what the targets hold.

    Appended rows are merged with the facts held; a replaced target's rows stand alone, and its series named in `gone(table_name)` that did
    not come again lose their rows. What the catalogue does not know yet comes from the stored rows: all of them if it knows no facts at all, or else
    those of the series that are new to it, by a filter that reaches the scan.
    """
    old = read_version(spark, path)
    old = old if old is not None else catalog.empty_catalogue(spark)
    with_facts = [(target, rows) for target, rows in appended if _has_facts(rows)]
    if not with_facts:
        return
    alone, merged = [], []
    for target, rows in with_facts:
        if target.replace:
            alone.append(_dated_rows(target, rows))
        elif (unknown := _unknown(old, target, rows)) is not None:
            stored = read_target(spark, target, rows)
            stored = stored if _has_facts(stored) else rows
            if target.series and not _knows_nothing(old):
                merged.append(_dated_rows(target, rows).join(unknown, "table_name", "left_anti"))
                stored = _of_series(stored, target.series, unknown)
            alone.append(_dated_rows(target, stored))
        else:
            merged.append(_dated_rows(target, rows))
    facts = []
    if alone:
        facts.append(latest_facts(functools.reduce(DataFrame.unionAll, alone), "table_name"))
    if merged:
        found = latest_facts(functools.reduce(DataFrame.unionAll, merged), "table_name")
        facts.append(catalog.newest_facts(found, old))
    single = [(target.name,) for target, _rows in with_facts if not target.series]
    known = functools.reduce(DataFrame.unionAll, facts)
    if single:
        # Tables without new rows are refreshed too; appended ones keep the facts they have, replaced ones are empty now.
        named = spark.createDataFrame(single, "table_name STRING").join(known.select("table_name"), "table_name", "left_anti")
        replaced = [t.name for t, _rows in with_facts if t.replace and not t.series]
        held = catalog.newest_facts(named.select("table_name", F.lit(None).cast("date").alias("latest_date"), F.lit(None).cast("timestamp_ntz").alias("last_update")), old)
        void = F.col("table_name").isin(replaced)
        known = known.unionByName(held.select("table_name", *[F.when(~void, F.col(c)).alias(c) for c in ("latest_date", "last_update")]))
    fresh = catalog.fact_rows(known, rules, as_of)
    renewed = [t.name for t, _rows in with_facts if t.replace and not t.series]
    if renewed:
        # What a replaced table no longer has a fact for is not carried over.
        facts_keys = F.col("_key").isin("latest_date", "last_update")
        stale = old.where(F.col("table_name").isin(renewed) & facts_keys).select("table_name", "_key")
        old = old.join(stale.join(fresh, ["table_name", "_key"], "left_anti"), ["table_name", "_key"], "left_anti")
    if gone is not None:
        lost = gone.select("table_name").join(known.select("table_name"), "table_name", "left_anti")
        old = old.join(lost, "table_name", "left_anti")
    write_version(catalog.upsert_catalogue(old, fresh), path)


#: So many names of new series are looked for by a filter that Parquet dictionaries can answer; more of them by a join.
NAMED_SERIES = 1000


def _facts_held(catalogue: DataFrame) -> DataFrame:
    return catalogue.where(F.col("_key") == "latest_date").select("table_name")


def _knows_nothing(catalogue: DataFrame) -> bool:
    return _facts_held(catalogue).isEmpty()


def _unknown(catalogue: DataFrame, target: Target, rows: DataFrame) -> DataFrame | None:
    """(table_name): the series among the new rows of which the catalogue holds no facts; None if it knows them all."""
    if target.series:
        named = _dated_rows(target, rows).select("table_name").distinct()
    else:
        named = rows.sparkSession.createDataFrame([(target.name,)], "table_name STRING")
    unknown = named.join(_facts_held(catalogue), "table_name", "left_anti")
    return None if unknown.isEmpty() else unknown


def _of_series(stored: DataFrame, series: str, names: DataFrame) -> DataFrame:
    few = names.limit(NAMED_SERIES + 1).collect()
    if len(few) > NAMED_SERIES:
        return stored.join(names.select(F.col("table_name").alias(series)), series, "left_semi")
    known = [r["table_name"] for r in few]
    chosen = F.col(series).isin([n for n in known if n is not None])
    return stored.where(chosen | F.col(series).isNull() if None in known else chosen)


def _series_of(spark: SparkSession, target: Target, like: DataFrame) -> DataFrame | None:
    """The series a replaced target holds before it is written again."""
    if not (target.replace and target.series):
        return None
    stored = read_target(spark, dataclasses.replace(target, replace=False), like)
    if stored is None or target.series not in stored.columns:
        return None
    ensure_checkpoint_dir(spark)
    return stored.select(F.col(target.series).cast("string").alias("table_name")).distinct().checkpoint()


def rebuild_catalogue(
    spark: SparkSession, targets: Iterable[tuple[Target, DataFrame]], rules: DataFrame, path: str, as_of
) -> None:
    """The catalogue from scratch, from all rows of the targets; each comes with a frame that gives its columns."""
    stored = [(t, read_target(spark, dataclasses.replace(t, replace=False), like)) for t, like in targets]
    parts = [_dated_rows(target, rows) for target, rows in stored if _has_facts(rows)]
    if parts:
        rows = functools.reduce(DataFrame.unionAll, parts)
        write_version(catalog.catalogue_rows(rows, rules, as_of, "table_name"), path)
    else:
        write_version(catalog.empty_catalogue(spark), path)


def run(
    spark: SparkSession,
    ingest: Ingest,
    as_of,
    dry_run: bool = False,
    on_error: str = "raise",
    catalogue_path: str | None = None,
    rules: DataFrame | None = None,
    manifest_path: str | None = None,
) -> Run:
    """Run one ingest. A dry run writes nothing and returns the frames and the would-be new rows.

    Errors are raised, or recorded in the report with `on_error="continue"`.
    """
    result = Run(ingest.name)
    started = time.monotonic()
    target_name = None
    try:
        if ingest.before:
            ingest.before()
        for source in ingest.sources:
            frame = load(spark, source, result.frames)
            if frame is not None:
                result.frames[source.name] = frame
            failed = result.frames.get(failed_name(source.name))
            if failed is not None:
                result.failed_urls[source.name] = failed.count()
        steps = ingest.transform if isinstance(ingest.transform, (list, tuple)) else [ingest.transform]
        for step in steps:
            if step is not None:
                result.frames = overlay(result.frames, step(result.frames))
        run_id = uuid.uuid4().hex
        rules = rules if rules is not None or not catalogue_path else catalog.load_rules(spark, None)
        for target in ingest.targets:
            target_name = target.name
            incoming = result.frames.get(target.name)
            if incoming is None:
                result.entries.append((ingest.name, target.name, "no frame", 0, 0.0, None))
                continue
            begun = time.monotonic()
            gone = _series_of(spark, target, incoming) if catalogue_path and not dry_run else None
            rows, written = export(spark, target, incoming, as_of, dry_run, keep=catalogue_path is not None)
            result.new_rows[target.name] = rows
            status = "dry run" if dry_run else "written"
            result.entries.append((ingest.name, target.name, status, written, time.monotonic() - begun, None))
            # Each target is recorded right after its write, so a later failure leaves nothing unrecorded.
            if not dry_run and manifest_path:
                append_manifest(spark, manifest_path, run_id, [(target.name, target.location, written)])
            if not dry_run and catalogue_path:
                # Ingests that run at once share the catalogue, whose next version is made from the one before.
                with CATALOGUE:
                    refresh_catalogue(spark, [(target, rows)], rules, catalogue_path, as_of, gone)
        for name, failed in result.failed_urls.items():
            result.entries.append((ingest.name, name, "failed urls", failed, 0.0, None))
        if ingest.after:
            ingest.after()
        log.info("ingest %s ran in %.1f seconds", ingest.name, time.monotonic() - started)
    except Exception as error:
        log.exception("ingest %s failed", ingest.name)
        if on_error != "continue":
            raise
        text = "".join(traceback.format_exception_only(error)).strip()
        result.entries.append((ingest.name, target_name, "failed", None, time.monotonic() - started, text))
    return result


def run_all(
    spark: SparkSession, make: Callable[..., Ingest | list[Ingest]], as_of, config: dict | None = None, together: int = 1, **kwargs
) -> list[Run]:
    """Run every ingest a declaration makes from `key=value` config; each run starts with no frames.

    Up to `together` ingests run at once, each in a scheduler pool of its own name, so that with the fair scheduler small ones do not wait for
    large ones. The runs are returned in the order of the ingests. With `on_error="continue"` a failure stays with its own ingest; else the
    ingests that have begun are ended and the first error is raised.
    """
    made = make(**(config or {}))
    ingests = made if isinstance(made, list) else [made]
    if together <= 1 or len(ingests) <= 1:
        return [run(spark, ingest, as_of, **kwargs) for ingest in ingests]
    stop = threading.Event()

    def one(ingest: Ingest) -> Run | None:
        if stop.is_set():
            return None
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", ingest.name)
        try:
            return run(spark, ingest, as_of, **kwargs)
        except Exception:
            stop.set()
            raise
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=together, thread_name_prefix="ingest") as workers:
        waiting = [workers.submit(inheritable_thread_target(spark)(one), ingest) for ingest in ingests]
    return [done.result() for done in waiting]


def config_of(arguments: Iterable[str]) -> dict[str, str]:
    """`key=value` items of a command line; the others are file names."""
    return dict(item.split("=", 1) for item in arguments if "=" in item)


def publish(frames: dict[str, DataFrame]) -> None:
    """Make named frames available to SQL."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def clear(spark: SparkSession, frames: dict[str, DataFrame]) -> None:
    """Forget named frames and their views."""
    for name, frame in frames.items():
        frame.unpersist()
        spark.catalog.dropTempView(name)
    frames.clear()


def output(spark: SparkSession, ingests: Iterable[Ingest], name: str, as_of) -> DataFrame:
    """One named frame after the given ingests ran without writing."""
    frames: dict[str, DataFrame] = {}
    for ingest in ingests:
        frames = overlay(frames, run(spark, ingest, as_of, dry_run=True).frames)
    return frames[name]


def copy(spark: SparkSession, source: Source, target: Target) -> None:
    """Read one source and write it to one target as it is."""
    write_target(load(spark, source), target)
