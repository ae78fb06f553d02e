"""Intervals of validity, the store of runs, last write wins as state and long chains, against plain Python."""

import datetime as dt
import math
import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from sparkseries.operators import intervals, rounds, snapshot
from sparkseries.sources import runs, version_store
from sparkseries.streaming import jobs, state

KEYS = ("series", "date")


def random_versions(spark, rng, n, dates=6, low=1, high=20):
    day = dt.date(2024, 1, 1)
    rows = []
    for _ in range(n):
        arrival = dt.datetime(2024, 1, rng.randint(low, high), rng.choice([0, 12, 23]), rng.choice([0, 59]), rng.choice([0, 59]))
        rows.append((rng.choice(["a", "b", None]), None if rng.random() < 0.03 else day + dt.timedelta(rng.randint(0, dates) * 3),
                     rng.choice([None, 1.0, 2.0, 3.0]), None if rng.random() < 0.03 else arrival))
    return spark.createDataFrame(rows, "series STRING, date DATE, value DOUBLE, created_at TIMESTAMP_NTZ")


def expected_at(df, moments):
    found = []
    for moment in moments:
        found += [(moment, *r) for r in rows_of(snapshot.frozen_snapshot(df, str(moment)), "series", "date", "value", "created_at")]
    return sorted(found, key=repr)


def as_moments(spark, moments):
    return spark.createDataFrame([(m,) for m in moments], "moment TIMESTAMP_NTZ")


@pytest.mark.parametrize("seed", [1, 2])
def test_snapshots_equal_frozen_ones(spark, seed):
    rng = random.Random(seed)
    df = random_versions(spark, rng, 120)
    # Moments close together and far apart, on borders of days, twice, and none.
    moments = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 4), dt.datetime(2024, 1, 4, 0, 0, 1), dt.datetime(2023, 1, 1), dt.datetime(2025, 6, 1, 5)]
    moments += [dt.datetime(2024, 1, rng.randint(1, 25), rng.choice([0, 12]), rng.choice([0, 59])) for _ in range(4)]
    found = intervals.snapshots_at(intervals.version_intervals(df), as_moments(spark, [*moments, moments[0], None]))
    assert rows_of(found, "moment", "series", "date", "value", "created_at") == expected_at(df, sorted(set(moments)))


def test_no_moments_and_no_versions(spark):
    df = random_versions(spark, random.Random(5), 20)
    none = as_moments(spark, [])
    assert intervals.snapshots_at(intervals.version_intervals(df), none).count() == 0
    one = as_moments(spark, [dt.datetime(2024, 1, 9)])
    assert intervals.snapshots_at(intervals.version_intervals(df.limit(0)), one).count() == 0
    assert intervals.snapshots_at(intervals.version_intervals(df), one).columns == ["moment", *df.columns]


def test_every_pair_meets_once(spark):
    """A version that is valid all the time is not copied for each of the moments, and meets each of them once."""
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1), 1.0, dt.datetime(2024, 1, 1))], "series STRING, date DATE, value DOUBLE, created_at TIMESTAMP_NTZ")
    moments = spark.range(1000).select((F.lit("2024-01-02").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("id"))).alias("moment"))
    found = intervals.snapshots_at(intervals.version_intervals(df), moments)
    assert found.count() == 1000 and found.select("moment").distinct().count() == 1000
    spread = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in spread and "NestedLoop" not in spread


@pytest.mark.parametrize("few", [0, intervals.FEW_POINTS])
def test_no_block_goes_to_one_task(spark, monkeypatch, few):
    """Blocks of few moments are broadcast whatever the session's limit, so that the intervals are not shuffled by block; both ways give the same."""
    monkeypatch.setattr(intervals, "FEW_POINTS", few)
    df = random_versions(spark, random.Random(4), 60)
    moments = [dt.datetime(2024, 1, d, 12) for d in range(1, 25)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = intervals.snapshots_at(intervals.version_intervals(df), as_moments(spark, moments))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) == bool(few) and ("SortMergeJoin" in plan) != bool(few)
        assert rows_of(found, "moment", "series", "date", "value", "created_at") == expected_at(df, moments)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("seed", [7])
def test_kept_up_store(spark, tmp_path, seed):
    """Appends in order, out of order, repeated and empty leave the same snapshots as all versions at once."""
    rng, path = random.Random(seed), str(tmp_path / "store")
    parts = [random_versions(spark, rng, 40, low=low, high=high).cache() for low, high in ((5, 9), (10, 15), (1, 25), (16, 28))]
    for part in [*parts, parts[1], parts[0].limit(0)]:
        version_store.append_to_store(spark, path, part, KEYS)
    every = parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3]).cache()
    moments = [dt.datetime(2024, 1, d, 12) for d in (1, 5, 11, 20, 30)]
    found = version_store.stored_snapshots(spark, path, as_moments(spark, moments), every)
    assert rows_of(found, "moment", "series", "date", "value", "created_at") == expected_at(every.distinct(), moments)
    again = intervals.append_versions(intervals.version_intervals(parts[0].unionAll(parts[1])), parts[2].unionAll(parts[3]))
    columns = ["series", "date", "value", "created_at", intervals.FROM, intervals.TO]
    assert rows_of(again, *columns) == rows_of(version_store.stored_intervals(spark, path, every), *columns) == rows_of(intervals.version_intervals(every), *columns)


def test_an_append_leaves_months_that_ended_before(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = [("a", dt.date(2024, 1, 1), float(m), dt.datetime(2024, m, 1)) for m in range(1, 7)]
    schema = "series STRING, date DATE, value DOUBLE, created_at TIMESTAMP_NTZ"
    version_store.append_to_store(spark, path, spark.createDataFrame(rows, schema))
    before = runs.Manifest.read(spark, path).runs
    version_store.append_to_store(spark, path, spark.createDataFrame([("a", dt.date(2024, 1, 1), 9.0, dt.datetime(2024, 6, 15))], schema))
    after = {r.folder for r in runs.Manifest.read(spark, path).runs}
    assert [r.part for r in before if r.folder not in after] == ["open"] and len(before) == 6
    assert rows_of(version_store.stored_intervals(spark, path, spark.createDataFrame(rows, schema)).where(F.col(intervals.TO).isNull()), "value") == [(9.0,)]


# --- runs


def merged(own):
    """Runs of one part after what is due has been merged, as (level, weight)."""
    while wanted := runs.due([runs.Run("p", level, str(n)) for n, (level, _w) in enumerate(own)]).get("p"):
        gone = {int(r.folder) for r in wanted}
        own = [r for n, r in enumerate(own) if n not in gone] + [(max(r.level for r in wanted) + 1, sum(own[n][1] for n in gone))]
    return own


def test_levels_after_many_batches():
    """After n batches a part has at most log2(n) + 1 runs, and a row has been written as often."""
    own, written = [], 0
    for n in range(1, 201):
        before = {id(r) for r in own}
        own = merged([*own, (0, 1)])
        written += sum(w for r in own if id(r) not in before for w in [r[1]])
        assert len(own) <= math.log2(n) + 1 and sum(w for _l, w in own) == n
    assert written <= 200 * (math.log2(200) + 2)


def stored(spark, path, like):
    return rows_of(runs.read_store(spark, path, like), "date", "value")


def test_store_of_runs(spark, tmp_path):
    path, rng = str(tmp_path / "store"), random.Random(3)
    schema, every = "date DATE, value INT", []
    like = spark.createDataFrame([], schema)
    for batch in range(12):
        rows = [(None if rng.random() < 0.1 else dt.date(2024, rng.choice([1, 2]), 3), batch) for _ in range(5)]
        every += rows
        for _time in range(2):  # a batch that comes again adds nothing
            runs.append_runs(spark, path, spark.createDataFrame(rows, schema), runs.month_of("date"), "w", batch)
        manifest = runs.merge_runs(spark, path, like, runs.month_of("date"))
        for part in {r.part for r in manifest.runs}:
            assert len([r for r in manifest.runs if r.part == part]) <= math.log2(batch + 1) + 1
    assert stored(spark, path, like) == sorted(every, key=repr)
    assert rows_of(runs.read_store(spark, path, like, ["2024-02"]), "value") == sorted(((v,) for d, v in every if d and d.month == 2), key=repr)
    assert rows_of(runs.read_store(spark, path, like, [runs.NO_PART]), "value") == sorted(((v,) for d, v in every if d is None), key=repr)


def test_crash_before_the_commit(spark, tmp_path, monkeypatch):
    """Rows whose manifest was not written are not in the table, neither those of a merge; the next try is whole."""
    path, schema = str(tmp_path / "store"), "date DATE, value INT"
    frames = [spark.createDataFrame([(dt.date(2024, 1, 3), n)], schema) for n in range(3)]
    part = runs.month_of("date")
    runs.append_runs(spark, path, frames[0], part, "w", 0)
    with monkeypatch.context() as patch:
        patch.setattr(runs, "write_version", lambda *_a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            runs.append_runs(spark, path, frames[1], part, "w", 1)
    assert stored(spark, path, frames[0]) == [(dt.date(2024, 1, 3), 0)]
    runs.append_runs(spark, path, frames[1], part, "w", 1)
    with monkeypatch.context() as patch:
        patch.setattr(runs, "write_version", lambda *_a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            runs.merge_runs(spark, path, frames[0], part)
    assert [v for _d, v in stored(spark, path, frames[0])] == [0, 1]
    runs.merge_runs(spark, path, frames[0], part)
    assert [v for _d, v in stored(spark, path, frames[0])] == [0, 1]


def test_stream_opens_its_months_only(spark, tmp_path, monkeypatch):
    opened, path = [], str(tmp_path / "store")
    read = runs.read_store
    monkeypatch.setattr(runs, "read_store", lambda s, p, like, parts=None: opened.append(sorted(parts)) or read(s, p, like, parts))
    schema = "series STRING, date DATE, value DOUBLE, created_at TIMESTAMP_NTZ"
    stream = lambda: spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    for month in (1, 2, 1):
        rows = [("a", dt.date(2024, month, d), 1.0, dt.datetime(2024, 3, 1)) for d in (1, 2)]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(str(tmp_path / "in"))
        jobs.stream_reconcile_compacted(stream(), path, str(tmp_path / "checkpoint")).awaitTermination()
    assert opened == [["2024-01"], ["2024-02"], ["2024-01"]]
    assert read(spark, path, spark.createDataFrame([], schema)).count() == 4


# --- state


def last_by_hand(rows):
    best = {}
    for i, at, value in rows:
        held = best.get(i)
        if held is None or (at is not None and (held[0] is None or at > held[0])) or (at is None and held[0] is None):
            best[i] = (at, value)
    return sorted(((i, at, v) for i, (at, v) in best.items()), key=repr)


def test_state_over_restarts(spark, tmp_path):
    """Nulls, ties, late rows and a restart after each batch; one stored row per id, and no ranking in the read."""
    rng, schema, every = random.Random(6), "id STRING, timestamp TIMESTAMP_NTZ, value INT", []
    like = spark.createDataFrame([], schema)
    for batch in range(3):
        rows = [(rng.choice([*"abcdef", None]), None if rng.random() < 0.2 else dt.datetime(2024, 1, rng.randint(1, 28)), None) for _ in range(6)]
        rows = [(i, at, batch) for i, at, _v in {(i, at): (i, at, 0) for i, at, _v in rows}.values()]
        every += rows
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        query = state.keep_last_write(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state"))
        query.awaitTermination()
    live = state.live_rows(spark, str(tmp_path / "state"), like)
    assert rows_of(live) == last_by_hand(every)
    plan = live._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Window", "Sort", "Exchange", "Aggregate"))
    assert state.settled_rows(spark, str(tmp_path / "out"), like).count() == 0
    assert spark.conf.get(state.PROVIDER, "") != state.ROCKSDB


def test_state_without_python(spark, tmp_path):
    """Where no id is settled no function is called for an id: the state is a maximum of Spark's, in the order the processor has."""
    schema = "id STRING, timestamp TIMESTAMP_NTZ, value INT, tags ARRAY<STRING>"
    first, second = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    batches = [
        [("a", first, 1, None), ("a", first, None, ["x"]), ("b", second, 5, ["x"]), ("b", second, 5, ["y"]), ("c", None, 9, None), (None, first, 1, None)],
        # An equal stamp comes too late, any row replaces one without a stamp.
        [("a", first, 7, None), ("b", first, 8, None), ("c", None, 2, None), (None, second, 2, None)],
    ]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        query = state.keep_last_write(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state"))
        query.awaitTermination()
        plan = query._jsq.explainInternal(False)
        assert "StateStoreSave" in plan and "Python" not in plan and "Pandas" not in plan
    live = state.live_rows(spark, str(tmp_path / "state"), spark.createDataFrame([], schema))
    assert rows_of(live) == sorted([("a", first, 1, None), ("b", second, 5, ["y"]), ("c", None, 2, None), (None, second, 2, None)], key=repr)


def test_state_of_rows_without_an_order(spark, tmp_path):
    """Maps have no order, so a processor holds such rows, which decides only between equal stamps by them."""
    schema = "id STRING, timestamp TIMESTAMP_NTZ, value MAP<STRING, INT>"
    for day in (2, 1):
        spark.createDataFrame([("a", dt.datetime(2024, 1, day), {"x": day})], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        state.keep_last_write(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert rows_of(state.live_rows(spark, str(tmp_path / "state"), spark.createDataFrame([], schema))) == [("a", dt.datetime(2024, 1, 2), {"x": 2})]


# --- chains


def walks_by_hand(links, starts, bound, root):
    known = {}
    for c, p in links:
        held = [x for x in (known.get(c), p) if x is not None]
        known[c] = min(held) if held else None
    found = set()
    for c, r in starts:
        at, left = c, r
        while at is not None and left >= bound and at in known and (known[at] is not None or root):
            found.add((c, left, at))
            at, left = known[at], left - 1
    return found


@pytest.mark.parametrize("kind, seed, root", [("list", 1, False), ("any", 2, True)])
def test_contracted_chains(spark, monkeypatch, kind, seed, root):
    monkeypatch.setattr(rounds, "FEW_LINKS", 4)
    monkeypatch.setattr(rounds, "FEW_STEPS", 2)
    rng, n = random.Random(seed), 60
    links = [(v, None if v == 0 or rng.random() < 0.02 else v - 1 if kind == "list" else rng.randrange(max(v, 1) if kind == "forest" else n)) for v in range(n)]
    links += [(rng.randrange(n), rng.choice([None, rng.randrange(n)])) for _ in range(4)]
    starts = [(rng.randrange(n + 2), rng.choice([2, 9, 30])) for _ in range(3)] + [(n - 1, 40)]
    found = rounds.walk_chains(spark.createDataFrame(links, "cid LONG, prev_cid LONG"), spark.createDataFrame(starts, "cid LONG, round INT"), 1, root)
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == walks_by_hand(links, starts, 1, root)
