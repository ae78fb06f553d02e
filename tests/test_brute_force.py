"""Operators against plain Python on random small inputs."""

import datetime as dt
import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from sparkseries.operators import rounds, snapshot
from sparkseries.operators import reconcile as rec

DAY = dt.date(2024, 1, 1)


def random_rows(rng, n):
    values = [None, 0.0, 1.0, 1.00000004, 1.0000006, 2.5, 3e-7]
    return [
        (rng.choice(["a", "b", None]), rng.choice([None, DAY, DAY + dt.timedelta(1), DAY + dt.timedelta(2)]), rng.choice(values),
         rng.choice([None, dt.datetime(2024, 1, rng.randint(1, 9))]))
        for _ in range(n)
    ]


def rounded(value):
    if not value:
        return value
    places = 6
    while abs(value) <= 10**-places:
        places += 3
    return round(value, places)


@pytest.mark.parametrize("seed", range(4))
def test_reconcile(spark, seed):
    rng = random.Random(seed)
    schema = "series STRING, date DATE, value DOUBLE, created_at TIMESTAMP_NTZ"
    base, incoming = random_rows(rng, 25), random_rows(rng, 60)
    known = {(s, d, rounded(v)) for s, d, v, _c in base}
    expected = {}
    for s, d, v, c in incoming:
        key = (s, d, rounded(v))
        if key not in known:
            held = expected.get(key)
            expected[key] = c if held is None else (held if c is None else min(held, c))
    found = rec.reconcile(spark.createDataFrame(base, schema), spark.createDataFrame(incoming, schema))
    assert rows_of(found) == sorted(((*key, c) for key, c in expected.items()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_frozen_snapshot(spark, seed):
    rng = random.Random(seed)
    rows = [("ab"[rng.randrange(2)], DAY + dt.timedelta(rng.randrange(8)), float(rng.randrange(100)),
             dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(240))) for _ in range(150)]
    now = dt.datetime(2024, 1, 4, 13)
    best = {}
    for s, d, v, c in rows:
        limit = now if d <= now.date() else dt.datetime.combine(d, dt.time(23, 59, 59))
        if c <= limit:
            best[(s, d)] = max(best.get((s, d), (c, v)), (c, v))
    df = spark.createDataFrame(rows, "series STRING, date DATE, value DOUBLE, created_at TIMESTAMP_NTZ")
    expected = sorted(((s, d, v, c) for (s, d), (c, v) in best.items()), key=repr)
    assert rows_of(snapshot.frozen_snapshot(df, now)) == expected


@pytest.mark.parametrize("seed", range(3))
def test_walks_over_random_links(spark, seed):
    rng = random.Random(seed)
    names = [f"n{i}" for i in range(25)]
    previous = {name: rng.choice([None, "unknown", *names, *names]) for name in names}
    starts = [(name, rng.randint(0, 30)) for name in rng.sample(names, 6)]
    expected = []
    for start, number in starts:
        cid = start
        while number >= 3 and previous.get(cid) is not None:
            expected.append((start, number, cid))
            cid, number = previous[cid], number - 1
    walked = rounds.walk_chains(
        spark.createDataFrame(list(previous.items()), "cid STRING, prev_cid STRING"),
        spark.createDataFrame(starts, "cid STRING, round INT"), bound=3,
    )
    assert rows_of(walked) == sorted(expected, key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_settlement(spark, seed):
    rng = random.Random(seed)
    pairs = [(r, k) for r in range(4) for k in "abcdefgh"]
    submissions, triggers = rng.sample(pairs, 20), rng.sample(pairs, 16)
    votes = [(*rng.choice(pairs), rng.random() < 0.5) for _ in range(40)]
    stakes = {k: 10 * (i + 1) for i, k in enumerate("abcdefgh")}
    expected = []
    for number in range(4):
        eligible = []
        for r, k in submissions:
            if r != number:
                continue
            cast = [valid for vr, vk, valid in votes if (vr, vk) == (r, k)]
            net = sum(1 if valid else -1 for valid in cast)
            if (r, k) not in triggers or net > 0:
                eligible.append(k)
            elif not cast or net < 0:
                expected.append((number, k, -(stakes[k] * 0.7)))
        expected += [(number, k, float(1000 // len(eligible))) for k in eligible]
    paid = rounds.settlement(
        spark.createDataFrame(submissions, "round INT, key STRING"), spark.createDataFrame(triggers, "round INT, key STRING"),
        spark.createDataFrame(votes, "round INT, key STRING, is_valid BOOLEAN"),
        spark.createDataFrame(list(stakes.items()), "key STRING, stake BIGINT"), F.lit(1000),
    )
    assert rows_of(paid, "round", "key", "amount") == sorted(expected, key=repr)


def test_last_write_wins_in_any_order(spark):
    rng = random.Random(7)
    rows = [(rng.choice("abcd"), rng.choice([None, 1, 2, 3]), i) for i in range(40)]
    df = spark.createDataFrame(rows, "id STRING, timestamp INT, value INT")
    expected = {}
    for key, stamp, value in rows:
        held = expected.get(key)
        if held is None or (-1 if stamp is None else stamp, value) > held:
            expected[key] = (-1 if stamp is None else stamp, value)
    found = snapshot.last_write_wins(df.limit(0), df)
    assert rows_of(found, "id", "value") == sorted((k, v) for k, (_s, v) in expected.items())
