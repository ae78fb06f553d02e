"""Fixtures of the tests in this folder; a second conftest would hide the first."""

import random

import pytest

SCHEMA = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"


@pytest.fixture
def documents(spark):
    """A table like `documents` from (doc_id, text) or (doc_id, text, lang) rows, with columns whose names could get in the way."""

    def make(rows, partitions=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", None if r[1] is None else len(r[1]), -1, "x") for r in rows]
        return spark.createDataFrame(full, SCHEMA + ", fp LONG, rest STRING").repartition(partitions)

    return make


@pytest.fixture
def words():
    """A maker of random words."""
    rng = random.Random(5)

    def make(n, letters="abcdefghij", longest=6):
        return ["".join(rng.choice(letters) for _ in range(rng.randint(1, longest))) for _ in range(n)]

    return make
