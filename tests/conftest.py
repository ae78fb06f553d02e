import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sparkseries import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def series(spark):
    """Rows of (series, date, value, created_at) given as texts and numbers."""

    def make(rows):
        parsed = [
            (s, None if d is None else dt.date.fromisoformat(d), v, None if c is None else dt.datetime.fromisoformat(c))
            for s, d, v, c in rows
        ]
        return spark.createDataFrame(parsed, "series STRING, date DATE, value DOUBLE, created_at TIMESTAMP_NTZ")

    return make


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)
